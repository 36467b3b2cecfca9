"""The corpus pipeline: stages from raw documents to token ids. Each stage reads what the one before it wrote."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import bpe, jaccard, mixing, pii, quality
from fleetlens.llm.common import materialize, n_words, read_table, small_batches

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

RANKS = "byte_bpe_50k.tiktoken"
# The key of the surrogates; real runs pass a secret of their own.
PII_KEY = "corpus-pipeline"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the first policy keeps."""
    return quality.keep(docs, "v1")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of documents that are similar, directly or through others: that of the smallest id."""
    small_batches(spark)
    return jaccard.representatives(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data and secrets."""
    return pii.pseudonymize(docs, PII_KEY).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per time that the mix takes a document; the row at a source's cut holds the words up to it."""
    taken = mixing.mix(docs.withColumn("_row", F.struct(*docs.columns)), n_words(F.col("text")))
    rows = mixing.repeated(taken.select("_row.text", "_row", "size", "taken"))
    return rows.select(*[F.col("text") if c == "text" else F.col(f"_row.{c}") for c in docs.columns])


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token ids of every row, and digests of the ids and of the bytes that they decode to."""
    small_batches(spark)
    ranks = bpe.Ranks.load(public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    ids = bpe.encode(docs.select("doc_id", "lang", "source", "text"), ranks, packed=True).drop("text")
    return bpe.decode(ids, ranks).select(
        "doc_id", "lang", "source", bpe.n_ids(F.col("ids")).alias("n_tokens"), "ids", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("private", private),
    ("mixed", mixed),
    ("encoded", encoded),
]

# Byte-pair merges, locality hashing and surrogates are beyond SQL; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written to the scratch folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
