"""Mixing sources to target weights.

Every row gets a hash-random key of its id. A source's rows, sorted by that key, form its epoch; the mix takes whole
epochs and then a prefix of the next one, cut exactly at the source's budget. Keys are uniform, so their high bits cut a
source into even ranges; prefix sums run over the ranges' totals first, and only the range that holds the cut is sorted.
What is decided for a source is one cut, so rows themselves are never moved.

Defined results: the NULL source is a source of its own, last in the order; rows of size 0 or NULL are taken 0 times;
rows with the same key, id and size are interchangeable and share evenly what the cut leaves for them (rounded down);
an empty table gives no rows. Reruns agree, as keys depend on ids and the seed only.
Added columns (``size``, ``source_size``, ``target``, ``taken``) replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetlens.llm.common import materialize

ROWS_PER_RANGE = 20_000
# Up to so many sources, what is decided for them (a row of under 100 bytes each) is broadcast; beyond, it is joined by shuffles.
FEW_SOURCES = 10_000


def key_of(row_id: Column, seed: int) -> Column:
    """Uniform 62-bit key of a row's id."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), row_id), 2)


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """Add ``rank``, from 0 by code point with NULL last; no task sees more than a range of the sources."""
    ranged = (
        sizes.repartitionByRange(F.col("source").asc_nulls_last())
        .sortWithinPartitions(F.col("source").asc_nulls_last())
        .withColumn("_at", F.monotonically_increasing_id())
    )
    ranged = materialize(ranged, "mix-sources")
    part, local = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # a row per partition
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        ranged.withColumn("_part", part).join(offsets, "_part")
        .withColumn("rank", F.col("_offset") + local).drop("_at", "_part", "_offset")
    )


def with_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """Add ``weight`` and ``target`` to rows (source, source_size).

    Targets are weight * level, but ``most`` times the source at most, and add up to ``share`` of all sizes. Each round
    reshares the excess of the sources above their cap; two sums per round reach the driver. Whole numbers until the
    one last division.
    """
    part = Fraction(share).limit_denominator(10_000)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = materialize(ranked_sources(sizes).withColumn("weight", weight.cast("long")), "mix-weights")
    total = (ranked.agg(F.sum("source_size")).first()[0] or 0) * part.numerator  # in units of 1 / denominator
    cap = F.col("source_size") * (most * part.denominator)
    above, level, free = F.lit(False), Fraction(0), None
    while True:
        capped, weights_left = ranked.agg(
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))
        ).first()
        if weights_left in (0, free):
            break
        free, level = weights_left, Fraction(int(total - capped), int(weights_left))
        # weight * level > cap, in whole numbers
        above = F.col("weight").cast("decimal(38,0)") * F.lit(str(level.numerator)).cast("decimal(38,0)") > (
            cap.cast("decimal(38,0)") * F.lit(str(level.denominator)).cast("decimal(38,0)"))
    shared = F.col("weight") * F.lit(float(level.numerator)) / F.lit(float(level.denominator * part.denominator))
    return ranked.withColumn(
        "target", F.when(above, (F.col("source_size") * most).cast("double")).otherwise(shared)
    ).drop("rank")


def mix(
    df: DataFrame, size: Column, source: str = "source", row_id: str = "doc_id", share: float = 1.5,
    weights: Sequence[int] = (5, 2, 1), most: int = 2, seed: int = 17,
) -> DataFrame:
    """Every row of ``df`` with ``size``, its source's ``source_size`` and ``target``, and ``taken``."""
    slim = materialize(df.select(
        F.col(source).alias("source"), F.col(row_id).alias("id"),
        F.coalesce(size.cast("long"), F.lit(0)).alias("size"), key_of(F.col(row_id), seed).alias("key"),
    ), "mix-rows")

    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    targets = materialize(with_targets(sizes, weights, share, most), "mix-targets")
    whole = F.col("target") >= F.col("source_size") * F.lit(most)
    epochs = F.when(whole, F.lit(most)).otherwise(F.floor(F.col("target") / F.col("source_size")))
    targets = targets.withColumn("epochs", F.when(F.col("source_size") > 0, epochs).otherwise(0).cast("long"))
    targets = targets.withColumn("rest", F.floor("target").cast("long") - F.col("epochs") * F.col("source_size"))

    shape = targets.agg(F.max("rows").alias("largest"), F.count(F.lit(1)).alias("sources")).first()
    bits = max(8, ((shape.largest or 0) // ROWS_PER_RANGE).bit_length())
    beside = F.broadcast if shape.sources <= FEW_SOURCES else (lambda side: side)
    at = F.shiftright("key", 62 - bits)

    # The range that holds the cut of each source.
    ranges = slim.groupBy("source", at.alias("range")).agg(F.sum("size").alias("_sum"))
    in_order = W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, 0)
    cut_range = (
        ranges.withColumn("_end", F.sum("_sum").over(in_order)).withColumn("before", F.col("_end") - F.col("_sum"))
        .withColumnRenamed("source", "__llm_source")
        .join(targets, F.col("__llm_source").eqNullSafe(F.col("source")))
        .where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("_end")))
        .select(F.col("__llm_source"), F.col("range").alias("_range"), "before", "rest")
    )
    # The row that holds it: the first whose prefix sum passes the rest.
    by_key = W.partitionBy("__llm_source", "_range").orderBy("key", "id", "size").rowsBetween(W.unboundedPreceding, 0)
    words = F.col("size") * F.col("n")
    cut = (
        slim.join(beside(cut_range), F.col("source").eqNullSafe(F.col("__llm_source")) & (at == F.col("_range")))
        .groupBy("__llm_source", "_range", "before", "rest", "key", "id", "size").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("_end", F.sum(words).over(by_key) + F.col("before"))
        .where((F.col("_end") - words <= F.col("rest")) & (F.col("rest") < F.col("_end")))
        .select("__llm_source", F.struct("key", "id", "size").alias("__llm_cut"),
                F.floor((F.col("rest") - F.col("_end") + words) / F.col("n")).cast("long").alias("__llm_left"))
    )
    decided = targets.join(cut, F.col("source").eqNullSafe(F.col("__llm_source")), "left").select(
        F.col("source").alias("__llm_source"), F.col("source_size").alias("__llm_source_size"), F.col("target").alias("__llm_target"),
        F.col("epochs").alias("__llm_epochs"), "__llm_cut", "__llm_left")

    here = F.struct(F.col("__llm_key").alias("key"), F.col(row_id).alias("id"), F.col("__llm_size").alias("size"))
    extra = F.when(F.col("__llm_cut").isNull(), 0).when(here < F.col("__llm_cut"), F.col("__llm_size")).when(
        here == F.col("__llm_cut"), F.col("__llm_left")).otherwise(0)
    rows = df.withColumns({"__llm_size": F.coalesce(size.cast("long"), F.lit(0)), "__llm_key": key_of(F.col(row_id), seed)})
    added = ["size", "source_size", "target", "taken"]
    return (
        rows.join(beside(decided), F.col(source).eqNullSafe(F.col("__llm_source")), "left")
        .withColumn("__llm_taken", F.col("__llm_epochs") * F.col("__llm_size") + extra)
        .select(*[c for c in df.columns if c not in added], *[F.col(f"__llm_{c}").alias(c) for c in added])
    )


def repeated(mixed: DataFrame, text: str = "text") -> DataFrame:
    """The mix as rows: each row once per whole epoch, then once cut to the words left, if any.

    Expects the columns of ``mix``; a cut text keeps its first words with the white space before them.
    """
    times = F.ceil(F.col("taken") / F.col("size")).cast("int")
    rows = mixed.where("taken > 0").withColumn("__llm_epoch", F.explode(F.sequence(F.lit(1), times)))
    left = F.col("taken") - (F.col("__llm_epoch") - 1) * F.col("size")
    words = F.regexp_extract_all(F.col(text), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    cut = F.array_join(F.slice(words, F.lit(1), left.cast("int")), "")
    return rows.withColumn(text, F.when(left < F.col("size"), cut).otherwise(F.col(text))).drop("__llm_epoch")
