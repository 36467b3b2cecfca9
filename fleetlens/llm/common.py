"""Reading tables, scratch tables and Arrow batch sizes shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.session import scratch_dir

# A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

# Rows of whole texts that travel to a Python worker at once.
TEXTS_PER_BATCH = 256


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts lineage and outlives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = TEXTS_PER_BATCH) -> None:
    """Bound the memory of Python workers: whole texts may be long, so few of them go into one Arrow batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def n_words(text: Column) -> Column:
    """Number of words; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def gathered(batches: Iterator[pd.DataFrame], rows: int = 8192) -> Iterator[pd.DataFrame]:
    """The same rows in batches of at least ``rows``, for work that is vectorized over short rows."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n >= rows:
            yield pd.concat(held, ignore_index=True)
            held, n = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)
