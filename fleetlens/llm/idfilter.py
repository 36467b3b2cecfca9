"""A filter of fixed size that lets through all rows whose id is in a set, and few others.

It stands before a join that would else move every text. The set becomes 2^BITS bits, kept as at most 2^(BITS - 6) rows of 64 bits: that size
doesn't grow with the set, so the rows may be broadcast. On sets too large for it, it lets everything through and the join alone decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import materialize

BITS = 23


def _bit(value: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(value), 64 - BITS)


def narrowed(df: DataFrame, value: Column, ids: DataFrame, column: str) -> DataFrame:
    """The rows of ``df`` whose ``value`` is in ``column`` of ``ids``, and few others."""
    words = ids.select(_bit(F.col(column)).alias("_b")).select(
        F.shiftright("_b", 6).alias("_word"), F.expr("shiftleft(1L, CAST(_b & 63 AS INT))").alias("_bits"))
    words = materialize(words.groupBy("_word").agg(F.bit_or("_bits").alias("_bits")), "id-filter")
    at = df.withColumn("_at", _bit(value))
    met = at.join(F.broadcast(words), F.shiftright("_at", 6) == F.col("_word"))
    return met.where(F.expr("shiftright(_bits, CAST(_at & 63 AS INT)) & 1") == 1).select(*df.columns)
