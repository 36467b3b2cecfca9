"""Ordered numbering and look-back over keys that may hold a large share of all rows.

A plain window sorts every row of a key in one task. Here each key is cut into blocks of its order
column; rows are ordered within (key, block), and only one summary row per block is ordered per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_BLOCK = "_block"


def day_block(ts: Column) -> Column:
    return F.date_trunc("day", ts)


def number_block(position: Column, size: int) -> Column:
    """Blocks of ``size`` whole numbers, each named by its first one."""
    return position - position % F.lit(size)


def running_number(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, out: str, total: str | None = None
) -> DataFrame:
    """Number the rows of each key from 1 in ``order``; ``block`` must not decrease along ``order``.

    ``total`` names a column for the number of rows of the key.
    """
    df = df.withColumn(_BLOCK, block)
    sizes = df.groupBy(*keys, _BLOCK).agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(W.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    totals = [F.sum("_n").over(W.partitionBy(*keys)).alias(total)] if total else []
    offsets = sizes.select(*keys, _BLOCK, offset, *totals)
    within = W.partitionBy(*keys, _BLOCK).orderBy(*order)
    return (
        df.withColumn("_local", F.row_number().over(within))
        .join(offsets, [*keys, _BLOCK])
        .withColumn(out, F.col("_offset") + F.col("_local"))
        .drop(_BLOCK, "_local", "_offset")
    )


def previous_value(
    df: DataFrame, keys: Sequence[str], order: str, value: str, block: Column, out: str
) -> DataFrame:
    """The ``value`` of the preceding row of the key, NULL on its first row; ``order`` is unique per key."""
    df = df.withColumn(_BLOCK, block)
    last = df.groupBy(*keys, _BLOCK).agg(F.max_by(value, order).alias("_last"))
    carried = last.select(
        *keys, _BLOCK, F.lag("_last").over(W.partitionBy(*keys).orderBy(_BLOCK)).alias("_carried")
    )
    within = W.partitionBy(*keys, _BLOCK).orderBy(order)
    return (
        df.withColumn("_rn", F.row_number().over(within))
        .withColumn("_prev", F.lag(value).over(within))
        .join(carried, [*keys, _BLOCK])
        .withColumn(out, F.when(F.col("_rn") == 1, F.col("_carried")).otherwise(F.col("_prev")))
        .drop(_BLOCK, "_rn", "_prev", "_carried")
    )
