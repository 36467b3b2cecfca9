"""Arrays to rows.

For a plain explode Catalyst adds the filter "array is not empty" below it, which works out the array a second
time. That is costly where the array is parsed from JSON or built by an expression, so such arrays are exploded
with their empty case, which is dropped afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest(df: DataFrame, array: Column, keep: list[str | Column], item: str, pos: str | None = None) -> DataFrame:
    """``keep`` and one row per item of ``array``, with its position if asked for."""
    position = pos or "_pos"
    rows = df.select(*keep, F.posexplode_outer(array).alias(position, item)).filter(F.col(position).isNotNull())
    return rows if pos else rows.drop(position)
