"""Left joins whose missing keys are many."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KEY = "_lookup"
_SPREAD = 4096


def left_lookup(left: DataFrame, right: DataFrame, key: str, spread: Sequence[str] | None = None) -> DataFrame:
    """``left`` with the columns of ``right`` for the same ``key``, NULL where there is none.

    A join sends all rows with a NULL key to one task. Here such a row gets a stand-in key, made from its
    other values, that matches nothing, so rows without key are spread like any others. ``spread`` names the columns that
    it is made from: those alone need to travel for it, else all do.
    """
    values = list(spread) if spread else [f.name for f in left.schema if isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.VariantType)]
    stand_in = F.concat(F.lit("\0"), F.pmod(F.xxhash64(*values), F.lit(_SPREAD)).cast("string"))
    text = F.col(key).cast("string")
    keyed = right.filter(F.col(key).isNotNull()).withColumn(_KEY, text).drop(key)
    return left.withColumn(_KEY, F.coalesce(text, stand_in)).join(keyed, _KEY, "left").drop(_KEY)
