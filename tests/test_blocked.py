"""Blocked numbering and look-back against plain windows."""

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetlens.functions.blocked import number_block, previous_value, running_number
from fleetlens.functions.lookup import left_lookup


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_matches_a_plain_window(spark, size):
    rng = random.Random(size)
    # One key holds most of the rows.
    rows = {(rng.choice("aaaab"), rng.randrange(200)) for _ in range(300)}
    df = spark.createDataFrame([(k, p, f"v{p}") for k, p in rows], "k string, p int, v string")
    w = W.partitionBy("k").orderBy("p")
    want = df.select("k", "p", F.row_number().over(w).alias("n"), F.lag("v").over(w).alias("last"))
    block = number_block(F.col("p"), size)
    numbered = running_number(df, ["k"], ["p"], block, "n").select("k", "p", "n")
    looked = previous_value(df, ["k"], "p", "v", block, "last").select("k", "p", "last")
    assert sorted(numbered.collect()) == sorted(want.select("k", "p", "n").collect())
    key = lambda r: (r.k, r.p)
    assert sorted(looked.collect(), key=key) == sorted(want.select("k", "p", "last").collect(), key=key)


def test_lookups_spread_rows_without_key(spark):
    left = spark.range(1000).select("id", F.when(F.col("id") % 2 == 0, F.col("id") % 4).alias("k"))
    right = spark.createDataFrame([(0, "zero"), (None, "none")], "k bigint, name string")
    got = left_lookup(left, right, "k")
    assert got.columns == ["id", "k", "name"]
    assert {(r.k, r.name, r["count"]) for r in got.groupBy("k", "name").count().collect()} == {
        (0, "zero", 250), (2, None, 250), (None, None, 500)
    }
