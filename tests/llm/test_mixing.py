import re
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from fleetlens.llm import mixing
from fleetlens.llm.common import n_words
from fleetlens.llm.queries import op2_mixing

SF = "/root/testdata/sf0.001"


def targets_by_rounds(sizes, weights, share, most):
    """Reshare the excess until no source is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, out, free = Fraction(share) * sum(sizes.values()), {}, set(order)
    while free:
        level = (total - sum(out.values())) / sum(w[s] for s in free)
        above = {s for s in free if w[s] * level > most * sizes[s]}
        if not above:
            out.update({s: w[s] * level for s in free})
            break
        out.update({s: Fraction(most * sizes[s]) for s in above})
        free -= above
    return out


def check(rows, share=1.5, weights=(5, 2, 1), most=2):
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= most * r.size
    want = targets_by_rounds(sizes, weights, share, most)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(float(want[r.source]), rel=1e-12)
    return sizes, taken, want


def test_query(spark, documents):
    rows = op2_mixing(spark, SF).collect()
    _, taken, want = check(rows)
    for s in want:
        assert taken[s] == int(want[s] + Fraction(1, 10**9))
    words = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in documents.collect()}
    assert {r.doc_id: r.size for r in rows} == words
    again = op2_mixing(spark, SF).collect()
    assert sorted(again) == sorted(rows)


def test_prefix_by_key(spark):
    """Within an epoch that is cut, rows are taken in the order of their keys."""
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").alias("source"),
                                  (F.col("id") % 7).alias("words"))
    old, mixing.ROWS_PER_RANGE = mixing.ROWS_PER_RANGE, 10
    rows = mixing.mix(df, F.col("words"), seed=4).withColumn("key", mixing.key_of(F.col("doc_id"), 4)).collect()
    mixing.ROWS_PER_RANGE = old
    _, taken, want = check(rows)
    for s in want:
        epoch = [r for r in sorted(rows, key=lambda r: (r.key, r.doc_id)) if r.source == s and r.size]
        rest = [r.taken % r.size if r.taken < 2 * r.size else r.size for r in epoch]
        assert taken[s] == int(want[s]) and sum(0 < x < r.size for x, r in zip(rest, epoch, strict=True)) <= 1


def test_awkward(spark, awkward, empty):
    mixed = mixing.mix(awkward, n_words(F.col("text")))
    rows = mixed.collect()
    check(rows)
    assert len(rows) == awkward.count() and set(awkward.columns) <= set(mixed.columns)
    assert sorted(rows, key=repr) == sorted(mixing.mix(awkward, n_words(F.col("text"))).collect(), key=repr)
    assert mixing.mix(empty, n_words(F.col("text"))).count() == 0
    assert mixing.mix(awkward.where("text IS NULL"), n_words(F.col("text"))).where("taken <> 0").count() == 0


def test_repeated_rows_of_the_mix(spark):
    df = spark.createDataFrame([(1, "  a b  c d", 4, 7), (2, "x y", 2, 0), (3, "p q r", 3, 3)], "doc_id long, text string, size long, taken long")
    got = sorted((r.doc_id, r.text) for r in mixing.repeated(df).collect())
    assert got == [(1, "  a b  c"), (1, "  a b  c d"), (3, "p q r")]
