import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import crf
from fleetlens.llm.queries import op13_crf

SF = "/root/testdata/sf0.01"
QUICK = crf.Training(texts=200, steps=40)


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = op13_crf(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [(quality[r.doc_id], r) for r in rows if r.held_out and r.doc_id in quality]
    bad, good = [r.score for q, r in held if q == 0], [r.score for q, r in held if q == 1]
    assert len(bad) > 3 and np.mean([a < b for a in bad for b in good]) > 0.98
    assert np.mean([r.predicted == q for q, r in held]) > 0.97
    assert sorted(op13_crf(spark, SF).collect()) == sorted(rows)


def every_labelling(score, labels, first):
    """Marginals and pair counts of one chain, by adding up all labellings."""
    n = len(score)
    good, pairs, total = np.zeros(n), np.zeros((2, 2)), 0.0
    for y in itertools.product((0, 1), repeat=n):
        s = sum(score[k] for k in range(n) if y[k]) + (first if y[0] else 0) + sum(labels[a, b] for a, b in itertools.pairwise(y))
        w = np.exp(s)
        total += w
        good += w * np.array(y)
        for a, b in itertools.pairwise(y):
            pairs[a, b] += w
    return good / total, pairs / total


def test_marginals_like_all_labellings():
    rng = np.random.default_rng(1)
    sizes = np.array([3, 1, 7, 4, 7])
    score, labels = rng.normal(0, 2, sizes.sum()), rng.normal(0, 1, (2, 2))
    good, pairs = crf._Chains(sizes).marginals(score, labels, 0.7)
    for k, part in enumerate(np.split(score, np.cumsum(sizes)[:-1])):
        want, want_pairs = every_labelling(part, labels, 0.7)
        assert np.allclose(np.split(good, np.cumsum(sizes)[:-1])[k], want) and np.allclose(pairs[k], want_pairs)


def test_large_scores_stay_finite():
    good, _ = crf._Chains(np.array([4, 2])).marginals(np.array([900.0, -900, 900, 3, -800, 800]), np.array([[2.0, -3], [-3, 2]]), 1.0)
    assert np.isfinite(good).all() and good[0] > 0.9 and good[1] < 0.1


def test_neighbours_count():
    """A line that looks like neither is judged by the lines around it."""
    rng = np.random.default_rng(0)

    def text(kind):
        line = {1: lambda: " ".join(["word", "another", "thing", "river"][k] for k in rng.integers(0, 4, 8)) + ".",
                0: lambda: " ".join(["#$#$", "%%%", "@@!!", "&&&&"][k] for k in rng.integers(0, 4, 8))}[kind]
        return "\n".join(line() if k % 3 else "so" for k in range(9)).encode()

    samples = [(k % 2, *crf.features(text(k % 2))) for k in range(60)]
    model = crf.fit(samples, (0.5, 0.5), QUICK)
    p = [crf.line_marginals(model, [crf.features(text(k))[0]])[0] for k in (0, 1)]
    assert p[0][3] < 0.3 and p[1][3] > 0.7
    mixed = crf.features(text(1) + b"\n" + b"\n".join([b"#$#$ %%% @@!! &&&&"] * 9))
    assert 0.2 < crf.quality(model, [mixed[0]], [mixed[1]])[0] < 0.8


def test_features_of_parts_and_long_lines(monkeypatch):
    text = "\n".join(f"line {k % 5} of some text, with words" for k in range(40)).encode()
    x, size = crf.features(text)
    assert x.shape == (40, crf.WIDTH) and (size == len(b"line 0 of some text, with words")).all()
    assert (x[:, -2] == [k >= 5 for k in range(40)]).all() and (x[:, -1] == [k < 35 for k in range(40)]).all()
    monkeypatch.setattr(crf, "BYTES_AT_ONCE", 50)
    assert np.allclose(crf.features(text)[0], x)
    monkeypatch.setattr(crf, "LONGEST_LINE", 64)
    long = b"word " * 100 + b"x" * 300
    assert b"".join(crf.lines(long)) == long and max(map(len, crf.lines(long))) < 300 + 64 and len(crf.features(long)[0]) > 3
    assert crf.features(b"")[0].shape == crf.features(b" \n ")[0].shape == (1, crf.WIDTH)


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, note string")


def test_awkward(spark, awkward, empty):
    labels = labels_of(spark, [(1, 1, "a"), (2, 1, "a"), (5, 1, "a"), (10, 0, "a"), (7, 0, "a"), (6, 0, "a"), (6, 1, "b"), (None, 0, "c"), (9, None, "d"), (4, 0, "e"), (99, 0, "")])
    model = crf.train(awkward, labels, QUICK)
    rows = crf.score(awkward, model).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows) and set(awkward.columns) <= set(rows[0].asDict())
    wordless = {r.score for r in rows if not (r.text or "").strip()}
    assert len(wordless) == 1
    assert crf.score(empty, model).count() == 0 and crf.train(empty, labels, QUICK) == pytest.approx(3 / 7)
    assert crf.train(awkward, labels.where("quality = 1"), QUICK) == 1.0 and crf.train(awkward, labels.limit(0), QUICK) == 1.0
    assert {r.score for r in crf.score(awkward, 0.25).collect()} == {0.25}


def test_only_the_given_rows_teach(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    a = crf.train(docs, labels.where(~held), QUICK)
    b = crf.train(docs.withColumn("text", F.when(held, "###").otherwise(F.col("text"))), labels.where(~held), QUICK)
    assert (a.weight == b.weight).all() and a.bias == b.bias and a.slope == b.slope


def test_sample_is_bounded_and_even(spark):
    labels = spark.range(1000).select(F.col("id").alias("doc_id"), (F.col("id") % 50 != 0).cast("int").alias("quality"))
    chosen, n = crf.sample(labels, crf.Training(texts=100), "doc_id", "quality")
    assert {r["__llm_label"]: r["count"] for r in chosen.groupBy("__llm_label").count().collect()} == {0: 20, 1: 50} and n == {0: 20, 1: 980}
