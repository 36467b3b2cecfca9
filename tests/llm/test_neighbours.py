import math

import numpy as np
from pyspark.sql import functions as F

from fleetlens.llm import neighbours
from fleetlens.llm.queries import op3_neighbours

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int, score string, id string"


def brute(rows, queries, k=10):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], float)
    out = {}
    for q in queries:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        d[ids == q] = math.inf
        order = np.lexsort((ids, d))[: min(k, len(ids) - 1)]
        out[q] = [(int(ids[i]), float(d[i])) for i in order]
    return out


def test_query_recall_and_scores(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = brute(rows, [i for i, _ in rows if i % 100 == 0])
    got = op3_neighbours(spark, SF).collect()
    at = dict(rows)
    hit = 0
    for q, best in want.items():
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in mine] == sorted((r.score, r.vec_id) for r in mine)
        for r in mine:
            assert math.isclose(r.score, math.dist(at[q], at[r.vec_id]), rel_tol=1e-12) and r.vec_id != q
        hit += len({r.vec_id for r in mine} & {i for i, _ in best})
    assert hit >= 0.9 * 10 * len(want)


def test_blocks_give_the_same_candidates(spark):
    """Whether a row is met doesn't depend on the other rows, so blocks change nothing but the fallback for short answers."""
    rng = np.random.default_rng(1)
    x, q = rng.normal(size=(400, 16)), rng.normal(size=(20, 16))
    index = neighbours.Index(width=4.0)
    whole = neighbours.candidates(index, x, q)
    parts = [neighbours.candidates(index, x[k:k + 100], q) for k in range(0, 400, 100)]
    assert (whole == np.hstack(parts)).all() and 0 < whole.mean() < 1


def test_probes_by_expected_success():
    sets = neighbours.perturbations(4, 30)
    assert len(sets) == 30 and not sets[0].any() and sets[1].tolist() == [1] + [0] * 7
    assert len({tuple(s) for s in sets.tolist()}) == 30
    assert all(s[j] + s[7 - j] < 2 for s in sets for j in range(4))


def test_awkward(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [None, 1.0]), (8, [inf, 1.0]),
            (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (100, [0.5, 0.5]), (100, [0.5, 0.5]), (200, [0.0, 0.0]), (300, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(*r, 0, "s", "i") for r in rows], SCHEMA)
    got = {}
    for r in neighbours.search(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {0: [1, 100, 2], 100: [0, 1, 2], 300: [9]}
    assert neighbours.search(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_ties_and_a_hot_vector(spark):
    df = spark.range(500).select(F.col("id").alias("vec_id"), F.when(F.col("id") % 3 == 0, F.array(F.lit(1.0), F.lit(2.0))).otherwise(
        F.array((F.col("id") + 3).cast("double"), F.lit(1.0))).cast("array<float>").alias("embedding"))
    got = neighbours.search(df, F.col("vec_id") % 100 == 0).where("query_id = 300").orderBy("rank").collect()
    assert [r.vec_id for r in got] == list(range(0, 30, 3)) and {r.score for r in got} == {0.0}
