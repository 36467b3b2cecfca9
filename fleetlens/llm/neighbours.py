"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are projected on Gaussian directions (2-stable, so projections keep Euclidean distances), shifted and cut into cells of a
width; a table's bucket is the vector of its cells. A query visits its own bucket and perturbed ones in the order of
their estimated success: the order of the sums of expected squared distances to the cell borders, mapped to the query's own borders from the nearest
on. Candidates of all tables are merged, and their distances are taken exactly on the original vectors.

The index is cut into blocks of rows and the queries into groups; each (block, group) builds the block's tables, and answers with at most
``k`` rows per query, so that neither candidates nor pairs are ever rows. Whether a row becomes a candidate depends on it and the query only, so recall
doesn't depend on the number of blocks. Width and number of probes are fitted on a bounded sample for a target recall.

Defined results: vectors that are NULL, empty, zero or hold NULL or non-finite components take no part, nor do rows without an id; of rows with equal
ids the one with the smallest vector counts; vectors of another length are no candidates; equal distances go to the smaller id; fewer rows than ``k``
give all of them; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetlens.llm.common import materialize

ROWS_PER_BLOCK, QUERIES_PER_GROUP = 8192, 1024
# Bounds of the sample that the index is fitted on.
SAMPLE_ROWS, SAMPLE_QUERIES = 4096, 128


@dataclass(frozen=True)
class Index:
    tables: int = 8
    projections: int = 8
    width: float = 1.0
    probes: int = 64
    seed: int = 5

    def directions(self, dim: int, table: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(directions, shifts, weights of the cells in a bucket's code) of a table."""
        rng = np.random.default_rng([self.seed, dim, table])
        return (rng.normal(size=(dim, self.projections)), rng.uniform(0, self.width, self.projections),
                rng.integers(1, 1 << 63, self.projections, dtype=np.uint64) | np.uint64(1))


def perturbations(m: int, number: int) -> np.ndarray:
    """The first ``number`` sets of borders by expected success, as 0/1 rows over borders from the nearest (first) to the farthest.

    Border j and border 2m - 1 - j belong to the same projection and exclude each other.
    """
    j = np.arange(1, 2 * m + 1)
    k = 2 * m + 1 - j
    near = j * (j + 1) / (4 * (m + 1) * (m + 2))
    far = 1 - k / (m + 1) + k * (k + 1) / (4 * (m + 1) * (m + 2))
    cost = np.where(j <= m, near, far)
    out, heap = [()], [(cost[0], (0,))]
    while heap and len(out) < number:
        total, chosen = heapq.heappop(heap)
        if all(2 * m - 1 - c not in chosen for c in chosen):
            out.append(chosen)
        end = chosen[-1]
        if end + 1 < 2 * m:
            heapq.heappush(heap, (total - cost[end] + cost[end + 1], (*chosen[:-1], end + 1)))
            heapq.heappush(heap, (total + cost[end + 1], (*chosen, end + 1)))
    rows = np.zeros((len(out), 2 * m), np.uint64)
    for r, chosen in enumerate(out):
        rows[r, list(chosen)] = 1
    return rows


def candidates(index: Index, rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Which rows each query meets in the buckets it visits, over all tables."""
    met = np.zeros((len(queries), len(rows)), bool)
    sets = perturbations(index.projections, index.probes)
    for table in range(index.tables):
        a, shift, weight = index.directions(rows.shape[1], table)
        codes = np.floor((rows @ a + shift) / index.width).astype(np.int64).astype(np.uint64) @ weight
        known, bucket = np.unique(codes, return_inverse=True)
        at = (queries @ a + shift) / index.width
        cell = np.floor(at)
        inside = at - cell
        # Distance to the lower and the upper border of each cell, and what stepping over it adds to the code.
        borders = np.argsort(np.concatenate([inside, 1 - inside], axis=1), axis=1, kind="stable")
        step = np.concatenate([-weight.astype(np.int64), weight.astype(np.int64)]).astype(np.uint64)[borders]
        probes = (cell.astype(np.int64).astype(np.uint64) @ weight)[:, None] + step @ sets.T
        place = np.searchsorted(known, probes)
        place[place == len(known)] = 0
        query, probe = np.nonzero(known[place] == probes)
        visited = np.zeros((len(queries), len(known)), bool)
        visited[query, place[query, probe]] = True
        met |= visited[:, bucket]
    return met


def nearest(rows: np.ndarray, ids: np.ndarray, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, distances) of the k nearest rows, ties to smaller ids."""
    score = np.sqrt(((rows - query) ** 2).sum(axis=1))
    if len(score) > k:
        few = np.flatnonzero(score <= np.partition(score, k - 1)[k - 1])
        ids, score = ids[few], score[few]
    order = np.lexsort((ids, score))[:k]
    return ids[order], score[order]


def fit(sample: np.ndarray, k: int, recall: float, index: Index = Index()) -> Index:
    """Width from the distances of neighbours, and as many probes as the recall on the sample takes.

    Neighbours in the whole table are nearer than those in the sample and so met more often.
    """
    if len(sample) <= k:
        return index
    queries = sample[:SAMPLE_QUERIES]
    square = (queries ** 2).sum(1)[:, None] + (sample ** 2).sum(1)[None] - 2 * queries @ sample.T
    square[np.arange(len(queries)), np.arange(len(queries))] = np.inf
    truth = np.argsort(square, axis=1)[:, :k]
    scale = float(np.sqrt(np.maximum(np.median(np.take_along_axis(square, truth, 1)), 1e-12)))
    index = Index(index.tables, index.projections, 1.6 * scale, index.probes, index.seed)
    all_sets = 3 ** index.projections
    probes = index.probes
    while True:
        index = Index(index.tables, index.projections, index.width, min(probes, all_sets), index.seed)
        met = candidates(index, sample, queries)
        if np.take_along_axis(met, truth, 1).mean() >= recall or probes >= all_sets:
            return index
        probes *= 2


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def search(
    df: DataFrame, is_query: Column, k: int = 10, recall: float = 0.96, row_id: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """Up to ``k`` nearest rows found for each row that ``is_query`` selects: query_id, rank, vec_id, score (distance)."""
    vectors = df.where(F.col(row_id).isNotNull() & is_query.isNotNull()).select(
        F.col(row_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), is_query.alias("is_query"))
    vectors = materialize(vectors.where(usable(F.col("v"))).groupBy("id").agg(
        F.min("v").alias("v"), F.max("is_query").alias("is_query")), "vectors")
    sizes = vectors.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("is_query"), 1)).alias("queries")).first()
    blocks, groups = max(1, ceil(sizes.rows / ROWS_PER_BLOCK)), max(1, ceil(sizes.queries / QUERIES_PER_GROUP))
    drawn = vectors.orderBy(F.xxhash64(F.lit(3), "id"), "id").limit(SAMPLE_ROWS).collect()
    lengths = [len(r.v) for r in drawn]
    usual = max(set(lengths), key=lengths.count) if lengths else 0
    index = fit(np.array([r.v for r in drawn if len(r.v) == usual]), k, recall) if lengths else Index()

    place = lambda n, salt: F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = vectors.select("id", "v", F.lit(False).alias("asks"), place(blocks, 1).alias("block")).withColumn("group", every(groups))
    asking = vectors.where("is_query").select("id", "v", F.lit(True).alias("asks"), place(groups, 2).alias("group")).withColumn("block", every(blocks))

    def answer(task: pd.DataFrame) -> pd.DataFrame:
        out = []
        task = task.sort_values("id")
        for _, same in task.groupby(task["v"].str.len()):
            queries, rows = same[same["asks"]], same[~same["asks"]]
            if not len(queries) or not len(rows):
                continue
            x, q = np.stack(rows["v"].to_numpy()), np.stack(queries["v"].to_numpy())
            ids = rows["id"].to_numpy()
            met = candidates(index, x, q)
            met &= ids[None] != queries["id"].to_numpy()[:, None]
            for n, query in enumerate(queries["id"]):
                found = np.flatnonzero(met[n])
                if len(found) < k:  # too few to fill the answer: look at the whole block
                    found = np.flatnonzero(ids != query)
                at, score = nearest(x[found], ids[found], q[n], k)
                out.append(pd.DataFrame({"query_id": query, "vec_id": at, "score": score}))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    found = rows.unionByName(asking).groupBy("block", "group").applyInPandas(answer, "query_id long, vec_id long, score double")
    best = W.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
