"""Jaccard join of texts on word shingles by chosen paths.

A text is its set of five-word shingles. In each run a set follows the shingles whose hash, seeded by the path so far, is below
1 / (threshold * size): similar sets share such a path with a probability bounded below, dissimilar sets rarely do. Sets that share a
path form a bucket; a bucket of few sets is compared by brute force, a larger one is split by the next step of its paths. Runs repeat
until the target recall. Buckets that are large after the last step are compared in blocks, so none is skipped.

Comparisons inside buckets use sizes, bit maps of small sets (which rule no similar pair out) and 256-bit sketches of large ones, and only have
to find groups of candidates: a set that is reached need not be reached again, so a bucket of near copies costs little more than one
comparison each. The candidates' sets are then sent once to their group, where every pair is decided exactly. Copies (equal sets) are one
set throughout.

Defined results: texts without a word (NULL, empty) are in a class of their own and have no links; texts of one to four words are
one shingle; equal rows and equal ids are rows of one class; classes are named by their smallest id; NULL ids stay NULL rows; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetlens.llm.common import WORD, gathered, materialize
from fleetlens.llm.components import connected
from fleetlens.llm.idfilter import narrowed
from fleetlens.llm.shingles import U64, mix, set_key, shingles

THRESHOLD = 0.8
DEPTH = 3
RECALL = 0.995
# Buckets up to this many sets are compared in one task; the last step's buckets in blocks of so many.
SMALL = BLOCK = 8192
# Sets that are compared with all others of their bucket at once.
TILE = 256
# Candidate groups are decided in blocks of so many sets.
GROUP_BLOCK = 1024
# Sets from this size on have a sketch of 256 minima; sets up to a quarter more have a map of 256 bits. So any two sets of sizes that
# may be similar have one of them in common.
SKETCHED = 300
SKETCH_BITS = 256
# Sketches of similar sets differ in fewer bits (none of 3000 random pairs at the threshold did in more).
MOST_DIFFERENT = 48
TOKENS_AT_ONCE = 1 << 16


def runs_for(recall: float = RECALL, depth: int = DEPTH, threshold: float = THRESHOLD) -> int:
    """Runs after which a pair at the threshold is found with probability ``recall``, even in the deepest bucket.

    The common paths of a pair are a branching process whose number of children is about Poisson.
    """
    children = 2 / (1 + threshold)  # common shingles times the chance to be chosen, for equal sizes
    found = 1.0
    for _ in range(depth):
        found = 1 - math.exp(-children * found)
    return math.ceil(math.log(1 - recall) / math.log(1 - found))


def _minima(values: np.ndarray) -> np.ndarray:
    """One bit of the smallest shingle in each of 256 ranges of the hash; an empty range looks to the next one."""
    place = (values >> U64(64 - 8)).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    bits, filled = np.zeros(SKETCH_BITS, np.uint8), np.zeros(SKETCH_BITS, bool)
    bits[place[first]] = (values[first] >> U64(20)).astype(np.uint8) & 1
    filled[place[first]] = True
    if not filled.all():
        at = np.flatnonzero(filled)
        nxt = np.searchsorted(at, np.arange(SKETCH_BITS)) % len(at)
        away = (at[nxt] - np.arange(SKETCH_BITS)) % SKETCH_BITS
        bits = bits[at[nxt]] ^ (away & 1).astype(np.uint8)
    return np.packbits(bits)


def sketch(values: np.ndarray) -> bytes:
    """What rules pairs out: a map of the set's shingles onto 256 bits if it is small, then a sketch of minima if it isn't."""
    out = np.zeros(2 * SKETCH_BITS // 8, np.uint8)
    if THRESHOLD * len(values) < SKETCHED:
        bits = np.zeros(SKETCH_BITS, np.uint8)
        bits[((values >> U64(8)) & U64(SKETCH_BITS - 1)).astype(np.int64)] = 1
        out[: SKETCH_BITS // 8] = np.packbits(bits)
    if len(values) >= SKETCHED:
        out[SKETCH_BITS // 8:] = _minima(values)
    return out.tobytes()


def _chosen(values: np.ndarray, seeds: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(seed number, path) of every shingle that a seed chooses, by seed.

    Shingles are hashes already; two multiplications part the seeds.
    """
    at, paths = [], []
    for k in range(0, len(values), TOKENS_AT_ONCE):
        h = values[None, k:k + TOKENS_AT_ONCE] ^ seeds[:, None]
        h *= U64(0xBF58476D1CE4E5B9)
        h ^= h >> U64(32)
        h *= U64(0x94D049BB133111EB)
        found = np.flatnonzero(h.ravel() <= U64(limit))
        seed = found // h.shape[1]
        at.append(seed)
        paths.append(mix(h.ravel()[found] + seeds[seed]))
    if len(at) == 1:
        return at[0], paths[0]
    seed, path = np.concatenate(at), np.concatenate(paths)
    order = np.argsort(seed, kind="stable")
    return seed[order], path[order]


def paths_of(values: np.ndarray, runs: int, threshold: float = THRESHOLD) -> list[tuple[int, bytes]]:
    """The set's first steps, each with the two steps that follow, as rows (second, third); 0: the path ends."""
    limit = min((1 << 64) - 1, int((1 << 64) / (threshold * len(values))))
    seeds = mix(np.arange(1, runs + 1, dtype=U64) << U64(32))
    _, first = _chosen(values, seeds, limit)
    if not len(first):
        return []
    parent, second = _chosen(values, first, limit)
    if not len(second):
        return [(step, b"") for step in first.astype(np.int64).tolist()]
    above, third = _chosen(values, second, limit)
    children = np.bincount(above, minlength=len(second))
    rows = np.zeros((np.maximum(children, 1).sum(), 2), U64)
    rows[:, 0] = np.repeat(second, np.maximum(children, 1))
    rows[np.repeat(children > 0, np.maximum(children, 1)), 1] = third
    ends = np.searchsorted(np.repeat(parent, np.maximum(children, 1)), np.arange(len(first) + 1)) * rows.itemsize * 2
    packed = rows.tobytes()
    return [(step, packed[a:b]) for step, a, b in zip(first.astype(np.int64).tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


FEATURES = "set binary, n long, sketch binary, paths array<struct<node: long, deeper: binary>>"


def features(df: DataFrame, runs: int, text: str = "text") -> DataFrame:
    """Add the set's name, size, sketch and paths to every row; NULL for texts without a word."""

    @F.pandas_udf(FEATURES)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in texts:
                s = shingles(None if t is None else bytes(t))
                rows.append((set_key(s), len(s), sketch(s), [{"node": a, "deeper": b} for a, b in paths_of(s, runs)]) if len(s) else (None, 0, None, None))
            yield pd.DataFrame(rows, columns=["set", "n", "sketch", "paths"])

    return df.withColumn("_f", run(F.col(text).cast("binary"))).drop(text).select("*", "_f.*").drop("_f")


def _candidates(n: np.ndarray, sketches: np.ndarray, other_n: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Which pairs may be similar, by size and sketch.

    Bits that only one of two maps has set stand for as many shingles that the other set lacks, so maps rule no similar pair out.
    """
    small, large = np.minimum(n[:, None], other_n[None]), np.maximum(n[:, None], other_n[None])
    words = SKETCH_BITS // 64
    out = small >= THRESHOLD * large
    mapped = small < SKETCHED
    if (out & mapped).any():
        ours, theirs = np.zeros(out.shape, np.int16), np.zeros(out.shape, np.int16)
        for k in range(words):
            a, b = sketches[:, None, k], other[None, :, k]
            ours += np.bitwise_count(a & ~b)
            theirs += np.bitwise_count(b & ~a)
        common = np.minimum(n[:, None] - ours, other_n[None] - theirs)
        out &= ~mapped | (common * (1 + THRESHOLD) >= THRESHOLD * (n[:, None] + other_n[None]) - 1e-6)
    if (out & ~mapped).any():
        differ = np.zeros(out.shape, np.uint16)
        for k in range(words, 2 * words):
            differ += np.bitwise_count(sketches[:, None, k] ^ other[None, :, k])
        out &= mapped | (differ <= MOST_DIFFERENT)
    return out


def _grouped(n: np.ndarray, sketches: np.ndarray) -> np.ndarray:
    """For each set the place of a set that it is connected with through candidates, the same for all of a group.

    Every set meets those not yet reached, so near copies of one another are soon done with. Memory is that of TILE times all sets.
    """
    if len(n) <= TILE:
        return _roots(_candidates(n, sketches, n, sketches))
    roots, left = np.arange(len(n)), np.arange(len(n))
    while len(left):
        seed, left = left[0], left[1:]
        reached = np.array([seed])
        while len(reached) and len(left):
            now, reached = reached[:TILE], reached[TILE:]
            hit = _candidates(n[now], sketches[now], n[left], sketches[left]).any(0)
            roots[left[hit]] = seed
            reached, left = np.concatenate([reached, left[hit]]), left[~hit]
    return roots


def _roots(pairs: np.ndarray) -> np.ndarray:
    """The smallest place connected to each place of a square, symmetric relation."""
    roots = np.arange(len(pairs))
    while True:
        new = np.minimum(roots, np.where(pairs, roots[None], len(pairs)).min(1))
        new = np.minimum(new, new[new])
        if (new == roots).all():
            return roots
        roots = new


def _sketches(values) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, values)), U64).reshape(-1, 2 * SKETCH_BITS // 64)


def _bucket_links(names: list[bytes], n: np.ndarray, sketches: np.ndarray) -> Iterator[tuple[bytes, bytes]]:
    roots = _grouped(n, sketches)
    for k in np.flatnonzero(roots != np.arange(len(roots))):
        yield names[k], names[roots[k]]


STEP = "node long, set binary, n long, sketch binary, deeper binary, other binary"


def _split_or_compare(last: bool):
    """One pass over rows sorted by node: links of small buckets, and the rows of larger ones one step on.

    Memory holds one bucket up to the size that is compared at once. A larger bucket's rows go on as they come.
    """
    most = BLOCK if last else SMALL

    def on(row) -> Iterator[tuple]:
        steps = np.frombuffer(row.deeper, U64).reshape(-1, 2)
        for second in np.unique(steps[:, 0]):
            thirds = steps[steps[:, 0] == second, 1]
            deeper = np.array([(t, 0) for t in thirds if t], U64).tobytes()
            yield int(second.astype(np.int64)), row.set, row.n, row.sketch, deeper, None

    def compare(held) -> Iterator[tuple]:
        if len(held) > 1:
            for a, b in _bucket_links([bytes(r.set) for r in held], np.array([r.n for r in held]), _sketches([r.sketch for r in held])):
                yield None, a, 0, None, None, b

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, held, large, out = None, [], False, []
        for rows in gathered(batches):
            # Rows alone in their bucket within the batch need no look, but for the batch's ends.
            nodes = rows["node"].to_numpy()
            same = nodes[1:] == nodes[:-1]
            useful = np.ones(len(nodes), bool)
            useful[1:-1] = same[:-1] | same[1:]
            for row in rows[useful].itertuples(index=False):
                if row.node != node:
                    if not large:
                        out += compare(held)
                    node, held, large = row.node, [], False
                if large:
                    out += on(row) if not last else [(row.node, row.set, row.n, row.sketch, b"", None)]
                    continue
                held.append(row)
                if len(held) > most:
                    large = True
                    for r in held:
                        out += on(r) if not last else [(r.node, r.set, r.n, r.sketch, b"", None)]
                    held = []
            yield pd.DataFrame(out, columns=["node", "set", "n", "sketch", "deeper", "other"])
            out = []
        if not large:
            out += compare(held)
        yield pd.DataFrame(out, columns=["node", "set", "n", "sketch", "deeper", "other"])

    return run


def _in_blocks(rows: DataFrame, key: str, block: int, name: str) -> DataFrame:
    """Send every row to each pair of blocks of its group that holds its own block.

    Adds ``block``, the row's own, and ``block_i``, ``block_j``, the pair; a group of one block stays as it is.
    """
    sizes = rows.groupBy(F.col(key).alias("_key")).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_blocks"))
    at = rows.join(sizes, rows[key] == sizes._key).drop("_key")
    at = at.withColumn("block", F.pmod(F.xxhash64(name), F.col("_blocks")).cast("int"))
    at = at.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return at.withColumns({"block_i": F.least("block", "_o"), "block_j": F.greatest("block", "_o")}).drop("_o").withColumnRenamed("_blocks", "blocks")


def candidate_links(sets: DataFrame) -> DataFrame:
    """Links (a, b) between names of sets that may be similar; enough of them to connect each group."""
    step = sets.select(F.explode("paths").alias("p"), "set", "n", "sketch").select(
        F.col("p.node").alias("node"), "set", "n", "sketch", F.col("p.deeper").alias("deeper"))
    links = []
    for depth in range(DEPTH):
        done = materialize(
            step.repartition("node").sortWithinPartitions("node").mapInPandas(_split_or_compare(depth == DEPTH - 1), STEP),
            f"paths-{depth}")
        links.append(done.where("other IS NOT NULL").select(F.col("set").alias("a"), F.col("other").alias("b")))
        step = done.where("other IS NULL").drop("other")
        if not step.limit(1).count():
            break
    else:
        rest = _in_blocks(step, "node", BLOCK, "set").select("node", "set", "n", "sketch", "block", "block_i", "block_j")

        def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            roots = _grouped(rows["n"].to_numpy(), _sketches(rows["sketch"]))
            names = rows["set"].to_numpy()
            at = np.flatnonzero(roots != np.arange(len(roots)))
            return pd.DataFrame({"a": names[at], "b": names[roots[at]]})

        links.append(materialize(rest.groupBy("node", "block_i", "block_j").applyInPandas(run, "a binary, b binary"), "paths-blocks"))
    found = links[0]
    for more in links[1:]:
        found = found.unionByName(more)
    return found.distinct()


def _similar(values: list[np.ndarray], other: list[np.ndarray], threshold: float = THRESHOLD) -> np.ndarray:
    """Which pairs have a Jaccard similarity of the threshold or more, exactly."""
    sizes, other_sizes = np.array([len(v) for v in values]), np.array([len(v) for v in other])
    tokens = np.unique(np.concatenate([*other]), return_inverse=True)
    known = tokens[0]
    common = np.zeros((len(values), len(other)), np.float32)
    ends = np.cumsum([0, *other_sizes])
    right = np.split(tokens[1], ends[1:-1])
    left = []
    for v in values:
        at = np.searchsorted(known, v)
        at[at == len(known)] = 0
        left.append(at[known[at] == v])
    width = max(1, min(len(known), (1 << 23) // max(1, len(values) + len(other))))
    for k in range(0, len(known), width):
        x, y = np.zeros((len(values), width), np.float32), np.zeros((len(other), width), np.float32)
        for m, parts in ((x, left), (y, right)):
            for row, ids in enumerate(parts):
                inside = ids[(ids >= k) & (ids < k + width)] if width < len(known) else ids
                m[row, inside - k] = 1
        common += x @ y.T
    # common / (a + b - common) >= threshold, in whole numbers
    num, den = round(threshold * 1000), 1000
    common = common.astype(np.int64)
    return common * (num + den) >= num * (sizes[:, None] + other_sizes[None])


def _decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by (component, block_i, block_j): link counts of each set and links that connect them."""
    def decide(rows: list) -> list[tuple]:
        i, j = rows[0].block_i, rows[0].block_j
        a = [r for r in rows if r.block == i]
        b = a if i == j else [r for r in rows if r.block == j]
        if not a or not b:
            return []
        pairs = _similar([np.frombuffer(r.values, U64) for r in a], [np.frombuffer(r.values, U64) for r in b])
        if i == j:
            np.fill_diagonal(pairs, False)
            square, both = pairs, a
        else:
            square = np.zeros((len(a) + len(b),) * 2, bool)
            square[:len(a), len(a):] = pairs
            square |= square.T
            both = a + b
        links = square @ np.array([r.copies for r in both])
        roots = _roots(square | np.eye(len(both), dtype=bool))
        return [(bytes(r.set), int(n), bytes(both[root].set), r.blocks > 1) for r, n, root in zip(both, links, roots, strict=True)]

    key, held = None, []
    for frame in batches:
        out = []
        for row in frame.itertuples(index=False):
            if (row.component, row.block_i, row.block_j) != key:
                out += decide(held) if held else []
                key, held = (row.component, row.block_i, row.block_j), []
            held.append(row)
        yield pd.DataFrame(out, columns=["set", "links", "root", "split"])
    yield pd.DataFrame(decide(held) if held else [], columns=["set", "links", "root", "split"])


def _values(df: DataFrame, text: str) -> DataFrame:
    @F.pandas_udf("set binary, values binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            sets = [shingles(None if t is None else bytes(t)) for t in texts]
            yield pd.DataFrame({"set": [set_key(s) if len(s) else None for s in sets], "values": [s.tobytes() for s in sets]})

    return df.select(run(F.col(text).cast("binary")).alias("_v")).select("_v.*")


def classes(df: DataFrame, row_id: str = "doc_id", text: str = "text", recall: float = RECALL) -> DataFrame:
    """A row per row of ``df``: its id, ``text_hash``, ``class_id``, ``n_links`` (rows similar to it) and ``class``.

    ``class`` names the class even where its rows share ids with others; NULL for texts without a word.

    Links to copies count: a row links to every other row whose set has a similarity of the threshold or more.
    """
    named = df.select(F.col(row_id).alias(row_id), F.xxhash64(text).alias("text_hash"), F.col(text).alias("_text"))
    table = materialize(features(named, runs_for(recall), "_text"), "jaccard-features")
    sets = table.where("set IS NOT NULL").groupBy("set").agg(
        F.count(F.lit(1)).alias("copies"), F.min(row_id).alias("least"), F.first("n").alias("n"), F.first("sketch").alias("sketch"),
        F.first("paths").alias("paths"))
    sets = materialize(sets, "jaccard-sets")

    groups = materialize(connected(candidate_links(sets)).join(
        sets.select(F.col("set").alias("node"), "copies", "least"), "node"), "jaccard-groups")
    texts = df.select(F.col(row_id).alias("_id"), F.col(text).alias("_text"))
    # Rows without an id can't be looked up by it; their sets are matched by name like all others.
    without = texts.where("_id IS NULL")
    texts = narrowed(texts.where("_id IS NOT NULL"), F.col("_id"), groups, "least")
    texts = texts.join(groups.select(F.col("least").alias("_id")).distinct(), "_id", "left_semi").unionByName(without)
    members = _values(texts, "_text").groupBy("set").agg(F.first("values").alias("values"))
    keys = ["component", "block_i", "block_j"]
    places = _in_blocks(groups.drop("least").withColumnRenamed("node", "set"), "component", GROUP_BLOCK, "set")
    members = places.join(members, "set")
    decided = materialize(members.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(
        _decide, "set binary, links long, root binary, split boolean"), "jaccard-decided")

    links = decided.groupBy("set").agg(F.sum("links").alias("links"), F.min("root").alias("root"))
    # A group decided in one task is final. The parts of a group decided in blocks are put together by their links.
    split = decided.where("split").select(F.col("set").alias("a"), F.col("root").alias("b"))
    name = F.coalesce("root", "set")
    if split.limit(1).count():
        links = links.join(connected(split).withColumnRenamed("node", "set"), "set", "left")
        name = F.coalesce("component", "root", "set")
    per_set = sets.select("set", "copies", "least").join(links, "set", "left").withColumn("class", name)
    per_class = per_set.groupBy("class").agg(F.min("least").alias("class_id"))
    per_set = per_set.join(per_class, "class").select(
        "set", "class", "class_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return table.select(row_id, "text_hash", "set").join(per_set, "set", "left").select(
        row_id, "text_hash", F.when(F.col("set").isNull(), F.col(row_id)).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "class")


def representatives(df: DataFrame, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class, that of the smallest id; all columns of ``df``. Rows without a word all stay."""
    chosen = classes(df, row_id, text).where("class IS NOT NULL").groupBy("class").agg(
        F.min(F.struct(F.col(row_id).alias("id"), F.col("text_hash").alias("hash"))).alias("_k")).select("_k")
    # The row travels whole beside its key, so its columns may have any names.
    rows = df.select(
        F.struct(*df.columns).alias("row"), F.struct(F.col(row_id).alias("id"), F.xxhash64(text).alias("hash")).alias("_k"),
        F.coalesce(F.col(text).rlike(WORD), F.lit(False)).alias("worded"))
    # Equal rows share a key; one of them stays.
    kept = rows.where("worded").join(chosen, "_k").withColumn(
        "_n", F.row_number().over(W.partitionBy("_k").orderBy("_k"))).where("_n = 1")
    return kept.select("row.*").unionByName(rows.where("NOT worded").select("row.*"))
