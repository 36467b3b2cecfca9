import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from fleetlens.llm import jaccard
from fleetlens.llm.components import connected
from fleetlens.llm.queries import op8_jaccard
from fleetlens.llm.shingles import shingles, word_hashes

SF = "/root/testdata/sf0.001"


def plain_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def brute(rows):
    """(class name, number of links) per row number."""
    sets = [plain_set(t) for _, t in rows]
    where = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            where[x].append(k)
    root, links = list(range(len(rows))), Counter()

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for k, s in enumerate(sets):
        for other, n in Counter(o for x in s for o in where[x] if o > k).items():
            if 5 * n >= 4 * (len(s) + len(sets[other]) - n):
                links[k] += 1
                links[other] += 1
                a, b = sorted((find(k), find(other)))
                root[b] = a
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [(least.get(find(k)) if sets[k] else rows[k][0], links[k]) for k in range(len(rows))]


def check(df, got):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    want = sorted(((i, *x) for (i, _), x in zip(rows, brute(rows), strict=True)), key=repr)
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got.collect()), key=repr) == want
    return want


def test_query(spark, documents):
    assert any(n for *_, n in check(documents, op8_jaccard(spark, SF)))


def variants(n, words=120):
    """Texts that differ in one or two words each."""
    rng = np.random.default_rng(2)
    base = [f"w{k}" for k in range(words)]
    out = []
    for k in range(n):
        text = list(base)
        for at in rng.integers(0, words, 1 + k % 3):
            text[at] = f"x{rng.integers(0, 5)}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("small, block, group", [(256, 2048, 1024), (8, 16, 20)])
def test_large_groups_in_blocks(spark, monkeypatch, small, block, group):
    """A group that no step splits: every link counts, however the group is cut into blocks."""
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "GROUP_BLOCK", group)
    texts = variants(90) + ["some other text with quite a few words " * 4] * 5
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(df, jaccard.classes(df))


def test_maps_and_sketches_rule_no_similar_pair_out():
    """Pairs at the threshold, of equal sizes and one inside the other, over all sizes."""
    rng = np.random.default_rng(4)
    missed = 0
    for k in range(3000):
        size = int(rng.integers(5, 700))
        # 10 and 10 of 100, or 80 of 100
        own = max(1, size // 9) if k % 2 else 0
        common = rng.integers(0, 2**63, size, dtype=np.uint64)
        a = np.unique(np.concatenate([common, rng.integers(0, 2**63, own, dtype=np.uint64)]))
        b = np.unique(np.concatenate([common, rng.integers(0, 2**63, own if k % 2 else size // 4, dtype=np.uint64)]))
        a, b = jaccard.mix(a), jaccard.mix(b)
        a.sort()
        b.sort()
        if len(np.intersect1d(a, b)) * 1.8 < 0.8 * (len(a) + len(b)):
            continue
        pair = [jaccard._sketches([jaccard.sketch(x)]) for x in (a, b)]
        missed += not jaccard._candidates(np.array([len(a)]), pair[0], np.array([len(b)]), pair[1])[0, 0]
        unlike = jaccard.mix(rng.integers(0, 2**63, len(a), dtype=np.uint64))
        if len(a) > 20:
            unlike.sort()
            assert not jaccard._candidates(np.array([len(a)]), pair[0], np.array([len(a)]), jaccard._sketches([jaccard.sketch(unlike)]))[0, 0]
    assert missed == 0


def test_groups_of_a_bucket(monkeypatch):
    """Tiles find the groups that all pairs give."""
    rng = np.random.default_rng(3)
    sets = []
    for k in range(120):
        base = np.unique(jaccard.mix(np.arange(200, dtype=np.uint64) + np.uint64(1000 * (k % 7))))
        sets.append(np.unique(np.concatenate([rng.choice(base, 190, replace=False), jaccard.mix(rng.integers(0, 2**60, 3, dtype=np.uint64))])))
    n, sketches = np.array([len(x) for x in sets]), jaccard._sketches([jaccard.sketch(x) for x in sets])
    want = jaccard._roots(jaccard._candidates(n, sketches, n, sketches))
    monkeypatch.setattr(jaccard, "TILE", 5)
    got = jaccard._grouped(n, sketches)
    assert len({(a, b) for a, b in zip(want, got, strict=True)}) == len(set(want)) == len(set(got)) == 7


@pytest.mark.parametrize("n", [300, 1200])
def test_rows_per_set_do_not_grow_with_the_group(spark, n):
    texts = spark.createDataFrame([(k, t) for k, t in enumerate(variants(n))], "doc_id long, text string")
    named = texts.selectExpr("doc_id", "text")
    sets = jaccard.features(named, jaccard.runs_for(), "text").where("set IS NOT NULL").dropDuplicates(["set"])
    step = sets.selectExpr("explode(paths) AS p", "set", "n", "sketch").selectExpr("p.node AS node", "set", "n", "sketch", "p.deeper AS deeper")
    rows = step.repartition("node").sortWithinPartitions("node").mapInPandas(jaccard._split_or_compare(False), jaccard.STEP).count()
    assert rows <= 20 * sets.count()


def test_a_large_group_of_near_copies(spark):
    """Every link of 4000 texts, among them copies of copies that are like some of the group only."""
    texts = variants(3900) + [" ".join(f"c{max(j, k)}" for j in range(160)) for k in range(100)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    check(df, jaccard.classes(df))


def test_awkward(spark, awkward, empty):
    check(awkward, jaccard.classes(awkward))
    assert jaccard.classes(empty).count() == 0 and jaccard.representatives(empty).columns == empty.columns
    kept = jaccard.representatives(awkward)
    assert kept.columns == awkward.columns and kept.exceptAll(awkward).count() == 0
    ids = sorted((r.doc_id for r in kept.where(kept.text.rlike(r"\S")).collect()), key=repr)
    texts = [r.text for r in kept.collect()]
    assert ids == sorted([1, 5, 7, 7, 9, 10, None], key=repr) and texts.count(None) == 2 and texts.count("one two") == 1


def test_recall_of_runs():
    assert jaccard.runs_for(0.995) > jaccard.runs_for(0.9) >= 2
    assert jaccard.runs_for(0.995, depth=1) < jaccard.runs_for(0.995, depth=3)


def test_hashes_follow_words():
    a, b = shingles(b"a b c d e f"), shingles(b" a\tb\n c d  e f ")
    assert (a == b).all() and len(a) == 2 and len(shingles(None)) == 0
    long = b"word another " * 200_000
    assert (np.unique(word_hashes(long)) == np.unique(word_hashes(b"another word"))).all() and len(word_hashes(long)) == 400_000


def test_components_of_a_path(spark):
    df = spark.createDataFrame([(k, k + 1) for k in range(0, 60)] + [(100, 101), (7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in connected(df).collect()}
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 101: 100}
    assert connected(df.limit(0)).count() == 0
