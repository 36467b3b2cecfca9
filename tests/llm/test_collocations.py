import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import collocations
from fleetlens.llm.queries import op12_collocations
from fleetlens.llm.sql import ORACLE

SF = "/root/testdata/sf0.001"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, least, share, top):
    """``rows``: (lang, text)."""
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, 5):
                f.update((lang, *words[i:i + k]) for i in range(len(words) - k + 1))
    candidates = {p: n for p, n in f.items() if len(p) > 2 and n >= least}
    found = {}
    for p, a in candidates.items():
        lang, words = p[0], p[1:]
        cuts = []
        for cut in range(1, len(words)):
            left, right = f[(lang, *words[:cut])], f[(lang, *words[cut:])]
            cuts.append((2_000_000 * a // (left + right), cut, left, right))
        score, _, left, right = min(cuts)
        found[p] = (a, left, right, score)
    out = {}
    for p, (a, left, right, score) in found.items():
        longer = [b for q, b in candidates.items() if len(q) > len(p) and q[0] == p[0]
                  and any(q[i:i + len(p) - 1] == p[1:] for i in range(1, len(q) - len(p) + 2))]
        if not any(100 * b >= share * a for b in longer):
            out.setdefault(p[0], []).append((-score, -a, " ".join(p[1:]).encode(), left, right))
    return sorted((lang, rank, phrase.decode(), -a, left, right, total[lang], -score)
                  for lang, rows in out.items() for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1))


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def test_query_is_its_statement(spark):
    with duckdb.connect() as db:
        db.sql(f"CREATE VIEW documents AS FROM '{SF}/documents.parquet'")
        want = sorted(tuple(r) for r in db.sql(ORACLE["op12_collocations"]).select(*COLUMNS).fetchall())
    assert rows_of(op12_collocations(spark, SF)) == want and len(want) > 20


def little(n, seed=1):
    rng = random.Random(seed)
    words = ["a", "B", "ü", "x.y", "c,", "d!", "é", "long\tword", "q\n", "　z", "e"]
    return [(rng.choice(["en", "en", "de", None, "und", ""]), " ".join(rng.choices(words, [9, 8, 3, 2, 3, 2, 2, 1, 1, 1, 6], k=rng.randint(0, 40)))) for _ in range(n)]


@pytest.mark.parametrize("least, share, top, hot", [(2, 80, 2000, 1000), (5, 50, 7, 12), (30, 80, 3, 5), (5, 80, 2000, 0)])
def test_like_brute_force(spark, monkeypatch, least, share, top, hot):
    """Whatever words are hot, and so however windows are spread."""
    monkeypatch.setattr(collocations, "HOT", hot)
    rows = little(300)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    got = rows_of(collocations.collocations(df, least=least, share=share, top=top))
    assert got == brute(rows, least, share, top) and got


def test_parts_of_long_texts(spark, monkeypatch):
    """Windows across the cuts of a long text, and words that are added up in small batches."""
    monkeypatch.setattr(collocations, "BYTES_AT_ONCE", 7)
    monkeypatch.setattr(collocations, "ROWS_AT_ONCE", 5)
    monkeypatch.setattr(collocations, "WORDS_AT_ONCE", 6)
    rows = [(lang, text * 3) for lang, text in little(60, 2)]
    got = [b"".join(p[:own] for p, own in collocations.parts(t.encode())) for _, t in rows]
    assert got == [t.encode() for _, t in rows]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    assert rows_of(collocations.collocations(df, least=3)) == brute(rows, 3, 80, 2000)


def test_shared_hashes_are_noticed(spark, monkeypatch):
    """Words that share a hash with the first seed are told apart with the next."""
    plain = collocations.hashlib.blake2b
    real = collocations.mix
    df = spark.createDataFrame([("en", "a b a b c")], "lang string, text string")
    assert collocations.vocabulary(df.withColumn("text", F.col("text").cast("binary")))[1] == 0
    calls = []

    def listed(seed):
        calls.append(seed)
        return (lambda batches: (b for b in batches)) if seed == 0 else collocations_list(seed)

    collocations_list = collocations._list_words
    shared = spark.createDataFrame([(1, "en", "a", 1), (1, "en", "b", 1)], "key long, lang string, word string, n long")
    monkeypatch.setattr(collocations, "_list_words", listed)

    class Once:
        def mapInArrow(self, run, schema):
            return shared if len(calls) == 1 else df.withColumn("text", F.col("text").cast("binary")).mapInArrow(run, schema)

    words, seed = collocations.vocabulary(Once())
    assert seed == 1 and {r.word: r.n for r in words.collect()} == {"a": 2, "b": 2, "c": 1}
    assert plain is collocations.hashlib.blake2b and real is collocations.mix


def test_the_filter_holds_all_frequent_words(spark):
    rng = collocations.np.random.default_rng(1)
    keys = rng.integers(-(2**63), 2**63 - 1, 5000).tolist()
    bits = collocations.np.unpackbits(collocations.frequent_words(spark.createDataFrame([(k, 40 if i % 2 else 3) for i, k in enumerate(keys)], "key long, n long"), 30))
    place = (collocations.np.array(keys).astype("u8") >> collocations.U64(64 - collocations.FILTER_BITS)).astype(int)
    assert bits[place[1::2]].all() and bits[place[::2]].mean() < 0.01


def test_large_counts_stay_exact(spark):
    n = 2**62
    df = spark.createDataFrame([(7, 8, 0, 0, 2, n - 1), (7, 0, 0, 0, 1, n), (8, 0, 0, 0, 1, n - 1)], "w1 long, w2 long, w3 long, w4 long, k int, f long")
    row = collocations.scored(df).first()
    assert row.score == 2_000_000 * (n - 1) // (2 * n - 1) and collocations.kept(collocations.scored(df), 80).count() == 1


def test_awkward(spark, awkward, empty):
    rows = [(r.lang, r.text) for r in awkward.select("lang", "text").collect()]
    assert rows_of(collocations.collocations(awkward, least=2)) == brute(rows, 2, 80, 2000)
    assert collocations.collocations(empty).count() == 0


def test_one_rollup_and_no_text_is_shuffled(spark):
    df = spark.createDataFrame(little(5), "lang string, text string").withColumn("text", F.col("text").cast("binary"))
    plan = collocations.phrases(collocations.windows(df, 0, collocations.np.zeros(1 << 20, "u1"), collocations.np.zeros(0, "i8")), 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("Exchange") == 3 and "text" not in plan.split("MapInArrow")[0]
