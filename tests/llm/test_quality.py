import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetlens.llm import quality
from fleetlens.llm.queries import op5_quality

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    n = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if n[x] > 1 for k in range(5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def measures(rows):
    return [(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows]


def test_query(spark, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    rows = op5_quality(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n_words, _, _, _, n_repeat = want = plain(texts[r.doc_id])
        assert measures([r])[0] == want
        assert r.base_failed == (n_words < 10 or 100 * n_repeat > 20 * n_words) and not (r.kept and r.base_failed)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab \n#\xa0É"), max_size=120), min_size=1, max_size=20))
def test_random_texts(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert measures(quality.ledger(df).orderBy("doc_id").collect()) == [plain(t) for t in texts]


def test_awkward(spark, awkward, empty):
    rows = quality.ledger(awkward).collect()
    assert len(rows) == awkward.count() and all(measures([r])[0] == plain(r.text) for r in rows)
    assert quality.ledger(empty).count() == 0 and quality.keep(empty, "v1").columns == empty.columns
    kept = quality.keep(awkward, "base")
    assert kept.columns == awkward.columns and kept.exceptAll(awkward).count() == 0
    assert sorted(r.text for r in kept.collect()) == sorted(
        r.text for r in rows if plain(r.text)[0] >= 10 and 100 * plain(r.text)[4] <= 20 * plain(r.text)[0])


def test_policies_and_ablations(spark):
    df = spark.createDataFrame([(0, 5), (1, 4), (4, 3), (5, 2), (256, 1)], "failures long, n int").withColumn(
        "i", F.explode(F.sequence(F.lit(1), F.col("n")))).select("failures")
    got = {r.rule: (r.failed, r.only_this, r.kept, r.kept_without) for r in quality.ablations(df, ("few_words", "many_symbols")).collect()}
    assert got == {"few_words": (6, 4, 6, 10), "many_symbols": (5, 3, 6, 9)}
    assert quality.mask_of("base") == 3 and df.where(quality.rejected("base")).count() == 6
    with pytest.raises(KeyError):
        quality.mask_of("no such policy")
    assert len({r.bit for r in quality.RULES}) == len(quality.RULES)


def test_native_plan_and_good_labels(spark):
    df = op5_quality(spark, SF)
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan
    good = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").select("doc_id").distinct()
    assert df.join(good, "doc_id").where("NOT base_failed AND NOT kept").count() == 0
