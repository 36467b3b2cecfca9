import zlib

import numpy as np
from pyspark.sql import functions as F

from fleetlens.llm import language
from fleetlens.llm.queries import op6_language

SF = "/root/testdata/sf0.01"


def test_query(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op6_language(spark, SF).collect()
    assert len(rows) == len(docs)
    known = {d.lang for d in docs.values()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.lang_pred in known
    held = [r for r in rows if r.held_out]
    assert np.mean([docs[r.doc_id].lang == r.lang_pred for r in held]) > 0.98
    again = op6_language(spark, SF).select("doc_id", "lang_pred", "score").collect()
    assert sorted(again) == sorted((r.doc_id, r.lang_pred, r.score) for r in rows)


def test_only_the_given_rows_teach(spark):
    """Held-out rows with wrong languages change nothing."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    fold = F.crc32(F.col("doc_id").cast("string")) % 3
    a = language.train(docs.where(fold != 1))
    b = language.train(docs.withColumn("lang", F.when(fold == 1, "xx").otherwise(F.col("lang"))).where(fold != 1))
    assert a.languages == b.languages and (a.table == b.table).all()


def test_sample_is_bounded_and_spread(spark):
    df = spark.range(1000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 50 == 0, "rare").otherwise("often").alias("lang"))
    got = language.sample(df, 40, "doc_id", "lang").groupBy("_lang").count().collect()
    assert {r["_lang"]: r["count"] for r in got} == {"rare": 20, "often": 20}


def test_awkward(spark, awkward, empty):
    model = language.train(awkward)
    rows = language.predict(awkward, model).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and (letters or (r.score == 0 and r.rejected))
    assert language.train(empty) is None and language.predict(empty, model).count() == 0
    assert {r.lang_pred for r in language.predict(awkward, None).collect()} == {"und"}
    assert language.train(awkward.withColumn("lang", F.lit(None).cast("string"))) is None


def test_rejection(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.train(docs)
    odd = spark.createDataFrame([(1, "Zzyx qqq wvk xx kjh zzt")], "doc_id long, text string")
    good = language.predict(docs, model)
    assert good.where("rejected").count() < 0.05 * good.count() and 0 < model.least < 1
    assert language.predict(odd, model).first().score <= 1
