"""A table of awkward documents that every operator must take: NULLs, empty and very long texts, ties, repeated rows, clashing names."""

import pytest

# Column names that operators use or add themselves.
CLASHES = "set string, size long, target double, span_from long, code string, n_words long, kind string, key string, path string, _n long"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}"
EXTRA = ("s", 1, 0.5, 2, "c", 3, "k", "key", "p", 4)

SENTENCE = "the quick brown fox jumps over the lazy dog near the river bank while seven tall men watch from an old wooden bridge "


def awkward_rows():
    long_text = "".join(f"word{i % 997} and{i % 89} more{i % 31} " for i in range(20_000))
    texts = [
        (1, SENTENCE * 2 + "alpha", "en", "a"), (2, SENTENCE * 2 + "alpha", "en", "a"), (3, None, "en", "a"), (4, "", None, "b"),
        (5, long_text, "en", "b"), (6, SENTENCE * 2 + "beta", "en", None), (6, SENTENCE * 2 + "beta", "en", None), (7, "one two", "de", "c"),
        (7, "one three", "de", "c"), (8, " \n\t ", None, None), (None, "no id at all but some words to keep here now", "fr", "c"),
        (None, None, None, None), (9, "é" * 300 + " ü", "de", "b"), (10, "a" * 5000, "en", "a"), (11, "one two", "de", "c"),
    ]
    return [(i, t, lang, source, len(t or ""), *EXTRA) for i, t, lang, source in texts]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
