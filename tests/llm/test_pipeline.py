import os
import sys

import pytest
import public_tokenizers

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import corpus_pipeline  # noqa: E402
from check_oracle import compare, connect  # noqa: E402

from fleetlens.llm import bpe, quality  # noqa: E402
from fleetlens.llm.common import materialize  # noqa: E402
from fleetlens.llm.sql import ORACLE  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    status, rows, _, note = compare(spark, connect(SF), name, SF)
    assert (status, note) == ("ok", "") and rows > 0


def test_stages(spark, documents):
    """Every stage takes effect on the whole of what the one before it kept."""
    from test_jaccard import brute
    from test_mixing import targets_by_rounds
    from test_quality import plain

    columns, docs, kept = documents.columns, documents, []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), f"test-{name}")
        kept.append(docs.collect())
        if name != "encoded":
            assert docs.columns == columns
    ruled, distinct, private, mixed, ids = kept
    first = quality.ledger(documents).where(~quality.rejected("v1"))
    assert sorted(r.doc_id for r in ruled) == sorted(r.doc_id for r in first.collect())
    rows = [(r.doc_id, r.text) for r in ruled]
    assert sorted(r.doc_id for r in distinct) == sorted({c for c, _ in brute(rows)})
    assert sorted(r.doc_id for r in private) == sorted(r.doc_id for r in distinct)
    sizes, words = {}, {}
    for r in private:
        sizes[r.source] = sizes.get(r.source, 0) + plain(r.text)[0]
    for r in mixed:
        words[r.source] = words.get(r.source, 0) + plain(r.text)[0]
    want = targets_by_rounds(sizes, (5, 2, 1), 1.5, 2)
    assert words == {s: int(t) for s, t in want.items() if int(t)}
    codec = bpe.Codec(bpe.Ranks.load(public_tokenizers.path(corpus_pipeline.RANKS)))
    assert sorted((r.doc_id, bytes(r.ids)) for r in ids) == sorted(
        (r.doc_id, b"".join(i.to_bytes(4, "little") for i in codec.encode(r.text))) for r in mixed)


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0 and len(corpus_pipeline.STAGES) == 5


def test_awkward(spark, awkward, empty):
    for docs in (awkward, empty):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, SF), f"test-{name}")
            assert name == "encoded" or docs.columns == columns
        assert docs.count() >= 0
