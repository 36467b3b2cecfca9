import base64
import hashlib

import numpy as np
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetlens.llm import bpe
from fleetlens.llm.queries import RANKS, op1_bpe

SF = "/root/testdata/sf0.001"
RANK_FILE = bpe.Ranks.load(public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
CODEC = bpe.Codec(RANK_FILE)


def library():
    with open(public_tokenizers.path(RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


PLAIN = library()


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab Z19'sé  \n\t.,!#字\x1c\x85"), max_size=400), st.integers(1, 40))
def test_chunks_encode_as_the_whole(text, chunk):
    old, bpe.CHUNK_CHARS, blank, bpe.LONG_BLANK = bpe.CHUNK_CHARS, chunk, bpe.LONG_BLANK, 0
    try:
        assert CODEC.encode(text) == PLAIN.encode_ordinary(text)
    finally:
        bpe.CHUNK_CHARS, bpe.LONG_BLANK = old, blank


def test_long_runs():
    for text in (" " * 300_000 + "x", "x" + "\n" * 200_000, "a b" + "  " * 100_000 + " c", "a" * 100_000, "ab1 " * 60_000):
        ids = CODEC.encode(text)
        assert CODEC.decode(ids) == text.encode()
        assert len(text) > 200_010 or ids == PLAIN.encode_ordinary(text)
    # Longer than the library can take at once.
    assert CODEC.decode(CODEC.encode(" " * 3_000_000 + "x")) == b" " * 3_000_000 + b"x"


def test_special_strings_are_plain_text():
    assert 50256 not in CODEC.encode("a<|endoftext|>b")


def test_query(spark, documents):
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    rows = op1_bpe(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = PLAIN.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_awkward(spark, awkward, empty):
    for packed in (True, False):
        both = bpe.decode(bpe.encode(awkward, RANK_FILE, packed=packed), RANK_FILE)
        assert set(awkward.columns) < set(both.columns)
        for r in both.collect():
            assert bytes(r.decoded) == (r.text or "").encode()
            assert (r.text is not None and r.text != "") or len(r.ids) == 0
    assert bpe.encode(empty, RANK_FILE).count() == 0
    replaced = bpe.encode(awkward, RANK_FILE, out="set")
    assert replaced.columns == awkward.columns
