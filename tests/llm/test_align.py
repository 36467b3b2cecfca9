import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleetlens.llm import align
from fleetlens.llm.queries import op11_align

SF = "/root/testdata/sf0.001"
JSON, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Plain:
    """The tokenizers as the libraries give them, on whole texts."""

    def __init__(self):
        self.a = Tokenizer.from_file(JSON)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=MODEL)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [k for k in range(256) if k not in printable]
        self.byte = {chr(k): k for k in printable} | {chr(256 + n): k for n, k in enumerate(rest)}

    def sides(self, text):
        a = [(k, bytes(self.byte[c] for c in self.a.id_to_token(k))) for k in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for k in self.b.encode(text):
            piece = self.b.id_to_piece(k)
            b.append((k, bytes([int(piece[1:-1], 16)]) if self.b.is_byte(k) else piece.replace("▁", " ").encode()))
        return a, b

    def groups(self, text):
        """[(A ids, B ids)]; none where the bytes differ."""
        if not text:
            return []
        a, b = self.sides(text)
        want = (" " + text).encode()
        if b"".join(t for _, t in a) != want or b"".join(t for _, t in b) != want:
            return []
        cuts = []
        for side in (a, b):
            at, ends = 0, set()
            for _, t in side:
                at += len(t)
                ends.add(at)
            cuts.append(ends)
        out, both = [], cuts[0] & cuts[1]
        at = {0: 0, 1: 0}
        for stop in sorted(both):
            group = []
            for s, side in enumerate((a, b)):
                ids = []
                while at[s] < stop:
                    k, t = side.pop(0)
                    ids.append(k)
                    at[s] += len(t)
                group.append(ids)
            out.append(group)
        return out


@pytest.fixture(scope="module")
def plain():
    return Plain()


def brute(plain, texts):
    rows = [plain.groups(t) for t in texts]
    links = [Counter((x, y) for g in row for x in g[0] for y in g[1]) for row in rows]
    held = Counter(p for c in links for p in c)
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for row, c in zip(rows, links, strict=True):
        spelled = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in row)
        out.append((sum(len(g[0]) for g in row), sum(len(g[1]) for g in row), len(row), sum(c.values()),
                    sum(n for p, n in c.items() if held[p] == best[p[0]]), sum(n * held[p] for p, n in c.items()),
                    hashlib.sha256(spelled.encode()).hexdigest() if spelled else ""))
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_query(spark, documents, plain):
    rows = documents.select("doc_id", "text").collect()
    want = sorted((r.doc_id, *x) for r, x in zip(rows, brute(plain, [r.text for r in rows]), strict=True))
    got = op11_align(spark, SF)
    assert sorted(tuple(r) for r in got.select("doc_id", *COLUMNS).collect()) == want
    assert sum(w[3] != w[5] for w in want) > 100


ODD = ["a  b", "  a", " ", "a\r\nb\tc ", "</s><s> <unk> <|endoftext|>", "ﬁ ½ Å\n\n x  \n y   ", "a\0b", "é　x", "   ", "\n", "日本語 テスト。 中文", "a" * 3000,
       "x  y   z", "don't we'll 'S it''s", "🙂👍🏽 ok", "a▁b", "word\n" * 5, "tail \n\n "]


def random_texts(n):
    rng = random.Random(3)
    return ["".join(rng.choice(" \n\t ab.'s1é▁ 日") for _ in range(rng.randint(1, 40))) for _ in range(n)]


def test_groups_of_odd_texts(plain):
    pair = align._Pair(align.Tokenizer.load(JSON), align.Tokenizer.load(MODEL))
    assert pair.cuts
    texts = ODD + random_texts(300)
    for text, row in zip(texts, pair.rows(texts), strict=True):
        assert row[4] == ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in plain.groups(text)), text


def test_segments_and_forgetting_change_nothing(documents, monkeypatch):
    texts = [r.text for r in documents.select("text").limit(60).collect()]
    files = align.Tokenizer.load(JSON), align.Tokenizer.load(MODEL)
    want = list(align._Pair(*files).rows(texts))
    whole = align._Pair(*files)
    whole.cuts = False
    assert list(whole.rows(texts)) == want
    monkeypatch.setattr(align, "SEGMENT_CHARS", 100)
    monkeypatch.setattr(align, "REMEMBERED", 50)
    assert list(align._Pair(*files).rows(texts)) == want


@pytest.mark.parametrize("block, slice_", [(1 << 21, 1 << 22), (10, 7)])
def test_awkward(spark, awkward, empty, plain, monkeypatch, block, slice_):
    """Blocks of any size and groups in slices count alike; repeated rows are texts of their own."""
    monkeypatch.setattr(align, "BLOCK_PAIRS", block)
    monkeypatch.setattr(align, "PAIRS_AT_ONCE", slice_)
    files = align.Tokenizer.load(JSON), align.Tokenizer.load(MODEL)
    found = align.link_counts(align.align(awkward, *files))
    assert set(awkward.columns) <= set(found.columns)
    rows = awkward.select("doc_id", "text").collect()
    want = [(r.doc_id, r.text, x[3], x[4], x[5]) for r, x in zip(rows, brute(plain, [r.text for r in rows]), strict=True)]
    got = [tuple(r) for r in found.select("doc_id", "text", "n_links", "n_best", "count_sum").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert align.link_counts(align.align(empty, *files)).count() == 0


def test_counts_of_pairs(spark, plain):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(["aab aab", "aab", "zz aab", None])], "doc_id long, text string")
    files = align.Tokenizer.load(JSON), align.Tokenizer.load(MODEL)
    blocks = spark.createDataFrame([(0, [5 << 32 | 1, 5 << 32 | 2], [3, 1]), (1, [5 << 32 | 1, 6 << 32 | 2], [4, 2])],
                                   "__llm_block long, __llm_pairs array<long>, __llm_texts array<long>")
    _, counts = align.pair_counts(blocks)
    assert sorted(tuple(r) for r in counts.select("a", "b", "texts", "best").collect()) == [(5, 1, 7, True), (5, 2, 1, False), (6, 2, 2, True)]
    assert align.link_counts(align.align(df, *files)).where(F.col("text").isNull()).first().count_sum == 0


def test_a_json_with_other_rules_is_encoded_whole():
    files = align.Tokenizer.load(public_tokenizers.path("word_bpe_49k.json")), align.Tokenizer.load(MODEL)
    assert not align._Pair(*files).cuts
