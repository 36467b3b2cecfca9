"""Cross-tokenizer alignment: which tokens of one tokenizer stand for which tokens of another, by byte ranges.

Both tokenizations of a text tile the same bytes. All tokens of both sides are sorted by their start (``lexsort``); the running maximum of the
ends (``maximum.accumulate``) tells how far the bytes are covered, and a group breaks where a start reaches it: there tokens of both sides
end. Inside a group every A token overlaps the group's bytes with every B token; these pairs are the links.

``align`` gives the ids of both sides and the ends of the groups of every text, ``link_counts`` how many texts of the corpus hold each id
pair linked and, for every text, what its links count. The corpus counts travel by blocks of texts: a block names its distinct pairs
once, so a pair that is in every text is one row per block and not one per text, and the counts come back to the blocks in the same way.

Texts are cut into chunks at blanks that neither tokenizer ever joins to what stands before (checked on the vocabularies), and a worker
remembers the ids of short chunks; a tokenizer without such places gets whole texts. Long texts are aligned in segments of whole chunks.

Defined results: NULL and empty texts, and texts whose tokens don't spell a blank and the text byte for byte (characters that the
tokenizer replaces), have no tokens and no groups; repeated rows count as texts of their own; rows are independent otherwise, so ties and order
don't matter; an empty table gives no rows; extra columns are kept, result columns replace columns of the same name.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetlens.llm.bpe import PATTERN
from fleetlens.llm.common import materialize

# Tokenizer files beyond this are refused, as every executor gets a copy.
MAX_FILE_BYTES = 64 << 20
# Texts are aligned together up to so many characters; longer ones in segments.
SEGMENT_CHARS = 1 << 18
# A worker remembers the ids of about so many chunks, or of so many tokens.
REMEMBERED, REMEMBERED_IDS = 1 << 17, 1 << 20
# A block of texts holds about so many token pairs at most, but for a single text.
BLOCK_PAIRS = 1 << 19
PAIRS_AT_ONCE = 1 << 21

# White space as the byte-level pattern sees it.
_OTHER_SPACE = "\t-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACE = f"[ {_OTHER_SPACE}]"
_INK = f"[^ {_OTHER_SPACE}]"
# From a blank after ink up to the next such blank; white space at the text's end belongs to the last chunk.
_CHUNK = re.compile(f" {_SPACE}*+(?:{_INK}++(?:[{_OTHER_SPACE}]{_SPACE}*+)?+)*+(?:{_SPACE}++\\Z)?")
# Ink followed by a blank or the mark of one.
_JOINED = re.compile(f"[^ \u2581{_OTHER_SPACE}][ \u2581]")
WORD_START = "\u2581"


@dataclass(frozen=True)
class Tokenizer:
    """A tokenizer file as shipped to the executors. ``kind``: ``bytes`` (JSON of a byte-level BPE) or ``pieces`` (sentencepiece)."""

    kind: str
    blob: bytes

    @classmethod
    def load(cls, path: str) -> Tokenizer:
        with open(path, "rb") as f:
            blob = f.read(MAX_FILE_BYTES + 1)
        if len(blob) > MAX_FILE_BYTES:
            raise ValueError(f"{path} is larger than {MAX_FILE_BYTES} bytes")
        return cls("bytes" if path.endswith(".json") else "pieces", blob)

    def open(self) -> _Bytes | _Pieces:
        return _Bytes(self.blob) if self.kind == "bytes" else _Pieces(self.blob)


def _byte_characters() -> dict[str, int]:
    """The characters that byte-level vocabularies write for bytes: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class _Bytes:
    def __init__(self, blob: bytes):
        parts = json.loads(blob)
        split, model = parts.get("pre_tokenizer") or {}, parts["model"]
        spelled = _byte_characters()
        vocabulary = model["vocab"] | {t["content"]: t["id"] for t in parts.get("added_tokens") or []}
        self.tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, k in vocabulary.items():
            self.tokens[k] = bytes(spelled[c] for c in token) if all(c in spelled for c in token) else token.encode()
        self.cuts = (parts.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True)
                     and not split.get("add_prefix_space", True))
        # Where tokens are numbered in the order of their merges, the ids are ranks, and the ranked encoder gives the same ids sooner.
        joined = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model.get("merges", [])]
        ids = [model["vocab"].get(t) for t in joined]
        self._ranked = None
        if self.cuts and not model.get("ignore_merges") and ids == list(range(256, 256 + len(ids))) and len(model["vocab"]) == 256 + len(ids):
            import tiktoken

            ranks = {self.tokens[k]: k for k in model["vocab"].values()}
            self._ranked = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
            import tokenizers

            self._encoder = tokenizers.Tokenizer.from_str(blob.decode())
            self._encoder.encode_special_tokens = True

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self._ranked:
            return [self._ranked.encode_ordinary(t) for t in texts]
        return [e.ids for e in self._encoder.encode_batch_fast(texts, add_special_tokens=False)]


class _Pieces:
    def __init__(self, blob: bytes):
        import sentencepiece

        self._encoder = sentencepiece.SentencePieceProcessor(model_proto=blob)
        ids = range(self._encoder.get_piece_size())
        pieces = [self._encoder.id_to_piece(k) for k in ids]
        self.tokens = [bytes([int(p[3:5], 16)]) if self._encoder.is_byte(k) else p.replace(WORD_START, " ").encode()
                       for k, p in zip(ids, pieces, strict=True)]
        # Cuts are safe if no piece goes on beyond a word and the encoder adds one blank in front and keeps all others.
        words = [p for k, p in enumerate(pieces) if not self._encoder.is_control(k)]
        kept = b"".join(self.tokens[k] for k in self._encoder.encode(" a  b ")) == b"  a  b "
        self.cuts = kept and not any(_JOINED.search(p) for p in words)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Of texts that start with a blank: the encoder adds that blank itself."""
        return self._encoder.encode([t[1:] for t in texts], num_threads=1)


class _Pair:
    """Both tokenizers of one Python worker."""

    def __init__(self, a: Tokenizer, b: Tokenizer):
        self.sides = (a.open(), b.open())
        self.cuts = all(s.cuts for s in self.sides)
        self.lengths = [np.array([len(t) for t in s.tokens], np.int64) for s in self.sides]
        # ids of A, then of B, each with a comma and with what ends its side of a group
        self._spelled = np.array([f"{k}{c}" for s, end in zip(self.sides, "|;", strict=True) for k in range(len(s.tokens)) for c in ("," + end)], object)
        self._forget()

    def _forget(self) -> None:
        """The ids of all chunks seen lie end to end per side; ``_known`` gives a chunk's number."""
        self._known: dict[str, int] = {}
        self._ids = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        self._ends = [np.zeros(1, np.int64), np.zeros(1, np.int64)]
        self._exact = np.zeros(0, bool)

    def _learn(self, chunks: list[str]) -> None:
        self._known.update(zip(chunks, range(len(self._known), len(self._known) + len(chunks)), strict=True))
        found = [s.encode(chunks) for s in self.sides]
        spelled = [[b"".join([s.tokens[k] for k in x]) for x in ids] for s, ids in zip(self.sides, found, strict=True)]
        exact = [a == b == c.encode() for a, b, c in zip(*spelled, chunks, strict=True)]
        self._exact = np.concatenate([self._exact, np.array(exact, bool)])
        for side, ids in enumerate(found):
            n = np.fromiter(map(len, ids), np.int64, len(ids))
            self._ids[side] = np.concatenate([self._ids[side], np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum()))])
            self._ends[side] = np.concatenate([self._ends[side], self._ends[side][-1] + np.cumsum(n)])

    def segments(self, text: str) -> list[list[str]]:
        """A blank and the text as lists of chunks, each of about SEGMENT_CHARS characters."""
        if not self.cuts:
            return [[" " + text]]
        chunks = _CHUNK.findall(" " + text)
        if len(text) <= SEGMENT_CHARS:
            return [chunks]
        out, size = [[]], 0
        for chunk in chunks:
            out[-1].append(chunk)
            size += len(chunk)
            if size >= SEGMENT_CHARS:
                out.append([])
                size = 0
        return [s for s in out if s]

    def _gathered(self, side: int, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of chunks, end to end, and where each chunk's end."""
        first, n = self._ends[side][chunks], self._ends[side][chunks + 1] - self._ends[side][chunks]
        ends = np.cumsum(n)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + n, n)
        return self._ids[side][at], ends

    def align(self, segments: list[list[str]]) -> list[tuple | None]:
        """(A ids, B ids, ends of the groups in A, in B, the groups spelled) per segment; None where bytes differ."""
        chunks = list(chain.from_iterable(segments))
        numbers = list(map(self._known.get, chunks))
        if None in numbers:
            self._learn(list(dict.fromkeys(c for c, k in zip(chunks, numbers, strict=True) if k is None)))
            numbers = list(map(self._known.__getitem__, chunks))
        number = np.array(numbers, np.int64)
        sizes = np.fromiter(map(len, segments), np.int64, len(segments))
        good = np.logical_and.reduceat(self._exact[number], np.cumsum(sizes) - sizes) if len(segments) else np.zeros(0, bool)
        out: list[tuple | None] = [None] * len(segments)
        if good.any():
            number, stops = number[np.repeat(good, sizes)], np.cumsum(sizes[good]) - 1
            sides = []
            for side in (0, 1):
                ids, ends = self._gathered(side, number)
                sides.append((ids, np.append(0, ends[stops])))
            for k, row in zip(np.flatnonzero(good).tolist(), self._coalesce(*sides), strict=True):
                out[k] = row
        if len(self._known) > REMEMBERED or len(self._ids[0]) + len(self._ids[1]) > REMEMBERED_IDS:
            self._forget()
        return out

    def _coalesce(self, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple]:
        """Ids of both sides, end to end, and where the segments end in them. A segment's tokens cover the same bytes on both sides."""
        sides = [a[0], b[0]]
        ends = [np.cumsum(length[ids]) for length, ids in zip(self.lengths, sides, strict=True)]
        end = np.concatenate(ends)
        start = np.concatenate([e - length[ids] for e, length, ids in zip(ends, self.lengths, sides, strict=True)])
        side = np.repeat(np.array([0, 1], np.int8), [len(s) for s in sides])
        order = np.lexsort((side, start))
        start, covered = start[order], np.maximum.accumulate(end[order])
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(np.append(False, start[1:] >= covered[:-1]))
        # By group, A before B: what the groups look like when written down.
        key = 2 * group + side
        written = np.argsort(key, kind="stable")
        key = key[written]
        places = 2 * np.concatenate(sides)[written] + np.append(key[1:] != key[:-1], True)
        places[(key & 1) == 1] += 2 * len(self.lengths[0])
        words = self._spelled[places].tolist()
        n = int(group[order[-1]]) + 1
        in_a, in_b = (np.cumsum(np.bincount(g, minlength=n)) for g in np.split(group, [len(sides[0])]))
        # Groups up to the end of each segment.
        stops = np.append(0, np.searchsorted(in_a, a[1][1:]) + 1)
        for k in range(len(a[1]) - 1):
            (at_a, to_a), (at_b, to_b), groups = a[1][k:k + 2], b[1][k:k + 2], slice(stops[k], stops[k + 1])
            yield a[0][at_a:to_a], b[0][at_b:to_b], in_a[groups] - at_a, in_b[groups] - at_b, "".join(words[at_a + at_b:to_a + to_b])[:-1]

    def rows(self, texts: list[str]) -> Iterator[tuple]:
        """(packed A ids, B ids, ends in A, ends in B, groups, number of links) per text; texts of a call are aligned together, long ones in segments."""
        segments = [self.segments(t) if t else [] for t in texts]
        found = iter(self.align([s for text in segments if len(text) == 1 for s in text]))
        for text in segments:
            if len(text) == 1:
                parts = [next(found)]
            else:
                parts = [p for s in text for p in self.align([s])]
            if not parts or any(p is None for p in parts):
                yield (b"", b"", b"", b"", "", 0)
                continue
            out = [np.concatenate([p[side] for p in parts]).astype("<u4").tobytes() for side in (0, 1)]
            for side in (2, 3):
                base = np.cumsum([0] + [len(p[side - 2]) for p in parts[:-1]])
                out.append(np.concatenate([p[side] + k for p, k in zip(parts, base, strict=True)]).astype("<u4").tobytes())
            n_links = sum(int((np.diff(p[2], prepend=0) * np.diff(p[3], prepend=0)).sum()) for p in parts)
            yield (*out, ";".join(p[4] for p in parts), n_links)


_PAIRS: dict[tuple[Tokenizer, Tokenizer], _Pair] = {}


def _pair(shared: Broadcast) -> _Pair:
    key = shared.value
    if key not in _PAIRS:
        _PAIRS[key] = _Pair(*key)
    return _PAIRS[key]


COLUMNS = ("a_ids", "b_ids", "a_ends", "b_ends", "groups", "n_links")
RESULT = "a_ids binary, b_ids binary, a_ends binary, b_ends binary, groups string, n_links long"


def _batches(texts: list[str]) -> Iterator[list[str]]:
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= SEGMENT_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def align(df: DataFrame, a: Tokenizer, b: Tokenizer, text: str = "text") -> DataFrame:
    """Add ``a_ids`` and ``b_ids``, the ends of the groups in them (``a_ends``, ``b_ends``), ``groups`` and ``n_links``.

    The first four are packed as little-endian unsigned 32-bit integers. ``groups`` writes the groups down: ``a1,a2|b1;a3|b2,b3``.
    """
    shared = df.sparkSession.sparkContext.broadcast((a, b))  # two files of at most MAX_FILE_BYTES

    @F.pandas_udf(RESULT)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        pair = _pair(shared)
        for values in batches:
            texts = ["" if v is None else bytes(v).decode("utf-8", "replace") for v in values]
            rows = [row for some in _batches(texts) for row in pair.rows(some)]
            yield pd.DataFrame(rows, columns=list(COLUMNS))

    aligned = df.withColumn("__llm_aligned", run(F.col(text).cast("binary")))
    return aligned.withColumns({c: F.col(f"__llm_aligned.{c}") for c in COLUMNS}).drop("__llm_aligned")


def n_packed(packed: Column) -> Column:
    return (F.octet_length(packed) / 4).cast("long")


PAIR_BITS = 32


def _links(ids: list[np.ndarray], ends: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(pair, how often it is linked) of one text's groups; a pair may come more than once.

    Equal ids of a group are one entry with a number, so a group of many equal tokens stays small. Groups expand in slices.
    """
    entries = []
    for x, e in zip(ids, ends, strict=True):
        group = np.repeat(np.arange(len(e)), np.diff(e, prepend=0))
        key, n = np.unique((group << PAIR_BITS) | x, return_counts=True)
        entries.append((key >> PAIR_BITS, key & ((1 << PAIR_BITS) - 1), n))
    (ga, ia, na), (gb, ib, nb) = entries
    size = np.bincount(gb, minlength=len(ends[0]))
    first = np.cumsum(size) - size
    repeat = size[ga]
    total = np.cumsum(repeat)
    lo = 0
    while lo < len(ga):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + PAIRS_AT_ONCE, side="right")))
        r = repeat[lo:hi]
        left = np.repeat(np.arange(lo, hi), r)
        right = np.arange(len(left)) - np.repeat(np.cumsum(r) - r, r) + first[ga[left]]
        yield (ia[left] << PAIR_BITS) | ib[right], na[left] * nb[right]
        lo = hi


def _text_pairs(row: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of a text and how often each is linked."""
    pairs, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for more, m in _links([row[0], row[1]], [row[2], row[3]]):
        pairs, at = np.unique(np.concatenate([pairs, more]), return_inverse=True)
        n = np.bincount(at, np.concatenate([n, m]).astype(float), minlength=len(pairs)).astype(np.int64)
    return pairs, n


PACKED = ("a_ids", "b_ids", "a_ends", "b_ends")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by blocks: instead of its ids a row has the places of its pairs among the block's, whose first row names them."""
    part, number = TaskContext.get().partitionId() << 32, 0
    held, found, size = [], [], 0

    def out():
        nonlocal held, found, size, number
        pairs = np.unique(np.concatenate([p for p, _ in found]))
        texts = np.zeros(len(pairs), np.int64)
        at, times = [], []
        for p, n in found:
            places = np.searchsorted(pairs, p)
            texts[places] += 1
            at.append(places.astype("<u4").tobytes())
            times.append(n.astype("<i8").tobytes())
        done = 0
        for rest in held:
            rows = slice(done, done + rest.num_rows)
            head = [pairs] if not done and rest.num_rows else []
            empty = [None] * (rest.num_rows - len(head))
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array([part + number] * rest.num_rows, pa.int64()), pa.array(at[rows], pa.binary()),
                 pa.array(times[rows], pa.binary()), pa.array([*head, *empty], pa.list_(pa.int64())),
                 pa.array([*([texts] if head else []), *empty], pa.list_(pa.int64()))],
                [*rest.schema.names, "__llm_block", "__llm_at", "__llm_times", "__llm_pairs", "__llm_texts"])
            done += rest.num_rows
        held, found, size, number = [], [], 0, number + 1

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c) for c in PACKED]
        for k in range(batch.num_rows):
            found.append(_text_pairs(tuple(np.frombuffer(c[k].as_buffer(), "<u4").astype(np.int64) for c in columns)))
            size += len(found[-1][0])
        held.append(batch.drop_columns(list(PACKED)))
        if size >= BLOCK_PAIRS:
            yield from out()
    if held:
        yield from out()


def pair_counts(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs of the blocks, corpus counts with whether a pair is a best one of its A id)."""
    each = blocks.where("__llm_pairs IS NOT NULL").select(
        "__llm_block", F.posexplode(F.arrays_zip("__llm_pairs", "__llm_texts")).alias("__llm_place", "p")).select(
        "__llm_block", "__llm_place", F.col("p.__llm_pairs").alias("pair"), F.col("p.__llm_texts").alias("texts"))
    counts = each.groupBy("pair").agg(F.sum("texts").alias("texts")).withColumn("a", F.shiftright("pair", PAIR_BITS))
    best = counts.groupBy("a").agg(F.max("texts").alias("most"))
    return each.drop("texts"), counts.join(best, "a").select("pair", "a", (F.col("pair").bitwiseAND((1 << PAIR_BITS) - 1)).alias("b"),
                                                             "texts", (F.col("texts") == F.col("most")).alias("best"))


def _scored(rows: pa.Table, counts: pa.Table) -> pa.Table:
    """The links of a block's texts, summed per text."""
    at = counts.column("__llm_place").to_numpy()
    texts, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    texts[at] = counts.column("texts").to_numpy()
    best[at] = counts.column("best").to_numpy()
    n_best, total = [], []
    for places, times in zip(rows.column("__llm_at"), rows.column("__llm_times"), strict=True):
        p, n = np.frombuffer(places.as_buffer(), "<u4"), np.frombuffer(times.as_buffer(), "<i8")
        n_best.append(int((best[p] * n).sum()))
        total.append(int((texts[p] * n).sum()))
    rows = rows.drop_columns(["__llm_block", "__llm_at", "__llm_times"])
    return rows.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64()))


def link_counts(aligned: DataFrame) -> DataFrame:
    """Replace the packed columns of ``align`` by ``n_best`` and ``count_sum``.

    A pair counts the rows that hold it linked, over the whole table. ``count_sum`` adds the counts of a row's links up, ``n_best`` is the number
    of its links whose count is the highest of their A id.
    """
    rest = aligned.drop(*PACKED, "n_best", "count_sum")
    block = "__llm_block long, __llm_at binary, __llm_times binary"
    schema = StructType([*rest.schema.fields, *StructType.fromDDL(f"{block}, __llm_pairs array<long>, __llm_texts array<long>").fields])
    ordered = aligned.select(*rest.columns, *PACKED)
    blocks = materialize(ordered.mapInArrow(_blocks, schema), "align-blocks")
    each, counts = pair_counts(blocks)
    counted = each.join(counts.select("pair", "texts", "best"), "pair").select(
        F.col("__llm_block").alias("__llm_in"), "__llm_place", "texts", "best")
    rows = blocks.drop("__llm_pairs", "__llm_texts")
    out = StructType([*rest.schema.fields, *StructType.fromDDL("n_best long, count_sum long").fields])
    return rows.groupBy("__llm_block").cogroup(counted.groupBy("__llm_in")).applyInArrow(_scored, out)
