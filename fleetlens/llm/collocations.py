"""Phrase collocations by top-order marginalisation: only the longest windows are counted, ROLLUP sums their prefixes.

Every word of a piece of text leads one window: itself and the words after it, padded behind the piece's end. Each occurrence of a shorter phrase is
the prefix of exactly one window, so the counts of all phrases of one to four words are sums of window counts over successively shorter prefixes.
Windows end before words that are rarer than a candidate may be, as far as a filter of fixed size knows them. They are counted first; those whose first two, three (all four) words are rarer than a candidate may be lose the words behind their first, second (third),
which no count of interest needs, because no phrase is more frequent than a part of it. Spark's ROLLUP then sums the few rows left. Windows of
a pair of words meet in one place, where its count is complete; those of a pair of very frequent words are spread by the words that follow.

Words travel as 64-bit hashes of language and word. The table of words keeps each hash's word; were two words to share a hash, the hashes
would be taken anew with the next seed, so counts are exact. A task adds up equal windows before they are shuffled.

A candidate's score is ``floor(SCALE * a / (l + r))`` for the cut into two parts (frequencies l and r) that scores lowest. Candidates that mostly
occur inside one longer candidate are dropped. Products are computed as decimals of 38 digits.

Defined results: NULL and empty texts have no words; a NULL language is ``und``; a phrase doesn't go beyond a piece or a row; repeated
rows count as often as they occur; ties are cut at the first word, ranked by frequency, then by the phrase's bytes; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetlens.llm.common import materialize
from fleetlens.llm.shingles import U64, mix, powers, prefix_hashes

UNKNOWN = "und"
LONGEST = 4
SCALE = 2_000_000
# Bytes that are worked on at once, and rows that a task adds up before it passes them on.
BYTES_AT_ONCE, ROWS_AT_ONCE, WORDS_AT_ONCE, ROWS_PER_BATCH = 1 << 20, 5 << 18, 1 << 18, 1 << 16
# Size of the filter of frequent words.
FILTER_BITS = 23
# A word is hot if it makes up one in so many of all words.
HOT = 1000
# Parts that a language's candidates are ranked in before the best of each meet.
RANK_PARTS = 64

INK, BLANK, BREAK = 0, 1, 2
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = BLANK
_CLASS[list(b".,;:!?") + [0x0A, 0x0B, 0x0C, 0x0D]] = BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# What follows a cut and still belongs to windows that lead before it.
_FOLLOWING = re.compile(rb"(?:[ \t]*[^ \t.,;:!?\n-\r]+){0,%d}" % (LONGEST - 1))
_CUT = re.compile(rb"[ \t.,;:!?\n-\r]")

# Stand-ins for a word: none (behind the piece's end), and any of those too rare to matter.
NONE, OTHER = 0, 1
# The end of the piece, where windows are told apart by what follows.
AFTER = 1
WORDS = ("w1", "w2", "w3", "w4")
SPREAD = ("s3", "s4")


def parts(text: bytes) -> Iterator[tuple[bytes, int]]:
    """Parts of a text with the words that follow each; words that start before the number given are the part's own."""
    start = 0
    while start < len(text):
        cut = _CUT.search(text, start + BYTES_AT_ONCE) if len(text) - start > BYTES_AT_ONCE else None
        stop = cut.start() if cut else len(text)
        end = _FOLLOWING.match(text, stop).end()
        yield text[start:end], stop - start
        start = stop


class _Words:
    """The words of many texts at once."""

    def __init__(self, texts: list[tuple[str, bytes, int]], seed: int):
        """``texts``: (language, bytes, own bytes)."""
        self.data = _LOWER[np.frombuffer(b"\n".join(t for _, t, _ in texts) + b"\n", np.uint8)]
        kind = _CLASS[self.data]
        edges = np.flatnonzero(np.diff(np.concatenate(([1], np.minimum(kind, 1)))))
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.piece = np.cumsum(kind == BREAK)[self.starts]
        first = np.cumsum([0] + [len(t) + 1 for _, t, _ in texts[:-1]])
        self.text = np.searchsorted(first, self.starts, side="right") - 1
        self.own = self.starts - first[self.text] < np.array([own for *_, own in texts])[self.text]
        p, (_, down) = prefix_hashes(self.data), powers(len(self.data))
        words = mix((p[self.ends] - p[self.starts]) * down[self.starts])
        seeds = {lang: hashlib.blake2b(lang.encode(), digest_size=8, salt=b"%d" % seed).digest() for lang, *_ in texts}
        of_text = np.array([int.from_bytes(seeds[lang], "little") for lang, *_ in texts], U64)
        self.key = np.maximum(mix(words ^ of_text[self.text]), U64(OTHER + 1)).astype(np.int64)

    def windows(self, frequent: np.ndarray) -> list[np.ndarray]:
        """A column per place of the windows that own words lead, each up to the first word that is not frequent."""
        usable = frequent[self.key.astype(U64) >> U64(64 - FILTER_BITS)]
        at = np.flatnonzero(self.own & usable)
        out, inside = [self.key[at]], np.ones(len(at), bool)
        for k in range(1, LONGEST):
            then = np.minimum(at + k, len(self.key) - 1)
            inside &= (at + k < len(self.key)) & (self.piece[then] == self.piece[at]) & usable[then]
            out.append(np.where(inside, self.key[then], NONE))
        return out

    def word(self, k: int) -> str:
        return self.data[self.starts[k]:self.ends[k]].tobytes().decode("utf-8", "replace")


def _read(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[tuple[_Words, list[str]]]:
    held, size = [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            for part, own in parts(text.as_buffer().to_pybytes()) if text.is_valid else ():
                held.append((lang.as_py(), part, own))
                size += len(part)
                if size >= BYTES_AT_ONCE:
                    yield _Words(held, seed), [h[0] for h in held]
                    held, size = [], 0
    if held:
        yield _Words(held, seed), [h[0] for h in held]


def _added_up(columns: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal rows as one, roughly in the order of their first two words, which packs well. They are brought together by a hash and compared whole."""
    h = np.zeros(len(n), U64)
    for c in columns[2:]:
        h = mix(h * U64(31) + c.astype(U64))
    first, second = (c.astype(U64) >> U64(40) for c in columns[:2])
    order = np.argsort((first << U64(40)) | ((second >> U64(4)) << U64(20)) | (h >> U64(44)))
    for k in range(len(columns)):
        columns[k] = columns[k][order]
    new = np.zeros(len(n), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    at = np.flatnonzero(new)
    return [c[at] for c in columns], np.add.reduceat(n[order], at) if len(at) else n


def _spread(columns: list[np.ndarray], hot: np.ndarray) -> list[np.ndarray]:
    """What tells windows of equal first two words apart when they are dealt out: their third word where the first two are hot, their fourth where all
    three are; else 0. So all windows of a pair that isn't hot meet, and no place draws more rows than a word may have that isn't hot,
    but for equal windows, which a task has added up.
    """
    two = np.isin(columns[0], hot) & np.isin(columns[1], hot)
    three = two & np.isin(columns[2], hot)
    return [np.where(where, np.where(word == NONE, AFTER, word), 0) for where, word in ((two, columns[2]), (three, columns[3]))]


def _count_windows(seed: int, shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        bits, hot = shared.value
        frequent = np.unpackbits(bits).astype(bool)

        def out():
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            held.clear()
            columns, n = _added_up(columns, np.ones(len(columns[0]), np.int64))
            columns = [*_spread(columns, hot), *columns, n]
            for k in range(0, len(n), ROWS_PER_BATCH):
                yield pa.RecordBatch.from_arrays([pa.array(c[k:k + ROWS_PER_BATCH]) for c in columns], [*SPREAD, *WORDS, "n"])

        for words, _ in _read(batches, seed):
            held.append(words.windows(frequent))
            size += len(held[-1][0])
            if size >= ROWS_AT_ONCE:
                yield from out()
                size = 0
        if held:
            yield from out()

    return run


def _list_words(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out():
            key, n, lang, word = (np.concatenate(c) for c in zip(*held, strict=True))
            key, first, at = np.unique(key, return_index=True, return_inverse=True)
            n = np.bincount(at, n).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(lang[first], pa.string()), pa.array(word[first], pa.string()), pa.array(n)], ["key", "lang", "word", "n"])

        for words, langs in _read(batches, seed):
            own = np.flatnonzero(words.own)
            key, first, n = np.unique(words.key[own], return_index=True, return_counts=True)
            at = own[first]
            held.append((key, n, np.array([langs[k] for k in words.text[at]], object), np.array([words.word(k) for k in at], object)))
            size += len(key)
            if size >= WORDS_AT_ONCE:
                yield out()
                held, size = [], 0
        if held:
            yield out()

    return run


def windows(texts: DataFrame, seed: int, frequent: np.ndarray, hot: np.ndarray) -> DataFrame:
    """(s3, s4, w1 .. w4, n) of the longest windows of frequent words, each window once per task and batch. ``texts``: (lang, text)."""
    shared = texts.sparkSession.sparkContext.broadcast((frequent, hot))  # 2^FILTER_BITS bits and at most HOT numbers
    return texts.mapInArrow(_count_windows(seed, shared), "s3 long, s4 long, w1 long, w2 long, w3 long, w4 long, n long")


def hot_words(words: DataFrame) -> np.ndarray:
    """Keys of the words that make up one in HOT of all words or more; there are at most HOT of them."""
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    return np.sort(words.where(F.col("n") * HOT >= total).select("key").toArrow().column("key").to_numpy())


def frequent_words(words: DataFrame, least: int) -> np.ndarray:
    """2^FILTER_BITS bits, packed: set for all words that occur ``least`` times or more, and for few others.

    Its size doesn't grow with the words; were they too many for it, more words would pass and more windows would be counted.
    """
    place = F.shiftrightunsigned("key", 64 - FILTER_BITS)
    bits = words.where(F.col("n") >= least).select(
        F.shiftright(place, 6).alias("at"), F.expr("shiftleft(1L, CAST(63 - (shiftrightunsigned(key, %d) & 63) AS INT))" % (64 - FILTER_BITS)).alias("bit"))
    rows = bits.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most 2^(FILTER_BITS - 6) rows
    out = np.zeros(1 << (FILTER_BITS - 6), ">i8")
    out[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return out.view(np.uint8)


def vocabulary(texts: DataFrame) -> tuple[DataFrame, int]:
    """(key, lang, word, n) of all words, and a seed with which no two words share a key."""
    for seed in count():
        words = texts.mapInArrow(_list_words(seed), "key long, lang string, word string, n long")
        words = materialize(words.groupBy("key", "lang", "word").agg(F.sum("n").alias("n")), "words")
        if not words.groupBy("key").count().where("count > 1").limit(1).count():
            return words, seed


def phrases(counted: DataFrame, least: int) -> DataFrame:
    """(w1 .. w4, k, f) of all phrases of one to four words that occur ``least`` times or more; unused places are NONE."""
    dealt = ("w1", "w2", *SPREAD)
    whole = counted.repartition(*dealt).groupBy(*SPREAD, *WORDS).agg(F.sum("n").alias("n"))
    n = F.sum("n")
    whole = whole.withColumn("three", n.over(W.partitionBy(*dealt, "w3"))).withColumn("two", n.over(W.partitionBy(*dealt)))

    # A sum over windows that meet elsewhere, too, tells nothing; ROLLUP adds those up.
    def cut(word: str, before: Column | None, complete: Column, occurrences: str) -> Column:
        keep = (F.col(word) == NONE) | ~complete | (F.col(occurrences) >= least)
        kept = F.when(keep, F.col(word)).otherwise(F.lit(OTHER).cast("long"))
        return kept if before is None else F.when(before == OTHER, before).otherwise(kept)

    second = cut("w2", None, F.col("s3") == 0, "two")
    third = cut("w3", second, F.col("s4") == 0, "three")
    fourth = cut("w4", third, F.lit(True), "n")
    short = whole.select("w1", second.alias("w2"), third.alias("w3"), fourth.alias("w4"), "n").groupBy(*WORDS).agg(F.sum("n").alias("n"))
    sums = short.rollup(*WORDS).agg(F.sum("n").alias("f"), F.grouping_id().alias("rolled"))
    # grouping_id has a bit per word that was summed over.
    k = F.when(F.col("rolled") == 0, 4).when(F.col("rolled") == 1, 3).when(F.col("rolled") == 3, 2).when(F.col("rolled") == 7, 1)
    last = F.coalesce("w4", "w3", "w2", "w1")
    found = sums.withColumn("k", k).where(F.col("k").isNotNull() & ~last.isin(NONE, OTHER) & (F.col("f") >= least))
    return found.select(*[F.coalesce(w, F.lit(NONE).cast("long")).alias(w) for w in WORDS], "k", "f")


def _part(first: int, words: int) -> list[Column]:
    """The phrase of so many words from the given place on."""
    return [F.col(WORDS[first + j]) if j < words else F.lit(NONE).cast("long") for j in range(LONGEST)]


def _named(columns: list[Column], prefix: str) -> list[Column]:
    return [c.alias(prefix + w) for c, w in zip(columns, WORDS, strict=True)]


def _looked_up(df: DataFrame, found: DataFrame, prefix: str, value: str) -> DataFrame:
    side = found.select(*[F.col(w).alias(f"_{w}") for w in WORDS], F.col("f").alias(value))
    at = [df[prefix + w] == side[f"_{w}"] for w in WORDS]
    return df.join(side, at).drop(*[f"_{w}" for w in WORDS], *[prefix + w for w in WORDS])


def scored(found: DataFrame) -> DataFrame:
    """(w1 .. w4, k, a, l, r, score) of all phrases of two words or more, by the cut of the lowest score."""
    cuts = []
    for k in range(2, LONGEST + 1):
        for cut in range(1, k):
            pieces = [*_named(_part(0, cut), "l_"), *_named(_part(cut, k - cut), "r_")]
            cuts.append(F.when(F.col("k") == k, F.struct(F.lit(cut).alias("cut"), *pieces)))
    each = found.where("k >= 2").select(*WORDS, "k", F.col("f").alias("a"), F.explode(F.filter(F.array(*cuts), lambda c: c.isNotNull())).alias("c"))
    each = each.select(*WORDS, "k", "a", "c.*")
    both = _looked_up(_looked_up(each, found, "l_", "l"), found, "r_", "r")
    score = F.expr(f"(CAST({SCALE} AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(20, 0))) DIV CAST(l + r AS DECIMAL(20, 0))")
    best = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("c")
    return both.groupBy(*WORDS, "k", "a").agg(best).select(*WORDS, "k", "a", "c.l", "c.r", "c.score")


def kept(candidates: DataFrame, share: int) -> DataFrame:
    """Candidates but those that lie inside a longer one that has ``share`` per cent of their occurrences or more."""
    inner = []
    for k in range(3, LONGEST + 1):
        for words in range(2, k):
            for first in range(k - words + 1):
                inner.append(F.when(F.col("k") == k, F.struct(*_named(_part(first, words), "_"))))
    longer = candidates.where("k >= 3").select("a", F.explode(F.filter(F.array(*inner), lambda c: c.isNotNull())).alias("c"))
    longer = longer.groupBy(*[F.col(f"c._{w}").alias(f"_{w}") for w in WORDS]).agg(F.max("a").alias("_longer"))
    at = [candidates[w] == longer[f"_{w}"] for w in WORDS]
    mostly = F.expr(f"CAST(100 AS DECIMAL(3, 0)) * CAST(_longer AS DECIMAL(20, 0)) >= CAST({share} AS DECIMAL(3, 0)) * CAST(a AS DECIMAL(20, 0))")
    return candidates.join(longer, at, "left").where(F.col("_longer").isNull() | ~mostly).drop("_longer", *[f"_{w}" for w in WORDS])


def spelled(candidates: DataFrame, words: DataFrame) -> DataFrame:
    """Add ``lang`` and ``phrase``."""
    each = candidates.select(*WORDS, F.posexplode(F.array(*WORDS)).alias("_place", "key")).where(F.col("key") != NONE)
    each = each.join(words.select("key", "lang", "word"), "key")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_place", "word"))), lambda x: x["word"]), " ")
    # At most four rows each.
    texts = each.groupBy(*WORDS).agg(F.first("lang").alias("lang"), text.alias("phrase"))
    return candidates.join(texts, list(WORDS))


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", least: int = 30, share: int = 80, top: int = 2000) -> DataFrame:
    """The ``top`` phrases of every language: lang, rank, phrase, a, l, r, n, score."""
    texts = df.select(F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"), F.col(text).cast("binary").alias("text"))
    words, seed = vocabulary(texts)
    found = materialize(phrases(windows(texts, seed, frequent_words(words, least), hot_words(words)), least), "phrases")
    candidates = materialize(scored(found), "candidates")
    named = spelled(kept(candidates, share), words)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    # The best of each part of a language hold the best of the language.
    named = named.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    near = named.withColumn("_nth", F.row_number().over(W.partitionBy("lang", "_part").orderBy(*order))).where(F.col("_nth") <= top)
    ranked = near.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
