"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

Texts are encoded as the library encodes ordinary text: the pattern splits the text, every match is merged on its
own, strings that look like special tokens are plain text. Long texts are cut at safe boundaries first: places where a
match of the pattern ends whatever surrounds them. Ids decode to raw bytes, because an id may hold part of a character.

Defined results: NULL text and NULL ids count as empty; texts of any length are encoded whole; bytes that are no valid
UTF-8 are replaced by U+FFFD as Spark itself does; rows are independent, so order, repeats and extra columns don't matter.
The output column replaces a column of the same name.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType

# Fixed value: the pattern of the 50k byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Rank files beyond this are refused, as every executor gets a copy.
MAX_RANK_FILE_BYTES = 64 << 20

# Texts are cut near multiples of so many characters.
CHUNK_CHARS = 1 << 16
LONG_BLANK = 1 << 12

# An ASCII letter before any other ASCII character, and an ASCII digit before a non-digit, always end a match.
_SAFE = re.compile(r"(?<=[A-Za-z])(?=[\x00-@\[-`{-\x7f])|(?<=[0-9])(?=[\x00-/:-\x7f])")
# White space of the pattern's \s. Python's own \s also holds U+001C to U+001F.
_SPACE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_BLANKS = re.compile(f"{_SPACE}{{{LONG_BLANK},}}")


@dataclass(frozen=True)
class Ranks:
    """A rank file as shipped to the executors."""

    blob: bytes
    pattern: str = PATTERN

    @classmethod
    def load(cls, path: str, pattern: str = PATTERN) -> Ranks:
        with open(path, "rb") as f:
            blob = f.read(MAX_RANK_FILE_BYTES + 1)
        if len(blob) > MAX_RANK_FILE_BYTES:
            raise ValueError(f"{path} is larger than {MAX_RANK_FILE_BYTES} bytes")
        return cls(blob, pattern)


class Codec:
    """Encoder and decoder of one Python worker."""

    def __init__(self, ranks: Ranks):
        self._ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.blob.splitlines()) if a}
        self._pattern = ranks.pattern

    def _encoding(self, pattern: str):
        import tiktoken

        return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=self._ranks, special_tokens={})

    @cached_property
    def _matches(self):
        return self._encoding(self._pattern)

    @cached_property
    def _one_match(self):
        return self._encoding(r"(?s:.+)")

    def encode(self, text: str) -> list[int]:
        if len(text) <= LONG_BLANK:
            return self._matches.encode_ordinary(text)
        ids: list[int] = []
        start = 0
        for blank in _BLANKS.finditer(text):
            # A run of white space is one match, but for its last character where something follows.
            end = blank.end() - (blank.end() < len(text))
            self._encode_chunks(text, start, blank.start(), ids)
            ids += self._one_match.encode_ordinary(text[blank.start():end])
            start = end
        self._encode_chunks(text, start, len(text), ids)
        return ids

    def _encode_chunks(self, text: str, start: int, stop: int, ids: list[int]) -> None:
        while start < stop:
            cut = _SAFE.search(text, start + CHUNK_CHARS, stop) if stop - start > CHUNK_CHARS else None
            end = cut.start() if cut else stop
            ids += self._matches.encode_ordinary(text[start:end])
            start = end

    def decode(self, ids: list[int]) -> bytes:
        return self._matches.decode_bytes(ids)


_CODECS: dict[Ranks, Codec] = {}


def _codec(shared: Broadcast) -> Codec:
    ranks = shared.value
    if ranks not in _CODECS:
        _CODECS[ranks] = Codec(ranks)
    return _CODECS[ranks]


def _as_text(value: bytes | None) -> str:
    return "" if value is None else bytes(value).decode("utf-8", "replace")


def _encoder(shared: Broadcast, packed: bool):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec(shared)
        for texts in batches:
            ids = (np.array(codec.encode(_as_text(t)), "<u4") for t in texts)
            yield pd.Series([i.tobytes() if packed else i.astype("i8") for i in ids], dtype=object)

    return F.pandas_udf(run, BinaryType() if packed else ArrayType(LongType()))


def _decoder(shared: Broadcast, packed: bool):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec(shared)
        for rows in batches:
            yield pd.Series([
                b"" if r is None else codec.decode((np.frombuffer(r, "<u4") if packed else np.asarray(r)).tolist())
                for r in rows
            ], dtype=object)

    return F.pandas_udf(run, BinaryType())


def share(spark: SparkSession, ranks: Ranks) -> Broadcast:
    """Ship the ranks once per executor; their size is bounded by MAX_RANK_FILE_BYTES."""
    return spark.sparkContext.broadcast(ranks)


def encode(df: DataFrame, ranks: Ranks, text: str = "text", out: str = "ids", packed: bool = False) -> DataFrame:
    """Add the ids of ``text``: an array, or packed as little-endian unsigned 32-bit integers."""
    run = _encoder(share(df.sparkSession, ranks), packed)
    return df.withColumn(out, run(F.col(text).cast("binary")))


def decode(df: DataFrame, ranks: Ranks, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the raw bytes that the ids stand for; ids as an array or packed."""
    packed = isinstance(df.schema[ids].dataType, BinaryType)
    return df.withColumn(out, _decoder(share(df.sparkSession, ranks), packed)(F.col(ids)))


def n_ids(packed_ids: Column) -> Column:
    return (F.octet_length(packed_ids) / 4).cast("long")
