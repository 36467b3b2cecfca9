"""Word shingles of a text as 64-bit hashes, in numpy."""

from __future__ import annotations

import hashlib

import numpy as np

U64 = np.uint64
# Texts are hashed in pieces of about so many bytes, cut at white space.
PIECE = 1 << 20

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose result bits all depend on all bits."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


# A random value per byte.
_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(_BASE))
_PLACE = mix(np.arange(1001, 1033, dtype=U64) * U64(_BASE))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers 0..n and their inverses, modulo 2^64."""
    if len(_powers["up"]) <= n:
        size = max(n + 1, 1 << 16, 2 * len(_powers["up"]))
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            values = np.full(size, base, U64)
            values[0] = 1
            _powers[name] = np.multiply.accumulate(values)
    return _powers["up"][: n + 1], _powers["down"][: n + 1]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """p with p[j] - p[i] = sum of byte value k times base^k over i <= k < j."""
    up, _ = powers(len(data))
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=out[1:])
    return out


def _piece_words(data: np.ndarray) -> np.ndarray:
    edges = np.flatnonzero(np.diff(np.concatenate(([True], _BLANK[data], [True]))))
    starts, ends = edges[0::2], edges[1::2]
    p = prefix_hashes(data)
    _, down = powers(len(data))
    return mix((p[ends] - p[starts]) * down[starts])


def word_hashes(text: bytes) -> np.ndarray:
    data = np.frombuffer(text, np.uint8)
    if len(data) <= PIECE:
        return _piece_words(data)
    parts, start = [], 0
    while start < len(data):
        end = min(start + PIECE, len(data))
        while end < len(data):  # on to the next white space
            blank = np.flatnonzero(_BLANK[data[end:end + PIECE]])
            if len(blank):
                end += int(blank[0])
                break
            end = min(end + PIECE, len(data))
        parts.append(_piece_words(data[start:end]))
        start = end
    return np.concatenate(parts)


def shingles(text: bytes | None, words: int = 5) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``words`` words; a shorter text is one run of all its words."""
    w = word_hashes(text or b"")
    if len(w) == 0:
        return w
    size = min(words, len(w))
    total = np.zeros(len(w) - size + 1, U64)
    for k in range(size):
        total += w[k:len(w) - size + 1 + k] * _PLACE[k]
    return np.unique(mix(total + U64(size)))


def set_key(values: np.ndarray) -> bytes:
    """128-bit name of a set of shingles."""
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()
