"""Quality classifier: a linear-chain conditional random field over the lines of a text, aggregated into the text's quality.

Every line with a word is good or bad. A line's score is linear in its own features and those of the line before and after it; neighbouring labels
have weights of their own. Forward-backward gives each line's probability of being good, and the text's quality is their average, weighted
by the lines' lengths, brought to the scale of labelled outcomes by a logistic curve fitted on held-back texts.

Only texts are labelled, so the lines of a text start with the text's label. In each further round the lines of bad texts that the model believes to be good
become good (as long as most of the text's length stays bad) and the model is fitted again.

Training uses a bounded sample: the ``Training.texts / 2`` texts of either label with the smallest hash of their id, and of a text with more than
``Training.lines`` lines so many consecutive ones. Their features (``FEATURES`` numbers a line) are computed by Spark and reach the
driver. Scoring reads every text whole; lines of more than LONGEST_LINE bytes count as several lines, cut at white space.

Defined results: a text without a word (NULL, empty) is one empty line; without labels of both kinds every score is the share of label 1 (1
without any label); ids labelled both ways, NULL ids and NULL labels are not learned from; repeated rows are scored alike; an empty table gives no
rows; extra columns are kept, result columns replace columns of the same name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.shingles import U64, mix, powers, prefix_hashes

# Longer lines are cut at white space; texts are worked on in parts of about so many bytes.
LONGEST_LINE, BYTES_AT_ONCE = 1 << 16, 1 << 20
_LINE_CUT = re.compile(rb"[\x20\x09\x0b-\x0d]")
# How far back a word is looked for among the words before it.
BACK = (1, 2, 3, 4, 8)

# Kinds of bytes: a kind per ASCII symbol, then small and capital letters, digits, white space, control characters, other bytes.
_SYMBOLS = [b for b in range(0x21, 0x7F) if not chr(b).isalnum()]
SMALL, CAPITAL, DIGIT, SPACE, CONTROL, HIGH = range(len(_SYMBOLS), len(_SYMBOLS) + 6)
KINDS = HIGH + 1
_KIND = np.full(256, CONTROL, np.uint8)
_KIND[_SYMBOLS] = np.arange(len(_SYMBOLS))
_KIND[ord("a"):ord("z") + 1], _KIND[ord("A"):ord("Z") + 1], _KIND[ord("0"):ord("9") + 1] = SMALL, CAPITAL, DIGIT
_KIND[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = SPACE
_KIND[128:] = HIGH
# Per line: the root of each kind's share, then what _structure adds.
FEATURES = KINDS + 9 + len(BACK)


@dataclass(frozen=True)
class Training:
    """Bounds of the sample and settings of the fit."""

    texts: int = 3000
    lines: int = 200
    rounds: int = 2
    steps: int = 150
    rate: float = 0.1
    # Penalties of squared weights, per text: of features, and of neighbouring labels.
    ridge: float = 1e-3
    ridge_labels: float = 1e-2
    # Every so many-th text of the sample calibrates.
    held: int = 5


@dataclass(frozen=True)
class Model:
    center: np.ndarray
    scale: np.ndarray
    weight: np.ndarray  # score of good against bad: features of a line, of the one before, of the one after
    bias: float
    labels: np.ndarray  # score of (label, next label); 0 is bad
    first: float  # score of a good first line
    slope: float
    offset: float


def lines(text: bytes) -> Iterator[bytes]:
    for line in text.split(b"\n"):
        start = 0
        while len(line) - start > LONGEST_LINE:
            cut = _LINE_CUT.search(line, start + LONGEST_LINE)
            stop = cut.end() if cut else len(line)
            yield line[start:stop]
            start = stop
        yield line[start:]


def _structure(data: np.ndarray, kind: np.ndarray, starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of the words of each line, the number of its words, and its hash. ``data``: lines, each with a line break."""
    n = len(starts)
    p, (_, down) = prefix_hashes(data), powers(len(data))
    ends = starts + size
    line_hash = mix((p[ends] - p[starts]) * down[starts])
    edges = np.flatnonzero(np.diff(np.concatenate(([1], (kind == SPACE).astype(np.int8)))))
    begin, end = edges[0::2], edges[1::2]
    word = mix((p[end] - p[begin]) * down[begin])
    line = np.searchsorted(starts, begin, side="right") - 1
    length = (end - begin).astype(float)

    def total(values) -> np.ndarray:
        return np.bincount(line, values, minlength=n)

    words = np.bincount(line, minlength=n)
    some = np.maximum(words, 1)
    capital = kind[begin] == CAPITAL
    letters = np.concatenate(([0], np.cumsum((kind == SMALL) | (kind == CAPITAL) | (kind == HIGH))))
    capitals = np.concatenate(([0], np.cumsum(kind == CAPITAL)))
    loud = (letters[end] - letters[begin] > 1) & (capitals[end] - capitals[begin] == letters[end] - letters[begin])
    symbol = kind[end - 1] < len(_SYMBOLS)
    doubled = symbol & (length > 1) & (kind[np.maximum(end - 2, 0)] < len(_SYMBOLS))
    mean = total(length) / some
    columns = [
        np.log1p(size) / 5, np.log1p(words) / 3, mean / 10, np.sqrt(np.maximum(total(length ** 2) / some - mean ** 2, 0)) / 10,
        total(capital) / some, total(loud) / some, total(symbol) / some, total(doubled) / some, total(length > 20) / some]
    for back in BACK:
        same = np.zeros(len(word))
        same[back:] = (word[back:] == word[:-back]) & (line[back:] == line[:-back])
        columns.append(total(same) / some)
    return np.stack(columns, 1), words, line_hash


def _part(some: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(features, number of words, size, hash) per line."""
    size = np.array([len(x) for x in some], np.int64)
    data = np.frombuffer(b"\n".join(some) + b"\n", np.uint8)
    starts = np.cumsum(size + 1) - size - 1
    kind = _KIND[data]
    line = np.repeat(np.arange(len(some)), size + 1)
    shares = np.bincount(line * KINDS + kind, minlength=len(some) * KINDS).reshape(-1, KINDS).astype(float)
    shares[:, SPACE] -= 1  # the line break
    shares = np.sqrt(shares / np.maximum(size, 1)[:, None])
    structure, words, hashes = _structure(data, kind, starts, size)
    return np.concatenate([shares, structure], 1).astype(np.float32), words, size, hashes


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(features, sizes) of the lines with a word; the features are followed by whether an equal line came before and whether one comes after."""
    found, held, n = [], [], 0
    for line in lines(text):
        held.append(line)
        n += len(line)
        if n >= BYTES_AT_ONCE:
            found.append(_part(held))
            held, n = [], 0
    if held:
        found.append(_part(held))
    x, words, size, hashes = (np.concatenate(c) for c in zip(*found, strict=True))
    x, size, hashes = x[words > 0], size[words > 0], hashes[words > 0]
    if not len(x):
        return np.zeros((1, FEATURES + 2), np.float32), np.ones(1, np.int64)
    order = np.argsort(hashes, kind="stable")
    equal = hashes[order][1:] == hashes[order][:-1]
    repeats = np.zeros((len(x), 2), np.float32)
    repeats[order[1:], 0], repeats[order[:-1], 1] = equal, equal
    return np.concatenate([x, repeats], 1), size


WIDTH = FEATURES + 2


def with_neighbours(x: np.ndarray) -> np.ndarray:
    """Features of each line, of the line before and of the line after; zeros beyond the ends."""
    none = np.zeros((1, x.shape[1]), x.dtype)
    return np.concatenate([x, np.concatenate([none, x[:-1]]), np.concatenate([x[1:], none])], 1)


class _Chains:
    """Texts of different lengths, longest first, so that the texts that have a line k are the first ones."""

    def __init__(self, sizes: np.ndarray):
        self.order = np.argsort(-sizes, kind="stable")
        self.sizes = sizes[self.order]
        first = np.cumsum(sizes) - sizes
        self.first = first[self.order]
        steps = int(self.sizes[0]) if len(sizes) else 0
        self.active = np.searchsorted(-self.sizes, -np.arange(1, steps + 1), side="right")  # texts with a line k

    def marginals(self, score: np.ndarray, labels: np.ndarray, first: float) -> tuple[np.ndarray, np.ndarray]:
        """Probability that a line is good, and the expected number of (label, next label) per text in their given order."""
        n, steps = len(self.sizes), len(self.active)
        step = np.exp(labels - labels.max())
        high = np.maximum(score, 0)
        emit = np.stack([np.exp(-high), np.exp(score - high)], 1)
        alpha, pairs = np.zeros((len(score), 2)), np.zeros((n, 2, 2))
        now = np.zeros((0, 2))
        for k in range(steps):
            at = self.first[: self.active[k]] + k
            if k == 0:
                now = emit[at] * np.array([1.0, np.exp(min(first, 500.0))])
            else:
                now = (now[: len(at)] @ step) * emit[at]
            now /= now.sum(1, keepdims=True)
            alpha[at] = now
        good = np.zeros(len(score))
        beta = np.ones((n, 2))
        for k in range(steps - 1, -1, -1):
            m = self.active[k]
            at = self.first[:m] + k
            both = alpha[at] * beta[:m]
            good[at] = both[:, 1] / both.sum(1)
            if k:
                ahead = emit[at] * beta[:m]
                joint = alpha[at - 1][:, :, None] * step * ahead[:, None, :]
                pairs[:m] += joint / joint.sum((1, 2), keepdims=True)
                back = ahead @ step.T
                beta[:m] = back / back.sum(1, keepdims=True)
        out = np.zeros_like(pairs)
        out[self.order] = pairs
        return good, out


def _by_text(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, np.cumsum(sizes) - sizes) if len(sizes) else np.zeros(0)


def _fit_chains(x: np.ndarray, sizes: np.ndarray, good: np.ndarray, weight: np.ndarray, t: Training) -> tuple[np.ndarray, float, np.ndarray, float]:
    """Weights of the most likely labels, by gradient steps of an adaptive rate. ``weight`` is per text."""
    chains, per_line = _Chains(sizes), np.repeat(weight, sizes)
    first_line = np.cumsum(sizes) - sizes
    inner = np.ones(len(good), bool)
    inner[first_line] = False
    seen = np.zeros((2, 2))
    at = np.flatnonzero(inner)
    np.add.at(seen, (good[at - 1].astype(int), good[at].astype(int)), per_line[at])
    theta = np.zeros(x.shape[1] + 6)  # features, bias, first line, label pairs
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    penalty = np.concatenate([np.full(x.shape[1], t.ridge), [0], np.full(5, t.ridge_labels)])
    total = weight.sum()
    for step in range(1, t.steps + 1):
        p, pairs = chains.marginals(x @ theta[:-6] + theta[-6], theta[-4:].reshape(2, 2), theta[-5])
        off = per_line * (p - good)
        grad = np.concatenate([x.T @ off, [off.sum(), off[first_line].sum()], (np.einsum("t,tij->ij", weight, pairs) - seen).ravel()])
        grad = grad / total + penalty * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        theta -= t.rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    return theta[:-6], float(theta[-6]), theta[-4:].reshape(2, 2), float(theta[-5])


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _curve(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope (never negative) and offset of the logistic curve of outcomes, by Newton steps with a slight penalty."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = _logistic(a * z + b)
        off, h = weight * (p - y), weight * p * (1 - p)
        grad = np.array([(off * z).sum() + 0.1 * (a - 1), off.sum() + 0.1 * b])
        hess = np.array([[(h * z * z).sum() + 0.1, (h * z).sum()], [(h * z).sum(), h.sum() + 0.1]])
        da, db = np.linalg.solve(hess, grad)
        a, b = a - np.clip(da, -1, 1), b - np.clip(db, -1, 1)
    return max(float(a), 0.0), float(b)


def fit(samples: list[tuple[int, np.ndarray, np.ndarray]], shares: tuple[float, float], t: Training = Training()) -> Model:
    """Learn from (label, features, sizes) of texts in a fixed order; ``shares`` are the labels' shares outside the sample."""
    y = np.array([s[0] for s in samples])
    balance = np.array([shares[k] / max((y == k).mean(), 1e-9) for k in y])
    held = np.arange(len(samples)) % t.held == t.held - 1
    train = [s for s, h in zip(samples, held, strict=True) if not h] or samples
    raw = np.concatenate([s[1] for s in train]).astype(float)
    center, scale = raw.mean(0), np.maximum(raw.std(0), 1e-3)
    x = np.concatenate([with_neighbours((s[1] - center) / scale) for s in train])
    sizes, length = np.array([len(s[1]) for s in train]), np.concatenate([s[2] for s in train]).astype(float)
    label = np.array([s[0] for s in train])
    good = np.repeat(label, sizes).astype(float)
    weight = np.ones(len(train))
    chains = _Chains(sizes)
    for k in range(t.rounds):
        w, bias, labels, first = _fit_chains(x, sizes, good, weight, t)
        if k + 1 < t.rounds:
            p, _ = chains.marginals(x @ w + bias, labels, first)
            believed = (p > 0.5) & (np.repeat(label, sizes) == 0)
            mostly = _by_text(length * believed, sizes) * 2 < _by_text(length, sizes)
            good = np.where(believed & np.repeat(mostly, sizes), 1.0, np.repeat(label, sizes))
    model = Model(center, scale, w, bias, labels, first, 1.0, 0.0)
    rest = [s for s, h in zip(samples, held, strict=True) if h]
    if len({s[0] for s in rest}) == 2:
        z = _logit(np.array([quality(model, [s[1]], [s[2]])[0] for s in rest]))
        slope, offset = _curve(z, np.array([s[0] for s in rest], float), balance[held])
        model = Model(center, scale, w, bias, labels, first, slope, offset)
    return model


def line_marginals(model: Model, xs: list[np.ndarray]) -> list[np.ndarray]:
    """The probability of each line of each text to be good."""
    sizes = np.array([len(x) for x in xs])
    score = np.concatenate([with_neighbours((x - model.center) / model.scale) @ model.weight for x in xs]) + model.bias
    good, _ = _Chains(sizes).marginals(score, model.labels, model.first)
    return np.split(good, np.cumsum(sizes)[:-1])


def quality(model: Model, xs: list[np.ndarray], lengths: list[np.ndarray]) -> np.ndarray:
    """The average of the lines' probabilities, weighted by length, before calibration."""
    return np.array([(p * n).sum() / n.sum() for p, n in zip(line_marginals(model, xs), lengths, strict=True)])


def sample(labels: DataFrame, t: Training, row_id: str, label: str) -> tuple[DataFrame, dict[int, int]]:
    """(id, label) of at most ``t.texts`` rows, as many of either label as far as there are, and how many there are."""
    each = labels.where(F.col(row_id).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(row_id).alias("__llm_id")).agg(
        F.min(label).alias("__llm_label"), F.max(label).alias("_other")).where("__llm_label = _other").drop("_other")
    n = {r["__llm_label"]: r["count"] for r in each.groupBy("__llm_label").count().collect()}
    h = F.xxhash64(F.lit(13), "__llm_id")
    half = [each.where(F.col("__llm_label") == k).orderBy(h, "__llm_id").limit(t.texts // 2) for k in (0, 1)]
    return half[0].unionByName(half[1]), n


def train(df: DataFrame, labels: DataFrame, t: Training = Training(), row_id: str = "doc_id", text: str = "text", label: str = "quality") -> Model | float:
    """Learn from the texts of ``df`` that ``labels`` marks 0 (bad) or 1 (good); their share of 1 where a label is missing."""
    chosen, n = sample(labels, t, row_id, label)
    if not n.get(0) or not n.get(1):
        return 0.0 if n.get(0) else 1.0

    @F.pandas_udf("x binary, n binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for v in texts:
                x, size = features(b"" if v is None else bytes(v))
                # A stretch of a long text, placed by its length alone.
                at = len(x) * 2654435761 % (len(x) - t.lines + 1) if len(x) > t.lines else 0
                rows.append((x[at:at + t.lines].astype("<f4").tobytes(), size[at:at + t.lines].astype("<i8").tobytes()))
            yield pd.DataFrame(rows, columns=["x", "n"])

    rows = df.select(F.col(row_id).alias("__llm_id"), F.col(text).cast("binary").alias("__llm_t"))
    # The sample's size is bounded, so it may be broadcast; the texts stay where they are.
    found = rows.join(F.broadcast(chosen), "__llm_id").select("__llm_id", "__llm_label", run("__llm_t").alias("f"))
    found = found.orderBy(F.xxhash64(F.lit(13), "__llm_id"), "__llm_id", "f").limit(2 * t.texts)
    samples = [(r["__llm_label"], np.frombuffer(r["f"].x, "<f4").reshape(-1, WIDTH), np.frombuffer(r["f"].n, "<i8")) for r in found.collect()]
    if len({s[0] for s in samples}) < 2:
        return n[1] / (n[0] + n[1])
    return fit(samples, (n[0] / (n[0] + n[1]), n[1] / (n[0] + n[1])), t)


def score(df: DataFrame, model: Model | float, text: str = "text") -> DataFrame:
    """Add ``score``, the probability of label 1, and ``good_lines``, the lines' average before calibration."""
    if not isinstance(model, Model):
        return df.withColumns({"score": F.lit(float(model)), "good_lines": F.lit(float(model))})
    shared = df.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers

    @F.pandas_udf("score double, good_lines double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in batches:
            found = [features(b"" if v is None else bytes(v)) for v in texts]
            if found:
                raw = quality(m, *map(list, zip(*found, strict=True)))
                yield pd.DataFrame({"score": _logistic(m.slope * _logit(raw) + m.offset), "good_lines": raw})
            else:
                yield pd.DataFrame({"score": [], "good_lines": []}, dtype=float)

    scored = df.withColumn("__llm_q", run(F.col(text).cast("binary")))
    return scored.withColumns({"score": F.col("__llm_q.score"), "good_lines": F.col("__llm_q.good_lines")}).drop("__llm_q")
