"""Language identification: averaged hashed subword embeddings under a linear softmax, trained by gradient descent in numpy.

A text is the average of the embeddings of its byte n-grams (2 to 4 bytes of lower-cased letters, words bounded by blanks), hashed into a
fixed number of buckets. Because the model is linear behind the average, embeddings and output layer fold into one table of scores per
bucket for prediction. A held-back part of the sample calibrates the scores (temperature) and the score below which a text is rejected.

Training uses a bounded sample (``Training.rows`` texts, spread over the languages, chosen by a hash of the id); its features are computed
by Spark, and only they, at most one value per bucket and text, reach the driver. Prediction reads every text whole.

Defined results: texts that are NULL or have no letter are ``und`` with score 0 and rejected; without any row to learn from all texts are; rows
with a NULL language are not learned from; ties go to the language first by code point; repeated rows and extra columns don't matter; an
empty table gives no rows. The result columns replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

UNKNOWN = "und"
SIZES = (2, 3, 4)
BITS = 15


@dataclass(frozen=True)
class Training:
    """Bounds and settings. ``rows`` bounds the sample over all languages; a fifth of it calibrates."""

    rows: int = 2000
    dimensions: int = 16
    epochs: int = 12
    rate: float = 0.5
    seed: int = 7
    # Share of the calibration texts of the right language that rejection may cost.
    lost: float = 0.005


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    table: np.ndarray  # score per bucket and language
    bias: np.ndarray
    temperature: float
    least: float  # scores below are rejected


# Bytes as the n-grams see them: ASCII other than letters is blank.
_SEEN = np.arange(256, dtype=np.uint8)
_SEEN[:128] = [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 else 32 for b in range(128)]


def buckets(text: bytes) -> np.ndarray:
    """The buckets of all n-grams of a text."""
    seen = np.concatenate(([32], _SEEN[np.frombuffer(text, np.uint8)], [32])).astype(np.uint8)
    blank = seen == 32
    seen = seen[~(blank & np.append(False, blank[:-1]))].astype(np.uint32)
    out, h = [], seen
    for size in range(2, max(SIZES) + 1):
        if len(seen) < size:
            break
        h = h[:-1] * np.uint32(0x01000193) + seen[size - 1:]
        if size in SIZES:
            out.append(((h ^ np.uint32(size * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def counts(text: bytes) -> np.ndarray:
    return np.bincount(buckets(text), minlength=1 << BITS)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(samples: Sequence[tuple[str, np.ndarray, np.ndarray]], t: Training) -> Model:
    """Train on (language, buckets, shares) of texts, given in a fixed order."""
    languages = tuple(sorted({s[0] for s in samples}))
    label = {name: k for k, name in enumerate(languages)}
    rng = np.random.default_rng(t.seed)
    order = rng.permutation(len(samples))
    held = order[: len(order) // 5]
    train = order[len(order) // 5:]
    embed = rng.normal(0, 1 / t.dimensions, (1 << BITS, t.dimensions)).astype(np.float32)
    out, bias = np.zeros((t.dimensions, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    # Rare languages weigh as much as frequent ones.
    seen = np.bincount([label[samples[k][0]] for k in train], minlength=len(languages))
    weight = len(train) / np.maximum(seen, 1) / len(languages)
    steps = t.epochs * max(len(train), 1)
    for step in range(steps):
        if step % len(train) == 0:
            rng.shuffle(train)
        name, at, share = samples[train[step % len(train)]]
        y = label[name]
        hidden = share @ embed[at]
        g = _softmax(hidden @ out + bias)
        g[y] -= 1
        g *= t.rate * (1 - step / steps) * min(weight[y], 5)
        back = out @ g
        out -= np.outer(hidden, g)
        bias -= g
        # The average makes each bucket's share small; its own rate makes up for it.
        embed[at] -= np.outer(share * (len(at) ** 0.5), back)
    table = embed @ out
    logits = np.array([s[2] @ table[s[1]] + bias for s in (samples[k] for k in held)]).reshape(-1, len(languages))
    truth = np.array([label[samples[k][0]] for k in held], int)
    temperature = _temperature(logits, truth)
    scores = _softmax(logits / temperature)
    right = scores[np.arange(len(truth)), truth][logits.argmax(1) == truth] if len(truth) else np.zeros(0)
    least = float(np.quantile(right, t.lost)) if len(right) else 0.0
    return Model(languages, table.astype(np.float32), bias, temperature, min(least, 0.9))


def _temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """The divisor of the logits that makes the held-back texts most likely."""
    if not len(truth):
        return 1.0
    best, grid = None, np.geomspace(0.25, 8, 41)
    for temperature in grid:
        p = _softmax(logits / temperature)[np.arange(len(truth)), truth]
        loss = -np.log(np.maximum(p, 1e-12)).mean()
        if best is None or loss < best[0]:
            best = (loss, float(temperature))
    return best[1]


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def sample(df: DataFrame, rows: int, row_id: str, lang: str) -> DataFrame:
    """Ids and languages of at most ``rows`` rows, the same number of each language as far as there are."""
    hashed = df.select(F.col(row_id).alias("_id"), F.col(lang).alias("_lang"), F.xxhash64(F.lit(11), row_id).alias("_h"))
    nth = F.row_number().over(W.partitionBy("_lang").orderBy("_h", "_id"))
    return hashed.withColumn("_nth", nth).where(F.col("_nth") <= rows).orderBy("_nth", "_h", "_id", "_lang").limit(rows).select("_id", "_lang", "_h")


def train(df: DataFrame, t: Training = Training(), row_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    """Learn from the rows with a language and a letter; None if there are none."""
    usable = df.where(F.col(lang).isNotNull() & has_letter(F.col(text)))
    chosen = sample(usable, t.rows, row_id, lang)

    @F.pandas_udf("buckets binary, shares binary")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = []
            for x in texts:
                c = counts(bytes(x))
                at = np.flatnonzero(c)
                out.append((at.astype("<u2").tobytes(), (c[at] / c.sum()).astype("<f4").tobytes()))
            yield pd.DataFrame(out, columns=["buckets", "shares"])

    rows = usable.select(F.col(row_id).alias("_id"), F.col(lang).alias("_lang"), F.lower(F.col(text)).cast("binary").alias("_t"))
    # The sample's size is bounded, so it may be broadcast; the texts stay where they are.
    found = rows.join(F.broadcast(chosen), ["_id", "_lang"]).select("_lang", "_h", "_id", features("_t").alias("f")).orderBy("_h", "_id", "f").limit(t.rows)
    samples = [(r["_lang"], np.frombuffer(r["f"].buckets, "<u2"), np.frombuffer(r["f"].shares, "<f4")) for r in found.collect()]
    return fit(samples, t) if samples else None


def predict(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``rejected``."""
    known = has_letter(F.col(text))
    if model is None:
        return df.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "rejected": F.lit(True)})
    shared = df.sparkSession.sparkContext.broadcast(model)  # buckets times languages numbers

    @F.pandas_udf("lang string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in batches:
            logits = np.zeros((len(texts), len(m.languages)))
            for k, x in enumerate(texts):
                if x is not None:
                    c = counts(bytes(x))
                    logits[k] = c @ m.table / max(c.sum(), 1) + m.bias
            p = _softmax(logits / m.temperature)
            best = p.argmax(1)
            yield pd.DataFrame({"lang": [m.languages[b] for b in best], "score": p.max(1)})

    scored = df.withColumn("__llm_p", run(F.when(known, F.lower(F.col(text)).cast("binary")))).withColumn("__llm_known", known)
    score = F.when(F.col("__llm_known"), F.col("__llm_p.score")).otherwise(0.0)
    return scored.withColumns({
        "lang_pred": F.when(F.col("__llm_known"), F.col("__llm_p.lang")).otherwise(UNKNOWN), "score": score,
        "rejected": ~F.col("__llm_known") | (score < model.least),
    }).drop("__llm_p", "__llm_known")
