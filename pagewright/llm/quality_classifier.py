"""Quality classifier: Naive Bayes support vectors.

Features are indicators of hashed n-grams: words, word pairs, stretches of word shapes (letters in upper or lower case, digits and
marks, runs joined) and words that repeat the word before. Each indicator is scaled by its class log-count ratio, and a linear
hinge-loss model is fitted to the scaled vectors by dual coordinate descent. A logistic curve turns margins into scores.

The model is fitted on a bounded sample of labelled rows: per class the ``sample`` rows with the smallest hash of the id. Everything
else covers all rows: scoring is one pass over whole texts without a shuffle.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import chunks, held_out, mixed, text_bytes, whole_text, word_codes, word_hashes

BITS = 18
SAMPLE = 4000
THRESHOLD = 0.7
_RUNS = ((re.compile(rb"[a-z\x80-\xff]+"), b"a"), (re.compile(rb"[A-Z]+"), b"A"), (re.compile(rb"[0-9]+"), b"0"), (re.compile(rb"([^aA0])\1+"), rb"\1"))


def word_shape(word: bytes) -> bytes:
    """A word with runs of lower-case letters, capitals, digits and equal marks cut to one sign each."""
    for pattern, sign in _RUNS:
        word = pattern.sub(sign, word)
    return word


def ngram_indicators(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed n-grams of each text, text after text, and where each text starts."""
    codes, starts, distinct = word_codes(texts)
    owner = np.repeat(np.arange(len(texts), dtype=np.uint64), np.diff(starts))
    words = word_hashes(distinct)[codes] if len(distinct) else np.zeros(0, np.uint64)
    shapes = word_hashes([word_shape(w) for w in distinct], 1)[codes] if len(distinct) else words
    keys = []

    def add(hashes: np.ndarray, kind: int, length: int) -> None:
        whole = owner[length - 1:] == owner[: len(owner) - length + 1] if length > 1 else slice(None)
        at = owner[: len(owner) - length + 1]
        spread = mixed(hashes + np.uint64(kind * 0x9E3779B97F4A7C15 % (1 << 64))) >> np.uint64(64 - BITS)
        keys.append(((at << np.uint64(BITS)) | spread)[whole])

    odd = np.uint64(0x9DDFEA08EB382D69)
    add(words, 1, 1)
    add(shapes, 2, 1)
    if len(owner) > 1:
        add(words[:-1] * odd + words[1:], 3, 2)
        add(shapes[:-1] * odd + shapes[1:], 4, 2)
        same = (codes[:-1] == codes[1:]).astype(np.uint64)
        add(same, 5, 2)
    if len(owner) > 2:
        add((shapes[:-2] * odd + shapes[1:-1]) * odd + shapes[2:], 6, 3)
        add(same[:-1] + same[1:] * np.uint64(2), 7, 3)
    every = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)
    cut = np.searchsorted(every, np.arange(len(texts) + 1, dtype=np.uint64) << np.uint64(BITS))
    return (every & np.uint64((1 << BITS) - 1)).astype(np.int32), cut


def log_count_ratios(rows: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    """log of (share among indicators of class 1) / (share in class 0), with one added to every count."""
    counts = np.ones((2, 1 << BITS))
    for features, label in zip(rows, good, strict=True):
        counts[int(label), features] += 1
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def dual_descent(rows: list[np.ndarray], scale: np.ndarray, good: np.ndarray, cost: float, epochs: int) -> np.ndarray:
    """Weights of an L2-regularised hinge-loss model by dual coordinate descent.

    Each row is its scaled indicators over the root of their number, with a constant as last coordinate. Both
    classes get the same total cost.
    """
    signs = np.where(good, 1.0, -1.0)
    upper = np.where(good, cost * len(good) / (2 * max(good.sum(), 1)), cost * len(good) / (2 * max((~good).sum(), 1)))
    values = [scale[f] / np.sqrt(max(len(f), 1)) for f in rows]
    norms = np.array([v @ v + 1 for v in values])
    alpha, weights, bias = np.zeros(len(rows)), np.zeros(len(scale)), 0.0
    order = np.random.default_rng(17)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            gradient = signs[i] * (values[i] @ weights[rows[i]] + bias) - 1
            new = min(max(alpha[i] - gradient / norms[i], 0.0), upper[i])
            step = (new - alpha[i]) * signs[i]
            if step:
                weights[rows[i]] += step * values[i]
                bias += step
                alpha[i] = new
    return np.append(weights, bias)


def logistic_curve(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn margins into chances, by Newton steps on smoothed targets."""
    goal = np.where(good, (good.sum() + 1) / (good.sum() + 2), 1 / ((~good).sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g = np.array([((p - goal) * margins).sum() + 1e-3 * a, (p - goal).sum()])
        w = np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(w * margins * margins).sum() + 1e-3, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


@dataclass(frozen=True)
class Model:
    """Weights per bucket (log-count ratios multiplied in), a constant, and the logistic curve."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def state(self) -> tuple:
        return self.weights, self.bias, self.slope, self.offset

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        out = []
        for start, end in chunks(texts):
            features, cut = ngram_indicators(texts[start:end])
            sums = np.concatenate([[0.0], np.cumsum(self.weights[features], dtype=np.float64)])
            size = np.maximum(np.diff(cut), 1)
            margins = (sums[cut[1:]] - sums[cut[:-1]]) / np.sqrt(size) + self.bias
            out.append(1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -30, 30))))
        return np.concatenate(out) if out else np.zeros(0)


def fit_rows(rows: list[np.ndarray], good: np.ndarray, calibrate: np.ndarray, cost: float, epochs: int) -> Model:
    fit = ~calibrate
    if not (good[fit].any() and (~good[fit]).any()):
        share = float(good.mean()) if len(good) else 1.0
        return Model(np.zeros(1 << BITS, np.float32), 0.0, 0.0, float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    chosen = [r for r, f in zip(rows, fit, strict=True) if f]
    ratios = log_count_ratios(chosen, good[fit])
    solved = dual_descent(chosen, ratios, good[fit], cost, epochs)
    weights, bias = (solved[:-1] * ratios).astype(np.float32), float(solved[-1])
    rest = [r for r, c in zip(rows, calibrate, strict=True) if c]
    margins = np.array([weights[r].sum(dtype=np.float64) / np.sqrt(max(len(r), 1)) + bias for r in rest])
    return Model(weights, bias, *logistic_curve(margins, good[calibrate]))


def fit_quality_model(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, modulus: int = 4, rest: int = 2, cost: float = 1.0, epochs: int = 12,
    id_column: str = "doc_id", text_column: str = "text",
) -> Model:
    """Learn from labelled rows whose crc32(id) mod ``modulus`` is not ``rest``, at most ``sample`` rows per class.

    Labels that are null are left out; an id that is labelled twice counts by its smaller label. A fifth of the sample
    fits the logistic curve. Without both classes every text gets the share of label 1, and 1 without labels.
    """
    known = (
        labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("_id")).agg((F.min("quality") == 1).alias("good"))
        .filter(~held_out("_id", modulus, rest))
    )
    picked = [known.filter(F.col("good") == side).orderBy(F.xxhash64("_id"), "_id").limit(sample) for side in (True, False)]
    chosen = F.broadcast(picked[0].unionAll(picked[1]))  # at most two times ``sample`` rows
    texts = docs.select(F.col(id_column).alias("_id"), whole_text(text_column).alias("text")).join(chosen, "_id")

    def indicators(batches):
        for batch in batches:
            raw = text_bytes(batch["text"])
            lists = []
            for start, end in chunks(raw):
                features, cut = ngram_indicators(raw[start:end])
                lists += [features[cut[i]:cut[i + 1]] for i in range(end - start)]
            yield pa.RecordBatch.from_arrays(
                [batch["_id"], batch["good"], pa.array(lists, type=pa.list_(pa.int32()))], ["_id", "good", "features"]
            )

    def fit(table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values("_id", kind="stable").drop_duplicates("_id")
        rows = [np.asarray(f, dtype=np.int32) for f in table["features"]]
        order = np.arange(len(rows))
        model = fit_rows(rows, table["good"].to_numpy(dtype=bool), order % 5 == 0, cost, epochs)
        return pd.DataFrame({"weights": [model.weights.tobytes()], "bias": [model.bias], "slope": [model.slope], "offset": [model.offset]})

    sampled = texts.mapInArrow(indicators, "_id long, good boolean, features array<int>")
    fitted = sampled.withColumn("model", F.lit(0)).groupBy("model").applyInPandas(fit, "weights binary, bias double, slope double, offset double").first()
    if fitted is None:
        return fit_rows([], np.zeros(0, bool), np.zeros(0, bool), cost, epochs)
    return Model(np.frombuffer(fitted["weights"], np.float32), fitted["bias"], fitted["slope"], fitted["offset"])


def score_quality(
    docs: DataFrame, model: Model, threshold: float = THRESHOLD, modulus: int = 4, rest: int = 2, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted. Null and empty texts score by the constant alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model.state())  # 2**BITS weights, whatever the input

    def score(batches):
        for batch in batches:
            scores = Model(*shared.value).scores(text_bytes(batch["text"]))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(scores)], ["doc_id", "held_out", "score"])

    rows = docs.select(
        F.col(id_column).alias("doc_id"), held_out(id_column, modulus, rest).alias("held_out"), whole_text(text_column).alias("text")
    )
    scored = rows.mapInArrow(score, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model.state())

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(Model(*shared.value).scores([t.encode("utf-8", "surrogatepass") for t in texts]))

    return docs.filter(scored(whole_text(text_column)) >= threshold)
