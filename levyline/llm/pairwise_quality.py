"""Quality scores by Bradley-Terry pairwise ranking.

Every document has a strength w . x of its features; a document of quality 1 is preferred to one of quality 0
with probability sigmoid(w . (x_1 - x_0)). The weights minimise the logistic loss of such preference pairs
(Newton steps with a small ridge). The cut between good and bad is a quantile of the training documents' strengths:
the one below which their share of label 0 lies. ``score`` is a logistic function of the strength that gives
``THRESHOLD`` at that quantile, so ``predicted`` asks for a strength above it.

Features are computed from the whole text alone: shares of capitals, digits, marks and repeated words, sizes of
words and lines, and the like, each squashed to a similar range. Training is bounded: at most about ``TRAIN_ROWS``
labelled documents, chosen by a hash of the id among those that are not held out, and ``PAIRS`` pairs.

Defined results: null and empty texts are scored by their (empty) features; without labels of both kinds
every score is 0.5; labels with a null id or quality are ignored; of repeated labels of an id the smaller counts.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship
from .crossparse import held_out

#: Labelled documents the model is fitted on (expected number).
TRAIN_ROWS = 20_000
PAIRS = 200_000
RIDGE = 1e-3
THRESHOLD = 0.7
SEED = 7

FEATURES = (
    "chars", "words", "word_len", "longest", "upper", "caps_words", "digits", "marks", "odd_marks", "bangs", "bars",
    "distinct", "top_word", "repeats", "lines", "line_len", "same_lines", "stops", "short_words", "no_stop",
)
_MARKS = re.compile(rb"[!-/:-@\[-`{-~]")
_ODD = re.compile(rb"[#$%&*+<=>@^_`{|}~\\]")
_CAPS = re.compile(r"\b[^\W\d_a-z]{2,}\b")


def features(text: str) -> list[float]:
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    n, c = len(words), max(1, len(text))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    held = Counter(words)
    marks, odd = len(_MARKS.findall(raw)), len(_ODD.findall(raw))
    upper = sum(map(str.isupper, text)) if not text.islower() else 0
    letters = max(1, c - marks - raw.count(b" "))
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
    sizes = list(map(len, words))
    stops = raw.count(b". ") + raw.count(b".\n") + raw.endswith(b".")
    m = max(1, n)
    return [
        np.log1p(len(text)) / 5,
        np.log1p(n) / 5,
        min(len(raw) / m / 6, 5.0),
        np.log1p(max(sizes, default=0)) / 3,
        3 * upper / letters,
        3 * len(_CAPS.findall(text)) / m,
        np.sqrt(sum(map(raw.count, _DIGITS)) / c) * 3,
        5 * np.sqrt(marks / c),
        5 * np.sqrt(odd / c),
        5 * np.sqrt(raw.count(b"!") / c),
        5 * np.sqrt(raw.count(b"|") / c),
        len(held) / m,
        max(held.values(), default=0) / m,
        3 * repeats / m,
        np.log1p(len(lines)) / 3,
        np.log1p(len(raw) / max(1, len(lines))) / 5,
        1 - len(set(lines)) / max(1, len(lines)),
        3 * np.sqrt(stops / m),
        sum(s <= 3 for s in sizes) / m,
        float(stops == 0),
    ]


_DIGITS = [str(d).encode() for d in range(10)]


def design(x: np.ndarray) -> np.ndarray:
    """Features with their squares."""
    return np.concatenate([x, x * x], axis=1)


def fit(x: np.ndarray, good: np.ndarray, pairs: int = PAIRS, seed: int = SEED) -> tuple[np.ndarray, float]:
    """Weights and the cut, from features and labels."""
    rng = np.random.default_rng(seed)
    z = design(x)
    a, b = z[good], z[~good]
    d = a[rng.integers(len(a), size=pairs)] - b[rng.integers(len(b), size=pairs)]
    w = np.zeros(z.shape[1])
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        gradient = d.T @ (1 - p) / len(d) - RIDGE * w
        curve = (d * (p * (1 - p))[:, None]).T @ d / len(d) + RIDGE * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w, float(np.quantile(z @ w, np.mean(~good)))


def _features(batches):
    for b in batches:
        x = [features(t or "") for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))], ["key", "x"])


def _score(model: tuple[np.ndarray, float] | None):
    logit = np.log(THRESHOLD / (1 - THRESHOLD))

    def run(batches):
        for b in batches:
            if model is None or not b.num_rows:
                score = np.full(b.num_rows, 0.5)
            else:
                w, cut = model
                x = np.array([features(t or "") for t in b.column(1).to_pylist()])
                score = 1 / (1 + np.exp(-np.clip(design(x) @ w - cut + logit, -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score)], ["key", "score"])

    return run


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = TRAIN_ROWS) -> tuple[np.ndarray, float] | None:
    """The model, from labelled documents that are not held out; None without labels of both kinds."""
    ship(docs.sparkSession)
    known = labels.where(~held_out(id_col)).select(F.col(id_col).alias("key"), F.col(label_col).cast("int").alias("label")).dropna()
    known = known.groupBy("key").agg(F.min("label").alias("label"))
    n = known.count()
    if not n:
        return None
    span = 1 << 62
    below = int(min(1.0, rows / n) * 2 * span) - span
    known = known.where(F.shiftright(F.xxhash64("key", F.lit("train")), 1) < F.lit(below))
    # about `rows` ids, a documented bound: broadcast, so that no text is shuffled
    found = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(known), "key")
    kind = docs.schema[id_col].dataType.simpleString()
    found = found.select("key", "text").mapInArrow(_features, f"key {kind}, x array<double>")
    shown = found.groupBy("key").agg(F.min("x").alias("x")).join(F.broadcast(known), "key").collect()  # one row an id, however often it repeats
    shown.sort(key=lambda r: (r["key"], r["x"]))
    good = np.array([r["label"] == 1 for r in shown], bool)
    if not good.any() or good.all():
        return None
    return fit(np.array([r["x"] for r in shown]), good)


def rank(docs: DataFrame, model: tuple[np.ndarray, float] | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, held_out, score, predicted), one for each row of ``docs``."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text")).mapInArrow(_score(model), f"key {kind}, score double")
    return rows.select(F.col("key").alias("doc_id"), held_out("key").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
