"""Positive-unlabelled quality classifier with the non-negative risk.

Trusted positives are the documents labelled good; the unlabelled text is all of it (labels
not looked at).  With class prior p and logistic loss l, the risk is

    p E_pos[l(f)] + max(0, E_unl[l(-f)] - p E_pos[l(-f)])

the second term being the risk on negatives, estimated without one negative and kept
from going below zero: a step that would take it there is cut short (as the method asks).

The model is linear in bounded measurements of the whole text.  Every step is one Spark
aggregate over all documents that may be learnt from: risk, gradient and curvature are sums, a few
hundred numbers at any corpus size.  As the logistic loss has l(f) - l(-f) = -f, the
risk is convex and some ten Newton steps reach its minimum.

The prior comes from positives and unlabelled text alone.  A first model tells positives
from all text; wherever its score is above a threshold, a share of all text lies that
cannot be less than p times the positives' share, as the good part of the text looks like the positives.  The smallest
quotient, over thresholds that keep nine tenths of the positives, is the estimate.

Defined cases: a null or empty text measures zero and is scored like any other; labels of
ids that no document has are not looked at; without a labelled good document there is
nothing to learn, which is said in a warning, and every score is 1; repeated rows repeat
their score and count as often as they are there; very long texts are measured whole; an empty
table gives no rows; further columns are not read.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import labelled, quality_rules, shared

ACCEPT = 0.7
RIDGE = 0.01
#: Thresholds at which the prior is looked for keep this share of the positives.
KEEP = 0.9
_BINS, _REACH = 4000, 20.0

_UPPER = bytes(range(65, 91))
_DIGIT = bytes(range(48, 58))
_LETTER = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
_SPACE = b" \t\n\x0b\x0c\r"

FEATURES = ("symbols", "table_marks", "bangs", "upper_letters", "upper_words", "digits", "other_marks", "repeated_words",
            "repeated_lines", "word_length", "long_words", "length")


def measurements(text: str) -> list[float]:
    """Bounded measurements of a whole text, in the order of ``FEATURES``."""
    (n, word_chars, symbols, n_lines, dup_lines, repeat, upper, bangs) = quality_rules.measure(text)
    raw = text.encode()
    size, words = max(1, len(raw)), max(1, n)
    letters = len(raw) - len(raw.translate(None, _LETTER))
    digits = len(raw) - len(raw.translate(None, _DIGIT))
    spaces = len(raw) - len(raw.translate(None, _SPACE))
    caps = len(raw) - len(raw.translate(None, _UPPER))
    mean = word_chars / words
    return [min(1.0, symbols / words), min(1.0, text.count("|") / words), min(1.0, bangs / words), caps / size, upper / words,
            digits / size, (len(raw) - letters - digits - spaces) / size, repeat / words, dup_lines / max(1, n_lines),
            min(2.0, mean / 10), max(0.0, min(3.0, mean / 10 - 1.2)), min(1.0, np.log1p(n) / 10)]


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``x`` (the measurements) of every row."""
    def rows(batches):
        for ids, texts in batches:
            yield {"doc_id": ids, "x": [measurements(t) for t in texts]}

    return shared.text_map(docs, rows, "doc_id bigint, x array<double>")


@dataclass(frozen=True)
class Model:
    weights: tuple[float, ...]
    bias: float
    prior: float

    def score(self, x: str = "x"):
        z = sum((F.get(F.col(x), k) * w for k, w in enumerate(self.weights)), F.lit(self.bias))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))


#: What scores everything 1: the model without positives.
ACCEPT_ALL = Model((0.0,) * len(FEATURES), 30.0, 1.0)


def _totals(rows: DataFrame, part: Callable[[np.ndarray, np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum of ``part(x, positive)`` over all rows: added up per task, then by Spark (exactly, so in any order)."""
    schema = "k int, v double"
    target = shared._arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            if b.num_rows:
                total += part(b.column(1).flatten().to_numpy().reshape(-1, len(FEATURES)), b.column(0).to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], schema=target)

    out = np.zeros(size)
    summed = shared.map_arrow(rows.select("positive", "x"), run, schema).groupBy("k").agg(F.sum(F.col("v").cast("decimal(38,15)")).cast("double").alias("v"))
    for r in summed.collect():  # ``size`` rows
        out[r["k"]] = r["v"]
    return out


def group_sums(x: np.ndarray, positive: np.ndarray, w: np.ndarray) -> np.ndarray:
    """For all rows and for the positive ones: number, softplus, its gradient and curvature; then the positives' own sum."""
    f = x @ w
    sure = 1 / (1 + np.exp(-np.clip(f, -30, 30)))
    loss, upper = np.logaddexp(0, f), np.triu_indices(x.shape[1])
    parts = []
    for some in (np.ones(len(x)), positive.astype(float)):
        parts += [[some.sum(), some @ loss], x.T @ (some * sure), ((x * (some * sure * (1 - sure))[:, None]).T @ x)[upper]]
    return np.concatenate([*parts, x.T @ positive.astype(float)])


def _unpack(sums: np.ndarray, d: int) -> list[tuple[float, float, np.ndarray, np.ndarray]]:
    """(number, mean softplus, mean gradient, mean curvature) of both groups, and the positives' mean."""
    upper, size, out = np.triu_indices(d), 2 + d + d * (d + 1) // 2, []
    for k in (0, size):
        n = max(sums[k], 1.0)
        curve = np.zeros((d, d))
        curve[upper] = sums[k + 2 + d:k + size] / n
        out.append((sums[k], sums[k + 1] / n, sums[k + 2:k + 2 + d] / n, curve + np.triu(curve, 1).T))
    return [*out, sums[2 * size:] / max(out[1][0], 1.0)]


def sums_size(d: int) -> int:
    return 2 * (2 + d + d * (d + 1) // 2) + d


def minimise(sums: Callable[[np.ndarray], np.ndarray], d: int, prior: float, steps: int = 25) -> tuple[np.ndarray, float]:
    """Weights (the last one of the constant) that minimise the non-negative risk, and the risk on negatives there."""
    keep = RIDGE * np.r_[np.ones(d - 1), 1e-6]

    def at(w: np.ndarray):
        every, pos, mean = _unpack(sums(w), d)
        risk = every[1] - prior * (mean @ w) + 0.5 * (keep * w) @ w
        return risk, every[1] - prior * pos[1], every[2] - prior * mean + keep * w, every[3] + np.diag(keep + 1e-9)

    w = np.zeros(d)
    now = at(w)
    for _ in range(steps):
        step, size = np.linalg.solve(now[3], now[2]), 1.0
        new = at(w - step)
        while (new[1] < 0 or new[0] > now[0] - 1e-4 * size * (now[2] @ step)) and size > 1e-2:
            size /= 3
            new = at(w - size * step)
        if new[1] < 0 or new[0] >= now[0]:
            break
        w, gain, now = w - size * step, now[0] - new[0], new
        if gain < 1e-6:
            break
    return w, now[1]


def tell_apart(sums: Callable[[np.ndarray], np.ndarray], d: int, steps: int = 7) -> np.ndarray:
    """Weights that tell positives from all text, both counting half."""
    w = np.zeros(d)
    for _ in range(steps):
        every, pos, mean = _unpack(sums(w), d)
        w = w - np.linalg.solve(every[3] + pos[3] + RIDGE * np.eye(d), every[2] + pos[2] - mean + RIDGE * w)
    return w


def prior_of(every: np.ndarray, positive: np.ndarray) -> float:
    """The prior from histograms of a score: the least quotient of the shares above a threshold that keeps most positives."""
    above_all, above = (np.cumsum(h[::-1])[::-1] / max(h.sum(), 1.0) for h in (every, positive))
    there = above >= KEEP
    return float(np.clip((above_all[there] / above[there]).min(), 0.01, 0.99))


def fit(found: DataFrame, labels: DataFrame) -> Model:
    """Fit on all measured documents (``measured``) that are not held out; the labels say which of them are good."""
    good = shared.sized(labelled.learn_labels(labels, "quality").where("y = 1").select("doc_id", F.lit(True).alias("positive")))
    rows = shared.cut(found.where(~shared.held_out("doc_id")).join(good, "doc_id", "left")
                      .select(F.coalesce("positive", F.lit(False)).alias("positive"), "x"))
    d = len(FEATURES)
    moments = _totals(rows, lambda x, p: np.r_[len(x), p.sum(), x.sum(axis=0), (x * x).sum(axis=0)], 2 + 2 * d)
    n, n_good = moments[:2]
    if not n_good:
        warnings.warn("no document is labelled good: every document will be accepted", stacklevel=2)
        return ACCEPT_ALL
    mean = moments[2:2 + d] / n
    spread = np.sqrt(np.maximum(moments[2 + d:] / n - mean * mean, 0)) + 1e-6

    def scaled(x: np.ndarray) -> np.ndarray:
        return np.c_[(x - mean) / spread, np.ones(len(x))]

    def sums(w: np.ndarray) -> np.ndarray:
        return _totals(rows, lambda x, p: group_sums(scaled(x), p, w), sums_size(d + 1))

    first = tell_apart(sums, d + 1)

    def histograms(x: np.ndarray, positive: np.ndarray) -> np.ndarray:
        bins = np.clip((scaled(x) @ first + _REACH) * (_BINS / (2 * _REACH)), 0, _BINS - 1).astype(int)
        return np.r_[np.bincount(bins, minlength=_BINS), np.bincount(bins[positive], minlength=_BINS)].astype(float)

    counts = _totals(rows, histograms, 2 * _BINS)
    prior = prior_of(counts[:_BINS], counts[_BINS:])
    w, _ = minimise(sums, d + 1, prior)
    weights = w[:-1] / spread
    return Model(tuple(map(float, weights)), float(w[-1] - weights @ mean), prior)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Measure every document once and fit on all of them."""
    return fit(shared.cut(measured(docs)), labels)


def judge(docs: DataFrame, model: Model, name: str = "_quality") -> DataFrame:
    """All rows and columns of ``docs`` with the score as column ``name``."""
    found = shared.text_append(docs, lambda texts: [measurements(t) for t in texts], "_measured", "array<double>")
    return found.withColumn(name, model.score("_measured")).drop("_measured")


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: ``doc_id, held_out, score, predicted``."""
    return scored(measured(docs), model)


def scored(found: DataFrame, model: Model) -> DataFrame:
    """``classify`` of documents that are measured already."""
    out = found.select("doc_id", shared.held_out("doc_id").alias("held_out"), model.score().alias("score"))
    return out.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))
