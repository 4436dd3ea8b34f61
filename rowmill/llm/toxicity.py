"""Toxicity scores: a linear classifier over character n-grams scaled by naive
Bayes log-count ratios.

An n-gram's feature is whether a text holds it (white space as one space, letters
in lower case), hashed into BUCKETS.  Over the labelled rows Spark counts, for
each feature, the toxic and other texts that hold it.  Its log ratio is smoothed
in proportion to the classes, so a feature that few texts hold has a ratio near
zero.  Features whose ratio is surely not zero are kept, FEATURES of them at most,
and a logistic regression is fitted on the features times their ratios.  A text's
score adds up a table of weights.

Calibration: the labelled rows are dealt into two halves, and each is scored by
counts and a regression of the other; a line through these log-odds, fitted to
the labels, corrects those of the final weights, which its own rows have made too
sure.

Learning takes at most SAMPLE labelled rows outside the held-out part (in the
order of a hash); the driver gets the counts of FEATURES n-grams and, as flat
32-bit arrays, the kept features of those rows.  Every document is scored over its whole
text.

Edge cases: a null or empty text has no features and gets the score of the
intercept; without labels of both values the score is the share of label 1, or
0.5 without labels; halves without both labels leave the log-odds as they are; an
empty table gives an empty result; repeated rows get equal scores; rows without
doc_id are scored and not learnt from; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.llm.base import stage
from rowmill.llm.learning import labelled_texts, scored, sigmoid

PARTS, REMAINDER = 4, 2
SAMPLE = 20_000
SIZES = (4, 6, 8)
BUCKETS = 1 << 20
FEATURES = 1 << 13
MIN_TEXTS = 4
MIN_EVIDENCE = 12.0  # likelihood ratio statistic of the two-by-two table
SMOOTHING = 30.0
PENALTY, STEPS = 3e-4, 300
CHUNK = 1 << 20
BASE, MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
LINE_STEPS = 30


def _hashes(text: str | None):
    """The n-gram hashes of a text, part by part."""
    words = (text or "").lower().split()
    if not words:
        return
    line = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    for at in range(0, len(line), CHUNK):
        some = line[at : at + CHUNK + max(SIZES) - 1]
        gram = np.zeros(min(CHUNK, len(some)), np.uint64)
        for k in range(max(SIZES)):
            n = min(CHUNK, len(some) - k)
            if n <= 0:
                break
            # the next character of every n-gram that still fits
            gram = gram[:n] * BASE + some[k : k + n]
            if k + 1 in SIZES:
                yield (((gram + np.uint64(k + 1)) * MIX) >> np.uint64(44)).astype(np.int64)


def features(text: str | None, wanted: np.ndarray) -> np.ndarray:
    """The distinct buckets of a text for which wanted is true."""
    found = [h[wanted[h]] for h in _hashes(text)]
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)


def _counts(sample: DataFrame) -> DataFrame:
    """bucket, and in how many texts of the sample it occurs, by half (0, 1) and
    label: other0, toxic0, other1, toxic1."""

    def run(batches):
        cells = np.zeros((4, BUCKETS), np.int32)
        every = np.ones(BUCKETS, bool)
        for b in batches:
            rows = zip(b.column(0), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)
            for text, label, share in rows:
                cells[2 * _half(share) + int(label == 1), features(text.as_py(), every)] += 1
        met = np.flatnonzero(cells.any(axis=0))
        for at in range(0, len(met), 1 << 16):
            some = met[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)), *[pa.array(c[some]) for c in cells]], ["bucket", *CELLS]
            )

    # the sample is bounded, so are its tasks
    partial = sample.select("text", "label", "share").coalesce(6).mapInArrow(
        run, "bucket int, " + ", ".join(f"{c} int" for c in CELLS)
    )
    return partial.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in CELLS])


CELLS = ["other0", "toxic0", "other1", "toxic1"]


def _half(share):
    return share >= 0.5 if isinstance(share, np.ndarray) else int(share >= 0.5)


def _statistic(toxic, other, n_toxic: int, n_other: int, log, positive):
    """Likelihood ratio statistic of a two-by-two table; log and positive(x, y),
    y where x is above zero and else 0, make it one for columns and for arrays."""
    n = n_toxic + n_other
    rest = n - toxic - other
    cells = [
        (toxic, n_toxic, toxic + other), (other, n_other, toxic + other),
        (n_toxic - toxic, n_toxic, rest), (n_other - other, n_other, rest),
    ]
    return sum(positive(seen, lambda s=seen, r=row, c=column: 2 * s * log(s * n / (r * c))) for seen, row, column in cells)


def _column_positive(seen, value):
    return F.when(seen > 0, value()).otherwise(0.0)


def _array_positive(seen, value):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(seen > 0, value(), 0.0)


def _ratio(toxic: np.ndarray, other: np.ndarray, n_toxic: int, n_other: int) -> np.ndarray:
    """Log ratio of the shares of toxic and other texts that hold a feature."""
    a, b = SMOOTHING * n_toxic / (n_toxic + n_other), SMOOTHING * n_other / (n_toxic + n_other)
    return np.log((toxic + a) / (n_toxic + 2 * a)) - np.log((other + b) / (n_other + 2 * b))


def _chosen(toxic: np.ndarray, other: np.ndarray, n_toxic: int, n_other: int) -> np.ndarray:
    """Numbers of the features to learn with, at most FEATURES by their evidence."""
    evidence = _statistic(toxic, other, n_toxic, n_other, np.log, _array_positive)
    fit_ = np.flatnonzero((toxic + other >= MIN_TEXTS) & (evidence >= MIN_EVIDENCE))
    best = fit_[np.argsort(-evidence[fit_], kind="stable")[:FEATURES]]
    return np.sort(best)


def _fit(owner: np.ndarray, column: np.ndarray, y: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression: row owner[i] has feature column[i], worth its ratio."""
    n = len(y)
    value = ratio[column]
    w, bias = np.zeros(len(ratio)), float(np.log((y.mean() + 1e-9) / (1 - y.mean() + 1e-9)))
    first, second = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, STEPS + 1):
        error = sigmoid(np.bincount(owner, value * w[column], n) + bias) - y
        slope = np.bincount(column, value * error[owner], len(w)) / n + PENALTY * w
        g = np.append(slope, error.mean())
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        move = 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return w, bias


def _learn(held: dict, owner, column, y, rows: np.ndarray, halves) -> tuple[np.ndarray, float]:
    """Weights of all fetched features, and the intercept, from the rows marked."""
    toxic = sum(held[f"toxic{h}"] for h in halves).astype(np.float64)
    other = sum(held[f"other{h}"] for h in halves).astype(np.float64)
    n_toxic, n_other = int(y[rows].sum()), int((1 - y[rows]).sum())
    chosen = _chosen(toxic, other, n_toxic, n_other)
    place = np.full(len(toxic), -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    number = (np.cumsum(rows) - 1).astype(np.int32)
    used = rows[owner] & (place[column] >= 0)
    ratio = _ratio(toxic[chosen], other[chosen], n_toxic, n_other)
    w, bias = _fit(number[owner[used]], place[column[used]], y[rows], ratio)
    weights = np.zeros(len(toxic))
    weights[chosen] = w * ratio
    return weights, bias


def _line(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept that make log-odds fit the labels."""
    at = np.array([1.0, 0.0])
    x = np.stack([z, np.ones(len(z))])
    for _ in range(LINE_STEPS):  # Newton's method, with a little weight on the line as it is
        p = sigmoid(at @ x)
        slope = x @ (p - y) / len(y) + 1e-4 * (at - [1.0, 0.0])
        bend = (x * (p * (1 - p))) @ x.T / len(y) + 1e-4 * np.eye(2)
        at = at - np.linalg.solve(bend, slope)
        at[0] = min(max(at[0], 0.1), 10.0)
    return float(at[0]), float(at[1])


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """Weights of all buckets, and the intercept."""
    sample = labelled_texts(docs, labels, "toxic", PARTS, REMAINDER, SAMPLE, "toxicity-sample")
    sizes = dict(sample.groupBy("label").count().collect())
    n_toxic, n_other = sizes.get(1, 0), sum(n for k, n in sizes.items() if k != 1)
    weights = np.zeros(BUCKETS, np.float32)
    if not n_toxic or not n_other:
        share = 0.5 if not sizes else float(n_toxic > 0)
        return weights, float(np.log((share + 1e-9) / (1 - share + 1e-9)))
    toxic, other = (F.col(f"{k}0") + F.col(f"{k}1") for k in ("toxic", "other"))
    evidence = _statistic(
        toxic.cast("double"), other.cast("double"), n_toxic, n_other, F.log, _column_positive
    )
    counted = _counts(sample).where(toxic + other >= MIN_TEXTS).withColumn("evidence", evidence)
    # a half chooses among the most telling of both
    best = counted.where(F.col("evidence") >= MIN_EVIDENCE).orderBy(F.desc("evidence"), "bucket")
    best = stage(best.limit(FEATURES), "toxicity-features").toArrow()
    order = np.argsort(best["bucket"].to_numpy())
    buckets = best["bucket"].to_numpy()[order]
    held = {c: best[c].to_numpy()[order] for c in CELLS}
    wanted = np.zeros(BUCKETS, bool)
    wanted[buckets] = True

    def run(batches):
        for b in batches:
            found = [features(t.as_py(), wanted) for t in b.column(0)]
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
            flat = np.concatenate(found) if found else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32))), b.column(1), b.column(2)],
                ["found", "label", "share"],
            )

    rows = sample.mapInArrow(run, "found array<int>, label int, share double").orderBy("share", "label", "found").toArrow()
    lists = rows["found"].combine_chunks()
    owner = np.repeat(np.arange(len(lists), dtype=np.int32), lists.value_lengths().to_numpy())
    column = np.searchsorted(buckets, lists.flatten().to_numpy()).astype(np.int32)
    y = (rows["label"].to_numpy() == 1).astype(np.float64)
    half = _half(rows["share"].to_numpy()).astype(int)
    w, bias = _learn(held, owner, column, y, np.ones(len(y), bool), (0, 1))
    if all(0 < y[half == h].sum() < (half == h).sum() for h in (0, 1)):
        z = np.empty(len(y))
        for h in (0, 1):
            other_w, other_bias = _learn(held, owner, column, y, half != h, (1 - h,))
            total = np.bincount(owner, other_w[column], len(y)) + other_bias
            z[half == h] = total[half == h]
        a, b = _line(z, y)
        w, bias = a * w, a * bias + b
    weights[buckets] = w
    return weights, float(bias)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    weights, bias = fit(docs, labels)
    model = docs.sparkSession.sparkContext.broadcast((weights, weights != 0, bias))  # BUCKETS values

    def score(texts):
        table, wanted, base = model.value
        return sigmoid(np.array([base + float(table[features(t, wanted)].sum()) for t in texts]))

    return scored(docs, score, PARTS, REMAINDER)
