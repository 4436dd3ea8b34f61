"""Quality scores from random-indexing word vectors and a small network.

Word vectors.  Tokens are words and single punctuation marks, hashed into
VOCABULARY slots.  Every slot has a fixed sparse vector of a few +1 and -1; a
slot's word vector is the sum of those of the neighbours of its tokens over all
documents.  A task adds up its documents in one array of fixed size and emits the
slots it met; Spark sums them, so the shuffle grows with the number of tasks and
not with the text.

Documents.  The vectors of a document's tokens are pooled: weighted mean, mean
square, and the mean likeness of neighbours.  A two-layer network, trained with
numpy, turns that into a logit, whose temperature is set on rows that the
training did not see.

Learning takes at most SAMPLE labelled rows outside the held-out part (in the
order of a hash); word vectors take all documents.  No document is sent to the
driver, only the slot table, at most SAMPLE pooled vectors, and the network.

Edge cases: a null, empty or wordless text has the zero vector and gets its
score; without labels of both values the score is the share of label 1, or 0.5
without labels; an empty table gives an empty result; repeated rows get equal
scores; rows without doc_id are scored and not learnt from; other columns are
not read.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.llm.learning import labelled_texts, scored, sigmoid

PARTS, REMAINDER = 5, 0
SAMPLE = 20_000
VOCABULARY, DIMENSIONS, NONZERO, REACH = 1 << 15, 32, 4, 2
COMMON = 1e-3
TOKEN = re.compile(r"\w+|[^\w\s]")
CHUNK = 200_000
HIDDEN, EPOCHS = 16, 60

_slots: dict[str, int] = {}


def _index_vectors():
    """Places and signs of the fixed sparse vectors."""
    draw = np.random.default_rng(20)
    places = draw.integers(0, DIMENSIONS, (VOCABULARY, NONZERO))
    return places, draw.choice(np.array([-1.0, 1.0]), (VOCABULARY, NONZERO))


def slots_of(text: str | None) -> np.ndarray:
    tokens = TOKEN.findall(text or "")
    if len(_slots) > 400_000:
        _slots.clear()
    for t in set(tokens).difference(_slots):
        _slots[t] = zlib.crc32(t.encode("utf-8", "surrogatepass")) % VOCABULARY
    return np.fromiter(map(_slots.__getitem__, tokens), np.int64, len(tokens))


def word_vectors(docs: DataFrame):
    """(unit vectors, token shares) of all slots, from all documents."""
    columns = [f"d{i}" for i in range(DIMENSIONS)]

    def run(batches):
        places, signs = _index_vectors()
        sums = np.zeros(VOCABULARY * DIMENSIONS)
        counts = np.zeros(VOCABULARY, np.int64)

        def add(slots, owner):
            counts[:] += np.bincount(slots, minlength=VOCABULARY)
            for step in range(1, REACH + 1):
                near = owner[:-step] == owner[step:]
                a, b = slots[:-step][near], slots[step:][near]
                for one, other in ((a, b), (b, a)):
                    base = one * DIMENSIONS
                    for k in range(NONZERO):
                        sums[:] += np.bincount(base + places[other, k], signs[other, k], len(sums))

        for b in batches:
            held, owners, size = [], [], 0
            for k, text in enumerate(b.column(0)):
                slots = slots_of(text.as_py())
                held.append(slots)
                owners.append(np.full(len(slots), k))
                size += len(slots)
                if size > 10 * CHUNK:
                    add(np.concatenate(held), np.concatenate(owners))
                    held, owners, size = [], [], 0
            if size:
                add(np.concatenate(held), np.concatenate(owners))
        met = np.flatnonzero(counts)
        if len(met):
            table = sums.reshape(VOCABULARY, DIMENSIONS)[met].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(met), pa.array(counts[met])] + [pa.array(table[:, i].copy()) for i in range(DIMENSIONS)],
                ["slot", "n"] + columns,
            )

    schema = "slot long, n long, " + ", ".join(f"{c} long" for c in columns)
    partial = docs.select("text").mapInArrow(run, schema)
    found = partial.groupBy("slot").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in columns]).toArrow()
    vectors, counts = np.zeros((VOCABULARY, DIMENSIONS), np.float32), np.zeros(VOCABULARY)
    slot = found["slot"].to_numpy()
    vectors[slot] = np.column_stack([found[c].to_numpy() for c in columns]) if len(slot) else 0
    counts[slot] = found["n"].to_numpy()
    # what all words share tells nothing
    share = counts / max(1.0, counts.sum())
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    vectors -= (share[:, None] * vectors).sum(axis=0, dtype=np.float64).astype(np.float32)
    vectors[counts == 0] = 0
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    return vectors, share


def pooled(text: str | None, vectors: np.ndarray, weights: np.ndarray) -> np.ndarray:
    slots, d = slots_of(text), vectors.shape[1]
    out = np.zeros(2 * d + 3)
    total, near = 0.0, 0.0
    for at in range(0, len(slots), CHUNK):
        some = slots[at : at + CHUNK]
        x, w = vectors[some], weights[some]
        out[:d] += w @ x
        out[d : 2 * d] += w @ (x * x)
        near += float((x[1:] * x[:-1]).sum())
        total += float(w.sum())
    if len(slots):
        out[: 2 * d] /= max(total, 1e-9)
        out[2 * d] = near / len(slots)
        out[2 * d + 1] = total / len(slots)
        out[2 * d + 2] = np.log1p(len(slots))
    return out


class Network:
    """Input, one hidden layer of tanh units, one logit over a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, share: np.ndarray):
        self.constant = None
        if len(np.unique(y)) < 2:
            self.constant = float(y.mean()) if len(y) else 0.5
            return
        fit = share < 0.8
        if len(np.unique(y[fit])) < 2 or len(np.unique(y[~fit])) < 2:
            fit = np.ones(len(y), bool)
        self.middle, self.spread = x[fit].mean(axis=0), x[fit].std(axis=0) + 1e-6
        self.temperature = 1.0
        self._train(self._scaled(x[fit]), y[fit])
        rest = ~fit if not fit.all() else fit
        logits, truth = self.logits(x[rest]), y[rest]
        grid = np.exp(np.linspace(-2, 3, 101))
        loss = [np.mean(np.logaddexp(0, logits / t) - truth * logits / t) for t in grid]
        self.temperature = float(grid[int(np.argmin(loss))])

    def _scaled(self, x):
        return np.clip((x - self.middle) / self.spread, -8, 8)

    def _train(self, x, y):
        draw = np.random.default_rng(5)
        n, d = x.shape
        self.p = [
            draw.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN),
            draw.normal(0, HIDDEN**-0.5, HIDDEN), np.array(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))),
        ]
        first, second, step = [np.zeros_like(p) for p in self.p], [np.zeros_like(p) for p in self.p], 0
        for _ in range(EPOCHS):
            order = draw.permutation(n)
            for at in range(0, n, 128):
                some = order[at : at + 128]
                h = np.tanh(x[some] @ self.p[0] + self.p[1])
                error = (sigmoid(h @ self.p[2] + self.p[3]) - y[some]) / len(some)
                back = np.outer(error, self.p[2]) * (1 - h * h)
                slopes = [x[some].T @ back + 1e-4 * self.p[0], back.sum(0), h.T @ error + 1e-4 * self.p[2], error.sum()]
                step += 1
                for k, g in enumerate(slopes):
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.p[k] = self.p[k] - 3e-3 * (first[k] / (1 - 0.9**step)) / (
                        np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8
                    )

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(self._scaled(x) @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return sigmoid(self.logits(x) / self.temperature)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    context = docs.sparkSession.sparkContext
    vectors, share = word_vectors(docs)
    weights = (COMMON / (COMMON + share)).astype(np.float32)
    table = context.broadcast((vectors, weights))  # VOCABULARY rows, whatever the input

    def features(batches):
        for b in batches:
            x = [pooled(t, *table.value) for t in b.column(0).to_pylist()]
            flat = pa.array(np.concatenate(x) if x else np.empty(0))
            width = len(x[0]) if x else 1
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * width)
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(offsets, flat), b.column(1), b.column(2)], ["x", "label", "share"]
            )

    sample = labelled_texts(docs, labels, "quality", PARTS, REMAINDER, SAMPLE, "quality-sample")
    rows = sample.mapInArrow(features, "x array<double>, label int, share double").toArrow()
    x = rows["x"].combine_chunks().flatten().to_numpy().reshape(len(rows), -1) if len(rows) else np.empty((0, 1))
    # the order of the rows must not depend on the order of tasks
    y, part = rows["label"].to_numpy().astype(np.float64), rows["share"].to_numpy()
    order = np.lexsort([*x.T[:4], y, part]) if len(y) else np.empty(0, np.int64)
    net = context.broadcast(Network(x[order], y[order], part[order]))

    def score(texts):
        if not texts:
            return np.empty(0)
        return net.value.probabilities(np.array([pooled(t, *table.value) for t in texts]))

    return scored(docs, score, PARTS, REMAINDER)
