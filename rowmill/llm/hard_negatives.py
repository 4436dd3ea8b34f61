"""Hard negatives by coordinate pruning over length buckets.

Every vector becomes integers, floor(256 x).  Rows of one label (and dimension)
are sorted by length and cut into buckets of at most BUCKET_ROWS.  Anchors, in
chunks of at most CHUNK_ROWS, meet the buckets in two passes: those of their own
label give each anchor its best rows, the positives; those of the other labels
give the best rows inside the score window of each positive.

In a bucket a bound on the score is a bound on the cosine, since no row is longer
than the bucket's longest.  From it follows, for each of an anchor's FOCUS largest
coordinates, the range that a row's unit coordinate must lie in: with angles a
and b of anchor and row to that axis, the cosine is at most cos(a - b).  The
bucket's sorted list of the coordinate gives the rows in range by two binary
searches; the shortest list is intersected with the ranges of the other focus
coordinates, and what is left is verified by its exact integer score.  The bound
is the window's lower end, or better, once the SEEDS rows that lead the sorted
list of the anchor's largest coordinate have given as many answers as are wanted.
Where the bound is no help (a score of zero or less), all rows are verified.

Volume: rows are written once for each chunk of anchors, anchors once for each
bucket they visit; a task holds one bucket and one chunk, and emits at most the
wanted rows for each anchor.  Best rows of several buckets are ranked by a window
that cuts before it shuffles.  Rows equal in label and vector are candidates only
by their smallest few vec_ids, which is all that a ranking with ties by vec_id
can return.

Edge cases: rows without vec_id or label, and vectors that are null or hold null
or non-finite components, take no part; rows equal in vec_id, label and vector
are one; other rows with one vec_id stay, and are no "other rows" to each other;
vectors of different length have no score; components beyond 64 bits become the
nearest 64-bit integer, and so do scores after ranking; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rowmill.llm.base import small_join, stage

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
BUCKET_ROWS, CHUNK_ROWS = 8_192, 4_096
FOCUS, SEEDS = 3, 64
EXACT = 1 << 53
LONG = (-(1 << 63), (1 << 63) - 1)
MARGIN = 1e-9
MOST_TASKS, TASK_BUCKETS = 4_096, 4


def quantised(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label, q (array of longs), dims: the rows that take part."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    usable = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return (
        rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(usable)
        .select("vec_id", F.col("label").cast("long").alias("label"),
                F.transform(x, lambda v: F.floor(v * scale)).alias("q"))
        .distinct().withColumn("dims", F.size("q"))
    )


def _length() -> Column:
    return F.sqrt(F.aggregate("q", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))


def bucketed(rows: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The rows that can be an answer, with `bucket`: rows of one label and
    dimension, next to each other in length."""
    first = W.partitionBy("label", "q").orderBy("vec_id")
    few = rows.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= POSITIVES + 1).drop("_n")
    order = ["dims", "label", F.desc("length"), "vec_id"]
    # the number of tasks follows the rows, so the number of buckets does too
    tasks = -(-rows.count() // (TASK_BUCKETS * bucket_rows)) or 1
    sized = few.withColumn("length", _length()).repartitionByRange(tasks, *order).sortWithinPartitions(*order)

    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held, before = 0, None
        for b in batches:
            names = b.schema.names
            keys = list(zip(b["dims"].to_pylist(), b["label"].to_pylist(), strict=True))
            buckets = np.empty(len(keys), np.int64)
            for i, key in enumerate(keys):
                if before is not None and (key != before or held == bucket_rows):
                    number, held = number + 1, 0
                buckets[i], before, held = number, key, held + 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(buckets)], [*names, "bucket"])

    fields = "vec_id long, label long, q array<long>, dims int, length double, bucket long"
    ids = sized.select(F.col("vec_id").cast("long"), "label", "q", "dims", "length")
    return stage(ids.mapInArrow(run, fields), "buckets")


class Bucket:
    """One bucket's vectors with sorted lists of their unit coordinates."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.floats = vectors.astype(np.float64)
        lengths = np.sqrt((self.floats**2).sum(axis=1))
        self.longest = lengths.max(initial=0.0)
        # a zero vector has no direction; its score is zero and no positive bound admits it
        self.unit = self.floats / np.where(lengths > 0, lengths, 1.0)[:, None]
        self.widest = int(np.abs(self.floats).max(initial=0))
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_list(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """Values of a unit coordinate in order, and the rows they belong to."""
        if f not in self.lists:
            order = np.argsort(self.unit[:, f], kind="stable")
            self.lists[f] = (self.unit[order, f], order)
        return self.lists[f]

    def scores(self, anchor: np.ndarray, rows: np.ndarray | slice) -> np.ndarray:
        """Exact integer scores."""
        if self.widest * int(np.abs(anchor.astype(np.float64)).max(initial=0)) * max(len(anchor), 1) < EXACT:
            return (self.floats[rows] @ anchor.astype(np.float64)).astype(np.int64)
        a = [int(v) for v in anchor]
        exact = [sum(x * int(y) for x, y in zip(a, v, strict=True)) for v in self.vectors[rows]]
        return np.array(exact, dtype=object)

    def feasible(self, anchor: np.ndarray, least: float) -> np.ndarray | slice:
        """Rows that may score `least` or more."""
        everything = slice(None)
        norm = float(np.sqrt((anchor.astype(np.float64) ** 2).sum()))
        if least <= 0 or norm == 0 or self.longest == 0:
            return everything
        cosine = float(least) / (norm * self.longest)
        if cosine > 1 + MARGIN:
            return np.zeros(0, np.int64)
        reach = np.arccos(min(1.0, cosine))
        unit = np.clip(anchor.astype(np.float64) / norm, -1, 1)
        ranges = []
        for f in np.argsort(-np.abs(unit), kind="stable")[:FOCUS]:
            angle = np.arccos(unit[f])
            low, high = np.cos(min(np.pi, angle + reach)) - MARGIN, np.cos(max(0.0, angle - reach)) + MARGIN
            values, order = self.sorted_list(int(f))
            s, e = np.searchsorted(values, low, "left"), np.searchsorted(values, high, "right")
            ranges.append((e - s, int(f), low, high, order[s:e]))
        ranges.sort(key=lambda r: r[:2])
        if ranges[0][0] > len(self.ids) // 2:
            return everything  # most rows are in range: a plain scan costs less than gathering them
        found = ranges[0][4]
        for _, f, low, high, _ in ranges[1:]:
            column = self.unit[found, f]
            found = found[(column >= low) & (column <= high)]
        return found

    def leaders(self, anchor: np.ndarray) -> np.ndarray:
        """The SEEDS rows that lead on the anchor's largest coordinate."""
        if not len(anchor):
            return np.zeros(0, np.int64)
        f = int(np.argmax(np.abs(anchor.astype(np.float64))))
        order = self.sorted_list(f)[1]
        return order[-SEEDS:] if anchor[f] > 0 else order[:SEEDS]

    def best(self, anchor: np.ndarray, anchor_id: int, k: int, windows: list) -> list[list[tuple[int, int]]]:
        """For each (low, high) the (score, vec_id) of the best k rows, other than
        the anchor's own, with low <= score <= high; None is no limit."""
        seeds = self._pick(anchor, anchor_id, k, windows, self.leaders(anchor))
        bounds = [found[-1][0] if len(found) == k else low for found, (low, _) in zip(seeds, windows, strict=True)]
        least = 0 if None in bounds else min(bounds)
        return self._pick(anchor, anchor_id, k, windows, self.feasible(anchor, least))

    def _pick(self, anchor, anchor_id, k, windows, rows):
        ids, scores = self.ids[rows], self.scores(anchor, rows)
        if (ids == anchor_id).any():
            ids, scores = ids[ids != anchor_id], scores[ids != anchor_id]
        return [_first(ids, scores, k, *limits) for limits in windows]


def _first(ids, scores, k, low, high):
    if low is not None:
        fit = (scores >= low) & (scores <= high)
        ids, scores = ids[fit], scores[fit]
    if len(ids) > 4 * k and scores.dtype != object:
        top = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        ids, scores = ids[top], scores[top]
    found = sorted(zip((-s for s in scores.tolist()), ids.tolist(), strict=True))[:k]
    return [(-s, i) for s, i in found]


def window(positive: int) -> tuple[int, int]:
    """Lowest and highest score n with 50 p <= 100 n <= 95 p."""
    return -(-50 * positive // 100), 95 * positive // 100


def _vectors(table: pa.Table) -> np.ndarray:
    lists = table["q"].combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _held(score: int) -> int:
    return min(max(score, LONG[0]), LONG[1])


def _chunk(rows: DataFrame, keys: list[str], most: int, name: str) -> DataFrame:
    """Deal the rows of each key evenly into as many chunks as keep to `most`."""
    counts = stage(rows.groupBy(*keys).agg(F.ceil(F.count("*") / most).cast("int").alias("_of")), "chunk-counts")
    dealt = F.pmod(F.xxhash64("anchor_id", "q"), F.col("_of")).cast("int")
    return small_join(rows, counts, keys).withColumn(name, dealt).drop("_of")


def _meet(anchors: DataFrame, buckets: DataFrame, own_label: bool, find, result: str) -> DataFrame:
    """Bring every chunk of anchors to the buckets of its dimension that hold its
    own label, or the other labels, and call find(bucket, anchor row, vector)
    there.  Anchors whose least score no row of a bucket is long enough for stay
    away from it."""
    keys = ["dims", "label"] if own_label else ["dims"]
    chunks = stage(anchors.groupBy(*keys).agg(F.max("chunk").alias("last")), "last-chunks")
    sizes = buckets.groupBy("bucket").agg(
        F.first("dims").alias("dims"), F.first("label").alias("label"), F.max("length").alias("longest")
    )
    pairs = stage(
        small_join(sizes, chunks, keys).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("last")))).drop("last"),
        "visits",
    )
    on = [anchors["dims"] == pairs["dims"], anchors["chunk"] == pairs["chunk"]]
    reachable = (F.col("least") <= 0) | (F.col("least") <= anchors["length"] * pairs["longest"] * (1 + MARGIN))
    same = anchors["label"] == pairs["label"]
    on += [same if own_label else ~same, reachable]
    left = anchors.join(pairs, on).select(*[anchors[c] for c in anchors.columns], pairs["bucket"])
    right = buckets.select("bucket", "vec_id", "q").join(pairs.select("bucket", "chunk"), "bucket")
    n = max(1, min(3 * pairs.count(), MOST_TASKS))  # a number given is not merged by bytes: this is work by CPU

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        out = []
        if a.num_rows and b.num_rows:
            bucket = Bucket(b["vec_id"].to_numpy(), _vectors(b))
            for row, vector in zip(a.drop_columns(["q"]).to_pylist(), _vectors(a), strict=True):
                out += find(bucket, row, vector)
        columns = zip(*out, strict=True) if out else [[]] * len(names)
        return pa.table(dict(zip(names, columns, strict=True)), schema=schema)

    names = [part.split()[0] for part in result.split(", ")]
    schema = pa.schema([(n, pa.int64()) for n in names])
    by = ["bucket", "chunk"]
    return (
        left.repartition(n, *by).groupBy(*by).cogroup(right.repartition(n, *by).groupBy(*by))
        .applyInArrow(run, result)
    )


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         bucket_rows: int = BUCKET_ROWS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    rows: as quantised() gives them; is_anchor: a column that marks the anchors."""
    if max(positives, negatives) > POSITIVES:
        raise ValueError(f"at most {POSITIVES} positives and negatives")
    rows = stage(rows, "vectors")
    buckets = bucketed(rows, bucket_rows)
    anchors = stage(
        rows.where(is_anchor).select(
            F.monotonically_increasing_id().alias("anchor"), F.col("vec_id").cast("long").alias("anchor_id"),
            "label", "q", "dims", _length().alias("length"), F.lit(0.0).alias("least"),
        ), "anchors",
    )

    def own(bucket, row, vector):
        (found,) = bucket.best(vector, row["anchor_id"], positives, [(None, None)])
        return [(row["anchor"], row["anchor_id"], _held(s), i) for s, i in found]

    ranked = W.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    found = "anchor long, anchor_id long, positive_score long, positive_id long"
    best = stage(
        _meet(_chunk(anchors, ["dims", "label"], chunk_rows, "chunk"), buckets, True, own, found)
        .withColumn("_n", F.row_number().over(ranked)).where(F.col("_n") <= positives).drop("_n"), "positives",
    )
    scores = best.groupBy("anchor").agg(
        F.sort_array(F.collect_set("positive_score")).alias("scores"),
        (F.min("positive_score") / 2).alias("least"),
    )
    asking = stage(anchors.drop("least").join(scores, "anchor"), "asking")

    def other(bucket, row, vector):
        asked = [p for p in row["scores"] if p >= 0]  # below zero no score is in the window
        found = bucket.best(vector, row["anchor_id"], negatives, [window(p) for p in asked]) if asked else []
        return [(row["anchor"], p, _held(s), i) for p, few in zip(asked, found, strict=True) for s, i in few]

    found = "anchor long, positive_score long, negative_score long, negative_id long"
    ranked = W.partitionBy("anchor", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    hard = (
        _meet(_chunk(asking, ["dims"], chunk_rows, "chunk"), buckets, False, other, found)
        .withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= negatives)
    )
    return best.join(hard, ["anchor", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


__all__ = ["quantised", "bucketed", "Bucket", "mine", "window"]
