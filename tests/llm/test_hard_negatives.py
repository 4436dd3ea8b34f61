"""Hard negatives against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowmill.llm import hard_negatives


def brute(rows, every):
    clean = {
        (i, label, tuple(math.floor(256 * float(x)) for x in v))
        for i, label, v in rows
        if i is not None and label is not None and v is not None
        and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for i, label, q in clean:
        if i % every:
            continue
        scored = [(-sum(map(int.__mul__, q, w)), j, own) for j, own, w in clean if len(w) == len(q)]
        same = sorted((s, j) for s, j, own in scored if own == label and j != i)[:5]
        other = sorted((s, j) for s, j, own in scored if own != label)
        for s, j in same:
            fit = [(n, k) for n, k in other if 50 * -s <= 100 * -n <= 95 * -s][:3]
            out += [(i, j, rank, k, -s, -n) for rank, (n, k) in enumerate(fit, 1)]
    return sorted(out)


def made_up(seed):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.4) for _ in range(6)] for _ in range(12)]
    rows = []
    for i in range(-20, 300):
        centre = rng.choice(centres)
        spread = rng.choice([0, 0.05])
        rows.append((i * 5, rng.choice([0, 0, 0, 1, 2, None]), [x + rng.gauss(0, spread) for x in centre]))
    bad = [[0.0] * 6, None, [float("nan")] * 6, [None] * 6, [float("inf")] + [0.0] * 5]
    rows += [(100 + 50 * i, 1, v) for i, v in enumerate(bad)]
    rows += [(400, 0, []), (450, 0, []), (500, 1, []), (None, 1, centres[0])]
    return rows + rows[:40]  # repeated rows


@pytest.mark.parametrize("bucket_rows,chunk_rows", [(8192, 4096), (16, 3)])
def test_against_brute_force(spark, bucket_rows, chunk_rows):
    rows = made_up(1)
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumn("dims", F.lit("x"))
    got = hard_negatives.mine(
        hard_negatives.quantised(df), F.col("vec_id") % 50 == 0, bucket_rows=bucket_rows, chunk_rows=chunk_rows
    )
    expected = brute(rows, 50)
    assert len(expected) > 100
    assert sorted(tuple(r) for r in got.collect()) == expected


def test_copies_and_a_hot_label(spark):
    """A third of the rows are copies of one vector, two thirds have one label."""
    rows = [(i, 0, [0.5, 0.25]) for i in range(300)] + [(1000 + i, 0, [0.01 * i, 0.3]) for i in range(300)]
    rows += [(2000 + i, 1, [0.3, 0.001 * i]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = hard_negatives.mine(hard_negatives.quantised(df), F.col("vec_id") % 50 == 0, bucket_rows=100)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 50)
    buckets = hard_negatives.bucketed(hard_negatives.quantised(df), 100)
    assert buckets.groupBy("bucket").count().agg(F.max("count")).first()[0] <= 100
    assert buckets.where("q[0] = 128 AND q[1] = 64").count() == hard_negatives.POSITIVES + 1


def test_beyond_exact_floats(spark):
    """Products past 53 bits are added up as whole numbers."""
    rows = [(0, 0, [3e5, 1e5]), (1, 0, [3e5, 1e5 + 1 / 256]), (2, 1, [2.5e5, 1.00000390625e5]), (3, 1, [2.5e5, 1e5])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = hard_negatives.mine(hard_negatives.quantised(df), F.col("vec_id") % 50 == 0)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 50)


def test_pruning_leaves_no_row_out():
    """Rows that reach a bound are among the feasible ones, which are few where vectors crowd."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 16))
    centres /= np.linalg.norm(centres, axis=1)[:, None]  # a bucket holds rows of about one length
    vectors = np.floor(256 * (centres[rng.integers(40, size=2000)] + 0.02 * rng.normal(size=(2000, 16)))).astype(int)
    bucket = hard_negatives.Bucket(np.arange(2000), vectors)
    shares = []
    for anchor in vectors[:60]:
        scores = bucket.scores(anchor, slice(None))
        least = int(0.95 * scores.max())
        rows = np.arange(2000)[bucket.feasible(anchor, least)]
        assert set(np.flatnonzero(scores >= least)) <= set(rows)
        shares.append(len(rows) / 2000)
    assert np.mean(shares) < 0.3
    assert len(bucket.feasible(vectors[0], 1e12)) == 0


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert hard_negatives.mine(hard_negatives.quantised(df), F.col("vec_id") % 50 == 0).collect() == []
