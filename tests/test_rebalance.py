"""Neighbours against brute force, and properties of oversampling."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowmill.operators import neighbors, rebalance


def brute(points, k):
    out = {}
    for i, (id_, v) in enumerate(points):
        others = sorted(
            (sum((a - b) ** 2 for a, b in zip(v, w)), j) for j, w in points if j != id_
        )
        out[id_] = [j for _, j in others[:k]]
    return out


def point_table(spark, points, kind="bigint"):
    return spark.createDataFrame(
        [(i, list(v), 1) for i, v in points], f"id {kind}, vec array<double>, copies bigint"
    ).repartition(6)


def clouds():
    rng = np.random.default_rng(3)
    yield "normal", rng.normal(size=(300, 3))
    grid = np.stack(np.meshgrid(range(15), range(15)), -1).reshape(-1, 2).astype(float)
    yield "grid with ties", grid
    yield "clusters", np.concatenate([rng.normal(size=(120, 2)) * 0.01, rng.normal(size=(120, 2)) * 50 + 100])
    yield "line", np.stack([np.arange(200.0), np.zeros(200)], -1)


@pytest.mark.parametrize("name,cloud", list(clouds()))
@pytest.mark.parametrize("cell_rows,part_rows,visitors", [(10_000, 2_000, 50_000), (30, 8, 15)])
def test_nearest_points(spark, monkeypatch, name, cloud, cell_rows, part_rows, visitors):
    monkeypatch.setattr(neighbors, "PART_ROWS", part_rows)
    points = [(i, tuple(map(float, v))) for i, v in enumerate(cloud)]
    near = neighbors.nearest_points(point_table(spark, points), 5, cell_rows, visitors)
    got = {r.id: [n.id for n in r.near] for r in near.collect()}
    assert got == brute(points, 5)


@pytest.mark.parametrize("name,cloud", list(clouds()))
def test_two_levels_of_cells(spark, monkeypatch, name, cloud):
    """With the driver held to a few coarse cells, the others are cut in tasks."""
    monkeypatch.setattr(neighbors, "ONE_LEVEL", 4)
    monkeypatch.setattr(neighbors, "PART_ROWS", 8)
    points = [(i, tuple(map(float, v))) for i, v in enumerate(cloud)]
    assert neighbors.coarse_cells(len(points) // 12 + 1) < 8
    near = neighbors.nearest_points(point_table(spark, points), 5, cell_rows=12, visitors=40)
    assert {r.id: [n.id for n in r.near] for r in near.collect()} == brute(points, 5)


def test_coarse_cells_grow_with_the_root():
    assert [neighbors.coarse_cells(n) for n in (1, 1_024, 1_025, 10**6, 10**8)] == [1, 1024, 1024, 1024, 10_000]


def test_cells_smaller_than_k(spark):
    points = [(i, (float(i * 7 % 53), float(i % 3))) for i in range(60)]
    near = neighbors.nearest_points(point_table(spark, points), 5, cell_rows=3)
    assert {r.id: [n.id for n in r.near] for r in near.collect()} == brute(points, 5)


def test_few_points_and_text_ids(spark):
    points = [("a", (0.0,)), ("b", (1.0,)), ("c", (5.0,))]
    near = neighbors.nearest_points(point_table(spark, points, "string"), 5)
    assert {r.id: [n.id for n in r.near] for r in near.collect()} == brute(points, 5)


def labelled(spark, n=400, hot=0):
    df = spark.range(n).select(
        "id",
        (F.col("id") % 10 == 0).cast("int").alias("y"),
        F.when(F.col("id") < hot, 1.0).otherwise(F.col("id") * 37 % 101).cast("double").alias("a"),
        F.when(F.col("id") < hot, 2).otherwise(F.col("id") * 13 % 17).cast("int").alias("b"),
    )
    return df


@pytest.mark.parametrize("hot", [0, 200])
def test_smote_balances(spark, hot):
    """Also with half of the minority rows being copies of one point."""
    df = labelled(spark, hot=hot)
    out = rebalance.smote(df, "id", "y", ["a", "b"], cell_rows=8)
    counts = {(r.y, r.synthetic): r["count"] for r in out.groupBy("y", "synthetic").count().collect()}
    assert counts == {(0, False): 360, (1, False): 40, (1, True): 320}


def test_smote_rows_lie_between_neighbours(spark):
    df = labelled(spark)
    made = rebalance.synthetic_rows(df, "id", "y", ["a", "b"], 1, 333).collect()
    assert len(made) == 333
    points = {(r.a, float(r.b)) for r in df.filter("y = 1").collect()}
    near = brute([(p, p) for p in sorted(points)], 5)

    def distance(p, q):
        return sum((x - y) ** 2 for x, y in zip(p, q))

    bases = {}
    for r in made:
        base, other = tuple(r.base), tuple(r.neighbor)
        # equally distant neighbours may stand in for each other
        assert other in points and 0 < distance(base, other) <= distance(base, near[base][-1])
        for x, lo, hi in zip(r.vec, np.minimum(base, other), np.maximum(base, other)):
            assert lo - 1e-9 <= x <= hi + 1e-9
        bases[base] = bases.get(base, 0) + 1
    assert set(bases.values()) == {8, 9}


def test_smote_is_repeatable(spark):
    df = labelled(spark)
    one = rebalance.smote(df.repartition(9), "id", "y", ["a", "b"]).collect()
    two = rebalance.smote(df.coalesce(1), "id", "y", ["a", "b"], cell_rows=5).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))


def test_smote_with_one_distinct_point(spark):
    df = labelled(spark).withColumn("a", F.lit(1.0)).withColumn("b", F.lit(2))
    out = rebalance.smote(df, "id", "y", ["a", "b"]).filter("synthetic")
    assert out.count() == 320 and out.distinct().count() == 1


def test_one_row_makes_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(rebalance, "BLOCK", 7)
    df = labelled(spark, 30)
    assert rebalance.synthetic_rows(df, "id", "y", ["a", "b"], 1, 100).count() == 100


def test_smote_needs_complete_rows(spark):
    df = labelled(spark)
    with pytest.raises(ValueError, match="missing"):
        rebalance.smote(df.withColumn("a", F.when(F.col("id") > 100, F.col("a"))), "id", "y", ["a"])
    with pytest.raises(ValueError, match="two rows"):
        rebalance.smote(df.filter("y = 0 or id = 10"), "id", "y", ["a"])
