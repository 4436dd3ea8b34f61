"""Exact quantiles, hash ordering and ranks against brute force."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowmill.functions import ordering, quantiles
from rowmill.functions.columns import is_missing, numeric_columns
from rowmill.functions.scalar import clip, even_grid, first_match, percent_text
from rowmill.operators import split

PROBABILITIES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


def tables():
    rng = np.random.default_rng(7)
    yield "normal", rng.normal(size=3000)
    yield "few values", rng.integers(0, 4, 3000).astype(float)
    yield "one hot value", np.where(rng.random(3000) < 0.4, 5.0, rng.normal(size=3000) * 100)
    yield "heavy tail", np.exp(rng.normal(size=3000) * 8)
    yield "single", np.array([3.25])
    yield "two", np.array([1.0, 2.0])


@pytest.mark.parametrize("name,values", list(tables()))
@pytest.mark.parametrize("bits,fetch", [(16, 50_000), (16, 0), (13, 10)])
def test_exact_quantiles(spark, monkeypatch, name, values, bits, fetch):
    """With nothing, or little, to fetch the search takes all its passes."""
    monkeypatch.setattr(quantiles, "DIGIT_BITS", bits)
    monkeypatch.setattr(quantiles, "FETCH_ROWS", fetch)
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(5)
    found = quantiles.exact_quantiles(df, ["x"], PROBABILITIES)["x"]
    np.testing.assert_allclose(found, np.quantile(values, PROBABILITIES), rtol=1e-12)


def test_quantiles_of_many_columns_share_one_budget(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "FETCH_ROWS", 600)
    names = [f"c{i}" for i in range(40)]
    df = spark.range(6000).select(
        *[(F.col("id") * (2 * i + 3) % 6007).cast("double").alias(c) for i, c in enumerate(names)]
    )
    kind, fetched = type(df), []
    collect = kind.collect

    def counted(self):
        rows = collect(self)
        fetched.append(len(rows))
        return rows

    monkeypatch.setattr(kind, "collect", counted)
    found = quantiles.exact_quantiles(df, names, [0.25, 0.5, 0.75])
    assert max(fetched) <= 600
    monkeypatch.undo()
    table = df.toPandas()
    for c in names:
        np.testing.assert_allclose(found[c], np.quantile(table[c], [0.25, 0.5, 0.75]), rtol=1e-12)


def test_quantiles_read_the_source_once(spark, monkeypatch):
    """Every value is computed once, and the codes are scanned at most five times."""
    monkeypatch.setattr(quantiles, "FETCH_ROWS", 0)
    met, scans = spark.sparkContext.accumulator(0), []

    def noted(batches):
        for b in batches:
            met.add(len(b))
            yield b

    counted = quantiles._counted
    monkeypatch.setattr(quantiles, "_counted", lambda *given: scans.append(1) or counted(*given))
    df = spark.range(5000).select((F.col("id") % 700).cast("double").alias("x"), F.lit(3.0).alias("y"))
    found = quantiles.exact_quantiles(df.mapInPandas(noted, "x double, y double"), ["x", "y"], [0.25, 0.5])
    assert found["y"] == [3.0, 3.0] and met.value == 5000
    assert 1 + len(scans) <= 5  # the first scan counts present values


def test_order_codes():
    values = np.array([-np.inf, -1e300, -1.5, -1e-310, -0.0, 0.0, 5e-324, 1.0, 1e300, np.inf])
    codes = quantiles.order_codes(values)
    assert (np.diff(codes) >= 0).all() and codes[4] == codes[5]
    assert [quantiles.code_value(int(c)) for c in codes] == [*values[:4], 0.0, 0.0, *values[6:]]


def test_quantiles_leave_missing_values_out(spark):
    rows = [(1.0, 1), (float("nan"), 2), (None, 3), (3.0, None)]
    df = spark.createDataFrame(rows, "x double, n int")
    found = quantiles.exact_quantiles(df, ["x", "n"], [0.5])
    assert found == {"x": [2.0], "n": [2.0]}


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert quantiles.exact_quantiles(df, ["x"], [0.5]) == {"x": [None]}
    assert quantiles.exact_quantiles(df.limit(0), ["x"], [0.5]) == {"x": [None]}


def brute_order(keys, seed=42):
    def h(k):
        return int(hashlib.md5(f"{seed}:{k}".encode()).hexdigest()[:8], 16)

    return sorted(keys, key=lambda k: (h(k), k))


@pytest.mark.parametrize("fetch", [20_000, 3])
def test_hash_cuts(spark, monkeypatch, fetch):
    monkeypatch.setattr(ordering, "FETCH_ROWS", fetch)
    rows = [(k, "a" if k % 3 else ("b" if k % 2 else None)) for k in range(5000)]
    df = spark.createDataFrame(rows, "k bigint, s string").repartition(7)
    found = ordering.hash_cuts(df, "k", lambda n: [0, 1, n // 2, n], "s")
    assert {f.value for f in found} == {"a", "b", None}
    for f in found:
        keys = brute_order([k for k, s in rows if s == f.value])
        n = len(keys)
        assert f.rows == n
        assert f.cuts[0] is None
        assert [c.key for c in f.cuts[1:]] == [keys[0], keys[n // 2 - 1], keys[n - 1]]


def test_text_keys(spark):
    df = spark.createDataFrame([(f"k{i}",) for i in range(500)], "k string")
    got = {r.k for r in split.sample_rows(df, 77, "k").collect()}
    assert got == set(brute_order([f"k{i}" for i in range(500)])[:77])


def test_too_many_strata_use_ranks(spark):
    df = spark.createDataFrame([(i, i % 500) for i in range(5000)], "k bigint, s int")
    with pytest.raises(ordering.TooManyStrata):
        ordering.hash_cuts(df, "k", lambda n: [1], "s")
    parts = split.stratified_split(df, "k", "s", 0.3)
    counts = parts.filter("split = 'test'").groupBy("s").count().collect()
    assert len(counts) == 500 and {r["count"] for r in counts} == {3}
    folds = split.stratified_folds(df, "k", "s", 3).groupBy("s", "fold").count().collect()
    assert len(folds) == 1500 and {r["count"] for r in folds} == {3, 4}


def test_repeated_and_null_keys_split_alike_on_both_paths(spark, monkeypatch):
    rows = [(None if i % 3 == 0 else i % 70, i, i % 4 if i % 9 else None) for i in range(1200)]
    df = spark.createDataFrame(rows, "k bigint, i bigint, s int").repartition(5)

    def result():
        parts = split.stratified_split(df, "k", "s", 0.35)
        folds = split.stratified_folds(parts, "k", "s", 5)
        return folds.schema, {(r.i, r.split, r.fold) for r in folds.collect()}

    by_cuts = result()
    assert len(by_cuts[1]) == 1200
    sides = {(k, s): side for (k, i, s), (_, side, _) in zip(rows, sorted(by_cuts[1]))}
    assert all(sides[rows[i][0], rows[i][2]] == side for i, side, _ in by_cuts[1])
    monkeypatch.setattr(ordering, "MAX_STRATA", 2)
    assert result() == by_cuts


def test_cuts_bring_a_bounded_number_of_rows_to_the_driver(spark, monkeypatch):
    """60 strata with 5 ends of folds each share one budget."""
    monkeypatch.setattr(ordering, "FETCH_ROWS", 2_000)
    monkeypatch.setattr(ordering, "MAX_PREFIXES", 4_096)
    df = spark.range(120_000).withColumn("s", F.col("id") % 60)
    kind, fetched = type(df), []
    collect = kind.collect

    def counted(self):
        rows = collect(self)
        fetched.append(len(rows))
        return rows

    monkeypatch.setattr(kind, "collect", counted)
    folds = split.stratified_folds(df, "id", "s", 6)
    assert len(fetched) > 2 and fetched[-1] <= 2_000
    assert max(fetched) <= 60 * 2**ordering.FIRST_BITS
    sizes = folds.groupBy("s", "fold").count().collect()
    assert len(sizes) == 360 and {r["count"] for r in sizes} == {333, 334}


@pytest.mark.parametrize("rows_per_bucket", [1_000_000, 50])
def test_rank_in_class(spark, rows_per_bucket):
    rows = [(k, "hot" if k % 10 else None) for k in range(3000)]
    df = spark.createDataFrame(rows, "k bigint, s string")
    ranked = ordering.rank_in_class(df, "k", "s", "r", "n", rows_per_bucket=rows_per_bucket)
    got = {r.k: (r.r, r.n) for r in ranked.collect()}
    assert len(got) == 3000
    for s in ("hot", None):
        keys = brute_order([k for k, v in rows if v == s])
        assert [got[k] for k in keys] == [(i + 1, len(keys)) for i in range(len(keys))]


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(2000).withColumn("y", (F.col("id") % 5 == 0).cast("int"))
    many = split.stratified_split(df.repartition(13), "id", "y").filter("split = 'test'")
    one = split.stratified_split(df.coalesce(1), "id", "y").filter("split = 'test'")
    assert {r.id for r in many.collect()} == {r.id for r in one.collect()}
    assert {r.y: r["count"] for r in one.groupBy("y").count().collect()} == {0: 320, 1: 80}


def test_a_null_key_loses_no_row(spark):
    df = spark.createDataFrame([(None, 1), (1, 1), (2, 1), (3, 1)], "k bigint, y int")
    assert split.random_split(df, "k").count() == 4
    assert split.stratified_folds(df, "k", "y", 2).filter("fold is not null").count() == 4
    assert ordering.rank_in_class(df, "k", "y", "r").count() == 4


def test_folds_are_even_and_cover_all(spark):
    df = spark.range(1003).withColumn("y", F.lit(1))
    sizes = [r["count"] for r in split.stratified_folds(df, "id", "y", 6).groupBy("fold").count().collect()]
    assert sorted(sizes) == [167, 167, 167, 167, 167, 168]
    tiny = split.stratified_folds(df.limit(2), "id", "y", 6)
    assert sorted(r.fold for r in tiny.collect()) == [0, 1]


def test_sample_sizes(spark):
    df = spark.range(100)
    assert split.sample(df, n=10, key="id").count() == 10
    assert split.sample(df, n=1000, key="id").count() == 100
    assert split.sample(df, n=0, key="id").count() == 0
    assert split.sample(df.limit(0), n=5, key="id").count() == 0
    with pytest.raises(ValueError):
        split.sample(df)
    with pytest.raises(ValueError):
        split.sample(df, n=5)
    with pytest.raises(ValueError):
        split.split(df, "id", method="other")


def test_scalars(spark):
    df = spark.createDataFrame([(None, 0.07), (1.0, 0.5), (9.0, 1.0)], "x double, p double")
    rows = df.select(
        clip(F.col("x"), 2.0, 5.0).alias("c"),
        percent_text(F.col("p")).alias("t"),
        first_match([(F.col("x") > 5, "big")], "small").alias("f"),
        even_grid(F.lit(-10.0), F.lit(10.0), 5).alias("g"),
    ).collect()
    assert [r.c for r in rows] == [None, 2.0, 5.0]
    assert [r.t for r in rows] == ["7.0%", "50.0%", "100.0%"]
    assert [r.f for r in rows] == ["small", "small", "big"]
    assert rows[0].g == [-10.0, -5.0, 0.0, 5.0, 10.0]


def test_types(spark):
    df = spark.createDataFrame([], "a decimal(9,2), b smallint, c tinyint, d string, e boolean, f float")
    assert numeric_columns(df) == ["a", "b", "c", "f"]
    odd = spark.createDataFrame([("", float("nan"), 1)], "`a.b` string, `c d` double, n int")
    assert odd.select(*[is_missing(odd, c) for c in odd.columns]).collect()[0][:] == (True, True, False)
