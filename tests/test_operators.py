"""Edge cases of the table operators on literal tables."""

import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from rowmill.functions.columns import col
from rowmill.operators import (
    binning, encode, impute, layout, lookup, outliers, profile, project, scale, vectors,
)
from rowmill.operators.binning import CREDIT_SCORE_BINS, CREDIT_SCORE_TOP

NAN = float("nan")


def values(df, name):
    return [r[0] for r in df.select(col(name)).collect()]


# ---- profiling


def test_profile_of_an_empty_table(spark):
    df = spark.createDataFrame([], "x double, s string")
    assert [r.null_count for r in profile.null_counts(df).collect()] == [0, 0]
    assert profile.total_missing(df).collect()[0][0] == 0
    row = profile.numeric_stats(df, "x", exact=True).collect()[0]
    assert row.null_percentage is None and row.q1 is None and row["mean"] is None
    assert profile.categorical_stats(df, "s").collect()[0].null_percentage is None
    assert profile.histogram(df, "x").count() == 0
    assert profile.density(df, "x").count() == 0
    assert profile.box_plot(df, ["x"]).collect()[0].outliers == 0


def test_missing_counts(spark):
    df = spark.createDataFrame([(NAN, "", 1), (None, None, None), (1.0, "a", 2)], "x double, s string, n int")
    assert {r.column: r.missing_count for r in profile.missing_counts(df).collect()} == {"x": 2, "s": 2, "n": 1}
    assert {r.column: r.null_count for r in profile.null_counts(df).collect()} == {"x": 1, "s": 1, "n": 1}


def test_top_values_ties(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "a", "b", "a", "c", None]], "s string")
    assert [tuple(r) for r in profile.top_values(df, "s", 2).collect()] == [("a", 2), ("b", 2)]
    assert profile.categorical_stats(df, "s").collect()[0].unique_values == 4


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(5.0,)] * 3, "x double")
    rows = profile.histogram(df, "x", 4).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [3, 0, 0, 0]


def test_binned_density_is_close_to_exact(spark):
    df = spark.range(400).select((F.sin("id") * 10 + F.col("id") % 7).alias("x"))
    exact = profile.density(df, "x", 50, bins=None).orderBy("x").collect()
    binned = profile.density(df, "x", 50).orderBy("x").collect()
    for a, b in zip(exact, binned):
        assert abs(a.density - b.density) < 1e-6
    step = exact[1].x - exact[0].x
    assert abs(sum(r.density for r in exact) * step - 1) < 0.01


def test_table_info(spark):
    df = spark.createDataFrame([(1, "a"), (3, None)], "n int, s string")
    info = profile.table_info(df)
    assert info["num_rows"] == 2 and info["num_columns"] == 2
    assert info["numeric_stats"]["n"]["mean"] == 2.0


def test_flagged_share(spark):
    df = spark.createDataFrame([(True,), (None,), (False,)], "f boolean")
    row = profile.flagged_share(df, "f").collect()[0]
    assert tuple(row) == (1, 0.333, 33.333)


# ---- projection


def test_drop_missing(spark):
    df = spark.createDataFrame([(None, "a"), (1, None), (2, "b")], "n int, s string")
    assert project.drop_missing(df).count() == 1
    assert project.drop_missing(df, []).count() == 3
    assert project.drop_missing(df, ["n"]).count() == 2


def test_strict_and_lenient_drop(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert project.drop_existing(df, ["b", "z"]).columns == ["a"]
    with pytest.raises(ValueError):
        project.drop_strict(df, ["z"])


def test_align_and_casts(spark):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    assert project.align(df, ["c", "a"]).collect()[0][:] == (0, "1")
    assert project.cast_columns(df, {"a": "int", "b": "int"}, lenient=True).collect()[0][:] == (1, None)


def test_discard_keeps_unknown(spark):
    df = spark.createDataFrame([(1,), (None,), (9,)], "n int")
    assert values(project.discard_where(df, F.col("n") > 5), "n") == [1, None]


# ---- imputation


def test_fraction_goes_into_an_integer_column(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,)], "n int")
    filled = impute.fill(df, "n", "mean")
    assert values(filled, "n")[-1] == pytest.approx(5 / 3)
    assert values(impute.fill(df, "n", "mode"), "n") == [1, 2, 2, 2]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(NAN,), (2.0,), (4.0,), (None,)], "x double")
    for method in ("mean", "median"):
        assert values(impute.fill(df, "x", method), "x") == [3.0, 2.0, 4.0, 3.0]


def test_mode_ties_take_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), (None,), (None,)], "s string")
    assert impute.fit_fill(df, "s", "mode") == {"s": "a"}


def test_fill_without_values(spark):
    df = spark.createDataFrame([(None,)], "x double")
    for method in ("mean", "median", "mode"):
        assert values(impute.fill(df, "x", method), "x") == [None]
    with pytest.raises(ValueError):
        impute.fill(df, "x", "other")
    with pytest.raises(ValueError):
        impute.fill(df, "x", "constant")


def predictor_rows(spark):
    rows = [(1, "Ann", "F"), (2, "Ann", "F"), (3, "Ann", "M"), (4, "Bob", "M"), (5, "Ann", None),
            (6, "Bob", ""), (7, "Cid", None), (8, None, None), (9, "Bob", "odd"), (10, "Bob", "odd")]
    return spark.createDataFrame(rows, "id int, name string, g string")


@pytest.mark.parametrize("large", [False, True])
def test_category_predictor(spark, monkeypatch, large):
    df = predictor_rows(spark)
    if large:  # as if the lookup were beyond the bound
        monkeypatch.setattr(impute, "bounded", lambda t: lookup.Lookup(t, None))
    p = impute.fit_category_predictor(df, ["name"], "g", ["F", "M"])
    got = {r.id: r.g for r in impute.apply_category_predictor(df, p).collect()}
    assert got == {1: "F", 2: "F", 3: "M", 4: "M", 5: "F", 6: "M", 7: "F", 8: "F", 9: "odd", 10: "odd"}


def test_domain(spark):
    df = spark.createDataFrame([(" Male",), ("x",), (None,), ("",)], "g string")
    assert values(impute.validate_domain(df, "g", ["Male"]), "g") == ["Male", None, None, None]
    assert tuple(impute.domain_report(df, "g", ["Male"]).collect()[0]) == (1, 1, 2)


def test_lookup_does_not_fan_out(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n int")
    right = spark.createDataFrame([("a", "y"), ("a", "x"), (None, "z")], "k string, v string")
    got = {r.n: r.v for r in lookup.left_lookup(left, right, ["k"], "v").collect()}
    assert got == {1: "x", 2: None, 3: None}


def test_lookup_bound(spark):
    assert lookup.bounded(spark.range(10), 10).rows == 10
    assert lookup.bounded(spark.range(11), 10).rows is None
    long = spark.createDataFrame([(1, "x" * 5000)], "k int, v string")
    assert lookup.bounded(long, 10, max_bytes=4000).rows is None
    assert lookup.bounded(long, 10, max_bytes=6000).rows == 1
    assert lookup.bounded(long.limit(0), 10).rows == 0


# ---- outliers


def test_missing_is_no_outlier(spark):
    rows = [(float(i), 1.0) for i in range(20)] + [(500.0, 500.0), (None, 500.0), (NAN, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    bounds = outliers.fit_iqr(df, ["a", "b"])
    kept = outliers.remove_outliers(df, bounds, 2)
    assert kept.count() == 22 and kept.columns == ["a", "b"]
    flagged = outliers.flag_outliers(df, bounds)
    assert [r.a_outlier for r in flagged.collect()][-3:] == [True, False, False]
    capped = outliers.cap_outliers(df, bounds).collect()
    assert capped[-2].a is None and capped[-3].a == bounds["a"][1]


def test_unknown_outlier_method(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(ValueError):
        outliers.handle_outliers(df, ["x"], "other")
    assert outliers.fit_sigma(df, ["x"])["x"] == (None, None)
    assert outliers.handle_outliers(df.limit(0), ["x"], "cap").count() == 0


# ---- binning


def test_bin_edges(spark):
    scores = [290, 300, 579, 580, 581, 670, 740, 800, 849, 850, 851, None]
    df = spark.createDataFrame([(s,) for s in scores], "CreditScore int")

    def labels(**options):
        return values(binning.bin_column(df, "CreditScore", CREDIT_SCORE_BINS, **options), "CreditScoreBins")

    closed = labels(exact=CREDIT_SCORE_TOP)
    assert closed == [None, "Poor", "Poor", "Poor", "Fair", "Fair", "Good", "Very Good", "Excellent",
                      "Excellent", None, None]
    assert labels(above="Invalid")[-2:] == ["Invalid", None]
    assert labels(otherwise="Poor")[0] == labels(otherwise="Poor")[-1] == "Poor"
    half_open = labels(closed="left")
    assert half_open == ["Poor", "Poor", "Poor", "Fair", "Fair", "Good", "Very Good", "Excellent",
                         "Excellent", "Excellent", None, None]
    with pytest.raises(ValueError):
        labels(closed="right")


def test_buckets(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (9.9,), (10.0,), (20.0,), (21.0,), (NAN,)], "x double")
    got = values(binning.bucket_index(df, "x", [0, 10, 20], "b"), "b")
    assert got == [None, 0, 0, 1, 1, None, None]


# ---- encoding


def test_label_order(spark):
    rows = [(5, "b"), (1, "c"), (2, "a"), (3, "a"), (4, "b"), (6, None)]
    df = spark.createDataFrame(rows, "id int, s string")
    assert encode.fit_label_index(df, "s").codes == {"a": 0, "b": 1, "c": 2}
    assert encode.fit_label_index(df, "s", "first_seen", "id").codes == {"c": 0, "a": 1, "b": 2}
    assert encode.fit_label_index(df, "s", "alphabet").codes == {"a": 0, "b": 1, "c": 2}
    with pytest.raises(ValueError):
        encode.fit_label_index(df, "s", "first_seen")


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("order", ["frequency", "alphabet", "first_seen"])
def test_large_vocabulary(spark, monkeypatch, order, small):
    """Codes of a vocabulary that no driver holds; one label fills half the table."""
    text = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 97 == 0, None).otherwise(
        F.concat(F.lit("w"), F.col("id") % 1500)
    )
    df = spark.range(6000).select("id", text.alias("s"))
    counts, first = {}, {}
    for r in df.collect():
        if r.s is not None:
            counts[r.s] = counts.get(r.s, 0) + 1
            first.setdefault(r.s, r.id)
    key = {"frequency": lambda v: (-counts[v], v), "alphabet": lambda v: v, "first_seen": first.get}[order]
    expected = {v: i for i, v in enumerate(sorted(counts, key=key))}
    kind, fetched = type(df), []
    collect = kind.collect

    def counted(self):
        rows = collect(self)
        fetched.append(len(rows))
        return rows

    monkeypatch.setattr(kind, "collect", counted)
    index = encode.fit_label_index(df, "s", order, "id" if order == "first_seen" else None)
    assert max(fetched) <= encode.INLINE_LABELS + 1
    monkeypatch.undo()
    assert index.codes is None and index.small and index.heavy["hot"] == expected["hot"]
    assert {r["value"]: r.code for r in index.table.collect()} == expected
    index = replace(index, small=small)
    coded = encode.apply_label_index(df, index, "code", unseen=-1)
    assert {(r.id, r.code) for r in coded.collect()} == {
        (r.id, -1 if r.s is None else expected[r.s]) for r in df.collect()
    }
    back = encode.invert_label_index(coded, index, "code", "again")
    assert back.filter("NOT (s <=> again)").count() == 0 and back.count() == 6000


def test_hot_label_is_dealt_over_tasks(spark):
    """In the shuffled join the rows of a label that fills half the table do not meet in one task."""
    df = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("s"), "id")
    index = replace(encode.fit_label_index(df, "s"), small=False)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        coded = encode.apply_label_index(df, index, "code")
        sizes = [r["count"] for r in coded.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) > 1 and max(sizes) < 1.2 * 20_000 / len(sizes)


def test_indicators_of_many_labels(spark):
    df = spark.range(60_000).select("id", (F.col("id") % 50_000).cast("string").alias("s"))
    with pytest.raises(ValueError):
        encode.one_hot(df, ["s"])
    coded = encode.one_hot(df, ["s"], "vectors")
    assert coded.columns == ["id", "s_vector"]
    order = {v: i for i, v in enumerate(sorted(map(str, range(50_000))))}
    for r in coded.filter(F.col("id") % 7_001 == 0).collect():
        assert r.s_vector.size == 50_001 and r.s_vector.indices.tolist() == [order[str(r.id % 50_000)]]
    fitted = encode.fit_indicators(df.filter("id < 3"), "s")
    new = spark.createDataFrame([("1",), ("9",), (None,)], "s string")
    got = encode.apply_indicators(new, fitted, "v").collect()
    assert [r.v.indices.tolist() for r in got] == [[1], [3], [3]]


def test_unseen_labels(spark):
    df = spark.createDataFrame([("a",), ("b",)], "s string")
    new = spark.createDataFrame([("b",), ("z",), (None,)], "s string")
    index = encode.fit_label_index(df, "s")
    assert values(encode.apply_label_index(new, index), "s") == [1, None, None]
    assert values(encode.apply_label_index(new, index, unseen=-1), "s") == [1, -1, -1]
    labels = encode.fit_one_hot(df, ["s"])
    rows = encode.apply_one_hot(new, labels).collect()
    assert [tuple(r) for r in rows] == [(0, 1), (0, 0), (0, 0)]


def test_indicator_names(spark):
    df = spark.createDataFrame([("a b",), ("c.d",)], "s string")
    coded = encode.apply_one_hot(df, encode.fit_one_hot(df, ["s"]))
    assert coded.columns == ["s_a_b", "s_c.d"]
    assert coded.select(col("s_c.d")).collect()[1][0] == 1
    clash = spark.createDataFrame([("a b",), ("a_b",)], "s string")
    with pytest.raises(ValueError):
        encode.fit_one_hot(clash, ["s"])
    with pytest.raises(ValueError):
        encode.fit_one_hot(df, ["s"], max_labels=1)


# ---- scaling, vectors, layout


def test_scaling(spark):
    df = spark.createDataFrame([(1.0, 7), (3.0, 7), (None, None)], "x double, c int")
    scaled = scale.apply_scaling(df, scale.fit_min_max(df, ["x", "c"])).collect()
    assert [tuple(r) for r in scaled] == [(0.0, 0.0), (1.0, 0.0), (None, None)]
    pop = scale.fit_standard(df, ["x", "c"])
    assert pop == {"x": (2.0, 1.0), "c": (7.0, 1.0)}
    assert scale.fit_standard(df, ["x"], with_mean=False, ddof=1)["x"] == (0.0, pytest.approx(math.sqrt(2)))
    assert scale.fit_standard(df, ["x"], with_std=False)["x"] == (2.0, 1.0)
    new = spark.createDataFrame([(5.0, 9)], "x double, c int")
    assert scale.apply_scaling(new, scale.fit_min_max(df, ["x", "c"])).collect()[0][:] == (2.0, 2.0)
    with pytest.raises(ValueError):
        scale.fit_standard(df, ["x"], ddof=2)


def test_composite_is_few_jobs(spark, folder):
    """Medians, moments and vocabularies of all columns in a bounded number of jobs."""
    df = spark.read.parquet(f"{folder}/part.parquet").withColumn(
        "gap", F.when(F.col("p_size") % 3 > 0, F.col("p_retailprice"))
    )
    df = df.withColumns({"maker": F.substring("p_brand", 1, 7), "sort": F.substring("p_type", 1, 3)})
    numeric, nominal, ordinal = ["p_size", "p_retailprice", "gap"], ["p_brand", "maker"], ["sort"]
    spark.sparkContext.setJobGroup("composite", "composite")
    fitted = vectors.fit_composite(df, numeric, nominal, ordinal)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("composite")
    spark.sparkContext.setJobGroup("", "")
    assert 0 < len(jobs) <= 12  # adaptive execution runs each map side as a job of its own
    filled = impute.apply_fill(df, fitted.fills)
    for c, (mean, sd) in scale.fit_standard(filled, numeric).items():
        assert fitted.scaling[c] == (pytest.approx(mean), pytest.approx(sd))
    assert fitted.labels == encode.fit_one_hot(df, nominal)
    assert fitted.ordinals[0].codes == encode.fit_label_index(df, "sort", "alphabet").codes
    df = df.withColumn("own", F.col("p_partkey").cast("string"))
    many = vectors.fit_composite(df, ["p_size"], ["p_brand"], ["own"])
    assert many.ordinals[0].codes is None and many.ordinals[0].table.count() == df.count()
    assert vectors.fit_composite(df, [], [], []).labels == {}


def test_composite_on_new_rows(spark):
    df = spark.createDataFrame([(1.0, "a", "p"), (3.0, None, "q"), (None, "b", None)], "x double, n string, o string")
    fitted = vectors.fit_composite(df, ["x"], ["n"], ["o"])
    out = vectors.apply_composite(df, fitted)
    assert out.columns == ["x", "n_a", "n_b", "n_missing", "o"]
    assert [r.o for r in out.collect()] == [1, 2, 0]  # 'missing' sorts before 'p'
    new = spark.createDataFrame([(9.0, "zzz", "zzz")], "x double, n string, o string")
    assert vectors.apply_composite(new, fitted).collect()[0][1:] == (0, 0, 0, None)


def test_assemble_skips_gaps(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None)], "k int, x double")
    assert vectors.assemble(df, ["x"], ["k"]).count() == 1


def test_partition_target(spark):
    assert layout.partition_target(0) == 1
    assert layout.partition_target(50_000) == 5
    assert layout.partition_target(10_000_000) == 200
    assert layout.partition_target(10**12) == 10**6
    df = spark.range(0, 100_000, numPartitions=40)
    assert layout.right_size(df).rdd.getNumPartitions() == 10
    assert layout.right_size(df.coalesce(1)).rdd.getNumPartitions() == 10
