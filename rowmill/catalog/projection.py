"""Row filters and column projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowmill.catalog.base import CHURN, FILLED, churn, filled, kept, query, rounded, table
from rowmill.catalog.profiling import GAPS, _gaps
from rowmill.operators import encode, outliers, profile, project


@query("prj_1_drop_critical", CHURN + "SELECT CustomerId, Firstname, Age FROM churn WHERE Firstname IS NOT NULL")
def _(spark, d):
    return project.drop_missing(churn(spark, d), ["Firstname"]).select("CustomerId", "Firstname", "Age")


@query(
    "prj_1_dropped_rows",
    CHURN
    + """SELECT count(*) FILTER (Firstname IS NOT NULL AND Age IS NOT NULL) AS kept,
    count(*) FILTER (Firstname IS NULL OR Age IS NULL) AS dropped FROM churn""",
)
def _(spark, d):
    return project.dropped_rows(churn(spark, d), ["Firstname", "Age"])


@query(
    "prj_2_drop_any",
    CHURN
    + """SELECT CustomerId, Firstname, Gender, Age FROM churn
    WHERE Firstname IS NOT NULL AND Gender IS NOT NULL AND Age IS NOT NULL""",
)
def _(spark, d):
    return project.drop_missing(churn(spark, d)).select("CustomerId", "Firstname", "Gender", "Age")


@query("prj_3_drop_existing", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def _(spark, d):
    return project.drop_existing(table(spark, d, "customer"), ["c_name", "c_mktsegment", "c_absent"])


@query("prj_4_drop_strict", "SELECT p_partkey, p_brand, p_type, p_size FROM part")
def _(spark, d):
    return project.drop_strict(table(spark, d, "part"), ["p_name", "p_retailprice"])


@query(
    "prj_5_cast",
    """SELECT p_partkey, p_size::DOUBLE AS p_size, trunc(p_retailprice)::INT AS p_retailprice,
    try_cast(substr(p_brand, 7) AS INT) AS brand_number, try_cast(p_type AS INT) AS type_number FROM part""",
)
def _(spark, d):
    part = table(spark, d, "part").select(
        "p_partkey",
        "p_size",
        "p_retailprice",
        F.substring("p_brand", 7, 10).alias("brand_number"),
        F.col("p_type").alias("type_number"),
    )
    out = project.cast_columns(part, {"p_size": "double", "p_retailprice": "int", "absent": "int"})
    return project.cast_columns(out, {"brand_number": "int", "type_number": "int"}, lenient=True)


@query("prj_6_features", CHURN + "SELECT CustomerId, Age, Balance FROM churn")
def _(spark, d):
    table_ = churn(spark, d).select("CustomerId", "Age", "Balance", "Exited")
    return project.features_and_target(table_, "Exited", "CustomerId")[0]


@query("prj_6_target", CHURN + "SELECT CustomerId, Exited FROM churn")
def _(spark, d):
    return project.features_and_target(churn(spark, d), "Exited", "CustomerId")[1]


@query(
    "prj_7_align",
    "SELECT c_acctbal, 0 AS Geography_France, c_custkey, 0 AS Gender_Male FROM customer",
)
def _(spark, d):
    expected = ["c_acctbal", "Geography_France", "c_custkey", "Gender_Male"]
    return project.align(table(spark, d, "customer"), expected)


@query(
    "prj_8_concatenate",
    """SELECT o_orderkey, o_totalprice, (o_orderstatus = 'F')::INT AS status_F,
    (o_orderstatus = 'O')::INT AS status_O, (o_orderstatus = 'P')::INT AS status_P FROM orders""",
)
def _(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    derived = {f"status_{s}": (F.col("o_orderstatus") == s).cast("int") for s in "FOP"}
    return project.replace_columns(orders, derived, ["o_orderstatus"])


@query(
    "prj_9_only_missing",
    GAPS + "SELECT event_id, event_type FROM gaps WHERE event_type IS NULL OR event_type = ''",
)
def _(spark, d):
    return project.only_missing(_gaps(spark, d), "event_type").select("event_id", "event_type")


@query(
    "prj_10_discard_mask",
    CHURN + "SELECT CustomerId, Age FROM churn WHERE NOT coalesce(Age > 60, false)",
)
def _(spark, d):
    return project.discard_where(churn(spark, d), F.col("Age") > 60).select("CustomerId", "Age")


@query(
    "prj_11_drop_helpers",
    "SELECT l_orderkey, l_quantity, l_discount FROM lineitem",
)
def _(spark, d):
    lineitem = table(spark, d, "lineitem").select("l_orderkey", "l_quantity", "l_discount")
    bounds = outliers.fit_sigma(lineitem, ["l_quantity", "l_discount"])
    return project.drop_helpers(outliers.flag_outliers(lineitem, bounds))


@query(
    "prj_12_feature_subset",
    FILLED + "SELECT round(Age, 6) AS Age, Balance, Geography, Exited FROM filled",
)
def _(spark, d):
    subset = project.feature_subset(filled(spark, d), ["Age", "Balance", "Geography"], ["Exited"])
    return rounded(subset, 6, ["Age"])


@query(
    "set_1_append_rows",
    CHURN
    + """SELECT Gender, 'observed' AS origin, count(*) AS n FROM churn GROUP BY Gender
    UNION ALL SELECT Gender, 'repeated', count(*) FROM churn WHERE Exited = 1 GROUP BY Gender""",
)
def _(spark, d):
    rows = churn(spark, d).select("Gender", "Exited")
    repeated = rows.filter(F.col("Exited") == 1).withColumn("origin", F.lit("repeated"))
    every = rows.withColumn("origin", F.lit("observed")).unionByName(repeated)
    return every.groupBy("Gender", "origin").agg(F.count(F.lit(1)).alias("n"))


@query(
    "srt_1_top_ten",
    """SELECT user_id AS value, count(*) AS count FROM events GROUP BY user_id
    ORDER BY count(*) DESC, user_id LIMIT 10""",
)
def _(spark, d):
    return profile.top_values(table(spark, d, "events"), "user_id", 10)


@query(
    "srt_2_most_frequent",
    """SELECT event_type AS value, count(*) AS count FROM events GROUP BY event_type
    ORDER BY count(*) DESC, event_type LIMIT 1""",
)
def _(spark, d):
    return profile.top_values(table(spark, d, "events"), "event_type", 1)


@query("srt_3_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100")
def _(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return profile.preview(orders, "o_orderkey", 100)


@query(
    "jon_4_rejoin_by_key",
    CHURN + "SELECT CustomerId, Balance, Geography, Exited FROM churn WHERE Firstname IS NOT NULL",
)
def _(spark, d):
    rows = kept(spark, d).select("CustomerId", "Balance", "Geography", "Exited")
    x, y = project.features_and_target(rows, "Exited", "CustomerId")
    return project.rejoin(x, y, "CustomerId")


@query(
    "scl_9_column_names",
    "SELECT "
    + ", ".join(
        f"sum((r_name = '{r}')::INT)::BIGINT AS \"r_name_{r.replace(' ', '_')}\""
        for r in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
    )
    + " FROM nation JOIN region ON n_regionkey = r_regionkey",
)
def _(spark, d):
    named = table(spark, d, "nation").join(
        table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select("r_name")
    labels = encode.fit_one_hot(named, ["r_name"])
    coded = encode.apply_one_hot(named, labels)
    return coded.agg(*[F.sum(c).alias(c) for c in encode.indicator_names(labels)])
