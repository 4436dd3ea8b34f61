"""Scalar functions on whole columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowmill.catalog.base import CHURN, KEPT, churn, kept, query, rounded, table
from rowmill.catalog.profiling import GAPS, _gaps
from rowmill.functions import scalar
from rowmill.functions.columns import is_missing
from rowmill.operators import outliers
from rowmill.operators.profile import value_range


@query(
    "scl_1_first_match",
    """SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_quantity > 40 THEN 'bulk'
      WHEN l_quantity > 10 THEN 'usual' ELSE 'few' END AS size FROM lineitem""",
)
def _(spark, d):
    q = F.col("l_quantity")
    size = scalar.first_match([(q > 40, "bulk"), (q > 10, "usual")], "few")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", size.alias("size"))


@query(
    "scl_2_missing_tests",
    GAPS
    + """SELECT event_id, event_type IS NULL AS is_null, coalesce(event_type = '', false) AS is_empty,
      coalesce(isnan(value), false) AS is_nan, value IS NULL OR isnan(value) AS is_missing FROM gaps""",
)
def _(spark, d):
    gaps = _gaps(spark, d)
    return gaps.select(
        "event_id",
        F.col("event_type").isNull().alias("is_null"),
        F.coalesce(F.col("event_type") == "", F.lit(False)).alias("is_empty"),
        F.isnan("value").alias("is_nan"),
        is_missing(gaps, "value").alias("is_missing"),
    )


@query(
    "scl_3_comparisons",
    """SELECT o_orderkey, (o_totalprice >= 100000 AND o_totalprice < 300000) OR o_orderstatus = 'P' AS picked
    FROM orders""",
)
def _(spark, d):
    price = F.col("o_totalprice")
    picked = ((price >= 100000) & (price < 300000)) | (F.col("o_orderstatus") == "P")
    return table(spark, d, "orders").select("o_orderkey", picked.alias("picked"))


@query(
    "scl_4_bounds",
    """WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3,
      avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS s FROM lineitem)
    SELECT 'iqr' AS rule, round(q1 - 1.5 * (q3 - q1), 6) AS low, round(q3 + 1.5 * (q3 - q1), 6) AS high FROM q
    UNION ALL SELECT 'sigma', round(m - 3 * s, 4), round(m + 3 * s, 4) FROM q""",
)
def _(spark, d):
    lineitem, c = table(spark, d, "lineitem"), "l_extendedprice"
    schema = "rule string, low double, high double"
    iqr = spark.createDataFrame([("iqr", *outliers.fit_iqr(lineitem, [c])[c])], schema)
    sigma = spark.createDataFrame([("sigma", *outliers.fit_sigma(lineitem, [c])[c])], schema)
    return rounded(iqr, 6).unionByName(rounded(sigma, 4))


@query(
    "scl_5_casts",
    """SELECT l_orderkey, l_linenumber, l_quantity::INT AS quantity, l_orderkey::DOUBLE AS order_number,
      (l_discount > 0.05)::INT AS discounted FROM lineitem""",
)
def _(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_orderkey").cast("double").alias("order_number"),
        (F.col("l_discount") > 0.05).cast("int").alias("discounted"),
    )


@query("scl_6_round", "SELECT o_orderkey, round(o_totalprice / 7, 2) AS weekly FROM orders")
def _(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", F.round(F.col("o_totalprice") / 7, 2).alias("weekly")
    )


PROBABILITY_SQL = "1.0 / (1.0 + exp(-(coalesce(Age, 40) - 45) / 10.0))"


@query(
    "scl_7_percent_text",
    CHURN + f"SELECT CustomerId, round({PROBABILITY_SQL} * 100.0, 2)::VARCHAR || '%' AS confidence FROM churn",
)
def _(spark, d):
    z = (F.coalesce("Age", F.lit(40.0)) - 45) / 10.0
    return churn(spark, d).select(
        "CustomerId", scalar.percent_text(scalar.logistic(z)).alias("confidence")
    )


@query(
    "scl_8_trimmed_text",
    """SELECT c_custkey, CASE WHEN trim('  ' || c_mktsegment || ' ') IN ('BUILDING', 'MACHINERY')
      THEN trim('  ' || c_mktsegment || ' ') END AS segment FROM customer""",
)
def _(spark, d):
    padded = F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))
    return table(spark, d, "customer").select(
        "c_custkey", scalar.trimmed_in(padded, ["BUILDING", "MACHINERY"]).alias("segment")
    )


@query(
    "scl_10_vector_elements",
    "SELECT vec_id, embedding[1]::DOUBLE AS first, embedding[3]::DOUBLE AS third, NULL::DOUBLE AS beyond FROM embeddings",
)
def _(spark, d):
    from pyspark.ml.functions import array_to_vector

    vector = array_to_vector(F.col("embedding").cast("array<double>"))
    return table(spark, d, "embeddings").select(
        "vec_id",
        scalar.vector_element(vector, 0).alias("first"),
        scalar.vector_element(vector, 2).alias("third"),
        scalar.vector_element(vector, 1_000_000).alias("beyond"),
    )


@query("scl_11_logistic", "SELECT event_id, round(1 / (1 + exp(-(value - 20) / 10)), 9) AS p FROM events")
def _(spark, d):
    return table(spark, d, "events").select(
        "event_id", F.round(scalar.logistic((F.col("value") - 20) / 10), 9).alias("p")
    )


@query(
    "scl_12_even_grid",
    """SELECT i::INT AS i, round(lo + i * (hi - lo) / 99, 6) AS z, round(1 / (1 + exp(-(lo + i * (hi - lo) / 99))), 9) AS p
    FROM (SELECT min(value) / 10 AS lo, max(value) / 10 AS hi FROM events), range(100) t(i)""",
)
def _(spark, d):
    events = table(spark, d, "events")
    ends = events.agg((F.min("value") / 10).alias("lo"), (F.max("value") / 10).alias("hi"))
    grid = ends.select(F.posexplode(scalar.even_grid(F.col("lo"), F.col("hi"), 100)).alias("i", "z"))
    return grid.select(
        "i", F.round("z", 6).alias("z"), F.round(scalar.logistic(F.col("z")), 9).alias("p")
    )


@query(
    "scl_13_clip",
    """WITH r AS (SELECT min(o_totalprice) * 2 AS lo, max(o_totalprice) / 2 AS hi FROM orders)
    SELECT o_orderkey, round(greatest(least(o_totalprice, hi), lo), 4) AS price FROM orders, r""",
)
def _(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    _, low, high = value_range(orders, "o_totalprice")
    price = scalar.clip(F.col("o_totalprice"), low * 2, high / 2)
    return orders.select("o_orderkey", F.round(price, 4).alias("price"))


@query(
    "scl_13_clip_keeps_null",
    KEPT + "SELECT CustomerId, CASE WHEN Age IS NOT NULL THEN greatest(least(Age, 60), 25) END AS Age FROM kept",
)
def _(spark, d):
    return kept(spark, d).select("CustomerId", scalar.clip(F.col("Age"), 25.0, 60.0).alias("Age"))
