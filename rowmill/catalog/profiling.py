"""Profiling reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowmill.catalog.base import CHURN, KEPT, churn, close_quantiles, kept, query, rounded, table
from rowmill.catalog.storage import SPLIT_SQL
from rowmill.functions.columns import numeric_columns
from rowmill.operators import outliers, profile, split

CHURN_COLUMNS = (
    "RowNumber", "CustomerId", "Firstname", "Lastname", "CreditScore", "Geography", "Gender",
    "Age", "Tenure", "Balance", "NumOfProducts", "HasCrCard", "IsActiveMember",
    "EstimatedSalary", "Exited",
)


def _union(parts):
    return "\nUNION ALL ".join(parts)


@query(
    "prf_1_null_counts",
    CHURN
    + _union(
        f"SELECT '{c}' AS column, count(*) - count({c}) AS null_count FROM churn"
        for c in CHURN_COLUMNS
    ),
)
def _(spark, d):
    return profile.null_counts(churn(spark, d))


EVENTS = ("event_id", "user_id", "event_type", "value", "props")
# an event type is blanked and a value made NaN by rule, so that every kind of gap occurs
GAPS = """WITH gaps AS (SELECT event_id, user_id,
  CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS event_type,
  CASE WHEN event_id % 5 = 0 THEN 'NaN'::DOUBLE WHEN event_id % 13 = 0 THEN NULL ELSE value END AS value,
  props FROM events)
"""


def _gaps(spark, d):
    events, i = table(spark, d, "events"), F.col("event_id")
    return events.select(
        "event_id",
        "user_id",
        F.when(i % 7 == 0, "").when(i % 11 == 0, None).otherwise(F.col("event_type")).alias("event_type"),
        F.when(i % 5 == 0, float("nan")).when(i % 13 == 0, None).otherwise(F.col("value")).alias("value"),
        "props",
    )


@query(
    "prf_2_missing_counts",
    GAPS
    + """SELECT 'event_id' AS column, 0 AS missing_count UNION ALL SELECT 'user_id', 0
    UNION ALL SELECT 'event_type', count(*) FILTER (event_type IS NULL OR event_type = '') FROM gaps
    UNION ALL SELECT 'value', count(*) FILTER (value IS NULL OR isnan(value)) FROM gaps
    UNION ALL SELECT 'props', count(*) FILTER (props IS NULL OR props = '') FROM gaps""",
)
def _(spark, d):
    return profile.missing_counts(_gaps(spark, d))


@query(
    "prf_3_total_missing",
    GAPS
    + """SELECT (count(*) FILTER (event_type IS NULL OR event_type = '')
      + count(*) FILTER (value IS NULL OR isnan(value))
      + count(*) FILTER (props IS NULL OR props = ''))::BIGINT AS total_missing FROM gaps""",
)
def _(spark, d):
    return profile.total_missing(_gaps(spark, d))


@query(
    "prf_4_table_info",
    _union(
        f"SELECT {i} AS position, '{c}' AS column, '{t}' AS type, count(*) AS num_rows, "
        f"count({c}) AS non_null FROM customer"
        for i, (c, t) in enumerate(
            [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"),
             ("c_acctbal", "double"), ("c_mktsegment", "string")]
        )
    ),
)
def _(spark, d):
    return profile.info_rows(table(spark, d, "customer"))


def _describe_sql(columns, source):
    return _union(
        f"SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 4) AS mean, "
        f"round(stddev_samp({c}), 4) AS stddev, round(min({c})::DOUBLE, 4) AS min, "
        f"round(max({c})::DOUBLE, 4) AS max FROM {source}"
        for c in columns
    )


@query(
    "prf_5_describe",
    _describe_sql(["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "lineitem"),
)
def _(spark, d):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return rounded(profile.describe_numeric(table(spark, d, "lineitem"), columns), 4)


@query(
    "prf_6_numeric_stats",
    """SELECT 'l_extendedprice' AS column, 0 AS null_count, 0.0::DOUBLE AS null_percentage,
    round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS stddev,
    round(min(l_extendedprice), 4) AS min, round(max(l_extendedprice), 4) AS max,
    round(quantile_cont(l_extendedprice, 0.25), 6) AS q1,
    round(quantile_cont(l_extendedprice, 0.5), 6) AS median,
    round(quantile_cont(l_extendedprice, 0.75), 6) AS q3 FROM lineitem""",
)
def _(spark, d):
    stats = profile.numeric_stats(table(spark, d, "lineitem"), "l_extendedprice", True)
    return rounded(rounded(stats, 4, ["mean", "stddev", "min", "max"]), 6, ["q1", "median", "q3"])


@query(
    "prf_6_numeric_stats_approx",
    """SELECT 'l_extendedprice' AS column, p AS probability, count(*) > 0 AS close
    FROM lineitem, (VALUES (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE)) t(p) GROUP BY ALL""",
)
def _(spark, d):
    c = "l_extendedprice"
    lineitem = table(spark, d, "lineitem").select(c)
    row = profile.numeric_stats(lineitem, c).collect()[0]
    found = {(c, 0.25): row["q1"], (c, 0.5): row["median"], (c, 0.75): row["q3"]}
    return close_quantiles(lineitem, found, 0.001)


@query(
    "prf_7_categorical_stats",
    CHURN
    + """SELECT 'Gender' AS column, count(*) - count(Gender) AS null_count,
    round(100.0 * (count(*) - count(Gender)) / count(*), 6) AS null_percentage,
    count(DISTINCT Gender) + max(CASE WHEN Gender IS NULL THEN 1 ELSE 0 END) AS unique_values
    FROM churn""",
)
def _(spark, d):
    return rounded(profile.categorical_stats(churn(spark, d), "Gender"))


@query(
    "prf_7_top_values",
    """SELECT p_name AS value, count(*) AS count FROM part GROUP BY p_name
    ORDER BY count(*) DESC, p_name LIMIT 10""",
)
def _(spark, d):
    return profile.top_values(table(spark, d, "part"), "p_name", 10)


@query("prf_8_shape", "SELECT count(*) AS num_rows, 11 AS num_columns FROM lineitem")
def _(spark, d):
    return profile.table_shape(table(spark, d, "lineitem"))


@query(
    "prf_9_value_counts",
    "SELECT l_returnflag AS value, count(*) AS count FROM lineitem GROUP BY l_returnflag",
)
def _(spark, d):
    return profile.value_counts(table(spark, d, "lineitem"), "l_returnflag")


@query(
    "prf_10_class_balance",
    CHURN
    + f"""SELECT {SPLIT_SQL.format(key='CustomerId', share=0.2)} AS split, Exited AS label,
    count(*) AS count FROM churn GROUP BY ALL""",
)
def _(spark, d):
    parts = split.random_split(churn(spark, d), "CustomerId", 0.2)
    return profile.class_balance(parts, "Exited")


@query(
    "prf_11_histogram",
    """WITH r AS (SELECT min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 20 AS w
      FROM orders),
    c AS (SELECT least(19, floor((o_totalprice - lo) / w))::INT AS bin, count(*) AS n
      FROM orders, r GROUP BY 1)
    SELECT i::INT AS bin, round(lo + i * w, 4) AS low, round(lo + (i + 1) * w, 4) AS high,
      coalesce(n, 0) AS count
    FROM range(20) t(i) CROSS JOIN r LEFT JOIN c ON c.bin = i""",
)
def _(spark, d):
    return rounded(profile.histogram(table(spark, d, "orders"), "o_totalprice", 20), 4)


@query(
    "prf_12_density",
    """WITH s AS (SELECT count(*) AS n, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi,
      stddev_samp(l_extendedprice) AS sd FROM lineitem),
    p AS (SELECT *, sd * power(n, -0.2) AS h, (hi - lo) / 4096 AS w FROM s),
    b AS (SELECT avg(l_extendedprice) AS v, count(*)::DOUBLE AS m
      FROM lineitem, p GROUP BY least(4095, floor((l_extendedprice - lo) / w))),
    g AS (SELECT lo - 3 * h + i * ((hi + 3 * h - (lo - 3 * h)) / 199) AS x, n, h
      FROM p, range(200) t(i))
    SELECT round(x, 4) AS x,
      round(sum(m * exp(-0.5 * power((x - v) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 12)
        AS density
    FROM g, b GROUP BY x""",
)
def _(spark, d):
    curve = profile.density(table(spark, d, "lineitem"), "l_extendedprice", 200, 4096)
    return rounded(rounded(curve, 4, ["x"]), 12, ["density"])


BOX_COLUMNS = ["Age", "Tenure", "CreditScore", "Balance", "EstimatedSalary", "NumOfProducts"]


@query(
    "prf_13_box_plot",
    KEPT
    + _union(
        f"""SELECT '{c}' AS column, round(q1, 6) AS q1, round(q2, 6) AS median, round(q3, 6) AS q3,
      round(min({c}) FILTER ({c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))::DOUBLE, 6)
        AS whisker_low,
      round(max({c}) FILTER ({c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))::DOUBLE, 6)
        AS whisker_high,
      count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS outliers
    FROM kept, (SELECT quantile_cont({c}::DOUBLE, 0.25) AS q1, quantile_cont({c}::DOUBLE, 0.5) AS q2,
      quantile_cont({c}::DOUBLE, 0.75) AS q3 FROM kept) GROUP BY q1, q2, q3"""
        for c in BOX_COLUMNS
    ),
)
def _(spark, d):
    return rounded(profile.box_plot(kept(spark, d), BOX_COLUMNS))


@query(
    "prf_14_mean_median",
    """SELECT round(avg(l_quantity), 2) AS mean, round(quantile_cont(l_quantity, 0.5), 2) AS median
    FROM lineitem""",
)
def _(spark, d):
    return profile.center(table(spark, d, "lineitem"), "l_quantity")


@query("prf_15_distinct_values", "SELECT DISTINCT p_type AS value FROM part")
def _(spark, d):
    return profile.distinct_values(table(spark, d, "part"), "p_type")


@query("prf_15_distinct_count", "SELECT count(DISTINCT l_partkey) AS distinct_count FROM lineitem")
def _(spark, d):
    return profile.distinct_count(table(spark, d, "lineitem"), "l_partkey")


@query("prf_16_preview", "SELECT * FROM part ORDER BY p_partkey LIMIT 10")
def _(spark, d):
    return profile.preview(table(spark, d, "part"), "p_partkey", 10)


@query(
    "prf_17_summary",
    KEPT
    + """, q AS (SELECT quantile_cont(Balance, [0.25, 0.75]) AS b, quantile_cont(CreditScore::DOUBLE, [0.25, 0.75]) AS c FROM kept),
    fine AS (SELECT kept.* FROM kept, q WHERE
      CASE WHEN Balance < b[1] - 0.5 * (b[2] - b[1]) OR Balance > b[2] + 0.5 * (b[2] - b[1]) THEN 1 ELSE 0 END
      + CASE WHEN CreditScore < c[1] - 0.5 * (c[2] - c[1]) OR CreditScore > c[2] + 0.5 * (c[2] - c[1]) THEN 1 ELSE 0 END < 1),
    """
    + f"""parts AS (SELECT *, {SPLIT_SQL.format(key='CustomerId', share=0.2)} AS split FROM fine)
    SELECT count(*) AS total_rows, count(*) FILTER (split = 'train') AS train_rows,
      count(*) FILTER (split = 'test') AS test_rows, 4 AS num_features,
      sum(CASE WHEN Age IS NULL THEN 1 ELSE 0 END + CASE WHEN Gender IS NULL THEN 1 ELSE 0 END)::BIGINT
        AS missing_values,
      (SELECT count(*) FROM kept) - count(*) AS outliers_removed,
      '0.2' AS test_size, 'iqr' AS outlier_method FROM parts""",
)
def _(spark, d):
    rows = kept(spark, d)
    bounds = outliers.fit_iqr(rows, ["Balance", "CreditScore"], 0.5)
    fine = split.random_split(outliers.remove_outliers(rows, bounds, 1), "CustomerId", 0.2)
    return profile.preparation_summary(
        fine,
        ["Age", "Gender", "Balance", "CreditScore"],
        rows.count(),
        {"test_size": "0.2", "outlier_method": "iqr"},
    )


@query(
    "prf_18_numeric_columns",
    _union(
        f"SELECT '{c}' AS column, count(*) - count({c}) AS null_count FROM lineitem"
        for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                  "l_extendedprice", "l_discount", "l_tax")
    ),
)
def _(spark, d):
    lineitem = table(spark, d, "lineitem")
    return profile.null_counts(lineitem.select(*numeric_columns(lineitem)))
