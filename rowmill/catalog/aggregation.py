"""Aggregations and small rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowmill.catalog.base import CHURN, KEPT, churn, close_quantiles, kept, query, rounded, table
from rowmill.functions.quantiles import exact_quantiles
from rowmill.operators import outliers, profile, tuning
from rowmill.operators.evaluate import prediction_summary
from rowmill.operators.project import sum_flags
from rowmill.operators.split import stratified_folds


@query("agg_1_mean", "SELECT round(avg(l_extendedprice), 4) AS mean FROM lineitem")
def _(spark, d):
    return table(spark, d, "lineitem").agg(F.round(F.avg("l_extendedprice"), 4).alias("mean"))


@query(
    "agg_2_one_pass",
    """SELECT round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS stddev,
    round(min(o_totalprice), 4) AS min, round(max(o_totalprice), 4) AS max FROM orders""",
)
def _(spark, d):
    described = profile.describe_numeric(table(spark, d, "orders"), ["o_totalprice"])
    return rounded(described.select("mean", "stddev", "min", "max"), 4)


@query(
    "agg_3_approx_quantiles",
    """SELECT c AS column, p AS probability, count(*) > 0 AS close FROM lineitem,
    (VALUES ('l_quantity'), ('l_extendedprice')) t(c), (VALUES (0.25::DOUBLE), (0.75::DOUBLE)) u(p)
    GROUP BY ALL""",
)
def _(spark, d):
    """Approximate quartiles lie within the promised rank error."""
    lineitem = table(spark, d, "lineitem").select("l_quantity", "l_extendedprice")
    found = lineitem.approxQuantile(lineitem.columns, [0.25, 0.75], 0.01)
    wanted = {
        (c, p): q for c, values in zip(lineitem.columns, found) for p, q in zip((0.25, 0.75), values)
    }
    return close_quantiles(lineitem, wanted, 0.01)


@query(
    "agg_4_exact_quantiles",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column, round(quantile_cont({c}, 0.1), 6) AS p10, "
        f"round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50, "
        f"round(quantile_cont({c}, 0.99), 6) AS p99 FROM lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_discount")
    ),
)
def _(spark, d):
    columns = ["l_quantity", "l_extendedprice", "l_discount"]
    found = exact_quantiles(table(spark, d, "lineitem"), columns, [0.1, 0.25, 0.5, 0.99])
    rows = [(c, *q) for c, q in found.items()]
    return rounded(
        spark.createDataFrame(rows, "column string, p10 double, p25 double, p50 double, p99 double"), 6
    )


@query(
    "agg_5_group_count",
    "SELECT l_linestatus AS value, count(*) AS count FROM lineitem GROUP BY l_linestatus",
)
def _(spark, d):
    return profile.value_counts(table(spark, d, "lineitem"), "l_linestatus")


@query("agg_6_distinct_count", "SELECT count(DISTINCT user_id) AS distinct_count FROM events")
def _(spark, d):
    return profile.distinct_count(table(spark, d, "events"), "user_id")


@query(
    "agg_7_filtered_count",
    """SELECT count(*) FILTER (l_quantity > 45) AS large, count(*) FILTER (l_discount = 0) AS undiscounted
    FROM lineitem""",
)
def _(spark, d):
    return table(spark, d, "lineitem").agg(
        F.count_if(F.col("l_quantity") > 45).alias("large"),
        F.count_if(F.col("l_discount") == 0).alias("undiscounted"),
    )


@query(
    "agg_8_flag_sum",
    CHURN
    + """SELECT CustomerId, CASE WHEN Age > 60 THEN 1 ELSE 0 END + CASE WHEN CreditScore > 800 THEN 1 ELSE 0 END
      + CASE WHEN NumOfProducts > 20 THEN 1 ELSE 0 END AS flags FROM churn""",
)
def _(spark, d):
    flags = [F.col("Age") > 60, F.col("CreditScore") > 800, F.col("NumOfProducts") > 20]
    return churn(spark, d).select("CustomerId", sum_flags(flags).alias("flags"))


@query(
    "agg_9_prediction_summary",
    CHURN
    + """, p AS (SELECT CASE WHEN coalesce(Age, 40) > 45 THEN 1 ELSE 0 END AS y,
      1.0 / (1.0 + exp(-(coalesce(Age, 40) - 45) / 10.0)) AS q FROM churn)
    SELECT count(*) AS num_predictions, round(avg(y), 6) AS avg_prediction,
      count(*) FILTER (y = 1) AS churn_predictions, count(*) FILTER (y = 0) AS retain_predictions,
      round(avg(q), 6) AS avg_churn_probability, count(*) FILTER (q > 0.7) AS high_risk,
      count(*) FILTER (q > 0.5 AND q <= 0.7) AS medium_risk, count(*) FILTER (q <= 0.5) AS low_risk FROM p""",
)
def _(spark, d):
    age = F.coalesce("Age", F.lit(40.0))
    scored = churn(spark, d).select(
        F.when(age > 45, 1).otherwise(0).alias("prediction"),
        (1.0 / (1.0 + F.exp(-(age - 45) / 10.0))).alias("probability"),
    )
    return rounded(prediction_summary(scored))


@query(
    "agg_10_flagged_share",
    """WITH b AS (SELECT avg(l_extendedprice) + 2 * stddev_samp(l_extendedprice) AS hi FROM lineitem)
    SELECT count(*) FILTER (l_extendedprice > hi) AS flagged,
      round(count(*) FILTER (l_extendedprice > hi) / count(*), 3) AS fraction,
      round(100.0::DOUBLE * (count(*) FILTER (l_extendedprice > hi) / count(*)), 3) AS percent
    FROM lineitem, b""",
)
def _(spark, d):
    lineitem = table(spark, d, "lineitem").select("l_extendedprice")
    _, high = outliers.fit_sigma(lineitem, ["l_extendedprice"], 2.0)["l_extendedprice"]
    flagged = outliers.flag_outliers(lineitem, {"l_extendedprice": (float("-inf"), high)})
    return profile.flagged_share(flagged, "l_extendedprice_outlier")


@query(
    "agg_11_null_percentage",
    CHURN
    + """SELECT 'Age' AS column, round(100.0 * (count(*) - count(Age)) / count(*), 6) AS null_percentage FROM churn
    UNION ALL SELECT 'Gender', round(100.0 * (count(*) - count(Gender)) / count(*), 6) FROM churn""",
)
def _(spark, d):
    rows = churn(spark, d)
    reports = [
        profile.numeric_stats(rows, "Age").select("column", "null_percentage"),
        profile.categorical_stats(rows, "Gender").select("column", "null_percentage"),
    ]
    return rounded(reports[0].unionByName(reports[1]))


THRESHOLDS = (30, 35, 40, 45, 50, 55, 60, 65)
RULE_SCORES = KEPT + f"""
, dealt AS (SELECT *, ntile(5) OVER (PARTITION BY Exited ORDER BY
    ('0x' || substr(md5('42:' || CustomerId), 1, 8))::BIGINT, CustomerId) AS fold
  FROM kept),
scores AS (SELECT t AS age_limit, fold, avg(CASE WHEN (Age > t) = (Exited = 1) THEN 1.0 ELSE 0.0 END) AS score
  FROM dealt, (VALUES {', '.join(f'({t})' for t in THRESHOLDS)}) g(t) GROUP BY t, fold),
means AS (SELECT age_limit, round(avg(score), 6) AS mean_test_score FROM scores GROUP BY age_limit)
"""


def _rule_means(spark, d):
    """Mean accuracy over folds of the rule 'older than t leaves'."""
    dealt = stratified_folds(kept(spark, d), "CustomerId", "Exited", 5)
    limits = F.explode(F.array(*[F.lit(t) for t in THRESHOLDS])).alias("age_limit")
    tried = dealt.select("fold", "Age", "Exited", limits)
    right = F.when((F.col("Age") > F.col("age_limit")) == (F.col("Exited") == 1), 1.0).otherwise(0.0)
    scores = tried.groupBy("age_limit", "fold").agg(F.avg(right).alias("score"))
    return scores.groupBy("age_limit").agg(F.round(F.avg("score"), 6).alias("mean_test_score"))


@query(
    "win_1_rank_combinations",
    RULE_SCORES
    + """SELECT age_limit, mean_test_score,
      rank() OVER (ORDER BY mean_test_score DESC) AS rank_test_score FROM means""",
)
def _(spark, d):
    return tuning.rank_scores(_rule_means(spark, d))


@query(
    "srt_4_best_combination",
    RULE_SCORES
    + """SELECT age_limit, mean_test_score AS best_score FROM means
    ORDER BY mean_test_score DESC, age_limit LIMIT 1""",
)
def _(spark, d):
    return tuning.best_by(_rule_means(spark, d), "age_limit", "mean_test_score")
