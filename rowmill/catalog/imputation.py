"""Imputation and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowmill.catalog.base import (
    CHURN, FILLED, KEPT, churn, close_quantiles, filled, kept, query, rounded, table,
)
from rowmill.catalog.profiling import GAPS, _gaps
from rowmill.functions.scalar import map_values
from rowmill.operators import encode, impute, lookup


@query("imp_1_mean", FILLED + "SELECT CustomerId, round(Age, 6) AS Age FROM filled")
def _(spark, d):
    return rounded(filled(spark, d).select("CustomerId", "Age"))


@query(
    "imp_1_mean_of_integers",
    CHURN
    + """, gaps AS (SELECT CustomerId, CASE WHEN CustomerId % 9 = 4 THEN NULL ELSE Tenure END AS Tenure
      FROM churn)
    SELECT CustomerId, round(coalesce(Tenure, (SELECT avg(Tenure) FROM gaps)), 6) AS Tenure FROM gaps""",
)
def _(spark, d):
    gaps = churn(spark, d).select(
        "CustomerId", F.when(F.col("CustomerId") % 9 != 4, F.col("Tenure")).alias("Tenure")
    )
    return rounded(impute.fill(gaps, "Tenure", "mean"))


@query(
    "imp_1_mean_with_nan",
    GAPS
    + """, ok AS (SELECT avg(value) AS m FROM gaps WHERE NOT isnan(value))
    SELECT event_id, round(CASE WHEN value IS NULL OR isnan(value) THEN m ELSE value END, 6) AS value
    FROM gaps, ok""",
)
def _(spark, d):
    return rounded(impute.fill(_gaps(spark, d).select("event_id", "value"), "value", "mean"))


@query(
    "imp_2_rounded_mean",
    KEPT + "SELECT CustomerId, coalesce(Age, (SELECT round(avg(Age), 2) FROM kept)) AS Age FROM kept",
)
def _(spark, d):
    return impute.fill(kept(spark, d), "Age", "mean", digits=2).select("CustomerId", "Age")


@query(
    "imp_3_median",
    KEPT
    + "SELECT CustomerId, coalesce(Age, (SELECT quantile_cont(Age, 0.5) FROM kept)) AS Age FROM kept",
)
def _(spark, d):
    return impute.fill(kept(spark, d), "Age", "median").select("CustomerId", "Age")


@query(
    "imp_3_median_approx",
    KEPT + "SELECT 'Age' AS column, 0.5::DOUBLE AS probability, count(*) > 0 AS close FROM kept",
)
def _(spark, d):
    rows = kept(spark, d).select("Age")
    median = impute.fit_fill(rows, "Age", "median", relative_error=0.01)["Age"]
    return close_quantiles(rows, {("Age", 0.5): median}, 0.01)


@query(
    "imp_4_mode",
    CHURN
    + """SELECT CustomerId, coalesce(Gender, (SELECT Gender FROM churn WHERE Gender IS NOT NULL
      GROUP BY Gender ORDER BY count(*) DESC, Gender LIMIT 1)) AS Gender FROM churn""",
)
def _(spark, d):
    return impute.fill(churn(spark, d), "Gender", "mode").select("CustomerId", "Gender")


@query(
    "imp_5_constant",
    CHURN + "SELECT CustomerId, coalesce(Gender, 'missing') AS Gender FROM churn",
)
def _(spark, d):
    filled_ = impute.fill(churn(spark, d), "Gender", "constant", value="missing")
    return filled_.select("CustomerId", "Gender")


@query(
    "imp_6_constant_everywhere",
    CHURN
    + """SELECT CustomerId, coalesce(Firstname, 'none') AS Firstname, coalesce(Gender, 'none') AS Gender, Age
    FROM churn""",
)
def _(spark, d):
    rows = churn(spark, d).select("CustomerId", "Firstname", "Gender", "Age")
    return impute.fill_all_constant(rows, "none")


@query(
    "imp_7_all_numeric",
    CHURN
    + """, gaps AS (SELECT CustomerId, Age, Gender,
      CASE WHEN CustomerId % 4 = 0 THEN NULL ELSE Tenure END AS Tenure,
      CASE WHEN CustomerId % 6 = 1 THEN NULL ELSE Balance END AS Balance FROM churn)
    SELECT CustomerId::DOUBLE AS CustomerId, Gender, round(coalesce(Age, (SELECT avg(Age) FROM gaps)), 4) AS Age,
      round(coalesce(Tenure, (SELECT avg(Tenure) FROM gaps)), 4) AS Tenure,
      round(coalesce(Balance, (SELECT avg(Balance) FROM gaps)), 4) AS Balance FROM gaps""",
)
def _(spark, d):
    key = F.col("CustomerId")
    gaps = churn(spark, d).select(
        "CustomerId",
        "Age",
        "Gender",
        F.when(key % 4 != 0, F.col("Tenure")).alias("Tenure"),
        F.when(key % 6 != 1, F.col("Balance")).alias("Balance"),
    )
    return rounded(impute.apply_fill(gaps, impute.fit_fill_numeric(gaps, "any")), 4)


@query(
    "imp_8_unknown_category",
    CHURN
    + "SELECT coalesce(Gender, 'Unknown') AS Gender, count(*) AS n FROM churn GROUP BY 1",
)
def _(spark, d):
    rows = impute.fill_category(churn(spark, d), "Gender")
    return rows.groupBy("Gender").agg(F.count(F.lit(1)).alias("n"))


@query(
    "imp_9_predicted_category",
    KEPT
    + """, c AS (SELECT Firstname, Gender, count(*) AS n FROM kept WHERE Gender IS NOT NULL GROUP BY ALL),
    best AS (SELECT Firstname, Gender AS g FROM c
      QUALIFY row_number() OVER (PARTITION BY Firstname ORDER BY n DESC, Gender) = 1),
    mode AS (SELECT Gender AS m FROM c GROUP BY Gender ORDER BY sum(n) DESC, Gender LIMIT 1)
    SELECT CustomerId, kept.Firstname, coalesce(Gender, g, m) AS Gender
    FROM kept LEFT JOIN best ON kept.Firstname = best.Firstname, mode""",
)
def _(spark, d):
    rows = kept(spark, d)
    predictor = impute.fit_category_predictor(rows, ["Firstname"], "Gender", ["Male", "Female"])
    return impute.apply_category_predictor(rows, predictor).select("CustomerId", "Firstname", "Gender")


@query(
    "imp_10_own_imputer",
    CHURN + "SELECT CustomerId, coalesce(Gender, Geography) AS Gender FROM churn",
)
def _(spark, d):
    class FromRegion:
        def impute(self, df):
            return df.withColumn("Gender", F.coalesce("Gender", "Geography"))

    return impute.with_imputer(churn(spark, d), FromRegion()).select("CustomerId", "Gender")


@query(
    "imp_11_validated",
    """SELECT c_custkey, CASE WHEN trim(c_mktsegment || ' ') IN ('BUILDING', 'MACHINERY')
      THEN c_mktsegment END AS segment FROM customer""",
)
def _(spark, d):
    said = table(spark, d, "customer").select(
        "c_custkey", F.concat("c_mktsegment", F.lit(" ")).alias("segment")
    )
    return impute.validate_domain(said, "segment", ["BUILDING", "MACHINERY"])


@query(
    "imp_11_domain_report",
    CHURN
    + """SELECT count(*) FILTER (Gender = 'Male') AS accepted,
    count(*) FILTER (Gender <> 'Male') AS rejected, count(*) FILTER (Gender IS NULL) AS missing FROM churn""",
)
def _(spark, d):
    return impute.domain_report(churn(spark, d), "Gender", ["Male"])


@query(
    "jon_1_left_two_keys",
    KEPT
    + """, pred AS (SELECT Firstname, Lastname, min(Geography) AS PredictedRegion FROM kept
      WHERE Gender IS NULL GROUP BY Firstname, Lastname)
    SELECT CustomerId, kept.Firstname, kept.Lastname, PredictedRegion FROM kept
    LEFT JOIN pred ON kept.Firstname = pred.Firstname AND kept.Lastname = pred.Lastname""",
)
def _(spark, d):
    rows = kept(spark, d)
    predicted = rows.filter(F.col("Gender").isNull()).select(
        "Firstname", "Lastname", F.col("Geography").alias("PredictedRegion")
    )
    joined = lookup.left_lookup(
        rows.select("CustomerId", "Firstname", "Lastname"),
        predicted, ["Firstname", "Lastname"], "PredictedRegion",
    )
    return joined.select("CustomerId", "Firstname", "Lastname", "PredictedRegion")


@query(
    "jon_2_map_lookup",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1
      WHEN '3-MEDIUM' THEN 2 END AS code FROM orders""",
)
def _(spark, d):
    codes = {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2}
    return table(spark, d, "orders").select(
        "o_orderkey", map_values(F.col("o_orderpriority"), codes).alias("code")
    )


@query(
    "jon_2_large_lookup",
    """WITH names AS (SELECT o_custkey, row_number() OVER (ORDER BY o_custkey) - 1 AS code
      FROM (SELECT DISTINCT o_custkey FROM orders))
    SELECT o_orderkey, code FROM orders JOIN names USING (o_custkey)""",
)
def _(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    index = encode.fit_label_index(orders, "o_custkey", "alphabet")
    return encode.apply_label_index(orders, index, "code").select("o_orderkey", "code")


@query(
    "jon_3_scalar_statistics",
    """SELECT o_orderkey, round(o_totalprice - m, 4) AS above_mean,
      round((o_totalprice - lo) / (hi - lo), 6) AS position
    FROM orders, (SELECT avg(o_totalprice) AS m, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)""",
)
def _(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    mean = impute.fit_fill(orders, "o_totalprice", "mean")["o_totalprice"]
    from rowmill.operators.scale import fit_min_max

    low, width = fit_min_max(orders, ["o_totalprice"])["o_totalprice"]
    price = F.col("o_totalprice")
    return orders.select(
        "o_orderkey",
        F.round(price - F.lit(mean), 4).alias("above_mean"),
        F.round((price - F.lit(low)) / F.lit(width), 6).alias("position"),
    )
