"""Whole jobs: layout, preparation, training."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowmill.catalog.base import KEPT, churn, query, rounded, table
from rowmill.catalog.sampling import HASH
from rowmill.catalog.scoring import PREPARED, features_sql
from rowmill.catalog.storage import SPLIT_SQL
from rowmill.operators import models
from rowmill.operators.layout import partition_target, right_size
from rowmill.plans import preparation, training
from rowmill.plans.settings import Settings
from rowmill.sources import workdir


@query(
    "lay_1_right_size",
    "SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY l_returnflag",
)
def _(spark, d):
    sized = right_size(table(spark, d, "lineitem"))
    return sized.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity")
    )


@query(
    "lay_1_partition_count",
    "SELECT greatest(1, least(200, count(*) // 10000), count(*) // 1000000) AS target FROM lineitem",
)
def _(spark, d):
    rows = table(spark, d, "lineitem").count()
    return spark.createDataFrame([(partition_target(rows),)], "target bigint")


ALL = Settings(fit_on="all")

SPLIT = f"""CASE WHEN row_number() OVER (PARTITION BY Exited ORDER BY {HASH.format(key='CustomerId')}, CustomerId)
  <= floor(0.2 * count(*) OVER (PARTITION BY Exited)) THEN 'test' ELSE 'train' END AS split"""


@query("cmp_1_prepare", PREPARED + f"SELECT CustomerId, Exited, {SPLIT}, " + features_sql("fine", ""))
def _(spark, d):
    prepared, _ = preparation.prepare(churn(spark, d), ALL)
    return rounded(prepared, 9)


@query(
    "cmp_1_summary",
    PREPARED
    + f""", dealt AS (SELECT fine.*, {SPLIT} FROM fine)
    SELECT count(*) AS total_rows, count(*) FILTER (split = 'train') AS train_rows,
      count(*) FILTER (split = 'test') AS test_rows, 16 AS num_features,
      count(*) FILTER (CreditScore < 300 OR CreditScore > 850) AS missing_values,
      (SELECT count(*) FROM kept) - count(*) AS outliers_removed, '0.2' AS test_size,
      '42' AS random_state, 'iqr' AS outlier_method, 'minmax' AS scaling FROM dealt""",
)
def _(spark, d):
    path = workdir.new_path(spark, "cmp1")
    summary, _ = preparation.run(churn(spark, d), path, ALL, "both")
    return summary


# statistics of the training part, applied to both parts
ON_TRAIN = KEPT + f""", dealt AS (SELECT *, {SPLIT} FROM kept),
a AS (SELECT avg(Age) AS mean_age FROM dealt WHERE split = 'train'),
filled AS (SELECT * REPLACE (coalesce(Age, mean_age) AS Age, coalesce(Gender, 'Unknown') AS Gender) FROM dealt, a),
q AS (SELECT
  quantile_cont(CreditScore::DOUBLE, 0.25) AS c1, quantile_cont(CreditScore::DOUBLE, 0.75) AS c3,
  quantile_cont(Age, 0.25) AS a1, quantile_cont(Age, 0.75) AS a3,
  quantile_cont(NumOfProducts::DOUBLE, 0.25) AS n1, quantile_cont(NumOfProducts::DOUBLE, 0.75) AS n3
  FROM filled WHERE split = 'train'),
fine AS (SELECT filled.* FROM filled, q WHERE
  (CreditScore < c1 - 1.5 * (c3 - c1) OR CreditScore > c3 + 1.5 * (c3 - c1))::INT
  + (Age < a1 - 1.5 * (a3 - a1) OR Age > a3 + 1.5 * (a3 - a1))::INT
  + (NumOfProducts < n1 - 1.5 * (n3 - n1) OR NumOfProducts > n3 + 1.5 * (n3 - n1))::INT < 2),
r AS (SELECT min(Balance) AS bl, max(Balance) AS bh, min(Age) AS gl, max(Age) AS gh,
  min(EstimatedSalary) AS sl, max(EstimatedSalary) AS sh FROM fine WHERE split = 'train')
"""


@query(
    "cmp_1_prepare_on_train",
    ON_TRAIN + "SELECT CustomerId, Exited, split, " + features_sql("fine", ""),
)
def _(spark, d):
    prepared, _ = preparation.prepare(churn(spark, d), Settings())
    return rounded(prepared, 9)


@query(
    "cmp_1_rebalanced",
    ON_TRAIN
    + """, c AS (SELECT split, Exited, count(*) AS rows FROM fine GROUP BY split, Exited),
    m AS (SELECT max(rows) AS top FROM c WHERE split = 'train')
    SELECT split, Exited, false AS synthetic, rows, rows AS ids FROM c
    UNION ALL SELECT split, Exited, true, top - rows, top - rows FROM c, m WHERE split = 'train' AND rows < top""",
)
def _(spark, d):
    """Equal classes in the training part, an untouched test part, and an id
    (key and copy) for every row."""
    settings = Settings(bin_otherwise="Poor", rebalance="smote")
    prepared, _ = preparation.prepare(churn(spark, d), settings)
    return prepared.groupBy("split", "Exited", (F.col("copy") > 0).alias("synthetic")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("CustomerId", "copy").alias("ids")
    )


@query("cmp_2_train")
def _(spark, d):
    path = workdir.new_path(spark, "cmp2")
    preparation.run(churn(spark, d), path, ALL)
    summary, _ = training.run(
        spark, path, model="random_forest",
        model_path=workdir.new_path(spark, "cmp2-model"),
    )
    return rounded(summary.drop("seconds"))


@query(
    "cmp_2_reuse",
    PREPARED
    + f""", dealt AS (SELECT fine.*, {SPLIT} FROM fine)
    SELECT count(*) FILTER (split = 'train' AND CreditScore BETWEEN 300 AND 850) AS train_rows,
      count(*) FILTER (split = 'test' AND CreditScore BETWEEN 300 AND 850) AS test_rows, 16 AS num_features,
      true AS reused, true AS rebuilt FROM dealt""",
)
def _(spark, d):
    """Training that prepares absent parts first; parts of equal settings are
    taken as they are, parts of others are made again."""
    path, source = workdir.new_path(spark, "cmp2"), churn(spark, d)
    summary, _ = training.run(
        spark, path, source=source, settings=ALL, model="decision_tree", max_depth=5
    )

    def files():
        return sorted(spark.read.parquet(f"{path}/parquet").inputFiles())

    first = files()
    preparation.run(source, path, ALL, force_rebuild=False)
    reused = files() == first
    preparation.run(source, path, ALL.with_options(scaling="standard"), force_rebuild=False)
    return summary.select(
        "train_rows", "test_rows", "num_features",
        F.lit(reused).alias("reused"), F.lit(files() != first).alias("rebuilt"),
    )


@query("cmp_2_tune")
def _(spark, d):
    """The default grid of the decision tree."""
    prepared, _ = preparation.prepare(churn(spark, d), ALL)
    summary, _ = training.train(prepared, "decision_tree", grid=models.GRIDS["decision_tree"], folds=5)
    return rounded(summary.drop("seconds"))


@query(
    "cmp_3_settings",
    KEPT
    + f""", parts AS (SELECT *, {SPLIT_SQL.format(key='CustomerId', share=0.2)} AS split FROM kept),
    c AS (SELECT Firstname, Gender, count(*) AS n FROM parts WHERE Gender IS NOT NULL AND split = 'train' GROUP BY ALL),
    best AS (SELECT Firstname AS fn, Gender AS g FROM c
      QUALIFY row_number() OVER (PARTITION BY Firstname ORDER BY n DESC, Gender) = 1),
    mode AS (SELECT Gender AS m FROM c GROUP BY Gender ORDER BY sum(n) DESC, Gender LIMIT 1),
    dealt AS (SELECT parts.* REPLACE (coalesce(Gender, g, m) AS Gender)
      FROM parts LEFT JOIN best ON Firstname = fn, mode),
    t AS (SELECT quantile_cont(Age, 0.5) AS med FROM dealt WHERE split = 'train'),
    full_ AS (SELECT * REPLACE (coalesce(Age, med) AS Age) FROM dealt, t),
    b AS (SELECT avg(CreditScore) AS cm, 3 * stddev_samp(CreditScore) AS cs, avg(Age) AS am,
      3 * stddev_samp(Age) AS asd, avg(NumOfProducts) AS nm, 3 * stddev_samp(NumOfProducts) AS ns
      FROM full_ WHERE split = 'train'),
    capped AS (SELECT full_.* REPLACE (greatest(least(CreditScore, cm + cs), cm - cs) AS CreditScore,
        greatest(least(Age, am + asd), am - asd) AS Age,
        greatest(least(NumOfProducts, nm + ns), nm - ns) AS NumOfProducts) FROM full_, b),
    s AS (SELECT avg(Balance) AS bm, stddev_pop(Balance) AS bs, avg(Age) AS gm, stddev_pop(Age) AS gs,
      avg(EstimatedSalary) AS em, stddev_pop(EstimatedSalary) AS es FROM capped WHERE split = 'train')
    SELECT CustomerId, Exited, split, round((Age - gm) / gs, 6) AS "Age", Tenure,
      round((Balance - bm) / bs, 6) AS "Balance", round(NumOfProducts, 6) AS "NumOfProducts", HasCrCard,
      IsActiveMember, round((EstimatedSalary - em) / es, 6) AS "EstimatedSalary",
      CASE WHEN CreditScore = 850 THEN 4 WHEN CreditScore BETWEEN 300 AND 580 THEN 0
        WHEN CreditScore BETWEEN 580 AND 670 THEN 1 WHEN CreditScore BETWEEN 670 AND 740 THEN 2
        WHEN CreditScore BETWEEN 740 AND 800 THEN 3 WHEN CreditScore BETWEEN 800 AND 850 THEN 4 END
        AS "CreditScoreBins",
      (Geography = 'AFRICA')::INT AS "Geography_AFRICA", (Geography = 'AMERICA')::INT AS "Geography_AMERICA",
      (Geography = 'ASIA')::INT AS "Geography_ASIA", (Geography = 'EUROPE')::INT AS "Geography_EUROPE",
      (Geography = 'MIDDLE EAST')::INT AS "Geography_MIDDLE_EAST", (Gender = 'Female')::INT AS "Gender_Female",
      (Gender = 'Male')::INT AS "Gender_Male" FROM capped, s""",
)
def _(spark, d):
    """The preparation under other settings: predicted gender, sigma bounds,
    capping, standard scaling and a random split."""
    settings = Settings().with_options(
        predict_labels={"Gender": ("Firstname",)}, detection_method="sigma", outlier_method="cap",
        scaling="standard", split_method="random", fill_methods={"Age": "median"},
    )
    prepared, _ = preparation.prepare(churn(spark, d), settings)
    return rounded(prepared)
