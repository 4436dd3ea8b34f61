"""Registration and the input tables of the queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.functions.columns import col, is_floating, unpivot_row


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with its SQL check if there is one."""

    def register(run):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(run, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6, only: list[str] | None = None) -> DataFrame:
    """Floating columns rounded, so that the order of summation does not show."""
    names = [
        f.name for f in df.schema.fields if is_floating(f.dataType) and (not only or f.name in only)
    ]
    return df.withColumns({n: F.round(col(n), digits) for n in names})


def close_quantiles(df: DataFrame, found: dict[tuple[str, float], float], error: float) -> DataFrame:
    """Whether the rank of each found quantile is within the error, by counting."""
    shares, rows = [], []
    for i, ((c, p), q) in enumerate(found.items()):
        n = F.count(col(c))
        shares += [
            (F.count_if(col(c) < q) / n).alias(f"under{i}"),
            (F.count_if(col(c) <= q) / n).alias(f"upto{i}"),
        ]
        close = (F.col(f"under{i}") <= p + error) & (F.col(f"upto{i}") >= p - error)
        rows.append({"column": F.lit(c), "probability": F.lit(p), "close": close})
    return unpivot_row(df.agg(*shares), rows)


def churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer, with gaps, outliers and values on bin edges.

    The orders are read once: what happened before the cut-off date describes
    the customer, an order after it means the customer stayed.
    """
    cutoff = F.lit("2000-07-01 00:00:00").cast("timestamp_ntz")
    before = F.col("o_orderdate") < cutoff
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count_if(before).alias("n_orders"),
        F.max(F.when(before, F.col("o_totalprice"))).alias("max_spend"),
        F.min(F.when(before, F.col("o_orderdate"))).alias("first_dt"),
        F.max(F.when(before, F.col("o_orderdate"))).alias("last_dt"),
        F.coalesce(F.bool_or(~before), F.lit(False)).alias("stayed"),
    )
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    )
    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    segment = F.col("c_mktsegment")
    recent = F.col("last_dt") >= F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
    return customers.select(
        (key + 1).alias("RowNumber"),
        key.alias("CustomerId"),
        F.when(key % 101 != 7, F.concat(F.lit("F"), (key % 97).cast("string"))).alias("Firstname"),
        F.concat(F.lit("L"), (key % 89).cast("string")).alias("Lastname"),
        F.when(key % 83 == 11, 850)
        .when(key % 83 == 12, 870)
        .when(key % 83 == 13, 290)
        .otherwise((F.lit(300) + F.floor((balance + 1000.0) / 20.0)).cast("int"))
        .alias("CreditScore"),
        F.col("r_name").alias("Geography"),
        F.when(key % 17 != 3, F.when(segment.isin("MACHINERY", "AUTOMOBILE"), "Male").otherwise("Female"))
        .alias("Gender"),
        F.when(key % 13 != 5, F.when(key % 53 == 1, 130).otherwise(18 + (key * 31) % 47))
        .cast("double")
        .alias("Age"),
        F.coalesce(2000 - F.year("first_dt"), F.lit(0)).alias("Tenure"),
        F.when(balance < 0, 0.0).otherwise(balance).alias("Balance"),
        (F.coalesce("n_orders", F.lit(0)) + F.when((key % 53).isin(1, 2), 30).otherwise(0))
        .cast("int")
        .alias("NumOfProducts"),
        F.when(segment == "BUILDING", 0).otherwise(1).alias("HasCrCard"),
        F.when(recent, 1).otherwise(0).alias("IsActiveMember"),
        F.coalesce("max_spend", F.lit(0.0)).alias("EstimatedSalary"),
        F.when(F.coalesce("stayed", F.lit(False)), 0).otherwise(1).alias("Exited"),
    )


def kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Churn rows with a first name."""
    from rowmill.operators.project import drop_missing

    return drop_missing(churn(spark, sf_dir), ["Firstname"])


def filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Those rows with the mean age filled in."""
    from rowmill.operators.impute import fill

    return fill(kept(spark, sf_dir), "Age", "mean")


# The same tables as SQL.
CHURN = """WITH hist AS (
  SELECT o_custkey, count(*) AS n_orders, max(o_totalprice) AS max_spend,
         min(o_orderdate) AS first_dt, max(o_orderdate) AS last_dt
  FROM orders WHERE o_orderdate < TIMESTAMP '2000-07-01 00:00:00' GROUP BY o_custkey),
fut AS (
  SELECT DISTINCT o_custkey AS fk
  FROM orders WHERE o_orderdate >= TIMESTAMP '2000-07-01 00:00:00'),
churn AS (
SELECT c_custkey + 1 AS RowNumber,
  c_custkey AS CustomerId,
  CASE WHEN c_custkey % 101 = 7 THEN NULL
       ELSE concat('F', CAST(c_custkey % 97 AS VARCHAR)) END AS Firstname,
  concat('L', CAST(c_custkey % 89 AS VARCHAR)) AS Lastname,
  CASE WHEN c_custkey % 83 = 11 THEN 850 WHEN c_custkey % 83 = 12 THEN 870
       WHEN c_custkey % 83 = 13 THEN 290
       ELSE CAST(300 + floor((c_acctbal + 1000.0) / 20.0) AS INT) END AS CreditScore,
  r_name AS Geography,
  CASE WHEN c_custkey % 17 = 3 THEN NULL
       WHEN c_mktsegment IN ('MACHINERY', 'AUTOMOBILE') THEN 'Male' ELSE 'Female' END AS Gender,
  CAST(CASE WHEN c_custkey % 13 = 5 THEN NULL WHEN c_custkey % 53 = 1 THEN 130
       ELSE 18 + (c_custkey * 31) % 47 END AS DOUBLE) AS Age,
  CAST(coalesce(2000 - year(first_dt), 0) AS INT) AS Tenure,
  CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS Balance,
  CAST(coalesce(n_orders, 0) + CASE WHEN c_custkey % 53 IN (1, 2) THEN 30 ELSE 0 END AS INT)
    AS NumOfProducts,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE 1 END AS HasCrCard,
  CASE WHEN last_dt >= TIMESTAMP '2000-01-01 00:00:00' THEN 1 ELSE 0 END AS IsActiveMember,
  coalesce(max_spend, 0.0) AS EstimatedSalary,
  CASE WHEN fk IS NULL THEN 1 ELSE 0 END AS Exited
FROM customer
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
LEFT JOIN hist ON c_custkey = hist.o_custkey
LEFT JOIN fut ON c_custkey = fk)
"""
KEPT = CHURN + ", kept AS (SELECT * FROM churn WHERE Firstname IS NOT NULL)\n"
FILLED = KEPT + (
    ", filled AS (SELECT * REPLACE (coalesce(Age, (SELECT avg(Age) FROM kept)) AS Age) FROM kept)\n"
)
