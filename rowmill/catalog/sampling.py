"""Splits, folds, samples, neighbours and oversampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowmill.catalog.base import CHURN, KEPT, churn, filled, kept, query, rounded, table
from rowmill.catalog.storage import SPLIT_SQL
from rowmill.functions.ordering import rank_in_class
from rowmill.operators import neighbors, rebalance, split

HASH = "('0x' || substr(md5('42:' || {key}), 1, 8))::BIGINT"


@query(
    "spl_1_random",
    f"SELECT o_orderkey, {SPLIT_SQL.format(key='o_orderkey', share=0.2)} AS split FROM orders",
)
def _(spark, d):
    return split.random_split(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 0.2)


@query(
    "spl_2_stratified",
    CHURN
    + f"""SELECT CustomerId, Exited, CASE WHEN row_number() OVER (PARTITION BY Exited
        ORDER BY {HASH.format(key='CustomerId')}, CustomerId)
        <= floor(0.2 * count(*) OVER (PARTITION BY Exited)) THEN 'test' ELSE 'train' END AS split FROM churn""",
)
def _(spark, d):
    rows = churn(spark, d).select("CustomerId", "Exited")
    return split.stratified_split(rows, "CustomerId", "Exited", 0.2)


@query(
    "spl_2_stratified_many_classes",
    f"""SELECT o_orderkey, o_custkey, CASE WHEN row_number() OVER (PARTITION BY o_custkey
        ORDER BY {HASH.format(key='o_orderkey')}, o_orderkey)
        <= floor(0.3 * count(*) OVER (PARTITION BY o_custkey)) THEN 'test' ELSE 'train' END AS split FROM orders""",
)
def _(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return split.stratified_split(rows, "o_orderkey", "o_custkey", 0.3)


@query(
    "spl_3_folds",
    f"""SELECT o_orderkey, o_orderpriority, ntile(6) OVER (PARTITION BY o_orderpriority
        ORDER BY {HASH.format(key='o_orderkey')}, o_orderkey) - 1 AS fold FROM orders""",
)
def _(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return split.stratified_folds(rows, "o_orderkey", "o_orderpriority", 6)


@query(
    "spl_4_by_method",
    f"""SELECT p_partkey, {SPLIT_SQL.format(key='p_partkey', share=0.3)} AS random,
      CASE WHEN row_number() OVER (PARTITION BY p_type ORDER BY {HASH.format(key='p_partkey')}, p_partkey)
        <= floor(0.3 * count(*) OVER (PARTITION BY p_type)) THEN 'test' ELSE 'train' END AS stratified FROM part""",
)
def _(spark, d):
    rows = table(spark, d, "part").select("p_partkey", "p_type")
    both = split.split(rows, "p_partkey", method="random", test_size=0.3, output="random")
    both = split.split(both, "p_partkey", "p_type", "stratified", 0.3, output="stratified")
    return both.drop("p_type")


@query(
    "smp_1_fraction",
    f"SELECT event_id FROM events WHERE {HASH.format(key='event_id')} / 4294967296.0 < 0.1",
)
def _(spark, d):
    return split.sample(table(spark, d, "events").select("event_id"), fraction=0.1, key="event_id")


@query("smp_1_fraction_seeded")
def _(spark, d):
    return split.sample(table(spark, d, "events").select("event_id"), fraction=0.1)


@query(
    "smp_2_rows",
    f"SELECT o_orderkey FROM orders ORDER BY {HASH.format(key='o_orderkey')}, o_orderkey LIMIT 777",
)
def _(spark, d):
    return split.sample(table(spark, d, "orders").select("o_orderkey"), n=777, key="o_orderkey")


@query(
    "win_2_rank_in_class",
    f"""SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus
        ORDER BY {HASH.format(key='o_orderkey')}, o_orderkey) AS rank,
      count(*) OVER (PARTITION BY o_orderstatus) AS size FROM orders""",
)
def _(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return rank_in_class(rows, "o_orderkey", "o_orderstatus", "rank", "size")


@query(
    "win_3_nearest_rows",
    CHURN
    + """, p AS (SELECT min(CustomerId) AS id, Balance AS b, EstimatedSalary AS s FROM churn
      WHERE Exited = 1 GROUP BY Balance, EstimatedSalary),
    n AS (SELECT p.id, q.id AS neighbor,
      row_number() OVER (PARTITION BY p.id
        ORDER BY (p.b - q.b) * (p.b - q.b) + (p.s - q.s) * (p.s - q.s), q.id) AS place
      FROM p JOIN p q ON p.id <> q.id)
    SELECT id, place, neighbor FROM n WHERE place <= 5""",
)
def _(spark, d):
    vec = F.array("Balance", "EstimatedSalary")
    points = (
        churn(spark, d).filter(F.col("Exited") == 1).groupBy(vec.alias("vec"))
        .agg(F.min("CustomerId").alias("id"), F.count(F.lit(1)).alias("copies"))
        .select("id", "vec", "copies")
    )
    near = neighbors.nearest_points(points, 5, cell_rows=64)
    return near.select("id", F.posexplode("near").alias("place", "n")).select(
        "id", (F.col("place") + 1).alias("place"), F.col("n.id").alias("neighbor")
    )


FEATURES = ["Age", "Tenure", "Balance", "NumOfProducts", "EstimatedSalary"]

# oversampling is for the training part of a stratified split
TRAIN_PART = KEPT + f""", dealt AS (SELECT *, row_number() OVER (PARTITION BY Exited
    ORDER BY {HASH.format(key='CustomerId')}, CustomerId) > floor(0.2 * count(*) OVER (PARTITION BY Exited)) AS train
  FROM kept), c AS (SELECT Exited, count(*) AS n FROM dealt WHERE train GROUP BY Exited)
"""


def _train_part(spark, d):
    parts = split.stratified_split(filled(spark, d), "CustomerId", "Exited", 0.2)
    return split.split_parts(parts)[0]


@query(
    "rsm_1_smote_counts",
    TRAIN_PART
    + """, m AS (SELECT max(n) AS top FROM c)
    SELECT Exited, false AS synthetic, n AS rows FROM c
    UNION ALL SELECT Exited, true, top - n FROM c, m WHERE n < top""",
)
def _(spark, d):
    balanced = rebalance.smote(_train_part(spark, d), "CustomerId", "Exited", FEATURES)
    return balanced.groupBy("Exited", "synthetic").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "rsm_1_smote_between_parents",
    TRAIN_PART
    + """SELECT max(n) - min(n) AS rows, max(n) - min(n) AS between_parents, max(n) - min(n) AS parents_found FROM c""",
)
def _(spark, d):
    rows = _train_part(spark, d)
    sizes = rebalance.class_sizes(rows, "Exited")
    need = max(sizes.values()) - min(sizes.values())
    minority = min(sizes, key=sizes.get)
    made = rebalance.synthetic_rows(rows, "CustomerId", "Exited", FEATURES, minority, need)
    inside = F.forall(
        F.arrays_zip("base", "neighbor", "vec"),
        lambda x: (x["vec"] >= F.least(x["base"], x["neighbor"]) - 1e-6)
        & (x["vec"] <= F.greatest(x["base"], x["neighbor"]) + 1e-6),
    )
    known = rows.filter(F.col("Exited") == minority).select(
        F.array(*[F.col(f).cast("double") for f in FEATURES]).alias("neighbor")
    ).distinct().withColumn("known", F.lit(1))
    return made.join(known, "neighbor", "left").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(inside).alias("between_parents"),
        F.count("known").alias("parents_found"),
    )


@query("rsm_1_smote_rows")
def _(spark, d):
    return rounded(rebalance.smote(_train_part(spark, d), "CustomerId", "Exited", FEATURES))
