"""Sources and sinks: write, read back, compare with the table."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowmill.catalog.base import CHURN, KEPT, churn, filled, kept, query, table
from rowmill.operators import binning, impute, project, split
from rowmill.operators.profile import preview
from rowmill.sources import checks, readers, workdir, writers

CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query("src_1_csv_scan", "SELECT * FROM customer")
def _(spark, d):
    path = workdir.new_path(spark, "src1") + ".csv"
    writers.save(table(spark, d, "customer"), path, "csv")
    return project.cast_columns(readers.read_csv(spark, path), {"c_custkey": "bigint"})


@query("src_2_parquet_scan", "SELECT * FROM part")
def _(spark, d):
    return readers.read_parquet(spark, f"{d}/part.parquet")


@query("src_3_load_json", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def _(spark, d):
    path = workdir.new_path(spark, "src3")
    writers.save(table(spark, d, "supplier"), path, "json")
    loaded = readers.load(spark, path, "json")
    return project.cast_columns(loaded, {"s_nationkey": "int"}).select(
        "s_suppkey", "s_name", "s_nationkey", "s_acctbal"
    )


@query("src_4_enforced_schema", "SELECT * FROM customer")
def _(spark, d):
    path = workdir.new_path(spark, "src4")
    writers.save(table(spark, d, "customer"), path, "csv")
    return readers.load(spark, path, "csv", CUSTOMER)


@query("src_5_by_extension", "SELECT * FROM nation")
def _(spark, d):
    return readers.ingest(spark, f"{d}/nation.parquet")


@query("src_6_records", "SELECT * FROM customer")
def _(spark, d):
    customer = table(spark, d, "customer")
    pairs = [x for c in customer.columns for x in (F.lit(c), F.col(c).cast("string"))]
    records = customer.select(F.create_map(*pairs).alias("record"))
    return readers.expand_records(records, "record", CUSTOMER)


SPLIT_SQL = """
  CASE WHEN ('0x' || substr(md5('42:' || {key}), 1, 8))::BIGINT / 4294967296.0 < {share}
       THEN 'test' ELSE 'train' END"""


@query(
    "src_7_reload_parts",
    f"SELECT *, {SPLIT_SQL.format(key='c_custkey', share=0.2)} AS split FROM customer",
)
def _(spark, d):
    path = workdir.new_path(spark, "src7")
    parts = split.random_split(table(spark, d, "customer"), "c_custkey", 0.2)
    writers.write_splits(parts, path, "csv")
    return readers.read_splits(spark, path, "csv", f"{CUSTOMER}, split string")


@query(
    "snk_1_save_modes",
    "SELECT p_brand, 2 * count(*) AS n, 2 * sum(p_size)::BIGINT AS size FROM part GROUP BY p_brand",
)
def _(spark, d):
    path = workdir.new_path(spark, "snk1")
    part = table(spark, d, "part")
    writers.save(part, path, "parquet", "overwrite")
    writers.save(part, path, "parquet", "append")
    writers.save(part, path, "parquet", "ignore")
    return (
        readers.load(spark, path)
        .groupBy("p_brand")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("p_size").alias("size"))
    )


@query(
    "snk_2_write_parts",
    CHURN
    + f""", parts AS (SELECT Exited, {SPLIT_SQL.format(key='CustomerId', share=0.25)} AS split FROM churn)
    SELECT f AS format, split, Exited, count(*) AS n
    FROM parts, (VALUES ('csv'), ('parquet')) t(f) GROUP BY ALL""",
)
def _(spark, d):
    path = workdir.new_path(spark, "snk2")
    table_ = churn(spark, d)
    writers.write_splits(split.random_split(table_, "CustomerId", 0.25), path, "both")
    schema = table_.schema.add("split", "string")
    parts = [
        readers.read_splits(spark, path, f, schema).select(F.lit(f).alias("format"), "split", "Exited")
        for f in ("csv", "parquet")
    ]
    return parts[0].unionByName(parts[1]).groupBy("format", "split", "Exited").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "snk_3_reuse_output",
    "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority",
)
def _(spark, d):
    path = workdir.new_path(spark, "snk3")

    def build():
        return table(spark, d, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))

    def must_not_run():
        raise AssertionError("a finished output was built again")

    writers.reuse_or_build(spark, path, build)
    return writers.reuse_or_build(spark, path, must_not_run)


@query(
    "snk_4_stage_imputed",
    KEPT
    + """SELECT CustomerId, round(coalesce(Age, (SELECT avg(Age) FROM kept)), 6) AS Age,
    coalesce(Gender, 'Unknown') AS Gender FROM kept""",
)
def _(spark, d):
    imputed = impute.fill_category(filled(spark, d), "Gender")
    staged = workdir.stage(imputed, "snk4")
    return staged.select("CustomerId", F.round("Age", 6).alias("Age"), "Gender")


@query("snk_5_bounded_rows", "SELECT * FROM customer ORDER BY c_custkey LIMIT 20")
def _(spark, d):
    customer = table(spark, d, "customer")
    local = writers.to_local(preview(customer, "c_custkey", 20), 20)
    return spark.createDataFrame(local, customer.schema)


@query(
    "snk_6_stage_files",
    KEPT
    + """, binned AS (SELECT CASE WHEN CreditScore < 580 THEN 'Poor' WHEN CreditScore < 670 THEN 'Fair'
      WHEN CreditScore < 740 THEN 'Good' WHEN CreditScore < 800 THEN 'Very Good'
      WHEN CreditScore <= 850 THEN 'Excellent' END AS CreditScoreBins, Age FROM kept)
    SELECT CreditScoreBins, count(*) AS n, count(Age) AS with_age FROM binned GROUP BY 1""",
)
def _(spark, d):
    first = workdir.new_path(spark, "snk6-handled")
    second = workdir.new_path(spark, "snk6-binned")
    handled = project.drop_existing(kept(spark, d), ["RowNumber", "CustomerId", "Firstname", "Lastname"])
    writers.save(handled, first, "csv")
    loaded = readers.load(spark, first, "csv", handled.schema)
    binned = binning.bin_column(loaded, "CreditScore", binning.CREDIT_SCORE_BINS, closed="left")
    writers.save(binned, second, "csv")
    return (
        readers.load(spark, second, "csv", binned.schema)
        .groupBy("CreditScoreBins")
        .agg(F.count(F.lit(1)).alias("n"), F.count("Age").alias("with_age"))
    )


@query(
    "snk_7_checks",
    f"""WITH parts AS (SELECT *, {SPLIT_SQL.format(key='c_custkey', share=0.2)} AS split FROM customer)
    SELECT 'customer: has rows' AS rule, count(*) AS observed, count(*) > 0 AS passed FROM parts
    UNION ALL SELECT 'customer: has its 3 columns', 2, false
    UNION ALL SELECT 'part train: has rows', count(*), count(*) > 0 FROM parts WHERE split = 'train'
    UNION ALL SELECT 'part test: has rows', count(*), count(*) > 0 FROM parts WHERE split = 'test'""",
)
def _(spark, d):
    customer = table(spark, d, "customer")
    expected = ["c_custkey", "c_acctbal", "c_absent"]
    parts = split.random_split(customer, "c_custkey", 0.2)
    return checks.check_table(customer, expected, "customer").unionByName(checks.check_splits(parts))
