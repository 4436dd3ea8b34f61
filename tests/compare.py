"""Run registered queries beside their SQL checks and compare the results."""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def session(cores: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("rowmill-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, repr(v))
    if isinstance(v, float):
        return (1, "nan" if math.isnan(v) else repr(v + 0.0))
    if isinstance(v, (list, tuple)):
        return (1, repr([_cell(x) for x in v]))
    if isinstance(v, int):
        return (1, repr(v))
    return (1, str(v))


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(_cell(r[i]) for i in order) for r in rows])


def compare(spark, con, folder, run, sql) -> tuple[str, int]:
    """'ok', 'rows only' or what differs, and the number of rows."""
    df = run(spark, folder)
    rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return "rows only", len(rows)
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}", len(rows)
    if len(rows) != len(expected):
        return f"{len(rows)} rows vs {len(expected)}", len(rows)
    a, b = canonical(df.columns, rows), canonical(names, expected)
    for x, y in zip(a, b):
        if x != y:
            return f"row {x} vs {y}", len(rows)
    return "ok", len(rows)


def main(folder: str, names: list[str]) -> int:
    from rowmill.catalog import all_queries

    spark, con, bad = session(), database(folder), 0
    for name, q in all_queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.perf_counter()
        try:
            result, n = compare(spark, con, folder, q.run, q.sql)
        except Exception as e:  # report every query
            result, n = f"{type(e).__name__}: {str(e)[:1500]}", -1
        bad += result not in ("ok", "rows only")
        print(f"{name:32s} {time.perf_counter() - start:6.2f}s {n:7d} {result}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
