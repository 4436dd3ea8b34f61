"""Checks of tables that go into or come out of a job: one status row per rule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.functions.columns import col, unpivot_row


def check_table(df: DataFrame, expected: Sequence[str], table: str = "table") -> DataFrame:
    """Not empty, and every expected column present (rule, rows, passed)."""
    absent = [c for c in expected if c not in df.columns]
    counted = df.agg(F.count(F.lit(1)).alias("n"))
    rules = [
        {
            "rule": F.lit(f"{table}: has rows"),
            "observed": F.col("n"),
            "passed": F.col("n") > 0,
        },
        {
            "rule": F.lit(f"{table}: has its {len(expected)} columns"),
            "observed": F.lit(len(expected) - len(absent)).cast("bigint"),
            "passed": F.lit(not absent),
        },
    ]
    return unpivot_row(counted, rules)


def check_splits(
    df: DataFrame, parts: Sequence[str] = ("train", "test"), split: str = "split"
) -> DataFrame:
    """Every expected part holds rows."""
    counted = df.agg(*[F.count_if(col(split) == p).alias(f"n{i}") for i, p in enumerate(parts)])
    rules = [
        {
            "rule": F.lit(f"part {p}: has rows"),
            "observed": F.col(f"n{i}"),
            "passed": F.col(f"n{i}") > 0,
        }
        for i, p in enumerate(parts)
    ]
    return unpivot_row(counted, rules)
