"""Partition count of a table that is going to be written or read often."""

from __future__ import annotations

from pyspark.sql import DataFrame


def partition_target(rows: int, per_partition: int = 10_000, most: int = 200) -> int:
    """max(1, min(most, rows / per_partition)); tables over a million rows per
    partition get more than ``most``."""
    return max(1, min(most, rows // per_partition), rows // 1_000_000)


def right_size(df: DataFrame, rows: int | None = None, cache: bool = False) -> DataFrame:
    """Coalesce when there are more than twice the wanted partitions, spread
    when there are fewer than half.  Pass ``rows`` to save the count."""
    target = partition_target(df.count() if rows is None else rows)
    current = df.rdd.getNumPartitions()
    if current > target * 2:
        df = df.coalesce(target)
    elif current < target // 2:
        df = df.repartition(target)
    return df.persist() if cache else df
