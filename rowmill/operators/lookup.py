"""Lookups against a second table whose size is not known beforehand."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.functions.columns import col
from rowmill.sources.workdir import stage

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 16 * 2**20


@dataclass(frozen=True)
class Lookup:
    """A lookup table; ``rows`` is its size, or None beyond the bounds."""

    table: DataFrame
    rows: int | None

    def for_join(self) -> DataFrame:
        return F.broadcast(self.table) if self.rows is not None else self.table


def measure(df: DataFrame) -> tuple[int, int]:
    """Rows of a table and their bytes as text, in one aggregation."""
    size = F.sum(F.octet_length(F.to_json(F.struct(*[col(c) for c in df.columns]))))
    rows, taken = df.agg(F.count(F.lit(1)), size).collect()[0]
    return rows, taken or 0


def within_bounds(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether a written table is small enough to be broadcast."""
    rows, taken = measure(df)
    return rows <= max_rows and taken <= max_bytes


def bounded(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> Lookup:
    """Write a lookup table once and measure it.

    Neither its query nor its shuffle runs again, and no row of it reaches the
    driver.  It is broadcast when both its rows and their bytes as text are
    within the bounds; else joins are left to Spark's own strategy and skew
    handling.
    """
    held = stage(df, "lookup")
    rows, taken = measure(held)
    return Lookup(held, rows if rows <= max_rows and taken <= max_bytes else None)


def one_per_key(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One value per key combination (the smallest), so a join cannot fan out."""
    return df.groupBy(*keys).agg(F.min(value).alias(value))


def left_lookup(
    df: DataFrame, table: DataFrame, keys: Sequence[str], value: str
) -> DataFrame:
    """Left join on the keys with one row per key on the right."""
    return df.join(bounded(one_per_key(table, keys, value)).for_join(), list(keys), "left")
