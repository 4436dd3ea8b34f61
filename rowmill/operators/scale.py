"""Scaling numeric columns in place."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.functions.columns import present, require

# (shift, scale) per column: scaled = (value - shift) / scale
Scaling = Mapping[str, tuple[float, float]]


def fit_min_max(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Range of every column from one aggregation.  A constant column has scale
    1 and so becomes 0."""
    columns = list(columns)
    require(df, columns)
    aggregates = []
    for c in columns:
        v = present(df, c).cast("double")
        aggregates += [F.min(v), F.max(v)]
    row = df.agg(*aggregates).collect()[0]
    state = {}
    for i, c in enumerate(columns):
        low, high = row[2 * i], row[2 * i + 1]
        state[c] = (0.0, 1.0) if low is None else (low, (high - low) or 1.0)
    return state


def fit_standard(
    df: DataFrame,
    columns: Sequence[str],
    with_mean: bool = True,
    with_std: bool = True,
    ddof: int = 0,
) -> dict[str, tuple[float, float]]:
    """Mean and standard deviation of every column from one aggregation.

    ``ddof=0`` divides by the population, ``ddof=1`` by the sample deviation; a
    deviation of zero divides by 1.
    """
    if ddof not in (0, 1):
        raise ValueError("ddof is 0 or 1")
    columns = list(columns)
    require(df, columns)
    deviation = F.stddev_samp if ddof else F.stddev_pop
    aggregates = []
    for c in columns:
        v = present(df, c).cast("double")
        aggregates += [F.avg(v), deviation(v)]
    row = df.agg(*aggregates).collect()[0]
    state = {}
    for i, c in enumerate(columns):
        mean, sd = row[2 * i], row[2 * i + 1]
        state[c] = ((mean or 0.0) if with_mean else 0.0, (sd or 1.0) if with_std else 1.0)
    return state


def apply_scaling(df: DataFrame, state: Scaling) -> DataFrame:
    require(df, state)
    return df.withColumns(
        {
            c: (present(df, c).cast("double") - F.lit(shift)) / F.lit(scale)
            for c, (shift, scale) in state.items()
        }
    )
