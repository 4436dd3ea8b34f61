"""Outlier bounds, flags, removal and capping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.functions.columns import col, present, require, unpivot_row
from rowmill.functions.quantiles import exact_quantiles
from rowmill.functions.scalar import clip
from rowmill.operators.project import sum_flags

Bounds = Mapping[str, tuple[float | None, float | None]]


def fit_iqr(
    df: DataFrame,
    columns: Sequence[str],
    threshold: float = 1.5,
    relative_error: float | None = None,
) -> dict[str, tuple[float | None, float | None]]:
    """(low, high) per column from the quartiles; all columns together."""
    columns = list(columns)
    require(df, columns)
    if relative_error is None:
        quartiles = exact_quantiles(df, columns, [0.25, 0.75])
    else:
        clean = df.select(
            *[present(df, c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)]
        )
        found = clean.approxQuantile(clean.columns, [0.25, 0.75], relative_error)
        quartiles = {c: (q or [None, None]) for c, q in zip(columns, found)}
    bounds = {}
    for c, (q1, q3) in quartiles.items():
        spread = None if q1 is None else threshold * (q3 - q1)
        bounds[c] = (None, None) if q1 is None else (q1 - spread, q3 + spread)
    return bounds


def fit_sigma(
    df: DataFrame, columns: Sequence[str], sigmas: float = 3.0
) -> dict[str, tuple[float | None, float | None]]:
    """mean -/+ sigmas * sample standard deviation, one aggregation."""
    columns = list(columns)
    require(df, columns)
    aggregates = []
    for c in columns:
        v = present(df, c).cast("double")
        aggregates += [F.avg(v), F.stddev_samp(v)]
    row = df.agg(*aggregates).collect()[0]
    bounds = {}
    for i, c in enumerate(columns):
        mean, sd = row[2 * i], row[2 * i + 1]
        bounds[c] = (None, None) if sd is None else (mean - sigmas * sd, mean + sigmas * sd)
    return bounds


def is_outlier(df: DataFrame, column: str, bounds: Bounds) -> Column:
    """True outside the bounds; a missing value is no outlier."""
    low, high = bounds[column]
    if low is None:
        return F.lit(False)
    v = present(df, column)
    return F.coalesce((v < F.lit(low)) | (v > F.lit(high)), F.lit(False))


def flag_outliers(df: DataFrame, bounds: Bounds) -> DataFrame:
    """Adds ``{column}_outlier`` for every bounded column."""
    require(df, bounds)
    return df.withColumns({f"{c}_outlier": is_outlier(df, c, bounds) for c in bounds})


def remove_outliers(df: DataFrame, bounds: Bounds, min_outliers: int = 2) -> DataFrame:
    """Rows with fewer than ``min_outliers`` columns out of bounds."""
    require(df, bounds)
    return df.filter(sum_flags([is_outlier(df, c, bounds) for c in bounds]) < min_outliers)


def cap_outliers(df: DataFrame, bounds: Bounds) -> DataFrame:
    """Values beyond a bound are set to it; missing values stay missing."""
    require(df, bounds)
    return df.withColumns(
        {c: clip(present(df, c).cast("double"), *bounds[c]) for c in bounds}
    )


def handle_outliers(
    df: DataFrame,
    columns: Sequence[str],
    method: str = "remove",
    min_outliers: int = 2,
    bounds: Bounds | None = None,
) -> DataFrame:
    if method not in ("remove", "cap"):
        raise ValueError(f"unknown outlier method '{method}'")
    bounds = bounds or fit_iqr(df, columns)
    return remove_outliers(df, bounds, min_outliers) if method == "remove" else cap_outliers(df, bounds)


def outlier_report(df: DataFrame, bounds: Bounds, digits: int = 3) -> DataFrame:
    """(column, outliers, fraction, percent) in one pass."""
    columns = list(bounds)
    counted = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(is_outlier(df, c, bounds)).alias(f"n{i}") for i, c in enumerate(columns)],
    )
    rows = []
    for i, c in enumerate(columns):
        fraction = F.try_divide(F.col(f"n{i}").cast("double"), F.col("n").cast("double"))
        rows.append(
            {
                "column": F.lit(c),
                "outliers": F.col(f"n{i}"),
                "fraction": F.round(fraction, digits),
                "percent": F.round(F.lit(100.0) * fraction, digits),
            }
        )
    return unpivot_row(counted, rows)


def bounds_table(df: DataFrame, bounds: Bounds) -> DataFrame:
    """The bounds as a table (column, low, high)."""
    rows = [(c, *b) for c, b in bounds.items()]
    return df.sparkSession.createDataFrame(rows, "column string, low double, high double")
