"""Row filters and column projections."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.functions.columns import col, is_missing, require

log = logging.getLogger(__name__)


def drop_missing(df: DataFrame, critical: Sequence[str] | None = None) -> DataFrame:
    """Rows without a missing value in the critical columns.

    No list means all columns; an empty list keeps every row.
    """
    return df.dropna() if critical is None else df.dropna(subset=list(critical))


def dropped_rows(df: DataFrame, critical: Sequence[str] | None = None) -> DataFrame:
    """How many rows ``drop_missing`` keeps and drops, in one pass."""
    columns = df.columns if critical is None else list(critical)
    bad = F.lit(False)
    for c in columns:
        bad = bad | is_missing(df, c, empty_text=False)
    return df.agg(F.count_if(~bad).alias("kept"), F.count_if(bad).alias("dropped"))


def drop_existing(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Without the named columns; names that are absent are ignored."""
    return df.drop(*[n for n in names if n in df.columns])


def drop_strict(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Without the named columns; an absent name is an error."""
    require(df, names)
    return df.drop(*names)


def cast_columns(df: DataFrame, types: Mapping[str, str], lenient: bool = False) -> DataFrame:
    """Cast by name.  Unknown names are skipped with a warning; ``lenient``
    turns values that do not fit into null."""
    for n in types:
        if n not in df.columns:
            log.warning("cast_columns: no column %s", n)
    return df.withColumns(
        {
            n: col(n).try_cast(t) if lenient else col(n).cast(t)
            for n, t in types.items()
            if n in df.columns
        }
    )


def features_and_target(
    df: DataFrame, target: str, key: str
) -> tuple[DataFrame, DataFrame]:
    """Features and target as two tables that both carry the key."""
    require(df, [target, key])
    return df.drop(target), df.select(col(key), col(target))


def rejoin(features: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Put features and target together again by key, never by position."""
    return features.join(target, key)


def align(df: DataFrame, expected: Sequence[str], fill: object = 0) -> DataFrame:
    """Exactly the expected columns in order; absent ones hold ``fill``."""
    return df.select([col(c) if c in df.columns else F.lit(fill).alias(c) for c in expected])


def replace_columns(
    df: DataFrame, derived: Mapping[str, Column], drop: Sequence[str] = ()
) -> DataFrame:
    """Add derived columns on the same rows and drop their originals."""
    return df.withColumns(dict(derived)).drop(*drop)


def only_missing(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value is null, NaN or empty text."""
    return df.filter(is_missing(df, column))


def discard_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is not true; unknown counts as not true."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def drop_helpers(
    df: DataFrame, suffixes: Sequence[str] = ("_outlier", "_index", "_vec", "_array")
) -> DataFrame:
    """Without the helper columns that other tools leave behind."""
    return df.drop(*[c for c in df.columns if c.endswith(tuple(suffixes))])


def feature_subset(
    df: DataFrame, features: Sequence[str], passthrough: Sequence[str] | None = ()
) -> DataFrame:
    """The named features, then the passthrough columns (None keeps the rest)."""
    require(df, features)
    rest = (
        [c for c in df.columns if c not in features] if passthrough is None else list(passthrough)
    )
    return df.select([col(c) for c in [*features, *rest]])


def sum_flags(flags: Sequence[Column]) -> Column:
    """How many flags are true; an unknown flag counts as false."""
    return sum((F.coalesce(f, F.lit(False)).cast("int") for f in flags), F.lit(0))
