"""Filling missing values."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from decimal import ROUND_HALF_UP, Decimal
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.functions.columns import col, dtype, is_missing, numeric_columns, present, require
from rowmill.functions.quantiles import exact_quantiles
from rowmill.operators.lookup import Lookup, bounded

METHODS = ("mean", "median", "mode", "constant")


def fit_fill(
    df: DataFrame,
    columns: str | Sequence[str],
    method: str = "mean",
    value: object = None,
    digits: int | None = None,
    relative_error: float | None = None,
) -> dict[str, object]:
    """The fill value of each column; a column without values has None.

    ``digits`` rounds it half up; ``relative_error`` makes the median approximate.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    require(df, columns)
    if method not in METHODS or (method == "constant" and value is None):
        raise ValueError(f"unknown method '{method}', or no value for a constant fill")
    if method == "constant":
        return {c: value for c in columns}
    if method == "mean":
        row = df.agg(*[F.avg(present(df, c).cast("double")) for c in columns]).collect()[0]
        fills = dict(zip(columns, row))
    elif method == "median" and relative_error is not None:
        clean = df.select(*[present(df, c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
        found = clean.approxQuantile(clean.columns, [0.5], relative_error)
        fills = {c: (q[0] if q else None) for c, q in zip(columns, found)}
    elif method == "median":
        fills = {c: q[0] for c, q in exact_quantiles(df, columns, [0.5]).items()}
    else:
        fills = {c: most_frequent(df, c) for c in columns}
    if digits is not None:
        fills = {c: None if v is None else _half_up(v, digits) for c, v in fills.items()}
    return fills


def _half_up(value: float, digits: int) -> float:
    """Rounded as Spark's ``round`` does."""
    return float(Decimal(repr(value)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def most_frequent(df: DataFrame, column: str) -> object:
    """The mode; missing values are no candidates, ties take the smallest."""
    counts = df.filter(~is_missing(df, column, empty_text=False)).groupBy(col(column).alias("v")).count()
    best = counts.orderBy(F.desc("count"), F.asc("v")).limit(1).collect()
    return best[0]["v"] if best else None


def apply_fill(df: DataFrame, fills: Mapping[str, object]) -> DataFrame:
    """Fill the columns; an integer column becomes double before a fraction
    goes in, because a cast the other way would cut it off."""
    require(df, fills)
    filled = {}
    for name, fill in fills.items():
        if fill is None:
            continue
        v = present(df, name)
        if isinstance(fill, float) and isinstance(dtype(df, name), T.NumericType):
            v = v.cast("double")
        filled[name] = F.coalesce(v, F.lit(fill))
    return df.withColumns(filled) if filled else df


def fill(df: DataFrame, columns: str | Sequence[str], method: str = "mean", **options) -> DataFrame:
    return apply_fill(df, fit_fill(df, columns, method, **options))


def fill_all_constant(df: DataFrame, value: object) -> DataFrame:
    """Fill every column whose type fits the value; an integer column becomes
    double before a fraction goes in."""
    if isinstance(value, float) and not value.is_integer():
        whole = [f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegralType)]
        df = df.withColumns({c: col(c).cast("double") for c in whole})
    return df.fillna(value)


def fit_fill_numeric(
    df: DataFrame, method: str = "mean", columns: Sequence[str] | None = None
) -> dict[str, object]:
    """Mean or median of all numeric columns; any other method means mean."""
    names = list(columns or numeric_columns(df))
    return fit_fill(df, names, method if method == "median" else "mean") if names else {}


def fill_category(df: DataFrame, column: str, label: str = "Unknown") -> DataFrame:
    """Null or empty text becomes the label."""
    return df.withColumn(column, F.when(is_missing(df, column), F.lit(label)).otherwise(col(column)))


def with_imputer(df: DataFrame, imputer: Callable[[DataFrame], DataFrame] | object) -> DataFrame:
    """A caller's own imputer: a function of a table, or an object with ``impute``."""
    return df.transform(getattr(imputer, "impute", imputer))


class FittedImputer(Protocol):
    """A caller's own imputer as a step of a job: ``fit`` returns what it has
    learnt as plain values (they are stored as JSON), ``apply`` is a projection
    over a table or a stream."""

    def fit(self, df: DataFrame) -> dict: ...

    def apply(self, df: DataFrame, fitted: dict) -> DataFrame: ...


_IMPUTERS: dict[str, FittedImputer] = {}


def register_imputer(name: str, imputer: FittedImputer) -> None:
    """Make an imputer known by a name, which settings and stored states refer to."""
    _IMPUTERS[name] = imputer


def registered_imputer(name: str) -> FittedImputer:
    """A state that names an unknown imputer is an error: the step must not be skipped."""
    if name not in _IMPUTERS:
        raise ValueError(f"imputer '{name}' is not registered, known: {sorted(_IMPUTERS)}")
    return _IMPUTERS[name]


@dataclass(frozen=True)
class CategoryPredictor:
    """Most frequent known value per key combination, with a fallback."""

    keys: tuple[str, ...]
    value: str
    fallback: object
    lookup: Lookup


def fit_category_predictor(
    df: DataFrame, keys: Sequence[str], value: str, domain: Sequence[str] | None = None
) -> CategoryPredictor:
    """Learn value by key from the rows that have one.

    Counts per (key, value) come first and the best value per key is a minimum
    over them, so a key that fills the table costs a few rows in the shuffle.
    """
    require(df, [*keys, value])
    known = df.filter(~is_missing(df, value))
    if domain is not None:
        known = known.filter(col(value).isin(*domain))
    counts = known.groupBy(*[col(k) for k in keys], col(value).alias("_v")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    best = counts.groupBy(*[col(k) for k in keys]).agg(
        F.min(F.struct((-F.col("_n")).alias("n"), F.col("_v").alias("v")))["v"].alias("_predicted")
    )
    total = counts.groupBy("_v").agg(F.sum("_n").alias("n"))
    overall = total.orderBy(F.desc("n"), F.asc("_v")).limit(1).collect()
    table = best.dropna(subset=list(keys))
    return CategoryPredictor(tuple(keys), value, overall[0]["_v"] if overall else None, bounded(table))


def apply_category_predictor(df: DataFrame, predictor: CategoryPredictor) -> DataFrame:
    """Fill missing values from the lookup; rows that have a value stay.

    With a large lookup only the rows that need a prediction are joined.
    """
    require(df, [*predictor.keys, predictor.value])
    name, columns = predictor.value, df.columns
    predicted = F.coalesce(F.col("_predicted"), F.lit(predictor.fallback))
    keys = list(predictor.keys)
    if predictor.lookup.rows is not None:
        joined = df.join(predictor.lookup.for_join(), keys, "left")
        result = F.when(is_missing(df, name), predicted).otherwise(col(name))
        return joined.withColumn(name, result).select([col(c) for c in columns])
    gaps = df.filter(is_missing(df, name)).join(predictor.lookup.table, keys, "left")
    gaps = gaps.withColumn(name, predicted).select([col(c) for c in columns])
    return df.filter(~is_missing(df, name)).unionByName(gaps)


def validate_domain(df: DataFrame, column: str, domain: Sequence[str]) -> DataFrame:
    """Values outside the domain become null (text is trimmed first)."""
    text = F.trim(col(column))
    return df.withColumn(column, F.when(text.isin(*domain), text))


def domain_report(df: DataFrame, column: str, domain: Sequence[str]) -> DataFrame:
    """Accepted, rejected and missing values of a predicted column."""
    text, missing = F.trim(col(column)), is_missing(df, column)
    accepted = F.coalesce(text.isin(*domain), F.lit(False))
    return df.agg(
        F.count_if(accepted).alias("accepted"),
        F.count_if(~accepted & ~missing).alias("rejected"),
        F.count_if(missing).alias("missing"),
    )
