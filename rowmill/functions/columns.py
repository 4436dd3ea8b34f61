"""Column names, types and the one definition of "missing"."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(name: str) -> Column:
    """A column by its literal name (one-hot names may hold dots or spaces)."""
    return F.col("`" + name.replace("`", "``") + "`")


def dtype(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def require(df: DataFrame, names: Iterable[str]) -> None:
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ValueError(f"columns not in the table: {absent}")


def is_floating(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.FloatType, T.DoubleType))


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the numeric columns, in schema order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def present(df: DataFrame, name: str) -> Column:
    """The value with NaN read as null (Spark sorts NaN above every number)."""
    value = col(name)
    return F.nanvl(value, F.lit(None)) if is_floating(dtype(df, name)) else value


def is_missing(df: DataFrame, name: str, empty_text: bool = True) -> Column:
    """True for null, for NaN in a float column and for '' in a text column."""
    value, kind = col(name), dtype(df, name)
    if is_floating(kind):
        return value.isNull() | F.isnan(value)
    if empty_text and isinstance(kind, T.StringType):
        return value.isNull() | (value == "")
    return value.isNull()


def unpivot_row(df: DataFrame, rows: list[dict[str, Column]]) -> DataFrame:
    """Turn a one-row aggregate into one row per dict in ``rows``."""
    structs = [F.struct(*[v.alias(k) for k, v in r.items()]) for r in rows]
    return df.select(F.inline(F.array(*structs)))
