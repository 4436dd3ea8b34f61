"""Scalar expressions shared by the operators.  All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(cases: Sequence[tuple[Column, object]], otherwise: object = None) -> Column:
    """Value of the first condition that holds."""
    if not cases:
        return F.lit(otherwise)
    chain = F.when(cases[0][0], F.lit(cases[0][1]))
    for condition, value in cases[1:]:
        chain = chain.when(condition, F.lit(value))
    return chain.otherwise(F.lit(otherwise))


def map_values(value: Column, mapping: Mapping) -> Column:
    """Replace by code; a value without a code, or null, becomes null."""
    return first_match([(value == k, v) for k, v in mapping.items()])


def clip(value: Column, low: float | None, high: float | None) -> Column:
    """Limit to [low, high]; null stays null."""
    bounded = value
    if high is not None:
        bounded = F.when(value > F.lit(high), F.lit(high)).otherwise(bounded)
    if low is not None:
        bounded = F.when(value < F.lit(low), F.lit(low)).otherwise(bounded)
    return bounded


def logistic(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def even_grid(low: Column, high: Column, n: int) -> Column:
    """Array of n evenly spaced points from low to high, both included."""
    if n < 2:
        raise ValueError("a grid needs at least two points")
    step = (high - low) / F.lit(float(n - 1))
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: low + i * step)


def percent_text(probability: Column, digits: int = 2) -> Column:
    """0.1234 -> '12.34%'."""
    return F.concat(F.round(probability.cast("double") * 100.0, digits).cast("string"), F.lit("%"))


def percentage(part: Column, whole: Column) -> Column:
    """100 * part / whole, null when the whole is empty."""
    return F.try_divide(part * F.lit(100.0), whole.cast("double"))


def trimmed_in(value: Column, domain: Sequence[str]) -> Column:
    """The trimmed text when it belongs to the domain, else null."""
    text = F.trim(value)
    return F.when(text.isin(*domain), text)


def column_label(value: str) -> str:
    """A data value made usable inside a generated column name."""
    return value.replace(" ", "_")


def vector_element(vector: Column, index: int) -> Column:
    """Element of an ML vector, null beyond its end."""
    from pyspark.ml.functions import vector_to_array

    return F.get(vector_to_array(vector), F.lit(index))
