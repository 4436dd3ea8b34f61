"""Feature vectors and the composite numeric / nominal / ordinal transform."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.functions.columns import col, dtype, is_missing, present, require
from rowmill.operators.encode import (
    INLINE_LABELS, LabelIndex, apply_label_index, apply_one_hot, checked_labels, fit_label_index, fit_one_hot,
    known_labels,
)
from rowmill.operators.impute import apply_fill, fit_fill
from rowmill.operators.scale import apply_scaling


def assemble(
    df: DataFrame,
    features: Sequence[str],
    keep: Sequence[str] = (),
    output: str = "features",
    invalid: str = "skip",
) -> DataFrame:
    """Feature vector beside the kept columns; rows with a null are skipped."""
    from pyspark.ml.feature import VectorAssembler

    require(df, [*features, *keep])
    assembler = VectorAssembler(
        inputCols=list(features), outputCol=output, handleInvalid=invalid
    )
    return assembler.transform(df).select(*[col(c) for c in keep], output)


@dataclass(frozen=True)
class CompositeState:
    fills: dict
    scaling: dict
    labels: dict
    ordinals: tuple[LabelIndex, ...]
    passthrough: tuple[str, ...]


def _fill_text(df: DataFrame, columns: Sequence[str], label: str = "missing") -> DataFrame:
    return df.withColumns(
        {c: F.when(is_missing(df, c), F.lit(label)).otherwise(col(c)) for c in columns}
    )


def fit_composite(
    df: DataFrame,
    numeric: Sequence[str],
    nominal: Sequence[str],
    ordinal: Sequence[str],
    passthrough: Sequence[str] = (),
) -> CompositeState:
    """Numeric: median fill, then standardise.  Nominal: 'missing' fill, then
    indicators.  Ordinal: 'missing' fill, then a code in value order.

    The medians take the few passes of exact quantiles.  Mean and deviation after
    the fill follow from those of the present values, and one aggregation has
    them for all columns; another one counts all vocabularies.
    """
    require(df, [*numeric, *nominal, *ordinal, *passthrough])
    fills = fit_fill(df, numeric, "median")
    labels, codes = _vocabularies(df, nominal, ordinal)
    ordinals = tuple(
        fit_label_index(_fill_text(df, [c]), c, "alphabet") if codes is None
        else known_labels(df, c, codes[c]) for c in ordinal
    )
    if labels is None:
        labels = fit_one_hot(_fill_text(df, nominal), nominal)
    return CompositeState(fills, _filled_moments(df, fills), labels, ordinals, tuple(passthrough))


def _filled_moments(df: DataFrame, fills: dict) -> dict[str, tuple[float, float]]:
    """Mean and deviation of each column once its gaps hold the fill: with n
    present values of mean m and variance v, and g gaps of value f,
    mean = (n m + g f) / (n + g), variance = (n (v + (m - mean)^2) + g (f - mean)^2) / (n + g)."""
    if not fills:
        return {}
    aggregates = [F.count(F.lit(1))]
    for c in fills:
        v = present(df, c).cast("double")
        aggregates += [F.count(v), F.avg(v), F.var_pop(v)]
    row = df.agg(*aggregates).collect()[0]
    state = {}
    for i, (c, fill) in enumerate(fills.items()):
        n, m, v = row[1 + 3 * i : 4 + 3 * i]
        if not n:
            state[c] = (0.0, 1.0)
            continue
        gaps = row[0] - n
        mean = (n * m + gaps * fill) / row[0]
        variance = (n * (v + (m - mean) ** 2) + gaps * (fill - mean) ** 2) / row[0]
        state[c] = (mean, math.sqrt(variance) or 1.0)
    return state


def _vocabularies(df: DataFrame, nominal: Sequence[str], ordinal: Sequence[str]):
    """The labels of all nominal and ordinal columns from one aggregation: sorted
    lists, or None for the nominal ones or for the ordinal ones if they are too
    many to be listed here."""
    columns = [*nominal, *ordinal]
    if not columns:
        return {}, {}
    filled = _fill_text(df, columns)
    cells = [F.struct(F.lit(i).alias("i"), col(c).cast("string").alias("v")) for i, c in enumerate(columns)]
    # one label of a column more than it may have tells that it has too many
    place = F.row_number().over(Window.partitionBy("i").orderBy("v"))
    distinct = filled.select(F.explode(F.array(*cells)).alias("x")).select("x.i", "x.v").distinct()
    found = distinct.withColumn("place", place).filter(F.col("place") <= INLINE_LABELS + 1).collect()
    lists: dict[str, list[str]] = {c: [] for c in columns}
    for i, v, _ in found:
        lists[columns[i]].append(v)
    many = {c for c, values in lists.items() if len(values) > INLINE_LABELS}
    plain = all(isinstance(dtype(df, c), T.StringType) for c in ordinal)
    return (
        None if many & set(nominal) else checked_labels({c: sorted(lists[c]) for c in nominal}),
        None if many & set(ordinal) or not plain else {c: sorted(lists[c]) for c in ordinal},
    )


def apply_composite(df: DataFrame, state: CompositeState) -> DataFrame:
    """Numeric, indicator, ordinal and passthrough columns; the rest is dropped."""
    ordinal = [i.column for i in state.ordinals]
    wanted = [*state.fills, *state.labels, *ordinal, *state.passthrough]
    out = df.select(*[col(c) for c in dict.fromkeys(wanted)])
    out = apply_scaling(apply_fill(out, state.fills), state.scaling)
    out = _fill_text(out, [*state.labels, *ordinal])
    for index in state.ordinals:
        out = apply_label_index(out, index)
    out = apply_one_hot(out, state.labels)
    from rowmill.operators.encode import indicator_names

    order = [*state.fills, *indicator_names(state.labels), *ordinal, *state.passthrough]
    return out.select(*[col(c) for c in order])
