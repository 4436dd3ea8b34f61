"""Binning a number into ordered labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.functions.columns import col, present, require
from rowmill.functions.scalar import first_match

# The credit score ranges, their exact top score and the codes.
CREDIT_SCORE_BINS = {
    "Poor": [300, 580],
    "Fair": [580, 670],
    "Good": [670, 740],
    "Very Good": [740, 800],
    "Excellent": [800, 850],
}
CREDIT_SCORE_TOP = {850: "Excellent"}
CREDIT_SCORE_CODES = {"Poor": 0, "Fair": 1, "Good": 2, "Very Good": 3, "Excellent": 4}


def bin_label(
    value: Column,
    bins: Mapping[str, Sequence[float]],
    exact: Mapping[float, str] | None = None,
    closed: str = "both",
    above: str | None = None,
    otherwise: str | None = None,
) -> Column:
    """Label of the first range that holds the value.

    ``closed='both'``: [low, high] ranges, a one-element range means ``>= low``.
    ``closed='left'``: only upper limits count; all are exclusive but the last.
    ``exact`` labels single values first.  ``above`` labels values over every
    range and ``otherwise`` everything that is left, missing values included
    only there.
    """
    if closed not in ("both", "left"):
        raise ValueError(f"closed must be 'both' or 'left', not '{closed}'")
    cases = [(value == v, label) for v, label in (exact or {}).items()]
    if closed == "left":
        last = len(bins) - 1
        for i, (label, limits) in enumerate(bins.items()):
            cases.append((value <= limits[-1] if i == last else value < limits[-1], label))
    else:
        for label, limits in bins.items():
            if len(limits) == 2:
                cases.append(((value >= limits[0]) & (value <= limits[1]), label))
            else:
                cases.append((value >= limits[0], label))
    if above is not None:
        cases.append((value > max(limits[-1] for limits in bins.values()), above))
    return first_match(cases, otherwise)


def bin_column(
    df: DataFrame,
    column: str,
    bins: Mapping[str, Sequence[float]],
    output: str | None = None,
    keep: bool = False,
    **options,
) -> DataFrame:
    """Adds ``{column}Bins`` and drops the column."""
    require(df, [column])
    binned = df.withColumn(output or f"{column}Bins", bin_label(present(df, column), bins, **options))
    return binned if keep else binned.drop(column)


def bucket_index(df: DataFrame, column: str, splits: Sequence[float], output: str) -> DataFrame:
    """Index of the half-open bucket in a long list of ascending splits.

    Values outside the splits give null, as do missing values.
    """
    from pyspark.ml.feature import Bucketizer

    require(df, [column])
    v = present(df, column).cast("double")
    usable = (v >= F.lit(float(splits[0]))) & (v <= F.lit(float(splits[-1])))
    helper = f"_{column}_bucket"
    bucketizer = Bucketizer(
        splits=[float(s) for s in splits], inputCol=helper, outputCol=output, handleInvalid="keep"
    )
    prepared = df.withColumn(helper, F.when(usable, v))
    result = bucketizer.transform(prepared).drop(helper)
    return result.withColumn(output, F.when(usable, col(output)).cast("int"))
