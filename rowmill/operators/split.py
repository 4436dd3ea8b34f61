"""Train/test split, folds and samples by key hash.

All of them are filters or projections with literals: no shuffle of the table,
and the same answer when a lost task runs again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.functions.columns import col, require
from rowmill.functions.ordering import (
    Stratum,
    TooManyStrata,
    hash_cuts,
    key_hash,
    rank_in_class,
    unit_hash,
)

METHODS = ("random", "stratified")


def random_split(
    df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42, output: str = "split"
) -> DataFrame:
    """Adds ``split``: test where the key hash falls below the share."""
    require(df, [key])
    test = unit_hash(col(key), seed) < F.lit(test_size)
    return df.withColumn(output, F.when(test, F.lit("test")).otherwise(F.lit("train")))


def fit_stratified_split(
    df: DataFrame, key: str, label: str, test_size: float = 0.2, seed: int = 42
) -> list[Stratum]:
    """Where in hash order the test part of each label ends."""
    return hash_cuts(df, key, lambda n: [math.floor(test_size * n)], label, seed)


def apply_stratified_split(
    df: DataFrame, strata: list[Stratum], key: str, label: str, seed: int = 42, output: str = "split"
) -> DataFrame:
    test = F.lit(False)
    for s in strata:
        if s.cuts[0] is not None:
            reached = s.cuts[0].reaches(F.col("_h"), col(key))
            test = test | (col(label).eqNullSafe(F.lit(s.value)) & reached)
    hashed = df.withColumn("_h", key_hash(col(key), seed))
    return hashed.withColumn(
        output, F.when(test, F.lit("test")).otherwise(F.lit("train"))
    ).drop("_h")


def stratified_split(
    df: DataFrame,
    key: str,
    label: str,
    test_size: float = 0.2,
    seed: int = 42,
    output: str = "split",
) -> DataFrame:
    """floor(test_size * n) rows of every label go to the test part; rows that
    share a key stay together, so repeated keys may bring a few rows more."""
    require(df, [key, label])
    try:
        strata = fit_stratified_split(df, key, label, test_size, seed)
    except TooManyStrata:
        ranked = rank_in_class(df, key, label, "_rank", "_rows", seed, same_key_same_rank=True)
        test = F.col("_rank") <= F.floor(F.lit(test_size) * F.col("_rows"))
        return ranked.withColumn(
            output, F.when(test, F.lit("test")).otherwise(F.lit("train"))
        ).drop("_rank", "_rows")
    return apply_stratified_split(df, strata, key, label, seed, output)


def split(
    df: DataFrame,
    key: str,
    label: str | None = None,
    method: str = "random",
    test_size: float = 0.2,
    seed: int = 42,
    output: str = "split",
) -> DataFrame:
    if method == "random":
        return random_split(df, key, test_size, seed, output)
    if method == "stratified" and label is not None:
        return stratified_split(df, key, label, test_size, seed, output)
    raise ValueError(f"unknown split method '{method}', or no label for a stratified split")


def split_parts(df: DataFrame, output: str = "split") -> tuple[DataFrame, DataFrame]:
    """The train and the test part as two tables."""
    return tuple(df.filter(col(output) == part).drop(output) for part in ("train", "test"))


def stratified_folds(
    df: DataFrame, key: str, label: str, k: int = 6, seed: int = 42, output: str = "fold"
) -> DataFrame:
    """Adds a fold 0..k-1: each label is dealt evenly, the first folds taking
    one row more where the count does not divide; rows that share a key stay
    together."""
    require(df, [key, label])

    def ends(n: int) -> list[int]:
        small, extra = divmod(n, k)
        return [small * (i + 1) + min(i + 1, extra) for i in range(k - 1)]

    try:
        strata = hash_cuts(df, key, ends, label, seed)
    except TooManyStrata:
        ranked = rank_in_class(df, key, label, "_rank", "_rows", seed, same_key_same_rank=True)
        n, rank0 = F.col("_rows"), F.col("_rank") - 1
        small, extra = F.floor(n / k), n % k
        wide = extra * (small + 1)
        fold = F.when(rank0 < wide, F.floor(rank0 / (small + 1))).otherwise(
            extra + F.floor((rank0 - wide) / F.greatest(small, F.lit(1)))
        )
        never_null = F.coalesce(fold.cast("int"), F.lit(0))  # as on the other path
        return ranked.withColumn(output, never_null).drop("_rank", "_rows")
    hashed = df.withColumn("_h", key_hash(col(key), seed))
    return hashed.withColumn(output, _fold(strata, key, label)).drop("_h")


def _fold(strata: list[Stratum], key: str, label: str) -> Column:
    """The first fold whose end the row does not pass."""
    fold = F.lit(0)
    for s in strata:
        inside = F.lit(len(s.cuts))
        for i, cut in reversed(list(enumerate(s.cuts))):
            if cut is not None:
                inside = F.when(cut.reaches(F.col("_h"), col(key)), F.lit(i)).otherwise(inside)
        fold = F.when(col(label).eqNullSafe(F.lit(s.value)), inside).otherwise(fold)
    return fold.cast("int")


def sample_fraction(
    df: DataFrame, fraction: float, key: str | None = None, seed: int = 42
) -> DataFrame:
    """Rows whose key hash falls below the fraction; without a key, Spark's own
    seeded sample."""
    if not 0 <= fraction <= 1:
        raise ValueError("fraction must be between 0 and 1")
    if key is None:
        return df.sample(False, fraction, seed)
    return df.filter(unit_hash(col(key), seed) < F.lit(fraction))


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """Exactly n rows (all, if fewer): the first in hash order, by a filter.
    The key must identify a row: rows that share one are taken together."""
    require(df, [key])
    found = hash_cuts(df, key, lambda rows: [min(n, rows)], seed=seed)
    if n <= 0 or not found:
        return df.limit(0)
    return df.filter(found[0].cuts[0].reaches(key_hash(col(key), seed), col(key)))


def sample(
    df: DataFrame,
    n: int | None = None,
    fraction: float | None = None,
    key: str | None = None,
    seed: int = 42,
) -> DataFrame:
    if n is not None:
        if key is None:
            raise ValueError("a sample of n rows needs a key")
        return sample_rows(df, n, key, seed)
    if fraction is not None:
        return sample_fraction(df, fraction, key, seed)
    raise ValueError("either n or fraction must be given")
