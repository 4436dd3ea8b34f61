"""Encoding categories as numbers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowmill.functions.columns import col, require
from rowmill.functions.scalar import column_label, map_values
from rowmill.operators.lookup import within_bounds
from rowmill.sources.workdir import stage

INLINE_LABELS = 64
PARTITION_SHIFT = 33  # of monotonically_increasing_id
MAX_INDICATORS = 2_000


def apply_ordinal(df: DataFrame, mappings: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """Label to code, in place; null or unseen becomes null."""
    require(df, mappings)
    return df.withColumns({c: map_values(col(c), m).cast("int") for c, m in mappings.items()})


@dataclass(frozen=True)
class LabelIndex:
    """The labels of one column with their codes 0, 1, 2, ...

    ``codes`` holds all of them when they are few.  A larger vocabulary is a
    table, and ``heavy`` has the codes of its most frequent labels.  ``small`` says
    that the table's measured size allows a broadcast.
    """

    column: str
    codes: dict[object, int] | None
    table: DataFrame  # (value, code)
    heavy: dict[object, int] = field(default_factory=dict)
    small: bool = True


def fit_label_index(
    df: DataFrame, column: str, order: str = "frequency", order_by: str | None = None
) -> LabelIndex:
    """Number the labels of a column; null is not a label.

    ``frequency``: most frequent first, equal counts in value order.
    ``alphabet``: value order.
    ``first_seen``: by the smallest ``order_by`` of the label, since the rows
    of a Spark table have no order of their own.

    At most INLINE_LABELS + 1 labels reach the driver.
    """
    require(df, [column] + ([order_by] if order_by else []))
    if order == "first_seen" and order_by is None:
        raise ValueError("order='first_seen' needs an order_by column")
    n = F.count(F.lit(1))
    rank = {
        "frequency": lambda: -n,
        "alphabet": lambda: F.lit(0),
        "first_seen": lambda: F.min(col(order_by)),
    }[order]()
    value = col(column)
    labels = df.filter(value.isNotNull()).groupBy(value.alias("value")).agg(rank.alias("rank"), n.alias("n"))
    head = labels.orderBy("rank", "value").limit(INLINE_LABELS + 1).collect()
    if len(head) <= INLINE_LABELS:
        codes = {r["value"]: i for i, r in enumerate(head)}
        return LabelIndex(column, codes, _code_table(df, column, codes))
    return index_of(column, _number(labels))


def known_labels(df: DataFrame, column: str, labels: Sequence) -> LabelIndex:
    """The index of a few labels that are known already, in their order."""
    codes = {v: i for i, v in enumerate(labels)}
    return LabelIndex(column, codes, _code_table(df, column, codes))


def index_of(column: str, coded: DataFrame) -> LabelIndex:
    """The index of a table (value, code, n) that is written already."""
    few = coded.limit(INLINE_LABELS + 1).collect()
    if len(few) <= INLINE_LABELS:
        return LabelIndex(column, {r["value"]: r["code"] for r in few}, coded.select("value", "code"))
    heavy = {r["value"]: r["code"] for r in coded.orderBy(F.desc("n"), "code").limit(INLINE_LABELS).collect()}
    return LabelIndex(column, None, coded.select("value", "code"), heavy, within_bounds(coded))


def _code_table(df: DataFrame, column: str, codes: Mapping[object, int]) -> DataFrame:
    kind = df.schema[column].dataType.simpleString()
    return df.sparkSession.createDataFrame(list(codes.items()), f"value {kind}, code bigint")


def _number(labels: DataFrame) -> DataFrame:
    """(value, code, n) in the order of rank and value, written, without sorting
    the labels in one task.

    Spark sorts by ranges; the generated id holds a row's partition and its
    place there.  The sorted labels are written once, then each place is shifted
    by the rows of the partitions before (one row per partition to look up).
    """
    numbered = stage(
        labels.orderBy("rank", "value").select(
            "value", "n", F.monotonically_increasing_id().alias("id")
        ),
        "labels",
    )
    part = F.shiftright("id", PARTITION_SHIFT)
    place = F.col("id").bitwiseAND(F.lit((1 << PARTITION_SHIFT) - 1))
    counts = numbered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return stage(
        numbered.select("value", part.alias("part"), place.alias("place"), "n")
        .join(F.broadcast(offsets), "part")
        .select("value", (F.col("before") + F.col("place")).alias("code"), "n"), "label-codes",
    )


def apply_label_index(
    df: DataFrame, index: LabelIndex, output: str | None = None, unseen: int | None = None
) -> DataFrame:
    """Replace labels by codes (or add ``output``), long integers whatever the
    size of the vocabulary; unseen and null give ``unseen``, by default null.

    Heavy labels are literals.  In a shuffled join their rows, and those of null,
    have no partner to meet, so they are dealt over all tasks by a hash of the row.
    """
    require(df, [index.column])
    name = output or index.column
    value = col(index.column)
    if index.codes is not None:
        code = map_values(value, index.codes).cast("bigint")
        return df.withColumn(name, F.coalesce(code, F.lit(unseen)).cast("bigint"))
    table = index.table.select(F.col("value").alias("_value"), F.col("code").alias("_code"))
    if index.small:
        joined = df.join(F.broadcast(table), value == F.col("_value"), "left")
        code = F.coalesce("_code", F.lit(unseen)).cast("bigint")
        return joined.withColumn(name, code).drop("_value", "_code")
    heavy = map_values(value, index.heavy).cast("bigint")
    joined = _join_apart(df, value, heavy, table, "_value")
    code = F.coalesce("_heavy", "_code", F.lit(unseen)).cast("bigint")
    return joined.withColumn(name, code).drop("_value", "_code", "_heavy")


def _join_apart(df: DataFrame, key: Column, heavy: Column, table: DataFrame, on: str) -> DataFrame:
    """Left join on ``key`` in which rows with a ``heavy`` value, kept as such, or
    without a key meet nothing: they are shuffled by a hash of the whole row."""
    apart = key.isNull() | heavy.isNotNull()
    row = F.xxhash64(*[col(c) for c, t in df.dtypes if "map<" not in t])
    marked = df.withColumns(
        {
            "_heavy": heavy,
            "_key": F.when(~apart, key),
            "_deal": F.when(apart, row).otherwise(F.xxhash64(key)),
        }
    )
    # the hash is part of the key on both sides, else rows without a key would share a task
    partners = table.withColumn("_partner", F.xxhash64(on))
    meets = (F.col("_key") == F.col(on)) & (F.col("_deal") == F.col("_partner"))
    return marked.join(partners, meets, "left").drop("_key", "_deal", "_partner")


def invert_label_index(df: DataFrame, index: LabelIndex, coded: str, output: str) -> DataFrame:
    """Codes back to labels."""
    table = index.table.select(F.col("value").alias(output), F.col("code").alias("_code"))
    if index.small:
        return df.join(F.broadcast(table), col(coded) == F.col("_code"), "left").drop("_code")
    labels = {code: label for label, code in index.heavy.items()}
    heavy = map_values(col(coded), labels).cast(index.table.schema["value"].dataType)
    table = table.withColumnRenamed(output, "_label")
    joined = _join_apart(df, col(coded), heavy, table, "_code")
    return joined.withColumn(output, F.coalesce("_heavy", "_label")).drop("_label", "_code", "_heavy")


def fit_one_hot(
    df: DataFrame, columns: Sequence[str], max_labels: int = MAX_INDICATORS
) -> dict[str, list[str]]:
    """The sorted labels of each column, all columns in one aggregation.

    Indicators become table columns, so a column with more labels than a table
    can hold is an error; ``fit_indicators`` has no such limit.
    """
    columns = list(columns)
    require(df, columns)
    cells = F.explode(
        F.array(
            *[
                F.struct(F.lit(i).alias("i"), col(c).cast("string").alias("v"))
                for i, c in enumerate(columns)
            ]
        )
    )
    most = max_labels * len(columns)
    found = (
        df.select(cells.alias("x")).select("x.i", "x.v").filter(F.col("v").isNotNull())
        .distinct().limit(most + 1).collect()
    )
    labels: dict[str, list[str]] = {c: [] for c in columns}
    for i, v in found:
        labels[columns[i]].append(v)
    for c, values in labels.items():
        if len(found) > most or len(values) > max_labels:
            raise ValueError(f"more than {max_labels} labels: encode {columns} as vectors instead")
        values.sort()
    return checked_labels(labels)


def checked_labels(labels: dict[str, list[str]]) -> dict[str, list[str]]:
    """Labels whose indicator columns have names of their own."""
    for c, values in labels.items():
        if len({column_label(v) for v in values}) < len(values):
            raise ValueError(f"labels of {c} give the same column name")
    return labels


def indicator_names(labels: Mapping[str, Sequence[str]]) -> list[str]:
    return [f"{c}_{column_label(v)}" for c, values in labels.items() for v in values]


def apply_one_hot(
    df: DataFrame, labels: Mapping[str, Sequence[str]], as_boolean: bool = False
) -> DataFrame:
    """``{column}_{label}`` per label in one projection, original dropped; null
    or unseen gives all zeros."""
    require(df, labels)

    def indicator(c: str, v: str) -> Column:
        hit = F.coalesce(col(c).cast("string") == F.lit(v), F.lit(False))
        return hit if as_boolean else hit.cast("int")

    added = {
        f"{c}_{column_label(v)}": indicator(c, v) for c, values in labels.items() for v in values
    }
    return df.withColumns(added).drop(*labels)


def fit_one_hot_vector(df: DataFrame, column: str, output: str):
    """Sparse indicator vector with a slot per label and one for unseen values."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer

    helper = f"_{column}_position"
    return Pipeline(
        stages=[
            StringIndexer(inputCol=column, outputCol=helper, handleInvalid="keep"),
            OneHotEncoder(inputCol=helper, outputCol=output, dropLast=False),
        ]
    ).fit(df)


def apply_one_hot_vector(df: DataFrame, model, column: str) -> DataFrame:
    return model.transform(df).drop(f"_{column}_position")


@dataclass(frozen=True)
class Indicators:
    """A column's indicator slots: labels in value order, unseen ones and null last."""

    index: LabelIndex
    slots: int


def fit_indicators(df: DataFrame, column: str) -> Indicators:
    """Slots for any number of labels; the vocabulary is a table, not a list."""
    index = fit_label_index(df, column, "alphabet")
    return Indicators(index, 1 + (len(index.codes) if index.codes is not None else index.table.count()))


def apply_indicators(df: DataFrame, fitted: Indicators, output: str) -> DataFrame:
    """Adds ``output``, a sparse vector with a one in the slot of the row's label."""
    from pyspark.ml.feature import OneHotEncoder

    unseen = fitted.slots - 1
    slot = f"_{output}_slot"
    # the encoder takes its number of slots from the largest one it is shown
    largest = df.sparkSession.createDataFrame([(float(unseen),)], f"`{slot}` double")
    encoder = OneHotEncoder(inputCol=slot, outputCol=output, dropLast=False).fit(largest)
    coded = apply_label_index(df, fitted.index, slot, unseen)
    return encoder.transform(coded.withColumn(slot, col(slot).cast("double"))).drop(slot)


def one_hot(df: DataFrame, columns: Sequence[str], form: str = "columns") -> DataFrame:
    """Encode columns by their own labels: ``columns`` gives one 0/1 column per
    label, ``vectors`` one sparse vector ``{column}_vector`` per column, for any
    number of labels.  The original columns are dropped."""
    if form == "columns":
        return apply_one_hot(df, fit_one_hot(df, columns))
    if form != "vectors":
        raise ValueError(f"unknown form '{form}'")
    out = df
    for c in columns:
        out = apply_indicators(out, fit_indicators(df, c), f"{c}_vector").drop(c)
    return out
