"""Fitted state as a table (operator, column, value), value as JSON text."""

from __future__ import annotations

import json
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession

from rowmill.operators.encode import LabelIndex, index_of

SCHEMA = "operator string, column string, value string"


def state_table(spark: SparkSession, state: dict[str, dict]) -> DataFrame:
    """Parameters of fitted operators; they are few by construction."""
    rows = [
        (operator, column, json.dumps(value))
        for operator, columns in state.items()
        for column, value in columns.items()
    ]
    return spark.createDataFrame(rows, SCHEMA)


def read_state(table: DataFrame) -> dict[str, dict]:
    state: dict[str, dict] = {}
    for r in table.collect():
        state.setdefault(r["operator"], {})[r["column"]] = json.loads(r["value"])
    return state


def save_state(spark: SparkSession, state: dict[str, dict], path: str) -> None:
    state_table(spark, state).coalesce(1).write.mode("overwrite").parquet(path)


def load_state(spark: SparkSession, path: str) -> dict[str, dict]:
    """An absent state is an error: scoring must not skip a fitted step."""
    return read_state(spark.read.schema(SCHEMA).parquet(path))


def label_table(index: LabelIndex) -> DataFrame:
    """A label map as a table (column, value, code), of any size."""
    from pyspark.sql import functions as F

    return index.table.select(F.lit(index.column).alias("column"), "value", "code")


def _label_path(path: str, column: str) -> str:
    """Each column has a folder of its own, so several share one path."""
    return f"{path.rstrip('/')}/{quote(column, safe='')}"


def save_label_index(index: LabelIndex, path: str) -> None:
    """The map, and for its heavy labels a rank, so that a loaded index treats
    them apart as the fitted one does."""
    from pyspark.sql import functions as F

    codes = list(index.heavy.values())
    weight = F.coalesce(F.array_position(F.lit(codes[::-1]), F.col("code")), F.lit(0)) if codes else F.lit(0)
    label_table(index).withColumn("n", weight.cast("bigint")).write.mode("overwrite").parquet(
        _label_path(path, index.column)
    )


def load_label_index(spark: SparkSession, path: str, column: str) -> LabelIndex:
    """An absent map, or one without rows, is an error: it would code all as null."""
    table = spark.read.parquet(_label_path(path, column)).select("value", "code", "n")
    index = index_of(column, table)
    if index.codes == {}:
        raise ValueError(f"no labels of {column} in {path}")
    return index
