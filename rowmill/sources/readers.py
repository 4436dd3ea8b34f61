"""Table sources."""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.functions.columns import col

# The CSV conventions that written and read files share.
CSV_TEXT = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
}
CSV_MISSING = {"nullValue": "", "nanValue": "NaN"}


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, **options
) -> DataFrame:
    """CSV with a header.  A schema saves the extra pass that inference costs."""
    settings = {**CSV_TEXT, **CSV_MISSING, "inferSchema": str(schema is None).lower(), **options}
    reader = spark.read.options(**settings)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def read_parquet(spark: SparkSession, path: str, **options) -> DataFrame:
    return spark.read.options(**options).parquet(path)


def load(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    schema: T.StructType | str | None = None,
    **options,
) -> DataFrame:
    """Any Spark source by its format name, with an optional enforced schema."""
    if format == "csv":
        return read_csv(spark, path, schema, **options)
    reader = spark.read.format(format).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def reader_for(path: str):
    """Reader chosen by file extension."""
    extension = os.path.splitext(path.rstrip("/"))[1].lower()
    readers = {".csv": read_csv, ".parquet": read_parquet}
    if extension not in readers:
        raise ValueError(f"no reader for extension '{extension}' of {path}")
    return readers[extension]


def ingest(spark: SparkSession, path: str, **options) -> DataFrame:
    return reader_for(path)(spark, path, **options)


def records_to_table(
    spark: SparkSession, records: dict | Iterable[dict], schema: T.StructType | str
) -> DataFrame:
    """One request, or the few records of one, as a table with a fixed schema."""
    rows = [records] if isinstance(records, dict) else list(records)
    if not rows or not all(isinstance(r, dict) and r for r in rows):
        raise ValueError("a record must be a non-empty dictionary")
    names = T.StructType.fromDDL(schema).names if isinstance(schema, str) else schema.names
    return spark.createDataFrame([Row(*[r.get(n) for n in names]) for r in rows], schema)


def expand_records(df: DataFrame, record: str, schema: T.StructType | str) -> DataFrame:
    """A column of text maps, one record per row, as typed columns.

    The distributed form of ``records_to_table``: absent fields and text that
    does not fit the type become null, an empty record becomes a null row.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def field(f: T.StructField) -> Column:
        return F.try_element_at(col(record), F.lit(f.name)).try_cast(f.dataType).alias(f.name)

    others = [col(c) for c in df.columns if c != record]
    return df.select(*others, *[field(f) for f in fields])


def read_splits(spark: SparkSession, path: str, format: str = "parquet", schema=None) -> DataFrame:
    """The parts written by ``write_splits``, with their ``split`` column."""
    return load(spark, f"{path.rstrip('/')}/{format}", format, schema)
