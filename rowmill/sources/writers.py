"""Table sinks."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from rowmill.sources.readers import CSV_TEXT, load

PARQUET_DEFAULTS = {"compression": "snappy"}


def save(
    df: DataFrame,
    path: str,
    format: str = "parquet",
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    **options,
) -> None:
    defaults = {"csv": CSV_TEXT, "parquet": PARQUET_DEFAULTS}.get(format, {})
    writer = df.write.format(format).mode(mode).options(**{**defaults, **options})
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_splits(df: DataFrame, path: str, output_format: str = "parquet") -> list[str]:
    """One dataset per format, partitioned by ``split``; label and key stay in
    their rows, so features and label can never drift apart.  Of both formats
    the second is copied from the first, so the plan runs once."""
    root, both = path.rstrip("/"), output_format == "both"
    first = "parquet" if both else output_format
    save(df, f"{root}/{first}", first, partition_by=["split"])
    if not both:
        return [f"{root}/{first}"]
    written = load(df.sparkSession, f"{root}/parquet", "parquet", df.schema)
    save(written, f"{root}/csv", "csv", partition_by=["split"])
    return [f"{root}/csv", f"{root}/parquet"]


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a finished Spark write left its success marker at the path."""
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def reuse_or_build(
    spark: SparkSession,
    path: str,
    build: Callable[[], DataFrame],
    force_rebuild: bool = False,
    format: str = "parquet",
    partition_by: list[str] | None = None,
) -> DataFrame:
    """Read the finished output at the path, or build and write it first."""
    if force_rebuild or not is_complete(spark, path):
        save(build(), path, format, partition_by=partition_by)
    return load(spark, path, format)


def to_local(df: DataFrame, max_rows: int) -> pd.DataFrame:
    """A bounded number of rows as pandas, for looking at."""
    if max_rows <= 0:
        raise ValueError("max_rows must be positive")
    return df.limit(max_rows).toPandas()
