"""Where intermediate tables are written.

The cluster names a shared folder in ``spark.checkpoint.dir``.  Only where that
is unset, as in a local test session, a folder on this machine is used.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    context = spark.sparkContext
    named = spark.conf.get(SETTING, None) or context.getConf().get(SETTING)
    if named:
        return named
    if not context.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that all executors can reach")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="rowmill-")
    return _local_dirs[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/rowmill/{name}-{uuid.uuid4().hex[:12]}"


def use_checkpoints(spark: SparkSession) -> None:
    """Let iterative trainers cut their lineage in the shared folder."""
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(new_path(spark, "checkpoints"))


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write a stage once and go on from the written table (cuts lineage)."""
    spark = df.sparkSession
    path = path or new_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
