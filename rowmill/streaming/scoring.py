"""Scoring a stream of records.

The preparation and the model are projections, so the same functions serve the
batch and the stream.  Each micro-batch writes under its own batch number and
overwrites what an earlier attempt left there: a batch that runs again after a
failure gives the same files.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rowmill.operators.evaluate import prediction_summary
from rowmill.operators.score import split_rejects
from rowmill.plans.scoring import SCORES, Scorer, split_marked


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    format: str = "parquet",
    files: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """New files of a folder as a stream; ``files`` is a glob on their names."""
    reader = spark.readStream.format(format).schema(schema)
    if files:
        reader = reader.option("pathGlobFilter", files)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def score_stream(
    records: DataFrame, scorer: Callable[[DataFrame], DataFrame], output: str, checkpoint: str
) -> StreamingQuery:
    """Score everything that is there and append it to a parquet table."""
    return (
        scorer(records)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def score_batches(
    records: DataFrame,
    scorer: Scorer | Callable[[DataFrame], DataFrame],
    required: Sequence[str],
    output: str,
    checkpoint: str,
    splitter: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None,
) -> StreamingQuery:
    """Per micro-batch: scored rows, rejected records and a metrics row, in
    ``scored``, ``rejected`` and ``metrics`` below the output path.

    A ``Scorer`` marks a batch in one pass: a record that lacks a required value,
    or a feature after the preparation, is rejected with its reason.  A function
    scores what ``splitter`` lets through, by default the records with all
    required columns; what it returns with a ``reject_reason`` is rejected too.
    Scored and rejected rows have to add up to the batch, else the batch fails.
    """
    root = output.rstrip("/")

    def write(table: DataFrame, name: str, batch: int) -> DataFrame:
        path = f"{root}/{name}/batch_id={batch}"
        table.write.mode("overwrite").parquet(path)
        return table.sparkSession.read.schema(table.schema).parquet(path)

    def parts_of(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        if isinstance(scorer, Scorer) and splitter is None:
            return split_marked(scorer.mark(batch, required).persist())
        good, bad = splitter(batch) if splitter else split_rejects(batch, required)
        scored = (scorer.score if isinstance(scorer, Scorer) else scorer)(good)
        if "reject_reason" not in scored.columns:
            return scored, bad
        refused = scored.filter(F.col("reject_reason").isNotNull()).drop(*SCORES)
        return (
            scored.filter(F.col("reject_reason").isNull()).drop("reject_reason"),
            bad.unionByName(refused, allowMissingColumns=True).select(bad.columns),
        )

    def one_batch(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            good, bad = parts_of(batch)
            scored, rejected = write(good, "scored", number), write(bad, "rejected", number)
            summary = write(prediction_summary(scored), "metrics", number).first()
            if summary["num_predictions"] + rejected.count() != batch.count():
                raise ValueError(f"batch {number}: scored and rejected records do not add up to the batch")
        finally:
            batch.unpersist()

    return (
        records.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def metrics_history(spark: SparkSession, output: str) -> DataFrame:
    """The metrics rows of all batches, with their batch number."""
    return spark.read.parquet(f"{output.rstrip('/')}/metrics").orderBy(F.col("batch_id"))
