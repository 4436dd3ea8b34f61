"""Batch scoring: prepare, score, write; and the stored scorer."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rowmill.functions.columns import col
from rowmill.operators.score import reject_reason, score
from rowmill.operators.split import sample_rows
from rowmill.operators.tuning import load_model, save_model
from rowmill.plans.preparation import State, prepare_records
from rowmill.plans.settings import Settings
from rowmill.plans.state import load_state, save_state
from rowmill.sources.workdir import stage
from rowmill.sources.writers import save


SCORES = ("prediction", "probability", "status", "confidence")


def mark_records(
    df: DataFrame, model: Model, state: State, settings: Settings, features: Sequence[str],
    required: Sequence[str] = (),
) -> DataFrame:
    """One row per raw record: key, scores, ``reject_reason`` and ``record``.

    A record without a required value, or without a feature after the
    preparation, has a reason and no scores; ``record`` is then the raw record,
    else null.  A projection, for batch and stream alike.
    """
    key = settings.key
    held = df.withColumn("_record", F.struct(*[col(c) for c in df.columns]))
    held = held.withColumn("_required", reject_reason(df, required))
    prepared = prepare_records(held, state, settings, ["_record", "_required", *features])
    scored = score(prepared, model, features, [key, "_record", "_required"], "_unprepared")
    why = F.coalesce("_required", "_unprepared")
    return scored.select(
        col(key),
        *[F.when(why.isNull(), F.col(c)).alias(c) for c in SCORES],
        why.alias("reject_reason"),
        F.when(why.isNotNull(), F.col("_record")).alias("record"),
    )


def score_records(
    df: DataFrame, model: Model, state: State, settings: Settings, features: Sequence[str]
) -> DataFrame:
    """Raw records to key, prediction, probability, status, confidence and
    reject_reason: a record that cannot be scored has a reason and no scores."""
    return mark_records(df, model, state, settings, features).drop("record")


def split_marked(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Scored rows, and raw records with their reason, of marked records."""
    refused = F.col("reject_reason").isNotNull()
    return (
        marked.filter(~refused).drop("reject_reason", "record"),
        marked.filter(refused).select("record.*", "reject_reason"),
    )


@dataclass(frozen=True)
class ScoredTable:
    """What became of a table's records; the two numbers add up to its rows."""

    scored: DataFrame
    rejected: DataFrame
    num_scored: int
    num_rejected: int


def score_table(
    df: DataFrame,
    model: Model,
    state: State,
    settings: Settings,
    features: Sequence[str],
    sample_size: int | None = None,
    rows_per_file: int | None = None,
    return_proba: bool = True,
    save_path: str | None = None,
    format: str = "parquet",
    required: Sequence[str] = (),
    rejects_path: str | None = None,
) -> ScoredTable:
    """A whole table, or a sample of it.  ``rows_per_file`` bounds the rows of
    one output file, as Spark scores in Arrow and code-generated batches by
    itself.

    The records are marked and written once, and counted while they are; scored
    and rejected rows are read from there and saved to paths of their own.
    """
    rows = df if sample_size is None else sample_rows(df, sample_size, settings.key, settings.seed)
    marked = mark_records(rows, model, state, settings, features, required)
    if not return_proba:
        marked = marked.drop("probability", "confidence")
    seen = Observation()
    refused = F.col("reject_reason").isNotNull()
    counted = marked.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(refused).alias("rejected")
    )
    scored, rejected = split_marked(stage(counted, "scored-records"))
    options = {"maxRecordsPerFile": rows_per_file} if rows_per_file else {}
    if save_path:
        save(scored, save_path, format, **options)
    if rejects_path:
        save(rejected, rejects_path, format, **options)
    total, refused = seen.get["rows"], seen.get["rejected"]
    return ScoredTable(scored, rejected, total - refused, refused)


@dataclass(frozen=True)
class Scorer:
    """Everything that scoring needs besides the records."""

    model: Model
    state: State
    settings: Settings
    features: tuple[str, ...]

    def score(self, df: DataFrame) -> DataFrame:
        return score_records(df, self.model, self.state, self.settings, self.features)

    def mark(self, df: DataFrame, required: Sequence[str] = ()) -> DataFrame:
        return mark_records(df, self.model, self.state, self.settings, self.features, required)

    def score_table(self, df: DataFrame, **options) -> ScoredTable:
        return score_table(df, self.model, self.state, self.settings, self.features, **options)


def save_scorer(spark: SparkSession, scorer: Scorer, path: str) -> None:
    """One folder with model, state, settings and feature order; lookup tables
    that the state holds as paths are copied into it."""
    root = path.rstrip("/")
    state = dict(scorer.state)
    if "predict" in state:
        state["predict"] = dict(state["predict"])
        for i, (column, p) in enumerate(state["predict"].items()):
            if "path" in p:
                save(spark.read.parquet(p["path"]), f"{root}/predict-{i}")
                state["predict"][column] = p | {"path": f"{root}/predict-{i}"}
    save_model(scorer.model, f"{root}/model")
    save_state(spark, state, f"{root}/state")
    held = [(scorer.settings.to_json(), json.dumps(scorer.features))]
    save(spark.createDataFrame(held, "settings string, features string"), f"{root}/settings")


def load_scorer(spark: SparkSession, path: str) -> Scorer:
    """A stored scorer; an absent part of it is an error."""
    root = path.rstrip("/")
    held = spark.read.parquet(f"{root}/settings").first()
    return Scorer(
        load_model(f"{root}/model"),
        load_state(spark, f"{root}/state"),
        Settings.from_json(held["settings"]),
        tuple(json.loads(held["features"])),
    )
