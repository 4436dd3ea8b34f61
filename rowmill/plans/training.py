"""The training job: read the parts, fit or tune, save, evaluate, summarise."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.functions.columns import col
from rowmill.operators.evaluate import confusion_matrix, metrics_of
from rowmill.operators.models import build_model
from rowmill.operators.score import score
from rowmill.operators.split import stratified_folds
from rowmill.operators.tuning import few_partitions, fit, grid_search, save_model
from rowmill.operators.vectors import assemble
from rowmill.plans import preparation
from rowmill.plans.scoring import Scorer, save_scorer
from rowmill.plans.settings import Settings
from rowmill.plans.state import load_state
from rowmill.sources.readers import read_splits


def features_of(df: DataFrame, key: str, target: str) -> list[str]:
    """All columns but key, target, split, and the numbers of new rows."""
    return [c for c in df.columns if c not in (key, target, "split", "copy")]


def training_table(
    df: DataFrame, key: str, target: str, features: Sequence[str], folds: int | None = None
) -> DataFrame:
    """(features, label) and, with folds, a stratified fold per row."""
    rows = df.filter(F.col("split") == "train")
    if folds:
        rows = stratified_folds(rows, key, target, folds)
    keep = [target] + (["fold"] if folds else [])
    return assemble(rows, features, keep).withColumnRenamed(target, "label").withColumn(
        "label", F.col("label").cast("double")
    )


def train(
    df: DataFrame,
    model: str = "random_forest",
    key: str = "CustomerId",
    target: str = "Exited",
    grid: Mapping[str, Sequence] | None = None,
    folds: int = 5,
    scoring: str = "accuracy",
    model_path: str | None = None,
    **params,
) -> tuple[DataFrame, object]:
    """Fit one model, or search a grid, on the training part; the summary has
    the metrics on the test part."""
    start = time.perf_counter()
    features = features_of(df, key, target)
    if grid is None:
        table = training_table(df, key, target, features).persist()
        try:
            rows = table.count()
            fitted, train_accuracy = fit(table, build_model(model, rows, **params))
            best_score = None
        finally:
            table.unpersist()
    else:
        table = training_table(df, key, target, features, folds)
        result = grid_search(table, model, grid, "fold", scoring, **params)
        fitted, best_score = result.best_model, result.best_score
        right = F.avg((F.col("prediction") == F.col("label")).cast("double"))
        train_accuracy, rows = fitted.transform(table).agg(right, F.count(F.lit(1))).first()
    if model_path:
        save_model(fitted, model_path)
    test = df.filter(F.col("split") == "test")
    # the metrics are of the rows that have a score; every task reads the whole model
    scored = score(few_partitions(test, rows), fitted, features, [key, target]).filter(F.col("prediction").isNotNull())
    spent = time.perf_counter() - start
    # all metrics, and the rows, from one pass over the scored part
    cells = {(r[0], r[1]): r[2] for r in confusion_matrix(scored, target, "prediction").collect()}
    metrics = metrics_of(cells)
    reached = [metrics[m] for m in ("accuracy", "precision", "recall", "f1")]
    row = (model, rows, sum(cells.values()), len(features), spent, train_accuracy, best_score, *reached)
    schema = (
        "model string, train_rows bigint, test_rows bigint, num_features int, seconds double, "
        "train_accuracy double, best_score double, accuracy double, precision double, recall double, f1 double"
    )
    return df.sparkSession.createDataFrame([row], schema), fitted


def run(
    spark: SparkSession,
    path: str,
    data_format: str = "parquet",
    schema=None,
    source: DataFrame | None = None,
    settings: Settings | None = None,
    force_rebuild: bool = False,
    scorer_path: str | None = None,
    **options,
):
    """Train on the parts that the preparation job wrote.

    Given a ``source``, parts that are absent, or were made with other settings,
    are prepared first.  ``scorer_path`` stores what scoring needs: the model
    with the state and the settings of the parts.
    """
    if source is not None:
        preparation.run(source, path, settings, data_format, force_rebuild)
    parts = read_splits(spark, path, data_format, schema)
    summary, fitted = train(parts, **options)
    if scorer_path:
        root = path.rstrip("/")
        made_with = spark.read.parquet(f"{root}/settings").first()["settings"]
        s, state = Settings.from_json(made_with), load_state(spark, f"{root}/state")
        save_scorer(spark, Scorer(fitted, state, s, tuple(features_of(parts, s.key, s.target))), scorer_path)
    return summary, fitted


def scored_test(df: DataFrame, fitted, key: str = "CustomerId", target: str = "Exited") -> DataFrame:
    """Predictions for the test part beside their key and label."""
    test = df.filter(F.col("split") == "test")
    return score(test, fitted, features_of(df, key, target), [key, target])
