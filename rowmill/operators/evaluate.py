"""Scores of predictions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.functions.columns import col, require


def confusion_matrix(
    df: DataFrame, label: str, prediction: str, classes: Sequence[int] = (0, 1)
) -> DataFrame:
    """(label, prediction, count) for every pair of the given classes and those
    that occur, a missing value among them; absent cells are 0, and the counts
    add up to the rows."""
    require(df, [label, prediction])
    counted = df.groupBy(col(label).cast("int"), col(prediction).cast("int")).count().collect()
    cells = {(r[0], r[1]): r[2] for r in counted}
    names = sorted({*classes} | {c for cell in cells for c in cell if c is not None})
    if any(None in cell for cell in cells):
        names.append(None)
    rows = [(a, p, cells.get((a, p), 0)) for a in names for p in names]
    return df.sparkSession.createDataFrame(rows, "label int, prediction int, count bigint")


def metrics_of(cells: Mapping[tuple[int, int], int]) -> dict[str, float]:
    """Accuracy, and precision, recall and F1 of class 1, from counts by
    (label, prediction); an empty denominator gives 0."""

    def ratio(a: float, b: float) -> float:
        return a / b if b else 0.0

    tp = cells.get((1, 1), 0)
    fp = sum(n for (a, p), n in cells.items() if p == 1 and a not in (1, None))
    fn = sum(n for (a, p), n in cells.items() if a == 1 and p not in (1, None))
    right = sum(n for (a, p), n in cells.items() if a == p)
    return {
        "accuracy": ratio(right, sum(cells.values())),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
    }


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def classification_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: accuracy, precision, recall, f1 of class 1."""
    require(df, [label, prediction])
    y, p = col(label), col(prediction)
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(y == p).alias("right"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y != 1) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p != 1)).alias("fn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        _ratio(F.col("right"), F.col("n")).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def extended_metrics(
    df: DataFrame, label: str, prediction: str, probability: str, epsilon: float = 1e-15
) -> DataFrame:
    """Class-weighted precision, recall and F1, log loss and area under ROC.

    The area comes from Spark's evaluator without thinning of the thresholds,
    which sums over range partitions of the score.
    """
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    y, p = col(label), col(prediction)
    q = F.least(F.greatest(col(probability), F.lit(epsilon)), F.lit(1 - epsilon))
    n, tp, fp, fn, tn = F.count(F.lit(1)), *[
        F.count_if((y == a) & (p == b)) for a, b in ((1, 1), (0, 1), (1, 0), (0, 0))
    ]
    positive, negative = tp + fn, tn + fp

    def weighted(of_one: Column, of_zero: Column) -> Column:
        return _ratio(of_one * positive + of_zero * negative, n)

    area = BinaryClassificationEvaluator(
        rawPredictionCol="score", labelCol="label", metricName="areaUnderROC", numBins=0
    ).evaluate(df.select(col(probability).alias("score"), y.cast("double").alias("label")))
    return df.agg(
        weighted(_ratio(tp, tp + fp), _ratio(tn, tn + fn)).alias("weighted_precision"),
        weighted(_ratio(tp, positive), _ratio(tn, negative)).alias("weighted_recall"),
        weighted(_ratio(2 * tp, 2 * tp + fp + fn), _ratio(2 * tn, 2 * tn + fp + fn)).alias(
            "weighted_f1"
        ),
        (-F.avg(F.when(y == 1, F.ln(q)).otherwise(F.ln(F.lit(1.0) - q)))).alias("log_loss"),
        F.lit(area).alias("roc_auc"),
    )


def prediction_summary(
    df: DataFrame, prediction: str = "prediction", probability: str | None = "probability"
) -> DataFrame:
    """Number and mean of predictions, class counts and risk bands."""
    p = col(prediction)
    aggregates = [
        F.count(F.lit(1)).alias("num_predictions"),
        F.avg(p.cast("double")).alias("avg_prediction"),
        F.count_if(p == 1).alias("churn_predictions"),
        F.count_if(p == 0).alias("retain_predictions"),
    ]
    if probability:
        q = col(probability)
        aggregates += [
            F.avg(q).alias("avg_churn_probability"),
            F.count_if(q > 0.7).alias("high_risk"),
            F.count_if((q > 0.5) & (q <= 0.7)).alias("medium_risk"),
            F.count_if(q <= 0.5).alias("low_risk"),
        ]
    return df.agg(*aggregates)
