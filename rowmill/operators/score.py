"""Scoring tables with a fitted model."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.functions.columns import col, is_missing, require
from rowmill.functions.scalar import percent_text, vector_element
from rowmill.operators.vectors import assemble


def status_text(prediction: Column) -> Column:
    return F.when(prediction == 1, F.lit("Churn")).when(prediction.isNotNull(), F.lit("Retain"))


def with_status(
    df: DataFrame, prediction: str = "prediction", probability: str = "probability"
) -> DataFrame:
    """Adds ``status`` and ``confidence``: the churn probability in percent,
    also for customers that stay."""
    return df.withColumns(
        {"status": status_text(col(prediction)), "confidence": percent_text(col(probability))}
    )


def score(
    df: DataFrame, model: Model, features: Sequence[str], keep: Sequence[str] = (), reason: str | None = None
) -> DataFrame:
    """Kept columns, class, probability of class 1, status and confidence.

    Every row has one row in the result.  Where a feature is missing there is no
    score: the four are null, and ``reason`` names a column that says why.
    """
    if model is None:
        raise ValueError("no model")
    helper = reason or "_reason"
    marked = df.withColumn(helper, unprepared_reason(df, features))
    scored = model.transform(assemble(marked, features, [*keep, helper], invalid="keep"))
    usable = col(helper).isNull()
    if "probability" in scored.columns:
        probability = F.when(usable, vector_element(F.col("probability"), 1))
    else:  # a linear SVM has a margin only
        probability = F.lit(None).cast("double")
    out = with_status(
        scored.select(
            *[col(c) for c in keep],
            F.when(usable, F.col("prediction").cast("int")).alias("prediction"),
            probability.alias("probability"),
            col(helper),
        )
    )
    order = [*keep, "prediction", "probability", "status", "confidence"] + ([reason] if reason else [])
    return out.select(*[col(c) for c in order])


def unprepared_reason(df: DataFrame, features: Sequence[str]) -> Column:
    """Which features a row lacks; null for a row that can be scored."""
    require(df, features)
    absent = F.array_compact(F.array(*[F.when(is_missing(df, c), F.lit(c)) for c in features]))
    return F.when(F.size(absent) > 0, F.concat(F.lit("not prepared: "), F.array_join(absent, ",")))


def reject_reason(df: DataFrame, required: Sequence[str]) -> Column:
    """Why a record cannot be scored; null for a good one, and where nothing is required."""
    require(df, required)
    if not required:
        return F.lit(None).cast("string")
    absent = [F.when(is_missing(df, c), F.lit(c)) for c in required]
    names = F.array_compact(F.array(*absent))
    return F.when(F.size(names) == len(required), F.lit("empty record")).when(
        F.size(names) > 0, F.concat(F.lit("missing: "), F.array_join(names, ","))
    )


def mark_rejects(df: DataFrame, required: Sequence[str], output: str = "reject_reason") -> DataFrame:
    return df.withColumn(output, reject_reason(df, required))


def split_rejects(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Records that can be scored, and the others with their reason."""
    marked = mark_rejects(df, required)
    good = marked.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return good, marked.filter(F.col("reject_reason").isNotNull())


def predict_with(
    df: DataFrame, function: Callable, inputs: Sequence[str], output: str, data_type: str = "string"
) -> DataFrame:
    """A caller's own function of pandas Series, applied in Arrow batches."""
    udf = F.pandas_udf(function, T._parse_datatype_string(data_type))
    return df.withColumn(output, udf(*[col(c) for c in inputs]))
