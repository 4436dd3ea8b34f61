"""Scoring records in batch and as a stream."""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import functions as F

from rowmill.catalog.base import CHURN, KEPT, churn, kept, query, rounded, table
from rowmill.operators import impute, models, score, tuning
from rowmill.plans.preparation import prepare, prepare_records
from rowmill.plans import training
from rowmill.plans.scoring import Scorer, load_scorer, save_scorer, score_records, score_table
from rowmill.plans.settings import Settings
from rowmill.plans.state import load_state
from rowmill.plans.training import features_of, training_table
from rowmill.sources import workdir
from rowmill.sources.writers import save
from rowmill.streaming import scoring as streams

SETTINGS = Settings(fit_on="all", bin_otherwise="Poor")


def _trained(spark, d):
    """Settings, fitted state, features and a model of the churn table."""
    prepared, state = prepare(churn(spark, d), SETTINGS)
    features = features_of(prepared, SETTINGS.key, SETTINGS.target)
    data = training_table(prepared, SETTINGS.key, SETTINGS.target, features)
    model, _ = tuning.fit(data, models.build_model("decision_tree", max_depth=5))
    return state, features, model


# statistics as the preparation fits them: filled, two outlier columns removed
PREPARED = KEPT + """, a AS (SELECT avg(Age) AS mean_age FROM kept),
filled AS (SELECT * REPLACE (coalesce(Age, mean_age) AS Age, coalesce(Gender, 'Unknown') AS Gender) FROM kept, a),
q AS (SELECT
  quantile_cont(CreditScore::DOUBLE, 0.25) AS c1, quantile_cont(CreditScore::DOUBLE, 0.75) AS c3,
  quantile_cont(Age, 0.25) AS a1, quantile_cont(Age, 0.75) AS a3,
  quantile_cont(NumOfProducts::DOUBLE, 0.25) AS n1, quantile_cont(NumOfProducts::DOUBLE, 0.75) AS n3
  FROM filled),
fine AS (SELECT filled.* FROM filled, q WHERE
  (CreditScore < c1 - 1.5 * (c3 - c1) OR CreditScore > c3 + 1.5 * (c3 - c1))::INT
  + (Age < a1 - 1.5 * (a3 - a1) OR Age > a3 + 1.5 * (a3 - a1))::INT
  + (NumOfProducts < n1 - 1.5 * (n3 - n1) OR NumOfProducts > n3 + 1.5 * (n3 - n1))::INT < 2),
r AS (SELECT min(Balance) AS bl, max(Balance) AS bh, min(Age) AS gl, max(Age) AS gh,
  min(EstimatedSalary) AS sl, max(EstimatedSalary) AS sh FROM fine)
"""


def features_sql(source: str, otherwise: str) -> str:
    """The feature columns over a table of filled rows, beside r."""
    return f"""round((Age - gl) / (gh - gl), 9) AS "Age", Tenure, round((Balance - bl) / (bh - bl), 9) AS "Balance",
  NumOfProducts, HasCrCard, IsActiveMember, round((EstimatedSalary - sl) / (sh - sl), 9) AS "EstimatedSalary",
  CASE WHEN CreditScore = 850 THEN 4 WHEN CreditScore BETWEEN 300 AND 580 THEN 0
    WHEN CreditScore BETWEEN 580 AND 670 THEN 1 WHEN CreditScore BETWEEN 670 AND 740 THEN 2
    WHEN CreditScore BETWEEN 740 AND 800 THEN 3 WHEN CreditScore BETWEEN 800 AND 850 THEN 4
    {otherwise} END AS "CreditScoreBins",
  (Geography = 'AFRICA')::INT AS "Geography_AFRICA", (Geography = 'AMERICA')::INT AS "Geography_AMERICA",
  (Geography = 'ASIA')::INT AS "Geography_ASIA", (Geography = 'EUROPE')::INT AS "Geography_EUROPE",
  (Geography = 'MIDDLE EAST')::INT AS "Geography_MIDDLE_EAST", (Gender = 'Female')::INT AS "Gender_Female",
  (Gender = 'Male')::INT AS "Gender_Male", (Gender = 'Unknown')::INT AS "Gender_Unknown"
  FROM {source}, r"""


@query(
    "sco_2_prepared_records",
    PREPARED
    + """, every AS (SELECT * REPLACE (coalesce(Age, mean_age) AS Age, coalesce(Gender, 'Unknown') AS Gender)
      FROM churn, a) SELECT CustomerId, """
    + features_sql("every", "ELSE 0"),
)
def _(spark, d):
    prepared, state = prepare(churn(spark, d), SETTINGS)
    features = features_of(prepared, SETTINGS.key, SETTINGS.target)
    return rounded(prepare_records(churn(spark, d), state, SETTINGS, features), 9)


@query("sco_1_loaded_scorer", CHURN + "SELECT count(*) AS scored, count(*) AS equal FROM churn")
def _(spark, d):
    """Records scored by a trained model, and by the same one read from its folder."""
    path, records = workdir.new_path(spark, "sco1"), churn(spark, d)
    _, model = training.run(
        spark, f"{path}/parts", source=records, settings=SETTINGS, scorer_path=f"{path}/scorer"
    )
    loaded = load_scorer(spark, f"{path}/scorer")
    state = load_state(spark, f"{path}/parts/state")
    before = score_records(records, model, state, SETTINGS, loaded.features)
    after = loaded.score(records)
    said = ["prediction", "probability", "status", "confidence"]
    both = before.select("CustomerId", F.struct(*said).alias("before")).join(
        after.select("CustomerId", F.struct(*said).alias("after")), "CustomerId"
    )
    return both.agg(
        F.count(F.lit(1)).alias("scored"), F.count_if(F.col("before") == F.col("after")).alias("equal")
    )


@query("sco_3_batch_scores")
def _(spark, d):
    state, features, model = _trained(spark, d)
    path = workdir.new_path(spark, "sco3")
    score_table(
        churn(spark, d), model, state, SETTINGS, features, rows_per_file=1_000_000, save_path=path
    )
    return rounded(spark.read.parquet(path))


COMPLETE_SQL = CHURN + """SELECT count(*) FILTER (Age IS NOT NULL AND CreditScore BETWEEN 300 AND 850) AS scored,
      count(*) FILTER (Age IS NULL) AS missing,
      count(*) FILTER (Age IS NOT NULL AND NOT CreditScore BETWEEN 300 AND 850) AS not_prepared,
      count(*) AS total FROM churn"""


def _kinds(rows, *names):
    """Numbers of scored and rejected records by the kind of reason."""
    kind = F.split(F.coalesce("reject_reason", F.lit("scored")), ":")[0]
    return rows.select(*names, kind.alias("kind")).groupBy(*names).agg(
        F.count_if(F.col("kind") == "scored").alias("scored"),
        F.count_if(F.col("kind").isin("missing", "empty record")).alias("missing"),
        F.count_if(F.col("kind") == "not prepared").alias("not_prepared"),
        F.count(F.lit(1)).alias("total"),
    )


def _default_scorer(spark, d):
    """A scorer under the default settings, which leave some records unprepared."""
    settings = Settings()
    prepared, state = prepare(churn(spark, d), settings)
    features = features_of(prepared, settings.key, settings.target)
    data = training_table(prepared, settings.key, settings.target, features)
    model, _ = tuning.fit(data, models.build_model("decision_tree", max_depth=5))
    return Scorer(model, state, settings, tuple(features))


@query("sco_3_complete", COMPLETE_SQL)
def _(spark, d):
    """Every record of a table is in the saved scores or in the saved rejects."""
    path = workdir.new_path(spark, "sco3-complete")
    found = _default_scorer(spark, d).score_table(
        churn(spark, d), required=["Age"], save_path=f"{path}/scored", rejects_path=f"{path}/rejected"
    )
    scored = spark.read.parquet(f"{path}/scored").select(F.lit(None).cast("string").alias("reject_reason"))
    both = scored.unionByName(spark.read.parquet(f"{path}/rejected").select("reject_reason"))
    return _kinds(both.filter(F.lit(found.num_scored + found.num_rejected) == both.count()))


@query(
    "sco_3_scorer_keeps_records",
    CHURN
    + """SELECT CustomerId, CreditScore BETWEEN 300 AND 850 AS scored,
      CASE WHEN NOT CreditScore BETWEEN 300 AND 850 THEN 'not prepared: CreditScoreBins' END AS reject_reason
    FROM churn""",
)
def _(spark, d):
    """Without any further argument a stored scorer answers for each record."""
    path = workdir.new_path(spark, "sco3-scorer")
    save_scorer(spark, _default_scorer(spark, d), path)
    found = load_scorer(spark, path).score(churn(spark, d))
    return found.select("CustomerId", F.col("status").isNotNull().alias("scored"), "reject_reason")


@query(
    "sco_3_sampled_scores",
    CHURN
    + """SELECT CustomerId, true AS scored FROM churn
    ORDER BY ('0x' || substr(md5('42:' || CustomerId), 1, 8))::BIGINT, CustomerId LIMIT 100""",
)
def _(spark, d):
    state, features, model = _trained(spark, d)
    scored = score_table(
        churn(spark, d), model, state, SETTINGS, features, sample_size=100, return_proba=False
    )
    return scored.scored.select("CustomerId", F.col("status").isin("Churn", "Retain").alias("scored"))


def _landed(spark, d):
    """The churn records as files of a landing folder."""
    path = workdir.new_path(spark, "landing")
    records = churn(spark, d)
    save(records.repartition(4, "CustomerId"), path)
    return path, records.schema


@query(
    "str_1_stream_equals_batch",
    CHURN + "SELECT count(*) AS scored, count(*) AS equal_to_batch FROM churn",
)
def _(spark, d):
    state, features, model = _trained(spark, d)
    folder, schema = _landed(spark, d)
    output, checkpoint = workdir.new_path(spark, "str1"), workdir.new_path(spark, "str1-checkpoint")

    def scorer(df):
        return score_records(df, model, state, SETTINGS, features)

    records = streams.read_stream(spark, folder, schema, files_per_batch=2)
    streams.score_stream(records, scorer, output, checkpoint).awaitTermination()
    batch = scorer(spark.read.schema(schema).parquet(folder)).select(
        "CustomerId", F.struct("prediction", "probability", "status", "confidence").alias("batch")
    )
    streamed = spark.read.parquet(output).select(
        "CustomerId", F.struct("prediction", "probability", "status", "confidence").alias("stream")
    )
    return streamed.join(batch, "CustomerId", "left").agg(
        F.count(F.lit(1)).alias("scored"),
        F.count_if(F.col("stream") == F.col("batch")).alias("equal_to_batch"),
    )


@query(
    "str_2_reject_reasons",
    CHURN
    + """SELECT CustomerId, CASE WHEN Age IS NULL AND Gender IS NULL THEN 'empty record'
      WHEN Age IS NULL THEN 'missing: Age' WHEN Gender IS NULL THEN 'missing: Gender' END AS reject_reason
    FROM churn""",
)
def _(spark, d):
    return score.mark_rejects(churn(spark, d), ["Age", "Gender"]).select("CustomerId", "reject_reason")


def _scored_batches(spark, d):
    state, features, model = _trained(spark, d)
    folder, schema = _landed(spark, d)
    output, checkpoint = workdir.new_path(spark, "batches"), workdir.new_path(spark, "batches-checkpoint")
    records = streams.read_stream(spark, folder, schema, files_per_batch=2)
    streams.score_batches(
        records,
        lambda df: score_records(df, model, state, SETTINGS, features),
        ["Age"],
        output,
        checkpoint,
    ).awaitTermination()
    return output


@query(
    "str_2_stream_rejects",
    CHURN
    + """SELECT 'scored' AS output, count(*) AS rows FROM churn WHERE Age IS NOT NULL
    UNION ALL SELECT 'rejected', count(*) FROM churn WHERE Age IS NULL""",
)
def _(spark, d):
    output = _scored_batches(spark, d)
    parts = [
        spark.read.parquet(f"{output}/{name}").agg(
            F.lit(name).alias("output"), F.count(F.lit(1)).alias("rows")
        )
        for name in ("scored", "rejected")
    ]
    return parts[0].unionByName(parts[1])


@query("str_2_complete", COMPLETE_SQL)
def _(spark, d):
    """Under the default settings every record is scored or rejected."""
    return _streamed_kinds(spark, d, lambda scorer: scorer)


@query("str_2_complete_by_function", COMPLETE_SQL)
def _(spark, d):
    """The same of a scoring function, and without a splitter."""
    return _streamed_kinds(spark, d, lambda scorer: scorer.score)


def _streamed_kinds(spark, d, chosen):
    folder, schema = _landed(spark, d)
    output, checkpoint = workdir.new_path(spark, "complete"), workdir.new_path(spark, "complete-checkpoint")
    streams.score_batches(
        streams.read_stream(spark, folder, schema, files_per_batch=2),
        chosen(_default_scorer(spark, d)),
        ["Age"],
        output,
        checkpoint,
    ).awaitTermination()
    scored = spark.read.parquet(f"{output}/scored").select(F.lit(None).cast("string").alias("reject_reason"))
    return _kinds(scored.unionByName(spark.read.parquet(f"{output}/rejected").select("reject_reason")))


@query(
    "str_3_batch_metrics",
    CHURN
    + """SELECT 2 AS batches, count(*) AS predictions, count(*) AS by_class, count(*) AS by_risk
    FROM churn WHERE Age IS NOT NULL""",
)
def _(spark, d):
    history = streams.metrics_history(spark, _scored_batches(spark, d))
    return history.agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("num_predictions").alias("predictions"),
        F.sum(F.col("churn_predictions") + F.col("retain_predictions")).alias("by_class"),
        F.sum(F.col("high_risk") + F.col("medium_risk") + F.col("low_risk")).alias("by_risk"),
    )


@query(
    "udf_1_two_column_function",
    KEPT
    + """SELECT CustomerId, CASE WHEN (length(Firstname) + length(Lastname)) % 2 = 0 THEN 'Male'
      ELSE 'Female' END AS predicted FROM kept""",
)
def _(spark, d):
    def predict(first: pd.Series, last: pd.Series) -> pd.Series:
        even = (first.str.len() + last.str.len()) % 2 == 0
        return even.map({True: "Male", False: "Female"})

    rows = kept(spark, d).select("CustomerId", "Firstname", "Lastname")
    return score.predict_with(rows, predict, ["Firstname", "Lastname"], "predicted").select(
        "CustomerId", "predicted"
    )


@query(
    "udf_2_first_vector_element",
    "SELECT vec_id, embedding[1]::DOUBLE AS first FROM embeddings",
)
def _(spark, d):
    from pyspark.ml.functions import array_to_vector

    from rowmill.functions.scalar import vector_element

    vector = array_to_vector(F.col("embedding").cast("array<double>"))
    return table(spark, d, "embeddings").select("vec_id", vector_element(vector, 0).alias("first"))


@query(
    "udf_3_per_value_function",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity <= 10 THEN 'small' WHEN l_quantity <= 30 THEN 'middle'
      WHEN l_quantity <= 50 THEN 'large' END AS "l_quantityBins" FROM lineitem""",
)
def _(spark, d):
    from rowmill.operators.binning import bin_column

    lineitem = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return bin_column(lineitem, "l_quantity", {"small": [0, 10], "middle": [10, 30], "large": [30, 50]})
