"""Sources, sinks, training, scoring and streaming."""

import os

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rowmill.catalog.base import churn
from rowmill.operators import evaluate, models, score, tuning
from rowmill.operators.split import stratified_folds
from rowmill.operators.vectors import assemble
from rowmill.plans import preparation, state, training
from rowmill.plans.scoring import score_records
from rowmill.plans.settings import Settings
from rowmill.sources import readers, workdir, writers
from rowmill.streaming import scoring as streams


# ---- sources and sinks


def test_csv_conventions(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a, b ,c\n1,"say ""hi"", ok",NaN\n,  padded  ,2.5\n')
    rows = readers.ingest(spark, str(tmp_path / "t.csv")).collect()
    assert rows[0][:2] == (1, 'say "hi", ok') and rows[0][2] != rows[0][2]
    assert tuple(rows[1]) == (None, "padded", 2.5)


def test_reader_by_extension():
    assert readers.reader_for("x/a.CSV") is readers.read_csv
    assert readers.reader_for("x/a.parquet/") is readers.read_parquet
    with pytest.raises(ValueError):
        readers.reader_for("a.xlsx")


def test_records(spark):
    df = readers.records_to_table(spark, {"a": 1, "z": 9}, "a int, b string")
    assert [tuple(r) for r in df.collect()] == [(1, None)]
    for bad in ({}, [], [1], [{}]):
        with pytest.raises(ValueError):
            readers.records_to_table(spark, bad, "a int")


def test_save_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(3)
    writers.save(df, path, mode="error")
    writers.save(df, path, mode="append")
    writers.save(df, path, mode="ignore")
    assert readers.load(spark, path).count() == 6
    with pytest.raises(Exception):
        writers.save(df, path, mode="error")


def test_reuse_unless_forced(spark, tmp_path):
    path, built = str(tmp_path / "t"), []

    def build():
        built.append(1)
        return spark.range(len(built))

    assert writers.reuse_or_build(spark, path, build).count() == 1
    assert writers.reuse_or_build(spark, path, build).count() == 1
    assert writers.reuse_or_build(spark, path, build, force_rebuild=True).count() == 2
    os.remove(f"{path}/_SUCCESS")  # an unfinished write does not count
    assert writers.reuse_or_build(spark, path, build).count() == 3


class Cluster:
    """A session on a cluster, with or without a named folder."""

    def __init__(self, named):
        self.conf = {workdir.SETTING: named} if named else {}
        self.sparkContext = self
        self.master = "spark://somewhere"

    def getConf(self):
        return self.conf


def test_shared_folder_is_the_sessions_own(spark):
    assert workdir.shared_dir(Cluster("/shared/x")) == "/shared/x"
    assert workdir.new_path(Cluster("/shared/x/"), "a").startswith("/shared/x/rowmill/a-")
    with pytest.raises(ValueError):  # never a folder of one machine on a cluster
        workdir.shared_dir(Cluster(None))
    staged = workdir.stage(spark.range(5), "x")
    assert staged.count() == 5 and "Range" not in staged._jdf.queryExecution().toString()


def test_local_rows_are_bounded(spark):
    assert len(writers.to_local(spark.range(100), 7)) == 7
    with pytest.raises(ValueError):
        writers.to_local(spark.range(1), 0)


# ---- training


@pytest.fixture(scope="module")
def data(spark):
    df = spark.range(300).select(
        "id",
        F.sin("id").alias("a"),
        (F.col("id") % 13 / 13).alias("b"),
    ).withColumn("label", (F.col("a") + F.col("b") > 0.6).cast("double"))
    rows = stratified_folds(df, "id", "label", 3)
    return assemble(rows, ["a", "b"], ["id", "label", "fold"]).persist()


def test_parameter_names():
    assert models.spark_params("random_forest", {"n_estimators": 5, "max_depth": None}) == {
        "numTrees": 5, "maxDepth": 30}
    assert models.spark_params("boosted_trees", {"n_estimators": 5, "colsample_bytree": 0.8}) == {
        "maxIter": 5, "featureSubsetStrategy": "0.8"}
    assert models.spark_params("decision_tree", {"criterion": "log_loss", "min_samples_split": 2}) == {
        "impurity": "entropy"}
    with pytest.raises(ValueError):
        models.build_model("nothing")
    assert len(tuning.grid_of("boosted_trees")) == 48
    assert [len(tuning.grid_of(m)) for m in ("logistic_regression", "decision_tree", "random_forest")] == [3, 12, 6]


def test_logistic_regression_penalty(data):
    """At the optimum of C * summed loss + |w|^2 / 2 the gradient vanishes."""
    model = models.build_model("logistic_regression", data.count(), C=1.0, tol=1e-12).fit(data)
    w = model.coefficients.toArray()
    rows = model.transform(data).select(
        vector_to_array("features").alias("x"), "label", vector_to_array("probability")[1].alias("p")
    ).collect()
    for j in range(2):
        assert sum((r.p - r.label) * r.x[j] for r in rows) + w[j] == pytest.approx(0, abs=1e-4)


def test_grid_search(spark, data):
    result = tuning.grid_search(
        data, "decision_tree", {"max_depth": [1, 4], "criterion": ["entropy", "log_loss"]}, scoring="f1",
        keep_fold_models=True,
    )
    assert result.best_params["max_depth"] == 4
    table = result.table(spark).orderBy("combination").collect()
    # the two names of the entropy criterion are one fit
    assert table[2]["mean_test_score"] == table[3]["mean_test_score"]
    assert [r["rank_test_score"] for r in table] == [3, 3, 1, 1]
    by_hand = [table[2][f"split{i}_test_score"] for i in range(3)]
    assert table[2]["mean_test_score"] == pytest.approx(sum(by_hand) / 3)
    fold, model = tuning.best_fold_model(result)
    assert by_hand[fold] == max(by_hand) and model.depth <= 4
    assert result.best_model.transform(data).count() == 300


def test_first_rounds_are_the_shorter_model(data):
    """A truncated ensemble gives what a fit of that many rounds gives."""
    options = {"max_depth": 3, "learning_rate": 0.2, "subsample": 0.7, "colsample_bytree": 0.5}
    long = models.build_model("boosted_trees", n_estimators=6, **options).fit(data)
    for rounds in (1, 4, 6):
        short = models.build_model("boosted_trees", n_estimators=rounds, **options).fit(data)
        cut = models.truncated(long, rounds)
        assert cut.getNumTrees == rounds and cut.treeWeights == short.treeWeights
        both = [m.transform(data).orderBy("id").select("rawPrediction", "prediction").collect() for m in (short, cut)]
        assert both[0] == both[1]
    for rounds in (0, 7):
        with pytest.raises(ValueError):
            models.truncated(long, rounds)


def test_rounds_share_a_fit(spark, data, monkeypatch):
    grid = {"n_estimators": [1, 3], "max_depth": [1, 2]}
    alone = [
        tuning.grid_search(data, "boosted_trees", {k: [v] for k, v in c.items()}, refit=False).scores[0]
        for c in tuning.grid_of("boosted_trees", grid)
    ]
    fitted, build = [], tuning.build_model
    monkeypatch.setattr(tuning, "build_model", lambda *a, **k: fitted.append(k) or build(*a, **k))
    result = tuning.grid_search(data, "boosted_trees", grid, refit=False)
    assert result.scores == alone
    assert len(fitted) == 2 * 3 and {k["n_estimators"] for k in fitted} == {3}


def test_two_rounds_share_a_fit_at_any_learning_rate(spark, data, monkeypatch):
    """The weights differ, the first two trees do not; from the third on they do."""
    options = {"max_depth": 2, "subsample": 0.7, "colsample_bytree": 0.5}
    given = models.build_model("boosted_trees", n_estimators=2, learning_rate=0.1, **options).fit(data)
    other = models.build_model("boosted_trees", n_estimators=2, learning_rate=0.9, **options).fit(data)
    cut = models.truncated(given, 2, 0.9)
    assert cut.treeWeights == other.treeWeights == [1.0, 0.9]
    both = [m.transform(data).orderBy("id").select("rawPrediction", "prediction").collect() for m in (cut, other)]
    assert both[0] == both[1]
    with pytest.raises(ValueError):
        models.truncated(models.build_model("boosted_trees", n_estimators=3, max_depth=1).fit(data), 3, 0.9)

    fitted, cls = [], models.ESTIMATORS["boosted_trees"]
    fit = cls.fit
    for rounds, fits in (([1, 2], 1), ([1, 3], 2)):
        grid = {"n_estimators": rounds, "learning_rate": [0.1, 0.9]}
        alone = [
            tuning.grid_search(data, "boosted_trees", {k: [v] for k, v in c.items()}, refit=False, **options).scores[0]
            for c in tuning.grid_of("boosted_trees", grid)
        ]
        monkeypatch.setattr(cls, "fit", lambda self, *a: fitted.append(self) or fit(self, *a))
        result = tuning.grid_search(data, "boosted_trees", grid, refit=False, **options)
        monkeypatch.setattr(cls, "fit", fit)
        assert result.scores == alone
        assert len(fitted) == fits * 3  # folds
        fitted.clear()


@pytest.mark.parametrize("name", ["decision_tree", "random_forest"])
def test_upper_levels_are_the_shallower_model(data, name):
    """A tree or forest cut at a depth gives what a fit of that depth gives."""
    options = {"n_estimators": 7, "random_state": 5} if name == "random_forest" else {}
    deep = models.build_model(name, max_depth=6, **options).fit(data)
    for depth in (0, 1, 3, 5, 6):
        short = models.build_model(name, max_depth=depth, **options).fit(data)
        cut = models.cut_depth(deep, depth)
        assert cut.getOrDefault("maxDepth") == depth
        assert cut.toDebugString.split("\n")[1:] == short.toDebugString.split("\n")[1:]
        both = [m.transform(data).orderBy("id").select("probability", "prediction").collect() for m in (short, cut)]
        assert both[0] == both[1]


@pytest.mark.parametrize("name", ["decision_tree", "random_forest", "logistic_regression"])
def test_depths_and_limits_share_a_fit(spark, data, monkeypatch, name):
    grid = {"max_iter": [3, 500, 900]} if name == "logistic_regression" else {
        "max_depth": [2, 4], "criterion": ["gini", "entropy"]
    }
    options = {"n_estimators": 5} if name == "random_forest" else {}
    alone = [
        tuning.grid_search(data, name, {k: [v] for k, v in c.items()}, refit=False, **options).scores[0]
        for c in tuning.grid_of(name, grid)
    ]
    fitted, cls = [], models.ESTIMATORS[name]
    fit = cls.fit
    monkeypatch.setattr(cls, "fit", lambda self, *a: fitted.append(self) or fit(self, *a))
    monkeypatch.setattr(tuning, "SHARED_DEPTH_ROWS", 0)
    result = tuning.grid_search(data, name, grid, refit=False, keep_fold_models=True, **options)
    assert result.scores == alone
    assert len(fitted) == 2 * 3  # folds
    assert len(result.manifest) == 3 * len(alone)
    assert tuning.best_fold_model(result)[1].transform(data).count() == data.count()


def test_fold_models_are_stored_and_let_go(spark, data, monkeypatch):
    """No more models are alive than are being fitted; the best one scores other rows."""
    import gc
    import weakref

    alive, most, save = [], [], tuning.save_model

    def noted(model, path):
        alive.append(weakref.ref(model.stages[0]))
        gc.collect()
        most.append(sum(r() is not None for r in alive))
        save(model, path)

    monkeypatch.setattr(tuning, "save_model", noted)
    result = tuning.grid_search(
        data, "decision_tree", {"max_depth": [1, 2, 3]}, parallelism=2, keep_fold_models=True, refit=False
    )
    gc.collect()
    assert len(most) == 9 and max(most) <= 2 and not any(r() for r in alive)
    stored = result.model_table(spark).collect()
    assert len(stored) == 9 and len({r.path for r in stored}) == 9
    fold, model = tuning.best_fold_model(result)
    kept = tuning.load_model(result.fold_models[fold])
    assert kept.stages[-1].toDebugString == model.toDebugString
    assert tuning.score_best_fold(result, data.drop("label")).count() == data.count()


def test_partitions_of_a_fit_follow_the_cores(spark):
    """More rows make no more partitions until a task would hold too many."""
    cores = spark.sparkContext.defaultParallelism
    many = spark.range(1000).repartition(cores * 6)
    sizes = {n: tuning.few_partitions(many, n).rdd.getNumPartitions() for n in (0, 1, 30_000, 900_000, 900_000 * cores)}
    assert sizes == {0: 1, 1: 1, 30_000: 2, 900_000: cores, 900_000 * cores: -(-900_000 * cores // 500_000)}
    assert sorted(r.id for r in tuning.few_partitions(many, 900_000).collect()) == list(range(1000))


def test_a_fit_leaves_the_plan_of_its_rows(spark, data, monkeypatch):
    """Each task of a fit would carry the plan along and answer with its counters; rows and partitions stay."""
    seen = data.groupBy("id").agg(F.first("features").alias("features"), F.max("label").alias("label"))
    seen = seen.join(data.select("id").distinct(), "id").sortWithinPartitions("id").persist()
    estimator = models.build_model("gradient_boosting", n_estimators=2, max_depth=2)
    given, real = [], type(estimator).fit
    monkeypatch.setattr(type(estimator), "fit", lambda self, df, params=None: given.append(df) or real(self, df, params))
    model, accuracy = tuning.fit(seen, estimator)
    assert given[0]._jdf.queryExecution().executedPlan().toString().count("\n") == 1  # a scan
    whole = tuning.few_partitions(seen, seen.count())
    assert given[0].collect() == whole.collect() and len(given[0].collect()) > 0
    assert given[0].rdd.getNumPartitions() == whole.rdd.getNumPartitions()
    assert model.stages[0].toDebugString.split("\n")[1:] == real(estimator, whole).toDebugString.split("\n")[1:]
    seen.unpersist()


@pytest.mark.parametrize("name", ["decision_tree", "random_forest"])
def test_rows_keep_their_node_between_levels(data, name):
    """A pass over a level does not take every row down from the root, and finds the same trees."""
    options = {"n_estimators": 7, "random_state": 5} if name == "random_forest" else {}
    kept = models.build_model(name, max_depth=6, **options)
    assert kept.getCacheNodeIds()
    sent = models.build_model(name, max_depth=6, **options).setCacheNodeIds(False)
    found = [m.fit(data).toDebugString.split("\n")[1:] for m in (kept, sent)]
    assert found[0] == found[1]


def test_fits_at_once_share_the_cores(spark, data, monkeypatch):
    """Fits that run together have two tasks a core between them; one alone has all cores."""
    cores = spark.sparkContext.defaultParallelism
    many = spark.range(1000).repartition(cores * 6)
    for at_once in (1, 2, 4, 8):
        parts = tuning.few_partitions(many, 900_000, at_once).rdd.getNumPartitions()
        assert parts == min(cores, -(-2 * cores // at_once))
    asked, few = [], tuning.few_partitions
    monkeypatch.setattr(tuning, "few_partitions", lambda d, n, k=1: asked.append(k) or few(d, n, k))
    tuning.grid_search(data, "decision_tree", {"criterion": ["gini", "entropy"]}, parallelism=4, max_depth=2)
    assert asked == [4, 1]  # the search, and the refit alone


def test_large_fits_do_not_run_at_once(spark, data, monkeypatch):
    """What the driver holds of growing trees, and executors of rows, is bounded: one
    unlimited tree of a large table at a time, as many as asked of a small one."""
    memory = tuning.memory_for_rows(spark)
    assert memory > 0
    tree = tuning.fits_at_once("decision_tree", [{"max_depth": 3}, {}], 5_000_000, spark)
    forest = tuning.fits_at_once("random_forest", [{"max_depth": 4}], memory // 2000, spark)
    assert (tree, forest) == (1, 1)
    assert tuning.fits_at_once("decision_tree", [{}], 15_000, spark) >= 8
    assert tuning.fits_at_once("logistic_regression", [{}], 5_000_000, spark) >= 8
    monkeypatch.setattr(tuning, "MOST_NODES", 1)
    running, most = [], []

    def fit(self, rows, *others):
        running.append(1)
        most.append(len(running))
        try:
            return plain(self, rows, *others)
        finally:
            running.pop()

    plain = models.DecisionTreeClassifier._fit
    monkeypatch.setattr(models.DecisionTreeClassifier, "_fit", fit)
    tuning.cross_validate(data, "decision_tree", parallelism=4)
    assert most == [1, 1, 1]


def test_the_registered_boosted_grid_is_whole(spark, folder, monkeypatch):
    """All combinations in all their rounds, on all rows and folds, with the refit."""
    from rowmill.catalog import all_queries, learning

    class Asked(Exception):
        pass

    def grid_search(df, model, grid=None, fold="fold", *, refit=True, **others):
        raise Asked(tuning.grid_of(model, grid), refit, df.groupBy(fold).count().collect())

    monkeypatch.setattr(tuning, "grid_search", grid_search)
    query = all_queries()["trn_6_boosted_grid"]
    with pytest.raises(Asked) as asked:
        query.run(spark, folder)
    combinations, refit, folds = asked.value.args
    assert combinations == tuning.grid_of("boosted_trees", models.GRIDS["boosted_trees"])
    assert {c["n_estimators"] for c in combinations} == {100, 200} and len(combinations) == 48
    assert refit and len(folds) == 5 and sum(r["count"] for r in folds) == learning.kept(spark, folder).count()


def test_models_score_in_a_session_that_observes(data):
    """A summary would take the session along to the executors."""
    from pyspark.sql import Observation

    seen = Observation()
    assert data.observe(seen, F.count(F.lit(1)).alias("n")).count() == seen.get["n"]
    for name in ("logistic_regression", "random_forest", "svm"):
        model, accuracy = tuning.fit(data, models.build_model(name))
        assert accuracy > 0.5 and model.transform(data).select("prediction").distinct().count() == 2
    result = tuning.cross_validate(data, "logistic_regression")
    assert sum(result.cells[0][0].values()) > 0


def test_model_round_trip(data, tmp_path):
    model, accuracy = tuning.fit(data, models.build_model("random_forest", n_estimators=5, max_depth=4))
    assert 0.8 < accuracy <= 1
    tuning.save_model(model, str(tmp_path / "m"))
    loaded = tuning.load_model(str(tmp_path / "m"))
    predictions = [[r.prediction for r in m.transform(data).orderBy("id").collect()] for m in (model, loaded)]
    assert predictions[0] == predictions[1]


def test_metrics_agree(spark):
    rows = [(1, 1)] * 3 + [(0, 1)] * 2 + [(1, 0)] + [(0, 0)] * 4
    df = spark.createDataFrame(rows, "y int, p int")
    by_driver = evaluate.metrics_of({(1, 1): 3, (0, 1): 2, (1, 0): 1, (0, 0): 4})
    assert evaluate.classification_metrics(df, "y", "p").collect()[0].asDict() == pytest.approx(by_driver)
    nothing = evaluate.classification_metrics(df.limit(0), "y", "p").collect()[0]
    assert tuple(nothing) == (0, 0, 0, 0)


def test_area_under_roc(spark):
    df = spark.createDataFrame([(0, 0.1), (1, 0.4), (0, 0.4), (1, 0.9)], "y int, q double").withColumn(
        "p", (F.col("q") > 0.5).cast("int"))
    assert evaluate.extended_metrics(df, "y", "p", "q").collect()[0].roc_auc == pytest.approx(0.875)


# ---- preparation and scoring


def test_settings():
    with pytest.raises(ValueError):
        Settings(scaling="other")
    with pytest.raises(ValueError):
        Settings().with_options(colour="red")


@pytest.fixture(scope="module")
def trained(spark, folder):
    settings = Settings(fit_on="all", bin_otherwise="Poor")
    prepared, fitted = preparation.prepare(churn(spark, folder), settings)
    features = training.features_of(prepared, settings.key, settings.target)
    table = training.training_table(prepared, settings.key, settings.target, features)
    model, _ = tuning.fit(table, models.build_model("decision_tree", max_depth=4))
    return settings, fitted, features, model


def test_prepared_parts(spark, folder):
    prepared, _ = preparation.prepare(churn(spark, folder))
    assert not [c for c in prepared.columns if c.endswith(("_outlier", "_index"))]
    shares = prepared.groupBy("Exited").agg(F.avg((F.col("split") == "test").cast("int")).alias("s"))
    assert all(abs(r.s - 0.2) < 0.08 for r in shares.collect())


def test_state_round_trip(spark, trained, tmp_path):
    _, fitted, _, _ = trained
    state.save_state(spark, fitted, str(tmp_path / "s"))
    assert state.load_state(spark, str(tmp_path / "s")) == fitted
    with pytest.raises(Exception):
        state.load_state(spark, str(tmp_path / "absent")).items()


def test_scoring_one_record(spark, folder, trained):
    settings, fitted, features, model = trained
    raw = churn(spark, folder)
    one = raw.filter("CustomerId = 1").collect()[0].asDict()
    record = readers.records_to_table(spark, one, raw.schema)
    alone = score_records(record, model, fitted, settings, features).collect()
    among = score_records(raw, model, fitted, settings, features).filter("CustomerId = 1").collect()
    assert alone == among and alone[0].status in ("Churn", "Retain")


def test_stream_restart_scores_only_new_files(spark, folder, trained, tmp_path):
    settings, fitted, features, model = trained
    raw = churn(spark, folder)
    landing, out, check = (str(tmp_path / n) for n in ("landing", "out", "check"))

    def run():
        records = streams.read_stream(spark, landing, raw.schema, files="*.parquet")
        streams.score_batches(
            records, lambda df: score_records(df, model, fitted, settings, features),
            ["Gender", "Geography"], out, check,
        ).awaitTermination()

    writers.save(raw.filter("CustomerId < 70"), landing)
    run()
    writers.save(raw.filter("CustomerId >= 70"), landing, mode="append")
    run()
    scored, rejected = (spark.read.parquet(f"{out}/{n}") for n in ("scored", "rejected"))
    assert scored.count() + rejected.count() == raw.count()
    assert rejected.count() == raw.filter("Gender is null").count()
    assert set(r[0] for r in rejected.select("reject_reason").distinct().collect()) == {"missing: Gender"}
    history = streams.metrics_history(spark, out).collect()
    assert [h.batch_id for h in history] == [0, 1]
    assert sum(h.num_predictions for h in history) == scored.count()


def test_a_scored_table_is_complete(spark, folder, tmp_path):
    """Scores and rejects add up, in one marked pass, and a lossy function stops the stream."""
    from rowmill.plans.preparation import prepare
    from rowmill.plans.scoring import Scorer
    from rowmill.plans.settings import Settings
    from rowmill.plans.training import features_of, training_table

    s, rows = Settings(), churn(spark, folder)
    prepared, fitted = prepare(rows, s)
    features = features_of(prepared, s.key, s.target)
    model, _ = tuning.fit(
        training_table(prepared, s.key, s.target, features), models.build_model("decision_tree", max_depth=3)
    )
    scorer = Scorer(model, fitted, s, tuple(features))
    found = scorer.score_table(rows, required=["Age"], return_proba=False, rejects_path=str(tmp_path / "no"))
    assert found.num_scored + found.num_rejected == rows.count() and found.num_rejected > 0
    assert found.scored.count() == found.num_scored
    assert found.scored.columns == [s.key, "prediction", "status"]
    assert found.rejected.columns == [*rows.columns, "reject_reason"]
    assert spark.read.parquet(str(tmp_path / "no")).count() == found.num_rejected
    every = scorer.score(rows).collect()
    assert len(every) == rows.count()
    assert all((r.reject_reason is None) == (r.status is not None) for r in every)
    assert scorer.score_table(rows.limit(0)).num_scored == 0
    records = streams.read_stream(spark, _saved(rows, tmp_path), rows.schema)
    with pytest.raises(Exception, match="add up"):
        streams.score_batches(
            records, lambda df: scorer.score(df).filter("status IS NOT NULL").drop("reject_reason"), [],
            str(tmp_path / "out"), str(tmp_path / "check"),
        ).awaitTermination()


def _saved(rows, tmp_path):
    writers.save(rows, str(tmp_path / "landed"))
    return str(tmp_path / "landed")


def test_rejects(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, ""), (2.0, None)], "x double, s string")
    reasons = [r[0] for r in score.mark_rejects(df, ["x", "s"]).select("reject_reason").collect()]
    assert reasons == [None, "empty record", "missing: s"]
    with pytest.raises(ValueError):
        score.score(df, None, ["x"])


def test_a_fit_is_few_jobs(spark, folder):
    """One aggregation per fit, whatever the number of columns."""
    from rowmill.operators import scale

    lineitem = spark.read.parquet(f"{folder}/lineitem.parquet")
    spark.sparkContext.setJobGroup("fit", "fit")
    scale.fit_min_max(lineitem, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("fit")
    spark.sparkContext.setJobGroup("", "")
    assert 0 < len(jobs) <= 2  # adaptive execution runs the map side as a job of its own


def test_records_are_prepared_as_in_training(spark, folder, tmp_path):
    """With capping and predicted labels, from a stored state."""
    from rowmill.catalog.base import churn, kept
    from rowmill.plans.preparation import prepare, prepare_records
    from rowmill.plans.settings import Settings
    from rowmill.plans.training import features_of

    s = Settings(outlier_method="cap", predict_labels={"Gender": ("Firstname",)})
    prepared, fitted = prepare(churn(spark, folder), s)
    features = features_of(prepared, s.key, s.target)
    state.save_state(spark, fitted, str(tmp_path / "state"))
    loaded = state.load_state(spark, str(tmp_path / "state"))
    records = prepare_records(kept(spark, folder), loaded, s, features)
    expected = prepared.select(s.key, *features)
    assert records.exceptAll(expected.select(records.columns)).count() == 0
    assert records.count() == expected.count()


class GroupMedian:
    """Fills Age by the median of the row's country."""

    def fit(self, df):
        rows = df.groupBy("Geography").agg(F.median("Age").alias("m")).collect()
        return {"medians": {r.Geography: r.m for r in rows}}

    def apply(self, df, fitted):
        cells = [F.lit(x) for pair in fitted["medians"].items() for x in pair]
        return df.withColumn("Age", F.coalesce("Age", F.create_map(*cells)[F.col("Geography")]))


def test_own_imputer_is_a_step(spark, folder, tmp_path):
    """Fitted on the training part, stored by name, replayed when scoring."""
    from rowmill.operators import impute
    from rowmill.operators.split import split_parts

    s, rows = Settings(imputer="median by country", fill_methods={}), churn(spark, folder)
    with pytest.raises(ValueError, match="not registered"):
        preparation.prepare(rows, s)
    impute.register_imputer("median by country", GroupMedian())
    try:
        prepared, fitted = preparation.prepare(rows, s)
        state.save_state(spark, fitted, str(tmp_path / "state"))
        loaded = state.load_state(spark, str(tmp_path / "state"))
        train, _ = split_parts(split_of(rows, s))
        expected = GroupMedian().fit(train)
        assert loaded["imputer"] == {"median by country": expected}
        features = training.features_of(prepared, s.key, s.target)
        records = preparation.prepare_records(rows.filter("Firstname IS NOT NULL"), loaded, s, features)
        both = prepared.select(s.key, "Age").join(records.select(s.key, F.col("Age").alias("again")), s.key)
        assert both.count() == prepared.count() and both.filter("NOT (Age <=> again)").count() == 0
        assert prepared.filter("Age IS NULL").count() == 0 < rows.filter("Age IS NULL").count()
        assert Settings.from_json(s.to_json()).imputer == s.imputer
    finally:
        impute._IMPUTERS.clear()


def split_of(rows, s):
    from rowmill.operators import project
    from rowmill.operators.split import split

    return split(project.drop_missing(rows, s.critical_columns), s.key, s.target, s.split_method, s.test_size, s.seed)


def test_rejects_and_good_records_are_all_records(spark, folder):
    from rowmill.catalog.base import churn
    from rowmill.plans.preparation import prepare, split_records
    from rowmill.plans.settings import Settings
    from rowmill.plans.training import features_of

    s, rows = Settings(), churn(spark, folder)
    prepared, fitted = prepare(rows, s)
    good, bad = split_records(rows, fitted, s, features_of(prepared, s.key, s.target), ["Age"])
    assert good.columns == rows.columns
    assert good.count() + bad.count() == rows.count()
    assert {r.reject_reason for r in bad.collect()} == {"empty record", "not prepared: CreditScoreBins"}


def test_label_maps_share_a_path(spark, folder, tmp_path):
    import pytest

    from rowmill.operators.encode import fit_label_index

    part, path = spark.read.parquet(f"{folder}/part.parquet"), str(tmp_path / "maps")
    for column in ("p_brand", "p_type"):
        state.save_label_index(fit_label_index(part, column), path)
    for column in ("p_brand", "p_type"):
        assert state.load_label_index(spark, path, column).codes == fit_label_index(part, column).codes
    with pytest.raises(Exception):
        state.load_label_index(spark, path, "p_size")


def test_confusion_matrix_counts_every_row(spark):
    from rowmill.operators.evaluate import confusion_matrix

    rows = spark.createDataFrame([(0, 0), (1, 2), (2, 2), (1, None), (0, 1)], "y int, p int")
    cells = {(r.label, r.prediction): r["count"] for r in confusion_matrix(rows, "y", "p").collect()}
    assert sum(cells.values()) == 5 and cells[1, 2] == cells[1, None] == 1 and cells[1, 1] == 0


def test_constant_keeps_its_fraction(spark):
    from rowmill.operators.impute import fill_all_constant

    rows = spark.createDataFrame([(1, None), (None, 2.0)], "a int, b double")
    assert [tuple(r) for r in fill_all_constant(rows, 2.7).collect()] == [(1.0, 2.7), (2.7, 2.0)]


def test_settings_as_text():
    s = Settings(predict_labels={"Gender": ("Firstname", "Lastname")}, rebalance="smote", test_size=0.25)
    again = Settings.from_json(s.to_json())
    assert again.to_json() == s.to_json()
    assert again.bin_exact == {"CreditScore": {850: "Excellent"}} and again.predict_labels == s.predict_labels


def test_rebalanced_parts(spark, folder):
    """The test part holds the same values as without rebalancing."""
    s = Settings(bin_otherwise="Poor")
    plain, _ = preparation.prepare(churn(spark, folder), s)
    more, _ = preparation.prepare(churn(spark, folder), s.with_options(rebalance="smote"))
    features = training.features_of(more, s.key, s.target)
    assert features == training.features_of(plain, s.key, s.target)
    kept = more.filter("copy = 0").drop("copy")
    same = plain.select([F.col(c).cast(kept.schema[c].dataType).alias(c) for c in kept.columns])
    assert kept.exceptAll(same).count() == 0 and kept.count() == plain.count()
    new = more.filter("copy > 0")
    assert {r.split for r in new.select("split").distinct().collect()} == {"train"}
    train = more.filter("split = 'train'").groupBy(s.target).count().collect()
    assert len(train) == 2 and len({r["count"] for r in train}) == 1
    bases = more.filter("copy = 0 and split = 'train'").select(s.key, s.target)
    assert new.join(bases, [s.key, s.target], "left_anti").count() == 0


def test_rebalanced_summary_and_unfinished_output(spark, folder, tmp_path):
    path, source = str(tmp_path / "p"), churn(spark, folder)
    s = Settings(bin_otherwise="Poor", rebalance="smote")
    summary, fitted = preparation.run(source, path, s, force_rebuild=False)
    first = summary.first()
    plain, _ = preparation.run(source, str(tmp_path / "q"), s.with_options(rebalance="none"))
    assert first.outliers_removed == plain.first().outliers_removed
    assert first.num_features == plain.first().num_features and first.test_rows == plain.first().test_rows
    files = spark.read.parquet(f"{path}/parquet").inputFiles()
    again, loaded = preparation.run(source, path, s, force_rebuild=False)
    assert again.first() == first and loaded == fitted
    assert spark.read.parquet(f"{path}/parquet").inputFiles() == files
    # a run that stopped before its end is not taken for a finished one
    writers.save(spark.createDataFrame([("", "")], "settings string, format string"), f"{path}/settings")
    preparation.run(source, path, s, force_rebuild=False)
    assert spark.read.parquet(f"{path}/parquet").inputFiles() != files


def test_stored_scorer_holds_its_lookups(spark, folder, tmp_path, monkeypatch):
    """Also a predictor too large to be held as rows."""
    from rowmill.operators import impute
    from rowmill.operators.lookup import bounded
    from rowmill.plans.scoring import load_scorer

    monkeypatch.setattr(impute, "bounded", lambda t: bounded(t, max_rows=3))
    s = Settings(predict_labels={"Gender": ("Firstname",)}, bin_otherwise="Poor")
    root, source = str(tmp_path), churn(spark, folder)
    _, model = training.run(
        spark, f"{root}/parts", source=source, settings=s, scorer_path=f"{root}/scorer",
        model="decision_tree", max_depth=4,
    )
    loaded = load_scorer(spark, f"{root}/scorer")
    assert loaded.state["predict"]["Gender"]["path"] == f"{root}/scorer/predict-0"
    before = score_records(source, model, state.load_state(spark, f"{root}/parts/state"), s, loaded.features)
    after = loaded.score(source)
    assert after.count() == source.count() and after.exceptAll(before).count() == 0


def test_metrics_of_more_classes(spark):
    cells = {(1, 1): 3, (2, 1): 2, (1, 2): 1, (0, 0): 4, (None, 1): 1}
    rows = [(a, p) for (a, p), n in cells.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "y int, p int")
    assert evaluate.classification_metrics(df, "y", "p").first().asDict() == pytest.approx(evaluate.metrics_of(cells))
