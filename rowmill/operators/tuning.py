"""Fitting, cross-validation and grid search."""

from __future__ import annotations

import itertools
import json
import math
import statistics
import sys
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowmill.functions.columns import col
from rowmill.operators.evaluate import metrics_of
from rowmill.operators.models import (
    DEFAULTS, DEPTHS, GRIDS, LIMITS, ROUNDS, SAME_ROUNDS, build_model, cut_depth, levels_are_whole, spark_params,
    truncated, without_summary,
)
from rowmill.sources.workdir import new_path, use_checkpoints

SCORES = ("accuracy", "precision", "recall", "f1")
ROWS_PER_TASK = 20_000
MOST_ROWS_PER_TASK = 500_000
# below this, a fit takes no longer than taking trees apart
SHARED_DEPTH_ROWS = 200_000
# nodes that trees growing on the driver at a time can have at most, some 400 bytes each; few trees come near
MOST_NODES = 2_000_000


def fit(df: DataFrame, estimator: Estimator) -> tuple[PipelineModel, float]:
    """The fitted model and its accuracy on the rows it was fitted to."""
    use_checkpoints(df.sparkSession)
    # a trainer reads its rows several times before its own cache is filled
    held = df.storageLevel.useMemory or df.storageLevel.useDisk
    data = df if held else df.persist()
    try:
        sized = rows_of_fit(data, data.count())
        model = without_summary(Pipeline(stages=[estimator]).fit(sized))
        cells = _confusion(model.transform(sized), estimator.getLabelCol())
    finally:
        if not held:
            data.unpersist()
    return model, metrics_of(cells)["accuracy"]


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def _confusion(predictions: DataFrame, label: str) -> dict[tuple[int, int], int]:
    rows = predictions.groupBy(col(label), F.col("prediction")).count().collect()
    return {(int(r[0]), int(r[1])): r[2] for r in rows}


def grid_of(model: str, grid: Mapping[str, Sequence] | None = None) -> list[dict]:
    """All combinations of a parameter grid, by default the model's own."""
    grid = GRIDS[model] if grid is None else grid
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


@dataclass
class SearchResult:
    """Per combination and fold all scores, and the best model."""

    model: str
    combinations: list[dict]
    scores: list[list[dict[str, float]]]  # [combination][fold]
    fit_times: list[list[float]]
    scoring: str
    # where the models of the best combination are stored, by fold
    fold_models: dict[int, str] = field(default_factory=dict)
    manifest: list[tuple[int, int, str]] = field(default_factory=list)  # combination, fold, path
    score_times: list[list[float]] = field(default_factory=list)
    best_model: PipelineModel | None = None
    # [combination][fold]: held-out rows by (label, prediction)
    cells: list[list[dict[tuple[int, int], int]]] = field(default_factory=list)

    def cell_table(self, spark) -> DataFrame:
        """What every fold's held-out rows were taken for."""
        rows = [
            (self.model, i, f, label, prediction, n)
            for i, folds in enumerate(self.cells)
            for f, cells in enumerate(folds)
            for (label, prediction), n in cells.items()
        ]
        return spark.createDataFrame(
            rows, "model string, combination int, fold int, label int, prediction int, count bigint"
        )

    def means(self, score: str | None = None) -> list[float]:
        return [statistics.fmean(f[score or self.scoring] for f in folds) for folds in self.scores]

    @property
    def best_index(self) -> int:
        means = self.means()
        return means.index(max(means))

    @property
    def best_params(self) -> dict:
        return self.combinations[self.best_index]

    @property
    def best_score(self) -> float:
        return self.means()[self.best_index]

    def table(self, spark) -> DataFrame:
        """One row per combination: fit and score times, the parameters together
        and each by itself as text, split scores, mean, deviation, rank."""
        k = len(self.scores[0])
        names = sorted({name for c in self.combinations for name in c})
        rows = []
        for i, (params, folds, times, scoring_times) in enumerate(
            zip(self.combinations, self.scores, self.fit_times, self.score_times)
        ):
            values = [f[self.scoring] for f in folds]
            rows.append(
                (
                    self.model,
                    i,
                    json.dumps(params, sort_keys=True),
                    *[json.dumps(params[n]) if n in params else None for n in names],
                    statistics.fmean(times),
                    statistics.pstdev(times),
                    statistics.fmean(scoring_times),
                    statistics.pstdev(scoring_times),
                    *values,
                    statistics.fmean(values),
                    statistics.pstdev(values),
                )
            )
        splits = ", ".join(f"split{i}_test_score double" for i in range(k))
        each = "".join(f"`param_{n}` string, " for n in names)
        schema = (
            f"model string, combination int, params string, {each}mean_fit_time double, std_fit_time double, "
            f"mean_score_time double, std_score_time double, {splits}, mean_test_score double, std_test_score double"
        )
        return rank_scores(spark.createDataFrame(rows, schema))

    def model_table(self, spark) -> DataFrame:
        """The stored models: (model, combination, fold, path)."""
        rows = [(self.model, *m) for m in self.manifest]
        return spark.createDataFrame(rows, "model string, combination int, fold int, path string")

    def score_table(self, spark) -> DataFrame:
        """Mean of every score (model, combination, score, mean)."""
        rows = [
            (self.model, i, s, m) for s in SCORES for i, m in enumerate(self.means(s))
        ]
        return spark.createDataFrame(
            rows, "model string, combination int, score string, mean double"
        )


def rank_scores(results: DataFrame, score: str = "mean_test_score") -> DataFrame:
    """Adds ``rank_test_score``: best first, equal scores share the lowest rank.

    A result table has one row per parameter combination, so one task holds it.
    """
    return results.withColumn(
        "rank_test_score", F.rank().over(Window.orderBy(F.desc_nulls_last(score)))
    )


def best_by(results: DataFrame, name: str, score: str) -> DataFrame:
    """The value of ``name`` at the highest score; ties take the smallest."""
    best = F.min(F.struct((-col(score)).alias("s"), col(name).alias("v")))
    scored = results.filter(col(score).isNotNull())
    return scored.agg(best.alias("b")).select(
        F.col("b.v").alias(name), (-F.col("b.s")).alias("best_score")
    )


def grid_search(
    df: DataFrame,
    model: str,
    grid: Mapping[str, Sequence] | None = None,
    fold: str = "fold",
    scoring: str = "f1",
    parallelism: int = 4,
    keep_fold_models: bool = False,
    refit: bool = True,
    rows: int | None = None,
    **fixed,
) -> SearchResult:
    """k-fold search over a table of (features, label, fold).

    Every combination is fitted once per fold and all scores come from one
    confusion table, instead of one fit per score.  Combinations that mean the
    same to Spark are fitted once.  Of boosted models that differ in their number
    of rounds only the longest is fitted; the others are its first rounds.  A grid of
    so few rounds that the learning rate does not reach the trees fits them once for
    all rates.  Of trees and forests of a large table that differ in their depth only the deepest
    is fitted; the others are its upper levels.  A regression that stops before
    its limit of iterations answers for all larger limits.

    With ``keep_fold_models`` every fitted model goes to the shared folder at
    once, and a manifest says where; the driver holds no more models than are
    being fitted, which is ``parallelism``.
    """
    if scoring not in SCORES:
        raise ValueError(f"unknown score '{scoring}', known: {SCORES}")
    use_checkpoints(df.sparkSession)
    combinations = grid_of(model, grid)
    store = new_path(df.sparkSession, "fold-models") if keep_fold_models else None
    data = df.select("features", "label", fold).persist()
    with_session = inheritable_thread_target(df.sparkSession)
    pool = None
    try:
        sizes = {r[0]: r[1] for r in data.groupBy(col(fold)).count().collect()}
        total, folds = sum(sizes.values()), sorted(sizes)
        keys = [json.dumps(spark_params(model, c), sort_keys=True) for c in combinations]
        families = _families(model, dict(zip(keys, combinations)))
        stepless = _stepless(model, combinations) or None
        results: dict[tuple[str, int], tuple] = {}
        fitted = [{**fixed, **list(members.values())[-1][0]} for members in families.values()]
        at_once = min(parallelism, len(families) * len(folds), fits_at_once(model, fitted, total, df.sparkSession))
        pool = ThreadPool(at_once)
        sized = few_partitions(data, total, at_once)

        width = sized.first()["features"].size if model in DEPTHS else 0

        def models_of(members, train, rows):
            """Key, model and seconds of its fit for each member of a family, the
            largest one last."""
            *others, last = members
            largest = build_model(model, rows, **{**fixed, **members[last][0]})
            shared = [
                key for key in others
                if model in ROUNDS or model in DEPTHS and total >= SHARED_DEPTH_ROWS
                and levels_are_whole(largest, width, members[key][1])
            ]
            stopped = None
            for key in [k for k in members if k not in shared]:
                estimator = largest if key == last else build_model(model, rows, **{**fixed, **members[key][0]})
                one, spent, enough = stopped or timed(estimator, train)
                if enough:
                    stopped = one, spent, enough
                for short in shared if key == last else ():
                    size = members[short][1]
                    if model in ROUNDS:
                        less = truncated(one, size, stepless and step_of(members[short][0]))
                    else:
                        less = cut_depth(one, size)
                    yield short, less, spent * size / members[last][1]
                yield key, one, spent

        def step_of(params):
            return spark_params(model, {**fixed, **params}).get("stepSize")

        def timed(estimator, train):
            """The model, its seconds, and whether it stopped before its limit."""
            start = time.perf_counter()
            one = estimator.fit(train)
            spent = time.perf_counter() - start
            enough = model in LIMITS and one.summary.totalIterations < estimator.getMaxIter()
            return without_summary(one), spent, enough

        def run(task):
            first, f = task
            held_out, found = sized.filter(col(fold) == f), []
            for key, one, spent in models_of(families[first], sized.filter(col(fold) != f), total - sizes[f]):
                start = time.perf_counter()
                cells = _confusion(one.transform(held_out), "label")
                scored = time.perf_counter() - start
                path = f"{store}/combination={keys.index(key)}/fold={f}" if store else None
                if path:
                    save_model(PipelineModel([one]), path)
                found.append(((key, f), metrics_of(cells), spent, path, cells, scored))
            return found

        for found in pool.imap_unordered(with_session(run), [(key, f) for key in families for f in folds]):
            for task, *values in found:
                results[task] = tuple(values)
        result = SearchResult(
            model,
            combinations,
            [[results[key, f][0] for f in folds] for key in keys],
            [[results[key, f][1] for f in folds] for key in keys],
            scoring,
            cells=[[results[key, f][3] for f in folds] for key in keys],
            score_times=[[results[key, f][4] for f in folds] for key in keys],
        )
        if keep_fold_models:
            result.manifest = [(i, f, results[key, f][2]) for i, key in enumerate(keys) for f in folds]
            best_key = keys[result.best_index]
            result.fold_models = {f: results[best_key, f][2] for f in folds}
        if refit:
            estimator = build_model(model, rows or total, **{**fixed, **result.best_params})
            result.best_model = without_summary(Pipeline(stages=[estimator]).fit(few_partitions(data, total)))
        return result
    finally:
        if pool:
            pool.close()
        data.unpersist()


def few_partitions(data: DataFrame, rows: int, at_once: int = 1) -> DataFrame:
    """An iterative fit runs many jobs over its rows, and each partition answers
    every one of them: a tree level ships the statistics of all its nodes from
    each partition, and every task that scores reads the whole model.  With
    partitions in proportion to the rows those products, and what the driver
    hears of tasks, would outgrow the input.  So a small table gets a task per
    ROWS_PER_TASK rows, a larger one a task per core, and only one of more than
    MOST_ROWS_PER_TASK a core gets more.  Fits that run ``at_once`` share the cores:
    together they have two tasks for each."""
    cores = data.sparkSession.sparkContext.defaultParallelism
    few = min(math.ceil(rows / ROWS_PER_TASK), cores, math.ceil(2 * cores / at_once))
    return data.coalesce(max(1, few, math.ceil(rows / MOST_ROWS_PER_TASK)))


def fits_at_once(model: str, params: Sequence[Mapping], rows: int, spark: SparkSession) -> int:
    """How many fits of these parameters can run at a time.  The driver holds the trees
    that grow, MOST_NODES nodes of all fits together; a tree without a limit has nodes
    in proportion to the rows.  And between levels a fit keeps the features of every
    row with its draws and its node in every tree, which is to stay in memory."""
    known = [spark_params(model, {**DEFAULTS[model], **p}) for p in params]
    if model not in {**ROUNDS, **DEPTHS}:
        return sys.maxsize
    memory, most = memory_for_rows(spark), []
    for p in known:
        forest = p.get("numTrees", 20) if model == "random_forest" else 1
        nodes = min(2 ** (p.get("maxDepth", 5) + 1), 2 * rows + 1)
        # the finished trees of a boosted model take a quarter of one that grows
        grown = nodes * forest + nodes * p.get("maxIter", 20) // 4 * (model in ROUNDS)
        # the nodes of two levels, and the draws
        most.append(min(MOST_NODES // grown, memory // max(1, rows * (200 + 12 * forest))))
    return max(1, min(most))


def memory_for_rows(spark: SparkSession) -> int:
    """Bytes that all executors have for cached rows and the work on them."""
    context = spark.sparkContext._jsc.sc()
    own = context.env().blockManager().blockManagerId().hostPort()
    found, each = {}, context.getExecutorMemoryStatus().iterator()
    while each.hasNext():
        entry = each.next()
        found[entry._1()] = entry._2()._1()
    # the driver caches nothing where there are executors
    return sum(size for name, size in found.items() if name != own) or sum(found.values())


def rows_of_fit(data: DataFrame, rows: int) -> DataFrame:
    """Those partitions, cut off from the plan that made them.  Every task of a fit
    carries the plan of its rows, though they are cached: it unpacks it, and its
    answer lists all the plan's counters.  Rounds of boosting are thousands of such tasks."""
    return few_partitions(data, rows).checkpoint()


def _stepless(model: str, combinations: Sequence[dict]) -> bool:
    """Whether all are boosted models of rounds that have the same trees at any learning rate."""
    name = ROUNDS.get(model)
    return name is not None and all(
        spark_params(model, {**DEFAULTS[model], **c})[name] <= SAME_ROUNDS for c in combinations
    )


def _families(model: str, distinct: dict[str, dict]) -> dict[str, dict[str, tuple[dict, int | None]]]:
    """The models to fit, in families that differ in nothing but their rounds
    (and learning rates, where these do not reach the trees), depths or limits of iterations; in their order, key -> parameters and size."""
    name = {**ROUNDS, **DEPTHS, **LIMITS}.get(model)
    stepless = _stepless(model, list(distinct.values()))
    groups: dict[str, list[tuple[int | None, str]]] = {}
    for key, params in distinct.items():
        known = spark_params(model, {**DEFAULTS[model], **params})
        size = known.pop(name, None)
        if stepless:
            known.pop("stepSize", None)
        together = name is not None and size is not None
        groups.setdefault(json.dumps(known, sort_keys=True) if together else key, []).append((size, key))
    out = {}
    for members in groups.values():
        members.sort(key=lambda m: m[0] or 0)
        out[members[0][1]] = {key: (distinct[key], size) for size, key in members}
    return out


def cross_validate(df: DataFrame, model: str, fold: str = "fold", **options) -> SearchResult:
    """k-fold scores of one model with its given or default parameters."""
    params = {k: [v] for k, v in options.pop("params", {}).items()}
    return grid_search(df, model, params, fold, refit=False, **options)


def best_fold_model(result: SearchResult) -> tuple[int, Model]:
    """The fold with the highest score, and the model fitted without it, from
    the store."""
    folds = sorted(result.fold_models)
    scores = [s[result.scoring] for s in result.scores[result.best_index]]
    best = folds[scores.index(max(scores))]
    return best, load_model(result.fold_models[best]).stages[-1]


def score_best_fold(result: SearchResult, test: DataFrame) -> DataFrame:
    """Predictions of the best fold's model on rows that no fold held: label,
    prediction and what the model adds."""
    return best_fold_model(result)[1].transform(test)


def compare_models(
    df: DataFrame, models: Mapping[str, Mapping] | Sequence[str], fold: str = "fold", **options
) -> list[SearchResult]:
    """Several models under the same folds."""
    chosen = models if isinstance(models, Mapping) else {m: {} for m in models}
    return [
        cross_validate(df, m, fold, params=dict(p), keep_fold_models=True, **options)
        for m, p in chosen.items()
    ]
