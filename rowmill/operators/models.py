"""Classifiers by name, with parameter names as analysts write them."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark import SparkContext
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    DecisionTreeClassifier,
    GBTClassificationModel,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassificationModel,
    RandomForestClassifier,
)

log = logging.getLogger(__name__)

MAX_DEPTH = 30  # the deepest tree Spark ML builds

ESTIMATORS = {
    "logistic_regression": LogisticRegression,
    "decision_tree": DecisionTreeClassifier,
    "random_forest": RandomForestClassifier,
    "boosted_trees": GBTClassifier,
    "gradient_boosting": GBTClassifier,
    "svm": LinearSVC,
}

# Default parameters of each model.
DEFAULTS: dict[str, dict] = {
    "logistic_regression": {"max_iter": 1000},
    "decision_tree": {"max_depth": None},
    "random_forest": {
        "n_estimators": 100,
        "max_depth": 10,
        "min_samples_leaf": 1,
        "random_state": 42,
    },
    "boosted_trees": {"n_estimators": 100, "max_depth": 10, "random_state": 42},
    "gradient_boosting": {"n_estimators": 100, "max_depth": 5, "random_state": 42},
    "svm": {},
}

# The parameter grids searched by default.
GRIDS: dict[str, dict[str, list]] = {
    "logistic_regression": {"max_iter": [1000, 5000, 10000]},
    "decision_tree": {
        "max_depth": [8, 12, 16, 20],
        "criterion": ["gini", "entropy", "log_loss"],
    },
    "random_forest": {
        "n_estimators": [100],
        "max_depth": [8, 12],
        "criterion": ["gini", "entropy", "log_loss"],
    },
    "random_forest_deep": {
        "n_estimators": [100, 200],
        "max_depth": [10, 15, None],
        "min_samples_leaf": [1, 2],
        "random_state": [42],
    },
    "boosted_trees": {
        "n_estimators": [100, 200],
        "max_depth": [5, 10],
        "learning_rate": [0.01, 0.1, 0.2],
        "subsample": [0.8, 1.0],
        "colsample_bytree": [0.8, 1.0],
        "random_state": [42],
    },
}


# Models whose first n rounds are the model of n rounds, and the parameter that counts them.
ROUNDS = {"boosted_trees": "maxIter", "gradient_boosting": "maxIter"}
# The first tree has weight 1 whatever the learning rate, so the second one follows the same errors.
SAME_ROUNDS = 2


def truncated(model: GBTClassificationModel, rounds: int, step: float | None = None) -> GBTClassificationModel:
    """The model of the first ``rounds`` trees, or, with a ``step``, that of another
    learning rate, which has the same trees for ``SAME_ROUNDS`` rounds.

    Boosting adds a tree at a time with a seed of its own number, so this is what
    a fit of that many rounds with the same seed gives.
    """
    if not 0 < rounds <= model.getNumTrees:
        raise ValueError(f"{rounds} rounds of a model of {model.getNumTrees}")
    if step is not None and rounds > SAME_ROUNDS:
        raise ValueError(f"{rounds} rounds under another learning rate")
    gateway = SparkContext._active_spark_context._gateway
    java = gateway.jvm.org.apache.spark.ml
    given, weights = model._java_obj.trees(), model.treeWeights
    trees = gateway.new_array(java.regression.DecisionTreeRegressionModel, rounds)
    kept = gateway.new_array(gateway.jvm.double, rounds)
    for i in range(rounds):
        trees[i], kept[i] = given[i], float(weights[i] if i == 0 or step is None else step)
    made = java.classification.GBTClassificationModel(
        f"{model.uid}_{rounds}", trees, kept, model.numFeatures, model.numClasses
    )
    short = GBTClassificationModel(made)
    short.setFeaturesCol(model.getFeaturesCol()).setPredictionCol(model.getPredictionCol())
    return short.setRawPredictionCol(model.getRawPredictionCol()).setProbabilityCol(model.getProbabilityCol())


# Models whose fit of a smaller depth is the upper part of a deeper one.
DEPTHS = {"decision_tree": "maxDepth", "random_forest": "maxDepth"}
# Models that stop by themselves: a fit that did not use up its iterations is that of any larger limit.
LIMITS = {"logistic_regression": "maxIter"}


def _upper_part(node, depth: int, java):
    """The tree down to ``depth``: what reaches below becomes a leaf, and sibling
    leaves of one class their parent, as at the end of a fit."""
    below = node.subtreeDepth()
    if below <= depth:
        return node, node.prediction() if below == 0 else None
    said, impurity, stats = node.prediction(), node.impurity(), node.impurityStats()
    if depth > 0:
        left, a = _upper_part(node.leftChild(), depth - 1, java)
        right, b = _upper_part(node.rightChild(), depth - 1, java)
        if a is None or a != b:
            return java.InternalNode(said, impurity, node.gain(), left, right, node.split(), stats), None
    return java.LeafNode(said, impurity, stats), said


def cut_depth(model: Model, depth: int) -> Model:
    """The decision tree or forest that a fit of a smaller ``depth`` gives.

    Levels are grown one after the other from the same rows, so a tree down to a
    level does not depend on the levels below.  Forests draw the features of each
    node in the order of growth: that holds while the trees' levels are grown
    whole, see ``levels_are_whole``.
    """
    gateway = SparkContext._active_spark_context._gateway
    java = gateway.jvm.org.apache.spark.ml
    tree = java.classification.DecisionTreeClassificationModel

    def cut(given):
        root = _upper_part(given.rootNode(), depth, java.tree)[0]
        return tree(f"{given.uid()}_{depth}", root, given.numFeatures(), given.numClasses())

    if isinstance(model, DecisionTreeClassificationModel):
        short = DecisionTreeClassificationModel(cut(model._java_obj))
    else:
        trees = list(model._java_obj.trees())
        made = gateway.new_array(tree, len(trees))
        for i, given in enumerate(trees):
            made[i] = cut(given)
        short = RandomForestClassificationModel(java.classification.RandomForestClassificationModel(
            f"{model.uid}_{depth}", made, model.numFeatures, model.numClasses
        ))
    model._copyValues(short)
    return short._set(maxDepth=depth)


def levels_are_whole(estimator: Estimator, features: int, depth: int, classes: int = 2) -> bool:
    """Whether every level above ``depth`` is grown in one pass: Spark takes as
    many nodes at once as their statistics, of all features at most, fit its
    ``maxMemoryInMB``.  A single tree uses all features, and passes do not matter."""
    if not hasattr(estimator, "getNumTrees"):
        return True
    nodes = estimator.getNumTrees() * 2 ** max(0, depth - 1)
    return nodes * features * estimator.getMaxBins() * (classes + 1) * 8 <= estimator.getMaxMemoryInMB() * 2**20


def without_summary(model: Model) -> Model:
    """The model without what it remembers of its training.

    The summary refers to the session, and a model that scores goes to the
    executors with it: once the session has observed a table, that fails.
    """
    for stage in getattr(model, "stages", [model]):
        if getattr(stage, "hasSummary", False):
            jvm = SparkContext._active_spark_context._gateway.jvm
            stage._java_obj.setSummary(getattr(getattr(jvm.scala, "None$"), "MODULE$"))
    return model


def available_models() -> list[str]:
    return sorted(ESTIMATORS)


def spark_params(model: str, params: Mapping[str, object]) -> dict[str, object]:
    """Parameter names and values of the Spark estimator."""
    if model not in ESTIMATORS:
        raise ValueError(f"unknown model '{model}', known: {available_models()}")
    trees = "numTrees" if model == "random_forest" else "maxIter"
    names = {
        "n_estimators": trees,
        "max_iter": "maxIter",
        "max_depth": "maxDepth",
        "criterion": "impurity",
        "learning_rate": "stepSize",
        "subsample": "subsamplingRate",
        "colsample_bytree": "featureSubsetStrategy",
        "min_samples_leaf": "minInstancesPerNode",
        "random_state": "seed",
    }
    known = {p.name for p in ESTIMATORS[model]().params}
    result = {}
    for name, value in params.items():
        target = names.get(name, name)
        if target == "maxDepth" and value is None:
            log.warning("%s: unlimited depth becomes %s, the deepest that Spark builds", model, MAX_DEPTH)
            value = MAX_DEPTH
        if target == "impurity" and value == "log_loss":
            value = "entropy"
        if target == "featureSubsetStrategy":
            value = "all" if value in (1, 1.0, "all") else str(value)
        if target in known:
            result[target] = value
        else:
            log.warning("%s: no counterpart of parameter %s", model, name)
    return result


def build_model(model: str, rows: int | None = None, C: float = 1.0, **params) -> Estimator:
    """An estimator with its default parameters and those given.

    The penalty of the logistic regression, 1 / (2 C) of the squared weights on
    the summed loss, is 1 / (C * rows) on Spark's mean loss.  Trees and forests keep
    the node of every row from level to level: without it each pass sends the whole
    trees to every task and takes every row down from their roots again.
    """
    if model not in ESTIMATORS:
        raise ValueError(f"unknown model '{model}', known: {available_models()}")
    estimator = ESTIMATORS[model](**spark_params(model, {**DEFAULTS[model], **params}))
    if model in DEPTHS:
        estimator.setCacheNodeIds(params.get("cacheNodeIds", True))
    if model == "logistic_regression":
        estimator.setStandardization(False)
        estimator.setRegParam(1.0 / (C * rows) if rows else 0.0)
    return estimator
