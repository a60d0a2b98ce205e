"""The compared models by name. ``build(name, params)`` gives a fit function.

A fit function maps a training table (row_id, features, label, weight) to a
function that adds ``prediction`` (and ``score`` for classifiers) to a table.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.models import batch, boost, forest, gaussian, histogram, kernel, linear, newton
from millrace.models.neighbours import fit_neighbours
from millrace.operators import stats
from millrace.session import col

Apply = Callable[[DataFrame], DataFrame]
Fit = Callable[[DataFrame], Apply]

ROW_ID = "row_id"
DEEPEST_TREE = 30  # Spark's own limit, and what "no limit" means here


def keep_result_columns(out: DataFrame, names: Sequence[str]) -> DataFrame:
    """The given columns, the prediction and, where the model has one, the score of class 1."""
    kept = [col(c) for c in names]
    for scores in ("probability", "rawPrediction"):
        if scores in out.columns:
            return out.select(*kept, "prediction", vector_to_array(scores)[1].alias("score"))
    return out.select(*kept, "prediction")


def _clean(model) -> Apply:
    """Apply a Spark ML model and keep only the columns the evaluation needs."""

    def transform(rows: DataFrame) -> DataFrame:
        return keep_result_columns(model.transform(rows), rows.columns)

    transform.model = model
    return transform


def _estimator(make: Callable[[], Any]) -> Fit:
    return lambda train: _clean(make().fit(train))


def _depth(value) -> int:
    if value is not None and int(value) > DEEPEST_TREE:
        raise ValueError(f"trees deeper than {DEEPEST_TREE} are not built")
    return DEEPEST_TREE if value is None else int(value)


class Constant:
    """One prediction for every row; classifiers score 0."""

    def __init__(self, prediction: float, score: float | None = None):
        self.prediction, self.score = prediction, score

    def transform(self, rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("prediction", F.lit(self.prediction))
        return rows if self.score is None else rows.withColumn("score", F.lit(self.score))


def _majority(train: DataFrame) -> Apply:
    return Constant(float(stats.modes(train, ["label"])["label"]), 0.0).transform


def _mean(train: DataFrame) -> Apply:
    return Constant(train.agg(F.avg("label")).first()[0]).transform


def _logistic(c: float = 1.0, elastic: float = 0.0) -> Fit:
    def fit(train):
        total = train.agg(F.sum("weight")).first()[0]
        model = LogisticRegression(
            weightCol="weight", regParam=1.0 / (c * total), elasticNetParam=elastic, standardization=False, maxIter=200
        )
        return _clean(model.fit(train))

    return fit


def _stochastic(loss: str = "hinge", alpha: float = 1e-4, penalty: str = "l2") -> Fit:
    """The converged optimum of the stated loss, not one particular descent path."""
    mix = {"l2": 0.0, "l1": 1.0, "elasticnet": 0.15}[penalty]
    if loss == "log_loss":
        return _estimator(
            lambda: LogisticRegression(
                weightCol="weight", regParam=alpha, elasticNetParam=mix, standardization=False, maxIter=200
            )
        )
    if loss in batch.SMOOTH:
        return _own(lambda t: batch.fit_smooth(t, {"loss": loss, "alpha": alpha, "penalty": penalty}))
    if loss == "hinge" and mix == 0.0:
        return _own(lambda t: batch.LinearCall(*newton.fit_hinge(t, alpha), margin=True))

    def unsupported(_):
        raise ValueError(f"no distributed solver for loss {loss!r} with penalty {penalty!r}")

    return unsupported


def _histogram(train: DataFrame, loss: str, p: Mapping[str, Any]):
    return histogram.fit_histogram_boosting(
        train, loss, p.get("max_iter", 100), p.get("learning_rate", 0.1), p.get("max_leaf_nodes", 31), p.get("min_samples_leaf", 20), p.get("l2_regularization", 0.0)
    )


def _own(fit_model) -> Fit:
    return lambda train: fit_model(train).transform


def _bagged(estimator, p: Mapping[str, Any], trees: int, seed: int) -> Fit:
    """Bagged trees of all features; Spark's own where rows lie in too many cells or classes."""
    n, depth, classes = p.get("n_estimators", trees), _depth(p.get("max_depth")), estimator is RandomForestClassifier

    def fit(train):
        model = forest.fit_bagged(train, n, depth, classes, seed)
        return model.transform if model else _clean(estimator(numTrees=n, maxDepth=depth, featureSubsetStrategy="all", seed=seed).fit(train))

    return fit


def _descended(p: Mapping[str, Any], seed: int) -> Fit:
    """Gradient boosting of squared errors; Spark's own where rows lie in too many cells."""
    n, rate, depth, least = p.get("n_estimators", 100), p.get("learning_rate", 0.1), p.get("max_depth", 3), p.get("min_samples_leaf", 1)

    def fit(train):
        model = boost.fit_gradient_boosting(train, n, rate, depth, least, seed)
        return model.transform if model else _clean(GBTRegressor(maxIter=n, stepSize=rate, maxDepth=depth, minInstancesPerNode=least, seed=seed).fit(train))

    return fit


def build(name: str, params: Mapping[str, Any] | None = None, seed: int = 42) -> Fit:
    """Fit function of a named candidate; ``params`` override its defaults."""
    p = {k.removeprefix("modelo__"): v for k, v in (params or {}).items()}
    get = p.get
    makers: dict[str, Callable[[], Fit]] = {
        "01_DummyClassifier": lambda: _majority,
        # The solver choice is accepted and has no effect: both reach the same optimum.
        "02_LogisticRegression": lambda: _logistic(get("C", 1.0)),
        "03_KNeighborsClassifier": lambda: _own(lambda t: fit_neighbours(t, get("n_neighbors", 5), get("p", 2), get("weights", "uniform"), "vote", ROW_ID)),
        "04_DecisionTreeClassifier": lambda: _estimator(
            lambda: DecisionTreeClassifier(
                weightCol="weight", maxDepth=_depth(get("max_depth")), impurity=get("criterion", "gini"),
                minInstancesPerNode=max(get("min_samples_leaf", 1), get("min_samples_split", 2) // 2), seed=seed,
            )
        ),
        "05_RandomForestClassifier": lambda: _estimator(
            lambda: RandomForestClassifier(
                weightCol="weight", numTrees=get("n_estimators", 100), maxDepth=_depth(get("max_depth")),
                minInstancesPerNode=get("min_samples_leaf", 1), featureSubsetStrategy=get("max_features", "sqrt") or "all", seed=seed,
            )
        ),
        "07_GradientBoostingClassifier": lambda: _estimator(
            lambda: GBTClassifier(maxIter=get("n_estimators", 100), stepSize=get("learning_rate", 0.1), maxDepth=get("max_depth", 3), seed=seed)
        ),
        "08_HistGradientBoosting": lambda: _own(lambda t: _histogram(t, "log_loss", p)),
        "09_AdaBoostClassifier": lambda: _own(lambda t: boost.fit_adaboost(t, get("n_estimators", 100), get("learning_rate", 1.0))),
        "10_SVC": lambda: _own(lambda t: kernel.fit_kernel_classifier(t, get("C", 1.0), get("gamma", "scale"), get("size", 256), seed)),
        "11_GaussianNB": lambda: _own(lambda t: gaussian.fit_naive_bayes(t, get("var_smoothing", 1e-9))),
        "12_LinearDiscriminantAnalysis": lambda: _own(lambda t: gaussian.fit_linear_discriminant(t, get("shrinkage"))),
        "13_QuadraticDiscriminantAnalysis": lambda: _own(lambda t: gaussian.fit_quadratic_discriminant(t, get("reg_param", 0.01))),
        "14_BaggingClassifier": lambda: _bagged(RandomForestClassifier, p, 50, seed),
        "15_SGDClassifier": lambda: _stochastic(get("loss", "hinge"), get("alpha", 1e-4), get("penalty", "l2")),
        "01_DummyRegressor": lambda: _mean,
        "02_LinearRegression": lambda: _estimator(linear.ordinary),
        "03_Ridge": lambda: lambda t: _clean(linear.fit_ridge(t, get("alpha", 1.0))),
        "04_Lasso": lambda: lambda t: _clean(linear.fit_lasso(t, get("alpha", 0.1))),
        "05_ElasticNet": lambda: lambda t: _clean(linear.fit_elastic_net(t, get("alpha", 0.1), get("l1_ratio", 0.5))),
        "06_KNeighborsRegressor": lambda: _own(lambda t: fit_neighbours(t, get("n_neighbors", 5), get("p", 2), get("weights", "uniform"), "average", ROW_ID)),
        "07_DecisionTreeRegressor": lambda: _estimator(lambda: DecisionTreeRegressor(maxDepth=_depth(get("max_depth")), seed=seed)),
        "08_RandomForestRegressor": lambda: _bagged(RandomForestRegressor, p, 100, seed),
        "10_GradientBoostingRegressor": lambda: _descended(p, seed),
        "11_HistGradientBoosting": lambda: _own(lambda t: _histogram(t, "squared_error", p)),
        "12_AdaBoostRegressor": lambda: _own(lambda t: boost.fit_adaboost_regressor(t, get("n_estimators", 100))),
        "13_SVR": lambda: _own(lambda t: kernel.fit_kernel_regressor(t, get("C", 1.0), get("gamma", "scale"), get("size", 256), seed)),
        "14_BaggingRegressor": lambda: _bagged(RandomForestRegressor, p, 50, seed),
        # The squared-error optimum under the penalty alpha / 2 |w|^2 per row.
        "15_SGDRegressor": lambda: lambda t: _clean(linear.fit_elastic_net(t, get("alpha", 1e-4), 0.0)),
    }
    if name not in makers:
        raise ValueError(f"unknown model {name!r}")
    return makers[name]()


# Candidate names in comparison order.
CLASSIFIERS = (
    "01_DummyClassifier", "02_LogisticRegression", "03_KNeighborsClassifier", "04_DecisionTreeClassifier",
    "05_RandomForestClassifier", "07_GradientBoostingClassifier", "08_HistGradientBoosting", "09_AdaBoostClassifier",
    "10_SVC", "11_GaussianNB", "12_LinearDiscriminantAnalysis", "13_QuadraticDiscriminantAnalysis",
    "14_BaggingClassifier", "15_SGDClassifier",
)
REGRESSORS = (
    "01_DummyRegressor", "02_LinearRegression", "03_Ridge", "04_Lasso", "05_ElasticNet", "06_KNeighborsRegressor",
    "07_DecisionTreeRegressor", "08_RandomForestRegressor", "10_GradientBoostingRegressor", "11_HistGradientBoosting",
    "12_AdaBoostRegressor", "13_SVR", "14_BaggingRegressor", "15_SGDRegressor",
)

# Search spaces per finalist, random draw and grid. Left out of the random draw, as no distributed solver
# has it with an L1 part: the loss hinge.
CLASSIFIER_SPACES: dict[str, dict[str, dict[str, list]]] = {
    "02_LogisticRegression": {
        "random": {"C": [0.01, 0.05, 0.1, 0.5, 1.0, 2.0, 5.0, 10.0], "penalty": ["l2"], "solver": ["liblinear", "lbfgs"]},
        "grid": {"C": [0.1, 0.5, 1.0, 2.0], "penalty": ["l2"], "solver": ["liblinear"]},
    },
    "04_DecisionTreeClassifier": {
        "random": {
            "max_depth": [3, 4, 5, 6, 8, 10, None], "min_samples_split": [2, 5, 10, 20],
            "min_samples_leaf": [1, 2, 5, 10, 20], "criterion": ["gini", "entropy"],
        },
        "grid": {"max_depth": [3, 5, 8, None], "min_samples_leaf": [5, 10, 20], "criterion": ["gini", "entropy"]},
    },
    "05_RandomForestClassifier": {
        "random": {
            "n_estimators": [80, 120, 160], "max_depth": [4, 6, 8, None],
            "min_samples_leaf": [1, 3, 5, 10], "max_features": ["sqrt", "log2", None],
        },
        "grid": {"n_estimators": [100, 160], "max_depth": [6, None], "min_samples_leaf": [3, 5], "max_features": ["sqrt"]},
    },
    "08_HistGradientBoosting": {
        "random": {
            "learning_rate": [0.03, 0.05, 0.08, 0.1, 0.15], "max_iter": [80, 120, 160, 220], "max_leaf_nodes": [15, 31, 63],
            "min_samples_leaf": [10, 20, 40, 60], "l2_regularization": [0.0, 0.01, 0.1, 1.0],
        },
        "grid": {
            "learning_rate": [0.05, 0.08, 0.1], "max_iter": [120, 160],
            "max_leaf_nodes": [15, 31], "min_samples_leaf": [20, 40],
        },
    },
    "10_SVC": {
        "random": {"C": [0.1, 0.5, 1.0, 2.0, 5.0], "gamma": ["scale", "auto", 0.01, 0.1], "kernel": ["rbf"]},
        "grid": {"C": [0.5, 1.0, 2.0], "gamma": ["scale", 0.01, 0.1], "kernel": ["rbf"]},
    },
    "11_GaussianNB": {
        "random": {"var_smoothing": [1e-12, 1e-11, 1e-10, 1e-9, 1e-8, 1e-7, 1e-6]},
        "grid": {"var_smoothing": [1e-11, 1e-10, 1e-9, 1e-8, 1e-7]},
    },
    "12_LinearDiscriminantAnalysis": {
        "random": {"solver": ["lsqr", "eigen"], "shrinkage": ["auto", 0.0, 0.1, 0.5, 0.9]},
        "grid": {"solver": ["lsqr"], "shrinkage": ["auto", 0.1, 0.5]},
    },
    "15_SGDClassifier": {
        "random": {
            "loss": ["log_loss", "modified_huber"], "alpha": [1e-5, 1e-4, 1e-3, 1e-2],
            "penalty": ["l2", "l1", "elasticnet"],
        },
        "grid": {"loss": ["log_loss", "modified_huber"], "alpha": [1e-4, 1e-3, 1e-2], "penalty": ["l2", "elasticnet"]},
    },
}
REGRESSOR_SPACES: dict[str, dict[str, dict[str, list]]] = {
    "03_Ridge": {"random": {"alpha": [0.01, 0.1, 0.5, 1.0, 2.0, 5.0, 10.0]}, "grid": {"alpha": [0.1, 0.5, 1.0, 2.0, 5.0]}},
    "04_Lasso": {"random": {"alpha": [0.001, 0.01, 0.05, 0.1, 0.2, 0.5, 1.0]}, "grid": {"alpha": [0.01, 0.05, 0.1, 0.2]}},
    "05_ElasticNet": {
        "random": {"alpha": [0.001, 0.01, 0.05, 0.1, 0.2, 0.5], "l1_ratio": [0.1, 0.3, 0.5, 0.7, 0.9]},
        "grid": {"alpha": [0.01, 0.05, 0.1, 0.2], "l1_ratio": [0.3, 0.5, 0.7]},
    },
    "06_KNeighborsRegressor": {
        "random": {"n_neighbors": [3, 5, 7, 9, 11, 15, 21], "weights": ["uniform", "distance"], "p": [1, 2]},
        "grid": {"n_neighbors": [3, 5, 7, 9, 11], "weights": ["uniform", "distance"], "p": [1, 2]},
    },
    "10_GradientBoostingRegressor": {
        "random": {
            "n_estimators": [80, 120, 160, 220], "learning_rate": [0.03, 0.05, 0.08, 0.1],
            "max_depth": [2, 3, 4], "min_samples_leaf": [1, 3, 5, 10],
        },
        "grid": {"n_estimators": [100, 160], "learning_rate": [0.05, 0.08], "max_depth": [2, 3], "min_samples_leaf": [3, 5]},
    },
}
