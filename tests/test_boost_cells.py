"""Boosting over cells against Spark's boosted trees and against rounds over rows."""

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from millrace.models import boost, candidates, forest


def frame(spark, x, y):
    rows = [(i, [float(v) for v in r], None if y[i] is None else float(y[i])) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "row_id bigint, x array<double>, label double")
    return df.withColumn("features", array_to_vector("x")).withColumn("weight", F.lit(1.0)).drop("x").repartition(3).cache()


def both(monkeypatch, df, name, params, shown):
    """What the fit over cells and Spark's own say."""
    fit, said = candidates.build(name, params), []
    for limit in (forest.CELLS, 0):
        monkeypatch.setattr(forest, "CELLS", limit)
        apply = fit(df)
        said.append((apply, np.array([r[shown] for r in apply(df).orderBy("row_id").collect()])))
    return said


def test_gradient_boosting_equals_sparks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.integers(0, 9, 2000), rng.normal(0, 1, 2000), rng.normal(0, 1, 2000)])
    df = frame(spark, x, 100 + x[:, 0] * x[:, 1] + rng.normal(0, 1, 2000))
    (own, got), (sparks, want) = both(monkeypatch, df, "10_GradientBoostingRegressor", {"n_estimators": 12, "min_samples_leaf": 30}, "prediction")
    assert type(own.__self__) is boost.CellBooster and hasattr(sparks, "model")
    assert got == pytest.approx(want, rel=1e-9)


def test_adaptive_boosting_is_near_the_rounds_over_rows(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 12, (2500, 3)).astype(float)  # few values: both have all thresholds in each round
    df = frame(spark, x, (x[:, 0] + x[:, 1] + rng.normal(0, 4, 2500) > 11).astype(float))
    (own, got), (rows, want) = both(monkeypatch, df, "09_AdaBoostClassifier", {"n_estimators": 15}, "score")
    assert type(own.__self__) is boost.CellBooster and type(rows.__self__) is boost.BoostedClassifier
    assert own.__self__.weights == pytest.approx(rows.__self__.alphas, rel=1e-9) and got == pytest.approx(want, rel=1e-9)


def test_odd_boosted_tables(spark):
    flat = boost.fit_adaboost(frame(spark, np.ones((9, 2)), [0.0] * 5 + [1.0] * 4), 5)
    assert flat.transform(frame(spark, np.ones((1, 2)), [0.0])).first()["prediction"] == 0.0
    sure = boost.fit_adaboost(frame(spark, [[0.0], [1.0]], [0.0, 1.0]), 5)
    assert len(sure.trees) == 1 and sure.weights == [1.0]
    with pytest.raises(PySparkException, match="labels must not be null"):
        boost.fit_adaboost(frame(spark, [[0.0], [1.0]], [0.0, None]), 5)
