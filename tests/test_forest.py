"""Trees grown from sums per cell against plain trees over rows, and the forests made of them."""

import re

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from millrace.models import candidates, cells, forest, store
from millrace.operators import vectorize


def frame(spark, x, y):
    rows = [(i, [float(v) for v in r], None if y[i] is None else float(y[i])) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "row_id bigint, x array<double>, label double")
    return df.withColumn("features", array_to_vector("x")).withColumn("weight", F.lit(1.0)).drop("x").repartition(3).cache()


def plain(x, y, depth):
    """Predictions of a greedy tree over all cuts of the rows."""
    out = np.full(len(x), y.mean())
    best = None
    for j in range(x.shape[1]):
        for cut in np.unique(x[:, j])[:-1]:
            low = x[:, j] <= cut
            gain = y[low].sum() ** 2 / low.sum() + y[~low].sum() ** 2 / (~low).sum() - y.sum() ** 2 / len(y)
            if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                best = (gain, low)
    if depth and best:
        for side in (best[1], ~best[1]):
            out[side] = plain(x[side], y[side], depth - 1)
    return out


@pytest.mark.parametrize("depth", [0, 1, 4, 9])
def test_tree_equals_plain_greedy_tree(depth):
    rng = np.random.default_rng(depth)
    x, y = rng.integers(0, 6, (300, 3)), rng.normal(0, 1, 300)
    grid = cells.Grid([np.arange(5) + 0.5] * 3)
    names, at = np.unique(grid.of(x.astype(float)), return_inverse=True)
    tree = forest.grow(grid.bins(names), np.bincount(at).astype(float), np.bincount(at, y), grid.sizes, depth)
    assert tree.score(grid.bins(names))[at] == pytest.approx(plain(x, y, depth))


def test_thresholds_are_those_of_sparks_trees(spark):
    rng = np.random.default_rng(1)
    x = np.column_stack([rng.normal(0, 1, 400), rng.integers(0, 5, 400), np.zeros(400)])
    df = frame(spark, x, rng.normal(0, 1, 400))
    grid = cells.fit_grid(cells.checked_rows(df, False), 400)
    said = re.findall(r"feature (\d+) <= (\S+)\)", DecisionTreeRegressor(maxDepth=12).fit(df).toDebugString)
    assert len(said) > 30 and all(np.isclose(grid.edges[int(j)], float(v), atol=1e-12).any() for j, v in said)
    assert [len(e) for e in grid.edges] == [31, 4, 0]


@pytest.mark.parametrize("name", ["08_RandomForestRegressor", "14_BaggingRegressor", "14_BaggingClassifier"])
def test_forest_is_near_sparks(spark, monkeypatch, name):
    rng = np.random.default_rng(2)
    x = np.column_stack([rng.integers(0, 9, 3000), rng.normal(0, 1, 3000)])
    y = x[:, 0] + 2 * x[:, 1] + rng.normal(0, 1, 3000)
    df = frame(spark, x, (y > 4).astype(float) if "Class" in name else y)
    fit = candidates.build(name, {"n_estimators": 30, "max_depth": 5})
    shown = "score" if "Class" in name else "prediction"

    def values():
        apply = fit(df)
        return apply, np.array([r[shown] for r in apply(df).orderBy("row_id").collect()])

    own, got = values()
    assert type(own.__self__) is forest.ForestModel and len(own.__self__.trees) == 30
    assert len({t.value[0] for t in own.__self__.trees}) == 30  # each has draws of its own
    monkeypatch.setattr(forest, "CELLS", 10)
    sparks, want = values()
    assert hasattr(sparks, "model")  # more cells than allowed: Spark's forest
    assert np.abs(got - want).mean() < 0.05 * want.std()


def test_bootstrap_weights_are_one_draw_a_row(spark):
    """Rows of one cell are drawn apart, so a cell's weight spreads as their number does."""
    y = np.tile([0.0, 1.0, 2.0, 3.0], 500)
    model = forest.fit_bagged(frame(spark, np.zeros((2000, 1)), y), 400, 3, False)
    means = np.array([t.value[0] for t in model.trees])
    assert means.std() == pytest.approx(y.std() / np.sqrt(2000), rel=0.15) and abs(means.mean()) < 0.01


def test_odd_forests(spark):
    one = forest.fit_bagged(frame(spark, [[1.0, 2.0]], [5.0]), 20, 3, False)
    assert one.transform(frame(spark, [[9.0, 9.0]], [0.0])).first()["prediction"] == 5.0
    with pytest.raises(ValueError, match="no training rows"):
        forest.fit_bagged(frame(spark, [[1.0]], [1.0]).limit(0), 3, 3, False)
    with pytest.raises(PySparkException, match="labels must not be null"):
        forest.fit_bagged(frame(spark, [[1.0], [2.0]], [1.0, None]), 3, 3, False)
    assert forest.fit_bagged(frame(spark, [[1.0], [2.0], [3.0]], [0, 1, 2]), 3, 3, True) is None
    wide = np.random.default_rng(0).normal(0, 1, (300, 40))
    assert forest.fit_bagged(frame(spark, wide, wide[:, 0]), 3, 3, False) is None  # more cells than a number can name


def test_leaves_that_call_the_same_class_are_joined():
    tree = forest.BinTree.of([0, 0, 0, 0, 0], [1, 0, 0, 0, 0], [1, 3, -1, -1, -1], [0.4, 0.2, 0.9, 0.1, 0.3])
    assert forest.joined(tree).left.tolist() == [1, -1, -1, -1, -1]


def test_saved_forest_scores_alike(spark, tmp_path):
    df = spark.createDataFrame([(i, float(i % 7), float(i % 7 > 3)) for i in range(60)], "row_id bigint, n double, label double")
    plan = vectorize.fit_vectorizer(df, ["n"], [])
    ready = plan.transform(df)
    apply = candidates.build("14_BaggingClassifier", {"n_estimators": 3})(ready)
    store.save_fitted(apply, plan, str(tmp_path / "m"), df.drop("label"))
    saved = store.load_fitted(spark, str(tmp_path / "m"))(df.drop("label"))
    assert {r.row_id: r.score for r in saved.collect()} == {r.row_id: r.score for r in apply(ready).collect()}
