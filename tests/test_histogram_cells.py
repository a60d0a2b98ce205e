"""Histogram boosting reads sums per cell of equal bins, by either way of summing partitions."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from millrace.models import histogram


@pytest.fixture(scope="module")
def drawn():
    rng = np.random.default_rng(9)
    x = np.column_stack([rng.integers(0, 7, 900), rng.integers(0, 9, 900), rng.integers(0, 2, 900)]).astype(float)
    return x, x[:, 0] * x[:, 1] - 9 * x[:, 2] + rng.normal(0, 1, 900), rng.choice([0.0, 0.5, 2.0], 900)


def frame(spark, x, y, w):
    rows = [([float(v) for v in r], float(a), float(b)) for r, a, b in zip(x, y, w, strict=True)]
    return spark.createDataFrame(rows, "x array<double>, label double, weight double").withColumn("features", array_to_vector("x")).repartition(4).cache()


def shape(model):
    return [(t.feature, t.bin, t.left, t.right) for t in model.trees]


@pytest.mark.parametrize("loss", ["squared_error", "log_loss"])
def test_rows_of_equal_bins_are_one_cell(spark, drawn, monkeypatch, loss):
    x, y, w = drawn
    df = frame(spark, x, y > y.mean() if loss == "log_loss" else y, w)
    kept, stage = {}, histogram.stage
    monkeypatch.setattr(histogram, "stage", lambda rows, name: kept.setdefault(name, stage(rows, name)))
    whole = histogram.fit_histogram_boosting(df, loss, 4, max_leaf_nodes=9, min_samples_leaf=7)
    assert kept["hist-cells"].count() == len(np.unique(x, axis=0)) and kept["hist-cells"].agg({"n": "sum"}).first()[0] == 900
    monkeypatch.setattr(histogram, "stage", stage)
    monkeypatch.setattr(histogram, "FEW_PARTS", 0)  # a group per leaf sums the partitions
    monkeypatch.setattr(histogram, "PART_ROWS", 40)
    monkeypatch.setattr(histogram, "JOINT", 1)
    apart = histogram.fit_histogram_boosting(df, loss, 4, max_leaf_nodes=9, min_samples_leaf=7)
    assert shape(apart) == shape(whole) and len(whole.trees) == 4
    assert [t.value for t in apart.trees] == [pytest.approx(t.value) for t in whole.trees]


def test_joint_histograms_fall_apart_into_their_features():
    rng = np.random.default_rng(1)
    sizes = [2, 200, 3, 5]
    assert histogram._bundles(sizes) == [[0, 2, 3], [1]]
    bins, w = np.stack([rng.integers(0, k, 400) for k in sizes], 1), rng.normal(0, 1, (3, 400))
    joint = (bins[:, 0] * 3 + bins[:, 2]) * 5 + bins[:, 3]
    sums = np.stack([np.concatenate([np.bincount(joint, v, 30), np.bincount(bins[:, 1], v, 200)]) for v in w])
    found = histogram._apart(sums, sizes, histogram._bundles(sizes))
    for j, size in enumerate(sizes):
        assert found[:, j, :size] == pytest.approx(np.stack([np.bincount(bins[:, j], v, size) for v in w]))


def test_walk_by_splits_equals_walk_by_rows():
    rng = np.random.default_rng(2)
    bins = rng.integers(0, 256, (700, 2)).astype(np.uint8)
    tree = histogram.HistTree([0, 1, 0, 0, 1, 0, 0], [99, 30, 0, 0, 200, 0, 0], [4, 2, -1, -1, 5, -1, -1], [1, 3, -1, -1, 6, -1, -1], [0.0] * 7)
    want = np.zeros(700, int)
    for node, rows in tree.leaves(bins):
        want[rows] = node
    assert tree.nodes(bins).tolist() == want.tolist()
