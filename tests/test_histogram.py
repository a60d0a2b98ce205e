"""Histogram boosting against plain best-first trees over all cuts of the values."""

import heapq
import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from millrace.models import candidates, histogram


def frame(spark, x, y, w=None):
    weight = np.ones(len(x)) if w is None else w
    rows = [(i, [float(v) for v in r], float(y[i]), float(weight[i])) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "row_id bigint, x array<double>, label double, weight double")
    return df.withColumn("features", array_to_vector("x")).drop("x").repartition(3).cache()


def plain(x, y, w, loss, rounds, rate, leaves, least, l2):
    """Scores after each round; every leaf's best cut by trying all of them."""
    mean = (y * w).sum() / w.sum()
    raw = np.full(len(x), mean if loss == "squared_error" else math.log(mean / (1 - mean)))
    for _ in range(rounds):
        p = raw if loss == "squared_error" else 1 / (1 + np.exp(-raw))
        g, h = (p - y) * w, w if loss == "squared_error" else p * (1 - p) * w

        def best(rows):
            top = (0.0,)
            for j in range(x.shape[1]):
                for cut in np.unique(x[rows, j])[:-1]:
                    a, b = rows[x[rows, j] <= cut], rows[x[rows, j] > cut]
                    if min(len(a), len(b)) < least or min(h[a].sum(), h[b].sum()) < 1e-3:
                        continue
                    gain = sum(g[s].sum() ** 2 / (h[s].sum() + l2) * c for s, c in ((a, 1), (b, 1), (rows, -1)))
                    if gain > top[0] + 1e-9:
                        top = (gain, a, b)
            return top

        heap, done, n = [], [], 0

        def push(rows):
            nonlocal n
            top = best(rows)
            if top[0] > 0:
                heapq.heappush(heap, (-top[0], n, rows, top))
                n += 1
            else:
                done.append(rows)

        push(np.arange(len(x)))
        count = 1
        while heap and count < leaves:
            _, _, _, top = heapq.heappop(heap)
            count += 1
            push(top[1])
            push(top[2])
        raw = raw.copy()
        for rows in done + [item[2] for item in heap]:
            raw[rows] -= rate * g[rows].sum() / (h[rows].sum() + l2)
    return raw


@pytest.mark.parametrize("loss", ["squared_error", "log_loss"])
@pytest.mark.parametrize(("leaves", "least", "l2", "rounds"), [(2, 1, 0.0, 1), (7, 5, 0.5, 3), (31, 2, 0.0, 2)])
def test_equals_plain_trees(spark, loss, leaves, least, l2, rounds, monkeypatch):
    monkeypatch.setattr(histogram, "WRITE_EVERY", 2)
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.integers(0, 40, 240), rng.normal(0, 1, 240).round(1), rng.integers(0, 2, 240)]).astype(float)
    y = (x[:, 0] / 20 + x[:, 1] * x[:, 2] + rng.normal(0, 0.3, 240) > 1).astype(float) if loss == "log_loss" else x[:, 0] ** 2 / 100 + x[:, 1] * x[:, 2]
    w = rng.choice([0.5, 1.0, 2.0], 240)
    df = frame(spark, x, y, w)
    model = histogram.fit_histogram_boosting(df, loss, rounds, 0.3, leaves, least, l2)
    out = model.transform(df).select("row_id", *(["prediction", "score"] if loss == "log_loss" else ["prediction"])).toPandas().sort_values("row_id")
    want = plain(x, y, w, loss, rounds, 0.3, leaves, least, l2)
    assert all(t.left.count(-1) <= leaves for t in model.trees)
    if loss == "squared_error":
        assert out["prediction"].to_numpy() == pytest.approx(want)
    else:
        assert out["score"].to_numpy() == pytest.approx(1 / (1 + np.exp(-want))) and (out["prediction"].to_numpy() == (want > 0)).all()


def test_quantile_bins_and_missing_values(spark):
    rng = np.random.default_rng(6)
    x = np.column_stack([rng.normal(0, 1, 3000), rng.normal(0, 1, 3000)])
    x[::10, 1] = np.nan
    y = np.where(np.isnan(x[:, 1]), 5.0, 0.0) + (x[:, 0] > 0.5)
    df = frame(spark, x, y)
    model = histogram.fit_histogram_boosting(df, "squared_error", 30, max_leaf_nodes=4)
    assert max(map(len, model.edges)) <= histogram.MAX_BINS - 1
    gap = model.transform(df).selectExpr("avg(abs(prediction - label)) AS e").first()["e"]
    assert gap < 0.1


def test_odd_tables(spark):
    rng = np.random.default_rng(7)
    flat = frame(spark, np.ones((50, 2)), rng.integers(0, 2, 50))
    assert histogram.fit_histogram_boosting(flat, max_iter=5).trees == []
    one = histogram.fit_histogram_boosting(frame(spark, rng.normal(0, 1, (50, 2)), np.ones(50)), max_iter=2)
    assert one.transform(flat).where("prediction <> 1").count() == 0
    with pytest.raises(ValueError, match="training"):
        histogram.fit_histogram_boosting(flat.limit(0))


def test_candidates_and_saved_form(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(0, 1, (400, 3))
    df = frame(spark, x, (x[:, 0] * x[:, 1] > 0).astype(float))
    wide, narrow = (candidates.build("08_HistGradientBoosting", {"max_iter": 8, "max_leaf_nodes": n, "l2_regularization": 1.0})(df)(df) for n in (31, 3))
    right = [d.where("prediction = label").count() for d in (wide, narrow)]
    assert right[0] > right[1] and right[0] > 380
    model = histogram.fit_histogram_boosting(df, max_iter=3)
    again = histogram.HistModel.from_dict(model.to_dict())
    assert [r.score for r in model.transform(df).orderBy("row_id").collect()] == [r.score for r in again.transform(df).orderBy("row_id").collect()]


def test_blocks_hold_rows_and_leaves_part_them():
    rng = np.random.default_rng(5)
    bins, y = rng.integers(0, 256, (500, 3)).astype(np.uint8), rng.normal(0, 1, 500)
    kept = list(histogram._blocks(histogram._packed(bins, y, y + 1, y + 2)))
    back = histogram._block(kept[0], 3)
    assert len(kept) == 1 and all(np.array_equal(a, b) for a, b in zip(back, (bins, y, y + 1, y + 2), strict=True))
    tree = histogram.HistTree([1, 0, 0, 0, 0], [100, 50, 0, 0, 0], [1, 3, -1, -1, -1], [2, 4, -1, -1, -1], [0.0, 0.0, 1.0, 2.0, 3.0])
    found = tree.leaves(back[0])
    assert sorted(np.concatenate([rows for _, rows in found]).tolist()) == list(range(500))
    assert tree.score(bins).tolist() == np.where(bins[:, 1] > 100, 1.0, np.where(bins[:, 0] <= 50, 2.0, 3.0)).tolist()


def test_small_blocks_give_the_same_trees(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.integers(0, 40, (600, 2)).astype(float)
    df = frame(spark, x, (x[:, 0] > x[:, 1]).astype(float)).repartition(5)
    whole = histogram.fit_histogram_boosting(df, "squared_error", 3, max_leaf_nodes=5)
    monkeypatch.setattr(histogram, "BLOCK_ROWS", 7)
    monkeypatch.setattr(histogram, "WRITE_EVERY", 2)
    small = histogram.fit_histogram_boosting(df, "squared_error", 3, max_leaf_nodes=5)
    assert [(t.feature, t.bin, t.left, t.right) for t in small.trees] == [(t.feature, t.bin, t.left, t.right) for t in whole.trees]
