"""Fits that share scans equal fits one by one: closed forms, optimality conditions, held-out scores."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from millrace.models import batch, candidates
from millrace.plans import selection


def table(spark, x, y, w=None, k=3):
    rows = [(i, [float(v) for v in r], float(y[i]), float(1 if w is None else w[i]), i % k) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "row_id bigint, x array<double>, label double, weight double, fold int")
    return df.withColumn("features", array_to_vector("x")).repartition(4).cache()


@pytest.fixture(scope="module")
def drawn():
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (240, 4)) * [1, 5, 0.2, 1] + [0, 100, 0, 0]
    return rng, x, 0.5 * x[:, 0] - 0.1 * x[:, 1] + rng.normal(0, 0.5, 240)


def test_squared_fits_meet_their_conditions(spark, drawn):
    _, x, y = drawn
    df = table(spark, x, y)
    trials = {"03_Ridge": [{"alpha": a} for a in (0.01, 5.0)], "05_ElasticNet": [{"alpha": 0.2, "l1_ratio": r} for r in (0.1, 0.9)], "04_Lasso": [{"alpha": 0.05}], "02_LinearRegression": [{}], "15_SGDRegressor": [{"alpha": 0.1}]}
    for name, listed in trials.items():
        for i, fit in enumerate(batch.squared_fits([df] * 3, name, listed)):
            own = np.arange(240) % 3 != i
            a, b = x[own], y[own]
            for t, params in enumerate(listed):
                p, w = batch.penalty_of(name, params, own.sum()), fit[:-1, t]
                left = b - a @ w - fit[-1, t]
                grad = -(a - a.mean(0)).T @ left / own.sum() + p.l2 * w
                assert abs(left.mean()) < 1e-9
                assert np.where(w != 0, np.abs(grad + p.l1 * np.sign(w)), np.maximum(np.abs(grad) - p.l1, 0)).max() < 1e-6


def test_logistic_fits_meet_their_conditions(spark, drawn):
    rng, x, y = drawn
    label, w = (y + rng.normal(0, 1, 240) > np.median(y)).astype(float), rng.choice([0.5, 2.0], 240)
    df = table(spark, x, label, w)
    cases = [("02_LogisticRegression", [{"C": c} for c in (0.01, 1.0, 10.0)]), ("15_SGDClassifier", [{"loss": "log_loss", "alpha": a, "penalty": p} for a in (1e-4, 1e-2) for p in ("l1", "l2", "elasticnet")])]
    for name, listed in cases:
        for i, fit in enumerate(batch.smooth_fits([df] * 3, name, listed)):
            own = np.arange(240) % 3 != i
            for t, params in enumerate(listed):
                p, v = batch.penalty_of(name, params, w[own].sum()), fit[:, t]
                q = 1 / (1 + np.exp(-(x[own] @ v[:-1] + v[-1])))
                off = w[own] * (q - label[own]) / w[own].sum()
                grad = x[own].T @ off + p.l2 * v[:-1]
                assert abs(off.sum()) < 1e-6
                assert np.where(v[:-1] != 0, np.abs(grad + p.l1 * np.sign(v[:-1])), np.maximum(np.abs(grad) - p.l1, 0)).max() < 1e-6


@pytest.mark.parametrize("loss", ["modified_huber", "squared_hinge"])
def test_other_smooth_losses_meet_their_conditions(spark, drawn, loss):
    rng, x, y = drawn
    label = (y + rng.normal(0, 1, 240) > np.median(y)).astype(float)
    df, side = table(spark, (x - x.mean(0)) / x.std(0), label), 2 * label - 1
    x = (x - x.mean(0)) / x.std(0)
    listed = [{"loss": loss, "alpha": a, "penalty": p} for a in (1e-3, 1e-1) for p in ("l1", "l2", "elasticnet")]
    for i, fit in enumerate(batch.smooth_fits([df] * 3, "15_SGDClassifier", listed)):
        own = np.arange(240) % 3 != i
        for t, params in enumerate(listed):
            p, v = batch.penalty_of("15_SGDClassifier", params, 1.0), fit[:, t]
            z = side[own] * (x[own] @ v[:-1] + v[-1])
            slope = np.where((z < -1) & (loss == "modified_huber"), -4.0, -2 * np.maximum(1 - z, 0)) * side[own] / own.sum()
            grad = x[own].T @ slope + p.l2 * v[:-1]
            assert abs(slope.sum()) < 1e-6
            assert np.where(v[:-1] != 0, np.abs(grad + p.l1 * np.sign(v[:-1])), np.maximum(np.abs(grad) - p.l1, 0)).max() < 1e-6


def test_held_out_scores(spark, drawn):
    _, x, y = drawn
    df, trials = table(spark, x, y), [{"alpha": 0.1}, {"alpha": 50.0}]
    fits = batch.squared_fits([df] * 3, "03_Ridge", trials)
    for i, (mae, mse, n) in enumerate(batch.held_out_errors([df] * 3, fits)):
        own = np.arange(240) % 3 == i
        gap = x[own] @ fits[i][:-1] + fits[i][-1] - y[own, None]
        assert mae == pytest.approx(np.abs(gap).mean(0)) and mse == pytest.approx((gap**2).mean(0)) and n == own.sum()
    label = (y > np.median(y)).astype(float)
    df = table(spark, x, label)
    fits = batch.smooth_fits([df] * 3, "02_LogisticRegression", [{"C": 1.0}, {"C": 1e-6}])
    for i, f1 in enumerate(batch.held_out_f1([df] * 3, fits)):
        own = np.arange(240) % 3 == i
        for t in range(2):
            called = x[own] @ fits[i][:-1, t] + fits[i][-1, t] > 0
            both = (called & (label[own] == 1)).sum()
            assert f1[t] == pytest.approx(2 * both / (called.sum() + label[own].sum()))


@pytest.mark.parametrize(("kind", "name", "trials"), [(selection.REGRESSION, "05_ElasticNet", [{"alpha": 0.01, "l1_ratio": 0.5}, {"alpha": 1.0, "l1_ratio": 0.5}]), (selection.CLASSIFICATION, "02_LogisticRegression", [{"C": 0.01}, {"C": 1.0}])])
def test_search_chooses_as_fits_one_by_one(spark, drawn, kind, name, trials):
    _, x, y = drawn
    label = y if kind == selection.REGRESSION else (y > np.median(y)).astype(float)
    rows = [(i, *map(float, r), float(label[i])) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "row_id bigint, a double, b double, c double, d double, label double")
    data = selection.fold_input(df, kind, "label", "row_id", ["a", "b", "c", "d"], [], k=3)
    params, score = selection.search(data, name, trials)
    main = "mae" if kind == selection.REGRESSION else "f1"
    alone = [selection.cross_validate(data, name, t)[main] for t in trials]
    best = int(np.argmin(alone) if main == "mae" else np.argmax(alone))
    assert params == trials[best] and abs(score) == pytest.approx(alone[best], abs=2e-3)


def test_other_candidates_are_left_to_their_own_fit():
    assert batch.fold_means([], "03_KNeighborsClassifier", [{}], False) is None
    assert batch.fold_means([], "15_SGDClassifier", [{"loss": "hinge"}], False) is None
    assert set(candidates.REGRESSOR_SPACES) >= {"03_Ridge", "04_Lasso", "05_ElasticNet"}


def test_discriminants_and_repeated_trials_share_scans(spark, drawn, monkeypatch):
    _, x, y = drawn
    label = (y > np.median(y)).astype(float)
    df = spark.createDataFrame([(i, *map(float, r), float(label[i])) for i, r in enumerate(x)], "row_id bigint, a double, b double, c double, d double, label double")
    data = selection.fold_input(df, selection.CLASSIFICATION, "label", "row_id", ["a", "b", "c", "d"], [], k=3)
    name, trials = "12_LinearDiscriminantAnalysis", [{"shrinkage": s, "solver": v} for s in ("auto", 0.0, 0.5, 0.9) for v in ("lsqr", "eigen")]
    alone = [selection.cross_validate(data, name, t)["f1"] for t in trials[::2]]
    monkeypatch.setattr(selection, "cross_validate", lambda *a: pytest.fail("fitted one by one"))
    passes, summed = [], batch._summed
    monkeypatch.setattr(batch, "_summed", lambda *a: passes.append(1) or summed(*a))
    assert batch.fold_means(data.blocks, name, trials, False) == pytest.approx(np.repeat(alone, 2), abs=1e-4)
    assert len(passes) <= 9
    (few, one), (every, best) = selection.search_each(data, name, [trials[-2:], trials])
    assert few == trials[-2] and one == alone[-1] and every == trials[2 * int(np.argmax(alone))] and best == max(alone)


def test_labels_that_are_not_0_or_1_are_fitted_one_by_one(spark):
    df = spark.createDataFrame([(i, float(i % 7), float(i % 3)) for i in range(60)], "row_id bigint, a double, label double")
    parts = selection.fold_input(df, selection.CLASSIFICATION, "label", "row_id", ["a"], [], k=2).blocks
    assert batch.fold_means(parts, "12_LinearDiscriminantAnalysis", [{"shrinkage": 0.5}], False) is None
