import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from millrace.models import candidates, gaussian, linear, store
from millrace.operators import cluster, density, graph, nearest, vectorize
from millrace.operators.moments import class_moments
from millrace.plans import selection


def vectors(spark, x, label=None):
    data = [(i, [float(v) for v in row], float(label[i]) if label is not None else 0.0) for i, row in enumerate(x)]
    df = spark.createDataFrame(data, "row_id bigint, x array<double>, label double")
    return df.withColumn("features", array_to_vector("x")).withColumn("weight", F.lit(1.0))


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(0)
    return np.concatenate(
        [rng.normal(0, 1, (60, 3)), rng.normal(4, 1, (60, 3)), rng.normal([9, 0, 0], 0.3, (40, 3)), rng.uniform(-5, 12, (30, 3))]
    )


def test_vectorizer_handles_unknown_and_saves(spark, tmp_path):
    train = spark.createDataFrame([(1.0, "a", "x"), (3.0, "b", "x"), (5.0, None, "y'z"), (None, "b", None)], "n double, t string, u string")
    plan = vectorize.fit_vectorizer(train, ["n", "gone"], ["t", "u"])
    plan.write().overwrite().save(str(tmp_path / "plan"))
    again = PipelineModel.load(str(tmp_path / "plan"))
    rows = again.transform(spark.createDataFrame([(3.0, "new", "y'z"), (None, "a", "x")], train.schema))
    got = [r[0] for r in rows.select(vector_to_array("features")).collect()]
    assert got[0] == pytest.approx([0.0, 0, 0, 0, 1]) and got[1] == pytest.approx([0.0, 1, 0, 1, 0])


def test_standardise_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 4.0), (3.0, 4.0), (5.0, 4.0)], "n double, c double")
    rows = vectorize.fit_vectorizer(df, ["n", "c"]).transform(df).select(vector_to_array("features")).collect()
    assert [r[0][0] for r in rows] == pytest.approx([-1.2247, 0, 1.2247], abs=1e-4)
    assert {r[0][1] for r in rows} == {0.0}


def test_fold_vectorizers_see_only_their_training_rows(spark):
    df = spark.createDataFrame([(0, 1.0, "a"), (0, 3.0, "b"), (1, 10.0, "c"), (1, 30.0, "c")], "fold int, n double, t string")
    first, second = vectorize.fit_fold_vectorizers(df, "fold", 2, ["n"], ["t"])
    alone = vectorize.fit_vectorizer(df.where("fold = 1"), ["n"], ["t"])
    a = [r[0] for r in first.transform(df).select(vector_to_array("features")).collect()]
    b = [r[0] for r in alone.transform(df).select(vector_to_array("features")).collect()]
    assert a == b and len(second.transform(df).first()["features"]) == 3


def test_gaussian_models_match_formulas(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 1, (80, 2)), rng.normal([1.5, 1], [1, 2], (60, 2))])
    y = np.array([0] * 80 + [1] * 60)
    df = vectors(spark, x, y)
    got = gaussian.fit_naive_bayes(df).transform(df).orderBy("row_id").select("score").toPandas()["score"].to_numpy()
    lift = 1e-9 * x.var(0).max()
    log = np.stack(
        [np.log((y == c).mean()) - 0.5 * (np.log(2 * np.pi * (x[y == c].var(0) + lift)) + (x - x[y == c].mean(0)) ** 2 / (x[y == c].var(0) + lift)).sum(1) for c in (0, 1)],
        1,
    )
    want = np.exp(log[:, 1]) / np.exp(log).sum(1)
    assert got == pytest.approx(want, abs=1e-9)
    lda = gaussian.fit_linear_discriminant(df)
    pooled = sum((y == c).sum() * np.cov(x[y == c].T, bias=True) for c in (0, 1)) / len(y)
    w = np.linalg.solve(pooled, x[y == 1].mean(0) - x[y == 0].mean(0))
    assert lda.linear[1] - lda.linear[0] == pytest.approx(w)
    assert gaussian.fit_linear_discriminant(df, "auto").transform(df).count() == 140
    qda = gaussian.fit_quadratic_discriminant(df, 0.01)
    inv = np.linalg.inv(0.99 * np.cov(x[y == 1].T) + 0.01 * np.eye(2))
    assert -2 * qda.full[1] == pytest.approx(inv)


def test_linear_models_match_closed_forms(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (120, 2))
    y = 2 * x[:, 0] - x[:, 1] + rng.normal(0, 0.5, 120)
    df = vectors(spark, x, y)
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 3 * np.eye(2), xc.T @ yc)
    assert linear.solve_ridge(df, 3.0).weights == pytest.approx(want)
    assert np.array(linear.fit_ridge(df, 3.0).coefficients) == pytest.approx(want, abs=1e-4)
    w = np.zeros(2)
    for _ in range(2000):
        for j in range(2):
            r = yc - xc @ w + xc[:, j] * w[j]
            c = xc[:, j] @ r / len(y)
            w[j] = np.sign(c) * max(abs(c) - 0.2 * 0.5, 0) / ((xc[:, j] ** 2).mean() + 0.2 * 0.5)
    assert np.array(linear.fit_elastic_net(df, 0.2, 0.5).coefficients) == pytest.approx(w, abs=1e-4)


@pytest.mark.parametrize("layout", [{"leaf_rows": 12, "fanout": 3, "block_rows": 7}, {}])
@pytest.mark.parametrize("p", [1, 2])
def test_neighbours_equal_brute_force(spark, cloud, layout, p):
    pts = nearest.as_points(vectors(spark, cloud), "row_id", "features").cache()
    got = {(r["id"], r["ref_id"]) for r in nearest.nearest_neighbours(pts, pts, 4, p, True, **layout).collect()}
    gap = cloud[:, None] - cloud[None]
    dist = np.abs(gap).sum(-1) if p == 1 else np.sqrt((gap**2).sum(-1))
    np.fill_diagonal(dist, np.inf)
    want = {(i, int(j)) for i in range(len(cloud)) for j in np.lexsort((np.arange(len(cloud)), dist[i]))[:4]}
    assert got == want


def test_vote_and_average(spark):
    found = spark.createDataFrame(
        [(1, 0.0, 1.0), (1, 1.0, 0.0), (1, 2.0, 0.0), (2, 1.0, 4.0), (2, 2.0, 1.0)], "id bigint, distance double, payload double"
    )
    assert {r["id"]: r["prediction"] for r in nearest.vote(found).collect()} == {1: 0.0, 2: 1.0}
    assert {r["id"]: r["prediction"] for r in nearest.average(found, "distance").collect()} == pytest.approx({1: 1.0, 2: 3.0})


def test_components_of_chain_and_hub(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 200)]
    nodes = spark.createDataFrame([(i,) for i in [*range(51), *range(100, 140), 200]], "id bigint")
    got = graph.connected_components(nodes, spark.createDataFrame(edges, "u bigint, v bigint"))
    assert {r["id"]: r["component"] for r in got.collect()} == {i: (0 if i < 51 else 100 if i < 200 else 200) for i in [*range(51), *range(100, 140), 200]}


@pytest.mark.parametrize("eps,least,layout", [(0.9, 5, {"leaf_rows": 12, "fanout": 3, "block_rows": 7}), (0.05, 5, {})])
def test_dbscan_equals_sequential(spark, cloud, eps, least, layout):
    pts = nearest.as_points(vectors(spark, cloud), "row_id", "features").cache()
    got = density.dbscan(pts, eps, least, **layout).toPandas().set_index("id")["cluster"].sort_index().to_numpy()
    near = np.sqrt(((cloud[:, None] - cloud[None]) ** 2).sum(-1)) <= eps
    core, label, c = near.sum(1) >= least, np.full(len(cloud), -1), 0
    for i in range(len(cloud)):
        if label[i] != -1 or not core[i]:
            continue
        todo = [i]
        while todo:
            j = todo.pop()
            if label[j] == -1:
                label[j] = c
                if core[j]:
                    todo += list(np.nonzero(near[j] & (label == -1))[0])
        c += 1
    assert (got == label).all()


def test_cluster_quality_equals_definition(spark, cloud):
    label = np.arange(len(cloud)) % 3
    df = vectors(spark, cloud, label).withColumn("cluster", F.col("label"))
    gap2 = ((cloud[:, None] - cloud[None]) ** 2).sum(-1)

    def silhouette(d):
        out = []
        for i in range(len(cloud)):
            a = d[i][label == label[i]].sum() / ((label == label[i]).sum() - 1)
            b = min(d[i][label == c].mean() for c in set(label) - {label[i]})
            out.append((b - a) / max(a, b))
        return np.mean(out)

    assert cluster.silhouette_squared(df) == pytest.approx(silhouette(gap2))
    pts = nearest.as_points(df, "row_id", "features", "cluster")
    assert cluster.silhouette_euclidean(pts, block_rows=70) == pytest.approx(silhouette(np.sqrt(gap2)))
    means = np.stack([cloud[label == c].mean(0) for c in range(3)])
    s = [np.linalg.norm(cloud[label == c] - means[c], axis=1).mean() for c in range(3)]
    want = np.mean([max((s[i] + s[j]) / np.linalg.norm(means[i] - means[j]) for j in range(3) if j != i) for i in range(3)])
    assert cluster.davies_bouldin(df) == pytest.approx(want)
    one = df.withColumn("cluster", F.lit(0))
    assert cluster.silhouette_squared(one) is None and cluster.davies_bouldin(one) is None


def test_principal_components(spark, cloud):
    pc = cluster.principal_components(vectors(spark, cloud), 2)
    _, s, vt = np.linalg.svd(cloud - cloud.mean(0), full_matrices=False)
    assert pc.ratio == pytest.approx((s**2 / (s**2).sum())[:2])
    assert np.abs(pc.components) == pytest.approx(np.abs(vt[:2]))


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(0, 1, (70, 2)), rng.normal(2.5, 1, (50, 2))])
    y = np.array([0] * 70 + [1] * 50)
    return vectors(spark, x, y).cache()


_QUICK = {
    "05_RandomForestClassifier": {"n_estimators": 5, "max_depth": 4}, "07_GradientBoostingClassifier": {"n_estimators": 3},
    "08_HistGradientBoosting": {"max_iter": 3, "max_leaf_nodes": 8}, "09_AdaBoostClassifier": {"n_estimators": 6},
    "10_SVC": {"size": 32}, "14_BaggingClassifier": {"n_estimators": 3}, "08_RandomForestRegressor": {"n_estimators": 3},
    "10_GradientBoostingRegressor": {"n_estimators": 3}, "11_HistGradientBoosting": {"max_iter": 20},
    "12_AdaBoostRegressor": {"n_estimators": 6}, "13_SVR": {"size": 32}, "14_BaggingRegressor": {"n_estimators": 3},
}


@pytest.mark.parametrize("name", candidates.CLASSIFIERS)
def test_classifiers_beat_chance(labelled, name):
    out = candidates.build(name, _QUICK.get(name))(labelled)(labelled)
    r = selection.evaluate(out, selection.CLASSIFICATION)[0]
    assert r["tp"] + r["tn"] + r["fp"] + r["fn"] == 120
    assert r["accuracy"] > (0.5 if "Dummy" in name else 0.85)
    assert r["roc_auc"] == 0.5 if "Dummy" in name else r["roc_auc"] > 0.85


@pytest.mark.parametrize("penalty", ["l1", "l2", "elasticnet"])
def test_modified_huber_beats_chance(labelled, penalty):
    out = candidates.build("15_SGDClassifier", {"loss": "modified_huber", "alpha": 1e-3, "penalty": penalty})(labelled)(labelled)
    r = selection.evaluate(out, selection.CLASSIFICATION)[0]
    assert r["accuracy"] > 0.85 and r["roc_auc"] > 0.85


@pytest.mark.parametrize("name", candidates.REGRESSORS)
def test_regressors_beat_the_mean(spark, labelled, name):
    rows = labelled.withColumn("label", 3 * F.col("x")[0] + F.col("x")[1])
    r = selection.evaluate(candidates.build(name, _QUICK.get(name))(rows)(rows), selection.REGRESSION)[0]
    assert r["r2"] == pytest.approx(0, abs=1e-9) if "Dummy" in name else r["r2"] > 0.5


def test_unsupported_trial_counts_as_missing(labelled):
    rows = labelled.select("row_id", "label", F.col("x")[0].alias("a"))
    data = selection.fold_input(rows, selection.CLASSIFICATION, "label", "row_id", ["a"], [], k=2)
    row = selection.cross_validate(data, "15_SGDClassifier", {"loss": "hinge", "penalty": "l1"})
    assert "no distributed solver" in row["error"] and row.get("f1") is None
    params, score = selection.search(data, "12_LinearDiscriminantAnalysis", [{"shrinkage": 0.0}, {"shrinkage": 0.5}])
    assert params["shrinkage"] in (0.0, 0.5) and score > 0.8
    swept, best = selection.search(data, "11_GaussianNB", [{"var_smoothing": v} for v in (1e-9, 1e-3)])
    alone = selection.cross_validate(data, "11_GaussianNB", swept)
    assert best == pytest.approx(alone["f1"], abs=1e-4)


def test_finalists_follow_the_published_rankings(spark):
    clf = [("11_GaussianNB", 0.2757), ("02_LogisticRegression", 0.2532), ("15_SGDClassifier", 0.2457), ("13_QuadraticDiscriminantAnalysis", 0.2395), ("01_DummyClassifier", 0.0)]
    df = spark.createDataFrame([(n, None, f) for n, f in clf], "modelo string, error string, f1 double")
    spaces = list(candidates.CLASSIFIER_SPACES)
    assert selection.pick_finalists(df, spaces, "f1", False) == ["11_GaussianNB", "02_LogisticRegression", "15_SGDClassifier"]
    reg = [("06_KNeighborsRegressor", 1.4408), ("01_DummyRegressor", 1.4827), ("04_Lasso", 1.4895), ("05_ElasticNet", 1.4946)]
    df = spark.createDataFrame([(n, None, f) for n, f in reg], "modelo string, error string, mae double")
    assert selection.pick_finalists(df, list(candidates.REGRESSOR_SPACES), "mae", True) == ["06_KNeighborsRegressor", "04_Lasso", "05_ElasticNet"]
    assert len(selection.pick_finalists(df.limit(0), spaces, "mae", True)) == 3


def test_search_sizes():
    sizes = {n: (len(selection.combinations(s["random"])), len(selection.combinations(s["grid"]))) for n, s in {**candidates.CLASSIFIER_SPACES, **candidates.REGRESSOR_SPACES}.items()}
    assert [min(12, sizes[n][0]) for n in ("11_GaussianNB", "02_LogisticRegression", "15_SGDClassifier", "06_KNeighborsRegressor", "04_Lasso", "05_ElasticNet")] == [7, 12, 12, 12, 7, 12]
    assert [sizes[n][1] for n in ("11_GaussianNB", "02_LogisticRegression", "15_SGDClassifier", "06_KNeighborsRegressor", "04_Lasso", "05_ElasticNet")] == [5, 4, 12, 20, 4, 12]
    assert selection.params_json({"b": None, "a": 1e-11}) == '{"modelo__a": 1e-11, "modelo__b": null}'


_SAVED = {**_QUICK, "05_RandomForestClassifier": {"n_estimators": 2}, "15_SGDClassifier": {"loss": "modified_huber"}}


# One candidate of each saved kind; the others are Spark ML models like 04.
_KINDS = (
    "01_DummyClassifier", "03_KNeighborsClassifier", "04_DecisionTreeClassifier", "08_HistGradientBoosting", "09_AdaBoostClassifier", "10_SVC", "11_GaussianNB",
    "15_SGDClassifier", "06_KNeighborsRegressor", "12_AdaBoostRegressor", "13_SVR",
)


@pytest.mark.parametrize("name", _KINDS)
def test_saved_model_scores_alike(spark, tmp_path, name):
    rng = np.random.default_rng(6)
    rows = [(i, float(rng.normal()), "ab"[i % 2], float(i % 3 == 0)) for i in range(60)]
    df = spark.createDataFrame(rows, "row_id bigint, n double, t string, label double")
    plan = vectorize.fit_vectorizer(df, ["n"], ["t"])
    ready = plan.transform(df).select("row_id", "features", "label").withColumn("weight", F.lit(1.0)).cache()
    apply = candidates.build(name, _SAVED.get(name))(ready)
    store.save_fitted(apply, plan, str(tmp_path / "m"), df.drop("label"))
    again = store.load_fitted(spark.newSession(), str(tmp_path / "m"))
    shown = ["prediction"] + (["score"] if name in candidates.CLASSIFIERS and "score" in apply(ready).columns else [])
    fresh = {r["row_id"]: [r[c] for c in shown] for r in apply(ready).collect()}
    saved = {r["row_id"]: [r[c] for c in shown] for r in again(df.drop("label")).collect()}
    assert saved.keys() == fresh.keys() and all(saved[k] == pytest.approx(v) for k, v in fresh.items())


def test_saved_models_check_version_and_columns(spark, labelled, tmp_path):
    df = labelled.select("row_id", F.col("x")[0].alias("n"), "label")
    plan = vectorize.fit_vectorizer(df, ["n"], [])
    apply = candidates.build("11_GaussianNB")(plan.transform(df))
    store.save_fitted(apply, plan, str(tmp_path / "m"), df.drop("label"))
    again = store.load_fitted(spark, str(tmp_path / "m"))
    with pytest.raises(ValueError, match="n double"):
        again(df.withColumn("n", F.col("n").cast("string")))
    old = spark.read.parquet(str(tmp_path / "m" / "parameters")).withColumn("version", F.lit(1)).collect()
    spark.createDataFrame(old).write.mode("overwrite").parquet(str(tmp_path / "m" / "parameters"))
    with pytest.raises(ValueError, match="version 1"):
        store.load_fitted(spark, str(tmp_path / "m"))
    with pytest.raises(ValueError, match="no saved form"):
        store.save_fitted(lambda rows: rows, plan, str(tmp_path / "k"))


def test_moments_keep_a_small_spread_around_large_values(spark):
    x = np.array([[1.7e9 + 0.5 * (i % 2), 3.0 * i] for i in range(40)])
    labels = [float(i % 3 == 0) for i in range(40)]
    got = class_moments(vectors(spark, x, labels), "label", cross=True)
    for c in (0.0, 1.0):
        own = x[np.array(labels) == c]
        assert np.allclose(got[c].covariance, np.cov(own.T, bias=True), rtol=1e-9)
    whole = got[0.0] + got[1.0]
    assert np.allclose(whole.covariance, np.cov(x.T, bias=True), rtol=1e-9) and np.allclose(whole.mean, x.mean(0))


def test_automatic_shrinkage_is_per_class(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, [1, 5, 100], (40, 3)), rng.normal([2, 0, 50], [2, 1, 30], (60, 3))])
    y = np.repeat([0.0, 1.0], [40, 60])
    df = vectors(spark, x, y)
    got = gaussian.shrunk_covariances(df, class_moments(df, "label", cross=True))
    for c in (0.0, 1.0):
        own = x[y == c]
        scale = own.std(0)
        z = (own - own.mean(0)) / scale
        n, d = z.shape
        cov = z.T @ z / n
        mu = np.trace(cov) / d
        delta = ((cov - mu * np.eye(d)) ** 2).sum() / d
        beta = sum(((np.outer(r, r) - cov) ** 2).sum() for r in z) / (d * n * n)
        share = min(beta, delta) / delta
        want = ((1 - share) * cov + share * mu * np.eye(d)) * np.outer(scale, scale)
        assert np.allclose(got[c], want)


def test_approximate_neighbours_recall(spark, cloud):
    df = vectors(spark, cloud)
    found = nearest.approximate_neighbours(df, df, 5, "features", "row_id", bucket_length=4.0, tables=8)
    near = {(r["id"], r["ref_id"]) for r in found.collect()}
    gaps = np.sqrt(((cloud[:, None] - cloud[None]) ** 2).sum(-1))
    true = {(i, int(j)) for i in range(len(cloud)) for j in np.argsort(gaps[i], kind="stable")[:5]}
    assert len(near & true) >= 0.9 * len(true)
