"""Restarts that share passes against Spark's own k-means, run one by one."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans

from millrace.operators import cluster


def test_shared_passes_end_where_single_fits_end(spark, monkeypatch):
    x = np.random.default_rng(5).normal(1000, 1, (400, 6))
    df = cluster.to_vector(spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id bigint, v array<double>"), "v").cache()
    alone = {}
    for k in (2, 4):
        fits = [KMeans(k=k, seed=3 + r, predictionCol="cluster", maxIter=100, tol=1e-4).fit(df) for r in range(3)]
        alone[k] = min(fits, key=lambda m: m.summary.trainingCost)
    passes, lloyd = [], cluster._lloyd
    monkeypatch.setattr(cluster, "_lloyd", lambda *a: passes.append(len(a[1])) or lloyd(*a))
    found = cluster.best_kmeans_each(df, (2, 4), seed=3, restarts=3)
    assert passes[0] == 6 and len(passes) <= 100
    for k, model in found.items():
        assert model.cost == pytest.approx(alone[k].summary.trainingCost, rel=1e-9)
        assert np.allclose(model.centres, np.array(alone[k].clusterCenters()))
        want = {r.id: r.cluster for r in alone[k].transform(df).collect()}
        assert {r.id: r.cluster for r in model.transform(df).collect()} == want


def test_a_centre_without_rows_and_few_points(spark):
    df = cluster.to_vector(spark.createDataFrame([(i, [float(i % 2), 0.0]) for i in range(9)], "id bigint, v array<double>"), "v")
    assert cluster.best_kmeans(df, 3, restarts=2).cost == pytest.approx(0.0, abs=1e-12)
