"""Newton fits of hinge and Huber losses against Spark's own solvers, feature maps that stay in the task, wide blocks of all pairs."""

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from millrace.models import batch, candidates, kernel, newton
from millrace.operators import cluster, nearest, tree


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(0, [1.0, 3.0, 0.2], (900, 3))
    called = (x @ [1.0, -0.5, 2.0] + rng.normal(0, 1.5, 900) > 0.3).astype(float)
    amount = x @ [1.0, 2.0, -3.0] + 5 + rng.standard_t(2, 900)
    data = [(i, v.tolist(), float(c), float(a), float(1 + i % 3)) for i, (v, c, a) in enumerate(zip(x, called, amount))]
    made = spark.createDataFrame(data, "row_id long, x array<double>, called double, amount double, weight double").repartition(3)
    return made.withColumn("features", array_to_vector("x")).cache()


def test_hinge_reaches_the_least_goal(rows):
    got = candidates.build("15_SGDClassifier", {"alpha": 1e-2})(rows.withColumnRenamed("called", "label"))
    model = got.__self__
    assert isinstance(model, batch.LinearCall) and model.margin
    data = rows.toPandas()
    x, side, w = np.stack(data.x), 2 * data.called.to_numpy() - 1, data.weight.to_numpy()

    def goal(v):
        return (w * np.maximum(1 - side * (x @ v[:-1] + v[-1]), 0)).sum() / w.sum() + 0.005 * v[:-1] @ v[:-1]

    found = np.append(model.weights, model.intercept)
    rng = np.random.default_rng(0)
    assert all(goal(found) <= goal(found + step) + 1e-4 for size in (1e-3, 1e-2, 0.1) for step in rng.normal(0, size, (200, 4)))
    theirs = LinearSVC(labelCol="called", weightCol="weight", regParam=1e-2, standardization=False, maxIter=1000, tol=1e-6).fit(rows)
    assert goal(found) <= goal(np.append(theirs.coefficients.toArray(), theirs.intercept)) + 1e-5
    called = got(rows.withColumnRenamed("called", "label")).toPandas()
    assert np.allclose(called.score, np.stack(called.x) @ found[:-1] + found[-1]) and ((called.score > 0) == (called.prediction == 1)).all()


def test_huber_is_spark_s_optimum(rows):
    train = rows.withColumnRenamed("amount", "label")
    weights, intercept = newton.fit_huber(train, 0.01)
    theirs = LinearRegression(loss="huber", regParam=0.01, standardization=False, maxIter=500, tol=1e-10).fit(train)
    assert np.allclose(weights, theirs.coefficients.toArray(), atol=1e-4) and intercept == pytest.approx(theirs.intercept, abs=1e-4)
    flat = train.withColumn("label", F.lit(2.0))
    assert newton.fit_huber(flat, 0.01)[1] == 2.0


def test_kernel_fit_keeps_no_lifted_rows(spark, rows):
    train = rows.withColumnRenamed("amount", "label")
    held = lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    before = held()
    model = kernel.fit_kernel_regressor(train, size=64)
    assert held() == before and len(model.weights) == 64
    assert model.transform(train).columns == [*train.columns, "prediction"]


def test_all_pairs_take_blocks_as_large_as_a_task_holds(spark):
    assert tree.group_rows(720_000, 64) == tree.GROUP_BYTES // 512 > 4 * nearest.BLOCK_ROWS
    x = np.random.default_rng(1).normal(0, 1, (300, 3))
    names = np.arange(300) % 4
    points = spark.createDataFrame([(i, v.tolist(), float(c)) for i, (v, c) in enumerate(zip(x, names))], "id long, x array<double>, p double")
    assert cluster.silhouette_euclidean(points) == pytest.approx(cluster.silhouette_euclidean(points, block_rows=17), abs=1e-9)


@pytest.mark.parametrize(("column", "wrong"), [("label", None), ("label", float("nan")), ("label", 2.0), ("weight", -1.0)])
def test_rows_without_a_sound_label_fail(rows, column, wrong):
    train = rows.withColumnRenamed("called", "label")
    bad = train.withColumn(column, F.when(F.col("row_id") != 7, F.col(column)).otherwise(F.lit(wrong)))
    with pytest.raises(Exception, match="must not be null"):
        newton.fit_hinge(bad, 0.01)
