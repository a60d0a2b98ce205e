"""Linear regressors with the penalties expressed in per-coefficient units."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.moments import class_moments
from millrace.session import col


def _label_scale(df: DataFrame, label: str) -> tuple[int, float]:
    row = df.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp(col(label)).alias("s")).first()
    return row["n"], row["s"] or 1.0


def _estimator(label: str, **kw) -> LinearRegression:
    return LinearRegression(labelCol=label, standardization=False, solver="l-bfgs", maxIter=1000, tol=1e-9, **kw)


def ordinary(label: str = "label") -> LinearRegression:
    """Least squares; normal equations solve it in one pass while d stays small."""
    return LinearRegression(labelCol=label, regParam=0.0, solver="auto", maxIter=1000, tol=1e-9)


def fit_ridge(df: DataFrame, alpha: float = 1.0, label: str = "label"):
    """Minimise sum of squares + alpha |w|^2. Spark's L2 term is divided by the label's deviation, hence the factor."""
    n, spread = _label_scale(df, label)
    return _estimator(label, elasticNetParam=0.0, regParam=alpha / n * spread).fit(df)


def fit_elastic_net(df: DataFrame, alpha: float = 0.1, l1_ratio: float = 0.5, label: str = "label"):
    """Minimise squares / 2n + alpha (ratio |w|_1 + (1 - ratio) |w|^2 / 2)."""
    _, spread = _label_scale(df, label)
    l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio) * spread
    return _estimator(label, regParam=l1 + l2, elasticNetParam=l1 / (l1 + l2) if l1 + l2 else 0.0).fit(df)


def fit_lasso(df: DataFrame, alpha: float = 0.1, label: str = "label"):
    return _estimator(label, elasticNetParam=1.0, regParam=alpha).fit(df)


class RidgeSolution:
    """Closed-form ridge weights on the raw scale."""

    def __init__(self, weights: np.ndarray, intercept: float):
        self.weights, self.intercept = weights, intercept

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        w, b = self.weights, self.intercept

        @F.pandas_udf("double")
        def predict(x: pd.Series) -> pd.Series:
            return pd.Series(np.stack(x.to_numpy()) @ w + b if len(x) else [], dtype=float)

        return df.withColumn("prediction", predict(vector_to_array(col(features))))


def solve_ridge(df: DataFrame, alpha: float = 1.0, label: str = "label") -> RidgeSolution:
    """One distributed Gram sum, one d x d solve."""
    m = class_moments(df, None, target=label, cross=True)[0.0]
    cov = m.covariance * m.n
    d = len(cov) - 1
    w = np.linalg.solve(cov[:d, :d] + alpha * np.eye(d), cov[:d, d])
    return RidgeSolution(w, float(m.mean[d] - m.mean[:d] @ w))
