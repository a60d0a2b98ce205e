"""RBF-kernel models by random Fourier features (Rahimi and Recht, 2007)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.models.newton import fit_hinge, fit_huber
from millrace.operators.moments import class_moments


class FourierMap:
    """cos(Wx + b) features whose inner product approaches exp(-gamma |x - y|^2)."""

    def __init__(self, d: int, gamma: float, size: int, seed: int):
        rng = np.random.default_rng(seed)
        self.w = rng.normal(0.0, np.sqrt(2 * gamma), (d, size))
        self.b = rng.uniform(0.0, 2 * np.pi, size)
        self.scale = np.sqrt(2.0 / size)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.scale * np.cos(x @ self.w + self.b)


def gamma_value(df: DataFrame, gamma: float | str) -> tuple[int, float]:
    """``scale`` is 1 / (d * variance of all entries), ``auto`` is 1 / d."""
    m = class_moments(df)[0.0]
    d = len(m.mean)
    if gamma == "auto":
        return d, 1.0 / d
    if gamma == "scale":
        overall = m.variance.mean() + m.mean.var()
        return d, 1.0 / (d * overall) if overall > 0 else 1.0
    return d, float(gamma)


class KernelModel:
    """A linear function of Fourier features; classifiers call class 1 above 0 and add its value as score. The features stay in the task."""

    def __init__(self, kind: str, weights: np.ndarray, intercept: float, d: int, gamma: float, size: int, seed: int):
        self.kind, self.weights, self.intercept = kind, np.asarray(weights, float), intercept
        self.d, self.gamma, self.size, self.seed = d, gamma, size, seed
        self.lift = FourierMap(d, gamma, size, seed)

    def numbers(self) -> dict:
        own = {"kind": self.kind, "weights": self.weights.tolist(), "intercept": self.intercept}
        return own | {"d": self.d, "gamma": self.gamma, "size": self.size, "seed": self.seed}

    def transform(self, rows: DataFrame) -> DataFrame:
        lift, weights, intercept = self.lift, self.weights, self.intercept

        @F.pandas_udf("double")
        def value(x: pd.Series) -> pd.Series:
            return pd.Series(lift(np.stack(x.to_numpy())) @ weights + intercept if len(x) else [], dtype=float)

        called = rows.withColumn("__value", value(vector_to_array("features")))
        if self.kind == "regressor":
            return called.withColumnRenamed("__value", "prediction")
        return called.withColumns({"prediction": (F.col("__value") > 0).cast("double"), "score": F.col("__value")}).drop("__value")


def fit_kernel_classifier(df: DataFrame, c: float = 1.0, gamma: float | str = "scale", size: int = 256, seed: int = 42) -> KernelModel:
    d, g = gamma_value(df, gamma)
    total = df.agg(F.sum("weight")).first()[0]
    return KernelModel("classifier", *fit_hinge(df, 1.0 / (c * total), FourierMap(d, g, size, seed)), d, g, size, seed)


def fit_kernel_regressor(df: DataFrame, c: float = 1.0, gamma: float | str = "scale", size: int = 256, seed: int = 42) -> KernelModel:
    d, g = gamma_value(df, gamma)
    return KernelModel("regressor", *fit_huber(df, 1.0 / (c * df.count()), FourierMap(d, g, size, seed)), d, g, size, seed)
