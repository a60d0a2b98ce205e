"""Gaussian models that need nothing but class moments: naive Bayes, linear and quadratic discriminants."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.moments import Moments, class_moments
from millrace.session import col


class LogDensityModel:
    """Per class a quadratic score  c + x.w + x A x; the greatest wins, the softmax is the probability.

    x counts from ``center``, so that features far from 0 lose no digits.
    ``diagonal`` holds A's diagonal (naive Bayes), ``full`` the whole matrix;
    a linear model has neither.
    """

    def __init__(self, classes, constant, linear, diagonal=None, full=None, center=0.0):
        self.classes = np.asarray(classes, float)
        self.constant, self.linear = np.asarray(constant, float), np.asarray(linear, float)
        self.diagonal = None if diagonal is None else np.asarray(diagonal, float)
        self.full = None if full is None else np.asarray(full, float)
        self.center = np.asarray(center, float)

    def scores(self, x: np.ndarray) -> np.ndarray:
        x = x - self.center
        out = x @ self.linear.T + self.constant
        if self.diagonal is not None:
            out = out + (x**2) @ self.diagonal.T
        if self.full is not None:
            out = out + np.stack([((x @ a) * x).sum(1) for a in self.full], axis=1)
        return out

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        model = self

        @F.pandas_udf("struct<prediction: double, score: double>")
        def evaluate(x: pd.Series) -> pd.DataFrame:
            if not len(x):
                return pd.DataFrame({"prediction": [], "score": []}, dtype=float)
            s = model.scores(np.stack(x.to_numpy()))
            best = model.classes[s.argmax(1)]
            e = np.exp(s - s.max(1, keepdims=True))
            positive = (e / e.sum(1, keepdims=True))[:, model.classes == 1.0].sum(1)
            return pd.DataFrame({"prediction": best, "score": positive})

        scored = df.withColumn("__s", evaluate(vector_to_array(col(features))))
        return scored.select(*[col(c) for c in df.columns], "__s.prediction", "__s.score")

    def to_dict(self) -> dict:
        return {
            k: None if v is None else v.tolist()
            for k, v in vars(self).items()
        }


def _pooled(moments: Mapping[float, Moments]) -> Moments:
    return reduce(lambda a, b: a + b, moments.values())


def bayes_from_moments(moments: Mapping[float, Moments], var_smoothing: float = 1e-9) -> LogDensityModel:
    """Naive Bayes whose variances are raised by ``var_smoothing`` times the largest overall variance."""
    classes = sorted(moments)
    whole = _pooled(moments)
    lift = var_smoothing * whole.variance.max()
    constant, linear, diagonal = [], [], []
    for c in classes:
        m = moments[c]
        var, mean = m.variance + lift, m.mean - whole.mean
        with np.errstate(divide="ignore"):
            prior = np.log(m.n / whole.n)
        constant.append(prior - 0.5 * np.sum(np.log(2 * np.pi * var)) - 0.5 * np.sum(mean**2 / var))
        linear.append(mean / var)
        diagonal.append(-0.5 / var)
    return LogDensityModel(classes, constant, linear, diagonal=diagonal, center=whole.mean)


def fit_naive_bayes(df: DataFrame, var_smoothing: float = 1e-9, label: str = "label") -> LogDensityModel:
    return bayes_from_moments(class_moments(df, label), var_smoothing)


def shrunk_covariances(df: DataFrame, moments: Mapping[float, Moments], label: str = "label") -> dict[float, np.ndarray]:
    """Each class's covariance under automatic shrinkage (Ledoit and Wolf, 2004).

    A class is standardised, its correlation matrix is pulled towards the identity by
    the share that the fourth moments ask for, and scaled back. One scan sums |z|^4 per class.
    """
    labels = sorted(moments)
    centres = np.stack([moments[c].mean for c in labels])
    scales = np.stack([scale_of(moments[c]) for c in labels])

    def fourth(batches):
        sums = np.zeros(len(labels))
        for batch in batches:
            if batch.empty:
                continue
            own = np.searchsorted(labels, batch["k"].to_numpy())
            z = (np.stack(batch["x"].to_numpy()) - centres[own]) / scales[own]
            sums += np.bincount(own, (z**2).sum(1) ** 2, len(labels))
        yield pd.DataFrame({"k": labels, "t": sums})

    rows = df.select(col(label).cast("double").alias("k"), vector_to_array("features").alias("x"))
    totals = {r["k"]: r["t"] for r in rows.mapInPandas(fourth, "k double, t double").groupBy("k").agg(F.sum("t").alias("t")).collect()}
    return shrunk_from(moments, totals)


def scale_of(m: Moments) -> np.ndarray:
    scale = np.sqrt(m.variance)
    scale[scale == 0] = 1.0
    return scale


def shrunk_from(moments: Mapping[float, Moments], totals: Mapping[float, float]) -> dict[float, np.ndarray]:
    """The shrunk covariances from the classes' moments and their sums of |z|^4."""
    out = {}
    for c, m in sorted(moments.items()):
        scale = scale_of(m)
        cov = m.covariance / np.outer(scale, scale)
        d = len(cov)
        mu = np.trace(cov) / d
        spread = (cov**2).sum() - d * mu**2
        noise = min((totals[c] / m.n - (cov**2).sum()) / m.n, spread)
        share = 0.0 if spread <= 0 else max(0.0, noise / spread)
        out[c] = ((1 - share) * cov + share * mu * np.eye(d)) * np.outer(scale, scale)
    return out


def fit_linear_discriminant(df: DataFrame, shrinkage: float | str | None = None, label: str = "label") -> LogDensityModel:
    """One covariance for all classes, the mean of the classes' own by their share of rows.

    A number pulls each class's covariance to a multiple of the identity; ``auto`` shrinks as
    :func:`shrunk_covariances` does.
    """
    moments = class_moments(df, label, cross=True)
    return discriminant_of(moments, shrinkage, shrunk_covariances(df, moments, label) if shrinkage == "auto" else None)


def discriminant_of(moments: Mapping[float, Moments], shrinkage: float | str | None, shrunk: Mapping[float, np.ndarray] | None = None) -> LogDensityModel:
    """The discriminant of class moments; ``shrunk`` are the covariances that ``auto`` asks for."""
    classes = sorted(moments)
    n = sum(m.n for m in moments.values())
    own = shrunk if shrinkage == "auto" else {c: moments[c].covariance for c in classes}
    pooled = sum(own[c] * moments[c].n for c in classes) / n
    if shrinkage and shrinkage != "auto":
        target = np.trace(pooled) / len(pooled) * np.eye(len(pooled))
        pooled = (1 - shrinkage) * pooled + shrinkage * target
    center = _pooled(moments).mean
    inverse = np.linalg.pinv(pooled, hermitian=True)
    linear = [inverse @ (moments[c].mean - center) for c in classes]
    constant = [-0.5 * (moments[c].mean - center) @ w + np.log(moments[c].n / n) for c, w in zip(classes, linear)]
    return LogDensityModel(classes, constant, linear, center=center)


def fit_quadratic_discriminant(df: DataFrame, reg_param: float = 0.01, label: str = "label") -> LogDensityModel:
    """One covariance per class with eigenvalues pulled towards 1 by ``reg_param``."""
    moments = class_moments(df, label, cross=True)
    classes = sorted(moments)
    n = sum(m.n for m in moments.values())
    center = _pooled(moments).mean
    constant, linear, full = [], [], []
    for c in classes:
        m = moments[c]
        cov = m.covariance * m.n / max(m.n - 1, 1)
        values, vectors = np.linalg.eigh(cov)
        values = (1 - reg_param) * np.maximum(values, 0.0) + reg_param
        inverse = (vectors / values) @ vectors.T
        w = inverse @ (m.mean - center)
        linear.append(w)
        full.append(-0.5 * inverse)
        constant.append(np.log(m.n / n) - 0.5 * np.log(values).sum() - 0.5 * (m.mean - center) @ w)
    return LogDensityModel(classes, constant, linear, full=full, center=center)


# --- the same model on named columns, as plain expressions ------------------------------------------------


def class_statistics(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """Per class and column: rows, mean, population variance (long form)."""
    per = df.groupBy(col(label)).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.avg(col(c)).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.var_pop(col(c)).alias(f"v{i}") for i, c in enumerate(columns)],
    )
    rows = [
        F.struct(F.lit(c).alias("feature"), F.col("__n").alias("n"), F.col(f"m{i}").alias("mean"), F.col(f"v{i}").alias("variance"))
        for i, c in enumerate(columns)
    ]
    return per.select(col(label), F.inline(F.array(*rows)))


def score_naive_bayes(df: DataFrame, label: str, columns: Sequence[str], var_smoothing: float = 1e-9) -> DataFrame:
    """Fit on named columns and add ``prediction`` and ``score`` without leaving code generation."""
    stats = class_statistics(df, label, columns).collect()
    overall = df.agg(*[F.var_pop(col(c)).alias(f"v{i}") for i, c in enumerate(columns)]).first()
    lift = var_smoothing * max(overall)
    classes = sorted({r[label] for r in stats})
    total = sum(r["n"] for r in stats if r["feature"] == columns[0])
    logs = []
    for k in classes:
        mine = {r["feature"]: r for r in stats if r[label] == k}
        value = F.lit(float(np.log(mine[columns[0]]["n"] / total)))
        for c in columns:
            var = mine[c]["variance"] + lift
            gap = col(c) - F.lit(mine[c]["mean"])
            value = value - F.lit(float(0.5 * np.log(2 * np.pi * var))) - gap * gap / F.lit(2 * var)
        logs.append(value)
    top = F.greatest(*logs)
    best = F.lit(classes[-1])
    for k, value in reversed(list(zip(classes, logs))):
        best = F.when(value == top, F.lit(k)).otherwise(best)
    positive = F.exp(logs[classes.index(1)] - top) if 1 in classes else F.lit(0.0)
    whole = reduce(lambda a, b: a + b, [F.exp(v - top) for v in logs])
    return df.withColumns({"prediction": best, "score": positive / whole})


def smoothing_sweep(
    df: DataFrame, values: Sequence[float], fold: str, held: Sequence[int], label: str = "label"
) -> DataFrame:
    """Confusion counts per smoothing value and held-out fold: one pass of moments, one of scoring.

    Class statistics do not depend on the smoothing, so a fold's training
    moments are the totals minus its own, and every value is scored in the
    same scan; tasks hand back counts only.
    """
    held = [int(f) for f in held]
    labels = sorted(float(r[0]) for r in df.select(col(label)).distinct().collect())  # one row per class
    if not set(labels) <= {0.0, 1.0}:
        raise ValueError("confusion counts need labels 0 and 1")
    by_part = class_moments(df.withColumn("__part", col(fold) * 2 + col(label)), "__part")
    models = {}
    for f in held:
        train: dict[float, Moments] = {}
        for key, m in by_part.items():
            if int(key) // 2 != f:
                c = float(int(key) % 2)
                train[c] = train[c] + m if c in train else m
        models[f] = [bayes_from_moments(train, v) for v in values]

    def count(batches):
        sums = {f: np.zeros((len(values), 4)) for f in held}
        for batch in batches:
            if batch.empty:
                continue
            x, y, parts = np.stack(batch["x"].to_numpy()), batch["y"].to_numpy(), batch["f"].to_numpy()
            for f in np.unique(parts):
                rows = parts == f
                for j, model in enumerate(models[int(f)]):
                    called = model.classes[model.scores(x[rows]).argmax(1)]
                    sums[int(f)][j] += np.bincount((2 * y[rows] + called).astype(int), minlength=4)
        for f, block in sums.items():
            yield pd.DataFrame(
                {"fold": f, "trial": range(len(block)), "tn": block[:, 0], "fp": block[:, 1], "fn": block[:, 2], "tp": block[:, 3]}
            )

    rows = df.where(col(fold).isin(held)).select(
        vector_to_array("features").alias("x"), col(label).cast("double").alias("y"), col(fold).cast("int").alias("f")
    )
    counts = rows.mapInPandas(count, "fold int, trial int, tn double, fp double, fn double, tp double")
    counts = counts.groupBy("trial", "fold").agg(*[F.sum(c).alias(c) for c in ("tn", "fp", "fn", "tp")])
    return counts.withColumn("var_smoothing", F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col("trial") + 1))
