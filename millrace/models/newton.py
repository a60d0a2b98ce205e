"""Newton passes for hinge and Huber losses: a pass sums loss, gradient and Hessian, and the rows are never widened outside a task.

A feature map (``lift``) is applied to a batch at a time inside the task, so a fit on hundreds of random features keeps only the
given columns. The driver sees one d x d sum per pass.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.models.batch import _summed
from millrace.session import stage

#: Widths over which the hinge is rounded, each fit starting at the one before; at the first every row bends at the start, where all scores are 0.
WIDTHS = (4.0, 1.0, 0.3, 0.1, 0.03, 0.01)
PASSES = 100
SETTLED = 1e-9
HUBER = 1.35

Lift = Callable[[np.ndarray], np.ndarray]


class _Descent:
    """Damped Newton steps for a convex goal: a step that does not lower it is halved."""

    def __init__(self, start: np.ndarray, l2: np.ndarray, positive: bool = False):
        self.v, self.l2, self.positive, self.goal, self.step, self.done = start, l2, positive, np.inf, np.zeros(len(start)), False

    @property
    def best(self) -> np.ndarray:
        return self.v - self.step

    def advance(self, loss: float, g: np.ndarray, h: np.ndarray) -> None:
        goal = loss + 0.5 * (self.l2 * self.v**2).sum()
        if goal > self.goal:
            self.step = self.step / 2
            self.v = self.v - self.step
            self.done = bool(np.abs(self.step).max() < SETTLED * (1 + np.abs(self.v).max()))
            return
        gained, self.goal = self.goal - goal, goal
        slope, bend = g + self.l2 * self.v, h + np.diag(self.l2)
        scale = max(float(np.diag(bend).max()), 1e-12)
        step = -np.linalg.solve(bend + 1e-9 * scale * np.eye(len(slope)), slope)
        if self.positive and step[-1] < -0.9 * self.v[-1]:
            step = step * (-0.9 * self.v[-1] / step[-1])
        # the decrease that the step promises, or what the last one brought, no longer counts
        self.done = bool(-(slope @ step) < SETTLED * (1 + abs(goal)) or gained < SETTLED * (1 + abs(goal)))
        self.step = np.zeros(len(step)) if self.done else step
        self.v = self.v + self.step


def _rows(train: DataFrame, binary: bool) -> DataFrame:
    """(part, x, y, w) written once; a null, infinite or wrong label, feature or weight fails the job."""

    def sure(value, good, name):
        return F.when(good, value).otherwise(F.raise_error(F.lit(f"{name} must not be null, NaN, infinite or out of range")))

    def finite(v):
        return F.coalesce(F.abs(v) < float("inf"), F.lit(False))  # NaN is above infinity

    x, y = vector_to_array("features"), F.col("label").cast("double")
    w = F.col("weight").cast("double") if "weight" in train.columns else F.lit(1.0)
    return stage(
        train.select(
            F.lit(0).alias("part"),
            sure(x, F.coalesce(F.forall(x, finite), F.lit(False)), "features").alias("x"),
            sure(y, finite(y) & (y.isin(0.0, 1.0) if binary else F.lit(True)), "labels").alias("y"),
            sure(w, finite(w) & (w >= 0), "weights").alias("w"),
        ),
        "newton-rows",
    )


def _descend(rows: DataFrame, total: float, fit: _Descent, sums) -> np.ndarray:
    """``sums(x, y, w, v)`` gives (loss, gradient, Hessian) of a batch."""
    n = len(fit.v)
    for _ in range(PASSES):

        def make(_, x, y, w, v=fit.v):
            loss, g, h = sums(x, y, w, v)
            return np.concatenate([[loss], g, h.ravel()])

        (block,) = _summed(rows, 1, make)
        fit.advance(block[0] / total, block[1 : n + 1] / total, block[n + 1 :].reshape(n, n) / total)
        if fit.done:
            break
    return fit.best


def _bent(z: np.ndarray, bend: np.ndarray) -> np.ndarray:
    """Sum of bend z z', from the rows that bend."""
    some = np.flatnonzero(bend)
    return z[some].T @ (z[some] * bend[some, None])


def fit_hinge(train: DataFrame, l2: float, lift: Lift | None = None) -> tuple[np.ndarray, float]:
    """Weights and intercept of the least mean hinge loss plus l2 / 2 |w|^2 on a table (features, label 0 or 1[, weight])."""
    rows = _rows(train, True)
    first, total = rows.select("x").first(), rows.agg(F.sum("w")).first()[0]
    if first is None:
        raise ValueError("no training rows")
    lift = lift or (lambda x: x)
    d = lift(np.array([first.x])).shape[1]
    v, l2s = np.zeros(d + 1), np.append(np.full(d, l2), 0.0)
    for width in WIDTHS:

        def sums(x, y, w, v, width=width):
            z = np.column_stack([lift(x), np.ones(len(x))])
            side = 2 * y - 1
            short = 1 - side * (z @ v) + width / 2
            inner = (short > 0) & (short < width)
            loss = np.where(inner, short**2 / (2 * width), np.maximum(short - width / 2, 0.0))
            return w @ loss, z.T @ (-w * side * np.clip(short / width, 0, 1)), _bent(z, np.where(inner, w / width, 0.0))

        v = _descend(rows, total, _Descent(v, l2s), sums)
    return v[:-1], float(v[-1])


def fit_huber(train: DataFrame, l2: float, lift: Lift | None = None) -> tuple[np.ndarray, float]:
    """Weights and intercept of the least mean Huber loss (Owen's, with its scale fitted along) plus l2 / 2 |w|^2; rows count alike."""
    rows = _rows(train.drop("weight"), False)
    first, r = rows.select("x").first(), rows.agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("mean"), F.stddev_pop("y").alias("spread")).first()
    if first is None:
        raise ValueError("no training rows")
    lift = lift or (lambda x: x)
    d = lift(np.array([first.x])).shape[1]
    if not r.spread:
        return np.zeros(d), float(r.mean)

    def sums(x, y, w, v):
        z, scale = np.column_stack([lift(x), np.ones(len(x))]), v[-1]
        gap = y - z @ v[:-1]
        u = np.column_stack([z, gap / scale])
        inner = np.abs(gap) <= HUBER * scale
        loss = np.where(inner, scale + gap**2 / scale, scale + 2 * HUBER * np.abs(gap) - scale * HUBER**2) / 2
        pull = np.where(inner, gap / scale, HUBER * np.sign(gap))
        by_scale = np.where(inner, 1 - (gap / scale) ** 2, 1 - HUBER**2) / 2
        return w @ loss, np.append(-(z.T @ (w * pull)), w @ by_scale), _bent(u, np.where(inner, w / scale, 0.0))

    start = np.concatenate([np.zeros(d), [r.mean, r.spread]])
    v = _descend(rows, float(r.n), _Descent(start, np.append(np.full(d, l2), [0.0, 0.0]), positive=True), sums)
    return v[:-2], float(v[-2])
