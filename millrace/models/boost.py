"""Boosting: rounds of trees over sums per cell of binned rows, or of weighted Spark trees where rows lie in too many cells.

Rows of a cell and class keep equal weights, and squared errors are sums per cell up to a constant, so rounds over cells are rounds over rows. One task
makes all rounds, as each needs the one before, from at most ``forest.CELLS`` sums.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.models import cells
from millrace.models.cells import Grid
from millrace.models.forest import BinTree, gridded, grow
from millrace.session import cut_lineage

CUT_EVERY = 5


def _next(current: DataFrame, rows: DataFrame, r: int) -> DataFrame:
    """The rows of the next round, made once; those of this round are let go."""
    rows = (cut_lineage(rows) if (r + 1) % CUT_EVERY == 0 else rows).persist()  # a tree reads them several times
    rows.agg(F.count("__w")).first()
    current.unpersist()
    return rows


@dataclass
class CellBooster:
    """The weighted sum of trees over cells; with ``classes`` a vote of their calls, else a value."""

    grid: Grid
    classes: bool
    trees: list[BinTree]
    weights: list[float]

    def transform(self, df: DataFrame) -> DataFrame:
        model = self

        def total(bins: np.ndarray) -> np.ndarray:
            calls = ((_vote(t.score(bins)) if model.classes else t.score(bins)) * w for t, w in zip(model.trees, model.weights, strict=True))
            return sum(calls) / ((sum(model.weights) or 1.0) if model.classes else 1.0)

        found = cells.by_cell(self.grid, total)
        if not self.classes:
            return df.withColumn("prediction", found)
        scored = df.withColumn("__margin", found)
        return scored.select(*df.columns, (F.col("__margin") > 0).cast("double").alias("prediction"), (1 / (1 + F.exp(-2 * F.col("__margin")))).alias("score"))

    def to_dict(self) -> dict:
        return {"edges": [e.tolist() for e in self.grid.edges], "classes": self.classes, "trees": [t.to_dict() for t in self.trees], "weights": self.weights}

    @staticmethod
    def from_dict(d: dict) -> CellBooster:
        return CellBooster(Grid([np.array(e, float) for e in d["edges"]]), d["classes"], [BinTree.of(**t) for t in d["trees"]], d["weights"])


def _vote(share: np.ndarray) -> np.ndarray:
    return np.where(share > 0.5, 1.0, -1.0)


def _adaptive(bins, n, s, sizes, rounds: int, learning_rate: float, max_depth: int):
    """(tree, weight) of each round; ``s`` are the cells' rows of class 1."""
    rows, w, made = np.stack([n - s, s]), np.ones((2, len(n))), []
    for _ in range(rounds):
        each = rows * w
        both = each.sum(0)
        share = each[1].sum() / both.sum()
        tree = grow(bins, both, each[1] - share * both, sizes, max_depth)
        tree.value = tree.value + share
        called = tree.score(bins) > 0.5
        wrong = np.stack([called, ~called])
        total = each.sum()
        error = each[wrong].sum() / total
        if error <= 0:
            return [(tree, 1.0)]
        if error >= 0.5:
            return made or [(tree, 1.0)]
        alpha = learning_rate * math.log((1 - error) / error)
        made.append((tree, alpha))
        grown = total * (1 - error) + total * error * math.exp(alpha)
        w = w * np.where(wrong, math.exp(alpha), 1.0) * (total / grown)
    return made


def _descending(bins, n, s, sizes, rounds: int, learning_rate: float, max_depth: int, least: int):
    """(tree, weight) of each round: the labels first, then what is left of them by the slope of their squared error, as Spark does."""
    made, score = [], np.zeros(len(n))
    for r in range(rounds):
        tree = grow(bins, n, 2 * (s - n * score) if r else s, sizes, max_depth, least)
        made.append((tree, learning_rate if r else 1.0))
        score = score + made[-1][1] * tree.score(bins)
    return made


_MADE = "feature binary, bin binary, left binary, value binary, weight double, round int"


def _fit_cells(df: DataFrame, classes: bool, fit: Callable, seed: int = 42) -> CellBooster | None:
    """``fit(bins, n, s, sizes)`` over the rows and label sums of all cells; None where ``gridded`` gives none."""
    found = gridded(df, classes, seed)
    if found is None:
        return None
    grid, held, _, _ = found
    base = 0.0 if classes else found[3]

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("cell")
        n, s = (table.column(c).to_numpy() for c in ("n", "s"))
        made = fit(grid.bins(table.column("cell").to_numpy()), n, s, grid.sizes)
        rows = [(*(v.tobytes() for v in vars(tree).values()), float(weight), i) for i, (tree, weight) in enumerate(made)]
        kinds = (*[pa.binary()] * 4, pa.float64(), pa.int32())
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["feature", "bin", "left", "value", "weight", "round"])

    sums = held.groupBy("cell").agg(F.count("y").cast("double").alias("n"), F.sum(F.col("y") - F.lit(base)).alias("s"))
    rows = sorted(sums.groupBy(F.lit(0).alias("all")).applyInArrow(run, _MADE).collect(), key=lambda r: r["round"])  # a row per tree
    trees = [BinTree(*(np.frombuffer(r[c], k).copy() for c, k in (("feature", np.uint16), ("bin", np.uint8), ("left", np.int32), ("value", float)))) for r in rows]
    if base:
        trees[0].value += base
    return CellBooster(grid, classes, trees, [r["weight"] for r in rows])


def fit_gradient_boosting(df: DataFrame, rounds: int, learning_rate: float, max_depth: int, least: int = 1, seed: int = 42) -> CellBooster | None:
    """Squared-error boosting as Spark's: the first tree counts whole, the others fit twice the residuals and are shrunken. None where ``gridded`` gives none."""
    return _fit_cells(df, False, lambda *sums: _descending(*sums, rounds, learning_rate, max_depth, least), seed)


class BoostedClassifier:
    def __init__(self, trees, alphas):
        self.trees, self.alphas = trees, alphas

    def transform(self, df: DataFrame) -> DataFrame:
        names = df.columns
        total = F.lit(0.0)
        for i, (tree, alpha) in enumerate(zip(self.trees, self.alphas)):
            df = tree.setPredictionCol(f"__t{i}").setRawPredictionCol("").setProbabilityCol("").transform(df)
            total = total + F.lit(alpha) * (2 * F.col(f"__t{i}") - 1)
        scale = sum(self.alphas) or 1.0
        df = df.withColumn("__margin", total / F.lit(scale))
        return df.select(
            *names,
            (F.col("__margin") > 0).cast("double").alias("prediction"),
            (1 / (1 + F.exp(-2 * F.col("__margin")))).alias("score"),
        )


def fit_adaboost(df: DataFrame, rounds: int = 100, learning_rate: float = 1.0, max_depth: int = 1) -> CellBooster | BoostedClassifier:
    """Discrete two-class boosting (Freund and Schapire): trees on re-weighted rows."""
    model = _fit_cells(df, True, lambda *sums: _adaptive(*sums, rounds, learning_rate, max_depth))
    if model:
        return model
    current = cut_lineage(df.select("features", "label", F.lit(1.0).alias("__w"))).persist()
    trees, alphas = [], []
    for r in range(rounds):
        tree = DecisionTreeClassifier(maxDepth=max_depth, weightCol="__w", seed=r, predictionCol="__p").fit(current)
        called = tree.transform(current).select("features", "label", "__w", "__p")
        wrong = F.col("__p") != F.col("label")
        row = called.agg(F.sum(F.when(wrong, F.col("__w")).otherwise(0.0)).alias("e"), F.sum("__w").alias("t")).first()
        error = (row["e"] or 0.0) / row["t"]
        if error <= 0:
            current.unpersist()
            return BoostedClassifier([tree], [1.0])
        if error >= 0.5:
            if not trees:
                trees, alphas = [tree], [1.0]
            break
        alpha = learning_rate * math.log((1 - error) / error)
        trees.append(tree)
        alphas.append(alpha)
        # Weights are kept at mean 1, whatever the number of rounds.
        grown = row["t"] * (1 - error) + row["t"] * error * math.exp(alpha)
        lift = F.when(wrong, F.lit(math.exp(alpha))).otherwise(1.0) * F.lit(row["t"] / grown)
        current = _next(current, called.select("features", "label", (F.col("__w") * lift).alias("__w")), r)
    current.unpersist()
    return BoostedClassifier(trees, alphas)


class BoostedRegressor:
    def __init__(self, trees, powers):
        self.trees, self.powers = trees, powers

    def transform(self, df: DataFrame) -> DataFrame:
        names, powers = df.columns, np.array(self.powers)
        for i, tree in enumerate(self.trees):
            df = tree.setPredictionCol(f"__t{i}").transform(df)

        @F.pandas_udf("double")
        def weighted_median(values: pd.Series) -> pd.Series:
            if not len(values):
                return pd.Series([], dtype=float)
            v = np.stack(values.to_numpy())
            order = v.argsort(1)
            reached = np.cumsum(powers[order], axis=1)
            pick = (reached >= 0.5 * reached[:, -1:]).argmax(1)
            here = np.arange(len(v))
            return pd.Series(v[here, order[here, pick]])

        voted = weighted_median(F.array(*[F.col(f"__t{i}") for i in range(len(self.trees))]))
        return df.select(*names, voted.alias("prediction"))


def fit_adaboost_regressor(df: DataFrame, rounds: int = 100, learning_rate: float = 1.0, max_depth: int = 3) -> BoostedRegressor:
    """AdaBoost.R2 (Drucker, 1997) with linear loss; weights enter the trees instead of resampling."""
    current = cut_lineage(df.select("features", "label", F.lit(1.0).alias("__w"))).persist()
    trees, powers = [], []
    for r in range(rounds):
        tree = DecisionTreeRegressor(maxDepth=max_depth, weightCol="__w", seed=r, predictionCol="__p").fit(current)
        called = tree.transform(current).withColumn("__gap", F.abs(F.col("__p") - F.col("label")))
        called = called.select("features", "label", "__w", "__gap")
        row = called.agg(F.max("__gap").alias("m"), F.sum("__w").alias("t"), F.sum(F.col("__w") * F.col("__gap")).alias("s")).first()
        if row["m"] <= 0:
            current.unpersist()
            return BoostedRegressor([tree], [1.0])
        loss = row["s"] / row["t"] / row["m"]
        if loss >= 0.5:
            if not trees:
                trees, powers = [tree], [1.0]
            break
        beta = loss / (1 - loss)
        trees.append(tree)
        powers.append(learning_rate * math.log(1 / beta))
        factor = F.pow(F.lit(beta), (1 - F.col("__gap") / F.lit(row["m"])) * F.lit(learning_rate))
        raised = called.select("features", "label", (F.col("__w") * factor).alias("__w"))
        mean = raised.agg(F.avg("__w")).first()[0]
        current = _next(current, raised.withColumn("__w", F.col("__w") / F.lit(mean)), r)
    current.unpersist()
    return BoostedRegressor(trees, powers)
