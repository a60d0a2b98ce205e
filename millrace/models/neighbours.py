"""k nearest neighbours as a fitted model: the references' tree is grown once and serves every later table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.join import left_join_unique
from millrace.operators.nearest import as_points, average, known_points, nearest_neighbours, numbered, vote
from millrace.operators.tree import MetricTree

_COMBINE = {"vote": vote, "average": average}


@dataclass
class NeighbourModel:
    """``how`` is ``vote`` (prediction and score) or ``average`` (prediction); ``key`` names each scored row."""

    tree: MetricTree
    k: int
    weights: str
    how: str
    key: str

    def transform(self, rows: DataFrame) -> DataFrame:
        points = as_points(rows, self.key, "features")
        found = nearest_neighbours(points, points, self.k, self.tree.p, tree=self.tree)
        called = _COMBINE[self.how](found, self.weights).drop("row").withColumnRenamed("id", self.key)
        return left_join_unique(rows, called, self.key, check=False)

    def save(self, path: str) -> dict:
        self.tree.save(f"{path}/tree")
        return {"k": self.k, "p": self.tree.p, "weights": self.weights, "how": self.how, "key": self.key}

    @staticmethod
    def load(spark: SparkSession, path: str, values: dict) -> NeighbourModel:
        p = values.pop("p")
        return NeighbourModel(MetricTree.load(spark, f"{path}/tree", p), **values)


def fit_neighbours(train: DataFrame, k: int, p: int, weights: str, how: str, key: str) -> NeighbourModel:
    refs = numbered(as_points(train, key, "features", "label"), "neighbour-refs")
    return NeighbourModel(known_points(refs, k, p), k, weights, how, key)
