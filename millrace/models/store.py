"""Save and load any fitted candidate together with its vectoriser, as tables and Spark ML folders.

``parameters`` holds one row: the version of the layout, the kind of model, its numbers and the columns that it was fitted
on. Models that are more than numbers have folders beside it: Spark ML models, a list of trees, or the tree of the known points.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession

from millrace.models.batch import LinearCall
from millrace.models.boost import BoostedClassifier, BoostedRegressor, CellBooster
from millrace.models.candidates import Apply, Constant, keep_result_columns
from millrace.models.forest import ForestModel
from millrace.models.gaussian import LogDensityModel
from millrace.models.histogram import HistModel
from millrace.models.kernel import KernelModel
from millrace.models.linear import RidgeSolution
from millrace.models.neighbours import NeighbourModel
from millrace.sources.tables import load_model, save_model

VERSION = 3


def _save_all(models, path: str) -> None:
    for i, model in enumerate(models):
        model.write().overwrite().save(f"{path}/{i}")


def _load_all(spark: SparkSession, path: str, n: int) -> list:
    return [DefaultParamsReader.loadParamsInstance(f"{path}/{i}", spark.sparkContext) for i in range(n)]


def _save_trees(m, path: str) -> dict:
    _save_all(m.trees, f"{path}/trees")
    return {"weights": [float(v) for v in (m.alphas if isinstance(m, BoostedClassifier) else m.powers)]}


def _load_trees(kind):
    return lambda spark, path, v: kind(_load_all(spark, f"{path}/trees", len(v["weights"])), v["weights"])


#: Kind: (class, save(model, path) -> numbers, load(spark, path, numbers) -> model).
_KINDS: dict[str, tuple[type, Callable, Callable]] = {
    "gaussian": (LogDensityModel, lambda m, _: m.to_dict(), lambda _, __, v: LogDensityModel(**v)),
    "cell_booster": (CellBooster, lambda m, _: m.to_dict(), lambda _, __, v: CellBooster.from_dict(v)),
    "forest": (ForestModel, lambda m, _: m.to_dict(), lambda _, __, v: ForestModel.from_dict(v)),
    "histogram": (HistModel, lambda m, _: m.to_dict(), lambda _, __, v: HistModel.from_dict(v)),
    "linear_call": (LinearCall, lambda m, _: {"weights": m.weights.tolist(), "intercept": m.intercept, "margin": m.margin}, lambda _, __, v: LinearCall(**_array(v))),
    "ridge": (RidgeSolution, lambda m, _: {"weights": m.weights.tolist(), "intercept": m.intercept}, lambda _, __, v: RidgeSolution(**_array(v))),
    "constant": (Constant, lambda m, _: vars(m), lambda _, __, v: Constant(**v)),
    "neighbours": (NeighbourModel, lambda m, path: m.save(path), NeighbourModel.load),
    "boosted_classifier": (BoostedClassifier, _save_trees, _load_trees(BoostedClassifier)),
    "boosted_regressor": (BoostedRegressor, _save_trees, _load_trees(BoostedRegressor)),
    "kernel": (KernelModel, lambda m, _: m.numbers(), lambda _, __, v: KernelModel(**_array(v))),
}


def _array(values: dict) -> dict:
    import numpy as np

    return {**values, "weights": np.array(values["weights"])}


def save_fitted(apply: Apply, vectorizer: PipelineModel, path: str, fitted_on: DataFrame | None = None) -> None:
    """Write a fitted candidate; ``fitted_on`` (raw rows) records the columns that later rows must have.

    An object of no known kind raises ValueError.
    """
    spark = SparkSession.getActiveSession()
    model, owner = getattr(apply, "model", None), getattr(apply, "__self__", None)
    if model is not None:
        save_model(PipelineModel([*vectorizer.stages, model]), f"{path}/pipeline")
        kind, values = "spark", {}
    else:
        kind = next((name for name, (cls, _, _) in _KINDS.items() if type(owner) is cls), None)
        if kind is None:
            raise ValueError(f"no saved form for {owner if owner is not None else apply!r}")
        save_model(vectorizer, f"{path}/pipeline")
        values = _KINDS[kind][1](owner, path)
    columns = [] if fitted_on is None else [[n, t] for n, t in fitted_on.dtypes]
    row = spark.createDataFrame([(VERSION, kind, json.dumps(values), json.dumps(columns))], "version int, kind string, parameters string, columns string")
    row.coalesce(1).write.mode("overwrite").parquet(f"{path}/parameters")


def load_fitted(spark: SparkSession, path: str) -> Callable[[DataFrame], DataFrame]:
    """A function that vectorises and scores raw rows.

    Raises ValueError for a folder of another version, and, when called, for rows that lack a column the
    model was fitted on or hold it in another type.
    """
    row = spark.read.parquet(f"{path}/parameters").first().asDict()
    if row.get("version") != VERSION:
        raise ValueError(f"{path} has version {row.get('version')}, this library reads {VERSION}")
    pipeline, columns = load_model(f"{path}/pipeline"), json.loads(row["columns"])
    values: dict[str, Any] = json.loads(row["parameters"])
    model = None if row["kind"] == "spark" else _KINDS[row["kind"]][2](spark, path, values)

    def score(rows: DataFrame) -> DataFrame:
        there = dict(rows.dtypes)
        wrong = [f"{n} {t}" for n, t in columns if there.get(n) != t]
        if wrong:
            raise ValueError(f"rows lack columns of the fitted table: {', '.join(wrong)}")
        ready = pipeline.transform(rows)
        if model is None:
            return keep_result_columns(ready, rows.columns)
        scored = model.transform(ready)
        return scored.select(*rows.columns, "prediction", *(["score"] if "score" in scored.columns else []))

    return score
