"""Cross-validated comparison, hyperparameter search and final choice."""

from __future__ import annotations

import itertools
import json
import random
import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property, reduce
from typing import Any

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.models import batch, candidates, gaussian
from millrace.models.candidates import ROW_ID
from millrace.operators import folds, metrics, vectorize
from millrace.session import col, cut_lineage, stage

CLASSIFICATION, REGRESSION = "clasificacion", "regresion"
_METRICS = {
    CLASSIFICATION: ("accuracy", "precision", "recall", "f1", "roc_auc"),
    REGRESSION: ("mae", "mse", "rmse", "r2"),
}
_COUNTS = ("tn", "fp", "fn", "tp")
_MAIN = {CLASSIFICATION: "f1", REGRESSION: "mae"}
_SCORING = {CLASSIFICATION: "f1", REGRESSION: "neg_mean_absolute_error"}


@dataclass
class FoldInput:
    """One assembled table per fold: features from the other folds' statistics, weights from their classes."""

    kind: str
    k: int
    parts: list[DataFrame]

    @cached_property
    def blocks(self) -> batch.Blocks:
        """The rows of all parts packed for the fits that share scans; written once."""
        return batch.pack(self.parts)

    def split(self, i: int) -> tuple[DataFrame, DataFrame]:
        part = self.parts[i]
        return part.where(F.col("fold") != i), part.where(F.col("fold") == i)


def fold_input(
    df: DataFrame, kind: str, target: str, key: str, numeric: Sequence[str], categorical: Sequence[str], k: int = 5, seed: int = 42
) -> FoldInput:
    """Assign folds and fit every fold's preprocessing in a few shared jobs.

    The assembled tables are read by every candidate, so each is written once:
    later plans start from files instead of dragging the whole history along.
    """
    rows = df.withColumns({ROW_ID: col(key).cast("bigint"), "label": col(target).cast("double")})
    rows = stage(rows.select(*[col(c) for c in dict.fromkeys([ROW_ID, "label", *numeric, *categorical])]), "fold-input")
    if kind == CLASSIFICATION:
        rows = folds.stratified_folds(rows, "label", [ROW_ID], k, seed)
    else:
        rows = folds.hashed_folds(rows, [ROW_ID], k, seed)
    rows = stage(rows, "fold-rows")
    vectorizers = vectorize.fit_fold_vectorizers(rows, "fold", k, numeric, categorical)
    weights = [F.lit(1.0)] * k
    if kind == CLASSIFICATION:
        counted = rows.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n")).collect()
        weights = [_fold_weight([r for r in counted if r["fold"] != i]) for i in range(k)]
    parts = [
        stage(v.transform(rows).select(ROW_ID, "features", "label", w.alias("weight"), "fold"), "fold-part")
        for v, w in zip(vectorizers, weights)
    ]
    return FoldInput(kind, k, parts)


def _fold_weight(counted):
    sizes: dict[float, int] = {}
    for r in counted:
        sizes[r["label"]] = sizes.get(r["label"], 0) + r["n"]
    total = sum(sizes.values())
    weight = F.lit(1.0)
    for label, n in sizes.items():
        weight = F.when(F.col("label") == label, F.lit(total / (len(sizes) * n))).otherwise(weight)
    return weight


def evaluate(predictions: DataFrame, kind: str, by: Sequence[str] = ()) -> list[dict[str, Any]]:
    """Metric rows per group of a prediction table (label, prediction, score)."""
    if kind == REGRESSION:
        rows = metrics.regression_errors(predictions, "label", "prediction", by).collect()
        return [r.asDict() for r in rows]
    counts = metrics.with_rates(metrics.confusion(predictions, "label", "prediction", by)).collect()
    areas = {}
    if "score" in predictions.columns:
        for r in metrics.roc_auc(predictions, "label", "score", by).collect():
            areas[tuple(r[c] for c in by)] = r["roc_auc"]
    return [{**r.asDict(), "roc_auc": areas.get(tuple(r[c] for c in by))} for r in counts]


def fold_scores(data: FoldInput, fit: candidates.Fit, parallelism: int = 4) -> list[dict[str, Any]]:
    """Fit on every fold's complement; all predictions are evaluated together, grouped by fold."""

    def one(i: int) -> DataFrame:
        train, test = data.split(i)
        out = fit(train)(test)
        keep = ["fold", "label", "prediction"] + (["score"] if "score" in out.columns else [])
        return out.select(*keep)

    with ThreadPoolExecutor(parallelism) as pool:
        predicted = list(pool.map(one, range(data.k)))
    return evaluate(cut_lineage(reduce(lambda a, b: a.unionByName(b), predicted)), data.kind, ["fold"])


def cross_validate(data: FoldInput, name: str, params: Mapping[str, Any] | None = None, parallelism: int = 4) -> dict[str, Any]:
    """Mean and population deviation of each metric over folds; a failing model becomes a row with its error."""
    start = time.time()
    row: dict[str, Any] = {"modelo": name, "error": None}
    try:
        scores = fold_scores(data, candidates.build(name, params), parallelism)
        for m in _METRICS[data.kind]:
            values = [s[m] for s in scores if s[m] is not None]
            row[m] = round(float(np.mean(values)), 4) if values else None
            row[f"{m}_std"] = round(float(np.std(values)), 4) if values else None
    except Exception as exc:  # a broken candidate must not end the comparison
        row["error"] = str(exc)[:120]
    row["tiempo_seg"] = round(time.time() - start, 2)
    return row


def ranking_schema(kind: str) -> T.StructType:
    fields = [("modelo", T.StringType()), ("error", T.StringType()), ("tiempo_seg", T.DoubleType())]
    for m in _METRICS[kind]:
        fields += [(m, T.DoubleType()), (f"{m}_std", T.DoubleType())]
    return T.StructType([T.StructField(n, t) for n, t in fields])


def _frame(spark, rows: Sequence[Mapping[str, Any]], schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def rank_models(
    data: FoldInput, names: Sequence[str], overrides: Mapping[str, Mapping[str, Any]] | None = None, parallelism: int = 4
) -> DataFrame:
    """Ranking of all candidates, F1 descending or MAE ascending."""
    rows = [cross_validate(data, n, (overrides or {}).get(n), parallelism) for n in names]
    table = _frame(data.parts[0].sparkSession, rows, ranking_schema(data.kind))
    return metrics.ranked(table, _MAIN[data.kind], smaller_is_better=data.kind == REGRESSION)


def pick_finalists(ranking: DataFrame, supported: Sequence[str], metric: str, smaller_is_better: bool, n: int = 3) -> list[str]:
    """Best n supported models without error or baseline, filled up in listed order."""
    usable = ranking.where(F.col("error").isNull() & ~F.col("modelo").contains("Dummy") & F.col("modelo").isin(list(supported)))
    order = F.col(metric).asc_nulls_last() if smaller_is_better else F.col(metric).desc_nulls_last()
    chosen = [r["modelo"] for r in usable.select("modelo", metric).distinct().orderBy(order, "modelo").limit(n).collect()]
    return chosen + [m for m in supported if m not in chosen][: n - len(chosen)]


def combinations(space: Mapping[str, Sequence[Any]]) -> list[dict[str, Any]]:
    names = sorted(space)
    return [dict(zip(names, values)) for values in itertools.product(*[space[n] for n in names])]


def params_json(params: Mapping[str, Any]) -> str:
    """Parameters as sorted JSON text."""
    return json.dumps({f"modelo__{k}": v for k, v in params.items()}, ensure_ascii=False, default=str, sort_keys=True)


def search(
    data: FoldInput, name: str, trials: Sequence[Mapping[str, Any]], parallelism: int = 4
) -> tuple[dict[str, Any], float]:
    """Best parameters by mean fold score; a trial that fails counts as missing.

    Linear models, the linear discriminant and naive Bayes score all trials and folds in shared scans, others are fitted one by one.
    """
    return search_each(data, name, [trials], parallelism)[0]


def search_each(
    data: FoldInput, name: str, lists: Sequence[Sequence[Mapping[str, Any]]], parallelism: int = 4
) -> list[tuple[dict[str, Any], float]]:
    """:func:`search` for several lists of trials at once: a trial that is in more than one is scored once."""
    named = {params_json(t): t for trials in lists for t in trials}
    scores = dict(zip(named, _trial_scores(data, name, list(named.values()), parallelism), strict=True))
    out = []
    for trials in lists:
        signed = [-scores[params_json(t)] if data.kind == REGRESSION else scores[params_json(t)] for t in trials]
        if np.isnan(signed).all():
            raise ValueError(f"every trial of {name} failed")
        best = int(np.nanargmax(signed))
        out.append((dict(trials[best]), float(signed[best])))
    return out


def _trial_scores(data: FoldInput, name: str, trials: Sequence[Mapping[str, Any]], parallelism: int) -> list[float]:
    main = _MAIN[data.kind]
    if name == "11_GaussianNB":
        scores = _bayes_scores(data, [t["var_smoothing"] for t in trials])
    else:
        scores = batch.fold_means(data.blocks, name, trials, data.kind == REGRESSION) if batch.shared(name, trials, data.kind == REGRESSION) else None
        if scores is not None and name == "12_LinearDiscriminantAnalysis":
            scores = [round(s, 4) for s in scores]  # as a fit of its own is reported
    if scores is None:
        scores = []
        for t in trials:
            value = cross_validate(data, name, t, parallelism).get(main)
            scores.append(np.nan if value is None else value)
    return scores


def _bayes_scores(data: FoldInput, values: Sequence[float]) -> list[float]:
    """Mean F1 of every smoothing value; one sweep per fold's features serves all values."""
    total = np.zeros(len(values))
    for i in range(data.k):
        for r in metrics.with_rates(gaussian.smoothing_sweep(data.parts[i], values, "fold", [i])).collect():
            total[r["trial"]] += r["f1"]
    return list(total / data.k)


@dataclass
class Tuned:
    """Search tables, stage comparison, final choice and the fitted parts of the chosen model."""

    random_results: DataFrame
    grid_results: DataFrame
    comparison: DataFrame
    final: DataFrame
    vectorizer: PipelineModel
    apply: candidates.Apply


def tune(
    df: DataFrame,
    kind: str,
    target: str,
    key: str,
    numeric: Sequence[str],
    categorical: Sequence[str],
    finalists: Sequence[str],
    spaces: Mapping[str, Mapping[str, Mapping[str, Sequence[Any]]]] | None = None,
    seed: int = 42,
    test_size: float = 0.2,
    k: int = 5,
    n_iter: int = 12,
    parallelism: int = 4,
) -> Tuned:
    """Base fit, random search and grid search per finalist; the winner has the best fold score.

    The hold-out part is scored for the report but does not choose the model.
    """
    spark = df.sparkSession
    spaces = spaces or (candidates.CLASSIFIER_SPACES if kind == CLASSIFICATION else candidates.REGRESSOR_SPACES)
    rows = df.withColumns({ROW_ID: col(key).cast("bigint"), "label": col(target).cast("double")})
    train, test = folds.holdout(rows, [ROW_ID], test_size, "label" if kind == CLASSIFICATION else None, seed)
    train, test = cut_lineage(train), cut_lineage(test)
    data = fold_input(train, kind, "label", ROW_ID, numeric, categorical, k, seed)
    vectorizer = vectorize.fit_vectorizer(train, numeric, categorical)
    ready = vectorizer.transform(train).select(ROW_ID, "features", "label")
    ready = vectorize.balanced_weights(ready, "label") if kind == CLASSIFICATION else ready.withColumn("weight", F.lit(1.0))
    ready = cut_lineage(ready)
    held = cut_lineage(vectorizer.transform(test).select(ROW_ID, "features", "label"))

    def held_out(fit) -> tuple[dict[str, Any], candidates.Apply]:
        apply = fit(ready)
        return evaluate(apply(held), kind)[0], apply

    random_rows, grid_rows, compared, fitted = [], [], [], []
    for name in finalists:
        base = cross_validate(data, name, None, parallelism).get(_MAIN[kind])
        base = None if base is None else (-base if kind == REGRESSION else base)
        stages = [("base_sin_optimizar", {}, base)]
        every = combinations(spaces[name]["random"])
        drawn = random.Random(seed).sample(every, min(n_iter, len(every)))
        params, score = search(data, name, drawn, parallelism)
        stages.append(("randomized_search", params, score))
        random_rows.append(_search_row(kind, name, "RandomizedSearchCV", "n_iter", len(drawn), params, score))
        grid = combinations(spaces[name]["grid"])
        params, score = search(data, name, grid, parallelism)
        stages.append(("grid_search", params, score))
        grid_rows.append(_search_row(kind, name, "GridSearchCV", "n_combinaciones", len(grid), params, score))
        for stage, params, score in stages:
            measured, apply = held_out(candidates.build(name, params, seed))
            entry = {"tipo_problema": kind, "modelo": name, "etapa": stage, "cv_score": _round(score)}
            entry.update({m: _round(measured.get(m)) for m in _METRICS[kind]})
            entry.update({c: measured.get(c) for c in _COUNTS})
            compared.append(entry)
            fitted.append((score if score is not None else -np.inf, entry, apply))
    _, entry, apply = max(fitted, key=lambda item: item[0])
    final = {**entry, "modelo_final": entry["modelo"], "criterio_seleccion": f"max_cv_{_MAIN[kind]}" if kind == CLASSIFICATION else f"min_cv_{_MAIN[kind]}"}
    return Tuned(
        _frame(spark, random_rows, _search_schema("n_iter")),
        _frame(spark, grid_rows, _search_schema("n_combinaciones")),
        _frame(spark, compared, comparison_schema()),
        _frame(spark, [final], final_schema()),
        vectorizer,
        apply,
    )


def _round(v, digits: int = 4):
    return None if v is None else round(float(v), digits)


def _search_row(kind, name, method, count_name, count, params, score) -> dict[str, Any]:
    return {
        "tipo_problema": kind, "modelo": name, "search": method, "scoring": _SCORING[kind],
        count_name: count, "best_score_cv": _round(score), "best_params": params_json(params),
    }


def _search_schema(count_name: str) -> T.StructType:
    return T.StructType.fromDDL(
        f"tipo_problema string, modelo string, search string, scoring string, {count_name} int, best_score_cv double, best_params string"
    )


def _metric_ddl() -> str:
    both = [*_METRICS[CLASSIFICATION]]
    parts = [f"{m} double" for m in both] + [f"{c} bigint" for c in _COUNTS] + [f"{m} double" for m in _METRICS[REGRESSION]]
    return ", ".join(parts)


def comparison_schema() -> T.StructType:
    return T.StructType.fromDDL("tipo_problema string, modelo string, etapa string, cv_score double, " + _metric_ddl())


def final_schema() -> T.StructType:
    return T.StructType.fromDDL(
        "tipo_problema string, modelo_final string, etapa string, cv_score double, criterio_seleccion string, " + _metric_ddl()
    )


def alert_text(df: DataFrame, prediction: str = "prediction", score: str = "score") -> DataFrame:
    """Verdict text per scored row, with the probability in percent."""
    share = F.format_string("%.1f%%", col(score) * 100)
    return df.withColumns(
        {
            "probabilidad": share,
            "alerta": F.when(col(prediction) == 1, F.lit("ALERTA: se espera incidencia")).otherwise(F.lit("OK: sin incidencia esperada")),
        }
    )
