"""Feature vectors: median + standardise for numbers, mode + one-hot for categories.

A fitted vectoriser is an ordinary ``PipelineModel`` of built-in stages, so it
saves, loads and runs in the JVM. Vectorisers for all folds are fitted by the
same few jobs: each statistic is a conditional aggregate over ``fold <> i``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import stats
from millrace.session import col, quoted


def _literal(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fit_vectorizer(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), out: str = "features"
) -> PipelineModel:
    return _fit(df, [None], None, numeric, categorical, out)[0]


def fit_fold_vectorizers(
    df: DataFrame, fold: str, k: int, numeric: Sequence[str], categorical: Sequence[str] = (), out: str = "features"
) -> list[PipelineModel]:
    """Vectoriser i is fitted on the rows whose fold is not i."""
    return _fit(df, list(range(k)), fold, numeric, categorical, out)


def _fit(df, parts, fold, numeric, categorical, out):
    numeric = [c for c in numeric if c in df.columns]
    categorical = [c for c in categorical if c in df.columns]

    def training(part, value):
        return value if part is None else F.when(col(fold) != F.lit(part), value)

    inputs = {(p, c): training(p, col(c).cast("double")) for p in parts for c in numeric}
    middles = stats.medians(df, {f"{p}/{c}": e for (p, c), e in inputs.items()})
    middle = {(p, c): middles[f"{p}/{c}"] or 0.0 for p, c in inputs}
    aggs = []
    for i, (p, c) in enumerate(inputs):
        filled = training(p, F.coalesce(col(c).cast("double"), F.lit(middle[(p, c)])))
        aggs += [F.avg(filled).alias(f"m{i}"), F.stddev_pop(filled).alias(f"s{i}")]
    row = df.agg(*aggs).first() if aggs else None
    scale = {pc: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0) for i, pc in enumerate(inputs)}
    counts = _level_counts(df, fold, categorical)

    models = []
    for p in parts:
        pieces = []
        for c in numeric:
            mean, spread = scale[(p, c)]
            value = f"coalesce(cast({quoted(c)} AS DOUBLE), {middle[(p, c)]!r}D)"
            pieces.append(f"({value} - {mean!r}D) / {spread!r}D AS {quoted(c + '__z')}")
        labels = []
        for c in categorical:
            seen = Counter()
            for (part, level), n in counts[c].items():
                if part != p or p is None:
                    seen[level] += n
            mode = min(seen, key=lambda v: (-seen[v], v)) if seen else ""
            labels.append(sorted(seen) or [""])
            pieces.append(f"coalesce(cast({quoted(c)} AS STRING), {_literal(mode)}) AS {quoted(c + '__c')}")
        stages = [SQLTransformer(statement=f"SELECT *, {', '.join(pieces)} FROM __THIS__")]
        vectors = [c + "__z" for c in numeric]
        if categorical:
            # One model per column: a joint one would pad the shorter level lists.
            index = PipelineModel(
                [
                    StringIndexerModel.from_labels(values, c + "__c", c + "__i", handleInvalid="keep")
                    for c, values in zip(categorical, labels)
                ]
            )
            hot = OneHotEncoder(
                inputCols=[c + "__i" for c in categorical], outputCols=[c + "__v" for c in categorical], dropLast=True
            )
            # The level counts sit in the column metadata, so fitting runs no job.
            stages += [*index.stages, hot.fit(index.transform(stages[0].transform(df)))]
            vectors += [c + "__v" for c in categorical]
        stages.append(VectorAssembler(inputCols=vectors, outputCol=out))
        models.append(PipelineModel(stages=stages))
    return models


def _level_counts(df: DataFrame, fold: str | None, categorical: Sequence[str]) -> dict[str, dict]:
    """Rows per (fold, level) of every categorical column, in one job."""
    counts: dict[str, dict] = {c: {} for c in categorical}
    if not categorical:
        return counts
    k = len(categorical)
    part = col(fold) if fold else F.lit(None).cast("int")
    work = df.select(part.alias("p"), *[col(c).cast("string").alias(f"c{i}") for i, c in enumerate(categorical)])
    names = [F.col(f"c{i}") for i in range(k)]
    grouped = work.groupingSets([[F.col("p"), c] for c in names], F.col("p"), *names).agg(
        F.count(F.lit(1)).alias("n"), F.grouping_id().alias("g")
    )
    rows = grouped.collect()  # a row per level and fold: the levels are the vector's own coordinates
    for r in rows:
        for i, c in enumerate(categorical):
            if r["g"] == (1 << k) - 1 - (1 << (k - 1 - i)) and r[f"c{i}"] is not None:
                counts[c][(r["p"], r[f"c{i}"])] = r["n"]
    return counts


def balanced_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Weight n / (classes * n_class), from one tiny aggregate."""
    rows = df.groupBy(col(label)).agg(F.count(F.lit(1)).alias("n")).collect()  # one row per class
    total, classes = sum(r["n"] for r in rows), len(rows)
    weight = F.lit(1.0)
    for r in rows:
        weight = F.when(col(label) == F.lit(r[label]), F.lit(total / (classes * r["n"]))).otherwise(weight)
    return df.withColumn(name, weight)
