"""Training-table preparation: column pruning, eligibility, imputation registers, targets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.numbers import outside
from millrace.functions.text import latin1_safe
from millrace.operators import stats
from millrace.operators.clean import fill_constant
from millrace.operators.profile import percent
from millrace.session import col, present

REGISTER_SCHEMA = "columna string, estrategia string, n_imputados bigint, valor string"


def keep_identified(df: DataFrame, key: str) -> DataFrame:
    return df.where(col(key).isNotNull())


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def drop_prefixed(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(prefix) and c not in keep])


def rename_by_fragment(df: DataFrame, fragment: str, name: str) -> DataFrame:
    """Rename the first column whose lower-cased name holds the fragment."""
    for c in df.columns:
        if fragment in c.lower():
            return df if c == name else df.withColumnRenamed(c, name)
    return df


def _null_counts(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    if not columns:
        return {}
    row = df.agg(*[F.count_if(col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    return {c: row[f"n{i}"] for i, c in enumerate(columns)}


def impute_medians(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Fill numeric columns by their exact median; returns the table and the register of what was filled."""
    nulls = {c: n for c, n in _null_counts(df, present(df, columns)).items() if n}
    learned = {c: v for c, v in stats.medians(df, list(nulls)).items() if v is not None}
    out = df.withColumns({c: F.coalesce(col(c).cast("double"), F.lit(v)) for c, v in learned.items()}) if learned else df
    rows = [(c, "mediana", nulls[c], str(round(v, 4))) for c, v in learned.items()]
    return out, df.sparkSession.createDataFrame(rows, REGISTER_SCHEMA)


def impute_modes(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Fill columns by their mode; returns the table and the register."""
    nulls = {c: n for c, n in _null_counts(df, present(df, columns)).items() if n}
    learned = {c: v for c, v in stats.modes(df, list(nulls)).items() if v is not None}
    rows = [(c, "moda", nulls[c], str(v)) for c, v in learned.items()]
    return fill_constant(df, learned), df.sparkSession.createDataFrame(rows, REGISTER_SCHEMA)


def _ineligible(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> dict[str, Column]:
    return {c: outside(col(c), *r) for c, r in ranges.items() if c in df.columns}


def keep_eligible(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Keep rows inside every range; a missing value removes the row."""
    for c, (low, high) in ranges.items():
        if c in df.columns:
            df = df.where(col(c).between(low, high))
    return df


def eligibility_counts(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Rows broken per rule and overall, in one aggregate."""
    rules = _ineligible(df, ranges)
    anything = F.lit(False)
    for b in rules.values():
        anything = anything | b
    aggs = [F.count_if(b).alias(f"b{i}") for i, b in enumerate(rules.values())]
    aggs.append(F.count_if(anything).alias("every"))
    rows = [F.struct(F.lit(c).alias("regla"), F.col(f"b{i}").alias("fuera")) for i, c in enumerate(rules)]
    rows.append(F.struct(F.lit("total").alias("regla"), F.col("every").alias("fuera")))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def remaining_nulls(df: DataFrame) -> DataFrame:
    """Columns that still hold nulls, with their count."""
    aggs = [F.count_if(col(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)]
    rows = [F.struct(F.lit(c).alias("columna"), F.col(f"n{i}").alias("nulos")) for i, c in enumerate(df.columns)]
    return df.agg(*aggs).select(F.inline(F.array(*rows))).where(F.col("nulos") > 0)


def require_target(df: DataFrame, target: str) -> None:
    if target not in df.columns:
        raise ValueError(f"target {target!r} is not in the table")


def binary_balance(df: DataFrame, target: str, low: float = 10.0, high: float = 90.0) -> DataFrame:
    """Positives, negatives, percent positive and an imbalance alert."""
    require_target(df, target)
    row = df.agg(F.count(F.lit(1)).alias("filas"), F.sum(col(target).cast("bigint")).alias("positivos"))
    row = row.withColumn("negativos", F.col("filas") - F.col("positivos"))
    row = row.withColumn("pct_positivos", percent(F.col("positivos"), F.col("filas")))
    return row.withColumn("desbalance", (F.col("pct_positivos") < low) | (F.col("pct_positivos") > high))


def target_summary(df: DataFrame, target: str) -> DataFrame:
    """Rows with a target, its mean, exact median and sample deviation."""
    require_target(df, target)
    known = df.where(col(target).isNotNull())
    middle = stats.medians(known, [target])[target]
    return known.agg(
        F.count(F.lit(1)).alias("filas"),
        F.avg(col(target)).alias("media"),
        F.max(F.lit(middle).cast("double")).alias("mediana"),
        F.stddev_samp(col(target)).alias("std"),
    )


def trace_rows(spark, rows: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Fixed lines of a traceability report (section, item, value, detail), latin-1 safe."""
    df = spark.createDataFrame(list(rows), "seccion string, item string, valor string, detalle string")
    return df.select(*[latin1_safe(F.col(c)).alias(c) for c in df.columns])
