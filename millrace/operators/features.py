"""Derived columns: ratios, durations, encodings, scaling, calendar parts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import dates, numbers
from millrace.operators.join import left_join_unique
from millrace.session import col, cut_lineage, present


def duration_days(df: DataFrame, start: str, end: str, name: str, low: int = 0, high: int = 60) -> DataFrame:
    if not {start, end} <= set(df.columns):
        return df
    return df.withColumn(name, dates.days_between(col(start), col(end), low, high))


def ratios(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``{output: (numerator, denominator)}``; a zero denominator gives null."""
    usable = {o: p for o, p in pairs.items() if set(p) <= set(df.columns)}
    return df.withColumns({o: numbers.ratio(col(a), col(b)) for o, (a, b) in usable.items()}) if usable else df


def count_flag(df: DataFrame, count: str, name: str) -> DataFrame:
    return df.withColumn(name, numbers.flag(col(count))) if count in df.columns else df


def level_text(c: Column, null_word: str = "nan") -> Column:
    """A missing category is a level of its own."""
    return F.coalesce(c.cast("string"), F.lit(null_word))


def levels(df: DataFrame, column: str) -> list[str]:
    """Sorted levels, for operators whose output schema depends on them: one column per level."""
    return sorted(r["v"] for r in df.select(level_text(col(column)).alias("v")).distinct().collect())


def one_hot(df: DataFrame, column: str, prefix: str | None = None, known: Sequence[str] | None = None) -> DataFrame:
    """One 0/1 column ``<prefix>_<level>`` per level, every level kept."""
    prefix = prefix or column
    text = level_text(col(column))
    values = list(known) if known is not None else levels(df, column)
    return df.withColumns({f"{prefix}_{v}": (text == F.lit(v)).cast("int") for v in values})


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """Level table (level, code), codes in alphabetical order from 0.

    Levels are split into ranges by Spark's own range partitioning over the whole text, numbered
    inside a range, and offset by the sizes of the ranges before (one row per range).
    """
    distinct = df.select(level_text(col(column)).alias("__level")).distinct()
    ranged = cut_lineage(distinct.repartitionByRange("__level").withColumn("__range", F.spark_partition_id()))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("n"))
    starts = sizes.select("__range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"))
    place = F.row_number().over(Window.partitionBy("__range").orderBy("__level"))
    return ranged.withColumn("__place", place).join(starts, "__range").select("__level", (F.col("__start") + F.col("__place") - 1).cast("int").alias("__code"))


def label_encode(df: DataFrame, column: str, name: str) -> DataFrame:
    """Integer code of each level by alphabetical order; null is the level ``nan``."""
    if column not in df.columns:
        return df
    coded = df.withColumn("__level", level_text(col(column)))
    return left_join_unique(coded, label_codes(df, column), "__level", check=False).withColumnRenamed("__code", name).drop("__level")


def min_max(df: DataFrame, columns: Sequence[str], suffix: str = "_norm") -> DataFrame:
    """Scale to [0, 1]; nulls pass, a constant column becomes 0. One aggregate for all columns."""
    columns = present(df, columns)
    if not columns:
        return df
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.min(col(c)).cast("double").alias(f"lo{i}"), F.max(col(c)).cast("double").alias(f"hi{i}")]
    row = df.agg(*aggs).first()
    out = {}
    for i, c in enumerate(columns):
        low, high = row[f"lo{i}"], row[f"hi{i}"]
        width = (high - low) or 1.0 if low is not None else 1.0
        out[f"{c}{suffix}"] = (col(c) - F.lit(low)) / F.lit(width)
    return df.withColumns(out)


def calendar(df: DataFrame, column: str, names: Mapping[str, str]) -> DataFrame:
    """Month, weekday (Monday = 0), quarter as doubles: ``{part: output}``."""
    if column not in df.columns:
        return df
    parts = dates.calendar_parts(col(column))
    return df.withColumns({out: parts[part] for part, out in names.items()})


def z_scores(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Standardise columns of a small report table by population deviation."""
    kept = [col(c) for c in df.columns if c not in columns]
    scaled = []
    for c in columns:
        mean, spread = df.agg(F.avg(col(c))).scalar(), df.agg(F.stddev_pop(col(c))).scalar()
        scaled.append(F.try_divide(col(c) - mean, spread).alias(c))
    return df.select(*kept, *scaled)
