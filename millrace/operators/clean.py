"""Cleaning: duplicates, coercion guards, imputation, Tukey fences."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import numbers, text
from millrace.functions.dates import parse_date
from millrace.operators import stats
from millrace.operators.join import left_join_unique
from millrace.session import col, present


def drop_duplicate_rows(df: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """Keep one copy of each row; columns in ``order_by`` do not count and keep their smallest entry."""
    if not order_by:
        return df.dropDuplicates()
    data = [col(c) for c in df.columns if c not in order_by]
    first = F.min(F.struct(*[col(c) for c in order_by])).alias("__first")
    grouped = df.groupBy(*data).agg(first)
    return grouped.select(*[col(c) if c not in order_by else F.col("__first").getField(c).alias(c) for c in df.columns])


def replace_columns(df: DataFrame, exprs: Mapping[str, Any]) -> DataFrame:
    """Rewrite or add several columns in one projection."""
    return df.withColumns(dict(exprs)) if exprs else df


def coerce_numbers(df: DataFrame, columns: Sequence[str], missing: str = "skip") -> DataFrame:
    return replace_columns(df, {c: numbers.to_number(col(c)) for c in present(df, columns, missing)})


def clean_ids(df: DataFrame, columns: Sequence[str], positive_only: bool = False) -> DataFrame:
    """Text ids to bigint; unreadable (and, on request, non-positive) ids become null."""
    out = {}
    for c in present(df, columns):
        value = numbers.to_number(col(c))
        out[c] = numbers.to_long(numbers.positive(value) if positive_only else value)
    return replace_columns(df, out)


def fractional_ids(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per id column that would lose a fraction in the cast to bigint."""
    aggs = [F.count_if(numbers.fractional(numbers.to_number(col(c)))).alias(f"n{i}") for i, c in enumerate(columns)]
    rows = [F.struct(F.lit(c).alias("columna"), F.col(f"n{i}").alias("afectados")) for i, c in enumerate(columns)]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def parse_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return replace_columns(df, {c: parse_date(col(c)) for c in present(df, columns)})


def title_columns(df: DataFrame, columns: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Strip and title-case; a mapping writes ``{output: input}``."""
    pairs = columns if isinstance(columns, Mapping) else {c: c for c in columns}
    return replace_columns(df, {o: text.strip_title(col(i)) for o, i in pairs.items() if i in df.columns})


def clean_money(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return replace_columns(df, {c: numbers.money(col(c)) for c in present(df, columns)})


def null_share_guard(df: DataFrame, columns: Sequence[str], limit: float = 0.10) -> DataFrame:
    """Null share per column and whether it breaks the limit; reports, never fails."""
    aggs = [F.avg(col(c).isNull().cast("int")).alias(f"r{i}") for i, c in enumerate(columns)]
    rows = [
        F.struct(
            F.lit(c).alias("columna"),
            F.round(F.col(f"r{i}"), 6).alias("proporcion"),
            F.coalesce(F.col(f"r{i}") > F.lit(limit), F.lit(False)).alias("excede"),
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def fill_constant(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    return replace_columns(df, {c: F.coalesce(col(c), F.lit(v)) for c, v in values.items() if c in df.columns})


def fill_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill with the most frequent value; one job learns all modes."""
    learned = stats.modes(df, present(df, columns))
    return fill_constant(df, {c: v for c, v in learned.items() if v is not None})


def fill_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill with the exact median; a column that is all null stays so."""
    learned = stats.medians(df, present(df, columns))
    filled = {c: F.coalesce(col(c).cast("double"), F.lit(v)) for c, v in learned.items() if v is not None}
    return replace_columns(df, filled)


def fill_group_median(df: DataFrame, by: str, value: str) -> DataFrame:
    """Fill from the median of the row's group, then from the median after that fill.

    The big table is never windowed: medians come from a per-group aggregate
    that is joined back, and the second median is learned on the filled column.
    """
    found = stats.group_medians(df, by, value, name="__median")
    joined = left_join_unique(df, found, by, check=False)
    once = joined.withColumn(value, F.coalesce(col(value).cast("double"), F.col("__median"))).select(*df.columns)
    rest = stats.medians(once, [value])[value]
    return once if rest is None else fill_constant(once, {value: rest})


def drop_outliers(df: DataFrame, columns: Sequence[str], multiplier: float = 2.0) -> DataFrame:
    """Remove rows outside the fence of any column; missing values stay.

    The fences of all columns come from the unfiltered table and enter the
    filter as literals in a form that Parquet scans can use.
    """
    for c, (low, high) in stats.tukey_fences(df, present(df, columns), multiplier).items():
        df = df.where(col(c).isNull() | ((col(c) >= F.lit(low)) & (col(c) <= F.lit(high))))
    return df


def _beyond(fences: Mapping[str, tuple[float, float]]):
    broken = F.lit(False)
    for c, (low, high) in fences.items():
        broken = broken | F.coalesce((col(c) < F.lit(low)) | (col(c) > F.lit(high)), F.lit(False))
    return broken


def outlier_report(df: DataFrame, columns: Sequence[str], multiplier: float = 2.0) -> DataFrame:
    """Per column the fence and the rows beyond it, plus the rows removed over all columns."""
    fences = stats.tukey_fences(df, present(df, columns), multiplier)
    aggs = [F.count_if(_beyond({c: f})).alias(f"n{i}") for i, (c, f) in enumerate(fences.items())]
    aggs.append(F.count_if(_beyond(fences)).alias("total"))
    rows = [
        F.struct(
            F.lit(c).alias("columna"), F.lit(low).alias("limite_inf"), F.lit(high).alias("limite_sup"),
            F.col(f"n{i}").alias("fuera"), F.col("total").alias("filas_eliminadas"),
        )
        for i, (c, (low, high)) in enumerate(fences.items())
    ]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))
