"""Column and table profiles, anomaly counts, null rankings (data quality observation)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.numbers import to_number
from millrace.functions.text import has_edge_space
from millrace.operators import stats
from millrace.session import col

# Severity bands and null labels of the quality report.
BAND_CRITICAL, BAND_MODERATE, BAND_LOW, BAND_OK = "CRITICO", "MODERADO", "BAJO", "OK"
HAS_NULLS, NO_NULLS = "Tiene nulos", "Sin nulos"


def _numeric(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.NumericType)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.coalesce(F.try_divide(part * 100.0, whole), F.lit(0.0)), digits)


def distinct_counts(df: DataFrame) -> DataFrame:
    """Exact number of distinct non-null values per column ordinal, from one scan.

    Each row becomes (ordinal, value) rows with the value in the column of its storage
    kind, which are deduplicated by one hash aggregate. Counting all columns with
    ``count(DISTINCT)`` in one aggregate would carry every column in every key.
    """
    pairs = []
    for i, f in enumerate(df.schema.fields):
        c = col(f.name)
        whole, number, text = F.lit(None).cast("bigint"), F.lit(None).cast("double"), F.lit(None).cast("string")
        if isinstance(f.dataType, T.IntegralType):
            whole = c.cast("bigint")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            number = c.cast("double")
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            text = F.when(c.isNotNull(), F.to_json(F.struct(c)))
        else:
            text = c.cast("string")
        pairs.append(F.struct(F.lit(i).alias("ordinal"), whole.alias("whole"), number.alias("number"), text.alias("text")))
    long = df.select(F.inline(F.array(*pairs))).where("whole is not null or number is not null or text is not null")
    return long.distinct().groupBy("ordinal").agg(F.count(F.lit(1)).alias("distinct"))


def table_profile(df: DataFrame, name: str, approx_distinct: bool = False) -> DataFrame:
    """One row per column: type, rows, nulls, distinct values and numeric summary.

    Everything but the distinct counts comes out of one aggregate without a
    data shuffle; ``approx_distinct`` moves those into it too, as sketches.
    """
    fields = df.schema.fields
    aggs: list[Column] = [F.count(F.lit(1)).alias("n")]
    for i, f in enumerate(fields):
        c = col(f.name)
        aggs.append(F.count(c).alias(f"k{i}"))
        if approx_distinct:
            aggs.append(F.approx_count_distinct(c).alias(f"d{i}"))
        if _numeric(f):
            v = c.cast("double")
            aggs += [
                F.min(v).alias(f"lo{i}"),
                F.max(v).alias(f"hi{i}"),
                F.avg(v).alias(f"m{i}"),
                F.stddev_samp(v).alias(f"s{i}"),
            ]
    rows = []
    none = F.lit(None).cast("double")
    for i, f in enumerate(fields):
        numbers = [F.round(F.col(f"{p}{i}"), 4) if _numeric(f) else none for p in ("lo", "hi", "m", "s")]
        rows.append(
            F.struct(
                F.lit(i).alias("ordinal"),
                F.lit(f.name).alias("columna"),
                F.lit(f.dataType.simpleString()).alias("tipo_dato"),
                F.col("n").alias("total_registros"),
                (F.col("n") - F.col(f"k{i}")).alias("nulos"),
                percent(F.col("n") - F.col(f"k{i}"), F.col("n")).alias("pct_nulos"),
                (F.col(f"d{i}") if approx_distinct else F.lit(0).cast("bigint")).alias("valores_unicos"),
                *[v.alias(a) for v, a in zip(numbers, ("min", "max", "media", "std"))],
            )
        )
    report = df.agg(*aggs).select(F.inline(F.array(*rows)))
    if not approx_distinct:
        report = report.join(distinct_counts(df), "ordinal", "left")
        report = report.withColumn("valores_unicos", F.coalesce("distinct", F.lit(0).cast("bigint")))
    return report.select(F.lit(name).alias("dataset"), *[F.col(c) for c in _PROFILE_COLUMNS])


_PROFILE_COLUMNS = (
    "columna", "tipo_dato", "total_registros", "nulos", "pct_nulos", "valores_unicos", "min", "max", "media", "std",
)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Number of second and later copies of whole rows (nulls equal)."""
    counted = df.groupBy(*[col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("__n"))
    return counted.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicates"))


def missing_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows without a value in each key column, as count and percent, one row per key."""
    aggs = [F.count(F.lit(1)).alias("n"), *[F.count_if(col(k).isNull()).alias(f"k{i}") for i, k in enumerate(keys)]]
    rows = [
        F.struct(F.lit(k).alias("key"), F.col(f"k{i}").alias("missing"), percent(F.col(f"k{i}"), F.col("n"), 1).alias("pct"))
        for i, k in enumerate(keys)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def extreme_count(df: DataFrame, column: str, multiplier: float = 3.0) -> DataFrame:
    """Values beyond Q1 - m*IQR or Q3 + m*IQR after numeric coercion, with the fence used."""
    value = to_number(col(column))
    fence = stats.tukey_fences(df, {column: value}, multiplier).get(column)
    low, high = fence or (None, None)
    beyond = (value < F.lit(low)) | (value > F.lit(high))
    return df.agg(
        F.count_if(F.coalesce(beyond, F.lit(False))).alias("extremes"),
        F.max(F.lit(low).cast("double")).alias("low"),
        F.max(F.lit(high).cast("double")).alias("high"),
    )


def padded_text(df: DataFrame, columns: Sequence[str], nulls: bool = False) -> DataFrame:
    """Rows per column whose text changes when stripped; ``nulls=True`` counts missing text too."""
    aggs = [F.count_if(has_edge_space(col(c), nulls)).alias(f"n{i}") for i, c in enumerate(columns)]
    rows = [F.struct(F.lit(c).alias("columna"), F.col(f"n{i}").alias("afectados")) for i, c in enumerate(columns)]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def value_counts(df: DataFrame, column: str, name: str = "cantidad") -> DataFrame:
    """Rows per non-null value, most frequent first."""
    counted = df.where(col(column).isNotNull()).groupBy(col(column)).agg(F.count(F.lit(1)).alias(name))
    return counted.orderBy(F.col(name).desc(), col(column))


def category_summary(df: DataFrame, by: str, counts: Mapping[str, str]) -> DataFrame:
    """Per category the number of non-null values of other columns: ``{output: column}``."""
    aggs = [F.count(col(c)).alias(a) for a, c in counts.items()]
    return df.where(col(by).isNotNull()).groupBy(col(by)).agg(*aggs)


def severity_report(profiles: Sequence[DataFrame], by_severity: bool = False) -> DataFrame:
    """Stack profiles and band their null share: > 20, 5 to 20, > 0, none.

    Sorted by band name, then share, as published; ``by_severity`` puts the
    worst band first instead.
    """
    report = profiles[0]
    for p in profiles[1:]:
        report = report.unionByName(p)
    share = F.col("pct_nulos")
    band = (
        F.when(share > 20, BAND_CRITICAL)
        .when(share.between(5, 20), BAND_MODERATE)
        .when(share > 0, BAND_LOW)
        .otherwise(BAND_OK)
    )
    report = report.withColumn("alerta_nulos", F.when(share > 0, HAS_NULLS).otherwise(NO_NULLS))
    report = report.withColumn("nivel_criticidad", band)
    order = [F.col("nivel_criticidad").asc()]
    if by_severity:
        order = [F.when(share > 20, 0).when(share >= 5, 1).when(share > 0, 2).otherwise(3)]
    return report.orderBy(*order, share.desc(), "dataset", "columna")


def null_counts(df: DataFrame, name: str) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("n"), *[F.count(col(c)).alias(f"k{i}") for i, c in enumerate(df.columns)]]
    rows = [
        F.struct(
            F.lit(c).alias("columna"),
            (F.col("n") - F.col(f"k{i}")).alias("nulos"),
            percent(F.col("n") - F.col(f"k{i}"), F.col("n")).alias("porcentaje"),
        )
        for i, c in enumerate(df.columns)
    ]
    return df.agg(*aggs).select(F.lit(name).alias("dataset"), F.inline(F.array(*rows)))


def null_ranking(tables: Mapping[str, DataFrame], top: int = 20) -> DataFrame:
    """Columns with nulls over several tables, highest share first."""
    parts = [null_counts(df, name) for name, df in tables.items()]
    report = parts[0]
    for p in parts[1:]:
        report = report.unionByName(p)
    ordered = report.where(F.col("nulos") > 0).orderBy(F.col("porcentaje").desc(), "dataset", "columna")
    return ordered.limit(top)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, exact quartiles and max, one row per column."""
    marks = stats.quantiles(df, columns, [0.25, 0.5, 0.75])
    aggs = []
    for i, c in enumerate(columns):
        v = col(c).cast("double")
        aggs += [
            F.count(v).alias(f"n{i}"), F.avg(v).alias(f"m{i}"), F.stddev_samp(v).alias(f"s{i}"),
            F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"),
        ]
    rows = [
        F.struct(
            F.lit(c).alias("columna"),
            F.col(f"n{i}").alias("count"),
            F.col(f"m{i}").alias("mean"),
            F.col(f"s{i}").alias("std"),
            F.col(f"lo{i}").alias("min"),
            *[F.lit(q).cast("double").alias(a) for q, a in zip(marks[c], ("p25", "p50", "p75"))],
            F.col(f"hi{i}").alias("max"),
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def class_balance(df: DataFrame, target: str, labels: Mapping[int, str]) -> DataFrame:
    """Count, label and percent of each class; the total is a scalar subquery over the tiny grouped table."""
    counted = df.groupBy(col(target)).agg(F.count(F.lit(1)).alias("cantidad"))
    total = counted.agg(F.sum("cantidad"))
    label = F.lit(None).cast("string")
    for value, text in labels.items():
        label = F.when(col(target) == F.lit(value), text).otherwise(label)
    share = percent(F.col("cantidad"), total.scalar()).alias("porcentaje")
    return counted.select(col(target), "cantidad", label.alias("clase"), share).orderBy(col(target))


def readiness_audit(df: DataFrame, name: str, leaked: Sequence[str], none_word: str = "ninguna") -> DataFrame:
    """Rows, columns, total nulls and forbidden columns still present, as one row."""
    nulls = F.lit(0)
    for c in df.columns:
        nulls = nulls + F.count_if(col(c).isNull())
    kept = ", ".join(c for c in leaked if c in df.columns) or none_word
    return df.agg(F.count(F.lit(1)).alias("filas"), nulls.alias("nulos_totales")).select(
        F.lit(name).alias("dataset"),
        "filas",
        F.lit(len(df.columns)).alias("columnas"),
        "nulos_totales",
        F.lit(kept).alias("columnas_leakage_presentes"),
    )
