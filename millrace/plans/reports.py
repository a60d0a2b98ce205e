"""Small report tables built from result tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import drop_number_prefix
from millrace.session import col

# Metric captions of the search report.
REGRESSION_CAPTION, CLASSIFICATION_CAPTION = "MAE CV (menor es mejor)", "F1 CV (mayor es mejor)"


def tag_and_stack(tables: Mapping[str, DataFrame], tag: str, columns: Sequence[str]) -> DataFrame:
    """Union result tables, naming the source of each row."""
    parts = [t.select(*[col(c) for c in columns]).withColumn(tag, F.lit(name)) for name, t in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def readable_scores(searches: DataFrame, score: str = "best_score_cv", kind: str = "tipo_problema") -> DataFrame:
    """Show error scores as positive numbers, with a caption per problem type."""
    error = col(kind) == "regresion"
    return searches.withColumns(
        {
            "score_interpretable": F.when(error, -col(score)).otherwise(col(score)),
            "metrica": F.when(error, REGRESSION_CAPTION).otherwise(CLASSIFICATION_CAPTION),
        }
    )


def baseline_against_best(ranking: DataFrame, metric: str, problem: str) -> DataFrame:
    """The baseline row and the first-ranked row with their metric."""
    baseline = ranking.where(F.col("modelo").contains("Dummy")).orderBy("posicion").limit(1)
    top = ranking.orderBy("posicion").limit(1)

    def line(df, role):
        return df.select(
            F.lit(problem).alias("problema"),
            F.concat(F.lit(role), drop_number_prefix(F.col("modelo"))).alias("modelo"),
            F.lit(metric).alias("metrica"),
            col(metric).alias("valor"),
        )

    return line(baseline, "Baseline: ").unionByName(line(top, "Mejor candidato: "))


def kpi_table(final: DataFrame, wanted: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``{caption: (problem, metric)}`` picked out of the wide final-metrics table."""
    metrics = sorted({m for _, m in wanted.values()})
    long = final.unpivot(["tipo_problema"], metrics, "metric", "valor")
    pick = F.lit(None).cast("string")
    for caption, (problem, metric) in wanted.items():
        pick = F.when((F.col("tipo_problema") == problem) & (F.col("metric") == metric), caption).otherwise(pick)
    return long.withColumn("kpi", pick).where(F.col("kpi").isNotNull()).select("kpi", "valor")


def clean_names(ranking: DataFrame, column: str = "modelo") -> DataFrame:
    return ranking.withColumn(column, drop_number_prefix(col(column)))
