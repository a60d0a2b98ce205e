"""Evaluation of predictions: confusion counts, ranking metrics, errors, residuals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.stats import BUCKET_ROWS, running_totals
from millrace.session import col


def _counts(label: str, prediction: str) -> list[Column]:
    y, p = col(label) == 1, col(prediction) == 1
    return [
        F.count_if(~y & ~p).alias("tn"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(y & p).alias("tp"),
    ]


def confusion(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """tn, fp, fn, tp, optionally per group (a fold, a model)."""
    return df.groupBy(*[col(c) for c in by]).agg(*_counts(label, prediction))


def with_rates(counts: DataFrame) -> DataFrame:
    """Add accuracy, precision, recall and F1 of the positive class; zero division gives 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    zero = F.lit(0.0)
    return counts.withColumns(
        {
            "accuracy": F.coalesce(F.try_divide(tp + tn, tp + tn + fp + fn), zero),
            "precision": F.coalesce(F.try_divide(tp, tp + fp), zero),
            "recall": F.coalesce(F.try_divide(tp, tp + fn), zero),
            "f1": F.coalesce(F.try_divide(2.0 * tp, 2 * tp + fp + fn), zero),
        }
    )


def score_table(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score: the only input ranking metrics need."""
    return (
        df.where(col(score).isNotNull())
        .groupBy(*[col(c) for c in by], col(score).cast("double").alias("score"))
        .agg(F.count_if(col(label) == 1).alias("pos"), F.count_if(col(label) != 1).alias("neg"))
    )


def roc_auc(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), rows_per_bucket: int = BUCKET_ROWS
) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; null with a single class.

    Scores are first reduced to one row per distinct value, then negatives
    below each score come from running totals over score ranges: no global
    sort in one task.
    """
    ranked = running_totals(score_table(df, label, score, by), "score", ["neg", "pos"], by, rows_per_bucket)
    won = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0))
    pairs = F.max("pos_total").cast("double") * F.max("neg_total")
    return ranked.groupBy(*[col(c) for c in by]).agg(F.try_divide(won, pairs).alias("roc_auc"))


def roc_points(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), rows_per_bucket: int = BUCKET_ROWS
) -> DataFrame:
    """False and true positive rate when everything scoring at least ``threshold`` is called positive.

    The curve starts at (0, 0), where the threshold is infinite.
    """
    ranked = running_totals(score_table(df, label, score, by), "score", ["neg", "pos"], by, rows_per_bucket)
    points = ranked.select(
        *[col(c) for c in by],
        F.col("score").cast("double").alias("threshold"),
        F.try_divide(F.col("neg_total") - F.col("neg_before"), F.col("neg_total")).alias("fpr"),
        F.try_divide(F.col("pos_total") - F.col("pos_before"), F.col("pos_total")).alias("tpr"),
    )
    start = ranked.select(*[col(c) for c in by]).distinct() if by else ranked.limit(1).select()
    return points.unionByName(start.withColumns({"threshold": F.lit(float("inf")), "fpr": F.lit(0.0), "tpr": F.lit(0.0)}))


def class_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class, then macro and weighted averages.

    Rows are reduced to (label, prediction) counts; the rest works on that
    tiny table.
    """
    pairs = df.groupBy(col(label).cast("int").alias("y"), col(prediction).cast("int").alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    sides = pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("y").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("called"),
                         F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(F.lit(0).cast("bigint")).alias("hit")),
                F.struct(F.col("p").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("called"),
                         F.lit(0).cast("bigint").alias("hit")),
            )
        )
    )
    zero = F.lit(0.0)
    per = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "called", "hit")])
    per = per.select(
        F.col("class").cast("string").alias("class"),
        F.coalesce(F.try_divide("hit", "called"), zero).alias("precision"),
        F.coalesce(F.try_divide("hit", "support"), zero).alias("recall"),
        F.coalesce(F.try_divide(2.0 * F.col("hit"), F.col("called") + F.col("support")), zero).alias("f1"),
        "support",
    )
    names = ("precision", "recall", "f1")
    macro = per.agg(*[F.avg(c).alias(c) for c in names], F.sum("support").alias("support"))
    weighted = per.agg(
        *[F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c) for c in names],
        F.sum("support").alias("support"),
    )
    out = per.unionByName(macro.withColumn("class", F.lit("macro avg")))
    return out.unionByName(weighted.withColumn("class", F.lit("weighted avg")))


def regression_errors(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, MSE, RMSE and R2 from one aggregate."""
    y, gap = col(label).cast("double"), col(label).cast("double") - col(prediction)
    return (
        df.groupBy(*[col(c) for c in by])
        .agg(
            F.avg(F.abs(gap)).alias("mae"),
            F.avg(gap * gap).alias("mse"),
            F.sqrt(F.avg(gap * gap)).alias("rmse"),
            (1 - F.try_divide(F.avg(gap * gap), F.var_pop(y))).alias("r2"),
        )
    )


def residuals(df: DataFrame, label: str, prediction: str, name: str = "residual") -> DataFrame:
    return df.withColumn(name, col(label).cast("double") - col(prediction))


def histogram(df: DataFrame, column: str, width: float) -> DataFrame:
    """Rows per interval [k*width, (k+1)*width)."""
    start = F.floor(col(column) / F.lit(width)) * F.lit(width)
    return df.where(col(column).isNotNull()).groupBy(start.alias("bin_start")).agg(F.count(F.lit(1)).alias("n"))


def ranked(df: DataFrame, metric: str, smaller_is_better: bool = False) -> DataFrame:
    """Position of each row of a small result table, best metric first (ties by model name)."""
    value = col(metric)
    order = value.asc_nulls_last() if smaller_is_better else value.desc_nulls_last()
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(order, "modelo"))
    return df.select(place.alias("posicion"), *[col(c) for c in df.columns]).orderBy("posicion")
