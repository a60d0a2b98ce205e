"""Reproducible fold assignment and hold-out splits."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.stats import BUCKET_ROWS, MAX_BUCKETS, running_totals
from millrace.session import col


def _order(keys: Sequence[str], seed: int | None) -> Column:
    if seed is None:
        return col(keys[0]).cast("double")
    return F.xxhash64(*[col(k) for k in keys], F.lit(seed)).cast("double")


def stratified_folds(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    k: int = 5,
    seed: int | None = 42,
    name: str = "fold",
    rows_per_bucket: int = BUCKET_ROWS,
) -> DataFrame:
    """Fold 0..k-1 by rank inside the class, so class sizes per fold differ by at most one.

    ``keys`` identify a row. With a seed the rank follows a hash of the keys;
    with ``seed=None`` it follows the first key. A class may hold most of the
    table, so the rank is built from ranges of the order, not one class window.
    """
    ordered = df.withColumn("__order", _order(keys, seed)).withColumn("__one", F.lit(1))
    cuts = None
    if seed is not None:
        # Hashes are spread evenly, so equal steps cut them into even ranges without a look at the data.
        parts = min(math.ceil(df.count() / rows_per_bucket), MAX_BUCKETS)
        cuts = [-(2.0**63) + i * (2.0**64 / parts) for i in range(1, parts)]
    ranked = running_totals(ordered, "__order", ["__one"], [label], rows_per_bucket, tie=list(keys), cuts=cuts)
    return ranked.select(*[col(c) for c in df.columns], F.pmod("__one_before", F.lit(k)).cast("int").alias(name))


def hashed_folds(df: DataFrame, keys: Sequence[str], k: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Fold by hash of the keys: no shuffle, stable under any partitioning."""
    hashed = F.xxhash64(*[col(c) for c in keys], F.lit(seed))
    return df.withColumn(name, F.pmod(hashed, F.lit(k)).cast("int"))


def holdout(
    df: DataFrame, keys: Sequence[str], test_size: float = 0.2, label: str | None = None, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Train and test part; ceil(n * test_size) rows are held out, of each class where a label is given.

    Rows are ranked by a hash of their keys, so the split is reproducible for any size.
    """
    by = label or "__whole"
    rows = df if label else df.withColumn(by, F.lit(0))
    ordered = rows.withColumn("__order", _order(keys, seed)).withColumn("__one", F.lit(1))
    parts = max(1, min(math.ceil(df.count() / BUCKET_ROWS), MAX_BUCKETS))
    cuts = [-(2.0**63) + i * (2.0**64 / parts) for i in range(1, parts)]
    ranked = running_totals(ordered, "__order", ["__one"], [by], tie=list(keys), cuts=cuts)
    held = F.col("__one_before") < F.ceil(F.round(F.col("__one_total") * test_size, 6))
    out = ranked.select(*[col(c) for c in df.columns], held.alias("__held"))
    return out.where(~F.col("__held")).drop("__held"), out.where("__held").drop("__held")
