"""Dimension and child-table joins: unique keys, children per parent, orphans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import col


def unique_by_key(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """Drop null keys and keep the first row of each key in the given total order.

    A ``min`` over (order, rest) combines map-side, so a key with many copies
    never meets in one task.
    """
    order_by = list(order_by)
    rest = [c for c in df.columns if c not in order_by and c != key]
    packed = F.struct(
        *[col(c).alias(f"o{i}") for i, c in enumerate(order_by)], *[col(c).alias(f"r{i}") for i, c in enumerate(rest)]
    )
    first = df.where(col(key).isNotNull()).groupBy(col(key)).agg(F.min(packed).alias("__first"))
    place = {c: f"__first.o{i}" for i, c in enumerate(order_by)} | {c: f"__first.r{i}" for i, c in enumerate(rest)}
    return first.select(*[col(key) if c == key else F.col(place[c]).alias(c) for c in df.columns])


def key_uniqueness(dim: DataFrame, key: str) -> DataFrame:
    """Non-null keys, distinct keys and whether a many-to-one join is safe."""
    return dim.agg(F.count(col(key)).alias("keys"), F.count_distinct(col(key)).alias("distinct_keys")).withColumn(
        "unique", F.col("keys") == F.col("distinct_keys")
    )


def left_join_unique(fact: DataFrame, dim: DataFrame, key: str, check: bool = True) -> DataFrame:
    """Left equi-join to a table that holds each key at most once; a repeated key fails the job.

    The join is left to Spark: it broadcasts a small table, and adaptive execution splits the
    fact rows of a hot or missing key by their measured bytes, so no key has to be counted
    first. The check groups the table by the join's own key. ``check=False`` is for
    tables that an aggregate by that key has just made.
    """
    if check:
        rest = [c for c in dim.columns if c != key]
        wrong = F.raise_error(F.concat(F.lit(f"join key {key!r} is not unique: "), col(key).cast("string")))
        counted = dim.where(col(key).isNotNull()).groupBy(col(key)).agg(F.count(F.lit(1)).alias("__n"), F.first(F.struct(*[col(c) for c in dim.columns])).alias("__row"))
        row = F.when(F.col("__n") == 1, F.col("__row")).otherwise(wrong)
        dim = counted.select(col(key), row.alias("__row")).select(col(key), *[F.col("__row").getField(c).alias(c) for c in rest])
    return fact.join(dim, key, "left")


def aggregate_children(
    child: DataFrame,
    key: str,
    order_by: Sequence[str],
    count: Mapping[str, str] | None = None,
    total: Mapping[str, str] | None = None,
    listed: Mapping[str, str] | None = None,
    sort_list: bool = False,
    separator: str = "|",
) -> DataFrame:
    """Children per parent: non-null counts, sums, and distinct texts joined in order of appearance.

    Two levels: the first aggregate is keyed by (parent, text) and carries the
    sums, so a parent with a third of all children is spread and combined
    map-side; only one row per distinct text reaches the second.
    """
    count, total, listed = dict(count or {}), dict(total or {}), dict(listed or {})
    if len(listed) > 1:
        raise ValueError("one text column per call")
    rows = child.where(col(key).isNotNull())
    out_name, text = next(iter(listed.items())) if listed else (None, None)
    group = [col(key).alias("__k")] + ([col(text).alias("__t")] if text else [])
    first = F.struct(*[col(c).alias(f"o{i}") for i, c in enumerate(order_by)])
    partial = rows.groupBy(*group).agg(
        *[F.count(col(c)).alias(f"__c{i}") for i, c in enumerate(count.values())],
        *[F.sum(col(c)).alias(f"__s{i}") for i, c in enumerate(total.values())],
        *([F.min(first).alias("__first")] if text else []),
        F.count(F.lit(1)).alias("__rows"),
    )
    aggs = [F.sum(f"__c{i}").alias(n) for i, n in enumerate(count)]
    aggs += [F.coalesce(F.sum(f"__s{i}"), F.lit(0.0)).alias(n) for i, n in enumerate(total)]
    if text:
        entry = F.when(F.col("__t").isNotNull(), F.struct("__t") if sort_list else F.struct("__first", "__t"))
        ordered = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["__t"])
        aggs.append(F.array_join(ordered, separator).alias(out_name))
    if not aggs:
        aggs = [F.sum("__rows").alias("children")]
    return partial.groupBy(F.col("__k").alias(key)).agg(*aggs)


def fill_defaults(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """Replace nulls left by an unmatched outer join."""
    return df.withColumns({c: F.coalesce(col(c), F.lit(v)) for c, v in values.items() if c in df.columns})


def match_rates(df: DataFrame, conditions: Mapping[str, Any]) -> DataFrame:
    """Share of rows (percent, 1 decimal) for which each condition holds."""
    return df.agg(*[F.round(F.avg(c.cast("int")) * 100, 1).alias(n) for n, c in conditions.items()])


def orphan_keys(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Non-null fact keys absent from the dimension, one row per key with its row count.

    Fact keys are counted first, so the anti join moves one row per key.
    """
    counted = fact.where(col(key).isNotNull()).groupBy(col(key)).agg(F.count(F.lit(1)).alias("rows"))
    known = dim.select(col(dim_key or key).alias(key)).where(col(key).isNotNull())
    return counted.join(known, key, "left_anti")


