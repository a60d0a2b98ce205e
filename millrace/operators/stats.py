"""Exact order statistics and running totals that never gather a column in one task.

Spark's ``percentile``, ``median`` and ``mode`` keep a value -> count map that
ends up whole in one task. Here, for tables of every size:

* quantiles are found by narrowing: a bounded sketch proposes two pivots per
  rank, one aggregate counts exactly how many rows lie below and at each pivot,
  and the search goes on inside the interval that must hold the rank, until the
  interval is short enough to be listed;
* modes are a grouped count followed by a min over (-count, value);
* running totals are split into value ranges, summed per range, and offset.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import col

LIST_ROWS = 50_000
SKETCH_ACCURACY = 10_000
BUCKET_ROWS = 1_000_000
MAX_BUCKETS = 20_000


def _as_columns(columns: Sequence[str] | Mapping[str, Column]) -> dict[str, Column]:
    if isinstance(columns, Mapping):
        return dict(columns)
    return {c: col(c) for c in columns}


def _number(c: Column) -> Column:
    """As double, with NaN read as missing like everywhere else here."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def quantiles(
    df: DataFrame,
    columns: Sequence[str] | Mapping[str, Column],
    probs: Sequence[float],
    list_rows: int = LIST_ROWS,
) -> dict[str, list[float | None]]:
    """Exact linearly interpolated quantiles of many columns, nulls skipped.

    ``columns`` may map names to expressions, so conditional columns (one per
    fold, say) share the same jobs. Every job reads only the columns involved.
    """
    exprs = _as_columns(columns)
    if not exprs:
        return {}
    names = list(exprs)
    ids = range(len(names))
    work = df.select(*[_number(exprs[n]).alias(f"v{i}") for i, n in enumerate(names)])
    sizes = dict(zip(ids, work.agg(*[F.count(f"v{i}") for i in ids]).first(), strict=True))
    spots = {i: [(sizes[i] - 1) * float(p) for p in probs] for i in ids if sizes[i]}
    wanted = {i: sorted({r for s in at for r in (math.floor(s), math.ceil(s))}) for i, at in spots.items()}
    found = _select_ranks(work, sizes, wanted, list_rows)
    out: dict[str, list[float | None]] = {names[i]: [None] * len(probs) for i in ids}
    for i, at in spots.items():
        values = []
        for spot in at:
            lo, hi = math.floor(spot), math.ceil(spot)
            a, b = found[(i, lo)], found[(i, hi)]
            values.append(a if lo == hi or a == b else (hi - spot) * a + (spot - lo) * b)
        out[names[i]] = values
    return out


def _around(p: float) -> tuple[float, float]:
    """Two fractions whose sketched values are sure to enclose the wanted one."""
    step = 2.0 / SKETCH_ACCURACY
    return max(float(p) - step, 0.0), min(float(p) + step, 1.0)


def _inside(i: int, low: float | None, high: float | None) -> Column:
    """The value where it lies strictly between the ends; None is an open end, as infinities are values too."""
    v = F.col(f"v{i}")
    cond = v.isNotNull()
    if low is not None:
        cond = cond & (v > F.lit(low))
    if high is not None:
        cond = cond & (v < F.lit(high))
    return F.when(cond, v)


def _sketches(spans: dict[tuple, list[float]]) -> list[Column]:
    return [
        F.approx_percentile(_inside(*span), F.array(*[F.lit(p) for p in ps]), F.lit(SKETCH_ACCURACY)).alias(f"p{j}")
        for j, (span, ps) in enumerate(spans.items())
    ]


def _select_ranks(
    work: DataFrame, sizes: dict[int, int], wanted: dict[int, list[int]], list_rows: int
) -> dict[tuple[int, int], float]:
    """Values at zero-based ranks, by multi-pivot narrowing over whole-table aggregates.

    Per open target the state is an interval (low, high) of values, the exact
    number of rows at or below ``low`` and the exact number inside. Pivots are
    values of the data, so each round either hits the target or shrinks the
    interval; a value held by a third of the rows is simply hit. An interval of
    at most ``list_rows`` rows is listed.
    """
    state = {(i, r): (None, None, 0, sizes[i]) for i, ranks in wanted.items() for r in ranks}
    found: dict[tuple[int, int], float] = {}
    while state:
        small = {t: s for t, s in state.items() if s[3] <= list_rows}
        if small:
            spans = list(dict.fromkeys((t[0], s[0], s[1]) for t, s in small.items()))
            name = {span: f"s{j}" for j, span in enumerate(spans)}
            row = work.agg(*[F.sort_array(F.collect_list(_inside(*p))).alias(name[p]) for p in spans]).first()
            for t, (low, high, below, _) in small.items():
                found[t] = row[name[(t[0], low, high)]][t[1] - below]
                del state[t]
        if not state:
            break
        spans: dict[tuple, set] = {}
        for t, (low, high, below, size) in state.items():
            spans.setdefault((t[0], low, high), set()).update(_around((t[1] - below) / size))
        row = work.agg(*_sketches({span: sorted(ps) for span, ps in spans.items()})).first()
        pivots: dict[int, list[float]] = {}
        for j, (i, _, _) in enumerate(spans):
            pivots[i] = sorted({*pivots.get(i, []), *row[f"p{j}"]})
        flat = [(i, v) for i, vs in pivots.items() for v in vs]
        counts = []
        for j, (i, v) in enumerate(flat):
            counts.append(F.count_if(F.col(f"v{i}") < F.lit(v)).alias(f"lt{j}"))
            counts.append(F.count_if(F.col(f"v{i}") <= F.lit(v)).alias(f"le{j}"))
        row = work.agg(*counts).first()
        seen = {pair: (row[f"lt{j}"], row[f"le{j}"]) for j, pair in enumerate(flat)}
        for t in list(state):
            low, high, below, size = state[t]
            upto = below + size
            for v in pivots[t[0]]:
                if low is not None and v <= low or high is not None and v >= high:
                    continue
                lt, le = seen[(t[0], v)]
                if lt <= t[1] < le:
                    found[t] = v
                    del state[t]
                    break
                if le <= t[1]:
                    low, below = v, le
                else:
                    high, upto = v, lt
                    break
            if t in state:
                state[t] = (low, high, below, upto - below)
    return found


def medians(df: DataFrame, columns, **limits) -> dict[str, float | None]:
    return {c: q[0] for c, q in quantiles(df, columns, [0.5], **limits).items()}


def tukey_fences(df: DataFrame, columns, multiplier: float, **limits) -> dict[str, tuple[float, float]]:
    """[Q1 - m*IQR, Q3 + m*IQR] per column; all-null columns get no fence."""
    fences = {}
    for c, (q1, q3) in quantiles(df, columns, [0.25, 0.75], **limits).items():
        if q1 is not None:
            fences[c] = (q1 - multiplier * (q3 - q1), q3 + multiplier * (q3 - q1))
    return fences


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, Any]:
    """Most frequent non-null value of each column, the smallest one on a tie.

    One job: grouping sets count all columns at once with map-side combine, and
    the second aggregate keeps a single (-count, value) per column.
    """
    columns = list(columns)
    if not columns:
        return {}
    k = len(columns)
    work = df.select(*[col(c).alias(f"c{i}") for i, c in enumerate(columns)])
    names = [F.col(f"c{i}") for i in range(k)]
    counted = work.groupingSets([[c] for c in names], *names).agg(
        F.count(F.lit(1)).alias("n"), F.grouping_id().alias("g")
    )
    best = []
    for i in range(k):
        own = (1 << k) - 1 - (1 << (k - 1 - i))
        hit = (F.col("g") == F.lit(own)) & F.col(f"c{i}").isNotNull()
        best.append(F.min(F.when(hit, F.struct((-F.col("n")).alias("n"), F.col(f"c{i}").alias("v")))).alias(f"m{i}"))
    row = counted.agg(*best).first()
    return {c: (row[f"m{i}"]["v"] if row[f"m{i}"] is not None else None) for i, c in enumerate(columns)}


def split_points(df: DataFrame, value: str, rows_per_bucket: int = BUCKET_ROWS) -> list[float]:
    """Ascending cut values that split a numeric column into ranges of about the given size."""
    v = col(value).cast("double")
    buckets = min(math.ceil(df.agg(F.count(v)).first()[0] / rows_per_bucket), MAX_BUCKETS)
    if buckets <= 1:
        return []
    probs = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    accuracy = F.lit(max(SKETCH_ACCURACY, 10 * buckets))
    return sorted(set(df.agg(F.approx_percentile(v, probs, accuracy)).first()[0]))


def with_bucket(df: DataFrame, value: str, cuts: Sequence[float], name: str = "__bucket") -> DataFrame:
    """Add the index of the value range each row falls in (0 when there are no cuts)."""
    if not cuts:
        return df.withColumn(name, F.lit(0))
    splits = [-float("inf"), *cuts, float("inf")]
    ready = df.withColumn("__bucket_in", col(value).cast("double"))
    cutter = Bucketizer(splits=splits, inputCol="__bucket_in", outputCol=name)
    return cutter.transform(ready).withColumn(name, F.col(name).cast("int")).drop("__bucket_in")


def running_totals(
    df: DataFrame,
    order: str,
    measures: Sequence[str],
    within: Sequence[str] = (),
    rows_per_bucket: int = BUCKET_ROWS,
    tie: Sequence[str] = (),
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """Sum of each measure over the rows strictly before, in ``order``, per group.

    Adds ``<measure>_before`` and ``<measure>_total``. A group of any size is
    spread over value ranges: rows are ordered only inside a range, and the
    range sums (at most ``MAX_BUCKETS`` per group) supply the offsets.
    ``order`` must be numeric and without nulls; give one row per value, or
    break ties with ``tie``. ``cuts`` brings range limits that are known already.
    """
    within = list(within)
    if cuts is None:
        cuts = split_points(df, order, rows_per_bucket)
    work = with_bucket(df, order, cuts)
    keys = [*within, "__bucket"]
    rows = Window.partitionBy(*[col(k) for k in keys]).orderBy(col(order), *[col(t) for t in tie])
    inner = rows.rowsBetween(Window.unboundedPreceding, -1)
    for m in measures:
        work = work.withColumn(f"{m}_before", F.coalesce(F.sum(col(m)).over(inner), F.lit(0)))
    ranges = with_bucket(df, order, cuts).groupBy(*[col(k) for k in keys]).agg(
        *[F.sum(col(m)).alias(f"__sum_{m}") for m in measures]
    )
    whole = Window.partitionBy(*[col(k) for k in within]) if within else Window.partitionBy(F.lit(0))
    earlier = whole.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(
        *[col(k).alias(f"__k_{i}") for i, k in enumerate(keys)],
        *[F.coalesce(F.sum(f"__sum_{m}").over(earlier), F.lit(0)).alias(f"__off_{m}") for m in measures],
        *[F.sum(f"__sum_{m}").over(whole).alias(f"{m}_total") for m in measures],
    )
    match = None
    for i, k in enumerate(keys):
        same = col(k).eqNullSafe(F.col(f"__k_{i}"))
        match = same if match is None else match & same
    joined = work.join(offsets, match, "left")
    return joined.select(
        *[col(c) for c in df.columns],
        *[(col(f"{m}_before") + F.col(f"__off_{m}")).alias(f"{m}_before") for m in measures],
        *[col(f"{m}_total") for m in measures],
    )


def group_medians(
    df: DataFrame, by: str, value: str, name: str = "median", rows_per_bucket: int = BUCKET_ROWS
) -> DataFrame:
    """Exact median per group as a lazy table (by, median); null keys are left out.

    Rows are first counted per (group, value), which spreads a hot group over
    its values; the two middle ranks are then located by running totals.
    """
    counted = (
        df.select(col(by).alias("__g"), _number(col(value)).alias("__v"))
        .where(F.col("__g").isNotNull() & F.col("__v").isNotNull())
        .groupBy("__g", "__v")
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    cuts = split_points(df.select(by, value), value, rows_per_bucket)
    ranked = running_totals(counted, "__v", ["__n"], ["__g"], cuts=cuts)
    low = F.floor((F.col("__n_total") - 1) / 2)
    high = F.ceil((F.col("__n_total") - 1) / 2)

    def holds(rank):
        return ((F.col("__n_before") <= rank) & (rank < F.col("__n_before") + F.col("__n"))).cast("int")

    weight = holds(low) + holds(high)
    return (
        ranked.where(weight > 0)
        .groupBy(F.col("__g").alias(by))
        .agg((F.sum(F.col("__v") * weight) / 2).alias(name))
    )
