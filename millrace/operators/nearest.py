"""Exact neighbour search without a cross join, on a metric tree.

Equal points are merged to places first, so a point that repeats is no crowd. Every query falls to one leaf, whose
points bound the distance of its k-th neighbour; it then visits the other leaves that reach within this bound. Leaves meet
in groups of bounded size on both sides, block by block; a group is handled by matrix kernels in one task
and hands back at most a few rows per point, never its pairs.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.tree import FANOUT, LEAF_ROWS, MetricTree, ddl, distances, group_rows, grow_tree, matrix
from millrace.session import col, stage

BLOCK_ROWS = 4_096


def as_points(df: DataFrame, key: str, features: str, payload: str | None = None) -> DataFrame:
    """Columns id (bigint), x (array<double>), p (double payload). Rows may share an id; each is a point of its own."""
    kind = df.schema[features].dataType
    x = col(features).cast("array<double>") if isinstance(kind, T.ArrayType) else vector_to_array(col(features))
    p = col(payload).cast("double") if payload else F.lit(0.0)
    return df.select(col(key).cast("bigint").alias("id"), x.alias("x"), p.alias("p"))


def numbered(points: DataFrame, name: str) -> DataFrame:
    """Points with a number of their own (``row``), written so that the number stays. Points without coordinates are left out."""
    return stage(points.where(F.col("x").isNotNull()).withColumn("row", F.monotonically_increasing_id()), name)


def known_points(refs: DataFrame, need: int, p: int = 2, leaf_rows: int = LEAF_ROWS, fanout: int = FANOUT) -> MetricTree:
    """Tree over the places of numbered points; a place lists its first ``need`` points by (id, row): ids, rows, payloads."""
    first = Window.partitionBy("x").orderBy("id", "row")
    few = refs.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= need)
    listed = few.groupBy("x").agg(F.sort_array(F.collect_list(F.struct("id", "row", "p"))).alias("held"))
    places = listed.select("x", F.col("held.id").alias("ids"), F.col("held.row").alias("rows"), F.col("held.p").alias("ps"))
    return grow_tree(places.withColumn("place", F.monotonically_increasing_id()), p, leaf_rows, fanout)


_FOUND = pa.schema([("q", pa.int64()), ("ref_id", pa.int64()), ("ref_row", pa.int64()), ("distance", pa.float64()), ("payload", pa.float64())])


class _Closest:
    """The first ``need`` points by (distance, id, row) that a group's places hold for each asked row, none beyond its reach ``r``."""

    def __init__(self, need: int, p: int, asked: pa.Table, places: pa.Table):
        self.need, self.p, self.q = need, p, asked.column("q").to_numpy()
        self.a, self.b = matrix(asked.column("x")), matrix(places.column("x"))
        lists = [places.column(c).combine_chunks() for c in ("ids", "rows", "ps")]
        starts = lists[0].offsets.to_numpy().astype(np.int64)
        self.starts, (self.ids, self.rows, self.pays) = starts - starts[0], (c.flatten().to_numpy(zero_copy_only=False) for c in lists)
        self.limit = asked.column("r").to_numpy().copy() if "r" in asked.column_names else np.full(len(self.q), np.inf)
        self.found, self.n = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))], 0
        self.most = max(1 << 17, 4 * need * len(self.q))

    def meet(self, rows: np.ndarray, start: int, end: int) -> None:
        a, b, need = self.a[rows], self.b[start:end], self.need
        rough, limit = distances(a, b, self.p), self.limit[rows]
        limit = limit if self.p == 1 else limit**2
        # the Gram form errs in proportion to the squared lengths of both points
        slack = 1e-9 * (1.0 + (a**2).sum(1) + (b**2).sum(1).max())
        near = rough <= (limit * (1 + 1e-9) + slack)[:, None]
        if end - start > need and near.sum() > 4 * need * len(rows):
            kth = np.partition(rough, need - 1, axis=1)[:, need - 1]
            near &= rough <= (kth * (1 + 1e-9) + slack)[:, None]
        i, j = np.nonzero(near)
        if not len(i):
            return
        gap = a[i] - b[j]
        exact = np.abs(gap).sum(1) if self.p == 1 else np.sqrt((gap**2).sum(1))
        j = j + start
        size = self.starts[j + 1] - self.starts[j]
        each = np.repeat(np.arange(len(j)), size)
        at = np.repeat(self.starts[j] - (np.cumsum(size) - size), size) + np.arange(len(each))
        self.found.append((rows[i[each]], at, exact[each]))
        self.n += len(at)
        if self.n > self.most:
            self._first()

    def _first(self) -> None:
        row, at, exact = (np.concatenate(c) for c in zip(*self.found, strict=True))
        order = np.lexsort((self.rows[at], self.ids[at], exact, row))
        row, at, exact = row[order], at[order], exact[order]
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        last = nth == self.need - 1
        self.limit[row[last]] = np.minimum(self.limit[row[last]], exact[last])
        kept = nth < self.need
        self.found, self.n = [(row[kept], at[kept], exact[kept])], 0

    def result(self) -> pa.Table:
        self._first()
        row, at, exact = self.found[0]
        return pa.table([pa.array(v, f.type) for v, f in zip((self.q[row], self.ids[at], self.rows[at], exact, self.pays[at]), _FOUND, strict=True)], schema=_FOUND)


def closest_points(asked: DataFrame, tree: MetricTree, need: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The first ``need`` known points of each ``asked`` (q, x): (q, ref_id, ref_row, distance, payload), by distance, id, row."""
    visitor, order = partial(_Closest, need, tree.p), Window.partitionBy("q").orderBy("distance", "ref_id", "ref_row")

    def first(found: DataFrame) -> DataFrame:
        return found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= need).drop("nth")

    fallen = tree.leaf_groups(tree.own_leaf(asked, need))
    if not tree.parted:
        return first(tree.join(fallen.select("q", "x", "node", "group"), tree.rows, visitor, _FOUND, block_rows))
    fallen = stage(fallen, "nearest-asked")
    own = stage(first(tree.join(fallen.select("q", "x", "node", "group"), tree.rows, visitor, _FOUND, block_rows)), "nearest-own")
    kth = own.groupBy("q").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("far"))
    reach = F.least("bound", F.when(F.col("n") >= need, F.col("far")).otherwise(F.lit(math.inf)))
    walkers = fallen.join(kth, "q", "left").select("q", "x", F.col("node").alias("own"), reach.alias("r"))
    beyond = tree.groups_within(walkers)
    return first(own.unionByName(tree.join(beyond, tree.rows, visitor, _FOUND, block_rows)))


def nearest_neighbours(
    queries: DataFrame,
    refs: DataFrame,
    k: int,
    p: int = 2,
    exclude_self: bool = False,
    leaf_rows: int = LEAF_ROWS,
    fanout: int = FANOUT,
    block_rows: int = BLOCK_ROWS,
    tree: MetricTree | None = None,
) -> DataFrame:
    """The k nearest references of each query row: id, row, ref_id, distance, payload, position.

    Both inputs come from ``as_points``. ``row`` numbers the query rows, so rows that share an id stay apart. Ties go
    to the smaller reference id, then to the one that comes first. ``exclude_self`` leaves out the row itself where both
    inputs are the same table, other rows of its id not; between two tables it leaves out the query's id. ``tree``
    is one that ``known_points`` grew for ``refs`` earlier, with lists long enough for ``k``. Points without coordinates take no part.
    """
    need = k + int(exclude_self)
    asked_rows = numbered(queries, "nearest-queries")
    same = queries is refs
    if exclude_self and not same:
        copies = refs.groupBy("id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
        need = k + copies  # so many rows may share the query's id
    if tree is None:
        tree = known_points(asked_rows if same else numbered(refs, "nearest-refs"), need, p, leaf_rows, fanout)
    asked = stage(asked_rows.select("x").distinct().withColumn("q", F.monotonically_increasing_id()), "nearest-places")
    found = closest_points(asked, tree, need, block_rows)
    rows = asked_rows.join(asked, "x").select("id", "row", "q").join(found, "q")
    if exclude_self:
        rows = rows.where(F.col("ref_row") != F.col("row") if same else F.col("ref_id") != F.col("id"))
    order = Window.partitionBy("row").orderBy("distance", "ref_id", "ref_row")
    ranked = rows.withColumn("position", F.row_number().over(order)).where(F.col("position") <= k)
    return ranked.select("id", "row", "ref_id", "distance", "payload", "position")


def all_block_pairs(queries: DataFrame, refs: DataFrame, kernel, schema: pa.Schema, block_rows: int | None = None) -> DataFrame:
    """``kernel(queries, refs)`` for all pairs of blocks of two numbered tables: for results that need every pair by definition.

    A row is copied once per block of the other table, so blocks are as large as a task may hold unless ``block_rows`` is given.
    """

    def parts(rows: DataFrame) -> int:
        n, first = rows.count(), rows.select(F.size("x")).first()
        return max(1, math.ceil(n / (block_rows or group_rows(n, max(1, first[0]))))) if first else 1

    q_parts, r_parts = parts(queries), parts(refs)

    def cut(rows, own, mine, other, theirs):
        rows = rows.withColumn(mine, F.pmod(F.xxhash64("row", F.lit(7)), F.lit(own)).cast("int"))
        return rows.withColumn(theirs, F.explode(F.sequence(F.lit(0), F.lit(other - 1)))).groupBy("q_part", "r_part")

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        return kernel(a, b) if a.num_rows and b.num_rows else schema.empty_table()

    left, right = cut(queries, q_parts, "q_part", r_parts, "r_part"), cut(refs, r_parts, "r_part", q_parts, "q_part")
    return left.cogroup(right).applyInArrow(run, ddl(schema))


def approximate_neighbours(
    queries: DataFrame, refs: DataFrame, k: int, features: str, key: str, bucket_length: float, tables: int = 4, radius: float = math.inf
) -> DataFrame:
    """Bucketed random projections (Spark ML) as the approximate option for large inputs."""
    lsh = BucketedRandomProjectionLSH(
        inputCol=features, outputCol="__hash", bucketLength=bucket_length, numHashTables=tables, seed=42
    )
    pairs = lsh.fit(refs).approxSimilarityJoin(queries, refs, radius, distCol="distance")
    flat = pairs.select(col("datasetA").getField(key).alias("id"), col("datasetB").getField(key).alias("ref_id"), "distance")
    order = Window.partitionBy("id").orderBy("distance", "ref_id")
    return flat.withColumn("position", F.row_number().over(order)).where(F.col("position") <= k)


def _per_query(neighbours: DataFrame) -> list[str]:
    return [c for c in ("id", "row") if c in neighbours.columns]


def vote(neighbours: DataFrame, weights: str = "uniform") -> DataFrame:
    """Majority class (smallest on a tie) and the share of class 1 per query row."""
    w, keys = _vote_weight(weights), _per_query(neighbours)
    per = neighbours.groupBy(*keys, "payload").agg(F.sum(w).alias("w"))
    return per.groupBy(*keys).agg(
        F.min(F.struct((-F.col("w")).alias("w"), F.col("payload").alias("v")))["v"].alias("prediction"),
        F.try_divide(F.sum(F.when(F.col("payload") == 1, F.col("w")).otherwise(0.0)), F.sum("w")).alias("score"),
    )


def average(neighbours: DataFrame, weights: str = "uniform") -> DataFrame:
    """(Weighted) mean payload per query row; a query that hits references exactly takes their mean."""
    w = _vote_weight(weights)
    return neighbours.groupBy(*_per_query(neighbours)).agg((F.sum(w * F.col("payload")) / F.sum(w)).alias("prediction"))


def _vote_weight(weights: str):
    if weights == "uniform":
        return F.lit(1.0)
    # An exact hit outweighs every finite distance.
    return F.when(F.col("distance") == 0, F.lit(1e150)).otherwise(1.0 / F.col("distance"))
