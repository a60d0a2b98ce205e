"""Metric tree over points: grown level by level from samples, kept as tables, searched by bounds.

A node has a centre, the radius around it and the box of its points. Nodes of more than ``leaf_rows`` points are split:
a bounded sample of each gives up to ``fanout`` centres, and every point goes to the nearest one. Growing takes
a pass over the points per level, so its depth is the logarithm of their number. A search walks the tree from the root and
leaves out every node whose ball or box is out of reach, so a point is copied only to the leaves it can matter to.

Nodes reach the tasks in chunks of bounded bytes, a pass over the walkers per chunk: a large tree needs more passes, never
a larger broadcast.

Leaves are dealt into groups, subtrees or siblings of bounded bytes. Rows that meet the points of a tree are copied to the groups they
reach, not to the leaves: where no bound prunes, as in many dimensions, that is a few copies of a row and not one per leaf. The
leaves' bounds are asked again inside the group.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import stage

LEAF_ROWS = 4_096
FANOUT = 32
SAMPLE_PER_CHILD = 8
CHUNK_BYTES = 32 << 20
#: Rows of a distance matrix that are held at once.
STEP_ROWS = 512
#: Bytes of a group's points, and the least number of groups that a tree of more than one leaf aims at.
GROUP_BYTES = 16 << 20
GROUPS = 8
#: Rows that walk at once; their copies leave the task before the next ones walk.
WALK_ROWS = 1_024

def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(flat), -1)


def distances(a: np.ndarray, b: np.ndarray, p: int = 2) -> np.ndarray:
    """Distance matrix; exact differences for p = 1, Gram form for p = 2 (squared)."""
    if p == 1:
        out = np.empty((len(a), len(b)))
        for i in range(0, len(a), 16):
            out[i : i + 16] = np.abs(a[i : i + 16, None, :] - b[None, :, :]).sum(-1)
        return out
    return np.maximum((a**2).sum(1)[:, None] + (b**2).sum(1)[None, :] - 2.0 * a @ b.T, 0.0)


def metric(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """Distances from exact differences, for bounds that may not err."""
    out = np.empty((len(a), len(b)))
    for i in range(0, len(a), 16):
        gap = a[i : i + 16, None, :] - b[None, :, :]
        out[i : i + 16] = np.abs(gap).sum(-1) if p == 1 else np.sqrt((gap**2).sum(-1))
    return out


def _box_gaps(x: np.ndarray, low: np.ndarray, high: np.ndarray, p: int) -> np.ndarray:
    """Distance of each point to each box, 0 inside."""
    out = np.empty((len(x), len(low)))
    for i in range(0, len(x), 16):
        part = x[i : i + 16, None, :]
        gap = np.maximum(np.maximum(low[None] - part, part - high[None]), 0.0)
        out[i : i + 16] = gap.sum(-1) if p == 1 else np.sqrt((gap**2).sum(-1))
    return out


def ddl(schema: pa.Schema) -> str:
    """The Spark form of a schema of whole and real numbers."""
    return ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'double'}" for f in schema)


def wider(r):
    """A reach that no rounding can make too short."""
    return r * (1 + 1e-9) + 1e-9


@dataclass
class _Chunk:
    """Children of some nodes, parent by parent."""

    parents: np.ndarray
    starts: np.ndarray
    ids: np.ndarray
    n: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    low: np.ndarray
    high: np.ndarray
    group: np.ndarray

    @staticmethod
    def of(rows: pa.Table) -> _Chunk:
        rows = rows.sort_by([("parent", "ascending"), ("node", "ascending")])
        parents, starts = np.unique(rows.column("parent").to_numpy(), return_index=True)
        box = [matrix(rows.column(c)) for c in ("centre", "low", "high")]
        return _Chunk(parents, np.append(starts, len(rows)), rows.column("node").to_numpy(), rows.column("n").to_numpy(), box[0], rows.column("radius").to_numpy(), box[1], box[2], rows.column("group").fill_null(-1).to_numpy())

    def children(self, node: int) -> tuple[int, int] | None:
        at = int(np.searchsorted(self.parents, node))
        return (int(self.starts[at]), int(self.starts[at + 1])) if at < len(self.parents) and self.parents[at] == node else None


def _by_node(nodes: np.ndarray):
    order = np.argsort(nodes, kind="stable")
    cuts = np.flatnonzero(np.diff(nodes[order])) + 1
    return [(int(nodes[part[0]]), part) for part in np.split(order, cuts) if len(part)]


def _nearest_leaf(chunk: _Chunk, x: np.ndarray, node: np.ndarray, gap: np.ndarray, bound: np.ndarray, need: int, p: int) -> None:
    """Walk down to the nearest child, in place; ``bound`` keeps the least distance within which ``need`` points are known."""
    todo = _by_node(node)
    while todo:
        name, rows = todo.pop()
        found = chunk.children(name)
        if found is None:
            continue
        s, e = found
        for i in range(0, len(rows), STEP_ROWS):
            some = rows[i : i + STEP_ROWS]
            d = metric(x[some], chunk.centre[s:e], p)
            best = d.argmin(1)
            node[some], gap[some] = chunk.ids[s + best], d[np.arange(len(some)), best]
            if need:
                far = np.where(chunk.n[s:e] >= need, d + chunk.radius[s:e], np.inf)
                bound[some] = np.minimum(bound[some], far.min(1))
        todo += [(name, rows[part]) for name, part in _by_node(node[rows])]


def _reached(chunk: _Chunk, x: np.ndarray, r: np.ndarray, node: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, node) for all nodes that may hold a point within ``r``; nodes without children in the chunk end the walk."""
    out, todo = [], _by_node(node)
    while todo:
        name, rows = todo.pop()
        found = chunk.children(name)
        if found is None:
            out.append((rows, np.full(len(rows), name)))
            continue
        s, e = found
        for i in range(0, len(rows), STEP_ROWS):
            some = rows[i : i + STEP_ROWS]
            reach = wider(r[some])[:, None]
            d = metric(x[some], chunk.centre[s:e], p)
            near = d - chunk.radius[s:e] <= reach
            # a point went to its nearest centre, so none within reach lies with one that is farther by more than twice the reach
            near &= d * (1 - 1e-12) <= d.min(1, keepdims=True) * (1 + 1e-12) + 2 * reach
            near &= _box_gaps(x[some], chunk.low[s:e], chunk.high[s:e], p) <= reach
            todo += [(int(chunk.ids[s + j]), some[near[:, j]]) for j in range(e - s) if near[:, j].any()]
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


def _chunks(nodes: DataFrame, d: int, limit: int) -> list:
    """The nodes' children as broadcasts of about ``limit`` bytes, parents before their children."""
    spark = nodes.sparkSession
    total = nodes.count()
    per = max(1, limit // (8 * (3 * d + 4)))
    if total <= per:
        ranges = [(None, None)] if total else []
    else:  # parents are numbered level by level, so ranges of parents are in the order of a walk
        ends = nodes.select(F.col("parent").cast("double").alias("v")).approxQuantile("v", [i / math.ceil(total / per) for i in range(1, math.ceil(total / per))], 0.001)
        marks = sorted(set(ends))
        ranges = list(zip([None, *marks], [*marks, None], strict=True))
    found = []
    for low, high in ranges:
        some = nodes if low is None else nodes.where(F.col("parent") > low)
        some = some if high is None else some.where(F.col("parent") <= high)
        rows = some.toArrow()
        if rows.num_rows:
            found.append(spark.sparkContext.broadcast(_Chunk.of(rows)))
    return found


def _walk(rows: DataFrame, chunks: list, step) -> DataFrame:
    """``step(chunk, batch)`` over all chunks one after another; a row stays as it is where its node is not in the chunk.

    Between two chunks the rows are written, so a task never holds more than one chunk and one Python worker.
    """
    for i, chunk in enumerate(chunks):

        def run(batches, chunk=chunk):
            for batch in batches:
                for at in range(0, batch.num_rows, WALK_ROWS):
                    yield step(chunk.value, batch.slice(at, WALK_ROWS))

        rows = (stage(rows, "tree-walk") if i else rows).mapInArrow(run, rows.schema)
    return rows


def _replaced(batch: pa.RecordBatch, **columns) -> pa.RecordBatch:
    arrays = [pa.array(columns[f.name], f.type) if f.name in columns else batch.column(f.name) for f in batch.schema]
    return pa.RecordBatch.from_arrays(arrays, schema=batch.schema)


def _descend(need: int, p: int):
    def step(chunk, batch):
        node, gap, bound = (batch.column(c).to_numpy(zero_copy_only=False).copy() for c in ("node", "gap", "bound"))
        _nearest_leaf(chunk, matrix(batch.column("x")), node, gap, bound, need, p)
        return _replaced(batch, node=node, gap=gap, bound=bound)

    return step


def _spread(p: int):
    def step(chunk, batch):
        row, node = _reached(chunk, matrix(batch.column("x")), batch.column("r").to_numpy(), batch.column("node").to_numpy(), p)
        return _replaced(batch.take(pa.array(row)), node=node)

    return step


def _gather(p: int):
    """A row per group in reach: nodes that belong to a group end the walk."""

    def step(chunk, batch):
        row, node = _reached(chunk, matrix(batch.column("x")), batch.column("r").to_numpy(), batch.column("node").to_numpy(), p)
        group = batch.column("group").to_numpy()[row]
        at = np.minimum(np.searchsorted(chunk.ids, node), len(chunk.ids) - 1)
        group = np.where((chunk.ids[at] == node) & (group < 0), chunk.group[at], group)
        _, first = np.unique(np.column_stack([row, group, np.where(group < 0, node, -1)]), axis=0, return_index=True)
        return _replaced(batch.take(pa.array(row[first])), node=node[first], group=group[first])

    return step


def group_rows(n: int, d: int, leaf_rows: int = LEAF_ROWS) -> int:
    """Points of a group: bounded in bytes, and few enough that several tasks share the work."""
    return min(max(1, GROUP_BYTES // (8 * d)), max(1, leaf_rows // 2, math.ceil(n / GROUPS)))


def _dealt(nodes: pa.Table, limit: int) -> dict[int, int | None]:
    """The group of each node (node, parent, n): nodes up to ``limit`` points join their siblings; larger ones leave it to their children."""
    nodes = nodes.sort_by("node")  # a parent's number is less than its children's
    columns = [nodes.column(c).to_pylist() for c in ("node", "parent", "n")]
    inner, group, filling = set(columns[1]), {}, {}
    for node, parent, n in zip(*columns, strict=True):
        if group.get(parent) is not None:
            group[node] = group[parent]
        elif n > limit and node in inner:
            group[node] = None
        else:
            name, held = filling.get(parent, (node, limit))
            name, held = (node, 0) if held + n > limit else (name, held)
            group[node], filling[parent] = name, (name, held + n)
    return group


def _in_reach(x: np.ndarray, r: np.ndarray, points: np.ndarray, p: int) -> np.ndarray:
    """Numbers of the rows whose reach touches the ball and the box of some points."""
    norm = (lambda v: np.abs(v).sum(1)) if p == 1 else (lambda v: np.sqrt((v**2).sum(1)))
    centre, reach = points.mean(0), wider(r)
    rows = np.flatnonzero(norm(x - centre) - wider(norm(points - centre).max()) <= reach)
    low, high, x = points.min(0), points.max(0), x[rows]
    return rows[norm(np.maximum(np.maximum(low - x, x - high), 0.0)) <= reach[rows]]


def _level_start(level: int, fanout: int) -> int:
    return (fanout**level - 1) // (fanout - 1)


def _box(rows: DataFrame, d: int) -> DataFrame:
    """(node, n, radius, low, high) of the points of each node."""
    ends = [F.array(*[end(F.col("x")[i]) for i in range(d)]).alias(name) for end, name in ((F.min, "low"), (F.max, "high"))]
    return rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.max("gap").alias("radius"), *ends)


def _choose(fanout: int, leaf_rows: int):
    """Up to ``fanout`` different points of a node's sample as centres, those drawn first; no more than half-full leaves need."""

    def run(table: pa.Table) -> pa.Table:
        x = matrix(table.column("x"))[np.argsort(table.column("u").to_numpy(), kind="stable")]
        _, first = np.unique(x, axis=0, return_index=True)
        most = min(fanout, max(2, -(-2 * table.column("n")[0].as_py() // leaf_rows)))
        x, node = x[np.sort(first)[:most]], table.column("node")[0].as_py()
        if len(x) < 2:
            x = x[:0]
        ids = node * fanout + 1 + np.arange(len(x))
        return pa.table({"parent": pa.array(np.full(len(x), node), pa.int64()), "node": pa.array(ids, pa.int64()), "centre": pa.array(list(x), pa.list_(pa.float64()))})

    return run


@dataclass
class MetricTree:
    """``nodes`` (node, parent, n, centre, radius, low, high, group), root 0, and ``rows``: the points with the ``node`` of their leaf and its ``group``."""

    nodes: DataFrame
    rows: DataFrame
    d: int
    p: int
    chunk_bytes: int = CHUNK_BYTES
    group_rows: int | None = None

    def __post_init__(self):
        root = self.nodes.where("parent is null").select("n", "group").first()
        self.parted = not self.nodes.where("parent is not null").isEmpty()
        self.group_rows = self.group_rows or group_rows(root["n"], self.d)
        self._one_group = root["group"]
        self._sent = self._coarse = None

    def _children(self) -> list:
        if self._sent is None:
            self._sent = _chunks(self.nodes.where("parent is not null"), self.d, self.chunk_bytes) if self.parted else []
        return self._sent

    def own_leaf(self, asked: DataFrame, need: int) -> DataFrame:
        """``asked`` (with ``x``) and the leaf it falls to (``node``) and a distance that is known to hold ``need`` points (``bound``)."""
        start = asked.withColumns({"node": F.lit(0).cast("long"), "gap": F.lit(0.0), "bound": F.lit(math.inf)})
        return _walk(start, self._children(), _descend(need, self.p)).drop("gap")

    def within(self, asked: DataFrame) -> DataFrame:
        """A row of ``asked`` (with ``x`` and a reach ``r``) for each leaf (``node``) that may hold a point in reach."""
        return _walk(asked.withColumn("node", F.lit(0).cast("long")), self._children(), _spread(self.p))

    def leaf_groups(self, fallen: DataFrame) -> DataFrame:
        """``fallen`` (with the ``node`` of a leaf) and the ``group`` of that leaf."""
        return fallen.join(self.nodes.select("node", "group"), "node")

    def groups_within(self, asked: DataFrame) -> DataFrame:
        """A row of ``asked`` (with ``q``, ``x`` and a reach ``r``) for each ``group`` that may hold a point in reach."""
        if self._one_group is not None:
            return asked.withColumn("group", F.lit(self._one_group).cast("long"))
        if self._coarse is None:
            large = self.nodes.where("group is null").select(F.col("node").alias("parent"))
            self._coarse = _chunks(self.nodes.join(large, "parent", "left_semi"), self.d, self.chunk_bytes)
        start = asked.withColumns({"node": F.lit(0).cast("long"), "group": F.lit(-1).cast("long")})
        walked = _walk(start, self._coarse, _gather(self.p)).drop("node")
        return walked if len(self._coarse) == 1 else walked.dropDuplicates(["q", "group"])

    def join(self, asked: DataFrame, refs: DataFrame, visitor: Callable[[pa.Table, pa.Table], object], schema: pa.Schema, block_rows: int) -> DataFrame:
        """What ``visitor(asked, refs)`` returns for the rows that meet in a group, both cut into parts of bounded rows.

        ``asked`` has ``x``, a number ``q`` of its own, ``group``, and either the ``node`` of the one leaf it meets or a reach ``r`` (and
        maybe ``own``, a leaf that it does not meet); ``refs`` has ``x``, ``node``, ``group`` and a number ``place``. A visitor's
        ``meet(rows, start, end)`` is called for rows of ``asked`` and blocks of up to ``block_rows`` rows of ``refs``, leaf by
        leaf, then ``result()``. A crowded group is many parts, none of which grows.
        """
        limit, p = float(self.group_rows), self.p
        parts = lambda n: F.ceil(F.col(n) / F.lit(limit)).cast("int")
        sizes = asked.groupBy("group").agg(F.count(F.lit(1)).alias("nq")).join(refs.groupBy("group").agg(F.count(F.lit(1)).alias("nr")), "group")
        plan = stage(sizes.select("group", parts("nq").alias("q_parts"), parts("nr").alias("r_parts")), "tree-plan")

        def cut(rows, own, key, other, mine):
            rows = rows.join(F.broadcast(plan), "group").withColumn(mine, F.pmod(F.xxhash64(key, F.lit(7)), F.col(own)).cast("int"))
            rows = rows.withColumn("q_part" if mine == "r_part" else "r_part", F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop("q_parts", "r_parts")
            return rows.select(*[F.col(c).alias(c) for c in rows.columns])  # both sides may come from one table

        left, right = cut(asked, "q_parts", "q", "r_parts", "q_part"), cut(refs, "r_parts", "place", "q_parts", "r_part")

        def run(a: pa.Table, b: pa.Table) -> pa.Table:
            if not a.num_rows or not b.num_rows:
                return schema.empty_table()
            b = b.sort_by("node")
            visit, xa, xb, leaf = visitor(a, b), matrix(a.column("x")), matrix(b.column("x")), b.column("node").to_numpy()
            mine, own, r = (a.column(c).to_numpy() if c in a.column_names else None for c in ("node", "own", "r"))
            cuts = [0, *(np.flatnonzero(np.diff(leaf)) + 1).tolist(), len(leaf)]
            for start, end in zip(cuts, cuts[1:]):
                if mine is not None:
                    rows = np.flatnonzero(mine == leaf[start])
                else:
                    rows = _in_reach(xa, r, xb[start:end], p)
                    rows = rows if own is None else rows[own[rows] != leaf[start]]
                for at in range(start, end, block_rows):
                    for i in range(0, len(rows), STEP_ROWS):
                        visit.meet(rows[i : i + STEP_ROWS], at, min(at + block_rows, end))
            return visit.result()

        keys = ["group", "q_part", "r_part"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, ddl(schema))

    def save(self, path: str) -> None:
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        self.rows.write.mode("overwrite").parquet(f"{path}/rows")

    @staticmethod
    def load(spark: SparkSession, path: str, p: int) -> MetricTree:
        nodes, rows = spark.read.parquet(f"{path}/nodes"), spark.read.parquet(f"{path}/rows")
        return MetricTree(nodes, rows, nodes.select(F.size("low")).first()[0], p)


def grow_tree(points: DataFrame, p: int = 2, leaf_rows: int = LEAF_ROWS, fanout: int = FANOUT, chunk_bytes: int = CHUNK_BYTES) -> MetricTree:
    """Tree over ``points``, which have a list ``x`` of equal lengths and a number ``place``; other columns travel along.

    Equal points are best merged before: a node of equal points only cannot be split and stays a crowded leaf.
    Raises ValueError on an empty table or lists of several lengths.
    """
    if fanout < 2:
        raise ValueError("a node needs two children at least")
    rows = stage(points.withColumns({"node": F.lit(0).cast("long"), "gap": F.lit(0.0), "bound": F.lit(math.inf)}), "tree-points")
    sizes = [r[0] for r in rows.select(F.size("x").alias("n")).distinct().limit(2).collect()]
    if not sizes:
        raise ValueError("no reference points")
    if len(sizes) > 1:
        raise ValueError("points differ in length")
    d, draws, level = sizes[0], SAMPLE_PER_CHILD * fanout, 0
    root = _box(rows, d).select("node", F.lit(None).cast("long").alias("parent"), "n", F.col("low").alias("centre"), F.lit(math.inf).alias("radius"), "low", "high")
    found = [stage(root, "tree-nodes")]
    deepest = int(62 / math.log2(fanout))
    while level < deepest:
        open_ = found[-1].where((F.col("n") > leaf_rows) & (F.col("low") != F.col("high")))
        if open_.isEmpty():
            break
        unit = F.pmod(F.xxhash64(F.lit("tree-sample"), "place", F.lit(level)), F.lit(1 << 30)) / F.lit(float(1 << 30))
        some = rows.where(F.col("node") >= _level_start(level, fanout)).select("node", "x", unit.alias("u")).where(F.col("u") < min(1.0, draws / leaf_rows))
        drawn = some.join(open_.select("node", "n"), "node").where(F.col("u") * F.col("n") < draws).select("node", "x", "u", "n")
        centres = stage(drawn.groupBy("node").applyInArrow(_choose(fanout, leaf_rows), "parent long, node long, centre array<double>"), "tree-centres")
        blank = F.col("centre")
        sent = _chunks(centres.select("node", "parent", F.lit(0).cast("long").alias("n"), "centre", F.lit(0.0).alias("radius"), blank.alias("low"), blank.alias("high"), F.lit(None).cast("long").alias("group")), d, chunk_bytes)
        rows = stage(_walk(rows, sent, _descend(0, p)), "tree-points")
        level += 1
        boxes = _box(rows.where(F.col("node") >= _level_start(level, fanout)), d)
        found.append(stage(boxes.join(centres, "node").select("node", "parent", "n", "centre", "radius", "low", "high"), "tree-nodes"))
    nodes = found[0]
    for more in found[1:]:
        nodes = nodes.unionByName(more)
    limit = group_rows(found[0].first()["n"], d, leaf_rows)
    dealt = _dealt(nodes.select("node", "parent", "n").toArrow(), limit)  # a row per node
    groups = nodes.sparkSession.createDataFrame(pa.table({"node": pa.array(list(dealt), pa.int64()), "group": pa.array(list(dealt.values()), pa.int64())}))
    nodes = stage(nodes.join(groups, "node"), "tree-nodes")
    rows = rows.drop("gap", "bound").join(nodes.select("node", "group"), "node")
    return MetricTree(nodes, rows, d, p, chunk_bytes, limit)
