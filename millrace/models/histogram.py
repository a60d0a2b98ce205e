"""Histogram gradient boosting: gradients summed per (leaf, feature, bin) in Spark, trees grown best leaf first.

Rows are binned once; rows of equal bins are one cell with their number, weight and mean label, as gradients and Hessians are linear in these. Cells
are kept as blocks of bytes, a feature after the other. A pass over them sends each cell down the tree
so far and adds its gradient and Hessian to the histograms of the leaves that are asked for, features of few bins in one joint histogram; the
partitions' histograms are summed and give each leaf's best split: by the driver where partitions are few, else by a group per leaf, so what
the driver sees is bounded, whatever the number of rows. Leaves are opened ahead of their
turn: a pass takes all leaves that the best-first order may need next, so a tree costs about as many passes as it is deep.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.models.cells import matrix
from millrace.session import stage

MAX_BINS = 255
LEAST_HESSIAN = 1e-3
#: Trees that passes walk beside the kept scores before these are written anew.
WRITE_EVERY = 10
_WIDTH = 256
#: Cells of a block, the least of a partition where there are cores for more, and bytes of blocks in a partition where each core has one.
BLOCK_ROWS = 1 << 15
PART_ROWS = 1 << 12
PART_BYTES = 32 << 20
#: Bins of a joint histogram, and partitions whose histograms the driver sums.
JOINT = 1 << 10
FEW_PARTS = 32
_BLOCKS = "n int, bins binary, y binary, w binary, raw binary, rows binary"


@dataclass
class HistTree:
    """Nodes as arrays: a row goes left where its bin is at most ``bin``; ``left`` is -1 in a leaf."""

    feature: list[int]
    bin: list[int]
    left: list[int]
    right: list[int]
    value: list[float]

    def leaves(self, bins: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """The rows that end in each leaf, for leaves that hold any."""
        found, todo = [], [(0, np.arange(len(bins)))]
        while todo:
            node, rows = todo.pop()
            if self.left[node] < 0:
                found.append((node, rows))
                continue
            low = bins[:, self.feature[node]][rows] <= self.bin[node]
            todo += [(child, part) for child, part in ((self.left[node], rows[low]), (self.right[node], rows[~low])) if len(part)]
        return found

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row: a split at a time over whole columns, parents before their children."""
        at = np.zeros(len(bins), np.uint16 if len(self.left) < 1 << 16 else np.int64)
        kind = at.dtype.type
        for node, (feature, cut, left, right) in enumerate(zip(self.feature, self.bin, self.left, self.right, strict=True)):
            if left < 0:
                continue
            low, high = (left, right) if left < right else (right, left)
            side = bins[:, feature] > cut if left < right else bins[:, feature] <= cut
            step = side * kind(high - low)
            step += kind(low - node)
            step *= at == node
            at += step
        return at

    def score(self, bins: np.ndarray) -> np.ndarray:
        return np.asarray(self.value, float)[self.nodes(bins)]


def bin_rows(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bin of each value: the number of edges below it; missing values are above all edges."""
    return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1).astype(np.uint8)


@dataclass
class HistModel:
    """Boosted trees with their bins; ``loss`` is ``log_loss`` (labels 0 and 1) or ``squared_error``."""

    edges: list[np.ndarray]
    base: float
    loss: str
    trees: list[HistTree] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        model = self

        @F.arrow_udf("double")
        def raw(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for column in columns:
                bins = np.asfortranarray(bin_rows(matrix(column), model.edges)) if len(column) else np.zeros((0, len(model.edges)), np.uint8)
                yield pa.array(sum((t.score(bins) for t in model.trees), np.full(len(bins), model.base)))

        scored = df.withColumn("__raw", raw(vector_to_array("features")))
        if self.loss == "squared_error":
            return scored.withColumn("prediction", F.col("__raw")).drop("__raw")
        score = 1 / (1 + F.exp(-F.col("__raw")))
        return scored.withColumns({"prediction": (F.col("__raw") > 0).cast("double"), "score": score}).drop("__raw")

    def to_dict(self) -> dict:
        return {"edges": [e.tolist() for e in self.edges], "base": self.base, "loss": self.loss, "trees": [vars(t) for t in self.trees]}

    @staticmethod
    def from_dict(d: dict) -> HistModel:
        return HistModel([np.array(e, float) for e in d["edges"]], d["base"], d["loss"], [HistTree(**t) for t in d["trees"]])

    def __repr__(self):
        return f"HistModel({self.loss}, {len(self.trees)} trees, {json.dumps([len(e) for e in self.edges])} edges)"


def bin_edges(df: DataFrame, features: str = "features", max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """Upper ends of the bins of each feature: its quantiles, or all its values where they are few. One aggregate."""
    if not 2 <= max_bins <= MAX_BINS:
        raise ValueError(f"bins are numbered from 0 to {MAX_BINS}")
    x = df.select(vector_to_array(features).alias("x")) if df.schema[features].dataType.typeName() != "array" else df.select(F.col(features).alias("x"))
    first = x.first()
    if first is None:
        raise ValueError("no training rows")
    marks = [i / max_bins for i in range(1, max_bins)]
    value = [F.when(~F.isnan(v), v) for v in (F.col("x")[j] for j in range(len(first[0])))]
    x = x.coalesce(df.sparkSession.sparkContext.defaultParallelism)  # one task merges a sketch per partition
    found = x.agg(*[F.percentile_approx(v, marks, 10_000).alias(f"q{j}") for j, v in enumerate(value)]).first()
    return [np.unique(np.array(q or [], float)) for q in found]


@dataclass
class _Leaf:
    g: float
    h: float
    n: int
    split: tuple | None = None  # (gain, feature, bin, g, h, n of the left side); None: not known or not worth it
    known: bool = False
    children: tuple[int, int] | None = None


class _Grower:
    """One tree: leaves by number, opened where the best-first order may come to them."""

    def __init__(self, max_leaves: int, least: int):
        self.max_leaves, self.least = max_leaves, least
        self.leaves = [_Leaf(0.0, 0.0, 0)]

    def order(self) -> tuple[list[int], list[int]]:
        """(nodes split best first, leaves whose own best split must be known before that order is sure)."""
        if not self.leaves[0].known:
            return [], [0]
        heap, split, asked, count = [], [], [], 1

        def push(name):
            leaf = self.leaves[name]
            if not leaf.known:
                asked.append(name)
            elif leaf.split is not None:
                heapq.heappush(heap, (-leaf.split[0], name))

        push(0)
        while heap and count < self.max_leaves:
            _, name = heapq.heappop(heap)
            split.append(name)
            count += 1
            if count == self.max_leaves and not asked:
                break  # nothing that could come earlier is unknown
            for child in self.open(name):
                push(child)
        return split, asked

    def open(self, name: int) -> tuple[int, int]:
        leaf = self.leaves[name]
        if leaf.children is None:
            _, _, _, g, h, n = leaf.split
            leaf.children = (len(self.leaves), len(self.leaves) + 1)
            for part in ((g, h, n), (leaf.g - g, leaf.h - h, leaf.n - n)):
                self.leaves.append(_Leaf(*part, known=part[2] < 2 * self.least))
        return leaf.children

    def structure(self) -> HistTree:
        """All opened leaves as a tree, to send rows down."""
        rows = [(l.split[1], l.split[2], *l.children) if l.children else (0, 0, -1, -1) for l in self.leaves]  # noqa: E741
        return HistTree(*[list(c) for c in zip(*rows, strict=True)], [0.0] * len(rows))

    def tree(self, split: list[int], rate: float, l2: float) -> HistTree:
        """The chosen splits only, with shrunken leaf values."""
        chosen, place, out = set(split), {}, []
        todo = [0]
        while todo:
            name = todo.pop()
            place[name] = len(place)
            out.append(name)
            if name in chosen:
                todo += list(reversed(self.open(name)))
        made = HistTree([], [], [], [], [])
        for name in out:
            leaf = self.leaves[name]
            inner = name in chosen
            left, right = (place[c] for c in leaf.children) if inner else (-1, -1)
            value = 0.0 if inner or not leaf.h + l2 else -rate * leaf.g / (leaf.h + l2)
            for column, v in zip((made.feature, made.bin, made.left, made.right, made.value), (leaf.split[1] if inner else 0, leaf.split[2] if inner else 0, left, right, value), strict=True):
                column.append(v)
        return made


def _gradients(loss: str, y, w, raw):
    if loss == "squared_error":
        return (raw - y) * w, w
    p = 1 / (1 + np.exp(-raw))
    return (p - y) * w, np.maximum(p * (1 - p), 1e-16) * w


def _block(row, d: int):
    """(bins, y, w, raw) of a kept block; bins of a feature lie side by side."""
    return np.frombuffer(row["bins"], np.uint8).reshape(d, row["n"]).T, *(np.frombuffer(row[c]) for c in ("y", "w", "raw"))


def _blocks(batch: pa.RecordBatch):
    """Rows of a batch of blocks, a block at a time."""
    for i in range(batch.num_rows):
        yield {c: batch.column(c)[i].as_buffer() if c != "n" else batch.column(c)[i].as_py() for c in batch.schema.names}


def _packed(bins, y, w, raw, rows=None) -> pa.RecordBatch:
    rows = np.ones(len(y)) if rows is None else rows
    cells = [np.ascontiguousarray(bins.T).tobytes(), *(np.ascontiguousarray(v, float).tobytes() for v in (y, w, raw, rows))]
    return pa.RecordBatch.from_arrays([pa.array([len(y)], pa.int32()), *(pa.array([v], pa.binary()) for v in cells)], ["n", "bins", "y", "w", "raw", "rows"])


def _bundles(sizes: list[int]) -> list[list[int]]:
    """Features that share a histogram: those of few bins, as long as their bins multiply to at most ``JOINT``."""
    found, bins = [], 0
    for j in sorted(range(len(sizes)), key=lambda j: sizes[j]):
        if found and bins * sizes[j] <= JOINT:
            found[-1].append(j)
            bins *= sizes[j]
        else:
            found.append([j])
            bins = sizes[j]
    return found


def _apart(sums: np.ndarray, sizes: list[int], bundles: list[list[int]]) -> np.ndarray:
    """Sums per feature and bin of a leaf's joint sums."""
    out, start = np.zeros((3, len(sizes), _WIDTH)), 0
    for bundle in bundles:
        shape = [sizes[j] for j in bundle]
        cube = sums[:, start : (start := start + math.prod(shape))].reshape(3, *shape)
        for i, j in enumerate(bundle):
            out[:, j, : sizes[j]] = cube.sum(axis=tuple(k + 1 for k in range(len(bundle)) if k != i))
    return out


def _histograms(loss: str, sizes: list[int], sent):
    """Per partition one row for each asked leaf: sums of gradients, Hessians and rows per bin of each bundle of features."""
    bundles = _bundles(sizes)
    widths = [math.prod(sizes[j] for j in bundle) for bundle in bundles]

    def run(batches):
        trees, tree, asked = sent.value
        slot_of = np.full(len(tree.left), -1)
        slot_of[asked] = np.arange(len(asked))
        sums = [np.zeros((3, len(asked) * width)) for width in widths]
        for block in (b for batch in batches for b in _blocks(batch)):
            bins, y, w, raw = _block(block, len(sizes))
            counts = np.frombuffer(block["rows"])
            slot = slot_of[tree.nodes(bins)]
            rows = np.flatnonzero(slot >= 0)
            if not len(rows):
                continue
            raw = sum((t.score(bins) for t in trees), raw)
            if len(rows) < len(slot):
                slot, y, w, raw, counts, bins = slot[rows], y[rows], w[rows], raw[rows], counts[rows], [bins[:, j][rows] for j in range(len(sizes))]
            else:
                bins = bins.T
            g, h = _gradients(loss, y, w, raw)
            alike = np.array_equal(h, counts)
            for bundle, width, into in zip(bundles, widths, sums, strict=True):
                at = slot * width
                joint = bins[bundle[0]].astype(np.uint32)
                for j in bundle[1:]:
                    joint *= np.uint32(sizes[j])
                    joint += bins[j]
                at += joint
                into[0] += np.bincount(at, g, into.shape[1])
                into[1] += (n := np.bincount(at, counts, into.shape[1])) if alike else np.bincount(at, h, into.shape[1])
                into[2] += n if alike else np.bincount(at, counts, into.shape[1])
        cubes = [v.reshape(3, len(asked), width) for v, width in zip(sums, widths, strict=True)]
        found = [(int(name), np.concatenate([v[:, s] for v in cubes], axis=1).tobytes()) for s, name in enumerate(asked) if cubes[0][2, s].any()]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.int32(), pa.binary()), strict=True)], ["leaf", "sums"])

    return run


def best_split(sums: np.ndarray, least: int, l2: float) -> tuple[float, int, float, float, int]:
    """(gain, bin, g, h, n of the left side) of the first best cut of one histogram; gain 0 where no cut is allowed."""
    g, h, n = np.cumsum(sums, axis=1)
    right_g, right_h, right_n = g[-1] - g, h[-1] - h, n[-1] - n
    allowed = (n >= least) & (right_n >= least) & (h >= LEAST_HESSIAN) & (right_h >= LEAST_HESSIAN)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = g**2 / (h + l2) + right_g**2 / (right_h + l2) - g[-1] ** 2 / (h[-1] + l2)
    gain = np.where(allowed, gain, 0.0)
    at = int(gain.argmax())
    return float(gain[at]), at, float(g[at]), float(h[at]), int(n[at])


def _splits(sizes: list[int], least: int, l2: float):
    """The best split of a leaf: the greatest gain, of equal ones the first feature."""
    d, bundles = len(sizes), _bundles(sizes)

    def run(table: pa.Table) -> pa.Table:
        sums = _apart(sum(np.frombuffer(packed.as_buffer()) for packed in table.column("sums")).reshape(3, -1), sizes, bundles)
        splits = [best_split(sums[:, j], least, l2) for j in range(d)]
        j = max(range(d), key=lambda j: (splits[j][0], -j))
        gain, at, g, h, n = splits[j]
        row = (table.column("leaf")[0].as_py(), j, gain, at, g, h, n, *sums[:, d - 1].sum(1))
        kinds = (pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.float64(), pa.float64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
        return pa.table([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], ["leaf", "feature", "gain", "bin", "g", "h", "n", "all_g", "all_h", "all_n"])

    return run


_SPLIT = "leaf int, feature int, gain double, bin int, g double, h double, n long, all_g double, all_h double, all_n double"


def fit_histogram_boosting(
    df: DataFrame, loss: str = "log_loss", max_iter: int = 100, learning_rate: float = 0.1, max_leaf_nodes: int = 31,
    min_samples_leaf: int = 20, l2: float = 0.0, max_bins: int = MAX_BINS,
) -> HistModel:
    """Boosted trees of at most ``max_leaf_nodes`` leaves on a table (features, label[, weight]).

    The leaf that gains most is split first; equal gains go to the older leaf, in a leaf to the first feature and bin.
    ``min_samples_leaf`` counts rows, ``l2`` is added to the Hessians of leaf values and gains. A tree without a worthwhile
    split ends the fit. Weights scale gradients and Hessians; a table without rows raises ValueError.
    """
    if loss not in ("log_loss", "squared_error"):
        raise ValueError(f"unknown loss {loss!r}")
    edges = bin_edges(df, max_bins=max_bins)
    sizes = [len(e) + 1 for e in edges]
    d, weight = len(edges), F.col("weight").cast("double") if "weight" in df.columns else F.lit(1.0)
    rows = df.select(vector_to_array("features").alias("x"), F.col("label").cast("double").alias("y"), weight.alias("w"))
    mean = rows.agg(F.sum(F.col("y") * F.col("w")) / F.sum("w")).first()[0]
    base = mean if loss == "squared_error" else math.log(mean / (1 - mean)) if 0 < mean < 1 else math.copysign(30.0, mean - 0.5)
    model = HistModel(edges, float(base), loss)

    def binned(batches):
        for batch in batches:
            if batch.num_rows:
                bins, y, w = bin_rows(matrix(batch.column("x")), edges), batch.column("y").to_numpy(), batch.column("w").to_numpy()
                ends = pa.py_buffer((np.arange(len(y) + 1) * d).astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), len(y), [None, ends, pa.py_buffer(bins.tobytes())]), pa.array(w), pa.array(w * y)], ["cell", "w", "wy"])

    def blocks(batches):
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                at = batch.column("cell")
                bins = np.frombuffer(b"".join(at.to_pylist()), np.uint8).reshape(-1, d)
                held.append((bins, *(batch.column(c).to_numpy() for c in ("y", "w", "n"))))
                size += len(bins)
            if size >= BLOCK_ROWS:
                yield block(held)
                held, size = [], 0
        if size:
            yield block(held)

    def block(held):
        bins, y, w, n = (np.concatenate(c) for c in zip(*held, strict=True))
        return _packed(bins, y, w, np.full(len(y), model.base), n)

    context = df.sparkSession.sparkContext
    label = F.when(F.col("w") != 0, F.col("wy") / F.col("w")).otherwise(0.0).alias("y")
    merged = rows.mapInArrow(binned, "cell binary, w double, wy double").groupBy("cell").agg(F.count("cell").cast("double").alias("n"), F.sum("w").alias("w"), F.sum("wy").alias("wy"))
    packed = stage(merged.select("cell", "n", "w", label), "hist-cells")
    parts = _parts(packed.count(), d, context.defaultParallelism)
    held = packed.repartition(parts).mapInArrow(blocks, _BLOCKS).persist()
    waiting = []
    for _ in range(max_iter):
        grower = _Grower(max_leaf_nodes, min_samples_leaf)
        split, asked = grower.order()
        while asked:
            sent = context.broadcast((waiting, grower.structure(), np.array(asked)))
            found, split_of = held.mapInArrow(_histograms(loss, sizes, sent), "leaf int, sums binary"), _splits(sizes, min_samples_leaf, l2)
            if parts <= FEW_PARTS:
                sums = found.toArrow()  # a row per asked leaf and partition
                splits = [split_of(sums.filter(pc.equal(sums.column("leaf"), name))).to_pylist()[0] for name in pc.unique(sums.column("leaf"))]
            else:
                splits = found.groupBy("leaf").applyInArrow(split_of, _SPLIT).toArrow().to_pylist()  # a row per asked leaf
            best: dict[int, tuple] = {}
            for r in splits:
                leaf = grower.leaves[r["leaf"]]
                leaf.g, leaf.h, leaf.n = r["all_g"], r["all_h"], int(r["all_n"])
                if r["gain"] > 0:
                    best[r["leaf"]] = tuple(r[c] for c in ("gain", "feature", "bin", "g", "h", "n"))
            sent.unpersist()
            for name in asked:
                grower.leaves[name].known, grower.leaves[name].split = True, best.get(name)
            split, asked = grower.order()
        if not split:
            break
        model.trees.append(grower.tree(split, learning_rate, l2))
        waiting = [*waiting, model.trees[-1]]
        if len(waiting) == WRITE_EVERY:
            done, held = held, stage(_scored(held, waiting, d), "hist-rows").persist()
            done.unpersist()
            waiting = []
    held.unpersist()
    return model


def _parts(cells: int, d: int, cores: int) -> int:
    """Partitions of the kept blocks: one per core, fewer for few cells, more where their bytes ask for it."""
    return max(1, min(math.ceil(cells / PART_ROWS), cores), math.ceil(cells * (d + 32) / PART_BYTES))


def _scored(held: DataFrame, trees: list[HistTree], d: int) -> DataFrame:
    """The blocks with the scores of these trees added."""

    def run(batches):
        for block in (b for batch in batches for b in _blocks(batch)):
            bins, y, w, raw = _block(block, d)
            yield _packed(bins, y, w, sum((t.score(bins) for t in trees), raw), np.frombuffer(block["rows"]))

    return held.mapInArrow(run, _BLOCKS)
