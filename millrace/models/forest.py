"""Bagged trees over the cells of binned rows: a task draws the bootstrap weights of its rows for all trees, a task grows a tree.

Every row gets a Poisson weight of its own in each tree. A tree sees rows only by their bins, so a row's weights are summed into its
cell, and a tree is grown from sums per cell: what it costs is bounded by ``CELLS``, whatever the number of rows. Wider grids are left to Spark's forests.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.models import cells
from millrace.models.cells import Grid

#: The most cells that trees are grown from here.
CELLS = 1 << 20
#: Rows of a task that draws weights, and the most whose weights are drawn at once.
DRAWN_ROWS = 500_000
CHUNK_ROWS = 1 << 20
#: A gain below this share of a node's own sum is rounding.
NO_GAIN = 1e-12


@dataclass
class BinTree:
    """Nodes as arrays: a cell goes left where its bin is at most ``bin``; ``left`` is -1 in a leaf, the right child follows it."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def score(self, bins: np.ndarray) -> np.ndarray:
        out, at, node = np.empty(bins.shape[1]), np.arange(bins.shape[1]), np.zeros(bins.shape[1], np.int32)
        while len(at):
            down = self.left[node]
            done = down < 0
            if done.any():
                out[at[done]] = self.value[node[done]]
                at, node, down = at[~done], node[~done], down[~done]
            node = down + (bins[self.feature[node], at] > self.bin[node])
        return out

    def to_dict(self) -> dict:
        return {name: v.tolist() for name, v in vars(self).items()}

    @staticmethod
    def of(feature, bin, left, value) -> BinTree:
        return BinTree(np.asarray(feature, np.uint16), np.asarray(bin, np.uint8), np.asarray(left, np.int32), np.asarray(value, float))


def grow(bins: np.ndarray, w: np.ndarray, s: np.ndarray, sizes: list[int], depth: int, least: float = 0.0) -> BinTree:
    """The tree that splits every node by its greatest gain in squared error, of equal ones the first feature and bin, down to ``depth``.

    ``bins`` holds the cells' bins, a feature after the other, ``w`` their weights, all above 0, and ``s`` the weighted sums of their labels. The gain in
    Gini impurity of two classes is twice that in squared error, so both rules choose alike. Children weigh ``least`` or more.
    """
    total = w.sum()
    feature, cut, left, value = [np.zeros(1, np.uint16)], [np.zeros(1, np.uint8)], [np.full(1, -1, np.int32)], [np.array([s.sum() / total])]
    first, count, node = 0, 1, np.zeros(len(w), np.int64)  # of this level: number of its first node, its nodes, the cells' nodes
    own_w, own_s = np.array([total]), np.array([s.sum()])
    for _ in range(depth):
        base = own_s**2 / own_w
        nothing = NO_GAIN * (base + 1e-300)
        best, f, b, lw, ls = nothing, np.zeros(count, np.int64), np.zeros(count, np.int64), np.zeros(count), np.zeros(count)
        for j, size in enumerate(sizes):
            if size < 2:
                continue
            key = node * size + bins[j]
            cw, cs = (np.cumsum(np.bincount(key, v, count * size).reshape(count, size), axis=1)[:, :-1] for v in (w, s))
            rw, rs = own_w[:, None] - cw, own_s[:, None] - cs
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = cs**2 / cw + rs**2 / rw - base[:, None]
            gain = np.where((cw > 0) & (rw > 0) & (cw >= least) & (rw >= least), gain, 0.0)
            at = gain.argmax(1)
            row = np.arange(count)
            better = gain[row, at] > best
            best = np.where(better, gain[row, at], best)
            f, b = np.where(better, j, f), np.where(better, at, b)
            lw, ls = np.where(better, cw[row, at], lw), np.where(better, cs[row, at], ls)
        split = best > nothing
        if not split.any():
            break
        place = np.cumsum(split) - 1  # of a split node among the split ones
        feature[-1], cut[-1] = np.where(split, f, 0).astype(np.uint16), np.where(split, b, 0).astype(np.uint8)
        left[-1] = np.where(split, first + count + 2 * place, -1).astype(np.int32)
        own_w = np.column_stack([lw, own_w - lw])[split].ravel()
        own_s = np.column_stack([ls, own_s - ls])[split].ravel()
        kept = split[node]
        bins, w, s, node = bins[:, kept], w[kept], s[kept], node[kept]
        node = 2 * place[node] + (bins[f[node], np.arange(len(node))] > b[node])
        first, count = first + count, 2 * int(split.sum())
        feature.append(np.zeros(count, np.uint16))
        cut.append(np.zeros(count, np.uint8))
        left.append(np.full(count, -1, np.int32))
        value.append(own_s / own_w)
    return BinTree(*map(np.concatenate, (feature, cut, left, value)))


def joined(tree: BinTree) -> BinTree:
    """The tree with sibling leaves that call the same class made one, from below, as Spark's classifiers do."""
    left, calls = tree.left.copy(), tree.value > 0.5
    for node in range(len(left) - 1, -1, -1):  # children have greater numbers
        a = left[node]
        if a >= 0 and left[a] < 0 and left[a + 1] < 0 and calls[a] == calls[a + 1]:
            left[node], calls[node] = -1, calls[a]
    return BinTree(tree.feature, tree.bin, left, tree.value)


@dataclass
class ForestModel:
    """The mean of trees: a value, or the share of class 1 with the class that has more than half."""

    grid: Grid
    classes: bool
    base: float
    trees: list[BinTree] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        trees, base = self.trees, self.base

        def value(bins: np.ndarray) -> np.ndarray:
            return base + sum(t.score(bins) for t in trees) / len(trees)

        found = cells.by_cell(self.grid, value)
        if not self.classes:
            return df.withColumn("prediction", found)
        scored = df.withColumn("score", found)
        return scored.select(*df.columns, (F.col("score") > 0.5).cast("double").alias("prediction"), "score")

    def to_dict(self) -> dict:
        return {"edges": [e.tolist() for e in self.grid.edges], "classes": self.classes, "base": self.base, "trees": [t.to_dict() for t in self.trees]}

    @staticmethod
    def from_dict(d: dict) -> ForestModel:
        return ForestModel(Grid([np.array(e, float) for e in d["edges"]]), d["classes"], d["base"], [BinTree.of(**t) for t in d["trees"]])


def _draws(trees: int, base: float, seed: int):
    """(tree, cell, w, s) of a partition's rows: Poisson weights of mean 1, a row and tree at a time, summed per cell."""

    def run(batches):
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        held, size = [], 0
        for batch in batches:
            held.append((batch.column("cell").to_numpy(), batch.column("y").to_numpy()))
            size += batch.num_rows
            if size >= CHUNK_ROWS:
                yield from drawn(rng, held)
                held, size = [], 0
        if size:
            yield from drawn(rng, held)

    def drawn(rng, held):
        cell, y = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.lexsort((y, cell))
        cell, y = cell[order], y[order]
        start = np.flatnonzero(np.append(True, (np.diff(cell) != 0) | (np.diff(y) != 0)))
        alike, cell, y = np.diff(np.append(start, len(cell))).astype(float), cell[start], y[start] - base  # weights of n equal rows add up to Poisson(n)
        names, at = np.unique(cell, return_inverse=True)
        once = bool((alike == 1).all())
        for tree in range(trees):
            w = rng.poisson(1.0, len(y)) if once else rng.poisson(alike)
            n, s = np.bincount(at, w, len(names)), np.bincount(at, w * y, len(names))
            some = n > 0
            if not some.any():
                continue
            cells_of = [np.ascontiguousarray(v[some]).tobytes() for v in (names, n, s)]
            yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), *(pa.array([v], pa.binary()) for v in cells_of)], ["tree", "cell", "w", "s"])

    return run


_TREE = "tree int, feature binary, bin binary, left binary, value binary"


def _grown(grid: Grid, depth: int, classes: bool, base: float):
    def run(table: pa.Table) -> pa.Table:
        cell, w, s = (np.concatenate([np.frombuffer(v.as_buffer(), kind) for v in table.column(c)]) for c, kind in (("cell", np.int64), ("w", float), ("s", float)))
        names, at = np.unique(cell, return_inverse=True)
        tree = grow(grid.bins(names), np.bincount(at, w), np.bincount(at, s), grid.sizes, depth)
        if classes:
            tree = joined(BinTree(tree.feature, tree.bin, tree.left, tree.value + base))
            tree = BinTree(tree.feature, tree.bin, tree.left, tree.value - base)
        return pa.table([pa.array([table.column("tree")[0].as_py()], pa.int32()), *(pa.array([v.tobytes()], pa.binary()) for v in vars(tree).values())], ["tree", *vars(tree)])

    return run


def gridded(df: DataFrame, classes: bool, seed: int = 42) -> tuple[Grid, DataFrame, int, float] | None:
    """The grid, the rows as (cell, y), their number and mean label; None where trees are not grown from cells.

    That is where rows lie in more than ``CELLS`` cells or, with ``classes``, have labels above 1. A table without rows raises ValueError.
    """
    rows = cells.checked_rows(df, classes)
    row = rows.agg(F.count("x").alias("n"), F.avg("y").alias("mean"), F.max("y").alias("most")).first()
    if not row.n:
        raise ValueError("no training rows")
    if classes and row.most > 1:
        return None
    grid = cells.fit_grid(rows, row.n, seed=seed)
    if grid.cells >= 1 << 62:
        return None
    held = cells.in_cells(rows, grid)
    if grid.cells > CELLS and held.select("cell").distinct().count() > CELLS:
        return None
    return grid, held, row.n, float(row["mean"])


def fit_bagged(df: DataFrame, trees: int, depth: int, classes: bool, seed: int = 42) -> ForestModel | None:
    """Trees on bootstrap weights of a table (features, label), all features open to every split, labels 0 and 1 where ``classes``.

    None where ``gridded`` gives none.
    """
    found = gridded(df, classes, seed)
    if found is None:
        return None
    grid, held, n, base = found
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-n // DRAWN_ROWS))
    drawn = held.repartition(parts, "cell").mapInArrow(_draws(trees, base, seed), "tree int, cell binary, w binary, s binary")
    found = drawn.groupBy("tree").applyInArrow(_grown(grid, depth, classes, base), _TREE).collect()  # a row per tree
    kinds = (np.uint16, np.uint8, np.int32, float)
    made = {r.tree: BinTree(*(np.frombuffer(r[c], k) for c, k in zip(("feature", "bin", "left", "value"), kinds, strict=True))) for r in found}
    bare = BinTree.of([0], [0], [-1], [0.0])  # of a tree for which no row was drawn
    return ForestModel(grid, classes, base, [made.get(t, bare) for t in range(trees)])
