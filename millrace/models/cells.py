"""Rows by the bins of their features: trees over few bins see a row only by the cell it lies in, so sums per cell stand for the rows.

A cell is a number: the bins of all features as digits. There are never more cells than rows, and no more than the product of the bins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import stage

#: Bins of a feature, and rows whose values place them, as in Spark's trees.
BINS = 32
SAMPLE = 10_000
#: Cells whose values a task keeps at hand.
KEPT = 1 << 22


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds halfway between values: all of them where they are few, else at about equal numbers of rows."""
    seen, counts = np.unique(values, return_counts=True)
    middle = (seen[:-1] + seen[1:]) / 2
    if len(seen) <= bins:
        return middle
    stride, reached = len(values) / bins, np.cumsum(counts)
    kept, target = [], stride
    for i in range(1, len(seen)):
        if abs(reached[i - 1] - target) < abs(reached[i] - target):
            kept.append(middle[i - 1])
            target += stride
    return np.array(kept[: bins - 1])


@dataclass
class Grid:
    """Thresholds of each feature; a value lies in the bin numbered by the thresholds below it."""

    edges: list[np.ndarray]

    @property
    def sizes(self) -> list[int]:
        return [len(e) + 1 for e in self.edges]

    @property
    def cells(self) -> int:
        return int(np.prod([*map(int, self.sizes)], dtype=object)) if self.edges else 1

    def of(self, x: np.ndarray) -> np.ndarray:
        cell = np.zeros(len(x), np.int64)
        for j, e in enumerate(self.edges):
            cell = cell * (len(e) + 1) + np.searchsorted(e, x[:, j], side="left")
        return cell

    def bins(self, cell: np.ndarray) -> np.ndarray:
        """The bins of cells, a feature after the other."""
        out = np.empty((len(self.edges), len(cell)), np.uint8)
        for j in range(len(self.edges) - 1, -1, -1):
            cell, out[j] = np.divmod(cell, len(self.edges[j]) + 1)
        return out


def checked_rows(df: DataFrame, binary: bool) -> DataFrame:
    """(x, y): a label or feature that is null, NaN or infinite, or no class number, fails the job."""

    def sure(value, good, name):
        return F.when(F.coalesce(good, F.lit(False)), value).otherwise(F.raise_error(F.lit(f"{name} must not be null, NaN, infinite or out of range")))

    def finite(v):
        return F.abs(v) < float("inf")  # NaN is above infinity

    x, y = vector_to_array("features"), F.col("label").cast("double")
    good = finite(y) & (y >= 0) & (y == F.floor(y)) if binary else finite(y)
    return df.select(sure(x, F.forall(x, lambda v: ~F.isnan(v)), "features").alias("x"), sure(y, good, "labels").alias("y"))


def fit_grid(rows: DataFrame, n: int, bins: int = BINS, seed: int = 42) -> Grid:
    """Thresholds from about ``SAMPLE`` of the ``n`` rows (x), from all of them where there are no more."""
    some = rows.select("x") if n <= SAMPLE else rows.select("x").sample(SAMPLE / n, seed)
    x = matrix(some.toArrow().column("x").combine_chunks())
    return Grid([_cuts(x[:, j], bins) for j in range(x.shape[1])])


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def in_cells(rows: DataFrame, grid: Grid) -> DataFrame:
    """(cell, y) of rows (x, y), written once."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(grid.of(matrix(batch.column("x")))), batch.column("y")], ["cell", "y"])

    return stage(rows.mapInArrow(run, "cell long, y double"), "cell-rows")


def by_cell(grid: Grid, value: Callable[[np.ndarray], np.ndarray]):
    """A column function of ``features``: ``value(bins)`` of their cell, made once for each cell that a task meets."""

    @F.arrow_udf("double")
    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = np.full(grid.cells, np.nan) if grid.cells <= KEPT else None
        for column in columns:
            cell = grid.of(matrix(column)) if len(column) else np.zeros(0, np.int64)
            if known is None:
                some, at = np.unique(cell, return_inverse=True)
                yield pa.array(value(grid.bins(some))[at] if len(some) else np.zeros(0))
                continue
            new = np.unique(cell[np.isnan(known[cell])])
            if len(new):
                known[new] = value(grid.bins(new))
            yield pa.array(known[cell])

    return score(vector_to_array("features"))
