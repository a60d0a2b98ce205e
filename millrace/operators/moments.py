"""Class-wise sums and Gram matrices of a vector column, as one distributed aggregate."""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import col

#: Rows whose medians are the centres of the sums.
CENTRE_ROWS = 1000


@dataclass
class Moments:
    """Row count, mean, and sums of squared deviations and (optionally) of their products, of one class."""

    n: float
    mean: np.ndarray
    squares: np.ndarray
    gram: np.ndarray | None

    @property
    def variance(self) -> np.ndarray:
        return np.maximum(self.squares / self.n, 0.0)

    @property
    def covariance(self) -> np.ndarray:
        return self.gram / self.n

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        gap = other.mean - self.mean
        share = self.n * other.n / n
        gram = None if self.gram is None else self.gram + other.gram + share * np.outer(gap, gap)
        return Moments(n, self.mean + gap * other.n / n, self.squares + other.squares + share * gap**2, gram)


def class_moments(
    df: DataFrame, by: str | None = None, features: str = "features", target: str | None = None, cross: bool = False
) -> dict[float, Moments]:
    """Moments per class; with ``target`` the label is appended as the last coordinate.

    One pass sums the deviations from a centre near each class's mean, the medians of a few rows, so
    large values with a small spread lose nothing; any centre within the spread of the values is as good. Each partition folds its
    batches into one small block per class; the blocks are summed position by position on the
    cluster, so what reaches the driver is d (or d*d) numbers per class whatever the row count.
    ``features`` may be a vector or an array.
    """
    values = col(features) if isinstance(df.schema[features].dataType, T.ArrayType) else vector_to_array(col(features))
    if target is not None:
        values = F.concat(values, F.array(col(target).cast("double")))
    key = col(by).cast("double") if by else F.lit(0.0)

    work = df.select(key.alias("k"), values.alias("x"))
    centres, middle = {}, None
    few = work.limit(CENTRE_ROWS).toPandas()
    if len(few):
        matrix, keys = np.stack(few["x"].to_numpy()), few["k"].to_numpy()
        centres = {float(k): _median(matrix[keys == k]) for k in np.unique(keys)}
        middle = _median(matrix)

    def deviations(rows: np.ndarray, centre: np.ndarray) -> list[np.ndarray]:
        rows = rows - centre
        return [rows.sum(0), (rows**2).sum(0), *([(rows.T @ rows).ravel()] if cross else [])]

    out = {}
    for k, flat in _summed(work, deviations, centres, middle).items():
        n, centre = flat[0], centres.get(k, middle)
        d = len(centre)
        off = flat[1 : 1 + d] / n
        gram = flat[1 + 2 * d :].reshape(d, d) - n * np.outer(off, off) if cross else None
        out[k] = Moments(n, centre + off, flat[1 + d : 1 + 2 * d] - n * off**2, gram)
    return out


def _median(rows: np.ndarray) -> np.ndarray:
    finite = np.where(np.isfinite(rows), rows, np.nan)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", RuntimeWarning)
        return np.nan_to_num(np.nanmedian(finite, axis=0))


def _summed(work: DataFrame, parts_of, centres: dict[float, np.ndarray], middle) -> dict[float, np.ndarray]:
    """Per class: row count and the sums that ``parts_of(rows, centre)`` makes, as one flat array."""

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[float, np.ndarray] = {}
        for batch in batches:
            if batch.empty:
                continue
            matrix = np.stack(batch["x"].to_numpy())
            keys = batch["k"].to_numpy()
            for k in np.unique(keys):
                rows = matrix[keys == k]
                flat = np.concatenate([np.array([len(rows)], float), *parts_of(rows, centres.get(k, middle))])
                held[k] = held[k] + flat if k in held else flat
        for k, flat in held.items():
            yield pd.DataFrame({"k": [float(k)], "block": [flat]})

    blocks = work.mapInPandas(fold, "k double, block array<double>")
    summed = (
        blocks.select("k", F.posexplode("block").alias("i", "v"))
        .groupBy("k", "i")
        .agg(F.sum("v").alias("v"))
        .groupBy("k")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda e: e["v"]).alias("block"))
    )
    return {r["k"]: np.array(r["block"]) for r in summed.collect()}
