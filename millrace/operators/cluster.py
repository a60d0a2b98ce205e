"""KMeans search, cluster quality, principal components, cluster profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.density import NOISE
from millrace.operators.join import left_join_unique
from millrace.operators.moments import class_moments
from millrace.operators.nearest import all_block_pairs, numbered
from millrace.operators.tree import distances, matrix
from millrace.session import col, stage

_SUMS = pa.schema([("row", pa.int64()), ("own", pa.float64()), ("c", pa.float64()), ("s", pa.float64())])

#: Distances that a task holds at once.
HELD = 1 << 21
#: Bytes of a block of rows.
BLOCK_BYTES = 4 << 20

# Risk bands of a cluster against the global rate.
RISK_HIGH, RISK_LOW, RISK_MEDIUM = "riesgo_operativo_alto", "riesgo_operativo_bajo", "riesgo_operativo_medio"


class Centres:
    """Cluster centres with their within-cluster sum of squares."""

    def __init__(self, centres: np.ndarray, cost: float, features: str = "features"):
        self.centres, self.cost, self.features = centres, cost, features

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` and the number of each row's nearest centre (``cluster``)."""
        shift = self.centres.mean(0)
        centres = self.centres - shift

        @F.pandas_udf("int")
        def nearest(x: pd.Series) -> pd.Series:
            return pd.Series(_gaps(np.stack(x.to_numpy()) - shift, centres).argmin(1) if len(x) else [], dtype="int32")

        return df.withColumn("cluster", nearest(vector_to_array(col(self.features))))


def _gaps(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances to each centre, short of the rows' own |x|^2."""
    return (centres**2).sum(1) - 2.0 * x @ centres.T


def _blocks(df: DataFrame, features: str) -> DataFrame:
    """(n, single, x): rows packed into blocks of bounded bytes, as single precision where that loses nothing; dealt to all cores and written once."""

    def pack(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            every = matrix(batch.column("x"))
            step = max(1, BLOCK_BYTES // (8 * max(1, every.shape[1])))
            for i in range(0, len(every), step):
                x = every[i : i + step]
                short = x.astype(np.float32)
                single = bool((short == x).all())
                yield pa.RecordBatch.from_arrays([pa.array([len(x)], pa.int64()), pa.array([single]), pa.array([(short if single else x).tobytes()], pa.binary())], ["n", "single", "x"])

    packed = df.select(vector_to_array(col(features)).alias("x")).mapInArrow(pack, "n long, single boolean, x binary")
    return stage(packed.repartition(df.sparkSession.sparkContext.defaultParallelism), "kmeans-blocks")


def _lloyd(blocks: DataFrame, runs: Sequence[np.ndarray], shift: np.ndarray) -> list[np.ndarray]:
    """One pass for all runs: per run a row (rows, cost, sum of the rows) for each of its centres; centres and sums count from ``shift``."""
    centres = np.concatenate(runs)
    ends = np.cumsum([len(r) for r in runs])
    d = centres.shape[1]

    def add_up(batches):
        held = np.zeros((len(centres), d + 2))
        for batch in batches:
            for n, single, block in zip(batch.column("n").to_pylist(), batch.column("single").to_pylist(), batch.column("x"), strict=True):
                rows = np.frombuffer(block.as_buffer(), np.float32 if single else np.float64).reshape(n, d)
                step = max(1, HELD // len(centres))
                for i in range(0, n, step):
                    x = rows[i : i + step] - shift
                    gaps, norm, mine = _gaps(x, centres), (x**2).sum(1), np.zeros((len(x), len(centres)))
                    here = np.arange(len(x))
                    for s, e in zip(ends - [len(r) for r in runs], ends, strict=True):
                        at = s + gaps[:, s:e].argmin(1)
                        mine[here, at] = 1.0
                        held[s:e, 1] += np.bincount(at - s, np.maximum(gaps[here, at] + norm, 0.0), e - s)
                    held[:, 0] += mine.sum(0)
                    held[:, 2:] += mine.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(held)), pa.int32()), pa.array([r.tobytes() for r in held], pa.binary())], ["c", "sums"])

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(v.as_py()) for v in table.column("sums")], axis=0)
        return pa.table([table.column("c")[:1], pa.array([total.tobytes()], pa.binary())], ["c", "sums"])

    kind = "c int, sums binary"
    found = {r.c: np.frombuffer(r.sums) for r in blocks.mapInArrow(add_up, kind).groupBy("c").applyInArrow(add, kind).collect()}  # a row per centre
    return np.split(np.stack([found[c] for c in range(len(centres))]), ends[:-1])


def best_kmeans_each(df: DataFrame, ks: Sequence[int], seed: int = 42, restarts: int = 10, features: str = "features", passes: int = 100, tol: float = 1e-4) -> dict[int, Centres]:
    """For each k the restart with the least within-cluster sum of squares.

    Spark's k-means chooses each restart's first centres. From there the restarts of all k move together: a pass over the rows
    serves every one that has not settled (no centre moved farther than ``tol``), so there are ``passes`` passes at most. The cost
    is that of the last assignment, as Spark reports it; a centre without rows stays.
    """
    starts = [KMeans(k=k, seed=seed + r, featuresCol=features, predictionCol="cluster", maxIter=0).fit(df).clusterCenters() for k in ks for r in range(restarts)]
    asked = [k for k in ks for _ in range(restarts)]
    shift = np.concatenate(starts).mean(0)
    runs, costs = [np.stack(s) - shift for s in starts], [0.0] * len(starts)
    blocks, live = _blocks(df, features), list(range(len(runs)))
    for _ in range(passes):
        if not live:
            break
        moving = []
        for i, sums in zip(live, _lloyd(blocks, [runs[i] for i in live], shift), strict=True):
            n = sums[:, :1]
            new = np.where(n > 0, sums[:, 2:] / np.maximum(n, 1), runs[i])
            if (((new - runs[i]) ** 2).sum(1) > tol**2).any():
                moving.append(i)
            runs[i], costs[i] = new, float(sums[:, 1].sum())
        live = moving
    best = {}
    for i, k in enumerate(asked):
        if k not in best or costs[i] < costs[best[k]]:
            best[k] = i
    return {k: Centres(runs[i] + shift, costs[i], features) for k, i in best.items()}


def best_kmeans(df: DataFrame, k: int, seed: int = 42, restarts: int = 10, features: str = "features") -> Centres:
    """The restart with the least within-cluster sum of squares."""
    return best_kmeans_each(df, [k], seed, restarts, features)[k]


def silhouette_euclidean(points: DataFrame, block_rows: int | None = None) -> float | None:
    """Mean silhouette under Euclidean distance, exactly; noise removed.

    ``points`` carries the cluster in its payload. Every block pair hands back
    one distance sum per (point, cluster); the work is quadratic by nature, so
    ``silhouette_squared`` is the choice for large tables.
    """
    points = numbered(points.where(F.col("p") != NOISE), "silhouette-points")
    sizes = points.groupBy(F.col("p").alias("c")).agg(F.count(F.lit(1)).cast("double").alias("size"))
    if len(sizes.limit(2).collect()) < 2:
        return None

    def kernel(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("p")
        b, rows = matrix(right.column("x")), right.column("row").to_numpy()
        names, starts = np.unique(right.column("p").to_numpy(), return_index=True)
        a_all, own, mine = matrix(left.column("x")), left.column("p").to_numpy(), left.column("row").to_numpy()
        by_row, parts = np.argsort(rows), []
        step = max(1, HELD // len(b))
        for start in range(0, len(a_all), step):
            at = slice(start, start + step)
            gap = np.sqrt(distances(a_all[at], b))
            self_at = by_row[np.minimum(np.searchsorted(rows, mine[at], sorter=by_row), len(rows) - 1)]
            here = np.flatnonzero(rows[self_at] == mine[at])
            gap[here, self_at[here]] = 0.0
            m = len(names)
            parts.append([np.repeat(mine[at], m), np.repeat(own[at], m), np.tile(names, len(gap)), np.add.reduceat(gap, starts, axis=1).ravel()])
        return pa.table([pa.array(np.concatenate([part[i] for part in parts]), f.type) for i, f in enumerate(_SUMS)], schema=_SUMS)

    sums = all_block_pairs(points, points, kernel, _SUMS, block_rows).groupBy("row", "own", "c").agg(F.sum("s").alias("s")).join(sizes, "c")
    size = F.col("size")
    mine = F.col("own") == F.col("c")
    return _mean_silhouette(
        sums.groupBy("row").agg(
            F.max(F.when(mine, F.try_divide(F.col("s"), size - 1))).alias("a"),
            F.min(F.when(~mine, F.col("s") / size)).alias("b"),
        )
    )


def silhouette_squared(df: DataFrame, label: str = "cluster", features: str = "features") -> float | None:
    """Mean silhouette under squared Euclidean distance from class moments alone: linear in the rows.

    The mean squared distance from x to a cluster is |x|^2 - 2 x.mean + mean|y|^2.
    """
    rows = df.where(col(label) != NOISE)
    moments = class_moments(rows, label, features)
    if len(moments) < 2:
        return None
    labels = sorted(moments)
    sizes = np.array([moments[c].n for c in labels])
    means = np.stack([moments[c].mean for c in labels])
    centre = sizes @ means / sizes.sum()
    means = means - centre  # distances do not change, and large coordinates stay exact
    spread = np.array([moments[c].variance.sum() for c in labels]) + (means**2).sum(1)

    def score(batches):
        for batch in batches:
            if batch.empty:
                continue
            x = np.stack(batch["x"].to_numpy()) - centre
            gap = (x**2).sum(1)[:, None] - 2 * x @ means.T + spread[None, :]
            own = np.searchsorted(labels, batch["c"].to_numpy())
            here = np.arange(len(x))
            n = sizes[own]
            with np.errstate(divide="ignore", invalid="ignore"):
                a = np.where(n > 1, gap[here, own] * n / (n - 1), np.nan)
            gap[here, own] = np.inf
            yield pd.DataFrame({"a": a, "b": gap.min(1)})

    scored = rows.select(vector_to_array(col(features)).alias("x"), col(label).cast("double").alias("c"))
    return _mean_silhouette(scored.mapInPandas(score, "a double, b double"))


def _mean_silhouette(ab: DataFrame) -> float | None:
    """Mean of (b - a) / max(a, b); a point alone in its cluster scores 0."""
    a = F.when(~F.isnan("a"), F.col("a"))
    value = F.coalesce(F.try_divide(F.col("b") - a, F.greatest(a, F.col("b"))), F.lit(0.0))
    return ab.agg(F.avg(value)).first()[0]


def davies_bouldin(df: DataFrame, label: str = "cluster", features: str = "features") -> float | None:
    """Mean over clusters of the worst (s_i + s_j) / d_ij; noise removed."""
    rows = df.where(col(label) != NOISE)
    moments = class_moments(rows, label, features)
    if len(moments) < 2:
        return None
    labels = sorted(moments)
    means = np.stack([moments[c].mean for c in labels])

    def spread(batches):
        for batch in batches:
            if batch.empty:
                continue
            own = np.searchsorted(labels, batch["c"].to_numpy())
            gap = np.sqrt(((np.stack(batch["x"].to_numpy()) - means[own]) ** 2).sum(1))
            yield pd.DataFrame({"c": batch["c"].to_numpy(), "d": gap})

    scored = rows.select(vector_to_array(col(features)).alias("x"), col(label).cast("double").alias("c"))
    mean_gap = scored.mapInPandas(spread, "c double, d double").groupBy("c").agg(F.avg("d").alias("d"))
    within = {r["c"]: r["d"] for r in mean_gap.collect()}
    s = np.array([within[c] for c in labels])
    worst = []
    for i in range(len(labels)):  # a row at a time: k x d numbers, not k x k x d
        apart = np.sqrt(((means - means[i]) ** 2).sum(1))
        ratio = (s + s[i]) / np.where(apart == 0, np.nan, apart)
        worst.append(np.nanmax(np.delete(ratio, i)) if np.isfinite(np.delete(ratio, i)).any() else np.nan)
    return float(np.mean(worst))


class PrincipalComponents:
    """Components of the centred data, each with its largest loading positive."""

    def __init__(self, mean: np.ndarray, components: np.ndarray, ratio: np.ndarray):
        self.mean, self.components, self.ratio = mean, components, ratio

    def transform(self, df: DataFrame, names: Sequence[str], features: str = "features", digits: int = 4) -> DataFrame:
        mean, parts = self.mean, self.components

        @F.pandas_udf("array<double>")
        def project(x: pd.Series) -> pd.Series:
            return pd.Series(list((np.stack(x.to_numpy()) - mean) @ parts.T)) if len(x) else x

        out = df.withColumn("__pc", project(vector_to_array(col(features))))
        return out.withColumns({n: F.round(F.col("__pc")[i], digits) for i, n in enumerate(names)}).drop("__pc")


def principal_components(df: DataFrame, k: int = 2, features: str = "features") -> PrincipalComponents:
    """Eigenvectors of the covariance summed on the cluster; the d x d solve is the driver's only part."""
    m = class_moments(df, None, features, cross=True)[0.0]
    values, vectors = np.linalg.eigh(m.covariance)
    order = np.argsort(values)[::-1]
    parts = vectors[:, order[:k]].T
    heavy = np.abs(parts).argmax(1)
    parts = parts * np.sign(parts[np.arange(len(parts)), heavy])[:, None]
    return PrincipalComponents(m.mean, parts, values[order[:k]] / values.sum())


def cluster_profile(df: DataFrame, cluster: str, target: str, averages: Mapping[str, str], digits: int = 4) -> DataFrame:
    """Rows, target rate, means and a risk band (rate against 1.25 and 0.75 of the global rate) per cluster."""
    overall = df.agg(F.avg(col(target))).scalar()
    means = [F.round(F.avg(col(c)), digits).alias(n) for n, c in averages.items() if c in df.columns]
    per = df.groupBy(col(cluster)).agg(F.count(col(target)).alias("n_envios"), F.avg(col(target)).alias("__rate"), *means)
    band = (
        F.when(F.col("__rate") >= overall * 1.25, RISK_HIGH)
        .when(F.col("__rate") <= overall * 0.75, RISK_LOW)
        .otherwise(RISK_MEDIUM)
    )
    names = [n for n, c in averages.items() if c in df.columns]
    return per.select(
        col(cluster), "n_envios", F.round("__rate", digits).alias("tasa_incidencia"), *names, band.alias("interpretacion_negocio")
    )


def cluster_rows(points: DataFrame, labels: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Attach label tables (key, label) to the points by id, never by position."""
    for name, table in labels.items():
        points = left_join_unique(points, table.select(col(key), col(table.columns[-1]).alias(name)), key)
    return points


def to_vector(df: DataFrame, array_column: str, name: str = "features") -> DataFrame:
    return df.withColumn(name, array_to_vector(col(array_column).cast("array<double>")))
