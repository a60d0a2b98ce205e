"""Many linear fits per scan: all penalties and folds of a search share each pass over the rows.

Squared error needs one pass: every penalty is solved on the Gram sums of a fold's training rows. The smooth losses of
classification (logistic, modified Huber, squared hinge) take a few passes: each one adds up loss, gradient and Hessian of all fits that have not settled,
and the driver makes their next proximal Newton step. What reaches the driver is a few d x d numbers per fit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.models import gaussian
from millrace.operators.moments import Moments
from millrace.session import stage

#: Numbers per row on their way to being summed.
PIECE = 4096
#: Bytes of a block of rows.
BLOCK_BYTES = 4 << 20
SETTLED = 1e-9


def _logistic(y, raw):
    q = 1 / (1 + np.exp(-raw))
    return np.logaddexp(0, raw) - y * raw, q - y, q * (1 - q)


def _modified_huber(y, raw):
    side = 2 * y - 1
    z = side * raw
    inner = np.maximum(1 - z, 0.0)
    far = z < -1
    return np.where(far, -4 * z, inner**2), side * np.where(far, -4.0, -2 * inner), np.where(far | (z >= 1), 0.0, 2.0)


def _squared_hinge(y, raw):
    side = 2 * y - 1
    inner = np.maximum(1 - side * raw, 0.0)
    return inner**2, -2 * side * inner, np.where(inner > 0, 2.0, 0.0)


#: Loss, first and second derivative by the linear score, for labels 0 and 1.
SMOOTH = {"log_loss": _logistic, "modified_huber": _modified_huber, "squared_hinge": _squared_hinge}


def loss_of(name: str, params: Mapping[str, Any]) -> str:
    return params.get("loss", "log_loss") if name == "15_SGDClassifier" else "log_loss"


@dataclass(frozen=True)
class Penalty:
    """Added to the mean loss per unit of weight: l1 |w| + l2 / 2 |w|^2; the intercept is free."""

    l1: float = 0.0
    l2: float = 0.0


def penalty_of(name: str, params: Mapping[str, Any], weight: float) -> Penalty | None:
    """The penalty of a candidate's parameters for a total weight; None where the candidate is not a fit of this kind."""
    get = params.get
    if name == "02_LogisticRegression" and get("penalty", "l2") == "l2":
        return Penalty(0.0, 1.0 / (get("C", 1.0) * weight))
    if name == "15_SGDClassifier" and get("loss", "hinge") in SMOOTH:
        mix = {"l2": 0.0, "l1": 1.0, "elasticnet": 0.15}[get("penalty", "l2")]
        return Penalty(get("alpha", 1e-4) * mix, get("alpha", 1e-4) * (1 - mix))
    if name == "02_LinearRegression":
        return Penalty()
    if name == "03_Ridge":
        return Penalty(0.0, get("alpha", 1.0) / weight)
    if name in ("04_Lasso", "05_ElasticNet"):
        alpha, ratio = get("alpha", 0.1), 1.0 if name == "04_Lasso" else get("l1_ratio", 0.5)
        return Penalty(alpha * ratio, alpha * (1 - ratio))
    if name == "15_SGDRegressor":
        return Penalty(0.0, get("alpha", 1e-4))
    return None


def minimise(a: np.ndarray, c: np.ndarray, penalty: Penalty, start: np.ndarray, free: int = 0, sweeps: int = 20_000) -> np.ndarray:
    """Minimum of w a w / 2 - c w + penalty by coordinate descent; the last ``free`` coordinates carry no penalty."""
    d = len(c)
    l1 = np.append(np.full(d - free, penalty.l1), np.zeros(free))
    whole = a + np.diag(np.append(np.full(d - free, penalty.l2), np.zeros(free)))
    if not penalty.l1:
        return np.linalg.lstsq(whole, c, rcond=None)[0]
    w, scale = start.copy(), np.diag(whole)
    for _ in range(sweeps):
        moved = 0.0
        for j in range(d):
            if scale[j] <= 0:
                continue
            pull = c[j] - whole[j] @ w + scale[j] * w[j]
            new = np.sign(pull) * max(abs(pull) - l1[j], 0.0) / scale[j]
            moved = max(moved, abs(new - w[j]) * np.sqrt(scale[j]))
            w[j] = new
        if moved < 1e-12:
            break
    return w


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    """All folds' tables in one: the fold left out (``part``), the row's own ``fold``, x, y, weight."""
    tables = [
        p.select(F.lit(i).alias("part"), F.col("fold").cast("int").alias("fold"), vector_to_array("features").alias("x"), F.col("label").cast("double").alias("y"), F.col("weight").cast("double").alias("w"))
        for i, p in enumerate(parts)
    ]
    return reduce(lambda a, b: a.unionByName(b), tables)


def _by_part(batch):
    """(part, x, y, w) of each part in a batch of rows."""
    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    y, w, part = (batch.column(c).to_numpy() for c in ("y", "w", "part"))
    for p in np.unique(part):
        here = part == p
        yield int(p), x[here], y[here], w[here]


def _by_block(batch):
    """(part, x, y, w) of each packed block."""
    for part, n, block in zip(batch.column("part").to_pylist(), batch.column("n").to_pylist(), batch.column("rows"), strict=True):
        rows = np.frombuffer(block.as_buffer()).reshape(n, -1)
        yield part, rows[:, :-2], rows[:, -2], rows[:, -1]


@dataclass
class Blocks:
    """The rows of all folds' tables packed into blocks (part, held, n, rows), written once for all searches; ``held``: the row's fold is the part left out."""

    table: DataFrame
    parts: int
    _both: list[Moments | None] | None = None

    def sums(self, held: bool, make) -> list[np.ndarray | None]:
        return _summed(self.table.where(F.col("held") if held else ~F.col("held")), self.parts, make, _by_block)

    def labels(self) -> set[float]:
        """0, 1, and NaN if there is any other label."""
        found = [b for held in (False, True) for b in self.sums(held, lambda p, x, y, w: np.array([(y == 0).any(), (y == 1).any(), (~np.isin(y, (0, 1))).any()], float)) if b is not None]
        seen = np.sum(found, axis=0) if found else np.zeros(3)
        return {v for v, n in zip((0.0, 1.0, float("nan")), seen, strict=True) if n}

    def moments(self, z_of) -> list[Moments | None]:
        """Count, mean and products of deviations of the rows ``z_of(x, y)`` over each part's training rows: a pass for the means, one around them."""

        def count(p, x, y, w):
            z = z_of(x, y)
            return np.append(len(z), z.sum(0))

        first = self.sums(False, count)
        means = [None if b is None or not b[0] else b[1:] / b[0] for b in first]

        def make(p, x, y, w):
            if means[p] is None:
                return None
            z = z_of(x, y) - means[p]
            return np.concatenate([z.sum(0), (z.T @ z).ravel()])

        out = []
        for b, mean, flat in zip(first, means, self.sums(False, make), strict=True):
            if mean is None:
                out.append(None)
                continue
            n, d = b[0], len(mean)
            off = flat[:d] / n
            gram = flat[d:].reshape(d, d) - n * np.outer(off, off)
            out.append(Moments(n, mean + off, np.diag(gram).copy(), gram))
        return out


def pack(parts: Sequence[DataFrame] | Blocks) -> Blocks:
    """Blocks of bounded bytes, so that a pass reads numbers instead of rows."""
    if isinstance(parts, Blocks):
        return parts

    def run(batches):
        for batch in batches:
            for held in (False, True):
                some = batch.filter(batch.column("held") if held else pc.invert(batch.column("held")))
                if not some.num_rows:
                    continue
                for p, x, y, w in _by_part(some):
                    rows = np.column_stack([x, y, w])
                    step = max(1, BLOCK_BYTES // (8 * rows.shape[1]))
                    for i in range(0, len(rows), step):
                        block = np.ascontiguousarray(rows[i : i + step], np.float64)
                        yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([held]), pa.array([len(block)], pa.int64()), pa.array([block.tobytes()], pa.binary())], ["part", "held", "n", "rows"])

    rows = _union(parts).withColumn("held", F.col("part") == F.col("fold")).where("held is not null").select("part", "held", "x", "y", "w")
    packed = rows.mapInArrow(run, "part int, held boolean, n long, rows binary")
    return Blocks(stage(packed.repartition(rows.sparkSession.sparkContext.defaultParallelism), "search-blocks"), len(parts))


def _summed(rows: DataFrame, parts: int, make, unpack=_by_part) -> list[np.ndarray | None]:
    """``make(part, x, y, w)`` gives a flat block per batch; the blocks of a part are summed piece by piece in Spark."""

    def fold(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            for p, x, y, w in unpack(batch):
                block = make(p, x, y, w)
                if block is not None:
                    held[p] = held[p] + block if p in held else block
        for p, block in held.items():
            for i in range(0, len(block), PIECE):
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([i], pa.int64()), pa.array([block[i : i + PIECE].tobytes()], pa.binary())], ["part", "at", "sums"])

    def add(table: pa.Table) -> pa.Table:
        total = reduce(lambda a, b: a + b, (np.frombuffer(v.as_py()) for v in table.column("sums")))
        return pa.table([table.column("part")[:1], table.column("at")[:1], pa.array([total.tobytes()], pa.binary())], ["part", "at", "sums"])

    kind = "part int, at long, sums binary"
    found: dict[int, list] = {}
    for r in rows.mapInArrow(fold, kind).groupBy("part", "at").applyInArrow(add, kind).collect():  # a block per part
        found.setdefault(r.part, []).append((r.at, np.frombuffer(r.sums)))
    return [np.concatenate([v for _, v in sorted(found[p], key=lambda e: e[0])]) if p in found else None for p in range(parts)]


def squared_fits(parts: Sequence[DataFrame] | Blocks, name: str, trials: Sequence[Mapping[str, Any]]) -> list[np.ndarray]:
    """Per fold the coefficients of all trials, (d + 1) x trials with the intercept last, from the sums of its training rows."""
    blocks = pack(parts)
    if blocks._both is None:  # the same for every model of a search
        blocks._both = blocks.moments(lambda x, y: np.column_stack([x, y]))
    out = []
    for m in blocks._both:
        if m is None:
            raise ValueError("a fold without training rows")
        d, cov = len(m.mean) - 1, m.covariance
        fits = []
        for t in trials:
            w = minimise(cov[:d, :d], cov[:d, d], penalty_of(name, t, m.n), np.zeros(d))
            fits.append(np.append(w, m.mean[d] - m.mean[:d] @ w))
        out.append(np.stack(fits, 1))
    return out


def discriminant_fits(parts: Sequence[DataFrame] | Blocks, trials: Sequence[Mapping[str, Any]]) -> list[np.ndarray]:
    """Linear discriminants of labels 0 and 1 as coefficients, (d + 1) x trials with the intercept last; class sums serve all trials."""
    blocks = pack(parts)
    own = {c: blocks.moments(lambda x, y, c=c: x[y == c]) for c in (0.0, 1.0)}
    moments = [{c: m for c in own if (m := own[c][p]) is not None} for p in range(blocks.parts)]
    shrunk = [None] * blocks.parts
    if any(t.get("shrinkage") == "auto" for t in trials):
        scales = [{c: gaussian.scale_of(m) for c, m in of.items()} for of in moments]

        def fourth(p, x, y, w):
            z = {c: (x[y == c] - moments[p][c].mean) / scales[p][c] for c in moments[p]}
            return np.array([((z[c] ** 2).sum(1) ** 2).sum() if c in z else 0.0 for c in (0.0, 1.0)])

        totals = blocks.sums(False, fourth)
        shrunk = [gaussian.shrunk_from(of, dict(zip((0.0, 1.0), t, strict=True))) for of, t in zip(moments, totals, strict=True)]
    out = []
    for of, auto in zip(moments, shrunk, strict=True):
        fits = []
        for t in trials:
            model = gaussian.discriminant_of(of, t.get("shrinkage"), auto)
            if len(model.classes) == 1:
                fits.append(np.append(np.zeros(len(model.center)), 1.0 if model.classes[0] == 1 else -1.0))
            else:
                w = model.linear[1] - model.linear[0]
                fits.append(np.append(w, model.constant[1] - model.constant[0] - model.center @ w))
        out.append(np.stack(fits, 1))
    return out


@dataclass
class _Fit:
    penalty: Penalty
    v: np.ndarray
    goal: float = np.inf
    step: np.ndarray | None = None
    done: bool = False

    def value(self, loss: float, v: np.ndarray) -> float:
        w = v[:-1]
        return loss + self.penalty.l1 * np.abs(w).sum() + self.penalty.l2 / 2 * (w @ w)

    def advance(self, loss: float, g: np.ndarray, h: np.ndarray) -> None:
        """Take what one pass found at ``v``: accept it and step on, or go back half of the last step."""
        goal = self.value(loss, self.v)
        if self.step is not None and goal > self.goal + 1e-13 * (1 + abs(self.goal)):
            self.step = self.step / 2
            self.v = self.v - self.step
            self.done = bool(np.abs(self.step).max() < SETTLED)
            return
        self.goal = goal
        target = minimise(h + 1e-12 * np.eye(len(g)), h @ self.v - g, self.penalty, self.v, free=1)
        self.step = target - self.v
        self.done = bool(np.abs(self.step).max() < SETTLED * (1 + np.abs(self.v).max()))
        self.v = target


def smooth_fits(parts: Sequence[DataFrame] | Blocks, name: str, trials: Sequence[Mapping[str, Any]], passes: int = 60) -> list[np.ndarray]:
    """Per fold the coefficients of all trials, (d + 1) x trials with the intercept last; each pass serves all that are open."""
    blocks = pack(parts)
    first = blocks.sums(False, lambda p, x, y, w: np.concatenate([[w.sum(), w @ y], np.zeros(x.shape[1])]))
    if any(b is None for b in first):
        raise ValueError("a fold without training rows")
    weights = [float(b[0]) for b in first]
    fits: list[list[_Fit]] = []
    for b, weight in zip(first, weights, strict=True):
        mean = min(max(b[1] / weight, 1e-9), 1 - 1e-9)
        start = np.append(np.zeros(len(b) - 2), np.log(mean / (1 - mean)))
        fits.append([_Fit(penalty_of(name, t, weight), start.copy()) for t in trials])
    for _ in range(passes):
        live = [[i for i, f in enumerate(own) if not f.done] for own in fits]
        if not any(live):
            break
        sent = [np.stack([fits[p][i].v for i in live[p]], 1) if live[p] else None for p in range(blocks.parts)]
        kinds = [[loss_of(name, trials[i]) for i in own] for own in live]

        def make(p, x, y, w, sent=sent, kinds=kinds):
            if sent[p] is None:
                return None
            z = np.column_stack([x, np.ones(len(x))])
            raw = z @ sent[p]
            found = [SMOOTH[kind](y, raw[:, t]) for t, kind in enumerate(kinds[p])]
            loss = [w @ f[0] for f in found]
            grad = [z.T @ (w * f[1]) for f in found]
            bend = [(z.T @ (z * (w * f[2])[:, None])).ravel() for f in found]
            return np.concatenate([loss, *grad, *bend])

        for p, block in enumerate(blocks.sums(False, make)):
            if block is None:
                continue
            n, size, total = len(live[p]), len(sent[p]), weights[p]
            loss, grad, bend = block[:n] / total, block[n : n + n * size].reshape(n, size) / total, block[n + n * size :].reshape(n, size, size) / total
            for t, i in enumerate(live[p]):
                fits[p][i].advance(loss[t], grad[t], bend[t])
    return [np.stack([f.v for f in own], 1) for own in fits]


class LinearCall:
    """A fitted linear classifier: class 1 above 0, the logistic function of the linear value as score, or the value itself (``margin``)."""

    def __init__(self, weights: np.ndarray, intercept: float, margin: bool = False):
        self.weights, self.intercept, self.margin = weights, intercept, margin

    def transform(self, df: DataFrame) -> DataFrame:
        w, b = self.weights, self.intercept

        @F.pandas_udf("double")
        def linear(x: pd.Series) -> pd.Series:
            return pd.Series(np.stack(x.to_numpy()) @ w + b if len(x) else [], dtype=float)

        rows = df.withColumn("__raw", linear(vector_to_array("features")))
        score = F.col("__raw") if self.margin else 1 / (1 + F.exp(-F.col("__raw")))
        return rows.withColumns({"prediction": (F.col("__raw") > 0).cast("double"), "score": score}).drop("__raw")


def fit_smooth(train: DataFrame, params: Mapping[str, Any]) -> LinearCall:
    """One classifier under a smooth loss and its penalty, on all rows of a table (features, label, weight)."""
    (v,) = smooth_fits([train.withColumn("fold", F.lit(-1))], "15_SGDClassifier", [params])
    return LinearCall(v[:-1, 0], float(v[-1, 0]))


def held_out_errors(parts: Sequence[DataFrame] | Blocks, coefficients: Sequence[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Per fold (mean absolute error of each trial, mean squared error, rows) on the rows left out, in one pass."""

    def make(p, x, y, _):
        gap = x @ coefficients[p][:-1] + coefficients[p][-1] - y[:, None]
        return np.concatenate([np.abs(gap).sum(0), (gap**2).sum(0), [len(y)]])

    blocks = pack(parts).sums(True, make)
    t = coefficients[0].shape[1]
    return [(b[:t] / b[-1], b[t : 2 * t] / b[-1], b[-1]) for b in blocks if b is not None]


def held_out_f1(parts: Sequence[DataFrame] | Blocks, coefficients: Sequence[np.ndarray]) -> list[np.ndarray]:
    """Per fold the F1 of each trial on the rows left out, in one pass; 0 where no row is called 1."""

    def make(p, x, y, _):
        called = x @ coefficients[p][:-1] + coefficients[p][-1] > 0
        return np.concatenate([(called & (y[:, None] == 1)).sum(0), called.sum(0), [(y == 1).sum()]]).astype(float)

    blocks = pack(parts).sums(True, make)
    t = coefficients[0].shape[1]
    out = []
    for b in blocks:
        if b is not None:
            under = b[t : 2 * t] + b[-1]
            out.append(np.where(under > 0, 2 * b[:t] / np.where(under > 0, under, 1), 0.0))
    return out


_DISCRIMINANT = "12_LinearDiscriminantAnalysis"


def shared(name: str, trials: Sequence[Mapping[str, Any]], regression: bool) -> bool:
    """Whether all trials are fits that share scans."""
    if name == _DISCRIMINANT:
        return bool(trials) and not regression
    return bool(trials) and all(penalty_of(name, t, 1.0) is not None for t in trials)


def fold_means(parts: Sequence[DataFrame] | Blocks, name: str, trials: Sequence[Mapping[str, Any]], regression: bool) -> list[float] | None:
    """Mean over the folds of each trial's mean absolute error or F1; None if some trial is not a fit of this kind.

    Trials that ask for the same fit (another solver, say) are fitted once.
    """
    if not shared(name, trials, regression):
        return None
    discriminant = name == _DISCRIMINANT
    keys = [t.get("shrinkage") if discriminant else (loss_of(name, t), penalty_of(name, t, 1.0)) for t in trials]
    place = {k: i for i, k in enumerate(dict.fromkeys(keys))}
    once = [trials[keys.index(k)] for k in place]
    blocks = pack(parts)
    if regression:
        errors = held_out_errors(blocks, squared_fits(blocks, name, once))
        means = [float(np.mean([e[0][t] for e in errors])) for t in range(len(once))]
    else:
        if discriminant and blocks.labels() - {0.0, 1.0}:
            return None
        fits = discriminant_fits(blocks, once) if discriminant else smooth_fits(blocks, name, once)
        scores = held_out_f1(blocks, fits)
        means = [float(np.mean([s[t] for s in scores])) for t in range(len(once))]
    return [means[place[k]] for k in keys]
