"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fmix, give_back, lots, query, split_words, table, word_hashes
from millrace.llm.langid import held_out, unit_of

BLOCK_BYTES = 4 << 20
WINDOW, STRIDE = 32, 16
THRESHOLD = 0.7
_MARK = np.uint8(0)  # stands before and after each word in its character n-grams


def char_grams(words: pa.Array, sizes=(3, 4, 5)) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every character n-gram, word it belongs to), byte n-grams of the marked words."""
    raw = words.cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    lengths = np.diff(offsets)
    starts = offsets[:-1] - offsets[0] + 2 * np.arange(len(lengths))
    buffer = np.full(len(data) + 2 * len(lengths), _MARK)
    owner = np.repeat(np.arange(len(lengths)), lengths + 2)
    inside = np.ones(len(buffer), bool)
    inside[starts] = False
    inside[starts + lengths + 1] = False
    buffer[inside] = data
    codes, owners = [], []
    for n in sizes:
        code = np.full(max(0, len(buffer) - n + 1), n, np.uint64)
        for i in range(n):
            code = code * np.uint64(257) + buffer[i : len(code) + i].astype(np.uint64)
        same = owner[: len(code)] == owner[n - 1 : len(code) + n - 1] if len(code) else np.zeros(0, bool)
        codes.append(fmix(code[same]))
        owners.append(owner[: len(code)][same])
    return np.concatenate(codes), np.concatenate(owners)


@dataclass
class Evidence:
    """Log odds of hashed words and character n-grams between toxic and other training texts."""

    bits: int
    words: np.ndarray
    chars: np.ndarray


def _slots(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _odds(toxic: np.ndarray, other: np.ndarray, n_toxic: int, n_other: int) -> np.ndarray:
    """Smoothed log odds, drawn to 0 for what few texts have."""
    p, q = (toxic + 0.5) / (n_toxic + 1.0), (other + 0.5) / (n_other + 1.0)
    seen = toxic + other
    return (np.log(p / q) * seen / (seen + 4.0)).astype(np.float32)


def _gram_slots(words: pa.Array, bits: int, step: int = 20_000):
    """For lots of words in turn: (first word, slots of their character n-grams word by word, where each word's begin)."""
    for i in range(0, len(words), step):
        some = words.slice(i, step)
        grams, owner = char_grams(some)
        order = np.argsort(owner, kind="stable")
        yield i, _slots(grams[order], bits).astype(np.int32), np.searchsorted(owner[order], np.arange(len(some) + 1))


def gather_evidence(texts: list[str], toxic: np.ndarray, bits: int) -> Evidence:
    offsets, codes, words = split_words(pa.array(texts, pa.string()))
    word_slot = _slots(word_hashes(words), bits)
    lots, ends, at = [], [np.zeros(1, np.int64)], 0
    for _, slots, bounds in _gram_slots(words, bits):
        lots.append(slots)
        ends.append(bounds[1:] + at)
        at += len(slots)
    gram_slot, ends = np.concatenate(lots), np.concatenate(ends)
    counts = np.zeros((2, 2, 1 << bits), np.float32)
    for i, label in enumerate(toxic):
        mine = np.unique(codes[offsets[i] : offsets[i + 1]])
        counts[0, label, np.unique(word_slot[mine])] += 1
        own = [gram_slot[ends[w] : ends[w + 1]] for w in mine]
        if own:
            counts[1, label, np.unique(np.concatenate(own))] += 1
    n1, n0 = int(toxic.sum()), int((toxic == 0).sum())
    return Evidence(bits, _odds(counts[0, 1], counts[0, 0], n1, n0), _odds(counts[1, 1], counts[1, 0], n1, n0))


def word_inputs(words: pa.Array, evidence: Evidence) -> np.ndarray:
    """Fixed inputs of each distinct word: word odds, greatest, mean and least character odds, length."""
    out = np.zeros((len(words), 5), np.float32)
    if not len(words):
        return out
    out[:, 0] = evidence.words[_slots(word_hashes(words), evidence.bits)]
    for i, slots, bounds in _gram_slots(words, evidence.bits):
        odds, first = evidence.chars[slots], bounds[:-1]  # every word has a gram: marks make it three bytes at least
        n, rows = np.diff(bounds), slice(i, i + len(first))
        out[rows, 1] = np.maximum.reduceat(odds, first)
        out[rows, 2] = np.add.reduceat(odds, first) / n
        out[rows, 3] = np.minimum.reduceat(odds, first)
        out[rows, 4] = np.log1p(n) / 4
    return out


def _embeds(words: pa.Array, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Row of each word in the word table, and of its head (its first four bytes) in the character table."""
    import pyarrow.compute as pc

    heads = pc.binary_slice(words.cast(pa.large_binary()), 0, 4) if len(words) else words
    coded = heads.dictionary_encode()
    head_hash = np.array([hash_bytes(h) for h in coded.dictionary.to_pylist()], np.uint64)[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.uint64)
    return (word_hashes(words) % np.uint64(rows)).astype(np.int64), (head_hash % np.uint64(rows)).astype(np.int64)


def hash_bytes(value: bytes) -> int:
    h = 14695981039346656037
    for b in value:
        h = (h ^ b) * 1099511628211 % (1 << 64)
    return h >> 7


def windows_of(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word, text) of all windows: every STRIDE words, until a window reaches the text's end."""
    n = np.diff(offsets)
    count = np.where(n > 0, 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE)), 0)
    text = np.repeat(np.arange(len(n)), count)
    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return offsets[:-1][text] + within * STRIDE, text


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Word and character tables, a GRU in each direction, attention, and a logistic output."""

    p: dict[str, np.ndarray] = field(default_factory=dict)
    rows: int = 4096
    hidden: int = 8

    @staticmethod
    def new(seed: int = 7, rows: int = 4096, embed: int = 4, hidden: int = 8) -> Network:
        rng = np.random.default_rng(seed)
        d = 5 + 2 * embed
        p = {"word": rng.normal(0, 0.05, (rows, embed)), "char": rng.normal(0, 0.05, (rows, embed))}
        for side in "fb":
            p |= {f"W{side}": rng.normal(0, d**-0.5, (d, 3 * hidden)), f"U{side}": rng.normal(0, hidden**-0.5, (hidden, 3 * hidden)), f"b{side}": np.zeros(3 * hidden)}
        p |= {"Wa": rng.normal(0, (2 * hidden) ** -0.5, (2 * hidden, hidden)), "ba": np.zeros(hidden), "va": rng.normal(0, 0.3, hidden), "wo": rng.normal(0, 0.3, 2 * hidden), "bo": np.zeros(1)}
        return Network({k: v.astype(np.float32) for k, v in p.items()}, rows, hidden)

    def inputs(self, fixed, words, chars):
        return np.concatenate([fixed, self.p["word"][words], self.p["char"][chars]], -1)

    def _run(self, x, mask, side, keep):
        """States of one direction (T, B, H); with ``keep`` also what the way back needs."""
        h_size, p = self.hidden, self.p
        gates = x @ p[f"W{side}"] + p[f"b{side}"]  # (T, B, 3H)
        u = p[f"U{side}"]
        h = np.zeros((x.shape[1], h_size), np.float32)
        states, kept = np.empty((len(x), x.shape[1], h_size), np.float32), []
        for t in range(len(x)) if side == "f" else range(len(x) - 1, -1, -1):
            hu = h @ u
            zr = _sigmoid(gates[t, :, : 2 * h_size] + hu[:, : 2 * h_size])
            z, r = zr[:, :h_size], zr[:, h_size:]
            hn = hu[:, 2 * h_size :]
            n = np.tanh(gates[t, :, 2 * h_size :] + r * hn)
            new = n + z * (h - n)
            if keep:
                kept.append((t, h, z, r, hn, n))
            h = np.where(mask[t, :, None], new, h)
            states[t] = h
        return states, kept

    def forward(self, x, mask, keep=False):
        """Logit of each window. x: (T, B, D), mask: (T, B)."""
        p = self.p
        hf, kf = self._run(x, mask, "f", keep)
        hb, kb = self._run(x, mask, "b", keep)
        h = np.concatenate([hf, hb], -1)
        a = np.tanh(h @ p["Wa"] + p["ba"])
        s = np.where(mask, a @ p["va"], np.float32(-1e9))
        e = np.exp(s - s.max(0))
        alpha = e / e.sum(0)
        c = (alpha[:, :, None] * h).sum(0)
        logit = c @ p["wo"] + p["bo"]
        return (logit, (kf, kb, h, a, alpha, c)) if keep else logit

    def gradients(self, x, mask, target, weight):
        """Gradients of the weighted cross entropy, and of the inputs."""
        p, hs = self.p, self.hidden
        logit, (kf, kb, h, a, alpha, c) = self.forward(x, mask, True)
        d = ((_sigmoid(logit) - target) * weight / weight.sum()).astype(np.float32)
        g = {"wo": c.T @ d, "bo": d.sum(keepdims=True)}
        dc = d[:, None] * p["wo"]
        dalpha = (h * dc).sum(-1)
        dh = alpha[:, :, None] * dc
        ds = alpha * (dalpha - (alpha * dalpha).sum(0))
        g["va"] = np.tensordot(a, ds, ([0, 1], [0, 1]))
        da = ds[:, :, None] * p["va"] * (1 - a**2)
        g["Wa"], g["ba"] = np.tensordot(h, da, ([0, 1], [0, 1])), da.sum((0, 1))
        dh = dh + da @ p["Wa"].T
        dx = np.zeros_like(x)
        for side, kept, part in (("f", kf, dh[:, :, :hs]), ("b", kb, dh[:, :, hs:])):
            u, dgates = p[f"U{side}"], np.zeros((*x.shape[:2], 3 * hs), np.float32)
            du, carry = np.zeros_like(u), np.zeros((x.shape[1], hs), np.float32)
            for t, before, z, r, hn, n in reversed(kept):
                total = part[t] + carry
                live = mask[t, :, None]
                dn = total * live
                dz = dn * (before - n) * z * (1 - z)
                dpre = dn * (1 - z) * (1 - n**2)
                dr = dpre * hn * r * (1 - r)
                dgates[t] = np.concatenate([dz, dr, dpre], -1)
                dhu = np.concatenate([dz, dr, dpre * r], -1)
                du += before.T @ dhu
                carry = np.where(live, dn * z + dhu @ u.T, total)
            g[f"U{side}"], g[f"b{side}"] = du, dgates.sum((0, 1))
            g[f"W{side}"] = np.tensordot(x, dgates, ([0, 1], [0, 1]))
            dx += dgates @ p[f"W{side}"].T
        return g, dx


@dataclass
class Model:
    network: Network
    evidence: Evidence
    scale: float = 1.0
    shift: float = 0.0

    def text_logits(self, texts: pa.Array, batch: int = 2048) -> np.ndarray:
        """Greatest window logit of each whole text; -inf where it has no words."""
        offsets, codes, words = split_words(texts)
        fixed = word_inputs(words, self.evidence)
        x_of = self.network.inputs(fixed, *_embeds(words, self.network.rows)) if len(words) else np.zeros((1, 1), np.float32)
        start, text = windows_of(offsets)
        best = np.full(len(offsets) - 1, -np.inf)
        last = offsets[1:][text]
        for i in range(0, len(start), batch):
            at = start[i : i + batch] + np.arange(min(WINDOW, int((last - start).max())))[:, None]
            mask = at < last[i : i + batch]
            x = x_of[codes[np.minimum(at, len(codes) - 1)]]
            np.maximum.at(best, text[i : i + batch], self.network.forward(x, mask))
        return best

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Calibrated chance of label 1; a text without words scores as the least toxic text."""
        logits = np.maximum(self.text_logits(texts), -30.0)
        return 1 / (1 + np.exp(-np.clip(self.scale * logits + self.shift, -60, 60)))


def _adam(p, g, state, rate):
    """One step; the tables move slower than the network, or they learn the sample by heart."""
    state["t"] += 1
    for k, v in g.items():
        pace = rate * (0.1 if k in ("word", "char") else 1.0)
        m, s = state.setdefault(k, (np.zeros_like(p[k]), np.zeros_like(p[k])))
        m[:] = 0.9 * m + 0.1 * v
        s[:] = 0.999 * s + 0.001 * v**2
        p[k] -= pace * (m / (1 - 0.9 ** state["t"])) / (np.sqrt(s / (1 - 0.999 ** state["t"])) + 1e-8)


def train(texts: list[str], labels: list[int], bits: int = 18, epochs: int = 6, rounds: int = 2, clean_windows: int = 6, batch: int = 256, rate: float = 0.01, seed: int = 7) -> Model | None:
    """Fit on whole labelled texts (multiple instances: a toxic text has a toxic window).

    The odds that a text's words bring along come from the other half of the sample, so
    that the network learns how far to trust them. Each round takes the
    most toxic window of a toxic text as positive, and random windows plus the most toxic one
    of a clean text as negative; the first round ranks by character odds. None without both labels.
    """
    toxic = np.array(labels, np.int64)
    if len(set(labels)) < 2:
        return None
    rng = np.random.default_rng(seed)
    half = np.zeros(len(texts), np.int64)
    for label in (0, 1):
        rows = np.flatnonzero(toxic == label)
        half[rows] = np.arange(len(rows)) % 2
    offsets, codes, words = split_words(pa.array(texts, pa.string()))
    fixed = []
    for h in (0, 1):
        others = [t for t, x in zip(texts, half, strict=True) if x != h]
        fixed.append(word_inputs(words, gather_evidence(others, toxic[half != h], bits)))
        give_back()
    network = Network.new(seed)
    word_rows, char_rows = _embeds(words, network.rows)
    start, text = windows_of(offsets)
    if not len(start):
        return None
    last = offsets[1:][text]
    at = start.astype(np.int32)[:, None] + np.arange(WINDOW, dtype=np.int32)
    mask = at < last[:, None]
    token = codes.astype(np.int32)[np.minimum(at, len(codes) - 1)]
    del at, words
    give_back()
    side = half[text]
    value = np.empty(len(start), np.float32)
    for h in (0, 1):
        value[side == h] = np.where(mask[side == h], fixed[h][token[side == h], 1], -9).max(1)

    def batch_of(rows):
        f = np.where((side[rows] == 0)[:, None, None], fixed[0][token[rows]], fixed[1][token[rows]])
        return network.inputs(f, word_rows[token[rows]], char_rows[token[rows]]).transpose(1, 0, 2), mask[rows].T

    def top_window(value):
        order = np.lexsort((value, text))
        return order[np.append(np.flatnonzero(np.diff(text[order])), len(order) - 1)]

    state = {"t": 0}
    e = network.p["word"].shape[1]
    for round_ in range(rounds):
        if round_:
            value = np.concatenate([network.forward(*batch_of(np.arange(i, min(i + 2048, len(start))))) for i in range(0, len(start), 2048)])
        best = top_window(value)
        positive = best[toxic[text[best]] == 1]
        clean = np.flatnonzero(toxic[text] == 0)
        want = min(len(clean), clean_windows * int((toxic == 0).sum()))
        negative = np.unique(np.concatenate([best[toxic[text[best]] == 0], rng.choice(clean, want, replace=False)]))
        rows = np.concatenate([positive, negative])
        target = np.concatenate([np.ones(len(positive)), np.zeros(len(negative))]).astype(np.float32)
        weight = np.where(target == 1, min(8.0, len(negative) / max(1, len(positive))), 1.0).astype(np.float32)
        steps = max(epochs, -(-200 * batch // len(rows)))  # a small sample is passed over more often
        for _ in range(min(steps, 40)):
            order = rng.permutation(len(rows))
            for i in range(0, len(rows), batch):
                some = order[i : i + batch]
                x, m = batch_of(rows[some])
                shown = (rng.random((*x.shape[:2], 1)) < 0.5).astype(np.float32)  # half of the tokens show their fixed inputs only
                x[..., 5:] *= shown
                g, dx = network.gradients(x, m, target[some], weight[some])
                dx[..., 5:] *= shown
                dx = dx.transpose(1, 0, 2)
                for name, part, index in (("word", dx[..., 5 : 5 + e], word_rows), ("char", dx[..., 5 + e :], char_rows)):
                    g[name] = np.zeros_like(network.p[name])
                    np.add.at(g[name], index[token[rows[some]]], part)
                _adam(network.p, g, state, rate / (1 + round_))
    for name in ("word", "char"):
        network.p[name] *= np.float32(0.5)
    value = np.concatenate([network.forward(*batch_of(np.arange(i, min(i + 2048, len(start))))) for i in range(0, len(start), 2048)])
    best = top_window(value)
    scale, shift = _calibrate(value[best].astype(float), toxic[text[best]])
    del token, mask, fixed
    give_back()
    return Model(network, gather_evidence(texts, toxic, bits), scale, shift)


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic fit of the label on a text's greatest logit, by damped Newton steps."""
    w = np.array([1.0, 0.0])
    a = np.stack([x, np.ones_like(x)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -60, 60)))
        grad = a.T @ (p - y) + 1e-2 * (w - [1.0, 0.0])
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(2), grad)
        w = w - step / max(1.0, np.abs(step).max())
    return float(max(w[0], 1e-3)), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, toxic_texts: int = 1500, clean_texts: int = 3000, max_bytes: int = 32_768, **options) -> Model | None:
    """Train on a bounded sample of labelled texts.

    The bound is about ``toxic_texts`` and ``clean_texts`` texts of at most ``max_bytes`` bytes, those whose hashed id
    falls below the share that leaves so many. A null label is no label; a document labelled more than
    once counts as toxic if any label says so.
    """
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg((F.max("toxic") == 1).cast("int").alias("toxic"))
    counts = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    limit = F.when(F.col("toxic") == 1, F.lit(toxic_texts / max(1, counts.get(1, 0)))).otherwise(F.lit(clean_texts / max(1, counts.get(0, 0))))
    chosen = known.where(unit_of("doc_id") < limit)
    found = docs.select("doc_id", F.col("text").cast("string").alias("text")).where(F.octet_length("text").between(1, max_bytes))
    rows = sorted(found.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic").collect(), key=lambda r: (r.doc_id, r.text))
    with np.errstate(over="ignore"):
        model = train([r.text for r in rows], [r.toxic for r in rows], **options)
    del rows
    give_back()
    return model


def score(docs: DataFrame, model: Model | None, key: str = "doc_id") -> DataFrame:
    """(key, score, predicted) per row, from all overlapping windows of the whole text.

    A null, empty or wordless text scores as the least toxic one; without a model every score is 0.
    Rows are scored apart from each other, so null or repeated keys are carried along; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for part in lots(batches, "text", BLOCK_BYTES):
            with np.errstate(over="ignore"):
                values = model.scores(part.column("text")) if model else np.zeros(part.num_rows)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(values), pa.array((values >= THRESHOLD).astype(np.int32))], [key, "score", "predicted"])

    rows = docs.select(key, F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"{key} {dict(docs.dtypes)[key]}, score double, predicted int")


def reject(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with its own columns, without the rows whose whole text scores at or above the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for part in lots(batches, "text", BLOCK_BYTES):
            with np.errstate(over="ignore"):
                values = model.scores(part.column("text")) if model else np.zeros(part.num_rows)
            yield part.filter(pa.array(values < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)


@query("op9_toxicity")
def op9(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text")
    labels = table(spark, folder, "labels", "doc_id", "toxic")
    model = fit(docs.where(held_out(3) != 1), labels.where(held_out(3) != 1))
    return score(docs, model).select("doc_id", (held_out(3) == 1).alias("held_out"), "score", "predicted")
