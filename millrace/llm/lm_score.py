"""Stupid-backoff language-model scores from n-gram counts of the whole corpus."""

from __future__ import annotations

import hashlib
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fmix, lots, query, split_words, stage, table, word_hashes

BLOCK_BYTES = 10 << 20
_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]


def _positions(counts: np.ndarray) -> np.ndarray:
    """Place of each word in its text."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def gram_ids(codes: np.ndarray, place: np.ndarray, order: int):
    """For each order, the words that end an n-gram and the n-gram's id; ids follow the order of (shorter n-gram, word)."""
    n_words = int(codes.max()) + 1 if len(codes) else 0
    ends, ids = np.arange(len(codes)), codes
    yield ends, ids, n_words, None
    for k in range(2, order + 1):
        whole = np.full(len(codes), -1, np.int64)
        whole[ends] = ids
        ends = np.flatnonzero(place >= k - 1)
        pairs, ids = np.unique(whole[ends - 1] * n_words + codes[ends], return_inverse=True)
        yield ends, ids, len(pairs), pairs


def _blocks(batches):
    for part in lots(batches, "text", BLOCK_BYTES):
        offsets, codes, words = split_words(part.column("text"))
        keys = part.column(0)
        seal = hashlib.blake2b(repr(keys.to_pylist()).encode(), digest_size=8)
        seal.update(offsets.tobytes() + codes.tobytes())
        yield int.from_bytes(seal.digest(), "little", signed=True), keys, np.diff(offsets), codes, words


def gram_hashes(words: np.ndarray, codes: np.ndarray, counts: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, count) of each distinct n-gram of a block, orders one after another; ``words`` holds the word hashes."""
    hashes, times, last = [], [], None
    for k, (_, ids, size, pairs) in enumerate(gram_ids(codes, _positions(counts), order), 1):
        last = fmix(words * _K[0] + np.uint64(1)) if k == 1 else fmix(last[pairs // len(words)] * _K[0] + words[pairs % len(words)] * _K[1] + np.uint64(k))
        hashes.append(last)
        times.append(np.bincount(ids, minlength=size))
    return np.concatenate(hashes), np.concatenate(times)


def _pack(*columns: np.ndarray) -> bytes:
    """Unsigned numbers of equal count as compressed byte planes."""
    planes = [np.ascontiguousarray(c.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns]
    return zstandard.compress(b"".join(planes), 1)


def _unpack(packed: bytes, n: int, columns: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(columns, 8, n)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.uint64).reshape(columns, n)


def _count_rows(order: int, parts: int):
    """The exploded n-grams of a block: a row per hash partition, n-grams in hash order as steps, with counts."""

    def run(batches):
        for block, _, counts, codes, words in _blocks(batches):
            if not len(codes):
                continue
            with np.errstate(over="ignore"):
                hashes, times = gram_hashes(word_hashes(words), codes, counts, order)
            turn = np.argsort(hashes, kind="stable")
            hashes, times = hashes[turn], times[turn]
            part = ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            cuts = np.flatnonzero(np.diff(part)) + 1
            rows = [(int(part[i]), block, j - i, _pack(np.diff(hashes[i:j], prepend=np.uint64(0)), times[i:j])) for i, j in pairwise([0, *cuts, len(part)])]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.int32(), pa.binary()), strict=True)], ["part", "block", "n", "packed"])

    return run


def _join_counts(rows: pa.Table) -> pa.Table:
    """The count table of one hash partition, joined back to each block's n-grams."""
    sizes = rows.column("n").to_pylist()
    found = [_unpack(p, n, 2) for n, p in zip(sizes, rows.column("packed").to_pylist(), strict=True)]
    grams, place = np.unique(np.concatenate([np.cumsum(f[0], dtype=np.uint64) for f in found]), return_inverse=True)
    table = np.zeros(len(grams), np.uint64)
    np.add.at(table, place, np.concatenate([f[1] for f in found]))
    ends = np.cumsum([0, *sizes])
    packed = [_pack(table[place[i:j]]) for i, j in pairwise(ends)]
    return pa.table([rows.column("block"), rows.column("part"), rows.column("n"), pa.array(packed, pa.binary())], ["block", "part", "n", "packed"])


def _layouts(batches):
    for block, keys, counts, codes, words in _blocks(batches):
        columns = [[block], [keys.to_pylist()], [counts], [len(words)], [word_hashes(words).tobytes()], [_pack(codes)]]
        kinds = (pa.int64(), pa.list_(keys.type), pa.list_(pa.int32()), pa.int32(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["block", "keys", "counts", "n_words", "words", "codes"])


def own_counts(text: np.ndarray, ids: np.ndarray, size: int, step: int = 1 << 20) -> np.ndarray:
    """How often each n-gram occurrence's own text has its n-gram; texts are taken a bounded lot at a time."""
    out, start = np.zeros(len(ids), np.int64), 0
    while start < len(ids):
        end = min(len(ids), start + step)
        if end < len(ids):
            cut = int(np.searchsorted(text, text[end]))
            end = cut if cut > start else int(np.searchsorted(text, text[end], side="right"))
        _, back, times = np.unique((text[start:end] - text[start]) * max(1, size) + ids[start:end], return_inverse=True, return_counts=True)
        out[start:end] = times[back]
        start = end
    return out


def score_tokens(codes: np.ndarray, counts: np.ndarray, totals_of, order: int, alpha: float):
    """Per text: (sum of logs without the corpus size, number of words scored by their own count).

    ``totals_of(k, size, own)`` gives corpus counts of the order-k n-grams of the block. The text's
    own occurrences are taken out of every count.
    """
    place, text = _positions(counts), np.repeat(np.arange(len(counts)), counts)
    logs, short = np.zeros(len(codes)), np.ones(len(codes), bool)
    context = None
    for k, (ends, ids, size, _) in enumerate(gram_ids(codes, place, order), 1):
        totals = totals_of(k, size, np.bincount(ids, minlength=size))
        left = np.zeros(len(codes))
        left[ends] = totals[ids] - own_counts(text[ends], ids, size)
        if k == 1:
            logs = np.log(np.where(left > 0, left, alpha))
        else:
            seen = ends[left[ends] > 0]
            missed = ends[left[ends] <= 0]
            logs[seen] = np.log(left[seen]) - np.log(context[seen - 1])
            logs[missed] += np.log(alpha)
            short[seen] = False
        context = left
    return np.bincount(text, logs, len(counts)), np.bincount(text, short, len(counts)).astype(np.int64)


def _scored(order: int, alpha: float):
    def run(grams: pa.Table, layout: pa.Table) -> pa.Table:
        if layout.num_rows == 0:
            raise ValueError("the texts changed between two scans")
        parts = dict(zip(grams.column("part").to_pylist(), zip(grams.column("n").to_pylist(), grams.column("packed").to_pylist(), strict=True), strict=True))
        found = [_unpack(packed, n, 1)[0] for _, (n, packed) in sorted(parts.items())]  # equal blocks of repeated rows share their counts
        out = []
        for keys, counts, words, packed in zip(*(layout.column(c).to_pylist() for c in ("keys", "counts", "words", "codes")), strict=True):
            codes = _unpack(packed, sum(counts), 1)[0].astype(np.int64)
            counts, totals = np.array(counts, np.int64), np.zeros(0, np.int64)
            if len(codes):
                with np.errstate(over="ignore"):
                    hashes, times = gram_hashes(np.frombuffer(words, np.uint64), codes, counts, order)
                totals = np.empty(len(hashes), np.int64)
                totals[np.argsort(hashes, kind="stable")] = np.concatenate(found)
            shift = [0]

            def totals_of(_, size, own, totals=totals, shift=shift):
                shift[0] += size
                return totals[shift[0] - size : shift[0]]

            sums, short = score_tokens(codes, counts, totals_of, order, alpha)
            out.append(pa.table([pa.array(keys, layout.schema.field("keys").type.value_type), pa.array(counts, pa.int64()), pa.array(sums), pa.array(short)], ["key", "n_words", "logs", "short"]))
        return pa.concat_tables(out)

    return run


def score(docs: DataFrame, order: int = 2, alpha: float = 0.4, key: str = "doc_id", grams_per_part: int = 2_000_000) -> DataFrame:
    """(key, n_words, n_backoff, log_score, mean_log_score) of every whole text.

    A word w after context u scores c(uw) / c(u) where uw is seen in another document, else alpha times
    its score after a context shorter by a word; at last c(w) / N, with alpha in place of a count
    of 0. Counts cover all documents and leave the scored document out, so a text is not evidence for
    itself. ``n_backoff`` is the number of words that ended at their own count. Logs are natural.

    Count tables are partitioned by the n-gram's hash. Each block of texts sends a distinct n-gram
    once to its partition, so a common n-gram comes once a block and is no hot key; there the table is
    summed and joined to the n-grams, and counts go back to the block, where they are summed per document. A
    row of the shuffle holds the n-grams of one block and partition, packed; ``grams_per_part`` bounds
    what meets in one task. Texts never travel, only numbers do.

    Defined cases: a null, empty or wordless text has 0 words, score 0 and a null mean; null or
    repeated keys are carried along (copies under one key are still documents of their own);
    other columns are ignored.
    """
    kind = dict(docs.dtypes)[key]
    rows = docs.select(key, F.col("text").cast("string").alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_parts = max(16, size * order // (6 * grams_per_part))
    grams = rows.mapInArrow(_count_rows(order, n_parts), "part int, block long, n int, packed binary")
    counted = grams.groupBy("part").applyInArrow(_join_counts, "block long, part int, n int, packed binary")
    layouts = rows.mapInArrow(_layouts, f"block long, keys array<{kind}>, counts array<int>, n_words int, words binary, codes binary")
    parts = counted.groupBy("block").cogroup(layouts.groupBy("block")).applyInArrow(_scored(order, alpha), f"key {kind}, n_words long, logs double, short long")
    parts = stage(parts.withColumnRenamed("key", key), "lm-parts")
    n = parts.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    rest = F.log(F.greatest(F.lit(n) - F.col("n_words"), F.lit(1)))
    out = parts.withColumn("log_score", F.when(F.col("n_words") == 0, F.lit(0.0)).otherwise(F.col("logs") - F.col("short") * rest))
    return out.select(key, "n_words", F.col("short").alias("n_backoff"), F.round("log_score", 4).alias("log_score"), F.round(F.try_divide("log_score", F.col("n_words")), 6).alias("mean_log_score"))


SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS l FROM documents
), tokens AS (
  SELECT doc_id, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS w FROM words
), pairs AS (
  SELECT doc_id, i, w, lag(w) OVER (PARTITION BY doc_id ORDER BY i) AS u FROM tokens
), total AS (SELECT count(*) AS n FROM tokens
), one AS (SELECT w, count(*) AS c FROM tokens GROUP BY w
), one_d AS (SELECT doc_id, w, count(*) AS c FROM tokens GROUP BY doc_id, w
), two AS (SELECT u, w, count(*) AS c FROM pairs WHERE u IS NOT NULL GROUP BY u, w
), two_d AS (SELECT doc_id, u, w, count(*) AS c FROM pairs WHERE u IS NOT NULL GROUP BY doc_id, u, w
), left_out AS (
  SELECT p.doc_id, a.c - ad.c AS cw, b.c - bd.c AS cu, t.c - td.c AS cuw, p.u, n - len(l) AS n
  FROM pairs p JOIN words USING (doc_id) CROSS JOIN total
  JOIN one a ON a.w = p.w JOIN one_d ad ON ad.doc_id = p.doc_id AND ad.w = p.w
  LEFT JOIN one b ON b.w = p.u LEFT JOIN one_d bd ON bd.doc_id = p.doc_id AND bd.w = p.u
  LEFT JOIN two t ON t.u = p.u AND t.w = p.w LEFT JOIN two_d td ON td.doc_id = p.doc_id AND td.u = p.u AND td.w = p.w
), scored AS (
  SELECT doc_id, CASE WHEN cuw > 0 THEN ln(cuw) - ln(cu) ELSE (CASE WHEN u IS NULL THEN 0 ELSE ln(0.4) END) + ln(CASE WHEN cw > 0 THEN cw ELSE 0.4 END) - ln(greatest(n, 1)) END AS s,
    CASE WHEN cuw > 0 THEN 0 ELSE 1 END AS short FROM left_out
), summed AS (SELECT doc_id, sum(s) AS s, sum(short) AS short FROM scored GROUP BY doc_id
)
SELECT doc_id, CAST(len(l) AS BIGINT) AS n_words, CAST(coalesce(short, 0) AS BIGINT) AS n_backoff, round(coalesce(s, 0), 4) AS log_score,
  round(CASE WHEN len(l) > 0 THEN s / len(l) END, 6) AS mean_log_score
FROM words LEFT JOIN summed USING (doc_id)
"""


@query("op1_stupid_backoff", SQL)
def op1(spark, folder):
    return score(table(spark, folder, "documents", "doc_id", "text"))
