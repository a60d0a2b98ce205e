"""Phrase collocations by Toivonen's sampling: a sample proposes, full passes count exactly, until the border holds."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import fmix, lots, query, stage, table, word_hashes

LOT_BYTES = 4 << 20
#: Rows that a count table takes from a lot to the shuffle at once.
SEND_ROWS = 100_000
_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]

# Class of each byte: 0 in a word, 1 between words, 2 between pieces; bytes of letters beyond ASCII are 0x80 or more.
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = 1
_CLASS[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def split_pieces(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Lower-case A-Z, cut texts into pieces and pieces into words: (text, piece, word code) of each word, distinct words.

    Works on the bytes of all texts at once. Nulls count as empty texts.
    """
    texts = texts.cast(pa.large_binary())
    texts = pa.array([t or b"" for t in texts.to_pylist()], pa.large_binary()) if texts.null_count else texts
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = _LOWER[np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]]
    offsets = offsets - offsets[0]
    kind = _CLASS[raw]
    inside = kind == 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[:-1][np.diff(offsets) > 0]
    first[edges] = inside[edges]
    starts = np.flatnonzero(first)
    text = np.searchsorted(offsets, starts, side="right") - 1
    piece = np.cumsum(kind == 2, dtype=np.int32)[starts] + text  # both only grow, so their sum changes where either does
    kept = np.cumsum(inside, dtype=np.int32)
    ends = np.append(kept[starts] - 1, kept[-1] if len(kept) else 0).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw[inside].tobytes())])
    coded = words.dictionary_encode()
    return text, piece, coded.indices.to_numpy().astype(np.int64), coded.dictionary.cast(pa.large_string())


def _mix(left: np.ndarray, right: np.ndarray, k: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return fmix(left * _K[0] + right * _K[1] + np.uint64(k))


class Grams:
    """The n-grams of a lot, level by level: ids, hashes, counts, and the two n-grams of one word less that each is made of."""

    def __init__(self, part: pa.RecordBatch):
        text, self.piece, code, words = split_pieces(part.column("text"))
        langs = part.column("lang").dictionary_encode()
        lang = langs.indices.to_numpy().astype(np.int64)[text]
        # a word of a language is a number of its own, so that longer n-grams keep to one language
        pairs, self.ids = np.unique(lang * max(1, len(words)) + code, return_inverse=True)
        self.words, self.langs = words.take(pa.array(pairs % max(1, len(words)))), langs.dictionary.take(pa.array(pairs // max(1, len(words))))
        self.hashes = _mix(word_hashes(words)[pairs % max(1, len(words))], word_hashes(langs.dictionary)[pairs // max(1, len(words))], 1) if len(words) else np.zeros(0, np.uint64)
        self.word_hashes, self.n_words = self.hashes, len(pairs)
        self.firsts = np.arange(self.n_words)[:, None]  # the words of each n-gram
        self.ends, self.k = np.arange(len(code)), 1
        self.counts = np.bincount(self.ids, minlength=self.n_words)

    def longer(self, open_: np.ndarray) -> None:
        """Go to n-grams of one word more whose two parts are both ``open_``."""
        whole = np.full(len(self.piece), -1, np.int64)
        whole[self.ends] = np.where(open_[self.ids], self.ids, -1)
        ends = np.arange(1, len(whole))
        ends = ends[(whole[1:] >= 0) & (whole[:-1] >= 0) & (self.piece[1:] == self.piece[:-1])]
        size = max(1, len(self.hashes))
        pairs, self.ids = np.unique(whole[ends - 1] * size + whole[ends], return_inverse=True)
        self.left, self.right = pairs // size, pairs % size
        last = self.firsts[self.right][:, -1]
        self.k += 1
        self.hashes = _mix(self.hashes[self.left], self.word_hashes[last], self.k) if len(pairs) else np.zeros(0, np.uint64)
        self.firsts = np.column_stack([self.firsts[self.left], last]) if len(pairs) else np.zeros((0, self.k), np.int64)
        self.ends, self.counts = ends, np.bincount(self.ids, minlength=len(pairs))

    def rows(self, chosen: np.ndarray):
        """(lang, k, phrase, n) of the chosen n-grams, in bounded batches."""
        chosen = np.flatnonzero(chosen)
        for i in range(0, len(chosen), SEND_ROWS):
            some = chosen[i : i + SEND_ROWS]
            parts = [self.words.take(pa.array(self.firsts[some, j])) for j in range(self.k)]
            phrase = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if self.k > 1 else parts[0]
            lang = self.langs.take(pa.array(self.firsts[some, 0]))
            yield _batch(lang, np.full(len(some), self.k), phrase, self.counts[some])


def _batch(lang, k, phrase, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([lang.cast(pa.string()), pa.array(k, pa.int32()), phrase.cast(pa.string()), pa.array(n, pa.int64())], ["lang", "k", "phrase", "n"])


def gram_hashes(lang: pa.Array, phrase: pa.Array) -> np.ndarray:
    """The hashes of :class:`Grams` for phrases of one length."""
    lists = pc.split_pattern(phrase.cast(pa.large_string()), " ")
    words = np.ascontiguousarray(word_hashes(pc.list_flatten(lists)).reshape(len(phrase), -1)) if len(phrase) else np.zeros((0, 1), np.uint64)
    langs = word_hashes(lang.cast(pa.large_string()))
    each = [_mix(words[:, j], langs, 1) for j in range(words.shape[1])]
    return reduce(lambda done, j: _mix(done, each[j], j + 1), range(1, len(each)), each[0])


class Bitmap:
    """Set of hashes as one bit each in a table of fixed size: no member is missed, others may be taken for members."""

    def __init__(self, bits: int, places: np.ndarray, masks: np.ndarray):
        self.shift, self.table = np.uint64(64 - bits), np.zeros(1 << (bits - 6), np.uint64)
        self.table[places] = masks

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> self.shift
        return (self.table[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _bitmap(grams: DataFrame, bits: int) -> Bitmap:
    """Bits of all n-grams, or-ed together in Spark; at most 2 ** (bits - 6) rows reach the driver."""

    def run(batches):
        shift = np.uint64(64 - bits)
        for batch in batches:
            for k in np.unique(batch.column("k").to_numpy()):
                some = batch.filter(pc.equal(batch.column("k"), int(k)))
                at = gram_hashes(some.column("lang"), some.column("phrase")) >> shift
                place, back = np.unique((at >> np.uint64(6)).astype(np.int64), return_inverse=True)
                mask = np.zeros(len(place), np.uint64)
                np.bitwise_or.at(mask, back, np.uint64(1) << (at & np.uint64(63)))
                yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(mask.view(np.int64))], ["place", "mask"])

    found = grams.select("lang", "k", "phrase").mapInArrow(run, "place long, mask long").groupBy("place").agg(F.expr("bit_or(mask)").alias("mask")).toArrow()
    return Bitmap(bits, found.column("place").to_numpy(), found.column("mask").to_numpy().view(np.uint64))


class Members:
    """Which n-grams of each length may be frequent: a sorted list of hashes per length, or a bitmap of all."""

    def __init__(self, bitmap: Bitmap | None = None, lists: dict[int, np.ndarray] | None = None):
        self.bitmap, self.lists = bitmap, lists or {}

    def has(self, k: int, hashes: np.ndarray) -> np.ndarray:
        if self.bitmap is not None:
            return self.bitmap.has(hashes)
        known = self.lists.get(k, np.zeros(0, np.uint64))
        if not len(known):
            return np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        return known[at] == hashes


def _count_pass(members, longest: int, first: bool):
    """Counts of the n-grams that ``members``, a list of :class:`Members`, propose and that no earlier pass has counted.

    An n-gram is counted in the first pass whose members hold both its parts. The first pass counts every word
    besides, and all words of a language as a phrase of length 0.
    """

    def run(batches):
        for part in lots(batches, "text", LOT_BYTES):
            grams = Grams(part)
            if first:
                total = pa.table({"lang": grams.langs, "n": grams.counts}).group_by("lang").aggregate([("n", "sum")]).combine_chunks()
                if total.num_rows:
                    lang = total.column("lang").combine_chunks()
                    yield _batch(lang, np.zeros(len(lang)), pa.array([""] * len(lang)), total.column("n_sum").to_numpy())
                yield from grams.rows(np.ones(grams.n_words, bool))
            for k in range(1, longest):
                held = [m.has(k, grams.hashes) for m in members.value]
                grams.longer(reduce(np.logical_or, held))
                both = [h[grams.left] & h[grams.right] for h in held]
                yield from grams.rows(both[-1] & ~reduce(np.logical_or, both[:-1], np.zeros(len(grams.left), bool)))

    return run


def _failures(found: DataFrame, members: Members, longest: int) -> DataFrame:
    """Frequent phrases, short enough to be a part of others, that the pass which counted them did not expect."""
    expected = found.sparkSession.sparkContext.broadcast(members)

    def run(batches):
        for batch in batches:
            for k in np.unique(batch.column("k").to_numpy()):
                some = batch.filter(pc.equal(batch.column("k"), int(k)))
                yield some.filter(pa.array(~expected.value.has(int(k), gram_hashes(some.column("lang"), some.column("phrase")))))

    return found.where(F.col("k").between(1, longest - 1)).select("lang", "k", "phrase").mapInArrow(run, "lang string, k int, phrase string")


def _sample_lists(rows: DataFrame, total: int, least: int, longest: int, sample_bytes: int) -> dict[int, np.ndarray]:
    """Hashes of the n-grams, by length, that are frequent in a sample of about ``sample_bytes`` bytes of texts."""
    share = min(1.0, sample_bytes / max(1, total))
    low = max(2, int(0.75 * least * share))
    drawn = rows.where(F.pmod(F.xxhash64("text", "lang"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) + 1))

    def run(batches):
        for part in lots(batches, "text", LOT_BYTES):
            grams = Grams(part)
            for k in range(1, longest):
                if k > 1:
                    grams.longer(np.ones(len(grams.hashes), bool))
                columns = [pa.array(np.full(len(grams.hashes), k), pa.int32()), pa.array(grams.hashes.view(np.int64)), pa.array(grams.counts, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["k", "hash", "n"])

    found = drawn.mapInArrow(run, "k int, hash long, n long").groupBy("k", "hash").agg(F.sum("n").alias("n")).where(F.col("n") >= low).select("k", "hash").toArrow()
    k, hashes = found.column("k").to_numpy(), found.column("hash").to_numpy().view(np.uint64)
    return {i: np.sort(hashes[k == i]) for i in range(1, longest)}


def frequent_phrases(docs: DataFrame, least: int = 10, longest: int = 3, sample_bytes: int = 16 << 20, bits: int = 26) -> DataFrame:
    """(lang, k, phrase, n): every phrase of 1 to ``longest`` words with at least ``least`` occurrences, counted exactly.

    Row k = 0 of a language holds its number of words. Toivonen's method, for contiguous phrases inside pieces:

    * A sample of about ``sample_bytes`` bytes is mined with a lowered threshold. Its frequent phrases are a
      list of hashes of bounded size.
    * One pass over all texts counts every word and every phrase whose two parts (all but the last word, all but the first)
      the sample found frequent: its frequent phrases and their negative border.
    * A counted phrase that turns out frequent though the sample did not have it is a failure of the border: phrases made
      of it may be frequent too. Then a pass follows that counts the phrases whose parts are both *known* frequent and
      that no pass has counted yet, until the border holds; there are at most ``longest`` passes.

    Known phrases reach the tasks as a bitmap of 2 ** ``bits`` bits whatever their number; a wrong member is
    only counted in vain. Counts are summed per lot of texts first, so a common phrase is no
    hot key, then by the phrase's own text, so no two phrases share a count.

    Defined cases: null and empty texts have no words; a null ``lang`` is ``und``; repeated rows count
    as often as they occur; other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    members = [Members(lists=_sample_lists(rows, total, least, longest, sample_bytes))]
    known, names = None, "lang string, k int, phrase string, n long"
    while True:
        counted = rows.mapInArrow(_count_pass(spark.sparkContext.broadcast(members), longest, known is None), names)
        # counts are combined per lot already, so they go to the shuffle as they are
        summed = counted.repartition("lang", "k", "phrase").groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n")).where((F.col("k") == 0) | (F.col("n") >= least))
        found = stage(summed, "phrases")
        known = found if known is None else known.unionByName(found)
        if _failures(found, members[-1], longest).isEmpty():
            return known
        members = [*members, Members(_bitmap(known.where(F.col("k").between(1, longest - 1)), bits))]


def _parts(longest: int) -> Column:
    """For each cut of a phrase of up to ``longest`` words: (cut, first part, rest)."""
    words = F.split("phrase", " ", -1)

    def cut(c):
        return F.struct(c.alias("cut"), F.array_join(F.slice(words, 1, c), " ").alias("head"), F.array_join(F.slice(words, c + 1, F.size(words) - c), " ").alias("rest"))

    return F.transform(F.sequence(F.lit(1), F.col("k") - 1), cut)


def collocations(docs: DataFrame, least: int = 10, longest: int = 3, top: int = 2000, cover: int = 50, **mining) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of 2 to ``longest`` words of each language.

    ``score`` is floor(1000000 a a / (l r)) for the cut that scores least, the shortest first part of equals; decimals
    of 38 digits hold the products exactly up to 10 ** 15 occurrences. A candidate that lies inside a
    longer one with at least ``cover`` percent of its count is left out. ``top`` phrases per language are the report: by score,
    then a, both descending, then phrase in UTF-8 order.

    Parts of a frequent phrase are frequent themselves, so every l and r is in the table of
    :func:`frequent_phrases`, whose defined cases hold here; joins are on (lang, part), one row a part.
    """
    known = frequent_phrases(docs, least, longest, **mining)
    words = known.where("k = 0").select("lang", F.col("n").alias("words"))
    counts = known.where("k > 0").select("lang", "k", "phrase", "n")
    phrases = counts.where("k > 1")
    split = F.split("phrase", " ", -1)
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda s: F.transform(F.sequence(F.lit(1), F.col("k") - s + 1), lambda i: F.array_join(F.slice(split, i, s), " "))))
    longer = counts.where("k > 2").select("lang", "n", F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    kept = phrases.join(longer, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < cover * F.col("n"), F.lit(True)))
    cuts = kept.select("lang", "phrase", F.col("n").alias("a"), F.explode(_parts(longest)).alias("c")).select("lang", "phrase", "a", "c.cut", "c.head", "c.rest")
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    rests = counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    scored = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"])
    exact = scored.withColumn("score", F.expr("CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)) * CAST(1000000 AS DECIMAL(7,0)) DIV (CAST(l AS DECIMAL(15,0)) * CAST(r AS DECIMAL(15,0)))"))
    lowest = exact.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("s")).select("lang", "phrase", "a", "s.l", "s.r", "s.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = lowest.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("words").alias("n"), "score")


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, list_filter(regexp_split_to_array(p, '[ \t]+'), lambda w: w <> '') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)
), grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, (VALUES (1), (2), (3)) AS t(k))
), f AS (SELECT lang, k, phrase, count(*) AS n FROM grams GROUP BY ALL
), totals AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
), cand AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND n >= 10
), inner_parts AS (
  SELECT lang, phrase, max(n) AS n FROM (
    SELECT lang, n, array_to_string(w[1:2], ' ') AS phrase FROM cand WHERE k = 3 UNION ALL SELECT lang, n, array_to_string(w[2:3], ' ') FROM cand WHERE k = 3) GROUP BY ALL
), kept AS (
  SELECT c.* FROM cand c LEFT JOIN inner_parts i ON c.lang = i.lang AND c.phrase = i.phrase WHERE i.n IS NULL OR 100 * i.n < 50 * c.n
), cuts AS (
  SELECT c.lang, c.phrase, c.n AS a, cut, l.n AS l, r.n AS r,
    CAST(c.n AS HUGEINT) * c.n * 1000000 // (CAST(l.n AS HUGEINT) * r.n) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM kept) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[cut + 1:], ' ')
), lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT ranked.lang, CAST(rank AS INTEGER) AS rank, phrase, a, l, r, totals.n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals ON totals.lang = ranked.lang WHERE rank <= 2000
"""


@query("op11_collocations", SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents", "text", "lang"))
