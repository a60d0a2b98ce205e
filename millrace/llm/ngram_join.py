"""N-gram Jaccard join by vertical partitioning of the global n-gram order."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fmix, lots, query, split_words, stage, table, word_hashes
from millrace.operators.graph import connected_components

BLOCK_BYTES = 8 << 20
#: Partners of a class that are counted in one task.
GROUP_SETS = 1000
#: Segments that leave a task in one batch.
SEND_ROWS = 20_000
_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def shingle_sets(texts: pa.Array, width: int):
    """Distinct shingle hashes of each text, ascending. A shorter text is one shingle; no words, none."""
    offsets, codes, words = split_words(texts)
    hashes = word_hashes(words)[codes] if len(codes) else np.zeros(0, np.uint64)
    n = len(hashes)
    grams = np.zeros(max(0, n - width + 1), np.uint64)
    for i in range(width):
        grams = fmix(grams * _K[0] + hashes[i : n - width + 1 + i] + _K[1])
    for start, end in zip(offsets[:-1], offsets[1:], strict=True):
        if end - start >= width:
            yield np.unique(grams[start : end - width + 1])
        elif end > start:
            whole = np.uint64(end - start)
            for h in hashes[start:end]:
                whole = fmix(np.array([whole * _K[2] + h]))[0]
            yield np.array([whole], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def _fingerprint(grams: np.ndarray) -> bytes | None:
    return hashlib.md5(grams.tobytes()).digest() if len(grams) else None


def _scan(width: int, buckets: int, chunks: int):
    """Per text its set size and fingerprint; per task one sketch of shingle counts, in chunks."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("fp", pa.binary()), ("chunk", pa.int32()), ("counts", pa.binary())])

    def run(batches):
        counts = np.zeros(buckets, np.uint32)
        for part in lots(batches, "text", BLOCK_BYTES):
            sizes, prints = [], []
            with np.errstate(over="ignore"):
                for grams in shingle_sets(part.column("text"), width):
                    sizes.append(len(grams))
                    prints.append(_fingerprint(grams))
                    np.add.at(counts, grams & np.uint64(buckets - 1), 1)
            none = pa.nulls(part.num_rows, pa.int32()), pa.nulls(part.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sizes, pa.int32()), pa.array(prints, pa.binary()), *none], schema=schema)
        # a task counts up to 255: the sketch only orders the n-grams, and any order is exact
        packed = [zstandard.compress(np.minimum(c, 255).astype(np.uint8).tobytes(), 1) for c in counts.reshape(chunks, -1)]
        none = pa.nulls(chunks, pa.int64()), pa.nulls(chunks, pa.int32()), pa.nulls(chunks, pa.binary())
        yield pa.RecordBatch.from_arrays([*none, pa.array(range(chunks), pa.int32()), pa.array(packed, pa.binary())], schema=schema)

    return run


def _add_up(batches):
    """Sum the sketches of a task's chunks as they stream by; memory is one sum per chunk."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, packed in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            part = np.frombuffer(zstandard.decompress(packed), np.uint8).astype(np.uint64)
            sums[chunk] = sums[chunk] + part if chunk in sums else part
    if sums:
        rows = [rank_of(c).tobytes() for c in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(rows, pa.binary())], ["chunk", "ranks"])


def rank_of(counts: np.ndarray) -> np.ndarray:
    """One byte that grows with the count: exact below 64, then eight steps a doubling."""
    steps = 64 + 8 * np.log2(np.maximum(counts, 64) / 64.0)
    return np.where(counts < 64, counts, np.minimum(steps, 255)).astype(np.uint8)


def cut_points(held: np.ndarray, fragments: int) -> np.ndarray:
    """Pivots that cut the global order (rank, hash) into fragments of about equal mass; ``held`` counts the buckets of each rank.

    The order key of an n-gram is its rank in the top byte and its hash below,
    so inside one rank the mass is even and pivots are interpolated.
    """
    rank = np.flatnonzero(held)
    buckets = held[rank]
    weight = np.where(rank < 64, rank, 64 * 2.0 ** ((rank.astype(float) - 64) / 8)) * buckets
    edge = np.concatenate([[0], np.cumsum(weight)])
    marks = edge[-1] * np.arange(1, fragments) / fragments
    at = np.clip(np.searchsorted(edge, marks, side="right") - 1, 0, max(0, len(rank) - 1))
    inside = np.clip((marks - edge[at]) / np.maximum(weight[at], 1), 0, 0.999)
    return (rank[at].astype(np.uint64) << np.uint64(56)) + (inside * 2.0**56).astype(np.uint64)


def order_keys(grams: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    rank = ranks[(grams & np.uint64(len(ranks) - 1)).astype(np.int64)].astype(np.uint64)
    return (rank << np.uint64(56)) | (grams >> np.uint64(8))


def _lists(rows: list[np.ndarray], kind) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(kind)))


def size_steps() -> np.ndarray:
    """Lower ends of size classes that grow by half each."""
    steps = [1]
    while steps[-1] < 1 << 40:
        steps.append(max(steps[-1] + 1, steps[-1] * 3 // 2))
    return np.array(steps)


def _signatures(width: int, num: int, den: int, pivots: np.ndarray, ranks_of):
    """One row per distinct set of a task: size, n-grams per fragment, and the prefix in global order.

    ``homes`` are the size classes of the set, from that of the smallest set it may link with to its own.
    """
    steps = size_steps()

    def run(batches):
        ranks, seen = np.frombuffer(ranks_of.value, np.uint8), set()
        for part in lots(batches, "text", BLOCK_BYTES):
            prints, sizes, cells, prefixes, homes = [], [], [], [], []
            with np.errstate(over="ignore"):
                for grams in shingle_sets(part.column("text"), width):
                    fp = _fingerprint(grams)
                    if fp is None or fp in seen:
                        continue
                    seen.add(fp)
                    n = len(grams)
                    keys = order_keys(grams, ranks)
                    order = np.lexsort((grams, keys))
                    prints.append(fp)
                    sizes.append(n)
                    cells.append(np.bincount(np.searchsorted(pivots, keys, side="right"), minlength=len(pivots) + 1))
                    low, own = np.searchsorted(steps, [(num * n + den - 1) // den, n], side="right")
                    homes.append(np.arange(low, own + 1))
                    prefixes.append(grams[order[: n - (num * n + den - 1) // den + 1]].view(np.int64))
            if prints:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(prints, pa.binary()), pa.array(sizes, pa.int32()), _lists(cells, np.int32), _lists(prefixes, np.int64), _lists(homes, np.int32)],
                    ["fp", "n", "cells", "prefix", "homes"],
                )

    return run


def _segments(width: int, pivots: np.ndarray, ranks_of):
    """Whole sets cut at the pivots: a row per fragment that has n-grams and per group that the set goes to.

    A text whose set is not the expected one (another row of its ``doc_id``) gives nothing.
    """

    def run(batches):
        ranks, seen = np.frombuffer(ranks_of.value, np.uint8), set()
        for part in lots(batches, "text", BLOCK_BYTES):
            places, parts, rows = [], [], []
            wanted, targets = part.column("fp").to_pylist(), part.column("targets").to_pylist()
            with np.errstate(over="ignore"):
                for i, grams in enumerate(shingle_sets(part.column("text"), width)):
                    fp = _fingerprint(grams)
                    if fp is None or fp != wanted[i] or fp in seen:
                        continue
                    seen.add(fp)
                    cell = np.searchsorted(pivots, order_keys(grams, ranks), side="right")
                    for f in np.unique(cell):
                        own = grams[cell == f].view(np.int64)
                        for t in targets[i]:
                            places.append((t["a"], t["salt"], t["id"]))
                            parts.append(f)
                            rows.append(own)
            for i in range(0, len(places), SEND_ROWS):
                a, salt, name = zip(*places[i : i + SEND_ROWS], strict=True)
                columns = [pa.array(a, pa.int64()), pa.array(parts[i : i + SEND_ROWS], pa.int32()), pa.array(salt, pa.int32()), pa.array(name, pa.int64()), _lists(rows[i : i + SEND_ROWS], np.int64)]
                yield pa.RecordBatch.from_arrays(columns, ["a", "fragment", "salt", "id", "grams"])

    return run


def _overlaps(batches):
    """Rows sorted by (class, fragment, salt), the class's own n-grams first: the overlap of each partner with them.

    One segment is held at a time, however many partners a class has; a repeated segment counts once.
    """
    key = own = last = None
    for batch in batches:
        names = [batch.column(c).to_numpy() for c in ("a", "fragment", "salt", "id")]
        lists = batch.column("grams")
        values, ends = lists.flatten().to_numpy(), np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))
        found = []
        for i, (a, fragment, salt, name) in enumerate(zip(*(c.tolist() for c in names), strict=True)):
            if (a, fragment, salt) != key:
                key, own, last = (a, fragment, salt), None, None
            grams = values[ends[i] : ends[i + 1]]
            if name == a:
                own = np.sort(grams)
            elif own is not None and name != last:
                last = name
                at = np.minimum(np.searchsorted(own, grams), len(own) - 1)
                if same := int(np.count_nonzero(own[at] == grams)):
                    found.append((a, name, same))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["a", "b", "part"])


class NgramJoin:
    """Links between documents whose n-gram sets have a Jaccard similarity of num/den or more.

    1. One scan gives each text its set size and fingerprint and counts all
       n-grams in a sketch (a counter for eight words, ``most_buckets`` at most). The order
       of n-grams is (sketched count, hash): any order is exact, a good one
       is fast. Equal sets collapse to one class.
    2. The order is cut by pivots of equal mass into ``fragments``. Each class
       keeps its counts per fragment and its prefix (the rarest n-grams, of
       which two similar sets share one).
    3. Candidates share a prefix n-gram and a size class, and pass the length, position and
       fragment-count bounds, all of which are lossless. A class's n-grams go to each of its partners'
       groups once, fragment by fragment; overlaps are counted there and summed per pair.
    4. Groups of near copies are not expanded: first each n-gram's most
       central class is compared with the others. Their links give
       components, and only pairs between different components follow.

    Defined cases: null or empty text has an empty set and no link; a null
    ``doc_id`` takes no part and is its own null component; repeated rows are
    copies; other columns are ignored.
    """

    def __init__(self, docs: DataFrame, width: int = 3, num: int = 90, den: int = 100, fragments: int = 16, most_buckets: int = 1 << 24, chunks: int = 1024, broadcast_rows: int = 1_000_000):
        self.spark = docs.sparkSession
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        self.width, self.num, self.den, self.broadcast_rows = width, num, den, broadcast_rows
        size = self.docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        buckets = min(most_buckets, max(chunks, 1 << (size // 48).bit_length()))
        scan = stage(self.docs.mapInArrow(_scan(width, buckets, chunks), "doc_id long, n int, fp binary, chunk int, counts binary"), "ngram-scan")
        self.sets = scan.where("chunk is null").select("doc_id", "n", "fp")
        sketch = scan.where("chunk is not null").select("chunk", "counts").repartition("chunk")
        # one copy of the ranks on the driver: chunks come a partition at a time and go straight to their place
        step, held = buckets // chunks, np.zeros(256, np.int64)
        ranks = bytearray(buckets)
        for row in stage(sketch.mapInArrow(_add_up, "chunk int, ranks binary"), "ngram-ranks").toLocalIterator():
            ranks[row.chunk * step : (row.chunk + 1) * step] = row.ranks
            held += np.bincount(np.frombuffer(row.ranks, np.uint8), minlength=256)
        if buckets > (seen := int(held.sum())):
            held[0] += buckets - seen
        self.pivots = cut_points(held, fragments)
        self.ranks = self.spark.sparkContext.broadcast(ranks)
        made = self.docs.select("text").mapInArrow(_signatures(width, num, den, self.pivots, self.ranks), "fp binary, n int, cells array<int>, prefix array<long>, homes array<int>")
        first = made.groupBy("fp").agg(*[F.first(c).alias(c) for c in ("n", "cells", "prefix", "homes")])
        self.classes = stage(first.withColumn("id", F.monotonically_increasing_id()), "ngram-classes")

    def needed(self, a: str, b: str):
        """Least overlap of a linked pair: ceil(num * (a + b) / (num + den))."""
        return F.expr(f"({self.num}L * ({a} + {b}) + {self.num + self.den - 1}) div {self.num + self.den}")

    def may_link(self, a: str, b: str):
        """Length and position bounds of two postings of one n-gram."""
        return (
            F.expr(f"{self.den}L * {a}.n >= {self.num}L * {b}.n and {self.den}L * {b}.n >= {self.num}L * {a}.n")
            & (F.expr(f"1 + least({a}.n - {a}.pos, {b}.n - {b}.pos)") >= self.needed(f"{a}.n", f"{b}.n"))
        )

    def postings(self) -> DataFrame:
        """(gram, id, n, pos) of prefix n-grams that more than one class of a size class has, position from 1."""
        rows = self.classes.select("id", "n", "homes", F.posexplode("prefix").alias("at", "gram")).select("id", "n", (F.col("at") + 1).alias("pos"), "gram", F.explode("homes").alias("home"))
        rows = rows.select(F.xxhash64("gram", "home").alias("gram"), "id", "n", "pos").repartition("gram")
        hubs = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("df"), F.min(F.struct("pos", "n", "id")).alias("hub")).where("df > 1").drop("df")
        return stage(rows.join(hubs, "gram"), "ngram-postings")

    def star_pairs(self, postings: DataFrame) -> DataFrame:
        """Each n-gram's most central class (fewest rarer n-grams) against its other classes."""
        both = postings.select(F.col("id").alias("b"), F.col("hub.id").alias("a"), F.struct("n", "pos").alias("x"), F.struct("hub.n", "hub.pos").alias("y"))
        near = both.where(F.col("a") != F.col("b")).where(self.may_link("x", "y"))
        return near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def cross_pairs(self, postings: DataFrame, roots: DataFrame) -> DataFrame:
        """All candidate pairs whose classes are in different components so far."""
        rows = postings.drop("hub").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
        several = rows.groupBy("gram").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("gram")
        rows = stage(rows.join(several, "gram"), "ngram-several")
        x = rows.select("gram", F.col("root").alias("r"), F.col("id").alias("a"), F.struct("n", "pos").alias("x"))
        y = rows.select("gram", F.col("root").alias("s"), F.col("id").alias("b"), F.struct("n", "pos").alias("y"))
        pairs = x.join(y, "gram").where(F.col("r") < F.col("s")).where(self.may_link("x", "y"))
        return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def bounded(self, pairs: DataFrame) -> DataFrame:
        """Keep pairs whose counts per fragment leave room for the overlap."""
        side = self.classes.select("id", "n", "cells")
        a = side.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("cells").alias("ca"))
        b = side.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("cells").alias("cb"))
        rows = pairs.join(a, "a").join(b, "b")
        room = F.aggregate(F.zip_with("ca", "cb", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
        return rows.where(room >= self.needed("na", "nb")).select("a", "b", "na", "nb")

    def verified(self, pairs: DataFrame, name: str) -> DataFrame:
        """Partial overlaps counted per fragment and summed per pair; the links that reach the threshold."""
        pairs = stage(self.bounded(pairs), f"ngram-{name}-pairs")
        degree = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(GROUP_SETS))).cast("int").alias("salts"))
        members = pairs.select("a", F.col("b").alias("id")).join(degree, "a").select("a", "id", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int").alias("salt"))
        heads = degree.select("a", F.col("a").alias("id"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
        wanted = members.unionByName(heads).join(self.classes.select("id", "fp"), "id")
        # a class has a group for each of its prefix n-grams at most, and one for every GROUP_SETS partners of its own
        targets = wanted.groupBy("fp").agg(F.collect_list(F.struct("a", "salt", "id")).alias("targets"), F.count(F.lit(1)).alias("groups"))
        texts = self.sets.where("n > 0 and doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("doc_id")).join(targets, "fp")
        texts = stage(texts, f"ngram-{name}-texts")
        few = (texts.agg(F.sum("groups")).first()[0] or 0) <= self.broadcast_rows
        texts = texts.select("doc_id", "fp", "targets")
        texts = self.docs.join(F.broadcast(texts) if few else texts, "doc_id").select("text", "fp", "targets")
        cut = texts.mapInArrow(_segments(self.width, self.pivots, self.ranks), "a long, fragment int, salt int, id long, grams array<long>")
        keys = ["a", "fragment", "salt"]
        sent = cut.repartition(*keys).sortWithinPartitions(*keys, F.col("id") != F.col("a"), "id")
        total = sent.mapInArrow(_overlaps, "a long, b long, part long").groupBy("a", "b").agg(F.sum("part").alias("overlap"))
        linked = F.expr(f"{self.den}L * overlap >= {self.num}L * (na + nb - overlap)")
        return stage(total.join(pairs, ["a", "b"]).where(linked).select(F.col("a").alias("u"), F.col("b").alias("v")), f"ngram-{name}-links")

    def roots(self, links: DataFrame) -> DataFrame:
        nodes = links.select(F.explode(F.array("u", "v")).alias("id")).distinct()
        return stage(connected_components(nodes, links).select("id", F.col("component").alias("root")), "ngram-roots")

    def components(self) -> DataFrame:
        """(doc_id, n_shingles, component_id), a row per input row."""
        postings = self.postings()
        links = self.verified(self.star_pairs(postings), "star")
        roots = self.roots(links)
        rest = self.verified(self.cross_pairs(postings, roots), "cross")
        if rest.head(1):
            roots = self.roots(links.unionByName(rest))
        lows = self.sets.where("n > 0").groupBy("fp").agg(F.min("doc_id").alias("low")).join(self.classes.select("fp", "id"), "fp")
        joined = lows.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
        lowest = joined.groupBy("root").agg(F.min("low").alias("component_id"))
        known = joined.join(lowest, "root").select("fp", "component_id")
        own = F.when(F.col("n") == 0, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component_id"))
        return self.sets.join(known, "fp", "left").select("doc_id", F.col("n").cast("long").alias("n_shingles"), own.alias("component_id"))


def ngram_components(docs: DataFrame, **options) -> DataFrame:
    """Components of the n-gram Jaccard join; see :class:`NgramJoin`."""
    return NgramJoin(docs, **options).components()


def keep_one(docs: DataFrame, broadcast_rows: int = 2_000_000, **options) -> DataFrame:
    """``docs`` with its own columns, and of each component the rows of its smallest id only.

    Equal rows under one id are one document. Rows without id, words or text stay.
    """
    found = stage(ngram_components(docs, **options), "ngram-components")
    gone = stage(found.where("doc_id is not null and component_id <> doc_id").select("doc_id").distinct(), "ngram-gone")
    kept = docs.join(F.broadcast(gone) if gone.count() <= broadcast_rows else gone, "doc_id", "left_anti").select(*docs.columns)
    again = docs.where("doc_id is not null and text is not null").groupBy("doc_id", F.xxhash64("text")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not again.head(1):
        return kept
    whole = F.col("doc_id").isNotNull() & F.col("text").isNotNull()
    return kept.where(whole).dropDuplicates(["doc_id", "text"]).unionByName(kept.where(~whole))


# Fixed value: the white space that separates words.
_SPACE = r"[^\x20\x09-\x0D]+"
SQL = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SPACE}') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)]) END AS s FROM words
), grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), rare AS (SELECT g FROM grams GROUP BY g HAVING count(*) > 1
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS i
  FROM (SELECT * FROM grams SEMI JOIN rare USING (g)) x JOIN (SELECT * FROM grams SEMI JOIN rare USING (g)) y ON x.g = y.g AND x.doc_id <> y.doc_id
    AND 100 * x.n >= 90 * y.n AND 100 * y.n >= 90 * x.n
  GROUP BY x.doc_id, y.doc_id
), links AS (SELECT a, b FROM shared WHERE 100 * i >= 90 * (na + nb - i)
), reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(min(r.b), s.doc_id)) AS component_id
FROM sets s LEFT JOIN reach r ON s.doc_id = r.a GROUP BY s.doc_id, s.s
"""


@query("op6_ngram_jaccard", SQL)
def op6(spark, folder):
    return ngram_components(table(spark, folder, "documents", "doc_id", "text"))
