"""Benchmark decontamination with a hash set of test windows, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import query, stage, table

# What parts words, and the letters that are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_KEY = ("doc_id", "text_key")


def words_of(text: Column) -> Column:
    """Lower-cased words; ``lower`` is the quick way where a text is ASCII throughout."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    lowered = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def _with_window_hashes(df: DataFrame, lengths: list[int]) -> DataFrame:
    """Adds ``h<L>``: the hash of the L words from each position, made from halves by doubling."""
    df = df.withColumn("g1", F.transform("words", lambda w: F.xxhash64(w)))
    made = {1}

    def make(df: DataFrame, n: int) -> DataFrame:
        if n in made:
            return df
        left = 1 << ((n - 1).bit_length() - 1)
        df = make(make(df, left), n - left)
        made.add(n)
        tail = F.slice(f"g{n - left}", left + 1, F.greatest(F.size(f"g{n - left}") - left, F.lit(0)))
        joined = F.zip_with(F.slice(f"g{left}", 1, F.size(tail)), tail, lambda a, b: F.xxhash64(a, b))
        return df.withColumn(f"g{n}", joined)

    for n in lengths:
        df = make(df, n)
    return df


def _tagged(n: int) -> Column:
    return F.transform(f"g{n}", lambda h, i: F.struct(i.alias("start"), h.alias("h"), F.lit(n).alias("length")))


class Decontaminator:
    """Finds and removes benchmark windows in documents.

    A window is ``width`` consecutive words of an item; a shorter item with words is
    one window. The hashes of all windows form a set that is broadcast when it has
    at most ``broadcast_rows`` rows and is joined by shuffle beyond. Documents are scanned as
    (position, hash) rows, so only hashes meet the set; a hit is then verified
    against the words themselves. All of it is linear in the words of the corpus.

    Defined cases: null text or item text has no words; a null ``item_id`` hits but is not listed;
    rows that repeat a ``doc_id`` are told apart by their text; equal rows
    give equal results; other columns pass through untouched or are ignored.
    """

    def __init__(self, benchmark: DataFrame, width: int = 10, broadcast_rows: int = 1_000_000):
        self.width, self.broadcast_rows = width, broadcast_rows
        items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
        length = F.least(F.size("words"), F.lit(width))
        starts = F.sequence(F.lit(1), F.size("words") - length + 1)
        windows = items.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("words", i, length))).alias("words"))
        windows = windows.distinct().withColumn("length", F.size("words"))
        self.windows = stage(windows, "bench-windows")
        self.lengths = sorted(r.length for r in self.windows.select("length").distinct().collect())
        self.small = self.windows.count() <= broadcast_rows

    def _side(self, df: DataFrame) -> DataFrame:
        return F.broadcast(df) if self.small else df

    def _set(self) -> DataFrame:
        parts = []
        for n in self.lengths:
            hashed = _with_window_hashes(self.windows.where(F.col("length") == n).select("words").distinct(), [n])
            parts.append(hashed.select(F.col(f"g{n}")[0].alias("h"), F.lit(n).alias("length")))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.distinct()

    @staticmethod
    def _keyed(docs: DataFrame) -> DataFrame:
        return docs.select("doc_id", "text").withColumn("text_key", F.xxhash64(F.coalesce("text", F.lit(""))))

    def hits(self, docs: DataFrame) -> DataFrame | None:
        """Verified occurrences: (doc_id, text_key, start, length, item_ids); start counts words from 0."""
        if not self.lengths:
            return None
        keyed = self._keyed(docs)
        scan = _with_window_hashes(keyed.select(*_KEY, words_of(F.col("text")).alias("words")), self.lengths)
        if len(self.lengths) == 1:
            rows = scan.select(*_KEY, F.posexplode_outer(f"g{self.lengths[0]}").alias("start", "h")).withColumn("length", F.lit(self.lengths[0]))
        else:
            tagged = F.concat(*[_tagged(n) for n in self.lengths])
            rows = scan.select(*_KEY, F.inline_outer(tagged))
        # The outer forms keep Spark from deriving a filter that would compute the arrays once more below.
        found = stage(rows.join(self._side(self._set()), ["h", "length"]).select(*_KEY, "start", "length").distinct(), "bench-hits")
        few = found.count() <= self.broadcast_rows // 4
        places = found.groupBy(*_KEY).agg(F.collect_list(F.struct("start", "length")).alias("places"))
        same = F.expr("d.doc_id <=> p.doc_id and d.text_key = p.text_key")
        texts = keyed.dropDuplicates(["doc_id", "text_key"]) if not few else keyed
        joined = texts.alias("d").join((F.broadcast(places) if few else places).alias("p"), same).select("d.doc_id", "d.text_key", "d.text", "p.places")
        spelled = joined.select(*_KEY, "places", words_of(F.col("text")).alias("words"))
        seen = spelled.select(*_KEY, F.inline_outer(F.transform("places", lambda p: F.struct(p.start.alias("start"), p.length.alias("length"), F.slice("words", p.start + 1, p.length).alias("words")))))
        owners = self.windows.groupBy("words", "length").agg(F.collect_set("item_id").alias("item_ids"))
        return stage(seen.join(self._side(owners), ["words", "length"]).select(*_KEY, "start", "length", "item_ids").distinct(), "bench-verified")

    def report(self, docs: DataFrame) -> DataFrame:
        """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) per input row."""
        keyed = self._keyed(docs).select(*_KEY, F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
        nothing = F.sha2(F.lit("").cast("binary"), 256)
        hits = self.hits(docs)
        if hits is None:
            zero = F.lit(0).cast("long")
            return keyed.select("doc_id", "n_words", zero.alias("n_hit"), zero.alias("n_items"), nothing.alias("items_sha256"), F.lit(False).alias("contaminated"))
        spans = hits.select(*_KEY, F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("at")).distinct().groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n_hit"))
        items = hits.select(*_KEY, F.explode("item_ids").alias("item")).distinct().groupBy(*_KEY).agg(F.array_sort(F.collect_list("item")).alias("items"))
        found = spans.alias("s").join(items.alias("i"), F.expr("s.doc_id <=> i.doc_id and s.text_key = i.text_key"), "left").select("s.doc_id", "s.text_key", "s.n_hit", "i.items")
        out = keyed.alias("d").join(found.alias("f"), F.expr("d.doc_id <=> f.doc_id and d.text_key = f.text_key"), "left")
        items = F.coalesce("f.items", F.array().cast("array<string>"))
        return out.select(
            "d.doc_id",
            "d.n_words",
            F.coalesce("f.n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.size(items).cast("long").alias("n_items"),
            F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
            F.col("f.n_hit").isNotNull().alias("contaminated"),
        )

    def clean(self, docs: DataFrame, spans: bool = False) -> DataFrame:
        """``docs`` with its own columns, without the documents that hold a window, or without the hit words.

        A removed word takes the separators after it along.
        """
        hits = self.hits(docs)
        if hits is None:
            return docs
        same = F.expr("d.doc_id <=> h.doc_id and xxhash64(coalesce(d.text, '')) = h.text_key")
        if not spans:
            gone = stage(hits.select(*_KEY).distinct(), "bench-gone")
            return docs.alias("d").join((F.broadcast(gone) if gone.count() <= self.broadcast_rows else gone).alias("h"), same, "left_anti").select(*docs.columns)
        gone = hits.select(*_KEY, F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("at")).groupBy(*_KEY).agg(F.collect_set("at").alias("gone"))
        gap = r"\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F"  # the separators of a text that is not lower-cased
        pieces = F.expr(f"regexp_extract_all(d.text, '[^{gap}]+[{gap}]*', 0)")
        head = F.expr(f"regexp_extract(d.text, '^[{gap}]*', 0)")
        kept = F.filter(pieces, lambda w, i: ~F.array_contains(F.col("h.gone"), i))
        text = F.when(F.col("h.gone").isNull(), F.col("d.text")).otherwise(F.concat(head, F.array_join(kept, "")))
        return docs.alias("d").join(gone.alias("h"), same, "left").select(*[text.alias(c) if c == "text" else F.col(f"d.`{c}`") for c in docs.columns])


SQL = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{SEPARATORS.replace("[", "[^", 1)}') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{SEPARATORS.replace("[", "[^", 1)}') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, n, g FROM (
    SELECT item_id, least(10, len(w)) AS n, unnest([array_to_string(w[i:i + least(10, len(w)) - 1], ' ') FOR i IN range(1, len(w) - least(10, len(w)) + 2)]) AS g
    FROM b WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw))
), hits AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, g)
), spans AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), items AS (SELECT doc_id, list_sort(list_distinct(list(CAST(item_id AS VARCHAR)))) AS l FROM hits GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(len(l), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(l, ','), '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN spans USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op7_decontamination", SQL)
def op7(spark, folder):
    return Decontaminator(table(spark, folder, "benchmark", "item_id", "text")).report(table(spark, folder, "documents", "doc_id", "text"))
