"""Sharding by sampled splitters, with DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import query, stage, table

# A group of equal texts is kept in one shard up to this share of a shard: 1 / 200.
GROUP_SHARE = 200


def _bounds_at_or_below(bounds: list[tuple[str, int | None]], key: Column) -> Column:
    """Number of sorted boundaries at or below ``key``, by a search of two levels."""
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))

    def literal(part):
        return F.array(*[F.struct(F.lit(k).alias("key"), F.lit(d).cast("long").alias("doc_id")) for k, d in part])

    tops = literal(bounds[::step])
    blocks = F.array(*[literal(bounds[i : i + step]) for i in range(0, len(bounds), step)])
    top = F.size(F.filter(tops, lambda s: s <= key))
    inside = F.size(F.filter(F.element_at(blocks, top), lambda s: s <= key))
    return F.when(top == 0, F.lit(0)).otherwise((top - 1) * step + inside)


def _ranged(rows: DataFrame, bounds) -> DataFrame:
    return rows.withColumn("range", _bounds_at_or_below(bounds, F.struct("key", "doc_id")))


def _pick(rows: DataFrame, rate: float, seed: int) -> list:
    """Keys drawn with a chance in proportion to their weight, the same ones on every run."""
    unit = F.pmod(F.xxhash64("key", "doc_id", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.where(unit < F.col("weight") * rate).select("key", "doc_id", F.greatest("weight", F.lit(1.0 / rate)).alias("weight")).collect()


def _quantiles(sample: list, parts: int, heavy: set[str]) -> set:
    """Weighted quantiles of a sample as boundaries; only a heavy key is cut inside its group."""
    sample = sorted(sample, key=lambda r: (r.key, r.doc_id is not None, r.doc_id or 0))
    total, passed, found = sum(r.weight for r in sample), 0.0, set()
    for r in sample:
        before, passed = passed, passed + r.weight
        if int(before * parts / total) < int(passed * parts / total):
            found.add((r.key, r.doc_id if r.key in heavy else None))
    return found


def shard_table(docs: DataFrame, shards: int = 8, ranges: int = 256, rows_per_range: int = 250_000, sample_per_range: int = 16, seed: int = 7) -> DataFrame:
    """Shards of near equal bytes: (doc_id, size, text_crc32, law, shard, slot, grown_shard).

    Records are ordered by (md5 of the text, doc_id), which puts equal texts side by
    side. A sample weighted by size (and by a like share of rows, so that tiny
    records spread too) gives quantile boundaries; exact totals then show
    overfull ranges, which are subdivided with a denser sample of their own, a
    hot text by ``doc_id``. Prefix sums over the ranges and running sums inside them give
    each record its byte offset, and the offset its shard, so the result does not depend on
    the sample. Equal texts share a shard while they weigh under 1/200 of it; a heavier
    group is cut record by record.

    The sample is bounded by ``sample_per_range`` keys a range. Defined cases: a null
    text is an empty one (size 1); null ``doc_id`` comes first; repeated rows
    take slots of their own; an empty table gives an empty result; other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = stage(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.md5(F.encode(text, "UTF-8")).alias("key"),
        ),
        "shard-rows",
    )
    count, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    parts = max(ranges, -(-count // rows_per_range))
    weighted = rows.withColumn("weight", F.col("size") / F.lit(2.0 * max(1, total)) + F.lit(0.5 / max(1, count)))
    limit = total / (shards * GROUP_SHARE)

    # Keys that weigh too much for one range; a share of 1/parts bounds their number.
    drawn = _pick(weighted, sample_per_range * parts, seed)
    repeated = {k for k, n in _times(drawn).items() if n > 1}
    sizes = weighted.where(F.col("key").isin(list(repeated))).groupBy("key").agg(F.sum("weight").alias("w")).where(F.col("w") > 0.5 / parts)
    heavy = {r.key for r in sizes.collect()} if repeated else set()
    bounds = _quantiles(drawn, parts, heavy) if drawn else set()
    bounds |= {(k, None) for k in heavy}
    full = _overfull(weighted, bounds, parts)
    while full:
        ordered = _ordered(bounds)
        inside = _ranged(weighted, ordered).where(F.col("range").isin(list(full)))
        dense = _pick(inside.drop("range"), sample_per_range * parts * 8, seed + len(bounds))
        cut = bounds | _quantiles(dense, parts * 4 * max(1, len(full)), heavy) if dense else bounds
        if cut == bounds:  # what is left is one record, or records without any difference
            break
        bounds = cut
        full = _overfull(weighted, bounds, parts)

    ranged = _ranged(rows, _ordered(bounds))
    totals = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    base = totals.select("range", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("byte0"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("row0"))
    line = Window.partitionBy("range").orderBy("key", "doc_id")
    placed = ranged.join(F.broadcast(base), "range").select(
        "doc_id",
        "size",
        "text_crc32",
        "key",
        (F.col("byte0") + F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("at"),
        (F.col("row0") + F.row_number().over(line) - 1).alias("nth"),
        "range",
    )
    group = Window.partitionBy("range", "key")
    placed = stage(placed.withColumns({"start": F.min("at").over(group), "bytes": F.sum("size").over(group)}).drop("range"), "shard-placed")
    if heavy:  # their groups may lie in several ranges
        whole = placed.where(F.col("key").isin(list(heavy))).groupBy("key").agg(F.min("at").alias("start0"), F.sum("size").alias("bytes0"))
        placed = placed.join(F.broadcast(whole), "key", "left").withColumns({"start": F.coalesce("start0", "start"), "bytes": F.coalesce("bytes0", "bytes")})
    middle = F.when(F.col("bytes") <= limit, 2 * F.col("start") + F.col("bytes")).otherwise(2 * F.col("at") + F.col("size"))
    sharded = placed.select("doc_id", "size", "text_crc32", "nth", F.expr("0").alias("zero"), (middle * shards).alias("m"))
    sharded = sharded.withColumn("shard", F.expr(f"cast(m div {2 * max(1, total)}L as int)")).drop("m", "zero")
    firsts = sharded.groupBy("shard").agg(F.min("nth").alias("first"))
    return sharded.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("nth") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def _times(sample) -> dict[str, int]:
    found: dict[str, int] = {}
    for r in sample:
        found[r.key] = found.get(r.key, 0) + 1
    return found


def _ordered(bounds) -> list:
    return sorted(bounds, key=lambda b: (b[0], b[1] is not None, b[1] or 0))


def _overfull(weighted: DataFrame, bounds, parts: int) -> set[int]:
    """Ranges of several records that weigh over twice the mean."""
    totals = _ranged(weighted, _ordered(bounds)).groupBy("range").agg(F.sum("weight").alias("w"), F.count(F.lit(1)).alias("n"))
    return {r.range for r in totals.where((F.col("w") > 2.0 / parts) & (F.col("n") > 1)).select("range").collect()}


def write_shards(docs: DataFrame, assigned: DataFrame, path: str) -> None:
    """Write the records of ``docs`` into one folder per shard, in slot order within each file."""
    rows = docs.join(assigned.select("doc_id", "shard", "slot"), "doc_id")
    spread = F.floor(F.col("slot") / 1_000_000)
    rows.repartition("shard", spread).sortWithinPartitions("shard", "slot").drop("slot").write.partitionBy("shard").parquet(path)


def _crc_table() -> list[int]:
    rows = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ 0xEDB88320 if c & 1 else c >> 1
        rows.append(c)
    return rows


SQL = f"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size, md5(coalesce(text, '')) AS key FROM documents
), crc(tbl) AS (SELECT {_crc_table()}::BIGINT[]
), bytes AS (
  SELECT key, any_value(hex(encode(t))) AS h FROM base GROUP BY key
), sums AS (
  SELECT key, xor(4294967295::BIGINT, list_reduce(
    list_prepend(4294967295::BIGINT, [CAST('0x' || h[2 * i + 1:2 * i + 2] AS BIGINT) FOR i IN range(len(h) // 2)]),
    lambda a, b: xor(a >> 8, tbl[1 + (xor(a, b) & 255)]))) AS text_crc32 FROM bytes, crc
), placed AS (
  SELECT *, sum(size) OVER w - size AS pos, row_number() OVER w - 1 AS nth, sum(size) OVER () AS total, sum(size) OVER (PARTITION BY key) AS gbytes
  FROM base WINDOW w AS (ORDER BY key, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING)
), starts AS (SELECT *, min(pos) OVER (PARTITION BY key) AS gstart FROM placed
), sharded AS (
  SELECT *, CAST(8 * (CASE WHEN gbytes <= total / 1600 THEN 2 * gstart + gbytes ELSE 2 * pos + size END) // (2 * total) AS INTEGER) AS shard FROM starts
)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, shard,
  CAST(nth - min(nth) OVER (PARTITION BY shard) AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM sharded JOIN sums USING (key)
"""


@query("op3_sampled_splitters", SQL)
def op3(spark, folder):
    return shard_table(table(spark, folder, "documents", "doc_id", "text"))
