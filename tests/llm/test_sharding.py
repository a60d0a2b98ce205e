"""Shards of near equal bytes against a plain computation, also with a hot text and tiny rows."""

import hashlib
import zlib

import pytest

from millrace.llm import sharding


def plain(rows, shards=8):
    texts = [(i, t or "") for i, t in rows]
    sizes = {}
    for _, t in texts:
        sizes[t] = sizes.get(t, 0) + len(t.encode()) + 1
    total = sum(sizes.values())
    at, starts, out, firsts = 0, {}, [], {}
    for n, (i, t) in enumerate(sorted(texts, key=lambda r: (hashlib.md5(r[1].encode()).hexdigest(), r[0] is not None, r[0] or 0))):
        size = len(t.encode()) + 1
        start = starts.setdefault(t, at)
        middle = 2 * start + sizes[t] if sizes[t] <= total / (shards * 200) else 2 * at + size
        shard = middle * shards // (2 * total)
        out.append((i, size, zlib.crc32(t.encode()), shard, n - firsts.setdefault(shard, n)))
        at += size
    return sorted(out, key=str)


CASES = {
    "mixed": [(i, "wörd " * (i % 90)) for i in range(400)] + [(900 + i, "hot text") for i in range(200)] + [(None, "no id"), (7, None), (8, "")],
    "repeats": [(1, "same"), (1, "same"), (1, None), (1, None)],
    "one": [(5, "x" * 10_000)],
    "empties": [(i, "") for i in range(300)] + [(1000, "long " * 3000)],
}


@pytest.mark.parametrize("case", CASES)
def test_equals_plain(spark, case):
    rows = CASES[case]
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, key string, size int").repartition(3)
    got = sharding.shard_table(df, ranges=16)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert sorted(((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in got.collect()), key=str) == plain(rows)


def test_empty_table(spark):
    assert sharding.shard_table(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_written_shards(spark, tmp_path):
    df = spark.range(100).selectExpr("id AS doc_id", "repeat('a', cast(id as int)) AS text")
    sharding.write_shards(df, sharding.shard_table(df), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 100 and back.select("shard").distinct().count() == 8
