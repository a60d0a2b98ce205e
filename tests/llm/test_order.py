"""The permutation is one, records come back from their slots, and a second run writes the same bytes."""

import numpy as np
import pytest

from millrace.llm import order


@pytest.mark.parametrize("size", [1, 2, 3, 17, 1000, 4097])
def test_permutation(size):
    with np.errstate(over="ignore"):
        slots = order.feistel(np.arange(size), size, 7)
        other = order.feistel(np.arange(size), size, 8)
    assert sorted(slots) == list(range(size))
    assert size < 100 or (slots != other).mean() > 0.9


def test_records_round_trip(spark, tmp_path):
    texts = {i: ("ab" * (i * 7 % 300)).encode() for i in range(60)} | {100: None, 101: b""}
    df = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, ids binary, slot int")
    df.repartition(4).write.parquet(str(tmp_path / "docs"))
    df = spark.read.parquet(str(tmp_path / "docs"))  # the input must give the same partitions twice
    folder = str(tmp_path / "shards")
    rows = order.materialise(df, folder, ids=62, shard_bytes=640).collect()
    pieces = {(i, n): (t or b"")[n * 62 : n * 62 + 62] for i, t in texts.items() for n in range(-(-len(t or b"") // 62))}
    assert sorted(r.slot for r in rows) == list(range(len(pieces)))
    records = list(order.read_slots(folder, 0, len(rows)))
    assert {(r.doc_id, r.part): records[r.slot] for r in rows} == pieces
    assert list(order.read_slots(folder, 7, 25)) == records[7:32]  # starts and ends inside shards
    assert all(r.offset == (r.slot % 10) * 64 and r.shard == r.slot // 10 for r in rows)
    before = {p.name: p.read_bytes() for p in (tmp_path / "shards").iterdir() if p.suffix == ".bin"}
    order.materialise(df, folder, ids=62, shard_bytes=640).collect()
    assert before == {p.name: p.read_bytes() for p in (tmp_path / "shards").iterdir() if p.suffix == ".bin"}


def test_repeated_and_missing_ids(spark, tmp_path):
    df = spark.createDataFrame([(1, b"x"), (1, b"x"), (None, b"y")], "doc_id long, ids binary")
    assert sorted((r.doc_id or 0) for r in order.materialise(df, str(tmp_path / "s")).collect()) == [0, 1, 1]


def test_empty_table(spark, tmp_path):
    assert order.materialise(spark.createDataFrame([], "doc_id long, ids binary"), str(tmp_path / "s")).count() == 0


def test_a_changing_input_is_refused(spark, tmp_path):
    from pyspark.sql import functions as F

    df = spark.range(50).select(F.col("id").alias("doc_id"), F.encode(F.rand().cast("string"), "UTF-8").alias("ids"))
    order.materialise(df, str(tmp_path / "same")).count()  # a seeded plan is the same twice
    shuffled = df.repartition(5)
    try:
        rows = order.materialise(shuffled, str(tmp_path / "other")).collect()
    except Exception as e:
        assert "other documents" in str(e)
    else:
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
