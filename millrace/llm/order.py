"""Training-order materialisation: a keyed permutation gives each token sequence a slot in fixed-stride shards."""

from __future__ import annotations

import json
import zlib
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fmix, lots, query, shared_folder, table

BLOCK_BYTES = 8 << 20
HEADER = 2  # bytes before the ids: how many ids are real


def feistel(index: np.ndarray, size: int, key: int, rounds: int = 6) -> np.ndarray:
    """Keyed bijection of 0 .. size-1: a balanced Feistel network on the next even power of two, walked until it lands inside."""
    half = np.uint64(max(1, ((max(2, size) - 1).bit_length() + 1) // 2))
    low = np.uint64((1 << int(half)) - 1)
    keys = fmix(np.uint64(key) + np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def once(x):
        left, right = x >> half, x & low
        for k in keys:
            left, right = right, left ^ (fmix(right ^ k) & low)
        return (left << half) | right

    out = once(index.astype(np.uint64))
    while (far := out >= np.uint64(size)).any():
        out[far] = once(out[far])
    return out.astype(np.int64)


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if urlparse(uri).scheme else f"file://{uri}")


_RECORD = ("slot", "doc_id", "part", "n_tokens", "record")


def _sequences(bases, marks, size, key, ids, kind, shard_records):
    """Cuts each document's ids into sequences, numbers them within the partition, and packs them by shard."""

    def run(batches):
        me = TaskContext.get().partitionId()
        place, seal = bases.get(me, 0), 0
        for part in lots(batches, "ids", BLOCK_BYTES):
            keys, parts, lengths, records = [], [], [], []
            for doc, raw in zip(part.column(0).to_pylist(), part.column("ids").to_pylist(), strict=True):
                raw = raw or b""
                seal = (seal + zlib.crc32(raw)) & 0xFFFFFFFF
                for n, i in enumerate(range(0, len(raw), ids)):
                    piece = raw[i : i + ids]
                    keys.append(doc)
                    parts.append(n)
                    lengths.append(len(piece))
                    records.append(piece)
            with np.errstate(over="ignore"):
                slots = feistel(np.arange(place, place + len(keys)), size, key)
            place += len(keys)
            made = pa.RecordBatch.from_arrays([pa.array(slots), pa.array(keys, kind), pa.array(parts, pa.int32()), pa.array(lengths, pa.int32()), pa.array(records, pa.binary())], names=_RECORD)
            shards = slots // shard_records
            turn = np.argsort(shards, kind="stable")
            cuts = np.flatnonzero(np.diff(shards[turn])) + 1
            groups = np.split(turn, cuts) if len(turn) else []
            packed = [_packed(made.take(pa.array(lot))) for lot in groups]
            yield pa.RecordBatch.from_arrays([pa.array([int(shards[lot[0]]) for lot in groups], pa.int32()), pa.array(packed, pa.binary())], ["shard", "packed"])
        if seal != marks.get(me, 0):
            raise ValueError("a partition gave other documents than when they were counted")

    return run


def _packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _write(folder: str, shard_records: int, total: int, stride: int):
    """Writes one shard: its records in slot order, in a file that takes its name when it is whole.

    A lost task leaves only a file under its attempt's name, and writing again gives the same bytes.
    """

    def run(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        rows = pa.concat_tables([pa.ipc.open_stream(p).read_all() for p in group.column("packed").to_pylist()])
        slots = rows.column("slot").to_numpy()
        turn = np.argsort(slots)
        rows, slots = rows.take(pa.array(turn)), slots[turn]
        if len(slots) != min(shard_records, total - shard * shard_records) or (np.diff(slots) != 1).any():
            raise ValueError(f"shard {shard} has {len(slots)} records, or not those of its slots")
        files, base = _filesystem(folder)
        attempt, sums = TaskContext.get().taskAttemptId(), []
        with files.open_output_stream(f"{base}/.{shard:08d}-{attempt}", buffer_size=1 << 20) as out:
            for n, raw in zip(rows.column("n_tokens").to_pylist(), rows.column("record").to_pylist(), strict=True):
                record = n.to_bytes(HEADER, "little") + raw.ljust(stride - HEADER, b"\0")
                out.write(record)
                sums.append(zlib.crc32(record))
        files.move(f"{base}/.{shard:08d}-{attempt}", f"{base}/{shard:08d}.bin")
        columns = {
            "slot": slots, "shard": np.full(len(slots), shard, np.int32), "offset": (slots - shard * shard_records) * stride,
            "doc_id": rows.column("doc_id"), "part": rows.column("part"), "n_tokens": rows.column("n_tokens"), "record_crc32": pa.array(sums, pa.int64()),
        }
        return pa.table(columns)

    return run


def materialise(docs: DataFrame, folder: str, ids: int = 510, shard_bytes: int = 16 << 20, key: int = 7) -> DataFrame:
    """Write every sequence of ``docs`` to its slot; (slot, shard, offset, doc_id, part, n_tokens, record_crc32) per sequence.

    ``docs`` has ``doc_id`` and ``ids``, the token ids of a document as bytes (one byte per id; wider ids as
    several bytes, with ``ids`` a multiple of their width). A document is cut into sequences of ``ids`` bytes; a record is their
    number as two bytes, the ids, and zeros up to the stride. Sequences are numbered over the partitions of the input, a keyed Feistel
    permutation with cycle-walking turns numbers into slots 0 .. N-1, and slot ranges of equal
    length are the shards, each one file of records in slot order. Slot s is at byte (s mod R) * stride
    of file s div R, so reading can start and resume anywhere.

    The frame writes when an action runs it; an action that runs it again writes the same bytes again. The input
    must give the same partitions twice (a table scan does); a difference is found and raised.

    Defined cases: null or empty ``ids`` have no sequence; null or repeated ids of documents are
    carried along; an empty table writes no shard; other columns are ignored.
    """
    stride = ids + HEADER
    rows = docs.select("doc_id", F.col("ids").cast("binary").alias("ids"))
    size = F.coalesce(F.octet_length("ids"), F.lit(0))
    counts = rows.groupBy(F.spark_partition_id().alias("at")).agg(F.sum(F.ceil(size / ids)).alias("n"), F.pmod(F.sum(F.crc32(F.coalesce("ids", F.lit(b"")))), F.lit(1 << 32)).alias("seal")).orderBy("at").collect()  # one row per input partition
    bases, total = {}, 0
    for r in counts:
        bases[r["at"]] = total
        total += r["n"]
    marks = {r["at"]: r["seal"] for r in counts}
    records = max(1, shard_bytes // stride)
    shards = -(-total // records)
    files, base = _filesystem(folder)
    files.create_dir(base, recursive=True)
    with files.open_output_stream(f"{base}/layout.json") as f:
        f.write(json.dumps({"records": total, "stride": stride, "header": HEADER, "shard_records": records, "shards": shards, "key": key}).encode())
    kind = dict(docs.dtypes)["doc_id"]
    arrow_kind = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    made = rows.mapInArrow(_sequences(bases, marks, total, key, ids, arrow_kind, records), "shard int, packed binary")
    schema = f"slot long, shard int, offset long, doc_id {kind}, part int, n_tokens int, record_crc32 long"
    return made.groupBy("shard").applyInArrow(_write(folder, records, total, stride), schema)


def read_slots(folder: str, start: int, count: int):
    """Token ids (as bytes) of ``count`` slots from ``start`` on: one seek per shard, then sequential."""
    files, base = _filesystem(folder)
    with files.open_input_file(f"{base}/layout.json") as f:
        layout = json.loads(f.read())
    stride, per = layout["stride"], layout["shard_records"]
    end = min(start + count, layout["records"])
    while start < end:
        shard = start // per
        stop = min(end, (shard + 1) * per)
        with files.open_input_file(f"{base}/{shard:08d}.bin") as f:
            f.seek((start - shard * per) * stride)
            for _ in range(start, stop):
                record = f.read(stride)
                yield record[HEADER : HEADER + int.from_bytes(record[:HEADER], "little")]
        start = stop


@query("op4_training_order")
def op4(spark, folder):
    """UTF-8 bytes are the token ids: the whole byte vocabulary, one byte each."""
    import uuid

    docs = table(spark, folder, "documents", "doc_id", "text").select("doc_id", F.encode("text", "UTF-8").alias("ids"))
    return materialise(docs, f"{shared_folder(spark)}/{spark.sparkContext.applicationId}-order-{uuid.uuid4().hex[:12]}")
