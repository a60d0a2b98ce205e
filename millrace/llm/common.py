"""Registry, shared folder, and the vectorised word splitter of the text operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array
from pyspark.sql import DataFrame, SparkSession

from millrace.session import cut_lineage, stage  # noqa: F401


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(spark, folder)`` and, where SQL can say it, its DuckDB statement."""

    def register(build):
        REGISTRY[name] = Query(name, build, sql)
        return build

    return register


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    small_batches(spark)
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def small_batches(spark: SparkSession) -> None:
    """Rows of texts go to Python in small batches, which bounds what Arrow holds in a task."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach: ``spark.checkpoint.dir``, a temporary one only in local sessions."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        cut_lineage(spark.range(1))  # chooses the session's own folder once, and refuses on a cluster
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def give_back() -> None:
    """Return what this process has freed to the system; else a fit on the driver holds its peak for the rest of the session."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's; other C libraries go without
    if trim:
        trim(0)


def fmix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values (public splitmix constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Lower-case A-Z and split on ASCII white space: (offsets per text, word codes, distinct words).

    Nulls count as empty texts. One pass in Arrow, no Python object per word.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    words = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    offsets = offsets - offsets[0]
    full = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    if not full.all():
        before = np.concatenate([[0], np.cumsum(full)])
        offsets, words = before[offsets], words.filter(pa.array(full))
    coded = words.dictionary_encode()
    return offsets, coded.indices.to_numpy().astype(np.int64), coded.dictionary


def word_hashes(words: pa.Array) -> np.ndarray:
    """Keyed 64-bit hash per word, the same in every process."""
    return hash_array(words.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def lots(batches, column: str, limit: int):
    """Record batches of about ``limit`` bytes of ``column`` (one row at least), across the batches that come in.

    Ranges are copied, since Arrow's string kernels misread sliced offsets, and memory that a
    lot has freed goes back to the system before the next one.
    """
    held, size = [], 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total, start = np.cumsum(sizes, dtype=np.int64), 0
        while start < len(sizes):
            done = total[start - 1] if start else 0
            end = min(len(sizes), max(start + 1, int(np.searchsorted(total, done + limit - size, side="right"))))
            if held and total[end - 1] - done + size > limit:
                yield _joined(held)
                pa.default_memory_pool().release_unused()
                held, size = [], 0
                continue
            held.append(batch.take(pa.array(np.arange(start, end))))
            size += int(total[end - 1] - done)
            start = end
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return held[0] if len(held) == 1 else pa.concat_batches(held)
