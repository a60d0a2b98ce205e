"""Byte-level BPE by a global shuffle of distinct words, and decoding by the token-byte table."""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import DataFrame

from millrace.llm.common import lots, query, table

BLOCK_BYTES = 16 << 20


def token_table(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a rank file; the vocabulary's size bounds it."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def splitter(pattern: str):
    """``findall`` for the pre-token pattern.

    Texts below U+0250 take the standard library's engine with the three classes
    spelled out from the same character tables; others take the full engine.
    """
    full = regex.compile(pattern).findall
    known = [chr(i) for i in range(0x250)]
    sets = {name: "".join(re.escape(c) for c in known if regex.match(cls, c)) for name, cls in (("L", r"\p{L}"), ("N", r"\p{N}"), ("s", r"\s"))}
    plain = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{sets['s']}{sets['L']}{sets['N']}]")
    plain = plain.replace(r"\p{L}", f"[{sets['L']}]").replace(r"\p{N}", f"[{sets['N']}]").replace(r"\S", f"[^{sets['s']}]").replace(r"\s", f"[{sets['s']}]")
    if "\\p" in plain:
        return full
    quick, beyond = re.compile(plain).findall, re.compile("[^\x00-ɏ]").search
    return lambda text: full(text) if beyond(text) else quick(text)


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one pre-token: the lowest-ranked neighbouring pair merges first, the left one of equals.

    A heap over linked neighbours, so a word of n bytes costs n log n.
    """
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    n = len(word)
    parts: list = [word[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, size = heapq.heappop(heap)
        j = after[i] if parts[i] is not None else n
        if j >= n or len(parts[i]) + len(parts[j]) != size:
            continue
        parts[i] += parts[j]
        parts[j] = None
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
            both = parts[i] + parts[after[i]]
            if (r := ranks.get(both)) is not None:
                heapq.heappush(heap, (r, i, len(both)))
        if before[i] >= 0:
            both = parts[before[i]] + parts[i]
            if (r := ranks.get(both)) is not None:
                heapq.heappush(heap, (r, before[i], len(both)))
    return [ranks[p] for p in parts if p is not None]


class _Index(dict):
    def __missing__(self, word):
        self[word] = place = len(self)
        return place


def _blocks(batches, pattern: str):
    """(block id, first column's values, token counts, codes, words) for each block of texts.

    The id is a digest of the block's keys and texts, so the two scans that make words
    and layouts must agree on it or nothing matches.
    """
    split = splitter(pattern)
    for part in lots(batches, "text", BLOCK_BYTES):
        index, codes, counts, seal = _Index(), [], [], hashlib.blake2b(digest_size=8)
        seal.update(repr(part.column(0).to_pylist()).encode())
        place = index.__getitem__
        for text in (t.as_py() for t in part.column("text")):
            found = split(text or "")
            counts.append(len(found))
            codes.append(np.fromiter(map(place, found), np.uint32, len(found)))
            seal.update((text or "").encode())
        codes = np.concatenate(codes)
        yield int.from_bytes(seal.digest(), "little", signed=True), part.column(0), counts, codes, index
        del part, index, codes, place


def _words(pattern: str):
    def run(batches):
        for block, _, _, _, index in _blocks(batches, pattern):
            words = list(index)
            for i in range(0, len(words), 50_000):
                some = pa.array(words[i : i + 50_000])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), block)), pa.array(np.arange(i, i + len(some)), pa.int32()), some], ["block", "place", "word"])

    return run


def _pack(*columns: np.ndarray) -> bytes:
    """Unsigned numbers as compressed byte planes (equal bytes of all numbers together)."""
    planes = [np.ascontiguousarray(c.astype(np.uint32).view(np.uint8).reshape(-1, 4).T).tobytes() for c in columns]
    return zstandard.compress(b"".join(planes), 3)


def _unpack(packed: bytes, *sizes: int) -> list[np.ndarray]:
    raw, at, out = zstandard.decompress(packed), 0, []
    for n in sizes:
        planes = np.frombuffer(raw, np.uint8, 4 * n, at).reshape(4, n)
        out.append(np.ascontiguousarray(planes.T).view(np.int32).reshape(-1))
        at += 4 * n
    return out


def _layouts(pattern: str):
    def run(batches):
        for block, keys, counts, codes, _ in _blocks(batches, pattern):
            row = [pa.array([block]), pa.array([keys.to_pylist()], pa.list_(keys.type)), pa.array([counts], pa.list_(pa.int32())), pa.array([_pack(codes)], pa.binary())]
            yield pa.RecordBatch.from_arrays(row, ["block", "keys", "counts", "codes"])

    return run


def _encode_sorted(ranks_of, flush: int = 400_000):
    """Rows sorted by word: each distinct word is encoded at its first row only.

    Ids go back as one row per block for every ``flush`` words: places in the block, sizes, ids.
    """

    def send(blocks, places, lists):
        block, place = np.concatenate(blocks), np.concatenate(places)
        ids = pa.concat_arrays(lists)
        offsets = ids.offsets.to_numpy().astype(np.int64)
        order = np.lexsort((place, block))
        block, place, sizes = block[order], place[order], np.diff(offsets)[order]
        flat = ids.values.to_numpy()[_gather(offsets[:-1], np.diff(offsets), order)]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        cuts = np.flatnonzero(np.diff(block, prepend=block[0] - 1, append=block[-1] + 1))
        rows = [(block[i], j - i, ends[j] - ends[i], _pack(place[i:j], sizes[i:j], flat[ends[i] : ends[j]])) for i, j in pairwise(cuts)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)], ["block", "n", "m", "packed"])

    def run(batches):
        ranks, last, ids, held = ranks_of.value, None, [], 0
        blocks, places, lists = [], [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            coded = batch.column("word").dictionary_encode()
            made = []
            for word in coded.dictionary.to_pylist():
                if word != last:
                    last, ids = word, merge(word.encode(), ranks)
                made.append(ids)
            blocks.append(batch.column("block").to_numpy())
            places.append(batch.column("place").to_numpy())
            lists.append(pa.array(made, pa.list_(pa.int32())).take(coded.indices))
            held += batch.num_rows
            if held >= flush:
                yield send(blocks, places, lists)
                blocks, places, lists, held = [], [], [], 0
        if held:
            yield send(blocks, places, lists)

    return run


def _gather(starts: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Indices that copy the runs (start, size) of each code one after another."""
    size = sizes[codes]
    ends = np.cumsum(size)
    return np.repeat(starts[codes] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def _reassemble(lookup, ids_too: bool, sums_too: bool, slice_words: int = 500_000):
    """Blocks back to texts, a bounded slice of words at a time; digests are made here, so that ids need not travel for them."""

    def run(words: pa.Table, layout: pa.Table) -> pa.Table:
        if layout.num_rows == 0:
            raise ValueError("the texts changed between two scans")
        parts = [_unpack(p, n, n, m) for n, m, p in zip(*(words.column(c).to_pylist() for c in ("n", "m", "packed")), strict=True)]
        place, sizes, flat = (np.concatenate([p[i] for p in parts] or [np.zeros(0, np.int32)]) for i in range(3))
        del parts
        starts = np.cumsum(sizes, dtype=np.int64) - sizes
        _, order = np.unique(place, return_index=True)  # equal blocks of repeated rows share their words
        starts, sizes = starts[order], sizes[order]
        kind, made = layout.schema.field("keys").type.value_type, []
        for keys, counts, packed in zip(*(layout.column(c).to_pylist() for c in ("keys", "counts", "codes")), strict=True):
            (codes,) = _unpack(packed, sum(counts))
            ends = np.cumsum([0, *counts])
            first = 0
            while first < len(counts):
                last = max(first + 1, int(np.searchsorted(ends, ends[first] + slice_words, side="right")) - 1)
                some = codes[ends[first] : ends[last]]
                ids = _gathered(flat, starts, sizes, some, slice_words)
                cuts = np.append(0, np.cumsum(sizes[some], dtype=np.int64))[ends[first : last + 1] - ends[first]]
                made.append(_row_columns(pa.array(keys[first:last], kind), ids, cuts, lookup, ids_too, sums_too))
                first = last
        return pa.Table.from_batches(made) if made else pa.Table.from_batches([_row_columns(pa.array([], kind), np.zeros(0, np.int32), np.zeros(1, np.int64), lookup, ids_too, sums_too)])

    return run


def _gathered(flat, starts, sizes, codes, step: int) -> np.ndarray:
    """The ids of the words in order; one very long text is gathered in pieces as well."""
    pieces = [flat[_gather(starts, sizes, codes[i : i + step])] for i in range(0, len(codes), step)]
    return np.concatenate(pieces) if pieces else np.zeros(0, np.int32)


def _row_columns(keys, ids: np.ndarray, cuts: np.ndarray, lookup, ids_too: bool, sums_too: bool) -> pa.RecordBatch:
    columns = {"key": keys}
    if sums_too:
        rows = [ids[i:j] for i, j in pairwise(cuts.tolist())]
        columns["n_tokens"] = pa.array(np.diff(cuts), pa.int64())
        columns["ids_sha256"] = pa.array([hashlib.sha256(r.astype("<u4").tobytes()).hexdigest() for r in rows], pa.string())
        columns["decoded_sha256"] = pa.array([hashlib.sha256(_decoded(r, lookup.value)).hexdigest() for r in rows], pa.string())
    if ids_too:
        columns["ids"] = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids))
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _encoded(docs: DataFrame, path: str, pattern: str, key: str, ids_too: bool, sums_too: bool) -> DataFrame:
    spark = docs.sparkSession
    ranks, lookup = spark.sparkContext.broadcast(token_table(path)), spark.sparkContext.broadcast(_token_bytes(path))
    kind = dict(docs.dtypes)[key]
    rows = docs.select(key, docs["text"].cast("string").alias("text"))
    words = rows.mapInArrow(_words(pattern), "block long, place int, word string").repartition("word").sortWithinPartitions("word")
    coded = words.mapInArrow(_encode_sorted(ranks), "block long, n int, m int, packed binary")
    layouts = rows.mapInArrow(_layouts(pattern), f"block long, keys array<{kind}>, counts array<int>, codes binary")
    schema = f"key {kind}" + ", n_tokens long, ids_sha256 string, decoded_sha256 string" * sums_too + ", ids array<int>" * ids_too
    joined = coded.groupBy("block").cogroup(layouts.groupBy("block")).applyInArrow(_reassemble(lookup, ids_too, sums_too), schema)
    return joined.withColumnRenamed("key", key)


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """Token ids of every whole text: (key, ids), a row per input row.

    Texts are cut into pre-tokens in blocks. A block sends each distinct word once, by a
    shuffle on the word, where equal words meet and are merged once; ids return to
    (block, place in the block), where the block's positions put them in
    order. A word can repeat only once a block, so common words are no hot keys. Positions
    travel as numbers, texts never do.

    ``docs`` is read twice and must give the same rows in the same batches both times, as a scan does; else it raises.
    Defined cases: a null or empty text has no ids; a null or repeated key is
    carried along, as rows are never joined by it; other columns are ignored.
    """
    return _encoded(docs, path, pattern, key, True, False)


def encode_digests(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256), and the ids if asked for, of :func:`encode` and :func:`decode`.

    Ids are decoded and digested in the task that puts them in order.
    """
    return _encoded(docs, path, pattern, key, keep_ids, True)


def _token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token-byte table as one blob with a start and size per id."""
    by_id = {i: b for b, i in token_table(path).items()}
    listed = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
    sizes = np.array([len(b) for b in listed], np.int64)
    return np.frombuffer(b"".join(listed), np.uint8), np.cumsum(sizes) - sizes, sizes


def _decoded(ids: np.ndarray, lookup, step: int = 500_000) -> bytes:
    """Join each id of a row with its bytes, a bounded lot of ids at a time."""
    blob, starts, sizes = lookup
    return b"".join(blob[_gather(starts, sizes, ids[i : i + step])].tobytes() for i in range(0, len(ids), step))


def _rows_of(ids: pa.ListArray):
    flat = ids.values.to_numpy()
    for a, b in pairwise(ids.offsets.to_numpy()):
        yield flat[a:b]


def _whole(ids: pa.Array) -> pa.ListArray:
    return pc.fill_null(ids, pa.scalar([], ids.type))


def decode(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """(key, decoded binary): every id joined with its row of the token-byte table, in order.

    The table has a row per vocabulary entry, so each task holds it whole (a map-side join). A null list decodes to no bytes.
    """
    lookup = encoded.sparkSession.sparkContext.broadcast(_token_bytes(path))

    def run(batches):
        for batch in batches:
            rows = [_decoded(r, lookup.value) for r in _rows_of(_whole(batch.column("ids")))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], [key, "decoded"])

    return encoded.select(key, "ids").mapInArrow(run, f"{key} {dict(encoded.dtypes)[key]}, decoded binary")


@query("op5_bpe")
def op5(spark, folder):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return encode_digests(table(spark, folder, "documents", "doc_id", "text"), path, public_tokenizers.PATTERN)
