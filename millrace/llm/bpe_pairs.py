"""BPE with a merge list: an index from each pair to all its positions in a lot of words, rank by rank."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.bpe import splitter
from millrace.llm.common import lots, query, table

LOT_BYTES = 8 << 20


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 as it is, the rest from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Merges by rank, the bytes of each id, and the special tokens of a tokenizer file; its size is the file's.

    ``keys`` holds left * size + right of every merge in order, ``ranks`` the rank beside it.
    Raises ValueError for files that do more than byte-level BPE with plain special tokens, and for
    merge lists in which a merge comes before one that makes a part of it: ranks could then not
    be applied in ascending order.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, added = file["model"], file.get("added_tokens") or []
        pre, off = file.get("pre_tokenizer") or {}, ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        odd = [t for t in added if t["lstrip"] or t["rstrip"] or t["single_word"]]
        if file.get("normalizer") or model["type"] != "BPE" or any(model.get(k) for k in off) or odd or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError(f"{path} asks for more than byte-level BPE with plain special tokens")
        letters, vocab = byte_letters(), model["vocab"]
        self.special = {t["content"]: t["id"] for t in added}
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.byte_ids = np.array([vocab.get(c, -1) for c, _ in sorted(letters.items(), key=lambda x: x[1])], np.int32)
        if (self.byte_ids < 0).any():
            raise ValueError(f"{path} has no token for some byte")
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        made = {}
        for rank, (a, b) in enumerate(pairs):
            if any(len(x) > 1 and made.get(x, rank) >= rank for x in (a, b)) or a + b in made:
                raise ValueError(f"{path}: merge {rank} comes before one of its parts, or makes a token anew")
            made[a + b] = rank
        self.left, self.right = (np.array([vocab[p[i]] for p in pairs], np.int32) for i in (0, 1))
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        keys = self.left.astype(np.int64) * self.size + self.right
        self.ranks = np.argsort(keys)
        self.keys = keys[self.ranks]
        texts = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        listed = [self._bytes(texts.get(i, ""), letters) for i in range(self.size)]
        self.sizes = np.array([len(b) for b in listed], np.int64)
        self.blob, self.starts = np.frombuffer(b"".join(listed), np.uint8), np.cumsum(self.sizes) - self.sizes

    @staticmethod
    def _bytes(token: str, letters) -> bytes:
        return bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where the list has no such merge."""
        keys = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], -1)

    def decoded(self, ids: np.ndarray, step: int = 500_000) -> str:
        """Each id joined with its bytes, a bounded lot at a time; bytes that are no UTF-8 become U+FFFD."""
        out = []
        for i in range(0, len(ids), step):
            some = ids[i : i + step]
            size = self.sizes[some]
            ends = np.cumsum(size)
            out.append(self.blob[np.repeat(self.starts[some] - (ends - size), size) + np.arange(ends[-1])].tobytes())
        return b"".join(out).decode("utf-8", "replace")


class PairIndex:
    """The words of a lot as one array of linked symbols, with the positions of every pair that has a rank."""

    def __init__(self, words: list[bytes], vocab: Vocabulary):
        self.vocab, sizes = vocab, np.array([len(w) for w in words], np.int64)
        n = int(sizes.sum())
        self.end = n  # stands before the first and after the last symbol of a word
        self.symbols = np.append(vocab.byte_ids[np.frombuffer(b"".join(words), np.uint8)], np.int32(-1))
        self.after, self.before = np.arange(1, n + 2), np.arange(-1, n)
        ends = np.cumsum(sizes)
        full = sizes > 0
        self.after[ends[full] - 1], self.before[(ends - sizes)[full]] = n, n
        self.starts = ends - sizes
        self.places: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []
        self._add(np.flatnonzero(self.after[:n] < n))

    def _add(self, at: np.ndarray) -> None:
        """File the pairs that start at these positions under their ranks."""
        ranks = self.vocab.rank(self.symbols[at], self.symbols[self.after[at]])
        order = np.argsort(ranks, kind="stable")[np.count_nonzero(ranks < 0) :]
        at, ranks = at[order], ranks[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        for i, j in pairwise([0, *cuts.tolist(), len(at)] if len(at) else []):
            rank = int(ranks[i])
            if rank not in self.places:
                self.places[rank] = []
                heapq.heappush(self.active, rank)
            self.places[rank].append(at[i:j])

    def _merge(self, rank: int) -> None:
        vocab, symbols, after, before = self.vocab, self.symbols, self.after, self.before
        found = self.places.pop(rank)
        at = np.unique(np.concatenate(found) if len(found) > 1 else found[0])
        at = at[(symbols[at] == vocab.left[rank]) & (symbols[after[at]] == vocab.right[rank])]  # the rest has merged otherwise since
        if vocab.left[rank] == vocab.right[rank] and len(at) > 1:  # in a run of one symbol, every other position from the left
            i = np.arange(len(at))
            fresh = np.append(True, after[at[:-1]] != at[1:])
            at = at[(i - np.maximum.accumulate(np.where(fresh, i, 0))) % 2 == 0]
        if not len(at):
            return
        gone = after[at]
        beyond = after[gone]
        symbols[at], symbols[gone] = vocab.made[rank], -1
        after[at], before[beyond] = beyond, at
        prior = before[at]
        self._add(np.concatenate([prior[prior < self.end], at[beyond < self.end]]))

    def run(self) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after another, start of each word's ids and the end)."""
        while self.active:
            self._merge(heapq.heappop(self.active))
        alive = self.symbols[:-1] >= 0
        passed = np.append(0, np.cumsum(alive))
        return self.symbols[:-1][alive], np.append(passed[self.starts], passed[-1])


class _Words(dict):
    def __missing__(self, word):
        self[word] = place = len(self)
        return place


def encode_texts(texts: list, vocab: Vocabulary, split):
    """(word codes of each text, ids of all distinct words, their starts); codes beyond the words name special tokens.

    Special tokens are cut out first, the longest of those that start at one place; their codes are
    -1 - id until the words are known.
    """
    cut = re.compile("|".join(re.escape(t) for t in sorted(vocab.special, key=len, reverse=True))) if vocab.special else None
    words, coded = _Words(), []
    place = words.__getitem__
    for text in texts:
        codes, start = [], 0
        for m in cut.finditer(text) if cut else ():
            codes += map(place, split(text[start : m.start()]))
            codes.append(-1 - vocab.special[m.group()])
            start = m.end()
        rest = split(text[start:] if start else text)
        codes = np.fromiter(map(place, rest), np.int64, len(rest)) if not codes else np.array([*codes, *map(place, rest)], np.int64)
        coded.append(codes)
    ids, starts = PairIndex([w.encode() for w in words], vocab).run()
    names = np.array(sorted(vocab.special.values()), np.int32)
    for codes in coded:
        named = codes < 0
        codes[named] = len(words) + np.searchsorted(names, -1 - codes[named])
    return coded, np.append(ids, names), np.append(starts, len(ids) + 1 + np.arange(len(names)))


def _ids_of(codes: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    size = starts[codes + 1] - starts[codes]
    ends = np.cumsum(size)
    return ids[np.repeat(starts[codes] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]


def _mapped(docs: DataFrame, path: str, pattern: str, key: str, columns: str, make) -> DataFrame:
    """``make`` turns the ids of each text of a lot, one by one, into the named columns."""
    vocab = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))
    names = [c.split()[0] for c in columns.split(", ")]
    kinds = [{"ids": pa.list_(pa.int32()), "n_tokens": pa.int64()}.get(n, pa.string()) for n in names]

    def run(batches):
        split = splitter(pattern)
        for part in lots(batches, "text", LOT_BYTES):
            coded, ids, starts = encode_texts([t or "" for t in part.column("text").to_pylist()], vocab.value, split)
            rows = [make(_ids_of(codes, ids, starts), vocab.value) for codes in coded]
            made = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), *made], [key, *names])

    rows = docs.select(docs[key].alias("key"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(run, f"`{key}` {dict(docs.dtypes)[key]}, {columns}")


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """(key, ids) of every whole text, a row per input row, as the tokenizer file at ``path`` says.

    A task takes its texts in lots, splits them into words by ``pattern`` (special tokens first) and indexes
    the lot's distinct words: each pair of neighbouring symbols that has a rank is mapped to all its positions.
    The lowest active rank merges at all its positions at once, which files new pairs to the left
    and right under their own, always higher, ranks; positions that went stale are skipped when their rank comes.
    A symbol takes part in as many merges as it has bytes, so very long words cost no more than short ones.
    Nothing is shuffled, and a lost task is run again by itself.

    Defined cases: a null or empty text has no ids; null and repeated keys are carried along; other columns
    are ignored, whatever their names; an empty table gives no rows. A lot holds one text at least, however long.
    """
    return _mapped(docs, path, pattern, key, "ids array<int>", lambda ids, _: (ids,))


def decode(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """(key, decoded): the text of each list of ids, special tokens included; a null list decodes to the empty text.

    The table of token bytes is as large as the vocabulary, so each task joins it as a whole.
    """
    vocab = encoded.sparkSession.sparkContext.broadcast(Vocabulary(path))

    def run(batches):
        for batch in batches:
            rows = [vocab.value.decoded(np.array(ids or [], np.int64)) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.string())], [key, "decoded"])

    rows = encoded.select(encoded[key].alias("key"), "ids")
    return rows.mapInArrow(run, f"`{key}` {dict(encoded.dtypes)[key]}, decoded string")


def _digest(ids: np.ndarray, vocab: Vocabulary):
    listed = ",".join(map(str, ids.tolist()))
    return len(ids), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(vocab.decoded(ids).encode()).hexdigest()


def digests(docs: DataFrame, path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of :func:`encode` and :func:`decode`, made where the ids are, so that they never travel."""
    return _mapped(docs, path, pattern, key, "n_tokens long, ids_sha256 string, decoded_sha256 string", _digest)


@query("op13_pair_index")
def op13(spark, folder):
    import public_tokenizers

    return digests(table(spark, folder, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
