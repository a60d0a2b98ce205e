"""Words as ASCII white space parts them, and lots of bounded bytes across batches."""

import pyarrow as pa
import pytest

from millrace.llm.common import lots, split_words, word_hashes


def batches(texts, size):
    return [pa.RecordBatch.from_arrays([pa.array(texts[i : i + size], pa.string())], ["text"]) for i in range(0, len(texts), size)]


@pytest.mark.parametrize("size", [1, 3, 100])
@pytest.mark.parametrize("limit", [1, 10, 50, 10_000])
def test_lots_keep_all_rows_in_order(size, limit):
    texts = ["abc", None, "", "é" * 30, "x" * 200, "tail", "y" * 9] * 3
    out = [b.column("text").to_pylist() for b in lots(batches(texts, size), "text", limit)]
    assert sum(out, []) == texts
    for lot in out:
        assert len(lot) == 1 or sum(len((t or "").encode()) for t in lot) <= limit


def test_no_rows():
    assert list(lots([], "text", 10)) == [] and list(lots(batches([], 5), "text", 10)) == []


def test_words():
    texts = ["  Ab c\x0bd\n", None, "", " ", "É x\x1cy\x85z AB"]
    offsets, codes, words = split_words(pa.array(texts))
    found = [[words[int(c)].as_py() for c in codes[a:b]] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    assert found == [[w.decode() for w in "".join(c.lower() if c.isascii() else c for c in t or "").encode().split()] for t in texts]
    assert len(set(word_hashes(words))) == len(words)
