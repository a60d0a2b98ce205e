"""Encoding equals the public library's, and decoding gives the bytes back."""

import hashlib
import struct

import public_tokenizers
import pytest
import tiktoken

from millrace.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = bpe.token_table(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
TEXTS = [
    "", " ", "a", "It's the   end.\n\n\tWe'll see  \x0b\x1c x", "naïve café ½ª² Ünïcode \u0085end", "日本語テキスト と emoji 👩‍👩‍👧 mixed١٢٣", "x" * 3000,
    "<|endoftext|> token", "aaaaaaaaabaaaaaaaab" * 40, "\r\n 　 wide sep", "ǅ ꟊ ͸ tail   ",
]


def ids_of(text):
    split = bpe.splitter(public_tokenizers.PATTERN)
    return [i for w in split(text) for i in bpe.merge(w.encode(), RANKS)]


@pytest.mark.parametrize("text", TEXTS)
def test_words_merge_like_the_library(text):
    assert ids_of(text) == LIBRARY.encode_ordinary(text)


def test_tables_round_trip(spark, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 64)
    rows = [(i, t, "other") for i, t in enumerate(TEXTS)] + [(None, "no id", "x"), (3, "same id", "x"), (90, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    encoded = bpe.encode(docs, PATH, public_tokenizers.PATTERN)
    got = sorted((r.doc_id or -1, tuple(r.ids)) for r in encoded.collect())
    assert got == sorted((i or -1, tuple(LIBRARY.encode_ordinary(t or ""))) for i, t, _ in rows)
    back = sorted((r.doc_id or -1, bytes(r.decoded)) for r in bpe.decode(encoded, PATH).collect())
    assert back == sorted((i or -1, (t or "").encode()) for i, t, _ in rows)


def test_digests(spark):
    docs = spark.createDataFrame([(1, TEXTS[4]), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in bpe.encode_digests(docs, PATH, public_tokenizers.PATTERN).collect()}
    ids = LIBRARY.encode_ordinary(TEXTS[4])
    assert got[1].n_tokens == len(ids)
    assert got[1].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
    assert got[1].decoded_sha256 == hashlib.sha256(TEXTS[4].encode()).hexdigest()
    assert got[2].decoded_sha256 == got[2].ids_sha256 == hashlib.sha256(b"").hexdigest()


def test_slices_of_blocks(spark, monkeypatch):
    whole = bpe._reassemble
    monkeypatch.setattr(bpe, "_reassemble", lambda *a: whole(*a, slice_words=7))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    for r in bpe.encode_digests(docs, PATH, public_tokenizers.PATTERN, keep_ids=True).collect():
        ids = LIBRARY.encode_ordinary(TEXTS[r.doc_id])
        assert r.ids == ids and r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(TEXTS[r.doc_id].encode()).hexdigest()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode_digests(docs, PATH, public_tokenizers.PATTERN).count() == 0


def test_query_equals_the_library(spark):
    from millrace.llm.common import REGISTRY

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in REGISTRY["op5_bpe"].build(spark, folder).collect():
        ids = LIBRARY.encode_ordinary(texts[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
