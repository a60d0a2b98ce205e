"""The pair index equals the public library, special tokens and odd texts included, and decodes back."""

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import bpe_pairs

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
VOCAB = bpe_pairs.Vocabulary(PATH)
LIBRARY = Tokenizer.from_file(PATH)
TEXTS = [
    "", " ", "a", "<|endoftext|>", "x<|endoftext|>y <|endoftext|><|endoftext|> <|endoftext", "aaaaaaa aaaa aaa", "abababababa" * 30, "x" * 5001,
    "It's the   end.\n\n\tWe'll see  \x0b\x1c\x85 x", "naïve café ½ª² Ünïcode", "日本語テキスト と emoji 👩‍👩‍👧 mixed١٢٣", " 　 wide sep\r\n", "\x00\x7f�",
]


def ids_of(texts):
    coded, ids, starts = bpe_pairs.encode_texts(texts, VOCAB, bpe_pairs.splitter(PATTERN))
    return [bpe_pairs._ids_of(c, ids, starts).tolist() for c in coded]


def want(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_one_lot_equals_the_library():
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choice(["a", "b", " ", "é", "'s", "\n", "1", "٢", "<|endoftext|>", "the", "ing"]) for _ in range(rng.randint(0, 80))) for _ in range(300)]
    got = ids_of(texts)
    assert got == [want(t) for t in texts]
    assert [VOCAB.decoded(np.array(i, np.int64)) for i in got] == [LIBRARY.decode(i, skip_special_tokens=False) for i in got] == texts


def test_lots_without_words():
    assert ids_of([]) == [] and ids_of(["", ""]) == [[], []] and ids_of(["<|endoftext|>"]) == [[50256]]


def test_torn_bytes_decode_like_the_library():
    ids = want("é日👩")
    for part in (ids[:1], ids[1:], ids[::-1], [50256, *ids[2:4]]):
        assert VOCAB.decoded(np.array(part, np.int64)) == LIBRARY.decode(part, skip_special_tokens=False)


def test_tables(spark, monkeypatch):
    monkeypatch.setattr(bpe_pairs, "LOT_BYTES", 64)
    rows = [(i, t, "other") for i, t in enumerate(TEXTS)] + [(None, "no id", "x"), (3, "same id", "x"), (90, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    encoded = bpe_pairs.encode(docs, PATH, PATTERN)
    assert sorted((r.doc_id or -1, tuple(r.ids)) for r in encoded.collect()) == sorted((i or -1, tuple(want(t))) for i, t, _ in rows)
    back = sorted((r.doc_id or -1, r.decoded) for r in bpe_pairs.decode(encoded, PATH).collect())
    assert back == sorted((i or -1, t or "") for i, t, _ in rows)
    assert bpe_pairs.digests(docs.limit(0), PATH, PATTERN).count() == 0


def test_files_that_ask_for_more_are_refused(tmp_path):
    with open(PATH, encoding="utf-8") as f:
        file = json.load(f)
    merges = file["model"]["merges"]
    for change in ({"normalizer": {"type": "NFC"}}, {"model": {**file["model"], "merges": merges[::-1]}}):
        (tmp_path / "t.json").write_text(json.dumps({**file, **change}), encoding="utf-8")
        with pytest.raises(ValueError):
            bpe_pairs.Vocabulary(str(tmp_path / "t.json"))


def test_query_equals_the_library(spark):
    from millrace.llm.common import REGISTRY

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = REGISTRY["op13_pair_index"].build(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = want(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()
