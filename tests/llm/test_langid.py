"""Filters hold what was put in, and held-out documents get their language."""

import numpy as np
import pyarrow as pa

from millrace.llm import langid


def test_filters_have_no_false_negatives():
    texts = ["abcd efgh", "ijkl mnop qrst", "abcd uvwx"]
    with np.errstate(over="ignore"):
        filters = langid.build_filters(texts, ["x", "y", "z"], least=1)
        for i, t in enumerate(texts):
            data, offsets = langid._lowered(pa.array([t]))
            total, counts = langid.popcounts(filters, data, offsets)
            assert counts[0, i] >= total[0] - 1e-6
    assert filters.masks.shape[1] == 1


def test_more_languages_than_one_mask_holds():
    names = [f"l{i:03d}" for i in range(70)]
    texts = [f"{chr(0x400 + i)}{chr(0x480 + i)} {chr(0x500 + i)}" * 3 for i in range(70)]
    with np.errstate(over="ignore"):
        filters = langid.build_filters(texts, names)
    assert filters.masks.shape[1] == 2
    found, _ = langid._predict(filters, pa.array(texts))
    assert (found == np.array(names, object)).mean() > 0.95


def test_held_out_accuracy(spark):
    from millrace.llm.common import REGISTRY

    folder = "/root/testdata/sf0.01"
    found = REGISTRY["op10_language_bloom"].build(spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id")
    n, right = found.where("held_out").selectExpr("count(*)", "count_if(lang = lang_pred)").first()
    assert n > 200 and right >= 0.98 * n


def test_edge_rows(spark):
    learn = spark.createDataFrame([(i, "the quick brown fox and the dog", "en") for i in range(9)] + [(10 + i, "der schnelle braune fuchs und der hund", "de") for i in range(9)] + [(99, None, "fr"), (98, "x", None)], "doc_id long, text string, lang string")
    filters = langid.fit(learn)
    rows = [(1, "the fox"), (2, "der hund"), (3, None), (4, ""), (5, "123 !!"), (None, "und der braune"), (1, "the fox"), (6, "the quick " * 30_000)]
    df = spark.createDataFrame([(i, t, "zz", 9.0) for i, t in rows], "doc_id long, text string, lang_pred string, score double").repartition(3)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(df, filters).collect()}
    assert {k: v[0] for k, v in got.items()} == {1: "en", 2: "de", 3: "und", 4: "und", 5: "und", None: "de", 6: "en"}
    assert all(0 <= v[1] <= 1 for v in got.values())
    assert sorted(str(r.doc_id) for r in langid.reject(df, filters).collect()) == sorted(["1", "1", "2", "None", "6"])


def test_nothing_learned(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    filters = langid.fit(none)
    assert [r.lang_pred for r in langid.identify(spark.createDataFrame([(1, "words")], "doc_id long, text string"), filters).collect()] == ["und"]
    assert langid.identify(none, filters).count() == 0


def test_reject_follows_the_members(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    filters = langid.fit(docs)
    strange = [(9001, "zzqxj wqpzk vvxxq"), (9002, "漢字のテキストです、長い文"), (9003, "ωραία μέρα σήμερα παιδιά " * 50), (9004, "12 34"), (9005, "a.")]
    more = docs.select("doc_id", "text", "lang").unionByName(spark.createDataFrame([(i, t, None) for i, t in strange], "doc_id long, text string, lang string"))
    kept = {r.doc_id for r in langid.reject(more, filters).collect()}
    assert len(filters.languages) == 4 and docs.select("lang").distinct().count() == 4
    assert kept == {r.doc_id for r in docs.collect()} | {9005}


def test_reject_keeps_texts_where_nothing_was_learned(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, None, None), (3, "12", None)], "doc_id long, text string, lang string")
    assert [r.doc_id for r in langid.reject(docs, langid.fit(docs)).collect()] == [1]
