"""Each stage against its restatement, on the small tables with planted cases."""

import random

import pytest
import tiktoken
from test_decontaminate import brute as leaks
from test_ngram_join import brute as groups

import corpus_pipeline
from millrace.llm import bpe, langid, toxicity

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_stages_in_order():
    names = [f.__name__ for _, f in corpus_pipeline.STAGES]
    assert names == ["reject_toxic", "reject_unknown_language", "keep_one_of_near_copies", "drop_contaminated", "encode"]


def test_toxicity_follows_the_scores(spark, docs):
    labels, learn = spark.read.parquet(f"{FOLDER}/labels.parquet"), langid.held_out(3) != 1
    model = toxicity.fit(docs.where(learn), labels.where(learn))
    want = {r.doc_id for r in toxicity.score(docs, model).collect() if not r.predicted}
    kept = corpus_pipeline.reject_toxic(spark, docs, FOLDER)
    assert kept.schema == docs.schema and {r.doc_id for r in kept.collect()} == want


def test_language_keeps_all_with_letters(spark, docs):
    more = docs.unionByName(spark.createDataFrame([(9001, "12 34", None, "s", 5), (9002, None, "en", "s", 0)], docs.schema))
    kept = corpus_pipeline.reject_unknown_language(spark, more, FOLDER)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in docs.collect())


def test_one_of_each_group(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = {low for _, _, low in groups(rows, 5, 80, 100)}
    kept = corpus_pipeline.keep_one_of_near_copies(spark, docs, FOLDER)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == want


def test_near_copies_with_some_words_edited_go(spark, docs):
    rng, rows = random.Random(5), []
    for base in range(6):
        words = [f"w{rng.randrange(5000)}" for _ in range(100 if base < 3 else 300)]
        for edits in (0, 1, 2, 3):
            copy = list(words)
            for at in rng.sample(range(len(copy)), edits * len(copy) // 100):
                copy[at] = f"x{rng.randrange(5000)}"
            rows.append((len(rows), " ".join(copy), "en", "s", 0))
    want = {low for _, _, low in groups([r[:2] for r in rows], 5, 80, 100)}
    assert want < {low for _, _, low in groups([r[:2] for r in rows], 3, 90, 100)}
    kept = corpus_pipeline.keep_one_of_near_copies(spark, spark.createDataFrame(rows, docs.schema), FOLDER)
    assert {r.doc_id for r in kept.collect()} == want


def test_leaks_go(spark, docs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    want = {r[0] for r in leaks([(r.doc_id, r.text) for r in docs.collect()], items) if not r[5]}
    kept = corpus_pipeline.drop_contaminated(spark, docs, FOLDER)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == want


def test_whole_run(spark, docs):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.token_table(path), special_tokens={})
    texts = {r.doc_id: r.text for r in docs.collect()}
    done = corpus_pipeline.run(spark, FOLDER).collect()
    assert 0 < len(done) < len(texts)
    assert all(list(r.ids) == library.encode_ordinary(texts[r.doc_id]) for r in done)
