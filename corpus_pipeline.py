"""Corpus pipeline: from documents to token ids in five stages.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns the
columns of ``docs`` (the last one returns ids and digests). Stages are written as
Parquet and read again in between, so each recovers on its own.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, langid, toxicity
from millrace.llm.common import small_batches, stage, table
from millrace.llm.decontaminate import Decontaminator
from millrace.llm.ngram_join import keep_one


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold; the network learns from two thirds of the labels."""
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    learn = langid.held_out(3) != 1
    return toxicity.reject(docs, toxicity.fit(docs.where(learn), labels.where(learn)))


def reject_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language; the filters learn from three quarters of the documents."""
    small_batches(spark)
    return langid.reject(docs, langid.fit(docs.where(F.col("doc_id").isNotNull() & (langid.held_out(4) != 2))))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the Jaccard join on shingles of five words, from 0.8 on."""
    small_batches(spark)
    return keep_one(docs, width=5, num=80, den=100)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    return Decontaminator(table(spark, sf_dir, "benchmark", "item_id", "text")).clean(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document with the digests of the ids and of the decoded bytes."""
    small_batches(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_digests(docs, path, public_tokenizers.PATTERN, keep_ids=True)


STAGES = [
    ("toxicity", reject_toxic),
    ("language", reject_unknown_language),
    ("near copies", keep_one_of_near_copies),
    ("decontamination", drop_contaminated),
    ("encoding", encode),
]

# Learned models and byte-pair merges have no SQL; tests/llm/test_pipeline.py restates the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; all but the last are written as Parquet on the way."""
    docs = table(spark, sf_dir, "documents")
    for n, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{name.replace(' ', '-')}")
    return docs
