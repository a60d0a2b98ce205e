"""All queries of this folder; importing it fills the registry."""

from millrace.llm import bpe, bpe_pairs, collocations, decontaminate, dialogue, langid, lm_score, ngram_join, order, pivots, sharding, template, toxicity  # noqa: F401
from millrace.llm.common import REGISTRY


def queries():
    return {name: q.build for name, q in REGISTRY.items()}


def oracle_sql():
    return {name: q.sql for name, q in REGISTRY.items() if q.sql is not None}
