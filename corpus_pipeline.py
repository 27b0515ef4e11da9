"""Pipeline over ``documents``: quality rules, near-duplicate join, repeated passages, mixing, tokens.

Every stage takes the columns of documents, handles nulls, empty texts, repeated rows and empty
tables as its operator defines, and all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers

from auditlens.llm import bpe, mixing, ngram_join, quality, suffix_dedup
from auditlens.llm.packed import stored
from auditlens.llm.queries import table


def quality_stage(spark, docs, sf_dir):
    """Documents that the quality rules keep."""
    return quality.quality_filter(docs, quality.trusted_documents(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark, docs, sf_dir):
    """One document of each group of near duplicates."""
    return ngram_join.one_of_each_group(docs)


def passage_stage(spark, docs, sf_dir):
    """Documents without the passages that repeat, their n_chars following the text."""
    return suffix_dedup.without_passages(docs)


def mixing_stage(spark, docs, sf_dir):
    """Documents as the mix takes them: left out, once, or repeated."""
    return mixing.mixed_documents(docs)


def token_stage(spark, docs, sf_dir):
    """Token counts and digests of ids and decoded text."""
    return bpe.encoded(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeated_passages", passage_stage),
    ("source_mixing", mixing_stage),
    ("bpe_tokens", token_stage),
]
#: Hashed n-gram verdicts and merges by rank have no SQL form; tests hold them against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
