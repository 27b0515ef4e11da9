"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlens.llm import (
    bpe,
    hard_negatives,
    html_extract,
    language_id,
    mixing,
    neighbours,
    ngram_join,
    packing,
    prefix_trie,
    quality,
    suffix_dedup,
    toxicity,
    warc,
)

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op8_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality.quality_scores(docs, quality.trusted_documents(docs, table(spark, sf_dir, "labels")))


@query
def op2_ngram_jaccard_join(spark, sf_dir):
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"))


@query
def op6_suffix_array_dedup(spark, sf_dir):
    return suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"))


@query
def op4_source_mixing(spark, sf_dir):
    return mixing.mix_by_source(table(spark, sf_dir, "documents"))


ORACLES["op4_source_mixing"] = mixing.ORACLE_SQL


@query
def op3_bpe_encoding(spark, sf_dir):
    return bpe.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op1_toxicity(spark, sf_dir):
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_warc_revisits(spark, sf_dir):
    return warc.archived_pages(table(spark, sf_dir, "pages"))


ORACLES["op7_warc_revisits"] = warc.ORACLE_SQL


@query
def op9_html_extraction(spark, sf_dir):
    return html_extract.extracted(table(spark, sf_dir, "pages"))


@query
def op10_language_id(spark, sf_dir):
    return language_id.languages(table(spark, sf_dir, "documents"))


@query
def op5_nearest_neighbours(spark, sf_dir):
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(100)) == 0)


@query
def op12_hard_negatives(spark, sf_dir):
    marked = F.col("vec_id") % 7 == 0
    label = F.when(marked, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


ORACLES["op12_hard_negatives"] = hard_negatives.ORACLE_SQL


@query
def op13_best_fit_packing(spark, sf_dir):
    ranks, special = public_tokenizers.path("byte_bpe_50k.tiktoken"), {"<|endoftext|>": 50256}
    return packing.packed(packing.pieces(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, special))


@query
def op11_conversation_trie(spark, sf_dir):
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


ORACLES["op11_conversation_trie"] = prefix_trie.ORACLE_SQL
