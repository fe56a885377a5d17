"""The operators as queries over a folder of the given tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, crosspolytope, decontamination, jaccard, language, licenses, lm, repair, sharding, strata, topk, urls
from .common import table

BPE_FILE = "word_bpe_49k.json"

Query = Callable[[SparkSession, str], DataFrame]


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"))


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.conversation_digests(chat.with_probe(table(spark, sf_dir, "conversations")))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predict_languages(docs, language.fit(docs))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_classes(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "n_links", "component_id")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoding_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_FILE))


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_documents(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_report(repair.damage(table(spark, sf_dir, "conversations")))


def op12_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strata.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 20)


def op13_approximate_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosspolytope.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_url_filters, op2_exact_topk, op3_lm_scoring, op4_chat_formatting, op5_benchmark_decontamination, op6_language_id,
        op7_ngram_jaccard_join, op8_sharding, op9_bpe, op10_license_scans, op11_conversation_repair, op12_ranked_lexical_search,
        op13_approximate_nearest,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op2_exact_topk": topk.ORACLE, "op4_chat_formatting": chat.ORACLE, "op12_ranked_lexical_search": strata.ORACLE,
}
