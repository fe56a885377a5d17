"""A training corpus from ``documents``: each stage takes what the one before kept, written as Parquet and read again.

``language_id`` drops texts without a letter and those that the network takes for none of the labelled languages; ``ngram_jaccard_join`` keeps one document of each class
of near copies (five-word shingles, 80 %); ``benchmark_decontamination`` drops documents that share a window of ten
words with a benchmark item; ``bpe_encoding`` returns the token ids of what is left.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from orderlens.llm import bpe, decontamination, jaccard, language
from orderlens.llm.common import table
from orderlens.session import shared_path

BPE_FILE = "word_bpe_49k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network, fitted to the labelled ones among them, knows."""
    return language.keep_determined(docs, language.fit(docs, reject=True))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, the smallest doc_id."""
    return jaccard.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with the benchmark."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and token ids of every document."""
    return bpe.encode_documents(docs, public_tokenizers.path(BPE_FILE)).select("doc_id", "n_tokens", "ids")


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_encoding", bpe_encoding),
]

ORACLE_SQL = None  # neither the network nor the encoding is SQL; tests/llm compares with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents``; the stages before write to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    *before, (_, last) = STAGES
    for name, stage in before:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return last(spark, docs, sf_dir)
