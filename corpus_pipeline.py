"""The corpus pipeline: documents in, token ids out.

Every stage works on all that its predecessor kept, and all but the last return the columns of ``documents``:
toxic documents go, one document of each group of near copies stays, documents that overlap the benchmark go, personal data
is replaced by its kind, and what is left is encoded.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from creditloom.llm import bpe, jaccard, pii, seeds, toxicity
from creditloom.session import materialise


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, _table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each_group(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return seeds.without_benchmark(docs, _table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers) and the digests of ids and decoded text."""
    return bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)


STAGES = [("toxicity", drop_toxic), ("ngram_jaccard", drop_near_copies), ("decontamination", drop_benchmark),
          ("pii", redact_personal_data), ("bpe", encode)]

#: SQL can express neither the compression model nor the span classifier; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
