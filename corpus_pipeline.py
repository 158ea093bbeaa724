"""The corpus pipeline: quality, near-duplicates, decontamination, mixing, token files.

Each stage gets what the one before kept, written as Parquet and read again, so a lost executor
costs at most the running stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from postmill.llm.common import table
from postmill.llm.decontaminate import without_leaks
from postmill.llm.mixing import mixed_documents
from postmill.llm.quality_rules import keep_good
from postmill.llm.shingle_join import one_of_each
from postmill.llm.token_files import encode_corpus
from postmill.session import stage

VOCABULARY = "byte_bpe_50k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_corpus(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_files", token_files),
]

ORACLE_SQL = None  # SQL can express neither the n-gram scores nor the vocabulary's merges


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
