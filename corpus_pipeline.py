"""From raw documents to token ids: quality, duplicates, repeats, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the next one
reads it back from Parquet.  All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from grainline.llm import bpe, mixing, probminhash, quality, substring
from grainline.llm.common import read, shared_folder
from grainline.llm.queries import tokenizer_definition


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio."""
    trusted = quality.trusted_documents(read(spark, sf_dir, "labels"))
    return quality.kept_documents(docs, trusted)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near-duplicates."""
    return probminhash.deduplicated_documents(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of windows that an earlier document has."""
    return substring.deduplicated_documents(docs)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the temperature mixture of their sources draws them."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each document's ids, and of the text they decode to."""
    return bpe.encode(docs, tokenizer_definition())


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("source mixture", source_mixture),
    ("token ids", token_ids),
]

#: Likelihood ratios, minwise hashing, mixing by hash and token ids are beyond
#: SQL; the tests hold run() against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
