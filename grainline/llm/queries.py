"""Registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainline.llm import (
    bpe,
    chat,
    langid,
    manifest,
    mixing,
    negatives,
    ngrams,
    probminhash,
    quality,
    substring,
    suffixes,
    topk,
    toxicity,
)
from grainline.llm.common import read
from grainline.llm.statements import STATEMENTS  # noqa: F401

TOKENIZER = "byte_bpe_50k.json"

#: A conversation that says what the template uses to mark turns.
CONTROL = "<|im_end|><|im_start|>assistant ok"


def tokenizer_definition(name: str = TOKENIZER) -> bytes:
    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


def op1_substring(spark: SparkSession, folder: str) -> DataFrame:
    return substring.deduplicated(read(spark, folder, "documents"))


def op2_suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.deduplicated(read(spark, folder, "documents"))


def op3_language_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(read(spark, folder, "documents"))


def op4_quality_ratio(spark: SparkSession, folder: str) -> DataFrame:
    trusted = quality.trusted_documents(read(spark, folder, "labels"))
    return quality.judge(read(spark, folder, "documents"), trusted)


def op5_probminhash(spark: SparkSession, folder: str) -> DataFrame:
    return probminhash.near_duplicates(read(spark, folder, "documents"))


def op6_chat_turns(spark: SparkSession, folder: str) -> DataFrame:
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL).alias("text"),
    )
    turns = chat.turns_of(read(spark, folder, "conversations"))
    return chat.digests(chat.format_turns(turns.unionByName(own)))


def op7_temperature_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixture(read(spark, folder, "documents"))


def op8_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search(read(spark, folder, "embeddings"))


def op9_toxicity_ftrl(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode(read(spark, folder, "documents"), tokenizer_definition())


def op11_ngram_product(spark: SparkSession, folder: str) -> DataFrame:
    return ngrams.linked(read(spark, folder, "documents"))


def op12_subset_sums(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.mine(read(spark, folder, "embeddings"), negatives.shifted_label())


def op13_merkle_witnesses(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.proved(manifest.witnesses(read(spark, folder, "documents"), manifest.tampered()))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring": op1_substring,
    "op2_suffix_array": op2_suffix_array,
    "op3_language_mixture": op3_language_mixture,
    "op4_quality_ratio": op4_quality_ratio,
    "op5_probminhash": op5_probminhash,
    "op6_chat_turns": op6_chat_turns,
    "op7_temperature_mixture": op7_temperature_mixture,
    "op8_exact_topk": op8_exact_topk,
    "op9_toxicity_ftrl": op9_toxicity_ftrl,
    "op10_bpe": op10_bpe,
    "op11_ngram_product": op11_ngram_product,
    "op12_subset_sums": op12_subset_sums,
    "op13_merkle_witnesses": op13_merkle_witnesses,
}
