"""A corpus from raw documents to packed sequences: each stage is written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sigtrack.llm import langid, mixing, packing, quality, simhash
from sigtrack.llm.common import stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents most of whose words are in one language, which becomes their ``lang``; the model learns from the documents not held out."""
    return langid.accepted(docs, langid.fitted(docs))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the share of content lines keep; labels come from the tables."""
    return quality.kept(docs, quality.learn(quality.training_sample(docs, table(spark, sf_dir, "labels"))))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, up to twice."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens, with their ids. Workers that all stages use keep fewer words in memory."""
    return packing.with_checksum(packing.pack(docs, cache_words=150_000), "ids")


STAGES = [
    ("language_id", language),
    ("quality_rules", good_quality),
    ("simhash_dedup", distinct),
    ("source_mix", mix),
    ("packing", pack),
]

#: The models, xxHash and the tokenizer have no SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
