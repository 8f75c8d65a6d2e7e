"""Documents to packed training sequences, one operator after the other."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import exact_dedup, language, ngram_join, packing, quality
from millrace.llm.queries import TOKENIZER, language_network, quality_model, table
from millrace.sinks.files import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# A document needs this much of a score to stay.
LEAST_QUALITY = quality.THRESHOLD
# How far the language's score must be from an even guess among the languages, 0, to certainty, 1.
# With four languages the score is 0.5: 11 of the 10,000 documents of sf0.1 are below it, none of
# sf0.01, and half of the texts of Cyrillic letters in the test.
LEAST_CERTAINTY = 1 / 3


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model, LEAST_QUALITY)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network tells with some certainty."""
    network = language_network(docs)
    return language.accepted(docs, network, language.floor(network, LEAST_CERTAINTY))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest id."""
    return exact_dedup.kept_rows(docs)


def distinct_contents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that hang together as near duplicates, the one with the least id; rows that
    share an id or have none are told apart by their texts. Rows without a word stay."""
    return ngram_join.without_near_duplicates(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document, and where it lies in which sequence."""
    return packing.pack(docs, TOKENIZER)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("language", known_language),
    ("exact_dedup", distinct_texts),
    ("near_dedup", distinct_contents),
    ("packing", packed),
]

# The classifiers cannot be expressed in SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
