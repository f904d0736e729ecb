"""The corpus pipeline: stages over documents, each written as Parquet and read back by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, language_id, mixing, near_dedup, pieces
from tidemark.llm.common import stored, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; models are fitted on the stage's own input.

    Null and empty texts and texts without a letter are rejected. Repeated rows and further
    columns stay as they are; a null language is not learnt from.
    """
    return language_id.recognised(docs)


def unique_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document for each distinct text: that of the largest id.

    Null and empty texts are the same text. Of repeated rows one stays; equal ids are told
    apart by their other columns. Further columns stay.
    """
    return exact_dedup.deduplicate(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, five words and a similarity of 0.8 or more: that of the smallest id.

    Texts without words are copies of nothing and stay. Further columns stay.
    """
    return near_dedup.deduplicate_near(docs, percent=80)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: up to three times, or not at all.

    A null source is a source, the last one. Texts without words are not taken. Copies are
    equal rows; further columns stay.
    """
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's tokens, their spans and the text they decode to, as digests.

    Text and further columns end here. A null text is encoded as an empty one; repeated
    rows give repeated rows.
    """
    return pieces.digests(docs, pieces.public_model())


STAGES = [
    ("language identification", known_language),
    ("exact dedup", unique_texts),
    ("near dedup", no_near_copies),
    ("source mixing", mixed_sources),
    ("pieces", tokens),
]

#: SQL can express neither language models nor tokenising; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over the documents: one row for each document and time that it was taken."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
