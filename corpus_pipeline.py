"""The corpus pipeline: quality, near-duplicates, decontamination, mixing, shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm import quality_classifier
from ledgerlark.llm.decontamination import drop_documents
from ledgerlark.llm.mixing import apply_mix
from ledgerlark.llm.near_duplicates import deduplicate
from ledgerlark.llm.queries_native import SHARDS, SLOTS
from ledgerlark.llm.registry import read, ready
from ledgerlark.llm.sharding import place
from ledgerlark.session import stage


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier accepts.

    A null text is judged as an empty one, rows of one text alike, and a score equal to the bound is
    accepted. Without two trusted labels every score is 0.5 and nothing is accepted. An empty table stays empty.
    """
    ready(spark)
    return quality_classifier.accepted(docs, quality_classifier.train(docs, read(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest id.

    Null ids come first; of one id the smallest text hash counts, and of equal rows one stays. Null and
    empty texts are equal texts, so one of them stays. An empty table stays empty.
    """
    ready(spark)
    return deduplicate(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a window of a benchmark item.

    Null and empty texts hold none and stay, as do all repeated rows of a clean document. Items without
    words, and an empty table of items, drop nothing.
    """
    ready(spark)
    return drop_documents(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, once for every reading.

    Documents without words are never read and go; rows with a null source are a source of their own.
    Rows equal in id, source and text share what is taken of them. An empty table stays empty.
    """
    ready(spark)
    return apply_mix(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their slot and shard.

    Null ids are placed in slot 0, equal ids in one shard; columns that are called ``slot`` or ``shard`` are
    replaced. An empty table stays empty.
    """
    ready(spark)
    return place(docs, SHARDS, SLOTS, F.col("doc_id"))


STAGES = [
    ("quality_classifier", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

# The classifier's model is no SQL expression.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next one reads it."""
    docs = read(ready(spark), sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
