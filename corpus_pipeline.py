"""From raw documents to packed training sequences, in five stages.

Each stage reads what the one before wrote; all but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelwise.llm import jaccard, lines, mixing, packing, quality
from parcelwise.llm.common import stage, table
from parcelwise.llm.queries import GOOD, byte_words


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network rejects go."""
    network = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.keep(docs, network, GOOD)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of line runs go, and documents that consisted of nothing else."""
    edited = lines.dedup(docs)
    emptied = (F.col("deleted_lines") > 0) & ~F.col("text").rlike(r"\S")
    edited = edited.filter(~F.coalesce(emptied, F.lit(False)))
    length = F.when(F.col("deleted_lines") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return edited.withColumn("n_chars", length).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share most of their five-word shingles the smallest doc_id stays."""
    return jaccard.one_of_each(docs, width=5, percent=80)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that all sources get the same weight, in a shuffled order."""
    return mixing.mix(docs, seed=7).select(*docs.columns)


def packed_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents' token ids in windows of 1024."""
    return packing.pack(docs, byte_words, window=1024, end_id=0)


STAGES = [
    ("quality", good_documents),
    ("line_dedup", without_repeated_lines),
    ("near_duplicates", one_of_each_group),
    ("mixing", mixed_sources),
    ("packing", packed_windows),
]

# Learned scores and token ids are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
