"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    caps, id_files, jaccard, language, lines, mixing, packing, phrases, quality, ranked, thresholds,
    voronoi, warc,
)
from .common import held_out, table
from .tokens import Encoder, shared_encoder
from .vectors import usable
from ..session import shared_folder

# A score from which a document counts as good.
GOOD = 0.3

QUERIES: dict = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def byte_words() -> Encoder:
    return shared_encoder("byte_bpe_50k.json")


def folded_words() -> Encoder:
    return shared_encoder("word_bpe_49k.json", folds=True)


@query
def op1_warc_reassembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write_archives(table(spark, sf_dir, "pages"), shared_folder(spark, "archives"))
    return warc.read_archives(files, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op2_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), byte_words, window=1024, end_id=0)


@query
def op3_string_kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = language.predict(documents, language.fit(documents))
    return found.withColumn("held_out", held_out(F.col("doc_id")))


@query
def op4_simple8b_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_files.encode_and_read(table(spark, sf_dir, "documents"), folded_words, end_id=1)


@query
def op5_convolutional_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    network = quality.fit(documents, table(spark, sf_dir, "labels"))
    return quality.score(documents, network).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )


@query
def op7_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), seed=7)


@query
def op8_voronoi_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").filter(usable(F.col("embedding")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    data = rows.select(F.col("vec_id").alias("id"), whole.alias("vector"))
    return voronoi.top_k(data.filter(F.col("id") % 50 == 0), data, 5)


@query
def op9_spherical_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.near_duplicates(table(spark, sf_dir, "embeddings"), 0.95)


@query
def op10_jaccard_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = jaccard.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=90)
    return groups.select("doc_id", "n_shingles", "component_id")


@query
def op6_line_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup(table(spark, sf_dir, "documents"))


@query
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), longest=5, least=100, first=2000)


@query
def op12_adaptive_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return thresholds.judge(table(spark, sf_dir, "documents"))


@query
def op13_geometric_block_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.top_k(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)
