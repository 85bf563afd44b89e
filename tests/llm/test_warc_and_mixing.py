"""WARC round trips, broken archives, and Poisson mixing."""

import base64
import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelwise.checks import compare
from parcelwise.llm import mixing, queries, warc
from parcelwise.llm.oracle import ORACLE
from parcelwise.session import shared_folder

PAGE = "page_id long, url string, html string, digest string, block string"


@pytest.fixture(scope="module")
def con(tiny):
    con = compare.connect(tiny)
    for name in ("documents", "pages", "embeddings", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tiny}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", ["op1_warc_reassembly", "op7_poisson_mixing", "op8_voronoi_top_k", "op9_spherical_caps", "op10_jaccard_relations", "op11_phrase_collocations", "op12_adaptive_quality_rules", "op13_geometric_block_search"])
def test_query_equals_its_sql(spark, con, tiny, name):
    assert compare.differences(queries.QUERIES[name](spark, tiny), con, ORACLE[name]) == []


def test_archives_return_every_page(spark):
    values = [
        (1, "http://a/1", "x" * 70_000), (2, None, None), (3, "http://a/ü?q=1 2\r\n", "é" * 40_000), (4, "u", ""),
        (5, "v", "x" * 70_000), (5, "v", "x" * 70_000), (6, "w", "small"), (None, "n", "small"), (7, "y", "z\r\n\r\n0\r\n"),
    ]
    df = spark.createDataFrame([(*v, "d", "b") for v in values], PAGE).repartition(3)
    files = warc.write_archives(df, shared_folder(spark, "test-archives"), segment_bytes=1000)
    rows = warc.read_archives(files).collect()
    first = {}
    for page, _, html in values:
        if page is not None:
            first[html or ""] = max(page, first.get(html or "", page))
    expected = Counter()
    for page, _, html in values:
        body = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        refers = first[html or ""] if first[html or ""] != page else None
        kind = "revisit" if refers is not None else "response"
        expected[page, len(body), digest, kind, refers, None if refers is not None else body] += 1
    found = Counter(
        (r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload))
        for r in rows
    )
    assert found == expected and {r.status for r in rows} == {"ok"}
    some = warc.write_archives(df, shared_folder(spark, "test-archives"), min_bytes=10_000)
    kinds = {(r.page_id, r.record_type) for r in warc.read_archives(some).collect()}
    assert (1, "revisit") in kinds and (2, "response") in kinds and (4, "response") in kinds
    none = warc.write_archives(df.limit(0), shared_folder(spark, "test-archives"))
    assert warc.read_archives(none).count() == 0


def test_broken_records_are_told(spark, tmp_path):
    digest = hashlib.sha1(b"y" * 5000).hexdigest()
    whole = list(warc.page_records(1, "u", b"y" * 5000, digest, None, 1000))
    assert len(whole) > 4
    variants = {
        "segment missing or repeated": whole[:2] + whole[3:],
        "total length differs": [*whole[:1], whole[1].replace(b"y" * 900, b"y" * 899, 1).replace(b"Content-Length: 1000", b"Content-Length: 999"), *whole[2:]],
        "digest differs": [whole[0].replace(b"yyyy", b"yyyz", 1), *whole[1:]],
        "bad chunks": [whole[0].replace(b"chunked\r\n\r\n1388", b"chunked\r\n\r\n1389"), *whole[1:]],
        "ok": whole[::-1],
    }
    for problem, records in variants.items():
        writer = warc.ArchiveWriter(str(tmp_path))
        for data in records:
            writer.add(data)
        files = spark.createDataFrame([writer.close()], warc.LIST)
        (row,) = warc.read_archives(files).collect()
        assert row.status == problem, (problem, row.status)


def test_chunks_round_trip():
    rng = np.random.default_rng(1)
    for n in [0, 1, 8191, 8192, 8193, 50_000]:
        body = rng.bytes(n)
        assert warc.decode_chunks(warc.chunked(body)) == body
    assert warc.decode_chunks(b"3;x=1\r\nabc\r\n0\r\nT: 1\r\n\r\n") == b"abc"
    for bad in [b"", b"5\r\nabc\r\n0\r\n\r\n", b"zz\r\n", b"3\r\nabcX0\r\n\r\n", b"-1\r\n\r\n"]:
        assert warc.decode_chunks(bad) is None


@pytest.mark.parametrize("rate", [0.01, 0.9, 30.0, 5000.0])
def test_tables_hold_the_poisson_distribution(rate):
    first, below = mixing.poisson_table(rate)
    draws = (np.arange(20_000) + 0.5) / 20_000
    counts = first + np.searchsorted(below, draws, "right")
    assert counts.mean() == pytest.approx(rate, rel=0.02)
    assert counts.var() == pytest.approx(rate, rel=0.05)
    assert below[-1] == pytest.approx(1.0, abs=1e-9)


def test_sources_reach_their_weights(spark):
    df = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.lit("ten chars.").alias("text"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 4)).alias("source"),
        F.lit(9).alias("copy"),
        F.lit("x").alias("rate"),
    )
    mixed = mixing.mix(df, {"hot": 1.0, "s0": 2.0, "s1": 1.0}, total=40_000.0)
    assert mixed.columns == ["doc_id", "text", "source", "rate", "copy", "shuffle_key"]
    counts = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert set(counts) == {"hot", "s0", "s1"}
    assert counts["s0"] == pytest.approx(2000, rel=0.1) and counts["hot"] == pytest.approx(1000, rel=0.12)
    again = mixing.mix(df.repartition(7), {"hot": 1.0, "s0": 2.0, "s1": 1.0}, total=40_000.0)
    assert mixed.exceptAll(again).count() == 0 and mixed.count() == again.count()
    rows = [(r[0], r.shuffle_key) for r in mixed.select(F.spark_partition_id(), "shuffle_key").collect()]
    assert rows == sorted(rows, key=lambda r: (r[0], r[1])) or all(
        [k for p, k in rows if p == q] == sorted(k for p, k in rows if p == q) for q in {p for p, _ in rows}
    )


def test_mixing_of_odd_rows(spark):
    schema = "doc_id long, text string, source string"
    values = [(1, None, "a"), (2, "", "a"), (3, "text", None), (3, "text", None), (None, "text", "b")]
    df = spark.createDataFrame(values, schema)
    found = mixing.mix(df).collect()
    assert {r.doc_id for r in found if r.source == "a"} == {1, 2}
    assert mixing.mix(df.limit(0)).count() == 0
