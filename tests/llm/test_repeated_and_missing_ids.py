"""Draws and candidates of rows that repeat an id or have none."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelwise.llm import language, mixing, voronoi
from parcelwise.llm.sampling import per_class


@pytest.mark.parametrize("doc_id", range(1, 5))
def test_rows_of_one_id_are_drawn_by_their_content(spark, doc_id):
    df = spark.range(20_000).select(F.lit(doc_id).alias("doc_id"), "id", F.lit("en").alias("lang"))
    sample, classes = per_class(df, "lang", ["doc_id", "id"], 3000)
    assert abs(sample.count() - 3000) < 150
    assert [tuple(r) for r in classes.collect()] == [("en", 20_000)]
    again, _ = per_class(df.repartition(7), "lang", ["doc_id", "id"], 3000)
    assert sample.exceptAll(again).count() == 0


def test_equal_rows_are_drawn_as_one(spark):
    df = spark.range(20_000).select(F.lit(1).alias("doc_id"), F.lit("en").alias("lang"))
    sample, classes = per_class(df, "lang", ["doc_id"], 3000)
    assert sample.count() == 1 and classes.first()["n"] == 1
    none, classes = per_class(df.limit(0), "lang", ["doc_id"], 3000)
    assert none.count() == 0 and classes.count() == 0


def test_many_classes_all_have_rows(spark):
    df = spark.range(6000).select("id", (F.col("id") % 1200).alias("lang"))
    sample, classes = per_class(df, "lang", ["id"], 6000)
    assert classes.count() == 1200 and sample.select("lang").distinct().count() == 1200


def test_a_language_is_learnt_from_rows_of_one_id(spark):
    words = {"aa": "ein kleiner hund lief schnell", "bb": "the quick brown fox jumped"}
    rows = [(1, f"{text} {k}", lang) for k in range(200) for lang, text in words.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(df, rows=60)
    odd = spark.createDataFrame([(5, words["aa"]), (6, words["bb"])], "doc_id long, text string")
    found = {r.doc_id: r.lang_pred for r in language.predict(odd, model).collect()}
    assert found == {5: "aa", 6: "bb"}


@pytest.mark.parametrize("seed", [0, 2, 7])
def test_rows_without_an_id_draw_each_for_itself(spark, seed):
    df = spark.range(5000).select(
        F.lit(None).cast("long").alias("doc_id"), F.lit("same text").alias("text"), F.lit("a").alias("source")
    )
    mixed = mixing.mix(df, seed=seed)
    # Poisson with mean 1 each: the total has a deviation of 71.
    assert abs(mixed.count() - 5000) < 220
    keys = mixed.select("shuffle_key").distinct().count()
    assert keys == mixed.count()
    with_ids = df.withColumn("doc_id", F.monotonically_increasing_id())
    both = mixing.mix(df.unionByName(with_ids), seed=seed)
    alone = mixing.mix(with_ids, seed=seed)
    drawn = both.filter("doc_id is not null").select("doc_id", "copy", "shuffle_key")
    assert drawn.exceptAll(alone.select(drawn.columns)).count() == 0 and drawn.count() == alone.count()


def test_all_vectors_of_an_id_are_candidates(spark):
    two = spark.createDataFrame([(1, [5]), (1, [9]), (1, [9]), (2, [1])], "id long, vector array<long>")
    found = voronoi.top_k(two.filter("id = 2"), two, 5).orderBy("rank").collect()
    assert [tuple(r) for r in found] == [(2, 1, 1, 9), (2, 2, 1, 5)]


def test_queries_that_repeat_an_id_lose_no_neighbour(spark):
    rng = np.random.default_rng(3)
    # Id 0 holds a third of all vectors, the nearest ones to itself.
    rows = [(0, v.tolist()) for v in rng.integers(90, 110, (300, 4))]
    rows += [(k + 1, v.tolist()) for k, v in enumerate(rng.integers(-100, 100, (600, 4)))]
    df = spark.createDataFrame(rows, "id long, vector array<long>")
    found = voronoi.top_k(df.filter("id % 50 = 0"), df, 5).collect()
    distinct = {(i, tuple(v)) for i, v in rows}
    for q in range(0, 601, 50):
        query = min(v for i, v in distinct if i == q)
        scores = sorted((-sum(a * b for a, b in zip(query, v)), i) for i, v in distinct if i != q)[:5]
        got = sorted((r["rank"], r.vec_id, r.score) for r in found if r.query_id == q)
        assert got == [(n + 1, i, -s) for n, (s, i) in enumerate(scores)]
