"""Language and quality models: held-out accuracy, gradients and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelwise.llm import language, quality, queries
from parcelwise.llm.common import held_out

DOCUMENT = "doc_id long, text string, lang string, source string, score double, sketch string"
ODD = [(1, None), (2, ""), (3, " \n"), (4, "1234 !?"), (5, "a"), (None, "the word"), (5, "a"), (6, "x" * 300_000), (7, "é")]


@pytest.fixture(scope="module")
def small(spark):
    return "/root/testdata/sf0.01"


def odd(spark):
    return spark.createDataFrame([(*r, "en", "s", 0.0, "") for r in ODD], DOCUMENT)


def test_languages_of_held_out_documents(spark, small):
    found = queries.op3_string_kernel_language(spark, small)
    known = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang")
    right = found.join(known, "doc_id").filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert found.count() == known.count()
    assert right.first()[0] > 0.97
    assert found.filter("score < 0 or score > 1 or score is null").count() == 0


def test_kernel_counts_shared_grams():
    texts = ["abc abd", "abc xyz", "ABC", "hello there", "öäü ß"] * 2
    sets = [language.gram_set(t) for t in texts]
    model = language.Model(sets, ["a", "b", "a", "b", "a"] * 2)
    got = model.kernels(sets)
    landmark = [s for l in ("a", "b") for s, m in zip(sets, ["a", "b", "a", "b", "a"] * 2) if m == l]
    grams = set(np.concatenate(landmark).tolist())
    for k, x in enumerate(sets):
        for j, y in enumerate(landmark):
            x_in = set(x.tolist()) & grams
            expected = len(x_in & set(y.tolist())) / np.sqrt(len(x_in) * len(y))
            assert got[k, j] == pytest.approx(expected, abs=1e-5)


def test_long_texts_are_read_to_the_end():
    text = "a" * (language.PART + 10) + "zq"
    assert set(language.gram_set(text)) >= set(language.gram_set("azq")) 


def test_odd_texts_have_a_language(spark):
    model = language.Model([language.gram_set("the and of"), language.gram_set("der und die")], ["en", "de"])
    rows = [(r.doc_id, r.lang_pred, r.score) for r in language.predict(odd(spark), model).collect()]
    assert len(rows) == len(ODD)
    unknown = [d for d, l, s in rows if l == "und"]
    assert sorted(unknown) == [1, 2, 3, 4] and all(s == 0 for d, l, s in rows if l == "und")
    assert {l for _, l, _ in language.predict(odd(spark), None).select("doc_id", "lang_pred", "score").collect()} == {"und"}
    assert language.fit(odd(spark).limit(0)) is None
    assert language.predict(odd(spark).limit(0), model).count() == 0


def test_no_label_of_a_held_out_row_is_learnt(spark):
    df = odd(spark).filter("doc_id is not null").withColumn("lang", F.when(held_out(F.col("doc_id")), "secret").otherwise("en"))
    model = language.fit(df)
    assert model is None or model.labels == ["en"]


def test_gradients_equal_differences():
    network = quality.Network(3)
    network.params = {k: v.astype(np.float64) for k, v in network.params.items()}
    rng = np.random.default_rng(0)
    rows = []
    for _ in range(3):
        byte = quality.padded(rng.integers(32, 127, 150, dtype=np.uint8).tobytes())
        rows.append((byte, quality.repeats(byte)))
    goals, weights = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])

    def loss():
        best = np.stack([(network.chunks(*r) @ network.params["filters"]).max(0) for r in rows])
        z = np.tanh(best + network.params["bias"]) @ network.params["out"] + network.params["base"]
        p = 1 / (1 + np.exp(-z))
        return float(np.mean(weights * -(goals * np.log(p) + (1 - goals) * np.log(1 - p))))

    grads = network.gradients(rows, goals, weights)
    for name, grad in grads.items():
        flat, g = network.params[name].reshape(-1), np.asarray(grad).reshape(-1)
        for k in np.argsort(-np.abs(g))[:3]:
            before, step = flat[k], 1e-2
            flat[k] = before + step
            up = loss()
            flat[k] = before - step
            down = loss()
            flat[k] = before
            assert g[k] == pytest.approx((up - down) / (2 * step), rel=0.1, abs=1e-4)


def test_every_byte_of_a_long_text_counts():
    network = quality.Network(1)
    text = b"plain words " * 40_000
    whole = network.pooled(text + b"#### $$$$ %%%%" + text)
    byte = quality.padded(text + b"#### $$$$ %%%%" + text)
    direct = (network.chunks(byte, quality.repeats(byte)) @ network.params["filters"]).max(0)
    assert np.allclose(whole, direct, atol=1e-4)


def test_quality_of_held_out_documents(spark, small):
    found = queries.op5_convolutional_quality(spark, small)
    labels = spark.read.parquet(f"{small}/labels.parquet").select("doc_id", "quality")
    rows = found.join(labels, "doc_id").filter("held_out").collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([r.predicted for r in rows if r.quality == 1]) > 0.95
    assert found.filter("score < 0 or score > 1 or score is null").count() == 0


def test_odd_texts_have_a_score(spark):
    network = quality.Network(2)
    rows = quality.score(odd(spark), network).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in quality.score(odd(spark), None).collect()} == {0.5}
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").limit(0)
    assert quality.fit(odd(spark), labels) is None
    kept = quality.keep(odd(spark), None, 0.3)
    assert kept.columns == odd(spark).columns and kept.count() == len(ODD)


def labelled(spark, rows):
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    return docs, spark.createDataFrame(sorted({(i, q) for i, _, q in rows}), "doc_id long, quality int")


def test_quality_is_learnt_from_long_texts_only(spark):
    free = [r.id for r in spark.range(400).filter(~held_out(F.col("id"))).limit(60).collect()]
    good, bad = "a calm sentence about rivers and towns. ", "$$$ ### click now !!! "
    rows = [(k, (good, bad)[n % 2] * 1200 + str(k), 1 - n % 2) for n, k in enumerate(free)]
    network = quality.fit(*labelled(spark, rows))
    scores = network.score([good * 20, bad * 20, good * 5000, bad * 8000])
    assert scores[0] > 0.7 > 0.3 > scores[1] and scores[2] > 0.7 > 0.3 > scores[3]


def test_fit_draws_the_texts_of_a_repeated_id(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(quality.Network, "fit", lambda self, texts, goals, weights: taken.append((texts, goals)) or self)
    rows = [(1, f"text {k}", 1) for k in range(3000)] + [(2, "same", 0)] * 2000
    docs, labels = labelled(spark, rows)
    quality.fit(docs, labels, rows=400)
    texts, goals = taken.pop()
    assert abs(sum(goals) - 200) < 60 and goals.count(0) == 1
    quality.fit(docs.repartition(5), labels, rows=400)
    assert taken.pop() == (texts, goals)
    quality.fit(docs, labels, rows=400, most=500)
    assert 500 <= sum(len(t) for t, g in zip(*taken.pop()) if g == 1) < 520
    assert quality.fit(docs.limit(0), labels) is None


def test_maxima_of_long_texts_are_found_in_parts():
    network = quality.Network(4)
    byte = quality.padded(bytes(np.random.default_rng(1).integers(32, 127, 3 * quality.PART + 77, dtype=np.uint8)))
    same = quality.repeats(byte)
    part = network.chunks(byte, same)
    answers = part @ network.params["filters"]
    best, place, held = network.tops(byte, same)
    assert np.allclose(best, answers.max(0), atol=1e-4) and np.allclose(held, part[place])
    assert np.allclose(answers[place, np.arange(quality.FILTERS)], best, atol=1e-4)
