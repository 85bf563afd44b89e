import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelwise.operators import classify
from parcelwise.sources import models


@pytest.fixture(scope="module")
def rows(spark):
    n = 6000
    df = spark.range(n).select(
        F.col("id").alias("order_id"),
        (F.col("id") % 7).cast("int").alias("lead_days"),
        (F.col("id") % 50).cast("int").alias("quantity"),
        (F.pmod(F.xxhash64("id"), F.lit(1000)) / 10).alias("sales_amount"),
        (F.col("id") % 11 / 100).alias("discount_rate"),
        (F.col("id") % 13 - 6.0).alias("profit"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("R"), F.col("id") % 5)).alias("region_name"),
    )
    return df.withColumn("late_risk_flag", (F.col("lead_days") >= 4).cast("int")).persist()


def test_region_codes_are_in_name_order(rows):
    codes = {r["region_label"]: r["region_encoded"] for r in classify.region_codes(rows).collect()}
    assert codes == {"R1": 0, "R2": 1, "R3": 2, "R4": 3, "Unknown": 4}
    encoded = classify.encode_region(rows)
    assert encoded.count() == rows.count()
    assert {r[0] for r in encoded.filter("region_name is null").select("region_encoded").distinct().collect()} == {4}


def test_split_is_stable_and_keeps_the_class_shares(rows):
    split = classify.stratified_split(rows, ["order_id"]).persist()
    shares = {r["late_risk_flag"]: r["s"] for r in split.groupBy("late_risk_flag").agg(F.avg(F.col("is_test").cast("int")).alias("s")).collect()}
    assert all(abs(s - 0.2) < 0.03 for s in shares.values())
    other = classify.stratified_split(rows.repartition(11), ["order_id"])
    assert split.filter("is_test").select("order_id").exceptAll(other.filter("is_test").select("order_id")).count() == 0


def test_forest_finds_a_separable_label_and_survives_saving(spark, rows, tmp_path):
    data = classify.classifier_features(classify.encode_region(rows), keep=("order_id",))
    model = classify.train_late_risk_forest(data, trees=5)
    models.save_model(model, str(tmp_path / "model"))
    scored = classify.score_late_risk(models.load_model(str(tmp_path / "model")), data).persist()
    assert classify.auc_roc(scored, "late_probability").first()["auc"] == 1.0
    assert scored.filter("predicted_late <> late_risk_flag").count() == 0
    best = classify.feature_importance(rows, model).first()
    assert best["feature"] == "lead_days" and best["importance"] > 0.5
    folds = classify.cross_validated_auc(data, ["order_id"], folds=2, trees=3).collect()
    assert [r["auc"] for r in folds] == [1.0, 1.0]


def test_rows_with_a_missing_input_are_left_out(rows):
    holed = rows.withColumn("profit", F.when(F.col("order_id") >= 10, F.col("profit")))
    assert classify.classifier_features(classify.encode_region(holed)).count() == 5990


def pairwise_auc(scores, labels):
    pos, neg = scores[labels == 1], scores[labels == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


@pytest.mark.parametrize("levels", [2, 7, 100000])
def test_auc_equals_the_pairwise_definition(spark, levels):
    rng = np.random.default_rng(levels)
    scores = rng.integers(0, levels, 900) / levels
    labels = (rng.uniform(size=900) < 0.2 + 0.5 * scores).astype(int)
    df = spark.createDataFrame(
        [(float(s), int(l)) for s, l in zip(scores, labels)], "s double, late_risk_flag int"
    )
    assert classify.auc_roc(df, "s").first()["auc"] == pytest.approx(pairwise_auc(scores, labels), rel=1e-14)


def test_auc_of_one_class_is_missing(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "s double, late_risk_flag int")
    assert classify.auc_roc(df, "s").first()["auc"] is None


def test_report(spark):
    pairs = [(1, 1)] * 3 + [(1, 0)] * 1 + [(0, 0)] * 4 + [(0, 1)] * 2
    df = spark.createDataFrame(pairs, "late_risk_flag int, predicted_late int")
    found = {r["class"]: r for r in classify.classification_report(df).collect()}
    assert found["1"]["precision"] == 3 / 5 and found["1"]["recall"] == 3 / 4
    assert found["0"]["f1_score"] == pytest.approx(8 / 11) and found["0"]["support"] == 6
    assert found["accuracy"]["precision"] == 0.7 and found["accuracy"]["support"] == 10
    assert found["macro avg"]["precision"] == pytest.approx((3 / 5 + 4 / 5) / 2)
    assert found["weighted avg"]["recall"] == pytest.approx(0.7)


def test_report_of_a_class_never_predicted(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "late_risk_flag int, predicted_late int")
    found = {r["class"]: r for r in classify.classification_report(df).collect()}
    assert (found["1"]["precision"], found["1"]["recall"], found["1"]["f1_score"]) == (0.0, 0.0, 0.0)


def test_every_fold_holds_a_rare_class(spark):
    df = spark.range(5000).withColumn("late_risk_flag", (F.col("id") < 10).cast("int"))
    placed = classify.label_place(df, ["id"], 42).withColumn("fold", F.col("_place") % 5)
    rare = {r["fold"]: r["count"] for r in placed.filter("late_risk_flag = 1").groupBy("fold").count().collect()}
    assert rare == {k: 2 for k in range(5)}
    sizes = [r["count"] for r in placed.groupBy("fold").count().collect()]
    assert len(sizes) == 5 and max(sizes) < 1.2 * min(sizes)
    split = classify.stratified_split(df, ["id"])
    assert split.filter("is_test and late_risk_flag = 1").count() == 2


def test_a_hundred_thousand_regions(spark):
    df = spark.range(100_000).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("region_name"))
    codes = classify.encode_region(df)
    assert codes.agg(F.max("region_encoded")).first()[0] == 99_999
    assert codes.select("region_encoded").distinct().count() == 100_000


def test_codes_of_many_regions(spark):
    rows = spark.range(200_000).select(F.concat(F.lit("r"), F.col("id") % 100_000).alias("region_name"))
    found = classify.region_codes(rows).toPandas().sort_values("region_label")
    assert found.region_encoded.tolist() == list(range(100_000))
    assert found.region_label.tolist() == sorted(f"r{k}" for k in range(100_000))
    assert classify.region_codes(rows.limit(0)).count() == 0


def test_rows_are_not_shuffled_to_their_places(spark):
    df = spark.range(2_000_000).selectExpr("id", "int(id % 3 = 0) AS late_risk_flag")
    placed = classify.label_place(df, ["id"], 42)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert placed.count() == 2_000_000
