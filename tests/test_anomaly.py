import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from parcelwise.functions.quantile import exact_quantile
from parcelwise.operators import anomaly


def orders_with_outliers(spark, n=4000, outliers=20):
    normal = spark.range(n).select(
        F.col("id").alias("order_id"),
        (F.col("id") % 7).cast("int").alias("lead_days"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10000)) / 10 + 100).alias("sales_amount"),
        (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(10000)) / 100).alias("profit"),
        (F.pmod(F.xxhash64("id", F.lit(3)), F.lit(11)) / 100).alias("discount_rate"),
        (F.col("id") % 50).cast("int").alias("quantity"),
        F.format_string("2022-%02d", F.col("id") % 12 + 1).alias("year_month"),
        F.lit("a").alias("region_name"),
    )
    odd = spark.range(n, n + outliers).select(
        F.col("id").alias("order_id"),
        F.lit(300).alias("lead_days"),
        F.lit(90000.0).alias("sales_amount"),
        (F.lit(-80000.0) - F.col("id")).alias("profit"),
        F.lit(0.9).alias("discount_rate"),
        F.lit(900).alias("quantity"),
        F.lit("2022-05").alias("year_month"),
        F.lit("a").alias("region_name"),
    )
    return normal.unionByName(odd)


@pytest.fixture(scope="module")
def orders(spark):
    return orders_with_outliers(spark).persist()


@pytest.fixture(scope="module")
def forest(orders):
    return anomaly.isolation_forest_fit(orders, trees=40)


def test_planted_outliers_have_the_highest_scores(orders, forest):
    scored = anomaly.isolation_forest_score(orders, forest)
    top = scored.orderBy(F.desc("anomaly_score")).limit(20).collect()
    assert all(r["order_id"] >= 4000 for r in top)
    scores = [r["anomaly_score"] for r in scored.collect()]
    assert 0 < min(scores) and max(scores) <= 1
    flagged = anomaly.flag_anomalies(scored.persist())
    summary = anomaly.anomaly_summary(flagged).first()
    assert summary["anomaly_pct"] == pytest.approx(5.0, abs=0.1)
    assert flagged.filter("order_id >= 4000 and is_anomaly = 1").count() == 20


def test_trees_do_not_depend_on_the_partitioning(orders, forest):
    again = anomaly.isolation_forest_fit(orders.repartition(13), trees=40)
    assert again.threshold == forest.threshold and again.path == forest.path


def test_every_tree_has_its_own_full_sample(orders):
    pool, total = anomaly.sample_pool(orders, anomaly.FEATURES)
    assert total == 4020
    sizes = anomaly.sample_for_trees(pool, anomaly.FEATURES, trees=10, pool_rows=4020).groupBy("tree").count()
    assert [r["count"] for r in sizes.collect()] == [256] * 10


def test_copies_keep_their_share_of_the_pool(spark, orders):
    """A third of the rows are copies of one row; the pool must show that third."""
    hot = orders.filter("order_id = 1").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(2000))))
    df = orders.unionByName(hot.drop("n"))
    for seed in (1, 2):
        pool, total = anomaly.sample_pool(df, anomaly.FEATURES, pool_rows=900, seed=seed)
        copies = [r["copies"] for r in pool.collect()]
        assert total == 6020
        assert max(copies) == pytest.approx(900 * 2001 / 6020, abs=1)
        assert sum(copies) == pytest.approx(900, rel=0.15)


def test_scores_follow_the_tree_definition(spark):
    """One tree with one split, scored by hand."""
    grow = anomaly._tree_grower(["x"], 4, 0)
    tree = grow(pd.DataFrame({"tree": [0] * 4, "place": [1, 2, 3, 4], "x": [0.0, 0.0, 0.0, 9.0]}))
    assert tree["feature"][0].shape == (3,) and 0 < tree["threshold"][0][0] < 9
    forest = anomaly.IsolationForest(
        ["x"], [tree["feature"][0].tolist()], [tree["threshold"][0].tolist()], [tree["path"][0].tolist()], 4
    )
    df = spark.createDataFrame([(0.0,), (9.0,), (None,)], "x double")
    low, high, none = [r["anomaly_score"] for r in anomaly.isolation_forest_score(df, forest).collect()]
    c = lambda n: 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n
    assert high == pytest.approx(2 ** (-1 / c(4)))
    assert low == pytest.approx(2 ** (-(1 + c(3)) / c(4)))
    assert none is None


def test_missing_features_give_no_flag_and_no_anomaly(spark, forest):
    df = orders_with_outliers(spark, 24, 0).withColumn(
        "profit", F.when(F.col("order_id") < 12, F.col("profit"))
    )
    flagged = anomaly.attach_anomaly_flag(df, forest, 0.0)
    assert flagged.filter("is_anomaly is null").count() == 12
    rates = anomaly.monthly_anomaly_rate(flagged).collect()
    assert {(r["total_orders"], r["anomaly_count"], r["anomaly_rate_pct"]) for r in rates} == {(2, 1, 50.0)}
    assert anomaly.anomaly_features(df).count() == 12


@pytest.mark.parametrize("share", [0.0, 0.05, 0.5, 0.95, 1.0])
def test_exact_quantile_equals_numpy(spark, share):
    rng = np.random.default_rng(1)
    samples = {
        "spread": rng.normal(size=5001),
        "tied": rng.integers(0, 4, 5000).astype(float),
        "narrow": np.append(1.0 + rng.uniform(size=3000) * 1e-9, [-1e12, 1e12]),
        "one": np.array([7.0]),
    }
    for values in samples.values():
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").persist()
        assert exact_quantile(df, "v", share) == pytest.approx(np.quantile(values, share), rel=1e-15, abs=1e-15)


def test_quantile_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "anomaly_score double")
    assert exact_quantile(df, "anomaly_score", 0.5) is None
    assert anomaly.flag_anomalies(df).first()["is_anomaly"] is None


def test_nan_is_no_score(spark):
    df = spark.createDataFrame([(float(v),) for v in range(100)] + [(float("nan"),)], "anomaly_score double")
    assert exact_quantile(df, "anomaly_score", 0.95) == pytest.approx(94.05)
    flagged = anomaly.flag_anomalies(df)
    assert flagged.filter("is_anomaly = 1").count() == 5
    assert flagged.filter("is_anomaly is null").count() == 1


def test_keyed_rows_are_drawn_alike_at_any_partitioning(spark, orders):
    for pool_rows in (900, 10_000):
        pools = [
            {tuple(r) for r in anomaly.sample_pool(df, anomaly.FEATURES, pool_rows, key=["order_id"])[0].collect()}
            for df in (orders, orders.repartition(11))
        ]
        assert pools[0] == pools[1]
        assert sum(p[-1] for p in pools[0]) == pytest.approx(min(pool_rows, 4020), rel=0.15)


def test_pool_is_the_rows_of_the_smallest_draws(spark):
    """Nine rows in ten lack a feature: a second limit is needed, the pool is full all the same."""
    rows = spark.range(30_000).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 10 == 0, F.col("id") % 700).alias("x"),
        F.lit(1.5).alias("y"),
    )
    found, size = anomaly.sample_pool(rows, ["x", "y"], 500, key=["order_id"])
    draw = anomaly.unit_draw(F.lit(anomaly.SEED), "order_id", "x", "y")
    wanted = rows.dropna().select(draw.alias("draw"), F.col("x").cast("double"), "y").orderBy("draw").limit(500)
    wanted = wanted.groupBy("x", "y").agg(F.count("*").alias("copies"))
    assert size == 500 and found.exceptAll(wanted).count() == 0 and wanted.exceptAll(found).count() == 0
    # A key that all rows share does not make them one draw; copies of one row fill it.
    one, size = anomaly.sample_pool(rows.withColumn("order_id", F.lit(1)).fillna(3), ["x", "y"], 500, key=["order_id"])
    assert size == 500
    assert anomaly.sample_pool(rows.limit(0), ["x", "y"], 500, key=["order_id"])[1] == 0


@pytest.mark.parametrize("share", [0.0, 1e-5, 0.3, 0.95, 0.99999, 1.0])
def test_quantile_in_the_bracket_of_a_sketch(spark, share):
    """More rows than the sketch tells apart, with ties, a constant and far values."""
    rng = np.random.default_rng(2)
    samples = {
        "spread": rng.normal(size=60_000),
        "tied": rng.integers(0, 3, 60_000).astype(float),
        "mixed": np.concatenate([np.full(40_000, 0.25), rng.uniform(size=20_000), [-1e300, 1e300]]),
        "constant": np.full(30_000, -3.5),
    }
    for values in samples.values():
        df = spark.createDataFrame(pd.DataFrame({"v": values}))
        assert exact_quantile(df, "v", share) == pytest.approx(np.quantile(values, share), rel=1e-15, abs=1e-15)


def test_quantile_outside_of_the_bracket(spark, monkeypatch):
    from parcelwise.functions import quantile

    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    monkeypatch.setattr(quantile, "_bracket", lambda *_: (10.0, 20.0, 0.0, 999.0, 1000))
    assert quantile.exact_quantile(df, "v", 0.95) == pytest.approx(949.05)
