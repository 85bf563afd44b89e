from hypothesis import given, settings, strategies as st

from parcelwise.operators import feeds, score
from pyspark.sql import functions as F

MONTHLY = "year_month string, region_name string, late_risk_pct double"
RATES = "year_month string, region_name string, anomaly_rate_pct double"


def test_missing_rates_are_zero_and_null_keys_stay(spark):
    monthly = spark.createDataFrame([("m1", "a", 10.0), ("m1", None, 20.0), ("m2", "a", 30.0)], MONTHLY)
    rates = spark.createDataFrame([("m1", "a", 5.0)], RATES)
    found = {(r[0], r[1]): r["anomaly_rate_pct"] for r in score.join_anomaly_rate(monthly, rates).collect()}
    assert found == {("m1", "a"): 5.0, ("m1", None): 0.0, ("m2", "a"): 0.0}


def test_scores_of_three_months(spark):
    monthly = spark.createDataFrame([("m1", "a", 10.0), ("m2", "a", 20.0), ("m3", "a", 30.0)], MONTHLY)
    rates = spark.createDataFrame([("m1", "a", 0.0), ("m2", "a", 4.0), ("m3", "a", 8.0)], RATES)
    rows = score.build_risk_scores(monthly, rates).orderBy("year_month").collect()
    assert [r["disruption_score"] for r in rows] == [20.0, 60.0, 100.0]
    assert [r["risk_tier"] for r in rows] == ["Low", "Medium", "High"]


def test_constant_columns_scale_to_fifty(spark):
    monthly = spark.createDataFrame([("m1", "a", 10.0), ("m2", "a", 10.0)], MONTHLY)
    rows = score.build_risk_scores(monthly, spark.createDataFrame([], RATES)).collect()
    assert {(r["late_risk_norm"], r["anomaly_norm"], r["disruption_score"]) for r in rows} == {(50.0, 50.0, 60.0)}


def test_tier_bounds_and_missing_score(spark):
    df = spark.createDataFrame([(39.9,), (40.0,), (69.9,), (70.0,), (None,)], "disruption_score double")
    tiers = [r["risk_tier"] for r in score.risk_tier(df).collect()]
    assert tiers == ["Low", "Medium", "Medium", "High", "Low"]


def test_rounding_is_half_even_and_missing_stays_missing(spark):
    df = spark.createDataFrame(
        [(0.5, 0.0), (1.5, 0.0), (None, 1.0)], "late_risk_norm double, anomaly_norm double"
    )
    assert [r["disruption_score"] for r in score.disruption_score(df).collect()] == [20.2, 20.8, None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 100), st.floats(0, 100)), min_size=1, max_size=12))
def test_scores_stay_in_range_and_tiers_rise_with_them(spark, pairs):
    keys = [(f"m{i:02d}", "a") for i in range(len(pairs))]
    monthly = spark.createDataFrame([(*k, p[0]) for k, p in zip(keys, pairs)], MONTHLY)
    rates = spark.createDataFrame([(*k, p[1]) for k, p in zip(keys, pairs)], RATES)
    rows = score.build_risk_scores(monthly, rates).collect()
    assert all(20 <= r["disruption_score"] <= 100 for r in rows)
    assert all(0 <= r["late_risk_norm"] <= 100 for r in rows)
    order = ["Low", "Medium", "High"]
    ranks = [order.index(r["risk_tier"]) for r in sorted(rows, key=lambda r: r["disruption_score"])]
    assert ranks == sorted(ranks)


SCORES = (
    "year_month string, region_name string, disruption_score double, risk_tier string, "
    "late_risk_pct double, total_sales double, avg_lead_days double, anomaly_rate_pct double"
)


def some_scores(spark):
    return spark.createDataFrame(
        [
            ("2022-01", "a", 30.0, "Low", 10.0, 1.0, 2.0, 3.0),
            ("2022-02", "a", 80.0, "High", 50.0, 2.0, 4.0, 5.0),
            ("2022-02", "b", 50.0, "Medium", 20.0, 3.0, None, 9.0),
            ("2022-03", "b", 50.0, "Medium", 20.0, 4.0, 3.0, 1.0),
            ("2022-02", None, 90.0, "High", 90.0, 5.0, 1.0, 7.0),
            (None, "b", 10.0, "Low", 5.0, 6.0, 1.0, 1.0),
        ],
        SCORES,
    )


def test_filters_and_cards(spark):
    scores = some_scores(spark)
    options = [tuple(r) for r in feeds.filter_options(scores).collect()]
    assert options == [
        ("region", "a", True), ("region", "b", True),
        ("month", "2022-01", True), ("month", "2022-02", False), ("month", "2022-03", True),
    ]
    chosen = feeds.filter_risk_scores(scores, ["a", "b"], "2022-01", "2022-02", ("High", "Medium"))
    assert {(r[0], r[1]) for r in chosen.collect()} == {("2022-02", "a"), ("2022-02", "b")}
    assert tuple(feeds.kpi_cards(chosen).first()) == (65.0, 1, 35.0, 5.0, 4.0)


def test_charts(spark):
    scores = some_scores(spark)
    assert [tuple(r)[1:3] for r in feeds.latest_risk_by_region(scores).collect()] == [("b", 50.0)]
    assert [tuple(r) for r in feeds.anomaly_rate_by_region(scores).collect()] == [("a", 4.0), ("b", 11 / 3)]
    assert feeds.anomaly_rate_by_region(scores.drop("anomaly_rate_pct")) is None
    assert [r[0] for r in feeds.late_trend(scores).collect()] == ["2022-01", "2022-02", "2022-03"]
    trend = {tuple(r) for r in feeds.risk_trend(scores).collect()}
    matrix = feeds.risk_matrix(scores, ["a", "b"]).collect()
    cells = {(r["year_month"], c, r[c]) for r in matrix for c in ("a", "b") if r[c] is not None}
    assert trend == cells and len(trend) == 4
    assert feeds.highest_avg_score_region(scores).first()["region_name"] is None


def test_bands_and_departments(spark):
    forecasts = spark.createDataFrame(
        [("a", 2, "T+2", 40.0, 30.0, 55.0), ("a", 1, "T+1", 69.9, 60.0, 100.0), ("b", 1, "T+1", 70.0, 0.0, 71.0)],
        "region_name string, forecast_step int, forecast_month string, predicted_risk double, "
        "lower_bound double, upper_bound double",
    )
    assert [r["forecast_step"] for r in feeds.forecast_for_region(forecasts, "a").collect()] == [1, 2]
    assert [r[0] for r in feeds.forecast_regions(forecasts).collect()] == ["a", "b"]
    bands = {r["predicted_risk"]: (r["error_up"], r["error_down"], r["colour"]) for r in feeds.forecast_bands(forecasts).collect()}
    assert bands[40.0] == (15.0, 10.0, "#EF9F27") and bands[70.0][2] == "#E24B4A"
    departments = spark.createDataFrame(
        [("x", "m1", 1.0, 2.0, 10.0), ("x", "m2", 1.0, 2.0, 20.0), ("y", "m1", 9.0, 1.0, 5.0), (None, "m1", 99.0, 9.0, 1.0)],
        "department_name string, year_month string, total_sales double, total_profit double, late_risk_pct double",
    )
    assert [tuple(r) for r in feeds.department_performance(departments).collect()] == [
        ("y", 9.0, 1.0, 5.0), ("x", 2.0, 4.0, 15.0)
    ]
    assert tuple(feeds.department_most_profit(departments).first()) == (None, 9.0)
