from datetime import datetime

from hypothesis import given, strategies as st

from parcelwise.functions.names import snake_name, snake_names
from parcelwise.operators import clean, profile, quality

from .frames import raw_rows

DATES = ("order date (DateOrders)", "shipping date (DateOrders)")


def dated(start, end):
    return dict(zip(DATES, (start, end)))


def test_three_orders_get_dates_lead_days_and_flags(spark):
    raw = raw_rows(
        spark,
        {"Order Id": "1"},
        {"Order Id": "2", **dated("2022-02-10", "2022-02-15"), "Late_delivery_risk": "0"},
        {"Order Id": "3", **dated("2022-03-05", "2022-03-12")},
    )
    rows = clean.clean_orders(raw).orderBy("order_id").collect()
    assert [r["order_date"] for r in rows] == [
        datetime(2022, 1, 15), datetime(2022, 2, 10), datetime(2022, 3, 5)
    ]
    assert [r["actual_lead_days"] for r in rows] == [5, 5, 7]
    assert {r["late_delivery_risk"] for r in rows} == {0, 1}
    assert [r["order_year_month"] for r in rows] == ["2022-01", "2022-02", "2022-03"]
    assert [(r["order_year"], r["order_month"], r["order_quarter"]) for r in rows][2] == (2022, 3, 1)


def test_copies_collapse_and_are_counted(spark):
    raw = raw_rows(spark, {}, {}, {"Order Region": None}, {"Order Region": None})
    kept = clean.tidy_rows(raw, copies="copies")
    assert sorted(r["copies"] for r in kept.collect()) == [2, 2]
    assert clean.tidy_rows(raw).count() == 2
    assert clean.drop_repeats(clean.tidy_rows(raw)).count() == 2


def test_rows_that_become_equal_by_cleaning_are_copies(spark):
    raw = raw_rows(spark, {"Order Profit Per Order": "n.a."}, {"Order Profit Per Order": "0"})
    assert clean.tidy_rows(raw).count() == 1


def test_bad_values_become_null_or_zero(spark):
    raw = raw_rows(
        spark,
        {
            "order date (DateOrders)": "31/31/2022 9:00",
            "Late_delivery_risk": None,
            "Order Profit Per Order": "NaN",
            "Sales": "many",
            "Order Item Quantity": "3.0",
        },
        {"Order Profit Per Order": "-12.5"},
    )
    bad, good = clean.tidy_rows(raw).orderBy("order_profit_per_order", ascending=False).collect()
    assert bad["order_date"] is None and bad["actual_lead_days"] is None
    assert bad["order_year_month"] is None and bad["order_quarter"] is None
    assert bad["late_delivery_risk"] == 0 and bad["order_profit_per_order"] == 0.0
    assert bad["sales"] is None and bad["order_item_quantity"] == 3
    assert good["order_profit_per_order"] == -12.5
    labelled = clean.tidy_rows(raw, nat_as_string=True)
    assert {r[0] for r in labelled.select("order_year_month").collect()} == {"NaT", "2022-01"}


def test_long_ids_stay_exact(spark):
    ids = ["9007199254740993", "12.0", "many"]
    raw = raw_rows(spark, *[{"Order Id": i} for i in ids])
    found = {r["order_id"] for r in clean.tidy_rows(raw).collect()}
    assert found == {9007199254740993, 12, None}


def test_lead_days_round_down_and_both_formats_parse(spark):
    cases = {
        ("2022-01-15 23:00:00", "2022-01-16 01:00:00"): 0,
        ("2022-01-15 12:00:00", "2022-01-15 11:00:00"): -1,
        ("1/5/2022 0:30", "1/6/2022 0:30"): 1,
        ("1/5/2022 0:30", "1/6/2022 0:29"): 0,
        ("12/31/2021 22:05", "2022-01-07"): 6,
        ("2022-01-10", "2022-01-08"): -2,
    }
    raw = raw_rows(spark, *[{**dated(*k), "Order Id": str(i)} for i, k in enumerate(cases)])
    rows = clean.tidy_rows(raw).orderBy("order_id").collect()
    assert [r["actual_lead_days"] for r in rows] == list(cases.values())


def test_sparse_columns_are_strictly_above_half(spark):
    df = spark.createDataFrame(
        [(1, None, None), (2, None, None), (3, "x", None), (4, "y", "z")],
        "id int, half string, most string",
    )
    assert clean.drop_sparse(df).columns == ["id", "half"]
    assert clean.drop_sparse(df.limit(0)).columns == df.columns


def test_names(spark):
    assert snake_name("  Order Item Discount Rate     ") == "order_item_discount_rate"
    assert snake_name("shipping date (DateOrders)") == "shipping_date_dateorders"
    assert snake_names(["A b", "a-b", "A_B", "%"]) == ["a_b", "a_b_2", "a_b_3", "column_3"]
    assert clean.normalize_columns(raw_rows(spark, {})).columns[2] == "late_delivery_risk"


@given(st.lists(st.text(max_size=8), max_size=8))
def test_names_are_unique_and_stable(names):
    unique = snake_names(names)
    assert len(set(unique)) == len(names)
    assert snake_names(unique) == unique


def report(df, min_rows=100_000):
    return {r["check_name"]: r["passed"] for r in quality.dq_report(df, min_rows).collect()}


def test_quality_of_a_small_table(spark):
    found = report(clean.tidy_rows(raw_rows(spark, {}, {"Order Id": "2"})))
    assert found["late_risk_binary"] is True
    assert found["row_count_above_100k"] is False and found["all_passed"] is False
    assert report(clean.tidy_rows(raw_rows(spark, {}, {"Order Id": "2"})), 1)["all_passed"] is True


def test_quality_of_no_rows(spark):
    found = report(clean.tidy_rows(raw_rows(spark, {})).limit(0))
    assert found == {
        "no_null_order_date": True,
        "no_null_region": True,
        "late_risk_binary": True,
        "positive_sales": False,
        "reasonable_lead_days": False,
        "row_count_above_100k": False,
        "all_passed": False,
    }


def test_quality_bounds(spark):
    schema = "order_date int, order_region string, late_delivery_risk int, sales double, actual_lead_days int"
    good = [(1, "a", 1, 0.0, 365)] * 19
    assert report(spark.createDataFrame([*good, (1, "a", 1, -1.0, 366)], schema))["positive_sales"] is False
    assert report(spark.createDataFrame([*good, *good, (1, "a", 0, None, -6)], schema), 38)["all_passed"] is True
    null_flag = report(spark.createDataFrame([*good, (None, None, None, 1.0, -5)], schema))
    assert not null_flag["late_risk_binary"] and null_flag["reasonable_lead_days"]
    assert not null_flag["no_null_order_date"] and not null_flag["no_null_region"]


def test_profile(spark):
    df = spark.createDataFrame([("a", None), ("b", None), ("a", 1), (None, 2)], "s string, n int")
    shape = profile.profile_shape(df).first()
    assert (shape["row_count"], shape["column_count"]) == (4, 2)
    nulls = profile.profile_nulls(df).collect()
    assert [(r["column_name"], r["null_count"], r["null_pct"]) for r in nulls] == [("n", 2, 50.0), ("s", 1, 25.0)]
    assert [tuple(r) for r in profile.profile_value_counts(df, "s").collect()] == [("a", 2), ("b", 1)]
    assert {r[0] for r in profile.profile_distinct(df, "s").collect()} == {"a", "b", None}
