from parcelwise.operators import clean, kpi, quality, star

from .frames import raw_rows


def star_of(spark, *changes):
    cleaned = clean.tidy_rows(raw_rows(spark, *changes)).persist()
    return star.star_tables(cleaned)


def test_dimensions_hold_distinct_rows_with_a_key(spark):
    tables = star_of(
        spark,
        {"Order Id": "1"},
        {"Order Id": "2", "Order Region": None},
        {"Order Id": None, "Customer City": "Bay"},
        {"Order Id": "4", "Product Name": "Lamp II", "order date (DateOrders)": "?"},
    )
    counts = {r["table_name"]: r["row_count"] for r in star.table_row_counts(tables).collect()}
    assert counts == {
        "dim_region": 1, "dim_product": 2, "dim_customer": 2, "dim_date": 1, "fact_orders": 3
    }
    twice = quality.key_uniqueness(tables["dim_product"], "product_id").collect()
    assert [(r["key_value"], r["versions"]) for r in twice] == [(101, 2)]


def test_a_product_with_two_names_counts_its_orders_twice(spark):
    changes = [
        {"Order Id": "1", "Sales": "10.10", "Order Profit Per Order": "1.005"},
        {"Order Id": "2", "Product Name": "Lamp II", "Late_delivery_risk": "0"},
        {"Order Id": "3", "Product Card Id": "7", "Product Name": "Cup"},
        {"Order Id": "4", "Product Card Id": None},
    ]
    tables = star_of(spark, *changes)
    row = kpi.department_kpis(tables["fact_orders"], tables["dim_product"]).first()
    joined = tables["fact_orders"].join(tables["dim_product"], "product_id")
    assert row["total_orders"] == joined.count() == 5
    assert row["late_risk_pct"] == 60.0
    assert row["total_sales"] == round(2 * 10.10 + 2 * 120.5 + 120.5, 2)
    assert row["total_profit"] == 92.01


def test_monthly_groups_keep_null_keys(spark):
    fact = star_of(
        spark,
        {"Order Id": "1"},
        {"Order Id": "2", "Late_delivery_risk": "0", "shipping date (DateOrders)": "2022-01-22"},
        {"Order Id": "3", "Order Region": None},
        {"Order Id": "4", "order date (DateOrders)": "?"},
    )["fact_orders"]
    rows = {(r["year_month"], r["region_name"]): r for r in kpi.monthly_risk_by_region(fact).collect()}
    assert set(rows) == {("2022-01", "Harbour North"), ("2022-01", None), (None, "Harbour North")}
    both = rows["2022-01", "Harbour North"]
    assert (both["total_orders"], both["late_orders"], both["late_risk_pct"]) == (2, 1, 50.0)
    assert (both["avg_lead_days"], both["total_sales"], both["avg_discount_pct"]) == (6.0, 241.0, 5.0)
    assert rows[None, "Harbour North"]["avg_lead_days"] is None


def test_huge_amounts_fall_back_to_plain_sums(spark):
    fact = star_of(
        spark, {"Order Id": "1", "Sales": "1e300"}, {"Order Id": "2", "Sales": "2e300"}
    )["fact_orders"]
    assert kpi.monthly_risk_by_region(fact).first()["total_sales"] == 3e300


def test_totals_do_not_depend_on_the_partitioning(spark):
    df = spark.range(20000).selectExpr(
        "'m' year_month", "'r' region_name", "1 late_risk_flag", "2 lead_days",
        "(id % 977) * 0.01D + 0.1D sales_amount", "-(id % 31) * 0.37D profit", "0.07D discount_rate",
    )
    totals = {
        tuple(kpi.monthly_risk_by_region(df.repartition(n)).first()) for n in (1, 3, 8)
    }
    assert len(totals) == 1


def test_top_months_break_ties_by_key(spark):
    monthly = spark.createDataFrame(
        [("2022-02", "b", 50.0, 1), ("2022-02", "a", 50.0, 1), ("2022-01", "z", 50.0, 1), (None, "a", None, 1)],
        "year_month string, region_name string, late_risk_pct double, total_orders long",
    )
    found = kpi.top_risk_region_months(monthly).collect()
    assert [(r[0], r[1]) for r in found] == [("2022-01", "z"), ("2022-02", "a"), ("2022-02", "b"), (None, "a")]


def test_segments_of_one_region_and_category(spark):
    tables = star_of(
        spark,
        {"Order Id": "1"},
        {"Order Id": "2", "Customer Id": "2", "Customer Segment": "Corporate", "Late_delivery_risk": "0"},
        {"Order Id": "3", "Customer Id": "2", "Customer Segment": "Corporate"},
        {"Order Id": "4", "Category Name": "Garden", "Product Card Id": "9"},
    )
    found = kpi.segment_risk(
        tables["fact_orders"], tables["dim_customer"], tables["dim_product"], "Harbour North", "Lighting"
    ).collect()
    assert [tuple(r) for r in found] == [("Consumer", 1, 1, 100.0), ("Corporate", 2, 1, 50.0)]
