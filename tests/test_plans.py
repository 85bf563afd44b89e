import uuid

import pytest
from pyspark.sql import functions as F

from parcelwise.functions.moments import month_label, parse_moment
from parcelwise.plans import dashboard, ingest, learn
from parcelwise.sources import benchmark_tables, orders_csv, runs, tables
from parcelwise.streaming import daily


@pytest.fixture(scope="module")
def home(spark, tmp_path_factory):
    return str(tmp_path_factory.mktemp("home"))


@pytest.fixture(scope="module")
def ingested(spark, tiny, home):
    return ingest.ingest(benchmark_tables.raw_orders(spark, tiny), home)


def test_ingest(spark, ingested):
    assert (ingested.rows_in, ingested.duplicates) == (6309, 309)
    assert ingested.dropped_columns == ["product_description"]
    assert ingested.clean.count() == 6000
    report = {r[0]: r[1] for r in ingested.report.collect()}
    assert report["late_risk_binary"] and not report["row_count_above_100k"]
    assert spark.table("fact_orders").filter("order_id is null").count() == 0


def test_learn_and_dashboard(spark, ingested, home, tmp_path, monkeypatch):
    folder = tmp_path / "shared"
    monkeypatch.setattr(tables, "shared_folder", lambda spark, label: f"{folder}/{label}-{uuid.uuid4().hex}")
    learned = learn.learn(spark, home, trees=3, folds=2)
    assert list(folder.iterdir()) == []
    assert learned.scores.count() == spark.table(ingest.MONTHLY_VIEW).count()
    assert learned.forecasts.count() == 75 and learned.failed_regions.count() == 0
    assert learned.skipped_regions.count() == 0
    keys = {r["key"] for r in runs.read_run_metrics(runs.read_run_log(spark, f"{home}/runs")).collect()}
    assert keys == {"auc_test", "auc_cv"}
    dashboard.publish_feeds(spark, home)
    feed = dashboard.dashboard_feed(spark, home)
    assert feed["anomaly_rate"].count() == 5 and feed["kpi_cards"].count() == 1
    assert feed["departments"].count() == 25
    narrow = dashboard.dashboard_feed(spark, home, ["NATION_2"], ("1996-01", "1996-03"), ("Low",))
    found = {tuple(r) for r in narrow["risk_scores"].select("region_name", "risk_tier").distinct().collect()}
    assert found <= {("NATION_2", "Low")}


def test_rejected_rows_are_kept_and_counted(spark, tiny, tmp_path):
    raw = some_months(spark, tiny).limit(200)
    orders_csv.write_orders_csv(raw.coalesce(1), str(tmp_path / "in"))
    (tmp_path / "in" / "more.csv").write_text(",".join(raw.columns) + "\n1,2\n")
    home = str(tmp_path / "home")
    done = ingest.ingest(orders_csv.read_orders(spark, str(tmp_path / "in" / "*.csv"), raw.columns), home)
    assert (done.rows_in, done.rejected_rows) == (200, 1)
    assert [r["reason"] for r in spark.read.parquet(f"{home}/rejected").collect()] == ["too few fields"]


STAR = ["fact_orders", "dim_region", "dim_product", "dim_customer", "dim_date", ingest.MONTHLY_VIEW, ingest.DEPARTMENT_VIEW]


def some_months(spark, tiny):
    """Orders of a few months, as files have them, those without a date included."""
    raw = benchmark_tables.raw_orders(spark, tiny).drop(*benchmark_tables.LINE_KEY)
    month = month_label(parse_moment(F.col("order date (DateOrders)")))
    return raw.filter(F.coalesce(month, F.lit("1995-01")).between("1995-01", "1996-02"))


def contents(spark):
    return {name: sorted(map(str, spark.table(name).select(sorted(spark.table(name).columns)).collect())) for name in STAR}


def files(folder):
    return {str(p): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


@pytest.mark.parametrize("seeded", [False, True])
def test_daily_runs_equal_one_ingest(spark, tiny, tmp_path, seeded):
    raw = some_months(spark, tiny)
    ingest.ingest(raw, str(tmp_path / "whole"))
    expected = contents(spark)
    landing, home = tmp_path / "landing", str(tmp_path / "home")
    first = raw.filter("`Order Item Quantity` <= 25")
    if seeded:
        ingest.ingest(first, home)
        with pytest.raises(ValueError, match="seed"):
            daily.run_daily(spark, str(landing / "day=*"), home, raw.columns)
        daily.seed(first, home)
    # The second day repeats part of the first one's rows.
    for day, rows in enumerate([first, raw.filter("`Order Item Quantity` > 20")][seeded:]):
        orders_csv.write_orders_csv(rows.coalesce(2), str(landing / f"day={day}"))
        daily.run_daily(spark, str(landing / "day=*"), home, raw.columns, 1).awaitTermination()
    assert contents(spark) == expected
    # One more month: the files of the others stay, and a day without news changes nothing.
    before = files(tmp_path / "home" / "star" / "fact_orders")
    extra = raw.limit(1).withColumn("order date (DateOrders)", F.lit("2031-05-01"))
    orders_csv.write_orders_csv(extra, str(landing / "day=7"))
    daily.run_daily(spark, str(landing / "day=*"), home, raw.columns).awaitTermination()
    after = files(tmp_path / "home" / "star" / "fact_orders")
    assert {p: after.get(p) for p in before} == before and len(after) == len(before) + 1
    months = spark.table(ingest.MONTHLY_VIEW).filter("year_month = '2031-05'")
    assert months.count() == 1 == spark.table("fact_orders").filter("year_month = '2031-05'").count()
    assert spark.table("dim_date").filter("year_month = '2031-05'").count() == 1
    now = contents(spark)
    daily.run_daily(spark, str(landing / "day=*"), home, raw.columns).awaitTermination()
    assert contents(spark) == now


def test_the_daily_job_reaches_the_scores(spark, tiny, tmp_path):
    raw = some_months(spark, tiny)
    landing, home = tmp_path / "landing", str(tmp_path / "home")
    orders_csv.write_orders_csv(raw.filter("`Order Item Quantity` <= 40"), str(landing / "day=0"))
    daily.run_day(spark, str(landing / "day=*"), home, raw.columns, trees=2, folds=0)
    orders_csv.write_orders_csv(raw.filter("`Order Item Quantity` > 40"), str(landing / "day=1"))
    late = raw.limit(40).withColumn("order date (DateOrders)", F.lit("2031-05-01"))
    orders_csv.write_orders_csv(late, str(landing / "day=2"))
    learned = daily.run_day(spark, str(landing / "day=*"), home, raw.columns, trees=2, folds=0)
    assert learned.scores.filter("year_month = '2031-05'").count() > 0
    found = sorted(map(str, spark.table("risk_scores").collect()))
    # The same rows in one step.
    other = str(tmp_path / "other")
    ingest.ingest(raw.unionByName(late), other)
    whole = learn.learn(spark, other, trees=2, folds=0)
    assert found == sorted(map(str, whole.scores.select(spark.table("risk_scores").columns).collect()))
