import datetime

import pytest

from parcelwise.operators import adhoc, clean
from parcelwise.session import shared_folder
from parcelwise.sources import benchmark_tables, orders_csv, runs, tables

from .frames import RAW_COLUMNS, raw_rows


def test_csv_is_latin_1_text_with_missing_values(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    text = 'Id,City ,Note\n1,Málaga,"a ""quoted"", text"\n2,NA,\n3,n/a,None\n'
    (folder / "orders.csv").write_bytes(text.encode("latin-1"))
    df = orders_csv.read_orders_csv(spark, str(folder))
    assert df.columns == ["Id", "City ", "Note"]
    assert [tuple(r) for r in df.orderBy("Id").collect()] == [
        ("1", "Málaga", 'a "quoted", text'), ("2", None, None), ("3", None, None)
    ]
    assert orders_csv.read_orders_csv(spark, str(folder), ["Id", "City ", "Note"]).count() == 3
    with pytest.raises(Exception):
        orders_csv.read_orders_csv(spark, str(folder), ["City ", "Id", "Note"]).collect()
    (folder / "orders.csv").write_text('Id,Note\n1,"two\nlines"\n')
    assert orders_csv.read_orders_csv(spark, str(folder), multiline=True).count() == 1


def test_csv_round_trip(spark, tmp_path):
    raw = raw_rows(spark, {}, {"Order Id": "2", "Order Region": None, "Product Name": 'Lamp "X", large'})
    orders_csv.write_orders_csv(raw, str(tmp_path / "out"))
    back = orders_csv.read_orders_csv(spark, str(tmp_path / "out"), list(RAW_COLUMNS))
    assert back.exceptAll(raw).count() == 0 and back.count() == 2


def test_clean_parquet_is_partitioned_by_year(spark, tmp_path):
    cleaned = clean.tidy_rows(
        raw_rows(spark, {}, {"Order Id": "2", "order date (DateOrders)": "?"}, {"Order Id": "3", "order date (DateOrders)": "2021-05-01"})
    )
    path = str(tmp_path / "clean")
    tables.write_clean_parquet(cleaned, path)
    assert {p.name for p in (tmp_path / "clean").glob("order_year=*")} == {
        "order_year=2021", "order_year=2022", "order_year=__HIVE_DEFAULT_PARTITION__"
    }
    assert spark.read.schema(cleaned.schema).parquet(path).select(cleaned.columns).exceptAll(cleaned).count() == 0
    tables.write_clean_parquet(cleaned.filter("order_year = 2021"), path)
    assert spark.read.parquet(path).count() == 1


def test_replacing_partitions_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "fact")
    first = spark.createDataFrame([(1, "2022-01"), (2, "2022-02"), (3, None)], "id int, year_month string")
    tables.replace_partitions(first, path, ["year_month"])
    new = spark.createDataFrame([(9, "2022-02"), (8, None)], "id int, year_month string")
    for _ in range(2):
        tables.replace_partitions(new, path, ["year_month"])
    found = spark.read.schema(first.schema).parquet(path).collect()
    assert sorted(r["id"] for r in found) == [1, 8, 9]


def test_tables_views_and_questions(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "region_name string, n int")
    tables.publish_table(df, "probe_table", str(tmp_path))
    tables.publish_table(df.limit(1), "probe_table", str(tmp_path))
    assert tables.read_published(spark, "probe_table").count() == 1
    tables.publish_view(df, "probe_view")
    answer = adhoc.adhoc_sql(spark, " SELECT region_name FROM probe_view ORDER BY n DESC; ")
    assert answer.error is None and answer.result.first()[0] == "b"
    for text in ("SELECT nothing FROM probe_view", "DROP TABLE probe_table", "", "CREATE TABLE x AS SELECT 1"):
        answer = adhoc.adhoc_sql(spark, text)
        assert answer.result is None and answer.error.startswith("Query error: ")
    assert spark.catalog.tableExists("probe_table")
    spark.sql("DROP VIEW probe_table")


def test_run_log_keeps_history_and_gives_the_latest(spark, tmp_path):
    path = str(tmp_path / "runs")
    at = datetime.datetime(2026, 1, 1)
    for hour, value in enumerate((0.5, 0.75)):
        entry = runs.run_rows(
            spark, "late", "r1", "forest", at + datetime.timedelta(hours=hour),
            params={"max_depth": 8}, metrics={"auc": value},
        )
        runs.log_run_metrics(entry, path)
    log = runs.read_run_log(spark, path)
    assert log.count() == 4
    last = runs.read_run_metrics(log).collect()
    assert [(r["key"], r["value"], r["entries"]) for r in last] == [("auc", 0.75, 2)]


def test_staged_copy_equals_its_source(spark):
    df = raw_rows(spark, {}, {"Order Region": None})
    assert tables.stage(df, "probe").exceptAll(df).count() == 0
    assert shared_folder(spark, "a") != shared_folder(spark, "a")


def write_text(path, text):
    path.write_text(text, encoding="latin-1")


def test_files_with_reordered_columns_are_an_error(spark, tmp_path):
    write_text(tmp_path / "a.csv", "Order Id,Sales\n1,10\n")
    write_text(tmp_path / "b.csv", "Sales,Order Id\n99,4\n")
    df = orders_csv.read_orders_csv(spark, str(tmp_path / "*.csv"))
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        df.collect()
    write_text(tmp_path / "b.csv", "Order Id,Sales\n4,99\n")
    rows = orders_csv.read_orders_csv(spark, str(tmp_path / "*.csv")).collect()
    assert {(r["Order Id"], r["Sales"]) for r in rows} == {("1", "10"), ("4", "99")}


def test_errors_of_a_running_query_are_told(spark):
    from parcelwise.operators.adhoc import adhoc_sql

    answer = adhoc_sql(spark, "SELECT 1 / (id - 1) AS x FROM range(3)")
    rows, error = answer.rows()
    assert rows == [] and "DIVIDE_BY_ZERO" in error
    assert adhoc_sql(spark, "SELECT 2 AS x").rows() == ([(2,)], None)
    many = adhoc_sql(spark, "SELECT id FROM range(30)")
    rows, error = many.rows(10)
    assert len(rows) == 10 and rows.is_cut and error is None
    assert not many.rows(30)[0].is_cut and many.result.count() == 30


def test_rows_that_do_not_fit_are_told(spark, tmp_path):
    lines = {
        "a.csv": ["1,10,A", "2,20", "3,30,C,x", '4,"40,C', '5,"5,0","say ""hi"""', "6,,", "7,70,,", "8"],
        "b.csv": ["9,90,Z", '"10",1,"q"z', "", "NA,NA,NA"],
    }
    for name, data in lines.items():
        write_text(tmp_path / name, "\n".join(["Order Id,Sales,Note ", *data]) + "\n")
    found = orders_csv.read_orders(spark, str(tmp_path / "*.csv"))
    bad = sorted((r["file"].rsplit("/", 1)[1], r["row"], r["reason"]) for r in found.rejected.collect())
    assert bad == [
        ("a.csv", "2,20", "too few fields"), ("a.csv", "3,30,C,x", "too many fields"),
        ("a.csv", '4,"40,C', "open quote"), ("a.csv", "7,70,,", "too many fields"), ("a.csv", "8", "too few fields"),
    ]
    good = found.rows.collect()
    assert len(good) + len(bad) == sum(bool(x) for data in lines.values() for x in data)
    assert sorted(str(r["Order Id"]) for r in good) == ["1", "10", "5", "6", "9", "None"]
    # The same whichever columns are asked for.
    assert found.rows.select("Sales").count() == found.rows.count() == len(good)
    assert found.rejected.count() == len(bad) == found.rejected.select("file").count()


def test_compressed_order_files_hold_the_same_rows_in_files_of_bounded_size(spark, tiny, tmp_path, monkeypatch):
    monkeypatch.setattr(orders_csv, "FILE_ROWS", 1000)
    rows = benchmark_tables.raw_orders(spark, tiny).coalesce(1).persist()
    orders_csv.write_orders_csv(rows, str(tmp_path / "plain"))
    orders_csv.write_orders_csv(rows, str(tmp_path / "packed"), "gzip")
    plain, packed = [orders_csv.read_orders_csv(spark, str(tmp_path / name)) for name in ("plain", "packed")]
    assert packed.count() == rows.count() and plain.exceptAll(packed).count() == 0
    files = list((tmp_path / "packed").glob("*.csv.gz"))
    assert len(files) == -(-rows.count() // 1000)
    size = lambda name: sum(f.stat().st_size for f in (tmp_path / name).glob("*.csv*"))
    assert size("packed") < size("plain") / 3
