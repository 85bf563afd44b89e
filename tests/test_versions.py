"""Published tables: one step per change, old versions readable, failures without effect."""

import pytest
from pyspark.sql import functions as F

from parcelwise.sources import tables, versions


@pytest.fixture
def name(spark):
    name = "versioned_probe"
    yield name
    for t in spark.catalog.listTables():
        if t.name.startswith(name):
            spark.sql(f"DROP {'VIEW' if t.tableType == 'VIEW' else 'TABLE'} IF EXISTS `{t.name}`")


def rows(spark, *values):
    return spark.createDataFrame(list(values), "id int, month string, at timestamp_ntz")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def failing(spark):
    return rows(spark, (9, "2022-01", None)).withColumn("id", F.raise_error(F.lit("lost")).cast("int"))


def test_a_failed_write_leaves_the_old_table(spark, tmp_path, name):
    tables.publish_table(rows(spark, (1, "2022-01", None)), name, str(tmp_path))
    for _ in range(2):
        with pytest.raises(Exception, match="lost"):
            tables.publish_table(failing(spark), name, str(tmp_path))
        assert ids(spark.table(name)) == [1]
    tables.publish_table(rows(spark, (2, None, None)), name, str(tmp_path))
    assert ids(spark.table(name)) == [2]


@pytest.mark.parametrize("step", ["_write", "_commit", "_register"])
def test_a_job_lost_at_any_step_can_run_again(spark, tmp_path, monkeypatch, name, step):
    versions.publish(rows(spark, (1, "a", None), (2, None, None)), name, str(tmp_path), "month")

    def lost(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(versions, step, lost)
        with pytest.raises(RuntimeError):
            versions.replace_parts(rows(spark, (3, "a", None)), name, str(tmp_path), "month", ["a"])
    assert ids(spark.table(name)) == [1, 2]
    versions.replace_parts(rows(spark, (3, "a", None)), name, str(tmp_path), "month", ["a"])
    assert ids(spark.table(name)) == [2, 3]


def test_parts_change_together_and_others_keep_their_files(spark, tmp_path, name):
    folder = str(tmp_path)
    versions.publish(rows(spark, (1, "a", None), (2, "b", None), (3, None, None), (4, "it's", None)), name, folder, "month")
    reader = versions.current(spark, name, folder)
    first = versions.manifests(spark, folder, name)[-1]
    versions.replace_parts(rows(spark, (7, "b", None), (8, "c", None)), name, folder, "month", ["b", "c", None])
    second = versions.manifests(spark, folder, name)[-1]
    assert ids(spark.table(name)) == [1, 4, 7, 8]
    assert ids(reader) == [1, 2, 3, 4]
    assert {v: second.parts[v] for v in ("a", "it's")} == {v: first.parts[v] for v in ("a", "it's")}
    # Only the month's part is read.
    one = spark.table(name).filter("month = 'b'")
    assert second.parts["b"] in one.select(F.input_file_name()).first()[0]
    assert "PartitionFilters: [isnotnull(month" in one._jdf.queryExecution().executedPlan().toString()
    # Null and a value can be replaced by nothing.
    versions.replace_parts(rows(spark), name, folder, "month", ["a", "b"])
    assert ids(spark.table(name)) == [4, 8]
    with pytest.raises(ValueError):
        versions.replace_parts(rows(spark).drop("at"), name, folder, "month", ["a"])


def test_old_versions_go_with_their_files(spark, tmp_path, name):
    folder = str(tmp_path)
    for k in range(versions.KEEP + 3):
        tables.publish_table(rows(spark, (k, "x", None)), name, folder)
    found = versions.manifests(spark, folder, name)
    assert len(found) == versions.KEEP + 1
    assert {p.name for p in (tmp_path / name).iterdir()} == {"_manifests", *[v.id for v in found]}
    assert ids(spark.table(name)) == [versions.KEEP + 2]
    # A change of columns is one step, too.
    tables.publish_table(rows(spark, (1, "x", None)).withColumn("more", F.lit(1)), name, folder, ["month"])
    assert spark.table(name).columns == ["id", "at", "more", "month"]


def test_another_session_attaches_the_newest_version(spark, tmp_path, name):
    versions.publish(rows(spark, (1, "a", None), (2, None, None)), name, str(tmp_path), "month")
    for t in spark.catalog.listTables():
        if t.name.startswith(name):
            spark.sql(f"DROP {'VIEW' if t.tableType == 'VIEW' else 'TABLE'} `{t.name}`")
    assert versions.attach(spark, name, str(tmp_path))
    assert ids(spark.table(name)) == [1, 2]
    assert not versions.attach(spark, "nothing", str(tmp_path))


def test_a_plain_table_makes_way(spark, tmp_path, name):
    rows(spark, (1, "a", None)).write.option("path", str(tmp_path / "old")).saveAsTable(name)
    tables.publish_table(rows(spark, (2, "a", None)), name, str(tmp_path))
    assert ids(spark.table(name)) == [2]
    empty = rows(spark).filter("id > 0")
    tables.publish_table(empty, name, str(tmp_path), ["month"])
    assert spark.table(name).count() == 0
