"""What the plans must look like, whatever the size of the data."""

import pytest
from pyspark.sql import functions as F

from parcelwise.operators import classify, feeds, kpi
from parcelwise import session
from parcelwise.session import apply_settings, sizing
from parcelwise.sources import benchmark_tables, tables

FACT = (
    "order_id bigint, customer_id bigint, product_id bigint, region_name string, year_month string, "
    "late_risk_flag int, lead_days int, sales_amount double, profit double, discount_rate double"
)


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture(scope="module")
def fact(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("fact"))
    df = spark.range(6000).select(
        F.col("id").alias("order_id"),
        (F.col("id") % 40).alias("customer_id"),
        # A third of all rows belong to one product.
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).cast("long").alias("product_id"),
        F.concat(F.lit("R"), F.col("id") % 4).alias("region_name"),
        F.format_string("2022-%02d", F.col("id") % 12 + 1).alias("year_month"),
        (F.col("id") % 5 == 0).cast("int").alias("late_risk_flag"),
        (F.col("id") % 7).cast("int").alias("lead_days"),
        (F.col("id") % 97 * 1.01).alias("sales_amount"),
        (F.col("id") % 13 - 6.5).alias("profit"),
        (F.col("id") % 11 / 100).alias("discount_rate"),
    )
    tables.write_parquet(df, path, ["year_month"])
    return spark.read.schema(FACT).parquet(path)


@pytest.fixture(scope="module")
def products(spark):
    return spark.range(50).select(
        F.col("id").alias("product_id"),
        F.concat(F.lit("D"), F.col("id") % 3).alias("department_name"),
        F.explode(F.array(F.lit("x"), F.lit("y"))).alias("product_name"),
        F.lit("C").alias("category_name"),
    )


def test_kpis_read_only_their_columns_and_aggregate_before_the_shuffle(fact):
    text = plan(kpi.monthly_risk_by_region(fact))
    assert "customer_id" not in text and "product_id" not in text
    assert text.index("partial_count") < text.index("Exchange", text.index("(3)"))


def test_filters_reach_the_scan(spark, fact, tmp_path):
    scores = kpi.monthly_risk_by_region(fact).select(
        "year_month", "region_name", F.col("late_risk_pct").alias("disruption_score"), F.lit("Low").alias("risk_tier")
    )
    tables.write_feed_parquet(scores, str(tmp_path / "scores"))
    stored = tables.read_feed_parquet(spark, str(tmp_path / "scores"))
    text = plan(feeds.filter_risk_scores(stored, ["R1"], "2022-02", "2022-03", ("Low",)))
    pushed = text[text.index("PushedFilters"):].split("\n")[0]
    assert "region_name" in pushed and "year_month" in pushed and "risk_tier" in pushed


def test_partition_sizes_follow_the_input():
    small, large = sizing(1e9), sizing(100e12)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert 100e12 / int(large["spark.sql.shuffle.partitions"]) <= 1e9 + 1
    assert int(small["spark.sql.files.maxPartitionBytes"]) < int(large["spark.sql.files.maxPartitionBytes"])


def test_sizes_for_a_session_built_elsewhere(spark):
    before = {k: spark.conf.get(k) for k in sizing(1e9)}
    try:
        apply_settings(spark, 100e12)
        assert 100e12 / int(spark.conf.get("spark.sql.shuffle.partitions")) <= 512 * 1024**2 + 1e4
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@pytest.mark.parametrize("now, expected", [
    # Nothing set, as in a plain session; less than the input needs, more, in other units.
    ((None, None), ("596", "134217728")),
    (("300", "16m"), ("596", "134217728")),
    (("900", "1g"), ("900", "1g")),
])
def test_large_inputs_raise_partitions_whatever_is_set(spark, monkeypatch, now, expected):
    monkeypatch.setattr(session, "input_size", lambda df: 5_000_000_000)
    keys = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for key, value in zip(keys, now):
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
        session.fit_partitions(spark.range(1))
        assert tuple(spark.conf.get(k).removesuffix("b") for k in keys) == expected
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_lines_are_not_shuffled_to_nations_and_carry_what_is_needed(spark, tiny):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        tree = plan(benchmark_tables.raw_orders(spark, tiny).dropDuplicates())
    finally:
        spark.conf.set(key, before)
    dealt = [line for line in tree.split("\n") if "hashpartitioning" in line]
    assert not any("nationkey" in line for line in dealt)
    # Lines to orders and to parts, and the three tables they meet; copies go where they are.
    assert len(dealt) == 6, dealt
    to_parts = tree[: tree.index("hashpartitioning(l_partkey")].rsplit("Input [", 1)[1]
    assert "lead" in to_parts and "shipdate" not in to_parts and "orderpriority" not in to_parts


def test_generated_methods_are_small_enough_to_be_compiled(spark):
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    assert apply_settings(spark).conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_month_filters_prune_partitions(fact):
    text = plan(kpi.monthly_risk_by_region(fact).filter(F.col("year_month") == "2022-05"))
    assert "PartitionFilters: [isnotnull(year_month" in text


def test_hot_products_meet_their_departments_as_a_few_rows(spark, fact, products):
    found = {tuple(r)[:3] for r in kpi.department_kpis(fact, products).collect()}
    plain = fact.join(products, "product_id").groupBy("department_name", "year_month").agg(F.count("*"))
    assert {r[:3] for r in found} == {tuple(r) for r in plain.collect()}
    tree = plan(kpi.department_kpis(fact, products)).split("\n\n")[0]
    below_join = tree[tree.index("Join"):]
    assert below_join.count("HashAggregate") >= 4


def test_department_kpis_shuffle_orders_once_and_not_their_sums(fact, products):
    plain = kpi.department_kpis(fact, products)
    tree = plan(plain).split("\n\n")[0]
    # The scan of the facts is the first; between it and the join stands one exchange.
    facts = tree[tree.index("Join"): tree.index("Scan parquet")]
    assert facts.count("Exchange") == 1
    assert facts.index("HashAggregate") < facts.rindex("HashAggregate") < facts.index("Exchange")


def test_product_states_come_out_by_month_and_equal_a_plain_sum(fact):
    states = kpi.product_months(fact)
    text = plan(states)
    assert text.split("\n\n")[0].count("Exchange") == 1 and "hashpartitioning(year_month" in text
    found = {(r["product_id"], r["year_month"], r["_orders"], r["_late"]) for r in states.collect()}
    rows = fact.groupBy("product_id", "year_month").agg(F.count("*"), F.sum("late_risk_flag")).collect()
    assert found == {tuple(r) for r in rows} and len(rows) == states.count()


def test_clean_orders_are_written_without_a_further_shuffle(spark, tmp_path):
    rows = spark.range(0, 400, 1, 4).select("id", (F.col("id") % 3 + 2020).cast("int").alias("order_year"))
    tables.write_clean_parquet(rows, str(tmp_path))
    # Each of the four tasks writes its own file of each year.
    assert len(list(tmp_path.glob("order_year=*/*.zstd.parquet"))) == 12
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path)).collect()) == list(range(400))


def test_partitions_follow_the_rows_that_remove_copies():
    assert int(sizing(8e9)["spark.sql.shuffle.partitions"]) > 900
    assert int(sizing(500e9)["spark.sql.shuffle.partitions"]) == 2000


def test_no_operator_plans_a_product_of_tables(fact, products):
    results = [
        kpi.department_kpis(fact, products),
        classify.encode_region(fact),
        classify.auc_roc(fact, "sales_amount"),
        feeds.latest_risk_by_region(
            fact.select("year_month", "region_name", F.col("profit").alias("disruption_score"), F.lit("Low").alias("risk_tier"))
        ),
    ]
    for df in results:
        text = plan(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
