"""One registered query per operator, over the benchmark tables.

The helpers below only choose inputs; the work is in the package's
operators. The fault-planted raw table feeds everything, so nulls, copies and
products with two names reach each operator. Queries that need an anomaly flag
with a known answer take ``profit < 0``; the isolation forest has its own queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.moments import parse_moment
from ..operators import (
    adhoc,
    anomaly,
    classify,
    clean as cleaning,
    feeds,
    forecast,
    kpi,
    profile,
    quality,
    score,
    star,
)
from ..plans import ingest
from ..sources import benchmark_tables, models, orders_csv, runs, tables
from ..session import apply_settings, fit_partitions, shared_folder
from ..sources.benchmark_tables import LINE_KEY

REGION = "NATION_3"
SEGMENT_REGION = "NATION_7"
SEGMENT_CATEGORY = "ECONOMY"
FIRST_MONTH, LAST_MONTH = "1996-01", "1998-06"
SELECTED = ["NATION_1", "NATION_10", "NATION_11", "NATION_2", "NATION_20"]

QUERIES: dict = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


# Inputs -------------------------------------------------------------------


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = benchmark_tables.raw_orders(apply_settings(spark), sf_dir)
    fit_partitions(rows)
    return rows


def named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.normalize_columns(raw(spark, sf_dir))


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.tidy_rows(raw(spark, sf_dir))


def fact(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return star.fact_orders(clean(spark, sf_dir), keep)


def keyed_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact(spark, sf_dir, tuple(LINE_KEY))


def stored_keyed_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For queries that read the facts more than once."""
    return tables.stage(keyed_fact(spark, sf_dir), "keyed-fact")


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.monthly_risk_by_region(fact(spark, sf_dir))


# What the star tables are made of.
STAR_COLUMNS = list(
    dict.fromkeys(
        source
        for layout in (star.REGION, star.PRODUCT, star.CUSTOMER, star.DATE, star.FACT)
        for source in layout.values()
    )
)


def stored_clean(
    spark: SparkSession, sf_dir: str, columns: list[str] = STAR_COLUMNS
) -> DataFrame:
    """For queries that read the cleaned orders more than once."""
    return tables.stage(clean(spark, sf_dir).select(*columns), "clean")


def stored_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.stage(fact(spark, sf_dir), "fact")


def departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = stored_clean(
        spark, sf_dir, list(dict.fromkeys([*star.FACT.values(), *star.PRODUCT.values()]))
    )
    return kpi.department_kpis(star.fact_orders(cleaned), star.dim_product(cleaned))


def loss_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("is_anomaly", (F.col("profit") < 0).cast("int"))


def loss_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly.monthly_anomaly_rate(loss_flag(fact(spark, sf_dir)))


def rated_months(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Monthly KPIs and anomaly rates, stored as the daily job stores them."""
    orders = stored_fact(spark, sf_dir)
    rates = anomaly.monthly_anomaly_rate(loss_flag(orders))
    return (
        tables.stage(kpi.monthly_risk_by_region(orders), "monthly"),
        tables.stage(rates, "anomalies"),
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.build_risk_scores(*rated_months(spark, sf_dir))


def selected_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.filter_risk_scores(scores(spark, sf_dir), SELECTED, FIRST_MONTH, LAST_MONTH)


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.forecast_risk_by_region(monthly(spark, sf_dir))


def model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classifier input with its row key, from a stored copy of the columns it needs."""
    needed = [*LINE_KEY, *[c for c in classify.FEATURES if c != "region_encoded"], "region_name", classify.LABEL]
    facts = tables.stage(keyed_fact(spark, sf_dir).select(*needed), "keyed-fact")
    return classify.classifier_features(classify.encode_region(facts), keep=tuple(LINE_KEY))


def trained(spark: SparkSession, sf_dir: str, **settings):
    rows = tables.stage(classify.stratified_split(model_rows(spark, sf_dir), LINE_KEY), "split-rows")
    model = classify.train_late_risk_forest(rows.filter(~F.col("is_test")), key=LINE_KEY, **settings)
    return model, rows


# Sources and sinks ---------------------------------------------------------


@query
def read_orders_csv(spark, sf_dir):
    path = shared_folder(spark, "orders-csv")
    orders_csv.write_orders_csv(raw(spark, sf_dir).drop(*LINE_KEY), path, "gzip")
    return cleaning.tidy_rows(orders_csv.read_orders_csv(spark, path))


@query
def write_clean_parquet(spark, sf_dir):
    path = shared_folder(spark, "clean")
    tables.write_clean_parquet(clean(spark, sf_dir), path)
    return spark.read.parquet(path).select(
        *LINE_KEY, "order_id", "order_date", "order_year", "order_year_month", "sales"
    )


@query
def write_feed_parquet(spark, sf_dir):
    path = shared_folder(spark, "anomalies")
    tables.write_feed_parquet(loss_rates(spark, sf_dir), path)
    return tables.read_feed_parquet(spark, path)


@query
def read_feed_parquet(spark, sf_dir):
    path = shared_folder(spark, "scores")
    tables.write_feed_parquet(scores(spark, sf_dir), path)
    return tables.read_feed_parquet(spark, path)


def _publish(spark, sf_dir) -> None:
    """Star tables and KPI views in the catalog, as the daily job publishes them."""
    ingest.publish_star(stored_clean(spark, sf_dir), shared_folder(spark, "star"))
    ingest.publish_kpis(spark)


@query
def publish_table(spark, sf_dir):
    tables.publish_table(
        star.dim_customer(clean(spark, sf_dir)), "dim_customer", shared_folder(spark, "customer")
    )
    return spark.table("dim_customer")


@query
def publish_view(spark, sf_dir):
    tables.publish_view(monthly(spark, sf_dir), "vw_monthly_risk_by_region")
    return spark.table("vw_monthly_risk_by_region")


@query
def read_published(spark, sf_dir):
    _publish(spark, sf_dir)
    return tables.read_published(spark, "fact_orders")


def _metric_history(spark, sf_dir) -> DataFrame:
    """A run log with one run per region and one entry per month."""
    rates = monthly(spark, sf_dir).dropna(subset=["region_name", "year_month"])
    return rates.select(
        F.lit("late_share").alias("experiment"),
        F.col("region_name").alias("run_id"),
        F.lit("monthly").alias("run_name"),
        F.lit("metric").alias("kind"),
        F.lit("late_risk_pct").alias("key"),
        F.col("late_risk_pct").cast("string").alias("value"),
        F.col("total_orders").alias("step"),
        parse_moment(F.concat("year_month", F.lit("-01"))).alias("logged_at"),
    )


@query
def log_run_metrics(spark, sf_dir):
    path = shared_folder(spark, "runs")
    runs.log_run_metrics(_metric_history(spark, sf_dir), path)
    return runs.read_run_log(spark, path).withColumn("value", F.col("value").cast("double"))


@query
def read_run_metrics(spark, sf_dir):
    path = shared_folder(spark, "runs")
    runs.log_run_metrics(_metric_history(spark, sf_dir), path)
    return runs.read_run_metrics(runs.read_run_log(spark, path))


# A forest has no SQL. The queries below report what must hold of any sound one, found on
# all rows: SQL states the rows, keys, splits and counts, and that each claim is true.
LEAST_AUC = 0.7


def _shares(importance: DataFrame) -> DataFrame:
    total = importance.agg(F.round(F.sum("importance"), 9).alias("total"))
    return importance.crossJoin(total).select(
        "feature", F.col("importance").between(0, 1).alias("is_share"), "total"
    )


def _sound_auc(auc: DataFrame, *keep: str) -> DataFrame:
    return auc.select(*keep, F.col("auc").between(LEAST_AUC, 1).alias("is_sound"))


@query
def save_model(spark, sf_dir):
    model, rows = trained(spark, sf_dir)
    path = shared_folder(spark, "model")
    models.save_model(model, path)
    return _shares(classify.feature_importance(rows, models.load_model(path)))


@query
def load_model(spark, sf_dir):
    model, rows = trained(spark, sf_dir)
    path = shared_folder(spark, "model")
    models.save_model(model, path)
    tested = rows.filter("is_test")
    first = classify.score_late_risk(model, tested)
    again = classify.score_late_risk(models.load_model(path), tested)
    both = first.select(*LINE_KEY, "late_probability").join(
        again.select(*LINE_KEY, F.col("late_probability").alias("loaded")), LINE_KEY
    )
    same = F.bool_and(F.col("late_probability") == F.col("loaded"))
    return both.agg(F.count("*").alias("tested"), same.alias("scores_agree"))


# Profiling -----------------------------------------------------------------


@query
def profile_shape(spark, sf_dir):
    return profile.profile_shape(raw(spark, sf_dir))


@query
def profile_nulls(spark, sf_dir):
    return profile.profile_nulls(raw(spark, sf_dir))


@query
def profile_value_counts(spark, sf_dir):
    return profile.profile_value_counts(raw(spark, sf_dir), "Order Region")


@query
def profile_distinct(spark, sf_dir):
    return profile.profile_distinct(raw(spark, sf_dir), "Order Region")


@query
def profile_date_range(spark, sf_dir):
    return profile.profile_date_range(raw(spark, sf_dir), "order date (DateOrders)")


# Cleaning ------------------------------------------------------------------


@query
def clean_normalize_columns(spark, sf_dir):
    return named(spark, sf_dir)


@query
def clean_parse_dates(spark, sf_dir):
    dated = cleaning.parse_dates(named(spark, sf_dir))
    return dated.select(*LINE_KEY, "order_date", "shipping_date")


@query
def clean_lead_days(spark, sf_dir):
    dated = cleaning.parse_dates(named(spark, sf_dir))
    return cleaning.add_lead_days(dated).select(*LINE_KEY, "actual_lead_days")


@query
def clean_calendar(spark, sf_dir):
    dated = cleaning.parse_dates(named(spark, sf_dir))
    return cleaning.add_calendar(dated).select(
        *LINE_KEY, "order_year", "order_month", "order_quarter", "order_year_month"
    )


@query
def clean_late_flag(spark, sf_dir):
    return cleaning.fill_late_flag(named(spark, sf_dir)).select(*LINE_KEY, "late_delivery_risk")


@query
def clean_profit(spark, sf_dir):
    return cleaning.fill_profit(named(spark, sf_dir)).select(*LINE_KEY, "order_profit_per_order")


@query
def clean_dedup(spark, sf_dir):
    kept = cleaning.drop_repeats(named(spark, sf_dir), copies="copies")
    return kept.select(*LINE_KEY, "order_id", (F.col("copies") - 1).alias("removed"))


@query
def clean_drop_sparse(spark, sf_dir):
    return cleaning.drop_sparse(
        tables.stage(cleaning.drop_repeats(named(spark, sf_dir)), "deduplicated")
    )


@query
def clean_orders(spark, sf_dir):
    return cleaning.clean_orders(raw(spark, sf_dir))


# Quality -------------------------------------------------------------------


def _check(name):
    return lambda spark, sf_dir: quality.run_check(clean(spark, sf_dir), name)


for _key, _name in {
    "dq_no_null_order_date": "no_null_order_date",
    "dq_no_null_region": "no_null_region",
    "dq_late_risk_binary": "late_risk_binary",
    "dq_positive_sales": "positive_sales",
    "dq_reasonable_lead_days": "reasonable_lead_days",
    "dq_min_rows": "row_count_above_100k",
}.items():
    QUERIES[_key] = _check(_name)


@query
def dq_report(spark, sf_dir):
    return quality.dq_report(clean(spark, sf_dir))


@query
def dim_key_uniqueness(spark, sf_dir):
    return quality.key_uniqueness(star.dim_product(clean(spark, sf_dir)), "product_id")


# Star schema ---------------------------------------------------------------


@query
def dim_region(spark, sf_dir):
    return star.dim_region(clean(spark, sf_dir))


@query
def dim_product(spark, sf_dir):
    return star.dim_product(clean(spark, sf_dir))


@query
def dim_customer(spark, sf_dir):
    return star.dim_customer(clean(spark, sf_dir))


@query
def dim_date(spark, sf_dir):
    return star.dim_date(clean(spark, sf_dir))


@query
def fact_orders(spark, sf_dir):
    return fact(spark, sf_dir)


@query
def table_row_counts(spark, sf_dir):
    cleaned = stored_clean(spark, sf_dir)
    return star.table_row_counts(star.star_tables(cleaned))


# KPIs ----------------------------------------------------------------------


@query
def monthly_risk_by_region(spark, sf_dir):
    return monthly(spark, sf_dir)


@query
def department_kpis(spark, sf_dir):
    return departments(spark, sf_dir)


@query
def top_risk_region_months(spark, sf_dir):
    return kpi.top_risk_region_months(monthly(spark, sf_dir))


@query
def segment_risk(spark, sf_dir):
    cleaned = stored_clean(spark, sf_dir)
    return kpi.segment_risk(
        star.fact_orders(cleaned),
        star.dim_customer(cleaned),
        star.dim_product(cleaned),
        SEGMENT_REGION,
        SEGMENT_CATEGORY,
    )


# Classification ------------------------------------------------------------


@query
def encode_region(spark, sf_dir):
    return classify.encode_region(stored_keyed_fact(spark, sf_dir)).select(
        *LINE_KEY, "region_name", "region_encoded"
    )


@query
def classifier_features(spark, sf_dir):
    encoded = classify.encode_region(stored_keyed_fact(spark, sf_dir))
    return classify.classifier_features(encoded, keep=tuple(LINE_KEY))


@query
def stratified_split(spark, sf_dir):
    return classify.stratified_split(stored_keyed_fact(spark, sf_dir), LINE_KEY).select(
        *LINE_KEY, "late_risk_flag", "is_test"
    )


@query
def train_late_risk_forest(spark, sf_dir):
    model, rows = trained(spark, sf_dir)
    held_out = classify.score_late_risk(model, rows.filter("is_test"))
    return _sound_auc(classify.auc_roc(held_out, "late_probability"), "positives", "negatives")


@query
def score_late_risk(spark, sf_dir):
    model, rows = trained(spark, sf_dir)
    likely = F.col("late_probability")
    side = F.when(likely == 0.5, True).otherwise((likely > 0.5) == (F.col("predicted_late") == 1))
    return classify.score_late_risk(model, rows).select(
        *LINE_KEY, "is_test", (likely.between(0, 1) & side).alias("is_sound")
    )


@query
def auc_roc(spark, sf_dir):
    known = keyed_fact(spark, sf_dir).dropna(subset=["lead_days"])
    rated = known.withColumn("score", (F.col("lead_days") * 10 + F.col("quantity")).cast("double"))
    return classify.auc_roc(rated, "score")


@query
def cross_validated_auc(spark, sf_dir):
    return _sound_auc(classify.cross_validated_auc(model_rows(spark, sf_dir), LINE_KEY), "fold")


@query
def classification_report(spark, sf_dir):
    guess = (F.coalesce(F.col("lead_days"), F.lit(0)) >= 3).cast("int")
    return classify.classification_report(fact(spark, sf_dir).withColumn("predicted_late", guess))


@query
def feature_importance(spark, sf_dir):
    model, rows = trained(spark, sf_dir)
    return _shares(classify.feature_importance(rows, model))


# Forecast ------------------------------------------------------------------


@query
def region_series(spark, sf_dir):
    return forecast.region_series(monthly(spark, sf_dir)).select(
        "region_name", "months", F.posexplode("y").alias("position", "late_risk_pct")
    )


@query
def forecast_eligibility(spark, sf_dir):
    return forecast.forecast_eligibility(forecast.region_series(monthly(spark, sf_dir)))


@query
def arima_fit(spark, sf_dir):
    return forecast.arima_fit(forecast.region_series(monthly(spark, sf_dir)))


@query
def forecast_risk_by_region(spark, sf_dir):
    return forecasts(spark, sf_dir)


@query
def forecast_failures(spark, sf_dir):
    """Every third region is given a last value that is no number."""
    series = forecast.region_series(monthly(spark, sf_dir))
    third = F.substring_index("region_name", "_", -1).cast("int") % 3 == 0
    broken = F.concat(F.slice("y", 1, F.size("y") - 1), F.array(F.lit(float("nan"))))
    damaged = series.withColumn("y", F.when(third, broken).otherwise(F.col("y")))
    return forecast.forecast_failures(forecast.arima_fit(damaged))


# Anomalies -----------------------------------------------------------------


@query
def anomaly_features(spark, sf_dir):
    return anomaly.anomaly_features(fact(spark, sf_dir))


@query
def isolation_forest_fit(spark, sf_dir):
    orders = stored_keyed_fact(spark, sf_dir)
    grown, _ = anomaly.isolation_forest_trees(orders, key=LINE_KEY)
    splits = F.size(F.filter("threshold", lambda t: t < F.lit(float("inf"))))
    return grown.select(
        "tree",
        F.size("threshold").alias("nodes"),
        (splits.between(8, 255) & (F.array_max("path") >= 8)).alias("is_sound"),
    )


@query
def isolation_forest_score(spark, sf_dir):
    orders = stored_keyed_fact(spark, sf_dir)
    forest = anomaly.isolation_forest_fit(orders, key=LINE_KEY)
    score = F.col("anomaly_score")
    return anomaly.isolation_forest_score(orders, forest).select(
        *LINE_KEY, score.isNotNull().alias("has_score"), ((score > 0) & (score <= 1)).alias("is_sound")
    )


def _loss_size(spark, sf_dir) -> DataFrame:
    return keyed_fact(spark, sf_dir).select(
        *LINE_KEY,
        "order_id",
        "year_month",
        "region_name",
        F.when(F.col("lead_days").isNotNull(), -F.col("profit")).alias("anomaly_score"),
    )


@query
def flag_anomalies(spark, sf_dir):
    stored = tables.stage(_loss_size(spark, sf_dir), "scored")
    return anomaly.flag_anomalies(stored).select(*LINE_KEY, "anomaly_score", "is_anomaly")


@query
def anomaly_summary(spark, sf_dir):
    return anomaly.anomaly_summary(
        anomaly.flag_anomalies(tables.stage(_loss_size(spark, sf_dir), "scored"))
    )


@query
def attach_anomaly_flag(spark, sf_dir):
    """Orders of the operator whose flag says what their score is above; the score itself
    has no SQL, so the flag is reported as right or wrong."""
    orders = stored_keyed_fact(spark, sf_dir)
    forest = anomaly.isolation_forest_fit(orders, key=LINE_KEY)
    flagged = anomaly.attach_anomaly_flag(orders, forest, 0.5)
    right = F.col("is_anomaly").eqNullSafe((F.col("anomaly_score") > 0.5).cast("int"))
    return flagged.select(
        *LINE_KEY,
        "order_id",
        F.col("is_anomaly").isNotNull().alias("has_flag"),
        (right & F.coalesce(F.col("anomaly_score").between(0, 1), F.lit(True))).alias("flag_is_right"),
    )


@query
def monthly_anomaly_rate(spark, sf_dir):
    return anomaly.monthly_anomaly_rate(
        anomaly.flag_anomalies(tables.stage(_loss_size(spark, sf_dir), "scored"))
    )


# Risk score ----------------------------------------------------------------


@query
def join_anomaly_rate(spark, sf_dir):
    return score.join_anomaly_rate(*rated_months(spark, sf_dir))


@query
def minmax_normalize(spark, sf_dir):
    return score.minmax_normalize(
        tables.stage(monthly(spark, sf_dir), "monthly"), {"late_risk_pct": "late_risk_norm", "total_sales": "sales_norm"}
    ).select("year_month", "region_name", "late_risk_norm", "sales_norm")


@query
def disruption_score(spark, sf_dir):
    return scores(spark, sf_dir).select("year_month", "region_name", "disruption_score")


@query
def risk_tier(spark, sf_dir):
    return scores(spark, sf_dir).groupBy("risk_tier").agg(F.count("*").alias("region_months"))


@query
def build_risk_scores(spark, sf_dir):
    return scores(spark, sf_dir)


@query
def top_risk_scores(spark, sf_dir):
    return score.top_risk_scores(scores(spark, sf_dir))


# Dashboard tables ----------------------------------------------------------


@query
def filter_options(spark, sf_dir):
    return feeds.filter_options(scores(spark, sf_dir))


@query
def filter_risk_scores(spark, sf_dir):
    return selected_scores(spark, sf_dir)


@query
def kpi_cards(spark, sf_dir):
    return feeds.kpi_cards(selected_scores(spark, sf_dir))


@query
def risk_trend(spark, sf_dir):
    return feeds.risk_trend(selected_scores(spark, sf_dir))


@query
def risk_matrix(spark, sf_dir):
    stored = tables.stage(scores(spark, sf_dir), "scores")
    regions = stored.select("region_name").dropna().distinct().orderBy("region_name")
    return feeds.risk_matrix(stored, [r["region_name"] for r in regions.collect()])


@query
def latest_risk_by_region(spark, sf_dir):
    return feeds.latest_risk_by_region(selected_scores(spark, sf_dir))


@query
def late_trend(spark, sf_dir):
    return feeds.late_trend(selected_scores(spark, sf_dir))


@query
def anomaly_rate_by_region(spark, sf_dir):
    return feeds.anomaly_rate_by_region(selected_scores(spark, sf_dir))


@query
def forecast_for_region(spark, sf_dir):
    return feeds.forecast_for_region(forecasts(spark, sf_dir), REGION)


@query
def forecast_bands(spark, sf_dir):
    return feeds.forecast_bands(forecasts(spark, sf_dir))


@query
def department_performance(spark, sf_dir):
    return feeds.department_performance(departments(spark, sf_dir))


# Questions -----------------------------------------------------------------


@query
def adhoc_sql(spark, sf_dir):
    _publish(spark, sf_dir)
    return adhoc.adhoc_sql(
        spark,
        """
        SELECT c.segment, p.category_name, COUNT(*) AS order_lines,
               SUM(f.late_risk_flag) AS late_lines
        FROM fact_orders f
        JOIN dim_customer c ON f.customer_id = c.customer_id
        JOIN dim_product p ON f.product_id = p.product_id
        GROUP BY c.segment, p.category_name
        """,
    ).result


@query
def q_highest_avg_score_region(spark, sf_dir):
    return feeds.highest_avg_score_region(scores(spark, sf_dir))


@query
def q_months_most_anomalies(spark, sf_dir):
    return feeds.months_most_anomalies(loss_rates(spark, sf_dir))


@query
def q_department_most_profit(spark, sf_dir):
    return feeds.department_most_profit(departments(spark, sf_dir))


@query
def q_region_late_trend(spark, sf_dir):
    return feeds.region_late_trend(monthly(spark, sf_dir), REGION)
