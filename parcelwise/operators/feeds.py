"""Tables behind the dashboard's controls and charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import exact_avg, money_sum
from .score import HIGH_FROM, MEDIUM_FROM

# Chart colours of the tiers, and the tiers in display order.
TIER_COLOURS = {"High": "#E24B4A", "Medium": "#EF9F27", "Low": "#639922"}
DEFAULT_REGIONS = 5


def filter_options(scores: DataFrame) -> DataFrame:
    """Choices of the two filters, with the preselected ones marked: the first regions by
    name, and the first and the last month. Values stay rows, however many there are."""
    regions = scores.select("region_name").dropna().distinct()
    first = regions.orderBy("region_name").limit(DEFAULT_REGIONS)
    first = first.withColumn("is_default", F.lit(True))
    months = scores.select("year_month").dropna().distinct()
    ends = months.agg(F.array(F.min("year_month"), F.max("year_month")).alias("ends"))
    ends = ends.select(F.explode(F.array_distinct("ends")).alias("year_month"))
    ends = ends.withColumn("is_default", F.lit(True))

    def choices(name: str, column: str, values: DataFrame, chosen: DataFrame) -> DataFrame:
        return values.join(chosen, column, "left").select(
            F.lit(name).alias("filter"),
            F.col(column).alias("choice"),
            F.coalesce("is_default", F.lit(False)).alias("is_default"),
        )

    options = choices("region", "region_name", regions, first).unionByName(
        choices("month", "year_month", months, ends)
    )
    return options.orderBy(F.desc("filter"), "choice")


def filter_risk_scores(
    scores: DataFrame,
    regions: list[str],
    first_month: str,
    last_month: str,
    tiers: tuple[str, ...] = tuple(TIER_COLOURS),
) -> DataFrame:
    return scores.filter(
        F.col("region_name").isin(list(regions))
        & F.col("year_month").between(first_month, last_month)
        & F.col("risk_tier").isin(list(tiers))
    )


def kpi_cards(scores: DataFrame) -> DataFrame:
    return scores.agg(
        exact_avg("disruption_score").alias("avg_disruption_score"),
        F.count_if(F.col("risk_tier") == "High").alias("high_risk_periods"),
        exact_avg("late_risk_pct").alias("avg_late_risk_pct"),
        money_sum("total_sales").alias("total_sales"),
        exact_avg("avg_lead_days").alias("avg_lead_days"),
    )


def risk_trend(scores: DataFrame) -> DataFrame:
    """Mean score of each month and region; missing keys and means are left out."""
    return (
        scores.dropna(subset=["year_month", "region_name"])
        .groupBy("year_month", "region_name")
        .agg(exact_avg("disruption_score").alias("disruption_score"))
        .dropna()
    )


def risk_matrix(scores: DataFrame, regions: list[str]) -> DataFrame:
    """Months down, regions across; the list of regions spares Spark a job to find it."""
    return (
        scores.dropna(subset=["year_month"])
        .groupBy("year_month")
        .pivot("region_name", regions)
        .agg(exact_avg("disruption_score"))
    )


def latest_risk_by_region(scores: DataFrame) -> DataFrame:
    newest = scores.agg(F.max("year_month").alias("newest")).scalar()
    return (
        scores.filter(F.col("year_month") == newest)
        .select("year_month", "region_name", "disruption_score", "risk_tier")
        .orderBy(F.asc_nulls_last("disruption_score"), F.asc_nulls_last("region_name"))
    )


def late_trend(scores: DataFrame) -> DataFrame:
    return (
        scores.dropna(subset=["year_month"])
        .groupBy("year_month")
        .agg(exact_avg("late_risk_pct").alias("late_risk_pct"))
        .orderBy("year_month")
    )


def anomaly_rate_by_region(scores: DataFrame) -> DataFrame | None:
    """Mean anomaly rate of each region; None while no anomalies have been computed."""
    if "anomaly_rate_pct" not in scores.columns:
        return None
    return (
        scores.dropna(subset=["region_name"])
        .groupBy("region_name")
        .agg(exact_avg("anomaly_rate_pct").alias("anomaly_rate_pct"))
        .orderBy(F.desc_nulls_last("anomaly_rate_pct"), "region_name")
    )


def forecast_regions(forecasts: DataFrame) -> DataFrame:
    """Regions with a forecast, in name order: the choices of the chart's selector."""
    return forecasts.select("region_name").distinct().orderBy("region_name")


def forecast_for_region(forecasts: DataFrame, region: str) -> DataFrame:
    return forecasts.filter(F.col("region_name") == region).orderBy("forecast_step")


def _colour(value: Column) -> Column:
    return (
        F.when(value >= HIGH_FROM, TIER_COLOURS["High"])
        .when(value >= MEDIUM_FROM, TIER_COLOURS["Medium"])
        .otherwise(TIER_COLOURS["Low"])
    )


def forecast_bands(forecasts: DataFrame) -> DataFrame:
    """Error widths above and below each forecast, and its colour."""
    risk = F.col("predicted_risk")
    return forecasts.select(
        "region_name",
        "forecast_step",
        "forecast_month",
        "predicted_risk",
        (F.col("upper_bound") - risk).alias("error_up"),
        (risk - F.col("lower_bound")).alias("error_down"),
        _colour(risk).alias("colour"),
    )


def department_performance(departments: DataFrame) -> DataFrame:
    return (
        departments.dropna(subset=["department_name"])
        .groupBy("department_name")
        .agg(
            money_sum("total_sales").alias("total_sales"),
            money_sum("total_profit").alias("total_profit"),
            exact_avg("late_risk_pct").alias("late_risk_pct"),
        )
        .orderBy(F.desc_nulls_last("total_sales"), "department_name")
    )


def highest_avg_score_region(scores: DataFrame) -> DataFrame:
    return (
        scores.groupBy("region_name")
        .agg(exact_avg("disruption_score").alias("avg_disruption_score"))
        .orderBy(F.desc_nulls_last("avg_disruption_score"), F.asc_nulls_last("region_name"))
        .limit(1)
    )


def months_most_anomalies(anomalies: DataFrame) -> DataFrame:
    return (
        anomalies.groupBy("year_month")
        .agg(F.sum("anomaly_count").alias("anomalies"))
        .orderBy(F.desc_nulls_last("anomalies"), F.asc_nulls_last("year_month"))
    )


def department_most_profit(departments: DataFrame) -> DataFrame:
    return (
        departments.groupBy("department_name")
        .agg(money_sum("total_profit").alias("total_profit"))
        .orderBy(F.desc_nulls_last("total_profit"), F.asc_nulls_last("department_name"))
        .limit(1)
    )


def region_late_trend(monthly: DataFrame, region: str) -> DataFrame:
    return (
        monthly.filter(F.col("region_name") == region)
        .select("year_month", "late_risk_pct")
        .orderBy(F.asc_nulls_last("year_month"))
    )
