"""Stored feeds to the tables a dashboard shows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import feeds
from ..sources import tables
from .ingest import DEPARTMENT_VIEW


def publish_feeds(spark: SparkSession, home: str) -> None:
    """Make the stored feeds available to SQL beside the star tables."""
    for name in ("risk_scores", "forecasts", "anomalies"):
        tables.publish_view(tables.read_feed_parquet(spark, f"{home.rstrip('/')}/{name}"), name)


def dashboard_feed(
    spark: SparkSession,
    home: str,
    regions: list[str] | None = None,
    months: tuple[str, str] | None = None,
    tiers: tuple[str, ...] = tuple(feeds.TIER_COLOURS),
) -> dict[str, DataFrame]:
    """Every table for one setting of the filters; unset filters take their defaults.

    The filters reach the parquet scan. The scores have one row per region and
    month, so keeping the selection in memory for its readers is cheap.
    """
    scores = tables.read_feed_parquet(spark, f"{home.rstrip('/')}/risk_scores")
    forecasts = tables.read_feed_parquet(spark, f"{home.rstrip('/')}/forecasts")
    options = feeds.filter_options(scores)
    if regions is None or months is None:
        defaults = options.filter("is_default").collect()
        preset = sorted(r["choice"] for r in defaults if r["filter"] == "month")
        if regions is None:
            regions = [r["choice"] for r in defaults if r["filter"] == "region"]
        if months is None:
            months = (preset[0], preset[-1]) if preset else ("", "")
    chosen = feeds.filter_risk_scores(scores, regions, *months, tiers).persist()
    return {
        "filter_options": options,
        "risk_scores": chosen,
        "kpi_cards": feeds.kpi_cards(chosen),
        "risk_trend": feeds.risk_trend(chosen),
        "risk_matrix": feeds.risk_matrix(chosen, regions),
        "latest_risk": feeds.latest_risk_by_region(chosen),
        "late_trend": feeds.late_trend(chosen),
        "anomaly_rate": feeds.anomaly_rate_by_region(chosen),
        "forecast_regions": feeds.forecast_regions(forecasts),
        "forecast_bands": feeds.forecast_bands(forecasts),
        "departments": feeds.department_performance(spark.table(DEPARTMENT_VIEW)),
    }
