"""Published tables to classifier, forecasts, anomalies and risk scores."""

from __future__ import annotations

import datetime
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import anomaly, classify, forecast, score
from ..operators.forest import Forest
from ..session import fit_partitions
from ..sources import models, runs, tables
from .ingest import MONTHLY_VIEW

# Names under which runs are logged.
EXPERIMENT = "late_delivery_risk"
RUN_NAME = "random_forest_v1"

# Integer columns that tell order lines apart when they are drawn into samples.
SPLIT_KEY = ["order_id", "product_id", "customer_id", "quantity"]


@dataclass(frozen=True)
class Learned:
    model: Forest
    report: DataFrame
    importance: DataFrame
    forecasts: DataFrame
    skipped_regions: DataFrame
    failed_regions: DataFrame
    anomalies: DataFrame
    scores: DataFrame


def classify_orders(fact: DataFrame, home: str, split_key: list[str], trees: int, folds: int):
    """Train, evaluate, log and save the late-delivery classifier."""
    spark = fact.sparkSession
    features = classify.classifier_features(
        classify.encode_region(fact), keep=tuple(c for c in split_key if c not in classify.FEATURES)
    )
    split = classify.stratified_split(tables.stage(features, "features"), split_key)
    rows = tables.stage(split, "model-rows")
    model = classify.train_late_risk_forest(rows.filter(~F.col("is_test")), trees=trees, key=split_key)
    tested = tables.stage(
        classify.score_late_risk(model, rows.filter(F.col("is_test"))), "tested"
    )
    metrics = {"auc_test": classify.auc_roc(tested, "late_probability").first()["auc"]}
    if folds:
        per_fold = classify.cross_validated_auc(rows, split_key, folds, trees=trees)
        metrics["auc_cv"] = per_fold.agg(F.avg("auc")).first()[0]
    entry = runs.run_rows(
        spark,
        EXPERIMENT,
        uuid.uuid4().hex,
        RUN_NAME,
        datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None),
        params={"n_estimators": trees, "max_depth": classify.DEPTH},
        metrics={k: v for k, v in metrics.items() if v is not None},
    )
    runs.log_run_metrics(entry, f"{home}/runs")
    models.save_model(model, f"{home}/late_risk_model")
    return model, classify.classification_report(tested), classify.feature_importance(rows, model)


def detect_anomalies(fact: DataFrame, trees: int = anomaly.TREES) -> DataFrame:
    """Monthly anomaly rates. Scores are stored once, as the threshold reads them again."""
    needed = ["order_id", "year_month", "region_name", *anomaly.FEATURES]
    forest = anomaly.isolation_forest_fit(fact, trees=trees, key=SPLIT_KEY)
    scored = tables.stage(
        anomaly.isolation_forest_score(fact.select(*needed), forest).drop(*anomaly.FEATURES),
        "scored",
    )
    return anomaly.monthly_anomaly_rate(anomaly.flag_anomalies(scored))


def learn(
    spark: SparkSession,
    home: str,
    trees: int = classify.TREES,
    folds: int = classify.FOLDS,
    split_key: list[str] = SPLIT_KEY,
) -> Learned:
    """The three branches share only the published tables and meet in the score.

    All results are stored below ``home``; what is staged on the way is deleted.
    """
    fact = tables.read_published(spark, "fact_orders")
    fit_partitions(fact)
    with tables.scratch(spark):
        return _learn(spark, fact, home.rstrip("/"), trees, folds, split_key)


def _learn(
    spark: SparkSession, fact: DataFrame, home: str, trees: int, folds: int, split_key: list[str]
) -> Learned:
    monthly = tables.stage(tables.read_published(spark, MONTHLY_VIEW), "monthly")
    model, report, importance = classify_orders(fact, home, split_key, trees, folds)

    series = forecast.region_series(monthly)
    fits = tables.stage(forecast.arima_fit(series), "fits")
    eligibility = forecast.forecast_eligibility(series)

    feeds = {
        "forecasts": forecast.forecast_from_fit(fits),
        "anomalies": detect_anomalies(fact),
    }
    for name, df in feeds.items():
        tables.write_feed_parquet(df, f"{home}/{name}")
        feeds[name] = tables.read_feed_parquet(spark, f"{home}/{name}", df.schema)
    # The feeds the scores are made of are stored by now; these are small tables.
    results = {
        "report": report,
        "importance": importance,
        "skipped_regions": eligibility.filter(~F.col("is_eligible")),
        "failed_regions": forecast.forecast_failures(fits),
        "risk_scores": score.build_risk_scores(monthly, feeds["anomalies"]),
    }
    for name, df in results.items():
        tables.write_feed_parquet(df, f"{home}/{name}")
        results[name] = tables.read_feed_parquet(spark, f"{home}/{name}", df.schema)
    return Learned(
        model=model,
        report=results["report"],
        importance=results["importance"],
        forecasts=feeds["forecasts"],
        skipped_regions=results["skipped_regions"],
        failed_regions=results["failed_regions"],
        anomalies=feeds["anomalies"],
        scores=results["risk_scores"],
    )
