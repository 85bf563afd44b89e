"""Run log: parameters and metrics of training runs, one row per entry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

RUN_SCHEMA = (
    "experiment string, run_id string, run_name string, kind string, "
    "key string, value string, step bigint, logged_at timestamp_ntz"
)


def run_rows(
    spark: SparkSession,
    experiment: str,
    run_id: str,
    run_name: str,
    logged_at,
    params: dict | None = None,
    metrics: dict | None = None,
    step: int = 0,
) -> DataFrame:
    entries = [("param", k, str(v)) for k, v in (params or {}).items()]
    entries += [("metric", k, repr(float(v))) for k, v in (metrics or {}).items()]
    return spark.createDataFrame(
        [(experiment, run_id, run_name, kind, k, v, step, logged_at) for kind, k, v in entries],
        RUN_SCHEMA,
    )


def log_run_metrics(rows: DataFrame, path: str) -> None:
    """Append entries. Earlier ones are kept, so the folder is the full history."""
    fields = [f.split()[0] for f in RUN_SCHEMA.split(", ")]
    rows.select(*fields).write.mode("append").parquet(path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def read_run_metrics(log: DataFrame) -> DataFrame:
    """The latest value of every metric of every run."""
    newest = F.struct("logged_at", "step", F.col("value").try_cast("double").alias("value"))
    return (
        log.filter(F.col("kind") == "metric")
        .groupBy("experiment", "run_id", "key")
        .agg(F.max(newest).alias("last"), F.count("*").alias("entries"))
        .select(
            "experiment",
            "run_id",
            "key",
            F.col("last.value").cast("double").alias("value"),
            F.col("last.step").alias("step"),
            "entries",
        )
    )
