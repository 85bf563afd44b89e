"""The daily run as a file stream: new order files in, refreshed months out.

``trigger(availableNow=True)`` processes the files that have arrived since the
last run and stops; the stream's checkpoint remembers which ones. Rows are kept
raw, by batch and month. A month that receives rows is cleaned again from all its
raw rows and replaces its part of the published tables, so copies that arrive on
different days are still found, and a batch that is run twice changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.moments import month_label, parse_moment
from ..functions.names import snake_names
from ..operators import clean as cleaning
from ..plans import dashboard, ingest, learn
from ..sources import tables, versions
from ..sources.orders_csv import blank_to_null

MONTH = "raw_month"
SEEDED = -1


def order_file_stream(
    spark: SparkSession, landing: str, columns: list[str], files_per_batch: int = 1000
) -> DataFrame:
    """CSV files of a landing folder, every column text.

    ``columns`` are the raw names; a file with another header fails the run.
    """
    layout = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    stream = (
        spark.readStream.schema(layout)
        .option("header", True)
        .option("encoding", "ISO-8859-1")
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(landing)
    )
    return blank_to_null(stream).toDF(*snake_names(columns))


def month_of(raw: DataFrame) -> DataFrame:
    return raw.withColumn(MONTH, month_label(parse_moment(F.col("order_date_dateorders"))))


def refresh_months(raw: DataFrame, months: list[str | None], star_folder: str) -> None:
    """Rebuild the given months of the published tables from their raw rows."""
    wanted = F.col(MONTH).isin([m for m in months if m is not None])
    if None in months:
        wanted = wanted | F.col(MONTH).isNull()
    with tables.scratch(raw.sparkSession):
        cleaned = tables.stage(cleaning.tidy_rows(raw.filter(wanted).drop("batch", MONTH)), "months")
        ingest.refresh_star(cleaned, months, star_folder)
    ingest.publish_kpis(raw.sparkSession)


def seed(raw: DataFrame, home: str) -> None:
    """Keep the raw rows of a first ``ingest`` as batch -1, so that days that bring rows of
    its months find them; needed before the first daily run on such a home. Values are kept
    as text, as files have them."""
    named = raw.select(*[F.col(f"`{c}`").cast("string") for c in raw.columns]).toDF(*snake_names(raw.columns))
    rows = month_of(named).withColumn("batch", F.lit(SEEDED).cast("long"))
    tables.replace_partitions(rows, f"{home.rstrip('/')}/raw", ["batch", MONTH])


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def run_daily(
    spark: SparkSession,
    landing: str,
    home: str,
    columns: list[str],
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Start the run; ``awaitTermination()`` returns when all new files are in.

    The months that get rows change in the published star tables and KPI views, the same
    that ``ingest`` publishes below ``home``; all others keep their files. Where ``ingest``
    has published, its rows must have been handed to ``seed`` once.
    """
    home = home.rstrip("/")
    folder = f"{home}/star"
    if versions.manifests(spark, folder, ingest.FACT) and not _exists(spark, f"{home}/raw"):
        raise ValueError("orders are published here whose raw rows are not kept: call daily.seed first")

    def take_in(batch: DataFrame, number: int) -> None:
        dated = month_of(batch).withColumn("batch", F.lit(number).cast("long"))
        tables.replace_partitions(dated, f"{home}/raw", ["batch", MONTH])
        # A calendar's months, not rows: short whatever the size of the batch.
        stored = spark.read.schema(dated.schema).parquet(f"{home}/raw")
        touched = stored.filter(F.col("batch") == number).select(MONTH).distinct().collect()
        if touched:
            refresh_months(stored, [r[MONTH] for r in touched], folder)

    return (
        order_file_stream(spark, landing, columns, files_per_batch)
        .writeStream.foreachBatch(take_in)
        .option("checkpointLocation", f"{home}/stream-state")
        .trigger(availableNow=True)
        .start()
    )


def run_day(
    spark: SparkSession, landing: str, home: str, columns: list[str], files_per_batch: int = 1000, **settings
) -> learn.Learned:
    """The whole daily job: new files, then model, forecasts, anomalies and risk scores over
    the tables they changed, then the feeds for SQL. ``settings`` are those of ``learn``."""
    run_daily(spark, landing, home, columns, files_per_batch).awaitTermination()
    learned = learn.learn(spark, home, **settings)
    dashboard.publish_feeds(spark, home)
    return learned
