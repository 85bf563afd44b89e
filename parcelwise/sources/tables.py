"""Parquet folders, published tables and views."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_folder
from . import versions

# Parquet files shrink by a quarter against the default, and reading them needs no setting.
COMPRESSION = "zstd"
# Folders a task writes into side by side; rows of more folders are sorted first.
OPEN_FOLDERS = 64


def _balanced(df: DataFrame, keys: list[str]) -> DataFrame:
    """Bring rows of one output folder together before the write.

    Without it each task writes a file into each folder. The rebalance hint lets
    AQE split a folder that holds a large share of the rows over several tasks.
    """
    return df.hint("rebalance", *keys) if keys else df


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite a whole folder."""
    keys = partition_by or []
    writer = _balanced(df, keys).write.mode("overwrite").option("partitionOverwriteMode", "static")
    if keys:
        writer = writer.partitionBy(*keys)
    writer.parquet(path)


def write_clean_parquet(df: DataFrame, path: str) -> None:
    """Overwrite the cleaned orders, a folder per year.

    Years are few and the rows come in balanced tasks, so each task writes its own files of
    all its years, some side by side: the widest table is neither shuffled nor sorted again.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    conf = df.sparkSession.conf
    before = conf.get(name)
    conf.set(name, str(OPEN_FOLDERS))
    try:
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.option("compression", COMPRESSION).partitionBy("order_year").parquet(path)
    finally:
        conf.set(name, before)


def write_feed_parquet(df: DataFrame, path: str) -> None:
    write_parquet(df, path)


def read_feed_parquet(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Overwrite only the partitions present in ``df``; running it twice changes nothing."""
    (
        _balanced(df, partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def publish_table(
    df: DataFrame,
    name: str,
    folder: str | None = None,
    partition_by: list[str] | None = None,
    dealt: bool = False,
) -> None:
    """Create or replace a catalog table in one step, kept under ``folder`` (the warehouse
    unless given): readers see the old version until the new one is whole, and a write that
    fails leaves the old one. ``partition_by`` names one column at most; ``dealt`` says that
    the rows lie together by it already."""
    keys = partition_by or []
    if len(keys) > 1:
        raise ValueError("published tables are partitioned by one column")
    folder = folder or df.sparkSession.conf.get("spark.sql.warehouse.dir")
    versions.publish(df, name, folder, keys[0] if keys else None, dealt)


def publish_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def read_published(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what was staged inside once the block ends: nothing that leaves it may read it."""
    paths: list[str] = []
    token = _staged.set(paths)
    try:
        yield
    finally:
        _staged.reset(token)
        for name in paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Store an intermediate result read more than once, and go on from the stored copy.

    The copy is in the shared folder, so losing an executor does not lose it. Inside
    ``scratch`` it is deleted at the end, else with that folder.
    """
    spark = df.sparkSession
    path = shared_folder(spark, label)
    if (paths := _staged.get()) is not None:
        paths.append(path)
    df.write.option("compression", COMPRESSION).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
