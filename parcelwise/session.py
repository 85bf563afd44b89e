"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on, at any size.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Small inputs are split over all cores, too; large splits keep their size.
    "spark.sql.files.openCostInBytes": "524288",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Keys and numbers are shuffled and names join them behind it, so a task's rows are many
    # times what it reads: what removes copies holds them all.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when a later step then has to shuffle again.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # The JVM never compiles a method above 8000 bytes of code, and wide rows make such methods
    # of a whole stage; Spark then generates each operator's code by itself.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


MB = 1024**2


def sizing(input_bytes: float) -> dict[str, str]:
    """Partition sizes for an input of this many bytes.

    Of compressed input, 8 MB per shuffle partition are a few hundred thousand wide rows,
    which fit an executor core's memory; AQE merges what turns out small. From 2000
    partitions on they grow up to half a gigabyte, as the number of shuffle blocks is
    splits times shuffle partitions. Input splits grow with the input, too.
    """
    partitions = max(int(input_bytes / (512 * MB)), min(int(input_bytes / (8 * MB)), 2000), 200)
    split = max(int(input_bytes / 200_000), 128 * MB)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(split),
    }


def build_session(
    app: str = "parcelwise",
    master: str | None = None,
    input_bytes: float | None = None,
    **extra,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sized = sizing(input_bytes) if input_bytes else {}
    for key, value in {**SETTINGS, **sized, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession, input_bytes: float | None = None) -> SparkSession:
    """Give the same settings, and sizes if the input's is told, to a session built elsewhere."""
    sized = sizing(input_bytes) if input_bytes else {}
    for key, value in {**SETTINGS, **sized}.items():
        spark.conf.set(key, value)
    return spark


def fit_partitions(df: DataFrame) -> None:
    """Raise the session's shuffle partitions and splits to what the files of ``df`` need."""
    spark = df.sparkSession
    size = input_size(df)
    if size < 200 * 8 * MB:
        return
    for key, value in sizing(size).items():
        # Without a default of ours, which Spark would check like a value that is set.
        now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
        if now < int(value):
            spark.conf.set(key, value)


def input_size(df: DataFrame) -> int:
    """Bytes of the files a frame reads."""
    spark = df.sparkSession
    total = 0
    for file in df.inputFiles():
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        total += system.getFileStatus(path).getLen()
    return total


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder below the cluster's ``spark.checkpoint.dir``.

    Every executor must reach it, so a machine-local folder is accepted only
    when the session itself is local (tests, one-machine trials).
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="parcelwise-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
