"""What the operators of this subpackage share: tables, shared scratch, files, id hashes."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import shared_folder

# Rows in one Arrow batch. Texts can be long, so a worker holds few of them at a time.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write below the shared checkpoint folder and read again.

    The rows outlive the executors that made them, and what is read later does not
    run the plan again.
    """
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete a staged copy that no later plan reads: its folder as a whole."""
    spark = df.sparkSession
    jvm = spark._jvm
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def held_out(key: Column) -> Column:
    """True for the fifth of all rows that no model learns labels from; a null key counts as ''."""
    return (F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 5) == 0


def share_of(*parts: Column) -> Column:
    """A number in [0, 1) drawn from the md5 of the parts, the same wherever it is computed."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def file_system(folder: str):
    """pyarrow's file system for a folder that Spark names by a URI or a path."""
    from pyarrow import fs

    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


def fresh_file(folder: str, suffix: str) -> str:
    """A file name no other attempt of any task uses; only files named in a written
    manifest count, so what a lost attempt leaves behind is never read."""
    import uuid

    return f"{folder.rstrip('/')}/{uuid.uuid4().hex}{suffix}"


def per_file(manifest: DataFrame) -> DataFrame:
    """Deal the rows of a file list out, so that each task opens few files."""
    files = manifest.count()
    return manifest.repartition(max(1, min(files, 10_000)), "path")


def rows_of(batches: Iterator, columns: list[str]) -> Iterator[tuple]:
    """The rows of Arrow batches, integers exact and nulls as None."""
    for batch in batches:
        yield from zip(*[batch.column(c).to_pylist() for c in columns])


ARROW = {
    "int": "int32", "long": "int64", "double": "float64", "boolean": "bool",
    "string": "string", "binary": "binary",
}


def batch_of(rows: list[tuple], schema: str):
    """An Arrow batch of rows, under a schema in Spark's words: "name type, ...",
    where a type is a name of ``ARROW`` or array<name>."""
    import pyarrow as pa

    fields = []
    for part in schema.split(", "):
        name, kind = part.split(" ")
        inner = kind.removeprefix("array<").rstrip(">")
        found = pa.type_for_alias(ARROW[inner])
        fields.append((name, pa.list_(found) if inner != kind else found))
    columns = list(zip(*rows)) or [()] * len(fields)
    arrays = [pa.array(list(c), type=t) for c, (_, t) in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def give_back() -> None:
    """Return what a task has freed to the system: idle workers keep it otherwise, beside
    the workers and the heap of the next stage."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library than glibc
        return


def batches_of(rows: Iterator[tuple], schema: str, size: int = 10_000) -> Iterator:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield batch_of(held, schema)
            held = []
    if held:
        yield batch_of(held, schema)
    give_back()
