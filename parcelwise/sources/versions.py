"""Published tables as versions: written beside the old one, then swapped in one step.

A version is a set of parts, each a folder of parquet files: one part for a plain table,
one per value for a table partitioned by a column. A new version is written into folders
of its own and listed in a manifest; parts that did not change are listed where they are.
Two steps make it the current one, each a single change: the manifest gets its name by a
rename, and the published name, a view, is pointed at the version's table. Until then
readers see the old version as a whole, and a job lost at any point before leaves it as it
was. A query that has begun on an old version can end: the ``KEEP`` versions before the
current one stay, with all their files, and files go when no version lists them.

    <folder>/<name>/_manifests/<version>.json    value -> part folder
    <folder>/<name>/<version>/...                the parts this version wrote

One writer per table is assumed, any number of readers. A session with another catalog
gets the newest version by ``attach``.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, types as T

# Versions kept behind the current one.
KEEP = 2
# Fixed value: how Spark names the folder of the null value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Version:
    id: str
    schema: T.StructType
    partition_by: str | None
    parts: dict[str | None, str]  # partition value (None: null) -> folder; a plain table has one

    def text(self) -> str:
        return json.dumps({
            "id": self.id, "schema": self.schema.jsonValue(), "partition_by": self.partition_by,
            "parts": list(self.parts.items()),
        })

    @staticmethod
    def read(text: str) -> "Version":
        found = json.loads(text)
        schema = T.StructType.fromJson(found["schema"])
        return Version(found["id"], schema, found["partition_by"], {v: p for v, p in found["parts"]})


def _root(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name.split('.')[-1]}"


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, folder: str) -> None:
    path, system = _path(spark, folder)
    system.delete(path, True)


def manifests(spark: SparkSession, folder: str, name: str) -> list[Version]:
    """All versions that were completed, the newest last. Their number is bounded by KEEP."""
    path, system = _path(spark, f"{_root(folder, name)}/_manifests")
    if not system.exists(path):
        return []
    files = [s.getPath().toString() for s in system.listStatus(path) if s.getPath().getName().endswith(".json")]
    if not files:
        return []
    texts = spark.read.option("wholetext", True).text(files).collect()
    return sorted((Version.read(r[0]) for r in texts), key=lambda v: v.id)


def _commit(spark: SparkSession, root: str, version: Version) -> None:
    """Give the manifest its name once it is whole."""
    draft, system = _path(spark, f"{root}/_manifests/{version.id}.draft")
    out = system.create(draft, True)
    out.write(bytearray(version.text().encode()))
    out.close()
    final, _ = _path(spark, f"{root}/_manifests/{version.id}.json")
    if not system.rename(draft, final):
        raise OSError(f"could not publish {final}")


def version_table(name: str, version: Version) -> str:
    return f"{name}__{version.id}"


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _register(spark: SparkSession, root: str, name: str, version: Version) -> None:
    """A catalog table over the version's parts, and the published name on top of it."""
    table = _quoted(version_table(name, version))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in version.schema.fields)
    if version.partition_by is None:
        (place,) = version.parts.values()
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet LOCATION {_literal(place)}")
    else:
        key = version.partition_by
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet PARTITIONED BY (`{key}`) "
            f"LOCATION {_literal(f'{root}/{version.id}')}"
        )
        clauses = [
            f"PARTITION (`{key}` = {'NULL' if value is None else _literal(value)}) LOCATION {_literal(place)}"
            for value, place in version.parts.items()
        ]
        for start in range(0, len(clauses), 500):
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(clauses[start : start + 500]))
    # A plain table of this name, from before versions, makes way for the view.
    if any(t.name == name.split(".")[-1] and t.tableType in ("MANAGED", "EXTERNAL") for t in _tables(spark, name)):
        spark.sql(f"DROP TABLE {_quoted(name)}")
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(name)} AS SELECT * FROM {table}")


def _tables(spark: SparkSession, name: str):
    *database, pattern = name.split(".")
    return spark.catalog.listTables(".".join(database) or None, pattern)


def _clean_up(spark: SparkSession, root: str, name: str, found: list[Version]) -> None:
    """Drop the versions before the last KEEP + 1, and the files that only they list."""
    old, kept = found[: -KEEP - 1], found[-KEEP - 1 :]
    needed = {place for version in kept for place in version.parts.values()}
    for version in old:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(version_table(name, version))}")
        for place in set(version.parts.values()) - needed:
            _delete(spark, place)
        _delete(spark, f"{root}/_manifests/{version.id}.json")


def _write(df: DataFrame, place: str, key: str | None, dealt: bool = False) -> dict[str | None, str]:
    writer = (df.hint("rebalance", key) if key and not dealt else df).write.mode("errorifexists").option("compression", "zstd")
    if key is None:
        writer.parquet(place)
        return {None: place}
    writer.partitionBy(key).parquet(place)
    path, system = _path(df.sparkSession, place)
    parts = {}
    # Folders are named after the values, special characters as %XX.
    for status in system.listStatus(path):
        if status.isDirectory() and "=" in (folder := status.getPath().getName()):
            value = unquote(folder.split("=", 1)[1])
            parts[None if value == NULL_FOLDER else value] = f"{place}/{folder}"
    return parts


def _publish(
    df: DataFrame, name: str, folder: str, key: str | None, keep_parts: dict, found: list[Version], dealt: bool = False
) -> Version:
    spark, root = df.sparkSession, _root(folder, name)
    number = max(time.time_ns() // 1_000_000, int(found[-1].id[1:14]) + 1 if found else 0)
    version_id = f"v{number:013d}_{uuid.uuid4().hex[:8]}"
    written = _write(df, f"{root}/{version_id}", key, dealt)
    order = [f for f in df.schema.fields if f.name != key] + [f for f in df.schema.fields if f.name == key]
    version = Version(version_id, T.StructType(order), key, {**keep_parts, **written})
    _commit(spark, root, version)
    _register(spark, root, name, version)
    _clean_up(spark, root, name, [*found, version])
    return version


def publish(
    df: DataFrame, name: str, folder: str, partition_by: str | None = None, dealt: bool = False
) -> Version:
    """Make ``df`` the whole content of the published table ``name``. Rows that are ``dealt``
    out by ``partition_by`` already are written as they lie, without a further shuffle."""
    return _publish(df, name, folder, partition_by, {}, manifests(df.sparkSession, folder, name), dealt)


def replace_parts(df: DataFrame, name: str, folder: str, partition_by: str, values: list) -> Version:
    """Make ``df`` the content of the parts ``values`` (None: null) of a table partitioned by
    one column. All of them change in one step; a value without rows in ``df`` goes, and the
    files of other parts are not touched. A table that is not there yet is made."""
    found = manifests(df.sparkSession, folder, name)
    if found and (found[-1].partition_by != partition_by or {f.name: f.dataType for f in found[-1].schema} != {f.name: f.dataType for f in df.schema}):
        raise ValueError(f"{name} is published with other columns; publish it as a whole")
    gone = {None if v is None else str(v) for v in values}
    kept = {v: p for v, p in found[-1].parts.items() if v not in gone} if found else {}
    return _publish(df, name, folder, partition_by, kept, found)


def current(spark: SparkSession, name: str, folder: str) -> DataFrame | None:
    """The newest version as it is now; it does not change with later ones."""
    found = manifests(spark, folder, name)
    return spark.table(_quoted(version_table(name, found[-1]))) if found and attach(spark, name, folder) else None


def attach(spark: SparkSession, name: str, folder: str) -> bool:
    """Register the newest version in this session's catalog; False if there is none."""
    found = manifests(spark, folder, name)
    if found:
        _register(spark, _root(folder, name), name, found[-1])
    return bool(found)
