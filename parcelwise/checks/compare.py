"""Run registered queries against their SQL and report what differs.

    python -m parcelwise.checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from ..session import build_session
from .oracle import ORACLE
from .queries import QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

# Spark type of a column -> DuckDB type it must meet.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _rows(frame: pd.DataFrame) -> list[tuple]:
    def plain(value):
        if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
            return (0, "")
        if isinstance(value, pd.Timestamp):
            return (1, value.isoformat())
        return (1, repr(value.item() if hasattr(value, "item") else value))

    columns = sorted(frame.columns)
    lists = [[plain(v) for v in frame[c].astype(object)] for c in columns]
    return sorted(zip(*lists))


def differences(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when names, types and all values agree, bit for bit."""
    answer = con.sql(sql)
    expected_types = dict(zip(answer.columns, [str(t) for t in answer.types]))
    found_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in result.schema.fields}
    if expected_types != found_types:
        return [f"{c}: {found_types.get(c)} instead of {expected_types.get(c)}"
                for c in sorted({*expected_types, *found_types})
                if found_types.get(c) != expected_types.get(c)]
    columns = sorted(found_types)
    found = _rows(pd.DataFrame(result.select(*[f"`{c}`" for c in columns]).collect(), columns=columns, dtype=object))
    expected = _rows(pd.DataFrame(answer.fetchall(), columns=answer.columns, dtype=object))
    if len(found) != len(expected):
        return [f"{len(found)} rows instead of {len(expected)}"]
    wrong = [(a, b) for a, b in zip(found, expected) if a != b]
    return [f"{len(wrong)} of {len(found)} rows differ, first {wrong[0]}"] if wrong else []


def main(spark: SparkSession, sf_dir: str, names: list[str]) -> int:
    con, failed = connect(sf_dir), 0
    for name in names:
        started = time.time()
        try:
            result = QUERIES[name](spark, sf_dir)
            if name in ORACLE:
                problems = differences(result, con, ORACLE[name])
                verdict = "same" if not problems else "; ".join(problems)
            else:
                problems, verdict = [], f"{len(result.collect())} rows, no SQL"
        except Exception as error:  # noqa: BLE001 - one query must not stop the others
            problems, verdict = [error], f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problems)
        print(f"{name:32s} {time.time() - started:6.1f}s  {verdict}", flush=True)
    return failed


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                                  "spark.driver.memory": "12g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    sys.exit(bool(main(session, folder.rstrip("/"), sys.argv[2:] or list(QUERIES))))
