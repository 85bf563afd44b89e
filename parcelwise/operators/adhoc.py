"""SQL typed by a user, run over the published tables and views."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession


class Rows(list):
    """Rows of a result, and whether it has more."""

    is_cut = False


@dataclass(frozen=True)
class Answer:
    """Either a result or the reason why there is none."""

    result: DataFrame | None
    error: str | None = None

    def rows(self, most: int = 1000) -> tuple[Rows, str | None]:
        """Run the query: its first rows, and the error if it fails while it runs. ``is_cut``
        of the rows tells whether there are more; ``result`` has all of them as a frame."""
        if self.result is None:
            return Rows(), self.error
        try:
            found = self.result.limit(most + 1).collect()
        except PySparkException as problem:
            return Rows(), f"Query error: {problem}"
        rows = Rows(found[:most])
        rows.is_cut = len(found) > most
        return rows, None


def adhoc_sql(spark: SparkSession, query: str) -> Answer:
    """Run one query.

    It is placed inside a SELECT, where no statement that changes tables is valid
    SQL: the published tables are read-only here.
    """
    text = query.strip().rstrip(";")
    try:
        return Answer(spark.sql(f"SELECT * FROM (\n{text}\n)"))
    except PySparkException as problem:
        return Answer(None, f"Query error: {problem}")
