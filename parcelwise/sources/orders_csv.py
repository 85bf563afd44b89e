"""Raw order files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# The texts a data-frame CSV reader takes for a missing value.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def blank_to_null(df: DataFrame) -> DataFrame:
    """Turn the missing-value texts of string columns into nulls."""
    return df.select(
        *[
            F.when(~F.col(f"`{f.name}`").isin(NA_TOKENS), F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


# Holds the text of a row that does not fit the layout.
CORRUPT = "_corrupt_row"


@dataclass(frozen=True)
class Orders:
    """The rows of order files, and the rows that are none."""

    rows: DataFrame
    rejected: DataFrame  # file, reason, row


def _reader(spark: SparkSession, multiline: bool):
    return (
        spark.read.option("header", True)
        .option("encoding", "ISO-8859-1")
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("inferSchema", False)
    )


def read_orders(
    spark: SparkSession, path: str, columns: list[str] | None = None, multiline: bool = False
) -> Orders:
    """Order files as ``read_orders_csv`` reads them, without the rows that do not fit.

    A row with too many fields, with too few, or with a quote that its line does not close is
    rejected: with its file, the reason and its text. Rows and rejected rows together are all
    lines of data, empty ones left out. Every column is parsed wherever the rows are used, as
    a row can be judged by all of its fields only.
    """
    columns = columns or _reader(spark, multiline).csv(path).columns
    names = [*columns, CORRUPT]
    layout = T.StructType([T.StructField(c, T.StringType()) for c in names])
    read = (
        _reader(spark, multiline)
        .schema(layout)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", False)
        .csv(path)
    )
    row = F.col(CORRUPT)
    quotes = F.length(row) - F.length(F.replace(row, F.lit('"')))
    # Commas inside closed quotes part no fields.
    bare = F.regexp_replace(row, '"[^"]*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1
    # Always true: Spark refuses queries that read the text of rejected rows and no column.
    parsed = F.octet_length(F.coalesce(F.col(f"`{columns[-1]}`"), F.lit(""))) >= 0
    reason = (
        F.when(quotes % 2 == 1, "open quote")
        .when(fields < len(columns), "too few fields")
        .when(fields > len(columns), "too many fields")
        .otherwise("unreadable")
    )
    rejected = read.filter(row.isNotNull() & parsed).select(
        F.col("_metadata.file_path").alias("file"), reason.alias("reason"), row.alias("row")
    )
    return Orders(blank_to_null(read.filter(row.isNull() & parsed).drop(CORRUPT)), rejected)


def read_orders_csv(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Latin-1 CSV with a header, every column text; cleaning gives the types.

    No schema is inferred from the values: that would read the files twice. The header
    of every file is checked against ``columns``, or against the first file's header
    where they are not given; a file with other or reordered columns is an error when it
    is read. ``multiline`` accepts line breaks inside quotes, at the price that a file is
    no longer split over tasks. Fields beyond the columns are dropped and missing ones are
    null; ``read_orders`` tells such rows apart.
    """
    columns = columns or _reader(spark, multiline).csv(path).columns
    layout = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return blank_to_null(_reader(spark, multiline).schema(layout).option("enforceSchema", False).csv(path))


# Rows in a compressed file: readers cannot split it, so one task reads that many.
FILE_ROWS = 1_000_000


def write_orders_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Write a frame in the layout ``read_orders_csv`` reads, as ``.csv`` files, or under the
    name of a ``compression`` such as gzip, which readers know by the ending of the files."""
    writer = (
        df.write.mode("overwrite")
        .option("header", True)
        .option("encoding", "ISO-8859-1")
        .option("escape", '"')
        # Names of raw columns end in blanks; readers check them as they are.
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    if compression:
        writer = writer.option("compression", compression).option("maxRecordsPerFile", FILE_ROWS)
    writer.csv(path)
