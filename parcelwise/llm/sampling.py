"""Bounded, reproducible samples of labelled rows to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import share_of, stage


def per_class(df: DataFrame, label: str, key: list[str], rows: int) -> tuple[DataFrame, DataFrame]:
    """About ``rows`` rows in all, as many of each class where it has them; and the classes
    (``label``, n), n the number of their rows. Null classes are out.

    Rows are drawn by the hash of ``key``, and those that agree in label and key are one
    row, here and in the counts. With more classes than ``rows`` some have no row.
    """
    known = df.filter(F.col(label).isNotNull())
    drawn = F.xxhash64(*key)
    sizes = known.select(label, drawn.alias("drawn")).distinct().groupBy(label).agg(F.count("*").alias("n"))
    # Stored, so that Spark broadcasts it by its measured size and the rows stay where they are.
    sizes = stage(sizes, "classes")
    each = rows / max(1, sizes.count())
    classes = sizes.select(F.col(label).alias("_of"), F.col("n").alias("_n"))
    picked = (
        known.join(classes, F.col(label) == F.col("_of"))
        .filter(share_of(F.lit("fit"), *[F.col(k) for k in key]) < F.lit(each) / F.col("_n"))
        .drop("_of", "_n")
        .dropDuplicates([label, *key])
    )
    return picked, sizes
