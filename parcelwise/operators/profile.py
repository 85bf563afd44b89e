"""Profiling a raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.moments import parse_moment


def profile_shape(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("row_count"), F.lit(len(df.columns)).alias("column_count")
    )


def profile_nulls(df: DataFrame, top: int | None = 15) -> DataFrame:
    """The columns with the most nulls, counted in one pass; ties in column order.

    ``top=None`` lists every column with its type.
    """
    per_column = F.array(
        *[
            F.struct(
                F.lit(position).alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("column_type"),
                F.count_if(F.col(f"`{field.name}`").isNull()).alias("null_count"),
            )
            for position, field in enumerate(df.schema.fields)
        ]
    )
    ranked = (
        df.agg(F.count("*").alias("rows"), per_column.alias("per_column"))
        .select("rows", F.inline("per_column"))
        .orderBy(F.desc("null_count"), "position")
    )
    return (ranked if top is None else ranked.limit(top)).select(
        "column_name",
        "column_type",
        "null_count",
        F.try_divide(F.col("null_count") * 100, F.col("rows")).alias("null_pct"),
    )


def profile_value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of each value, most frequent first; nulls are left out."""
    value = F.col(f"`{column}`")
    return (
        df.filter(value.isNotNull())
        .groupBy(value.alias("value"))
        .agg(F.count("*").alias("occurrences"))
        .orderBy(F.desc("occurrences"), "value")
    )


def profile_distinct(df: DataFrame, column: str) -> DataFrame:
    """Distinct values; null is one of them."""
    return df.select(F.col(f"`{column}`").alias("value")).distinct()


def profile_date_range(df: DataFrame, column: str) -> DataFrame:
    moment = parse_moment(F.col(f"`{column}`").cast("string"))
    return df.select(moment.alias("moment")).agg(
        F.min("moment").alias("first_order"), F.max("moment").alias("last_order")
    )
