"""Cleaning raw orders.

``clean_orders`` runs every step. The single steps take and return DataFrames,
so they can be used alone as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.moments import month_label, parse_moment, whole_days
from ..functions.names import snake_names
from ..sources.tables import stage

# Types of the columns used downstream, when the source delivers text.
TEXT_TYPES = {
    "order_id": "bigint",
    "customer_id": "bigint",
    "product_card_id": "bigint",
    "sales": "double",
    "order_item_discount_rate": "double",
    "order_item_quantity": "int",
}


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*snake_names(df.columns))


def number(c: Column) -> Column:
    """Text or number to double; text that is no number, and NaN, give null."""
    return F.nanvl(c.try_cast("double"), F.lit(None).cast("double"))


def give_types(df: DataFrame) -> DataFrame:
    """Cast the known text columns; a value that does not fit becomes null."""
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    casts = {}
    for name, target in TEXT_TYPES.items():
        if name in texts:
            # Whole numbers may be written with a fraction ("12.0"); the detour over
            # double is taken only then, as it would round long ids.
            exact = number(F.col(name)) if target == "double" else F.col(name).try_cast(target)
            casts[name] = F.coalesce(exact, number(F.col(name)).try_cast(target))
    return df.withColumns(casts) if casts else df


def parse_dates(df: DataFrame) -> DataFrame:
    """Add order_date and shipping_date from the two source columns."""

    def moment(name: str) -> Column:
        if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return F.col(name).cast("timestamp_ntz")
        return parse_moment(F.col(name).cast("string"))

    return df.withColumns(
        {
            "order_date": moment("order_date_dateorders"),
            "shipping_date": moment("shipping_date_dateorders"),
        }
    )


def add_lead_days(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "actual_lead_days", whole_days(F.col("order_date"), F.col("shipping_date"))
    )


def add_calendar(df: DataFrame, nat_as_string: bool = False) -> DataFrame:
    """Year, month, quarter and the ``yyyy-MM`` label of the order date.

    Orders without a date get a null label; ``nat_as_string`` labels them 'NaT'.
    """
    label = month_label(F.col("order_date"))
    return df.withColumns(
        {
            "order_year": F.year("order_date"),
            "order_month": F.month("order_date"),
            "order_quarter": F.quarter("order_date"),
            "order_year_month": F.coalesce(label, F.lit("NaT")) if nat_as_string else label,
        }
    )


def fill_late_flag(df: DataFrame) -> DataFrame:
    flag = number(F.col("late_delivery_risk")).try_cast("int")
    return df.withColumn("late_delivery_risk", F.coalesce(flag, F.lit(0)))


def fill_profit(df: DataFrame) -> DataFrame:
    """Profit as a number, missing or unreadable as 0; losses stay negative."""
    profit = number(F.col("order_profit_per_order"))
    return df.withColumn("order_profit_per_order", F.coalesce(profit, F.lit(0.0)))


def drop_repeats(df: DataFrame, copies: str | None = None) -> DataFrame:
    """Drop exact copies of a row; null equals null.

    Copies collapse inside each task before the shuffle, so a row repeated very
    often does not overload one reducer. ``copies`` names a column to add with the
    number of rows each kept row stands for.
    """
    if copies is None:
        return df.dropDuplicates()
    keys = [F.col(f"`{c}`") for c in df.columns]
    return df.groupBy(*keys).agg(F.count("*").alias(copies))


def sparse_columns(df: DataFrame, limit: float = 0.5) -> list[str]:
    """Columns whose share of nulls is above ``limit``; one aggregate for all of them."""
    shares = df.agg(
        *[F.avg(F.col(f"`{c}`").isNull().cast("int")).alias(str(i)) for i, c in enumerate(df.columns)]
    ).first()
    return [c for c, share in zip(df.columns, shares) if share is not None and share > limit]


def drop_sparse(df: DataFrame, limit: float = 0.5) -> DataFrame:
    """Drop mostly-empty columns. Runs a job: the output columns depend on the data."""
    return df.drop(*sparse_columns(df, limit))


def tidy_rows(
    df: DataFrame, nat_as_string: bool = False, copies: str | None = None
) -> DataFrame:
    """Every cleaning step but the sparse-column one; fully lazy.

    The date and calendar columns are functions of columns that take part in the
    comparison of rows, so they are derived after the duplicates are gone: the
    shuffle carries fewer columns and dates are parsed once per kept row.
    """
    unified = fill_profit(fill_late_flag(give_types(normalize_columns(df))))
    dated = parse_dates(drop_repeats(unified, copies))
    return add_calendar(add_lead_days(dated), nat_as_string)


def clean_orders(df: DataFrame, nat_as_string: bool = False, limit: float = 0.5) -> DataFrame:
    """The whole step. The deduplicated rows are stored, as the null shares of their
    columns decide which columns the result has."""
    return drop_sparse(stage(tidy_rows(df, nat_as_string), "tidy"), limit)
