"""Data-quality checks: one aggregate pass, one boolean per check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import share_true

# The share a check must exceed, the accepted lead days, the row bound.
PASS_SHARE = 0.95
LEAD_DAY_RANGE = (-5, 365)
MIN_ROWS = 100_000


def no_nulls(column: str) -> Column:
    return F.count_if(F.col(column).isNull()) == 0


def late_flag_is_binary() -> Column:
    ok = F.coalesce(F.col("late_delivery_risk").isin(0, 1), F.lit(False))
    return F.coalesce(F.bool_and(ok), F.lit(True))


def mostly(condition: Column) -> Column:
    return F.coalesce(share_true(condition) > PASS_SHARE, F.lit(False))


def check_columns(min_rows: int = MIN_ROWS) -> dict[str, Column]:
    return {
        "no_null_order_date": no_nulls("order_date"),
        "no_null_region": no_nulls("order_region"),
        "late_risk_binary": late_flag_is_binary(),
        "positive_sales": mostly(F.col("sales") >= 0),
        "reasonable_lead_days": mostly(F.col("actual_lead_days").between(*LEAD_DAY_RANGE)),
        "row_count_above_100k": F.count("*") > min_rows,
    }


def run_check(df: DataFrame, name: str, min_rows: int = MIN_ROWS) -> DataFrame:
    return df.agg(check_columns(min_rows)[name].alias("passed")).select(
        F.lit(name).alias("check_name"), "passed"
    )


def dq_report(df: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """All checks and ``all_passed``, one row each, from a single scan."""
    checks = check_columns(min_rows)
    results = df.agg(*[passed.alias(name) for name, passed in checks.items()])
    everything = F.lit(True)
    for name in checks:
        everything = everything & F.col(name)
    names = [*checks, "all_passed"]
    return results.withColumn("all_passed", everything).unpivot(
        [], names, "check_name", "passed"
    )


def key_uniqueness(dim: DataFrame, key: str) -> DataFrame:
    """Keys with more than one row in a dimension: each doubles the facts it joins."""
    return (
        dim.groupBy(F.col(key).alias("key_value"))
        .agg(F.count("*").alias("versions"))
        .filter(F.col("versions") > 1)
    )
