"""Monthly KPIs and the questions asked of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import WeightedTotal, exact_avg, money_sum, round_half_away

# A month's products are added up in parts, one for so many shuffle partitions.
PARTITIONS_PER_BUCKET = 50
SALES, PROFIT = WeightedTotal("sales_amount"), WeightedTotal("profit")


def monthly_risk_by_region(fact: DataFrame) -> DataFrame:
    """One row per month and region; null months and regions form groups too."""
    return fact.groupBy("year_month", "region_name").agg(
        F.count("*").alias("total_orders"),
        F.sum("late_risk_flag").alias("late_orders"),
        round_half_away(F.avg("late_risk_flag") * 100, 2).alias("late_risk_pct"),
        round_half_away(F.avg("lead_days"), 1).alias("avg_lead_days"),
        money_sum("sales_amount").alias("total_sales"),
        money_sum("profit").alias("total_profit"),
        round_half_away(exact_avg("discount_rate", times=100), 2).alias("avg_discount_pct"),
    )


def _wanted(fact: DataFrame) -> DataFrame:
    """What the department KPIs need of the facts."""
    return fact.filter(F.col("product_id").isNotNull()).select(
        "product_id", "year_month", "late_risk_flag", "sales_amount", "profit"
    )


def _states(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count("*").alias("_orders"),
        F.count("late_risk_flag").alias("_flags"),
        F.sum("late_risk_flag").alias("_late"),
        *SALES.partial(),
        *PROFIT.partial(),
    )


def product_months(fact: DataFrame) -> DataFrame:
    """Partial sums of the department KPIs, one row per product and month. States of a month
    are a function of that month's facts, and adding up states gives those of both.

    Products have few orders a month, and a state is wider than an order. So orders are
    shuffled as they are, a month's in a few parts, and states come out by month.
    """
    buckets = max(1, int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions")) // PARTITIONS_PER_BUCKET)
    bucket = F.pmod(F.xxhash64("product_id"), F.lit(buckets)).cast("int")
    dealt = _wanted(fact).withColumn("_bucket", bucket).repartition("year_month", "_bucket")
    return _states(dealt, "product_id", "year_month", "_bucket").drop("_bucket")


def departments_of(states: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Department KPIs from the states of ``product_months``."""
    versions = dim_product.groupBy("product_id", "department_name").agg(
        F.count("*").alias("versions")
    )
    late_share = F.sum(F.col("_late") * F.col("versions")) / F.sum(
        F.col("_flags") * F.col("versions")
    )
    return (
        states.join(versions, "product_id")
        .groupBy("department_name", "year_month")
        .agg(
            F.sum(F.col("_orders") * F.col("versions")).alias("total_orders"),
            round_half_away(late_share * 100, 2).alias("late_risk_pct"),
            SALES.combine("versions").alias("total_sales"),
            PROFIT.combine("versions").alias("total_profit"),
        )
    )


def department_kpis(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Department by month over fact joined to product, one row per match.

    Facts are added up per product and month, and products counted per
    department, before they meet. A product with many orders or many versions
    then brings few rows to the join, and its orders still count once per version.
    Orders are shuffled once, as they are and by product alone: sums per product and month
    are wider than the orders behind them, and the join needs them by product.
    """
    dealt = _wanted(fact).repartition("product_id")
    return departments_of(_states(dealt, "product_id", "year_month"), dim_product)


def top_risk_region_months(monthly: DataFrame, n: int = 5) -> DataFrame:
    """The region-months with the highest late share; ties by month, then region."""
    return (
        monthly.select("year_month", "region_name", "late_risk_pct", "total_orders")
        .orderBy(
            F.desc_nulls_last("late_risk_pct"),
            F.asc_nulls_last("year_month"),
            F.asc_nulls_last("region_name"),
        )
        .limit(n)
    )


def segment_risk(
    fact: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    region: str,
    category: str,
) -> DataFrame:
    """Customer segments of one region and product category, most late first.

    As in ``department_kpis`` each side is counted before it is joined.
    """
    in_region = (
        fact.filter(F.col("region_name") == region)
        .groupBy("product_id", "customer_id")
        .agg(F.count("*").alias("orders"), F.sum("late_risk_flag").alias("late"))
    )
    in_category = (
        dim_product.filter(F.col("category_name") == category)
        .groupBy("product_id")
        .agg(F.count("*").alias("versions"))
    )
    per_customer = (
        in_region.join(in_category, "product_id")
        .groupBy("customer_id")
        .agg(
            F.sum(F.col("orders") * F.col("versions")).alias("orders"),
            F.sum(F.col("late") * F.col("versions")).alias("late"),
        )
    )
    segments = dim_customer.groupBy("customer_id", "segment").agg(F.count("*").alias("versions"))
    return (
        per_customer.join(segments, "customer_id")
        .groupBy("segment")
        .agg(
            F.sum(F.col("orders") * F.col("versions")).alias("total_orders"),
            F.sum(F.col("late") * F.col("versions")).alias("late_orders"),
        )
        .select(
            "segment",
            "total_orders",
            "late_orders",
            round_half_away(F.col("late_orders") / F.col("total_orders") * 100, 2).alias("late_risk_pct"),
        )
        .orderBy(F.desc("late_risk_pct"), F.asc_nulls_last("segment"))
    )
