"""Star schema around one row per order line.

A dimension holds the distinct combinations of all its columns, so an id can
occur more than once; ``quality.key_uniqueness`` shows where.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

# Published name of each column -> its name in the cleaned orders. The first
# column of a table is the one that must be present.
REGION = {
    "region_name": "order_region",
    "market_name": "market",
    "country": "order_country",
}
PRODUCT = {
    "product_id": "product_card_id",
    "product_name": "product_name",
    "category_name": "category_name",
    "department_name": "department_name",
}
CUSTOMER = {
    "customer_id": "customer_id",
    "segment": "customer_segment",
    "country": "customer_country",
    "city": "customer_city",
    "state": "customer_state",
}
DATE = {
    "year_month": "order_year_month",
    "year": "order_year",
    "month": "order_month",
    "quarter": "order_quarter",
}
FACT = {
    "order_id": "order_id",
    "customer_id": "customer_id",
    "product_id": "product_card_id",
    "region_name": "order_region",
    "year_month": "order_year_month",
    "order_date": "order_date",
    "shipping_date": "shipping_date",
    "lead_days": "actual_lead_days",
    "late_risk_flag": "late_delivery_risk",
    "delivery_status": "delivery_status",
    "sales_amount": "sales",
    "profit": "order_profit_per_order",
    "discount_rate": "order_item_discount_rate",
    "quantity": "order_item_quantity",
}


def _keyed(clean: DataFrame, layout: dict[str, str]) -> DataFrame:
    key = next(iter(layout.values()))
    return clean.filter(F.col(key).isNotNull()).select(
        *[F.col(source).alias(name) for name, source in layout.items()]
    )


def dim_region(clean: DataFrame) -> DataFrame:
    return _keyed(clean, REGION).distinct()


def dim_product(clean: DataFrame) -> DataFrame:
    return _keyed(clean, PRODUCT).distinct()


def dim_customer(clean: DataFrame) -> DataFrame:
    return _keyed(clean, CUSTOMER).distinct()


def dim_date(clean: DataFrame) -> DataFrame:
    return _keyed(clean, DATE).distinct()


def fact_orders(clean: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Order lines; ``keep`` names further columns to carry along."""
    return _keyed(clean, {**FACT, **{c: c for c in keep}})


BUILDERS = {
    "dim_region": dim_region,
    "dim_product": dim_product,
    "dim_customer": dim_customer,
    "dim_date": dim_date,
    "fact_orders": fact_orders,
}


def star_tables(clean: DataFrame) -> dict[str, DataFrame]:
    return {name: build(clean) for name, build in BUILDERS.items()}


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
