"""The benchmark's line-item tables seen as one wide, raw order table.

``raw_orders`` gives the layout of a raw order file, with faults planted by
fixed rules (missing regions, bad dates, bad numbers, repeated rows, ...), so
that cleaning and checking have something to find.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Unique for every line; integers only, as engines print doubles differently.
LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "price_cents"]

# Days allowed for each order priority 1..5.
SCHEDULED_DAYS = [1, 2, 4, 4, 5]

# Declared, so that opening a table runs no job to read its schema.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def joined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with everything known about them.

    Lines are shuffled twice, to their orders and then to their parts, as keys and numbers.
    In between they lose what only the lead and the priority's digit are taken from, and names
    come last. Orders, customers and parts are broadcast only where Spark's measured size is
    below the threshold. Nations and their regions, a few dozen whatever the size of the other
    tables, always are: Spark takes the product of their sizes for that of their join, and with
    a low threshold would shuffle all lines to the few keys of the nations.
    """
    nation = F.broadcast(
        table(spark, sf_dir, "nation").join(
            F.broadcast(table(spark, sf_dir, "region")), F.expr("n_regionkey = r_regionkey")
        )
    )
    customer = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders").join(customer, F.expr("o_custkey = c_custkey"))
    allowed = ", ".join(str(days) for days in SCHEDULED_DAYS)
    dated = (
        table(spark, sf_dir, "lineitem")
        .join(orders, F.expr("l_orderkey = o_orderkey"))
        .selectExpr(
            "* EXCEPT (l_shipdate, o_orderpriority)",
            "pmod(datediff(l_shipdate, o_orderdate), 7) AS lead",
            "substring(o_orderpriority, 1, 1) AS priority",
        )
    )
    return (
        dated.join(table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))
        .join(nation, F.expr("c_nationkey = n_nationkey"))
        .selectExpr(
            "*",
            f"element_at(array({allowed}), int(priority)) AS scheduled",
            "bigint(round(l_extendedprice * 100)) AS price_cents",
            "l_extendedprice * (1 - l_discount) - l_quantity * p_retailprice AS line_profit",
        )
    )


def _moment_text(moment: str) -> str:
    return (
        f"CASE WHEN l_orderkey % 2 = 0 THEN date_format({moment}, 'M/d/yyyy H:mm') "
        f"ELSE date_format({moment}, 'yyyy-MM-dd HH:mm:ss') END"
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw layout with planted faults; text where a raw file holds text."""
    at_night = "l_orderkey % 13 = 0 AND lead = 1"
    backwards = "l_orderkey % 17 = 0 AND lead = 0"
    moments = joined_lines(spark, sf_dir).selectExpr(
        "*",
        f"o_orderdate + make_dt_interval(0, IF({at_night}, 23, 0)) AS ordered",
        f"""o_orderdate + make_dt_interval(
            lead, CASE WHEN {at_night} THEN 1 WHEN {backwards} THEN -1 ELSE 0 END) AS shipped""",
        "explode(sequence(1, IF(l_orderkey % 20 = 0, 2, 1))) AS copy",
    )
    return moments.selectExpr(
        *LINE_KEY,
        f"""CASE WHEN l_orderkey % 211 = 0 THEN 'not a date' ELSE {_moment_text('ordered')} END
            AS `order date (DateOrders)`""",
        f"{_moment_text('shipped')} AS `shipping date (DateOrders)`",
        "CASE WHEN l_suppkey % 7 <> 0 THEN int(lead > scheduled) END AS Late_delivery_risk",
        "CASE WHEN c_custkey % 97 <> 0 THEN n_name END AS `Order Region`",
        "r_name AS Market",
        "n_name AS `Order Country`",
        "l_partkey AS `Product Card Id`",
        """CASE WHEN l_partkey % 101 = 0 AND l_linenumber % 2 = 0 THEN p_name || ' (renamed)'
            ELSE p_name END AS `Product Name`""",
        "p_type AS `Category Name`",
        "p_brand AS `Department Name`",
        "o_custkey AS `Customer Id`",
        "c_mktsegment AS `Customer Segment`",
        "n_name AS `Customer Country`",
        "n_name AS `Customer City`",
        "r_name AS `Customer State`",
        "CASE WHEN l_orderkey % 301 <> 0 THEN l_orderkey END AS `Order Id`",
        """CASE WHEN lead > scheduled THEN 'Late delivery' WHEN lead = scheduled
            THEN 'Shipping on time' ELSE 'Advance shipping' END AS `Delivery Status`""",
        "l_extendedprice AS Sales",
        """CASE WHEN l_partkey % 53 = 0 THEN 'n.a.' ELSE string(line_profit) END
            AS `Order Profit Per Order`""",
        "l_discount AS `Order Item Discount Rate     `",
        "int(l_quantity) AS `Order Item Quantity`",
        "CASE WHEN l_orderkey % 10 >= 6 THEN 'About ' || p_name END AS `Product Description`",
    )
