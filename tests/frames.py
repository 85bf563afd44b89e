"""Small hand-made inputs."""

RAW_COLUMNS = {
    "order date (DateOrders)": "2022-01-15",
    "shipping date (DateOrders)": "2022-01-20",
    "Late_delivery_risk": "1",
    "Order Region": "Harbour North",
    "Market": "Coast",
    "Order Country": "Freeland",
    "Product Card Id": "101",
    "Product Name": "Lamp",
    "Category Name": "Lighting",
    "Department Name": "Home",
    "Customer Id": "1001",
    "Customer Segment": "Consumer",
    "Customer Country": "Freeland",
    "Customer City": "Port",
    "Customer State": "FL",
    "Order Id": "5001",
    "Delivery Status": "Late delivery",
    "Sales": "120.5",
    "Order Profit Per Order": "30.0",
    "Order Item Discount Rate": "0.05",
    "Order Item Quantity": "2",
}


def raw_rows(spark, *changes):
    """One raw order for each dict of changes to the standard row; all text."""
    schema = ", ".join(f"`{c}` string" for c in RAW_COLUMNS)
    rows = [tuple({**RAW_COLUMNS, **change}.values()) for change in changes]
    return spark.createDataFrame(rows, schema)
