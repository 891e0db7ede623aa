"""Declared schemas of the four raw shop tables and the flat invoice-line input."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_TABLES = ("customers", "products", "orders", "order_items")

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("signup_date", T.DateType()),
    T.StructField("country", T.StringType()),
    T.StructField("email", T.StringType()),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("category", T.StringType()),
    T.StructField("created_at", T.DateType()),
])

ORDERS = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("status", T.StringType()),
    T.StructField("total_amount", T.DoubleType()),
])

ORDER_ITEMS = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", T.DoubleType()),
])

RAW_SCHEMAS = {"customers": CUSTOMERS, "products": PRODUCTS, "orders": ORDERS, "order_items": ORDER_ITEMS}

# Flat retail invoice lines (one row per line).  ``line_no`` carries the
# source order that "first" aggregations depend on.
RETAIL_LINE_COLUMNS = ("InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate",
                       "UnitPrice", "CustomerID", "Country")
