"""Staging relations: typed, cleaned projections of the raw tables.

Each function is a narrow projection, so Catalyst folds it into the scan's
stage (column pruning and filter pushdown pass straight through it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.casts import cast_integral

# fixed values: the normalised order-status domain
PAID, CANCELED, REFUNDED, UNKNOWN = "paid", "canceled", "refunded", "unknown"


def stg_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        cast_integral(customers, "customer_id", "bigint").alias("customer_id"),
        F.col("signup_date").cast("date").alias("signup_date"),
        F.upper(F.trim("country")).alias("country"),
        F.nullif(F.lower(F.trim("email")), F.lit("")).alias("email"),
    )


def stg_products(products: DataFrame) -> DataFrame:
    return products.select(
        cast_integral(products, "product_id", "bigint").alias("product_id"),
        F.trim("category").alias("category"),
        F.col("created_at").cast("date").alias("created_at"),
    )


# fixed values: accepted spellings (after trim + lower-case) -> normalised status
STATUS_SPELLINGS = {"paid": PAID, "canceled": CANCELED, "cancelled": CANCELED, "refunded": REFUNDED}


def normalise_status(status: F.Column) -> F.Column:
    """Free-text status -> paid / canceled / refunded / unknown (NULL included in unknown).

    One lookup in a literal map, so the cleaned text is computed once per row.
    """
    spellings = F.create_map(*[F.lit(x) for kv in STATUS_SPELLINGS.items() for x in kv])
    return F.coalesce(F.try_element_at(spellings, F.lower(F.trim(status))), F.lit(UNKNOWN))


def stg_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        cast_integral(orders, "order_id", "bigint").alias("order_id"),
        cast_integral(orders, "customer_id", "bigint").alias("customer_id"),
        F.col("order_date").cast("date").alias("order_date"),
        normalise_status(F.col("status")).alias("order_status"),
        F.col("total_amount").cast("double").alias("total_amount"),
    )


def stg_order_items(order_items: DataFrame) -> DataFrame:
    return order_items.select(
        cast_integral(order_items, "order_id", "bigint").alias("order_id"),
        cast_integral(order_items, "product_id", "bigint").alias("product_id"),
        cast_integral(order_items, "quantity", "int").alias("quantity"),
        F.col("unit_price").cast("double").alias("unit_price"),
    )


def stage(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All four staging relations from the raw tables."""
    return {
        "stg_customers": stg_customers(raw["customers"]),
        "stg_products": stg_products(raw["products"]),
        "stg_orders": stg_orders(raw["orders"]),
        "stg_order_items": stg_order_items(raw["order_items"]),
    }
