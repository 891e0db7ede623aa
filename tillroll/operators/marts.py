"""Mart relations: dimensions and the two fact tables.

``fct_orders`` pre-aggregates the item lines per order (map-side partial sums,
so even an order holding a third of all lines leaves each map task as one row)
and then left-joins the orders on ``order_id``.  Money is summed in integer
cents and exposed as DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.money import cents, from_cents
from tillroll.sources.buckets import BucketStore


def dim_customers(stg_customers: DataFrame) -> DataFrame:
    return stg_customers.select("customer_id", "signup_date", "country", "email")


def dim_products(stg_products: DataFrame) -> DataFrame:
    return stg_products.select("product_id", "category", "created_at")


def fct_order_items(stg_order_items: DataFrame) -> DataFrame:
    """Item lines with ``item_total = ROUND(quantity * unit_price, 2)``."""
    return stg_order_items.select(
        "order_id", "product_id", "quantity", "unit_price",
        from_cents(cents(F.col("quantity") * F.col("unit_price"))).alias("item_total"),
    )


def item_totals(fct_order_items: DataFrame) -> DataFrame:
    """Per order: item cents and line count (one row per order_id)."""
    return fct_order_items.groupBy("order_id").agg(
        F.sum(cents("item_total")).alias("items_cents"),
        F.count(F.lit(1)).alias("item_lines"),
    )


def stored_item_totals(items: BucketStore) -> DataFrame:
    """``item_totals`` of items stored in buckets by order, added up where they lie."""
    return items.sums({"items_cents": cents("item_total"), "item_lines": F.lit(1).cast("bigint")})


def fct_orders(stg_orders: DataFrame, fct_order_items: DataFrame | BucketStore) -> DataFrame:
    """Orders with the amount rebuilt from items, the reconciliation delta and line count.

    Orders without items are kept (LEFT join) with amount 0 and 0 lines.
    """
    items = (stored_item_totals if isinstance(fct_order_items, BucketStore) else item_totals)(fct_order_items)
    o = stg_orders.join(items, "order_id", "left")
    total_cents = cents("total_amount")
    item_cents = F.coalesce(F.col("items_cents"), F.lit(0).cast("bigint"))
    return o.select(
        "order_id", "customer_id", "order_date", "order_status",
        from_cents(total_cents).alias("order_total_amount"),
        from_cents(item_cents).alias("order_amount_from_items"),
        from_cents(total_cents - item_cents).alias("reconciliation_delta"),
        F.coalesce(F.col("item_lines"), F.lit(0).cast("bigint")).alias("item_lines"),
    )


def build_marts(staged: dict[str, DataFrame]) -> dict[str, DataFrame]:
    items = fct_order_items(staged["stg_order_items"])
    return {
        "dim_customers": dim_customers(staged["stg_customers"]),
        "dim_products": dim_products(staged["stg_products"]),
        "fct_order_items": items,
        "fct_orders": fct_orders(staged["stg_orders"], items),
    }
