"""Which categories an order holds, as a stored bit set: category filters that read no item lines.

Categories are numbered by a dictionary; an order's set is a map from word number (code div 64) to 64 bits,
with the words that have any, so it grows with the order's categories and has no limit on the dictionary.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.ingest import dense_ids

BITS = "category_bits"
WORD = 64


def category_codes(dim_products: DataFrame) -> DataFrame:
    """``(category, code)``: the distinct categories numbered from 0 in ascending order."""
    return dense_ids(dim_products, "category", "id").select("category", (F.col("id") - 1).cast("int").alias("code"))


def order_category_bits(fct_order_items: DataFrame, dim_products: DataFrame, codes: DataFrame) -> DataFrame:
    """``(order_id, category_bits)`` of every order with a line whose product has a category.

    Lines are folded to one word per order and word number map-side, so an order with very many lines
    leaves each task as a few rows.
    """
    products = dim_products.select("product_id", "category").join(codes, "category").select("product_id", "code")
    bit = F.expr(f"shiftleft(1L, code % {WORD})")
    words = (fct_order_items.select("order_id", "product_id").join(products, "product_id")
             .groupBy("order_id", F.expr(f"code div {WORD}").cast("int").alias("word")).agg(F.bit_or(bit).alias("bits")))
    return words.groupBy("order_id").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias(BITS))


def with_category_bits(fct_orders: DataFrame, bits: DataFrame) -> DataFrame:
    """``fct_orders`` with the column ``category_bits``; an empty map where an order has no category."""
    return fct_orders.join(bits, "order_id", "left").withColumn(
        BITS, F.coalesce(BITS, F.create_map().cast("map<int,bigint>")))


def holds_any(codes: DataFrame, categories: Sequence[str]) -> Column:
    """Whether ``category_bits`` has any of the categories; their codes come from one scalar subquery."""
    names = list(dict.fromkeys(categories))
    found = codes.agg(F.struct(*[F.max(F.when(F.col("category") == c, F.col("code"))).alias(f"c{i}")
                                 for i, c in enumerate(names)])).scalar()

    def has(code: Column) -> Column:  # a category outside the dictionary has no code and no order
        bits = F.try_element_at(F.col(BITS), F.floor(code / WORD).cast("int"))
        return F.coalesce(F.getbit(bits, F.pmod(code, F.lit(WORD))) == 1, F.lit(False))
    return reduce(or_, [has(found[f"c{i}"]) for i in range(len(names))])
