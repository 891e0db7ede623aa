"""Adapter from the supplied TPC-H-style Parquet tables to the raw shop tables.

The shop model has customers, products, orders and order items; the supplied
data has customer / nation / part / orders / lineitem.  The mapping is a fixed
set of projections and joins (documented in FIXTURES.md section 4) that leaves
work for every staging rule: padded lower-case countries, blank and missing
emails, free-text statuses in five spellings, and prices with many decimals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# file path -> schema read from its footer.  The supplied files never change, so
# each is inferred once per process; later reads pass the schema and skip the
# footer-reading job Spark otherwise launches for every Parquet read.
_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = _SCHEMAS.get(path)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


def _order_date() -> F.Column:
    return F.col("o_orderdate").cast("date")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    # signup_date = first order date of the customer (partial aggregate, then a key join)
    first_order = (table(spark, sf_dir, "orders")
                   .groupBy(F.col("o_custkey").alias("c_custkey"))
                   .agg(F.min(_order_date()).alias("signup_date")))
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    key = F.col("c_custkey")
    return (table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .join(first_order, "c_custkey", "left")
            .select(key.alias("customer_id"),
                    F.col("signup_date"),
                    F.concat(F.lit(" "), F.lower("n_name"), F.lit(" ")).alias("country"),
                    F.when(key % 100 == 0, F.lit(None).cast("string"))
                     .when(key % 100 == 50, F.lit("  "))
                     .otherwise(F.concat(F.lit(" "), F.col("c_name"), F.lit("@Example.com")))
                     .alias("email")))


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    # created_at = global first order date: a scalar subquery, evaluated once
    first_day = table(spark, sf_dir, "orders").select(F.min(_order_date())).scalar()
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.col("p_type"), F.lit(" ")).alias("category"),
        first_day.alias("created_at"))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    bucket = key % 10
    # fixed values: the status spellings the staging rule must normalise
    status = (F.when(F.col("o_orderstatus") == "F", F.lit(" PAID "))
              .when(F.col("o_orderstatus") == "O", F.lit("paid"))
              .when(bucket <= 3, F.lit("cancelled"))
              .when(bucket <= 6, F.lit("Canceled"))
              .when(bucket <= 8, F.lit("REFUNDED"))
              .otherwise(F.lit("pending")))
    return table(spark, sf_dir, "orders").select(
        key.alias("order_id"), F.col("o_custkey").alias("customer_id"),
        _order_date().alias("order_date"), status.alias("status"),
        F.col("o_totalprice").alias("total_amount"))


def unit_price() -> F.Column:
    """Per-unit price in cents precision; the same expression is bit-equal in DuckDB."""
    return F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100 + 0.5) / 100


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"), unit_price().alias("unit_price"))


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four raw shop tables over the whole supplied tables (lazy)."""
    return {
        "customers": raw_customers(spark, sf_dir),
        "products": raw_products(spark, sf_dir),
        "orders": raw_orders(spark, sf_dir),
        "order_items": raw_order_items(spark, sf_dir),
    }


def retail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat invoice lines (open retail layout) built from lineitem and its dimensions.

    ``line_no`` is a struct ordering key standing in for file row order; it is
    unique over the lineitem columns it holds.
    """
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    j = (li.join(orders, li.l_orderkey == orders.o_orderkey)
         .join(cust, F.col("o_custkey") == F.col("c_custkey"))
         .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
         .join(part, F.col("l_partkey") == F.col("p_partkey")))
    return j.select(
        F.col("o_orderkey").cast("string").alias("InvoiceNo"),
        F.col("p_partkey").cast("string").alias("StockCode"),
        F.upper("p_name").alias("Description"),
        F.col("l_quantity").alias("Quantity"),
        F.col("o_orderdate").alias("InvoiceDate"),
        unit_price().alias("UnitPrice"),
        F.col("o_custkey").cast("double").alias("CustomerID"),
        F.col("n_name").alias("Country"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
                 "l_extendedprice", "l_quantity").alias("line_no"))
