"""Daily series of many keys with moving averages, in blocks of days: no key's history is one task's."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.money import cents, from_cents
from tillroll.operators.explore import Filters, Tables, orders_in_scope
from tillroll.operators.staging import PAID

# days of a block
BLOCK_DAYS = 1_024


def daily_series_by(t: Tables, by: str = "country", f: Filters = Filters()) -> DataFrame:
    """Paid orders in scope per value of a customer column and day: ``(by, metric_date, gmv, orders)``."""
    customers = t["dim_customers"]
    if f.countries:
        customers = customers.where(F.col("country").isin(list(f.countries)))
    orders = orders_in_scope(t, f, (PAID,)).select("customer_id", "order_date", cents("order_amount_from_items").alias("_c"))
    return (orders.join(customers.select("customer_id", by), "customer_id")
            .groupBy(by, F.col("order_date").alias("metric_date"))
            .agg(from_cents(F.sum("_c")).alias("gmv"), F.count(F.lit(1)).alias("orders")))


def moving_average_by(series: DataFrame, keys: Sequence[str], values: Sequence[str] = ("gmv", "orders"), n: int = 7,
                      money: Sequence[str] = ("gmv",), block_days: int = BLOCK_DAYS) -> DataFrame:
    """Per key a dense calendar from its first to its last date, missing days 0, and per value the mean of
    the last ``n`` days (fewer at the start), named ``<value>_ma<n>``.

    A key's days are cut into blocks on a fixed grid.  Each block also gets the ``n - 1`` days before it, so
    its averages need no other block; those days are left out of its result.  One shuffle, by key and block,
    holds at most ``block_days + n - 1`` days a group; rows that share a key and a date add up.  Rows without
    a date are left out, a NULL key is a key.
    """
    if block_days < n - 1:
        raise ValueError("a block must hold the days that an average looks back on")
    keys, values = list(keys), list(values)
    day, block = F.col("_day"), F.col("_block")
    number = lambda d: F.datediff(d, F.lit("1970-01-01").cast("date"))
    of = lambda d: F.floor(d / block_days).cast("int")
    rows = series.where(F.col("metric_date").isNotNull()).select(
        *keys, number("metric_date").alias("_day"),
        *[F.coalesce(cents(v) if v in money else F.col(v), F.lit(0)).cast("bigint").alias(v) for v in values])
    # a day near its block's end is also among the days before the next block
    twice = F.when(of(day + n - 1) > of(day), F.array(of(day), of(day) + 1)).otherwise(F.array(of(day)))
    placed = rows.select(*keys, F.explode(twice).alias("_block"), "_day", F.lit(None).cast("int").alias("_first"), *values)
    span = rows.groupBy(*keys).agg(F.min("_day").alias("_first"), F.max("_day").alias("_last"))
    blocks = span.select(*keys, "_first", "_last", F.explode(F.sequence(of(F.col("_first")), of(F.col("_last")))).alias("_block"))
    spine = blocks.select(
        *keys, "_block", "_first",
        F.explode(F.sequence(F.greatest("_first", block * block_days - (n - 1)),
                             F.least("_last", (block + 1) * block_days - 1))).alias("_day"),
        *[F.lit(0).cast("bigint").alias(v) for v in values])
    dense = (placed.unionByName(spine).repartition(*keys, "_block").groupBy(*keys, "_block", "_day")
             .agg(F.max("_first").alias("_first"), *[F.sum(v).alias(v) for v in values])
             .where(F.col("_first").isNotNull()))  # a key's last block hands no days on
    over = Window.partitionBy(*keys, "_block").orderBy("_day").rowsBetween(-(n - 1), 0)
    counted = F.count(F.lit(1)).over(over)
    out = [*keys, F.date_add(F.lit("1970-01-01").cast("date"), day).alias("metric_date"), "_block", "_day"]
    for v in values:
        mean = F.sum(v).over(over) / (counted * F.lit(100.0)) if v in money else (F.sum(v).over(over) / counted).cast("double")
        out += [(from_cents(v) if v in money else F.col(v)).alias(v), mean.alias(f"{v}_ma{n}")]
    return dense.select(*out).where(of(day) == block).drop("_block", "_day")
