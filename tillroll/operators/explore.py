"""Filtered analytics over the marts: series, top categories, KPI windows, cohorts.

Scale notes
-----------
* Filters are plain predicates on ``fct_orders`` (pushed to the scan) plus a
  ``left_semi`` join for the category EXISTS test; the semi join's right side
  is reduced to distinct order ids first, so a hot order cannot skew it.  The
  default date range comes from ONE scalar subquery over the staged orders.
* Each join shuffles only its key and is followed by a partial (map-side)
  aggregate, so after the last join only one row per group and task moves.
  A hot join key (one customer or order holding a third of the rows) is split
  by AQE's skew-join handling (``spark.sql.adaptive.skewJoin.enabled``), which
  divides the large side's partition and replicates the small side's.
  Pre-aggregating below the joins was measured to cost an extra full shuffle
  (orders carry only a few lines each), so it is not done here.
* Top categories joins the item lines to the filtered orders BEFORE the
  product join, so only lines in scope reach the second shuffle.
* Results that are one row per calendar day (moving averages, KPI windows) are
  bounded by the calendar, not by the data volume.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.dates import as_date_lit
from tillroll.functions.money import cents, div_half_away, from_cents
from tillroll.operators.metrics import signed_cents
from tillroll.operators.category_bits import BITS, holds_any
from tillroll.operators.staging import PAID, REFUNDED
from tillroll.session import stage

Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class Filters:
    """Dashboard filter state.  ``start``/``end`` default to the paid-order date bounds;
    reversed dates are swapped; a single date means a one-day range."""

    start: _dt.date | str | None = None
    end: _dt.date | str | None = None
    countries: Sequence[str] = field(default_factory=tuple)
    categories: Sequence[str] = field(default_factory=tuple)

    def date_range(self, orders: DataFrame) -> tuple[Column, Column]:
        start, end = self.start, self.end
        if isinstance(start, str):
            start = _dt.date.fromisoformat(start)
        if isinstance(end, str):
            end = _dt.date.fromisoformat(end)
        if start is not None and end is None:
            end = start
        if end is not None and start is None:
            start = end
        if start is not None:
            if start > end:
                start, end = end, start
            return F.lit(start).cast("date"), F.lit(end).cast("date")
        return paid_date_bounds(orders)


def paid_date_bounds(orders: DataFrame) -> tuple[Column, Column]:
    """MIN / MAX paid order date from ONE scalar subquery (evaluated once, used as literals).

    ``orders`` is ``stg_orders`` or ``fct_orders``: both have one row per order
    with the same date and status, and the staged one avoids the item join.
    """
    paid = orders.where(F.col("order_status") == PAID)
    bounds = paid.select(F.struct(F.min("order_date").alias("lo"), F.max("order_date").alias("hi"))).scalar()
    # no paid order at all: the range is today..today
    return F.coalesce(bounds["lo"], F.current_date()), F.coalesce(bounds["hi"], F.current_date())


def _order_dates(t: Tables) -> DataFrame:
    return t["stg_orders"] if "stg_orders" in t else t["fct_orders"]


def orders_with_categories(t: Tables, categories: Sequence[str]) -> DataFrame:
    """Distinct order ids having at least one item whose product is in ``categories``."""
    products = t["dim_products"].where(F.col("category").isin(list(categories))).select("product_id")
    return (t["fct_order_items"].select("order_id", "product_id")
            .join(products, "product_id", "left_semi").select("order_id").distinct())


def customers_in_scope(t: Tables, f: Filters) -> DataFrame:
    c = t["dim_customers"].select("customer_id", "country")
    if f.countries:
        c = c.where(F.col("country").isin(list(f.countries)))
    return c.select("customer_id")


def orders_in_scope(t: Tables, f: Filters, statuses: Sequence[str] = (PAID,),
                    category_exists: bool = True) -> DataFrame:
    """Order-level predicates of the filter (status, date range, category EXISTS), before the customer join."""
    fo = t["fct_orders"]
    if f.start is None and f.end is None and tuple(statuses) == (PAID,):
        dated = F.col("order_date").isNotNull()  # any dated paid order lies between the first and the last one
    else:
        dated = F.col("order_date").between(*f.date_range(_order_dates(t)))
    o = fo.where(F.col("order_status").isin(list(statuses)) & dated)
    stored = BITS in fo.columns and "dim_categories" in t
    if category_exists and f.categories:
        if stored:  # the item lines aren't read
            o = o.where(holds_any(t["dim_categories"], f.categories))
        else:
            o = o.join(orders_with_categories(t, f.categories), "order_id", "left_semi")
    return o.drop(BITS)


def filter_orders(t: Tables, f: Filters = Filters(), statuses: Sequence[str] = (PAID,)) -> DataFrame:
    """Orders passing the filter, joined to their customer (orders without a customer drop out)."""
    return orders_in_scope(t, f, statuses).join(customers_in_scope(t, f), "customer_id")


def _series(t: Tables, f: Filters, statuses: Sequence[str], amount: Column) -> DataFrame:
    scoped = (orders_in_scope(t, f, statuses).select("customer_id", "order_date", amount.alias("_a"))
              .join(customers_in_scope(t, f), "customer_id"))
    return (scoped.groupBy(F.col("order_date").alias("metric_date"))
            .agg(F.sum("_a").alias("_c"), F.count(F.lit(1)).alias("_n")))


def daily_series(t: Tables, f: Filters = Filters(), ordered: bool = True) -> DataFrame:
    """Paid orders in scope per day: ``metric_date, gmv, orders``; ``ordered`` sorts for display."""
    s = _series(t, f, (PAID,), cents("order_amount_from_items"))
    s = s.select("metric_date", from_cents("_c").alias("gmv"), F.col("_n").alias("orders"))
    return s.orderBy(F.col("metric_date").asc_nulls_last()) if ordered else s


def net_series(t: Tables, f: Filters = Filters(), ordered: bool = True) -> DataFrame:
    """Paid minus refunded per day: ``metric_date, net_gmv``; ``ordered`` sorts for display."""
    s = _series(t, f, (PAID, REFUNDED), signed_cents(F.col("order_status"), F.col("order_amount_from_items")))
    s = s.select("metric_date", from_cents("_c").alias("net_gmv"))
    return s.orderBy(F.col("metric_date").asc_nulls_last()) if ordered else s


def top_categories(t: Tables, f: Filters = Filters(), k: int = 10) -> DataFrame:
    """Top ``k`` categories by GMV of paid item lines in scope (ties broken by category name)."""
    products = t["dim_products"].select("product_id", "category")
    if f.categories:
        products = products.where(F.col("category").isin(list(f.categories)))
    scope = (orders_in_scope(t, f, (PAID,), category_exists=False).select("order_id", "customer_id")
             .join(customers_in_scope(t, f), "customer_id").select("order_id"))
    lines = t["fct_order_items"].select("order_id", "product_id", cents("item_total").alias("_c"))
    return (lines.join(scope, "order_id").join(products, "product_id")
            .groupBy("category").agg(from_cents(F.sum("_c")).alias("gmv"))
            .orderBy(F.col("gmv").desc_nulls_last(), F.col("category").asc_nulls_last())
            .limit(k))


def _last_date() -> Column:
    # the series has one row per day, so this whole-series window is bounded by the calendar
    return F.max("metric_date").over(Window.partitionBy())


def kpi_windows(series: DataFrame) -> DataFrame:
    """GMV / orders over the 30 and 90 days ending at the series' last date, AOV over 90 days,
    and the first / last date present in each window.  An empty series gives zeros.

    One pass over the series: the last date comes from a window over the
    per-day rows instead of a second evaluation of the series.
    """
    s = series.select("metric_date", cents("gmv").alias("_c"), F.col("orders").alias("_o"),
                      _last_date().alias("_ref"))
    in30 = F.col("metric_date") >= F.date_sub("_ref", 29)
    in90 = F.col("metric_date") >= F.date_sub("_ref", 89)
    zero = F.lit(0).cast("bigint")
    agg = s.agg(
        F.coalesce(F.sum(F.when(in30, F.col("_c"))), zero).alias("c30"),
        F.coalesce(F.sum(F.when(in30, F.col("_o"))), zero).alias("orders_30d"),
        F.coalesce(F.sum(F.when(in90, F.col("_c"))), zero).alias("c90"),
        F.coalesce(F.sum(F.when(in90, F.col("_o"))), zero).alias("orders_90d"),
        F.min(F.when(in30, F.col("metric_date"))).alias("start_30d"),
        F.max(F.when(in30, F.col("metric_date"))).alias("end_30d"),
        F.min(F.when(in90, F.col("metric_date"))).alias("start_90d"),
        F.max(F.when(in90, F.col("metric_date"))).alias("end_90d"),
    )
    return agg.select(
        from_cents("c30").alias("gmv_30d"), "orders_30d",
        from_cents("c90").alias("gmv_90d"), "orders_90d",
        from_cents(F.coalesce(div_half_away("c90", "orders_90d"), zero)).alias("aov_90d"),
        "start_30d", "end_30d", "start_90d", "end_90d",
    )


def net_gmv_window(net: DataFrame, days: int = 30) -> DataFrame:
    """Net GMV over the ``days`` ending at the net series' own last date (0 when empty)."""
    s = net.select("metric_date", cents("net_gmv").alias("_c"), _last_date().alias("_ref"))
    inside = F.col("metric_date") >= F.date_sub("_ref", days - 1)
    c = F.coalesce(F.sum(F.when(inside, F.col("_c"))), F.lit(0).cast("bigint"))
    return s.agg(from_cents(c).alias(f"net_gmv_{days}d"))


def with_moving_average(series: DataFrame, values: Sequence[str] = ("gmv", "orders"),
                        n: int = 7, money: Sequence[str] = ("gmv",)) -> DataFrame:
    """Dense daily calendar from the first to the last date, missing days 0, plus a trailing
    ``n``-row mean (at least one row) per value column, named ``<value>_ma<n>``.

    One pass: each present day expands to itself plus the missing days up to
    the next present day (``lead`` + ``sequence``), then the moving window runs
    over the same date order.  Both windows hold one row per calendar day, so
    the single ordered partition is bounded by the date range, not the data.
    """
    by_date = Window.orderBy("metric_date")
    nxt = F.lead("metric_date").over(by_date)
    vals = [(cents(v) if v in money else F.col(v)).alias(v) for v in values]
    s = series.select("metric_date", *vals, nxt.alias("_next"))
    last = F.coalesce(F.date_sub("_next", 1), F.col("metric_date"))
    day = F.explode(F.sequence("metric_date", last, F.expr("INTERVAL 1 DAY"))).alias("_day")
    dense = s.select(day, "metric_date", *values)
    filled = [F.when(F.col("_day") == F.col("metric_date"), F.coalesce(F.col(v), F.lit(0)))
              .otherwise(F.lit(0)).cast("bigint").alias(v) for v in values]
    dense = dense.select(F.col("_day").alias("metric_date"), *filled)
    w = by_date.rowsBetween(-(n - 1), 0)
    rows = F.count(F.lit(1)).over(w)
    out = [F.col("metric_date")]
    for v in values:
        if v in money:
            out.append(from_cents(v).alias(v))
            out.append((F.sum(v).over(w) / (rows * F.lit(100.0))).alias(f"{v}_ma{n}"))
        else:
            out.append(F.col(v))
            out.append((F.sum(v).over(w) / rows).cast("double").alias(f"{v}_ma{n}"))
    return dense.select(*out).orderBy(F.col("metric_date").asc_nulls_last())


def cohort_matrix(retention: DataFrame) -> DataFrame:
    """Cohort x month_n matrix of retention rates; ``cohort_size`` first; empty cells stay NULL.

    Cells without a month (orders without a date) have no column and are left out.

    The retention cells (cohorts x months, a calendar-bounded set) are written
    once to the shared checkpoint folder; the distinct month offsets are read
    from them to fix the pivot schema, and the pivot reads them again instead
    of recomputing the cohorts.
    """
    cells = stage(retention.select("cohort_month", "cohort_size", "month_n", "retention_rate")
                  .where(F.col("month_n").isNotNull()), "cohorts")
    months = [r[0] for r in cells.select("month_n").distinct().orderBy("month_n").collect()]
    return (cells.groupBy("cohort_month", "cohort_size")
            .pivot("month_n", months)
            .agg(F.first("retention_rate"))
            .orderBy(F.col("cohort_month").asc_nulls_last()))


def filter_bounds(fct_orders: DataFrame, as_of: _dt.date | str | None = None) -> DataFrame:
    """MIN / MAX paid order date; both fall back to ``as_of`` (default today) when there is none."""
    agg = fct_orders.where(F.col("order_status") == PAID).agg(
        F.min("order_date").alias("lo"), F.max("order_date").alias("hi"))
    none = F.col("lo").isNull() | F.col("hi").isNull()
    today = as_date_lit(as_of)
    return agg.select(F.when(none, today).otherwise(F.col("lo")).alias("min_date"),
                      F.when(none, today).otherwise(F.col("hi")).alias("max_date"))


def filter_options(t: Tables) -> DataFrame:
    """Distinct countries and categories seen on paid orders: ``(option, value)``, NULLs dropped.

    Only distinct keys cross each join: paid order ids -> product ids -> categories.
    """
    paid = t["fct_orders"].where(F.col("order_status") == PAID)
    cust_ids = paid.select("customer_id").distinct()
    countries = (t["dim_customers"].select("customer_id", "country").join(cust_ids, "customer_id")
                 .select(F.lit("country").alias("option"), F.col("country").alias("value")))
    product_ids = (t["fct_order_items"].select("order_id", "product_id")
                   .join(paid.select("order_id").distinct(), "order_id", "left_semi")
                   .select("product_id").distinct())
    categories = (t["dim_products"].select("product_id", "category").join(product_ids, "product_id")
                  .select(F.lit("category").alias("option"), F.col("category").alias("value")))
    return (countries.unionByName(categories).where(F.col("value").isNotNull()).distinct()
            .orderBy("option", F.col("value").asc_nulls_last()))
