"""Registered queries: name -> (spark, sf_dir) -> DataFrame over the whole supplied tables.

Every entry builds the warehouse lazily from the supplied Parquet files and
returns a DataFrame for the caller to execute.  A few entries write
intermediate data while they are built (the ingest's staged lines and dense
ids, the cohort cells, the CSV and stored-mart round trips), always into a
fresh folder under the session's checkpoint folder.  The matching DuckDB
statement for each name lives in ``oracle.statements``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import explore as X
from tillroll.operators import ingest as I
from tillroll.operators import metrics as M
from tillroll.operators import quality as Q
from tillroll.operators.keyed_series import daily_series_by, moving_average_by
from tillroll.operators.marts import fct_orders
from tillroll.operators.staging import stage as stage_raw
from tillroll.operators.staging import stg_order_items
from tillroll.plans.warehouse import store_category_bits, warehouse_from_testdata
from tillroll.session import ensure_checkpoint_dir
from tillroll.sources import tpch
from tillroll.sources.buckets import BucketStore, store_bucketed
from tillroll.sources.csvlines import CSV_OPTIONS, found_types, read_text_csv, with_types
from tillroll.sources.raw import read_raw, row_counts
from tillroll.sources.sinks import export_relations, materialize, write_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _wh(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return warehouse_from_testdata(spark, sf_dir)


# --- load profile, staging, marts ---------------------------------------------------------

@query
def raw_row_counts(spark, sf_dir):
    return row_counts(_wh(spark, sf_dir))


def _relation(name: str) -> Query:
    def q(spark, sf_dir):
        return _wh(spark, sf_dir)[name]
    q.__name__ = name
    return q


for _name in ("stg_customers", "stg_products", "stg_orders", "stg_order_items",
              "dim_customers", "dim_products", "fct_order_items", "fct_orders"):
    query(_relation(_name))


# --- metrics ----------------------------------------------------------------------------

def _metric(name: str) -> Query:
    def q(spark, sf_dir):
        return M.METRICS[name](_wh(spark, sf_dir)["fct_orders"])
    q.__name__ = name
    return q


for _name in sorted(M.METRICS):
    query(_metric(_name))


# --- explore: filtered series, top categories, KPI windows, cohorts ----------------------


# A dashboard selection exercising every filter branch (dates, country IN, category EXISTS)
SAMPLE_FILTERS = X.Filters(start="2000-12-31", end="1996-01-01",
                           countries=("NATION_1", "NATION_7", "NATION_13", "NATION_21"),
                           categories=("PROMO", "SMALL"))
AS_OF = "2001-08-15"


@query
def daily_series(spark, sf_dir):
    return X.daily_series(_wh(spark, sf_dir))


@query
def daily_series_filtered(spark, sf_dir):
    return X.daily_series(_wh(spark, sf_dir), SAMPLE_FILTERS)


@query
def filtered_orders(spark, sf_dir):
    """The orders passing the sample filter, joined to their customer (P8 as a relation)."""
    return X.filter_orders(_wh(spark, sf_dir), SAMPLE_FILTERS)


@query
def net_series(spark, sf_dir):
    return X.net_series(_wh(spark, sf_dir))


@query
def net_series_filtered(spark, sf_dir):
    return X.net_series(_wh(spark, sf_dir), SAMPLE_FILTERS)


@query
def top_categories(spark, sf_dir):
    return X.top_categories(_wh(spark, sf_dir))


@query
def top_categories_filtered(spark, sf_dir):
    return X.top_categories(_wh(spark, sf_dir), X.Filters(start="1996-01-01", end="2000-12-31",
                                                          countries=SAMPLE_FILTERS.countries,
                                                          categories=("PROMO", "SMALL", "LARGE")))


@query
def kpi_windows(spark, sf_dir):
    return X.kpi_windows(X.daily_series(_wh(spark, sf_dir), ordered=False))


@query
def net_gmv_30d(spark, sf_dir):
    return X.net_gmv_window(X.net_series(_wh(spark, sf_dir), ordered=False), 30)


@query
def daily_ma7(spark, sf_dir):
    return X.with_moving_average(X.daily_series(_wh(spark, sf_dir), ordered=False))


@query
def cohort_matrix(spark, sf_dir):
    return X.cohort_matrix(M.m_retention_cohort(_wh(spark, sf_dir)["fct_orders"], rate_digits=None, ordered=False))


@query
def filter_bounds(spark, sf_dir):
    return X.filter_bounds(_wh(spark, sf_dir)["fct_orders"], AS_OF)


@query
def filter_options(spark, sf_dir):
    return X.filter_options(_wh(spark, sf_dir))


@query
def metrics_eval_window(spark, sf_dir):
    return M.apply_eval_days(M.m_gmv_daily(_wh(spark, sf_dir)["fct_orders"]), 90, "2001-08-01")


# fixed values: the metric list of the example configuration
CONFIG_METRICS = ("m_gmv_daily", "m_orders_daily", "m_aov_daily", "m_active_customers_daily",
                  "m_retention_cohort", "m_net_gmv_daily")


@query
def metrics_manifest(spark, sf_dir):
    results = M.run_metrics(_wh(spark, sf_dir)["fct_orders"], enabled=CONFIG_METRICS,
                            eval_days=90, as_of="2001-08-01")
    return M.manifest(results)


# --- quality ------------------------------------------------------------------


# the default integrity rules plus the reverse rule "every order has item lines"
RI_RULES = (*Q.REFERENTIAL_INTEGRITY_RULES,
            {"name": "orders.order_id -> order_items.order_id", "left_table": "orders",
             "left_column": "order_id", "right_table": "order_items", "right_column": "order_id"})
QUALITY_CONFIG = {**Q.EXAMPLE_CONFIG, "referential_integrity": list(RI_RULES)}


def _render(checks):
    """Sample keys rendered as list text, so the result compares as flat columns."""
    return checks.withColumn("sample_rows", F.concat(F.lit("["), F.array_join("sample_rows", ", "),
                                                      F.lit("]")))


@query
def dq_null_rate(spark, sf_dir):
    return _render(Q.check_null_rate(_wh(spark, sf_dir), Q.EXAMPLE_CONFIG["null_rate_thresholds"]))


@query
def dq_pk_uniqueness(spark, sf_dir):
    return _render(Q.check_pk_uniqueness(_wh(spark, sf_dir), Q.EXAMPLE_CONFIG["pk_uniqueness"]))


@query
def dq_numeric_range(spark, sf_dir):
    return _render(Q.check_numeric_ranges(_wh(spark, sf_dir), Q.EXAMPLE_CONFIG["ranges"]))


@query
def dq_freshness(spark, sf_dir):
    return _render(Q.check_freshness(_wh(spark, sf_dir), Q.EXAMPLE_CONFIG["freshness"], AS_OF))


@query
def dq_referential_integrity(spark, sf_dir):
    return _render(Q.check_referential_integrity(_wh(spark, sf_dir), RI_RULES))


def _report(spark, sf_dir):
    return Q.run_quality(_wh(spark, sf_dir), QUALITY_CONFIG, AS_OF)


@query
def dq_report(spark, sf_dir):
    return _render(_report(spark, sf_dir))


@query
def dq_summary(spark, sf_dir):
    return Q.summarize(_report(spark, sf_dir))


@query
def dq_failed(spark, sf_dir):
    return Q.failed(_report(spark, sf_dir))


@query
def dq_warned(spark, sf_dir):
    return Q.warned(_report(spark, sf_dir))


@query
def user_sql_metric(spark, sf_dir):
    """A user's SQL metric over two relations of the warehouse, run by the metric runner."""
    sql = ("SELECT c.country, count(*) AS orders, count(DISTINCT o.customer_id) AS customers "
           "FROM fct_orders o JOIN dim_customers c ON o.customer_id = c.customer_id GROUP BY c.country")
    return M.run_metrics(_wh(spark, sf_dir), enabled=["by_country"], extra={"by_country": sql})["by_country"]


@query
def m_retention_null_dates(spark, sf_dir):
    """Retention where a seventh of the orders, and all orders of some customers, have no date."""
    fo = _wh(spark, sf_dir)["fct_orders"]
    blank = (F.col("order_id") % 7 == 0) | (F.col("customer_id") % 5 == 0)
    return M.m_retention_cohort(fo.withColumn("order_date", F.when(~blank, F.col("order_date"))))


@query
def stg_half_quantities(spark, sf_dir):
    """Staged items whose quantity is half of the supplied one, as DOUBLE: ties everywhere."""
    raw = tpch.raw_order_items(spark, sf_dir)
    return stg_order_items(raw.withColumn("quantity", F.col("quantity") / 2))


# --- open retail ingest ----------------------------------------------------------------------


CLEAN_COLUMNS = ("InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice",
                 "CustomerID", "Country", "customer_id", "order_date", "order_key")


@query
def retail_clean_lines(spark, sf_dir):
    return I.clean_lines(tpch.retail_lines(spark, sf_dir)).select(*CLEAN_COLUMNS)


@query
def retail_text_lines(spark, sf_dir):
    """Invoice lines as text: four date writings, numbers with decimals and exponents, and lines that must drop."""
    lines = tpch.retail_lines(spark, sf_dir)
    k = (F.col("InvoiceNo").cast("bigint") * 7 + F.col("StockCode").cast("bigint")) % 12
    day = F.col("InvoiceDate").cast("date")
    when = (F.when(k == 11, F.lit("no date")).when(k % 4 == 0, F.date_format(day, "yyyy-MM-dd"))
            .when(k % 4 == 1, F.date_format(day, "M/d/yyyy' 8:26'")).when(k % 4 == 2, F.date_format(day, "yyyyMMdd"))
            .otherwise(F.date_format(day, "d MMM yyyy")))
    whole = F.col("Quantity").cast("bigint").cast("string")
    quantity = F.when(k == 5, F.lit("-3")).when(k == 6, F.lit("0x1p3")).when(k == 7, F.lit("2f")).otherwise(whole)
    cents = F.round(F.col("UnitPrice") * 100).cast("bigint").cast("string")
    price = F.when(k == 8, F.lit("1d")).otherwise(F.concat(F.lit(" +"), cents, F.lit("e-2 ")))
    customer = F.when(k == 10, F.lit("abc")).when(k != 9, F.concat(F.col("CustomerID").cast("bigint").cast("string"), F.lit(".0")))
    text = lines.withColumns({"InvoiceDate": when, "Quantity": quantity, "UnitPrice": price, "CustomerID": customer})
    return I.clean_lines(text).select("InvoiceNo", "StockCode", "Quantity", "InvoiceDate", "UnitPrice", "customer_id",
                                      "order_date", "order_key")


@query
def retail_order_ids(spark, sf_dir):
    return I.dense_ids(I.clean_lines(tpch.retail_lines(spark, sf_dir)), "order_key", "order_id")


@query
def retail_product_ids(spark, sf_dir):
    return I.dense_ids(I.clean_lines(tpch.retail_lines(spark, sf_dir)), "StockCode", "product_id")


def _retail(name):
    def q(spark, sf_dir):
        return I.ingest_retail(tpch.retail_lines(spark, sf_dir))[name]
    q.__name__ = "retail_" + name
    return q


for _name in ("order_items", "orders", "customers", "products"):
    query(_retail(_name))


# --- sources and sinks round trips ----------------------------------------------------------


def _scratch(spark) -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tillroll-{uuid.uuid4().hex}"


def _awkward(raw):
    """The raw tables with quotes, commas, blanks and decimal-looking whole numbers in their values."""
    out = dict(raw)
    odd = F.col("customer_id") % 3
    out["customers"] = raw["customers"].select(
        F.concat(F.col("customer_id").cast("string"), F.lit(".0")).alias("customer_id"), "signup_date",
        F.when(odd == 0, F.concat(F.lit(' the "'), F.col("country"), F.lit('", north '))).otherwise(F.col("country")).alias("country"),
        F.when(odd == 1, F.concat(F.lit('"'), F.col("email"), F.lit('", x@Y.z'))).otherwise(F.col("email")).alias("email"))
    out["products"] = raw["products"].withColumn("category", F.concat(F.lit('  "'), F.col("category"), F.lit(', "" a,b  ')))
    out["order_items"] = raw["order_items"].withColumn("quantity", F.concat(F.col("quantity").cast("string"), F.lit(".00")))
    return out


def _csv_raw(spark, sf_dir):
    root = _scratch(spark)
    for name, df in _awkward(tpch.raw_tables(spark, sf_dir)).items():
        write_table(df, f"{root}/{name}.csv", "csv")
    return read_raw(spark, root, "csv")


@query
def raw_csv_row_counts(spark, sf_dir):
    """Raw tables written as CSV with header, then loaded with the declared schemas."""
    return row_counts(_csv_raw(spark, sf_dir))


def _csv_staged(name: str) -> Query:
    def q(spark, sf_dir):
        return stage_raw(_csv_raw(spark, sf_dir))["stg_" + name]
    q.__name__ = "csv_stg_" + name
    return q


for _name in ("customers", "products", "orders", "order_items"):
    query(_csv_staged(_name))


@query
def csv_line_breaks(spark, sf_dir):
    """Customers whose texts hold line breaks, blank lines and quotes, cut into records in parallel and staged."""
    root = _scratch(spark)
    for name, df in tpch.raw_tables(spark, sf_dir).items():
        if name == "customers":
            df = df.withColumns({
                "country": F.concat(F.col("country"), F.when(F.col("customer_id") % 3 == 0, F.lit('\n\n"north", \nor south')).otherwise("")),
                "email": F.when(F.col("customer_id") % 4 == 1, F.concat(F.lit('"\n'), F.col("email"), F.lit("\r\nx"))).otherwise(F.col("email"))})
        write_table(df, f"{root}/{name}.csv", "csv")
    return stage_raw(read_raw(spark, root, "csv"))["stg_customers"]


@query
def csv_column_types(spark, sf_dir):
    """Orders written as CSV, read back with the column types that all values have; ``types`` names them."""
    orders = tpch.raw_tables(spark, sf_dir)["orders"]
    k = F.col("order_id")
    path = f"{_scratch(spark)}/orders.csv"
    write_table(orders.select(
        "order_id", "order_date", "total_amount", (k % 2 == 0).alias("even"),
        F.when(k % 5 != 0, F.col("customer_id")).alias("customer"),
        F.when(k % 997 == 1, F.lit("none")).otherwise(F.col("customer_id").cast("string")).alias("mostly_number"),
        F.when(k % 997 == 1, F.col("total_amount")).otherwise(F.col("customer_id")).alias("mostly_whole"),
        F.concat(F.date_format("order_date", "yyyy-MM-dd"), F.when(k % 997 == 1, F.lit(" 12:30:00")).otherwise("")).alias("moment"),
        F.lit(None).cast("string").alias("nothing")), path, "csv")
    text = read_text_csv(spark, path)
    types = found_types(text)
    return with_types(text, types).withColumn("types", F.lit(", ".join(types.values())))


@query
def export_roundtrip(spark, sf_dir):
    """Customers with awkward texts, exported as CSV and read again by any RFC 4180 reader's rules."""
    raw = _awkward(tpch.raw_tables(spark, sf_dir))["customers"].select(
        F.col("customer_id").alias("id"), F.col("country").alias("label"), F.col("email").alias("note"))
    root = _scratch(spark)
    export_relations({"out_customers": raw}, root, ("out_",))
    return spark.read.options(**CSV_OPTIONS).schema("id string, label string, note string").csv(f"{root}/out_customers")


@query
def stored_fct_orders(spark, sf_dir):
    """fct_orders after a write to Parquet and a read back (the stored mart table)."""
    return materialize(spark, _wh(spark, sf_dir), _scratch(spark), ["fct_orders"])["fct_orders"]


def _hot_orders(spark, sf_dir) -> tuple[BucketStore, DataFrame]:
    """Item facts with a third of the lines in one order, stored in buckets by order, and the staged orders."""
    wh = _wh(spark, sf_dir)
    items = wh["fct_order_items"].withColumn("order_id", F.when(F.col("product_id") % 3 == 0, 1).otherwise(F.col("order_id")))
    name = f"tillroll_hot_{uuid.uuid4().hex[:12]}"
    return store_bucketed(items, name, f"{_scratch(spark)}/{name}", "order_id", 8), wh["stg_orders"]


@query
def stored_hot_orders(spark, sf_dir):
    """Stored lines joined with their orders; only the hot order's row is repeated."""
    store, orders = _hot_orders(spark, sf_dir)
    return store.joined(orders.select("order_id", "order_status", "order_date"), "left")


@query
def stored_hot_order_totals(spark, sf_dir):
    """Order facts from stored lines of which a third lie in one order."""
    store, orders = _hot_orders(spark, sf_dir)
    return fct_orders(orders, store)


@query
def filtered_orders_by_bits(spark, sf_dir):
    """The orders passing the sample filter, their categories tested by stored bits instead of the item lines."""
    return X.filter_orders(store_category_bits(spark, _wh(spark, sf_dir), _scratch(spark)), SAMPLE_FILTERS)


@query
def daily_ma7_by_country(spark, sf_dir):
    """Daily sales of every country over its own calendar with seven-day means, in blocks of 256 days."""
    return moving_average_by(daily_series_by(_wh(spark, sf_dir)), ["country"], block_days=256)
