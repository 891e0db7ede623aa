"""Open retail ingest: flat invoice lines -> the four raw shop tables.

Input is a DataFrame of invoice lines (``InvoiceNo, StockCode, Description,
Quantity, InvoiceDate, UnitPrice, CustomerID, Country``) plus ``line_no``, an
orderable column giving source order (the "first" rules depend on it).  When
reading one CSV file, ``monotonically_increasing_id()`` taken right after the
scan follows file order and can serve as ``line_no``.

Everything is relational: coercing casts and filters are one projection;
orders, customers and products are grouped aggregates; the dense surrogate
ids are computed by range partitioning (see ``dense_ids``), never by a global
single-partition window.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.casts import computed_once, try_number, try_timestamp
from tillroll.functions.text import derive_category, strip
from tillroll.session import stage as stage_table
from tillroll.session import unstage
from tillroll.sources.schemas import RETAIL_LINE_COLUMNS

# fixed values: text of a missing key, order-key separator, status of ingested orders, email format
MISSING_TEXT = "nan"
ORDER_KEY_SEPARATOR = "::"
INGESTED_STATUS = "paid"
EMAIL_FORMAT = "cust%07d@open-data.local"

KEY_COLUMNS = ("CustomerID", "Quantity", "UnitPrice", "InvoiceDate", "InvoiceNo", "StockCode")
STAGED_COLUMNS = ("order_key", "StockCode", "customer_id", "order_date", "Quantity", "UnitPrice",
                  "Description", "Country", "line_no")


def require_columns(lines: DataFrame, required=RETAIL_LINE_COLUMNS) -> None:
    missing = sorted(set(required) - set(lines.columns))
    if missing:
        raise ValueError(f"the open dataset lacks the columns {missing}")


def _text_key(c: Column) -> Column:
    # a missing key becomes the text 'nan', as the source's str conversion does
    return strip(F.coalesce(c.cast("string"), F.lit(MISSING_TEXT)))


def clean_lines(lines: DataFrame) -> DataFrame:
    """Coerce, trim and filter the lines; add ``customer_id``, ``order_date`` and ``order_key``.

    Unparsable numbers and dates become NULL and drop out with the other NULL
    keys; only lines with positive quantity and price remain.  The order key
    is ``InvoiceNo::customer_id``, so one invoice with two customers yields two orders.
    """
    require_columns(lines)
    w = lines.select(
        _text_key(F.col("InvoiceNo")).alias("InvoiceNo"),
        _text_key(F.col("StockCode")).alias("StockCode"),
        F.col("Description").cast("string").alias("Description"),
        computed_once(
            try_number(F.col("Quantity")).alias("Quantity"),
            try_timestamp(F.col("InvoiceDate")).alias("InvoiceDate"),
            try_number(F.col("UnitPrice")).alias("UnitPrice"),
            try_number(F.col("CustomerID")).alias("CustomerID")),
        F.col("Country").cast("string").alias("Country"),
        F.col("line_no"),
    )
    w = w.dropna(subset=list(KEY_COLUMNS)).where((F.col("Quantity") > 0) & (F.col("UnitPrice") > 0))
    customer_id = F.col("CustomerID").cast("bigint")
    return w.select(
        "*", customer_id.alias("customer_id"), F.to_date("InvoiceDate").alias("order_date"),
        F.concat_ws(ORDER_KEY_SEPARATOR, F.col("InvoiceNo"), customer_id.cast("string")).alias("order_key"),
    )


def dense_ids(df: DataFrame, key: str, id_col: str, partitions: int | None = None,
              folders: list[DataFrame] | None = None) -> DataFrame:
    """``(key, id_col)``: the distinct non-NULL keys numbered 1..n in ascending order.

    Distinct keys are range-partitioned and sorted inside each partition, so a
    key's rank is (keys in earlier partitions) + (position in its partition).
    The partition number and position are stored with each key (Parquet in the
    shared checkpoint folder), so the counts and the positions come from one
    materialisation even if executors are lost.  The offsets table has one row
    per partition, which is what makes its broadcast safe.  The stored frame is
    added to ``folders``, whose owner deletes it.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = stage_table(
        df.select(key).where(F.col(key).isNotNull()).distinct()
        .repartitionByRange(n, key).sortWithinPartitions(key)
        .select(key, F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("_m")),
        "dense-ids")
    if folders is not None:
        folders.append(ranged)
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
               .select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")))
    local = F.col("_m") - F.shiftleft(F.col("_p").cast("bigint"), 33)
    return ranged.join(F.broadcast(offsets), "_p").select(key, (F.col("_off") + local + 1).alias(id_col))


def unit_price_2dp(x: Column) -> Column:
    """Price rounded to 2 places half-to-even on the scaled value (the source's rounding)."""
    return F.bround(x * F.lit(100.0)) / F.lit(100.0)


class RetailTables(Mapping):
    """The four raw tables of an ingest, each built when first asked for.

    Orders and items need the order ids, items and products the product ids; each dense-id table is
    computed (and staged) at most once.  The cleaned lines are staged once, by the first table that reads
    them more than once; customers alone are a single aggregate over the source.  ``close`` (or leaving
    a ``with`` block) deletes the staged folders, so do it when the tables have been written.
    """

    NAMES = ("customers", "products", "orders", "order_items")

    def __init__(self, lines: DataFrame, partitions: int | None = None, staged: bool = True):
        self.lines, self.partitions, self.staged = lines, partitions, staged
        self._built: dict[str, DataFrame] = {}
        self._folders: list[DataFrame] = []

    def __enter__(self) -> RetailTables:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        unstage(*self._folders)
        self._folders.clear()
        self._built.clear()
        for name in ("work", "order_ids", "product_ids"):
            self.__dict__.pop(name, None)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.NAMES:
            raise KeyError(name)
        if name not in self._built:
            self._built[name] = getattr(self, "_" + name)()
        return self._built[name]

    def __iter__(self):
        return iter(self.NAMES)

    def __len__(self) -> int:
        return len(self.NAMES)

    def _keep(self, df: DataFrame, label: str) -> DataFrame:
        df = stage_table(df, label)
        self._folders.append(df)
        if df.isEmpty():
            raise ValueError("no line of the open dataset is usable")
        return df

    @cached_property
    def work(self) -> DataFrame:
        """The cleaned lines, staged."""
        return self._keep(self.lines, "retail-lines") if self.staged else self.lines

    @cached_property
    def order_ids(self) -> DataFrame:
        return dense_ids(self.work, "order_key", "order_id", self.partitions, self._folders)

    @cached_property
    def product_ids(self) -> DataFrame:
        return dense_ids(self.work, "StockCode", "product_id", self.partitions, self._folders)

    def _order_items(self) -> DataFrame:
        return (self.work.join(self.order_ids, "order_key").join(self.product_ids, "StockCode")
                .select("order_id", "product_id", F.col("Quantity").cast("bigint").alias("quantity"),
                        unit_price_2dp(F.col("UnitPrice")).alias("unit_price")))

    def _orders(self) -> DataFrame:
        # per order key first (partial aggregates), then one id per key: the customer is part
        # of the key, so MIN is its only value; totals are exact cents of quantity x rounded price
        price_cents = F.round(unit_price_2dp(F.col("UnitPrice")) * 100).cast("bigint")
        per_key = (self.work.groupBy("order_key")
                   .agg(F.min("customer_id").alias("customer_id"), F.min("order_date").alias("order_date"),
                        F.sum(F.col("Quantity").cast("bigint") * price_cents).alias("_c")))
        return per_key.join(self.order_ids, "order_key").select(
            "order_id", "customer_id", "order_date", F.lit(INGESTED_STATUS).alias("status"),
            (F.col("_c") / F.lit(100.0)).alias("total_amount"))

    def _customers(self) -> DataFrame:
        # one aggregate: the lines are staged only if another table has done so
        lines = self.__dict__.get("work", self.lines)
        known = F.col("Country").isNotNull()
        out = (lines.groupBy("customer_id")
               .agg(F.min("order_date").alias("signup_date"),
                    F.min_by(F.when(known, F.col("Country")), F.when(known, F.col("line_no"))).alias("country"))
               .select("customer_id", "signup_date", "country",
                       F.format_string(EMAIL_FORMAT, F.col("customer_id")).alias("email")))
        return self._keep(out, "retail-customers") if self.staged else out

    def _products(self) -> DataFrame:
        first_day = self.work.select(F.min("order_date")).scalar()
        return (self.work.groupBy("StockCode")
                .agg(F.min_by(F.col("Description"), F.col("line_no")).alias("_desc"))
                .join(self.product_ids, "StockCode")
                .select("product_id", derive_category(F.col("_desc")).alias("category"),
                        first_day.alias("created_at")))


def ingest_retail(lines: DataFrame, partitions: int | None = None, stage: bool = True) -> RetailTables:
    """Flat invoice lines -> ``customers``, ``products``, ``orders``, ``order_items`` (raw layout).

    With ``stage`` (default) the cleaned lines are written once as Parquet in
    the shared checkpoint folder when a table needs them more than once, so the source (often CSV, or a
    join) is parsed once and a lost executor re-reads the staged lines.  Without a usable line the
    first table asked for raises.  Tables are built on first access; ``close`` them when done.
    """
    # only what the four tables read: the raw invoice number, customer number and timestamp live on
    # in order_key, customer_id and order_date
    work = clean_lines(lines).select(*STAGED_COLUMNS)
    if not stage and work.isEmpty():
        raise ValueError("no line of the open dataset is usable")
    return RetailTables(work, partitions, stage)
