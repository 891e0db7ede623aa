"""Warehouse composition: raw -> staging -> marts, as lazy DataFrames.

Nothing runs until a sink or an action; dependencies are function calls, not
file-name order.  ``register`` exposes every relation as a temp view so SQL
metrics and checks can name them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.operators.category_bits import category_codes, order_category_bits, with_category_bits
from tillroll.operators.marts import build_marts, fct_orders
from tillroll.operators.staging import stage
from tillroll.sources import tpch
from tillroll.sources.sinks import materialize

# fixed values: the twelve relations of the warehouse, in layer order
RELATIONS = (
    "customers", "products", "orders", "order_items",
    "stg_customers", "stg_products", "stg_orders", "stg_order_items",
    "dim_customers", "dim_products", "fct_orders", "fct_order_items",
)


def build(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All twelve relations from the four raw tables."""
    staged = stage(raw)
    return {**raw, **staged, **build_marts(staged)}


def register(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return tables


def warehouse_from_testdata(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The warehouse over the supplied Parquet tables (adapter + build)."""
    return build(tpch.raw_tables(spark, sf_dir))


def store_category_bits(spark: SparkSession, tables: dict[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """The relations with stored order facts that know their categories: ``dim_categories``, ``fct_orders.category_bits``.

    Category filters (``explore.orders_in_scope``) then test bits of the orders and don't read the item lines.
    """
    out = materialize(spark, {**tables, "dim_categories": category_codes(tables["dim_products"])}, root, ["dim_categories"])
    bits = order_category_bits(out["fct_order_items"], out["dim_products"], out["dim_categories"])
    return materialize(spark, {**out, "fct_orders": with_category_bits(out["fct_orders"], bits)}, root, ["fct_orders"])


MARTS = ("dim_customers", "dim_products", "fct_order_items", "fct_orders")


def run_all(spark: SparkSession, raw: dict[str, DataFrame], out_dir: str, config: dict | None = None,
            as_of=None, contract: dict | None = None, partition_orders_by_date: bool = False,
            order_buckets: int | None = None, extra_metrics: dict | None = None,
            extra_checks: dict | None = None) -> dict:
    """Build, store and check the warehouse: the whole batch run.

    Raw tables and marts are written as Parquet tables under ``out_dir/warehouse`` and read
    back, so the source is parsed once and metrics and checks scan stored tables; staging and marts,
    and catalog relations with the same prefixes, are exported as CSV; metrics, the manifest, the quality report and the
    contract result are written under ``out_dir``.  Failing quality checks do
    not fail the run; the returned ``contract_ok`` tells whether the contract held.
    ``partition_orders_by_date`` stores ``fct_orders`` in one folder per order
    date, so the dashboards' date ranges prune files (worth it at scale, where
    a day holds many row groups; at small scale it only makes many small files).
    ``order_buckets`` stores both fact tables bucketed by ``order_id``: the
    order facts are then built from the stored items without shuffling them,
    and later order-id joins between the facts need no shuffle either.
    ``extra_metrics`` (functions of ``fct_orders`` or SQL over the relations) and ``extra_checks``
    (functions of the relations and the configuration) run with the built-in ones.
    """
    import datetime as _dt
    import os

    from tillroll.operators.contract import SCHEMA_V1, validate_contract
    from tillroll.operators.metrics import daily_facts, run_metrics
    from tillroll.operators.quality import EXAMPLE_CONFIG, run_quality
    from tillroll.session import stage as stage_table
    from tillroll.session import unstage
    from tillroll.sources.sinks import export_relations, write_checks, write_metrics, write_table

    cfg = config or {"quality": EXAMPLE_CONFIG, "metrics": {}}
    parts = {"fct_orders": ["order_date"]} if partition_orders_by_date else None
    root = os.path.join(out_dir, "warehouse")
    raw = materialize(spark, raw, root, tuple(raw))
    # store the item facts first, then build the order facts from the stored items
    buckets = ({"fct_order_items": (order_buckets, "order_id"), "fct_orders": (order_buckets, "order_id")}
               if order_buckets else None)
    stores: dict = {}
    tables = materialize(spark, build(raw), root, ("dim_customers", "dim_products", "fct_order_items"),
                         bucket_by=buckets, stores=stores)
    tables["fct_orders"] = fct_orders(tables["stg_orders"], stores.get("fct_order_items", tables["fct_order_items"]))
    tables = materialize(spark, tables, root, ("fct_orders",), parts, buckets)
    register(tables)
    export_relations(tables, os.path.join(out_dir, "staging"), ("stg_",))
    export_relations(tables, os.path.join(out_dir, "marts"), ("dim_", "fct_"))

    mcfg = cfg.get("metrics", {}) or {}
    daily = stage_table(daily_facts(tables["fct_orders"]), "daily")  # one row per day feeds all daily metrics
    results = run_metrics(tables, mcfg.get("enabled"), mcfg.get("disabled"), mcfg.get("eval_days"), as_of,
                          extra_metrics, daily)
    manifest = write_metrics(results, os.path.join(out_dir, "metrics"))
    unstage(daily)

    checks = run_quality(tables, cfg.get("quality", {}), as_of, extra_checks)
    today = (as_of if isinstance(as_of, str) else (as_of or _dt.date.today()).isoformat())
    report = write_checks(checks, os.path.join(out_dir, "quality"), today)

    contract_rows = validate_contract(tables, contract or SCHEMA_V1)
    write_table(contract_rows, os.path.join(out_dir, "contract"), "json")
    contract_ok = contract_rows.where("status <> 'pass'").limit(1).count() == 0
    return {"tables": tables, "metrics": sorted(results), "manifest": manifest,
            "quality_summary": report["counts"], "contract_ok": contract_ok}
