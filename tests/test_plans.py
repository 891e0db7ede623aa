"""Physical-plan properties that matter at scale, checked on every registered query."""

import re

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
             "FlatMapGroupsInPandas", "MapInPandas")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def no_auto_broadcast(spark):
    """As at 100 TB: no table is small enough for an automatic broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry._LLM_QUERIES)))
def test_no_python_no_cross_join_no_unbounded_broadcast(spark, no_auto_broadcast, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"
    # the only explicit broadcasts: dense-id offsets, one row per range partition, and a store's heavy keys, at
    # most sixteen per bucket
    broadcasts = plan.count("BroadcastExchange")
    assert broadcasts == 0 or name in {"retail_order_ids", "retail_product_ids", "retail_order_items",
                                       "retail_orders", "retail_products", "stored_hot_orders"}, f"{name}: {broadcasts} broadcasts"


def test_partial_aggregation_before_every_daily_shuffle(spark):
    plan = plan_of(entry.queries()["m_gmv_daily"](spark, SF))
    assert "partial_sum" in plan
    # the item totals per order are pre-aggregated map-side as well
    assert plan.count("partial_sum") >= 2


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(entry.queries()["m_orders_daily"](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    orders = [s for s in schemas if "o_orderkey" in s or "o_orderdate" in s]
    assert orders and all("o_totalprice" not in s and "o_orderpriority" not in s for s in orders)


def test_item_join_is_pruned_when_no_item_column_is_used(spark):
    plan = plan_of(entry.queries()["filter_bounds"](spark, SF))
    assert "lineitem" not in plan


def test_referential_integrity_shuffles_each_side_once(spark, no_auto_broadcast):
    from tillroll.operators import quality as Q
    from tillroll.plans.warehouse import warehouse_from_testdata
    t = warehouse_from_testdata(spark, SF)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rule = {"name": "x", "left_table": "order_items", "left_column": "order_id",
                "right_table": "orders", "right_column": "order_id"}
        plan = plan_of(Q.missing_references(t, rule))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 2
    assert "partial_count" in plan


def test_key_rules_on_one_column_share_a_shuffle(spark):
    """Uniqueness and integrity rules over the same column reuse one key-count exchange."""
    df = entry.queries()["dq_report"](spark, SF)
    df.collect()
    final = plan_of(df)
    assert "isFinalPlan=true" in final
    reused = re.findall(r"ReusedExchange \[([a-z_]+)#\d+L?, count#", final)
    assert {"order_id", "customer_id", "product_id"} <= set(reused)


def test_eval_window_reaches_the_scan(spark, tmp_path):
    """The date filter is pushed to a stored table, and prunes the folders of a date-partitioned one."""
    from tillroll.operators import metrics as M
    fo = entry.queries()["fct_orders"](spark, SF).where("order_date BETWEEN DATE'2001-07-01' AND DATE'2001-07-10'")
    fo.write.parquet(str(tmp_path / "plain"))
    fo.write.partitionBy("order_date").parquet(str(tmp_path / "dated"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    for folder, found in (("plain", r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(order_date,2001-07-04\)"),
                          ("dated", r"PartitionFilters: \[[^\]]*order_date")):
        df = M.apply_eval_days(M.m_gmv_daily(spark.read.parquet(str(tmp_path / folder))), 28, "2001-08-01")
        assert re.search(found, plan_of(df)), folder


@pytest.mark.parametrize("name", ["kpi_windows", "net_gmv_30d", "daily_ma7", "daily_series", "top_categories"])
def test_no_range_sort_below_windows_and_no_extra_pass_for_dates(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    if name not in ("daily_series", "top_categories"):
        ranges = plan.count("rangepartitioning")
        assert ranges <= (1 if name == "daily_ma7" else 0)
    if name != "net_gmv_30d":
        assert "Subquery" not in plan or "o_orderdate" not in plan.split("Subquery", 1)[1].split("lo#")[0]


def test_entry_imports_without_a_session():
    import subprocess
    import sys
    code = "import __spark_entry__ as e; from pyspark import SparkContext as c; assert c._active_spark_context is None; e.queries()"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=entry._ROOT)


def test_a_date_is_parsed_once_per_line(spark):
    """Each format stands once in the plan: the shape of the text picks one of them, no filter repeats it."""
    from tillroll.functions.casts import TIMESTAMP_SHAPES
    plan = entry.queries()["retail_text_lines"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("gettimestamp") == len(TIMESTAMP_SHAPES)
