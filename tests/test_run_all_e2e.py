import json
import os
import tempfile

from tillroll.plans.warehouse import RELATIONS, run_all
from tillroll.sources import tpch


def test_run_all_small(spark):
    out = tempfile.mkdtemp(prefix="tillroll-e2e-")
    cfg = {"quality": {"null_rate_thresholds": {"customers.email": {"warn": 0.01, "fail": 0.03}},
                       "pk_uniqueness": ["orders.order_id"]},
           "metrics": {"eval_days": 90, "enabled": ["m_gmv_daily", "m_net_gmv_daily", "m_retention_cohort"]}}
    res = run_all(spark, tpch.raw_tables(spark, "/root/testdata/sf0.001"), out, cfg, as_of="2001-08-15",
                  order_buckets=4)
    assert set(RELATIONS) <= set(res["tables"])
    from tillroll.plans.warehouse import build
    lazy = build(tpch.raw_tables(spark, "/root/testdata/sf0.001"))["fct_orders"]
    assert sorted(map(tuple, res["tables"]["fct_orders"].collect())) == sorted(map(tuple, lazy.collect()))
    assert res["metrics"] == ["m_gmv_daily", "m_net_gmv_daily", "m_retention_cohort"]
    assert set(res["quality_summary"]) >= {"pass", "warn", "fail"}
    assert res["contract_ok"] is True
    for sub in ("staging/stg_orders", "marts/fct_orders", "warehouse/fct_orders", "contract"):
        assert os.path.isdir(os.path.join(out, sub)), sub
    for sub in ("metrics/m_gmv_daily.csv", "metrics/m_net_gmv_daily.csv", "metrics/m_retention_cohort.json",
                "metrics/metrics_manifest.json", "quality/checks.json", "quality/summary.json"):
        assert os.path.isfile(os.path.join(out, sub)), sub
    daily = json.load(open(os.path.join(out, "metrics/m_gmv_daily.json")))
    assert [d["metric_date"] for d in daily] == sorted(d["metric_date"] for d in daily)
    assert {c["status"] for c in json.load(open(os.path.join(out, "quality/checks.json")))} <= {"pass", "warn", "fail"}
    manifest = spark.read.json(os.path.join(out, "metrics/metrics_manifest.json")).collect()
    assert {r["metric"] for r in manifest} == set(res["metrics"])
    for r in manifest:  # the counts are those of the written outputs
        assert r["rows"] == spark.read.option("header", True).csv(r["csv"]).count()
        assert r["rows"] == spark.read.json(r["json"]).count()
    summary = spark.read.json(os.path.join(out, "quality/summary.json")).first()
    assert summary["generated_at"] == "2001-08-15"
    assert set(summary["summary"].asDict()) >= {"pass", "warn", "fail"}  # an object, not text


def test_partitioned_fct_orders_prunes_by_date(spark):
    import re

    from tillroll.operators.explore import Filters, daily_series
    from tillroll.plans.warehouse import build
    from tillroll.sources.sinks import materialize
    out = tempfile.mkdtemp(prefix="tillroll-part-")
    built = build(tpch.raw_tables(spark, "/root/testdata/sf0.001"))
    # a one-quarter fixture keeps the folder count small; the filter below stays inside it
    built["fct_orders"] = built["fct_orders"].where("order_date BETWEEN DATE'2000-01-01' AND DATE'2000-03-31'")
    stored = materialize(spark, built, out, ["fct_orders"], {"fct_orders": ["order_date"]})
    assert stored["fct_orders"].columns == built["fct_orders"].columns
    s = daily_series(stored, Filters(start="2000-01-01", end="2000-01-31"))
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*order_date", plan)
    want = daily_series(built, Filters(start="2000-01-01", end="2000-01-31")).collect()
    assert sorted(map(tuple, s.collect())) == sorted(map(tuple, want))


def test_bucketed_items_build_orders_without_an_item_shuffle(spark):
    from tillroll.operators.marts import fct_orders
    from tillroll.plans.warehouse import build
    from tillroll.sources.sinks import materialize
    out = tempfile.mkdtemp(prefix="tillroll-bucket-")
    built = build(tpch.raw_tables(spark, "/root/testdata/sf0.001"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as at scale
    try:
        stored = materialize(spark, built, out, ["fct_order_items"], bucket_by={"fct_order_items": (8, "order_id")})
        facts = fct_orders(built["stg_orders"], stored["fct_order_items"])
        plan = facts._jdf.queryExecution().executedPlan().toString()
        # only the staged orders are shuffled on order_id; the stored items are read in their buckets
        assert plan.count("Exchange hashpartitioning(order_id") == 1
        assert sorted(map(tuple, facts.collect())) == sorted(map(tuple, built["fct_orders"].collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_run_all_stores_raw_once_and_takes_user_metrics_checks_and_relations(spark):
    out = tempfile.mkdtemp(prefix="tillroll-user-")
    raw = tpch.raw_tables(spark, "/root/testdata/sf0.001")
    seen = spark.sparkContext.accumulator(0)

    def counted(rows):
        for batch in rows:
            seen.add(batch.num_rows)
            yield batch
    raw["order_items"] = raw["order_items"].mapInArrow(counted, raw["order_items"].schema)
    raw["order_items"].sparkSession.range(3).createOrReplaceTempView("fct_of_user")
    check = lambda tables, cfg: tables["orders"].selectExpr("'mine' AS check_type", "'orders' AS target",
                                                            "'pass' AS status").limit(1)
    try:
        res = run_all(spark, raw, out, {"quality": {}, "metrics": {"enabled": ["mine", "m_gmv_daily"]}}, as_of="2001-08-15",
                      extra_metrics={"mine": "SELECT count(*) AS n FROM order_items JOIN orders USING (order_id)"},
                      extra_checks={"mine": check}, partition_orders_by_date=False)
    finally:
        spark.catalog.dropTempView("fct_of_user")
    assert seen.value == 6000  # the source's item lines were read once
    assert spark.read.json(os.path.join(out, "metrics/mine.json")).first()["n"] == 6000
    assert spark.read.json(os.path.join(out, "quality/checks.json")).where("check_type = 'mine'").count() == 1
    assert spark.read.option("header", True).csv(os.path.join(out, "marts/fct_of_user")).count() == 3
    assert res["metrics"] == ["m_gmv_daily", "mine"]


def test_daily_facts_give_the_daily_metrics(spark, warehouse):
    from tillroll.operators import metrics as M
    fo = warehouse["fct_orders"].selectExpr("* except (customer_id, order_date)", "if(customer_id % 9 = 0, NULL, customer_id) AS customer_id",
                                            "if(order_id % 11 = 0, NULL, order_date) AS order_date")
    for name, fn in M.FROM_DAILY_FACTS.items():
        assert fn(M.daily_facts(fo)).collect() == M.METRICS[name](fo).collect(), name
