import os
import tempfile

import pytest

from tillroll.operators.metrics import run_metrics
from tillroll.plans.warehouse import register
from tillroll.sources.raw import read_raw, row_counts
from tillroll.sources.sinks import export_relations, list_relations, write_table


def test_read_raw_checks_every_file_first(spark, warehouse):
    root = tempfile.mkdtemp(prefix="tillroll-raw-")
    for name in ("customers", "products", "orders"):
        write_table(warehouse[name], os.path.join(root, f"{name}.csv"), "csv")
    with pytest.raises(FileNotFoundError, match="order_items"):
        read_raw(spark, root, "csv")
    write_table(warehouse["order_items"], os.path.join(root, "order_items.csv"), "csv")
    raw = read_raw(spark, root, "csv")
    got = {r["table"]: r["rows"] for r in row_counts(raw).collect()}
    want = {r["table"]: r["rows"] for r in row_counts(warehouse).collect()}
    assert got == want
    assert dict(raw["orders"].dtypes)["order_date"] == "date"


def _raw_folder(spark, warehouse, **texts):
    """CSV files of the four tables, some replaced by the given text."""
    root = tempfile.mkdtemp(prefix="tillroll-raw-")
    for name in ("customers", "products", "orders", "order_items"):
        if name in texts:
            with open(os.path.join(root, f"{name}.csv"), "w") as f:
                f.write(texts[name])
        else:
            write_table(warehouse[name].limit(3), os.path.join(root, f"{name}.csv"), "csv")
    return root


def test_csv_values_survive(spark, warehouse):
    rows = [(1, None, 'U ""K"", x', "b@x"), (2, None, " pad ", 'say "hi"'), (3, None, "a,b", ""), (4, None, None, None)]
    schema = "customer_id long, signup_date date, country string, email string"
    root = _raw_folder(spark, warehouse)
    write_table(spark.createDataFrame(rows, schema), os.path.join(root, "customers.csv"), "csv")
    # an empty text and a missing one are the same in a CSV file
    want = [tuple(v if v != "" else None for v in r) for r in rows]
    assert sorted(map(tuple, read_raw(spark, root)["customers"].collect())) == want
    text = 'email,customer_id,country,signup_date\n"x, ""y""",2.0,"two\nlines",2020-01-01\n'
    root = _raw_folder(spark, warehouse, customers=text)
    for multiline in (None, True):
        got = read_raw(spark, root, multiline=multiline)["customers"].collect()
        assert [(r.customer_id, r.country, r.email) for r in got] == [(2, "two\nlines", 'x, "y"')]
    with pytest.raises(Exception):  # where they aren't looked for, a break inside quotes raises instead of shifting values
        read_raw(spark, root, multiline=False)["customers"].collect()


def test_columns_beyond_the_schema_are_kept_with_their_types(spark, warehouse):
    text = 'score,customer_id,country,signup_date,email,"since, at",tag\n1,1,x,,,2020-01-01 10:00:00,007\n2.5,2,"a\nb",2020-01-01,,,b\n'
    got = read_raw(spark, _raw_folder(spark, warehouse, customers=text))["customers"]
    assert got.dtypes[4:] == [("score", "double"), ("since, at", "timestamp_ntz"), ("tag", "string")]
    assert sorted((r.customer_id, r.country, r.score, r.tag) for r in got.collect()) == [(1, "x", 1.0, "007"), (2, "a\nb", 2.5, "b")]


@pytest.mark.parametrize("name,text", [
    ("order_items", "order_id,product_id,quantity,unit_price\n1,2,x,3\n"),
    ("order_items", "order_id,product_id,quantity,unit_price\n1,2,1,oops\n"),
    ("orders", "order_id,customer_id,order_date,status,total_amount\n1,2,not-a-date,paid,3\n"),
    ("orders", "order_id,customer_id,order_date,status,total_amount\n1,2\n"),
    ("orders", "order_id,customer_id,status,total_amount\n1,2,paid,3\n")])
def test_bad_csv_raises(spark, warehouse, name, text):
    root = _raw_folder(spark, warehouse, **{name: text})
    with pytest.raises(Exception):
        read_raw(spark, root)[name].collect()


def test_sql_metric_reads_the_given_relations(spark, warehouse):
    register(warehouse)
    mine = {**warehouse, "fct_orders": warehouse["fct_orders"].limit(3)}
    res = run_metrics(mine, enabled=["n"], extra={"n": "SELECT count(*) AS n FROM fct_orders"})
    assert res["n"].first()["n"] == 3
    assert spark.table("fct_orders").count() == warehouse["fct_orders"].count()


def test_export_by_prefix(spark, warehouse):
    out = tempfile.mkdtemp(prefix="tillroll-export-")
    paths = export_relations(warehouse, out, ("dim_",))
    assert {os.path.basename(p) for p in paths} >= {"dim_customers", "dim_products"}
    assert [n for n in list_relations(spark, warehouse, ("stg_",)) if n in warehouse] == ["stg_customers", "stg_order_items", "stg_orders",
                                                          "stg_products"]


def test_user_metrics_function_and_sql(spark, warehouse):
    register(warehouse)
    extra = {
        "m_paid_orders_total": lambda fo: fo.where("order_status = 'paid'").groupBy().count(),
        "m_status_mix": "SELECT order_status, COUNT(*) AS n FROM fct_orders GROUP BY 1",
    }
    res = run_metrics(warehouse, enabled=["m_status_mix.sql", "m_paid_orders_total", "m_gmv_daily"],
                      extra=extra)
    assert list(res) == ["m_status_mix", "m_paid_orders_total", "m_gmv_daily"]
    mix = {r["order_status"]: r["n"] for r in res["m_status_mix"].collect()}
    assert mix["paid"] == res["m_paid_orders_total"].first()[0]
    assert set(mix) <= {"paid", "canceled", "refunded", "unknown"}


def test_eval_window_uses_first_date_column(spark, warehouse):
    res = run_metrics(warehouse["fct_orders"], enabled=["m_gmv_daily", "m_retention_cohort"], eval_days=60,
                      as_of="2001-08-01")
    assert min(r[0] for r in res["m_gmv_daily"].select("metric_date").collect()).isoformat() >= "2001-06-02"
    assert all(r[0].isoformat() >= "2001-06-02" for r in res["m_retention_cohort"].select("cohort_month").collect())
