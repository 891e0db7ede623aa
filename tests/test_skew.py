"""Hot keys: one customer with a third of the orders, one order and one product with a third of the lines.

AQE's skew-join split is forced on with tiny thresholds so the split path really runs; results are
compared with a brute-force pandas computation of the same rules.
"""

import datetime as dt
import random

import pandas as pd
import pytest

from tillroll.operators import explore as X
from tillroll.operators import metrics as M
from tillroll.operators import quality as Q
from tillroll.plans.warehouse import build

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture(scope="module")
def skewed(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    rnd = random.Random(7)
    day0 = dt.date(2021, 1, 1)
    customers = [(c, day0, f" c{c % 5} ", f"u{c}@x.io") for c in range(1, 61)]
    products = [(p, f"cat{p % 7}", day0) for p in range(1, 31)]
    statuses = ["paid", " PAID ", "refunded", "Canceled", "other"]
    orders = []
    for o in range(1, 3001):
        cust = 1 if o % 3 == 0 else rnd.randint(2, 60)
        orders.append((o, cust, day0 + dt.timedelta(days=rnd.randint(0, 89)), statuses[o % 5 if o % 4 else 0],
                       round(rnd.uniform(1, 500), 2)))
    items = []
    for i in range(9000):
        order = 1 if i % 3 == 0 else rnd.randint(1, 3000)
        product = 1 if i % 3 == 1 else rnd.randint(1, 30)
        items.append((order, product, rnd.randint(1, 5), round(rnd.uniform(0.5, 99.0), 3)))
    raw = {
        "customers": spark.createDataFrame(customers, "customer_id long, signup_date date, country string, email string"),
        "products": spark.createDataFrame(products, "product_id long, category string, created_at date"),
        "orders": spark.createDataFrame(orders, "order_id long, customer_id long, order_date date, status string, "
                                                "total_amount double"),
        "order_items": spark.createDataFrame(items, "order_id long, product_id long, quantity int, unit_price double"),
    }
    frames = {
        "orders": pd.DataFrame(orders, columns=["order_id", "customer_id", "order_date", "status", "total_amount"]),
        "items": pd.DataFrame(items, columns=["order_id", "product_id", "quantity", "unit_price"]),
        "customers": pd.DataFrame(customers, columns=["customer_id", "signup_date", "country", "email"]),
        "products": pd.DataFrame(products, columns=["product_id", "category", "created_at"]),
    }
    yield build(raw), frames
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _cents(x):
    # round half away from zero of x * 100, as the SQL rounding does
    import math
    y = x * 100
    return int(math.floor(abs(y) + 0.5)) * (1 if y >= 0 else -1)


def _paid(frames):
    o = frames["orders"].copy()
    o["st"] = o["status"].str.strip().str.lower()
    it = frames["items"].copy()
    it["c"] = [_cents(q * p) for q, p in zip(it["quantity"], it["unit_price"])]
    per_order = it.groupby("order_id")["c"].sum()
    o["c"] = o["order_id"].map(per_order).fillna(0).astype("int64")
    return o, it


def test_daily_gmv_and_series_with_a_hot_customer(skewed):
    tables, frames = skewed
    o, _ = _paid(frames)
    paid = o[o["st"] == "paid"]
    want = {d: c / 100.0 for d, c in paid.groupby("order_date")["c"].sum().items()}
    got = {r["metric_date"]: r["gmv"] for r in M.m_gmv_daily(tables["fct_orders"]).collect()}
    assert got == want
    series = X.daily_series(tables)
    rows = series.collect()
    assert {r["metric_date"]: r["gmv"] for r in rows} == want
    assert sum(r["orders"] for r in rows) == len(paid)
    assert "skew=true" in series._jdf.queryExecution().executedPlan().toString()  # hot customer split


def test_top_categories_with_hot_order_and_product(skewed):
    tables, frames = skewed
    o, it = _paid(frames)
    paid_ids = set(o[o["st"] == "paid"]["order_id"])
    lines = it[it["order_id"].isin(paid_ids)].merge(frames["products"], on="product_id")
    want = lines.groupby("category")["c"].sum().sort_values(ascending=False)
    df = X.top_categories(tables, k=10)
    got = [(r["category"], r["gmv"]) for r in df.collect()]
    assert got == sorted(((k, v / 100.0) for k, v in want.items()), key=lambda kv: (-kv[1], kv[0]))[:10]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan  # AQE split the hot order / product partition


def test_key_and_integrity_checks_with_hot_keys(skewed):
    tables, frames = skewed
    dup_items = len(frames["items"]) - frames["items"]["order_id"].nunique()
    row = Q.check_pk_uniqueness(tables, ["order_items.order_id"]).first()
    assert row["observed"] == dup_items
    rule = {"name": "r", "left_table": "order_items", "left_column": "order_id",
            "right_table": "customers", "right_column": "customer_id"}
    missing = frames["items"][~frames["items"]["order_id"].isin(frames["customers"]["customer_id"])]
    row = Q.check_referential_integrity(tables, [rule]).first()
    assert row["missing_count"] == len(missing)
    assert row["sample_rows"] == [str(k) for k in sorted(missing["order_id"])[:5]]
