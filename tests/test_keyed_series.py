"""Moving averages of many keys in blocks of days, against a plain computation."""

import collections
import datetime as dt
import random

import pytest

from tillroll.operators.keyed_series import moving_average_by

START = dt.date(1969, 12, 20)  # the grid of blocks begins at 1970-01-01: days before it count too


def expected(rows, n):
    by = collections.defaultdict(lambda: collections.defaultdict(lambda: [0, 0]))
    for key, day, gmv, orders in rows:
        if day is not None:
            by[key][day][0] += round((gmv or 0) * 100)
            by[key][day][1] += orders or 0
    out = []
    for key, days in by.items():
        line = [min(days) + dt.timedelta(i) for i in range((max(days) - min(days)).days + 1)]
        vals = [days[d] if d in days else [0, 0] for d in line]
        for i, d in enumerate(line):
            last = vals[max(0, i - n + 1):i + 1]
            out.append((key, d, vals[i][0] / 100, sum(v[0] for v in last) / (len(last) * 100.0), vals[i][1], sum(v[1] for v in last) / len(last)))
    return sorted(out, key=str)


@pytest.mark.parametrize("n, block_days", [(7, 6), (7, 1024), (3, 5), (1, 1)])
def test_blocks_change_nothing(spark, n, block_days):
    rng = random.Random(n)
    rows = [(rng.choice(["a", "b", None]), START + dt.timedelta(rng.randint(0, 70)), rng.randint(0, 900) / 4, rng.randint(0, 5)) for _ in range(60)]
    rows += [("lone", START, 1.0, 1), ("gap", START, None, None), ("gap", START + dt.timedelta(40), 2.0, 1), ("none", None, 1.0, 1)]
    df = spark.createDataFrame(rows, "k string, metric_date date, gmv double, orders long")
    got = moving_average_by(df, ["k"], n=n, block_days=block_days)
    assert got.columns == ["k", "metric_date", "gmv", f"gmv_ma{n}", "orders", f"orders_ma{n}"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows, n)


def test_one_shuffle_of_days_and_bounded_groups(spark):
    df = spark.range(10).selectExpr("id % 2 AS k", "date_add(DATE'2020-01-01', int(id * 100)) AS metric_date", "1.0D AS gmv", "1L AS orders")
    plan = moving_average_by(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(k") + plan.count("Exchange hashpartitioning(_") == 2  # days, and each key's span
    assert moving_average_by(df.where("false"), ["k"]).collect() == []
    with pytest.raises(ValueError, match="look"):
        moving_average_by(df, ["k"], n=7, block_days=5)
