import datetime as dt

import pandas as pd

from tillroll.operators import explore as X


def test_filters_swap_and_single_date(spark, warehouse):
    fo = warehouse["fct_orders"]
    lo, hi = X.Filters(start="2000-02-01", end="1999-01-01").date_range(fo)
    got = spark.range(1).select(lo, hi).first()
    assert tuple(got) == (dt.date(1999, 1, 1), dt.date(2000, 2, 1))
    lo, hi = X.Filters(start="1999-03-04").date_range(fo)
    assert tuple(spark.range(1).select(lo, hi).first()) == (dt.date(1999, 3, 4),) * 2


def test_moving_average_matches_pandas_rolling(spark):
    days = [dt.date(2020, 1, d) for d in (1, 2, 5, 6, 7, 8, 9, 10, 14)]
    gmv = [10.5, 3.25, 7.0, 1.0, 0.5, 8.75, 2.0, 4.0, 6.5]
    orders = [1, 2, 3, 1, 1, 4, 2, 1, 5]
    series = spark.createDataFrame(list(zip(days, gmv, orders)), "metric_date date, gmv double, orders long")
    got = X.with_moving_average(series).toPandas()
    ref = pd.DataFrame({"gmv": gmv, "orders": orders}, index=pd.DatetimeIndex(days))
    ref = ref.reindex(pd.date_range(days[0], days[-1], freq="D")).fillna(0)
    assert len(got) == len(ref) == 14
    assert (abs(got["gmv_ma7"].values - ref["gmv"].rolling(7, min_periods=1).mean().values) < 1e-9).all()
    assert (abs(got["orders_ma7"].values - ref["orders"].rolling(7, min_periods=1).mean().values) < 1e-9).all()


def test_kpi_windows_empty_series_gives_zeros(spark):
    empty = spark.createDataFrame([], "metric_date date, gmv double, orders long")
    row = X.kpi_windows(empty).first()
    assert (row["gmv_30d"], row["orders_30d"], row["gmv_90d"], row["orders_90d"], row["aov_90d"]) == (0, 0, 0, 0, 0)
    assert row["start_30d"] is None
    assert X.with_moving_average(empty).count() == 0
    assert X.net_gmv_window(spark.createDataFrame([], "metric_date date, net_gmv double")).first()[0] == 0.0


def test_kpi_windows_brute_force(spark):
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=3 * i) for i in range(50)]
    series = spark.createDataFrame([(d, float(i) + 0.25, i + 1) for i, d in enumerate(days)],
                                   "metric_date date, gmv double, orders long")
    row = X.kpi_windows(series).first()
    last = days[-1]
    w30 = [i for i, d in enumerate(days) if d >= last - dt.timedelta(days=29)]
    w90 = [i for i, d in enumerate(days) if d >= last - dt.timedelta(days=89)]
    assert row["orders_30d"] == sum(i + 1 for i in w30)
    assert abs(row["gmv_90d"] - sum(i + 0.25 for i in w90)) < 1e-9
    assert row["start_90d"] == days[w90[0]] and row["end_30d"] == last


def test_filter_bounds_default_to_as_of(spark, warehouse):
    none_paid = warehouse["fct_orders"].where("order_status = 'nothing'")
    row = X.filter_bounds(none_paid, "2022-02-02").first()
    assert tuple(row) == (dt.date(2022, 2, 2),) * 2


def test_category_filter_counts_whole_orders(spark, warehouse):
    f = X.Filters(categories=("PROMO",))
    with_cat = X.daily_series(warehouse, f).agg({"orders": "sum"}).first()[0]
    all_orders = X.daily_series(warehouse).agg({"orders": "sum"}).first()[0]
    assert 0 < with_cat < all_orders


def test_default_range_without_paid_orders_is_today(spark, warehouse):
    import pyspark.sql.functions as F
    no_paid = {**warehouse, "stg_orders": warehouse["stg_orders"].where("order_status <> 'paid'"),
               "fct_orders": warehouse["fct_orders"].where("order_status <> 'paid'")}
    lo, hi = X.Filters().date_range(no_paid["stg_orders"])
    today = spark.range(1).select(F.current_date()).first()[0]
    assert tuple(spark.range(1).select(lo, hi).first()) == (today, today)
