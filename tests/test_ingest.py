import datetime as dt

import pytest

from tillroll.operators.ingest import clean_lines, dense_ids, ingest_retail

COLS = ("InvoiceNo string, StockCode string, Description string, Quantity string, InvoiceDate string, "
        "UnitPrice string, CustomerID string, Country string, line_no long")


def _lines(spark):
    rows = [
        ("A1", "S1", "popcorn-holder set", "2", "2020-01-05 10:00:00", "1.25", "17", None, 1),
        ("A1", "S2", "", "1", "2020-01-05 10:00:00", "0.125", "17", "UK", 2),       # country after a NULL
        ("A1", "S3", None, "3", "2020-01-05 10:00:00", "2.00", "18", "FR", 3),      # same invoice, 2nd customer
        ("A2", "S1", "ignored later desc", "1", "2020-01-03 09:00:00", "1.30", "17", "DE", 4),
        ("A3", "S4", "...", "4", "2020-01-07 00:00:00", "3.10", None, "UK", 5),     # NULL customer: dropped
        ("A4", "S4", "...", "0", "2020-01-07 00:00:00", "3.10", "19", "UK", 6),     # quantity 0: dropped
        ("A5", "S4", "...", "x", "2020-01-07 00:00:00", "3.10", "19", "UK", 7),     # unparsable: dropped
        (" A6 ", " S5 ", "  -widget_  blue", "5", "2020-01-08 00:00:00", "0.99", "19", "UK", 8),
    ]
    return spark.createDataFrame(rows, COLS)


def test_clean_lines_filters_and_keys(spark):
    got = clean_lines(_lines(spark)).orderBy("line_no").collect()
    assert [r["line_no"] for r in got] == [1, 2, 3, 4, 8]
    assert [r["order_key"] for r in got] == ["A1::17", "A1::17", "A1::18", "A2::17", "A6::19"]
    assert got[-1]["StockCode"] == "S5" and got[0]["order_date"] == dt.date(2020, 1, 5)


def test_missing_columns_raise(spark):
    with pytest.raises(ValueError, match="Country"):
        clean_lines(spark.createDataFrame([("x",)], "InvoiceNo string"))


def test_dense_ids_equal_rank(spark):
    keys = spark.range(0, 5000).selectExpr("cast(id * 7919 % 5003 as string) as k")
    got = dict(dense_ids(keys, "k", "id", partitions=7).collect())
    expected = {k: i + 1 for i, k in enumerate(sorted({str(i * 7919 % 5003) for i in range(5000)}))}
    assert got == expected


def test_ingest_tables(spark):
    t = ingest_retail(_lines(spark), partitions=3)
    orders = {r["order_id"]: r for r in t["orders"].collect()}
    # order keys sorted: A1::17, A1::18, A2::17, A6::19
    assert sorted(orders) == [1, 2, 3, 4]
    assert orders[1]["customer_id"] == 17 and orders[1]["total_amount"] == 2.62
    assert orders[2]["customer_id"] == 18 and orders[3]["order_date"] == dt.date(2020, 1, 3)
    assert {r["status"] for r in orders.values()} == {"paid"}
    items = sorted(tuple(r) for r in t["order_items"].collect())
    assert (1, 2, 1, 0.12) in items  # 0.125 rounds half to even
    cust = {r["customer_id"]: r for r in t["customers"].collect()}
    assert cust[17]["country"] == "UK" and cust[17]["signup_date"] == dt.date(2020, 1, 3)
    assert cust[19]["email"] == "cust0000019@open-data.local"
    prods = {r["product_id"]: r["category"] for r in t["products"].collect()}
    # stock codes sorted: S1, S2, S3, S5
    assert prods == {1: "Popcorn-Holder", 2: "General", 3: "Nan", 4: "Widget"}
    assert {r["created_at"] for r in t["products"].collect()} == {dt.date(2020, 1, 3)}


def test_ingest_rejects_when_nothing_usable(spark):
    rows = [("A", "S", "d", "-1", "2020-01-01", "1.0", "1", "UK", 1)]
    for name in ("customers", "products", "orders", "order_items"):
        with pytest.raises(ValueError):
            ingest_retail(spark.createDataFrame(rows, COLS))[name]
    with pytest.raises(ValueError):
        ingest_retail(spark.createDataFrame(rows, COLS), stage=False)


def test_staged_folders_go_with_their_owner(spark):
    import os
    with ingest_retail(_lines(spark), partitions=3) as t:
        t["customers"].collect()
        assert "work" not in t.__dict__  # customers alone don't stage the lines
        t["orders"].collect()
        t["products"].collect()
        folders = {f.rsplit("/", 1)[0].removeprefix("file://") for df in t._folders for f in df.inputFiles()}
        assert len(folders) == 4 and all(map(os.path.isdir, folders))
    assert not any(map(os.path.isdir, folders))
