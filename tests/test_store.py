"""Stored tables: replacing them safely, buckets with a hot key, category bits of orders."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from tillroll.operators import explore as X
from tillroll.operators.category_bits import category_codes, order_category_bits
from tillroll.operators.marts import fct_orders
from tillroll.plans.warehouse import store_category_bits
from tillroll.sources.buckets import SALT, store_bucketed
from tillroll.sources.replace import replace_table
from tillroll.sources.sinks import write_one_file, write_table


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def name(spark):
    out = f"t_{uuid.uuid4().hex[:10]}"
    yield out
    spark.sql(f"DROP TABLE IF EXISTS {out}")


def failing(df):
    """Some tasks write their rows, one raises."""
    return df.repartition(4).withColumn("id", F.when(F.spark_partition_id() == 3, F.raise_error(F.lit("half way")).cast("long"))
                                        .otherwise(F.col("id")))


def folders(root):
    return sorted(n for n in os.listdir(root) if os.path.isdir(os.path.join(root, n)))


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_a_failed_folder_write_leaves_the_old_rows(spark, tmp_path, fmt):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path, fmt)
    with pytest.raises(Exception, match="half way"):
        write_table(failing(spark.range(100)), path, fmt)
    read = lambda: sorted(int(r[0]) for r in spark.read.option("header", True).schema("id long").format(fmt).load(path).collect())
    assert read() == [0, 1, 2, 3, 4] and os.listdir(tmp_path) == ["t"]
    write_table(spark.read.schema("id long").option("header", True).format(fmt).load(path).where("id > 2"), path, fmt)  # from itself
    assert read() == [3, 4] and os.listdir(tmp_path) == ["t"]


def test_a_table_is_switched_to_its_new_version(spark, tmp_path, name):
    root = str(tmp_path / "v")
    replace_table(spark.range(5), name, root, layout=lambda w: w.bucketBy(2, "id").sortBy("id"))
    first = folders(root)
    reader = spark.table(name)  # resolved before the replace: still reads the version it was resolved to
    with pytest.raises(Exception, match="half way"):
        replace_table(failing(spark.range(100)), name, root, layout=lambda w: w.bucketBy(2, "id").sortBy("id"))
    assert spark.table(name).count() == 5 and folders(root) == first
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(name + "__")]
    replace_table(spark.range(10, 17), name, root, layout=lambda w: w.bucketBy(2, "id").sortBy("id"))
    assert sorted(r.id for r in spark.table(name).collect()) == list(range(10, 17))
    assert reader.count() in (5, 7) and len(folders(root)) == 2  # the version before stays for running readers
    assert "Exchange" not in plan_of(spark.table(name).groupBy("id").count())
    replace_table(spark.range(3), name, root, layout=lambda w: w.bucketBy(2, "id").sortBy("id"))
    assert spark.table(name).count() == 3 and len(folders(root)) == 2 and first[0] not in folders(root)


def test_other_columns_or_partitions_swap_names(spark, tmp_path, name):
    root = str(tmp_path / "v")
    replace_table(spark.range(5), name, root)
    replace_table(spark.range(4).withColumn("day", F.lit("x")), name, root)
    assert spark.table(name).columns == ["id", "day"] and spark.table(name).count() == 4
    for n in (3, 2):
        replace_table(spark.range(n).withColumn("day", F.lit("y")), name, root, ["day"])
        assert spark.table(name).where("day = 'y'").count() == n


@pytest.fixture(scope="module")
def hot(spark):
    """90,000 lines, a third of them in order 7, many of them alike, and some without an order."""
    k = F.col("id")
    return spark.range(90_000).select(
        F.when(k % 3 == 0, 7).when(k % 1000 == 1, None).otherwise(k % 20_011).cast("long").alias("order_id"),
        (k % 5).alias("product_id"), (k % 4).cast("int").alias("quantity"), F.lit(1.25).alias("unit_price"),
        (k % 4 * 1.25).alias("item_total"))


@pytest.fixture(scope="module")
def store(spark, hot, tmp_path_factory):
    table = f"t_{uuid.uuid4().hex[:10]}"
    yield store_bucketed(hot, table, str(tmp_path_factory.mktemp("hot")), "order_id", 8)
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_a_hot_order_is_dealt_over_the_buckets(store, hot):
    assert store.salted and {r.order_id for r in store.heavy.collect()} == {7}
    sizes = sorted(r["count"] for r in store.stored.groupBy(F.regexp_extract(F.input_file_name(), r"_(\d+)\.c", 1)).count().collect())
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[4]
    assert store.stored.where(F.col(SALT) == 0).where("order_id = 7").isEmpty()
    key = lambda df: sorted((tuple(r) for r in df.groupBy(*hot.columns).count().collect()), key=str)
    assert key(store.rows) == key(hot)


def test_sums_and_joins_read_the_hot_store_in_place(spark, store, hot):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sums = store.sums({"n": F.lit(1), "t": F.col("quantity")})
        want = hot.groupBy("order_id").agg(F.sum(F.lit(1)).alias("n"), F.sum("quantity").alias("t"))
        assert sorted(map(tuple, sums.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
        again = store.sums({"n": F.lit(1), "t": F.col("quantity")})
        assert plan_of(again).count("Exchange hashpartitioning") == 1  # of the hot order's partial sums alone
        orders = spark.range(0, 15_000).select(F.col("id").alias("order_id"), (F.col("id") % 9).alias("customer_id"))
        for how in ("inner", "left", "left_semi", "left_anti"):
            got = store.joined(orders, how)
            count = lambda df: sorted((tuple(r) for r in df.groupBy(*df.columns).count().collect()), key=str)
            expected = hot.join(orders, "order_id", how)
            assert count(got.select(*sorted(got.columns))) == count(expected.select(*sorted(expected.columns)))
        plan = plan_of(store.joined(orders))
        assert plan.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(order_id#" in plan
        assert store.spread(orders).count() == 15_000 - 1 + store.heavy.first()["pieces"]
        with pytest.raises(ValueError, match="right"):
            store.joined(orders, "right")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_order_facts_from_a_hot_store(spark, store, hot):
    orders = spark.range(0, 500).select(F.col("id").alias("order_id"), F.lit(1).cast("long").alias("customer_id"),
                                        F.lit(None).cast("date").alias("order_date"), F.lit("paid").alias("order_status"),
                                        F.lit(2.5).alias("total_amount"))
    assert sorted(map(tuple, fct_orders(orders, store).collect())) == sorted(map(tuple, fct_orders(orders, hot).collect()))


def test_without_a_hot_key_the_buckets_are_by_key(spark, tmp_path, name):
    even = spark.range(20_000).select((F.col("id") % 5000).alias("k"), F.col("id").alias("v"))
    got = store_bucketed(even, name, str(tmp_path / "e"), "k", 4)
    assert not got.salted and got.rows.columns == ["k", "v"] and got.spread(even) is even
    assert "Exchange" not in plan_of(got.rows.groupBy("k").count())
    assert got.sums({"n": F.lit(1)}).where("n <> 4").isEmpty()
    nothing = store_bucketed(even.where("false"), name, str(tmp_path / "e"), "k", 4)  # replaces it with an empty table
    assert nothing.rows.count() == 0 and nothing.joined(even).count() == 0


def test_category_bits_replace_the_items_scan(spark, warehouse, tmp_path):
    stored = store_category_bits(spark, warehouse, str(tmp_path))
    categories = [r[0] for r in stored["dim_categories"].orderBy("code").collect()]
    assert [r.code for r in stored["dim_categories"].orderBy("code").collect()] == list(range(len(categories)))
    for asked in (("PROMO", "SMALL"), (categories[-1],), ("no such category",), ("no such category", categories[0])):
        f = X.Filters(start="1996-01-01", end="2000-12-31", categories=asked)
        got = X.filter_orders(stored, f)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, X.filter_orders(warehouse, f).collect()), key=str)
        assert "lineitem" not in plan_of(got) and "product_id" not in plan_of(got)
        assert got.columns == X.filter_orders(warehouse, f).columns


def test_category_bits_grow_with_the_dictionary(spark):
    products = spark.range(500).select(F.col("id").alias("product_id"), F.format_string("c%03d", "id").alias("category")).unionByName(
        spark.createDataFrame([(1000, None)], "product_id long, category string"))
    lines = spark.createDataFrame([(1, 0), (1, 63), (1, 64), (1, 64), (1, 499), (2, 200), (3, 1000), (4, 5000)], "order_id long, product_id long")
    bits = {r.order_id: r.category_bits for r in order_category_bits(lines, products, category_codes(products)).collect()}
    assert bits == {1: {0: 1 - (1 << 63), 1: 1, 7: 1 << 51}, 2: {3: 1 << 8}}


def test_one_file_is_an_array_and_a_failed_task_leaves_none(spark, tmp_path):
    df = spark.createDataFrame([(3, None, "a,\"b\"\nc"), (1, 2.5, None)], "id long, x double, t string").withColumn(
        "day", F.lit("2020-01-02").cast("date"))
    for rows in (df, df.where("false")):
        for _ in range(2):  # a second write replaces the first
            write_one_file(rows, str(tmp_path / "m.json"), "json")
            write_one_file(rows, str(tmp_path / "m.csv"), "csv")
        want = [{"id": 3, "x": None, "t": "a,\"b\"\nc", "day": "2020-01-02"}, {"id": 1, "x": 2.5, "t": None, "day": "2020-01-02"}]
        assert json.load(open(tmp_path / "m.json")) == (want if rows is df else [])
        assert open(tmp_path / "m.csv").readline() == "id,x,t,day\n"
    with pytest.raises(Exception, match="half way"):
        write_one_file(failing(spark.range(10)), str(tmp_path / "none.json"), "json")
    with pytest.raises(Exception, match="half way"):
        write_one_file(failing(spark.range(10)), str(tmp_path / "m.json"), "json")
    assert json.load(open(tmp_path / "m.json")) == []
    assert sorted(n for n in os.listdir(tmp_path) if not n.endswith(".crc")) == ["m.csv", "m.json"]
