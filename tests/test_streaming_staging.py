"""The staging projections are stateless, so they run unchanged on a file stream."""

import os
import tempfile

from tillroll.operators.staging import stg_orders
from tillroll.sources.schemas import ORDERS
from tillroll.sources.sinks import write_table


def test_stg_orders_on_a_file_stream_equals_batch(spark, warehouse):
    root = tempfile.mkdtemp(prefix="tillroll-stream-")
    src = os.path.join(root, "orders")
    write_table(warehouse["orders"], src, "csv")
    stream = spark.readStream.schema(ORDERS).option("header", True).csv(src)
    query = (stg_orders(stream).writeStream.format("memory").queryName("stg_orders_stream")
             .option("checkpointLocation", os.path.join(root, "ckpt")).outputMode("append").start())
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    got = sorted(map(tuple, spark.table("stg_orders_stream").collect()))
    want = sorted(map(tuple, stg_orders(spark.read.schema(ORDERS).option("header", True).csv(src)).collect()))
    assert got == want and len(got) == warehouse["orders"].count()
