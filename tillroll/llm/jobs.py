"""Helpers shared by the operators: staged tables, connected components, id filters, grouped streams."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.words import give_back
from tillroll.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tillroll-{label}-{uuid.uuid4().hex}"


def write_stage(df: DataFrame, label: str, *by: str) -> DataFrame:
    """Write ``df`` as Parquet into a fresh shared folder, in folders ``by`` columns, and return it re-read with its own schema.

    Cuts the lineage: a lost executor costs re-reading files, not re-running the plan.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, partitionBy=list(by) or None)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stage(spark: SparkSession, *frames: DataFrame, only: str = "") -> None:
    """Delete the folders of staged frames that nothing reads any more; with ``only`` the folders of that name."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for df in frames:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if only and not folder.endswith(f"/{only}"):
                continue
            if "/tillroll-" in folder and folder.split(":", 1)[-1].lstrip("/").startswith(
                    root.split(":", 1)[-1].lstrip("/")):
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(conf).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Have shuffle files deleted that no frame needs any more: Spark's cleaner follows the driver's collections."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether every node has one link at most to a smaller node, and no node has links both ways."""
    ends = edges.select(F.inline(F.array(F.struct(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                                         F.struct(F.col("b").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))))
    return ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where(
        "up > 1 or (up = 1 and down = 1)").isEmpty()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(id, component)`` of every node of ``edges (a, b)``; the component is its smallest id.

    Alternating large-star and small-star: every node's neighbours are re-linked to the smallest
    one until the links form stars.  Each half step is a join on the node, so a node with very many
    neighbours is split by the skewed-join rule, and its minimum is taken map-side first.  Only a
    yes or no per round reaches the driver.
    """
    spark = edges.sparkSession
    cur = write_stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .distinct(), "edges")
    for _ in range(max_rounds):
        if _is_star_forest(cur):
            break
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = write_stage(both.groupBy("a").agg(F.min("b").alias("m"))
                            .select("a", F.least("a", "m").alias("m")), "least")
        large = write_stage(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                            .where("a <> b").distinct(), "large")
        drop_stage(spark, cur, least)
        least = write_stage(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        cur = write_stage(large.join(least, "a").select(F.inline(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))))
            .where("a <> b").distinct(), "small")
        drop_stage(spark, large, least)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return cur.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        cur.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


# bits of the id filter: 4 MB at most; more ids only let more rows through to the exact join
FILTER_BITS = 25
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def _places(ids: np.ndarray, size: int) -> list[np.ndarray]:
    with np.errstate(over="ignore"):
        u = ids.astype(np.int64).view(np.uint64)
        return [((u ^ (u >> np.uint64(32))) * m) >> np.uint64(64 - size) for m in _ODD]


def folded(bits: np.ndarray) -> np.ndarray:
    """The bitmap in as few bits, a power of two, as keep 15 of 16 clear."""
    size = len(bits).bit_length() + 5
    marked = int(np.bitwise_count(bits).sum())
    least = max(6, (16 * max(marked, 1) - 1).bit_length())
    if least >= size:
        return bits
    at = np.flatnonzero(bits)
    out = np.zeros(1 << (least - 6), np.uint64)
    for j in range(64):
        place = (at[(bits[at] >> np.uint64(j)) & np.uint64(1) == 1] * 64 + j).astype(np.uint64) >> np.uint64(size - least)
        np.bitwise_or.at(out, (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
    return out


def id_filter(ids: DataFrame, size: int = FILTER_BITS):
    """A broadcast bitmap of at most 2**size bits that holds all long ids of the single-column frame.

    Every executor keeps a file of each bitmap, so that few ids get a smaller one.
    """
    spark = ids.sparkSession
    name = ids.columns[0]

    def marks(batches):
        bits = np.zeros(1 << (size - 6), np.uint64)
        for batch in batches:
            got = batch.column(0).to_numpy(zero_copy_only=False)
            for p in _places(got, size):
                np.bitwise_or.at(bits, (p >> np.uint64(6)).astype(np.int64), np.uint64(1) << (p & np.uint64(63)))
        at = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(bits[at].view(np.int64))], names=["at", "bits"])

    rows = (ids.select(F.col(name).cast("long")).where(F.col(name).isNotNull())
            .mapInArrow(marks, "at long, bits long")
            .groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow())
    bits = np.zeros(1 << (size - 6), np.uint64)
    bits[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(folded(bits))


def maybe_in(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which ids the bitmap may hold (never False for one that it holds)."""
    found = np.ones(len(ids), bool)
    for p in _places(ids, len(bits).bit_length() + 5):
        found &= ((bits[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1)).astype(bool)
    return found


def by_group(df: DataFrame, keys: list[str], fn: Callable[[tuple, pa.Table], Iterator[pa.RecordBatch]],
             schema: T.StructType | str) -> DataFrame:
    """Run ``fn(key values, rows)`` once per key, streaming over key-sorted partitions.

    Only one group's rows are held at a time; the caller keeps groups bounded.
    """
    def run(batches):
        held, at = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys]
            rows = list(zip(*cols))
            start = 0
            for i in range(1, len(rows) + 1):
                if i == len(rows) or rows[i] != rows[start]:
                    if at is not None and rows[start] != at:
                        yield from fn(at, pa.Table.from_batches(held))
                        held = []
                    at = rows[start]
                    held.append(batch.slice(start, i - start))
                    start = i
        if held:
            yield from fn(at, pa.Table.from_batches(held))
        give_back()

    return (df.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys).mapInArrow(run, schema))
