"""Target-distribution importance resampling over hashed word features (operator 13)."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.crc import crc32_spans
from tillroll.llm.jobs import write_stage
from tillroll.llm.spans import Spans, alnum_spans, places
from tillroll.llm.words import chunks


def _joined(words: Spans) -> Spans:
    """The same words, each text's one space apart in ``raw``."""
    size = words.end - words.start
    end = np.cumsum(size + 1) - 1 if len(size) else np.zeros(0, np.int64)
    raw = np.full(int((size + 1).sum()), 32, np.uint8)
    raw[places(end - size, size)] = words.raw[places(words.start, size)]
    return Spans(raw, end - size, end, words.bounds)


def buckets_of(texts: pa.Array, least: int, most: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each feature, text of each feature, words of each text).

    Features are all runs of ``least`` to ``most`` consecutive words, joined by one space; a feature's
    bucket is its UTF-8 bytes' CRC-32 modulo ``buckets``.
    """
    words = alnum_spans(texts)
    n_words = np.diff(words.bounds)
    owner = np.repeat(np.arange(len(n_words)), n_words)
    if most > 1:
        words = _joined(words)
    found, owners = [], []
    for n in range(least, most + 1):
        first = np.arange(max(0, len(owner) - n + 1))
        first = first[owner[first] == owner[first + n - 1]]
        found.append(crc32_spans(words.raw, words.start[first], words.end[first + n - 1]) % np.uint32(buckets))
        owners.append(owner[first])
    return np.concatenate(found).astype(np.int64), np.concatenate(owners), n_words


def bucket_counts(docs: DataFrame, least: int, most: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket: ``buckets`` numbers, added up in Spark."""
    def run(batches):
        held = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in chunks(batch):
                held += np.bincount(buckets_of(part.column(0), least, most, buckets)[0], minlength=buckets)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], names=["bucket", "n"])

    rows = (docs.select("text").mapInArrow(run, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros(buckets, np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def gains(raw: np.ndarray, target: np.ndarray, scale: int = 1000) -> np.ndarray:
    """Each bucket's floor(scale * log of its smoothed share of the target over that of the raw texts)."""
    size, s, t = len(raw), int(raw.sum()), int(target.sum())
    return np.array([math.floor(scale * math.log(float((b + 1) * (s + size)) / float((a + 1) * (t + size))))
                     for a, b in zip(raw.tolist(), target.tolist())], np.int64)


def resampled(docs: DataFrame, target: DataFrame, least: int = 1, most: int = 1, buckets: int = 10_000,
              percent: int = 10, min_words: int = 20, seed: int = 2024, scale: int = 1000) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score, rank)``, one row per row of ``docs``.

    Words are ASCII letters and digits (A-Z lower-cased) and characters beyond ASCII.  A text's features
    are its runs of ``least`` to ``most`` words, hashed into ``buckets`` by CRC-32; ``weight`` is the sum of
    the gains of their buckets (how much commoner a bucket is in ``target (text)`` than in ``docs``).  The
    score adds Gumbel noise that ``seed`` and the doc_id fix, so the highest scores are a draw without
    replacement with chances in proportion to exp(weight / scale).  Of the N texts with at least
    ``min_words`` words, floor(percent * N / 100) are drawn; ``rank`` is their place from 1 on, ties to the
    smaller doc_id, and null for all others.

    Only ``buckets`` counts a table reach the driver.  Scores are ranked by ranges and positions inside them,
    never in one task.  Null and empty texts have no features and weight 0 and are never drawn; without
    target texts the gains level the buckets.  A null doc_id takes the noise of an empty one and comes last
    in ties; repeated rows are drawn row by row, in any order among themselves.  An empty table gives
    no rows; other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(
        gains(bucket_counts(docs, least, most, buckets), bucket_counts(target, least, most, buckets), scale))

    def run(batches):
        for batch in batches:
            for part in chunks(batch):
                found, owner, n_words = buckets_of(part.column(1), least, most, buckets)
                n = len(n_words)
                weight = np.zeros(n, np.int64)
                np.add.at(weight, owner, table.value[found])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n_words.astype(np.int64)),
                     pa.array(np.bincount(owner, minlength=n).astype(np.int64)), pa.array(weight)],
                    names=["doc_id", "n_words", "n_features", "weight"])

    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-scale * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    weighed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_words long, n_features long, weight long")
    # the stored row number only parts rows that are alike
    scored = write_stage(weighed.withColumn("score", F.col("weight") + noise)
                         .withColumn("copy", F.monotonically_increasing_id()), "scored")
    long_enough = scored.where(F.col("n_words") >= min_words)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("copy")]
    ranged = write_stage(long_enough.repartitionByRange(*order).sortWithinPartitions(*order).withColumns(
        {"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()}), "ranged")
    sizes = ranged.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition of the ranges
    ahead = write_stage(sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead")), "ahead")
    drawn = ranged.count() * percent // 100
    rank = F.col("ahead") + F.col("place") - F.shiftleft(F.col("part").cast("long"), 33) + 1
    ranked = ranged.join(F.broadcast(ahead), "part").withColumn("rank", F.when(rank <= drawn, rank))
    columns = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return ranked.select(*columns).unionByName(
        scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long")).select(*columns))
