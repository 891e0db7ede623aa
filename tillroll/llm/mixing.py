"""Mixing sources to target weights with exact block quotas per output shard (operator 3)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.jobs import write_stage

WORD = r"[^\x20\x09-\x0D]+"
# one row per source is planned on the driver; more distinct sources than this are refused
MAX_SOURCES = 1_000_000
BLOCK_WORDS = 8_192
SHARD_WORDS = 1_000_000
# numpy draws the splits exactly below this many blocks; larger corpora get larger blocks
MAX_BLOCKS = 100_000_000
# each search level for a source's last document looks at this many ranges of the permutation
DIGIT_BITS, LEVELS, KEY_BITS = 12, 2, 62


@dataclass
class Mix:
    """``documents``: (doc_id, key, source_no, size, source_size, target, copies, rows), one row per distinct
    document row; ``drawn``: (doc_id, key, copy, shard, position)."""

    documents: DataFrame
    drawn: DataFrame
    shards: int


def targets(sizes: Sequence[int], weights: Sequence[int], ratio: Fraction, most: int) -> list[Fraction]:
    """Words to take per source: shares by weight of ``ratio`` times all words, at most ``most`` times a source."""
    open_, out = set(range(len(sizes))), [Fraction(0)] * len(sizes)
    rest = min(ratio * sum(sizes), Fraction(most * sum(sizes)))
    while open_:
        total = sum(weights[i] for i in open_)
        above = {i for i in open_ if rest * weights[i] > total * most * sizes[i]}
        if not above:
            for i in open_:
                out[i] = rest * weights[i] / total
            break
        for i in above:
            out[i] = Fraction(most * sizes[i])
            rest -= out[i]
        open_ -= above
    return out


def split_tree(quota: np.ndarray, shards: int, seed: int, wanted: Sequence[int]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For the wanted shards: (first block, number of blocks) per source.

    A node's blocks are split between its halves by one multivariate hypergeometric draw, seeded by
    the node, so any task can walk to its own leaves and all tasks agree.  The left half takes the
    first blocks of every source's permuted sequence, the right half the next ones.
    """
    out: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    stack = [(0, shards, np.zeros(len(quota), np.int64), quota.astype(np.int64), sorted(set(wanted)))]
    while stack:
        lo, hi, first, count, asked = stack.pop()
        if not asked:
            continue
        if hi - lo == 1:
            out[lo] = (first, count)
            continue
        mid = (lo + hi) // 2
        total = int(count.sum())
        part = (total * (mid - lo) + (hi - lo) // 2) // (hi - lo)
        rng = np.random.default_rng([seed, lo, hi])
        left = rng.multivariate_hypergeometric(count, part, method="marginals") if total else count
        stack.append((lo, mid, first, left, [s for s in asked if s < mid]))
        stack.append((mid, hi, first + left, count - left, [s for s in asked if s >= mid]))
    return out


def row_key(seed: int):
    """Place of a document in the permutation, from its id, source and text: equal rows share it."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "source", "text"), 64 - KEY_BITS)


def mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), ratio: Fraction = Fraction(3, 2), most: int = 2,
        seed: int = 3, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS) -> Mix:
    """Draw a mix of ``ratio`` times all words in which sources have their target shares.

    A document's size is its number of words (null text: 0).  Sources in code point order, null last,
    weigh ``weights``, repeating; a source gives at most ``most`` times its size, the excess is shared
    out again.  A keyed hash permutes each source's documents; equal ranges of it are the source's
    blocks.  The source is taken whole as often as its target allows, then from the front of the
    permutation up to the document where the words come nearest to the target.  The splitting tree
    gives every shard an exact number of blocks per source, the shard gets the next such blocks of the
    sequence, disjoint from all others, and orders its documents by another keyed hash.

    Documents without words are never taken.  Rows alike in doc_id, source and text are taken alike,
    each as often; null ids and sources take part.  An empty table gives an empty mix.  Other columns
    are ignored.  Reruns give the same rows.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
                       .alias("size"), row_key(seed).alias("key"))
    units = write_stage(rows.groupBy("doc_id", "source", "key", "size").agg(F.count("*").alias("rows")), "units")
    found = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("words")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [int(r["words"]) for r in found]
    aim = targets(sizes, [weights[i % len(weights)] for i in range(len(found))], Fraction(ratio), most)
    total = int(sum(aim))
    block_words = max(block_words, -(-2 * sum(sizes) // MAX_BLOCKS))
    blocks = [max(1, -(-s // block_words)) for s in sizes]
    full = [int(t // s) if s else 0 for t, s in zip(aim, sizes)]
    plan = spark.createDataFrame(
        [(r["source"], i, s, float(t), f, float(t - f * s), b)
         for i, (r, s, t, f, b) in enumerate(zip(found, sizes, aim, full, blocks))],
        "source string, source_no int, source_size long, target double, full int, rest double, blocks long")
    numbered = write_stage(units.join(plan, units["source"].eqNullSafe(plan["source"]))
                           .drop(plan["source"]).drop("source"), "numbered")

    # the key below which the words come nearest to the rest, found by ranges of ranges of the key
    worded = numbered.where("rest > 0 and size > 0")
    cut = plan.select("source_no", F.lit(0).cast("long").alias("low"), F.col("rest").alias("need"))
    shift = KEY_BITS
    for _ in range(LEVELS):
        shift -= DIGIT_BITS
        digit = F.shiftright(F.col("key") - F.col("low"), shift)
        inside = worded.join(cut, "source_no").withColumn("digit", digit).where(
            F.col("digit").between(0, (1 << DIGIT_BITS) - 1))
        sums = write_stage(inside.groupBy("source_no", "low", "need", "digit").agg(
            F.sum(F.col("size") * F.col("rows")).alias("words")), "digits")
        w = Window.partitionBy("source_no").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
        cut = write_stage(
            sums.withColumn("before", F.coalesce(F.sum("words").over(w), F.lit(0)))
            .where("before <= need").groupBy("source_no").agg(F.max_by(F.struct(
                (F.col("low") + F.col("digit") * F.lit(1 << shift)).alias("low"),
                (F.col("need") - F.col("before")).alias("need")), "digit").alias("c"))
            .select("source_no", "c.low", "c.need"), "cut")
    near = worded.join(cut, "source_no").where((F.col("key") >= F.col("low")) &
                                               (F.shiftright(F.col("key") - F.col("low"), shift) == 0))
    w = Window.partitionBy("source_no").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    last = write_stage(
        near.withColumn("w", F.col("size") * F.col("rows")).withColumn("before", F.coalesce(F.sum("w").over(w), F.lit(0)))
        .withColumn("taken", F.col("before") + F.col("w") / 2 <= F.col("need"))
        .groupBy("source_no").agg(F.max("low").alias("low"), F.max(F.when(F.col("taken"), F.col("key"))).alias("top")), "last")
    copies = F.col("full") + F.when((F.col("rest") > 0) & (F.col("key") <= F.coalesce("top", F.col("low") - 1)), 1).otherwise(0)
    block = F.least(F.floor(F.col("key") / F.lit(float(1 << KEY_BITS)) * F.col("blocks")), F.col("blocks") - 1).cast("long")
    documents = write_stage(
        numbered.join(last, "source_no", "left")
        .withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(0)).withColumn("block", block)
        .select("doc_id", "key", "source_no", "size", "source_size", "target", "copies", "rows", "block", "blocks"),
        "documents")

    # block quotas: whole passes and the blocks that the last pass touches
    touched = documents.where("copies > 0").groupBy("source_no").agg(F.max(
        (F.col("copies") - 1) * F.col("blocks") + F.col("block") + 1).alias("quota")).collect()
    quota = np.zeros(len(found), np.int64)
    for r in touched:
        quota[r["source_no"]] = r["quota"]
    shards = max(1, -(-total // shard_words))

    def leaves(batches):
        for batch in batches:
            for shard, (first, count) in split_tree(quota, shards, seed, batch.column(0).to_pylist()).items():
                own = np.flatnonzero(count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), shard, np.int64)), pa.array(own.astype(np.int32)),
                     pa.array(first[own]), pa.array(count[own])], names=["shard", "source_no", "first", "count"])

    assigned = (spark.range(shards).mapInArrow(leaves, "shard long, source_no int, first long, count long")
                .select("shard", "source_no", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("count") - 1))
                        .alias("turn")))
    each = (documents.where("copies > 0")
            .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
            .withColumn("turn", F.col("copy") * F.col("blocks") + F.col("block"))
            .select("doc_id", "key", "source_no", "copy", "turn").join(assigned, ["source_no", "turn"]))
    local = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed + 1), "key", "copy"), "doc_id", "key", "copy")
    drawn = each.withColumn("position", F.row_number().over(local) - 1).select(
        "doc_id", "key", "copy", "shard", "position")
    return Mix(documents, drawn, shards)


def taken_words(docs: DataFrame, **settings) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` per row of ``docs``: the words the mix takes of it."""
    m = mix(docs, **settings)
    drawn = m.drawn.groupBy("doc_id", "key").agg(F.count("*").alias("n")).select(
        F.col("doc_id").alias("drawn_id"), F.col("key").alias("drawn_key"), "n")
    return (m.documents.join(drawn, F.col("doc_id").eqNullSafe(F.col("drawn_id")) & (F.col("key") == F.col("drawn_key")),
                             "left")
            .select("doc_id", "size", "source_size", "target",
                    (F.col("size") * F.coalesce("n", F.lit(0))).alias("taken"),
                    F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("row")).drop("row"))


def mixed_documents(docs: DataFrame, seed: int = 3, **settings) -> DataFrame:
    """The rows of ``docs`` as the mix takes them (repeats are repeated rows), shard by shard in mixed order.

    Null and empty texts have no words and are never taken; a null source is a source, a null doc_id a row like
    others; repeated rows are taken row by row; an empty table gives no rows.  All columns stay.
    """
    m = mix(docs, seed=seed, **settings)
    places = m.drawn.groupBy("doc_id", "key").agg(F.collect_list(F.struct("shard", "position")).alias("_places"))
    names = docs.columns
    left = docs.select(F.struct(*names).alias("_row"), F.col("doc_id").alias("_id"), row_key(seed).alias("_key"))
    right = places.select(F.col("doc_id").alias("_pid"), F.col("key").alias("_pkey"), "_places")
    return (left.join(right, (F.col("_key") == F.col("_pkey")) & F.col("_id").eqNullSafe(F.col("_pid")))
            .select("_row", F.explode("_places").alias("_at"))
            .select("_row", F.col("_at.shard").alias("_shard"), F.col("_at.position").alias("_position"))
            .repartition("_shard").sortWithinPartitions("_shard", "_position").select("_row.*"))
