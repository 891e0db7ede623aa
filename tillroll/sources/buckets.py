"""Stored tables dealt into buckets by a key, where one key may hold a third of all rows.

Keys with far more rows than others are found first.  Their rows are dealt over several buckets by a salt,
all others have salt 0; the table is bucketed by key and salt.  Sums per key then need a merge for the
heavy keys only, and a join repeats only the other side's rows of heavy keys.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.session import stage as stage_table
from tillroll.session import unstage
from tillroll.sources.replace import replace_table

SALT = "_salt"
# a heavy key's rows are dealt out in pieces of this part of a mean bucket; bounds the number of heavy keys too
PIECES_PER_BUCKET = 16
# mean rows of a bucket from which keys are parted
LEAST_ROWS = 1_000


def heavy_keys(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``(key, pieces)``: keys with more rows than a piece, at most ``PIECES_PER_BUCKET * buckets`` of them."""
    counts = stage_table(df.groupBy(key).agg(F.count("*").alias("n")), "key-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    piece = max(1, total // (PIECES_PER_BUCKET * buckets))
    # of a small table every key holds more than a piece; it is not worth parting
    over = F.col("n") > piece if total >= LEAST_ROWS * buckets else F.lit(False)
    heavy = stage_table(counts.where(over).select(key, F.ceil(F.col("n") / piece).cast("int").alias("pieces")), "heavy-keys")
    unstage(counts)
    return heavy


@dataclass
class BucketStore:
    """A stored table in ``buckets`` buckets by ``key`` and, if ``heavy`` (key, pieces) has any rows, by salt."""

    stored: DataFrame
    heavy: DataFrame
    key: str
    buckets: int
    salted: bool

    @property
    def rows(self) -> DataFrame:
        """The table's own columns."""
        return self.stored.drop(SALT)

    def sums(self, columns: Mapping[str, Column]) -> DataFrame:
        """``(key, sums)``: the sum of each column per key, added up inside the buckets.

        Only the heavy keys' partial sums, one per piece, are shuffled.
        """
        if not self.salted:
            return self.stored.groupBy(self.key).agg(*[F.sum(c).alias(n) for n, c in columns.items()])
        part = self.stored.groupBy(self.key, SALT).agg(*[F.sum(c).alias(n) for n, c in columns.items()])
        merged = part.where(F.col(SALT) > 0).groupBy(self.key).agg(*[F.sum(n).alias(n) for n in columns])
        return part.where(F.col(SALT) == 0).drop(SALT).unionByName(merged)

    def spread(self, other: DataFrame) -> DataFrame:
        """``other`` with a salt, rows of heavy keys once per piece; store it in the same buckets to join in place."""
        if not self.salted:
            return other
        heavy = self.heavy.where(F.col(self.key).isNotNull())
        marked = other.join(F.broadcast(heavy), self.key, "left")  # at most PIECES_PER_BUCKET rows a bucket
        salts = F.when(F.col("pieces").isNull(), F.array(F.lit(0))).otherwise(
            F.sequence(F.lit(1), F.coalesce("pieces", F.lit(1))))
        return marked.select(*other.columns, F.explode(salts).alias(SALT))

    def joined(self, other: DataFrame, how: str = "inner") -> DataFrame:
        """The stored rows joined with ``other`` by the key; the stored side isn't shuffled.

        ``how`` is from the stored side's view: inner, left, left_semi or left_anti.  ``other``'s rows of heavy
        keys are repeated, so joins that keep ``other``'s unmatched rows aren't offered.
        """
        if how not in ("inner", "left", "left_semi", "left_anti"):
            raise ValueError(f"no {how} join with repeated rows")
        on = [self.key, SALT] if self.salted else [self.key]
        return self.stored.join(self.spread(other), on, how).drop(SALT)


def _salted(df: DataFrame, heavy: DataFrame, key: str) -> DataFrame:
    """``df`` with its salt: 0, or for heavy keys 1 to the number of pieces by the row's place in a stored copy."""
    few = F.broadcast(heavy)
    same = df[key].eqNullSafe(heavy[key])
    light = df.join(few, same, "left_anti").withColumn(SALT, F.lit(0))
    held = stage_table(df.join(few, same).select(df["*"], "pieces"), "heavy-rows")  # equal rows must part too: their place tells them apart
    place = F.xxhash64(F.col("_metadata.file_name"), F.col("_metadata.row_index"))
    return light.unionByName(held.withColumn(SALT, (F.pmod(place, F.col("pieces")) + 1).cast("int")).drop("pieces"))


def store_bucketed(df: DataFrame, table: str, folder: str, key: str, buckets: int, partition_by=()) -> BucketStore:
    """Store ``df`` as the catalog table ``table`` in ``buckets`` buckets by ``key``, replacing it safely.

    Without heavy keys the buckets are by the key alone.  No bucket gets much more than the mean: a heavy key's
    pieces are a sixteenth of it.  NULL is a key like others here, though it joins with nothing.
    """
    if SALT in df.columns:
        raise ValueError(f"{SALT} is a column of the store")
    heavy = heavy_keys(df, key, buckets)
    salted = not heavy.isEmpty()
    by = [key, SALT] if salted else [key]
    rows = _salted(df, heavy, key) if salted else df
    stored = replace_table(rows.repartition(buckets, *by), table, folder, partition_by,
                           lambda w: w.bucketBy(buckets, *by).sortBy(key))
    return BucketStore(stored.select(*df.columns, *([SALT] if salted else [])), heavy, key, buckets, salted)
