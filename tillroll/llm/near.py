"""Near-duplicate detection: many universal hash minima, banding, exact confirmation, components.

The engine works on items ``(id long, text)``: whole documents for the document operator, passages
for the passage operator.  Steps:

1. one pass over the texts gives per item the minima of ``rows * bands`` universal hash functions
   over its shingles, folded into one key per band;
2. keys held by more than one item link each holder to the most central holder (a star, never all
   pairs); links whose signatures agree far too little are dropped;
3. the links' components are families.  Only the texts of family members are shuffled (a fixed-size
   bitmap picks them in the scan), and their shingle sets built again where they are compared;
4. exact Jaccard similarity is decided on the full sets inside family blocks of bounded size, each
   block also against the family's centre; what a large family leaves apart from its centre is then
   compared with every other block, so no link between different texts is lost to a block border;
5. components of the confirmed links by alternating large-star and small-star.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.jobs import by_group, connected_components, drop_stage, id_filter, maybe_in, write_stage
from tillroll.llm.words import chunks, hash_strings, mix64, shingle_hashes, words

# shingles of a family block: bounds what one task holds at once
BLOCK_SHINGLES = 16_384


def bands_for(threshold: float, rows: int, miss: float) -> int:
    """Bands of ``rows`` minima each so that a pair at the threshold is missed with chance <= ``miss``."""
    return math.ceil(math.log(miss) / math.log(1 - threshold ** rows))


def hash_family(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and shifts of ``count`` universal hash functions over 32-bit values."""
    rng = np.random.default_rng(seed)
    return (rng.integers(0, 1 << 32, count, dtype=np.uint32) | np.uint32(1),
            rng.integers(0, 1 << 32, count, dtype=np.uint32))


def minima(sets: list[np.ndarray], family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The matrix (item, function) of hash minima; items must not be empty."""
    a, b = family
    out = np.empty((len(sets), len(a)), np.uint32)
    if not sets:
        return out
    sizes = np.array([len(s) for s in sets])
    first = 0
    while first < len(sets):  # runs of about 64k shingles stay in cache
        last = max(first + 1, int(np.searchsorted(np.cumsum(sizes[first:]), 65_536)) + first)
        x = (np.concatenate(sets[first:last]) >> np.uint64(32)).astype(np.uint32)
        at = np.concatenate(([0], np.cumsum(sizes[first:last])[:-1]))
        for j in range(len(a)):
            out[first:last, j] = np.minimum.reduceat(x * a[j] + b[j], at)
        first = last
    return out


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` neighbouring minima, different for each band."""
    n, k = signatures.shape
    grouped = signatures.reshape(n, k // rows, rows).astype(np.uint64)
    with np.errstate(over="ignore"):
        key = np.tile(np.arange(k // rows, dtype=np.uint64) + np.uint64(1), (n, 1))
        for j in range(rows):
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + grouped[:, :, j])
    return key.view(np.int64)


def set_digest(shingles: np.ndarray) -> bytes:
    """128-bit digest of a sorted shingle set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def star_links(keys: DataFrame) -> DataFrame:
    """``(a, b)``: each holder of a shared key with the key's most central holder.

    ``keys`` holds (id, keys array).  A holder's centrality is the number of items that it meets over
    all its keys, so a group's original tends to win every key that it is in.
    """
    spark = keys.sparkSession
    rows = keys.select("id", F.explode("keys").alias("key"))
    shared = write_stage(rows.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"),
                                                 F.count("*").alias("holders"))
                         .where("lo < hi").select("key", "holders"), "shared")
    held = write_stage(rows.join(shared, "key").distinct(), "held")
    weight = write_stage(held.groupBy("id").agg(F.sum("holders").alias("weight")), "weight")
    central = write_stage(held.join(weight, "id").groupBy("key").agg(
        F.max(F.struct("weight", F.bitwise_not("id").alias("back"))).alias("best"))  # ties: the smallest id
        .select("key", F.bitwise_not("best.back").alias("centre")), "central")
    links = write_stage(held.join(central, "key").where("id <> centre")
                        .select(F.col("id").alias("a"), F.col("centre").alias("b")).distinct(), "links")
    drop_stage(spark, shared, held, weight, central)
    return links


class _Union:
    """Union-find over the positions of one block."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def exact_links(ids: np.ndarray, sets: list[np.ndarray], percent: int, start: int = 1,
                groups: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links (id, id) with 100 * |A and B| >= percent * |A or B| that join what was apart.

    Shared shingles are counted through an inverted index.  Items from position ``start`` on are
    compared with all items before them; ``groups`` names what already belongs together.
    """
    n = len(ids)
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(n), sizes)
    _, term = np.unique(flat, return_inverse=True)
    order = np.argsort(term, kind="stable")
    post, bounds = owner[order], np.concatenate(([0], np.cumsum(np.bincount(term)) if n else []))
    ends = np.concatenate(([0], np.cumsum(sizes)))
    union, out = _Union(n), []
    if groups is not None:
        seen: dict = {}
        for i, g in enumerate(groups.tolist()):
            union.join(seen.setdefault(g, i), i)
    for i in range(max(1, start), n):
        terms = term[ends[i]:ends[i + 1]].astype(np.int64)
        lo, hi = bounds[terms].astype(np.int64), bounds[terms + 1].astype(np.int64)
        lens = hi - lo
        take = np.repeat(lo - np.concatenate(([0], np.cumsum(lens)[:-1])), lens) + np.arange(lens.sum())
        met = post[take]
        common = np.bincount(met[met < i], minlength=i)[:i]
        near = np.flatnonzero((common > 0) & (100 * common >= percent * (sizes[:i] + sizes[i] - common)))
        for j in near.tolist():
            if union.join(i, j):
                out.append((int(ids[i]), int(ids[j])))
    return out


def confirmed_links(links: DataFrame, fetch: Callable[[object], DataFrame], sizes: DataFrame, shingle: int,
                    percent: int) -> DataFrame:
    """``(a, b)``: enough exact links to connect all that is linked within the families of ``links``.

    ``fetch(bitmap)`` returns ``(id, text)`` of the items the bitmap may hold; ``sizes`` holds
    ``(id, n_shingles)``.  Texts are what travels: they are smaller than their sets, which each block
    builds for itself.
    """
    spark = links.sparkSession
    families = connected_components(links).select("id", F.col("component").alias("family"))
    families = write_stage(families.join(sizes, "id"), "families")
    bitmap = id_filter(families.select("id"))
    degree = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("degree"))
    centre = families.join(degree, "id").groupBy("family").agg(
        F.max(F.struct("degree", F.bitwise_not("id").alias("back"))).alias("best"))
    info = write_stage(families.groupBy("family").agg(F.sum("n_shingles").alias("total")).join(centre, "family")
                       .select("family", F.ceil(F.col("total") / BLOCK_SHINGLES).cast("long").alias("blocks"),
                               F.bitwise_not("best.back").alias("centre")), "info")
    place = write_stage(families.join(info, "family").withColumn(
        "block", F.pmod(F.xxhash64("id", F.lit(11)), F.col("blocks"))), "place")
    members = write_stage(fetch(bitmap).join(place, "id"), "members")
    schema = "a long, b long"

    def out(found):
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()),
                                          pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

    def unpack(rows: pa.Table):
        codes, offsets, vocab = words(rows.column("text").combine_chunks())
        return rows.column("id").to_numpy(), shingle_hashes(codes, offsets, hash_strings(vocab), shingle)

    def inside(_, rows):
        ids, sets = unpack(rows)
        keep = np.unique(ids, return_index=True)[1]
        yield from out(exact_links(ids[keep], [sets[i] for i in keep], percent))

    centres = (members.where("id = centre and blocks > 1")
               .select("family", "id", "text", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")))
    first = write_stage(by_group(members.select("family", "id", "text", "block").unionByName(centres),
                                 ["family", "block"], inside, schema), "first")

    # what is still apart from its family's centre, against every other block of the family
    if info.where("blocks > 1").isEmpty():
        drop_stage(spark, members, info, families, place)
        return first
    large = members.where("blocks > 1")
    joined = write_stage(connected_components(first), "joined")
    groups = (large.join(joined, "id", "left").select(
        "family", "id", "text", "n_shingles", "block", "blocks", "centre", F.coalesce("component", "id").alias("group")))
    hub = (info.where("blocks > 1").join(joined.withColumnRenamed("id", "centre"), "centre", "left")
           .select("family", F.coalesce("component", "centre").alias("hub")))
    groups = write_stage(groups.join(hub, "family"), "groups")
    apart = groups.where("`group` <> hub")
    waves = write_stage(apart.groupBy("family").agg(F.sum("n_shingles").alias("n")).select(
        "family", F.ceil(F.col("n") / BLOCK_SHINGLES).cast("long").alias("waves")), "waves")
    cols = ["family", "block", "wave", "later", "id", "group", "text"]
    probes = (apart.join(waves, "family")
              .withColumn("wave", F.pmod(F.xxhash64("id", F.lit(13)), F.col("waves")))
              .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .withColumn("later", F.lit(True)).select(*cols))
    targets = (groups.join(waves, "family")
               .withColumn("wave", F.explode(F.sequence(F.lit(0), F.col("waves") - 1)))
               .withColumn("later", F.lit(False)).select(*cols))

    def across(_, rows):
        ids, sets = unpack(rows)
        later = rows.column("later").to_numpy(zero_copy_only=False)
        group = rows.column("group").to_numpy()
        there = set(ids[~later].tolist())
        order = [*np.flatnonzero(~later), *(i for i in np.flatnonzero(later) if ids[i] not in there)]
        yield from out(exact_links(ids[order], [sets[i] for i in order], percent, start=len(there),
                                   groups=group[order]))

    second = write_stage(by_group(probes.unionByName(targets), ["family", "block", "wave"], across, schema), "second")
    drop_stage(spark, members, groups, joined, info, families, waves, place)
    return first.unionByName(second)


def picked(items: DataFrame, bitmap) -> DataFrame:
    """The ``(id, text)`` rows whose id the bitmap may hold."""
    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(maybe_in(bitmap.value, batch.column(0).to_numpy(zero_copy_only=False))))

    return items.select("id", "text").mapInArrow(run, "id long, text string")


def signatures(items: DataFrame, shingle: int, rows: int, bands: int, seed: int) -> DataFrame:
    """``(id, n_shingles, digest, signature, keys)`` of ``items (id, text)``; nulls where there is no word."""
    family = hash_family(rows * bands, seed)

    def run(batches):
        for batch in batches:
            for part in chunks(batch):
                codes, offsets, vocab = words(part.column(1))
                sets = shingle_hashes(codes, offsets, hash_strings(vocab), shingle)
                n = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(n)
                sig = minima([sets[i] for i in full], family)
                keys = band_keys(sig, rows).tolist()
                digest: list = [None] * len(sets)
                signs: list = [None] * len(sets)
                held: list = [None] * len(sets)
                for at, i in enumerate(full.tolist()):
                    digest[i], signs[i], held[i] = set_digest(sets[i]), sig[at].tobytes(), keys[at]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n), pa.array(digest, pa.binary()), pa.array(signs, pa.binary()),
                     pa.array(held, pa.list_(pa.int64()))],
                    names=["id", "n_shingles", "digest", "signature", "keys"])

    return items.select("id", "text").mapInArrow(
        run, "id long, n_shingles long, digest binary, signature binary, keys array<long>")


def agreeing(links: DataFrame, signs: DataFrame, least: float) -> DataFrame:
    """The links whose signatures agree in at least the share ``least`` of the hash functions."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(batch.num_rows, -1)
                    for i in (2, 3))
            hit = (x == y).mean(axis=1) >= least
            yield batch.select([0, 1]).filter(pa.array(hit))

    bitmap = id_filter(links.select(F.explode(F.array("a", "b")).alias("id")))

    def asked(batches):
        for batch in batches:
            yield batch.filter(pa.array(maybe_in(bitmap.value, batch.column(0).to_numpy(zero_copy_only=False))))

    held = write_stage(signs.select("id", "signature").mapInArrow(asked, "id long, signature binary"), "asked")
    x = held.select(F.col("id").alias("a"), F.col("signature").alias("x"))
    y = held.select(F.col("id").alias("b"), F.col("signature").alias("y"))
    return links.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")
