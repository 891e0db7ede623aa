"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests (operator 4).

DataFrame operations only.  A sketch has three tables of ``w`` cells; a digest goes into one cell of
each.  A cell holds a count, the exclusive-or of its digests and the exclusive-or of their check
hashes, so two sketches subtract cell by cell and what both texts share cancels out.  A cell left with
one digest gives it away; taking it out of its other cells frees more (peeling).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.jobs import release_shuffles, write_stage
from tillroll.llm.minhash import numbered

# cells per table of the stored fingerprint
BASE_CELLS = 16
# peeling steps of one attempt (each over one of the three tables) and attempts before the exact difference
STEPS, ATTEMPTS = 9, 6
# a paragraph is a line, long lines in parts that end with a sentence
PARAGRAPH = r"[^\n]{120,400}?[.!?](?=\s)|[^\n]{1,400}"
_CHECK, _RECOVERED, _MARK = -1, -1, -2


def paragraph_digests(text: Column) -> Column:
    """The distinct 64-bit digests of the paragraphs of a text (blank ones left out)."""
    parts = F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0))
    return F.array_distinct(F.transform(F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != ""),
                                        lambda p: F.xxhash64(p)))


def _cell(digest: Column, table: int, level: int) -> Column:
    return (F.lit(table) * F.col("w") + F.pmod(F.xxhash64(digest, F.lit(level), F.lit(table)), F.col("w"))).cast("int")


def sketch(rows: DataFrame, keys: list[str], level: int = 0) -> DataFrame:
    """Cells ``(keys, w, cell, cnt, key, chk)`` of ``rows (keys, w, sign, digest)``; a null digest only marks its key."""
    put = F.when(F.col("digest").isNull(), F.array(F.struct(F.lit(_MARK).alias("cell")))).otherwise(
        F.array(*[F.struct(_cell(F.col("digest"), j, level).alias("cell")) for j in range(3)]))
    return (rows.select(*keys, "w", "sign", "digest", F.inline(put))
            .groupBy(*keys, "w", "cell")
            .agg(F.sum(F.when(F.col("digest").isNotNull(), F.col("sign")).otherwise(0)).alias("cnt"),
                 F.bit_xor(F.coalesce("digest", F.lit(0).cast("long"))).alias("key"),
                 F.bit_xor(F.when(F.col("digest").isNotNull(), F.xxhash64("digest", F.lit(_CHECK))).otherwise(F.lit(0).cast("long")))
                 .alias("chk")))


def peel(cells: DataFrame, keys: list[str], level: int = 0, steps: int = STEPS) -> DataFrame:
    """Peel subtracted cells: rows with ``cell`` -1 are recovered digests (``key``, ``cnt`` their side).

    Rows with cell -2 mark their key.  Other rows that are left are cells that stayed locked.  A step
    opens the pure cells of one table, where a digest has one place, so no digest is taken out twice.
    """
    state = cells
    for step in range(steps):
        table = step % 3
        pure = ((F.col("cell") >= 0) & (F.floor(F.col("cell") / F.col("w")) == table) & (F.abs("cnt") == 1)
                & (F.col("chk") == F.xxhash64("key", F.lit(_CHECK))))
        moved = [F.struct(F.lit(_RECOVERED).alias("cell"), F.col("cnt"), F.col("key"), F.lit(0).cast("long").alias("chk"))]
        moved += [F.struct(_cell(F.col("key"), j, level).alias("cell"), (-F.col("cnt")).alias("cnt"), F.col("key"),
                           F.col("chk")) for j in range(3) if j != table]
        stay = F.struct("cell", "cnt", "key", "chk")
        state = (state.select(*keys, "w", F.inline(F.when(pure, F.array(*moved)).otherwise(F.array(stay))))
                 .groupBy(*keys, "w", "cell", F.when(F.col("cell") == _RECOVERED, F.col("key")).alias("own"))
                 .agg(F.sum("cnt").alias("cnt"), F.bit_xor("key").alias("key"), F.bit_xor("chk").alias("chk"))
                 .drop("own").where("cell < 0 or cnt <> 0 or key <> 0 or chk <> 0"))
    return state


def _hex(value: Column, digits: int) -> Column:
    """Hexadecimal text of at least so many digits."""
    text = F.lower(F.hex(value))
    return F.lpad(text, F.greatest(F.length(text), F.lit(digits)), F.lit("0"))


def _number(text: Column) -> Column:
    return F.conv(text, 16, -10).cast("long")


def fingerprints(digests: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, fingerprint)``: the base sketch of ``digests (keys, digests array)`` as text.

    The text lists the non-empty cells in order, in hexadecimal: the cell (2 digits), its count (4 or
    more), digests (16) and checks (16).  ``decoded`` reads it back.
    """
    rows = digests.select(*keys, F.lit(BASE_CELLS).cast("long").alias("w"), F.lit(1).cast("long").alias("sign"),
                          F.explode_outer("digests").alias("digest"))
    cell = F.concat(_hex(F.col("cell"), 2), _hex(F.col("cnt"), 4), _hex(F.col("key"), 16), _hex(F.col("chk"), 16))
    return (sketch(rows, keys).groupBy(*keys).agg(F.sort_array(F.collect_list(F.when(F.col("cell") >= 0, cell))).alias("c"))
            .select(*keys, F.concat(F.lit(f"iblt{BASE_CELLS}:"), F.array_join("c", ".")).alias("fingerprint")))


def decoded(stored: DataFrame, keys: list[str], column: str = "fingerprint", sign: int = 1) -> DataFrame:
    """Cells ``(keys, w, cell, cnt, key, chk)`` of stored fingerprints, one row per non-empty cell.

    A fingerprint without cells gives its key's mark alone; counts are multiplied by ``sign``.  Null
    fingerprints give no rows; text that is no fingerprint raises.
    """
    text = F.when(F.col(column).rlike(r"^iblt\d+:([0-9a-f]{38,}(\.[0-9a-f]{38,})*)?$"), F.col(column)).otherwise(
        F.raise_error(F.concat(F.lit("no fingerprint: "), F.col(column))))
    listed = F.filter(F.split(F.substring_index("_text", ":", -1), r"\."), lambda c: c != "")
    n = F.length("_cell")
    cell = F.when(F.col("_cell") == "", F.lit(_MARK)).otherwise(_number(F.substring("_cell", 1, 2)).cast("int"))
    number = lambda start, size: F.when(F.col("_cell") == "", 0).otherwise(
        _number(F.substring(F.col("_cell"), start, size))).cast("long")
    return (stored.where(F.col(column).isNotNull()).select(*keys, text.alias("_text"))
            .select(*keys, F.regexp_extract("_text", r"^iblt(\d+):", 1).cast("long").alias("w"),
                    F.explode(F.concat(F.array(F.lit("")), listed)).alias("_cell"))
            .select(*keys, "w", cell.alias("cell"), (number(F.lit(3), n - 34) * sign).alias("cnt"),
                    number(n - 31, F.lit(16)).alias("key"), number(n - 15, F.lit(16)).alias("chk")))


def difference(stored: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    """``(keys, plus, minus, whole)`` of two stored fingerprints a row: the digests only one text has.

    The sketches are subtracted cell by cell and peeled.  ``whole`` is false where cells stay locked: the
    texts differ by more than a base sketch can tell, and what is listed is part of the difference.
    """
    cells = decoded(stored, keys, a).unionByName(decoded(stored, keys, b, -1))
    left = (cells.groupBy(*keys, "w", "cell").agg(F.sum("cnt").alias("cnt"), F.bit_xor("key").alias("key"), F.bit_xor("chk").alias("chk"))
            .where("cell < 0 or cnt <> 0 or key <> 0 or chk <> 0"))
    got = lambda side: F.sort_array(F.collect_list(
        F.when((F.col("cell") == _RECOVERED) & (F.col("cnt") == side), F.col("key"))))
    return peel(left, keys).groupBy(*keys).agg(got(1).alias("plus"), got(-1).alias("minus"),
                                               (F.count_if(F.col("cell") >= 0) == 0).alias("whole"))


def likeness(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, plus, minus, near)`` of ``pairs (keys, a array, b array)``: differing digests and Jaccard likeness.

    The pair's sketches are subtracted and peeled at the base size; pairs that stay locked or whose
    recovered digests don't add up are tried again with sketches sized for their digests, twice as
    large each time and with other hash functions, at last by the exact difference of the arrays.
    Two texts without paragraphs are alike (1).
    """
    spark = pairs.sparkSession
    pairs = pairs.withColumn("na", F.size("a").cast("long")).withColumn("nb", F.size("b").cast("long"))
    done, staged = [], []
    left = pairs
    for level in range(ATTEMPTS):
        if level:
            w = F.ceil((F.col("na") + F.col("nb")) / 2 * (1 << level - 1)).cast("long") + 8
        else:
            w = F.lit(BASE_CELLS).cast("long")
        signed = F.concat(F.transform("a", lambda d: F.struct(F.lit(1).cast("long").alias("sign"), d.alias("digest"))),
                          F.transform("b", lambda d: F.struct(F.lit(-1).cast("long").alias("sign"), d.alias("digest"))),
                          F.array(F.struct(F.lit(0).cast("long").alias("sign"), F.lit(None).cast("long").alias("digest"))))
        rows = (left.withColumn("w", w).repartition(*keys)
                .select(*keys, "na", "nb", "w", F.inline(signed)))
        group = [*keys, "na", "nb"]
        result = (peel(sketch(rows, group, level), group, level).groupBy(*group).agg(
            F.count_if(F.col("cell") >= 0).alias("locked"),
            F.count_if((F.col("cell") == _RECOVERED) & (F.col("cnt") == 1)).alias("plus"),
            F.count_if((F.col("cell") == _RECOVERED) & (F.col("cnt") == -1)).alias("minus")))
        result = write_stage(result.withColumn("ok", F.expr("locked = 0 and na - plus + minus = nb")), "peeled")
        staged.append(result)
        done.append(result.where("ok"))
        failed = result.where("not ok").select(*keys)
        if failed.isEmpty():
            break
        left = pairs.join(failed, keys, "left_semi")
    else:
        done.append(left.withColumn("plus", F.size(F.array_except("a", "b")).cast("long"))
                    .withColumn("minus", F.size(F.array_except("b", "a")).cast("long")))
    union = F.col("na") + F.col("minus")
    return reduce(DataFrame.unionByName, [d.select(*keys, "na", "plus", "minus") for d in done]).select(
        *keys, "plus", "minus",
        F.when(union == 0, 1.0).otherwise((F.col("na") - F.col("plus")) / union).alias("near"))


def neighbours(items: DataFrame) -> DataFrame:
    """``(id, doc_id, n_chars, for_id, for_need)`` of ``items (id, doc_id, text)``: the document that each one lends to.

    Documents stand in descending doc_id (then row number), the last is followed by the first; the one before borrows the
    first third of its own length.  Ids are dealt by ranges, ordered within each range, and the ranges'
    ends (one row per range) joined up.
    """
    down = [F.desc("doc_id"), F.desc("id")]
    small = items.select("id", "doc_id", F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("n_chars"))
    dealt = write_stage(small.repartitionByRange(*down).withColumn("range", F.spark_partition_id()), "ranges")
    ends = dealt.groupBy("range").agg(F.min(F.struct("doc_id", "id", "n_chars")).alias("low"))
    over = Window.orderBy("range")
    wrap = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("range", F.coalesce(F.lag("low").over(over), F.min("low").over(wrap)).alias("above"))
    inside = Window.partitionBy("range").orderBy(*down)
    return write_stage(
        dealt.withColumn("before", F.lag(F.struct("doc_id", "id", "n_chars")).over(inside))
        .join(F.broadcast(ends), "range")  # one row per range partition
        .withColumn("before", F.coalesce("before", "above"))
        .select("id", "doc_id", "n_chars", F.col("before.id").alias("for_id"),
                F.floor(F.col("before.n_chars") / 3).cast("int").alias("for_need")), "order")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)`` per row.

    The edited text replaces the last floor(n_chars / 3) characters by as many (or all) first
    characters of the next document in descending doc_id.  Null texts are empty; a lone document is its
    own next.  Rows that share a doc_id are documents of their own and stand next to each other in the
    order they were read in.  Rows without a doc_id have no place in the order: they come back with their
    own fingerprint and null for all that needs a neighbour.  Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows, name, _ = numbered(docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    items = rows.select(F.col(name).alias("id"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = neighbours(items)
    # whole texts are dealt once: both uses below take the same two columns of them, so Spark reuses the exchange
    placed = items.select("id", "text").join(order, "id")
    lent = placed.select(F.col("for_id").alias("id"), F.expr("substring(text, 1, for_need)").alias("borrowed"),
                         paragraph_digests(F.col("text")).alias("next"))
    edited = F.concat(F.expr("substring(text, 1, int(n_chars - floor(n_chars / 3)))"), F.col("borrowed"))
    rows = (placed.select("id", "doc_id", "n_chars", "text").join(lent, "id").withColumn("edited", edited)
            .select("id", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                    paragraph_digests(F.col("text")).alias("own"), paragraph_digests(F.col("edited")).alias("changed"), "next"))
    rows = write_stage(rows, "paragraphs")
    release_shuffles(spark)
    pairs = rows.select("id", F.explode(F.array(F.struct(F.lit("edited").alias("pair"), F.col("changed").alias("b")),
                                                F.struct(F.lit("next").alias("pair"), F.col("next").alias("b")))).alias("p"),
                        F.col("own").alias("a")).select("id", "p.pair", "a", "p.b")
    near = likeness(pairs, ["id", "pair"])
    near = write_stage(near.groupBy("id").agg(F.max(F.when(F.col("pair") == "edited", F.col("near"))).alias("near_edited"),
                                              F.max(F.when(F.col("pair") == "next", F.col("near"))).alias("near_next")), "near")
    versions = (rows.repartition("id").select("id", F.inline(F.array(
        F.struct(F.lit("own").alias("version"), F.col("own").alias("digests")),
        F.struct(F.lit("edited").alias("version"), F.col("changed").alias("digests"))))))
    both = fingerprints(versions, ["id", "version"]).groupBy("id").agg(
        F.max(F.when(F.col("version") == "own", F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(F.col("version") == "edited", F.col("fingerprint"))).alias("edited_fingerprint"))
    found = rows.select("id", "doc_id", "n_chars", "edited_sha256").join(near, "id").join(both, "id").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    lost = docs.where("doc_id is null").select(F.monotonically_increasing_id().alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    lost = lost.select("row", F.char_length("text").cast("long").alias("n_chars"), paragraph_digests(F.col("text")).alias("digests"))
    return found.unionByName(fingerprints(lost, ["row", "n_chars"]).select(
        F.lit(None).cast("long").alias("doc_id"), "n_chars", "fingerprint"), allowMissingColumns=True)
