"""MinHash near-duplicate documents (operator 7)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.jobs import connected_components, drop_stage, write_stage
from tillroll.llm.near import agreeing, bands_for, confirmed_links, picked, signatures, star_links


def numbered(docs: DataFrame) -> tuple[DataFrame, str, bool]:
    """(rows, column, plain): ``docs`` with a column that names each row by a number of its own.

    That is the doc_id where every row has one and none repeats (``plain``).  Otherwise rows are numbered and
    stored with their numbers, so that texts under one doc_id, or under none, are rows of their own.
    """
    name = "_row"
    while name in docs.columns:
        name += "_"
    ids = docs.select(F.col("doc_id").cast("long").alias("id"))
    if ids.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 or id is null").isEmpty():
        return docs.withColumn(name, F.col("doc_id").cast("long")), name, True
    return write_stage(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), name, False


def _components(items: DataFrame, shingle: int, percent: int, rows: int, miss: float, seed: int) -> DataFrame:
    """``(id, n_shingles, component)`` of ``items (id, text)``; the component is its smallest id."""
    spark = items.sparkSession
    bands = bands_for(percent / 100, rows, miss)
    signed = write_stage(signatures(items, shingle, rows, bands, seed), "signed")
    classes = write_stage(signed.where("digest is not null").groupBy("digest").agg(F.min("id").alias("rep")),
                          "classes")
    members = signed.select("id", "n_shingles", "digest").join(classes, "digest", "left") \
        .select("id", "n_shingles", F.coalesce("rep", "id").alias("rep"))
    reps = write_stage(signed.select("id", "keys").join(classes.select(F.col("rep").alias("id")), "id", "left_semi")
                       .select("id", "keys"), "reps")
    k, t = rows * bands, percent / 100
    floor = max(0.0, t - 8 * math.sqrt(t * (1 - t) / k))
    links = write_stage(agreeing(star_links(reps), signed, floor), "near")
    exact = confirmed_links(links, lambda bitmap: picked(items, bitmap), signed.select("id", "n_shingles"), shingle, percent)
    comps = write_stage(connected_components(exact), "comps")
    drop_stage(spark, reps, links)
    return (members.join(comps.withColumnRenamed("id", "rep"), "rep", "left")
            .select("id", "n_shingles", F.coalesce("component", "rep").alias("component")))


def _first_rows(found: DataFrame, docs: DataFrame, name: str) -> DataFrame:
    """``found`` with each row's ``doc_id``, its component's ``component_id`` and first row ``keeper``."""
    named = write_stage(found.join(docs.select(F.col(name).alias("id"), F.col("doc_id").cast("long").alias("doc_id")), "id"),
                        "named")
    first = named.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "id")).alias("f"))
    return named.join(first.select("component", F.col("f.doc_id").alias("component_id"), F.col("f.id").alias("keeper")),
                      "component")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, rows: int = 4,
                    miss: float = 1e-6, seed: int = 7) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per row of ``docs``.

    A document's set is its distinct ``shingle``-word shingles (A-Z lower-cased; the whole sequence
    where it has fewer words).  Two documents are linked where 100 * |A and B| >= percent * |A or B|,
    decided on the full sets; components are the transitive closure, named by their smallest doc_id,
    and only that document is ``kept``.  Equal sets are grouped first by a 128-bit digest and go on as
    one class.  The number of bands follows from ``rows`` and ``miss``, the chance that a pair just at
    the threshold shares no band.

    Every row is a document: rows that share a doc_id, or have none, are compared by their own texts, each
    of them can be linked or alone, and of each component one row is kept (of its rows with the smallest
    doc_id the one read first).  A component without any doc_id has a null component_id.  Null, empty and blank
    texts have no shingles, stay alone and are kept.  An empty table gives no rows.  Other columns of
    ``docs`` are ignored, whatever their names.
    """
    few, name, plain = numbered(docs.select("doc_id", "text"))
    found = _components(few.select(F.col(name).alias("id"), "text"), shingle, percent, rows, miss, seed)
    if plain:
        return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"),
                            F.expr("id = component").alias("kept"))
    return _first_rows(found, few, name).select("doc_id", "n_shingles", "component_id", F.expr("id = keeper").alias("kept"))


def deduplicated(docs: DataFrame, shingle: int = 5, percent: int = 80, rows: int = 4, miss: float = 1e-6,
                 seed: int = 7) -> DataFrame:
    """``docs`` without the rows that ``near_duplicates`` does not keep; all columns stay.

    Rows go one by one: a doc_id with several texts loses only those rows whose text another kept row repeats
    or nearly repeats.  Null, empty and blank texts all stay, rows without a doc_id are compared like others, and an
    empty table stays empty.
    """
    rows_, name, plain = numbered(docs)
    found = _components(rows_.select(F.col(name).alias("id"), "text"), shingle, percent, rows, miss, seed)
    if plain:
        removed = found.where("id <> component")
    else:
        removed = _first_rows(found, rows_, name).where("id <> keeper")
    removed = write_stage(removed.select(F.col("id").alias(name)), "removed")
    return rows_.join(removed, name, "left_anti").select(*docs.columns)
