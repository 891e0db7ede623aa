"""Replacing stored data so that the old rows stay readable until the new ones are whole.

New data is always written beside the old.  A catalog table is then pointed at its new folder by one
change of its location, a plain folder is put in place by renaming.  A write that fails halfway changes
nothing that readers see.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

# table property that names the folder of the version before the present one
PREVIOUS = "tillroll.previous"


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def put_in_place(spark: SparkSession, fresh: str, path: str) -> None:
    """Make the folder or file ``fresh`` that of ``path``; what is there is moved aside, and back if that fails.

    Two renames: a reader that looks between them finds nothing, none finds a mix.  Where renaming
    copies (object stores), use catalog tables.
    """
    fs, new = _path(spark, fresh)
    _, there = _path(spark, path)
    parent, name = str(there.getParent()), there.getName()
    _, aside = _path(spark, f"{parent}/.{name}-old-{uuid.uuid4().hex}")
    had = fs.exists(there)
    if had and not fs.rename(there, aside):
        raise OSError(f"{path} cannot be moved")
    if not fs.rename(new, there):
        if had:
            fs.rename(aside, there)
        raise OSError(f"{fresh} cannot be moved to {path}")
    if had:
        fs.delete(aside, True)


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Let ``write(folder)`` write a fresh folder beside ``path``, then put it in its place."""
    fs, there = _path(spark, path)
    fs.mkdirs(there.getParent())
    fresh = f"{there.getParent()}/.{there.getName()}-new-{uuid.uuid4().hex}"
    try:
        write(fresh)
        put_in_place(spark, fresh, path)
    except BaseException:
        delete_folder(spark, fresh)
        raise
    return path


def replace_file(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Let ``write(folder)`` write a folder with one part file beside ``path``, then make that file ``path``."""
    fs, there = _path(spark, path)
    fs.mkdirs(there.getParent())
    fresh = f"{there.getParent()}/.{there.getName()}-new-{uuid.uuid4().hex}"
    try:
        write(fresh)
        parts = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{fresh}/part-*"))
        if len(parts) != 1:
            raise OSError(f"{len(parts)} part files were written for {path}")
        put_in_place(spark, str(parts[0].getPath()), path)
    finally:
        delete_folder(spark, fresh)
    return path


def _described(spark: SparkSession, table: str) -> tuple[list, str, str | None]:
    """(layout, location, previous location) of a catalog table."""
    rows = [tuple(r) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()]
    details = next(i for i, r in enumerate(rows) if r[0] == "# Detailed Table Information")
    layout = [r[:2] for r in rows[:details] if r[0]]
    facts = {r[0]: r[1] for r in rows[details:]}
    layout += [(k, facts.get(k)) for k in ("Num Buckets", "Bucket Columns", "Sort Columns", "Provider")]
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return layout, facts["Location"], properties.get(PREVIOUS)


def replace_table(df: DataFrame, table: str, folder: str, partition_by: Iterable[str] = (),
                  layout: Callable[[DataFrameWriter], DataFrameWriter] = lambda w: w) -> DataFrame:
    """CREATE OR REPLACE TABLE ``table`` AS ``df`` under ``folder``, one folder per version; returns the table.

    The new version is written and registered beside.  Where columns, types and buckets are those of the
    old one and nothing is partitioned, the table's location is then switched: readers that resolve the table
    see the old rows or the new ones.  Otherwise the two tables swap names: between the two renames the
    table is missing.  The version before stays until the next replace, for readers that are still at it;
    older ones are deleted.  A write that fails leaves the old table and no new folder.
    ``layout`` sets buckets on the writer.
    """
    spark = df.sparkSession
    run = uuid.uuid4().hex
    fresh, beside = f"{folder.rstrip('/')}/{run}", f"{table}__{run}"
    partition_by = list(partition_by)
    writer = layout(df.write.format("parquet").option("path", fresh))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.saveAsTable(beside)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {beside}")
        delete_folder(spark, fresh)
        raise
    if not spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {beside} RENAME TO {table}")
        return spark.table(table)
    new, place, _ = _described(spark, beside)
    old, last, before = _described(spark, table)
    if new == old and not partition_by:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{place}'")
        spark.sql(f"DROP TABLE {beside}")  # its files are the table's now
    else:
        spark.sql(f"ALTER TABLE {table} RENAME TO {table}__old_{run}")
        spark.sql(f"ALTER TABLE {beside} RENAME TO {table}")
        spark.sql(f"DROP TABLE {table}__old_{run}")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{PREVIOUS}' = '{last}')")
    spark.catalog.refreshTable(table)
    if before and before != last:
        delete_folder(spark, before)
    return spark.table(table)
