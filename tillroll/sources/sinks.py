"""Sinks: relation exports, metric outputs, manifests and check reports.

Relations are distributed DataFrame writes (a folder of part files each); metrics, checks and manifests,
which are bounded by the calendar and the rules, are one file each.  Nothing is collected to the driver
except the small manifest and summary rows a caller asks for.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources.buckets import BucketStore, store_bucketed
from tillroll.sources.replace import replace_file, replace_folder

# values come back as they were: quotes doubled, outer blanks kept
CSV_WRITE = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False,
             "ignoreTrailingWhiteSpace": False}


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Iterable[str] = ()) -> str:
    """CREATE OR REPLACE TABLE ... AS SELECT: the folder ``path`` with ``df``'s rows.

    The rows are written beside and put in place once they are whole: a write that fails leaves the old
    ones, and ``df`` may read from ``path`` itself.
    """
    def write(folder: str) -> None:
        w = df.write.format(fmt)
        if partition_by:
            w = w.partitionBy(*partition_by)
        if fmt == "csv":
            w = w.options(**CSV_WRITE)
        if fmt == "json":
            w = w.option("dateFormat", "yyyy-MM-dd")
        w.save(folder)

    return replace_folder(df.sparkSession, path, write)


def write_one_file(df: DataFrame, path: str, fmt: str) -> str:
    """``df`` as the one file ``path``: CSV with a header, or JSON as one array of records (NULLs written).

    For bounded results only, such as metrics, checks and manifests: one task writes the file, and a JSON array
    is one value.  The file is put in its place when it is whole; a failed task leaves the old one, or none.
    Rows keep the frame's order.
    """
    spark = df.sparkSession

    def write(folder: str) -> None:
        one = df.coalesce(1)
        if fmt == "csv":
            one.write.options(**CSV_WRITE).csv(folder)
        else:
            record = F.struct(*[F.col("`{}`".format(c.replace("`", "``"))) for c in df.columns])
            options = {"dateFormat": "yyyy-MM-dd", "ignoreNullFields": "false"}
            one.agg(F.to_json(F.collect_list(record), options).alias("value")).coalesce(1).write.text(folder)

    return replace_file(spark, path, write)


def materialize(spark: SparkSession, tables: Mapping[str, DataFrame], root: str,
                names: Iterable[str], partition_by: Mapping[str, Iterable[str]] | None = None,
                bucket_by: Mapping[str, tuple[int, str]] | None = None,
                table_prefix: str = "tillroll", stores: dict[str, BucketStore] | None = None) -> dict[str, DataFrame]:
    """Write the named relations as Parquet under ``root`` and return them re-read.

    Later steps then read the stored tables instead of recomputing the whole
    lineage, and a lost executor only costs re-reading files.  ``partition_by``
    maps a relation to partition columns (e.g. ``fct_orders`` by
    ``order_date``), so date-range filters prune whole folders.  ``bucket_by``
    maps a relation to ``(buckets, key)``: the table is dealt out by the key once at
    write time (``store_bucketed``: keys with very many rows over several buckets) and registered as a
    bucketed catalog table, so later aggregations and joins on that key read it without a shuffle.
    ``stores`` takes those tables' ``BucketStore`` by name.
    Replaced tables stay readable until the new ones are whole.  Columns keep their original order on read.
    """
    out = dict(tables)
    for name in names:
        keys = list((partition_by or {}).get(name, ()))
        path = os.path.join(root, name)
        if bucket_by and name in bucket_by:
            n, key = bucket_by[name]
            store = store_bucketed(tables[name], f"{table_prefix}_{name}", path, key, n, keys)
            out[name] = store.rows
            if stores is not None:
                stores[name] = store
        else:
            # rebalance splits a hot key over tasks by size and merges small ones
            df = tables[name].hint("rebalance", *[F.col(k) for k in keys]) if keys else tables[name]
            write_table(df, path, partition_by=keys)
            out[name] = spark.read.parquet(path).select(*tables[name].columns)
    return out


def list_relations(spark: SparkSession, tables: Mapping[str, DataFrame] | None = None,
                   prefixes: Iterable[str] = ()) -> list[str]:
    """Relation names (given tables plus catalog tables/views), sorted, optionally by name prefix."""
    names = set(tables or {})
    names.update(t.name for t in spark.catalog.listTables())
    prefixes = tuple(prefixes)
    return sorted(n for n in names if not prefixes or n.startswith(prefixes))


def export_relations(tables: Mapping[str, DataFrame], out_dir: str, prefixes: Iterable[str],
                     fmt: str = "csv") -> list[str]:
    """Export every relation whose name starts with one of ``prefixes`` (CSV with header by default).

    Relations are the given tables and the catalog's tables and views; a given table wins over one of its name.
    """
    spark = next(iter(tables.values())).sparkSession
    return [write_table(tables[n] if n in tables else spark.table(n), os.path.join(out_dir, n), fmt)
            for n in list_relations(spark, tables, prefixes)]


def write_metric(df: DataFrame, out_dir: str, name: str) -> dict[str, str]:
    """Metric result as the files ``name.csv`` (header) and ``name.json`` (an array of records, ISO dates)."""
    return {fmt: write_one_file(df, os.path.join(out_dir, f"{name}.{fmt}"), fmt) for fmt in ("csv", "json")}


def write_metrics(results: Mapping[str, DataFrame], out_dir: str) -> DataFrame:
    """Write each metric and a manifest ``(metric, rows, csv, json)``; returns the manifest.

    A metric result is one row per day (or per cohort cell), so it is kept
    for the two writes and the row count instead of being computed three
    times from the facts; a lost executor just recomputes its part.
    """
    spark = next(iter(results.values())).sparkSession
    entries = []
    for name, df in results.items():
        kept = df.persist(StorageLevel.MEMORY_AND_DISK)
        paths = write_metric(kept, out_dir, name)
        entries.append((name, kept.count(), paths["csv"], paths["json"]))
        kept.unpersist()
    m = spark.createDataFrame(entries, "metric string, rows long, csv string, json string")
    write_one_file(m, os.path.join(out_dir, "metrics_manifest.json"), "json")
    return m


def write_checks(checks: DataFrame, out_dir: str, generated_at: str) -> dict:
    """Quality report: the files ``checks.json`` and ``summary.json`` (one record with the run date).

    The check rows (one per configured rule) are kept for the write and the
    summary, so the checks run once.
    """
    from tillroll.operators.quality import summarize
    kept = checks.persist(StorageLevel.MEMORY_AND_DISK)
    checks_path = os.path.join(out_dir, "checks.json")
    write_one_file(kept, checks_path, "json")
    counts = {r["status"]: int(r["count"]) for r in summarize(kept).collect()}  # a handful of statuses
    kept.unpersist()
    summary_df = checks.sparkSession.createDataFrame(
        [(generated_at, dict(sorted(counts.items())))], "generated_at string, summary map<string,long>")
    summary_path = os.path.join(out_dir, "summary.json")
    write_one_file(summary_df, summary_path, "json")
    return {"checks": checks_path, "summary": summary_path, "counts": counts}


__all__ = ["export_relations", "list_relations", "materialize", "write_checks", "write_metric",
           "write_metrics", "write_table"]
