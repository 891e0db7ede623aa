"""Raw table sources: CSV/Parquet folders with declared schemas, and the load profile."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.casts import strict
from tillroll.sources.csvlines import CSV_OPTIONS, found_types, read_text_csv, with_types
from tillroll.sources.schemas import RAW_SCHEMAS, RAW_TABLES


def _typed(field: T.StructField) -> Column:
    """A CSV text as its declared type; bad text raises, integral numbers may be written with decimals."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return c
    text = F.trim(c)
    if isinstance(field.dataType, T.IntegralType):
        return F.bround(strict(text, "decimal(38,10)", field.name)).cast(field.dataType).alias(field.name)
    return strict(text, field.dataType.simpleString(), field.name).alias(field.name)


def _declared(text: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns by name and type, then the file's other columns with the types found in them."""
    own = {f.name.lower() for f in schema.fields}
    extra = [c for c in text.columns if c.lower() not in own]
    if not extra:
        return text.select([_typed(f) for f in schema.fields])
    typed = with_types(text, found_types(text, extra))
    return typed.select([_typed(f) for f in schema.fields] + [F.col("`{}`".format(c.replace("`", "``"))) for c in extra])


def read_raw(spark: SparkSession, raw_dir: str, fmt: str = "csv", multiline: bool | None = None) -> dict[str, DataFrame]:
    """Load ``customers``, ``products``, ``orders``, ``order_items`` from ``raw_dir``.

    CSV files carry a header; their columns are taken by name, as text, and cast to the declared types:
    nothing but an empty value turns into NULL.  Columns that aren't declared come after those, typed by
    what all their values are.  Line breaks inside quoted values are found and read in parallel
    (``read_text_csv`` says how, and what ``multiline`` does).
    Every file is checked before any is read, so a missing table fails the whole load up front.
    """
    ext = {"csv": ".csv", "parquet": ".parquet"}[fmt]
    missing = []
    for t in RAW_TABLES:
        path = os.path.join(raw_dir, t + ext)
        try:  # resolves the path; of a CSV file the header line is read
            spark.read.options(**CSV_OPTIONS).csv(path) if fmt == "csv" else spark.read.schema(RAW_SCHEMAS[t]).parquet(path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
                raise
            missing.append(path)
    if missing:
        raise FileNotFoundError(f"Missing raw file(s): {', '.join(missing)}")
    paths = {t: os.path.join(raw_dir, t + ext) for t in RAW_TABLES}
    if fmt == "parquet":
        return {t: spark.read.schema(RAW_SCHEMAS[t]).parquet(path) for t, path in paths.items()}
    return {t: _declared(read_text_csv(spark, path, multiline), RAW_SCHEMAS[t]) for t, path in paths.items()}


def row_counts(tables: dict[str, DataFrame], names: tuple[str, ...] = RAW_TABLES) -> DataFrame:
    """COUNT(*) per table as one DataFrame ``(table, rows)``; one job, one partial count per scan."""
    parts = [tables[n].agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows")
             for n in names]
    return reduce(DataFrame.unionByName, parts)
