"""Type coercions with SQL-model semantics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_BINARY = (T.FloatType, T.DoubleType)

# plain decimal numbers, as text that a number parser of the ingest takes (no type suffixes, no hexadecimal)
NUMBER_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# date texts by their shape, besides ISO text; month before day where both could be meant
TIMESTAMP_SHAPES = (
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}$", "M/d/yyyy H:mm"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}$", "M/d/yyyy H:mm:ss"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4} \d{1,2}:\d{2}$", "d MMM yyyy H:mm"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
    (r"^\d{1,2} [A-Za-z]{4,} \d{4}$", "d MMMM yyyy"),
    (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy"),
    (r"^[A-Za-z]{4,} \d{1,2}, \d{4}$", "MMMM d, yyyy"),
    (r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{2}:\d{2}$", "yyyy/M/d H:mm:ss"),
    (r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{2}$", "yyyy/M/d H:mm"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{1,2}\.\d{1,2}\.\d{4} \d{1,2}:\d{2}$", "d.M.yyyy H:mm"),
    (r"^\d{1,2}\.\d{1,2}\.\d{4}$", "d.M.yyyy"),
)


def cast_integral(df: DataFrame, name: str, target: str) -> Column:
    """CAST(col AS INTEGER/BIGINT) the way the SQL models do it.

    Integral inputs cast directly.  FLOAT and DOUBLE round ties to even (2.5 -> 2), DECIMAL and text
    away from zero ('2.5' -> 3), instead of Spark's truncation; text that is no number raises.
    """
    dtype = df.schema[name].dataType
    col = F.col(name)
    if isinstance(dtype, _INTEGRAL):
        return col.cast(target)
    if isinstance(dtype, _BINARY):
        return F.bround(col).cast(target)
    if isinstance(dtype, T.StringType):
        col = strict(F.trim(col), "decimal(38,10)", name)
    return F.round(col).cast(target)


def strict(col: Column, target: str, what: str) -> Column:
    """Cast text, NULL staying NULL; text that doesn't parse raises whatever the session's ANSI setting."""
    cast = col.try_cast(target)
    bad = F.raise_error(F.concat(F.lit(f"{what}: no {target}: "), col))
    return F.when(col.isNotNull() & cast.isNull(), bad.cast(target)).otherwise(cast)


def try_number(col: Column | str) -> Column:
    """Coerce to DOUBLE; anything that is no plain number becomes NULL."""
    c = F.col(col) if isinstance(col, str) else col
    text = F.trim(c.cast("string"))
    return F.when(F.typeof(c) != "string", c.try_cast("double")).when(text.rlike(NUMBER_TEXT), text.try_cast("double"))


def try_timestamp(col: Column | str) -> Column:
    """Coerce to a zone-less TIMESTAMP_NTZ: ISO text, or one of TIMESTAMP_SHAPES; anything else becomes NULL.

    The text's shape names the one format it is parsed with, so each value is parsed once.  Only digits
    are a date if there are eight of them (yyyyMMdd), never a year alone.
    """
    c = F.col(col) if isinstance(col, str) else col
    text = F.trim(c.cast("string"))
    parsed = F.when(text.rlike(r"^\d{4}-"), text.try_cast("timestamp_ntz"))
    for shape, fmt in TIMESTAMP_SHAPES:
        parsed = parsed.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz"))
    parsed = parsed.when(~text.rlike(r"^\d+$"), text.try_cast("timestamp_ntz"))
    return F.when(F.typeof(c) != "string", c.try_cast("timestamp_ntz")).otherwise(parsed)


def computed_once(*columns: Column) -> Column:
    """The columns, as one generator of a ``select``: later filters and projections read their values.

    The optimizer copies a projection's expressions into the filters and projections above it; it doesn't
    copy those of a generator, which here gives exactly one row per input row.
    """
    return F.inline(F.array(F.struct(*columns)))
