"""Calendar helpers as Column expressions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def month_start(d: Column | str) -> Column:
    """DATE_TRUNC('month', d) as a DATE."""
    return F.trunc(_c(d), "MM")


def month_diff(start: Column | str, end: Column | str) -> Column:
    """DATE_DIFF('month', start, end): month boundaries crossed (Jan 31 -> Feb 1 is 1).

    Spark's ``months_between``/``timestampdiff`` count whole months instead, so
    the difference is taken on (year, month) pairs.
    """
    s, e = _c(start), _c(end)
    return ((F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))).cast("bigint")


def as_date_lit(value: _dt.date | str | None) -> Column:
    """A driver-side date parameter as a DATE literal; ``None`` means the session's current date."""
    if value is None:
        return F.current_date()
    if isinstance(value, str):
        value = _dt.date.fromisoformat(value)
    return F.lit(value).cast("date")
