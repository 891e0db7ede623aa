"""String helpers as Column expressions (all JVM-side, no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# fixed values: category of an empty description, text standing for a missing one
DEFAULT_CATEGORY = "General"
MISSING_TEXT = "nan"

# Python's whitespace: the characters str.strip() and str.split() treat as space,
# derived from str.isspace (none lies above U+3000)
PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())
_WS = "".join(f"\\u{ord(ch):04x}" for ch in PY_WHITESPACE)  # as a regex character-class body


# letters that have case: the regex class body
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"


def strip(x: Column | str) -> Column:
    """Python ``str.strip()``: remove Python whitespace at both ends (no regex).

    Spark's ``trim`` removes only the space character.
    """
    return F.btrim(_c(x), F.lit(PY_WHITESPACE))


def title_case(x: Column | str) -> Column:
    """Python ``str.title()``: upper-case the first letter of every run of cased letters,
    lower-case the rest (``popcorn-holder`` -> ``Popcorn-Holder``).

    The text is split into runs of cased and other characters and ``initcap`` is applied per run, so
    letters after a digit, punctuation or a letter without case start a new word.
    """
    runs = F.regexp_extract_all(_c(x), F.lit(rf"([{_CASED}]+|[^{_CASED}]+)"), 1)
    return F.array_join(F.transform(runs, lambda r: F.initcap(r)), "")


def derive_category(description: Column | str) -> Column:
    """Product category from a free-text description.

    Rule (fixed by the source system): strip the text; empty -> ``General``;
    take the first whitespace-separated token; strip the characters ``.,;:-_``
    from both ends; empty -> ``General``; otherwise title-case it.  A missing
    description is treated as the text ``nan`` (so it becomes ``Nan``).
    """
    text = strip(F.coalesce(_c(description).cast("string"), F.lit(MISSING_TEXT)))
    token = F.regexp_extract(text, f"^([^{_WS}]+)", 1)
    # fixed value: the punctuation set stripped from the token's ends
    token = F.regexp_replace(token, r"^[.,;:\-_]+|[.,;:\-_]+$", "")
    return F.when(token == "", F.lit(DEFAULT_CATEGORY)).otherwise(title_case(token))
