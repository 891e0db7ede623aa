"""Column-level helpers: money rounding in cents, calendar math, text rules, casts."""

from tillroll.functions.casts import cast_integral, try_number, try_timestamp
from tillroll.functions.dates import as_date_lit, month_diff, month_start
from tillroll.functions.money import cents, div_half_away, from_cents, round2, round_dp
from tillroll.functions.text import derive_category, strip, title_case

__all__ = [
    "as_date_lit", "cast_integral", "cents", "derive_category", "div_half_away", "from_cents",
    "month_diff", "month_start", "round2", "round_dp", "strip", "title_case", "try_number",
    "try_timestamp",
]
