"""Money arithmetic as Column expressions.

Amounts are DOUBLE at the edges (that is what the SQL models expose) but every
sum runs over integer cents, so totals do not depend on summation order and a
1000-executor aggregation gives the same bits as a single-threaded one.

``round_dp`` mirrors how SQL engines round a DOUBLE to ``n`` places: scale,
round half away from zero, unscale.  Spark's own ``round(x, n)`` rounds the
shortest decimal text of ``x`` instead, which differs at binary ties
(1.005 -> 1.01 in Spark, 1.0 in the SQL models).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_dp(x: Column | str, n: int) -> Column:
    """ROUND(x, n) on a DOUBLE, half away from zero on the scaled binary value.

    A result of zero keeps the sign of ``x`` (ROUND(-0.3, 0) is -0.0 in SQL,
    while Spark's decimal rounding has no negative zero).
    """
    scale = float(10**n)
    r = F.round(_c(x) * F.lit(scale)) / F.lit(scale)
    return F.when(r == 0, F.lit(0.0) * F.signum(_c(x))).otherwise(r)


def cents(x: Column | str) -> Column:
    """An amount in DOUBLE currency units -> BIGINT cents (ROUND(x, 2) * 100)."""
    return F.round(_c(x) * F.lit(100.0)).cast("bigint")


def from_cents(c: Column | str) -> Column:
    """BIGINT cents -> DOUBLE currency units."""
    return _c(c).cast("double") / F.lit(100.0)


def round2(x: Column | str) -> Column:
    """ROUND(x, 2) for money, exact to the cent."""
    return from_cents(cents(x))


def div_half_away(num: Column | str, den: Column | str) -> Column:
    """Integer ``num / den`` rounded half away from zero; NULL when ``den`` is 0.

    Used for ratios of sums (average order value): ``div_half_away(cents, n)``
    is ``ROUND(sum / n, 2)`` computed exactly instead of through a noisy double.
    """
    num = _c(num).cast("decimal(20,0)")
    den = _c(den).cast("decimal(20,0)")
    # exact integer arithmetic in DECIMAL: floor((2|n| + |d|) / (2|d|))
    mag = F.floor((F.abs(num) * 2 + F.abs(den)) / (F.abs(den) * 2)).cast("bigint")
    sign = F.when((num < 0) != (den < 0), F.lit(-1)).otherwise(F.lit(1))
    return F.when(den == 0, F.lit(None).cast("bigint")).otherwise(sign * mag)
