"""Money arithmetic.

Stored money is DOUBLE (as in the source tables).  Sums, products and rounding
are done in DECIMAL so results do not depend on summation order or on how an
engine rounds a binary fraction at an exact half; the result is cast back to
DOUBLE at the edge.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
RATE = "decimal(18,6)"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str, dtype: str = MONEY) -> Column:
    """DOUBLE money -> DECIMAL (rounds half away from zero to the cent)."""
    return _c(c).cast(dtype)


def to_double(c: Column | str) -> Column:
    return _c(c).cast("double")


def round_money(c: Column | str, scale: int = 2) -> Column:
    """Round a DECIMAL expression and return DOUBLE."""
    return F.round(_c(c), scale).cast("double")


def money_sum(c: Column | str, scale: int = 2) -> Column:
    """round(sum(x), scale) computed exactly, returned as DOUBLE."""
    return round_money(F.sum(money(c)), scale)


def ratio_pct(num: Column, den: Column, scale: int = 1) -> Column:
    """round(num / den * 100, scale) in DECIMAL; NULL when den is 0 or NULL."""
    return F.round(F.try_divide(num * F.lit(100), F.nullif(den, F.lit(0))), scale).cast("double")


def pct_change(cur: Column, prev: Column, scale: int = 1) -> Column:
    """Percent change of DECIMAL values; NULL when prev is 0 or NULL (safe divide)."""
    return ratio_pct(cur - prev, prev, scale)
