"""Numeric column helpers.

Rounding rule
-------------
``round_half_up(x, n)`` first fixes the double at 8 decimals and then
rounds the decimal half away from zero.  Rounding a binary double directly
is engine dependent (1.005 is stored as 1.00499...; a decimal-based engine
gives 1.01, a binary one 1.0).  Fixing 8 decimals first also absorbs the
last-bit noise of sums taken in a different order on different
partitionings, so the same data gives the same rounded value however it
was split.  ``round_half_even`` mirrors Python's ``round``.

No value is ever lost: NaN, the infinities and magnitudes of 1e29 and more
(whole numbers far beyond a double's fraction digits) pass unchanged.  More
than 8 digits cannot be kept by the rule and are refused.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed decimal types used to pin a double at 8 decimals before rounding.
PIN_TYPE = "decimal(38,8)"
# Up to 18 digits a decimal is held in a long (no BigDecimal arithmetic),
# which makes per-row rounding several times cheaper; |x| < 1e9 fits.
FAST_PIN_TYPE = "decimal(18,8)"
FAST_PIN_LIMIT = 1e9
# Beyond this a double does not fit PIN_TYPE; it is a whole number anyway.
PIN_LIMIT = 1e29
PIN_DIGITS = 8


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _pinned(col: Column, digits: int, rounder) -> Column:
    if digits > PIN_DIGITS:
        raise ValueError(f"values are fixed at {PIN_DIGITS} decimals; cannot round to {digits}")
    c = _col(col)
    fast = rounder(c.cast(FAST_PIN_TYPE), digits).cast("double")
    wide = rounder(c.cast(PIN_TYPE), digits).cast("double")
    # Same value either way; only the representation (and speed) differs.  NaN sorts above
    # every number, so it fails both comparisons and passes unchanged.
    return (F.when(F.abs(c) < F.lit(FAST_PIN_LIMIT), fast)
            .when(F.abs(c) < F.lit(PIN_LIMIT), wide).otherwise(c.cast("double")))


def round_half_up(col: Column | str, digits: int) -> Column:
    """Round half away from zero to ``digits``; result DOUBLE (F2)."""
    return _pinned(col, digits, F.round)


def round_half_even(col: Column | str, digits: int) -> Column:
    """Banker's rounding, as Python's ``round`` does; result DOUBLE."""
    return _pinned(col, digits, F.bround)


def round_sql(expr: str, digits: int) -> str:
    """The same rounding rule as SQL text (for oracle queries)."""
    return _round_sql("round", expr, digits)


def round_even_sql(expr: str, digits: int) -> str:
    """``round_half_even`` as SQL text."""
    return _round_sql("round_even", expr, digits)


def _round_sql(function: str, expr: str, digits: int) -> str:
    return (f"CASE WHEN abs({expr}) < 1e29 THEN CAST({function}(CAST({expr} AS DECIMAL(38,8)), {digits}) AS DOUBLE) "
            f"ELSE CAST({expr} AS DOUBLE) END")


def scale_round(col: Column | str, factor: float = 100.0, digits: int = 4) -> Column:
    """``round(x * factor, digits)``: a fraction as a percentage (F1)."""
    return round_half_up(_col(col).cast("double") * F.lit(float(factor)), digits)


def ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den`` as DOUBLE; null when the denominator is 0."""
    return _col(num).cast("double") / F.nullif(_col(den).cast("double"), F.lit(0.0))


def clamp(col: Column | str, lo: Column | str, hi: Column | str) -> Column:
    """Limit ``col`` to ``[lo, hi]``."""
    return F.least(F.greatest(_col(col), _col(lo)), _col(hi))
