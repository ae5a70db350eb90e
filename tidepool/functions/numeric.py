"""Numeric helpers whose results agree across SQL engines.

Spark (ANSI mode) raises on division by zero and returns a BIGINT from
``ceil(double)``; other engines return inf/NaN or a DOUBLE.  The helpers below
pin one behaviour: an undefined ratio is NULL, ``ceil`` is NULL-guarded and
typed BIGINT, and rounding is half-away-from-zero on the scaled double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nz(c: Column) -> Column:
    """``nullif(c, 0)``: turns a zero divisor into NULL."""
    return F.when(c != F.lit(0), c)


def safe_div(num: Column, den: Column) -> Column:
    """``num / den`` as DOUBLE, NULL when ``den`` is 0 or NULL."""
    return num.cast("double") / nz(den.cast("double"))


def _floor_nonnegative(v: Column) -> Column:
    """``floor`` of a non-negative double, as a double.

    Spark's ``floor(double)`` returns BIGINT and saturates above 2^63;
    ``v - (v % 1)`` is exact in IEEE arithmetic (the remainder is exact) for
    every finite ``v >= 0``.
    """
    return v - v % F.lit(1.0)


def round_half_away(c: Column, places: int = 0) -> Column:
    """Round half away from zero to ``places`` decimals.

    Written as ``sign(x) * floor(|x| * 10^k + 0.5) / 10^k`` in doubles so the
    same text gives the same double in Spark and in the oracle engine (their
    built-in ``round`` disagree on binary ties such as 1.005), for any
    magnitude.
    """
    scale = F.lit(float(10 ** places))
    x = c.cast("double")
    return F.signum(x) * _floor_nonnegative(F.abs(x) * scale + F.lit(0.5)) / scale


def ceil_long(c: Column) -> Column:
    """``ceil`` typed BIGINT; NULL in, NULL out (Spark maps NaN to 0 otherwise).

    Used for bin counts, which are bounded by the log of the double range over
    the log of the smallest bin step (well inside BIGINT)."""
    return F.when(c.isNotNull() & ~F.isnan(c), F.ceil(c)).cast("bigint")


def bins_between(ratio: Column, bin_step: Column) -> Column:
    """Number of price bins spanned by ``ratio`` with ``bin_step`` (1/10000 units).

    ``ceil(log(ratio) / log(1 + bin_step / 10000))``; NULL when the ratio is not
    positive or the bin step is not positive.  Base 10 in both logs (the ratio is
    base-free, but the same base keeps exact bin multiples on the same side of
    the ceiling in every engine).
    """
    step = F.log10(F.lit(1.0) + bin_step.cast("double") / F.lit(10000.0))
    ok = (ratio > F.lit(0.0)) & (bin_step > F.lit(0))
    return ceil_long(F.when(ok, F.log10(ratio) / step))
