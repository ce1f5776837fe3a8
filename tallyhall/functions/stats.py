"""Numeric helpers (H15-H20, H24): guarded division, corrected skew, tiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den) -> Column:
    """num / den, null when den is 0 or null (DAX ``DIVIDE(a, b, BLANK())``)."""
    return F.try_divide(_c(num).cast("double"), F.nullif(_c(den).cast("double"), F.lit(0.0)))


def money(c, precision: int = 12) -> Column:
    """Money as exact decimal so sums do not depend on row order.

    Line-level amounts use ``decimal(12,2)`` so products with rates
    (``decimal(3,2)`` / ``decimal(5,4)``) stay within 18 digits, Spark's
    long-backed fast path; sums widen automatically.
    """
    return _c(c).cast(f"decimal({precision},2)")


def rate(c, scale: int = 2) -> Column:
    """A rate or ratio as a narrow exact decimal (``decimal(3,2)`` or
    ``decimal(5,4)``)."""
    return _c(c).cast("decimal(3,2)" if scale == 2 else "decimal(5,4)")


def msum(c) -> Column:
    """Exact sum of a money column."""
    return F.sum(money(c))


def dbl(c, places: int = 6) -> Column:
    """Final projection: double, rounded so both engines agree bit-for-bit."""
    return F.round(_c(c).cast("double"), places)


def round_half_even(c, places: int = 2) -> Column:
    """Round half to even (the feed's 2-place money rounding); exact on
    decimals, differs from ``round`` only at exact ties."""
    return F.bround(_c(c), places)


def corrected_skew(c) -> Column:
    """Bias-corrected sample skewness G1 (pandas ``Series.skew``); null for n < 3.

    Spark's ``skewness`` is the population g1; G1 = g1 * sqrt(n(n-1)) / (n-2).
    """
    x = _c(c)
    n = F.count(x).cast("double")
    g1 = F.skewness(x)
    return F.when(n >= 3, g1 * F.sqrt(n * (n - 1)) / (n - 2))


# Data-quality tier thresholds (score >= bound -> tier).
DQ_TIERS = [(98.0, "A"), (95.0, "B"), (90.0, "C")]
DQ_TIER_FLOOR = "D"


def dq_tier(score) -> Column:
    s = _c(score)
    expr = None
    for bound, tier in DQ_TIERS:
        expr = F.when(s >= bound, tier) if expr is None else expr.when(s >= bound, tier)
    return expr.otherwise(DQ_TIER_FLOOR)
