"""Date and period expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import trim_ws


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(c) -> Column:
    """Date -> integer key yyyymmdd; null stays null."""
    d = F.to_date(_c(c))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def key_to_date(c) -> Column:
    """Integer key yyyymmdd -> date (invalid -> null)."""
    return F.try_to_date(F.lpad(_c(c).cast("string"), 8, "0"), "yyyyMMdd")


def month_text(c) -> Column:
    """Date -> ``yyyy-MM`` text."""
    return F.date_format(_c(c), "yyyy-MM")


def month_start(c) -> Column:
    return F.trunc(_c(c), "month")


def weekday0(c) -> Column:
    """Day of week with Monday = 0 .. Sunday = 6."""
    return F.weekday(_c(c))


def is_weekend(c) -> Column:
    return (weekday0(c) >= 5).cast("int")


def week_of_year_monday(c) -> Column:
    """Monday-first week number 00-53: days before the first Monday of the
    year are week 0 (C ``%W``)."""
    d = _c(c)
    return F.floor((F.dayofyear(d) - 1 + 7 - F.weekday(d)) / 7).cast("int")


def period_to_month(c) -> Column:
    """Budget period text (``2025-01`` or ``Jan-2025``) -> first day of month."""
    s = trim_ws(_c(c).cast("string"))
    return F.coalesce(
        F.when(s.rlike(r"^\d{4}-\d{1,2}$"), F.try_to_date(s, "yyyy-M")),
        F.when(s.rlike(r"^[A-Za-z]{3}-\d{4}$"), F.try_to_date(s, "MMM-yyyy")),
    )


def days_between(end, start) -> Column:
    return F.datediff(_c(end), _c(start))
