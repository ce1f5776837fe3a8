"""Text cleaning and parsing as pure Column expressions.

Everything here compiles to JVM expressions inside whole-stage codegen; no
Python runs per row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace characters stripped by trim_ws (Java ``\s``).
WS_CHARS = " \t\n\x0b\f\r"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c) -> Column:
    """Strip leading/trailing whitespace including tabs and newlines (SQL
    ``trim`` strips spaces only)."""
    return F.btrim(_c(c), F.lit(WS_CHARS))


def is_blank(c) -> Column:
    """True when the value is null or only whitespace."""
    c = _c(c)
    return c.isNull() | (trim_ws(c.cast("string")) == "")


def blank_to_null(c) -> Column:
    c = trim_ws(_c(c))
    return F.when(c == "", F.lit(None).cast("string")).otherwise(c)


def norm_key(c) -> Column:
    """Canonical lookup key: upper case, every run of characters outside
    ``[A-Z0-9 ]`` becomes one space, spaces collapsed, ends trimmed; null
    becomes the empty string."""
    up = F.upper(_c(c).cast("string"))
    return F.coalesce(F.trim(F.regexp_replace(up, "[^A-Z0-9]+", " ")), F.lit(""))


def last_token(c) -> Column:
    """Last space-separated token of the normalized key."""
    return F.element_at(F.split(norm_key(c), " "), -1)


def yn_flag(c) -> Column:
    """Y/N text flag -> 0/1 integer; anything else (and null) -> 0."""
    return F.coalesce((F.upper(trim_ws(_c(c))) == "Y").cast("int"), F.lit(0))


# The date shapes recognised by the mixed-date parser, in
# priority order, each as (full-match pattern, Spark datetime format).
DATE_SHAPES = [
    (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"),
    (r"^\d{2}/\d{2}/\d{4}$", "dd/MM/yyyy"),
    (r"^\d{2}-\d{2}-\d{4}$", "MM-dd-yyyy"),
    (r"^\d{2}-[A-Za-z]{3}-\d{4}$", "dd-MMM-yyyy"),
    (r"^\d{8}$", "yyyyMMdd"),
]


def parse_mixed_date(c, day_first_fallback: bool = False) -> Column:
    """Parse text dates of several shapes, chosen by the shape of the text.

    ``dd/MM/yyyy`` is day first, ``MM-dd-yyyy`` month first. Impossible
    dates and unknown shapes give null. With ``day_first_fallback`` a
    dashed ``dd-MM-yyyy`` is accepted when the month-first reading is
    invalid.
    """
    return parse_trimmed_date(trim_ws(_c(c).cast("string")), day_first_fallback)


def parse_trimmed_date(c, day_first_fallback: bool = False) -> Column:
    """:func:`parse_mixed_date` of text without white space at its ends. Only
    shapes of the text's length are tried."""
    s = _c(c)
    shapes = DATE_SHAPES + ([(r"^\d{2}-\d{2}-\d{4}$", "dd-MM-yyyy")] if day_first_fallback else [])
    by_length: dict[int, list[Column]] = {}
    for rx, fmt in shapes:
        by_length.setdefault(len(fmt), []).append(F.when(s.rlike(rx), _shaped_date(s, fmt)))
    return reduce(lambda found, n: found.when(F.length(s) == n, F.coalesce(*by_length[n])), by_length, F).otherwise(F.lit(None))


def _shaped_date(s: Column, fmt: str) -> Column:
    """The date of a text that has the shape of ``fmt``. Digits are put in ISO
    order and cast, which costs far less than a formatter a row."""
    if "MMM" in fmt:
        return F.try_to_date(s, fmt)
    if fmt == "yyyy-MM-dd":
        return s.try_cast("date")
    year, month, day = (F.substring(s, fmt.index(f) + 1, len(f)) for f in ("yyyy", "MM", "dd"))
    return F.concat(year, F.lit("-"), month, F.lit("-"), day).try_cast("date")


_THOUSANDS_COMMA = r"^\d{1,3}(,\d{3})+$"
_THOUSANDS_DOT = r"^\d{1,3}(\.\d{3})+$"
_FLOAT_BODY = r"^([0-9]+\.?[0-9]*|\.[0-9]+)$"


def parse_mixed_number(c) -> Column:
    """Parse locale-mixed numeric text to double; anything else -> null.

    A leading ``-`` makes the value negative, leading signs are dropped. Only
    digits, commas and dots may remain. With both separators the later one is
    the decimal mark; a lone separator is a thousands mark only when it
    groups digits in threes (``123.456`` -> 123456), else decimal.
    """
    return parse_number_body(*number_body(c))


def number_body(c) -> tuple[Column, Column]:
    """Whether a text begins with a minus, and what follows its signs."""
    s = trim_ws(_c(c).cast("string"))
    return s.startswith("-"), trim_ws(F.regexp_replace(s, r"^[-+]+", ""))


def parse_number_body(neg, body) -> Column:
    """The number of a ``number_body``, which is named many times here."""
    neg, body = _c(neg), _c(body)
    has_comma = body.contains(",")
    has_dot = body.contains(".")
    comma_last = body.rlike(r",[^.]*$")
    normalized = (
        F.when(has_comma & has_dot & comma_last,
               F.regexp_replace(F.regexp_replace(body, r"\.", ""), ",", "."))
        .when(has_comma & has_dot, F.regexp_replace(body, ",", ""))
        .when(has_comma & body.rlike(_THOUSANDS_COMMA), F.regexp_replace(body, ",", ""))
        .when(has_comma, F.regexp_replace(body, ",", "."))
        .when(has_dot & body.rlike(_THOUSANDS_DOT), F.regexp_replace(body, r"\.", ""))
        .otherwise(body)
    )
    ok = body.rlike(r"^[0-9.,]*$") & normalized.rlike(_FLOAT_BODY)
    v = F.when(ok, normalized.try_cast("double"))
    return F.when(neg, -v).otherwise(v)


def any_of(cols) -> Column:
    return reduce(lambda a, b: a | b, cols)


def all_of(cols) -> Column:
    return reduce(lambda a, b: a & b, cols)
