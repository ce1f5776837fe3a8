import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyhall.functions import (dq_tier, norm_key, parse_mixed_date, parse_mixed_number,
                                 period_to_month, week_of_year_monday, corrected_skew)

DATE_GOLDENS = [
    ("2025-03-04", dt.date(2025, 3, 4)), (" 2025-03-04 ", dt.date(2025, 3, 4)),
    ("04/03/2025", dt.date(2025, 3, 4)), ("2025-02-30", None),
    ("03-04-2025", dt.date(2025, 3, 4)), ("31/02/2025", None),
    ("04-Mar-2025", dt.date(2025, 3, 4)), ("25-12-2025", None),
    ("04-MAR-2025", dt.date(2025, 3, 4)), ("04/13/2025", None),
    ("20250304", dt.date(2025, 3, 4)), ("2025/03/04", None),
    ("", None), (None, None),
]

NUMBER_GOLDENS = [
    ("1.234.567,89", 1234567.89), ("1,234,567.89", 1234567.89), ("1234567.89", 1234567.89),
    ("1.234,56", 1234.56), ("1234,56", 1234.56), ("1,234", 1234.0),
    ("1.234", 1234.0), ("123.456", 123456.0), ("1234.567", 1234.567),
    ("12.5", 12.5), ("0,5", 0.5), ("0", 0.0),
    ("-1.450.000", -1450000.0), ("- 5", -5.0), ("+7", 7.0),
    (" 42 ", 42.0), ("1,2.3", 12.3), ("1.2,3", 12.3),
    ("1,23,456", None), ("1.2.3", None), (".", None),
    ("-", None), ("", None), ("abc", None),
    ("12d", None), ("1e5", None), ("Rp 5", None),
    ("(5)", None), (None, None),
]


def _eval(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["o"] for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").collect()]


def test_parse_mixed_date(spark):
    got = _eval(spark, [v for v, _ in DATE_GOLDENS], parse_mixed_date)
    assert got == [e for _, e in DATE_GOLDENS]


def test_day_first_fallback(spark):
    got = _eval(spark, ["25-12-2025", "03-04-2025"], lambda c: parse_mixed_date(c, True))
    assert got == [dt.date(2025, 12, 25), dt.date(2025, 3, 4)]


def test_parse_mixed_number(spark):
    got = _eval(spark, [v for v, _ in NUMBER_GOLDENS], parse_mixed_number)
    for (v, e), g in zip(NUMBER_GOLDENS, got):
        if e is None:
            assert g is None, v
        else:
            assert g == pytest.approx(e), v


def test_norm_key(spark):
    vals = [" Coffee - Latte ", "coffee  latte", "Rice & Noodles", "F&B", "HQ-Jakarta", None]
    assert _eval(spark, vals, norm_key) == [
        "COFFEE LATTE", "COFFEE LATTE", "RICE NOODLES", "F B", "HQ JAKARTA", ""]


def test_period_and_week(spark):
    assert _eval(spark, ["2025-01", "Jan-2025", "bad"], period_to_month) == [
        dt.date(2025, 1, 1), dt.date(2025, 1, 1), None]
    df = spark.createDataFrame([(dt.date(2025, 1, 5),), (dt.date(2025, 1, 6),),
                                (dt.date(2026, 12, 31),)], "d date")
    assert [r[0] for r in df.select(week_of_year_monday("d")).collect()] == [0, 1, 52]


def test_week_matches_python_strftime(spark):
    df = spark.sql("SELECT explode(sequence(DATE'2020-01-01', DATE'2030-12-31')) AS d")
    rows = df.select("d", week_of_year_monday("d").alias("w")).collect()
    bad = [r for r in rows if int(r["d"].strftime("%W")) != r["w"]]
    assert not bad


def test_skew_and_tier(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    r = df.agg(corrected_skew("x").alias("s"), F.stddev_samp("x").alias("sd"),
               F.percentile("x", 0.25).alias("p")).first()
    assert r["s"] == pytest.approx(1.763632614803888)
    assert r["sd"] == pytest.approx(4.08248290463863)
    assert r["p"] == pytest.approx(1.75)
    t = spark.createDataFrame([(98.0,), (97.99,), (95.0,), (90.0,), (89.9,)], "s double")
    assert [r[0] for r in t.select(dq_tier("s")).collect()] == ["A", "B", "B", "C", "D"]


def test_round_half_even_on_exact_ties(spark):
    from pyspark.sql import functions as F
    from tallyhall.functions import round_half_even
    df = spark.createDataFrame([("0.125",), ("0.135",), ("2.675",), ("-0.125",)], "s string")
    got = [r[0] for r in df.select(round_half_even(F.col("s").cast("decimal(12,3)")).cast("string"))
           .collect()]
    assert got == ["0.12", "0.14", "2.68", "-0.12"]
