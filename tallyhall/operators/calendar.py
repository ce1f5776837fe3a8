"""Calendar dimension and holiday windows.

The calendar is generated from a one-row bounds frame with
``explode(sequence(lo, hi))``; it is a few thousand rows at most, so it is
always safe to broadcast.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import date_key, week_of_year_monday, weekday0

# Holidays that fall on the same day every year
# (month, day, name). Moving feasts must be given as explicit dates.
FIXED_DATE_HOLIDAYS = [
    (1, 1, "New Year"),
    (5, 1, "Labour Day"),
    (6, 1, "Pancasila Day"),
    (8, 17, "Independence Day"),
    (12, 25, "Christmas"),
]

# Demand multipliers used by the demand index.
DOW_FACTOR = {0: 0.92, 1: 0.95, 2: 0.97, 3: 1.02, 4: 1.18, 5: 1.22, 6: 0.88}
MONTH_FACTOR = {1: 1.05, 2: 0.88, 3: 0.90, 4: 0.95, 5: 0.98, 6: 1.08,
                7: 1.12, 8: 1.10, 9: 0.96, 10: 0.97, 11: 1.03, 12: 1.15}
LONG_WEEKEND_BOOST = 1.25
HOLIDAY_WINDOW_DAYS = 1


def holiday_dates(spark: SparkSession, years: DataFrame, explicit=None) -> DataFrame:
    """Holiday rows (holiday_date, holiday_name) for every year in ``years``
    (a frame with an int column ``year``) plus explicit ``{date: name}``."""
    fixed = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(d).alias("d"), F.lit(n).alias("name"))
                      for m, d, n in FIXED_DATE_HOLIDAYS])
    per_year = (years.select("year", F.explode(fixed).alias("h"))
                .select(F.make_date("year", "h.m", "h.d").alias("holiday_date"),
                        F.concat_ws(" ", "h.name", F.col("year").cast("string"))
                        .alias("holiday_name")))
    if explicit:
        rows = [(d if isinstance(d, dt.date) else dt.date.fromisoformat(d), n)
                for d, n in explicit.items()]
        per_year = per_year.unionByName(
            spark.createDataFrame(rows, "holiday_date date, holiday_name string"))
    return per_year


def holiday_window_days(holidays: DataFrame, days: int = HOLIDAY_WINDOW_DAYS) -> DataFrame:
    """Explode each holiday into the dates of its ±``days`` window so the
    range test becomes an equi-join; one row per window date."""
    offs = F.sequence(F.lit(-days), F.lit(days))
    return (holidays
            .select(F.explode(F.transform(offs, lambda o: F.date_add("holiday_date", o)))
                    .alias("window_date"))
            .distinct())


def build_calendar(bounds: DataFrame, lo: str = "lo", hi: str = "hi",
                   explicit_holidays=None) -> DataFrame:
    """One row per day between the ``lo`` and ``hi`` date columns of a
    one-row ``bounds`` frame, with 13 calendar attributes and the holiday /
    long-weekend flag (1 within ±1 day of a holiday)."""
    spark = bounds.sparkSession
    days = bounds.select(F.explode(F.sequence(F.to_date(lo), F.to_date(hi))).alias("full_date"))
    years = bounds.select(F.explode(F.sequence(F.year(F.to_date(lo)) - 1,
                                               F.year(F.to_date(hi)) + 1)).alias("year"))
    hol = holiday_dates(spark, years, explicit_holidays)
    window = holiday_window_days(hol).withColumn("in_window", F.lit(1))
    names = (hol.groupBy("holiday_date")
             .agg(F.array_join(F.array_sort(F.collect_set("holiday_name")), " / ")
                  .alias("holiday_name")))
    d = F.col("full_date")
    return (days
            .join(F.broadcast(window), d == F.col("window_date"), "left")
            .join(F.broadcast(names), d == F.col("holiday_date"), "left")
            .select(
                date_key(d).alias("date_key"),
                d,
                F.year(d).alias("year"),
                F.quarter(d).alias("quarter"),
                F.month(d).alias("month"),
                F.date_format(d, "MMMM").alias("month_name"),
                weekday0(d).alias("day_of_week"),
                F.date_format(d, "EEEE").alias("day_name"),
                (weekday0(d) >= 5).cast("int").alias("is_weekend"),
                F.coalesce(F.col("in_window"), F.lit(0)).cast("int").alias("is_holiday_flag"),
                F.coalesce(F.col("holiday_name"), F.lit("")).alias("holiday_name"),
                F.dayofyear(d).alias("day_of_year"),
                week_of_year_monday(d).alias("week_of_year"),
                F.weekofyear(d).alias("iso_week"),
            ))


def calendar_between(spark: SparkSession, lo, hi, explicit_holidays=None) -> DataFrame:
    bounds = spark.createDataFrame([(str(lo), str(hi))], "lo string, hi string")
    return build_calendar(bounds, explicit_holidays=explicit_holidays)


def demand_index(date_col, in_window_col) -> "F.Column":
    """Day-of-week × month × long-weekend multiplier of a date."""
    dow = F.create_map(*[x for k, v in DOW_FACTOR.items() for x in (F.lit(k), F.lit(v))])
    mon = F.create_map(*[x for k, v in MONTH_FACTOR.items() for x in (F.lit(k), F.lit(v))])
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    w = F.col(in_window_col) if isinstance(in_window_col, str) else in_window_col
    return (dow[weekday0(d)] * mon[F.month(d)]
            * F.when(w == 1, F.lit(LONG_WEEKEND_BOOST)).otherwise(F.lit(1.0)))
