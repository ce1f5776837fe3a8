"""KPI marts (A1-A8, J12-J15) built by drill-across over a calendar spine.

Every fact is aggregated to the conformed grain *before* it meets another
fact or the spine, so no join fans out; the three daily aggregates are all
hash-partitioned on (date_id, property_id) and the spine joins them on the
same keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import dbl, safe_div
from ..operators.lookup import dim_join
from .roles import OTHER_INCOME_CODES, Star

def _zero():
    return F.lit(0).cast("decimal(18,2)")


def _z(c):
    return F.coalesce(F.col(c), _zero())


def _zi(c):
    return F.coalesce(F.col(c), F.lit(0).cast("bigint"))


def room_daily(star: Star) -> DataFrame:
    """A1: bookings per (date, property)."""
    r = star.fact_room_sales
    return r.groupBy("date_id", "property_id").agg(
        F.sum("room_revenue").alias("room_revenue"),
        F.sum("room_nights").cast("bigint").alias("occupied_room_nights"),
        F.sum("rooms_sold").cast("bigint").alias("rooms_sold"),
        F.sum("is_cancelled").cast("bigint").alias("cancellations"),
        F.sum("is_no_show").cast("bigint").alias("no_shows"),
        F.count("*").alias("bookings"))


def per_transaction(f: DataFrame, keys) -> DataFrame:
    """First aggregation level of the POS measures: one row per transaction
    within ``keys``. Summing these rows again gives the line measures, and
    counting them gives distinct transactions, without the row expansion
    of ``countDistinct`` and with a hot key pre-aggregated map-side."""
    clean = (F.col("is_void") == 0) & (F.col("is_refund") == 0)
    return f.groupBy(*keys, "transaction_id").agg(
        F.sum("gross_sales").alias("gross"),
        F.sum(F.when(clean, F.col("net_sales")).otherwise(_zero())).alias("net_clean"),
        F.sum("net_sales").alias("net_all"),
        F.sum("cogs_amount").alias("cogs"),
        F.sum("discount").alias("disc"),
        F.sum("is_void").cast("bigint").alias("voids"),
        F.sum("is_refund").cast("bigint").alias("refunds"),
        F.count("*").alias("lines"))


def fnb_daily(star: Star) -> DataFrame:
    """A2: POS lines per (date, property), via per-transaction partials."""
    t = per_transaction(star.fact_fnb_sales, ["date_id", "property_id"])
    return t.groupBy("date_id", "property_id").agg(
        F.sum("gross").alias("fnb_gross_sales"),
        F.sum("net_clean").alias("fnb_net_revenue"),
        F.sum("cogs").alias("fnb_cogs"),
        F.sum("disc").alias("fnb_discount"),
        F.sum("voids").cast("bigint").alias("void_lines"),
        F.sum("lines").cast("bigint").alias("fnb_lines"),
        F.count("transaction_id").alias("fnb_transactions"))


def expense_daily(star: Star) -> DataFrame:
    """A3: ledger per (date, property) split by account type."""
    e = star.fact_expense.join(F.broadcast(star.dim_account.drop("department_id")), "account_id")
    t = F.col("account_type")
    return e.groupBy("date_id", "property_id").agg(
        F.sum(F.when(t == "OPEX", F.col("amount")).otherwise(_zero())).alias("opex"),
        F.sum(F.when(t == "COGS", F.col("amount")).otherwise(_zero())).alias("other_cogs"),
        F.sum(F.when((t == "Revenue") & F.col("account_code").isin(OTHER_INCOME_CODES),
                     F.col("amount")).otherwise(_zero())).alias("other_income"))


def property_days(star: Star, p: DataFrame) -> DataFrame:
    """Each property row once per day of the reporting window: a generator
    on the property dim, not a pairing join. Size = properties × days."""
    days = F.sequence(F.to_date(F.lit(star.cal_lo)), F.to_date(F.lit(star.cal_hi)))
    return p.select("*", F.explode(days).alias("full_date"))


def spine(star: Star, business_types=None) -> DataFrame:
    """Calendar × properties. Properties are expanded over the window's
    days, then the calendar attributes come by an equi-join on the date
    against the broadcast calendar (days in the window: bounded)."""
    p = star.dim_property
    if business_types:
        p = p.filter(F.col("business_type").isin(list(business_types)))
    d = star.dim_date.select("date_key", "full_date", "year", "month", "quarter",
                             "is_weekend", "is_holiday_flag")
    pd = property_days(star, p.select("property_id", "property_name", "business_type", "rooms"))
    return pd.join(F.broadcast(d), "full_date").select(*d.columns, "property_id",
                                                       "property_name", "business_type", "rooms")


def kpi_daily(star: Star, business_types=None) -> DataFrame:
    """A4 ``mart_kpi_daily``: spine + A1..A3 with guarded ratios.

    ``occupancy_ratio`` is 0-1, ``occupancy_pct`` ×100 (null without rooms);
    ``ebitda`` follows the mart formula (F&B and ledger COGS both subtracted).
    """
    keys = ["date_id", "property_id"]
    s = spine(star, business_types).withColumnRenamed("date_key", "date_id")
    j = (s.join(room_daily(star), keys, "left")
         .join(fnb_daily(star), keys, "left")
         .join(expense_daily(star), keys, "left"))
    rooms = F.col("rooms").cast("double")
    total = _z("room_revenue") + _z("fnb_net_revenue") + _z("other_income")
    ebitda = total - _z("fnb_cogs") - _z("other_cogs") - _z("opex")
    occ = safe_div(_zi("occupied_room_nights"), rooms)
    return j.select(
        F.col("date_id").alias("date_key"), "full_date", "year", "month", "quarter",
        "is_weekend", "is_holiday_flag", "property_id", "property_name", "business_type",
        _z("room_revenue").cast("double").alias("room_revenue"),
        _zi("occupied_room_nights").alias("occupied_room_nights"),
        _zi("rooms_sold").alias("rooms_sold"),
        _zi("cancellations").alias("cancellations"),
        _zi("no_shows").alias("no_shows"),
        _zi("bookings").alias("bookings"),
        _z("fnb_gross_sales").cast("double").alias("fnb_gross_sales"),
        _z("fnb_net_revenue").cast("double").alias("fnb_net_revenue"),
        _z("fnb_cogs").cast("double").alias("fnb_cogs"),
        _z("fnb_discount").cast("double").alias("fnb_discount"),
        _zi("fnb_transactions").alias("fnb_transactions"),
        _zi("void_lines").alias("void_lines"),
        _zi("fnb_lines").alias("fnb_lines"),
        _z("opex").cast("double").alias("opex"),
        _z("other_cogs").cast("double").alias("other_cogs"),
        _z("other_income").cast("double").alias("other_income"),
        dbl(occ).alias("occupancy_ratio"),
        dbl(occ * 100).alias("occupancy_pct"),
        dbl(safe_div(_z("room_revenue"), _zi("rooms_sold"))).alias("adr"),
        dbl(safe_div(_z("room_revenue"), rooms)).alias("revpar"),
        dbl(safe_div(_z("fnb_cogs"), F.when(_z("fnb_net_revenue") > 0, _z("fnb_net_revenue")))
            * 100).alias("food_cost_pct"),
        total.cast("double").alias("total_revenue"),
        ebitda.cast("double").alias("ebitda"),
    )


def hotel_monthly(star: Star, daily: DataFrame | None = None) -> DataFrame:
    """A5 ``mart_hotel_monthly``: rooms × days as capacity (not a constant)."""
    k = daily if daily is not None else kpi_daily(star, ["Hotel"])
    p = star.dim_property.select("property_id", "city", "rooms")
    k = k.filter(F.col("business_type") == "Hotel").join(F.broadcast(p), "property_id")
    g = k.groupBy("year", "month", "property_id", "property_name", "city").agg(
        F.round(F.sum("room_revenue"), 2).alias("room_revenue"),
        F.sum("occupied_room_nights").alias("occupied_room_nights"),
        F.sum("rooms_sold").alias("rooms_sold"),
        F.sum("bookings").alias("bookings"),
        F.sum("cancellations").alias("cancellations"),
        F.sum("no_shows").alias("no_shows"),
        F.count("*").alias("days_in_period"),
        F.sum("rooms").cast("bigint").alias("available_room_nights"))
    return g.select(
        "year", "month", "property_id", "property_name", "city",
        "room_revenue", "occupied_room_nights", "rooms_sold",
        "bookings", "cancellations", "no_shows", "days_in_period", "available_room_nights",
        dbl(safe_div("room_revenue", "rooms_sold")).alias("adr"),
        dbl(safe_div("room_revenue", "occupied_room_nights")).alias("adr_per_night"),
        dbl(safe_div("occupied_room_nights", "available_room_nights")).alias("occupancy_ratio"),
        dbl(safe_div("room_revenue", "available_room_nights")).alias("revpar"),
        dbl(safe_div("cancellations", "bookings") * 100).alias("cancellation_pct"),
        dbl(safe_div("no_shows", "bookings") * 100).alias("noshow_pct"))


def fnb_monthly(star: Star) -> DataFrame:
    """A6 ``mart_fnb_monthly`` by (year, month, property, outlet, category)."""
    f = star.fact_fnb_sales.withColumns({"year": F.year("sale_date"),
                                         "month": F.month("sale_date")})
    keys = ["year", "month", "property_id", "outlet_name", "category"]
    t = per_transaction(f, keys)
    g = t.groupBy(*keys).agg(
        F.sum("gross").alias("gross_sales"),
        F.sum("net_clean").alias("net_revenue"),
        F.sum("net_all").alias("net_sales_all"),
        F.sum("cogs").alias("cogs"),
        F.sum("disc").alias("discount"),
        F.sum("voids").cast("bigint").alias("void_lines"),
        F.sum("refunds").cast("bigint").alias("refund_lines"),
        F.sum("lines").cast("bigint").alias("lines"),
        F.count("transaction_id").alias("transactions"))
    g = g.join(F.broadcast(star.dim_property.select("property_id", "property_name")),
               "property_id")
    return g.select(
        "year", "month", "property_id", "property_name", "outlet_name", "category",
        F.col("gross_sales").cast("double").alias("gross_sales"),
        F.col("net_revenue").cast("double").alias("net_revenue"),
        F.col("cogs").cast("double").alias("cogs"),
        F.col("discount").cast("double").alias("discount"),
        "void_lines", "refund_lines", "lines", "transactions",
        dbl(safe_div("net_revenue", "transactions")).alias("average_check"),
        dbl(safe_div("cogs", "net_sales_all") * 100).alias("food_cost_pct"),
        (F.col("net_revenue") - F.col("cogs")).cast("double").alias("gross_profit"))


def finance_monthly(star: Star) -> DataFrame:
    """A7 ``mart_finance_monthly``: Σ amount by 7 keys (star join)."""
    e = star.fact_expense
    e = (e.join(F.broadcast(star.dim_property.select("property_id", "property_name")), "property_id")
         .join(F.broadcast(star.dim_account.select("account_id", "account_type", "account_name")),
               "account_id")
         .join(F.broadcast(star.dim_department), "department_id"))
    return (e.groupBy(F.year("expense_date").alias("year"), F.month("expense_date").alias("month"),
                      "property_id", "property_name", "account_type", "account_name",
                      "department_name")
            .agg(F.sum("amount").cast("double").alias("amount")))


def budget_vs_actual(star: Star) -> DataFrame:
    """A8 ``mart_budget_vs_actual``: actuals are summed to the month before the
    join (J15), so expenses on any day of the month count."""
    act = (star.fact_expense
           .groupBy(F.trunc("expense_date", "month").alias("budget_date"), "property_id",
                    "account_id")
           .agg(F.sum("amount").alias("actual")))
    b = star.fact_budget.join(act, ["budget_date", "property_id", "account_id"], "left")
    b = (b.join(F.broadcast(star.dim_property.select("property_id", "property_name")), "property_id")
         .join(F.broadcast(star.dim_department), "department_id")
         .join(F.broadcast(star.dim_account.select("account_id", "account_name", "account_type")),
               "account_id"))
    t = F.col("account_type")
    a = F.coalesce(F.col("actual"), _zero())
    g = b.groupBy(F.col("budget_year").alias("year"), F.col("budget_month").alias("month"),
                  "property_id", "property_name", "department_name", "account_name",
                  "account_type").agg(
        F.sum("budget_amount").alias("budget_amount"),
        F.sum(F.when(t == "Revenue", a).otherwise(_zero())).alias("actual_revenue"),
        F.sum(F.when(t == "OPEX", a).otherwise(_zero())).alias("actual_opex"),
        F.sum(F.when(t == "COGS", a).otherwise(_zero())).alias("actual_cogs"),
        F.sum(a).alias("actual_amount"))
    return g.select(
        "year", "month", "property_id", "property_name", "department_name", "account_name",
        "account_type",
        *[F.col(c).cast("double").alias(c) for c in
          ["budget_amount", "actual_revenue", "actual_opex", "actual_cogs", "actual_amount"]],
        (F.col("actual_amount") - F.col("budget_amount")).cast("double").alias("variance"),
        dbl(safe_div(F.col("actual_amount") - F.col("budget_amount"), "budget_amount") * 100)
        .alias("variance_pct"))
