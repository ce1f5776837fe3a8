"""Measure registry (M0): semantic-model measures evaluated at any grain.

For every fact a requested measure needs: conform the fact (calendar and
property attributes), apply the filters that fact can see, aggregate the
*base* measures at the ``group_by`` grain, full-outer-join the per-fact
results on the conformed keys, then compute ratios of sums with guarded
division. Facts are aggregated before they meet, so nothing fans out.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import safe_div
from ..operators.combine import prior_period, with_scalars
from .marts import property_days
from .roles import OTHER_INCOME_CODES, Star

DATE_ATTRS = ["year", "quarter", "month", "month_start", "full_date"]
PROPERTY_ATTRS = ["property_id", "property_name", "business_type", "city", "region"]
def _zero():
    return F.lit(0).cast("decimal(18,2)")

# EBITDA -> net profit factor.
NET_PROFIT_FACTOR = "0.72"


def _date_attrs(d: Column) -> dict[str, Column]:
    return {"year": F.year(d), "quarter": F.quarter(d), "month": F.month(d),
            "month_start": F.trunc(d, "month"), "full_date": d}


def conform(df: DataFrame, date_col: str, star: Star) -> DataFrame:
    """Add the calendar and property attributes every fact shares."""
    p = star.dim_property.select(*PROPERTY_ATTRS)
    return df.withColumns(_date_attrs(F.col(date_col))).join(F.broadcast(p), "property_id", "left")


@dataclass
class FactSpec:
    name: str
    build: Callable[[Star], DataFrame]
    base: Callable[[], list[Column]]


def _room(star):
    return conform(star.fact_room_sales, "check_in", star)


def _fnb(star):
    return conform(star.fact_fnb_sales, "sale_date", star)


def _expense(star):
    a = star.dim_account.select("account_id", "account_type", "account_code")
    return conform(star.fact_expense.join(F.broadcast(a), "account_id"), "expense_date", star)


def _budget(star):
    a = star.dim_account.select("account_id", "account_type", "account_code")
    return conform(star.fact_budget.join(F.broadcast(a), "account_id"), "budget_date", star)


def _capacity(star):
    """Calendar × hotel properties: available room nights per day."""
    d = star.dim_date.select("full_date")
    p = star.dim_property.filter(F.col("rooms").isNotNull())
    return (property_days(star, p).join(F.broadcast(d), "full_date")
            .withColumns({k: v for k, v in _date_attrs(F.col("full_date")).items()
                          if k != "full_date"}))


def _named(*cols: Column) -> dict[str, Column]:
    """Key aggregate expressions by their output name."""
    out = {}
    for c in cols:
        name = c._jc.toString().rsplit(" AS ", 1)[-1].strip("`")
        out[name] = c
    return out


def _clean():
    return (F.col("is_void") == 0) & (F.col("is_refund") == 0)


FACTS = {
    "room": FactSpec("room", _room, lambda: _named(
        F.sum("room_revenue").alias("room_revenue"),
        F.sum("rooms_sold").cast("bigint").alias("rooms_sold"),
        F.sum("room_nights").cast("bigint").alias("room_nights"),
        F.sum("los").cast("bigint").alias("los_nights"),
        F.count("*").alias("bookings"),
        F.sum("is_cancelled").cast("bigint").alias("cancellations"),
        F.sum("is_no_show").cast("bigint").alias("no_shows"))),
    "capacity": FactSpec("capacity", _capacity, lambda: _named(
        F.sum("rooms").cast("bigint").alias("available_room_nights"))),
    "fnb": FactSpec("fnb", _fnb, lambda: _named(
        F.sum("gross_sales").alias("fnb_gross_sales"),
        F.sum(F.when(_clean(), F.col("net_sales")).otherwise(_zero())).alias("fnb_net_revenue"),
        F.sum("cogs_amount").alias("fnb_cogs"),
        F.sum("discount").alias("fnb_discount"),
        F.count("*").alias("fnb_lines"),
        F.sum("is_void").cast("bigint").alias("void_lines"),
        F.countDistinct("transaction_id").alias("fnb_transactions"))),
    "expense": FactSpec("expense", _expense, lambda: _named(
        F.sum(F.when(F.col("account_type") == "OPEX", F.col("amount")).otherwise(_zero())).alias("opex"),
        F.sum(F.when(F.col("account_type") == "COGS", F.col("amount")).otherwise(_zero()))
        .alias("ledger_cogs"),
        F.sum(F.when((F.col("account_type") == "Revenue")
                     & F.col("account_code").isin(OTHER_INCOME_CODES), F.col("amount"))
              .otherwise(_zero())).alias("other_income"))),
    "budget": FactSpec("budget", _budget, lambda: _named(
        F.sum("budget_amount").alias("budget_amount"))),
}

BASE_OF = {"room_revenue": "room", "rooms_sold": "room", "room_nights": "room", "los_nights": "room", "bookings": "room",
           "cancellations": "room", "no_shows": "room", "available_room_nights": "capacity",
           "fnb_gross_sales": "fnb", "fnb_net_revenue": "fnb", "fnb_cogs": "fnb",
           "fnb_discount": "fnb", "fnb_lines": "fnb", "void_lines": "fnb",
           "fnb_transactions": "fnb", "opex": "expense", "ledger_cogs": "expense",
           "other_income": "expense", "budget_amount": "budget"}

COUNTS = {"rooms_sold", "room_nights", "los_nights", "bookings", "cancellations", "no_shows",
          "available_room_nights", "fnb_lines", "void_lines", "fnb_transactions"}


def _b(name):
    z = F.lit(0).cast("bigint") if name in COUNTS else _zero()
    return F.coalesce(F.col(name), z)


def _total():
    return _b("room_revenue") + _b("fnb_net_revenue") + _b("other_income")


def _ebitda():
    return _total() - _b("ledger_cogs") - _b("opex")


def _pct(n, d):
    return F.round(safe_div(n, d) * 100, 6)


def _ratio(n, d):
    return F.round(safe_div(n, d), 6)


# name -> (base measures needed, expression)
DERIVED: dict[str, tuple[list[str], Callable[[], Column]]] = {
    "occupancy_pct": (["room_nights", "available_room_nights"],
                      lambda: _pct(_b("room_nights"), F.col("available_room_nights"))),
    "adr": (["room_revenue", "rooms_sold"], lambda: _ratio(_b("room_revenue"), _b("rooms_sold"))),
    "revpar": (["room_revenue", "available_room_nights"],
               lambda: _ratio(_b("room_revenue"), F.col("available_room_nights"))),
    "cancellation_pct": (["cancellations", "bookings"],
                         lambda: _pct(_b("cancellations"), _b("bookings"))),
    "noshow_pct": (["no_shows", "bookings"], lambda: _pct(_b("no_shows"), _b("bookings"))),
    "avg_los": (["los_nights", "rooms_sold"], lambda: _ratio(_b("los_nights"), _b("rooms_sold"))),
    "food_cost_pct": (["fnb_cogs", "fnb_net_revenue"],
                      lambda: _pct(_b("fnb_cogs"), _b("fnb_net_revenue"))),
    "gross_profit": (["fnb_net_revenue", "fnb_cogs"],
                     lambda: (_b("fnb_net_revenue") - _b("fnb_cogs")).cast("double")),
    "gross_margin_pct": (["fnb_net_revenue", "fnb_cogs"],
                         lambda: _pct(_b("fnb_net_revenue") - _b("fnb_cogs"), _b("fnb_net_revenue"))),
    "average_check": (["fnb_net_revenue", "fnb_transactions"],
                      lambda: _ratio(_b("fnb_net_revenue"), _b("fnb_transactions"))),
    "discount_pct": (["fnb_discount", "fnb_gross_sales"],
                     lambda: _pct(_b("fnb_discount"), _b("fnb_gross_sales"))),
    "void_pct": (["void_lines", "fnb_lines"], lambda: _pct(_b("void_lines"), _b("fnb_lines"))),
    "total_revenue": (["room_revenue", "fnb_net_revenue", "other_income"],
                      lambda: _total().cast("double")),
    "ebitda": (["room_revenue", "fnb_net_revenue", "other_income", "ledger_cogs", "opex"],
               lambda: _ebitda().cast("double")),
    "ebitda_margin_pct": (["room_revenue", "fnb_net_revenue", "other_income", "ledger_cogs", "opex"],
                          lambda: _pct(_ebitda(), _total())),
    "net_profit": (["room_revenue", "fnb_net_revenue", "other_income", "ledger_cogs", "opex"],
                   lambda: (_ebitda() * F.lit(NET_PROFIT_FACTOR).cast("decimal(3,2)")).cast("double")),
    "budget_achievement_pct": (["room_revenue", "fnb_net_revenue", "other_income", "budget_amount"],
                               lambda: _pct(_total(), _b("budget_amount"))),
    "revenue_variance": (["room_revenue", "fnb_net_revenue", "other_income", "budget_amount"],
                         lambda: (_total() - _b("budget_amount")).cast("double")),
    "variance_pct": (["room_revenue", "fnb_net_revenue", "other_income", "budget_amount"],
                     lambda: _pct(_total() - _b("budget_amount"), _b("budget_amount"))),
}


def _fnb_two_level(df: DataFrame, group_by, wanted) -> DataFrame:
    """POS base measures via per-transaction partials (no countDistinct row
    expansion; a hot group is pre-aggregated map-side)."""
    from .marts import per_transaction
    t = per_transaction(df, group_by)
    second = {"fnb_gross_sales": F.sum("gross"), "fnb_net_revenue": F.sum("net_clean"),
              "fnb_cogs": F.sum("cogs"), "fnb_discount": F.sum("disc"),
              "fnb_lines": F.sum("lines").cast("bigint"), "void_lines": F.sum("voids").cast("bigint"),
              "fnb_transactions": F.count("transaction_id")}
    g = t.groupBy(*group_by) if group_by else t
    return g.agg(*[second[b].alias(b) for b in wanted])


def _apply_filters(df: DataFrame, filters) -> DataFrame:
    """Apply each filter the fact can see; a fact without the filtered
    attribute is unaffected (single-direction dim -> fact filtering)."""
    for k, v in (filters or {}).items():
        if k == "date_from" and "full_date" in df.columns:
            df = df.filter(F.col("full_date") >= F.lit(v).cast("date"))
        elif k == "date_to" and "full_date" in df.columns:
            df = df.filter(F.col("full_date") <= F.lit(v).cast("date"))
        elif k in df.columns:
            vals = v if isinstance(v, (list, tuple, set)) else [v]
            df = df.filter(F.col(k).isin(list(vals)))
    return df


def measures(star: Star, names, group_by, filters=None) -> DataFrame:
    """Evaluate base and derived measures ``names`` at the ``group_by`` grain.

    Facts are aggregated to the grain one by one and their rows united and
    merged by one more aggregation, in which null keys are a group like any
    other. An unknown measure, a filter that no fact of the request has, and
    a measure whose fact the grain cannot split are errors."""
    group_by = [group_by] if isinstance(group_by, str) else list(group_by)
    if unknown := [n for n in names if n not in DERIVED and n not in BASE_OF]:
        raise ValueError(f"unknown measures: {unknown}")
    unused = set(filters or {})
    base: list[str] = []
    for n in names:
        for b in (DERIVED[n][0] if n in DERIVED else [n]):
            if b not in base:
                base.append(b)
    frames = []
    for fname, spec in FACTS.items():
        wanted = [b for b in base if BASE_OF[b] == fname]
        if not wanted:
            continue
        df = spec.build(star)
        if missing := [g for g in group_by if g not in df.columns]:
            raise ValueError(f"{wanted} cannot be split by {missing}")
        unused -= {k for k in unused if k in df.columns or (k in ("date_from", "date_to") and "full_date" in df.columns)}
        df = _apply_filters(df, filters)
        if fname == "fnb":
            frames.append(_fnb_two_level(df, group_by, wanted))
            continue
        named = spec.base()
        frames.append(df.groupBy(*group_by).agg(*[named[b] for b in wanted]))
    if unused:
        raise ValueError(f"no fact of these measures has {sorted(unused)}")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    # a measure stands in one row of its group at most: max picks it
    out = out.groupBy(*group_by).agg(*[F.max(b).alias(b) for b in base])
    cols = [F.col(g) for g in group_by]
    for n in names:
        if n in DERIVED:
            cols.append(DERIVED[n][1]().alias(n))
        else:
            c = _b(n)
            cols.append((c if n in COUNTS else c.cast("double")).alias(n))
    return out.select(*cols)


def with_prior(df: DataFrame, period: str, keys, names, months: int, suffix: str) -> DataFrame:
    """J19 for measure frames: attach each measure from ``months`` earlier."""
    return prior_period(df, period, keys, names, months, suffix)
