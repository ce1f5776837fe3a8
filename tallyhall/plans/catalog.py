"""Query catalog: one callable ``(spark, sf_dir) -> DataFrame`` per query key.

Each key exercises one or more operators from the SURVEY inventory on the
driver's tables through the role map in :mod:`roles`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import marts
from ..operators.combine import with_scalars
from ..session import cut_lineage
from .roles import OTHER_INCOME_CODES, Star

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


@query("kpi_daily_spine")
def kpi_daily_spine(spark, sf_dir):
    return marts.kpi_daily(Star(spark, sf_dir))


@query("hotel_monthly")
def hotel_monthly(spark, sf_dir):
    return marts.hotel_monthly(Star(spark, sf_dir))


@query("fnb_monthly")
def fnb_monthly(spark, sf_dir):
    return marts.fnb_monthly(Star(spark, sf_dir))


@query("finance_monthly")
def finance_monthly(spark, sf_dir):
    return marts.finance_monthly(Star(spark, sf_dir))


@query("budget_vs_actual")
def budget_vs_actual(spark, sf_dir):
    return marts.budget_vs_actual(Star(spark, sf_dir))


# ---------------------------------------------------------------- parsing
from pyspark.sql import functions as F  # noqa: E402

from ..functions.dates import period_to_month  # noqa: E402
from ..functions.stats import money  # noqa: E402
from ..functions.text import (norm_key, parse_mixed_date, parse_mixed_number,  # noqa: E402
                              yn_flag)
from ..operators import clean  # noqa: E402


def _t(spark, sf_dir, name):
    return Star(spark, sf_dir).t(name)


def raw_date_text(li):
    """Ship dates written in six shapes (the last one unsupported)."""
    d = F.to_date("l_shipdate")
    k = F.col("l_linenumber") % 6
    return (F.when(k == 0, F.date_format(d, "yyyy-MM-dd"))
            .when(k == 1, F.date_format(d, "dd/MM/yyyy"))
            .when(k == 2, F.date_format(d, "MM-dd-yyyy"))
            .when(k == 3, F.upper(F.date_format(d, "dd-MMM-yyyy")))
            .when(k == 4, F.date_format(d, "yyyyMMdd"))
            .otherwise(F.date_format(d, "yyyy/MM/dd")))


@query("parse_mixed_dates")
def parse_mixed_dates(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    r = li.select("l_orderkey", "l_linenumber", raw_date_text(li).alias("raw_date"))
    return r.withColumn("parsed_date", parse_mixed_date("raw_date"))


def raw_number_text():
    """Prices and quantities written in five locale styles."""
    k = F.col("l_linenumber") % 5
    en = F.format_number("l_extendedprice", 2)
    qty = F.col("l_quantity").cast("int").cast("string")
    return (F.when(k == 0, en)
            .when(k == 1, F.translate(en, ",.", ".,"))
            .when(k == 2, F.regexp_replace(en, ",", ""))
            .when(k == 3, F.concat(qty, F.lit(".000")))
            .otherwise(F.concat(F.lit("- "), qty)))


@query("parse_mixed_numbers")
def parse_mixed_numbers(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    r = li.select("l_orderkey", "l_linenumber", raw_number_text().alias("raw_number"))
    return r.withColumn("parsed_number", parse_mixed_number("raw_number"))


def raw_name_text():
    k = F.col("p_partkey") % 4
    n = F.col("p_name")
    return (F.when(k == 0, F.upper(n))
            .when(k == 1, F.concat(F.lit("  "), n, F.lit(" ")))
            .when(k == 2, F.regexp_replace(n, " ", "-"))
            .otherwise(F.concat(n, F.lit(" & Co."))))


@query("norm_keys")
def norm_keys(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    r = p.select("p_partkey", raw_name_text().alias("raw_name"))
    return r.withColumn("name_key", norm_key("raw_name"))


@query("period_parse")
def period_parse(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    period = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM")) \
        .otherwise(F.date_format("o_orderdate", "MMM-yyyy"))
    r = o.select("o_orderkey", period.alias("period"))
    return r.withColumn("period_month", period_to_month("period"))


@query("yn_flags")
def yn_flags(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    raw = (F.when(F.col("l_returnflag") == "R", "y").when(F.col("l_returnflag") == "A", " Y ")
           .when(F.col("l_linestatus") == "O", "n").otherwise("N"))
    return (li.select(raw.alias("raw_flag"))
            .groupBy("raw_flag", yn_flag("raw_flag").alias("flag"))
            .agg(F.count("*").alias("n")))


# ---------------------------------------------------------------- dedup / numbering
LINE_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
              "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@query("dedup_first")
def dedup_first(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    return clean.dedup_first(p, ["p_name"], ["p_partkey"])


@query("dedup_exact")
def dedup_exact(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    r = li.select("l_orderkey", "l_partkey", "l_returnflag",
                  F.col("l_linenumber").alias("_raw_row"))
    return clean.dedup_exact(r, ignore=("_raw_row",))


@query("line_numbers")
def line_numbers(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    r = clean.line_numbers(li, "l_orderkey", LINE_ORDER, "line_no", base=1)
    return r.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                    F.to_date("l_shipdate").alias("ship_date"), "line_no")


@query("composite_keys")
def composite_keys(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    r = clean.line_numbers(li, "l_orderkey", LINE_ORDER, "n", base=0)
    return r.select(clean.composite_key("l_orderkey", "n").alias("purchase_line_id"),
                    "l_partkey", "l_suppkey",
                    F.col("l_extendedprice").cast("decimal(18,2)").cast("double").alias("total_amount"))


# ---------------------------------------------------------------- row repairs
@query("fix_interval")
def fix_interval(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    r = j.select("l_orderkey", "l_linenumber", F.to_date("o_orderdate").alias("stay_start"),
                 F.to_date("l_shipdate").alias("stay_end"))
    return clean.fix_interval(r, "stay_start", "stay_end", flag="swapped")


@query("fix_negative")
def fix_negative(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    r = clean.fix_negative(c, "c_acctbal", "zero", out="acctbal_floor")
    return clean.fix_negative(r, "c_acctbal", "abs", out="acctbal_abs")


@query("window_guard")
def window_guard(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("order_date"))
    return clean.window_guard(o, "order_date", "1996-01-01", "2000-12-31")


@query("los_flags")
def los_flags(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_extendedprice")
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    j = li.join(o, li.l_orderkey == o.o_orderkey).select(
        "o_orderstatus", F.to_date("o_orderdate").alias("check_in"),
        F.to_date("l_shipdate").alias("check_out"), "l_extendedprice")
    j = clean.fix_interval(j, "check_in", "check_out")
    flags = clean.status_flags("o_orderstatus", {"rooms_sold": "F", "is_cancelled": "O",
                                                 "is_no_show": "P"})
    j = j.withColumns(flags).withColumn("los", clean.length_of_stay("check_in", "check_out"))
    return j.groupBy("o_orderstatus").agg(
        F.count("*").alias("bookings"),
        F.sum("los").cast("bigint").alias("los_total"),
        F.sum("rooms_sold").cast("bigint").alias("rooms_sold"),
        F.sum(F.col("rooms_sold") * F.col("los")).cast("bigint").alias("room_nights"),
        F.sum("is_cancelled").cast("bigint").alias("cancellations"),
        F.sum("is_no_show").cast("bigint").alias("no_shows"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)") * F.col("rooms_sold"))
        .cast("double").alias("room_revenue"))


@query("unit_price_cogs")
def unit_price_cogs(spark, sf_dir):
    star = Star(spark, sf_dir)
    li = star.t("lineitem")
    prod = star.dim_product.select("product_id", "unit_cost_ratio")
    j = li.join(prod, li.l_partkey == prod.product_id)
    qty = F.when(F.col("l_linenumber") == 1, F.lit(0.0)).otherwise(F.col("l_quantity"))
    gross = F.col("l_extendedprice").cast("decimal(18,2)")
    return j.select(
        "l_orderkey", "l_linenumber", "l_partkey", qty.alias("quantity"),
        F.round(clean.guarded_unit_price("l_extendedprice", qty), 6).alias("unit_price"),
        F.round(gross * F.col("unit_cost_ratio"), 2).cast("double").alias("cogs_amount"))


# ---------------------------------------------------------------- blanks, trims, whitelist
def _blanked_part(p):
    small = F.col("p_size") <= 2
    return p.select(
        F.col("p_partkey").alias("_raw_row"),
        F.when(small, F.lit("  ")).otherwise(F.col("p_name")).alias("p_name"),
        F.when(small, F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("p_brand"),
        F.when(F.col("p_size") <= 3, F.lit("\t")).otherwise(F.col("p_type")).alias("p_type"))


@query("drop_blank_rows")
def drop_blank_rows(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    return clean.drop_blank_rows(_blanked_part(p), ignore=("_raw_row",))


@query("trim_all")
def trim_all(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    r = p.select("p_partkey",
                 F.concat(F.lit(" \t"), "p_name", F.lit("  ")).alias("p_name"),
                 F.concat("p_brand", F.lit("\n")).alias("p_brand"),
                 F.concat(F.lit("  "), "p_type").alias("p_type"))
    return clean.trim_all(r)


# The category whitelist used by the whitelist query.
CATEGORY_WHITELIST = ["Standard", "Medium", "Economy", "Large"]


@query("whitelist_default")
def whitelist_default(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    k = F.col("p_partkey") % 3
    raw = (F.when(k == 0, F.lower("p_type")).when(k == 1, F.concat(F.lit(" "), "p_type", F.lit(" ")))
           .otherwise(F.col("p_type")))
    r = p.select("p_partkey", raw.alias("raw_type"))
    return clean.whitelist(r, "raw_type", CATEGORY_WHITELIST, "Other", out="category")


# ---------------------------------------------------------------- lookups
from ..operators import lookup as lk  # noqa: E402
from ..operators.calendar import build_calendar, demand_index, holiday_dates, holiday_window_days  # noqa: E402,E501


def _supplier_raw_property(spark, sf_dir):
    """Each supplier names its nation in one of four spellings."""
    s = _t(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey)
    k = F.col("s_suppkey") % 4
    raw = (F.when(k == 0, F.col("n_name")).when(k == 1, F.concat(F.lit("HQ "), "n_name"))
           .when(k == 2, F.lower("n_name")).otherwise(F.regexp_replace("n_name", "_", "-")))
    return j.select("s_suppkey", raw.alias("raw_property"))


def _property_alias_map(spark, sf_dir):
    n = _t(spark, sf_dir, "nation")
    return (n.select(F.col("n_name").alias("alias"), F.col("n_nationkey").alias("pid"))
            .unionByName(n.select(F.concat(F.lit("HQ "), "n_name").alias("alias"),
                                  F.col("n_nationkey").alias("pid"))))


@query("alias_lookup")
def alias_lookup(spark, sf_dir):
    raw = _supplier_raw_property(spark, sf_dir)
    return lk.lookup(raw, "raw_property", _property_alias_map(spark, sf_dir), "alias", "pid",
                     out="property_id")


@query("normalized_lookup")
def normalized_lookup(spark, sf_dir):
    raw = _supplier_raw_property(spark, sf_dir)
    return lk.normalized_lookup(raw, "raw_property", _property_alias_map(spark, sf_dir), "alias",
                                "pid", out="property_id")


@query("two_stage_lookup")
def two_stage_lookup(spark, sf_dir):
    s = _t(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = _t(spark, sf_dir, "nation")
    j = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey)
    k3, k2 = F.col("s_suppkey") % 3, F.col("s_suppkey") % 2
    code = (F.when(k3 == 0, F.col("n_nationkey").cast("string"))
            .when(k3 == 1, F.concat(F.lit("X"), F.col("n_nationkey").cast("string"))))
    name = F.when(k2 == 0, F.lower("n_name")).otherwise(F.lit("unknown"))
    raw = j.select("s_suppkey", code.alias("raw_code"), name.alias("raw_name"))
    dim = n.select(F.col("n_nationkey").cast("string").alias("code"), "n_name",
                   F.col("n_nationkey").alias("pid"))
    return lk.two_stage_lookup(raw, "raw_code", "raw_name", dim, "code", "n_name", "pid",
                               "property_id")


UNKNOWN_PROPERTY = -1


@query("default_bucket")
def default_bucket(spark, sf_dir):
    return lk.default_bucket(alias_lookup(spark, sf_dir), "property_id", UNKNOWN_PROPERTY)


@query("quarantine_counts")
def quarantine_counts(spark, sf_dir):
    mapped = alias_lookup(spark, sf_dir)
    ok, bad = clean.quarantine(mapped, F.col("property_id").isNull(), "unmapped_property")
    return (ok.select(F.lit("ok").alias("status"))
            .unionByName(bad.select(F.col("_rule").alias("status")))
            .groupBy("status").agg(F.count("*").alias("n")))


# ---------------------------------------------------------------- fuzzy maps
@query("contains_match")
def contains_match(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    raw = p.select(raw_name_text().alias("raw_name"))
    dim = p.select("p_type").distinct()
    return lk.contains_match(raw, "raw_name", dim, "p_type", "p_type", "p_type", "matched_type")


def _token_raw(p):
    second = F.element_at(F.split("p_name", " "), 2)
    return (F.when(F.col("p_partkey") % 2 == 0,
                   F.concat(F.upper("p_name"), F.lit(" "), F.lower("p_type")))
            .otherwise(F.concat(second, F.lit(" "), F.col("p_type"))))


@query("token_overlap_match")
def token_overlap_match(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    raw = p.select(_token_raw(p).alias("raw_text"))
    dim = p.select("p_name").distinct()
    return lk.token_overlap_match(raw, "raw_text", dim, "p_name", "p_name", "p_name", 1,
                                  "matched_name")


def _coverage_raw():
    k = F.col("p_partkey") % 5
    first = F.element_at(F.split("p_name", " "), 1)
    second = F.element_at(F.split("p_name", " "), 2)
    return (F.when(k == 0, F.col("p_name"))
            .when(k == 1, F.concat(F.upper("p_name"), F.lit(" special")))
            .when(k == 2, F.regexp_replace("p_name", " ", "-"))
            .when(k == 3, F.concat(second, F.lit(" "), first))
            .otherwise(F.concat(second, F.lit(" deluxe"))))


@query("alias_coverage")
def alias_coverage(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    obs = p.select(_coverage_raw().alias("raw_name"))
    dim = p.select("p_name").distinct()
    amap, unmapped = lk.build_alias_map(obs, "raw_name", dim, "p_name", "p_name", "p_name",
                                        fallback="tokens", min_overlap=2)
    return (amap.select("raw", "id", "method")
            .unionByName(unmapped.select("raw", F.lit(None).cast("string").alias("id"),
                                         F.lit("unmapped").alias("method"))))


# ---------------------------------------------------------------- RI, semi, outer merge, sets
@query("ri_orphans")
def ri_orphans(spark, sf_dir):
    star = Star(spark, sf_dir)
    hotels = star.dim_property.filter(F.col("business_type") == "Hotel")
    rooms = star.fact_room_sales.select("booking_id", "property_id")
    return lk.orphans(rooms, "property_id", hotels, "property_id")


@query("semi_members")
def semi_members(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = _t(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    return lk.members(o, "o_custkey", c, "c_custkey")


@query("outer_merge_trend")
def outer_merge_trend(spark, sf_dir):
    from ..operators.combine import outer_merge
    star = Star(spark, sf_dir)
    room = (star.fact_room_sales.groupBy(F.date_format("check_in", "yyyy-MM").alias("month"))
            .agg(F.sum("room_revenue").cast("double").alias("room_revenue")))
    fnb = (star.t("lineitem").groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("month"))
           .agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double")
                .alias("fnb_revenue")))
    return outer_merge(room, fnb, ["month"])


def _customer_raw_property(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
    k = F.col("c_custkey") % 3
    raw = (F.when(k == 0, F.col("n_name")).when(k == 1, F.upper(F.concat(F.lit("mg "), "n_name")))
           .otherwise(F.concat(F.lit(" "), "n_name")))
    return j.select(raw.alias("raw_property"))


@query("union_distinct")
def union_distinct(spark, sf_dir):
    from ..operators.combine import union_distinct as ud
    return ud([_supplier_raw_property(spark, sf_dir), _customer_raw_property(spark, sf_dir)],
              "raw_property")


@query("set_difference")
def set_difference(spark, sf_dir):
    from ..operators.combine import set_difference as sd
    p = _t(spark, sf_dir, "part")
    observed = p.select(norm_key("p_type").alias("category_key"))
    allowed = spark.createDataFrame([(k.upper(),) for k in CATEGORY_WHITELIST] + [("OTHER",)],
                                    "category_key string")
    return sd(observed, allowed, "category_key")


# ---------------------------------------------------------------- calendar
def _data_bounds(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").agg(F.min(F.to_date("o_orderdate")).alias("lo"))
    li = _t(spark, sf_dir, "lineitem").agg(F.max(F.to_date("l_shipdate")).alias("hi"))
    return with_scalars(o, li)


@query("calendar_dim")
def calendar_dim(spark, sf_dir):
    return build_calendar(_data_bounds(spark, sf_dir))


@query("holiday_windows")
def holiday_windows(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("order_date"))
    years = o.select(F.year("order_date").alias("y")).distinct()
    years = years.select(F.explode(F.array(F.col("y") - 1, F.col("y"), F.col("y") + 1))
                         .alias("year")).distinct()
    win = holiday_window_days(holiday_dates(spark, years))
    j = o.join(F.broadcast(win), o.order_date == win.window_date, "left")
    flag = F.col("window_date").isNotNull().cast("int")
    return j.select("o_orderkey", "order_date", flag.alias("in_window"),
                    F.round(demand_index("order_date", flag), 6).alias("demand_index"))


# ---------------------------------------------------------------- distributions
from ..operators import describe as ds  # noqa: E402
from ..operators import timeseries as ts  # noqa: E402


@query("describe_series")
def describe_series(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return ds.describe_series(ev, "value", by="event_type")


@query("check_size")
def check_size(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    checks = (li.groupBy("l_orderkey")
              .agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double")
                   .alias("check_total")))
    return ds.describe_series(checks, "check_total")


@query("ratio_distribution")
def ratio_distribution(spark, sf_dir):
    f = Star(spark, sf_dir).fact_fnb_sales
    ratio = F.when(F.col("net_sales") > 0,
                   F.col("cogs_amount").cast("double") / F.col("net_sales").cast("double") * 100)
    return ds.describe_series(f.select("category", ratio.alias("food_cost_pct")),
                              "food_cost_pct", by="category")


@query("histogram")
def histogram(spark, sf_dir):
    return ds.histogram(_t(spark, sf_dir, "lineitem"), "l_extendedprice", 40, 0.99)


# ---------------------------------------------------------------- segments, KPI rows, counts
@query("segment_topk")
def segment_topk(spark, sf_dir):
    from pyspark.sql import Window
    star = Star(spark, sf_dir)
    r = star.fact_room_sales.join(
        F.broadcast(star.dim_property.select("property_id", "property_name")), "property_id")
    f = star.fact_fnb_sales.filter((F.col("is_void") == 0) & (F.col("is_refund") == 0))

    def tot(df, dim, member, measure):
        return (df.groupBy(F.col(member).cast("string").alias("member"))
                .agg(F.sum(measure).cast("double").alias("revenue"))
                .withColumn("dimension", F.lit(dim)))

    u = (tot(r, "property", "property_name", "room_revenue")
         .unionByName(tot(r, "channel", "channel", "room_revenue"))
         .unionByName(tot(r, "segment", "segment", "room_revenue"))
         .unionByName(tot(f, "category", "category", "net_sales")))
    w = Window.partitionBy("dimension").orderBy(F.desc("revenue"), "member")
    return (u.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= 8)
            .select("dimension", "member", "revenue", "rank"))


KPI_METRICS = ["room_revenue", "rooms_sold", "fnb_net_revenue", "fnb_cogs", "gross_profit",
               "food_cost_pct", "adr", "date_span_days", "n_properties"]


@query("kpi_long")
def kpi_long(spark, sf_dir):
    star = Star(spark, sf_dir)
    r = star.fact_room_sales.agg(
        F.sum("room_revenue").alias("room_revenue"), F.sum("rooms_sold").alias("rooms_sold"),
        (F.datediff(F.max("check_in"), F.min("check_in")) + 1).alias("date_span_days"),
        F.countDistinct("property_id").alias("n_properties"))
    clean_ = (F.col("is_void") == 0) & (F.col("is_refund") == 0)
    f = star.fact_fnb_sales.agg(
        F.sum(F.when(clean_, F.col("net_sales")).otherwise(0)).alias("fnb_net_revenue"),
        F.sum("cogs_amount").alias("fnb_cogs"))
    row = with_scalars(r, f).select(
        "*", (F.col("fnb_net_revenue") - F.col("fnb_cogs")).alias("gross_profit"),
        (F.col("fnb_cogs").cast("double") / F.nullif(F.col("fnb_net_revenue").cast("double"), F.lit(0.0))
         * 100).alias("food_cost_pct"),
        (F.col("room_revenue").cast("double") / F.nullif(F.col("rooms_sold").cast("double"), F.lit(0.0)))
        .alias("adr"))
    out = ds.long_kpis(row, KPI_METRICS)
    return out.select("metric", F.round("value", 6).alias("value"))


@query("row_counts")
def row_counts(spark, sf_dir):
    star = Star(spark, sf_dir)
    return ds.row_counts({
        "dim_property": star.dim_property, "dim_product": star.dim_product,
        "fact_room_sales": star.fact_room_sales, "fact_fnb_sales": star.fact_fnb_sales,
        "fact_expense": star.fact_expense, "fact_budget": star.fact_budget,
        "fact_purchase": star.fact_purchase, "fact_inventory": star.fact_inventory})


# ---------------------------------------------------------------- series
def room_series(star, by_property=True):
    keys = ["property_id"] if by_property else []
    return (star.fact_room_sales.groupBy(*keys, F.col("check_in").alias("ds"))
            .agg(F.sum("room_revenue").cast("double").alias("revenue")))


@query("rolling7")
def rolling7(spark, sf_dir):
    s = room_series(Star(spark, sf_dir))
    r = ts.rolling_mean(s, "revenue", "ds", by="property_id", n=7)
    return r.select("property_id", "ds", "revenue", F.round("rolling_mean", 4).alias("rolling_mean"),
                    F.round("diff_from_rolling", 4).alias("diff_from_rolling"))


@query("rolling_median28")
def rolling_median28(spark, sf_dir):
    s = room_series(Star(spark, sf_dir))
    r = ts.rolling_median(s, "revenue", "ds", by="property_id", n=28)
    return r.select("property_id", "ds", "revenue", F.round("rolling_median", 4).alias("rolling_median"),
                    F.round("deviation", 4).alias("deviation"))


@query("zscore_anomalies")
def zscore_anomalies(spark, sf_dir):
    s = room_series(Star(spark, sf_dir), by_property=False)
    z = ts.zscores(s, "revenue").filter(F.abs("z") > 2)
    return (z.orderBy(F.desc(F.abs("z")), "ds").limit(10)
            .select("ds", "revenue", F.round("z", 6).alias("z")))


def _exact_sum(c, kind="decimal(18,2)"):
    """Sum of a rounded measure, the same whatever the order of the rows."""
    return F.sum(F.col(c).cast(kind)).cast("double")


def _exact_avg(c, places=6):
    """Average of a measure of six places, rounded half up in whole numbers:
    neither the order of the rows nor a binary fraction decides a tie."""
    total = (F.sum(F.col(c).cast("decimal(18,6)")) * 1_000_000).cast("decimal(28,0)")
    unit = F.count(c) * 10 ** (6 - places)
    return (F.floor((2 * total + unit) / F.nullif(2 * unit, F.lit(0))).cast("double") / 10 ** places)


def kpi_series_long(daily):
    g = daily.groupBy("full_date").agg(
        _exact_sum("total_revenue").alias("daily_revenue"),
        _exact_avg("occupancy_pct").alias("occupancy"),
        (_exact_sum("fnb_cogs") / F.nullif(_exact_sum("fnb_net_revenue"), F.lit(0.0)) * 100).alias("food_cost"),
        F.sum("fnb_transactions").cast("double").alias("fnb_transactions"))
    return (g.selectExpr("full_date", "stack(4, 'daily_revenue', daily_revenue, 'occupancy', occupancy, "
                         "'food_cost', food_cost, 'fnb_transactions', fnb_transactions) AS (series, v)")
            .filter(F.col("v").isNotNull()))


@query("outliers_hi_lo")
def outliers_hi_lo(spark, sf_dir):
    # days x 4 rows at any scale, read by the stats and by the rows they
    # are joined back to: written once to the shared checkpoint folder
    long = cut_lineage(kpi_series_long(marts.kpi_daily(Star(spark, sf_dir))))
    z = ts.zscores(long, "v", by="series")
    return (z.filter(F.abs("z") > 3)
            .select("series", "full_date", F.round("v", 6).alias("v"), F.round("z", 6).alias("z"),
                    F.when(F.col("z") > 0, "high").otherwise("low").alias("side")))


@query("iqr_anomalies")
def iqr_anomalies(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("event_id", "event_type", "value")
    r = ts.iqr_fences(ev, "value", by="event_type", k=1.5)
    return r.select("event_id", "event_type", "value", F.round("lower_fence", 6).alias("lower_fence"),
                    F.round("upper_fence", 6).alias("upper_fence"))


# Business-rule thresholds (percent units).
BR_FOOD_COST, BR_OCC_MAX, BR_OCC_MIN, BR_DISCOUNT, BR_VOID = 40.0, 100.0, 20.0, 20.0, 5.0


@query("business_rules")
def business_rules(spark, sf_dir):
    k = marts.kpi_daily(Star(spark, sf_dir))
    disc = F.col("fnb_discount") / F.nullif(F.col("fnb_gross_sales"), F.lit(0.0)) * 100
    void = F.col("void_lines") / F.nullif(F.col("fnb_lines").cast("double"), F.lit(0.0)) * 100
    rules = {
        "negative_net_revenue": (F.col("fnb_net_revenue") < 0, F.col("fnb_net_revenue")),
        "occupancy_above_max": (F.col("occupancy_pct") > BR_OCC_MAX, F.col("occupancy_pct")),
        "occupancy_below_min": (F.col("occupancy_pct") < BR_OCC_MIN, F.col("occupancy_pct")),
        "food_cost_high": (F.col("food_cost_pct") > BR_FOOD_COST, F.col("food_cost_pct")),
        "discount_high": (disc > BR_DISCOUNT, disc),
        "void_rate_high": (void > BR_VOID, void),
    }
    r = ts.rule_hits(k, ["date_key", "property_id"], rules)
    return r.select("date_key", "property_id", "rule", F.round("value", 6).alias("value"))


# ---------------------------------------------------------------- stock
@query("densify_ffill")
def densify_ffill(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    daily = (ev.groupBy("user_id", F.to_date("ts").alias("ds"))
             .agg(F.max_by("value", F.struct("ts", "event_id")).alias("value")))
    return ts.densify_ffill(daily, "user_id", "ds", "value")


def _inv(spark, sf_dir):
    return Star(spark, sf_dir).fact_inventory


@query("stock_continuity")
def stock_continuity(spark, sf_dir):
    r = ts.stock_continuity(_inv(spark, sf_dir), ["store_id", "item"], "stock_date",
                            "opening_stock", "closing_stock")
    return r.select("store_id", "item", "stock_date",
                    *[F.col(c).cast("double").alias(c) for c in
                      ["opening_stock", "closing_stock", "prev_closing", "continuity_gap"]])


@query("stock_variance")
def stock_variance(spark, sf_dir):
    r = ts.stock_variance(_inv(spark, sf_dir))
    return r.select("store_id", "item", "stock_date",
                    *[F.col(c).cast("double").alias(c) for c in
                      ["opening_stock", "closing_stock", "theoretical_closing", "inventory_variance"]])


@query("moving_unit_cost")
def moving_unit_cost(spark, sf_dir):
    p = Star(spark, sf_dir).fact_purchase
    daily = p.groupBy("product_id", "purchase_date").agg(
        F.sum(F.col("quantity").cast("decimal(18,2)")).alias("qty"),
        F.sum("total_amount").alias("total"))
    r = ts.moving_unit_cost(daily, "product_id", "purchase_date", "total", "qty")
    return r.select("product_id", "purchase_date", F.col("qty").cast("double").alias("qty"),
                    F.col("total").cast("double").alias("total"),
                    F.round("moving_unit_cost", 6).alias("moving_unit_cost"))


REORDER_COVERAGE_DAYS = 5


@query("reorder_signal")
def reorder_signal(spark, sf_dir):
    r = clean.reorder_signal(_inv(spark, sf_dir), "opening_stock", "consumption_qty",
                             REORDER_COVERAGE_DAYS)
    return (r.filter(F.col("needs_reorder") == 1)
            .select("store_id", "item", "stock_date",
                    F.col("opening_stock").cast("double").alias("opening_stock"),
                    F.col("consumption_qty").cast("double").alias("consumption_qty")))


# ---------------------------------------------------------------- forecasts
HORIZON = 90


def _levels_mean(s):
    return s.groupBy("property_id").agg(F.avg("revenue").alias("level"),
                                        F.date_add(F.max("ds"), 1).alias("start"))


def _levels_last30(s):
    last = ts.last_n(s, "property_id", "ds", 30)
    return last.groupBy("property_id").agg(F.avg("revenue").alias("level"))


@query("forecast_wave")
def forecast_wave(spark, sf_dir):
    s = room_series(Star(spark, sf_dir))
    f = ts.wave_forecast(_levels_mean(s), "property_id", "level", "start", HORIZON)
    return f.select("property_id", "forecast_date", "step", F.round("forecast", 4).alias("forecast"))


@query("forecast_moving_avg")
def forecast_moving_avg(spark, sf_dir):
    s = room_series(Star(spark, sf_dir))
    lv = _levels_last30(s).join(_levels_mean(s).select("property_id", "start"), "property_id")
    f = ts.wave_forecast(lv, "property_id", "level", "start", HORIZON)
    return f.select("property_id", "forecast_date", "step", F.round("forecast", 4).alias("forecast"))


@query("forecast_accuracy")
def forecast_accuracy(spark, sf_dir):
    s = room_series(Star(spark, sf_dir))
    cut = s.groupBy("property_id").agg(F.date_sub(F.max("ds"), HORIZON - 1).alias("cutoff"))
    s = s.join(F.broadcast(cut), "property_id")
    train = s.filter(F.col("ds") < F.col("cutoff"))
    test = s.filter(F.col("ds") >= F.col("cutoff")).select(
        "property_id", F.col("ds").alias("forecast_date"), F.col("revenue").alias("actual"))
    mean_lv = train.groupBy("property_id", "cutoff").agg(F.avg("revenue").alias("level"))
    ma_lv = _levels_last30(train).join(cut, "property_id")
    out = None
    for name, lv in [("wave", mean_lv), ("moving_avg", ma_lv)]:
        fc = ts.wave_forecast(lv, "property_id", "level", "cutoff", HORIZON)
        acc = ts.accuracy(test, fc, "property_id").withColumn("model", F.lit(name))
        out = acc if out is None else out.unionByName(acc)
    return out.select("property_id", "model", "n", F.round("mape", 4).alias("mape"),
                      F.round("mae", 4).alias("mae"), F.round("rmse", 4).alias("rmse"))


@query("forecast_seasonal")
def forecast_seasonal(spark, sf_dir):
    """T3 (rows-only check): Holt-Winters per property on the zero-filled
    daily room revenue series."""
    s = room_series(Star(spark, sf_dir))
    b = s.groupBy("property_id").agg(F.min("ds").alias("lo"), F.max("ds").alias("hi"))
    spine = b.select("property_id", F.explode(F.sequence("lo", "hi")).alias("ds"))
    dense = (spine.join(s, ["property_id", "ds"], "left")
             .select("property_id", "ds", F.coalesce("revenue", F.lit(0.0)).alias("revenue")))
    return ts.seasonal_forecast(dense, "property_id", "ds", "revenue", HORIZON, HORIZON, 7)


# ---------------------------------------------------------------- data quality
from ..operators import quality as qa  # noqa: E402

PROFILE_TABLES = ["orders", "customer"]


@query("profile_columns")
def profile_columns(spark, sf_dir):
    out = None
    for t in PROFILE_TABLES:
        p = qa.profile(_t(spark, sf_dir, t), t)
        out = p if out is None else out.unionByName(p)
    return out


@query("findings")
def findings(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    raw = li.select("l_quantity", "l_discount", raw_date_text(li).alias("raw_date"))
    f1 = qa.findings(raw, "lineitem", {
        "unparsable_date": parse_mixed_date("raw_date").isNull(),
        "negative_quantity": F.col("l_quantity") < 0,
        "zero_discount": F.col("l_discount") == 0})
    f2 = qa.findings(_t(spark, sf_dir, "customer"), "customer",
                     {"negative_balance": F.col("c_acctbal") < 0})
    f3 = qa.findings(_t(spark, sf_dir, "supplier"), "supplier",
                     {"negative_balance": F.col("s_acctbal") < 0})
    p = clean.whitelist(_t(spark, sf_dir, "part"), "p_type", CATEGORY_WHITELIST, "Other", "cat")
    f4 = qa.findings(p, "part", {"invalid_category": F.col("cat") == "Other"})
    dup = qa.duplicate_rows(li, ["l_orderkey", "l_linenumber"]).select(
        F.lit("duplicate_line_key").alias("rule"), F.lit("lineitem").alias("source"),
        F.col("duplicate_rows").alias("records_affected"))
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    j = li.select("l_orderkey", "l_shipdate").join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    f5 = qa.findings(j, "lineitem", {"ship_before_order": F.col("l_shipdate") < F.col("o_orderdate")})
    return f1.unionByName(f2).unionByName(f3).unionByName(f4).unionByName(dup).unionByName(f5)


def _gate(star):
    g = qa.Gate()
    r, f, e, inv = star.fact_room_sales, star.fact_fnb_sales, star.fact_expense, star.fact_inventory
    g.rows(r, "fact_room_sales", {
        "booking_id_not_null": F.col("booking_id").isNotNull(),
        "check_out_after_check_in": F.col("check_out") >= F.col("check_in"),
        "revenue_non_negative": F.col("room_revenue") >= 0})
    g.unique(r, "fact_room_sales", "booking_id")
    g.rows(f, "fact_fnb_sales", {
        "product_not_null": F.col("product_id").isNotNull(),
        "quantity_non_negative": F.col("quantity") >= 0,
        "net_le_gross": F.col("net_sales") <= F.col("gross_sales") + F.lit(0.01)})
    g.unique(f, "fact_fnb_sales", ["transaction_id", "line_no"])
    g.references(r, "fact_room_sales", "property_id", star.dim_property, "property_id")
    g.references(f, "fact_fnb_sales", "product_id", star.dim_product, "product_id")
    g.references(e, "fact_expense", "account_id", star.dim_account, "account_id")
    g.references(e, "fact_expense", "department_id", star.dim_department, "department_id")
    g.rows(inv, "fact_inventory", {"closing_non_negative": F.col("closing_stock") >= 0})
    return g


@query("gate_checks")
def gate_checks(spark, sf_dir):
    return _gate(Star(spark, sf_dir)).result()


def _with_flag(df, col, dim, key, flag):
    d = dim.select(F.col(key).alias("__fk")).distinct().withColumn(flag, F.lit(True))
    return df.join(F.broadcast(d), F.col(col) == F.col("__fk"), "left").drop("__fk") \
        .withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


# The item domain of the stock series.
STOCK_ITEMS = ["purchase", "view", "click", "error", "signup"]


def _health_specs(star):
    props = star.dim_property
    r = _with_flag(star.fact_room_sales, "property_id", props, "property_id", "_ri")
    f = _with_flag(star.fact_fnb_sales, "property_id", props, "property_id", "_ri")
    e = _with_flag(star.fact_expense, "property_id", props, "property_id", "_ri")
    inv = star.fact_inventory
    return [
        qa.SourceSpec("bookings", "orders", r, ["booking_id"], "check_in",
                      ["booking_id", "property_id", "check_in"],
                      (F.col("room_revenue") >= 0) & (F.col("los") >= 1),
                      F.col("check_out") >= F.col("check_in"), F.col("_ri"),
                      F.col("segment").isNotNull()),
        qa.SourceSpec("pos", "lineitem", f, ["transaction_id", "line_no"], "sale_date",
                      ["transaction_id", "product_id", "property_id"],
                      F.col("quantity") >= 0, F.col("net_sales") <= F.col("gross_sales") + F.lit(0.01),
                      F.col("_ri"), F.col("category").isNotNull()),
        qa.SourceSpec("ledger", "orders", e, ["expense_id"], "expense_date",
                      ["expense_id", "account_id", "property_id"],
                      F.col("amount") >= 0,
                      (F.col("transaction_type") == "Credit") | (F.col("transaction_type") == "Debit"),
                      F.col("_ri"), F.col("department_id").isNotNull()),
        qa.SourceSpec("inventory", "events", inv, ["stock_date", "store_id", "item"], "stock_date",
                      ["store_id", "item"], F.col("closing_stock") >= 0, F.col("movements") >= 1,
                      F.col("item").isin(STOCK_ITEMS), F.col("store_id").isNotNull()),
    ]


@query("source_health")
def source_health(spark, sf_dir):
    return qa.source_health(_health_specs(Star(spark, sf_dir)))


RECONCILE_METRICS = ["room_revenue", "rooms_sold", "occupied_room_nights", "bookings",
                     "fnb_gross_sales", "fnb_net_revenue", "fnb_cogs", "opex", "other_income"]


@query("reconcile_kpis")
def reconcile_kpis(spark, sf_dir):
    star = Star(spark, sf_dir)
    daily = marts.kpi_daily(star)
    a = daily.agg(*[F.round(F.sum(m).cast("double"), 2).alias(m) for m in RECONCILE_METRICS])
    # the other side: the facts' rows, added up without the mart's builders
    sold = F.col("is_void") + F.col("is_refund") == 0
    kind = F.col("account_type")
    sides = [
        (star.fact_room_sales, {
            "room_revenue": F.sum("room_revenue"), "rooms_sold": F.sum("rooms_sold"),
            "occupied_room_nights": F.sum("room_nights"), "bookings": F.count("*")}),
        (star.fact_fnb_sales, {
            "fnb_gross_sales": F.sum("gross_sales"), "fnb_net_revenue": F.sum(F.when(sold, F.col("net_sales"))),
            "fnb_cogs": F.sum("cogs_amount")}),
        (star.fact_expense.join(F.broadcast(star.dim_account.select("account_id", "account_type", "account_code")),
                                "account_id"), {
            "opex": F.sum(F.when(kind == "OPEX", F.col("amount"))),
            "other_income": F.sum(F.when((kind == "Revenue") & F.col("account_code").isin(*OTHER_INCOME_CODES),
                                         F.col("amount")))}),
    ]
    b = None
    for fact, sums in sides:
        part = ds.long_kpis(fact.agg(*[F.round(c.cast("double"), 2).alias(m) for m, c in sums.items()]), list(sums))
        b = part if b is None else b.unionByName(part)
    return qa.reconcile(ds.long_kpis(a, RECONCILE_METRICS), b)


# Allowed domains per coded column.
DOMAINS = {
    "business_type": ["Hotel", "F&B"],
    "account_type": ["Revenue", "COGS", "OPEX"],
    "transaction_type": ["Debit", "Credit"],
    "order_status": ["F", "O", "P"],
    "return_flag": ["A", "N", "R"],
}


@query("domain_check")
def domain_check(spark, sf_dir):
    star = Star(spark, sf_dir)
    parts = [
        qa.domain_check(star.dim_property, "business_type", "business_type", DOMAINS["business_type"]),
        qa.domain_check(star.dim_account, "account_type", "account_type", DOMAINS["account_type"]),
        qa.domain_check(star.fact_expense, "transaction_type", "transaction_type",
                        DOMAINS["transaction_type"]),
        qa.domain_check(star.t("orders"), "order_status", "o_orderstatus", DOMAINS["order_status"]),
        qa.domain_check(star.t("lineitem"), "return_flag", "l_returnflag", DOMAINS["return_flag"]),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- measures
from . import measures as ms  # noqa: E402

ALL_MEASURES = [
    "room_revenue", "rooms_sold", "room_nights", "bookings", "available_room_nights",
    "occupancy_pct", "adr", "revpar", "cancellation_pct", "noshow_pct", "avg_los",
    "fnb_gross_sales", "fnb_net_revenue", "fnb_cogs", "food_cost_pct", "gross_profit",
    "gross_margin_pct", "fnb_transactions", "average_check", "discount_pct", "void_pct",
    "opex", "ledger_cogs", "other_income", "total_revenue", "ebitda", "ebitda_margin_pct",
    "net_profit", "budget_amount", "budget_achievement_pct", "revenue_variance", "variance_pct"]

SEGMENT_MEASURES = ["room_revenue", "rooms_sold", "room_nights", "bookings", "adr",
                    "cancellation_pct", "noshow_pct", "avg_los"]


@query("measures_by_property")
def measures_by_property(spark, sf_dir):
    return ms.measures(Star(spark, sf_dir), ALL_MEASURES,
                       ["property_id", "property_name", "business_type"])


@query("measures_by_month")
def measures_by_month(spark, sf_dir):
    return ms.measures(Star(spark, sf_dir), ALL_MEASURES, ["year", "month"])


@query("measures_by_segment")
def measures_by_segment(spark, sf_dir):
    return ms.measures(Star(spark, sf_dir), SEGMENT_MEASURES, ["segment"],
                       filters={"business_type": "Hotel"})


@query("yoy_mom")
def yoy_mom(spark, sf_dir):
    from ..functions.stats import safe_div
    base = ["total_revenue", "room_revenue", "fnb_net_revenue", "ebitda", "room_nights",
            "available_room_nights", "fnb_cogs"]
    # the monthly frame (months rows at any scale) feeds three branches:
    # written once to the shared checkpoint folder instead of recomputed
    m = cut_lineage(ms.measures(Star(spark, sf_dir), base, ["month_start"]))
    ly = ms.with_prior(m, "month_start", [], base, 12, "_ly")
    lm = m.select(F.add_months("month_start", 1).alias("month_start"),
                  F.col("total_revenue").alias("total_revenue_lm"))
    j = ly.join(lm, "month_start", "left")

    def pct(a, b):
        return F.round(safe_div(F.col(a) - F.col(b), b) * 100, 6)

    return j.select(
        "month_start", "total_revenue", "total_revenue_ly",
        pct("total_revenue", "total_revenue_ly").alias("revenue_yoy_pct"),
        "total_revenue_lm", pct("total_revenue", "total_revenue_lm").alias("revenue_mom_pct"),
        "room_revenue_ly", "fnb_net_revenue_ly", "ebitda", "ebitda_ly",
        pct("ebitda", "ebitda_ly").alias("ebitda_yoy_pct"),
        F.round(safe_div("room_nights", "available_room_nights") * 100, 6).alias("occupancy_pct"),
        F.round(safe_div("room_nights_ly", "available_room_nights_ly") * 100, 6)
        .alias("occupancy_pct_ly"),
        F.round(safe_div("fnb_cogs", "fnb_net_revenue") * 100, 6).alias("food_cost_pct"),
        F.round(safe_div("fnb_cogs_ly", "fnb_net_revenue_ly") * 100, 6).alias("food_cost_pct_ly"))


@query("revenue_share")
def revenue_share(spark, sf_dir):
    from ..functions.stats import safe_div
    m = ms.measures(Star(spark, sf_dir), ["room_revenue", "fnb_net_revenue", "total_revenue"], ["month_start"])
    return m.select("month_start", *[F.round(c, 2).alias(c) for c in ("room_revenue", "fnb_net_revenue", "total_revenue")],
                    F.round(safe_div("room_revenue", "total_revenue") * 100, 6).alias("hotel_share_pct"),
                    F.round(safe_div("fnb_net_revenue", "total_revenue") * 100, 6).alias("fnb_share_pct"))


# Healthy bands per KPI (lo, hi); None = open end.
KPI_BANDS = [
    ("occupancy_pct", 65.0, 85.0), ("food_cost_pct", None, 32.0),
    ("gross_margin_pct", 65.0, None), ("ebitda_margin_pct", 28.0, None),
    ("cancellation_pct", None, 8.0), ("noshow_pct", None, 2.0), ("avg_los", 2.0, 4.0),
    ("discount_pct", None, 6.0), ("void_pct", None, 2.0),
]


@query("kpi_bands")
def kpi_bands(spark, sf_dir):
    names = [k for k, _, _ in KPI_BANDS]
    m = ms.measures(Star(spark, sf_dir), names, ["property_id"])
    long = m.select("property_id", F.explode(F.array(*[
        F.struct(F.lit(n).alias("kpi"), F.col(n).cast("double").alias("value")) for n in names]))
        .alias("k")).select("property_id", "k.kpi", "k.value")
    bands = spark.createDataFrame(KPI_BANDS, "kpi string, lo double, hi double")
    j = long.join(F.broadcast(bands), "kpi")
    status = (F.when(F.col("value").isNull(), "n/a")
              .when(F.col("lo").isNotNull() & (F.col("value") < F.col("lo")), "low")
              .when(F.col("hi").isNotNull() & (F.col("value") > F.col("hi")), "high")
              .otherwise("ok"))
    return j.select("property_id", "kpi", "value", "lo", "hi", status.alias("status"))


# ---------------------------------------------------------------- trends, DQ summary, insights
@query("daily_trend")
def daily_trend(spark, sf_dir):
    """Daily revenue, average occupancy and average ADR across properties
    (``avg`` skips nulls)."""
    k = marts.kpi_daily(Star(spark, sf_dir))
    return k.groupBy("full_date").agg(
        _exact_sum("total_revenue").alias("revenue"),
        _exact_avg("occupancy_pct").alias("avg_occupancy_pct"),
        _exact_avg("adr", 4).alias("avg_adr"))


@query("quarantine_by_rule")
def quarantine_by_rule(spark, sf_dir):
    """P5: rows and amounts of every source, kept by its fact or left out, by
    the first rule broken; the rows of a source add up."""
    star = Star(spark, sf_dir)
    out = star.quarantine.groupBy("source", "rule").agg(F.count("*").alias("n_rows"), F.sum("amount").alias("amount"))
    kept = None
    for source, table, col, fact, key in (
            ("bookings", "orders", "o_totalprice", star.fact_room_sales, "room_rate"),
            ("ledger", "orders", "o_totalprice", star.fact_expense, None),
            ("pos", "lineitem", "l_extendedprice", star.fact_fnb_sales, "gross_sales"),
            ("purchases", "lineitem", "l_extendedprice", star.fact_purchase, "total_amount")):
        n = fact.agg(F.count("*").alias("n_rows"), *([F.sum(key).alias("amount")] if key else []))
        if key is None:  # the ledger keeps a share of the amount: what is not left out
            bad = star.quarantine.where(F.col("source") == source).agg(F.coalesce(F.sum("amount"), F.lit(0)).alias("bad"))
            total = star.t(table).agg(F.sum(money(col)).alias("total"))
            n = with_scalars(n, total)
            n = with_scalars(n, bad).select("n_rows", (F.col("total") - F.col("bad")).alias("amount"))
        n = n.where("n_rows > 0").select(F.lit(source).alias("source"), F.lit("kept").alias("rule"), "n_rows", "amount")
        kept = n if kept is None else kept.unionByName(n)
    return out.unionByName(kept).select("source", "rule", "n_rows", F.col("amount").cast("double").alias("amount"))


@query("dq_summary")
def dq_summary(spark, sf_dir):
    """DQ score, completeness, duplicate rate (averages) and
    failed records (sum) over the source-health table."""
    h = qa.source_health(_health_specs(Star(spark, sf_dir)))
    return h.agg(F.round(F.avg("quality_score"), 6).alias("dq_score"),
                  F.round(F.avg("completeness_pct"), 6).alias("completeness_pct"),
                  F.round(F.avg("duplicate_rate_pct"), 6).alias("duplicate_rate_pct"),
                  F.sum("failed_records").cast("bigint").alias("failed_records"))


INSIGHT_METRICS = [("total_revenue", "total_revenue_ly"), ("ebitda", "ebitda_ly"),
                   ("occupancy_pct", "occupancy_pct_ly")]


@query("insight_evidence")
def insight_evidence(spark, sf_dir):
    """Evidence rows (metric, value, baseline = same month last year,
    delta, delta %, direction) for the monthly headline measures."""
    y = yoy_mom(spark, sf_dir)
    arr = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"),
                             F.col(b).cast("double").alias("baseline")) for m, b in INSIGHT_METRICS])
    e = y.select("month_start", F.explode(arr).alias("e")).select("month_start", "e.*")
    e = e.filter(F.col("baseline").isNotNull() & F.col("value").isNotNull())
    delta = F.col("value") - F.col("baseline")
    return e.select("month_start", "metric", "value", "baseline", F.round(delta, 6).alias("delta"),
                    F.round(F.try_divide(delta, F.nullif(F.abs("baseline"), F.lit(0.0))) * 100, 6)
                    .alias("delta_pct"),
                    F.when(delta > 0, "up").when(delta < 0, "down").otherwise("flat").alias("direction"))


@query("finding_evidence")
def finding_evidence(spark, sf_dir):
    """Sorted distinct offending values (first 10) per finding."""
    li = _t(spark, sf_dir, "lineitem")
    raw = li.select(raw_date_text(li).alias("raw_date"))
    e1 = qa.evidence(raw, parse_mixed_date("raw_date").isNull(), "raw_date", "unparsable_date", "lineitem")
    p = _t(spark, sf_dir, "part")
    k = F.col("p_partkey") % 3
    rt = p.select((F.when(k == 0, F.lower("p_type")).when(k == 1, F.concat(F.lit(" "), "p_type", F.lit(" ")))
                   .otherwise(F.col("p_type"))).alias("raw_type"))
    rt = clean.whitelist(rt, "raw_type", CATEGORY_WHITELIST, "Other", "cat")
    e2 = qa.evidence(rt, F.col("cat") == "Other", "raw_type", "invalid_category", "part")
    c = _t(spark, sf_dir, "customer")
    e3 = qa.evidence(c, F.col("c_acctbal") < 0, "c_name", "negative_balance", "customer")
    return e1.unionByName(e2).unionByName(e3)


# ---------------------------------------------------------------- raw ingest
def _raw_lineitem_csv(spark, sf_dir) -> str:
    """Write lineitem as a dirty text extract (mixed date shapes, locale
    numbers, padded flags, an always-blank column, all-blank rows) into a
    fresh folder under the session's shared checkpoint folder."""
    import uuid

    from ..session import checkpoint_dir
    li = _t(spark, sf_dir, "lineitem")
    cols = ["l_orderkey", "l_linenumber", "ship_date", "amount", "return_flag", "prop_code"]
    rows = li.select(F.col("l_orderkey").cast("string").alias("l_orderkey"),
                     F.col("l_linenumber").cast("string").alias("l_linenumber"),
                     raw_date_text(li).alias("ship_date"), raw_number_text().alias("amount"),
                     F.concat(F.lit(" "), "l_returnflag").alias("return_flag"),
                     F.lit(None).cast("string").alias("prop_code"))
    blanks = li.filter(F.col("l_linenumber") == 7).select(*[F.lit(" ").alias(c) for c in cols])
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tallyhall-raw/{uuid.uuid4().hex}/lineitem"
    (rows.unionByName(blanks).write.mode("overwrite").option("header", True)
     .option("ignoreTrailingWhiteSpace", False).option("ignoreLeadingWhiteSpace", False).csv(path))
    return path


@query("raw_csv_ingest")
def raw_csv_ingest(spark, sf_dir):
    from ..sources import io
    path = _raw_lineitem_csv(spark, sf_dir)
    job = io.SourceJob("pos_lines", path, date_cols=["ship_date"], num_cols=["amount"])
    staged = io.stage(io.read_raw(spark, path), job)
    return staged.select(
        F.col("l_orderkey").cast("bigint").alias("l_orderkey"),
        F.col("l_linenumber").cast("int").alias("l_linenumber"),
        "ship_date", "amount", "return_flag",
        ((F.col("_raw_row") >= 2) & F.col("_source_file").isNotNull()).cast("int").alias("lineage_ok"),
        F.lit(",".join(staged.columns)).alias("staged_columns"))


# ---------------------------------------------------------------- cleaning stage
from . import cleaning  # noqa: E402


def _doubles(df):
    """Decimals as doubles, at the edge."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name)
                       for f in df.schema.fields])


def _clean_query(name):
    def run(spark, sf_dir):
        return _doubles(cleaning.cleaned(spark, Star(spark, sf_dir), name))
    run.__name__, run.__doc__ = f"clean_{name}", f"The cleaned {name} extract."
    return run


for _source in cleaning.CLEANERS:
    QUERIES[f"clean_{_source}"] = _clean_query(_source)


@query("cleansing_log")
def cleansing_log(spark, sf_dir):
    return cleaning.log(spark, Star(spark, sf_dir))


@query("gate_full")
def gate_full(spark, sf_dir):
    """Every check of the gate on the six cleaned tables: what cleaning gives is
    checked as it comes, and not stored in between."""
    return cleaning.gate_result(spark, Star(spark, sf_dir))


# ---------------------------------------------------------------- master data maps
from . import master  # noqa: E402


@query("property_dim")
def property_dim(spark, sf_dir):
    return master.property_dim(Star(spark, sf_dir))


def _map_query(name):
    def run(spark, sf_dir):
        return master.MAPS[name](Star(spark, sf_dir)).withColumnRenamed("id", f"{name}_id")
    run.__name__, run.__doc__ = f"{name}_map", master.MAPS[name].__doc__
    return run


for _name in master.MAPS:
    QUERIES[f"{_name}_map"] = _map_query(_name)


@query("map_coverage")
def map_coverage(spark, sf_dir):
    return master.map_coverage(Star(spark, sf_dir))
