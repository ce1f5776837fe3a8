"""The six source cleaners: dirty extract -> conformed rows, quarantine, log.

Each cleaner is a :class:`~tallyhall.operators.cleanse.Cleanse`: duplicates
combined, names mapped to the masters, unreadable or unknown rows quarantined
under a rule, the rest repaired. Masters are joined by normalized name behind
the size check; amounts stay text until they are parsed to the declared
decimals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import date_key, period_to_month
from ..functions.text import norm_key, parse_trimmed_date, trim_ws, yn_flag
from ..operators import clean, lookup
from ..operators.calendar import calendar_between
from ..operators.cleanse import Cleanse, cleansing_log
from ..operators.gate import Checks, run, run_parts
from ..operators.ranges import has_large_groups
from ..session import written_table
from .extracts import extract
from .roles import Star

# Members that rows with an unknown one go to; the segments and categories.
UNKNOWN_SUPPLIER, OTHER = "S999", "Other"
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
#: Reporting window of the bookings cleaner, inclusive.
WINDOW = ("1995-01-01", "2000-12-31")


def number(c: str, scale: int = 2):
    """A plain decimal text as its declared type; null if it is none."""
    return F.expr(f"try_cast(trim({c}) AS DECIMAL(16,{scale}))")


def product_names(star: Star) -> DataFrame:
    """(key, product_id, unit_cost_ratio): how extracts spell products."""
    return star.dim_product.select(F.concat(F.lit("ITEM "), F.col("product_id").cast("string")).alias("key"), "product_id", "unit_cost_ratio")


#: The column whose hash deals a source's rows into parts: rows that are
#: combined, numbered together or have a key in common agree in it.
PART_BY = {"bookings": "booking_id", "pos": "transaction_id", "ledger": "expense_id", "purchases": "purchase_id"}


def _source(spark: SparkSession, star: Star, name: str, part: tuple[int, int] | None) -> DataFrame:
    """The extract, or its rows of one part (k, n): the k-th of n."""
    df = extract(spark, star, name)
    return df if part is None else df.where(F.pmod(F.xxhash64(PART_BY[name]), F.lit(part[1])) == part[0])


def _map(raw: str, mp: DataFrame, key: str, values, out):
    """Attach ``values`` of the master whose normalized ``key`` the raw text
    has; masters have unique keys."""
    return lambda df: lookup.normalized_lookup(df, raw, mp, key, values, out, on_ambiguous="quarantine").drop("_ambiguous")


def _property(c: Cleanse, star: Star, source_rule: str = "unknown property") -> Cleanse:
    return (c.using(_map("property", star.dim_property, "property_name", "property_id", "property_id"))
            .quarantine(source_rule, F.col("property_id").isNull()))


def _dated(c: Cleanse, raw: str, out: str) -> Cleanse:
    # trimmed in a step of its own: the parser names its text many times
    c.derive(__text=trim_ws(raw)).derive(**{out: parse_trimmed_date("__text")}).using(lambda df: df.drop("__text"))
    return c.quarantine(f"unreadable {raw}", F.col(out).isNull())


def bookings(spark: SparkSession, star: Star, part: tuple[int, int] | None = None) -> Cleanse:
    c = Cleanse(_source(spark, star, "bookings", part), "bookings").dedup("duplicate booking_id", "booking_id")
    c = _property(c, star)
    c.derive(**{k: trim_ws(k) for k in ("cancellation_status", "booking_channel")})
    c.using(lambda df: clean.whitelist(df, "guest_segment", SEGMENTS, OTHER, "segment"))
    c.repair("segment not in master", F.col("segment") == OTHER, "set to Other")
    c.derive(channel=F.regexp_replace("booking_channel", " - ", "-"))
    _dated(_dated(c, "check_in", "arrival"), "check_out", "departure")
    c.repair("check_out before check_in", F.col("departure") < F.col("arrival"), "swapped", arrival=F.col("departure"), departure=F.col("arrival"))
    c.derive(room_rate=number("room_rate")).quarantine("unreadable rate", F.col("room_rate").isNull())
    c.repair("negative rate", F.col("room_rate") < 0, "set to 0", room_rate=F.lit(0).cast("decimal(16,2)"))
    c.quarantine("outside the window", ~F.col("arrival").between(*[F.lit(d).cast("date") for d in WINDOW]))
    flags = clean.status_flags("cancellation_status", {"is_cancelled": "Cancelled", "is_no_show": "No-Show"})
    c.derive(los=clean.length_of_stay("arrival", "departure"), **flags)
    c.derive(rooms_sold=(1 - F.col("is_cancelled")) * (1 - F.col("is_no_show")))
    return c.derive(room_nights=F.col("los") * F.col("rooms_sold"), room_revenue=(F.col("rooms_sold") * F.col("room_rate")).cast("decimal(16,2)"),
                    date_id=date_key("arrival"))


def pos(spark: SparkSession, star: Star, within: str | None = None, part: tuple[int, int] | None = None) -> Cleanse:
    c = Cleanse(_source(spark, star, "pos", part), "pos").dedup("duplicate line", within=within)
    outlets = star.t("supplier").select("s_name", F.col("s_name").alias("outlet_name"), F.col("s_nationkey").alias("property_id"))
    c.using(_map("outlet", outlets, "s_name", ["outlet_name", "property_id"], ["outlet_name", "property_id"]))
    c.quarantine("unknown outlet", F.col("property_id").isNull())
    c.using(_map("product_name", product_names(star), "key", ["product_id", "unit_cost_ratio"], ["product_id", "unit_cost_ratio"]))
    c.quarantine("unknown product", F.col("product_id").isNull())
    c.derive(raw_category=F.col("category")).using(lambda df: clean.whitelist(df, "raw_category", CATEGORIES, OTHER, "category"))
    c.repair("category not in master", F.col("category") == OTHER, "set to Other")
    _dated(c, "transaction_date", "sale_date")
    c.derive(quantity=number("quantity", 3), gross_sales=number("gross_sales"), discount=number("discount"))
    c.repair("missing discount", F.col("discount").isNull(), "set to 0", discount=F.lit(0).cast("decimal(16,2)"))
    c.repair("negative quantity", F.col("quantity") < 0, "absolute value", quantity=F.abs("quantity"))
    c.derive(net_sales=(F.col("gross_sales") - F.abs("discount")).cast("decimal(16,2)"), is_void=yn_flag("void_flag"), is_refund=yn_flag("refund_flag"),
             cogs_amount=F.round(F.col("gross_sales") * F.col("unit_cost_ratio"), 2).cast("decimal(16,2)"),
             unit_price=F.round(clean.guarded_unit_price("gross_sales", "quantity"), 6))
    return c.derive(gross_profit=(F.col("net_sales") - F.col("cogs_amount")).cast("decimal(16,2)"), date_id=date_key("sale_date"))


def ledger(spark: SparkSession, star: Star, part: tuple[int, int] | None = None) -> Cleanse:
    c = Cleanse(_source(spark, star, "ledger", part), "ledger").dedup("duplicate ledger line")
    c = _property(c, star)
    acc = star.dim_account
    c.using(_map("account_code", acc, "account_code", "account_id", "by_code")).using(_map("account_name", acc, "account_name", "account_id", "by_name"))
    c.derive(account_id=F.col("by_code"))
    c.repair("malformed account code", F.col("by_code").isNull() & F.col("by_name").isNotNull(), "mapped by name", account_id=F.col("by_name"))
    c.quarantine("unknown account", F.col("account_id").isNull())
    _dated(c, "transaction_date", "expense_date")
    return c.derive(amount=number("amount"), date_id=date_key("expense_date"))


#: Products of the stock extract.
STOCK_PRODUCTS = ["click", "error", "purchase", "signup", "view"]
_QUANTITIES = ["opening_stock", "purchase_qty", "transfer_qty", "consumption_qty", "waste_qty", "closing_stock"]


def inventory(spark: SparkSession, star: Star) -> Cleanse:
    """Equal rows are combined first; of what is left, rows of a (date,
    property, product) after the first are quarantined as such."""
    c = Cleanse(extract(spark, star, "inventory"), "inventory").dedup("duplicate stock row")
    c = _property(c, star)
    c.using(lambda df: clean.whitelist(df, "product_name", STOCK_PRODUCTS, "", "product_id"))
    c.quarantine("unknown product", F.col("product_id") == "")
    _dated(c, "inventory_date", "stock_date")
    c.derive(stock_value=number("stock_value"), **{q: number(q, 3) for q in _QUANTITIES})
    c.repair("missing transfer", F.col("transfer_qty").isNull(), "set to 0", transfer_qty=F.lit(0).cast("decimal(16,3)"))
    # the first of a grain, as a joined aggregate: a hot grain is reduced in every task
    grain, first = ["stock_date", "property_id", "product_id"], "__first"

    def with_first(df):
        rest = df.where(c.alive()).groupBy(*[F.col(g).alias(f"__{g}") for g in grain]).agg(F.min("_raw_row").alias(first))
        same = F.lit(True)
        for g in grain:
            same &= F.col(g) == F.col(f"__{g}")
        return df.join(rest, same, "left").drop(*[f"__{g}" for g in grain])
    c.using(with_first).quarantine("second row of a day's stock", F.col("_raw_row") > F.col(first))
    c.repair("negative consumption", F.col("consumption_qty") < 0, "absolute value", consumption_qty=F.abs("consumption_qty"))
    return c.derive(date_id=date_key("stock_date"))


def purchases(spark: SparkSession, star: Star, within: str | None = None, part: tuple[int, int] | None = None) -> Cleanse:
    c = Cleanse(_source(spark, star, "purchases", part), "purchases").dedup("duplicate purchase line", within=within)
    c = _property(c, star)
    c.using(_map("product_name", product_names(star), "key", "product_id", "product_id"))
    c.quarantine("unknown product", F.col("product_id").isNull())
    sup = star.t("supplier").select("s_name", F.format_string("S%03d", "s_suppkey").alias("supplier_id"))
    c.using(_map("supplier", sup, "s_name", "supplier_id", "supplier_id"))
    c.repair("unknown supplier", F.col("supplier_id").isNull(), "set to S999", supplier_id=F.lit(UNKNOWN_SUPPLIER))
    _dated(c, "purchase_date", "bought_on")
    c.derive(quantity=number("quantity", 3), unit_price=number("unit_price"))
    total = F.round(F.col("quantity") * F.col("unit_price"), 2).cast("decimal(16,2)")
    c.derive(total_amount=number("list_total"))
    c.repair("total is not quantity x price", F.abs(F.col("total_amount") - F.col("quantity") * F.col("unit_price")) >= 0.02,
             "recomputed", total_amount=total)
    return c.derive(date_id=date_key("bought_on"))


def budget(spark: SparkSession, star: Star) -> Cleanse:
    c = Cleanse(extract(spark, star, "budget"), "budget").dedup("duplicate budget line")
    c = _property(c, star)
    c.using(_map("account", star.dim_account, "account_name", ["account_id", "department_id"], ["account_id", "department_id"]))
    c.quarantine("unknown account", F.col("account_id").isNull())
    c.derive(budget_date=period_to_month("period")).quarantine("unreadable period", F.col("budget_date").isNull())
    return c.derive(budget_amount=number("budget_amount"), date_id=date_key("budget_date"),
                    budget_year=F.year("budget_date"), budget_month=F.month("budget_date"))


CLEANERS = {"bookings": bookings, "pos": pos, "ledger": ledger, "inventory": inventory, "purchases": purchases, "budget": budget}
#: The columns of each cleaned table.
COLUMNS = {
    "bookings": ["booking_id", "property_id", "segment", "channel", "arrival", "departure", "los", "is_cancelled", "is_no_show",
                 "rooms_sold", "room_nights", "room_rate", "room_revenue", "date_id"],
    "pos": ["transaction_id", "line_no", "outlet_name", "property_id", "product_id", "category", "sale_date", "quantity", "gross_sales",
            "discount", "net_sales", "unit_price", "cogs_amount", "gross_profit", "is_void", "is_refund", "date_id"],
    "ledger": ["expense_id", "property_id", "account_id", "expense_date", "amount", "date_id"],
    "inventory": ["stock_date", "property_id", "product_id", *_QUANTITIES, "stock_value", "date_id"],
    "purchases": ["purchase_line_id", "purchase_id", "property_id", "product_id", "supplier_id", "bought_on", "quantity", "unit_price",
                  "total_amount", "date_id"],
    "budget": ["budget_date", "property_id", "department_id", "account_id", "budget_amount", "budget_year", "budget_month", "date_id"],
}
_LINE_ORDER = {"pos": ["till_line", "outlet", "product_name", "category", "transaction_date", "quantity", "gross_sales", "discount", "void_flag",
                       "refund_flag"],
               "purchases": ["doc_line", "property", "product_name", "supplier", "purchase_date", "quantity", "list_total", "unit_price"]}


#: The transaction or document of a line.
_LINE_GROUP = {"pos": "transaction_id", "purchases": "purchase_id"}


def numbered(name: str, df: DataFrame, split: bool = True) -> DataFrame:
    """Cleaned rows with their running number in the transaction (POS, from
    1) or the purchase (from 0, as part of a key). With ``split``, numbering
    reads them three times."""
    if name == "pos":
        return clean.line_numbers(df, "transaction_id", _LINE_ORDER["pos"], "line_no", split=split)
    if name == "purchases":
        r = clean.line_numbers(df, "purchase_id", _LINE_ORDER["purchases"], "__n", base=0, split=split)
        return r.withColumn("purchase_line_id", clean.composite_key("purchase_id", "__n"))
    return df


def _has_large_lines(spark: SparkSession, star: Star) -> bool:
    """Whether a transaction or document may have more than a task's share."""
    return has_large_groups(star.t("lineitem"), ["l_orderkey"], int(spark.conf.get("spark.sql.shuffle.partitions")))


def cleaned(spark: SparkSession, star: Star, name: str, part: tuple[int, int] | None = None, split: bool | None = None) -> DataFrame:
    """The cleaned table of a source, amounts as declared decimals; of one part
    (``PART_BY``), if it is given.

    Lines are dealt by their transaction when equal lines are combined, and are
    numbered in the same tasks. Only if a transaction may have more than a
    task's share (``split``, if it is known) are they written first and numbered
    by ranges."""
    only = {} if part is None else {"part": part}
    if name not in _LINE_GROUP:
        return CLEANERS[name](spark, star, **only).clean().select(*COLUMNS[name])
    split = _has_large_lines(spark, star) if split is None else split
    df = CLEANERS[name](spark, star, within=None if split else _LINE_GROUP[name], **only).clean()
    if split:
        used = {*COLUMNS[name], *_LINE_ORDER[name]}
        df = written_table(df.select(*[c for c in df.columns if c in used]), f"clean-{name}")
    return numbered(name, df, split).select(*COLUMNS[name])


def log(spark: SparkSession, star: Star) -> DataFrame:
    """Every rule of every source: rows affected, before and after."""
    return cleansing_log([make(spark, star).log() for make in CLEANERS.values()])


#: Days that the warehouse's calendar has, inclusive.
CALENDAR = ("1995-01-01", "2025-12-31")


def checks(star: Star, tables: dict[str, DataFrame], only=None) -> list[Checks]:
    """Every check of the gate on the cleaned tables (those of ``only``):
    keys, rules, and the references to property, product, date, account,
    department, supplier."""
    day = calendar_between(star.spark, *CALENDAR).select("date_key")
    all_of = {n: Checks(df, n).refers("property_id", star.dim_property, "property_id").refers("date_id", day, "date_key")
              for n, df in tables.items() if not only or n in only}
    for name, add in _CHECKS.items():
        if name in all_of:
            add(all_of[name], star)
    return list(all_of.values())


#: Rows of a fact that the gate takes in one part at most, about.
PART_ROWS = 40_000_000
_FACT = {"bookings": "orders", "pos": "lineitem", "ledger": "orders", "inventory": "events", "purchases": "lineitem", "budget": "orders"}


def gate_result(spark: SparkSession, star: Star) -> DataFrame:
    """Every check on the cleaned tables as they come. If a fact has more than
    ``PART_ROWS`` rows, tables are checked one by one and large ones in parts,
    so that the disk holds what one part moves and not what all tables do; the
    budget is a few sums and the stock is taken whole, as its days' first rows
    are known only together."""
    rows = {f: star.t(f).count() for f in set(_FACT.values())}  # the files' own counts
    split = _has_large_lines(spark, star)
    if max(rows.values()) <= PART_ROWS:
        return run(checks(star, {n: cleaned(spark, star, n, split=split) for n in CLEANERS}))

    def parts():
        for name in CLEANERS:
            n = -(-rows[_FACT[name]] // PART_ROWS) if name in PART_BY else 1
            for k in range(max(1, n)):
                yield checks(star, {name: cleaned(spark, star, name, (k, n) if n > 1 else None, split)})
    return run_parts(spark, parts())


def _booking_checks(c: Checks, star: Star) -> None:
    c.unique("booking_id").not_null("booking_id")
    c.rule(departure_after_arrival=F.col("departure") >= F.col("arrival"), revenue_not_negative=F.col("room_revenue") >= 0)


def _pos_checks(c: Checks, star: Star) -> None:
    c.unique("transaction_id", "line_no").not_null("product_id", "property_id").refers("product_id", star.dim_product, "product_id")
    c.rule(quantity_not_negative=F.col("quantity") >= 0, net_at_most_gross=F.col("net_sales") <= F.col("gross_sales") + F.lit("0.01").cast("decimal(3,2)"))


def _ledger_checks(c: Checks, star: Star) -> None:
    c.not_null("account_id").refers("account_id", star.dim_account, "account_id")


def _inventory_checks(c: Checks, star: Star) -> None:
    stock = star.spark.createDataFrame([(p,) for p in STOCK_PRODUCTS], "product_id string")
    c.unique("date_id", "property_id", "product_id").rule(closing_not_negative=F.col("closing_stock") >= 0).refers("product_id", stock, "product_id")


def _purchase_checks(c: Checks, star: Star) -> None:
    supplier = star.t("supplier").select(F.format_string("S%03d", "s_suppkey").alias("supplier_id"))
    supplier = supplier.unionByName(star.spark.createDataFrame([(UNKNOWN_SUPPLIER,)], "supplier_id string"))
    c.refers("product_id", star.dim_product, "product_id").refers("supplier_id", supplier, "supplier_id")
    c.rule(total_is_quantity_x_price=F.abs(F.col("total_amount") - F.col("quantity") * F.col("unit_price")) < F.lit("0.02").cast("decimal(3,2)"))


def _budget_checks(c: Checks, star: Star) -> None:
    c.unique("date_id", "property_id", "department_id", "account_id").refers("department_id", star.dim_department, "department_id")


_CHECKS = {"bookings": _booking_checks, "pos": _pos_checks, "ledger": _ledger_checks, "inventory": _inventory_checks,
           "purchases": _purchase_checks, "budget": _budget_checks}
