"""Role map: the driver's star tables dressed as a hospitality star schema.

| Role                 | Source                                                  |
|----------------------|---------------------------------------------------------|
| property (spine)     | ``nation`` ⋈ ``region``; EUROPE nations are F&B units   |
| booking              | ``orders`` ⋈ ``customer`` (status F/O/P = confirmed /   |
|                      | cancelled / no-show; LOS = priority digit)              |
| segment, channel     | ``c_mktsegment``, ``o_orderpriority``                   |
| POS line             | ``lineitem`` ⋈ ``supplier`` (outlet) ⋈ ``part``         |
| product, category    | ``part``, ``p_type``; cost ratio = (20 + p_size) %      |
| ledger               | ``orders`` ⋈ ``customer``, account chosen by priority   |
| budget               | ledger by (property, account, month) one year earlier   |
|                      | × 1.05                                                  |
| purchase             | ``lineitem`` ⋈ ``supplier``                             |
| stock series         | ``events`` by (user_id, event_type, day)                |

Everything is a lazy DataFrame over the parquet scans, so Catalyst prunes
columns and pushes predicates into the scans of whichever query uses it.
"""

from __future__ import annotations

import os
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import date_key, month_start
from ..functions.stats import money, rate
from ..operators.calendar import calendar_between
from ..operators.lookup import dim_join

# The region whose nations are F&B units (no rooms).
FNB_REGION = "EUROPE"

# Chart of accounts used by the ledger role, keyed by the order
# priority that selects it: (priority, account_id, code, name, type, dept).
ACCOUNTS = [
    ("1-URGENT", "A6000", "6000", "Staff Salary", "OPEX", "D006"),
    ("2-HIGH", "A6001", "6001", "Utility Expense", "OPEX", "D004"),
    ("3-MEDIUM", "A5000", "5000", "Food Cost", "COGS", "D003"),
    ("4-NOT SPECIFIED", "A4002", "4002", "Other Income", "Revenue", "D006"),
    ("5-LOW", "A4000", "4000", "Room Revenue", "Revenue", "D001"),
]
ACCOUNT_SCHEMA = ("priority string, account_id string, account_code string, "
                  "account_name string, account_type string, department_id string")

# Departments (id, name).
DEPARTMENTS = [
    ("D001", "Rooms"), ("D002", "Food & Beverage"), ("D003", "Kitchen"),
    ("D004", "Engineering"), ("D005", "Sales & Marketing"),
    ("D006", "Administration"), ("D007", "Housekeeping"),
]

# Revenue account codes counted as other income in the marts.
OTHER_INCOME_CODES = ["4002", "4003", "4005", "4006"]

BUDGET_UPLIFT = "1.05"
LEDGER_SHARE = "0.01"

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def read_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(os.path.join(sf_dir, f"{t}.parquet")) for t in TABLES
            if os.path.exists(os.path.join(sf_dir, f"{t}.parquet"))}


class Star:
    """Lazily built dimensions and facts over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, cal_lo: str | None = None,
                 cal_hi: str | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self._window = (cal_lo, cal_hi)

    def t(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def window(self) -> tuple[str, str]:
        """Reporting window (inclusive): the whole years from the first to the
        last date of any fact, so no dated row falls outside the spine. One
        pass over two date columns; one row comes back."""
        lo, hi = self._window
        if lo is None or hi is None:
            dates = (self.t("orders").select(F.col("o_orderdate").alias("d"))
                     .unionByName(self.t("lineitem").select(F.col("l_shipdate").alias("d"))))
            first, last = dates.agg(F.min(F.year("d")), F.max(F.year("d"))).first()
            lo = lo or f"{first or 2000:04d}-01-01"
            hi = hi or f"{last or 2000:04d}-12-31"
        return lo, hi

    @property
    def cal_lo(self) -> str:
        return self.window[0]

    @property
    def cal_hi(self) -> str:
        return self.window[1]

    # ------------------------------------------------------------ dimensions
    @cached_property
    def dim_property(self) -> DataFrame:
        n, r = self.t("nation"), self.t("region")
        fnb = F.col("r_name") == FNB_REGION
        return (n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
                .select(F.col("n_nationkey").alias("property_id"),
                        F.col("n_name").alias("property_name"),
                        F.when(fnb, "F&B").otherwise("Hotel").alias("business_type"),
                        F.col("n_name").alias("city"),
                        F.col("r_name").alias("region"),
                        F.when(fnb, F.lit(None)).otherwise(100 + 4 * F.col("n_nationkey"))
                        .cast("int").alias("rooms"),
                        F.when(fnb, "F&B").otherwise("Midscale").alias("property_class")))

    @cached_property
    def dim_date(self) -> DataFrame:
        return calendar_between(self.spark, self.cal_lo, self.cal_hi)

    @cached_property
    def dim_account(self) -> DataFrame:
        return self.spark.createDataFrame(ACCOUNTS, ACCOUNT_SCHEMA)

    @cached_property
    def dim_department(self) -> DataFrame:
        return self.spark.createDataFrame(DEPARTMENTS, "department_id string, department_name string")

    @cached_property
    def dim_product(self) -> DataFrame:
        p = self.t("part")
        return p.select(F.col("p_partkey").alias("product_id"),
                        F.col("p_name").alias("product_name"),
                        F.col("p_type").alias("category"),
                        F.col("p_brand").alias("brand"),
                        F.col("p_retailprice").alias("base_price"),
                        ((F.col("p_size") + 20) * F.lit(0.01).cast("decimal(3,2)"))
                        .cast("decimal(5,4)").alias("unit_cost_ratio"))

    @cached_property
    def customers(self) -> DataFrame:
        return self.t("customer").select("c_custkey", "c_nationkey", "c_mktsegment")

    # ------------------------------------------------------------ facts
    @cached_property
    def fact_room_sales(self) -> DataFrame:
        o = self.t("orders")
        o = o.where(F.col("o_orderdate").isNotNull())
        j = dim_join(o, self.customers, o.o_custkey == F.col("c_custkey"), "inner")
        status = F.col("o_orderstatus")
        sold = (status == "F").cast("int")
        los = F.substring("o_orderpriority", 1, 1).cast("int")
        check_in = F.to_date("o_orderdate")
        return j.select(
            F.col("o_orderkey").alias("booking_id"),
            date_key(check_in).alias("date_id"),
            check_in.alias("check_in"),
            F.date_add(check_in, los).alias("check_out"),
            F.col("c_nationkey").alias("property_id"),
            F.col("c_mktsegment").alias("segment"),
            F.col("o_orderpriority").alias("channel"),
            los.alias("los"),
            sold.alias("rooms_sold"),
            (sold * los).alias("room_nights"),
            money("o_totalprice").alias("room_rate"),
            F.when(sold == 1, money("o_totalprice")).otherwise(F.lit(0).cast("decimal(12,2)"))
            .alias("room_revenue"),
            (status == "O").cast("int").alias("is_cancelled"),
            (status == "P").cast("int").alias("is_no_show"),
        )

    @cached_property
    def fact_fnb_sales(self) -> DataFrame:
        li = self.t("lineitem")
        sup = self.t("supplier").select("s_suppkey", "s_nationkey", "s_name")
        prod = self.dim_product.select("product_id", "category", "unit_cost_ratio")
        li = li.where(F.col("l_shipdate").isNotNull())
        j = dim_join(li, sup, li.l_suppkey == F.col("s_suppkey"), "inner")
        j = dim_join(j, prod, F.col("l_partkey") == F.col("product_id"), "inner")
        gross = money("l_extendedprice")
        disc = F.round(gross * rate("l_discount"), 2).cast("decimal(12,2)")
        cogs = F.round(gross * F.col("unit_cost_ratio"), 2).cast("decimal(12,2)")
        net = (gross - disc).cast("decimal(12,2)")
        sale_date = F.to_date("l_shipdate")
        return j.select(
            F.col("l_orderkey").alias("transaction_id"),
            F.col("l_linenumber").alias("line_no"),
            date_key(sale_date).alias("date_id"),
            sale_date.alias("sale_date"),
            F.col("s_nationkey").alias("property_id"),
            F.col("s_name").alias("outlet_name"),
            F.col("l_partkey").alias("product_id"),
            "category",
            F.col("l_quantity").alias("quantity"),
            gross.alias("gross_sales"),
            disc.alias("discount"),
            net.alias("net_sales"),
            cogs.alias("cogs_amount"),
            (net - cogs).cast("decimal(12,2)").alias("gross_profit"),
            (F.col("l_returnflag") == "A").cast("int").alias("is_void"),
            (F.col("l_returnflag") == "R").cast("int").alias("is_refund"),
        )

    @cached_property
    def fact_expense(self) -> DataFrame:
        o = self.t("orders")
        o = o.where(F.col("o_orderdate").isNotNull())
        j = dim_join(o, self.customers, o.o_custkey == F.col("c_custkey"), "inner")
        j = j.join(F.broadcast(self.dim_account), F.col("o_orderpriority") == F.col("priority"))
        d = F.to_date("o_orderdate")
        return j.select(
            F.col("o_orderkey").alias("expense_id"),
            date_key(d).alias("date_id"),
            d.alias("expense_date"),
            F.col("c_nationkey").alias("property_id"),
            "department_id", "account_id",
            F.round(money("o_totalprice") * F.lit(LEDGER_SHARE).cast("decimal(3,2)"), 2)
            .cast("decimal(12,2)").alias("amount"),
            F.when(F.col("account_type") == "Revenue", "Credit").otherwise("Debit")
            .alias("transaction_type"),
            (F.col("account_type") == "COGS").cast("int").alias("is_cogs"),
        )

    @cached_property
    def quarantine(self) -> DataFrame:
        """(source, rule, key, amount): every source row that a fact leaves
        out, under the first rule it breaks. The facts' joins are inner, so
        rows of a fact and its quarantined rows add up to the source."""
        o, li = self.t("orders"), self.t("lineitem")
        c = self.customers.select("c_custkey", F.lit(True).alias("has_customer"))
        a = F.broadcast(self.dim_account.select(F.col("priority"), F.lit(True).alias("has_account")))
        s = self.t("supplier").select("s_suppkey", F.lit(True).alias("has_supplier"))
        p = self.t("part").select("p_partkey", F.lit(True).alias("has_part"))
        j = (dim_join(o, c, o.o_custkey == F.col("c_custkey"), "left")
             .join(a, F.col("o_orderpriority") == F.col("priority"), "left"))
        k = dim_join(li, s, li.l_suppkey == F.col("s_suppkey"), "left")
        k = dim_join(k, p, F.col("l_partkey") == F.col("p_partkey"), "left")

        def broken(df, source, key, amount, rules):
            rule = F.coalesce(*[F.when(test, F.lit(name)) for name, test in rules])
            return (df.select(F.lit(source).alias("source"), rule.alias("rule"),
                              F.col(key).alias("key"), money(amount).alias("amount"))
                    .where(F.col("rule").isNotNull()))

        no_customer = ("unknown_customer", F.col("has_customer").isNull())
        no_order_date = ("missing_date", F.col("o_orderdate").isNull())
        no_supplier = ("unknown_supplier", F.col("has_supplier").isNull())
        no_ship_date = ("missing_date", F.col("l_shipdate").isNull())
        return (broken(j, "bookings", "o_orderkey", "o_totalprice", [no_customer, no_order_date])
                .unionByName(broken(j, "ledger", "o_orderkey", "o_totalprice", [
                    no_customer, ("unknown_account", F.col("has_account").isNull()), no_order_date]))
                .unionByName(broken(k, "pos", "l_orderkey", "l_extendedprice", [
                    no_supplier, ("unknown_part", F.col("has_part").isNull()), no_ship_date]))
                .unionByName(broken(k, "purchases", "l_orderkey", "l_extendedprice", [no_supplier, no_ship_date])))

    @cached_property
    def fact_budget(self) -> DataFrame:
        """Budget per (month, property, department, account) = the same month
        one year earlier × 1.05."""
        e = self.fact_expense
        m = F.add_months(month_start("expense_date"), 12)
        agg = (e.groupBy(m.alias("budget_date"), "property_id", "department_id", "account_id")
               .agg(F.sum("amount").alias("base")))
        return agg.select(
            date_key("budget_date").alias("date_id"), "budget_date", "property_id",
            "department_id", "account_id",
            F.round(F.col("base") * F.lit(BUDGET_UPLIFT).cast("decimal(3,2)"), 2)
            .cast("decimal(18,2)").alias("budget_amount"),
            F.year("budget_date").alias("budget_year"),
            F.month("budget_date").alias("budget_month"))

    @cached_property
    def fact_purchase(self) -> DataFrame:
        li = self.t("lineitem")
        sup = self.t("supplier").select("s_suppkey", "s_nationkey")
        li = li.where(F.col("l_shipdate").isNotNull())
        j = dim_join(li, sup, li.l_suppkey == F.col("s_suppkey"), "inner")
        d = F.to_date("l_shipdate")
        return j.select(
            F.col("l_orderkey").alias("purchase_id"),
            F.col("l_linenumber").alias("line_no"),
            date_key(d).alias("date_id"), d.alias("purchase_date"),
            F.col("s_nationkey").alias("property_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("supplier_id"),
            F.col("l_quantity").alias("quantity"),
            money("l_extendedprice").alias("total_amount"),
        )

    @cached_property
    def fact_inventory(self) -> DataFrame:
        """Daily stock movements per (user_id as store, event_type as item)."""
        ev = self.t("events")
        d = F.to_date("ts")
        et = F.col("event_type")

        def s(types):
            return F.sum(F.when(et.isin(types), money("value")).otherwise(F.lit(0).cast("decimal(12,2)")))

        return (ev.groupBy(d.alias("stock_date"), F.col("user_id").alias("store_id"),
                           et.alias("item"))
                .agg(money(F.min_by("value", F.struct("ts", "event_id"))).alias("opening_stock"),
                     money(F.max_by("value", F.struct("ts", "event_id"))).alias("closing_stock"),
                     s(["purchase"]).alias("purchase_qty"),
                     s(["signup"]).alias("transfer_qty"),
                     s(["view", "click"]).alias("consumption_qty"),
                     s(["error"]).alias("waste_qty"),
                     F.count("*").alias("movements"))
                .withColumn("date_id", date_key("stock_date")))
