"""DuckDB oracle SQL: an independent, plain-SQL statement of every query.

The driver registers the raw parquet tables as views; each statement here
re-derives the star roles (``STAR_CTES``) with the same fixed rules as
``roles.py`` and then states the query in ANSI SQL.
"""

from __future__ import annotations

from .roles import ACCOUNTS, DEPARTMENTS, FNB_REGION, OTHER_INCOME_CODES


def _values(rows) -> str:
    def lit(v):
        return "NULL" if v is None else ("'" + str(v).replace("'", "''") + "'"
                                         if isinstance(v, str) else str(v))
    return ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


def dkey(e: str) -> str:
    return f"CAST(year({e}) * 10000 + month({e}) * 100 + day({e}) AS INTEGER)"


M = "DECIMAL(18,2)"

# Whole years from the first to the last date that any fact has.
BOUNDS = """(SELECT CAST(min(year(d)) AS INTEGER) AS y0, CAST(max(year(d)) AS INTEGER) AS y1
        FROM (SELECT o_orderdate AS d FROM orders UNION ALL SELECT l_shipdate FROM lineitem))"""

STAR_CTES: dict[str, tuple[list[str], str]] = {
    "dim_property": ([], f"""
dim_property AS (
  SELECT n.n_nationkey AS property_id, n.n_name AS property_name,
         CASE WHEN r.r_name = '{FNB_REGION}' THEN 'F&B' ELSE 'Hotel' END AS business_type,
         n.n_name AS city, r.r_name AS region,
         CAST(CASE WHEN r.r_name = '{FNB_REGION}' THEN NULL ELSE 100 + 4 * n.n_nationkey END AS INTEGER) AS rooms,
         CASE WHEN r.r_name = '{FNB_REGION}' THEN 'F&B' ELSE 'Midscale' END AS property_class
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"""),
    "dim_account": ([], f"""
dim_account(priority, account_id, account_code, account_name, account_type, department_id) AS (
  VALUES {_values(ACCOUNTS)})"""),
    "dim_department": ([], f"""
dim_department(department_id, department_name) AS (VALUES {_values(DEPARTMENTS)})"""),
    "hol": ([], f"""
hol AS (
  SELECT make_date(CAST(y AS INTEGER), m, d) AS hd
  FROM (SELECT unnest(range(y0 - 1, y1 + 2)) AS y FROM {BOUNDS}),
       (VALUES (1, 1), (5, 1), (6, 1), (8, 17), (12, 25)) h(m, d))"""),
    "dim_date": (["hol"], f"""
dim_date AS (
  SELECT {dkey('g')} AS date_key, CAST(g AS DATE) AS full_date,
         CAST(year(g) AS INTEGER) AS year, CAST(quarter(g) AS INTEGER) AS quarter,
         CAST(month(g) AS INTEGER) AS month,
         CASE WHEN isodow(g) >= 6 THEN 1 ELSE 0 END AS is_weekend,
         CASE WHEN EXISTS (SELECT 1 FROM hol WHERE CAST(g AS DATE) BETWEEN hol.hd - 1 AND hol.hd + 1)
              THEN 1 ELSE 0 END AS is_holiday_flag
  FROM (SELECT unnest(generate_series(make_date(y0, 1, 1), make_date(y1, 12, 31), INTERVAL 1 DAY)) AS g FROM {BOUNDS}))"""),
    "fact_room_sales": ([], f"""
fact_room_sales AS (
  SELECT o.o_orderkey AS booking_id, {dkey('o.o_orderdate')} AS date_id,
         CAST(o.o_orderdate AS DATE) AS check_in,
         CAST(o.o_orderdate AS DATE) + CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS check_out,
         c.c_nationkey AS property_id, c.c_mktsegment AS segment, o.o_orderpriority AS channel,
         CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS los,
         CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS rooms_sold,
         CASE WHEN o.o_orderstatus = 'F' THEN CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) ELSE 0 END AS room_nights,
         CAST(o.o_totalprice AS {M}) AS room_rate,
         CASE WHEN o.o_orderstatus = 'F' THEN CAST(o.o_totalprice AS {M}) ELSE CAST(0 AS {M}) END AS room_revenue,
         CASE WHEN o.o_orderstatus = 'O' THEN 1 ELSE 0 END AS is_cancelled,
         CASE WHEN o.o_orderstatus = 'P' THEN 1 ELSE 0 END AS is_no_show
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""),
    "dim_product": ([], f"""
dim_product AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand,
         p_retailprice AS base_price,
         CAST((p_size + 20) * 0.01 AS DECIMAL(6,4)) AS unit_cost_ratio
  FROM part)"""),
    "fact_fnb_sales": (["dim_product"], f"""
fact_fnb_sales AS (
  SELECT l.l_orderkey AS transaction_id, l.l_linenumber AS line_no,
         {dkey('l.l_shipdate')} AS date_id, CAST(l.l_shipdate AS DATE) AS sale_date,
         s.s_nationkey AS property_id, s.s_name AS outlet_name, l.l_partkey AS product_id,
         p.category, l.l_quantity AS quantity,
         CAST(l.l_extendedprice AS {M}) AS gross_sales,
         CAST(round(CAST(l.l_extendedprice AS {M}) * CAST(l.l_discount AS {M}), 2) AS {M}) AS discount,
         CAST(CAST(l.l_extendedprice AS {M})
              - CAST(round(CAST(l.l_extendedprice AS {M}) * CAST(l.l_discount AS {M}), 2) AS {M}) AS {M}) AS net_sales,
         CAST(round(CAST(l.l_extendedprice AS {M}) * p.unit_cost_ratio, 2) AS {M}) AS cogs_amount,
         CASE WHEN l.l_returnflag = 'A' THEN 1 ELSE 0 END AS is_void,
         CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS is_refund
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
       JOIN dim_product p ON l.l_partkey = p.product_id)"""),
    "fact_expense": (["dim_account"], f"""
fact_expense AS (
  SELECT o.o_orderkey AS expense_id, {dkey('o.o_orderdate')} AS date_id,
         CAST(o.o_orderdate AS DATE) AS expense_date, c.c_nationkey AS property_id,
         a.department_id, a.account_id,
         CAST(round(CAST(o.o_totalprice AS {M}) * 0.01, 2) AS {M}) AS amount,
         CASE WHEN a.account_type = 'Revenue' THEN 'Credit' ELSE 'Debit' END AS transaction_type,
         CASE WHEN a.account_type = 'COGS' THEN 1 ELSE 0 END AS is_cogs
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN dim_account a ON o.o_orderpriority = a.priority)"""),
    "fact_budget": (["fact_expense"], f"""
fact_budget AS (
  SELECT {dkey('bd')} AS date_id, bd AS budget_date, property_id, department_id, account_id,
         CAST(round(base * 1.05, 2) AS {M}) AS budget_amount,
         CAST(year(bd) AS INTEGER) AS budget_year, CAST(month(bd) AS INTEGER) AS budget_month
  FROM (SELECT CAST(date_trunc('month', expense_date) + INTERVAL 12 MONTH AS DATE) AS bd,
               property_id, department_id, account_id, SUM(amount) AS base
        FROM fact_expense GROUP BY ALL))"""),
    "fact_inventory": ([], f"""
fact_inventory AS (
  SELECT CAST(ts AS DATE) AS stock_date, user_id AS store_id, event_type AS item,
         CAST(arg_min(value, (ts, event_id)) AS {M}) AS opening_stock,
         CAST(arg_max(value, (ts, event_id)) AS {M}) AS closing_stock,
         SUM(CASE WHEN event_type = 'purchase' THEN CAST(value AS {M}) ELSE 0 END) AS purchase_qty,
         SUM(CASE WHEN event_type = 'signup' THEN CAST(value AS {M}) ELSE 0 END) AS transfer_qty,
         SUM(CASE WHEN event_type IN ('view', 'click') THEN CAST(value AS {M}) ELSE 0 END) AS consumption_qty,
         SUM(CASE WHEN event_type = 'error' THEN CAST(value AS {M}) ELSE 0 END) AS waste_qty,
         COUNT(*) AS movements
  FROM events GROUP BY 1, 2, 3)"""),
}


def with_star(*names: str) -> str:
    """WITH clause holding the named star CTEs and their dependencies."""
    order: list[str] = []

    def add(n):
        for dep in STAR_CTES[n][0]:
            add(dep)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",".join(STAR_CTES[n][1] for n in order)


OTHER_INCOME_SQL = ", ".join(f"'{c}'" for c in OTHER_INCOME_CODES)


def _r6(e: str) -> str:
    return f"round(CAST({e} AS DOUBLE), 6)"


def _div(n: str, d: str) -> str:
    return f"(CAST({n} AS DOUBLE) / NULLIF(CAST({d} AS DOUBLE), 0))"


# What one row of a fact adds to its day and property, by measure (A1-A3).
_SOLD = "is_void + is_refund = 0"
DAILY_AMOUNTS = {
    "fact_room_sales": {
        "bookings": "1", "rooms_sold": "rooms_sold", "occupied_room_nights": "room_nights",
        "cancellations": "is_cancelled", "no_shows": "is_no_show", "room_revenue": "room_revenue"},
    "fact_fnb_sales": {
        "fnb_lines": "1", "void_lines": "is_void", "fnb_gross_sales": "gross_sales",
        "fnb_discount": "discount", "fnb_cogs": "cogs_amount",
        "fnb_net_revenue": f"if({_SOLD}, net_sales, 0)"},
    "(SELECT DISTINCT date_id, property_id, transaction_id FROM fact_fnb_sales)": {"fnb_transactions": "1"},
    "fact_expense JOIN dim_account USING (account_id)": {
        "opex": "if(account_type = 'OPEX', amount, 0)",
        "other_cogs": "if(account_type = 'COGS', amount, 0)",
        "other_income": f"if(account_type = 'Revenue' AND account_code IN ({OTHER_INCOME_SQL}), amount, 0)"},
}
DAILY_MONEY = ("room_revenue", "fnb_gross_sales", "fnb_net_revenue", "fnb_cogs", "fnb_discount",
               "opex", "other_cogs", "other_income")


def _tagged(fact: str, amounts: dict[str, str]) -> str:
    names = ", ".join(f"'{m}'" for m in amounts)
    values = ", ".join(f"CAST({e} AS {M})" for e in amounts.values())
    return (f"SELECT date_id, property_id, unnest([{names}]) AS measure, unnest([{values}]) AS amount "
            f"FROM {fact}")


_DAILY_MEASURES = [m for amounts in DAILY_AMOUNTS.values() for m in amounts]
_DAILY_TOTALS = ", ".join(f"COALESCE(SUM(amount) FILTER (measure = '{m}'), 0) AS {m}_sum" for m in _DAILY_MEASURES)
_DAILY_TYPED = ", ".join(f"CAST({m}_sum AS {'DOUBLE' if m in DAILY_MONEY else 'BIGINT'}) AS {m}" for m in _DAILY_MEASURES)
_EARNED = "room_revenue_sum + fnb_net_revenue_sum + other_income_sum"

# Facts as one list of tagged amounts, added up once over every day of every
# property; ratios follow from the totals.
KPI_DAILY_BODY = f"""
tagged AS ({" UNION ALL ".join(_tagged(f, a) for f, a in DAILY_AMOUNTS.items())}),
day_totals AS (
  SELECT d.*, p.property_id, p.property_name, p.business_type, p.rooms, {_DAILY_TOTALS}
  FROM dim_property p JOIN dim_date d ON true
       LEFT JOIN tagged t ON (t.property_id, t.date_id) = (p.property_id, d.date_key)
  GROUP BY ALL),
kpi AS (
  SELECT * EXCLUDE (rooms, {", ".join(m + "_sum" for m in _DAILY_MEASURES)}), {_DAILY_TYPED},
         {_r6(_div('occupied_room_nights_sum', 'rooms'))} AS occupancy_ratio,
         {_r6(_div('occupied_room_nights_sum', 'rooms') + ' * 100')} AS occupancy_pct,
         {_r6(_div('room_revenue_sum', 'rooms_sold_sum'))} AS adr,
         {_r6(_div('room_revenue_sum', 'rooms'))} AS revpar,
         {_r6(_div('fnb_cogs_sum', 'greatest(fnb_net_revenue_sum, 0)') + ' * 100')} AS food_cost_pct,
         CAST({_EARNED} AS DOUBLE) AS total_revenue,
         CAST({_EARNED} - (opex_sum + other_cogs_sum + fnb_cogs_sum) AS DOUBLE) AS ebitda
  FROM day_totals)"""

KPI_CTES = ("dim_property", "dim_date", "dim_account", "fact_room_sales", "fact_fnb_sales",
            "fact_expense")


def kpi_with(extra: str = "") -> str:
    """WITH clause that ends in the ``kpi`` (mart_kpi_daily) CTE."""
    return with_star(*KPI_CTES) + "," + KPI_DAILY_BODY + ("," + extra if extra else "")


ORACLE: dict[str, str] = {}

ORACLE["kpi_daily_spine"] = kpi_with() + "\nSELECT * FROM kpi"

ORACLE["hotel_monthly"] = with_star("dim_property", "dim_date", "fact_room_sales") + f"""
, months AS (SELECT year, month, COUNT(*) AS days_in_period FROM dim_date GROUP BY ALL),
booked AS (
  SELECT CAST(year(check_in) AS INTEGER) AS year, CAST(month(check_in) AS INTEGER) AS month, property_id,
         COUNT(*) AS bookings, SUM(is_cancelled) AS cancelled, SUM(is_no_show) AS absent,
         SUM(rooms_sold) AS sold, SUM(room_nights) AS nights, SUM(room_revenue) AS revenue
  FROM fact_room_sales GROUP BY ALL),
hm AS (
  SELECT year, month, property_id, property_name, city, days_in_period,
         CAST(COALESCE(revenue, 0) AS DOUBLE) AS room_revenue,
         CAST(COALESCE(nights, 0) AS BIGINT) AS occupied_room_nights,
         CAST(COALESCE(sold, 0) AS BIGINT) AS rooms_sold, COALESCE(bookings, 0) AS bookings,
         CAST(COALESCE(cancelled, 0) AS BIGINT) AS cancellations, CAST(COALESCE(absent, 0) AS BIGINT) AS no_shows,
         CAST(rooms * days_in_period AS BIGINT) AS available_room_nights
  FROM dim_property JOIN months ON business_type = 'Hotel' LEFT JOIN booked USING (year, month, property_id))
SELECT *, {_r6(_div('room_revenue', 'rooms_sold'))} AS adr,
       {_r6(_div('room_revenue', 'occupied_room_nights'))} AS adr_per_night,
       {_r6(_div('occupied_room_nights', 'available_room_nights'))} AS occupancy_ratio,
       {_r6(_div('room_revenue', 'available_room_nights'))} AS revpar,
       {_r6(_div('cancellations', 'bookings') + ' * 100')} AS cancellation_pct,
       {_r6(_div('no_shows', 'bookings') + ' * 100')} AS noshow_pct
FROM hm"""

# One row per check first: its lines, amounts and flags.
ORACLE["fnb_monthly"] = with_star("dim_property", "fact_fnb_sales") + f"""
, checks AS (
  SELECT year(sale_date) AS y, month(sale_date) AS m, property_id, outlet_name, category, transaction_id,
         COUNT(*) AS n, SUM(is_void) AS voids, SUM(is_refund) AS refunds, SUM(gross_sales) AS gross,
         SUM(net_sales) AS net, SUM(net_sales) FILTER ({_SOLD}) AS sold, SUM(cogs_amount) AS cost, SUM(discount) AS off
  FROM fact_fnb_sales GROUP BY ALL),
g AS (
  SELECT y, m, property_id, outlet_name, category, COUNT(transaction_id) AS transactions,
         CAST(SUM(n) AS BIGINT) AS lines, CAST(SUM(voids) AS BIGINT) AS void_lines,
         CAST(SUM(refunds) AS BIGINT) AS refund_lines, SUM(gross) AS gross, SUM(net) AS net,
         COALESCE(SUM(sold), 0) AS sold, SUM(cost) AS cost, SUM(off) AS off
  FROM checks GROUP BY ALL)
SELECT CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month, property_id, property_name, outlet_name, category,
       transactions, lines, void_lines, refund_lines,
       CAST(gross AS DOUBLE) AS gross_sales, CAST(sold AS DOUBLE) AS net_revenue,
       CAST(cost AS DOUBLE) AS cogs, CAST(off AS DOUBLE) AS discount,
       CAST(sold - cost AS DOUBLE) AS gross_profit,
       {_r6(_div('sold', 'transactions'))} AS average_check,
       {_r6(_div('cost', 'net') + ' * 100')} AS food_cost_pct
FROM g JOIN dim_property USING (property_id)"""

ORACLE["finance_monthly"] = with_star("dim_property", "dim_department", "fact_expense") + """
SELECT CAST(year(e.expense_date) AS INTEGER) AS year, CAST(month(e.expense_date) AS INTEGER) AS month,
       e.property_id, p.property_name, a.account_type, a.account_name, d.department_name,
       CAST(SUM(e.amount) AS DOUBLE) AS amount
FROM fact_expense e JOIN dim_property p ON p.property_id = e.property_id
     JOIN dim_account a ON a.account_id = e.account_id
     JOIN dim_department d ON d.department_id = e.department_id
GROUP BY 1, 2, 3, 4, 5, 6, 7"""

# Plan and ledger as one list of months; months without a plan are left out.
ORACLE["budget_vs_actual"] = with_star("dim_property", "dim_department", "fact_budget") + f"""
, both_sides AS (
  SELECT date_trunc('month', budget_date) AS m, property_id, account_id, budget_amount AS planned,
         CAST(0 AS {M}) AS spent, 1 AS plans
  FROM fact_budget
  UNION ALL
  SELECT date_trunc('month', expense_date), property_id, account_id, 0, amount, 0 FROM fact_expense),
g AS (
  SELECT CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month, property_id, account_id,
         SUM(planned) AS planned, SUM(spent) AS spent
  FROM both_sides GROUP BY ALL HAVING SUM(plans) > 0)
SELECT year, month, property_id, property_name, department_name, account_name, account_type,
       CAST(planned AS DOUBLE) AS budget_amount, CAST(spent AS DOUBLE) AS actual_amount,
       {", ".join(f"CAST(if(account_type = '{t}', spent, 0) AS DOUBLE) AS actual_{c}"
                  for t, c in (("Revenue", "revenue"), ("OPEX", "opex"), ("COGS", "cogs")))},
       CAST(spent - planned AS DOUBLE) AS variance,
       {_r6(_div('spent - planned', 'planned') + ' * 100')} AS variance_pct
FROM g JOIN dim_property USING (property_id) JOIN dim_account USING (account_id)
     JOIN dim_department USING (department_id)"""


# ---------------------------------------------------------------- parsing helpers (SQL side)
def sql_trim_ws(e: str) -> str:
    return f"regexp_replace({e}, '^\\s+|\\s+$', '', 'g')"


def sql_parse_date(e: str) -> str:
    s = sql_trim_ws(e)
    shapes = [(r"\d{4}-\d{2}-\d{2}", "%Y-%m-%d"), (r"\d{2}/\d{2}/\d{4}", "%d/%m/%Y"),
              (r"\d{2}-\d{2}-\d{4}", "%m-%d-%Y"), (r"\d{2}-[A-Za-z]{3}-\d{4}", "%d-%b-%Y"),
              (r"\d{8}", "%Y%m%d")]
    parts = [f"CASE WHEN regexp_full_match({s}, '{rx}') THEN CAST(try_strptime({s}, '{fmt}') AS DATE) END"
             for rx, fmt in shapes]
    return "COALESCE(" + ", ".join(parts) + ")"


def sql_parse_number(e: str) -> str:
    s = sql_trim_ws(e)
    body = sql_trim_ws(f"regexp_replace({s}, '^[-+]+', '')")
    norm = (f"CASE WHEN contains(b, ',') AND contains(b, '.') AND regexp_matches(b, ',[^.]*$') "
            f"THEN replace(replace(b, '.', ''), ',', '.') "
            f"WHEN contains(b, ',') AND contains(b, '.') THEN replace(b, ',', '') "
            f"WHEN contains(b, ',') AND regexp_full_match(b, '\\d{{1,3}}(,\\d{{3}})+') THEN replace(b, ',', '') "
            f"WHEN contains(b, ',') THEN replace(b, ',', '.') "
            f"WHEN contains(b, '.') AND regexp_full_match(b, '\\d{{1,3}}(\\.\\d{{3}})+') THEN replace(b, '.', '') "
            f"ELSE b END")
    return (f"(SELECT CASE WHEN neg THEN -v ELSE v END FROM (SELECT neg, "
            f"CASE WHEN regexp_full_match(b, '[0-9.,]*') AND regexp_full_match(n, '([0-9]+\\.?[0-9]*|\\.[0-9]+)') "
            f"THEN CAST(n AS DOUBLE) END AS v FROM (SELECT neg, b, {norm} AS n FROM "
            f"(SELECT starts_with({s}, '-') AS neg, {body} AS b))))")


def sql_norm_key(e: str) -> str:
    return (f"COALESCE(trim(regexp_replace(regexp_replace(upper({e}), '[^A-Z0-9 ]+', ' ', 'g'), "
            f"' +', ' ', 'g')), '')")


RAW_DATE_SQL = """CASE l_linenumber % 6
  WHEN 0 THEN strftime(l_shipdate, '%Y-%m-%d') WHEN 1 THEN strftime(l_shipdate, '%d/%m/%Y')
  WHEN 2 THEN strftime(l_shipdate, '%m-%d-%Y') WHEN 3 THEN upper(strftime(l_shipdate, '%d-%b-%Y'))
  WHEN 4 THEN strftime(l_shipdate, '%Y%m%d') ELSE strftime(l_shipdate, '%Y/%m/%d') END"""

ORACLE["parse_mixed_dates"] = f"""
SELECT l_orderkey, l_linenumber, raw_date, {sql_parse_date('raw_date')} AS parsed_date
FROM (SELECT l_orderkey, l_linenumber, {RAW_DATE_SQL} AS raw_date FROM lineitem)"""

RAW_NUMBER_SQL = """CASE l_linenumber % 5
  WHEN 0 THEN format('{:,.2f}', l_extendedprice)
  WHEN 1 THEN translate(format('{:,.2f}', l_extendedprice), ',.', '.,')
  WHEN 2 THEN replace(format('{:,.2f}', l_extendedprice), ',', '')
  WHEN 3 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '.000'
  ELSE '- ' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END"""

ORACLE["parse_mixed_numbers"] = f"""
SELECT l_orderkey, l_linenumber, raw_number, {sql_parse_number('raw_number')} AS parsed_number
FROM (SELECT l_orderkey, l_linenumber, {RAW_NUMBER_SQL} AS raw_number FROM lineitem)"""

RAW_NAME_SQL = """CASE p_partkey % 4 WHEN 0 THEN upper(p_name) WHEN 1 THEN '  ' || p_name || ' '
  WHEN 2 THEN replace(p_name, ' ', '-') ELSE p_name || ' & Co.' END"""

ORACLE["norm_keys"] = f"""
SELECT p_partkey, raw_name, {sql_norm_key('raw_name')} AS name_key
FROM (SELECT p_partkey, {RAW_NAME_SQL} AS raw_name FROM part)"""

ORACLE["period_parse"] = """
SELECT o_orderkey, period,
  CASE WHEN regexp_full_match(period, '\\d{4}-\\d{1,2}') THEN CAST(try_strptime(period || '-01', '%Y-%m-%d') AS DATE)
       WHEN regexp_full_match(period, '[A-Za-z]{3}-\\d{4}') THEN CAST(try_strptime('01-' || period, '%d-%b-%Y') AS DATE)
  END AS period_month
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m')
                              ELSE strftime(o_orderdate, '%b-%Y') END AS period FROM orders)"""

ORACLE["yn_flags"] = """
SELECT raw_flag, CASE WHEN upper(trim(raw_flag)) = 'Y' THEN 1 ELSE 0 END AS flag, COUNT(*) AS n
FROM (SELECT CASE WHEN l_returnflag = 'R' THEN 'y' WHEN l_returnflag = 'A' THEN ' Y '
                  WHEN l_linestatus = 'O' THEN 'n' ELSE 'N' END AS raw_flag FROM lineitem)
GROUP BY 1, 2"""

ORACLE["dedup_first"] = """
SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice
FROM (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS rn FROM part)
WHERE rn = 1"""

ORACLE["dedup_exact"] = """
SELECT l_orderkey, l_partkey, l_returnflag, MIN(l_linenumber) AS _raw_row
FROM lineitem GROUP BY 1, 2, 3"""

LINE_ORDER_SQL = ("l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, "
                  "l_discount, l_tax, l_returnflag, l_linestatus")

ORACLE["line_numbers"] = f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_date,
       CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER_SQL}) AS INTEGER) AS line_no
FROM lineitem"""

ORACLE["composite_keys"] = f"""
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER_SQL}) - 1 AS VARCHAR) AS purchase_line_id,
       l_partkey, l_suppkey, CAST(CAST(l_extendedprice AS {M}) AS DOUBLE) AS total_amount
FROM lineitem"""

ORACLE["fix_interval"] = """
SELECT l_orderkey, l_linenumber,
       CASE WHEN e < s THEN e ELSE s END AS stay_start, CASE WHEN e < s THEN s ELSE e END AS stay_end,
       CASE WHEN e < s THEN 1 ELSE 0 END AS swapped
FROM (SELECT l.l_orderkey, l.l_linenumber, CAST(o.o_orderdate AS DATE) AS s, CAST(l.l_shipdate AS DATE) AS e
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

ORACLE["fix_negative"] = """
SELECT c_custkey, c_acctbal, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS acctbal_floor,
       abs(c_acctbal) AS acctbal_abs
FROM customer"""

ORACLE["window_guard"] = """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders
WHERE o_orderdate IS NULL OR CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'"""

ORACLE["los_flags"] = f"""
SELECT o_orderstatus, COUNT(*) AS bookings, CAST(SUM(los) AS BIGINT) AS los_total,
       CAST(SUM(sold) AS BIGINT) AS rooms_sold, CAST(SUM(sold * los) AS BIGINT) AS room_nights,
       CAST(SUM(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS cancellations,
       CAST(SUM(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS no_shows,
       CAST(SUM(CAST(l_extendedprice AS {M}) * sold) AS DOUBLE) AS room_revenue
FROM (SELECT o.o_orderstatus, l.l_extendedprice,
             CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS sold,
             greatest(abs(datediff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE))), 1) AS los
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
GROUP BY 1"""

ORACLE["unit_price_cogs"] = f"""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey,
       CASE WHEN l.l_linenumber = 1 THEN 0.0 ELSE l.l_quantity END AS quantity,
       round(CASE WHEN (CASE WHEN l.l_linenumber = 1 THEN 0.0 ELSE l.l_quantity END) > 0
                  THEN l.l_extendedprice / l.l_quantity ELSE 0.0 END, 6) AS unit_price,
       CAST(round(CAST(l.l_extendedprice AS {M}) * CAST((p.p_size + 20) * 0.01 AS DECIMAL(6,4)), 2) AS DOUBLE) AS cogs_amount
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey"""

ORACLE["drop_blank_rows"] = """
SELECT * FROM (
  SELECT p_partkey AS _raw_row,
         CASE WHEN p_size <= 2 THEN '  ' ELSE p_name END AS p_name,
         CASE WHEN p_size <= 2 THEN NULL ELSE p_brand END AS p_brand,
         CASE WHEN p_size <= 3 THEN chr(9) ELSE p_type END AS p_type
  FROM part)
WHERE NOT ((p_name IS NULL OR trim(p_name, ' ' || chr(9) || chr(10) || chr(13)) = '')
       AND (p_brand IS NULL OR trim(p_brand, ' ' || chr(9) || chr(10) || chr(13)) = '')
       AND (p_type IS NULL OR trim(p_type, ' ' || chr(9) || chr(10) || chr(13)) = ''))"""

ORACLE["trim_all"] = f"""
SELECT p_partkey, {sql_trim_ws("' ' || chr(9) || p_name || '  '")} AS p_name,
       {sql_trim_ws("p_brand || chr(10)")} AS p_brand, {sql_trim_ws("'  ' || p_type")} AS p_type
FROM part"""

ORACLE["whitelist_default"] = f"""
SELECT p_partkey, raw_type,
       CASE {sql_norm_key('raw_type')} WHEN 'STANDARD' THEN 'Standard' WHEN 'MEDIUM' THEN 'Medium'
            WHEN 'ECONOMY' THEN 'Economy' WHEN 'LARGE' THEN 'Large' ELSE 'Other' END AS category
FROM (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN lower(p_type) WHEN 1 THEN ' ' || p_type || ' '
                             ELSE p_type END AS raw_type FROM part)"""


# ---------------------------------------------------------------- lookups
SUP_RAW_SQL = """
sup_raw AS (
  SELECT s.s_suppkey, CASE s.s_suppkey % 4 WHEN 0 THEN n.n_name WHEN 1 THEN 'HQ ' || n.n_name
                           WHEN 2 THEN lower(n.n_name) ELSE replace(n.n_name, '_', '-') END AS raw_property
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey),
amap AS (
  SELECT n_name AS alias, n_nationkey AS pid FROM nation
  UNION ALL SELECT 'HQ ' || n_name, n_nationkey FROM nation)"""

ORACLE["alias_lookup"] = f"""WITH {SUP_RAW_SQL}
SELECT r.s_suppkey, r.raw_property, m.pid AS property_id
FROM sup_raw r LEFT JOIN amap m ON r.raw_property = m.alias"""

ORACLE["normalized_lookup"] = f"""WITH {SUP_RAW_SQL}
SELECT r.s_suppkey, r.raw_property, m.pid AS property_id
FROM sup_raw r LEFT JOIN (SELECT DISTINCT {sql_norm_key('alias')} AS k, pid FROM amap) m
  ON {sql_norm_key('r.raw_property')} = m.k"""

ORACLE["two_stage_lookup"] = f"""
WITH raw AS (
  SELECT s.s_suppkey,
         CASE s.s_suppkey % 3 WHEN 0 THEN CAST(n.n_nationkey AS VARCHAR)
                              WHEN 1 THEN 'X' || CAST(n.n_nationkey AS VARCHAR) END AS raw_code,
         CASE s.s_suppkey % 2 WHEN 0 THEN lower(n.n_name) ELSE 'unknown' END AS raw_name
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey)
SELECT r.s_suppkey, r.raw_code, r.raw_name, COALESCE(a.n_nationkey, b.n_nationkey) AS property_id
FROM raw r
LEFT JOIN nation a ON {sql_norm_key('r.raw_code')} = {sql_norm_key('CAST(a.n_nationkey AS VARCHAR)')}
LEFT JOIN nation b ON {sql_norm_key('r.raw_name')} = {sql_norm_key('b.n_name')}"""

ORACLE["default_bucket"] = f"""WITH {SUP_RAW_SQL}
SELECT r.s_suppkey, r.raw_property, COALESCE(m.pid, -1) AS property_id
FROM sup_raw r LEFT JOIN amap m ON r.raw_property = m.alias"""

ORACLE["quarantine_counts"] = f"""WITH {SUP_RAW_SQL}
SELECT CASE WHEN m.pid IS NULL THEN 'unmapped_property' ELSE 'ok' END AS status, COUNT(*) AS n
FROM sup_raw r LEFT JOIN amap m ON r.raw_property = m.alias GROUP BY 1"""

ORACLE["contains_match"] = f"""
WITH s AS (SELECT DISTINCT {RAW_NAME_SQL} AS raw_name FROM part),
d AS (SELECT DISTINCT p_type, {sql_norm_key('p_type')} AS ck FROM part)
SELECT raw_name, MIN(p_type) AS matched_type
FROM s JOIN d ON d.ck <> '' AND (instr({sql_norm_key('raw_name')}, d.ck) > 0
     OR instr(replace({sql_norm_key('raw_name')}, ' ', ''), replace(d.ck, ' ', '')) > 0)
GROUP BY raw_name"""

ORACLE["token_overlap_match"] = f"""
WITH s AS (SELECT DISTINCT CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) || ' ' || lower(p_type)
                               ELSE split_part(p_name, ' ', 2) || ' ' || p_type END AS raw_text FROM part),
st AS (SELECT DISTINCT raw_text, unnest(string_split({sql_norm_key('raw_text')}, ' ')) AS tok FROM s),
d AS (SELECT DISTINCT p_name FROM part),
dt AS (SELECT DISTINCT p_name, unnest(string_split({sql_norm_key('p_name')}, ' ')) AS tok FROM d),
sh AS (SELECT st.raw_text, dt.p_name, COUNT(*) AS n FROM st JOIN dt ON st.tok = dt.tok
       WHERE st.tok <> '' GROUP BY 1, 2 HAVING COUNT(*) >= 1)
SELECT raw_text, p_name AS matched_name, n AS shared_tokens
FROM (SELECT *, row_number() OVER (PARTITION BY raw_text ORDER BY n DESC, p_name) AS rn FROM sh)
WHERE rn = 1"""

COVERAGE_RAW_SQL = """CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN upper(p_name) || ' special'
  WHEN 2 THEN replace(p_name, ' ', '-') WHEN 3 THEN split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1)
  ELSE split_part(p_name, ' ', 2) || ' deluxe' END"""

ORACLE["alias_coverage"] = f"""
WITH obs AS (SELECT DISTINCT {COVERAGE_RAW_SQL} AS raw FROM part),
d AS (SELECT DISTINCT p_name FROM part),
ex AS (SELECT {sql_norm_key('p_name')} AS k, MIN(p_name) AS id FROM d GROUP BY 1),
hit AS (SELECT o.raw, ex.id FROM obs o LEFT JOIN ex ON {sql_norm_key('o.raw')} = ex.k),
st AS (SELECT DISTINCT raw, unnest(string_split({sql_norm_key('raw')}, ' ')) AS tok FROM hit WHERE id IS NULL),
dt AS (SELECT DISTINCT p_name, unnest(string_split({sql_norm_key('p_name')}, ' ')) AS tok FROM d),
sh AS (SELECT st.raw, dt.p_name, COUNT(*) AS n FROM st JOIN dt ON st.tok = dt.tok
       WHERE st.tok <> '' GROUP BY 1, 2 HAVING COUNT(*) >= 2),
fb AS (SELECT raw, p_name AS fb_id FROM (
         SELECT *, row_number() OVER (PARTITION BY raw ORDER BY n DESC, p_name) AS rn FROM sh) WHERE rn = 1)
SELECT h.raw, COALESCE(h.id, fb.fb_id) AS id,
       CASE WHEN h.id IS NOT NULL THEN 'exact' WHEN fb.fb_id IS NOT NULL THEN 'tokens' ELSE 'unmapped' END AS method
FROM hit h LEFT JOIN fb ON h.raw = fb.raw"""

ORACLE["ri_orphans"] = with_star("dim_property", "fact_room_sales") + """
SELECT booking_id, property_id FROM fact_room_sales r
WHERE NOT EXISTS (SELECT 1 FROM dim_property p WHERE p.business_type = 'Hotel'
                  AND p.property_id = r.property_id)"""

ORACLE["semi_members"] = """
SELECT o_orderkey, o_custkey FROM orders o
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"""

ORACLE["outer_merge_trend"] = with_star("fact_room_sales") + f"""
, room AS (SELECT strftime(check_in, '%Y-%m') AS month, CAST(SUM(room_revenue) AS DOUBLE) AS room_revenue
           FROM fact_room_sales GROUP BY 1),
fnb AS (SELECT strftime(l_shipdate, '%Y-%m') AS month,
               CAST(SUM(CAST(l_extendedprice AS {M})) AS DOUBLE) AS fnb_revenue FROM lineitem GROUP BY 1)
SELECT month, COALESCE(room_revenue, 0) AS room_revenue, COALESCE(fnb_revenue, 0) AS fnb_revenue
FROM room FULL OUTER JOIN fnb USING (month)"""

ORACLE["union_distinct"] = f"""WITH {SUP_RAW_SQL}
SELECT raw_property FROM sup_raw
UNION
SELECT CASE c.c_custkey % 3 WHEN 0 THEN n.n_name WHEN 1 THEN upper('mg ' || n.n_name)
            ELSE ' ' || n.n_name END FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey"""

ORACLE["set_difference"] = f"""
SELECT DISTINCT {sql_norm_key('p_type')} AS category_key FROM part
WHERE {sql_norm_key('p_type')} NOT IN ('STANDARD', 'MEDIUM', 'ECONOMY', 'LARGE', 'OTHER')"""

CAL_SQL = """
b AS (SELECT (SELECT MIN(CAST(o_orderdate AS DATE)) FROM orders) AS lo,
             (SELECT MAX(CAST(l_shipdate AS DATE)) FROM lineitem) AS hi),
hy AS (SELECT make_date(CAST(y AS INTEGER), m, d) AS hd, name || ' ' || CAST(y AS VARCHAR) AS hname
       FROM b, range(year(b.lo) - 1, year(b.hi) + 2) t(y),
            (VALUES (1, 1, 'New Year'), (5, 1, 'Labour Day'), (6, 1, 'Pancasila Day'),
                    (8, 17, 'Independence Day'), (12, 25, 'Christmas')) h(m, d, name)),
days AS (SELECT CAST(g AS DATE) AS full_date FROM b, generate_series(b.lo, b.hi, INTERVAL 1 DAY) t(g))"""

ORACLE["calendar_dim"] = f"""WITH {CAL_SQL}
SELECT {dkey('full_date')} AS date_key, full_date, CAST(year(full_date) AS INTEGER) AS year,
       CAST(quarter(full_date) AS INTEGER) AS quarter, CAST(month(full_date) AS INTEGER) AS month,
       strftime(full_date, '%B') AS month_name, CAST(isodow(full_date) - 1 AS INTEGER) AS day_of_week,
       strftime(full_date, '%A') AS day_name,
       CASE WHEN isodow(full_date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
       CASE WHEN EXISTS (SELECT 1 FROM hy WHERE full_date BETWEEN hy.hd - 1 AND hy.hd + 1) THEN 1 ELSE 0 END AS is_holiday_flag,
       COALESCE((SELECT string_agg(DISTINCT hname, ' / ' ORDER BY hname) FROM hy WHERE hy.hd = full_date), '') AS holiday_name,
       CAST(dayofyear(full_date) AS INTEGER) AS day_of_year,
       CAST(strftime(full_date, '%W') AS INTEGER) AS week_of_year,
       CAST(week(full_date) AS INTEGER) AS iso_week
FROM days"""

ORACLE["holiday_windows"] = """
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders),
yrs AS (SELECT DISTINCT year(order_date) + k AS y FROM o, (VALUES (-1), (0), (1)) t(k)),
hd AS (SELECT make_date(CAST(y AS INTEGER), m, d) AS hd FROM yrs,
       (VALUES (1, 1), (5, 1), (6, 1), (8, 17), (12, 25)) h(m, d)),
o2 AS (SELECT o.*, CASE WHEN EXISTS (SELECT 1 FROM hd WHERE o.order_date BETWEEN hd.hd - 1 AND hd.hd + 1)
                        THEN 1 ELSE 0 END AS in_window FROM o)
SELECT o_orderkey, order_date, in_window,
       round(CASE isodow(order_date) WHEN 1 THEN 0.92 WHEN 2 THEN 0.95 WHEN 3 THEN 0.97 WHEN 4 THEN 1.02
                  WHEN 5 THEN 1.18 WHEN 6 THEN 1.22 ELSE 0.88 END::DOUBLE
           * CASE month(order_date) WHEN 1 THEN 1.05 WHEN 2 THEN 0.88 WHEN 3 THEN 0.90 WHEN 4 THEN 0.95
                  WHEN 5 THEN 0.98 WHEN 6 THEN 1.08 WHEN 7 THEN 1.12 WHEN 8 THEN 1.10 WHEN 9 THEN 0.96
                  WHEN 10 THEN 0.97 WHEN 11 THEN 1.03 ELSE 1.15 END::DOUBLE
           * CASE WHEN in_window = 1 THEN 1.25 ELSE 1.0 END, 6) AS demand_index
FROM o2"""


# ---------------------------------------------------------------- distributions
def sql_describe(v: str, src: str, by: str | None = None) -> str:
    qs = [("p01", 0.01), ("p05", 0.05), ("q1", 0.25), ("median", 0.5), ("q3", 0.75),
          ("p95", 0.95), ("p99", 0.99)]
    cols = ", ".join(f"round(quantile_cont(x, {p}), 6) AS {n}" for n, p in qs)
    b = f"{by}, " if by else ""
    return (f"SELECT {b}COUNT(x) AS count, round(AVG(x), 6) AS mean, round(stddev_samp(x), 6) AS std, "
            f"round(MIN(x), 6) AS min, {cols}, round(MAX(x), 6) AS max, "
            f"round(CASE WHEN COUNT(x) >= 3 THEN skewness(x) END, 6) AS skew "
            f"FROM (SELECT {b}CAST({v} AS DOUBLE) AS x FROM {src}) WHERE x IS NOT NULL"
            + (f" GROUP BY {by}" if by else ""))


ORACLE["describe_series"] = sql_describe("value", "events", "event_type")

ORACLE["check_size"] = sql_describe(
    "check_total", f"(SELECT l_orderkey, CAST(SUM(CAST(l_extendedprice AS {M})) AS DOUBLE) AS check_total "
                   "FROM lineitem GROUP BY 1)")

ORACLE["ratio_distribution"] = with_star("fact_fnb_sales") + " " + sql_describe(
    "food_cost_pct", "(SELECT category, CASE WHEN net_sales > 0 THEN CAST(cogs_amount AS DOUBLE) / "
                     "CAST(net_sales AS DOUBLE) * 100 END AS food_cost_pct FROM fact_fnb_sales)", "category")

ORACLE["histogram"] = """
WITH d AS (SELECT CAST(l_extendedprice AS DOUBLE) AS x FROM lineitem WHERE l_extendedprice IS NOT NULL),
s AS (SELECT MIN(x) AS lo, quantile_cont(x, 0.99) AS hi FROM d),
c AS (SELECT CAST(CASE WHEN s.hi - s.lo > 0 THEN least(floor((least(d.x, s.hi) - s.lo) / (s.hi - s.lo) * 40), 39)
                       ELSE 0 END AS INTEGER) AS bin, COUNT(*) AS n FROM d, s GROUP BY 1),
b AS (SELECT CAST(range AS INTEGER) AS bin FROM range(0, 40))
SELECT b.bin, round(s.lo + b.bin * ((s.hi - s.lo) / 40), 6) AS bin_lo,
       round(s.lo + (b.bin + 1) * ((s.hi - s.lo) / 40), 6) AS bin_hi, COALESCE(c.n, 0) AS n
FROM b CROSS JOIN s LEFT JOIN c ON c.bin = b.bin"""

ORACLE["segment_topk"] = with_star("dim_property", "fact_room_sales", "fact_fnb_sales") + """
, u AS (
  SELECT 'property' AS dimension, p.property_name AS member, CAST(SUM(r.room_revenue) AS DOUBLE) AS revenue
  FROM fact_room_sales r JOIN dim_property p ON p.property_id = r.property_id GROUP BY 2
  UNION ALL SELECT 'channel', channel, CAST(SUM(room_revenue) AS DOUBLE) FROM fact_room_sales GROUP BY 2
  UNION ALL SELECT 'segment', segment, CAST(SUM(room_revenue) AS DOUBLE) FROM fact_room_sales GROUP BY 2
  UNION ALL SELECT 'category', category, CAST(SUM(net_sales) AS DOUBLE) FROM fact_fnb_sales
            WHERE is_void = 0 AND is_refund = 0 GROUP BY 2)
SELECT dimension, member, revenue, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY dimension ORDER BY revenue DESC, member) AS INTEGER) AS rank FROM u)
WHERE rank <= 8"""

ORACLE["kpi_long"] = with_star("fact_room_sales", "fact_fnb_sales") + """
, r AS (SELECT SUM(room_revenue) AS room_revenue, SUM(rooms_sold) AS rooms_sold,
               datediff('day', MIN(check_in), MAX(check_in)) + 1 AS date_span_days,
               COUNT(DISTINCT property_id) AS n_properties FROM fact_room_sales),
f AS (SELECT SUM(CASE WHEN is_void = 0 AND is_refund = 0 THEN net_sales ELSE 0 END) AS fnb_net_revenue,
             SUM(cogs_amount) AS fnb_cogs FROM fact_fnb_sales),
k AS (SELECT r.*, f.*, f.fnb_net_revenue - f.fnb_cogs AS gross_profit,
             CAST(f.fnb_cogs AS DOUBLE) / NULLIF(CAST(f.fnb_net_revenue AS DOUBLE), 0) * 100 AS food_cost_pct,
             CAST(r.room_revenue AS DOUBLE) / NULLIF(CAST(r.rooms_sold AS DOUBLE), 0) AS adr FROM r, f)
SELECT metric, round(value, 6) AS value FROM (
  SELECT 'room_revenue' AS metric, CAST(room_revenue AS DOUBLE) AS value FROM k
  UNION ALL SELECT 'rooms_sold', CAST(rooms_sold AS DOUBLE) FROM k
  UNION ALL SELECT 'fnb_net_revenue', CAST(fnb_net_revenue AS DOUBLE) FROM k
  UNION ALL SELECT 'fnb_cogs', CAST(fnb_cogs AS DOUBLE) FROM k
  UNION ALL SELECT 'gross_profit', CAST(gross_profit AS DOUBLE) FROM k
  UNION ALL SELECT 'food_cost_pct', food_cost_pct FROM k
  UNION ALL SELECT 'adr', adr FROM k
  UNION ALL SELECT 'date_span_days', CAST(date_span_days AS DOUBLE) FROM k
  UNION ALL SELECT 'n_properties', CAST(n_properties AS DOUBLE) FROM k)"""

ORACLE["row_counts"] = with_star("dim_property", "dim_product", "fact_room_sales", "fact_fnb_sales",
                                 "fact_expense", "fact_budget", "fact_inventory") + """
SELECT 'dim_property' AS table_name, COUNT(*) AS n_rows FROM dim_property
UNION ALL SELECT 'dim_product', COUNT(*) FROM dim_product
UNION ALL SELECT 'fact_room_sales', COUNT(*) FROM fact_room_sales
UNION ALL SELECT 'fact_fnb_sales', COUNT(*) FROM fact_fnb_sales
UNION ALL SELECT 'fact_expense', COUNT(*) FROM fact_expense
UNION ALL SELECT 'fact_budget', COUNT(*) FROM fact_budget
UNION ALL SELECT 'fact_purchase', COUNT(*) FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
UNION ALL SELECT 'fact_inventory', COUNT(*) FROM fact_inventory"""

ROOM_SERIES = """
rs AS (SELECT property_id, check_in AS ds, CAST(SUM(room_revenue) AS DOUBLE) AS revenue
       FROM fact_room_sales GROUP BY 1, 2)"""

ORACLE["rolling7"] = with_star("fact_room_sales") + "," + ROOM_SERIES + """
SELECT property_id, ds, revenue, round(rm, 4) AS rolling_mean, round(revenue - rm, 4) AS diff_from_rolling
FROM (SELECT *, CASE WHEN COUNT(revenue) OVER w = 7 THEN AVG(revenue) OVER w END AS rm FROM rs
      WINDOW w AS (PARTITION BY property_id ORDER BY ds ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))"""

ORACLE["rolling_median28"] = with_star("fact_room_sales") + "," + ROOM_SERIES + """
SELECT property_id, ds, revenue, round(md, 4) AS rolling_median, round(revenue - md, 4) AS deviation
FROM (SELECT *, quantile_cont(revenue, 0.5) OVER (PARTITION BY property_id ORDER BY ds
                 ROWS BETWEEN 27 PRECEDING AND CURRENT ROW) AS md FROM rs)"""

ORACLE["zscore_anomalies"] = with_star("fact_room_sales") + """
, g AS (SELECT check_in AS ds, CAST(SUM(room_revenue) AS DOUBLE) AS revenue FROM fact_room_sales GROUP BY 1),
z AS (SELECT ds, revenue, (revenue - AVG(revenue) OVER ()) / NULLIF(stddev_samp(revenue) OVER (), 0) AS z FROM g)
SELECT ds, revenue, round(z, 6) AS z FROM z WHERE abs(z) > 2 ORDER BY abs(z) DESC, ds LIMIT 10"""

ORACLE["outliers_hi_lo"] = kpi_with() + """
, g AS (SELECT full_date, CAST(SUM(CAST(total_revenue AS DECIMAL(18,2))) AS DOUBLE) AS daily_revenue,
               CAST((2 * CAST(SUM(CAST(occupancy_pct AS DECIMAL(18,6))) * 1000000 AS HUGEINT) + 1 * COUNT(occupancy_pct)) // NULLIF(2 * COUNT(occupancy_pct), 0) AS DOUBLE) / 1000000 AS occupancy,
               CAST(SUM(CAST(fnb_cogs AS DECIMAL(18,2))) AS DOUBLE)
                 / NULLIF(CAST(SUM(CAST(fnb_net_revenue AS DECIMAL(18,2))) AS DOUBLE), 0) * 100 AS food_cost,
               CAST(SUM(fnb_transactions) AS DOUBLE) AS fnb_transactions FROM kpi GROUP BY 1),
l AS (SELECT full_date, 'daily_revenue' AS series, daily_revenue AS v FROM g
      UNION ALL SELECT full_date, 'occupancy', occupancy FROM g
      UNION ALL SELECT full_date, 'food_cost', food_cost FROM g
      UNION ALL SELECT full_date, 'fnb_transactions', fnb_transactions FROM g),
z AS (SELECT *, (v - AVG(v) OVER (PARTITION BY series)) / NULLIF(stddev_samp(v) OVER (PARTITION BY series), 0) AS z
      FROM l WHERE v IS NOT NULL)
SELECT series, full_date, round(v, 6) AS v, round(z, 6) AS z, CASE WHEN z > 0 THEN 'high' ELSE 'low' END AS side
FROM z WHERE abs(z) > 3"""

ORACLE["iqr_anomalies"] = """
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
           FROM events GROUP BY 1),
f AS (SELECT e.event_id, e.event_type, e.value, q.q1 - 1.5 * (q.q3 - q.q1) AS lo, q.q3 + 1.5 * (q.q3 - q.q1) AS hi
      FROM events e JOIN q USING (event_type))
SELECT event_id, event_type, value, round(lo, 6) AS lower_fence, round(hi, 6) AS upper_fence
FROM f WHERE value < lo OR value > hi"""

ORACLE["business_rules"] = kpi_with() + """
, r AS (
  SELECT date_key, property_id, 'negative_net_revenue' AS rule, fnb_net_revenue AS value, fnb_net_revenue < 0 AS hit FROM kpi
  UNION ALL SELECT date_key, property_id, 'occupancy_above_max', occupancy_pct, occupancy_pct > 100 FROM kpi
  UNION ALL SELECT date_key, property_id, 'occupancy_below_min', occupancy_pct, occupancy_pct < 20 FROM kpi
  UNION ALL SELECT date_key, property_id, 'food_cost_high', food_cost_pct, food_cost_pct > 40 FROM kpi
  UNION ALL SELECT date_key, property_id, 'discount_high', fnb_discount / NULLIF(fnb_gross_sales, 0) * 100,
                   fnb_discount / NULLIF(fnb_gross_sales, 0) * 100 > 20 FROM kpi
  UNION ALL SELECT date_key, property_id, 'void_rate_high', void_lines / NULLIF(CAST(fnb_lines AS DOUBLE), 0) * 100,
                   void_lines / NULLIF(CAST(fnb_lines AS DOUBLE), 0) * 100 > 5 FROM kpi)
SELECT date_key, property_id, rule, round(CAST(value AS DOUBLE), 6) AS value FROM r WHERE hit"""

ORACLE["densify_ffill"] = """
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS ds, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1, 2),
b AS (SELECT user_id, MIN(ds) AS lo, MAX(ds) AS hi FROM d GROUP BY 1),
sp AS (SELECT user_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS ds FROM b)
SELECT sp.user_id, sp.ds, d.value,
       last_value(d.value IGNORE NULLS) OVER (PARTITION BY sp.user_id ORDER BY sp.ds
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value_ffill,
       CASE WHEN d.value IS NULL THEN 1 ELSE 0 END AS is_filled
FROM sp LEFT JOIN d ON d.user_id = sp.user_id AND d.ds = sp.ds"""

ORACLE["stock_continuity"] = with_star("fact_inventory") + """
SELECT store_id, item, stock_date, CAST(opening_stock AS DOUBLE) AS opening_stock,
       CAST(closing_stock AS DOUBLE) AS closing_stock, CAST(prev AS DOUBLE) AS prev_closing,
       CAST(opening_stock - prev AS DOUBLE) AS continuity_gap
FROM (SELECT *, lag(closing_stock) OVER (PARTITION BY store_id, item ORDER BY stock_date) AS prev
      FROM fact_inventory)"""

ORACLE["stock_variance"] = with_star("fact_inventory") + """
SELECT store_id, item, stock_date, CAST(opening_stock AS DOUBLE) AS opening_stock,
       CAST(closing_stock AS DOUBLE) AS closing_stock, CAST(theo AS DOUBLE) AS theoretical_closing,
       CAST(closing_stock - theo AS DOUBLE) AS inventory_variance
FROM (SELECT *, opening_stock + purchase_qty - transfer_qty - consumption_qty - waste_qty AS theo
      FROM fact_inventory)"""

ORACLE["moving_unit_cost"] = f"""
WITH d AS (SELECT l_partkey AS product_id, CAST(l_shipdate AS DATE) AS purchase_date,
                  SUM(CAST(l_quantity AS {M})) AS qty, SUM(CAST(l_extendedprice AS {M})) AS total
           FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey GROUP BY 1, 2)
SELECT product_id, purchase_date, CAST(qty AS DOUBLE) AS qty, CAST(total AS DOUBLE) AS total,
       round(CAST(SUM(total) OVER w AS DOUBLE) / NULLIF(CAST(SUM(qty) OVER w AS DOUBLE), 0), 6) AS moving_unit_cost
FROM d WINDOW w AS (PARTITION BY product_id ORDER BY purchase_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

ORACLE["reorder_signal"] = with_star("fact_inventory") + """
SELECT store_id, item, stock_date, CAST(opening_stock AS DOUBLE) AS opening_stock,
       CAST(consumption_qty AS DOUBLE) AS consumption_qty
FROM fact_inventory WHERE opening_stock < consumption_qty * 5"""

WAVE = "level * (1 + 0.05 * sin(step / 7.0))"

ORACLE["forecast_wave"] = with_star("fact_room_sales") + "," + ROOM_SERIES + f"""
, lv AS (SELECT property_id, AVG(revenue) AS level, MAX(ds) + 1 AS start FROM rs GROUP BY 1)
SELECT property_id, CAST(start + step - 1 AS DATE) AS forecast_date, step, round({WAVE}, 4) AS forecast
FROM lv, (SELECT CAST(range AS INTEGER) AS step FROM range(1, 91))"""

ORACLE["forecast_moving_avg"] = with_star("fact_room_sales") + "," + ROOM_SERIES + f"""
, st AS (SELECT property_id, MAX(ds) + 1 AS start FROM rs GROUP BY 1),
lv AS (SELECT property_id, AVG(revenue) AS level FROM (
         SELECT *, row_number() OVER (PARTITION BY property_id ORDER BY ds DESC) AS rn FROM rs) WHERE rn <= 30
       GROUP BY 1)
SELECT property_id, CAST(start + step - 1 AS DATE) AS forecast_date, step, round({WAVE}, 4) AS forecast
FROM lv JOIN st USING (property_id), (SELECT CAST(range AS INTEGER) AS step FROM range(1, 91))"""

ORACLE["forecast_accuracy"] = with_star("fact_room_sales") + "," + ROOM_SERIES + f"""
, cut AS (SELECT property_id, MAX(ds) - 89 AS cutoff FROM rs GROUP BY 1),
s AS (SELECT rs.*, cut.cutoff FROM rs JOIN cut USING (property_id)),
train AS (SELECT * FROM s WHERE ds < cutoff),
test AS (SELECT property_id, ds AS forecast_date, revenue AS actual FROM s WHERE ds >= cutoff),
lv AS (SELECT property_id, 'wave' AS model, AVG(revenue) AS level FROM train GROUP BY 1
       UNION ALL
       SELECT property_id, 'moving_avg', AVG(revenue) FROM (
         SELECT *, row_number() OVER (PARTITION BY property_id ORDER BY ds DESC) AS rn FROM train)
       WHERE rn <= 30 GROUP BY 1),
fc AS (SELECT lv.property_id, lv.model, CAST(cut.cutoff + step - 1 AS DATE) AS forecast_date, {WAVE} AS forecast
       FROM lv JOIN cut USING (property_id), (SELECT CAST(range AS INTEGER) AS step FROM range(1, 91)))
SELECT fc.property_id, fc.model, COUNT(*) AS n,
       round(AVG(CASE WHEN actual <> 0 THEN abs(forecast - actual) / abs(actual) END) * 100, 4) AS mape,
       round(AVG(abs(forecast - actual)), 4) AS mae,
       round(sqrt(AVG((forecast - actual) * (forecast - actual))), 4) AS rmse
FROM fc JOIN test ON fc.property_id = test.property_id AND fc.forecast_date = test.forecast_date
GROUP BY 1, 2"""


# ---------------------------------------------------------------- quality
def _profile_sql(table: str, cols: list[tuple[str, bool]]) -> str:
    parts = []
    for c, num in cols:
        if num:
            x = f"CAST({c} AS DOUBLE)"
            stats = (f"round(AVG({x}), 6), round(stddev_samp({x}), 6), round(MIN({x}), 6), "
                     f"round(quantile_cont({x}, 0.25), 6), round(quantile_cont({x}, 0.5), 6), "
                     f"round(quantile_cont({x}, 0.75), 6), round(MAX({x}), 6)")
        else:
            stats = ", ".join(["CAST(NULL AS DOUBLE)"] * 7)
        parts.append(
            f"SELECT '{table}' AS table_name, '{c}' AS column_name, COUNT(*) AS n_rows, "
            f"COUNT(*) - COUNT({c}) AS null_count, "
            f"round((COUNT(*) - COUNT({c})) / NULLIF(COUNT(*), 0) * 100, 6) AS null_pct, "
            f"COUNT(DISTINCT {c}) AS n_distinct, {stats}, "
            f"(SELECT CAST(COALESCE(SUM(c - 1), 0) AS BIGINT) FROM (SELECT COUNT(*) AS c FROM {table} GROUP BY ALL_COLS)) "
            f"AS duplicate_rows FROM {table}")
    return " UNION ALL ".join(parts)


_PROFILE_COLS = {
    "orders": [("o_orderkey", True), ("o_custkey", True), ("o_orderstatus", False),
               ("o_totalprice", True), ("o_orderdate", False), ("o_orderpriority", False)],
    "customer": [("c_custkey", True), ("c_name", False), ("c_nationkey", True),
                 ("c_acctbal", True), ("c_mktsegment", False)],
}

# name the seven stats columns positionally via a wrapping select
_stat_names = ["mean", "std", "min", "q1", "median", "q3", "max"]
ORACLE["profile_columns"] = " UNION ALL ".join(
    "SELECT * FROM (" + _profile_sql(t, cols).replace(
        "GROUP BY ALL_COLS", "GROUP BY " + ", ".join(c for c, _ in cols)) + ") AS p(table_name, column_name, "
    "n_rows, null_count, null_pct, n_distinct, " + ", ".join(_stat_names) + ", duplicate_rows)"
    for t, cols in _PROFILE_COLS.items())

ORACLE["findings"] = f"""
SELECT 'unparsable_date' AS rule, 'lineitem' AS source,
       COUNT(*) FILTER (WHERE {sql_parse_date(RAW_DATE_SQL)} IS NULL) AS records_affected FROM lineitem
UNION ALL SELECT 'negative_quantity', 'lineitem', COUNT(*) FILTER (WHERE l_quantity < 0) FROM lineitem
UNION ALL SELECT 'zero_discount', 'lineitem', COUNT(*) FILTER (WHERE l_discount = 0) FROM lineitem
UNION ALL SELECT 'negative_balance', 'customer', COUNT(*) FILTER (WHERE c_acctbal < 0) FROM customer
UNION ALL SELECT 'negative_balance', 'supplier', COUNT(*) FILTER (WHERE s_acctbal < 0) FROM supplier
UNION ALL SELECT 'invalid_category', 'part', COUNT(*) FILTER (WHERE {sql_norm_key('p_type')}
                 NOT IN ('STANDARD', 'MEDIUM', 'ECONOMY', 'LARGE')) FROM part
UNION ALL SELECT 'duplicate_line_key', 'lineitem', CAST(COALESCE(SUM(c - 1), 0) AS BIGINT)
          FROM (SELECT COUNT(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)
UNION ALL SELECT 'ship_before_order', 'lineitem', COUNT(*) FILTER (WHERE l.l_shipdate < o.o_orderdate)
          FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

ORACLE["gate_checks"] = with_star("dim_property", "dim_department", "fact_room_sales",
                                  "fact_fnb_sales", "fact_expense", "fact_inventory") + """
, g AS (
  SELECT 'fact_room_sales.booking_id_not_null' AS check_name, COUNT(*) FILTER (WHERE booking_id IS NULL) AS failures FROM fact_room_sales
  UNION ALL SELECT 'fact_room_sales.check_out_after_check_in', COUNT(*) FILTER (WHERE NOT COALESCE(check_out >= check_in, FALSE)) FROM fact_room_sales
  UNION ALL SELECT 'fact_room_sales.revenue_non_negative', COUNT(*) FILTER (WHERE NOT COALESCE(room_revenue >= 0, FALSE)) FROM fact_room_sales
  UNION ALL SELECT 'fact_room_sales.unique(booking_id)', (SELECT COUNT(*) FROM (SELECT booking_id FROM fact_room_sales GROUP BY 1 HAVING COUNT(*) > 1))
  UNION ALL SELECT 'fact_fnb_sales.product_not_null', COUNT(*) FILTER (WHERE product_id IS NULL) FROM fact_fnb_sales
  UNION ALL SELECT 'fact_fnb_sales.quantity_non_negative', COUNT(*) FILTER (WHERE NOT COALESCE(quantity >= 0, FALSE)) FROM fact_fnb_sales
  UNION ALL SELECT 'fact_fnb_sales.net_le_gross', COUNT(*) FILTER (WHERE NOT COALESCE(net_sales <= gross_sales + 0.01, FALSE)) FROM fact_fnb_sales
  UNION ALL SELECT 'fact_fnb_sales.unique(transaction_id,line_no)', (SELECT COUNT(*) FROM (SELECT 1 FROM fact_fnb_sales GROUP BY transaction_id, line_no HAVING COUNT(*) > 1))
  UNION ALL SELECT 'fact_room_sales.property_id->dim', COUNT(*) FROM fact_room_sales r WHERE r.property_id IS NULL OR r.property_id NOT IN (SELECT property_id FROM dim_property)
  UNION ALL SELECT 'fact_fnb_sales.product_id->dim', COUNT(*) FROM fact_fnb_sales f WHERE f.product_id IS NULL OR f.product_id NOT IN (SELECT product_id FROM dim_product)
  UNION ALL SELECT 'fact_expense.account_id->dim', COUNT(*) FROM fact_expense e WHERE e.account_id IS NULL OR e.account_id NOT IN (SELECT account_id FROM dim_account)
  UNION ALL SELECT 'fact_expense.department_id->dim', COUNT(*) FROM fact_expense e WHERE e.department_id IS NULL OR e.department_id NOT IN (SELECT department_id FROM dim_department)
  UNION ALL SELECT 'fact_inventory.closing_non_negative', COUNT(*) FILTER (WHERE NOT COALESCE(closing_stock >= 0, FALSE)) FROM fact_inventory)
SELECT check_name, CAST(failures AS BIGINT) AS failures, CASE WHEN failures = 0 THEN 1 ELSE 0 END AS ok FROM g"""


def _health_sql(name, system, src, pk, date_col, mandatory, valid, consistent, integral, mapped):
    complete = " AND ".join(f"{c} IS NOT NULL" for c in mandatory)
    good = f"({complete}) AND COALESCE({valid}, FALSE) AND COALESCE({consistent}, FALSE) " \
           f"AND COALESCE({integral}, FALSE) AND COALESCE({mapped}, FALSE)"
    return (f"SELECT '{name}' AS source, '{system}' AS source_system, COUNT(*) AS records_total, "
            f"COUNT(*) FILTER (WHERE {good}) AS records_clean, "
            f"COUNT(*) FILTER (WHERE {complete}) AS n_complete, "
            f"COUNT(*) FILTER (WHERE COALESCE({valid}, FALSE)) AS n_valid, "
            f"COUNT(*) FILTER (WHERE COALESCE({consistent}, FALSE)) AS n_consistent, "
            f"COUNT(*) FILTER (WHERE COALESCE({integral}, FALSE)) AS n_integral, "
            f"COUNT(*) FILTER (WHERE COALESCE({mapped}, FALSE)) AS n_mapped, "
            f"CAST(MAX({date_col}) AS DATE) AS latest_record_date, "
            f"(SELECT COUNT(*) FROM (SELECT 1 FROM {src} GROUP BY {pk})) AS n_keys FROM {src}")


_RI = "property_id IN (SELECT property_id FROM dim_property)"
_pct = "round({c} / NULLIF(records_total, 0) * 100, 6)"
ORACLE["source_health"] = with_star("dim_property", "fact_room_sales", "fact_fnb_sales", "fact_expense",
                                    "fact_inventory") + """
, u AS (""" + " UNION ALL ".join([
    _health_sql("bookings", "orders", "fact_room_sales", "booking_id", "check_in",
                ["booking_id", "property_id", "check_in"], "room_revenue >= 0 AND los >= 1",
                "check_out >= check_in", _RI, "segment IS NOT NULL"),
    _health_sql("pos", "lineitem", "fact_fnb_sales", "transaction_id, line_no", "sale_date",
                ["transaction_id", "product_id", "property_id"], "quantity >= 0",
                "net_sales <= gross_sales + 0.01", _RI, "category IS NOT NULL"),
    _health_sql("ledger", "orders", "fact_expense", "expense_id", "expense_date",
                ["expense_id", "account_id", "property_id"], "amount >= 0",
                "transaction_type = 'Credit' OR transaction_type = 'Debit'", _RI,
                "department_id IS NOT NULL"),
    _health_sql("inventory", "events", "fact_inventory", "stock_date, store_id, item", "stock_date",
                ["store_id", "item"], "closing_stock >= 0", "movements >= 1",
                "item IN ('purchase', 'view', 'click', 'error', 'signup')", "store_id IS NOT NULL"),
]) + f"""),
p AS (
  SELECT source, source_system, records_total, records_clean,
         {_pct.format(c='n_complete')} AS completeness_pct, {_pct.format(c='n_keys')} AS uniqueness_pct,
         {_pct.format(c='n_valid')} AS validity_pct, {_pct.format(c='n_consistent')} AS consistency_pct,
         {_pct.format(c='n_integral')} AS integrity_pct,
         round((records_total - n_keys) / NULLIF(records_total, 0) * 100, 6) AS duplicate_rate_pct,
         {_pct.format(c='n_mapped')} AS mapping_completion_pct,
         records_total - records_clean AS failed_records, latest_record_date
  FROM u),
s AS (SELECT *, CAST(datediff('day', latest_record_date, (SELECT MAX(latest_record_date) FROM p)) AS INTEGER) AS freshness_days,
             round((completeness_pct * 1.0 + uniqueness_pct * 1.0 + validity_pct * 1.0 + consistency_pct * 1.0
                    + integrity_pct * 1.0 + mapping_completion_pct * 1.0) / 6.0, 6) AS quality_score
      FROM p)
SELECT *, CASE WHEN quality_score >= 98 THEN 'A' WHEN quality_score >= 95 THEN 'B'
               WHEN quality_score >= 90 THEN 'C' ELSE 'D' END AS dq_tier,
       CASE WHEN quality_score >= 95 THEN 'Healthy' WHEN quality_score >= 90 THEN 'Warning'
            ELSE 'Critical' END AS status
FROM s"""

_RECON = ["room_revenue", "rooms_sold", "occupied_room_nights", "bookings", "fnb_gross_sales",
          "fnb_net_revenue", "fnb_cogs", "opex", "other_income"]
ORACLE["reconcile_kpis"] = kpi_with() + """
, a AS (SELECT """ + ", ".join(f"round(CAST(SUM({m}) AS DOUBLE), 2) AS {m}" for m in _RECON) + """ FROM kpi),
b AS (SELECT round(CAST((SELECT SUM(room_revenue) FROM fact_room_sales) AS DOUBLE), 2) AS room_revenue,
             round(CAST((SELECT SUM(rooms_sold) FROM fact_room_sales) AS DOUBLE), 2) AS rooms_sold,
             round(CAST((SELECT SUM(room_nights) FROM fact_room_sales) AS DOUBLE), 2) AS occupied_room_nights,
             round(CAST((SELECT COUNT(*) FROM fact_room_sales) AS DOUBLE), 2) AS bookings,
             round(CAST((SELECT SUM(gross_sales) FROM fact_fnb_sales) AS DOUBLE), 2) AS fnb_gross_sales,
             round(CAST((SELECT SUM(CASE WHEN is_void = 0 AND is_refund = 0 THEN net_sales ELSE 0 END) FROM fact_fnb_sales) AS DOUBLE), 2) AS fnb_net_revenue,
             round(CAST((SELECT SUM(cogs_amount) FROM fact_fnb_sales) AS DOUBLE), 2) AS fnb_cogs,
             round(CAST((SELECT SUM(amount) FROM fact_expense JOIN dim_account USING (account_id) WHERE account_type = 'OPEX') AS DOUBLE), 2) AS opex,
             round(CAST((SELECT SUM(amount) FROM fact_expense JOIN dim_account USING (account_id)
                          WHERE account_type = 'Revenue' AND account_code IN (""" + OTHER_INCOME_SQL + """)) AS DOUBLE), 2) AS other_income),
la AS (""" + " UNION ALL ".join(f"SELECT '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM a" for m in _RECON) + """),
lb AS (""" + " UNION ALL ".join(f"SELECT '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM b" for m in _RECON) + """)
SELECT COALESCE(la.metric, lb.metric) AS metric, la.value AS value_a, lb.value AS value_b,
       round(la.value - lb.value, 6) AS diff,
       CASE WHEN abs(la.value - lb.value) <= 0.01 THEN 'match' ELSE 'mismatch' END AS status
FROM la FULL OUTER JOIN lb ON la.metric = lb.metric"""

ORACLE["domain_check"] = with_star("dim_property", "fact_expense") + """
SELECT 'business_type' AS domain, business_type AS value, COUNT(*) AS n_rows,
       CASE WHEN business_type IN ('Hotel', 'F&B') THEN 1 ELSE 0 END AS is_valid FROM dim_property GROUP BY 2
UNION ALL SELECT 'account_type', account_type, COUNT(*), CASE WHEN account_type IN ('Revenue', 'COGS', 'OPEX') THEN 1 ELSE 0 END
          FROM dim_account GROUP BY 2
UNION ALL SELECT 'transaction_type', transaction_type, COUNT(*), CASE WHEN transaction_type IN ('Debit', 'Credit') THEN 1 ELSE 0 END
          FROM fact_expense GROUP BY 2
UNION ALL SELECT 'order_status', o_orderstatus, COUNT(*), CASE WHEN o_orderstatus IN ('F', 'O', 'P') THEN 1 ELSE 0 END
          FROM orders GROUP BY 2
UNION ALL SELECT 'return_flag', l_returnflag, COUNT(*), CASE WHEN l_returnflag IN ('A', 'N', 'R') THEN 1 ELSE 0 END
          FROM lineitem GROUP BY 2"""


# ---------------------------------------------------------------- measures
def _conf(date: str) -> str:
    return (f"CAST(year({date}) AS INTEGER) AS year, CAST(quarter({date}) AS INTEGER) AS quarter, "
            f"CAST(month({date}) AS INTEGER) AS month, CAST(date_trunc('month', {date}) AS DATE) AS month_start, "
            f"{date} AS full_date")


_PATTRS = "p.property_name, p.business_type, p.city, p.region"
MEASURE_CTES = f"""
room_c AS (SELECT f.*, {_conf('f.check_in')}, {_PATTRS} FROM fact_room_sales f
           LEFT JOIN dim_property p ON p.property_id = f.property_id),
fnb_c AS (SELECT f.*, {_conf('f.sale_date')}, {_PATTRS} FROM fact_fnb_sales f
          LEFT JOIN dim_property p ON p.property_id = f.property_id),
exp_c AS (SELECT f.*, a.account_type, a.account_code, {_conf('f.expense_date')}, {_PATTRS} FROM fact_expense f
          JOIN dim_account a ON a.account_id = f.account_id
          LEFT JOIN dim_property p ON p.property_id = f.property_id),
bud_c AS (SELECT f.*, a.account_type, a.account_code, {_conf('f.budget_date')}, {_PATTRS} FROM fact_budget f
          JOIN dim_account a ON a.account_id = f.account_id
          LEFT JOIN dim_property p ON p.property_id = f.property_id),
cap_c AS (SELECT d.full_date, CAST(year(d.full_date) AS INTEGER) AS year, CAST(quarter(d.full_date) AS INTEGER) AS quarter,
                 CAST(month(d.full_date) AS INTEGER) AS month, CAST(date_trunc('month', d.full_date) AS DATE) AS month_start,
                 p.property_id, {_PATTRS}, p.rooms
          FROM dim_date d CROSS JOIN dim_property p WHERE p.rooms IS NOT NULL)"""

_BASE_SQL = {
    "room": ("room_c", {
        "room_revenue": "SUM(room_revenue)", "rooms_sold": "CAST(SUM(rooms_sold) AS BIGINT)",
        "room_nights": "CAST(SUM(room_nights) AS BIGINT)", "los_nights": "CAST(SUM(los) AS BIGINT)", "bookings": "COUNT(*)",
        "cancellations": "CAST(SUM(is_cancelled) AS BIGINT)", "no_shows": "CAST(SUM(is_no_show) AS BIGINT)"},
        ["segment", "channel"]),
    "capacity": ("cap_c", {"available_room_nights": "CAST(SUM(rooms) AS BIGINT)"}, []),
    "fnb": ("fnb_c", {
        "fnb_gross_sales": "SUM(gross_sales)",
        "fnb_net_revenue": "SUM(CASE WHEN is_void = 0 AND is_refund = 0 THEN net_sales ELSE 0 END)",
        "fnb_cogs": "SUM(cogs_amount)", "fnb_discount": "SUM(discount)", "fnb_lines": "COUNT(*)",
        "void_lines": "CAST(SUM(is_void) AS BIGINT)", "fnb_transactions": "COUNT(DISTINCT transaction_id)"},
        ["category", "product_id", "outlet_name"]),
    "expense": ("exp_c", {
        "opex": "SUM(CASE WHEN account_type = 'OPEX' THEN amount ELSE 0 END)",
        "ledger_cogs": "SUM(CASE WHEN account_type = 'COGS' THEN amount ELSE 0 END)",
        "other_income": f"SUM(CASE WHEN account_type = 'Revenue' AND account_code IN ({OTHER_INCOME_SQL}) "
                        f"THEN amount ELSE 0 END)"},
        ["department_id", "account_id", "account_type"]),
    "budget": ("bud_c", {"budget_amount": "SUM(budget_amount)"},
               ["department_id", "account_id", "account_type"]),
}
_COMMON = {"year", "quarter", "month", "month_start", "full_date", "property_id", "property_name",
           "business_type", "city", "region"}
_COUNTS = {"rooms_sold", "room_nights", "los_nights", "bookings", "cancellations", "no_shows",
           "available_room_nights", "fnb_lines", "void_lines", "fnb_transactions"}


def _bz(n):
    return f"COALESCE({n}, 0)"


def _pct_sql(n, d):
    return f"round(CAST({n} AS DOUBLE) / NULLIF(CAST({d} AS DOUBLE), 0) * 100, 6)"


def _ratio_sql(n, d):
    return f"round(CAST({n} AS DOUBLE) / NULLIF(CAST({d} AS DOUBLE), 0), 6)"


_TOT = f"({_bz('room_revenue')} + {_bz('fnb_net_revenue')} + {_bz('other_income')})"
_EBITDA = f"({_TOT} - {_bz('ledger_cogs')} - {_bz('opex')})"
_DERIVED_SQL = {
    "occupancy_pct": (["room_nights", "available_room_nights"], _pct_sql(_bz("room_nights"), "available_room_nights")),
    "adr": (["room_revenue", "rooms_sold"], _ratio_sql(_bz("room_revenue"), _bz("rooms_sold"))),
    "revpar": (["room_revenue", "available_room_nights"], _ratio_sql(_bz("room_revenue"), "available_room_nights")),
    "cancellation_pct": (["cancellations", "bookings"], _pct_sql(_bz("cancellations"), _bz("bookings"))),
    "noshow_pct": (["no_shows", "bookings"], _pct_sql(_bz("no_shows"), _bz("bookings"))),
    "avg_los": (["los_nights", "rooms_sold"], _ratio_sql(_bz("los_nights"), _bz("rooms_sold"))),
    "food_cost_pct": (["fnb_cogs", "fnb_net_revenue"], _pct_sql(_bz("fnb_cogs"), _bz("fnb_net_revenue"))),
    "gross_profit": (["fnb_net_revenue", "fnb_cogs"],
                     f"CAST({_bz('fnb_net_revenue')} - {_bz('fnb_cogs')} AS DOUBLE)"),
    "gross_margin_pct": (["fnb_net_revenue", "fnb_cogs"],
                         _pct_sql(f"({_bz('fnb_net_revenue')} - {_bz('fnb_cogs')})", _bz("fnb_net_revenue"))),
    "average_check": (["fnb_net_revenue", "fnb_transactions"],
                      _ratio_sql(_bz("fnb_net_revenue"), _bz("fnb_transactions"))),
    "discount_pct": (["fnb_discount", "fnb_gross_sales"], _pct_sql(_bz("fnb_discount"), _bz("fnb_gross_sales"))),
    "void_pct": (["void_lines", "fnb_lines"], _pct_sql(_bz("void_lines"), _bz("fnb_lines"))),
    "total_revenue": (["room_revenue", "fnb_net_revenue", "other_income"], f"CAST({_TOT} AS DOUBLE)"),
    "ebitda": (["room_revenue", "fnb_net_revenue", "other_income", "ledger_cogs", "opex"],
               f"CAST({_EBITDA} AS DOUBLE)"),
    "ebitda_margin_pct": (["room_revenue", "fnb_net_revenue", "other_income", "ledger_cogs", "opex"],
                          _pct_sql(_EBITDA, _TOT)),
    "net_profit": (["room_revenue", "fnb_net_revenue", "other_income", "ledger_cogs", "opex"],
                   f"CAST({_EBITDA} * 0.72 AS DOUBLE)"),
    "budget_achievement_pct": (["room_revenue", "fnb_net_revenue", "other_income", "budget_amount"],
                               _pct_sql(_TOT, _bz("budget_amount"))),
    "revenue_variance": (["room_revenue", "fnb_net_revenue", "other_income", "budget_amount"],
                         f"CAST({_TOT} - {_bz('budget_amount')} AS DOUBLE)"),
    "variance_pct": (["room_revenue", "fnb_net_revenue", "other_income", "budget_amount"],
                     _pct_sql(f"({_TOT} - {_bz('budget_amount')})", _bz("budget_amount"))),
}


def measures_sql(names, group_by, filters=None) -> tuple[str, str]:
    """(extra CTEs, final SELECT) evaluating measures at the grain."""
    base = []
    for n in names:
        for b in (_DERIVED_SQL[n][0] if n in _DERIVED_SQL else [n]):
            if b not in base:
                base.append(b)
    ctes, aliases = [], []
    for fname, (src, aggs, extra) in _BASE_SQL.items():
        wanted = [b for b in base if b in aggs]
        if not wanted or any(g not in _COMMON and g not in extra for g in group_by):
            continue
        where = []
        for k, v in (filters or {}).items():
            if k in _COMMON or k in extra:
                where.append(f"{k} = '{v}'" if isinstance(v, str) else f"{k} = {v}")
        g = ", ".join(group_by)
        ctes.append(f"m_{fname} AS (SELECT {g}, " + ", ".join(f"{aggs[b]} AS {b}" for b in wanted)
                    + f" FROM {src}" + (" WHERE " + " AND ".join(where) if where else "")
                    + f" GROUP BY {g})")
        aliases.append(f"m_{fname}")
    frm = aliases[0] + "".join(f" FULL OUTER JOIN {a} USING ({', '.join(group_by)})" for a in aliases[1:])
    cols = list(group_by)
    for n in names:
        if n in _DERIVED_SQL:
            cols.append(f"{_DERIVED_SQL[n][1]} AS {n}")
        elif n in _COUNTS:
            cols.append(f"{_bz(n)} AS {n}")
        else:
            cols.append(f"CAST({_bz(n)} AS DOUBLE) AS {n}")
    return ", ".join(ctes), f"SELECT {', '.join(cols)} FROM {frm}"


_MSTAR = with_star("dim_property", "dim_date", "dim_account", "fact_room_sales", "fact_fnb_sales",
                   "fact_budget") + "," + MEASURE_CTES

_ALL_M = ["room_revenue", "rooms_sold", "room_nights", "bookings", "available_room_nights",
          "occupancy_pct", "adr", "revpar", "cancellation_pct", "noshow_pct", "avg_los",
          "fnb_gross_sales", "fnb_net_revenue", "fnb_cogs", "food_cost_pct", "gross_profit",
          "gross_margin_pct", "fnb_transactions", "average_check", "discount_pct", "void_pct",
          "opex", "ledger_cogs", "other_income", "total_revenue", "ebitda", "ebitda_margin_pct",
          "net_profit", "budget_amount", "budget_achievement_pct", "revenue_variance", "variance_pct"]


def _mq(names, group_by, filters=None):
    c, sel = measures_sql(names, group_by, filters)
    return _MSTAR + ", " + c + "\n" + sel


ORACLE["measures_by_property"] = _mq(_ALL_M, ["property_id", "property_name", "business_type"])
ORACLE["measures_by_month"] = _mq(_ALL_M, ["year", "month"])
ORACLE["measures_by_segment"] = _mq(["room_revenue", "rooms_sold", "room_nights", "bookings", "adr",
                                     "cancellation_pct", "noshow_pct", "avg_los"], ["segment"],
                                    {"business_type": "Hotel"})

_yb = ["total_revenue", "room_revenue", "fnb_net_revenue", "ebitda", "room_nights", "available_room_nights", "fnb_cogs"]
_yc, _ys = measures_sql(_yb, ["month_start"])
ORACLE["yoy_mom"] = _MSTAR + ", " + _yc + f""",
m AS ({_ys}),
ly AS (SELECT CAST(month_start + INTERVAL 12 MONTH AS DATE) AS month_start, """ + ", ".join(
    f"{b} AS {b}_ly" for b in _yb) + """ FROM m),
lm AS (SELECT CAST(month_start + INTERVAL 1 MONTH AS DATE) AS month_start, total_revenue AS total_revenue_lm FROM m),
j AS (SELECT * FROM m LEFT JOIN ly USING (month_start) LEFT JOIN lm USING (month_start))
SELECT month_start, total_revenue, total_revenue_ly,
       round((total_revenue - total_revenue_ly) / NULLIF(total_revenue_ly, 0) * 100, 6) AS revenue_yoy_pct,
       total_revenue_lm, round((total_revenue - total_revenue_lm) / NULLIF(total_revenue_lm, 0) * 100, 6) AS revenue_mom_pct,
       room_revenue_ly, fnb_net_revenue_ly, ebitda, ebitda_ly,
       round((ebitda - ebitda_ly) / NULLIF(ebitda_ly, 0) * 100, 6) AS ebitda_yoy_pct,
       round(CAST(room_nights AS DOUBLE) / NULLIF(CAST(available_room_nights AS DOUBLE), 0) * 100, 6) AS occupancy_pct,
       round(CAST(room_nights_ly AS DOUBLE) / NULLIF(CAST(available_room_nights_ly AS DOUBLE), 0) * 100, 6) AS occupancy_pct_ly,
       round(fnb_cogs / NULLIF(fnb_net_revenue, 0) * 100, 6) AS food_cost_pct,
       round(fnb_cogs_ly / NULLIF(fnb_net_revenue_ly, 0) * 100, 6) AS food_cost_pct_ly
FROM j"""

_rc, _rs = measures_sql(["room_revenue", "fnb_net_revenue", "total_revenue"], ["month_start"])
ORACLE["revenue_share"] = _MSTAR + ", " + _rc + f""",
m AS ({_rs})
SELECT month_start, round(room_revenue, 2) AS room_revenue, round(fnb_net_revenue, 2) AS fnb_net_revenue,
       round(total_revenue, 2) AS total_revenue,
       round(room_revenue / NULLIF(total_revenue, 0) * 100, 6) AS hotel_share_pct,
       round(fnb_net_revenue / NULLIF(total_revenue, 0) * 100, 6) AS fnb_share_pct
FROM m"""

_bands = [("occupancy_pct", 65.0, 85.0), ("food_cost_pct", None, 32.0), ("gross_margin_pct", 65.0, None),
          ("ebitda_margin_pct", 28.0, None), ("cancellation_pct", None, 8.0), ("noshow_pct", None, 2.0),
          ("avg_los", 2.0, 4.0), ("discount_pct", None, 6.0), ("void_pct", None, 2.0)]
_kc, _ks = measures_sql([b[0] for b in _bands], ["property_id"])
ORACLE["kpi_bands"] = _MSTAR + ", " + _kc + f""",
m AS ({_ks}),
bands(kpi, lo, hi) AS (VALUES """ + ", ".join(
    f"('{k}', {'NULL' if lo is None else lo}::DOUBLE, {'NULL' if hi is None else hi}::DOUBLE)"
    for k, lo, hi in _bands) + """),
l AS (""" + " UNION ALL ".join(f"SELECT property_id, '{k}' AS kpi, CAST({k} AS DOUBLE) AS value FROM m"
                                for k, _, _ in _bands) + """)
SELECT l.property_id, l.kpi, l.value, b.lo, b.hi,
       CASE WHEN l.value IS NULL THEN 'n/a' WHEN b.lo IS NOT NULL AND l.value < b.lo THEN 'low'
            WHEN b.hi IS NOT NULL AND l.value > b.hi THEN 'high' ELSE 'ok' END AS status
FROM l JOIN bands b ON b.kpi = l.kpi"""


# ---------------------------------------------------------------- trends, DQ summary, insights
ORACLE["daily_trend"] = kpi_with() + """
SELECT full_date, CAST(SUM(CAST(total_revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
       CAST((2 * CAST(SUM(CAST(occupancy_pct AS DECIMAL(18,6))) * 1000000 AS HUGEINT) + 1 * COUNT(occupancy_pct)) // NULLIF(2 * COUNT(occupancy_pct), 0) AS DOUBLE) / 1000000 AS avg_occupancy_pct,
       CAST((2 * CAST(SUM(CAST(adr AS DECIMAL(18,6))) * 1000000 AS HUGEINT) + 100 * COUNT(adr)) // NULLIF(200 * COUNT(adr), 0) AS DOUBLE) / 10000 AS avg_adr
FROM kpi GROUP BY full_date"""

ORACLE["dq_summary"] = """
SELECT round(AVG(quality_score), 6) AS dq_score, round(AVG(completeness_pct), 6) AS completeness_pct,
       round(AVG(duplicate_rate_pct), 6) AS duplicate_rate_pct, CAST(SUM(failed_records) AS BIGINT) AS failed_records
FROM (""" + ORACLE["source_health"] + ")"

ORACLE["insight_evidence"] = """
WITH y AS (""" + ORACLE["yoy_mom"] + """),
e AS (SELECT month_start, 'total_revenue' AS metric, CAST(total_revenue AS DOUBLE) AS value,
             CAST(total_revenue_ly AS DOUBLE) AS baseline FROM y
      UNION ALL SELECT month_start, 'ebitda', ebitda, ebitda_ly FROM y
      UNION ALL SELECT month_start, 'occupancy_pct', occupancy_pct, occupancy_pct_ly FROM y)
SELECT month_start, metric, value, baseline, round(value - baseline, 6) AS delta,
       round((value - baseline) / NULLIF(abs(baseline), 0) * 100, 6) AS delta_pct,
       CASE WHEN value - baseline > 0 THEN 'up' WHEN value - baseline < 0 THEN 'down' ELSE 'flat' END AS direction
FROM e WHERE baseline IS NOT NULL AND value IS NOT NULL"""

ORACLE["finding_evidence"] = f"""
WITH v AS (
  SELECT DISTINCT 'unparsable_date' AS rule, 'lineitem' AS source, raw_date AS value
  FROM (SELECT {RAW_DATE_SQL} AS raw_date FROM lineitem) WHERE {sql_parse_date('raw_date')} IS NULL
  UNION ALL
  SELECT DISTINCT 'invalid_category', 'part', raw_type FROM (
    SELECT CASE p_partkey % 3 WHEN 0 THEN lower(p_type) WHEN 1 THEN ' ' || p_type || ' ' ELSE p_type END AS raw_type
    FROM part) WHERE {sql_norm_key('raw_type')} NOT IN ('STANDARD', 'MEDIUM', 'ECONOMY', 'LARGE')
  UNION ALL
  SELECT DISTINCT 'negative_balance', 'customer', c_name FROM customer WHERE c_acctbal < 0)
SELECT rule, source, rank, value FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY rule ORDER BY value) AS INTEGER) AS rank FROM v)
WHERE rank <= 10"""

ORACLE["raw_csv_ingest"] = f"""
SELECT l_orderkey, l_linenumber, {sql_parse_date(RAW_DATE_SQL)} AS ship_date,
       {sql_parse_number(RAW_NUMBER_SQL)} AS amount, l_returnflag AS return_flag, 1 AS lineage_ok,
       'l_orderkey,l_linenumber,ship_date,amount,return_flag,_source_file,_raw_row' AS staged_columns
FROM lineitem"""

# ---------------------------------------------------------------- rows that facts leave out
ORACLE["quarantine_by_rule"] = f"""
WITH priorities(priority) AS (VALUES {", ".join(f"('{a[0]}')" for a in ACCOUNTS)}),
o AS (SELECT *, NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey) AS c0,
             NOT EXISTS (SELECT 1 FROM priorities WHERE priority = o_orderpriority) AS a0, o_orderdate IS NULL AS d0 FROM orders),
l AS (SELECT *, NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey) AS s0,
             NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey) AS p0, l_shipdate IS NULL AS d0 FROM lineitem),
r AS (
  SELECT 'bookings' AS source, CASE WHEN c0 THEN 'unknown_customer' WHEN d0 THEN 'missing_date' ELSE 'kept' END AS rule, o_totalprice AS v FROM o
  UNION ALL SELECT 'ledger', CASE WHEN c0 THEN 'unknown_customer' WHEN a0 THEN 'unknown_account' WHEN d0 THEN 'missing_date' ELSE 'kept' END, o_totalprice FROM o
  UNION ALL SELECT 'pos', CASE WHEN s0 THEN 'unknown_supplier' WHEN p0 THEN 'unknown_part' WHEN d0 THEN 'missing_date' ELSE 'kept' END, l_extendedprice FROM l
  UNION ALL SELECT 'purchases', CASE WHEN s0 THEN 'unknown_supplier' WHEN d0 THEN 'missing_date' ELSE 'kept' END, l_extendedprice FROM l)
SELECT source, rule, COUNT(*) AS n_rows, CAST(SUM(CAST(v AS {M})) AS DOUBLE) AS amount FROM r GROUP BY source, rule"""
