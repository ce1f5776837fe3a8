"""Dirty extracts, derived from the star tables by fixed rules.

The tables are clean, so the dirt that the cleaning stage is for - spellings,
date shapes, signs, unknown members, duplicates - is derived from their keys.
Each extract is one statement of SQL that Spark and DuckDB read alike; text is
what an operational system would export.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def _date(d: str, k: str) -> str:
    """A date in one of three shapes, or unreadable, by ``k``."""
    t = f"CAST(CAST({d} AS DATE) AS STRING)"
    return (f"CASE WHEN {k} % 97 = 5 THEN 'n/a' WHEN {k} % 3 = 1 THEN substr({t}, 9, 2) || '/' || substr({t}, 6, 2) || '/' || substr({t}, 1, 4) "
            f"WHEN {k} % 3 = 2 THEN replace({t}, '-', '') ELSE {t} END")


def _name(n: str, k: str, unknown: str, every: int) -> str:
    """A name as it is spelled in one of four ways, or one that no master has."""
    return (f"CASE WHEN {k} % {every} = 7 THEN '{unknown}' WHEN {k} % 4 = 1 THEN lower({n}) WHEN {k} % 4 = 2 THEN '  ' || {n} || ' ' "
            f"WHEN {k} % 4 = 3 THEN replace({n}, ' ', '-') ELSE {n} END")


def _amount(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(16,2)) AS STRING)"



BOOKINGS = f"""
SELECT k * 2 + copy AS _raw_row, 'B' || CAST(k AS STRING) AS booking_id, {_name('n_name', '(k + copy)', 'Closed House', 29)} AS property,
  CASE WHEN k % 3 = 0 THEN lower(seg) WHEN k % 53 = 4 THEN 'walk-in?' ELSE ' ' || seg END AS guest_segment,
  CASE WHEN k % 5 = 0 THEN replace(pri, '-', ' - ') ELSE pri END AS booking_channel,
  CASE st WHEN 'F' THEN 'Confirmed' WHEN 'O' THEN ' Cancelled' ELSE 'No-Show ' END AS cancellation_status,
  CASE WHEN k % 13 = 2 THEN {_date('d + CAST(substr(pri, 1, 1) AS INT)', 'k')} ELSE {_date('d', 'k')} END AS check_in,
  CASE WHEN k % 13 = 2 THEN {_date('d', '(k + 1)')} ELSE {_date('d + CAST(substr(pri, 1, 1) AS INT)', '(k + 1)')} END AS check_out,
  CASE WHEN k % 19 = 3 THEN '-' ELSE '' END || {_amount('price')} AS room_rate
FROM (SELECT *, 0 AS copy FROM base UNION ALL SELECT *, 1 AS copy FROM base WHERE k % 17 = 0)
"""
_BOOKING_BASE = """
SELECT o.o_orderkey AS k, CAST(o.o_orderdate AS DATE) AS d, o.o_orderpriority AS pri, o.o_orderstatus AS st, o.o_totalprice AS price,
  c.c_mktsegment AS seg, n.n_name FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey
"""
_LINE_BASE = """
SELECT l.*, CAST(l.l_shipdate AS DATE) AS d, l.l_orderkey + l.l_linenumber AS k, s.s_name, n.n_name, p.p_type
FROM {lineitem} l JOIN {supplier} s ON l.l_suppkey = s.s_suppkey JOIN {nation} n ON s.s_nationkey = n.n_nationkey
  JOIN {part} p ON l.l_partkey = p.p_partkey
"""
POS = f"""
SELECT l_orderkey AS transaction_id, l_linenumber AS till_line, copy AS _raw_row, {_name('s_name', 'k', 'Pop-up Stall', 41)} AS outlet,
  {_name("('Item ' || CAST(l_partkey AS STRING))", '(k + 1)', 'Mystery dish', 31)} AS product_name,
  CASE WHEN k % 11 = 4 THEN 'misc!' WHEN k % 2 = 0 THEN lower(p_type) ELSE p_type || ' ' END AS category,
  {_date('d', 'k')} AS transaction_date, CASE WHEN k % 13 = 6 THEN '-' ELSE '' END || CAST(CAST(l_quantity AS DECIMAL(14,3)) AS STRING) || ' ' AS quantity,
  {_amount('l_extendedprice')} AS gross_sales, CASE WHEN k % 5 = 2 THEN NULL ELSE {_amount('CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(3,2))')} END AS discount,
  CASE WHEN l_returnflag = 'A' THEN 'y ' ELSE 'N' END AS void_flag, CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE '' END AS refund_flag
FROM (SELECT *, 0 AS copy FROM base UNION ALL SELECT *, 1 AS copy FROM base WHERE k % 23 = 0)
"""
LEDGER = f"""
SELECT k AS expense_id, copy AS _raw_row, {_name('n_name', 'k', 'Closed House', 37)} AS property,
  CASE WHEN k % 10 = 3 THEN a.account_code || 'X' ELSE a.account_code END AS account_code,
  CASE WHEN k % 70 = 3 THEN 'sundry' WHEN k % 2 = 0 THEN lower(a.account_name) ELSE a.account_name END AS account_name,
  {_date('d', 'k')} AS transaction_date, {_amount('CAST(price AS DECIMAL(12,2)) * 0.01')} AS amount
FROM (SELECT *, 0 AS copy FROM base UNION ALL SELECT *, 1 AS copy FROM base WHERE k % 21 = 0) b
  JOIN {{accounts}} a ON b.pri = a.priority
"""
INVENTORY = f"""
WITH moves AS (
  SELECT CAST(ts AS DATE) AS d, user_id AS u, event_type AS item, CAST(SUM(CAST(value AS DECIMAL(14,3))) AS DECIMAL(18,3)) AS v, COUNT(*) AS n
  FROM {{events}} GROUP BY CAST(ts AS DATE), user_id, event_type),
base AS (SELECT m.*, u * 7 + n AS k, x.n_name FROM moves m JOIN {{nation}} x ON m.u % 25 = x.n_nationkey)
SELECT u * 2 + copy AS _raw_row, {_name('n_name', 'u', 'Closed House', 43)} AS property,
  CASE WHEN k % 61 = 8 THEN 'ghost' ELSE ' ' || upper(item) END AS product_name, {_date('d', 'u')} AS inventory_date,
  CAST(v AS STRING) AS opening_stock, CAST(v * 2 AS STRING) AS purchase_qty, CASE WHEN k % 4 = 0 THEN NULL ELSE CAST(n AS STRING) END AS transfer_qty,
  CASE WHEN k % 9 = 5 THEN '-' ELSE '' END || CAST(v AS STRING) AS consumption_qty, CAST(n AS STRING) AS waste_qty,
  CAST(v * 2 AS STRING) AS closing_stock, CAST(v * 5 AS STRING) AS stock_value
FROM (SELECT *, 0 AS copy FROM base UNION ALL SELECT *, 1 AS copy FROM base WHERE k % 27 = 0)
"""
PURCHASES = f"""
SELECT l_orderkey AS purchase_id, l_linenumber AS doc_line, copy AS _raw_row, {_name('n_name', 'k', 'Closed House', 33)} AS property,
  {_name("('Item ' || CAST(l_partkey AS STRING))", '(k + 2)', 'Unlisted goods', 47)} AS product_name, {_name('s_name', '(k + 3)', 'Cash & Carry', 35)} AS supplier,
  {_date('d', 'k')} AS purchase_date, CAST(CAST(l_quantity AS DECIMAL(14,3)) AS STRING) || ' ' AS quantity,
  CAST(CAST(l_extendedprice AS DECIMAL(16,2)) AS STRING) AS list_total, CAST(CAST(l_tax + 10 AS DECIMAL(14,2)) AS STRING) AS unit_price
FROM (SELECT *, 0 AS copy FROM base UNION ALL SELECT *, 1 AS copy FROM base WHERE k % 25 = 0)
"""
BUDGET = f"""
WITH months AS (
  SELECT year(d) AS y, month(d) AS m, n_name, pri, COUNT(*) AS n, SUM(CAST(CAST(price AS DECIMAL(12,2)) * 0.01 AS DECIMAL(16,2))) AS v FROM base GROUP BY year(d), month(d), n_name, pri)
SELECT 0 AS _raw_row, {_name('n_name', '(n + m)', 'Closed House', 39)} AS property,
  CASE WHEN (n + m) % 23 = 7 THEN 'petty cash' WHEN n % 2 = 0 THEN upper(a.account_name) ELSE a.account_name END AS account,
  CASE WHEN n % 2 = 0 THEN CAST(y + 1 AS STRING) || '-' || lpad(CAST(m AS STRING), 2, '0')
       ELSE substr('JanFebMarAprMayJunJulAugSepOctNovDec', m * 3 - 2, 3) || '-' || CAST(y + 1 AS STRING) END AS period,
  CAST(CAST(CAST(v AS DECIMAL(16,2)) * 1.05 AS DECIMAL(18,2)) AS STRING) AS budget_amount
FROM months b JOIN {{accounts}} a ON b.pri = a.priority
"""


def _with(base: str, text: str) -> str:
    body = text.strip()
    return f"WITH base AS ({base}), {body[5:]}" if body.startswith("WITH ") else f"WITH base AS ({base}) {body}"


#: name -> SQL with ``{table}`` in place of the tables.
EXTRACTS = {
    "bookings": _with(_BOOKING_BASE, BOOKINGS), "pos": _with(_LINE_BASE, POS), "ledger": _with(_BOOKING_BASE, LEDGER),
    "inventory": INVENTORY, "purchases": _with(_LINE_BASE, PURCHASES), "budget": _with(_BOOKING_BASE, BUDGET),
}
TABLES = ["orders", "customer", "nation", "lineitem", "supplier", "part", "events"]


_COPIES = re.compile(r"SELECT \*, 0 AS copy FROM base UNION ALL SELECT \*, 1 AS copy FROM base WHERE k % (\d+) = 0")


def one_pass(text: str) -> str:
    """The statement with the copies made of each row as it is read, so that
    the joins of ``base`` run once and not once more for the copies."""
    return _COPIES.sub(r"SELECT * FROM base LATERAL VIEW explode(sequence(0, if(k % \1 = 0, 1, 0))) AS copy", text)


def extract(spark: SparkSession, star, name: str) -> DataFrame:
    """An extract of the star's tables."""
    text = one_pass(EXTRACTS[name])
    used = {t: star.t(t) for t in TABLES if f"{{{t}}}" in text}
    if "{accounts}" in text:
        used["accounts"] = star.dim_account
    return spark.sql(text, **used)
