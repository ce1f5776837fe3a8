"""DuckDB SQL of the six cleaners and their log.

Per source: the extract, equal rows or keys combined, masters joined, then the
rules as conditions. A row is kept if no quarantining condition holds; a rule
counts the rows where its condition and none of the quarantining ones before
it holds.
"""

from __future__ import annotations

from .cleaning import CALENDAR, CATEGORIES, OTHER, SEGMENTS, STOCK_PRODUCTS, UNKNOWN_SUPPLIER, WINDOW
from .extracts import EXTRACTS, TABLES
from .oracle import STAR_CTES


def _key(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(upper({x}), '[^A-Z0-9 ]+', ' ', 'g'), ' +', ' ', 'g'))"


def _day(x: str) -> str:
    return (f"CASE WHEN {x} LIKE '__/__/____' THEN CAST(strptime({x}, '%d/%m/%Y') AS DATE) WHEN {x} LIKE '____-__-__' THEN CAST({x} AS DATE) "
            f"WHEN length({x}) = 8 THEN CAST(strptime({x}, '%Y%m%d') AS DATE) END")


def _dkey(x: str) -> str:
    return f"CAST(year({x}) * 10000 + month({x}) * 100 + day({x}) AS INTEGER)"


def _in(x: str, values: list[str], other: str) -> str:
    pairs = " ".join(f"WHEN '{v.upper()}' THEN '{v}'" for v in values)
    return f"CASE {_key(x)} {pairs} ELSE '{other}' END"


_M, _Q = "DECIMAL(16,2)", "DECIMAL(16,3)"
_PROPERTY = f"LEFT JOIN dim_property m ON {_key('d.property')} = {_key('m.property_name')}"
_NO_PROPERTY = ("unknown property", "quarantined", "property_id IS NULL", True)


def _item(x: str) -> str:
    """The part that a product text names."""
    return f"LEFT JOIN part i ON {_key(x)} = 'ITEM ' || CAST(i.p_partkey AS VARCHAR)"


def _distinct(columns: str) -> str:
    return f"SELECT {columns}, min(_raw_row) AS _raw_row, count(*) AS copies FROM raw GROUP BY ALL"


SOURCES = {
    "bookings": {
        "duplicates": "duplicate booking_id",
        "combined": "SELECT *, count(*) OVER (PARTITION BY booking_id) AS copies FROM raw "
                    "QUALIFY row_number() OVER (PARTITION BY booking_id ORDER BY _raw_row) = 1",
        "judged": f"""
  SELECT *, CASE WHEN out_raw < in_raw THEN out_raw ELSE in_raw END AS arrival, CASE WHEN out_raw < in_raw THEN in_raw ELSE out_raw END AS departure,
    CASE WHEN status = 'Confirmed' THEN 1 ELSE 0 END AS sold, greatest(rate, CAST(0 AS {_M})) AS r
  FROM (SELECT d.*, m.property_id, {_in('guest_segment', SEGMENTS, OTHER)} AS segment, {_day('check_in')} AS in_raw, {_day('check_out')} AS out_raw,
          trim(cancellation_status) AS status, CAST(room_rate AS {_M}) AS rate FROM d {_PROPERTY})""",
        "rules": [_NO_PROPERTY, ("segment not in master", "set to Other", f"segment = '{OTHER}'", False),
                  ("unreadable check_in", "quarantined", "in_raw IS NULL", True), ("unreadable check_out", "quarantined", "out_raw IS NULL", True),
                  ("check_out before check_in", "swapped", "out_raw < in_raw", False), ("unreadable rate", "quarantined", "rate IS NULL", True),
                  ("negative rate", "set to 0", "rate < 0", False),
                  ("outside the window", "quarantined", f"arrival NOT BETWEEN DATE '{WINDOW[0]}' AND DATE '{WINDOW[1]}'", True)],
        "columns": f"""booking_id, property_id, segment, replace(trim(booking_channel), ' - ', '-') AS channel, arrival, departure,
  CAST(greatest(departure - arrival, 1) AS INTEGER) AS los, CASE WHEN status = 'Cancelled' THEN 1 ELSE 0 END AS is_cancelled,
  CASE WHEN status = 'No-Show' THEN 1 ELSE 0 END AS is_no_show, sold AS rooms_sold, CAST(greatest(departure - arrival, 1) * sold AS INTEGER) AS room_nights,
  CAST(r AS DOUBLE) AS room_rate, CAST(r * sold AS DOUBLE) AS room_revenue, {_dkey('arrival')} AS date_id""",
    },
    "pos": {
        "duplicates": "duplicate line",
        "combined": _distinct("transaction_id, till_line, outlet, product_name, category, transaction_date, quantity, gross_sales, discount, "
                              "void_flag, refund_flag"),
        "judged": f"""
  SELECT d.* EXCLUDE (category), d.category AS raw_category, s.s_name AS outlet_name, s.s_nationkey AS property_id, i.p_partkey AS product_id, i.p_size,
    {_in('d.category', CATEGORIES, OTHER)} AS category, {_day('transaction_date')} AS sale_date, CAST(trim(d.quantity) AS {_Q}) AS q,
    CAST(gross_sales AS {_M}) AS g, CAST(discount AS {_M}) AS disc
  FROM d LEFT JOIN supplier s ON {_key('d.outlet')} = {_key('s.s_name')} {_item('d.product_name')}""",
        "rules": [("unknown outlet", "quarantined", "property_id IS NULL", True), ("unknown product", "quarantined", "product_id IS NULL", True),
                  ("category not in master", "set to Other", f"category = '{OTHER}'", False),
                  ("unreadable transaction_date", "quarantined", "sale_date IS NULL", True),
                  ("missing discount", "set to 0", "disc IS NULL", False), ("negative quantity", "absolute value", "q < 0", False)],
        "columns": f"""transaction_id, CAST(row_number() OVER (PARTITION BY transaction_id ORDER BY till_line, outlet, product_name, raw_category,
    transaction_date, quantity, gross_sales, discount NULLS FIRST, void_flag, refund_flag) AS INTEGER) AS line_no, outlet_name, property_id, product_id,
  category, sale_date, CAST(abs(q) AS DOUBLE) AS quantity, CAST(g AS DOUBLE) AS gross_sales, CAST(coalesce(disc, 0) AS DOUBLE) AS discount,
  CAST(g - coalesce(disc, 0) AS DOUBLE) AS net_sales, CASE WHEN abs(q) > 0 THEN round(CAST(g AS DOUBLE) / CAST(abs(q) AS DOUBLE), 6) ELSE 0.0 END AS unit_price,
  CAST(c AS DOUBLE) AS cogs_amount, CAST(g - coalesce(disc, 0) - c AS DOUBLE) AS gross_profit, CASE WHEN upper(trim(void_flag)) = 'Y' THEN 1 ELSE 0 END AS is_void,
  CASE WHEN upper(trim(refund_flag)) = 'Y' THEN 1 ELSE 0 END AS is_refund, {_dkey('sale_date')} AS date_id""",
    },
    "ledger": {
        "duplicates": "duplicate ledger line",
        "combined": _distinct("expense_id, property, account_code, account_name, transaction_date, amount"),
        "judged": f"""
  SELECT d.* EXCLUDE (amount), m.property_id, a.account_id AS by_code, b.account_id AS by_name, {_day('transaction_date')} AS expense_date, CAST(amount AS {_M}) AS v
  FROM d {_PROPERTY} LEFT JOIN accounts a ON {_key('d.account_code')} = a.account_code LEFT JOIN accounts b ON {_key('d.account_name')} = {_key('b.account_name')}""",
        "rules": [_NO_PROPERTY, ("malformed account code", "mapped by name", "by_code IS NULL AND by_name IS NOT NULL", False),
                  ("unknown account", "quarantined", "by_code IS NULL AND by_name IS NULL", True),
                  ("unreadable transaction_date", "quarantined", "expense_date IS NULL", True)],
        "columns": f"""expense_id, property_id, coalesce(by_code, by_name) AS account_id, expense_date, CAST(v AS DOUBLE) AS amount,
  {_dkey('expense_date')} AS date_id""",
    },
    "inventory": {
        "duplicates": "duplicate stock row",
        "combined": _distinct("property, product_name, inventory_date, opening_stock, purchase_qty, transfer_qty, consumption_qty, waste_qty, "
                              "closing_stock, stock_value"),
        "judged": f"""
  SELECT *, rank() OVER (PARTITION BY bad, stock_date, property_id, product_id ORDER BY _raw_row) > 1 AS later
  FROM (SELECT *, property_id IS NULL OR product_id = '' OR stock_date IS NULL AS bad
        FROM (SELECT d.*, m.property_id, {_in('product_name', STOCK_PRODUCTS, '')} AS product_id, {_day('inventory_date')} AS stock_date FROM d {_PROPERTY}))""",
        "rules": [_NO_PROPERTY, ("unknown product", "quarantined", "product_id = ''", True),
                  ("unreadable inventory_date", "quarantined", "stock_date IS NULL", True), ("missing transfer", "set to 0", "transfer_qty IS NULL", False),
                  ("second row of a day's stock", "quarantined", "later", True),
                  ("negative consumption", "absolute value", f"CAST(consumption_qty AS {_Q}) < 0", False)],
        "columns": f"""stock_date, property_id, product_id, CAST(opening_stock AS DOUBLE) AS opening_stock, CAST(purchase_qty AS DOUBLE) AS purchase_qty,
  CAST(coalesce(transfer_qty, '0') AS DOUBLE) AS transfer_qty, abs(CAST(consumption_qty AS DOUBLE)) AS consumption_qty, CAST(waste_qty AS DOUBLE) AS waste_qty,
  CAST(closing_stock AS DOUBLE) AS closing_stock, CAST(CAST(stock_value AS {_M}) AS DOUBLE) AS stock_value, {_dkey('stock_date')} AS date_id""",
    },
    "purchases": {
        "duplicates": "duplicate purchase line",
        "combined": _distinct("purchase_id, doc_line, property, product_name, supplier, purchase_date, quantity, list_total, unit_price"),
        "judged": f"""
  SELECT d.* EXCLUDE (quantity, unit_price), d.quantity AS raw_quantity, d.unit_price AS raw_price, m.property_id, i.p_partkey AS product_id,
    CASE WHEN s.s_suppkey IS NOT NULL THEN printf('S%03d', s.s_suppkey) END AS sid,
    {_day('purchase_date')} AS bought_on, CAST(trim(d.quantity) AS {_Q}) AS q, CAST(d.unit_price AS {_M}) AS p, CAST(list_total AS {_M}) AS t
  FROM d {_PROPERTY} {_item('d.product_name')} LEFT JOIN supplier s ON {_key('d.supplier')} = {_key('s.s_name')}""",
        "rules": [_NO_PROPERTY, ("unknown product", "quarantined", "product_id IS NULL", True), ("unknown supplier", "set to S999", "sid IS NULL", False),
                  ("unreadable purchase_date", "quarantined", "bought_on IS NULL", True),
                  ("total is not quantity x price", "recomputed", "abs(t - q * p) >= 0.02", False)],
        "columns": f"""CAST(purchase_id AS VARCHAR) || '-' || CAST(row_number() OVER (PARTITION BY purchase_id ORDER BY doc_line, property, product_name,
    supplier, purchase_date, raw_quantity, list_total, raw_price) - 1 AS VARCHAR) AS purchase_line_id, purchase_id, property_id, product_id,
  coalesce(sid, '{UNKNOWN_SUPPLIER}') AS supplier_id, bought_on, CAST(q AS DOUBLE) AS quantity, CAST(p AS DOUBLE) AS unit_price,
  CAST(CASE WHEN abs(t - q * p) >= 0.02 THEN CAST(round(q * p, 2) AS {_M}) ELSE t END AS DOUBLE) AS total_amount, {_dkey('bought_on')} AS date_id""",
    },
    "budget": {
        "duplicates": "duplicate budget line",
        "combined": _distinct("property, account, period, budget_amount"),
        "judged": f"""
  SELECT d.* EXCLUDE (budget_amount), m.property_id, a.account_id, a.department_id, CAST(budget_amount AS {_M}) AS v,
    CAST(CASE WHEN period LIKE '____-__' THEN strptime(period, '%Y-%m') ELSE strptime(period, '%b-%Y') END AS DATE) AS budget_date
  FROM d {_PROPERTY} LEFT JOIN accounts a ON {_key('d.account')} = {_key('a.account_name')}""",
        "rules": [_NO_PROPERTY, ("unknown account", "quarantined", "account_id IS NULL", True), ("unreadable period", "quarantined", "budget_date IS NULL", True)],
        "columns": f"""budget_date, property_id, department_id, account_id, CAST(v AS DOUBLE) AS budget_amount, CAST(year(budget_date) AS INTEGER) AS budget_year,
  CAST(month(budget_date) AS INTEGER) AS budget_month, {_dkey('budget_date')} AS date_id""",
    },
}


def _ctes(name: str) -> str:
    s = SOURCES[name]
    raw = EXTRACTS[name].format(**{t: t for t in TABLES}, accounts="accounts")
    judged = s["judged"]
    if name == "pos":
        judged = f"SELECT *, CAST(round(g * CAST((p_size + 20) * 0.01 AS DECIMAL(6,4)), 2) AS {_M}) AS c FROM ({judged})"
    return (f"{STAR_CTES['dim_account'][1]}, accounts AS (SELECT * FROM dim_account), {STAR_CTES['dim_property'][1]}, "
            f"raw AS ({raw}), d AS ({s['combined']}), judged AS ({judged})")


def _none(rules) -> str:
    """No quarantining condition holds."""
    return " AND ".join([f"NOT coalesce({c}, false)" for _, _, c, out in rules if out] or ["true"])


def clean_sql(name: str) -> str:
    s = SOURCES[name]
    return f"WITH {_ctes(name)} SELECT {s['columns']} FROM judged WHERE {_none(s['rules'])}"


def log_sql() -> str:
    """Every source's rules, each counted on its own."""
    out = []
    for name, s in SOURCES.items():
        rows = [f"SELECT 1 AS log_id, '{name}' AS source, '{s['duplicates']}' AS rule, 'first kept' AS action, "
                "CAST(sum(copies) - count(*) AS BIGINT) AS records_affected, CAST(sum(copies) AS BIGINT) AS rows_before, count(*) AS rows_after FROM d"]
        for k, (rule, action, cond, leaves) in enumerate(s["rules"]):
            before = _none(s["rules"][:k])
            after = _none(s["rules"][:k + 1])
            rows.append(f"SELECT {k + 2}, '{name}', '{rule.replace(chr(39), chr(39) * 2)}', '{action}', count(*) FILTER (WHERE {before} AND coalesce({cond}, false)), "
                        f"count(*) FILTER (WHERE {before}), count(*) FILTER (WHERE {after}) FROM judged")
        out.append(f"(WITH {_ctes(name)} " + " UNION ALL ".join(rows) + ")")
    return " UNION ALL ".join(f"SELECT * FROM {o}" for o in out)


def gate_sql() -> str:
    """Every check, each stated on its own."""
    days = (f"(SELECT {_dkey('g')} FROM (SELECT unnest(generate_series(DATE '{CALENDAR[0]}', DATE '{CALENDAR[1]}', INTERVAL 1 DAY)) AS g))")
    dims = {"property_id": ("property_id", "(SELECT n_nationkey FROM nation)"), "date_id": ("date_key", days),
            "product_id": ("product_id", "(SELECT p_partkey FROM part)"), "account_id": ("account_id", "(SELECT account_id FROM accounts)"),
            "department_id": ("department_id", "(SELECT department_id FROM dim_department)"),
            "supplier_id": ("supplier_id", f"(SELECT printf('S%03d', s_suppkey) FROM supplier UNION ALL SELECT '{UNKNOWN_SUPPLIER}')")}
    stock = ", ".join(f"('{p}')" for p in STOCK_PRODUCTS)
    refs = {"bookings": [], "pos": ["product_id"], "ledger": ["account_id"], "inventory": ["product_id"], "purchases": ["product_id", "supplier_id"],
            "budget": ["department_id"]}
    keys = {"bookings": "booking_id", "pos": "transaction_id,line_no", "inventory": "date_id,property_id,product_id",
            "budget": "date_id,property_id,department_id,account_id"}
    rules = {"bookings": {"booking_id_not_null": "booking_id IS NOT NULL", "departure_after_arrival": "departure >= arrival",
                          "revenue_not_negative": "room_revenue >= 0"},
             "pos": {"product_id_not_null": "product_id IS NOT NULL", "property_id_not_null": "property_id IS NOT NULL",
                     "quantity_not_negative": "quantity >= 0", "net_at_most_gross": "net_sales <= gross_sales + 0.01"},
             "ledger": {"account_id_not_null": "account_id IS NOT NULL"}, "inventory": {"closing_not_negative": "closing_stock >= 0"},
             "purchases": {"total_is_quantity_x_price": "abs(total_amount - quantity * unit_price) < 0.02"}}
    out = []
    for name in SOURCES:
        rows = []
        for col in ["property_id", "date_id", *refs[name]]:
            key, dim = dims[col]
            dim = f"(VALUES {stock})" if (name, col) == ("inventory", "product_id") else dim
            rows.append((f"{name}.{col}->{key}", f"SELECT count(*) FROM t WHERE {col} IS NULL OR {col} NOT IN (SELECT * FROM {dim})"))
        if name in keys:
            rows.append((f"{name}.unique({keys[name]})", f"SELECT count(*) FROM (SELECT 1 FROM t GROUP BY {keys[name]} HAVING count(*) > 1)"))
        rows += [(f"{name}.{r}", f"SELECT count(*) FROM t WHERE NOT coalesce({c}, false)") for r, c in rules.get(name, {}).items()]
        each = " UNION ALL ".join(f"SELECT '{n}' AS check_name, ({q}) AS failures" for n, q in rows)
        out.append(f"(WITH {_ctes(name)}, {STAR_CTES['dim_department'][1]}, t AS (SELECT {SOURCES[name]['columns']} FROM judged "
                   f"WHERE {_none(SOURCES[name]['rules'])}) {each})")
    return "SELECT *, CASE WHEN failures = 0 THEN 1 ELSE 0 END AS ok FROM (" + " UNION ALL ".join(f"SELECT * FROM {o}" for o in out) + ")"


CLEAN_ORACLE = {f"clean_{name}": clean_sql(name) for name in SOURCES} | {"cleansing_log": log_sql(), "gate_full": gate_sql()}
