"""Independent SQL for the registered queries.

It starts from the numbers in the benchmark tables, not from the report texts, so it says
what the parsers must give back and repeats none of their work.
"""

from __future__ import annotations

from reportstar.operators.forecast import BAND, ORIGINS
from reportstar.operators.trend import KNOTS, NOTHING, PENALTY, SWEEPS
from reportstar.plans.raw_views import COMPUTER


def _terminal(k: str) -> str:
    return (
        f"CASE WHEN {k} < 6 THEN '{COMPUTER}0' || ({k} + 1) WHEN {k} < 9 THEN 'PS5 (' || ({k} - 5) || ')' "
        f"WHEN {k} = 9 THEN '{COMPUTER}-VIP' WHEN {k} = 10 THEN 'PS-VIP' ELSE 'Kiosk 1' END"
    )


def _cents(c: str) -> str:
    return f"CAST(round({c} * 100) AS BIGINT)"


def _money(c: str) -> str:
    """Text of whole cents."""
    return (
        f"CASE WHEN {c} < 0 THEN '-' ELSE '' END || replace(format('{{:,}}', abs({c}) // 100), ',', chr(8239)) "
        f"|| ',' || lpad(CAST(abs({c}) % 100 AS VARCHAR), 2, '0') || ' TND'"
    )


def _total(c: str) -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(18,2))) AS DOUBLE)"


CASH = f"""cash AS (
  SELECT event_id, 'cashier_' || (user_id % 7) AS cashier, date_trunc('second', ts) AS date,
    CASE WHEN event_type = 'error' THEN 'Expense' ELSE 'Income' END AS income_expense,
    CASE WHEN event_id % 2 = 0 THEN 'Cash' ELSE 'Card' END AS payment_method,
    event_type AS transaction_type,
    CASE event_id % 3 WHEN 0 THEN '(' || terminal || ')' WHEN 1 THEN 'Money deposited to member' END AS comment,
    {_cents('value')} / 100.0 AS amount_tnd,
    CASE WHEN event_id % 3 = 0 THEN terminal END AS terminal
  FROM (SELECT *, CASE WHEN k = 11 THEN ' ' || {_terminal('k')} || ' ' ELSE {_terminal('k')} END AS terminal
        FROM (SELECT *, (event_id // 3) % 12 AS k FROM events)))"""

SESSIONS = f"""sessions AS (
  SELECT 'cashier_' || (event_id % 5) AS cashier, {_terminal('(event_id % 12)')} AS terminal,
    ['Member', 'Guest', 'Free', 'Prepaid'][event_id % 4 + 1] AS session_type,
    CAST(event_id % 200 AS INTEGER) AS duration_minutes, event_id % 5 = 0 AS is_free_time,
    CASE WHEN event_id % 6 = 0 THEN CAST(event_id % 60 AS INTEGER) END AS paused_duration_minutes,
    c % 500 / 100.0 AS order_transfer_tnd, c / 100.0 AS usage_tnd, c % 50 / 100.0 AS discount_tnd,
    (c + c % 500 - c % 50) / 100.0 AS total_amount_tnd
  FROM (SELECT event_id, {_cents('value')} AS c FROM events))"""

STOCK = f"""stock AS (
  SELECT 'cashier_' || (l_suppkey % 7) AS cashier, date_trunc('second', l_shipdate) AS date,
    CASE WHEN l_partkey % 97 <> 0 THEN p_name END AS item_name, p_type AS category,
    CASE WHEN l_returnflag = 'R' THEN 'In' ELSE 'Out' END AS in_out, CAST(q AS INTEGER) AS quantity,
    CASE l_orderkey % 3 WHEN 0 THEN '(' || {_terminal('k')} || ')' WHEN 1 THEN 'shelf check' END AS comment,
    c // q / 100.0 AS unit_price_tnd, c / 100.0 AS total_amount_tnd,
    CASE WHEN l_orderkey % 3 = 0 THEN {_terminal('k')} END AS terminal
  FROM (SELECT *, {_cents('l_extendedprice')} AS c, CAST(l_quantity AS BIGINT) AS q, (l_orderkey // 3) % 12 AS k
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey))"""

MEMBERS = f"""members AS (
  SELECT c_custkey AS member_id, lower(c_name) AS username, 'First' || c_nationkey AS firstname,
    upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS lastname,
    CAST(c_custkey % 1000 AS INTEGER) AS duration_minutes, c / 100.0 AS usage_tnd,
    abs(c) % 300 / 100.0 AS orders_transfer_tnd, (c + abs(c) % 300) / 100.0 AS total_amount_tnd
  FROM (SELECT *, {_cents('c_acctbal')} AS c FROM customer) WHERE c_custkey % 10 <> 9)"""

DIM_CASHIER = """dim_cashier AS (
  SELECT row_number() OVER (ORDER BY cashier_name) AS cashier_id, cashier_name FROM (
    SELECT cashier AS cashier_name FROM cash UNION SELECT cashier FROM sessions UNION SELECT cashier FROM stock))"""

DIM_TERMINAL = """dim_terminal AS (
  SELECT row_number() OVER (ORDER BY terminal_name) AS terminal_id, terminal_name,
    CASE WHEN terminal_name LIKE '%VIP%' THEN 'VIP' WHEN terminal_name LIKE 'PS%' THEN 'PlayStation'
         WHEN terminal_name LIKE 'Kiosk%' THEN 'Other' ELSE 'Computer' END AS terminal_type
  FROM (SELECT terminal AS terminal_name FROM sessions
        UNION SELECT trim(terminal) FROM cash WHERE terminal IS NOT NULL
        UNION SELECT terminal FROM stock WHERE terminal IS NOT NULL))"""

DIM_ITEM = """dim_item AS (
  SELECT row_number() OVER (ORDER BY category NULLS LAST, item_name NULLS LAST) AS item_id, item_name, category
  FROM (SELECT DISTINCT item_name, category FROM stock))"""

DIM_MEMBER = "dim_member AS (SELECT member_id, username, firstname, lastname FROM members)"

_CASHIER_ID = "(SELECT max(cashier_id) FROM dim_cashier d WHERE d.cashier_name = f.cashier) AS cashier_id"
_TERMINAL_ID = "(SELECT max(terminal_id) FROM dim_terminal d WHERE d.terminal_name = f.terminal) AS terminal_id"

FACT_CASH = f"""fact_cash AS (
  SELECT {_CASHIER_ID}, date AS transaction_datetime, income_expense, payment_method, transaction_type,
    amount_tnd, {_TERMINAL_ID} FROM cash f)"""
FACT_SESSIONS = f"""fact_sessions AS (
  SELECT {_CASHIER_ID}, {_TERMINAL_ID}, session_type, is_free_time, paused_duration_minutes, duration_minutes,
    order_transfer_tnd, usage_tnd, discount_tnd, total_amount_tnd FROM sessions f)"""
FACT_STOCK = f"""item_key AS (SELECT item_name, max(item_id) AS item_id FROM dim_item GROUP BY item_name),
fact_stock AS (
  SELECT {_CASHIER_ID}, date AS movement_datetime, i.item_id, in_out, quantity, unit_price_tnd, total_amount_tnd,
    {_TERMINAL_ID} FROM stock f LEFT JOIN item_key i ON i.item_name IS NOT DISTINCT FROM f.item_name)"""
FACT_MEMBERS = """fact_members AS (
  SELECT member_id, duration_minutes, usage_tnd, orders_transfer_tnd, total_amount_tnd FROM members)"""

ALL_CLEAN = (CASH, SESSIONS, STOCK, MEMBERS)
ALL_DIMS = (DIM_CASHIER, DIM_TERMINAL, DIM_ITEM, DIM_MEMBER)
ALL_FACTS = (FACT_CASH, FACT_SESSIONS, FACT_STOCK, FACT_MEMBERS)


def _with(*parts: str) -> str:
    *ctes, body = parts
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + body


# Rows of the printed grid, by order key.
GRID_ROW = "5 + (o_orderkey % {n}) // 40 * 44 + (o_orderkey % {n}) % 40"


def _grid(n: int) -> str:
    """Printed reports of ``n`` orders each."""
    return f"""grid AS (
  SELECT o_orderkey, ' cashier_' || (o_custkey % 7) AS cashier,
    strftime(o_orderdate, '%d.%m.%Y %H:%M:%S') AS date,
    CASE WHEN o_orderstatus = 'F' THEN 'Expense' ELSE 'Income' END AS income_expense,
    CASE WHEN o_orderkey % 2 = 0 THEN 'Cash' ELSE 'Card' END AS payment_method,
    o_orderpriority AS transaction_type, {_money('c')} AS amount,
    CASE o_orderkey % 3 WHEN 0 THEN '(' || {_terminal('k')} || ')' WHEN 1 THEN 'Money deposited to member' ELSE '' END AS comment,
    'cash_' || (o_orderkey // {n}) AS source_file, {GRID_ROW.format(n=n)} AS row_idx
  FROM (SELECT *, {_cents('o_totalprice')} AS c, (o_orderkey // 3) % 12 AS k FROM orders))"""


GRID = _grid(1000)

REVENUE = """daily_income AS (
  SELECT CAST(date AS DATE) AS ds, sum(CAST(amount_tnd AS DECIMAL(18,2))) AS y FROM cash
  WHERE income_expense = 'Income' GROUP BY 1),
revenue AS (
  SELECT c.ds, CAST(coalesce(d.y, 0) AS DOUBLE) AS y
  FROM (SELECT CAST(unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY)) AS DATE) AS ds FROM daily_income) c
  LEFT JOIN daily_income d USING (ds))"""

# Quantity per item name and day; a name stands for all items that carry it.
SOLD = """sold AS (
  SELECT item_name, CAST(date AS DATE) AS ds, CAST(sum(quantity) AS DOUBLE) AS y FROM stock
  WHERE in_out = 'Out' AND item_name IS NOT NULL GROUP BY 1, 2)"""


def _sunday(d: str) -> str:
    return f"{d} + CAST(7 - isodow({d}) AS INTEGER)"


def _dense(source: str, freq: str) -> str:
    """All periods of all items of ``source``, then the split at 14 non-zero ones."""
    label = "ds" if freq == "D" else _sunday("ds")
    days = 1 if freq == "D" else 7
    return f"""per_period AS (SELECT item_name, {label} AS ds, sum(y) AS y FROM {source} GROUP BY 1, 2),
calendar AS (
  SELECT CAST(unnest(generate_series(min(ds), max(ds), INTERVAL {days} DAY)) AS DATE) AS ds FROM per_period),
filled AS (
  SELECT i.item_name, c.ds, coalesce(p.y, 0) AS y
  FROM (SELECT DISTINCT item_name FROM per_period) i CROSS JOIN calendar c
  LEFT JOIN per_period p ON p.item_name = i.item_name AND p.ds = c.ds),
periods AS (SELECT item_name, count(*) FILTER (y > 0) AS nonzero FROM filled GROUP BY 1),
series AS (SELECT f.* FROM filled f JOIN periods p USING (item_name) WHERE nonzero >= 14)"""


def _model(name: str, source: str, key: str, horizon: int, freq: str) -> str:
    """The estimator row by row: bends as columns, what a line explains taken off by regression, residuals averaged."""
    days, seasons = (1, 7) if freq == "D" else (7, 1)
    far = f"{ORIGINS - 1} * {horizon}"
    effect = "avg(rest)" if seasons > 1 else "0.0"
    zeros = ", ".join(["0.0"] * KNOTS)
    moved = ", ".join(
        f"CASE WHEN i % {KNOTS} <> {j} THEN d[{j + 1}] WHEN g[{j + 1}][{j + 1}] = 0 THEN 0.0 ELSE "
        f"sign(z[{j + 1}] - list_dot_product(g[{j + 1}], d) + d[{j + 1}]) * "
        f"greatest(abs(z[{j + 1}] - list_dot_product(g[{j + 1}], d) + d[{j + 1}]) - penalty, 0.0) END"
        for j in range(KNOTS)
    )
    return f"""{name}_n AS (SELECT {key} AS k, count(*) AS n, min(ds) AS first FROM {source} GROUP BY 1),
{name}_t AS (
  SELECT n.k, n.n, datediff('day', n.first, s.ds) // {days} AS u, CAST(s.y AS DOUBLE) AS y FROM {source} s JOIN {name}_n n ON n.k = {key}),
{name}_cuts AS (
  SELECT DISTINCT n, r, n - r * {horizon} AS m FROM {name}_n, generate_series(0, {ORIGINS}) AS g(r)
  WHERE r = 0 OR n - r * {horizon} >= {far}),
{name}_knots AS (SELECT DISTINCT n, j, (j * 8 * (n - 1)) // (10 * ({KNOTS} + 1)) AS c FROM {name}_n, generate_series(1, {KNOTS}) AS g(j)),
{name}_h AS (
  SELECT c.n, c.r, k.j, u, greatest(u - k.c, 0)::DOUBLE AS h
  FROM {name}_cuts c JOIN {name}_knots k USING (n), LATERAL (SELECT unnest(range(c.m)) AS u)),
{name}_line AS (
  SELECT n, r, j, coalesce(regr_slope(h, u), 0) AS b, coalesce(regr_intercept(h, u), avg(h)) AS a, sum(h * h) AS hh FROM {name}_h GROUP BY 1, 2, 3),
{name}_rest AS MATERIALIZED (SELECT n, r, j, u, h - a - b * u AS x FROM {name}_h JOIN {name}_line USING (n, r, j)),
{name}_size AS MATERIALIZED (
  SELECT n, r, j, CASE WHEN sum(x * x) > {NOTHING} * any_value(hh) THEN sqrt(sum(x * x)) ELSE 0.0 END AS size
  FROM {name}_rest JOIN {name}_line USING (n, r, j) GROUP BY 1, 2, 3),
{name}_pairs AS (
  SELECT x.n, x.r, x.j, y.j AS i, sum(x.x * y.x) AS p FROM {name}_rest x JOIN {name}_rest y USING (n, r, u) GROUP BY 1, 2, 3, 4),
{name}_gram AS (
  SELECT n, r, list(line ORDER BY j) AS g FROM (
    SELECT n, r, p.j, list(CASE WHEN s.size * t.size = 0 THEN 0.0 WHEN p.j = p.i THEN 1.0 ELSE p.p / (s.size * t.size) END ORDER BY p.i) AS line
    FROM {name}_pairs p JOIN {name}_size s USING (n, r, j) JOIN (SELECT n, r, j AS i, size FROM {name}_size) t USING (n, r, i)
    GROUP BY 1, 2, 3) GROUP BY 1, 2),
{name}_head AS (
  SELECT t.k, n, c.r, c.m,
         CASE WHEN c.m > 2 THEN sqrt(greatest(coalesce(regr_syy(y, u) - regr_sxy(y, u) ** 2 / regr_sxx(y, u), 0), 0) / (c.m - 2)) ELSE 0.0 END * {PENALTY} AS penalty
  FROM {name}_t t JOIN {name}_cuts c USING (n) WHERE t.u < c.m GROUP BY 1, 2, 3, 4),
{name}_z AS (
  SELECT k, n, r, list(z ORDER BY j) AS z FROM (
    SELECT t.k, n, x.r, x.j, CASE WHEN any_value(s.size) = 0 THEN 0.0 ELSE sum(x.x * t.y) / any_value(s.size) END AS z
    FROM {name}_t t JOIN {name}_rest x USING (n, u) JOIN {name}_size s USING (n, r, j)
    GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3),
{name}_descent(k, n, r, z, g, penalty, i, d) AS (
  SELECT k, n, r, z, g, penalty, 0, [{zeros}]::DOUBLE[] FROM {name}_head JOIN {name}_z USING (k, n, r) JOIN {name}_gram USING (n, r)
  UNION ALL
  SELECT k, n, r, z, g, penalty, i + 1, [{moved}] FROM {name}_descent WHERE i < {SWEEPS * KNOTS}),
{name}_bends AS MATERIALIZED (
  SELECT k, n, r, s.j, CASE WHEN s.size = 0 THEN 0.0 ELSE d[s.j] / s.size END AS b
  FROM {name}_descent JOIN {name}_size s USING (n, r) WHERE i = {SWEEPS * KNOTS}),
{name}_places AS (
  SELECT k, n, r, m, u FROM {name}_n JOIN {name}_cuts c USING (n), LATERAL (SELECT unnest(range(c.m + {horizon})) AS u)),
{name}_bent AS (
  SELECT k, r, u, sum(b * greatest(u - c, 0)) AS bent FROM {name}_places JOIN {name}_bends USING (k, n, r) JOIN {name}_knots USING (n, j) GROUP BY 1, 2, 3),
{name}_all AS MATERIALIZED (
  SELECT k, n, r, m, u, bent, y FROM {name}_places JOIN {name}_bent USING (k, r, u) LEFT JOIN {name}_t USING (k, n, u)),
{name}_trend AS (
  SELECT k, r, coalesce(regr_slope(y - bent, u), 0) AS b, coalesce(regr_intercept(y - bent, u), avg(y - bent)) AS a FROM {name}_all WHERE u < m GROUP BY 1, 2),
{name}_season AS (
  SELECT k, r, s, {effect} AS e FROM (
    SELECT k, r, u % {seasons} AS s, y - bent - a - b * u AS rest FROM {name}_all JOIN {name}_trend USING (k, r) WHERE u < m)
  GROUP BY 1, 2, 3),
{name}_made AS MATERIALIZED (
  SELECT k, n, r, m, u, y, a + b * u + bent + coalesce(e, 0) AS p
  FROM (SELECT *, u % {seasons} AS s FROM {name}_all) JOIN {name}_trend USING (k, r) LEFT JOIN {name}_season USING (k, r, s)),
{name}_spread AS (
  SELECT k, sqrt(coalesce(avg((y - p) ** 2) FILTER (r > 0 AND u >= m),
                          CASE WHEN any_value(n) > 1 THEN sum((y - p) ** 2) FILTER (r = 0 AND u < m) / (any_value(n) - 1) ELSE 0 END)) AS sd
  FROM {name}_made GROUP BY 1),
{name} AS (
  SELECT k, CAST(first + CAST(u * {days} AS INTEGER) AS DATE) AS ds, greatest(p, 0) AS yhat, greatest(p - sd * {BAND}, 0) AS low,
         greatest(p + sd * {BAND}, 0) AS high
  FROM {name}_made JOIN {name}_spread USING (k) JOIN {name}_n USING (k, n) WHERE r = 0 AND u >= m)"""


PRICES = """prices AS (
  SELECT item_name, CAST(sum(CAST(unit_price_tnd AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_price FROM stock
  WHERE unit_price_tnd > 0 AND item_name IS NOT NULL GROUP BY 1)"""

ORDER_DAYS = """order_days AS (
  SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS ds, count(*) AS orders FROM orders GROUP BY 1, 2),
order_calendar AS (SELECT CAST(unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY)) AS DATE) AS ds FROM order_days),
order_series AS (
  SELECT o_orderpriority, ds, ds - min(ds) OVER () AS since, coalesce(orders, 0) AS orders, orders IS NOT NULL AS known
  FROM (SELECT DISTINCT o_orderpriority FROM order_days) CROSS JOIN order_calendar LEFT JOIN order_days USING (o_orderpriority, ds))"""

BOTH_FORECASTS = (
    CASH, REVENUE, STOCK, SOLD, _dense("sold", "D"), PRICES,
    _model("items_fc", "series", "item_name", 30, "D"),
    _model("revenue_fc", "revenue", "1", 30, "D"),
)

def _histogram(column: str, source: str, cte: str, n: int) -> str:
    return _with(
        cte,
        f"vals AS (SELECT CAST({column} AS DOUBLE) AS v FROM {source})",
        "ends AS (SELECT min(v) AS lo, max(v) AS hi FROM vals)",
        f"""counted AS (
          SELECT least(CAST(floor((v - lo) / ((hi - lo) / {n})) AS INTEGER), {n} - 1) AS bin, count(*) AS n
          FROM vals, ends GROUP BY 1)""",
        f"bins AS (SELECT unnest(range({n})) AS bin)",
        f"""SELECT CAST(b.bin AS INTEGER) AS bin, round(lo + (hi - lo) / {n} * b.bin, 6) AS low,
          round(lo + (hi - lo) / {n} * (b.bin + 1), 6) AS high, coalesce(c.n, 0) AS n
        FROM bins b CROSS JOIN ends LEFT JOIN counted c ON c.bin = b.bin""",
    )


def _describe(columns: list[str], source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 4) AS mean,
        round(stddev_samp({c}), 4) AS std, round(CAST(min({c}) AS DOUBLE), 4) AS min,
        round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS q25, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS q50,
        round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS q75, round(CAST(max({c}) AS DOUBLE), 4) AS max FROM {source}"""
        for c in columns
    )


_CASH_TYPES = {
    "cashier": "string", "date": "timestamp_ntz", "income_expense": "string", "payment_method": "string",
    "transaction_type": "string", "comment": "string", "amount_tnd": "double", "terminal": "string",
}

_RELATIONS = (
    ("fact_cash_transactions", "fact_cash", "cashier_id", "dim_cashier"),
    ("fact_cash_transactions", "fact_cash", "terminal_id", "dim_terminal"),
    ("fact_sessions", "fact_sessions", "cashier_id", "dim_cashier"),
    ("fact_sessions", "fact_sessions", "terminal_id", "dim_terminal"),
    ("fact_stock_movements", "fact_stock", "cashier_id", "dim_cashier"),
    ("fact_stock_movements", "fact_stock", "item_id", "dim_item"),
    ("fact_stock_movements", "fact_stock", "terminal_id", "dim_terminal"),
    ("fact_member_stats", "fact_members", "member_id", "dim_member"),
)


def _relations() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS "fromTable", '{column}' AS "fromColumn", '{dim}' AS "toTable",
        '{column}' AS "toColumn", 'manyToOne' AS cardinality, true AS active, count(*) AS rows,
        count(*) - count({column}) AS null_keys,
        count(*) FILTER ({column} IS NOT NULL AND {column} NOT IN (SELECT {column} FROM {dim})) AS orphans
        FROM {cte}"""
        for name, cte, column, dim in _RELATIONS
    )


def _key_report() -> str:
    keys = {"dim_cashier": "cashier_id", "dim_terminal": "terminal_id", "dim_item": "item_id", "dim_member": "member_id"}
    return " UNION ALL ".join(
        f"""SELECT '{dim}' AS "table", count(*) AS rows, count(DISTINCT {key}) AS keys,
        count(*) - count(DISTINCT {key}) AS repeated_keys, count(*) - count({key}) AS null_keys FROM {dim}"""
        for dim, key in keys.items()
    )


_CASH_OUT = "date, cashier, income_expense, payment_method, transaction_type, comment, amount_tnd, terminal"
_PRICE = _cents("l_extendedprice")

def _counts() -> str:
    sources = {
        "dim_cashier": "dim_cashier", "dim_terminal": "dim_terminal", "dim_item": "dim_item",
        "dim_member": "dim_member", "fact_cash_transactions": "cash", "fact_sessions": "sessions",
        "fact_stock_movements": "stock", "fact_member_stats": "members",
    }
    return " UNION ALL ".join(f"SELECT '{name}' AS \"table\", count(*) AS rows FROM {source}" for name, source in sources.items())


def _hard(key: str, name: str) -> str:
    return f"""CASE {key} % 8 WHEN 0 THEN '  ' || {name} || ' ' WHEN 1 THEN '"' || {name} || '" \\"'
        WHEN 2 THEN {name} || chr(10) || 'second, line' || chr(13) || chr(10) WHEN 3 THEN '\\' || {name} || '\\'
        WHEN 4 THEN '' WHEN 6 THEN ',' || {name} WHEN 7 THEN {name} END"""


ORACLE: dict[str, str] = {
    # grids
    "q_grid_strip": _with(GRID, "SELECT * EXCLUDE (o_orderkey) FROM grid"),
    "q_grid_accounting": """
      SELECT 'cash' AS report, 'cash_' || (o_orderkey // 1000) AS source_file,
        count(*) + 5 * count(*) FILTER (k = 0) + 4 * count(*) FILTER (k % 40 = 39) + 3 * count(*) FILTER (k = 999) AS rows_in,
        5 * count(*) FILTER (k = 0) AS preamble,
        count(*) FILTER (k % 40 = 39) + count(*) FILTER (k = 999) AS page_marker,
        count(*) FILTER (k % 40 = 39) AS repeated_header,
        2 * count(*) FILTER (k % 40 = 39) + 2 * count(*) FILTER (k = 999) AS keyless,
        count(*) AS kept, CAST(60 AS INTEGER) AS width
      FROM (SELECT *, o_orderkey % 1000 AS k FROM orders) GROUP BY o_orderkey // 1000""",
    "q_scan_text_grid": _with(_grid(250_000), "SELECT source_file, row_idx, date, amount, comment FROM grid"),
    "q_header_scan": _with(
        GRID, 'SELECT trim(cashier) AS "Cashier", date AS "Date", amount AS "Amount" FROM grid'
    ),
    "q_preview": _with(
        GRID, "SELECT source_file, row_idx, date, amount FROM grid ORDER BY source_file, row_idx LIMIT 20"
    ),
    # profiles
    "q_profile": _with(
        CASH,
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", '{t}' AS type, count({c}) AS non_null FROM cash"
            for c, t in _CASH_TYPES.items()
        ),
    ),
    "q_summary": _with(STOCK, _describe(["quantity", "unit_price_tnd", "total_amount_tnd"], "stock")
                       + " UNION ALL SELECT 'empty', 0, NULL, NULL, NULL, NULL, NULL, NULL, NULL"),
    # scalar functions
    "q_parse_amount": f"""
      SELECT l_orderkey, l_linenumber, {_PRICE} / 100.0 AS amount, -{_PRICE} / 100.0 AS negative FROM lineitem""",
    "q_amount_lenient": f"""
      SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 4 <> 1 THEN c / 100.0 END AS lenient,
        CASE WHEN c < 100000 THEN c / 100.0 END AS notebook
      FROM (SELECT *, {_PRICE} AS c FROM lineitem)""",
    "q_amount_edges": f"""
      SELECT l_orderkey, l_linenumber, CASE l_orderkey % 8 WHEN 0 THEN c / 100.0
        WHEN 3 THEN CASE WHEN c < 100000 THEN c / 100.0 END WHEN 5 THEN c / 100.0 WHEN 7 THEN -c / 100.0 END AS amount
      FROM (SELECT *, {_PRICE} AS c FROM lineitem)""",
    "q_parse_datetime": "SELECT event_id, date_trunc('second', ts) AS ts FROM events",
    "q_datetime_edges": """
      SELECT event_id, CASE WHEN event_id % 7 IN (0, 1, 4) THEN date_trunc('second', ts) END AS trimmed,
        CASE WHEN event_id % 7 IN (0, 1) THEN date_trunc('second', ts) END AS as_is FROM events""",
    "q_parse_duration": "SELECT event_id, CAST(event_id % 200 AS INTEGER) AS minutes FROM events",
    "q_duration_lenient": """
      SELECT event_id, CAST(CASE WHEN event_id % 4 = 0 THEN h * 60 + m END AS INTEGER) AS strict,
        CAST(CASE event_id % 4 WHEN 0 THEN h * 60 + m WHEN 1 THEN h * 60 WHEN 2 THEN 0 END AS INTEGER) AS lenient,
        CASE event_id % 4 WHEN 0 THEN h * 60.0 + m WHEN 1 THEN h * 60.0 WHEN 2 THEN round(m / 60.0, 6) END::DOUBLE AS timedelta
      FROM (SELECT event_id, event_id % 50 AS h, event_id % 60 AS m FROM events)""",
    "q_duration_edges": """
      SELECT event_id, CAST(CASE event_id % 6 WHEN 0 THEN event_id % 24 * 60 + 3
        WHEN 1 THEN event_id % 10 * 60 + 30 WHEN 2 THEN event_id % 60
        WHEN 5 THEN event_id % 24 * 60 + 5 END AS INTEGER) AS minutes FROM events""",
    "q_extract_terminal": _with(CASH, "SELECT event_id, terminal FROM cash"),
    "q_terminal_edges": """
      SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'A' || event_id || ') (B' WHEN 2 THEN ' ' || event_id || ' ' END
        AS terminal FROM events""",
    "q_markers": """
      SELECT event_id, event_id % 4 = 0 AS is_free_time,
        CASE WHEN event_id % 3 = 0 THEN CAST(event_id % 90 AS INTEGER) END AS paused_minutes FROM events""",
    "q_to_int": """
      SELECT l_orderkey, l_linenumber,
        CAST(CASE l_orderkey % 5 WHEN 0 THEN q WHEN 1 THEN -q WHEN 3 THEN q END AS INTEGER) AS whole,
        CAST(CASE l_orderkey % 5 WHEN 0 THEN q WHEN 1 THEN -q - 0.7 WHEN 3 THEN q END AS DOUBLE) AS number,
        CASE l_orderkey % 5 WHEN 0 THEN q WHEN 1 THEN -q WHEN 3 THEN q END AS id
      FROM (SELECT *, CAST(l_quantity AS BIGINT) AS q FROM lineitem)""",
    "q_classify_terminal": _with(
        SESSIONS,
        """SELECT lower(terminal) AS terminal, CASE WHEN terminal LIKE '%VIP' THEN 'VIP'
          WHEN terminal LIKE 'PS5%' THEN 'PlayStation' WHEN terminal = 'Kiosk 1' THEN 'Other' ELSE 'Computer' END
          AS terminal_type, count(*) AS n FROM sessions GROUP BY 1, 2""",
    ),
    # cleaning
    "q_clean_cash": _with(CASH, f"SELECT {_CASH_OUT} FROM cash"),
    "q_clean_sessions": _with(SESSIONS, "SELECT * FROM sessions"),
    "q_clean_stock": _with(STOCK, "SELECT * FROM stock"),
    "q_clean_members": _with(MEMBERS, "SELECT * FROM members"),
    "q_rejects": """
      SELECT 'cash' AS "table", 'events' AS source_file, CAST(event_id AS INTEGER) AS row_idx, 'amount' AS "column",
        '12,3,4 TND' AS raw_value FROM events WHERE event_id % 50 = 0
      UNION ALL SELECT 'cash', 'events', CAST(event_id AS INTEGER), 'date', '31.02.2024 00:00:00'
        FROM events WHERE event_id % 75 = 0""",
    "q_row_quality": """
      SELECT 'cashier_' || (l_suppkey % 7) AS cashier, l_quantity AS quantity, '1,00 TND' AS unit_price,
        CASE WHEN l_orderkey % 10 = 6 THEN 'TOTAL AMOUNT' ELSE '2,00 TND' END AS total_amount
      FROM lineitem WHERE l_orderkey % 10 NOT IN (0, 1, 2, 3, 4, 5) AND l_quantity > 0""",
    "q_columns_quality": f"""
      SELECT 'cashier_' || (o_custkey % 7) AS "Cashier", o_orderdate AS "Date", c / 100.0 AS "Amount",
        {_money('c')} AS "Amount_raw"
      FROM (SELECT *, {_cents('o_totalprice')} AS c FROM orders)""",
    # star schema
    "q_dim_cashier": _with(CASH, SESSIONS, STOCK, DIM_CASHIER, "SELECT * FROM dim_cashier"),
    "q_dim_terminal": _with(CASH, SESSIONS, STOCK, DIM_TERMINAL, "SELECT * FROM dim_terminal"),
    "q_dim_item": _with(STOCK, DIM_ITEM, "SELECT * FROM dim_item"),
    "q_dim_member": _with(MEMBERS, DIM_MEMBER, "SELECT * FROM dim_member"),
    "q_dim_ordinals_bucketed": """
      SELECT row_number() OVER (ORDER BY l_partkey, l_suppkey DESC) AS pair_id, l_partkey, l_suppkey
      FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)""",
    "q_fact_cash": _with(CASH, SESSIONS, STOCK, DIM_CASHIER, DIM_TERMINAL, FACT_CASH, "SELECT * FROM fact_cash"),
    "q_fact_sessions": _with(
        CASH, SESSIONS, STOCK, DIM_CASHIER, DIM_TERMINAL, FACT_SESSIONS, "SELECT * FROM fact_sessions"
    ),
    "q_fact_stock": _with(
        CASH, SESSIONS, STOCK, DIM_CASHIER, DIM_TERMINAL, DIM_ITEM, FACT_STOCK, "SELECT * FROM fact_stock"
    ),
    "q_fact_members": _with(MEMBERS, FACT_MEMBERS, "SELECT * FROM fact_members"),
    "q_income_by_terminal": _with(
        CASH, SESSIONS, STOCK, DIM_TERMINAL,
        f"""SELECT cashier AS cashier_name, terminal_type, {_total('amount_tnd')} AS income_tnd,
          CAST(count(*) AS BIGINT) AS transactions
        FROM cash LEFT JOIN dim_terminal ON terminal = terminal_name
        WHERE income_expense = 'Income' GROUP BY 1, 2""",
    ),
    "q_fk_last_wins": """
      WITH items AS (SELECT row_number() OVER (ORDER BY p_type, p_name) AS item_id, p_name
                     FROM (SELECT DISTINCT p_name, p_type FROM part))
      SELECT p_partkey, max(item_id) AS item_id FROM part JOIN items USING (p_name) GROUP BY 1""",
    "q_fk_null_key": _with(
        CASH, SESSIONS, STOCK, DIM_CASHIER, DIM_TERMINAL, DIM_ITEM, FACT_STOCK,
        """SELECT in_out, count(*) AS n, count(*) - count(item_id) AS no_item,
          count(*) - count(terminal_id) AS no_terminal, CAST(sum(item_id) AS BIGINT) AS item_sum
        FROM fact_stock GROUP BY 1""",
    ),
    "q_fk_untrimmed": _with(
        CASH, SESSIONS, STOCK, DIM_TERMINAL,
        """SELECT terminal, count(*) AS n, max(a.terminal_id) AS as_is, max(b.terminal_id) AS stripped
        FROM cash LEFT JOIN dim_terminal a ON terminal = a.terminal_name
        LEFT JOIN dim_terminal b ON trim(terminal) = b.terminal_name GROUP BY 1""",
    ),
    "q_relationships": _with(*ALL_CLEAN, *ALL_DIMS, *ALL_FACTS, _relations()),
    "q_integrity": _with(*ALL_CLEAN, *ALL_DIMS, _key_report()),
    "q_orphans": """
      SELECT o_custkey, count(*) AS n FROM orders
      WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 9) GROUP BY 1""",
    "q_table_counts": _with(*ALL_CLEAN, *ALL_DIMS, _counts()),
    # exploration
    "q_member_activity": _with(
        MEMBERS, "SELECT firstname, lastname, count(*) AS n FROM members GROUP BY 1, 2"
    ),
    "q_member_usage": _with(
        MEMBERS, f"SELECT firstname, lastname, {_total('usage_tnd')} AS total FROM members GROUP BY 1, 2"
    ),
    "q_top_members": _with(
        MEMBERS,
        "SELECT username, total_amount_tnd FROM members ORDER BY total_amount_tnd DESC, username LIMIT 10",
    ),
    "q_frequency": _with(
        SESSIONS,
        """SELECT 'cashier' AS field, cashier AS value, count(*) AS n FROM sessions GROUP BY 2
        UNION ALL SELECT 'session_type', session_type, count(*) FROM sessions GROUP BY 2""",
    ),
    "q_top_items": _with(
        STOCK,
        f"""SELECT item_name, {_total('total_amount_tnd')} AS total FROM stock WHERE item_name IS NOT NULL
        GROUP BY 1 ORDER BY total DESC, item_name LIMIT 10""",
    ),
    "q_cashier_total": _with(
        SESSIONS, f"SELECT cashier, {_total('total_amount_tnd')} AS total FROM sessions GROUP BY 1"
    ),
    "q_avg_duration": _with(
        SESSIONS,
        """SELECT session_type, CAST(sum(duration_minutes) AS DOUBLE) / count(*) AS avg_minutes
        FROM sessions GROUP BY 1""",
    ),
    "q_daily_total": _with(
        STOCK, f"SELECT CAST(date AS DATE) AS day, {_total('total_amount_tnd')} AS total FROM stock GROUP BY 1"
    ),
    "q_category_total": _with(
        STOCK,
        f"SELECT category, {_total('total_amount_tnd')} AS total FROM stock WHERE category IS NOT NULL GROUP BY 1",
    ),
    "q_share": _with(
        STOCK,
        f"""SELECT in_out, {_total('total_amount_tnd')} AS total,
          round({_total('total_amount_tnd')} / (SELECT {_total('total_amount_tnd')} FROM stock) * 100, 1) AS share_pct
        FROM stock GROUP BY 1""",
    ),
    "q_histogram_15": _histogram("duration_minutes", "members", MEMBERS, 15),
    "q_histogram_20": _histogram("usage_tnd", "sessions", SESSIONS, 20),
    "q_duration_usage_corr": _with(
        MEMBERS,
        """SELECT round(corr(duration_minutes, usage_tnd), 6) AS corr,
          round(regr_slope(usage_tnd, duration_minutes), 6) AS slope,
          round(regr_intercept(usage_tnd, duration_minutes), 6) AS intercept FROM members""",
    ),
    # series and forecasts
    "q_week_bucket": f"""
      SELECT {_sunday('CAST(o_orderdate AS DATE)')} AS week, count(*) AS n FROM orders GROUP BY 1""",
    "q_revenue_series": _with(CASH, REVENUE, "SELECT ds, y FROM revenue"),
    "q_revenue_weekly": _with(
        CASH, REVENUE, f"SELECT {_sunday('ds')} AS ds, {_total('y')} AS y FROM revenue GROUP BY 1"
    ),
    "q_consumption_series": _with(STOCK, SOLD, _dense("sold", "D"), "SELECT * FROM series"),
    "q_consumption_weekly": _with(STOCK, SOLD, _dense("sold", "W"), "SELECT * FROM series"),
    "q_series_skipped": _with(
        """sold AS (
          SELECT p_name || ' ' || p_brand AS item_name, CAST(l_shipdate AS DATE) AS ds, sum(l_quantity) AS y
          FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag <> 'R' GROUP BY 1, 2)""",
        _dense("sold", "W"),
        "SELECT item_name, nonzero, nonzero >= 14 AS kept FROM periods",
    ),
    "q_avg_price": _with(STOCK, PRICES, "SELECT item_name, round(avg_price, 6) AS avg_price FROM prices"),
    "q_derived_revenue": _with(
        STOCK, SOLD, _dense("sold", "W"), PRICES,
        """SELECT ds AS date, round(sum(y * coalesce(avg_price, 0)), 3) AS derived_revenue_tnd
        FROM series LEFT JOIN prices USING (item_name) GROUP BY 1""",
    ),
    "q_forecast_revenue": _with(
        *BOTH_FORECASTS,
        """SELECT r.ds AS date, round(r.yhat, 3) AS direct_revenue_tnd, round(r.low, 3) AS direct_lower_tnd,
          round(r.high, 3) AS direct_upper_tnd, round(coalesce(d.v, 0), 3) AS derived_revenue_tnd
        FROM revenue_fc r LEFT JOIN (
          SELECT ds, sum(yhat * coalesce(avg_price, 0)) AS v
          FROM items_fc LEFT JOIN prices ON k = item_name GROUP BY 1) d ON d.ds = r.ds""",
    ),
    "q_forecast_consumption": _with(
        STOCK, SOLD, _dense("sold", "D"), _model("fc", "series", "item_name", 30, "D"),
        """SELECT ds AS date, k AS item_name, round(yhat, 4) AS predicted_qty, round(low, 4) AS lower_qty,
          round(high, 4) AS upper_qty FROM fc""",
    ),
    "q_forecast_weekly": _with(
        STOCK, SOLD, _dense("sold", "W"), _model("fc", "series", "item_name", 8, "W"),
        """SELECT ds AS date, k AS item_name, round(yhat, 4) AS predicted_qty, round(low, 4) AS lower_qty,
          round(high, 4) AS upper_qty FROM fc""",
    ),
    "q_forecast_trend": _with(
        ORDER_DAYS,
        """bent AS (
          SELECT o_orderpriority, ds, CASE WHEN known THEN 10 * orders + greatest(since - 400 * left(o_orderpriority, 1)::INT, 0) ELSE 0 END AS y
          FROM order_series)""",
        _model("fc", "bent", "o_orderpriority", 30, "D"),
        """SELECT k AS o_orderpriority, ds, round(yhat, 4) AS yhat, round(low, 4) AS yhat_lower, round(high, 4) AS yhat_upper FROM fc""",
    ),
    "q_forecast_edges": _with(
        ORDER_DAYS,
        """scaled AS (
          SELECT scale || '|' || o_orderpriority AS key, ds, orders * factor AS y
          FROM order_series, (VALUES ('large', 1e20::DOUBLE), ('small', 1e-6::DOUBLE)) AS f(scale, factor))""",
        _model("fc", "scaled", "key", 7, "D"),
        """SELECT split_part(k, '|', 1) AS scale, split_part(k, '|', 2) AS o_orderpriority, ds, round(yhat / f, 4) AS yhat,
          round(low / f, 4) AS yhat_lower, round(high / f, 4) AS yhat_upper
        FROM (SELECT *, CASE WHEN starts_with(k, 'large') THEN 1e20::DOUBLE ELSE 1e-6::DOUBLE END AS f FROM fc)""",
    ),
    "q_forecast_coverage": _with(
        STOCK, SOLD, _dense("sold", "D"),
        "early AS (SELECT * FROM series WHERE ds <= (SELECT max(ds) FROM series) - 30)",
        _model("fc", "early", "item_name", 30, "D"),
        """SELECT s.item_name, count(*) AS periods, count(*) FILTER (y >= low AND y <= high) AS inside
        FROM fc JOIN series s ON s.item_name = fc.k AND s.ds = fc.ds GROUP BY 1""",
    ),
    "q_forecast_summary": _with(
        *BOTH_FORECASTS,
        "best AS (SELECT k AS entry, sum(yhat) AS value FROM items_fc GROUP BY 1 ORDER BY value DESC, entry LIMIT 10)",
        """SELECT entry, round(value, 3) AS value FROM best
        UNION ALL SELECT 'direct_revenue_tnd', round(sum(yhat), 3) FROM revenue_fc
        UNION ALL SELECT 'direct_lower_tnd', round(sum(low), 3) FROM revenue_fc
        UNION ALL SELECT 'direct_upper_tnd', round(sum(high), 3) FROM revenue_fc
        UNION ALL SELECT item_name, nonzero::DOUBLE FROM periods WHERE nonzero < 14""",
    ),
    "q_money_precision": f"""
      SELECT l_returnflag, sum({_cents('l_extendedprice')})::BIGINT / 1000.0::DOUBLE AS total FROM lineitem GROUP BY 1""",
    "q_member_report": f"""
      SELECT c_mktsegment AS "Class", sum(abs(c) % 300)::BIGINT / 100.0::DOUBLE AS traded, sum(2 * c)::BIGINT / 100.0::DOUBLE AS usage
      FROM (SELECT *, {_cents('c_acctbal')} AS c FROM customer) GROUP BY 1""",
    "q_member_account": """
      SELECT 'rows_in' AS part, count(*) AS rows FROM customer
      UNION ALL SELECT 'kept', count(*) FROM customer WHERE c_custkey % 10 <> 9
      UNION ALL SELECT 'dropped', count(*) FROM customer WHERE c_custkey % 10 = 9""",
    "q_roundtrip_names": f"""
      SELECT 'item' AS kind, p_partkey AS id, {_hard('p_partkey', 'p_name')} AS name, p_type AS other FROM part
      UNION ALL SELECT 'member', c_custkey, {_hard('c_custkey', 'c_name')}, ' x ' FROM customer""",
    "q_run_etl": _with(
        *ALL_CLEAN, *ALL_DIMS, FACT_STOCK,
        _counts() + " UNION ALL SELECT 'sum item_id', sum(item_id)::BIGINT FROM fact_stock"
        " UNION ALL SELECT 'sum quantity', sum(quantity)::BIGINT FROM fact_stock"
        " UNION ALL SELECT 'sum terminal_id', count(terminal_id) FROM fact_stock",
    ),
    "q_run_etl_text": _with(*ALL_CLEAN, *ALL_DIMS, _counts()),
}
# What is written and read back is the table itself.
ORACLE["q_roundtrip_csv"] = ORACLE["q_fact_sessions"]
ORACLE["q_roundtrip_parquet"] = ORACLE["q_fact_cash"]
ORACLE["q_fact_stock_large"] = ORACLE["q_fact_stock"]
ORACLE["q_relationships_json"] = (
    f"SELECT * FROM ({ORACLE['q_relationships']}) WHERE \"fromTable\" = 'fact_sessions'"
)
ORACLE["q_run_forecast"] = (
    f"SELECT r.*, n.items FROM ({ORACLE['q_forecast_revenue']}) r LEFT JOIN "
    f"(SELECT date, count(*) AS items FROM ({ORACLE['q_forecast_consumption']}) GROUP BY 1) n USING (date)"
)
