"""The queries of ``__spark_entry__`` as plain SQL over the same tables."""

from __future__ import annotations

# The ledger: one CTE per step, each over whole tables.
LEDGER = """
lines(display_order, cash_flow_section, business_activity, reporting_line, cash_direction,
      id_prefix, driver_kind) AS (VALUES
  (1, 'Operating', 'Orders', 'Order cash received', 'inflow', 'FCST-ORD', 'recurring'),
  (2, 'Operating', 'Supply', 'Parts paid', 'outflow', 'FCST-PART', 'recurring'),
  (3, 'Operating', 'Corporate', 'Overhead paid', 'outflow', 'FCST-OH', 'recurring'),
  (4, 'Investing', 'Expansion', 'Buildout paid', 'outflow', 'FCST-BLD', 'last_month'),
  (5, 'Investing', 'Supply', 'Equipment paid', 'outflow', 'FCST-EQ', 'plan_only'),
  (6, 'Financing', 'Credit', 'Credit drawn', 'inflow', 'FCST-CRD', 'plan_only')
),
mapping(source, category, business_activity, cash_flow_section, reporting_line) AS (VALUES
  ('Receipts', 'f', 'Orders', 'Operating', 'Order cash received'),
  ('Operating payments', 'SMALL', 'Supply', 'Operating', 'Parts paid'),
  ('Operating payments', 'MEDIUM', 'Supply', 'Operating', 'Parts paid'),
  ('Operating payments', 'ECONOMY', 'Corporate', 'Operating', 'Overhead paid'),
  ('Operating payments', 'STANDARD', 'Corporate', 'Operating', 'Overhead paid'),
  ('Capital payments', 'LARGE', 'Expansion', 'Investing', 'Buildout paid'),
  ('Capital payments', 'PROMO', 'Supply', 'Investing', 'Equipment paid'),
  ('Credits', 'r', 'Credit', 'Financing', 'Credit drawn')
),
records AS (
  SELECT coalesce(CAST(c_nationkey AS VARCHAR), 'unknown') AS entity_id,
         'ORD-' || CAST(o_orderkey AS VARCHAR) AS transaction_id,
         'Order desk' AS source_system, 'orders.parquet' AS source_file, 'Receipts' AS source,
         lower(trim(o_orderstatus)) AS source_category, '' AS vendor,
         CAST(o_orderdate AS DATE) AS cash_date, 'inflow' AS cash_direction,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
         upper(trim(o_orderstatus)) AS status
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
  UNION ALL
  SELECT coalesce(CAST(s_nationkey AS VARCHAR), 'unknown'),
         'LIN-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-'
           || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR),
         CASE WHEN l_returnflag = 'R' THEN 'Credit desk'
              WHEN p_type IN ('LARGE', 'PROMO') THEN 'Capital projects'
              ELSE 'Accounts payable' END,
         'lineitem.parquet',
         CASE WHEN l_returnflag = 'R' THEN 'Credits'
              WHEN p_type IN ('LARGE', 'PROMO') THEN 'Capital payments'
              ELSE 'Operating payments' END,
         CASE WHEN l_returnflag = 'R' THEN lower(trim(l_returnflag)) ELSE trim(p_type) END,
         trim(s_name), CAST(l_shipdate AS DATE),
         CASE WHEN l_returnflag = 'R' THEN 'inflow' ELSE 'outflow' END,
         CAST(l_extendedprice AS DECIMAL(18,2)), upper(trim(l_linestatus))
  FROM lineitem
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
),
kept AS (SELECT * FROM records WHERE status = 'F'),
signed AS (
  SELECT k.*, m.business_activity, m.cash_flow_section, m.reporting_line,
         CAST(date_trunc('month', k.cash_date) AS DATE) AS reporting_month,
         CASE WHEN k.cash_direction = 'inflow' THEN k.amount ELSE -k.amount END AS signed_amount
  FROM kept k
  LEFT JOIN mapping m ON m.source = k.source AND m.category = k.source_category
),
ledger AS (
  SELECT *, CAST(CAST(signed_amount AS DOUBLE) AS BIGINT) AS signed_amount_usd FROM signed
),
actuals AS (
  SELECT * FROM ledger
  WHERE year(cash_date) = 2000 AND month(cash_date) <= 9
),
opening AS (
  SELECT coalesce(CAST(c_nationkey AS VARCHAR), 'unknown') AS entity_id,
         'ACCT-' || coalesce(CAST(c_nationkey AS VARCHAR), 'unknown') AS account_id,
         DATE '1999-12-31' AS balance_date, 'USD' AS currency,
         CAST(CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS BIGINT)
           AS available_balance_usd
  FROM customer GROUP BY c_nationkey
)"""

# Forecast and report on top of it.
REPORT = """
entities AS (SELECT entity_id FROM opening UNION SELECT entity_id FROM actuals),
months AS (
  SELECT CAST(DATE '2000-01-01' + CAST(g.n AS INTEGER) * INTERVAL 1 MONTH AS DATE)
           AS reporting_month, g.n >= 9 AS is_open
  FROM generate_series(0, 20) AS g(n)
),
closed_totals AS (
  SELECT entity_id, reporting_line, reporting_month, sum(signed_amount_usd) AS total
  FROM actuals GROUP BY ALL
),
run_rate AS (
  SELECT entity_id, reporting_line, CAST(round(sum(total) / 3.0) AS BIGINT) AS amount_usd
  FROM closed_totals SEMI JOIN (FROM lines WHERE driver_kind = 'recurring') USING (reporting_line)
  WHERE reporting_month IN (DATE '2000-07-01', DATE '2000-08-01', DATE '2000-09-01')
  GROUP BY ALL
),
last_active AS (
  SELECT entity_id, reporting_line, CAST(arg_max(total, reporting_month) AS BIGINT) AS amount_usd
  FROM closed_totals SEMI JOIN (FROM lines WHERE driver_kind = 'last_month') USING (reporting_line)
  GROUP BY ALL
),
plan AS (
  SELECT CAST(n.n_nationkey AS VARCHAR) AS entity_id, p.reporting_month, p.reporting_line,
         CAST((n.n_nationkey + 1) * 1000 * p.factor AS BIGINT) AS amount_usd
  FROM nation n CROSS JOIN (VALUES
    (DATE '2000-11-01', 'Equipment paid', -5),
    (DATE '2001-02-01', 'Credit drawn', 20),
    (DATE '2001-02-01', 'Overhead paid', -1),
    (DATE '2003-01-01', 'Credit drawn', 7),
    (DATE '2000-12-01', 'Unlisted line', 3)
  ) AS p(reporting_month, reporting_line, factor)
  {plan_filter}
),
grid AS (
  SELECT e.entity_id, m.reporting_month, m.is_open, l.*
  FROM entities e, months m, lines l
),
projected AS (
  SELECT g.entity_id, g.id_prefix || strftime(g.reporting_month, '-%Y-%m') AS transaction_id,
         'Forecast' AS source_system,
         if(p.amount_usd IS NULL, 'forecast_scenario.csv', 'plan_schedule.csv') AS source_file,
         g.reporting_line AS source_category, '' AS vendor, g.reporting_month AS cash_date,
         g.reporting_month, g.business_activity, g.cash_flow_section, g.reporting_line,
         g.cash_direction,
         CAST(coalesce(p.amount_usd, r.amount_usd, a.amount_usd, 0) AS BIGINT)
           AS signed_amount_usd
  FROM grid g
  LEFT JOIN plan p USING (entity_id, reporting_month, reporting_line)
  LEFT JOIN run_rate r USING (entity_id, reporting_line)
  LEFT JOIN last_active a USING (entity_id, reporting_line)
  WHERE g.is_open
),
cash AS (
  SELECT entity_id, reporting_month, cash_flow_section, business_activity, reporting_line,
         signed_amount_usd FROM actuals
  UNION ALL
  SELECT entity_id, reporting_month, cash_flow_section, business_activity, reporting_line,
         signed_amount_usd FROM projected
),
monthly_lines AS (
  SELECT entity_id, reporting_month, g.cash_flow_section, g.business_activity, reporting_line,
         CAST(coalesce(c.total, 0) AS BIGINT) AS signed_amount_usd, g.display_order,
         if(g.is_open, 'Forecast', 'Actual') AS amount_type
  FROM grid g
  LEFT JOIN (SELECT entity_id, reporting_month, reporting_line, sum(signed_amount_usd) AS total
             FROM cash GROUP BY ALL) c USING (entity_id, reporting_month, reporting_line)
),
wide AS (
  SELECT entity_id, reporting_month, amount_type,
    {line_columns}
  FROM monthly_lines GROUP BY ALL
),
section_sums AS (
  SELECT entity_id, reporting_month,
    {section_columns},
    CAST(sum(signed_amount_usd) AS BIGINT) AS net_change_in_cash
  FROM monthly_lines GROUP BY ALL
),
nets AS (SELECT * FROM wide JOIN section_sums USING (entity_id, reporting_month)),
summary AS (
  SELECT n.*, CAST(o.available_balance_usd + n.so_far - n.net_change_in_cash AS BIGINT)
           AS beginning_cash,
         CAST(o.available_balance_usd + n.so_far AS BIGINT) AS ending_cash
  FROM (SELECT *, sum(net_change_in_cash) OVER (PARTITION BY entity_id ORDER BY reporting_month)
          AS so_far FROM nets) n
  LEFT JOIN opening o USING (entity_id)
),
top_ids AS (
  SELECT entity_id, reporting_line, transaction_id FROM (
    SELECT *, row_number() OVER (PARTITION BY entity_id, reporting_line
                                 ORDER BY abs(signed_amount) DESC, transaction_id) AS rn
    FROM actuals) WHERE rn = 1
)"""

LINE_COLUMNS = {
    "order_cash_received": "Order cash received",
    "parts_paid": "Parts paid",
    "overhead_paid": "Overhead paid",
    "buildout_paid": "Buildout paid",
    "equipment_paid": "Equipment paid",
    "credit_drawn": "Credit drawn",
}
SECTION_COLUMNS = {
    "net_operating_cash_flow": "Operating",
    "net_investing_cash_flow": "Investing",
    "net_financing_cash_flow": "Financing",
}

TRANSACTIONS = """entity_id, transaction_id, source_system, source_file, source_category, vendor,
  cash_date, reporting_month, business_activity, cash_flow_section, reporting_line,
  cash_direction, signed_amount_usd"""

SIDE_BY_SIDE = """
SELECT {keys}, report_usd, ledger_usd,
  CAST(coalesce(report_usd, 0) - coalesce(ledger_usd, 0) AS BIGINT) AS difference_usd,
  coalesce(report_usd = coalesce(ledger_usd, 0), false) AS agrees
FROM (SELECT {keys}, CAST(sum(signed_amount_usd) AS BIGINT) AS report_usd
      FROM {report} GROUP BY {keys})
FULL JOIN (SELECT {keys}, CAST(sum(signed_amount_usd) AS BIGINT) AS ledger_usd
      FROM {ledger} GROUP BY {keys}) USING ({keys})"""

# One row per ledger id: how often it is booked, and its first occurrence. Only ids that
# are booked more than once are put in order.
BOOKED = """
booked AS MATERIALIZED (
  SELECT b.transaction_id, b.source_category, b.business_activity, b.cash_flow_section,
    b.signed_amount_usd, reporting_month, reporting_line, l.signed_amount_usd AS line_amount_usd
  FROM actuals b LEFT JOIN monthly_lines l USING (entity_id, reporting_month, reporting_line)
  WHERE b.transaction_id IS NOT NULL {asked}
),
times AS MATERIALIZED (SELECT transaction_id, count(*) AS ledger_rows FROM booked GROUP BY transaction_id),
first_booked AS MATERIALIZED (
  SELECT booked.*, ledger_rows FROM booked JOIN times USING (transaction_id) WHERE ledger_rows = 1
  UNION ALL
  SELECT * EXCLUDE (place) FROM (
    SELECT booked.*, ledger_rows, row_number() OVER (PARTITION BY transaction_id
        ORDER BY reporting_month NULLS FIRST, source_category NULLS FIRST, business_activity NULLS FIRST,
        cash_flow_section NULLS FIRST, reporting_line NULLS FIRST, signed_amount_usd NULLS FIRST,
        line_amount_usd NULLS FIRST) AS place
    FROM booked JOIN times USING (transaction_id) WHERE ledger_rows > 1) WHERE place = 1
)"""

TRACE = """
SELECT r.entity_id, r.transaction_id, r.source, r.status, r.vendor, r.cash_date,
  r.source_category, CAST(r.amount * 100 AS BIGINT) AS amount_cents,
  m.cash_flow_section AS rule_section, m.business_activity AS rule_activity,
  m.reporting_line AS rule_line,
  coalesce(a.ledger_rows, 0) AS ledger_rows, a.reporting_month, a.reporting_line,
  a.signed_amount_usd, a.line_amount_usd,
  coalesce(a.ledger_rows = 1, false) AS booked_once,
  a.transaction_id IS NOT NULL AND m.reporting_line IS NOT NULL
    AND a.source_category IS NOT DISTINCT FROM r.source_category
    AND a.business_activity IS NOT DISTINCT FROM m.business_activity
    AND a.cash_flow_section IS NOT DISTINCT FROM m.cash_flow_section
    AND a.reporting_line IS NOT DISTINCT FROM m.reporting_line AS rule_agrees,
  CASE WHEN r.status IS DISTINCT FROM 'F' THEN 'status not kept'
       WHEN m.reporting_line IS NULL THEN 'unmapped'
       WHEN a.transaction_id IS NULL THEN 'not in ledger'
       WHEN a.line_amount_usd IS NULL THEN 'not reported'
       ELSE 'reported' END AS outcome
FROM records r
LEFT JOIN mapping m ON m.source = r.source AND m.category = r.source_category
LEFT JOIN first_booked a ON a.transaction_id = r.transaction_id
{asked}"""

FEEDS = """
WITH order_feed AS (
  SELECT 'ORD-' || o_orderkey AS id, o_custkey, o_orderkey % 211 = 17 AS bad_customer,
    CASE WHEN o_orderkey % 97 = 5 THEN 'n/a' END AS bad_price, o_orderkey % 97 = 6 AS no_price,
    CASE o_orderkey % 89 WHEN 3 THEN strftime(o_orderdate, '%Y') || '-13-01'
      WHEN 4 THEN strftime(o_orderdate, '%Y') END AS bad_day,
    CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(o_orderdate AS DATE) AS day
  FROM orders
),
item_feed AS (
  SELECT 'LIN-' || l_orderkey || '-' || l_linenumber AS id, l_orderkey % 101 = 7 AS bad_quantity,
    l_orderkey % 103 = 7 AS bad_price, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
    CAST(l_shipdate AS DATE) AS day
  FROM lineitem
)"""

WHAT_IF = """
quantities AS (
  SELECT coalesce(CAST(s_nationkey AS VARCHAR), 'unknown') AS entity_id,
    CASE WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'Parts paid' ELSE 'Overhead paid' END AS reporting_line,
    CAST(sum(CAST(l_quantity AS DECIMAL(18,4))) AS DECIMAL(18,4)) AS quantity
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
  WHERE upper(trim(l_linestatus)) = 'F' AND coalesce(l_returnflag, '') <> 'R'
    AND trim(p_type) IN ('SMALL', 'MEDIUM', 'ECONOMY', 'STANDARD')
    AND l_shipdate >= TIMESTAMP '2000-07-01' AND l_shipdate < TIMESTAMP '2000-10-01'
  GROUP BY 1, 2
),
changed_lines AS (
  SELECT w.what_if, g.entity_id, g.reporting_month, g.reporting_line, g.cash_flow_section,
    if(g.is_open, 'Forecast', 'Actual') AS amount_type,
    CAST(CASE WHEN NOT g.is_open THEN coalesce(c.total, 0)
      ELSE coalesce(p.amount_usd,
        CASE WHEN w.what_if = 'more orders' AND g.reporting_line = 'Order cash received'
               THEN CAST(round_even(r.amount_usd * 1.1, 0) AS BIGINT)
             WHEN w.what_if = 'dearer parts' AND g.reporting_line = 'Order cash received'
               THEN CAST(round_even(r.amount_usd * 0.85, 0) AS BIGINT)
             WHEN w.what_if = 'dearer parts' AND g.reporting_line = 'Parts paid'
               THEN CAST(round_even(r.amount_usd * 1.0375 * 1.2, 0) AS BIGINT)
             WHEN w.what_if = 'list price' AND g.reporting_line = 'Parts paid'
               THEN CAST(round_even(-(q.quantity * 0.5 * 1234.5) / 3, 0) AS BIGINT)
             ELSE coalesce(r.amount_usd, a.amount_usd) END, 0) END AS BIGINT) AS signed_amount_usd
  FROM grid g
  CROSS JOIN (VALUES ('as is'), ('more orders'), ('dearer parts'), ('list price')) AS w(what_if)
  LEFT JOIN plan p ON p.entity_id = g.entity_id AND p.reporting_month = g.reporting_month
    AND p.reporting_line = g.reporting_line
  LEFT JOIN run_rate r ON r.entity_id = g.entity_id AND r.reporting_line = g.reporting_line
  LEFT JOIN last_active a ON a.entity_id = g.entity_id AND a.reporting_line = g.reporting_line
  LEFT JOIN quantities q ON q.entity_id = g.entity_id AND q.reporting_line = g.reporting_line
  LEFT JOIN closed_totals c ON c.entity_id = g.entity_id AND c.reporting_month = g.reporting_month
    AND c.reporting_line = g.reporting_line
)"""

# Growth by month: each factor is the one before times 1 + rate, at twelve decimal places.
GROWN = """
grown(reporting_line, rate, reporting_month, factor) AS (
  SELECT reporting_line, rate, DATE '2000-10-01', CAST(1 + rate AS DECIMAL(17,12))
  FROM (VALUES ('Order cash received', CAST(0.015 AS DECIMAL(5,4))), ('Overhead paid', CAST(0.0325 AS DECIMAL(5,4))))
    AS v(reporting_line, rate)
  UNION ALL
  SELECT reporting_line, rate, CAST(reporting_month + INTERVAL 1 MONTH AS DATE),
    CAST(factor * (1 + rate) AS DECIMAL(17,12))
  FROM grown WHERE reporting_month < DATE '2001-09-01'
)"""

BACKTEST = """
SELECT close_month, CAST(months_ahead AS INTEGER) AS months_ahead, reporting_line, count(*) AS n_cells,
  CAST(sum(forecast) AS BIGINT) AS forecast_usd, CAST(sum(actual) AS BIGINT) AS actual_usd,
  CAST(sum(forecast - actual) AS BIGINT) AS bias_usd,
  CAST(sum(abs(forecast - actual)) AS BIGINT) AS absolute_error_usd,
  CASE WHEN sum(abs(actual)) > 0
    THEN CAST(sum(abs(forecast - actual)) * 1000 // sum(abs(actual)) AS BIGINT) END AS error_milli
FROM (
  SELECT c.close_month, datediff('month', c.close_month, m.reporting_month) AS months_ahead, l.reporting_line,
    CAST(coalesce(CASE l.driver_kind
      WHEN 'recurring' THEN (SELECT round(sum(t.total) / 3.0) FROM closed_totals t
        WHERE t.entity_id = e.entity_id AND t.reporting_line = l.reporting_line
          AND t.reporting_month <= c.close_month AND t.reporting_month > c.close_month - INTERVAL 3 MONTH)
      ELSE (SELECT arg_max(t.total, t.reporting_month) FROM closed_totals t
        WHERE t.entity_id = e.entity_id AND t.reporting_line = l.reporting_line
          AND t.reporting_month <= c.close_month) END, 0) AS BIGINT) AS forecast,
    CAST(coalesce(a.total, 0) AS BIGINT) AS actual
  FROM entities e
  CROSS JOIN (SELECT reporting_month AS close_month FROM months WHERE NOT is_open) c
  JOIN months m ON NOT m.is_open AND m.reporting_month > c.close_month
  CROSS JOIN (SELECT * FROM lines WHERE driver_kind <> 'plan_only') l
  LEFT JOIN closed_totals a ON a.entity_id = e.entity_id AND a.reporting_line = l.reporting_line
    AND a.reporting_month = m.reporting_month
  WHERE c.close_month >= DATE '2000-03-01')
GROUP BY 1, 2, 3"""

SCENARIO_CHECKS = """
WITH proposed AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS entity_id, n_nationkey AS k, unnest(range(1, n_nationkey % 3 + 1)) AS row
  FROM nation
),
rows AS (
  SELECT entity_id, k - 4 + row AS a, if(k % 4 = 0, 0, 12) AS f,
    (k - 4 + row) || '+' || if(k % 4 = 0, 0, 12) AS wanted,
    CASE WHEN k % 5 = 0 THEN NULL WHEN k % 7 = 2 THEN '9+12' ELSE (k - 4 + row) || '+' || if(k % 4 = 0, 0, 12) END AS name
  FROM proposed
),
found AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS entity_id, count(r.entity_id) AS n, count(r.name) AS complete,
    count(*) FILTER (WHERE a NOT BETWEEN 1 AND 12 OR f < 1) AS bad_months,
    min(wanted) FILTER (WHERE a NOT BETWEEN 1 AND 12 OR f < 1) AS worst,
    count(*) FILTER (WHERE name <> wanted) AS bad_names,
    min(name) FILTER (WHERE name <> wanted) AS name, min(wanted) FILTER (WHERE name <> wanted) AS wanted
  FROM nation LEFT JOIN rows r ON r.entity_id = CAST(n_nationkey AS VARCHAR) GROUP BY n_nationkey
)
SELECT entity_id, 'scenario' AS stage, check_id, ord, CAST(violations AS BIGINT) AS violations, observed, expected,
  violations = 0 AS passed
FROM (
  SELECT entity_id, 'scenario_rows' AS check_id, 1 AS ord, if(n = 1, 0, 1) AS violations,
    CAST(n AS VARCHAR) AS observed, '1' AS expected FROM found
  UNION ALL SELECT entity_id, 'scenario_complete', 2, n - complete, CAST(complete AS VARCHAR), CAST(n AS VARCHAR) FROM found
  UNION ALL SELECT entity_id, 'scenario_months', 3, bad_months, coalesce(worst, CAST(bad_months AS VARCHAR)),
    '1..12 closed, 1 or more open' FROM found
  UNION ALL SELECT entity_id, 'scenario_name', 4, bad_names, coalesce(name, CAST(bad_names AS VARCHAR)),
    coalesce(wanted, 'as its months') FROM found)"""

MEASURES = """
  CAST(sum(CASE WHEN cash_direction = 'inflow' THEN signed_amount_usd ELSE 0 END) AS BIGINT) AS cash_inflow,
  CAST(sum(CASE WHEN cash_direction = 'outflow' THEN signed_amount_usd ELSE 0 END) AS BIGINT) AS cash_outflow,
  CAST(sum(signed_amount_usd) AS BIGINT) AS net_cash_movement, count(*) AS n_transactions"""

SECTION_SIDES = """
reported_sections AS (
  SELECT entity_id, reporting_month, 'Operating' AS measure, net_operating_cash_flow AS signed_amount_usd FROM summary
  UNION ALL SELECT entity_id, reporting_month, 'Investing', net_investing_cash_flow FROM summary
  UNION ALL SELECT entity_id, reporting_month, 'Financing', net_financing_cash_flow FROM summary
  UNION ALL SELECT entity_id, reporting_month, 'Net change', net_change_in_cash FROM summary
),
booked_sections AS (
  SELECT entity_id, reporting_month, cash_flow_section AS measure, signed_amount_usd FROM cash
  UNION ALL SELECT entity_id, reporting_month, 'Net change', signed_amount_usd FROM cash
)"""

CONTROL_TOTALS = """
SELECT cash_flow_section, cash_direction, CAST(sum(signed_amount) * 100 AS BIGINT) AS amount_cents
FROM actuals GROUP BY cash_flow_section, cash_direction
UNION ALL
SELECT 'All', 'net', CAST(sum(signed_amount) * 100 AS BIGINT) FROM actuals HAVING count(*) > 0"""

# Expected totals come from the raw tables, with the net of all as a group of its own.
CONTROL_SIDES = """
SELECT cash_flow_section, cash_direction, t.amount, e.expected_amount
FROM (
  SELECT CASE WHEN grouping(cash_flow_section) = 1 THEN 'All' ELSE cash_flow_section END AS cash_flow_section,
         CASE WHEN grouping(cash_direction) = 1 THEN 'net' ELSE cash_direction END AS cash_direction, sum(amount) AS expected_amount
  FROM (
    SELECT 'Operating' AS cash_flow_section, 'inflow' AS cash_direction,
           CAST(o_totalprice AS DECIMAL(18,2)) AS amount
    FROM orders WHERE upper(trim(o_orderstatus)) = 'F' AND o_orderdate >= TIMESTAMP '2000-01-01'
      AND o_orderdate < TIMESTAMP '2000-10-01'
    UNION ALL
    SELECT CASE WHEN l_returnflag = 'R' THEN 'Financing'
                WHEN p_type IN ('LARGE', 'PROMO') THEN 'Investing' ELSE 'Operating' END,
           if(l_returnflag = 'R', 'inflow', 'outflow'),
           if(l_returnflag = 'R', CAST(l_extendedprice AS DECIMAL(18,2)),
              -CAST(l_extendedprice AS DECIMAL(18,2)))
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
    WHERE upper(trim(l_linestatus)) = 'F' AND l_shipdate >= TIMESTAMP '2000-01-01'
      AND l_shipdate < TIMESTAMP '2000-10-01')
  GROUP BY GROUPING SETS ((cash_flow_section, cash_direction), ())
  HAVING {agreed}) e
FULL JOIN (
  SELECT CASE WHEN grouping(cash_flow_section) = 1 THEN 'All' ELSE cash_flow_section END AS cash_flow_section,
         CASE WHEN grouping(cash_direction) = 1 THEN 'net' ELSE cash_direction END AS cash_direction, sum(signed_amount) AS amount
  FROM actuals GROUP BY GROUPING SETS ((cash_flow_section, cash_direction), ())) t
  USING (cash_flow_section, cash_direction)"""

CONTROL_COMPARED = """
SELECT cash_flow_section, cash_direction, CAST(amount * 100 AS BIGINT) AS amount_cents,
  CAST(expected_amount * 100 AS BIGINT) AS expected_amount_cents,
  coalesce(amount = expected_amount, false) AS agrees
FROM ({sides})"""

CHECKS = """
SELECT stage, check_id, ord, CAST(violations AS BIGINT) AS violations, observed, expected,
  notice OR violations = 0 AS passed
FROM (
  SELECT 'close' AS stage, 'repeated_mapping_key' AS check_id, 5 AS ord, count(*) AS violations,
         CAST(count(*) AS VARCHAR) AS observed, '0' AS expected, false AS notice
  FROM (SELECT source, category FROM mapping GROUP BY 1, 2 HAVING count(*) > 1)
  UNION ALL
  SELECT 'close', 'unmapped_category', 10, count(*), CAST(count(*) AS VARCHAR), '0', false
  FROM ledger WHERE reporting_line IS NULL
  UNION ALL
  SELECT 'close', 'repeated_transaction_id', 20, n, CAST(n AS VARCHAR), '0', false
  FROM (SELECT CAST(coalesce(sum(CASE WHEN trim(coalesce(transaction_id, '')) = '' THEN n
                                      WHEN n > 1 THEN 1 ELSE 0 END), 0) AS BIGINT) AS n
        FROM (SELECT transaction_id, count(*) AS n FROM ledger GROUP BY 1))
  UNION ALL
  SELECT 'close', 'repeated_dimension_key', 7, count(*), CAST(count(*) AS VARCHAR), '0', false
  FROM (SELECT 'c', c_custkey FROM customer WHERE c_custkey IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1
    UNION ALL SELECT 'p', p_partkey FROM part WHERE p_partkey IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1
    UNION ALL SELECT 's', s_suppkey FROM supplier WHERE s_suppkey IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1)
  UNION ALL
  SELECT 'close', 'missing_entity', 35, count(*), CAST(count(*) AS VARCHAR), '0', false
  FROM ledger WHERE entity_id = 'unknown'
  UNION ALL
  SELECT 'close', 'figures_without_agreement', 58, 0, '0', '0', true
  UNION ALL
  SELECT 'close', 'control_agreement', 59, CASE WHEN count(expected_amount) = 0 THEN 1 ELSE 0 END,
         CASE WHEN count(expected_amount) = 0 THEN 'none' ELSE 'given' END, 'given', false
  FROM ({control_sides})
  UNION ALL
  SELECT 'report', gate, place,
         CAST(count(*) FILTER (WHERE amount IS NULL OR agreed IS NULL OR amount <> agreed) AS BIGINT),
         CAST(CAST(sum(amount) AS BIGINT) AS VARCHAR), CAST(CAST(sum(agreed) AS BIGINT) AS VARCHAR), false
  FROM ({agreed_amounts}) GROUP BY gate, place
  UNION ALL
  SELECT 'close', 'missing_counterparty', 30, count(*), CAST(count(*) AS VARCHAR), '0', false
  FROM ledger WHERE source <> 'Receipts' AND trim(coalesce(vendor, '')) = ''
  UNION ALL
  SELECT 'close', 'outside_closed_window', 40, count(*), CAST(count(*) AS VARCHAR), '0', true
  FROM ledger WHERE NOT (year(cash_date) = 2000 AND month(cash_date) <= 9)
  UNION ALL
  SELECT 'close', 'one_opening_record', 50,
         count(*) FILTER (WHERE n <> 1), CAST(sum(n) AS VARCHAR), CAST(count(*) AS VARCHAR), false
  FROM (SELECT e.entity_id, count(o.entity_id) AS n
        FROM entities e LEFT JOIN opening o ON o.entity_id = e.entity_id GROUP BY 1)
  UNION ALL
  SELECT 'forecast', 'forecast_row_count', 70,
         count(*) FILTER (WHERE n <> 72), CAST(sum(n) AS VARCHAR),
         CAST(count(*) * 72 AS VARCHAR), false
  FROM (SELECT e.entity_id, count(f.entity_id) AS n
        FROM entities e LEFT JOIN projected f ON f.entity_id = e.entity_id GROUP BY 1)
  UNION ALL
  SELECT 'forecast', 'repeated_forecast_id', 75, count(*), CAST(count(*) AS VARCHAR), '0', false
  FROM (SELECT entity_id, transaction_id FROM projected GROUP BY 1, 2 HAVING count(*) > 1)
  UNION ALL
  SELECT 'report', 'horizon_end', 95,
         CASE WHEN max(reporting_month) = DATE '2001-09-01' THEN 0 ELSE 1 END,
         CAST(max(reporting_month) AS VARCHAR), '2001-09-01', false FROM cash
  UNION ALL
  SELECT 'report', 'unknown_reporting_line', 100, count(*),
         CAST(coalesce(sum(signed_amount_usd), 0) AS VARCHAR), '0', false
  FROM (SELECT reporting_line, sum(signed_amount_usd) AS signed_amount_usd FROM cash
        GROUP BY entity_id, reporting_month, cash_flow_section, business_activity, reporting_line)
  WHERE reporting_line IS NULL OR reporting_line NOT IN (SELECT reporting_line FROM lines)
  UNION ALL
  SELECT 'report', 'line_equals_transactions', 110, count(*) FILTER (WHERE NOT agrees),
         CAST(coalesce(sum(difference_usd) FILTER (WHERE NOT agrees), 0) AS VARCHAR), '0', false
  FROM ({recon_line})
  UNION ALL
  SELECT 'report', 'activity_equals_transactions', 120, count(*) FILTER (WHERE NOT agrees),
         CAST(coalesce(sum(difference_usd) FILTER (WHERE NOT agrees), 0) AS VARCHAR), '0', false
  FROM ({recon_activity})
  UNION ALL
  SELECT 'forecast', 'forecast_matches_drivers', 80, count(*) FILTER (WHERE NOT agrees),
         CAST(coalesce(sum(difference_usd) FILTER (WHERE NOT agrees), 0) AS VARCHAR), '0', false
  FROM ({forecast_side})
  UNION ALL
  SELECT 'report', 'report_matches_drivers', 220, count(*) FILTER (WHERE NOT agrees),
         CAST(coalesce(sum(difference_usd) FILTER (WHERE NOT agrees), 0) AS VARCHAR), '0', false
  FROM ({report_side})
  UNION ALL
  SELECT 'forecast', 'unused_override', 85, count(*), CAST(count(*) AS VARCHAR), '0', true
  FROM ({unused})
  UNION ALL
  SELECT 'close', concat_ws('_', 'control', lower(cash_flow_section), lower(cash_direction)),
         CASE lower(cash_flow_section || '/' || cash_direction) WHEN 'operating/inflow' THEN 60
           WHEN 'operating/outflow' THEN 61 WHEN 'investing/outflow' THEN 62
           WHEN 'financing/inflow' THEN 63 WHEN 'all/net' THEN 64 ELSE 65 END,
         if(coalesce(amount = expected_amount, false), 0, 1), CAST(amount AS VARCHAR),
         CAST(expected_amount AS VARCHAR), false
  FROM ({control_sides})
  UNION ALL
  SELECT 'report', 'section_equals_transactions', 130, count(*) FILTER (WHERE NOT agrees),
         CAST(coalesce(sum(difference_usd) FILTER (WHERE NOT agrees), 0) AS VARCHAR), '0', false
  FROM ({recon_section})
  UNION ALL
  SELECT 'report', 'summary_row_count', 140, count(*) FILTER (WHERE n <> 21),
         CAST(max(n) AS VARCHAR), '21', false
  FROM (SELECT count(*) AS n FROM summary GROUP BY entity_id)
  UNION ALL
  SELECT 'report', 'line_row_count', 150, count(*) FILTER (WHERE n <> 126),
         CAST(max(n) AS VARCHAR), '126', false
  FROM (SELECT count(*) AS n FROM monthly_lines GROUP BY entity_id)
  UNION ALL
  SELECT 'report', 'balance_adds_up', 160, n, CAST(n AS VARCHAR), '0', false
  FROM (SELECT count(*) FILTER (WHERE NOT coalesce(
          beginning_cash + net_change_in_cash = ending_cash, false)) AS n FROM summary)
  UNION ALL
  SELECT 'report', 'balance_continues', 165, n, CAST(n AS VARCHAR), '0', false
  FROM (SELECT count(*) FILTER (WHERE p IS NOT NULL AND p IS DISTINCT FROM beginning_cash) AS n
        FROM (SELECT beginning_cash, lag(ending_cash) OVER (
                PARTITION BY entity_id ORDER BY reporting_month) AS p FROM summary))
  UNION ALL
  SELECT 'report', 'actual_month_count', 170, count(*) FILTER (WHERE n <> 9),
         CAST(max(n) AS VARCHAR), '9', false
  FROM (SELECT count(*) FILTER (WHERE amount_type = 'Actual') AS n FROM summary GROUP BY entity_id)
  UNION ALL
  SELECT 'report', 'forecast_month_count', 180, count(*) FILTER (WHERE n <> 12),
         CAST(max(n) AS VARCHAR), '12', false
  FROM (SELECT count(*) FILTER (WHERE amount_type = 'Forecast') AS n FROM summary GROUP BY entity_id)
  UNION ALL
  SELECT 'report', 'last_month', 190, count(*) FILTER (WHERE m <> DATE '2001-09-01'),
         CAST(max(m) AS VARCHAR), '2001-09-01', false
  FROM (SELECT max(reporting_month) AS m FROM summary GROUP BY entity_id)
)"""


# Opening amount, net change and final balance per entity, from raw tables and drivers.
AGREED_AMOUNTS = """
WITH held AS (
  SELECT coalesce(CAST(c_nationkey AS VARCHAR), 'unknown') AS entity_id,
         CAST(round_even(sum(CAST(c_acctbal AS DECIMAL(18,2))), 0) AS BIGINT) AS agreed
  FROM customer GROUP BY 1
),
moves AS (
  SELECT entity_id, CAST(sum(amount) AS BIGINT) AS agreed FROM (
    SELECT entity_id, signed_amount_usd AS amount FROM actuals
    UNION ALL SELECT entity_id, signed_amount_usd FROM ({driver_cells})) GROUP BY 1
)
SELECT 'opening_amount' AS gate, 90 AS place, entity_id, available_balance_usd AS amount, agreed
FROM opening FULL JOIN held USING (entity_id)
UNION ALL
SELECT 'total_net_change', 200, entity_id, amount, agreed
FROM (SELECT entity_id, sum(net_change_in_cash) AS amount FROM summary GROUP BY 1) FULL JOIN moves USING (entity_id)
UNION ALL
SELECT 'final_balance', 210, entity_id, amount, agreed
FROM (SELECT entity_id, arg_max(ending_cash, reporting_month) AS amount FROM summary GROUP BY 1)
FULL JOIN (SELECT entity_id, coalesce(h.agreed, 0) + coalesce(m.agreed, 0) AS agreed
           FROM held h FULL JOIN moves m USING (entity_id)) USING (entity_id)"""

# The forecast's cells from closed transactions, past the projected ledger.
DRIVER_CELLS = """
SELECT g.entity_id, g.reporting_month, g.reporting_line,
  CAST(coalesce(
    (SELECT p.amount_usd FROM plan p WHERE p.entity_id = g.entity_id
       AND p.reporting_month = g.reporting_month AND p.reporting_line = g.reporting_line),
    CASE g.driver_kind
      WHEN 'recurring' THEN d.closing
      WHEN 'last_month' THEN d.latest END, 0) AS BIGINT) AS signed_amount_usd
FROM grid g LEFT JOIN (
  SELECT entity_id, reporting_line,
    CAST(round(sum(total) FILTER (month(reporting_month) >= 7) / 3.0) AS BIGINT) AS closing,
    CAST(max_by(total, reporting_month) AS BIGINT) AS latest
  FROM closed_totals GROUP BY 1, 2) d USING (entity_id, reporting_line)
WHERE g.is_open"""


def _side_by_side(report: str, ledger: str, keys: str) -> str:
    return SIDE_BY_SIDE.format(report=report, ledger=ledger, keys=keys)


def _sums(dimension: str, columns: dict[str, str]) -> str:
    return ",\n    ".join(
        f"CAST(coalesce(sum(signed_amount_usd) FILTER ({dimension} = '{value}'), 0) AS BIGINT)"
        f" AS {name}"
        for name, value in columns.items()
    )


def statements() -> dict[str, str]:
    cell = "entity_id, reporting_month, reporting_line"
    recon_line = _side_by_side("monthly_lines", "cash", cell)
    recon_section = _side_by_side(
        "reported_sections", "booked_sections", "entity_id, reporting_month, measure"
    )
    recon_activity = _side_by_side(
        "monthly_lines", "cash", "entity_id, reporting_month, cash_flow_section, business_activity"
    )
    open_lines = "(SELECT * FROM monthly_lines WHERE amount_type = 'Forecast')"
    unused = """
        SELECT p.* FROM plan p
        WHERE NOT EXISTS (SELECT 1 FROM months m, lines l, opening o
          WHERE m.is_open AND m.reporting_month = p.reporting_month
            AND l.reporting_line = p.reporting_line AND o.entity_id = p.entity_id)"""
    on_ledger = {
        "kept_status_counts": """
            SELECT source, status, coalesce(status = 'F', false) AS kept, count(*) AS n_records,
              CAST(sum(amount) * 100 AS BIGINT) AS amount_cents
            FROM records GROUP BY source, status""",
        "canonical_ledger": """
            SELECT entity_id, transaction_id, source_system, source_file, source, source_category,
              vendor, cash_date, cash_direction, CAST(amount * 100 AS BIGINT) AS amount_cents
            FROM kept""",
        "mapped_signed_ledger": """
            SELECT entity_id, transaction_id, source_system, source_file, source, source_category,
              vendor, cash_date, reporting_month, business_activity, cash_flow_section,
              reporting_line, cash_direction, CAST(signed_amount * 100 AS BIGINT)
              AS signed_amount_cents, signed_amount_usd
            FROM ledger""",
        "unmapped_categories": """
            SELECT k.source, k.source_category, count(*) AS n_records
            FROM kept k LEFT JOIN (SELECT * FROM mapping WHERE category <> 'PROMO') m
              ON m.source = k.source AND m.category = k.source_category
            WHERE m.reporting_line IS NULL GROUP BY 1, 2""",
        "repeated_mapping_keys": """
            SELECT source, category, count(*) AS count FROM (
              SELECT source, category FROM mapping
              UNION ALL SELECT DISTINCT 'Operating payments', p_type FROM part)
            GROUP BY 1, 2 HAVING count(*) > 1""",
        "duplicate_line_ids": """
            SELECT 'LIN-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)
              AS transaction_id, count(*) AS n_rows
            FROM lineitem WHERE upper(trim(l_linestatus)) = 'F'
              AND l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
            GROUP BY 1 HAVING count(*) > 1""",
        "missing_counterparty_counts": """
            SELECT source, count(*) AS n_records,
              count(*) FILTER (WHERE trim(coalesce(vendor, '')) = '') AS blank_vendors,
              count(*) FILTER (WHERE source <> 'Receipts' AND trim(coalesce(vendor, '')) = '')
                AS violations
            FROM ledger GROUP BY source""",
        "out_of_window_rejects": """
            SELECT source, reporting_month, count(*) AS n_records,
              CAST(sum(signed_amount_usd) AS BIGINT) AS signed_amount_usd
            FROM ledger WHERE NOT (year(cash_date) = 2000 AND month(cash_date) <= 9)
            GROUP BY source, reporting_month""",
        "closed_actuals": f"SELECT {TRANSACTIONS} FROM actuals",
        "opening_by_entity": "SELECT * FROM opening",
        "control_totals": CONTROL_TOTALS,
        "control_totals_agree": CONTROL_COMPARED.format(sides=CONTROL_SIDES.format(agreed="true")),
        "control_totals_unexpected": CONTROL_COMPARED.format(
            sides=CONTROL_SIDES.format(agreed="coalesce(cash_flow_section, 'All') <> 'Financing'")
        ),
        "repeated_dimension_keys": """
            SELECT dimension, CAST(sum(n) AS BIGINT) AS n_rows, count(k) AS n_keys,
              count(*) FILTER (WHERE k IS NOT NULL AND n > 1) AS repeated_keys
            FROM (SELECT 'customer' AS dimension, c_custkey AS k, count(*) AS n FROM customer GROUP BY 1, 2
              UNION ALL SELECT 'part', p_partkey, count(*) FROM part GROUP BY 1, 2
              UNION ALL SELECT 'supplier', s_suppkey, count(*) FROM supplier GROUP BY 1, 2)
            GROUP BY dimension""",
        "ids_with_null_parts": """
            SELECT CAST(sum(n) AS BIGINT) AS n_rows,
              CAST(coalesce(sum(n) FILTER (WHERE id IS NULL), 0) AS BIGINT) AS blank_ids,
              count(*) FILTER (WHERE id IS NOT NULL AND n > 1) AS repeated_ids
            FROM (SELECT CASE WHEN source <> 'Receipts' AND split_part(transaction_id, '-', 3) = '4'
                         THEN NULL ELSE transaction_id END AS id, count(*) AS n
                  FROM ledger GROUP BY 1)""",
        "id_audit": """
            SELECT CAST(sum(n) AS BIGINT) AS n_rows,
              CAST(coalesce(sum(n) FILTER (WHERE id = ''), 0) AS BIGINT) AS blank_ids,
              count(*) FILTER (WHERE id <> '' AND n > 1) AS repeated_ids
            FROM (SELECT trim(coalesce(transaction_id, '')) AS id, count(*) AS n
                  FROM ledger GROUP BY 1)""",
        "records_by_file": """
            SELECT source_file, source, count(*) AS n_records, CAST(sum(amount) * 100 AS BIGINT) AS amount_cents
            FROM kept GROUP BY source_file, source""",
        "amount_identity": """
            SELECT source, source_category, outcome, count(*) AS n_records,
              CAST(sum(abs(off)) AS BIGINT) AS off_cents
            FROM (SELECT source, source_category, off,
                CASE WHEN quantity IS NULL AND price IS NULL THEN 'no price'
                     WHEN quantity IS NULL OR price IS NULL THEN 'one factor missing'
                     WHEN coalesce(abs(off) > 1, true) THEN 'differs' ELSE 'agrees' END AS outcome
              FROM (SELECT *, CAST((amount - round(quantity * price, 2)) * 100 AS HUGEINT) AS off
                FROM (SELECT CASE WHEN l_returnflag = 'R' THEN 'Credits'
                      WHEN p_type IN ('LARGE', 'PROMO') THEN 'Capital payments' ELSE 'Operating payments' END AS source,
                    CASE WHEN l_returnflag = 'R' THEN lower(trim(l_returnflag)) ELSE trim(p_type) END AS source_category,
                    CAST(l_quantity AS DECIMAL(12,4)) AS quantity, CAST(p_retailprice AS DECIMAL(12,4)) AS price,
                    CAST(l_extendedprice AS DECIMAL(18,2)) AS amount
                  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
                  WHERE upper(trim(l_linestatus)) = 'F')))
            GROUP BY source, source_category, outcome""",
        "drilldown_month_line": f"""
            SELECT {TRANSACTIONS} FROM ledger
            WHERE reporting_month = DATE '2000-09-01' AND reporting_line = 'Parts paid'""",
        "rollup_section": """
            SELECT cash_flow_section, CAST(sum(signed_amount_usd) AS BIGINT) AS signed_amount_usd,
              CASE cash_flow_section WHEN 'Operating' THEN 1 WHEN 'Investing' THEN 2
                WHEN 'Financing' THEN 3 ELSE 99 END AS section_order
            FROM actuals GROUP BY 1""",
        "rollup_activity": """
            SELECT business_activity, CAST(sum(signed_amount_usd) AS BIGINT) AS signed_amount_usd
            FROM actuals GROUP BY 1""",
        "cash_measures": f"""
            SELECT reporting_month, cash_flow_section, {MEASURES} FROM actuals GROUP BY 1, 2""",
        "cash_by_month_and_line": f"""
            SELECT entity_id, reporting_month, reporting_line, {MEASURES}
            FROM actuals GROUP BY 1, 2, 3""",
    }
    on_report = {
        "forecast_months": """
            SELECT CAST(n_nationkey AS VARCHAR) AS entity_id, reporting_month,
              CASE WHEN is_open THEN 'Forecast' ELSE 'Actual' END AS amount_type
            FROM nation CROSS JOIN months""",
        "run_rate_drivers": "SELECT * FROM run_rate",
        "last_active_month_driver": "SELECT * FROM last_active",
        "forecast_no_plan": f"SELECT {TRANSACTIONS} FROM projected",
        "forecast_cardinality_and_unique": """
            SELECT entity_id, CAST(sum(n) AS BIGINT) AS n_rows,
              count(*) FILTER (WHERE n > 1) AS repeated_ids, CAST(72 AS BIGINT) AS expected_rows
            FROM (SELECT entity_id, transaction_id, count(*) AS n FROM projected GROUP BY 1, 2)
            GROUP BY entity_id""",
        "monthly_lines_all": "SELECT * FROM monthly_lines",
        "actual_lines": "SELECT * FROM monthly_lines WHERE amount_type = 'Actual'",
        "lines_through_csv": "SELECT * FROM monthly_lines",
        "forecast_lines": "SELECT * FROM monthly_lines WHERE amount_type = 'Forecast'",
        "monthly_pivot": "SELECT * FROM wide",
        "section_nets": """
            SELECT entity_id, reporting_month, amount_type, net_operating_cash_flow,
              net_investing_cash_flow, net_financing_cash_flow, net_change_in_cash FROM nets""",
        "balance_rollforward": "SELECT * EXCLUDE (so_far) FROM summary",
        "final_balance_by_entity": """
            SELECT entity_id, max(reporting_month) AS reporting_month,
              arg_max(ending_cash, reporting_month) AS ending_cash
            FROM summary GROUP BY entity_id""",
        "recon_line": recon_line,
        "recon_activity": recon_activity,
        "recon_section": recon_section,
        "unknown_lines": """
            SELECT reporting_line, entity_id, reporting_month, cash_flow_section,
              business_activity, CAST(sum(signed_amount_usd) AS BIGINT) AS signed_amount_usd
            FROM actuals
            WHERE reporting_line IS NULL OR reporting_line NOT IN (
              SELECT reporting_line FROM lines WHERE reporting_line <> 'Equipment paid')
            GROUP BY 1, 2, 3, 4, 5""",
        "rollforward_identity": """
            SELECT entity_id, reporting_month, beginning_cash, net_change_in_cash, ending_cash,
              p AS previous_ending_cash,
              coalesce(beginning_cash + net_change_in_cash = ending_cash, false) AS adds_up,
              coalesce(p IS NULL OR p = beginning_cash, false) AS continues
            FROM (SELECT *, lag(ending_cash) OVER (
                    PARTITION BY entity_id ORDER BY reporting_month) AS p FROM summary)""",
        "period_counts": """
            SELECT entity_id, line_rows, summary_rows, actual_months, forecast_months, last_month
            FROM (SELECT entity_id, count(*) AS line_rows FROM monthly_lines GROUP BY 1)
            FULL JOIN (SELECT entity_id, count(*) AS summary_rows,
                count(*) FILTER (WHERE amount_type = 'Actual') AS actual_months,
                count(*) FILTER (WHERE amount_type = 'Forecast') AS forecast_months,
                max(reporting_month) AS last_month FROM summary GROUP BY 1) USING (entity_id)""",
        "exported_order": """
            SELECT reporting_month, entity_id, display_order, signed_amount_usd,
              row_number() OVER (ORDER BY reporting_month, entity_id, display_order) AS rank, true AS in_order
            FROM monthly_lines""",
        "backtest_error": BACKTEST,
        "id_presence": """
            SELECT transaction_id, source_rows, ledger_rows,
              source_rows = 1 AND ledger_rows = 1 AS found_once
            FROM (SELECT t.transaction_id,
                (SELECT count(*) FROM records r WHERE r.transaction_id = t.transaction_id)
                  AS source_rows,
                (SELECT count(*) FROM actuals a WHERE a.transaction_id = t.transaction_id)
                  AS ledger_rows
              FROM (SELECT DISTINCT transaction_id FROM top_ids) t)""",
        "trace_line_sum": f"""
            SELECT a.transaction_id, a.entity_id, a.reporting_month, a.reporting_line,
              b.n_transactions, b.transaction_sum, l.signed_amount_usd AS reported_amount,
              coalesce(b.transaction_sum = l.signed_amount_usd, false) AS agrees
            FROM actuals a
            JOIN (SELECT {cell}, count(*) AS n_transactions,
                    CAST(sum(signed_amount_usd) AS BIGINT) AS transaction_sum
                  FROM actuals GROUP BY {cell}) b USING ({cell})
            LEFT JOIN monthly_lines l USING ({cell})
            WHERE a.transaction_id IN (SELECT transaction_id FROM top_ids)""",
    }
    both = f"""(SELECT {TRANSACTIONS}, 'Actual' AS amount_type FROM actuals
      UNION ALL SELECT {TRANSACTIONS}, 'Forecast' FROM projected)"""
    on_plan = {
        "drilldown_forecast_cell": f"""
            SELECT * FROM {both}
            WHERE reporting_month = DATE '2001-02-01' AND reporting_line = 'Credit drawn'""",
        "cash_measures_by_type": f"""
            SELECT reporting_month, cash_flow_section, amount_type, {MEASURES}
            FROM {both} GROUP BY 1, 2, 3""",
        "forecast_with_plan": f"SELECT {TRANSACTIONS} FROM projected",
        "unused_overrides": unused,
        "monthly_lines_with_plan": "SELECT * FROM monthly_lines",
        "balance_rollforward_with_plan": "SELECT * EXCLUDE (so_far) FROM summary",
        "published_summary": "SELECT * EXCLUDE (so_far) FROM summary",
        "forecast_vs_driver": _side_by_side(open_lines, f"({DRIVER_CELLS})", cell),
        "check_report": CHECKS.format(
            recon_line=recon_line,
            recon_activity=recon_activity,
            recon_section=recon_section,
            forecast_side=_side_by_side("projected", "projected", cell),
            report_side=_side_by_side(open_lines, "projected", cell),
            unused=unused,
            control_sides=CONTROL_SIDES.format(agreed="true"),
            agreed_amounts=AGREED_AMOUNTS.format(driver_cells=DRIVER_CELLS),
        ),
    }

    def report_ctes(plan_filter: str) -> str:
        return REPORT.format(
            plan_filter=plan_filter,
            line_columns=_sums("reporting_line", LINE_COLUMNS),
            section_columns=_sums("cash_flow_section", SECTION_COLUMNS),
        )

    ledger = f"WITH {LEDGER}\n"
    report = f"WITH {LEDGER},{report_ctes('WHERE false')},{SECTION_SIDES}\n"
    planned = f"WITH {LEDGER},{report_ctes('')},{SECTION_SIDES}\n"
    # Read several times each: computed once.
    for step in ("records", "actuals", "closed_totals", "monthly_lines", "top_ids"):
        report = report.replace(f"\n{step} AS (", f"\n{step} AS MATERIALIZED (")
    # A rule is missing, payments are repeated, and a line is altered after it was added up.
    payments = "(SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 1000 = 7) AS lineitem"
    broken = planned
    for before, after in (
        ("  FROM lineitem\n  LEFT JOIN part", f"  FROM {payments}\n  LEFT JOIN part"),
        ("  ('Capital payments', 'PROMO', 'Supply', 'Investing', 'Equipment paid'),\n", ""),
        (
            "CAST(coalesce(c.total, 0) AS BIGINT) AS signed_amount_usd",
            "CAST(coalesce(c.total, 0) + if(reporting_line = 'Overhead paid' AND reporting_month = DATE '2000-09-01',"
            " 1, 0) AS BIGINT) AS signed_amount_usd",
        ),
    ):
        assert before in broken
        broken = broken.replace(before, after)
    found = {name: ledger + sql for name, sql in on_ledger.items()}
    asked = "transaction_id IN (SELECT transaction_id FROM top_ids)"
    for name, here in (("trace_ids", ""), ("trace_selected", asked)):
        booked = BOOKED.format(asked=f"AND b.{here}" if here else "")
        found[name] = report.rstrip() + "," + booked + TRACE.format(asked=f"WHERE r.{here}" if here else "")
    found["ledger_rows_by_id"] = report + """
        SELECT entity_id, transaction_id, source_system, source_file, source, source_category, vendor, cash_date,
          reporting_month, business_activity, cash_flow_section, reporting_line, cash_direction,
          CAST(signed_amount * 100 AS BIGINT) AS signed_amount_cents, signed_amount_usd
        FROM ledger WHERE transaction_id IN (SELECT transaction_id FROM top_ids)"""
    changed = planned.rstrip() + "," + WHAT_IF
    found["what_if_lines"] = changed + "SELECT * FROM changed_lines"
    found["what_if_balances"] = changed + """
        SELECT what_if, entity_id, reporting_month, amount_type, net_change_in_cash,
          CAST(available_balance_usd + sum(net_change_in_cash) OVER (
            PARTITION BY what_if, entity_id ORDER BY reporting_month) AS BIGINT) AS ending_cash
        FROM (SELECT what_if, entity_id, reporting_month, amount_type,
                CAST(sum(signed_amount_usd) AS BIGINT) AS net_change_in_cash
              FROM changed_lines GROUP BY 1, 2, 3, 4) LEFT JOIN opening USING (entity_id)"""
    grown = planned.replace("WITH ", f"WITH RECURSIVE {GROWN},", 1)
    for before, after in (
        ("coalesce(p.amount_usd, r.amount_usd, a.amount_usd, 0)",
         "coalesce(p.amount_usd, CAST(round_even(r.amount_usd * coalesce(f.factor, 1), 0) AS BIGINT), a.amount_usd, 0)"),
        ("  WHERE g.is_open\n",
         "  LEFT JOIN grown f ON f.reporting_line = g.reporting_line AND f.reporting_month = g.reporting_month\n"
         "  WHERE g.is_open\n"),
    ):
        assert before in grown
        grown = grown.replace(before, after)
    found["forecast_with_growth"] = grown + f"SELECT {TRANSACTIONS} FROM projected"
    found["scenario_checks"] = SCENARIO_CHECKS
    found["quarantined_records"] = FEEDS + """
        SELECT 'orders' AS feed, id AS record_id, 'o_custkey' AS column_name, 'C' || o_custkey AS raw_value,
          'not bigint' AS reason FROM order_feed WHERE bad_customer AND o_custkey IS NOT NULL
        UNION ALL SELECT 'orders', id, 'o_totalprice', bad_price, 'not decimal(18,2)' FROM order_feed WHERE bad_price IS NOT NULL
        UNION ALL SELECT 'orders', id, 'o_orderdate', bad_day, 'not date' FROM order_feed WHERE bad_day IS NOT NULL
        UNION ALL SELECT 'lineitem', id, 'l_quantity', '1O', 'not decimal(18,2)' FROM item_feed WHERE bad_quantity
        UNION ALL SELECT 'lineitem', id, 'l_extendedprice', 'USD ' || amount, 'not decimal(18,2)'
          FROM item_feed WHERE bad_price AND amount IS NOT NULL"""
    found["records_past_quarantine"] = FEEDS + """
        SELECT feed, month, count(*) AS n_records, count(amount) AS n_amounts, CAST(sum(amount) * 100 AS BIGINT) AS amount_cents
        FROM (SELECT 'orders' AS feed, CAST(date_trunc('month', day) AS DATE) AS month, if(no_price, NULL, amount) AS amount
              FROM order_feed WHERE NOT (bad_customer AND o_custkey IS NOT NULL) AND bad_price IS NULL AND bad_day IS NULL
              UNION ALL SELECT 'lineitem', CAST(date_trunc('month', day) AS DATE), amount
              FROM item_feed WHERE NOT bad_quantity AND NOT (bad_price AND amount IS NOT NULL))
        GROUP BY feed, month"""
    found["check_report_broken"] = broken + on_plan["check_report"]
    found |= {name: report + sql for name, sql in on_report.items()}
    found |= {name: planned + sql for name, sql in on_plan.items()}
    return found
