"""The same domain tables in plain SQL, for checking query results independently."""

from __future__ import annotations

import re

PRICE = "CAST(l_extendedprice AS DECIMAL(14,2))"
DISC = "CAST(l_discount AS DECIMAL(4,2))"
TAX = "CAST(l_tax AS DECIMAL(4,2))"
QTY = "CAST(l_quantity AS DECIMAL(8,2))"
MONEY = "DECIMAL(18,4)"
EVENT_VALUE = "CAST(CAST(value AS DECIMAL(14,2)) AS DECIMAL(18,4))"


def m(expr: str) -> str:
    return f"CAST({expr} AS {MONEY})"


def dsum(expr: str) -> str:
    return f"CAST(SUM({expr}) AS DOUBLE)"


def rsum(expr: str, scale: int = 2) -> str:
    return f"CAST(ROUND(SUM({expr}), {scale}) AS DOUBLE)"


def rnd(expr: str, scale: int = 2) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,6)), {scale}) AS DOUBLE)"


def ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def pct(a: str, b: str, scale: int = 2) -> str:
    return rnd(f"{ratio(a, b)} * 100", scale)


def ldate(ts: str) -> str:
    return f"CAST({ts} - INTERVAL 7 HOUR AS DATE)"


_ITEM = """'{"type":"%s","cost":"' || %s || '","total":"' || %s || '"}'"""


def _item(kind: str, cost: str, price: str) -> str:
    return _ITEM % (kind, cost, price)


def _txt(factor: str) -> str:
    return f"CAST({m(f'val * {factor}')} AS VARCHAR)"


_SHARE = "(CASE WHEN k = 0 THEN CAST(0.3 AS DECIMAL(2,1)) ELSE CAST(0.7 AS DECIMAL(2,1)) END)"

CTES: dict[str, str] = {
    "units": """
        SELECT CAST(n_nationkey AS BIGINT) AS id,
               n_name || CASE WHEN n_nationkey % 2 = 0 THEN '-Sales' ELSE '-Production' END AS name,
               r_name AS region,
               CASE r_name WHEN 'AFRICA' THEN false WHEN 'ASIA' THEN NULL ELSE true END AS active
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "job_types": """
        SELECT * FROM (VALUES (1, 'ESTIMATE-RES-EXT'), (2, 'ESTIMATE-COMM-INT'), (3, 'Warranty'),
            (4, 'Exterior Paint'), (5, 'Touchup'), (6, 'PM Inspection')) t(id, name)""",
    "campaigns": """
        SELECT r_regionkey AS id, 'Campaign ' || r_name AS name,
               CASE WHEN r_name = 'ASIA' THEN NULL ELSE true END AS active FROM region""",
    "technicians": """
        SELECT s_suppkey AS id, s_name AS name, s_nationkey AS business_unit_id,
               CASE WHEN s_acctbal < 0 THEN false END AS active FROM supplier""",
    "customers": f"""
        SELECT c_custkey AS id,
               CASE WHEN c_acctbal < 0 AND c_mktsegment IN ('MACHINERY','HOUSEHOLD')
                    THEN 'TEST ' || c_name
                    WHEN c_acctbal < 0 AND c_mktsegment = 'BUILDING' THEN NULL ELSE c_name END AS name,
               CASE WHEN c_mktsegment IN ('MACHINERY','BUILDING') THEN 'Commercial'
                    ELSE 'Residential' END AS type,
               {m('CAST(c_acctbal AS DECIMAL(14,2))')} AS balance
        FROM customer""",
    "location_zips": """
        SELECT c_custkey AS location_id,
               CASE c_mktsegment WHEN 'HOUSEHOLD' THEN lpad(CAST(501 + c_nationkey AS VARCHAR), 5, '0')
                    WHEN 'BUILDING' THEN CAST(85001 + c_nationkey AS VARCHAR)
                    WHEN 'FURNITURE' THEN CAST(90001 + c_nationkey AS VARCHAR)
                    ELSE CAST(89001 + c_nationkey AS VARCHAR) END AS zip5,
               CASE WHEN c_mktsegment = 'BUILDING' THEN c_nationkey + 0.5::DOUBLE END AS lon,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 33.25::DOUBLE END AS lat
        FROM customer WHERE c_mktsegment <> 'AUTOMOBILE'""",
    "jobs": """
        SELECT o_orderkey AS id, 'J' || o_orderkey AS job_number, o_custkey AS customer_id,
               o_custkey AS location_id,
               CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL
                    ELSE o_custkey % 25 END AS business_unit_id,
               CASE WHEN o_orderstatus = 'F' THEN 'Completed' WHEN o_orderstatus = 'O' THEN 'Scheduled'
                    WHEN o_orderpriority = '1-URGENT' THEN 'InProgress'
                    WHEN o_orderpriority = '2-HIGH' THEN 'Canceled' ELSE 'Hold' END AS job_status,
               CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED' THEN 6
                    ELSE CAST(o_orderpriority[1] AS BIGINT) END AS job_type_id,
               CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey % 5 END AS campaign_id,
               o_orderdate AS created_on,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 30 DAY END AS completed_on,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 45 DAY
                    ELSE o_orderdate END AS modified_on
        FROM orders""",
    "dim_jobs": """
        SELECT jobs.*, units.name AS bu_name, COALESCE(units.name, 'Unknown') AS business_unit,
               job_types.name AS job_type_name
        FROM jobs LEFT JOIN units ON jobs.business_unit_id = units.id
        LEFT JOIN job_types ON jobs.job_type_id = job_types.id""",
    "estimates": f"""
        SELECT l_orderkey * 10 + l_linenumber AS id,
               CASE WHEN l_returnflag = 'A' AND l_linenumber = 7 THEN NULL ELSE l_orderkey END AS job_id,
               CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'Sold'
                    WHEN l_returnflag = 'R' THEN 'Dismissed' ELSE 'Open' END AS status,
               l_shipdate - INTERVAL 14 DAY AS created_on,
               CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN l_shipdate END AS sold_on,
               l_shipdate AS modified_on, l_suppkey AS sold_by_id,
               {m(f'{PRICE} * (1 - {DISC})')} AS subtotal,
               CASE WHEN l_tax > 0 THEN {m(f'{PRICE} * {TAX}')} END AS total_tax,
               CASE WHEN l_tax > 0 THEN {m(f'{PRICE} * (1 - {DISC} + {TAX})')} END AS total
        FROM lineitem""",
    "invoice_parts": """
        SELECT orders.*, k, CAST(o_totalprice AS DECIMAL(14,2)) AS val
        FROM orders CROSS JOIN (VALUES (0), (1)) s(k)""",
    "invoices": f"""
        SELECT o_orderkey * 2 + k AS id,
               CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' AND k = 0 THEN NULL
                    ELSE o_orderkey END AS job_id,
               'J' || o_orderkey AS job_number,
               CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL
                    ELSE o_custkey % 25 END AS business_unit_id,
               o_custkey AS customer_id,
               o_orderdate + k * INTERVAL 15 DAY AS invoice_date,
               o_orderdate + k * INTERVAL 15 DAY AS created_on,
               o_orderdate + k * INTERVAL 20 DAY AS modified_on,
               {m(f'val * {_SHARE}')} AS subtotal,
               {m(f'val * {_SHARE} * CAST(0.1 AS DECIMAL(2,1))')} AS sales_tax,
               {m(f'val * {_SHARE} * CAST(1.1 AS DECIMAL(2,1))')} AS total,
               CASE o_orderstatus WHEN 'F' THEN CAST(0 AS {MONEY})
                    WHEN 'O' THEN {m(f'val * {_SHARE}')}
                    ELSE {m(f'val * {_SHARE} * CAST(1.1 AS DECIMAL(2,1))')} END AS balance,
               CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
                    WHEN o_orderpriority = '5-LOW' THEN '[]'
                    WHEN k = 0 THEN '[' || {_item('Material',
                        f"CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'n/a' ELSE {_txt('CAST(0.11 AS DECIMAL(3,2))')} END",
                        _txt('CAST(0.2 AS DECIMAL(3,2))'))} || ',' ||
                        {_item('Service', _txt('CAST(0.01 AS DECIMAL(3,2))'), _txt('CAST(0.1 AS DECIMAL(3,2))'))} || ']'
                    ELSE '[' || {_item('Equipment', _txt('CAST(0.05 AS DECIMAL(3,2))'), _txt('CAST(0.15 AS DECIMAL(3,2))'))}
                        || ',' || {_item('Permit', _txt('CAST(0.02 AS DECIMAL(3,2))'), _txt('CAST(0.02 AS DECIMAL(3,2))'))} || ']'
               END AS items
        FROM invoice_parts""",
    "invoice_items": """
        SELECT id, job_id, it.type AS type, TRY_CAST(it.cost AS DECIMAL(18,4)) AS cost,
               TRY_CAST(it.total AS DECIMAL(18,4)) AS total
        FROM (SELECT id, job_id,
                     unnest(from_json(items, '[{"type":"VARCHAR","cost":"VARCHAR","total":"VARCHAR"}]')) AS it
              FROM invoices WHERE items IS NOT NULL)""",
    "payments": f"""
        SELECT event_id AS id, CASE WHEN event_type <> 'error' THEN event_id * 2 + 1 END AS invoice_id,
               CASE WHEN event_type = 'view' THEN -{EVENT_VALUE} ELSE {EVENT_VALUE} END AS amount,
               user_id AS payment_type_id, ts AS created_on, ts AS modified_on
        FROM events""",
    "payroll": f"""
        SELECT l_suppkey AS employee_id,
               CASE WHEN l_returnflag = 'A' AND l_linenumber = 7 THEN NULL ELSE l_orderkey END AS job_id,
               l_shipdate AS date,
               CASE WHEN l_linenumber <= 3 THEN 'Paint' WHEN l_linenumber <= 6 THEN 'Prep' END AS activity,
               {m(f'{QTY} * CAST(25.5 AS DECIMAL(3,1))')} AS amount,
               {m(QTY)} AS paid_duration_hours,
               l_orderkey * 10 + l_linenumber AS source_entity_id,
               'Unit ' || (l_suppkey % 25) AS business_unit_name,
               l_shipdate + INTERVAL 2 DAY AS modified_on
        FROM lineitem JOIN (VALUES (0), (1)) s(k) ON k = 0 OR l_linenumber = 1""",
    "adjustments": f"""
        SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey * 2 + 1 AS invoice_id,
               l_suppkey AS employee_id, {m(f'-{QTY} * CAST(1.5 AS DECIMAL(2,1))')} AS amount,
               l_shipdate AS posted_on
        FROM lineitem WHERE l_returnflag = 'R'""",
    "pos": f"""
        SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS job_id, l_suppkey AS vendor_id,
               CASE WHEN l_returnflag = 'A' THEN 'Received' WHEN l_returnflag = 'N' THEN 'Pending'
                    WHEN l_linestatus = 'O' THEN 'Canceled' END AS status,
               l_shipdate AS date,
               {m(f'{PRICE} * CAST(0.1 AS DECIMAL(2,1))')} AS subtotal,
               {m(f'{QTY} * CAST(0.25 AS DECIMAL(3,2))')} AS tax,
               {m(f'{QTY} * CAST(0.5 AS DECIMAL(2,1))')} AS shipping,
               {m(f'{QTY} * CAST(0.1 AS DECIMAL(2,1))')} AS discount,
               {m(f'{PRICE} * CAST(0.1 AS DECIMAL(2,1)) + {QTY} * CAST(0.65 AS DECIMAL(3,2))')} AS total,
               {m(f'{PRICE} * CAST(0.06 AS DECIMAL(3,2))')} + {m(f'{PRICE} * CAST(0.04 AS DECIMAL(3,2))')} AS items_total,
               l_shipdate AS modified_on
        FROM lineitem""",
    "rets": f"""
        SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS job_id, l_suppkey AS vendor_id,
               l_shipdate + INTERVAL 20 DAY AS return_date,
               {m(f'{QTY} * CAST(2.25 AS DECIMAL(3,2))')} AS subtotal,
               {m(f'{QTY} * CAST(0.25 AS DECIMAL(3,2))')} AS tax,
               {m(f'{QTY} * CAST(2.5 AS DECIMAL(2,1))')} AS total
        FROM lineitem WHERE l_returnflag = 'R'""",
    "appts": """
        SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS job_id, l_shipdate AS scheduled_start,
               l_shipdate + CAST(l_quantity AS INTEGER) * INTERVAL 1 HOUR AS scheduled_end,
               CASE WHEN l_returnflag = 'A' THEN 'Done' WHEN l_returnflag = 'N' THEN 'Scheduled'
                    WHEN l_linestatus = 'O' THEN 'Canceled' ELSE 'Cancelled' END AS status,
               l_shipdate - INTERVAL 10 DAY AS created_on, l_shipdate AS modified_on
        FROM lineitem""",
    "run_log": """
        SELECT event_type AS entity_type, event_id AS run_id, ts AS start_time,
               CASE WHEN CAST(props->>'$.k' AS INTEGER) < 10 THEN 'failed' ELSE 'success' END AS status,
               CAST(props->>'$.k' AS BIGINT) AS records_fetched,
               CAST(CAST(value AS DECIMAL(14,2)) * 1000 AS BIGINT) AS duration_ms,
               CASE WHEN CAST(props->>'$.k' AS INTEGER) < 10 THEN 'code ' || (props->>'$.k') END
                   AS error_message
        FROM events""",
    "sync_state": """
        SELECT event_type AS entity_type, ts - INTERVAL 1 HOUR AS last_sync_time,
               CASE WHEN CAST(props->>'$.k' AS INTEGER) < 10 THEN 'failed' ELSE 'success' END
                   AS last_sync_status,
               CAST(props->>'$.k' AS BIGINT) AS records_processed, ts AS updated_at
        FROM events""",
    "collections": f"""
        SELECT CASE WHEN event_type <> 'error' THEN 'Unit ' || (user_id % 25) END AS business_unit,
               ts AS payment_date,
               CASE WHEN event_type = 'view' THEN -{EVENT_VALUE}
                    WHEN event_type = 'signup' AND user_id < 10 THEN NULL
                    WHEN event_type = 'click' AND user_id < 10 THEN CAST(0 AS {MONEY})
                    ELSE {EVENT_VALUE} END AS amount,
               CAST(user_id AS VARCHAR) AS job_id, ts + INTERVAL 1 HOUR AS updated_on, props AS raw
        FROM events""",
    "report_leads": """
        SELECT 'Unit ' || (l_orderkey % 25) AS bu_key, l_shipdate AS job_created_on,
               CASE WHEN l_orderkey % 3 = 0 THEN 'ESTIMATE-RES-EXT' ELSE 'ESTIMATE-COMM-INT' END AS job_type,
               CAST(l_orderkey AS VARCHAR) AS job_id,
               l_shipdate + l_linenumber * INTERVAL 1 DAY AS updated_on
        FROM lineitem""",
    "report_job_cost": f"""
        SELECT 'Unit ' || (l_orderkey % 25) AS bu_key, CAST(l_orderkey AS VARCHAR) AS job_id,
               l_shipdate AS job_start, {m(PRICE)} AS job_subtotal,
               {m(f'{PRICE} * (CAST(0.5 AS DECIMAL(2,1)) + {DISC})')} AS job_total_costs,
               l_shipdate + l_linenumber * INTERVAL 1 DAY AS updated_on
        FROM lineitem""",
    "report_future_bookings": f"""
        SELECT 'Unit ' || (l_orderkey % 25) AS bu_key, CAST(l_orderkey AS VARCHAR) AS job_id,
               l_shipdate AS scheduled_date, {m(PRICE)} AS job_subtotal,
               l_shipdate - l_linenumber * INTERVAL 1 DAY AS as_of_date
        FROM lineitem""",
    "report_sales": f"""
        SELECT CAST(l_shipdate AS DATE) AS event_date, 'Unit ' || (l_suppkey % 25) AS bu_name,
               'Seller ' || l_suppkey AS estimator, CAST(l_quantity AS BIGINT) AS sales_opportunities,
               CAST(l_linenumber AS BIGINT) AS closed_opportunities, {m(PRICE)} AS total_sales,
               {m(f'{PRICE} * {DISC}')} AS avg_closed_sale
        FROM lineitem""",
    "report_receivables": f"""
        SELECT 'Unit ' || (user_id % 25) AS bu_key, ts AS as_of, event_type AS location_name,
               {EVENT_VALUE} AS net_amount, ts AS updated_on, props AS raw
        FROM events""",
    # --- stage tables -------------------------------------------------------
    "leads_jobs": f"""
        SELECT j.id AS job_id, j.customer_id, j.business_unit, j.job_type_name, j.job_status,
               j.created_on AS job_created_on, j.completed_on AS job_completed_on,
               {ldate('j.created_on')} AS lead_date, c.name AS customer_name
        FROM dim_jobs j LEFT JOIN customers c ON j.customer_id = c.id
        WHERE j.job_type_name ILIKE '%estimate%' AND (c.name IS NULL OR c.name NOT ILIKE '%test%')
          AND j.customer_id IS NOT NULL AND j.created_on IS NOT NULL""",
    "completed_estimates_jobs": f"""
        SELECT id AS job_id, customer_id, business_unit, job_type_name, job_status,
               created_on AS job_created_on, completed_on AS job_completed_on,
               {ldate('completed_on')} AS completed_date
        FROM dim_jobs WHERE job_type_name ILIKE '%estimate%' AND job_status = 'Completed'
          AND completed_on IS NOT NULL""",
    "sold_estimates": f"""
        SELECT e.id AS estimate_id, e.job_id, j.customer_id, j.business_unit,
               e.status AS estimate_status, COALESCE(e.total, e.subtotal) AS revenue_amount,
               e.created_on AS estimate_created_on, e.sold_on AS estimate_sold_on,
               {ldate('e.sold_on')} AS sold_date
        FROM estimates e JOIN dim_jobs j ON e.job_id = j.id
        WHERE e.status = 'Sold' AND e.sold_on IS NOT NULL""",
    "opportunity_jobs": f"""
        SELECT j.id AS job_id, j.customer_id, j.business_unit, j.job_status, j.job_type_name,
               j.created_on AS job_created_on, j.completed_on AS job_completed_on,
               COALESCE(e.n, 0) AS estimate_count, COALESCE(e.sold, 0) AS sold_estimate_count,
               e.first_sold AS earliest_sold_on,
               {ldate('COALESCE(e.first_sold, j.completed_on)')} AS opportunity_date,
               TRUE AS is_sales_opportunity, COALESCE(e.sold, 0) >= 1 AS is_closed_opportunity
        FROM dim_jobs j
        LEFT JOIN (SELECT job_id, COUNT(*) AS n, COUNT(*) FILTER (status = 'Sold') AS sold,
                          MIN(sold_on) FILTER (status = 'Sold') AS first_sold
                   FROM estimates GROUP BY job_id) e ON e.job_id = j.id
        LEFT JOIN (SELECT job_id, SUM(subtotal) AS sub FROM invoices GROUP BY job_id) i
               ON i.job_id = j.id
        WHERE j.business_unit LIKE '%-Sales' AND (COALESCE(e.n, 0) > 0 OR COALESCE(i.sub, 0) <> 0)""",
    "job_costing": """
        SELECT *, revenue_subtotal - total_cost AS gross_profit FROM (
        SELECT j.id AS job_id, j.job_number, j.job_type_name AS job_type, j.job_status,
               j.business_unit_id, j.business_unit, a.s AS job_start_date, a.e AS job_end_date,
               j.completed_on AS completed_date, j.created_on AS created_date,
               COALESCE(i.sub, 0) AS revenue_subtotal, COALESCE(i.tot, 0) AS revenue_total,
               COALESCE(l.pay, 0) AS labor_cost,
               COALESCE(p.cost, 0) - COALESCE(r.credit, 0) AS material_cost_net,
               COALESCE(l.pay, 0) + COALESCE(p.cost, 0) - COALESCE(r.credit, 0) AS total_cost,
               COALESCE(l.pay, 0) AS labor_gross_pay, COALESCE(p.cost, 0) AS material_cost_raw,
               COALESCE(r.credit, 0) AS return_credit, COALESCE(i.n, 0) AS invoice_count,
               COALESCE(l.techs, 0) AS tech_count, COALESCE(p.n, 0) AS po_count,
               COALESCE(j.job_type_name IN ('Warranty', 'Touchup'), FALSE) AS is_warranty
        FROM dim_jobs j
        JOIN (SELECT job_id, MIN(scheduled_start) AS s, MAX(scheduled_end) AS e FROM appts GROUP BY 1) a
             ON a.job_id = j.id
        LEFT JOIN (SELECT job_id, SUM(subtotal) AS sub, SUM(total) AS tot, COUNT(*) AS n
                   FROM invoices GROUP BY 1) i ON i.job_id = j.id
        LEFT JOIN (SELECT job_id, SUM(amount) AS pay, COUNT(DISTINCT employee_id) AS techs
                   FROM (SELECT DISTINCT job_id, employee_id, date, activity, amount,
                                paid_duration_hours FROM payroll) GROUP BY 1) l ON l.job_id = j.id
        LEFT JOIN (SELECT job_id, SUM(total) AS cost, COUNT(*) AS n FROM pos
                   WHERE status <> 'Canceled' GROUP BY 1) p ON p.job_id = j.id
        LEFT JOIN (SELECT job_id, SUM(total) AS credit FROM rets GROUP BY 1) r ON r.job_id = j.id
        WHERE a.s IS NOT NULL)""",
    "production_jobs": """
        SELECT job_id, business_unit, job_status, revenue_subtotal, gross_profit, total_cost,
               labor_cost, material_cost_net, is_warranty, job_start_date AS start_date,
               completed_date AS completion_date
        FROM job_costing WHERE business_unit LIKE '%-Production'
          AND job_status IN ('Completed','Hold','Scheduled','InProgress','Canceled')""",
}

_NAMES = {name: re.compile(rf"\b{name}\b") for name in CTES}


def _closure(text: str, extra: dict[str, str]) -> list[str]:
    bodies = {**CTES, **extra}
    patterns = {**_NAMES, **{n: re.compile(rf"\b{n}\b") for n in extra}}
    order: list[str] = []

    def visit(body: str, seen: frozenset[str]) -> None:
        for name, pattern in patterns.items():
            if name in order or name in seen or not pattern.search(body):
                continue
            visit(bodies[name], seen | {name})
            if name not in order:
                order.append(name)

    visit(text, frozenset())
    return order


def sql(body: str, **extra: str) -> str:
    """``body`` with the domain tables it names (and ``extra`` ones) put in front."""
    names = _closure(body, extra)
    bodies = {**CTES, **extra}
    if not names:
        return body.strip()
    head = ",\n".join(f"{n} AS ({bodies[n].strip()})" for n in names)
    return f"WITH {head}\n{body.strip()}"
