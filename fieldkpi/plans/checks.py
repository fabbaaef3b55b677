"""Quality checks, reconciliations and diagnostics over the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldkpi.functions.constants import FLAG_RED
from fieldkpi.functions.expr import day_range, local_date, percent, sum_money
from fieldkpi.operators import costing, diagnostics, marts, quality, reconcile
from fieldkpi.operators.quality import Check, Metric
from fieldkpi.operators.reconcile import COUNT_BAND, DOLLAR_BAND, MARGIN_BAND, WARRANTY_BAND
from fieldkpi.plans.catalog import query
from fieldkpi.plans.domain import Domain
from fieldkpi.plans.kpis import (
    DAILY,
    KPI_WEEKS,
    REGIONS,
    TEN_KPI_SQL,
    daily_kpis,
    kpi_weeks,
    ten_kpis,
)
from fieldkpi.plans.oracle import dsum, ldate, pct, ratio, rnd, rsum
from fieldkpi.plans.stage_marts import (
    FACT,
    FINAL,
    completed,
    final_costing,
    job_costing,
    leads,
    opportunities,
    opportunity_daily,
    production,
    sold,
)
from fieldkpi.sources import readers
from fieldkpi.sources.literals import literal_relation

AS_OF = "2000-01-01"
NOW = "2000-01-01 00:00:00"
PAID_AS_OF = "2024-01-31"
WEEK = ("1998-03-02", "1998-03-08")
MONTHS = ("1998-03-01", "1998-05-31")


# --- quality ---------------------------------------------------------------------------


def stoplight(d: Domain) -> DataFrame:
    recent = quality.last_days("created_on", AS_OF, 30)
    paid = quality.last_days("created_on", PAID_AS_OF, 30)
    sold_share = F.count(F.when(recent & (F.col("status") == "Sold"), 1)) / F.count(F.when(recent, 1))
    return quality.stoplight(
        [
            (
                d.invoices(),
                [
                    Metric("Invoice Job Coverage", quality.coverage("job_id", recent), 90, 95),
                    Metric("Invoice BU Coverage", quality.coverage("business_unit_id", recent), 85, 95),
                    Metric("Invoices Data Freshness", quality.hours_old("modified_on", NOW), 48, 4, "hours", False),
                    Metric("Invoices Daily Volume", quality.volume("created_on", "1999-12-31"), 30, 100, "records"),
                    Metric("Invoice Duplicates", quality.duplicates("id", recent), 10, 1, "records", False),
                ],
            ),
            (d.payments(), [Metric("Payment Invoice Coverage", quality.coverage("invoice_id", paid), 95, 98)]),
            (
                d.estimates(),
                [
                    Metric("Estimate Job Coverage", quality.coverage("job_id", recent), 90, 95),
                    Metric("Average Close Rate", sold_share * 100, 15, 25),
                ],
            ),
            (
                d.jobs(),
                [
                    Metric("Jobs Data Freshness", quality.hours_old("modified_on", NOW), 48, 4, "hours", False),
                    Metric("Jobs Daily Volume", quality.volume("created_on", "1999-12-31"), 50, 200, "records"),
                ],
            ),
            (
                d.payroll(),
                [Metric("Payroll Data Freshness", quality.hours_old("modified_on", NOW), 72, 24, "hours", False)],
            ),
        ]
    )


def _recent(column: str, as_of: str = AS_OF, days: int = 30) -> str:
    return f"{column} >= TIMESTAMP '{as_of}' - INTERVAL {days} DAY"


def _share(column: str, table: str, as_of: str = AS_OF) -> str:
    return f"(SELECT {pct(f'COUNT({column})', 'COUNT(*)')} FROM {table} WHERE {_recent('created_on', as_of)})"


def _age(table: str) -> str:
    return f"(SELECT CAST(date_sub('hour', MAX(modified_on), TIMESTAMP '{NOW}') AS DOUBLE) FROM {table})"


def _volume(table: str) -> str:
    return f"(SELECT CAST(COUNT(*) AS DOUBLE) FROM {table} WHERE CAST(created_on AS DATE) = DATE '1999-12-31')"


_STOPLIGHT = f"""SELECT metric, value, unit, red_threshold, green_threshold, CASE
        WHEN up AND value < red_threshold THEN '🔴 RED' WHEN up AND value >= green_threshold THEN '🟢 GREEN'
        WHEN NOT up AND value > red_threshold THEN '🔴 RED'
        WHEN NOT up AND value <= green_threshold THEN '🟢 GREEN' ELSE '🟡 YELLOW' END AS status
    FROM (VALUES
        ('Invoice Job Coverage', {_share('job_id', 'invoices')}, '%', 90.0::DOUBLE, 95.0::DOUBLE, TRUE),
        ('Invoice BU Coverage', {_share('business_unit_id', 'invoices')}, '%', 85, 95, TRUE),
        ('Payment Invoice Coverage', {_share('invoice_id', 'payments', PAID_AS_OF)}, '%', 95, 98, TRUE),
        ('Estimate Job Coverage', {_share('job_id', 'estimates')}, '%', 90, 95, TRUE),
        ('Jobs Data Freshness', {_age('jobs')}, 'hours', 48, 4, FALSE),
        ('Invoices Data Freshness', {_age('invoices')}, 'hours', 48, 4, FALSE),
        ('Payroll Data Freshness', {_age('payroll')}, 'hours', 72, 24, FALSE),
        ('Jobs Daily Volume', {_volume('jobs')}, 'records', 50, 200, TRUE),
        ('Invoices Daily Volume', {_volume('invoices')}, 'records', 30, 100, TRUE),
        ('Average Close Rate', (SELECT COUNT(*) FILTER (status = 'Sold') / COUNT(*)::DOUBLE * 100 FROM estimates
            WHERE {_recent('created_on')}), '%', 15, 25, TRUE),
        ('Invoice Duplicates', (SELECT CAST(COUNT(*) - COUNT(DISTINCT id) AS DOUBLE) FROM invoices
            WHERE {_recent('created_on')}), 'records', 10, 1, FALSE)
    ) t(metric, value, unit, red_threshold, green_threshold, up)"""

query("dq_01_stoplight", "SELECT * FROM stoplight_rows", stoplight_rows=_STOPLIGHT)(stoplight)


_COVERED = {
    "jobs": ("created_on", "business_unit_id"),
    "invoices": ("created_on", "business_unit_id"),
    "estimates": ("created_on", "sold_by_id"),
    "payments": ("created_on", "payment_type_id"),
    "payroll": ("date", "employee_id"),
    "purchase_orders": ("date", "vendor_id"),
    "appointments": ("created_on", "status"),
    "returns": ("return_date", "vendor_id"),
}
_SQL_NAME = {"purchase_orders": "pos", "appointments": "appts", "returns": "rets"}


def month_coverage(d: Domain) -> DataFrame:
    entities = {n: (getattr(d, n)(), at, of) for n, (at, of) in _COVERED.items()}
    return quality.monthly_coverage(entities, "1996-01-01")


_MONTHLY = f"""SELECT entity, month, record_count, distinct_values,
    CASE WHEN prior > 0 THEN {pct('record_count - prior', 'prior', 1)} END AS month_over_month_pct,
    CASE WHEN record_count < 100 THEN '🟡 LOW' ELSE '🟢 OK' END AS status
    FROM (SELECT *, LAG(record_count) OVER (PARTITION BY entity ORDER BY month) AS prior FROM ({" UNION ALL ".join(
        f"SELECT '{n}' AS entity, CAST(date_trunc('month', {at}) AS DATE) AS month, COUNT(*) AS record_count,"
        f" COUNT(DISTINCT {of}) AS distinct_values FROM {_SQL_NAME.get(n, n)}"
        f" WHERE {at} >= TIMESTAMP '1996-01-01' GROUP BY 2" for n, (at, of) in _COVERED.items())}))"""

query("dq_02_monthly_coverage", "SELECT * FROM monthly", monthly=_MONTHLY)(month_coverage)


def integrity(d: Domain) -> DataFrame:
    return quality.join_integrity(
        [
            (d.invoices(), "created_on", {"invoices_to_jobs": "job_id", "invoices_to_business_units": "business_unit_id"}),
            (d.payroll(), "date", {"payroll_to_jobs": "job_id"}),
            (d.estimates(), "created_on", {"estimates_to_jobs": "job_id", "estimates_to_sellers": "sold_by_id"}),
            (
                d.jobs(),
                "created_on",
                {
                    "jobs_to_customers": "customer_id",
                    "jobs_to_business_units": "business_unit_id",
                    "jobs_to_campaigns": "campaign_id",
                },
            ),
        ],
        AS_OF,
    ).unionByName(
        quality.join_integrity(
            [(d.payments(), "created_on", {"payments_to_invoices": "invoice_id"})], PAID_AS_OF
        )
    )


def _join_row(name: str, table: str, column: str, at: str = "created_on", as_of: str = AS_OF) -> str:
    return (
        f"SELECT '{name}' AS join_type, COUNT(*) AS n, COUNT({column}) AS f FROM {table}"
        f" WHERE {_recent(at, as_of, 90)}"
    )


_INTEGRITY = f"""SELECT join_type, n AS total_records, f AS records_with_join, n - f AS records_missing_join,
        {pct('f', 'n')} AS coverage_percent,
        CASE WHEN join_type IN ('invoices_to_jobs', 'payments_to_invoices', 'estimates_to_jobs') AND {pct('f', 'n')} < 85 THEN '🔴 CRITICAL'
             WHEN {pct('f', 'n')} < 70 THEN '🟡 WARNING' WHEN {pct('f', 'n')} >= 95 THEN '🟢 EXCELLENT'
             ELSE '🟢 OK' END AS status,
        CASE WHEN join_type IN ('invoices_to_jobs', 'estimates_to_jobs') THEN 90.0::DOUBLE
             WHEN join_type = 'payments_to_invoices' THEN 95
             WHEN join_type LIKE '%_to_business_units' THEN 85 ELSE 75 END AS threshold_percent
    FROM ({" UNION ALL ".join([
        _join_row("invoices_to_jobs", "invoices", "job_id"),
        _join_row("invoices_to_business_units", "invoices", "business_unit_id"),
        _join_row("payroll_to_jobs", "payroll", "job_id", "date"),
        _join_row("estimates_to_jobs", "estimates", "job_id"),
        _join_row("estimates_to_sellers", "estimates", "sold_by_id"),
        _join_row("jobs_to_customers", "jobs", "customer_id"),
        _join_row("jobs_to_business_units", "jobs", "business_unit_id"),
        _join_row("jobs_to_campaigns", "jobs", "campaign_id"),
        _join_row("payments_to_invoices", "payments", "invoice_id", "created_on", PAID_AS_OF)])})"""

query("dq_03_join_integrity", "SELECT * FROM integrity", integrity=_INTEGRITY)(integrity)


def _spread(c: str, mean: str, sd: str) -> str:
    return (
        f"CASE WHEN ABS({c} - {mean}) > 3 * COALESCE({sd}, 1) THEN '🔴'"
        f" WHEN ABS({c} - {mean}) > 2 * COALESCE({sd}, 1) THEN '🟡' ELSE '🟢' END"
    )


_ANOMALY = KPI_WEEKS | {
    "unit_stats": """SELECT business_unit, AVG(leads) AS ml, STDDEV(leads) AS sl, AVG(total_booked) AS mb,
        STDDEV(total_booked) AS sb, AVG(dollars_produced) AS mp, STDDEV(dollars_produced) AS sp
        FROM kpi_weeks GROUP BY 1""",
    "anomalies": f"""SELECT *, leads_flag || booked_flag || produced_flag || gpm_flag || close_rate_flag AS overall_status
        FROM (SELECT week_start, w.business_unit, leads, {_spread('leads', 'ml', 'sl')} AS leads_flag,
            {rnd('total_booked', 0)} AS total_booked, {_spread('total_booked', 'mb', 'sb')} AS booked_flag,
            {rnd('dollars_produced', 0)} AS dollars_produced, {_spread('dollars_produced', 'mp', 'sp')} AS produced_flag,
            {rnd('avg_gpm_percent', 1)} AS gpm_pct,
            CASE WHEN avg_gpm_percent < 20 OR avg_gpm_percent > 80 THEN '🔴' WHEN avg_gpm_percent < 30 THEN '🟡'
                 ELSE '🟢' END AS gpm_flag,
            {rnd('avg_close_rate', 1)} AS close_rate_pct,
            CASE WHEN avg_close_rate < 10 THEN '🔴' WHEN avg_close_rate < 20 OR avg_close_rate > 90 THEN '🟡'
                 ELSE '🟢' END AS close_rate_flag
        FROM kpi_weeks w JOIN unit_stats s ON w.business_unit = s.business_unit)""",
}


@query("dq_04_weekly_anomalies", "SELECT * FROM anomalies", **_ANOMALY)
def anomalies(d: Domain) -> DataFrame:
    return quality.weekly_anomalies(kpi_weeks(d))


def _suite(d: Domain) -> dict[str, Check]:
    lights = stoplight(d)
    return {
        "Coverage by Month": Check(month_coverage(d), "status", quality.any_status("status", "NO DATA")),
        "Join Integrity": Check(integrity(d), "status", quality.any_status("status", "CRITICAL")),
        "Data Quality Stoplight": Check(lights, "status", F.count_if(F.col("status").contains(FLAG_RED)) > 2),
    }


def _suite_row(name: str, table: str, failed: str) -> str:
    flags = ", ".join(
        f"COUNT(*) FILTER (status LIKE '%{f}%') AS {n}"
        for f, n in (("🔴", "red"), ("🟡", "yellow"), ("🟢", "green"))
    )
    return (
        f"SELECT '{name}' AS \"check\", CASE WHEN {failed} THEN 'FAILED' ELSE 'PASSED' END AS status,"
        f" COUNT(*) AS row_count, {flags} FROM {table}"
    )


_SUITE = {"stoplight_rows": _STOPLIGHT, "monthly": _MONTHLY, "integrity": _INTEGRITY}


@query(
    "dq_05_suite",
    " UNION ALL ".join(
        [
            _suite_row("Coverage by Month", "monthly", "bool_or(status LIKE '%NO DATA%')"),
            _suite_row("Join Integrity", "integrity", "bool_or(status LIKE '%CRITICAL%')"),
            _suite_row("Data Quality Stoplight", "stoplight_rows", "COUNT(*) FILTER (status LIKE '%🔴%') > 2"),
        ]
    ),
    **_SUITE,
)
def _(d: Domain) -> DataFrame:
    return quality.run_suite(_suite(d))


def _sample_rows(name: str, table: str) -> str:
    """The first five rows of a check in the order of its columns, as JSON of texts."""
    return (
        f"SELECT '{name}' AS \"check\", CAST(to_json(x) AS VARCHAR) AS sample FROM (SELECT CAST(COLUMNS(*) AS VARCHAR)"
        f" FROM (SELECT * FROM {table} ORDER BY ALL NULLS FIRST LIMIT 5)) x"
    )


@query(
    "dq_05_suite_samples",
    " UNION ALL ".join(
        [
            _sample_rows("Coverage by Month", "monthly"),
            _sample_rows("Join Integrity", "integrity"),
            _sample_rows("Data Quality Stoplight", "stoplight_rows"),
        ]
    ),
    **_SUITE,
)
def _(d: Domain) -> DataFrame:
    return quality.suite_samples(_suite(d))


@query("dq_06_duplicate_keys", "SELECT id, COUNT(*) AS copies FROM estimates GROUP BY 1 HAVING COUNT(*) > 1")
def _(d: Domain) -> DataFrame:
    return quality.duplicate_keys(d.estimates(), ["id"])


@query(
    "dq_07_orphans",
    """SELECT invoice_id, COUNT(*) AS rows FROM (SELECT invoice_id * 3 - 2 AS invoice_id FROM payments)
       WHERE invoice_id IS NOT NULL AND invoice_id NOT IN (SELECT id FROM invoices) GROUP BY 1""",
)
def _(d: Domain) -> DataFrame:
    """All payments against all invoices; their invoice numbers are stretched, so that some name none."""
    payments = d.payments().withColumn("invoice_id", F.col("invoice_id") * 3 - 2)
    return quality.orphans(payments, d.invoices(), "invoice_id")


@query(
    "dq_08_date_gaps",
    """SELECT CAST(d AS DATE) AS date, CAST(COALESCE(l.n, 0) AS BIGINT) AS leads,
              CAST(COALESCE(c.n, 0) AS BIGINT) AS completed,
              CASE WHEN l.n IS NULL AND c.n IS NULL THEN 'No Data' ELSE 'OK' END AS status
       FROM (SELECT unnest(generate_series(MIN(o_orderdate), MAX(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)
       LEFT JOIN (SELECT lead_date, COUNT(*) AS n FROM leads_jobs GROUP BY 1) l ON l.lead_date = CAST(d AS DATE)
       LEFT JOIN (SELECT completed_date, COUNT(*) AS n FROM completed_estimates_jobs GROUP BY 1) c
            ON c.completed_date = CAST(d AS DATE)""",
)
def _(d: Domain) -> DataFrame:
    bounds = d.table("orders").agg(
        F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last")
    )
    return quality.date_gaps(
        readers.calendar(bounds),
        marts.leads_daily_unit(leads(d)),
        marts.completed_estimates_daily(completed(d)),
    )


_DATED = {"jobs": "modified_on", "invoices": "modified_on", "estimates": "modified_on", "payments": "created_on",
          "payroll": "modified_on", "purchase_orders": "modified_on", "appointments": "modified_on"}


@query(
    "dq_09_entity_coverage",
    " UNION ALL ".join(
        f"SELECT '{n}' AS entity, COUNT(*) AS row_count, CAST(MIN({at}) AS DATE) AS earliest_date,"
        f" CAST(MAX({at}) AS DATE) AS latest_date, COUNT(DISTINCT CAST({at} AS DATE)) AS distinct_days,"
        f" CAST(MAX({at}) AS DATE) - CAST(MIN({at}) AS DATE) AS days_of_data FROM {_SQL_NAME.get(n, n)}"
        for n, at in _DATED.items()
    ),
)
def _(d: Domain) -> DataFrame:
    return quality.entity_coverage({n: (getattr(d, n)(), at) for n, at in _DATED.items()})


@query("dq_10_rows_per_year", "SELECT year(created_on) AS year, COUNT(*) AS records FROM jobs GROUP BY 1")
def _(d: Domain) -> DataFrame:
    return quality.rows_per_year(d.jobs())


@query(
    "dq_11_allow_list",
    """SELECT COUNT(DISTINCT job_type_id) AS job_types_found, COUNT(*) AS jobs_found FROM jobs
       WHERE job_type_id IN (1, 2, 99)""",
)
def _(d: Domain) -> DataFrame:
    return quality.allow_list_found(d.jobs(), (1, 2, 99))


@query(
    "dq_11_allow_list_rows",
    """SELECT job_type_id, COUNT(*) AS job_count, COUNT(DISTINCT customer_id) AS unique_customers FROM jobs
       WHERE job_type_id IN (1, 2, 99) GROUP BY 1""",
)
def _(d: Domain) -> DataFrame:
    return quality.allow_list_rows(d.jobs(), (1, 2, 99))


_DAY_UNIT = {
    "day_leads": """SELECT lead_date AS kpi_date, business_unit, COUNT(DISTINCT customer_id) AS u FROM leads_jobs GROUP BY 1, 2""",
    "day_done": """SELECT completed_date AS kpi_date, business_unit, COUNT(*) AS n FROM completed_estimates_jobs GROUP BY 1, 2""",
    "day_opps": """SELECT opportunity_date AS kpi_date, business_unit, COUNT(*) AS n FROM opportunity_jobs
            WHERE opportunity_date IS NOT NULL GROUP BY 1, 2""",
}


@query(
    "dq_12_completed_above_leads",
    f"""SELECT kpi_date, business_unit, l.u AS leads, c.n AS completed_estimates
        FROM day_leads l LEFT JOIN day_done c USING (kpi_date, business_unit)
        WHERE kpi_date BETWEEN DATE '{AS_OF}' - 3000 AND DATE '{AS_OF}' AND COALESCE(c.n, 0) > l.u
        ORDER BY kpi_date DESC, business_unit LIMIT 10""",
    **_DAY_UNIT,
)
def _(d: Domain) -> DataFrame:
    return quality.completed_above_leads(
        marts.leads_daily_unit(leads(d)), marts.completed_estimates_daily(completed(d)), AS_OF, days=3000
    )


@query(
    "dq_13_opportunities_without_estimates",
    "SELECT COUNT(*) FILTER (estimate_count = 0) AS jobs_without_estimates FROM opportunity_jobs",
)
def _(d: Domain) -> DataFrame:
    return quality.opportunities_without_estimates(opportunities(d))


@query(
    "dq_14_zone_shift",
    f"""SELECT COUNT(*) FILTER (CAST(ts AS DATE) <> {ldate('ts')}) AS dates_differ_from_utc, COUNT(*) AS total_rows,
               {pct(f"COUNT(*) FILTER (CAST(ts AS DATE) <> {ldate('ts')})", 'COUNT(*)')} AS pct_different FROM events""",
)
def _(d: Domain) -> DataFrame:
    rows = d.table("events").withColumn("local_day", local_date("ts"))
    return quality.zone_shift(rows, "ts", "local_day")


@query(
    "dq_15_unit_distribution",
    f"""SELECT business_unit, COUNT(DISTINCT kpi_date) AS days_with_data, CAST(SUM(l.u) AS BIGINT) AS total_leads,
               CAST(SUM(COALESCE(c.n, 0)) AS BIGINT) AS total_completed,
               CAST(SUM(COALESCE(o.n, 0)) AS BIGINT) AS total_opportunities
        FROM day_leads l LEFT JOIN day_done c USING (kpi_date, business_unit) LEFT JOIN day_opps o USING (kpi_date, business_unit)
        WHERE kpi_date BETWEEN DATE '{AS_OF}' - 90 AND DATE '{AS_OF}' GROUP BY 1""",
    **_DAY_UNIT,
)
def _(d: Domain) -> DataFrame:
    return quality.unit_distribution(
        marts.leads_daily_unit(leads(d)),
        marts.completed_estimates_daily(completed(d)),
        opportunity_daily(d),
        AS_OF,
    )


@query(
    "dq_15_days_since_last",
    "SELECT MAX(lead_date) AS most_recent_date, DATE '2002-01-01' - MAX(lead_date) AS days_since_last_data FROM leads_jobs",
)
def _(d: Domain) -> DataFrame:
    return quality.days_since_last(marts.leads_daily(leads(d)), "2002-01-01")


@query(
    "dq_15_mart_summary",
    " UNION ALL ".join(
        f"SELECT '{n}' AS mart, COUNT(*) AS rows, COUNT(DISTINCT business_unit) AS units,"
        f" MIN(kpi_date) AS first_date, MAX(kpi_date) AS last_date FROM {t}"
        for n, t in (("leads", "day_leads"), ("completed", "day_done"), ("opportunities", "day_opps"))
    ),
    **_DAY_UNIT,
)
def _(d: Domain) -> DataFrame:
    return quality.mart_summary(
        {
            "leads": marts.leads_daily_unit(leads(d)),
            "completed": marts.completed_estimates_daily(completed(d)),
            "opportunities": opportunity_daily(d),
        }
    )


@query(
    "dq_16_unlisted_types",
    """SELECT DISTINCT job_type_name FROM dim_jobs
       WHERE job_type_name NOT IN ('ESTIMATE-RES-EXT', 'Warranty')""",
)
def _(d: Domain) -> DataFrame:
    allowed = literal_relation(d.spark, "job_type_name string", [("ESTIMATE-RES-EXT",), ("Warranty",), (None,)])
    return quality.unlisted_types(d.dim_jobs(), allowed)


@query(
    "dq_17_payroll_coverage",
    f"""SELECT CAST(completed_on AS DATE) AS job_date, COUNT(*) AS jobs_completed, COUNT(p.pay) AS jobs_with_payroll,
               {dsum('p.pay')} AS total_labor_cost, {rnd(ratio('SUM(p.pay)', 'COUNT(*)'))} AS labor_per_job
        FROM jobs j LEFT JOIN (SELECT job_id, SUM(amount) AS pay FROM payroll GROUP BY 1) p ON p.job_id = j.id
        WHERE completed_on >= TIMESTAMP '1998-01-01' GROUP BY 1""",
)
def _(d: Domain) -> DataFrame:
    return quality.payroll_coverage(d.jobs(), d.payroll(), "1998-01-01")


_FRESH = {"jobs": "modified_on", "invoices": "modified_on", "estimates": "modified_on", "payments": "modified_on",
          "payroll": "modified_on", "purchase_orders": "modified_on", "returns": "return_date"}


@query(
    "dq_18_ingest_freshness",
    " UNION ALL ".join(
        f"SELECT '{n}' AS entity, MAX({at}) AS last_ingested,"
        f" date_sub('hour', MAX({at}), TIMESTAMP '2024-02-01') AS hours_old, COUNT(*) AS total_records"
        f" FROM {_SQL_NAME.get(n, n)}"
        for n, at in _FRESH.items()
    ),
)
def _(d: Domain) -> DataFrame:
    return quality.ingest_freshness(
        {n: (getattr(d, n)(), at) for n, at in _FRESH.items()}, "2024-02-01 00:00:00"
    )


# --- reconciliation ----------------------------------------------------------------------

_EXPECTED = [
    ("AFRICA", 20, 90, 250000.0, 30000000.0, 98.0, 0.5),
    ("AMERICA", 25, 100, 300000.0, 3500000.0, 95.0, 1.0),
    ("ASIA", 15, 80, 260000.0, 4000000.0, 90.0, 0.0),
    ("EUROPE", 30, 90, 250000.0, 2500000.0, 97.0, 1.5),
    ("ATLANTIS", 1, 1, 1.0, 1.0, 1.0, 1.0),
]
_EXPECTED_SQL = f"""SELECT * FROM (VALUES {', '.join(f"('{r[0]}', " + ', '.join(f'{x}::DOUBLE' for x in r[1:]) + ')' for r in _EXPECTED)})
    t(region, lead_count, estimate_count, total_booked, dollars_produced, gpm_percent, warranty_percent)"""
_BANDS = {
    "lead_count": COUNT_BAND,
    "estimate_count": COUNT_BAND,
    "total_booked": DOLLAR_BAND,
    "dollars_produced": DOLLAR_BAND,
    "gpm_percent": MARGIN_BAND,
    "warranty_percent": WARRANTY_BAND,
}


def _status(delta: str, band: reconcile.Band) -> str:
    op = "<=" if band.inclusive else "<"
    return (
        f"CASE WHEN ABS({delta}) {op} {band.exact} THEN '✅ EXACT'"
        f" WHEN ABS({delta}) {op} {band.minor} THEN '⚠️ MINOR' ELSE '🔴 MAJOR' END"
    )


def _x(c: str) -> str:
    return f"CAST({c} AS DECIMAL(28,6))"


_REGIONAL = DAILY | {
    "regions": REGIONS,
    "expected": _EXPECTED_SQL,
    "regional": f"""SELECT region, CAST(SUM(lead_count) AS DOUBLE) AS lead_count,
            CAST(SUM(estimate_count) AS DOUBLE) AS estimate_count,
            CAST(SUM({_x('total_booked')}) AS DOUBLE) AS total_booked,
            CAST(SUM({_x('dollars_produced')}) AS DOUBLE) AS dollars_produced,
            {ratio(f"SUM({_x('gpm_percent')}) FILTER (gpm_percent > 0)", 'COUNT(*) FILTER (gpm_percent > 0)')} AS gpm_percent,
            {ratio(f"SUM({_x('warranty_percent')})", 'COUNT(warranty_percent)')} AS warranty_percent
        FROM daily_kpis JOIN regions USING (business_unit)
        WHERE event_date BETWEEN DATE '{MONTHS[0]}' AND DATE '{MONTHS[1]}' GROUP BY 1""",
}


def regional_window(d: Domain) -> DataFrame:
    """Sums of the window per region; margins as means of the days, as the report has them."""
    exact = "decimal(28,6)"

    def mean(c: str, test: Column) -> Column:
        picked = F.when(test, F.col(c).cast(exact))
        return F.try_divide(F.sum(picked).cast("double"), F.count(picked).cast("double"))

    inside = F.col("event_date").between(*[F.lit(x).cast("date") for x in MONTHS])
    return (
        daily_kpis(d)
        .where(inside)
        .join(d.regions(), "business_unit")
        .groupBy("region")
        .agg(
            F.sum("lead_count").cast("double").alias("lead_count"),
            F.sum("estimate_count").cast("double").alias("estimate_count"),
            F.sum(F.col("total_booked").cast(exact)).cast("double").alias("total_booked"),
            F.sum(F.col("dollars_produced").cast(exact)).cast("double").alias("dollars_produced"),
            mean("gpm_percent", F.col("gpm_percent") > 0).alias("gpm_percent"),
            mean("warranty_percent", F.col("warranty_percent").isNotNull()).alias("warranty_percent"),
        )
    )


def expected_regions(d: Domain) -> DataFrame:
    return literal_relation(
        d.spark,
        "region string, lead_count double, estimate_count double, total_booked double,"
        " dollars_produced double, gpm_percent double, warranty_percent double",
        _EXPECTED,
    )


def _variance_columns(m: str, band: reconcile.Band) -> str:
    delta = rnd(f"a.{m} - e.{m}")
    return f"""e.{m} AS expected_{m}, {rnd(f'a.{m}')} AS actual_{m}, {delta} AS {m}_delta,
        {pct(f'a.{m} - e.{m}', f'e.{m}')} AS {m}_pct, {pct(f'a.{m}', f'e.{m}')} AS {m}_accuracy,
        {_status(delta, band)} AS {m}_status"""


@query(
    "rec_01_variance_by_region",
    f"""SELECT e.region, {', '.join(_variance_columns(m, b) for m, b in _BANDS.items())}
        FROM expected e LEFT JOIN regional a ON a.region = e.region""",
    **_REGIONAL,
)
def _(d: Domain) -> DataFrame:
    return reconcile.variance_by_key(regional_window(d), expected_regions(d), "region", _BANDS)


_GOALS = [("NATION_0-Sales", 50000.0), ("NATION_1-Production", 700000.0), ("NATION_3-Production", 0.0)]


@query(
    "rec_02_report_comparison",
    f"""SELECT *, {rnd('actual - expected')} AS variance, {pct('actual - expected', 'expected')} AS variance_percent,
               {_status(rnd('actual - expected'), DOLLAR_BAND)} AS status
        FROM (SELECT kpi_type, u.business_unit, actual, COALESCE(e.goal, 0) AS expected FROM (
            SELECT 'PRODUCTION' AS kpi_type, business_unit, {rsum(_x('dollars_produced'))} AS actual FROM in_window
                WHERE business_unit LIKE '%-Production' GROUP BY 2
            UNION ALL SELECT 'SALES', business_unit, {rsum(_x('total_booked'))} FROM in_window
                WHERE business_unit LIKE '%-Sales' GROUP BY 2) u
        LEFT JOIN (VALUES {', '.join(f"('{u}', {g}::DOUBLE)" for u, g in _GOALS)}) e(business_unit, goal)
             ON e.business_unit = u.business_unit)""",
    in_window=f"SELECT * FROM daily_kpis WHERE event_date BETWEEN DATE '{MONTHS[0]}' AND DATE '{MONTHS[1]}'",
    **DAILY,
)
def _(d: Domain) -> DataFrame:
    inside = F.col("event_date").between(*[F.lit(x).cast("date") for x in MONTHS])
    production_side = F.col("business_unit").like("%-Production")
    value = F.when(production_side, F.col("dollars_produced")).otherwise(F.col("total_booked"))
    actual = (
        daily_kpis(d)
        .where(inside)
        .groupBy(F.when(production_side, "PRODUCTION").otherwise("SALES").alias("kpi_type"), "business_unit")
        .agg(F.round(F.sum(value.cast("decimal(28,6)")), 2).cast("double").alias("actual"))
    )
    goals = literal_relation(d.spark, "business_unit string, expected double", _GOALS)
    return reconcile.variance_rows(actual, goals, ["business_unit"])


def _market(u: str) -> str:
    return f"replace(replace({u}, '-Sales', ''), '-Production', '')"


_SPAN = ("1996-01-01", "1997-06-30")


def _spanned(column: str) -> str:
    return f"CAST({column} AS DATE) BETWEEN DATE '{_SPAN[0]}' AND DATE '{_SPAN[1]}'"


_PAYMENT_SPAN = ("2024-01-01", "2024-01-20")
_ALWAYS = dict.fromkeys(("lead_date", "sold_date", "completed_date", "start_date", "p.created_on", "i.created_on"), "")
_IN_SPAN = {c: f"AND {_spanned(c)}" for c in ("lead_date", "sold_date", "completed_date")} | {
    "start_date": f"WHERE {_spanned('start_date')}",
    "p.created_on": f"AND CAST(p.created_on AS DATE) BETWEEN DATE '{_PAYMENT_SPAN[0]}' AND DATE '{_PAYMENT_SPAN[1]}'",
    "i.created_on": f"AND CAST(i.created_on AS DATE) <= DATE '{_SPAN[1]}'",
}


def _consolidate(inside: dict[str, str]) -> dict[str, str]:
    return {
        "c_leads": f"""SELECT business_unit, COUNT(DISTINCT customer_id) AS leads FROM leads_jobs
            WHERE business_unit LIKE '%-Sales' {inside['lead_date']} GROUP BY 1""",
        "c_booked": f"""SELECT business_unit, {dsum('revenue_amount')} AS total_booked FROM sold_estimates
            WHERE business_unit LIKE '%-Sales' {inside['sold_date']} GROUP BY 1""",
        "c_done": f"""SELECT business_unit, COUNT(*) AS estimates FROM completed_estimates_jobs
            WHERE business_unit LIKE '%-Sales' {inside['completed_date']} GROUP BY 1""",
        "c_prod": f"""SELECT business_unit, {rsum('revenue_subtotal')} AS dollars_produced,
            {pct('SUM(gross_profit)', 'SUM(revenue_subtotal)')} AS gpm_pct FROM production_jobs
            {inside['start_date']} GROUP BY 1""",
        "c_paid": f"""SELECT j.business_unit, {dsum('p.amount')} AS dollars_collected FROM payments p
            JOIN invoices i ON p.invoice_id = i.id JOIN dim_jobs j ON i.job_id = j.id
            WHERE j.business_unit LIKE '%-Production' {inside['p.created_on']} GROUP BY 1""",
        "c_ar": f"""SELECT j.business_unit, {dsum('i.balance')} AS outstanding_ar FROM invoices i
            JOIN dim_jobs j ON i.job_id = j.id WHERE i.balance >= 10 AND j.business_unit LIKE '%-Production'
              {inside['i.created_on']} GROUP BY 1""",
    }


_BY_MARKET = f"""SELECT COALESCE({', '.join(_market(f'{t}.business_unit') for t in _consolidate(_ALWAYS))}) AS market, leads,
               total_booked, estimates, dollars_produced, gpm_pct, dollars_collected, outstanding_ar
        FROM c_leads FULL JOIN c_booked ON c_leads.business_unit = c_booked.business_unit
        FULL JOIN c_done ON COALESCE(c_leads.business_unit, c_booked.business_unit) = c_done.business_unit
        FULL JOIN c_prod ON {_market('COALESCE(c_leads.business_unit, c_booked.business_unit, c_done.business_unit)')}
             = {_market('c_prod.business_unit')}
        FULL JOIN c_paid ON c_prod.business_unit = c_paid.business_unit
        FULL JOIN c_ar ON COALESCE(c_prod.business_unit, c_paid.business_unit) = c_ar.business_unit"""


def _by_market(leads: DataFrame, sold: DataFrame, completed: DataFrame, made: DataFrame, paid: DataFrame, invoices: DataFrame, jobs: DataFrame) -> DataFrame:
    def sales(df: DataFrame) -> DataFrame:
        return df.where(F.col("business_unit").like("%-Sales")).groupBy("business_unit")

    produced = made.groupBy("business_unit").agg(
        F.round(sum_money("revenue_subtotal"), 2).cast("double").alias("dollars_produced"),
        percent(sum_money("gross_profit"), sum_money("revenue_subtotal")).alias("gpm_pct"),
    )
    return reconcile.by_market(
        [
            sales(leads).agg(F.countDistinct("customer_id").alias("leads")),
            sales(sold).agg(F.sum("revenue_amount").cast("double").alias("total_booked")),
            sales(completed).agg(F.count("*").alias("estimates")),
            produced,
            paid.groupBy("business_unit").agg(sum_money("amount").cast("double").alias("dollars_collected")),
            marts.receivables_with_floor(invoices, jobs),
        ]
    )


@query("rec_03_all_kpis_by_market", _BY_MARKET, **_consolidate(_ALWAYS))
def _(d: Domain) -> DataFrame:
    """Every branch over all its rows."""
    paid = marts.payments_with_unit(d.payments(), d.invoices(), d.dim_jobs())
    return _by_market(leads(d), sold(d), completed(d), production(d), paid, d.invoices(), d.dim_jobs())


@query("rec_03_all_kpis_by_market_window", _BY_MARKET, **_consolidate(_IN_SPAN))
def _(d: Domain) -> DataFrame:
    """Each branch in the window by its own date, receivables as they stood at its end; payments are of another time."""
    payments = d.payments().where(day_range("created_on", *_PAYMENT_SPAN))
    return _by_market(
        leads(d).where(F.col("lead_date").between(*_SPAN)),
        sold(d).where(F.col("sold_date").between(*_SPAN)),
        completed(d).where(F.col("completed_date").between(*_SPAN)),
        production(d).where(day_range("start_date", *_SPAN)),
        marts.payments_with_unit(payments, d.invoices(), d.dim_jobs()),
        d.invoices().where(day_range("created_on", "1900-01-01", _SPAN[1])),
        d.dim_jobs(),
    )


_TEN = (
    "lead_count total_booked dollars_produced gpm_percent warranty_percent dollars_collected num_estimates"
    " close_rate_percent future_bookings outstanding_ar"
).split()


def week_by_unit(d: Domain) -> DataFrame:
    """Counts and dollars summed over the week, rates averaged, snapshots by maximum."""
    exact = "decimal(28,6)"
    rates = ("gpm_percent", "warranty_percent", "close_rate_percent")

    def measure(c: str) -> Column:
        if c in ("future_bookings", "outstanding_ar"):
            return F.max(c).alias(c)
        total = F.sum(F.col(c).cast(exact)).cast("double")
        if c in rates:
            return F.try_divide(total, F.count(c).cast("double")).alias(c)
        return total.alias(c)

    inside = F.col("event_date").between(*[F.lit(x).cast("date") for x in WEEK])
    return ten_kpis(d, WEEK).where(inside).groupBy("business_unit").agg(*[measure(c) for c in _TEN])


def _week_measure(c: str) -> str:
    if c in ("future_bookings", "outstanding_ar"):
        return f"MAX({c}) AS {c}"
    if c in ("gpm_percent", "warranty_percent", "close_rate_percent"):
        return f"{ratio(f'SUM({_x(c)})', f'COUNT({c})')} AS {c}"
    return f"CAST(SUM({_x(c)}) AS DOUBLE) AS {c}"


_BASELINE = [
    ("NATION_0-Sales", 2.0, 10000.0, 0.0, 0.0, 0.0, 0.0, 1.0, 20.0, 0.0, 0.0),
    ("NATION_2-Sales", 1.0, 250000.0, 0.0, 0.0, 0.0, 0.0, 2.0, 15.0, 0.0, 0.0),
    ("NATION_1-Production", 0.0, 0.0, 500000.0, 90.0, 1.0, 0.0, 0.0, 0.0, 100000.0, 50000000.0),
    ("NATION_99-Sales", 5.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0),
]
_WEEK_SQL = TEN_KPI_SQL | {
    "week_units": f"""SELECT business_unit, {', '.join(_week_measure(c) for c in _TEN)} FROM ten_kpis
        WHERE event_date BETWEEN DATE '{WEEK[0]}' AND DATE '{WEEK[1]}' GROUP BY 1""",
    "baseline": f"""SELECT * FROM (VALUES {', '.join(f"('{r[0]}', " + ', '.join(f'{x}::DOUBLE' for x in r[1:]) + ')' for r in _BASELINE)})
        t(business_unit, {', '.join(_TEN)})""",
    "long_rows": " UNION ALL ".join(
        f"SELECT e.business_unit, '{c}' AS kpi, e.{c} AS expected, a.{c} AS actual"
        f" FROM baseline e LEFT JOIN week_units a USING (business_unit)"
        for c in _TEN
    ),
    "graded": f"""SELECT business_unit, kpi, expected, actual,
            CASE WHEN known THEN {rnd('actual - expected')} END AS variance,
            CASE WHEN known THEN {pct('actual - expected', 'expected')} END AS variance_percent,
            CASE WHEN NOT known THEN '⚠️' WHEN ABS({pct('actual - expected', 'expected')}) > 10 THEN '🔴'
                 WHEN ABS({pct('actual - expected', 'expected')}) > 1 THEN '⚠️' ELSE '✅' END AS status
        FROM (SELECT *, COALESCE(expected <> 0 AND actual <> 0, FALSE) AS known FROM long_rows)""",
}


def baseline(d: Domain) -> DataFrame:
    schema = "business_unit string, " + ", ".join(f"{c} double" for c in _TEN)
    return literal_relation(d.spark, schema, _BASELINE)


@query(
    "rec_04_week_comparison",
    f"""SELECT e.business_unit, {', '.join(f'e.{c} AS expected_{c}, {rnd(f"a.{c}")} AS actual_{c}, '
            f'{rnd(f"a.{c} - e.{c}")} AS {c}_delta, {pct(f"a.{c} - e.{c}", f"e.{c}")} AS {c}_pct, '
            f'{pct(f"a.{c}", f"e.{c}")} AS {c}_accuracy, {_status(rnd(f"a.{c} - e.{c}"), DOLLAR_BAND)} AS {c}_status'
            for c in _TEN)}
        FROM baseline e LEFT JOIN week_units a USING (business_unit)""",
    **_WEEK_SQL,
)
def _(d: Domain) -> DataFrame:
    return reconcile.variance_by_key(
        week_by_unit(d), baseline(d), "business_unit", {c: DOLLAR_BAND for c in _TEN}
    )


def long_rows(d: Domain) -> DataFrame:
    return reconcile.long_comparison(week_by_unit(d), baseline(d), "business_unit", _TEN)


@query("rec_13_variance_rows", "SELECT * FROM graded", **_WEEK_SQL)
def _(d: Domain) -> DataFrame:
    return long_rows(d)


@query(
    "rec_13_variance_summary",
    """SELECT COUNT(*) FILTER (status = '✅') AS perfect, COUNT(*) FILTER (status = '⚠️') AS minor,
              COUNT(*) FILTER (status = '🔴') AS major FROM graded""",
    **_WEEK_SQL,
)
def _(d: Domain) -> DataFrame:
    return reconcile.comparison_summary(long_rows(d))


_LISTS = {
    "listed": """SELECT o_orderkey AS job_id, CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DECIMAL(18,4)) AS revenue
        FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT -o_orderkey - 1, 5 FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'""",
    "ours": """SELECT job_id, revenue_subtotal AS revenue FROM job_costing
        WHERE job_status IN ('Completed', 'Hold')""",
    "issues": """SELECT COALESCE(l.job_id, o.job_id) AS job_id, l.revenue AS listed_revenue, o.revenue,
        CASE WHEN o.job_id IS NULL THEN 'Job not found'
             WHEN l.job_id IS NULL THEN CASE WHEN o.revenue > 0 THEN 'Not listed' END
             WHEN o.revenue = 0 THEN 'Job without revenue'
             WHEN o.revenue <> l.revenue THEN 'Revenue mismatch' END AS reason
        FROM listed l FULL JOIN ours o ON l.job_id = o.job_id""",
}


def listed_jobs(d: Domain) -> DataFrame:
    """Completed jobs with their order value, and some ids that do not exist."""
    value = "CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DECIMAL(18,4))"
    orders = d.table("orders")
    real = orders.where("o_orderstatus = 'F'").selectExpr("o_orderkey AS job_id", f"{value} AS revenue")
    fake = orders.where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'").selectExpr(
        "-o_orderkey - 1 AS job_id", "CAST(5 AS DECIMAL(18,4)) AS revenue"
    )
    return real.unionByName(fake)


def our_jobs(d: Domain) -> DataFrame:
    return (
        job_costing(d)
        .where(F.col("job_status").isin("Completed", "Hold"))
        .select("job_id", F.col("revenue_subtotal").alias("revenue"))
    )


@query(
    "rec_05_missing_and_extra",
    """SELECT job_id, CAST(listed_revenue AS DOUBLE) AS listed_revenue, CAST(revenue AS DOUBLE) AS revenue, reason
       FROM issues WHERE reason IS NOT NULL""",
    **_LISTS,
)
def _(d: Domain) -> DataFrame:
    out = reconcile.missing_and_extra(listed_jobs(d), our_jobs(d))
    return out.withColumns({c: F.col(c).cast("double") for c in ("listed_revenue", "revenue")})


@query(
    "rec_05_impact_totals",
    """SELECT 'Missing' AS issue_type, COUNT(*) AS job_count,
              CAST(ROUND(COALESCE(SUM(listed_revenue), 0), 2) AS DOUBLE) AS total_revenue
           FROM issues WHERE reason IS NOT NULL AND reason <> 'Not listed'
       UNION ALL SELECT 'Extra', COUNT(*), CAST(ROUND(COALESCE(SUM(revenue), 0), 2) AS DOUBLE)
           FROM issues WHERE reason = 'Not listed'
       UNION ALL SELECT 'Computed total', COUNT(*), CAST(ROUND(SUM(revenue), 2) AS DOUBLE) FROM ours
       UNION ALL SELECT 'Listed total', COUNT(*), CAST(ROUND(SUM(revenue), 2) AS DOUBLE) FROM listed""",
    **_LISTS,
)
def _(d: Domain) -> DataFrame:
    listed, ours = listed_jobs(d), our_jobs(d)
    return reconcile.impact_totals(reconcile.missing_and_extra(listed, ours), listed, ours)


_COMPARE = FINAL | {
    "side_a": """SELECT job_id, business_unit, labor_cost AS labor, material_cost_net AS materials FROM costed
            WHERE job_status <> 'Canceled'""",
    "side_b": """SELECT job_id, business_unit, labor_cost AS labor, material_cost_raw AS materials FROM costed
            WHERE job_status <> 'InProgress'""",
    "diff_rows": """SELECT * FROM (SELECT COALESCE(a.job_id, b.job_id) AS job_id,
                COALESCE(b.business_unit, a.business_unit) AS business_unit,
                CASE WHEN b.job_id IS NULL THEN CASE WHEN a.labor > 0 OR a.materials > 0 THEN 'DB_ONLY' END
                     WHEN a.job_id IS NULL THEN CASE WHEN b.labor > 0 OR b.materials > 0 THEN 'ST_ONLY' END
                     WHEN ABS(a.labor - b.labor) > 0.01 OR ABS(a.materials - b.materials) > 0.01 THEN 'DIFFERENT'
                END AS type,
                CASE WHEN b.job_id IS NULL THEN -a.labor WHEN a.job_id IS NULL THEN b.labor
                     ELSE a.labor - b.labor END AS labor_diff,
                CASE WHEN b.job_id IS NULL THEN -a.materials WHEN a.job_id IS NULL THEN b.materials
                     ELSE a.materials - b.materials END AS materials_diff
            FROM side_a a FULL JOIN side_b b ON a.job_id = b.job_id) WHERE type IS NOT NULL""",
}


def differences(d: Domain) -> DataFrame:
    """One side without canceled jobs, the other without running ones and without returns."""
    costed = final_costing(d)
    ours = costed.where("job_status <> 'Canceled'").select(
        "job_id", "business_unit", F.col("labor_cost").alias("labor"), F.col("material_cost_net").alias("materials")
    )
    theirs = costed.where("job_status <> 'InProgress'").select(
        "job_id", "business_unit", F.col("labor_cost").alias("labor"), F.col("material_cost_raw").alias("materials")
    )
    return reconcile.compare_jobs(ours, theirs)


def _diff_double(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in ("labor_diff", "materials_diff")})


_DIFF_OUT = """job_id, business_unit, type, CAST(labor_diff AS DOUBLE) AS labor_diff,
    CAST(materials_diff AS DOUBLE) AS materials_diff"""


@query("rec_06_job_differences", f"SELECT {_DIFF_OUT} FROM diff_rows", **_COMPARE)
def _(d: Domain) -> DataFrame:
    return _diff_double(differences(d))


@query(
    "rec_06_differences_by_unit",
    f"""SELECT business_unit, COUNT(*) AS jobs, {dsum('labor_diff')} AS labor_diff,
               {dsum('materials_diff')} AS materials_diff FROM diff_rows GROUP BY 1""",
    **_COMPARE,
)
def _(d: Domain) -> DataFrame:
    return reconcile.differences_by_unit(differences(d))


@query(
    "rec_06_largest_differences",
    f"""SELECT {_DIFF_OUT} FROM diff_rows ORDER BY ABS(diff_rows.labor_diff) + ABS(diff_rows.materials_diff) DESC, job_id LIMIT 20""",
    **_COMPARE,
)
def _(d: Domain) -> DataFrame:
    return _diff_double(reconcile.largest_differences(differences(d)))


@query(
    "rec_07_id_difference",
    """SELECT id AS job_id, 'ours' AS side FROM jobs WHERE id NOT IN (SELECT job_id FROM rets)
       UNION ALL SELECT -id - 1, 'theirs' FROM jobs WHERE job_status = 'Canceled'""",
)
def _(d: Domain) -> DataFrame:
    ours = d.jobs().select(F.col("id").alias("job_id"))
    unknown = d.jobs().where("job_status = 'Canceled'").select((-F.col("id") - 1).alias("job_id"))
    return reconcile.id_difference(ours, d.returns().select("job_id").unionByName(unknown))


_TARGETS = {"revenue": 1_000_000_000.0, "labor": 5_000_000.0, "materials": 100_000_000.0}


@query(
    "rec_08_section_report",
    """SELECT unnest(['Metrics','Metrics','Metrics','Metrics','Metrics','Metrics','Metrics','Metrics',
                      'Variances','Variances','Variances']) AS section,
              unnest(['Job Count','Total Revenue','Total Labor','PO Materials','Invoice Materials',
                      'Total Materials','Gross Profit','GPM %','Revenue Variance','Labor Variance',
                      'Materials Variance']) AS metric,
              unnest([CAST(n AS VARCHAR), '$' || r, '$' || l, '$' || p, '$' || i, '$' || m,
                      '$' || CAST(ROUND(r4 - l4 - m4, 2) AS DECIMAL(38,2)),
                      CAST(CAST(ROUND(CAST(CAST(r4 - l4 - m4 AS DOUBLE) / CAST(r4 AS DOUBLE) * 100 AS DECIMAL(38,6)), 2)
                           AS DECIMAL(38,2)) AS VARCHAR) || '%',
                      '$' || CAST(ROUND(r4 - 1000000000, 2) AS DECIMAL(38,2)),
                      '$' || CAST(ROUND(l4 - 5000000, 2) AS DECIMAL(38,2)),
                      '$' || CAST(ROUND(m4 - 100000000, 2) AS DECIMAL(38,2))]) AS value
       FROM (SELECT COUNT(*) AS n, SUM(revenue) AS r4, SUM(labor) AS l4, SUM(po + inv - ret) AS m4,
                    CAST(ROUND(SUM(revenue), 2) AS DECIMAL(38,2)) AS r, CAST(ROUND(SUM(labor), 2) AS DECIMAL(38,2)) AS l,
                    CAST(ROUND(SUM(po), 2) AS DECIMAL(38,2)) AS p, CAST(ROUND(SUM(inv), 2) AS DECIMAL(38,2)) AS i,
                    CAST(ROUND(SUM(po + inv - ret), 2) AS DECIMAL(38,2)) AS m
             FROM (SELECT COALESCE(i.s, 0) AS revenue, COALESCE(l.pay, 0) + COALESCE(x.payroll_adj, 0) AS labor,
                          COALESCE(p.c, 0) AS po, COALESCE(im.c, 0) AS inv, COALESCE(r.c, 0) AS ret
                   FROM jobs j LEFT JOIN inv i ON i.job_id = j.id LEFT JOIN lab l ON l.job_id = j.id
                   LEFT JOIN adj x ON x.job_id = j.id LEFT JOIN po_sum p ON p.job_id = j.id
                   LEFT JOIN item_sum im ON im.job_id = j.id LEFT JOIN ret r ON r.job_id = j.id
                   WHERE j.job_status = 'Completed'))""",
    **FACT,
)
def _(d: Domain) -> DataFrame:
    """Completed jobs, each child rolled up per job first."""
    listed = d.jobs().where("job_status = 'Completed'").select(F.col("id").alias("job_id"))
    rolled = (
        listed.join(costing.invoice_rollup(d.invoices()), "job_id", "left")
        .join(costing.labor_rollup(d.payroll()), "job_id", "left")
        .join(costing.adjustment_rollup(d.payroll_adjustments(), d.invoices()), "job_id", "left")
        .join(costing.purchase_order_rollup(d.purchase_orders()), "job_id", "left")
        .join(costing.item_material_rollup(d.invoices()), "job_id", "left")
        .join(costing.return_rollup(d.returns()), "job_id", "left")
    )
    zero = F.lit(0)
    financials = rolled.select(
        "job_id",
        F.col("invoice_subtotal").alias("revenue"),
        (F.coalesce("total_labor_cost", zero) + F.coalesce("payroll_adj", zero)).alias("labor"),
        F.col("po_cost").alias("po_materials"),
        F.col("invoice_material_cost").alias("invoice_materials"),
        F.col("return_credit").alias("return_credits"),
    )
    return reconcile.section_report(financials, _TARGETS)


_TOLERANCES = {
    "jobs": (3300, 10),
    "revenue": (800_000_000.0, 100),
    "labor": (5_000_000.0, 10),
    "materials": (60_000_000.0, 10),
    "gpm": (90.0, 5),
}


def _overall(label: str, value: str, goal: float, tolerance: float) -> str:
    off = rnd(f"{rnd(value)} - {goal}")
    return (
        f"SELECT 'OVERALL' AS section, '{label}' AS metric, {rnd(value)} AS computed, {goal}::DOUBLE AS target,"
        f" {off} AS variance, CASE WHEN ABS({off}) <= {tolerance} THEN '✅' ELSE '❌' END AS status FROM picked"
    )


_GPM = pct("SUM(gross_profit)", "SUM(revenue_subtotal)")


@query(
    "rec_09_tolerance_report",
    " UNION ALL ".join(
        [
            _overall("Job Count", "COUNT(*)", *_TOLERANCES["jobs"]),
            _overall("Revenue", "SUM(revenue_subtotal)", *_TOLERANCES["revenue"]),
            _overall("Labor", "SUM(labor_cost)", *_TOLERANCES["labor"]),
            _overall("Materials", "SUM(material_cost_net)", *_TOLERANCES["materials"]),
            _overall("GPM %", _GPM, *_TOLERANCES["gpm"]),
            f"SELECT 'BU: ' || business_unit, 'GPM %', {_GPM}, NULL, NULL, 'N/A' FROM picked GROUP BY business_unit",
        ]
    ),
    picked="SELECT * FROM costed WHERE business_unit LIKE '%-Production' AND job_status IN ('Completed', 'Hold')",
    **FINAL,
)
def _(d: Domain) -> DataFrame:
    picked = final_costing(d).where(
        F.col("business_unit").like("%-Production") & F.col("job_status").isin("Completed", "Hold")
    )
    return reconcile.tolerance_report(picked, _TOLERANCES)


_TOTALS = f"""COUNT(DISTINCT job_id) AS job_count, {rsum('revenue_subtotal')} AS total_revenue,
    {rsum('labor_cost')} AS total_labor, {rsum('material_cost_net')} AS total_materials,
    {rsum('total_cost')} AS total_costs, {_GPM} AS gpm_percent"""


@query(
    "rec_10_window_totals",
    f"""SELECT {_TOTALS} FROM costed WHERE CAST(job_start_date AS DATE) BETWEEN DATE '{MONTHS[0]}' AND DATE '{MONTHS[1]}'
        AND business_unit IN ('NATION_1-Production', 'NATION_3-Production', 'NATION_5-Production')""",
    **FINAL,
)
def _(d: Domain) -> DataFrame:
    units = ("NATION_1-Production", "NATION_3-Production", "NATION_5-Production")
    return reconcile.window_totals(final_costing(d), *MONTHS, units=units)


@query(
    "rec_10_window_jobs",
    f"""SELECT DISTINCT job_id, business_unit FROM costed
        WHERE CAST(job_start_date AS DATE) BETWEEN DATE '{MONTHS[0]}' AND DATE '{MONTHS[1]}'""",
    **FINAL,
)
def _(d: Domain) -> DataFrame:
    start = F.to_date("job_start_date").between(*[F.lit(x).cast("date") for x in MONTHS])
    return final_costing(d).where(start).select("job_id", "business_unit").distinct()


@query(
    "rec_11_alternate_start_dates",
    f"""SELECT {_TOTALS} FROM costed JOIN (
            SELECT j.id, COALESCE(MIN(a.scheduled_start), j.created_on) - INTERVAL 7 HOUR AS alt
            FROM jobs j LEFT JOIN appts a ON a.job_id = j.id GROUP BY j.id, j.created_on) s ON s.id = costed.job_id
        WHERE CAST(alt AS DATE) BETWEEN DATE '{MONTHS[0]}' AND DATE '{MONTHS[1]}'""",
    **FINAL,
)
def _(d: Domain) -> DataFrame:
    """Jobs without appointment start when they were created, also if they were completed."""
    no_completion = d.jobs().withColumn("completed_on", F.lit(None).cast("timestamp_ntz"))
    dates = costing.job_dates_with_fallback(no_completion, d.appointments())
    moved = final_costing(d).drop("job_start_date", "job_end_date").join(dates, "job_id")
    return reconcile.window_totals(moved, *MONTHS)


@query(
    "rec_12_fan_out_totals",
    """SELECT (SELECT CAST(SUM(subtotal) AS DOUBLE) FROM invoices WHERE job_id IS NOT NULL) AS true_revenue,
              (SELECT CAST(SUM(total) AS DOUBLE) FROM pos) AS true_materials,
              (SELECT CAST(SUM(amount) AS DOUBLE) FROM payroll WHERE job_id IS NOT NULL) AS true_labor,
              CAST(SUM(i.subtotal) AS DOUBLE) AS joined_revenue, CAST(SUM(p.total) AS DOUBLE) AS joined_materials,
              CAST(SUM(l.amount) AS DOUBLE) AS joined_labor
       FROM jobs j LEFT JOIN invoices i ON i.job_id = j.id LEFT JOIN pos p ON p.job_id = j.id
       LEFT JOIN payroll l ON l.job_id = j.id""",
)
def _(d: Domain) -> DataFrame:
    """Sums that a join of all children would give, beside the true ones."""
    return reconcile.fan_out_totals(
        [
            (d.invoices().select("job_id", F.col("subtotal").alias("revenue")), "revenue"),
            (d.purchase_orders().select("job_id", F.col("total").alias("materials")), "materials"),
            (d.payroll().select("job_id", F.col("amount").alias("labor")), "labor"),
        ],
        d.jobs(),
    )


# --- diagnostics ---------------------------------------------------------------------------


def _in_week(c: str) -> str:
    return f"CAST({c} AS DATE) BETWEEN DATE '{WEEK[0]}' AND DATE '{WEEK[1]}'"


_ACTIVE = "j.job_status IN ('Completed', 'Hold', 'Scheduled', 'InProgress')"


def _variant(name: str, join: str, test: str) -> str:
    return (
        f"SELECT '{name}' AS variant, COUNT(DISTINCT j.id) AS job_count,"
        f" COUNT(DISTINCT j.business_unit_id) AS bu_count FROM jobs j {join} WHERE {test}"
    )


_INV, _APPT = "JOIN invoices i ON i.job_id = j.id", "LEFT JOIN appts a ON a.job_id = j.id"


@query(
    "dgn_01_population_by_date_basis",
    "SELECT *, ABS(job_count - 45) AS off_target FROM ("
    + " UNION ALL ".join(
        [
            _variant("completedOn", "", f"{_in_week('j.completed_on')} AND {_ACTIVE}"),
            _variant("createdOn", "", f"{_in_week('j.created_on')} AND {_ACTIVE}"),
            _variant("appointment_scheduledStart", _APPT, f"{_in_week('a.scheduled_start')} AND {_ACTIVE}"),
            _variant("invoiceDate", _INV, f"{_in_week('i.invoice_date')} AND {_ACTIVE}"),
            _variant("invoice_createdOn", _INV, f"{_in_week('i.created_on')} AND {_ACTIVE}"),
            _variant("invoice_modifiedOn", _INV, f"{_in_week('i.modified_on')} AND {_ACTIVE}"),
            _variant(
                "appointment_or_completed",
                _APPT,
                f"({_in_week('a.scheduled_start')} OR {_in_week('j.completed_on')}) AND {_ACTIVE}",
            ),
            _variant("invoiceDate_all_statuses", _INV, _in_week("i.invoice_date")),
            _variant(
                "production_jobs_view",
                "",
                f"j.id IN (SELECT job_id FROM production_jobs WHERE {_in_week('start_date')})",
            ),
            _variant(
                "any_financial_activity",
                "",
                f"j.id IN (SELECT job_id FROM invoices WHERE {_in_week('invoice_date')}"
                f" UNION SELECT job_id FROM pos WHERE {_in_week('date')}"
                f" UNION SELECT job_id FROM payroll WHERE {_in_week('date')})",
            ),
        ]
    )
    + ")",
)
def _(d: Domain) -> DataFrame:
    return diagnostics.population_by_date_basis(
        d.jobs(), d.appointments(), d.invoices(), d.purchase_orders(), d.payroll(), production(d), *WEEK, 45
    )


_WANTED = [("1998-03-02", "NATION_0-Sales", 1000.0), ("1998-03-04", "NATION_2-Sales", 50000.0),
           ("1998-03-05", "NATION_4-Sales", 0.0), ("1998-03-06", "NATION_10-Sales", 100000.0),
           ("1998-03-07", "NATION_12-Sales", 250000.0)]


def _basis(basis: str, label: str, source: str, day: str, amount: str, test: str) -> str:
    return f"""SELECT w.event_date, w.business_unit, '{basis}' AS basis, '{label}' AS filter_desc,
        CAST(ROUND(COALESCE(SUM({amount}), 0), 2) AS DOUBLE) AS total_booked, COUNT(DISTINCT doc) AS num_documents,
        COUNT(DISTINCT job) AS num_jobs, {rnd(f'CAST(ROUND(COALESCE(SUM({amount}), 0), 2) AS DOUBLE) - MAX(w.expected)')} AS delta
        FROM wanted w JOIN ({source}) s ON s.business_unit = w.business_unit AND CAST(s.{day} AS DATE) = w.event_date
        WHERE {test} GROUP BY 1, 2"""


_S_INV = """SELECT j.business_unit, j.job_type_name, i.invoice_date, i.total, i.id AS doc, j.id AS job
    FROM invoices i JOIN dim_jobs j ON i.job_id = j.id"""
_S_EST = """SELECT j.business_unit, j.job_type_name, e.created_on, e.subtotal, e.id AS doc, j.id AS job
    FROM estimates e JOIN dim_jobs j ON e.job_id = j.id WHERE e.status = 'Sold'"""
_S_DONE = """SELECT j.business_unit, j.job_type_name, j.completed_on, i.total, i.id AS doc, j.id AS job
    FROM dim_jobs j LEFT JOIN invoices i ON i.job_id = j.id WHERE j.job_status = 'Completed'"""
_NO_COMM = "upper(s.job_type_name) NOT LIKE '%COMM%'"
_EST = "s.job_type_name ILIKE '%estimate%'"


@query(
    "dgn_02_booked_by_basis",
    " UNION ALL ".join(
        [
            _basis("invoice_date", "all_jobs", _S_INV, "invoice_date", "s.total", "TRUE"),
            _basis("invoice_date", "exclude_comm", _S_INV, "invoice_date", "s.total", _NO_COMM),
            _basis("estimate_created", "all_sold", _S_EST, "created_on", "s.subtotal", "TRUE"),
            _basis("estimate_created", "sold_no_comm", _S_EST, "created_on", "s.subtotal", _NO_COMM),
            _basis("estimate_created", "sold_estimate_jobs", _S_EST, "created_on", "s.subtotal", _EST),
            _basis("job_completed", "all_jobs", _S_DONE, "completed_on", "s.total", "TRUE"),
            _basis("job_completed", "estimate_jobs", _S_DONE, "completed_on", "s.total", _EST),
        ]
    ),
    wanted=f"""SELECT * FROM (VALUES {', '.join(f"(DATE '{a}', '{u}', {x}::DOUBLE)" for a, u, x in _WANTED)})
        t(event_date, business_unit, expected)""",
)
def _(d: Domain) -> DataFrame:
    wanted = literal_relation(d.spark, "event_date date, business_unit string, expected double", _WANTED)
    return diagnostics.booked_by_basis(d.invoices(), d.estimates(), d.dim_jobs(), wanted)


@query(
    "dgn_03_lead_funnel",
    f"""SELECT step, jobs, unique_customers FROM (
        SELECT 'Jobs created' AS step, COUNT(*) AS jobs, COUNT(DISTINCT customer_id) AS unique_customers FROM named_rows
        UNION ALL SELECT 'In unit', COUNT(*), COUNT(DISTINCT customer_id) FROM named_rows WHERE business_unit = 'NATION_2-Sales'
        UNION ALL SELECT 'Estimate jobs', COUNT(*), COUNT(DISTINCT customer_id) FROM named_rows
            WHERE business_unit = 'NATION_2-Sales' AND job_type_name ILIKE '%estimate%'
        UNION ALL SELECT 'Real customers', COUNT(*), COUNT(DISTINCT customer_id) FROM named_rows
            WHERE business_unit = 'NATION_2-Sales' AND job_type_name ILIKE '%estimate%'
              AND COALESCE(name, '') NOT ILIKE '%test%')""",
    named_rows=f"""SELECT j.*, c.name FROM dim_jobs j LEFT JOIN customers c ON j.customer_id = c.id
          WHERE {ldate('j.created_on')} BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'""",
)
def _(d: Domain) -> DataFrame:
    return diagnostics.lead_funnel(
        d.dim_jobs(), d.customers(), "1998-01-01", "1998-12-31", "NATION_2-Sales"
    )


def job_list(d: Domain) -> DataFrame:
    return d.jobs().where("job_status = 'Completed'").select(F.col("id").alias("job_id"))


_LIST = {
    "job_list": "SELECT id AS job_id FROM jobs WHERE job_status = 'Completed'",
    "lpo": "SELECT * FROM pos WHERE status <> 'Canceled' AND job_id IN (SELECT job_id FROM job_list)",
    "litem": "SELECT * FROM invoice_items WHERE job_id IN (SELECT job_id FROM job_list)",
    "lret": "SELECT * FROM rets WHERE job_id IN (SELECT job_id FROM job_list)",
}


def _part(label: str, amount: str, table: str, test: str = "TRUE") -> str:
    return f"SELECT {label} AS component, {amount} AS amount, COUNT(*) AS n FROM {table} WHERE {test}"


@query(
    "dgn_04_material_components",
    """SELECT component, CAST(ROUND(amount, 2) AS DOUBLE) AS amount, n AS count,
              CASE WHEN component LIKE '%Total%' THEN 'Total'
                   WHEN component LIKE '%Tax%' OR component LIKE '%Shipping%' OR component LIKE '%Discount%'
                   THEN 'Adjustment' WHEN component LIKE '%Returns%' THEN 'Credit' ELSE 'Cost' END AS category
       FROM ("""
    + " UNION ALL ".join(
        [
            _part("'PO Subtotal'", "SUM(subtotal)", "lpo"),
            _part("'PO Tax'", "SUM(tax)", "lpo"),
            _part("'PO Shipping'", "SUM(shipping)", "lpo"),
            _part("'PO Discount (negative)'", "-SUM(discount)", "lpo"),
            _part("'PO Total (header)'", "SUM(total)", "lpo"),
            _part("'Invoice Material Cost'", "SUM(cost)", "litem", "type = 'Material'"),
            _part("'Invoice Equipment Cost'", "SUM(cost)", "litem", "type = 'Equipment'"),
            _part("'Invoice Material Total (price)'", "SUM(total)", "litem", "type IN ('Material', 'Equipment')"),
            _part(
                "'Invoice Type: ' || type",
                "SUM(cost)",
                "litem",
                "type NOT IN ('Material', 'Equipment', 'Service', 'Labor') GROUP BY type",
            ),
            _part("'Returns Subtotal (credit)'", "-SUM(subtotal)", "lret"),
            _part("'Returns Tax (credit)'", "-SUM(tax)", "lret"),
            _part("'Returns Total (credit)'", "-SUM(total)", "lret"),
        ]
    )
    + ") WHERE COALESCE(amount, 0) <> 0",
    **_LIST,
)
def _(d: Domain) -> DataFrame:
    return diagnostics.material_components(job_list(d), d.purchase_orders(), d.invoices(), d.returns())


@query(
    "dgn_05_order_header_vs_items",
    """SELECT 'Total PO Header' AS metric, CAST(ROUND(SUM(total), 2) AS DOUBLE) AS amount FROM lpo
       UNION ALL SELECT 'Total PO Items', CAST(ROUND(SUM(items_total), 2) AS DOUBLE) FROM lpo
       UNION ALL SELECT 'Difference (Tax/Shipping/Discount)', CAST(ROUND(SUM(total - items_total), 2) AS DOUBLE) FROM lpo
       UNION ALL SELECT 'Jobs with POs', CAST(COUNT(DISTINCT job_id) AS DOUBLE) FROM lpo
           WHERE total > 0 OR items_total > 0""",
    **_LIST,
)
def _(d: Domain) -> DataFrame:
    return diagnostics.order_header_vs_items(job_list(d), d.purchase_orders())


def _scenario(name: str, amount: str) -> str:
    return (
        f"SELECT '{name}' AS scenario, CAST(ROUND({amount}, 2) AS DOUBLE) AS total_materials,"
        f" CAST(ROUND(60000000 - ({amount}), 2) AS DOUBLE) AS gap_to_target FROM scenario_sums"
    )


@query(
    "dgn_06_material_scenarios",
    " UNION ALL ".join(
        [
            _scenario("PO header + invoice materials", "h + m"),
            _scenario("PO items + invoice materials", "i + m"),
            _scenario("PO items + tax/shipping + invoice materials", "i + x + m"),
        ]
    ),
    scenario_sums="""SELECT (SELECT SUM(total) FROM lpo) AS h, (SELECT SUM(items_total) FROM lpo) AS i,
                (SELECT SUM(tax + shipping) FROM lpo) AS x,
                (SELECT SUM(cost) FROM litem WHERE type IN ('Material', 'Equipment')) AS m""",
    **_LIST,
)
def _(d: Domain) -> DataFrame:
    return diagnostics.material_scenarios(job_list(d), d.purchase_orders(), d.invoices(), 60_000_000.0)


@query(
    "dgn_07_material_sources",
    f"""SELECT 'Purchase Orders' AS source, COUNT(DISTINCT job_id) AS job_count, COUNT(*) AS record_count,
               {rsum('total')} AS total_amount, {rsum('tax')} AS tax_amount, {rsum('shipping')} AS shipping_amount,
               {rsum('subtotal')} AS subtotal_amount FROM lpo
        UNION ALL SELECT 'Invoice Materials/Equipment', COUNT(DISTINCT job_id), COUNT(*), {rsum('cost')}, 0, 0,
               {rsum('total')} FROM litem WHERE type IN ('Material', 'Equipment')
        UNION ALL SELECT 'Returns (negative)', COUNT(DISTINCT job_id), COUNT(*), {rsum('-total')}, {rsum('-tax')}, 0,
               {rsum('-subtotal')} FROM lret
        UNION ALL SELECT 'Payments (for reference)', COUNT(DISTINCT invoice_id), COUNT(*), {rsum('amount')}, 0, 0, 0
               FROM payments WHERE invoice_id IN (SELECT id FROM invoices WHERE job_id IN (SELECT job_id FROM job_list))""",
    **_LIST,
)
def _(d: Domain) -> DataFrame:
    return diagnostics.material_sources(
        job_list(d), d.purchase_orders(), d.invoices(), d.returns(), d.payments()
    )


@query(
    "dgn_08_appointment_facts",
    f"""SELECT j.id AS job_id, j.job_status, j.created_on, j.completed_on, COALESCE(a.n, 0) AS appt_count,
               a.f AS first_scheduled, a.l AS last_scheduled, a.all_dates, a.f IS NOT NULL AS in_costing
        FROM jobs j LEFT JOIN (
            SELECT job_id, COUNT(*) AS n, MIN(scheduled_start) AS f, MAX(scheduled_start) AS l,
                   string_agg(DISTINCT CAST({ldate('scheduled_start')} AS VARCHAR), ', '
                              ORDER BY CAST({ldate('scheduled_start')} AS VARCHAR)) AS all_dates
            FROM appts GROUP BY 1) a ON a.job_id = j.id
        WHERE j.id IN (SELECT job_id FROM job_list)""",
    **_LIST,
)
def _(d: Domain) -> DataFrame:
    return diagnostics.appointment_facts(job_list(d), d.jobs(), d.appointments(), job_costing(d))


@query(
    "dgn_09_status_profile",
    """SELECT job_status, COUNT(*) AS job_count, COUNT(comp) AS has_completed, COUNT(appt) AS has_appointment,
              COUNT(inv) AS has_invoice, MIN(appt) AS min_appt_date, MAX(appt) AS max_appt_date,
              MIN(inv) AS min_inv_date, MAX(inv) AS max_inv_date, MIN(comp) AS min_comp_date, MAX(comp) AS max_comp_date
       FROM (SELECT j.job_status, CAST(j.completed_on AS DATE) AS comp, CAST(a.s AS DATE) AS appt, CAST(i.s AS DATE) AS inv
             FROM jobs j LEFT JOIN (SELECT job_id, MIN(scheduled_start) AS s FROM appts GROUP BY 1) a ON a.job_id = j.id
             LEFT JOIN (SELECT job_id, MIN(invoice_date) AS s FROM invoices GROUP BY 1) i ON i.job_id = j.id
             WHERE j.id IN (SELECT job_id FROM rets)) GROUP BY 1""",
)
def _(d: Domain) -> DataFrame:
    return diagnostics.status_profile(d.returns().select("job_id"), d.jobs(), d.appointments(), d.invoices())


@query(
    "dgn_10_old_vs_new_leads",
    f"""SELECT business_unit, o AS old_lead_count, n AS new_lead_count, n - o AS delta,
               {pct('n - o', 'CASE WHEN o = 0 THEN 1 ELSE o END')} AS pct_change
        FROM (SELECT COALESCE(a.business_unit, b.business_unit) AS business_unit, COALESCE(a.n, 0) AS o, COALESCE(b.n, 0) AS n
              FROM (SELECT business_unit, COUNT(DISTINCT customer_id) AS n FROM named_rows
                    WHERE job_type_name NOT LIKE '%COMM%' GROUP BY 1) a
              FULL JOIN (SELECT business_unit, COUNT(DISTINCT customer_id) AS n FROM named_rows
                    WHERE job_type_name ILIKE '%estimate%' AND (name IS NULL OR name NOT ILIKE '%test%') GROUP BY 1) b
              ON a.business_unit = b.business_unit)""",
    named_rows=f"""SELECT j.*, c.name FROM dim_jobs j LEFT JOIN customers c ON j.customer_id = c.id
          WHERE j.business_unit LIKE '%-Sales' AND CAST(j.created_on AS DATE)
              BETWEEN DATE '{MONTHS[0]}' AND DATE '{MONTHS[1]}'""",
)
def _(d: Domain) -> DataFrame:
    return diagnostics.old_vs_new_leads(d.dim_jobs(), d.customers(), *MONTHS)


_LOCAL_DONE = f"{ldate('j.completed_on')} BETWEEN DATE '{MONTHS[0]}' AND DATE '{MONTHS[1]}' AND j.job_type_name ILIKE '%estimate%'"


@query(
    "dgn_11_booked_definitions",
    f"""SELECT 'Sold in window' AS method, COUNT(DISTINCT id) AS estimate_count,
               {rsum('COALESCE(total, subtotal)')} AS total_booked FROM estimates
            WHERE status = 'Sold' AND {ldate('sold_on')} BETWEEN DATE '{MONTHS[0]}' AND DATE '{MONTHS[1]}'
        UNION ALL SELECT 'Sold, job completed in window', COUNT(DISTINCT e.id), {rsum('COALESCE(e.total, e.subtotal)')}
            FROM estimates e JOIN dim_jobs j ON e.job_id = j.id WHERE e.status = 'Sold' AND {_LOCAL_DONE}
        UNION ALL SELECT 'All estimates of completed jobs', COUNT(DISTINCT e.id), {rsum('COALESCE(e.total, e.subtotal)')}
            FROM estimates e JOIN dim_jobs j ON e.job_id = j.id WHERE j.job_status = 'Completed' AND {_LOCAL_DONE}
        UNION ALL SELECT 'Invoices of completed jobs', COUNT(DISTINCT i.id), {rsum('i.total')}
            FROM invoices i JOIN dim_jobs j ON i.job_id = j.id WHERE j.job_status = 'Completed' AND {_LOCAL_DONE}""",
)
def _(d: Domain) -> DataFrame:
    return diagnostics.booked_definitions(d.estimates(), d.dim_jobs(), d.invoices(), *MONTHS)


@query(
    "dgn_11_close_rate_definitions",
    f"""SELECT 'Current rule' AS method, COUNT(*) AS total_jobs, COUNT(*) AS sales_opps,
               COUNT(*) FILTER (is_closed_opportunity) AS closed_opps,
               {pct('COUNT(*) FILTER (is_closed_opportunity)', 'COUNT(*)')} AS close_rate FROM opportunity_jobs
            WHERE opportunity_date BETWEEN DATE '{MONTHS[0]}' AND DATE '{MONTHS[1]}'
        UNION ALL SELECT 'Completed estimate jobs', COUNT(*), COUNT(*), COUNT(*) FILTER (won),
               {pct('COUNT(*) FILTER (won)', 'COUNT(*)')}
            FROM (SELECT j.id IN (SELECT job_id FROM estimates WHERE status = 'Sold' AND job_id IS NOT NULL) AS won
                  FROM dim_jobs j WHERE j.job_status = 'Completed' AND {_LOCAL_DONE})""",
)
def _(d: Domain) -> DataFrame:
    return diagnostics.close_rate_definitions(opportunities(d), d.dim_jobs(), d.estimates(), *MONTHS)


@query(
    "dgn_11_close_rate_by_unit",
    f"""SELECT j.business_unit, COUNT(*) FILTER (est) AS completed_estimates, COUNT(*) FILTER (est) AS sales_opportunities,
               COUNT(*) FILTER (est AND s.n > 0) AS closed_opportunities,
               {pct('COUNT(*) FILTER (est AND s.n > 0)', 'COUNT(*) FILTER (est)')} AS close_rate_percent,
               {rsum('s.a')} AS total_booked
        FROM (SELECT *, job_status = 'Completed' AND job_type_name ILIKE '%estimate%' AS est FROM dim_jobs) j
        LEFT JOIN (SELECT job_id, COUNT(*) AS n, SUM(COALESCE(total, subtotal)) AS a FROM estimates
                   WHERE status = 'Sold' GROUP BY 1) s ON s.job_id = j.id
        WHERE {ldate('j.completed_on')} BETWEEN DATE '{MONTHS[0]}' AND DATE '{MONTHS[1]}' GROUP BY 1""",
)
def _(d: Domain) -> DataFrame:
    return diagnostics.close_rate_by_unit(d.dim_jobs(), d.estimates(), *MONTHS)


def _base(name: str, value: str, base: float) -> str:
    return (
        f"SELECT '{name}' AS kpi, {base}::DOUBLE AS baseline, {rnd(f'({value})')} AS current,"
        f" {rnd(f'({value}) - {base}')} AS variance, {pct(f'(({value}) - {base})', str(base))} AS variance_pct"
    )


_W = f"BETWEEN DATE '{MONTHS[0]}' AND DATE '{MONTHS[1]}'"


@query(
    "dgn_12_baseline_vs_current",
    " UNION ALL ".join(
        [
            _base("Leads", f"SELECT CAST(COUNT(*) AS DOUBLE) FROM leads_jobs WHERE lead_date {_W}", 200.0),
            _base(
                "Completed Estimates",
                f"SELECT CAST(COUNT(*) AS DOUBLE) FROM completed_estimates_jobs WHERE completed_date {_W}",
                80.0,
            ),
            _base(
                "Close Rate %",
                f"""SELECT {ratio('COUNT(*) FILTER (is_closed_opportunity)', 'COUNT(*)')} * 100 FROM opportunity_jobs
                    WHERE opportunity_date {_W}""",
                50.0,
            ),
            _base("Total Booked $", f"SELECT {dsum('revenue_amount')} FROM sold_estimates WHERE sold_date {_W}", 9e6),
        ]
    ),
)
def _(d: Domain) -> DataFrame:
    def window(df: DataFrame) -> DataFrame:
        return df.where(F.col("kpi_date").between(*[F.lit(x).cast("date") for x in MONTHS]))

    rate = F.try_divide(F.sum("closed_opportunities").cast("double"), F.sum("sales_opportunities").cast("double"))
    booked = F.sum(F.col("total_booked").cast("decimal(28,6)"))
    return diagnostics.baseline_vs_current(
        {
            "Leads": (window(marts.leads_daily_unit(leads(d))), F.sum("leads_count"), 200.0),
            "Completed Estimates": (
                window(marts.completed_estimates_daily(completed(d))),
                F.sum("completed_estimates_count"),
                80.0,
            ),
            "Close Rate %": (window(opportunity_daily(d)), rate * 100.0, 50.0),
            "Total Booked $": (window(marts.total_booked_daily(sold(d))), booked, 9e6),
        }
    )


@query(
    "dgn_13_completed_job_invoices",
    f"""SELECT j.business_unit, COUNT(DISTINCT j.id) AS job_count, COUNT(DISTINCT i.id) AS invoice_count,
               {rsum('i.total')} AS total_dollars_produced
        FROM dim_jobs j LEFT JOIN invoices i ON i.job_id = j.id
        WHERE j.business_unit LIKE '%-Production' AND j.job_status = 'Completed'
          AND CAST(j.completed_on AS DATE) BETWEEN DATE '{MONTHS[0]}' AND DATE '{MONTHS[1]}' GROUP BY 1""",
)
def _(d: Domain) -> DataFrame:
    return diagnostics.completed_job_invoices(d.dim_jobs(), d.invoices(), *MONTHS)


@query(
    "dgn_14_batch_extents",
    """SELECT updated_on, MIN(job_start) AS min_job_start, MAX(job_start) AS max_job_start
       FROM report_job_cost GROUP BY 1 ORDER BY 1 DESC LIMIT 5""",
)
def _(d: Domain) -> DataFrame:
    return diagnostics.batch_extents(d.report_job_cost())


_DAY = ("1998-03-04", "1998-03-04")


@query("dgn_15_kpi_day_units", "SELECT * FROM ten_kpis WHERE event_date = DATE '1998-03-04'", **TEN_KPI_SQL)
def _(d: Domain) -> DataFrame:
    return diagnostics.kpi_day(ten_kpis(d, _DAY), "1998-03-04")


@query(
    "dgn_15_kpi_day_one_unit",
    "SELECT * FROM ten_kpis WHERE event_date = DATE '1998-03-04' AND business_unit = 'NATION_17-Production'",
    **TEN_KPI_SQL,
)
def _(d: Domain) -> DataFrame:
    return diagnostics.kpi_day(ten_kpis(d, _DAY, ("NATION_17-Production",)), "1998-03-04", "NATION_17-Production")


def _m(c: str) -> str:
    return rnd(ratio(f"SUM({_x(c)})", f"COUNT({c})"))


@query(
    "dgn_15_kpi_week",
    f"""SELECT business_unit, CAST(SUM(lead_count) AS BIGINT) AS weekly_leads, {rsum(_x('total_booked'))} AS weekly_booked,
               {rsum(_x('dollars_produced'))} AS weekly_produced, {_m('gpm_percent')} AS avg_gpm,
               {rsum(_x('dollars_collected'))} AS weekly_collected, CAST(SUM(num_estimates) AS BIGINT) AS weekly_estimates,
               {_m('close_rate_percent')} AS avg_close_rate
        FROM ten_kpis WHERE event_date BETWEEN DATE '{WEEK[0]}' AND DATE '{WEEK[1]}' GROUP BY 1""",
    **TEN_KPI_SQL,
)
def _(d: Domain) -> DataFrame:
    return diagnostics.kpi_window(ten_kpis(d, WEEK), *WEEK)


def _types(n: int) -> str:
    return f"array_to_string(list_slice(list_sort(list(DISTINCT job_type_name)), 1, {n}), ',')"


@query(
    "dgn_15_leads_detail",
    f"""SELECT CAST(created_on AS DATE) AS job_date, business_unit, COUNT(DISTINCT customer_id) AS lead_count,
               COUNT(*) AS total_jobs, {_types(10)} AS job_types
        FROM dim_jobs WHERE job_type_name ILIKE '%estimate%'
          AND CAST(created_on AS DATE) BETWEEN DATE '{MONTHS[0]}' AND DATE '{MONTHS[1]}' GROUP BY 1, 2""",
)
def _(d: Domain) -> DataFrame:
    return diagnostics.leads_detail(d.dim_jobs(), *MONTHS)


@query(
    "dgn_15_sold_detail",
    f"""SELECT CAST(e.created_on AS DATE) AS estimate_date, j.business_unit, COUNT(*) AS sold_estimates,
               {rsum('e.subtotal')} AS total_booked, {rnd(ratio('SUM(e.subtotal)', 'COUNT(e.subtotal)'))} AS avg_estimate_value,
               {_types(5)} AS job_types
        FROM estimates e JOIN dim_jobs j ON e.job_id = j.id
        WHERE e.status = 'Sold' AND CAST(e.created_on AS DATE) BETWEEN DATE '{MONTHS[0]}' AND DATE '{MONTHS[1]}'
        GROUP BY 1, 2""",
)
def _(d: Domain) -> DataFrame:
    return diagnostics.sold_detail(d.estimates(), d.dim_jobs(), *MONTHS)
