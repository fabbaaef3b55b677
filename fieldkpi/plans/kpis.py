"""KPI tables, regional rollups and periodic reports over the test tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkpi.functions.constants import NON_PRODUCTION_JOB_TYPES
from fieldkpi.functions.parse import job_type_warranty_category
from fieldkpi.operators import kpi, marts, periods, regional
from fieldkpi.plans.catalog import query
from fieldkpi.plans.domain import Domain
from fieldkpi.plans.ingest import leads_report
from fieldkpi.plans.oracle import dsum, ldate, pct, ratio, rnd, rsum
from fieldkpi.plans.stage_marts import (
    AS_OF,
    FACT,
    completed,
    job_cost_fact,
    job_costing,
    leads,
    margin_daily,
    opportunity_daily,
)
from fieldkpi.sources import tables
from fieldkpi.sources.workspace import new_folder

SINCE = "1997-01-01"
WINDOW = ("1998-03-02", "1998-04-26")
SALES_TYPES = (1, 2)
EXCLUDED = "('PM Inspection', 'Safety Inspection', 'Window/Solar Washing')"


# --- SQL twins of the branches ---------------------------------------------------------


BRANCH_SQL = {
    "k_leads": f"""SELECT CAST(created_on AS DATE) AS event_date, business_unit, COUNT(DISTINCT id) AS lead_count
        FROM dim_jobs WHERE business_unit LIKE '%-Sales' AND job_type_id IN (1, 2)
          AND created_on >= TIMESTAMP '{SINCE}' GROUP BY 1, 2""",
    "k_sales": """SELECT e.*, j.business_unit, j.customer_id, j.job_type_id IN (1, 2) AS listed,
               COALESCE(e.total, e.subtotal) AS amount
        FROM estimates e JOIN dim_jobs j ON e.job_id = j.id WHERE j.business_unit LIKE '%-Sales'""",
    "k_made": f"""SELECT CAST(created_on AS DATE) AS event_date, business_unit, COUNT(DISTINCT id) AS estimate_count
        FROM k_sales WHERE listed AND created_on >= TIMESTAMP '{SINCE}' GROUP BY 1, 2""",
    "k_close": f"""SELECT CAST(sold_on AS DATE) AS event_date, business_unit,
               COUNT(DISTINCT job_id) AS sales_opportunities,
               COUNT(DISTINCT job_id) FILTER (status = 'Sold') AS closed_opportunities,
               {ratio("COUNT(DISTINCT job_id) FILTER (status = 'Sold')", 'COUNT(DISTINCT job_id)')} AS close_rate
        FROM k_sales WHERE listed AND sold_on >= TIMESTAMP '{SINCE}' GROUP BY 1, 2""",
    "k_revenue": f"""SELECT CAST(sold_on AS DATE) AS event_date, business_unit, {dsum('amount')} AS total_booked
        FROM k_sales WHERE status = 'Sold' AND sold_on >= TIMESTAMP '{SINCE}' GROUP BY 1, 2""",
    "k_collected": f"""SELECT CAST(p.created_on AS DATE) AS event_date, j.business_unit,
               {dsum('p.amount')} AS dollars_collected, COUNT(DISTINCT p.id) AS payment_count
        FROM payments p JOIN invoices i ON p.invoice_id = i.id JOIN dim_jobs j ON i.job_id = j.id
        WHERE j.business_unit LIKE '%-Production' AND p.created_on >= TIMESTAMP '{SINCE}' GROUP BY 1, 2""",
}


def _production_sql(margin: str, since: bool) -> str:
    cut = f"AND job_start_date >= TIMESTAMP '{SINCE}'" if since else ""
    return f"""SELECT CAST(job_start_date AS DATE) AS event_date, business_unit,
        {dsum('revenue_subtotal')} AS dollars_produced, {margin} * 100 AS gpm_percent,
        {ratio('SUM(CASE WHEN is_warranty THEN total_cost ELSE 0 END)', 'SUM(revenue_subtotal)')} * 100
            AS warranty_percent,
        {ratio('SUM(revenue_subtotal)', 'SUM(labor_cost)')} AS labor_efficiency,
        {ratio('SUM(material_cost_net)', 'SUM(revenue_subtotal)')} * 100 AS material_cost_percent,
        COUNT(DISTINCT job_id) AS completed_job_count,
        COUNT(DISTINCT job_id) FILTER (is_warranty) AS warranty_job_count
        FROM job_costing WHERE business_unit LIKE '%-Production' AND job_status IN ('Completed', 'Hold') {cut}
        GROUP BY 1, 2"""


_EARNING = ratio(
    "SUM(CASE WHEN revenue_subtotal > 0 THEN gross_profit ELSE 0 END)",
    "SUM(CASE WHEN revenue_subtotal > 0 THEN revenue_subtotal ELSE 0 END)",
)
_ALL_JOBS = ratio("SUM(gross_profit)", "SUM(revenue_subtotal)")
BRANCH_SQL["k_production"] = _production_sql(_EARNING, True)
BRANCH_SQL["k_production_all"] = _production_sql(_ALL_JOBS, False)

_PROD = [
    "dollars_produced",
    "gpm_percent",
    "warranty_percent",
    "labor_efficiency",
    "material_cost_percent",
    "completed_job_count",
    "warranty_job_count",
]
_SIX = {
    "k_leads": ["lead_count"],
    "k_made": ["estimate_count"],
    "k_close": ["sales_opportunities", "closed_opportunities", "close_rate"],
    "k_revenue": ["total_booked"],
    "k_production": _PROD,
    "k_collected": ["dollars_collected", "payment_count"],
}


def _stack_sql(branches: dict[str, list[str]], value: str) -> str:
    """Union of the branches, each column filled with ``value`` where a branch lacks it."""
    columns = list(dict.fromkeys(c for cs in branches.values() for c in cs))
    parts = [
        "SELECT event_date, business_unit, "
        + ", ".join(c if c in cs else f"{value} AS {c}" for c in columns)
        + f" FROM {name}"
        for name, cs in branches.items()
    ]
    return " UNION ALL ".join(parts)


def _max_sql(branches: dict[str, list[str]]) -> str:
    columns = list(dict.fromkeys(c for cs in branches.values() for c in cs))
    return (
        "SELECT event_date, business_unit, "
        + ", ".join(f"MAX({c}) AS {c}" for c in columns)
        + f" FROM ({_stack_sql(branches, '0')}) GROUP BY 1, 2"
    )


def _value_sql(branches: dict[str, list[str]]) -> str:
    columns = list(dict.fromkeys(c for cs in branches.values() for c in cs))
    picked = ", ".join(
        f"MAX({c}) AS {c}" if c in kpi.RATES else f"COALESCE(MAX({c}), 0) AS {c}" for c in columns
    )
    return f"SELECT event_date, business_unit, {picked} FROM ({_stack_sql(branches, 'NULL')}) GROUP BY 1, 2"


DAILY = BRANCH_SQL | {"daily_kpis": _value_sql(_SIX)}


# --- KPI tables --------------------------------------------------------------------------


def ten_kpis(d: Domain, window: tuple[str, str] | None = None, units: Sequence[str] = ()) -> DataFrame:
    """The ten-KPI table; receivables and future bookings are snapshots per unit."""
    return kpi.ten_kpis(
        d.dim_jobs(),
        d.customers(),
        d.estimates(),
        d.invoices(),
        d.payments(),
        job_cost_fact(d),
        since=SINCE,
        as_of=AS_OF,
        excluded_types=NON_PRODUCTION_JOB_TYPES,
        window=window,
        units=units,
    )


TEN_KPI_SQL = FACT | {
    "t_leads": f"""SELECT CAST(j.created_on AS DATE) AS event_date, j.business_unit,
            COUNT(DISTINCT j.customer_id) AS lead_count
        FROM dim_jobs j LEFT JOIN customers c ON j.customer_id = c.id
        WHERE j.business_unit LIKE '%-Sales' AND j.job_type_name ILIKE '%estimate%'
          AND (c.name IS NULL OR c.name NOT ILIKE '%test%') AND j.created_on >= TIMESTAMP '{SINCE}'
        GROUP BY 1, 2""",
    "t_booked": f"""SELECT {ldate('e.sold_on')} AS event_date, j.business_unit, {dsum('e.subtotal')} AS total_booked
        FROM estimates e JOIN dim_jobs j ON e.job_id = j.id
        WHERE j.business_unit LIKE '%-Sales' AND e.status = 'Sold' AND e.sold_on >= TIMESTAMP '{SINCE}'
        GROUP BY 1, 2""",
    "t_inv": f"""SELECT CAST(i.invoice_date AS DATE) AS event_date, j.business_unit, j.job_type_name, i.total,
            COALESCE(c.total_cost, 0) AS cost
        FROM invoices i JOIN dim_jobs j ON i.job_id = j.id LEFT JOIN costed c ON c.job_id = i.job_id
        WHERE j.business_unit LIKE '%-Production' AND i.invoice_date >= TIMESTAMP '{SINCE}'""",
    "t_margin": f"""SELECT event_date, business_unit, {dsum('total')} AS dollars_produced,
            CASE WHEN SUM(total) > 0 THEN {ratio('SUM(total) - SUM(cost)', 'SUM(total)')} * 100 END AS gpm_percent
        FROM t_inv WHERE job_type_name NOT IN {EXCLUDED} GROUP BY 1, 2""",
    "t_warranty": f"""SELECT event_date, business_unit, CASE WHEN SUM(total) > 0 THEN
            {ratio("SUM(CASE WHEN job_type_name IN ('Warranty', 'Touchup') THEN cost ELSE 0 END)", 'SUM(total)')}
            * 100 END AS warranty_percent FROM t_inv GROUP BY 1, 2""",
    "t_collected": f"""SELECT CAST(p.created_on AS DATE) AS event_date, j.business_unit,
            {dsum('p.amount')} AS dollars_collected
        FROM payments p JOIN invoices i ON p.invoice_id = i.id JOIN dim_jobs j ON i.job_id = j.id
        WHERE j.business_unit LIKE '%-Production' GROUP BY 1, 2""",
    "t_estimates": f"""SELECT CAST(completed_on AS DATE) AS event_date, business_unit, COUNT(*) AS num_estimates
        FROM dim_jobs WHERE business_unit LIKE '%-Sales' AND job_status = 'Completed'
          AND job_type_name ILIKE '%estimate%' AND completed_on >= TIMESTAMP '{SINCE}' GROUP BY 1, 2""",
    "t_rate": f"""SELECT CAST(e.created_on AS DATE) AS event_date, j.business_unit,
            {ratio("COUNT(*) FILTER (e.status = 'Sold')", 'COUNT(*)')} * 100 AS close_rate_percent
        FROM estimates e JOIN dim_jobs j ON e.job_id = j.id
        WHERE j.business_unit LIKE '%-Sales' AND j.job_type_name ILIKE '%estimate%'
          AND e.created_on >= TIMESTAMP '{SINCE}' GROUP BY 1, 2""",
    "t_future": f"""SELECT j.business_unit, {dsum('i.total')} AS future_bookings
        FROM invoices i JOIN dim_jobs j ON i.job_id = j.id
        WHERE j.business_unit LIKE '%-Production' AND j.job_type_name NOT IN {EXCLUDED}
          AND CAST(i.invoice_date AS DATE) > DATE '{AS_OF}'
          AND CAST(i.invoice_date AS DATE) <= DATE '2001-01-01' GROUP BY 1""",
    "t_ar": f"""SELECT j.business_unit, {dsum('i.balance')} AS outstanding_ar
        FROM invoices i JOIN dim_jobs j ON i.job_id = j.id
        WHERE i.balance >= 10 AND j.business_unit LIKE '%-Production' GROUP BY 1""",
    "ten_kpis": """SELECT s.event_date, s.business_unit, COALESCE(lead_count, 0) AS lead_count,
            COALESCE(total_booked, 0) AS total_booked, COALESCE(dollars_produced, 0) AS dollars_produced,
            COALESCE(gpm_percent, 0) AS gpm_percent, COALESCE(warranty_percent, 0) AS warranty_percent,
            COALESCE(dollars_collected, 0) AS dollars_collected, COALESCE(num_estimates, 0) AS num_estimates,
            COALESCE(close_rate_percent, 0) AS close_rate_percent,
            COALESCE(future_bookings, 0) AS future_bookings, COALESCE(outstanding_ar, 0) AS outstanding_ar
        FROM (SELECT event_date, business_unit FROM t_leads UNION SELECT event_date, business_unit FROM t_booked
              UNION SELECT event_date, business_unit FROM t_warranty
              UNION SELECT event_date, business_unit FROM t_collected
              UNION SELECT event_date, business_unit FROM t_estimates
              UNION SELECT event_date, business_unit FROM t_rate) s
        LEFT JOIN t_leads USING (event_date, business_unit) LEFT JOIN t_booked USING (event_date, business_unit)
        LEFT JOIN t_margin USING (event_date, business_unit) LEFT JOIN t_warranty USING (event_date, business_unit)
        LEFT JOIN t_collected USING (event_date, business_unit)
        LEFT JOIN t_estimates USING (event_date, business_unit) LEFT JOIN t_rate USING (event_date, business_unit)
        LEFT JOIN t_future USING (business_unit) LEFT JOIN t_ar USING (business_unit)""",
}

query("kpi_01_ten_kpis", "SELECT * FROM ten_kpis", **TEN_KPI_SQL)(ten_kpis)

_SOLD_JOB = f"""SELECT CAST(sold_on AS DATE) AS event_date, business_unit, COUNT(DISTINCT job_id) AS lead_count,
    COUNT(DISTINCT id) AS estimate_count, {dsum('amount')} AS total_booked, 1.0::DOUBLE AS close_rate
    FROM k_sales WHERE status = 'Sold' AND sold_on IS NOT NULL GROUP BY 1, 2"""
_SALE = ["lead_count", "estimate_count", "total_booked", "close_rate"]


@query(
    "kpi_02_sales_and_production_max",
    _max_sql({"sold_branch": _SALE, "k_production_all": _PROD}),
    sold_branch=_SOLD_JOB,
    **BRANCH_SQL,
)
def _(d: Domain) -> DataFrame:
    return kpi.stack_max(
        [
            kpi.sold_sales(d.estimates(), d.dim_jobs(), close_by="customer_id"),
            kpi.production_kpis(job_costing(d)),
        ]
    )


_CREATED = f"""SELECT CAST(created_on AS DATE) AS event_date, business_unit,
    COUNT(DISTINCT customer_id) AS lead_count, COUNT(DISTINCT id) AS estimate_count,
    {dsum("CASE WHEN status = 'Sold' THEN amount ELSE 0 END")} AS total_booked,
    {ratio("COUNT(DISTINCT customer_id) FILTER (status = 'Sold')", 'COUNT(DISTINCT customer_id)')} AS close_rate
    FROM k_sales WHERE created_on >= TIMESTAMP '{SINCE}' GROUP BY 1, 2"""


@query(
    "kpi_03_customer_close_rate_max",
    _max_sql(
        {
            "created_branch": _SALE,
            "k_production_all": _PROD,
            "k_collected": ["dollars_collected", "payment_count"],
        }
    ),
    created_branch=_CREATED,
    **BRANCH_SQL,
)
def _(d: Domain) -> DataFrame:
    dim = d.dim_jobs()
    return kpi.stack_max(
        [
            kpi.created_sales(d.estimates(), dim, SINCE),
            kpi.production_kpis(job_costing(d)),
            kpi.collected(d.payments(), d.invoices(), dim, SINCE),
        ]
    )


_OPPS = f"""SELECT CAST(j.created_on AS DATE) AS event_date, j.business_unit, COUNT(DISTINCT j.id) AS lead_count,
    COUNT(DISTINCT e.id) AS estimate_count,
    {ratio("COUNT(DISTINCT j.id) FILTER (e.status = 'Sold')", 'COUNT(DISTINCT j.id)')} AS close_rate
    FROM dim_jobs j LEFT JOIN estimates e ON e.job_id = j.id
    WHERE j.business_unit LIKE '%-Sales' AND j.created_on >= TIMESTAMP '{SINCE}' GROUP BY 1, 2"""


@query(
    "kpi_04_job_opportunities_max",
    _max_sql(
        {
            "sold_branch": _SALE,
            "k_production_all": _PROD,
            "k_collected": ["dollars_collected", "payment_count"],
            "opp_branch": ["lead_count", "estimate_count", "close_rate"],
        }
    ),
    sold_branch=_SOLD_JOB,
    opp_branch=_OPPS,
    **BRANCH_SQL,
)
def _(d: Domain) -> DataFrame:
    dim, estimates = d.dim_jobs(), d.estimates()
    return kpi.stack_max(
        [
            kpi.sold_sales(estimates, dim),
            kpi.production_kpis(job_costing(d)),
            kpi.collected(d.payments(), d.invoices(), dim, SINCE),
            kpi.job_opportunities(estimates, dim, SINCE),
        ]
    )


@query("kpi_05_own_dates_max", _max_sql(_SIX), **BRANCH_SQL)
def _(d: Domain) -> DataFrame:
    dim, estimates = d.dim_jobs(), d.estimates()
    return kpi.stack_max(
        [
            kpi.created_leads(dim, SINCE, type_ids=SALES_TYPES),
            kpi.made_estimates(estimates, dim, SINCE, type_ids=SALES_TYPES),
            kpi.sold_close_rate(estimates, dim, SINCE, type_ids=SALES_TYPES),
            kpi.sold_revenue(estimates, dim, SINCE),
            kpi.production_kpis(job_costing(d), SINCE, positive_revenue_margin=True),
            kpi.collected(d.payments(), d.invoices(), dim, SINCE),
        ]
    )


@query("kpi_05_own_dates", "SELECT * FROM daily_kpis", **DAILY)
def daily_kpis(d: Domain) -> DataFrame:
    dim = d.dim_jobs()
    return kpi.stack_values(
        [
            kpi.created_leads(dim, SINCE, type_ids=SALES_TYPES),
            kpi.sales_by_own_date(d.estimates(), dim, SINCE, type_ids=SALES_TYPES),
            kpi.production_kpis(job_costing(d), SINCE, positive_revenue_margin=True),
            kpi.collected(d.payments(), d.invoices(), dim, SINCE),
        ],
        kpi.RATES,
    )


_CONSOLIDATED = {
    "f_leads": """SELECT CAST(job_created_on AS DATE) AS kpi_date, bu_key, COUNT(*) AS leads
        FROM report_leads WHERE job_created_on IS NOT NULL AND bu_key IS NOT NULL GROUP BY 1, 2""",
    "f_collected": f"""SELECT CAST(payment_date AS DATE) AS kpi_date, business_unit AS bu_key,
        {rsum('amount')} AS collected_amount FROM collections
        WHERE payment_date IS NOT NULL AND business_unit IS NOT NULL GROUP BY 1, 2""",
    "f_sales": f"""SELECT event_date AS kpi_date, bu_name AS bu_key,
        CAST(SUM(sales_opportunities) AS BIGINT) AS sales_opportunities,
        CAST(SUM(closed_opportunities) AS BIGINT) AS closed_opportunities,
        {rnd(ratio('SUM(closed_opportunities)', 'SUM(sales_opportunities)'), 4)} AS close_rate,
        {rsum('total_sales')} AS total_sales,
        {rnd(ratio('SUM(total_sales)', 'SUM(closed_opportunities)'))} AS avg_closed_sale
        FROM report_sales WHERE event_date IS NOT NULL AND bu_name IS NOT NULL GROUP BY 1, 2""",
    "f_cost": f"""SELECT CAST(job_start AS DATE) AS kpi_date, bu_key, COUNT(*) AS completed_jobs,
        {rsum('job_subtotal')} AS job_subtotal, {rsum('job_total_costs')} AS job_costs,
        {pct('SUM(job_subtotal) - SUM(job_total_costs)', 'SUM(job_subtotal)')} AS gross_margin_pct
        FROM report_job_cost WHERE job_start IS NOT NULL AND bu_key IS NOT NULL GROUP BY 1, 2""",
    "consolidated": """SELECT * FROM (SELECT kpi_date, bu_key FROM f_leads UNION SELECT kpi_date, bu_key FROM f_collected
            UNION SELECT kpi_date, bu_key FROM f_sales UNION SELECT kpi_date, bu_key FROM f_cost) s
        LEFT JOIN f_leads USING (kpi_date, bu_key) LEFT JOIN f_collected USING (kpi_date, bu_key)
        LEFT JOIN f_sales USING (kpi_date, bu_key) LEFT JOIN f_cost USING (kpi_date, bu_key)""",
}


@query("kpi_06_consolidated", "SELECT * FROM consolidated", **_CONSOLIDATED)
def consolidated(d: Domain) -> DataFrame:
    facts = [
        marts.report_leads_daily(d.report_leads()),
        marts.report_collections_daily(d.collections()).select(
            "kpi_date", F.col("business_unit").alias("bu_key"), F.col("amount").alias("collected_amount")
        ),
        marts.report_sales_daily(d.report_sales()).withColumnRenamed("bu_name", "bu_key"),
        marts.report_job_cost_daily(d.report_job_cost()).select(
            "kpi_date",
            "bu_key",
            F.col("jobs").alias("completed_jobs"),
            "job_subtotal",
            F.col("job_total_costs").alias("job_costs"),
            F.col("gm_pct").alias("gross_margin_pct"),
        ),
    ]
    return kpi.spine(facts, keys=("kpi_date", "bu_key"), fill=False)


@query(
    "kpi_07_mart_refresh",
    """SELECT 'leads' AS mart, 'ok' AS status, COUNT(*) AS rows, NULL::VARCHAR AS error FROM f_leads
       UNION ALL SELECT 'sales', 'ok', COUNT(*), NULL FROM f_sales
       UNION ALL SELECT 'broken', 'error', NULL, '[UNRESOLVED_COLUMN.WITH_SUGGESTION]'
       UNION ALL SELECT 'job_cost', 'ok', COUNT(*), NULL FROM f_cost
       UNION ALL SELECT 'consolidated', 'ok', COUNT(*), NULL FROM
           (SELECT kpi_date, bu_key FROM f_leads UNION SELECT kpi_date, bu_key FROM f_sales)""",
    **_CONSOLIDATED,
)
def _(d: Domain) -> DataFrame:
    """Facts first, then the table that reads them; one mart names a missing column."""
    folder = new_folder(d.spark, "refresh")

    def fact(name: str) -> DataFrame:
        return tables.current(d.spark, f"{folder}/{name}")

    report = kpi.refresh_all(
        {
            "leads": lambda: marts.report_leads_daily(d.report_leads()),
            "sales": lambda: marts.report_sales_daily(d.report_sales()).withColumnRenamed("bu_name", "bu_key"),
            "broken": lambda: d.report_sales().select("no_such_column"),
            "job_cost": lambda: marts.report_job_cost_daily(d.report_job_cost()),
            "consolidated": lambda: kpi.spine(
                [fact("leads"), fact("sales")], keys=("kpi_date", "bu_key"), fill=False
            ),
        },
        folder,
    )
    rows = [(r["mart"], r["status"], r["rows"], r["error"] and r["error"].split(" ")[0]) for r in report]
    return d.spark.createDataFrame(rows, "mart string, status string, rows bigint, error string")


@query("kpi_08_invoice_margin", """SELECT event_date, business_unit, dollars_produced, gpm_percent, warranty_percent
    FROM t_warranty LEFT JOIN t_margin USING (event_date, business_unit)""", **TEN_KPI_SQL)
def _(d: Domain) -> DataFrame:
    return kpi.invoice_margin(
        d.invoices(), d.dim_jobs(), job_cost_fact(d), SINCE, excluded_types=NON_PRODUCTION_JOB_TYPES
    )


@query("kpi_09_mean_close_rate", "SELECT * FROM t_rate", t_rate=TEN_KPI_SQL["t_rate"])
def _(d: Domain) -> DataFrame:
    return kpi.mean_close_rate(d.estimates(), d.dim_jobs(), SINCE)


@query(
    "kpi_10_margin_two_ways",
    f"""SELECT business_unit, {rnd(ratio('SUM(g)', 'COUNT(g)'))} AS gpm_average,
               {pct('SUM(gross_profit)', 'SUM(revenue_subtotal)')} AS gpm_weighted
        FROM (SELECT *, CAST(CAST(gross_profit AS DOUBLE) / NULLIF(CAST(revenue_subtotal AS DOUBLE), 0) * 100
                             AS DECIMAL(28,6)) AS g FROM job_costing)
        WHERE business_unit LIKE '%-Production' AND job_status IN ('Completed', 'Hold')
          AND CAST(job_start_date AS DATE) BETWEEN DATE '{WINDOW[0]}' AND DATE '{WINDOW[1]}' GROUP BY 1""",
)
def _(d: Domain) -> DataFrame:
    return kpi.margin_two_ways(job_costing(d), *WINDOW)


@query(
    "kpi_11_report_leads",
    f"""SELECT j.business_unit, COUNT(DISTINCT c.name) AS lead_count
        FROM dim_jobs j LEFT JOIN customers c ON j.customer_id = c.id
        WHERE j.business_unit LIKE '%-Sales' AND j.job_type_name = 'ESTIMATE-RES-EXT'
          AND (c.name IS NULL OR c.name NOT ILIKE '%test%')
          AND CAST(j.created_on AS DATE) BETWEEN DATE '{WINDOW[0]}' AND DATE '{WINDOW[1]}' GROUP BY 1""",
)
def _(d: Domain) -> DataFrame:
    return kpi.report_leads(d.dim_jobs(), d.customers(), *WINDOW)


@query(
    "kpi_11_report_warranty",
    f"""SELECT business_unit, COUNT(*) FILTER (is_warranty) AS warranty_jobs,
               CAST(SUM(total_cost) FILTER (is_warranty) AS DOUBLE) AS warranty_cost,
               {dsum(f'CASE WHEN job_type NOT IN {EXCLUDED} THEN revenue_subtotal ELSE 0 END')} AS dollars_produced,
               {pct('SUM(total_cost) FILTER (is_warranty)',
                    f'SUM(CASE WHEN job_type NOT IN {EXCLUDED} THEN revenue_subtotal ELSE 0 END)')} AS warranty_percent
        FROM job_costing WHERE business_unit LIKE '%-Production'
          AND CAST(job_start_date AS DATE) BETWEEN DATE '{WINDOW[0]}' AND DATE '{WINDOW[1]}'
        GROUP BY 1 HAVING COUNT(*) FILTER (is_warranty) > 0""",
)
def _(d: Domain) -> DataFrame:
    return kpi.report_warranty(job_costing(d), *WINDOW, excluded_types=NON_PRODUCTION_JOB_TYPES)


@query(
    "kpi_11_report_receivables",
    f"""SELECT bu_key, {dsum('net_amount')} AS outstanding_ar FROM report_receivables
        WHERE location_name <> 'view' AND net_amount >= 10 GROUP BY 1""",
)
def _(d: Domain) -> DataFrame:
    return kpi.report_receivables(d.report_receivables(), excluded_location="view")


@query(
    "kpi_11_report_future_bookings",
    f"""SELECT business_unit, {dsum('revenue_subtotal')} AS future_bookings FROM job_costing
        WHERE business_unit LIKE '%-Production' AND job_type NOT IN {EXCLUDED}
          AND CAST(job_start_date AS DATE) BETWEEN DATE '1999-12-27' AND DATE '2000-12-27' GROUP BY 1""",
)
def _(d: Domain) -> DataFrame:
    return kpi.report_future_bookings(job_costing(d), AS_OF, excluded_types=NON_PRODUCTION_JOB_TYPES)


# --- regions ------------------------------------------------------------------------------

REGIONS = "SELECT name AS business_unit, region FROM units"


def _zero_if(side: str, c: str) -> str:
    return f"SUM(CASE WHEN business_unit LIKE '%{side}' THEN CAST({c} AS DECIMAL(28,6)) ELSE 0 END)"


def _weighted(side: str, c: str, w: str) -> str:
    return ratio(
        f"SUM(CASE WHEN business_unit LIKE '%{side}' THEN COALESCE(CAST({c} AS DECIMAL(24,6))"
        f" * CAST({w} AS DECIMAL(14,4)), 0) ELSE 0 END)",
        _zero_if(side, w),
    )


@query(
    "reg_01_regional_kpis",
    f"""SELECT event_date, region, CAST({_zero_if('-Sales', 'lead_count')} AS BIGINT) AS lead_count,
               CAST({_zero_if('-Sales', 'total_booked')} AS DOUBLE) AS total_booked,
               CAST({_zero_if('-Sales', 'num_estimates')} AS BIGINT) AS num_estimates,
               {ratio(_zero_if('-Sales', 'num_estimates'), _zero_if('-Sales', 'lead_count'))} * 100 AS close_rate_percent,
               CAST({_zero_if('-Production', 'dollars_produced')} AS DOUBLE) AS dollars_produced,
               {_weighted('-Production', 'gpm_percent', 'dollars_produced')} AS gpm_percent,
               {_weighted('-Production', 'warranty_percent', 'dollars_produced')} AS warranty_percent,
               CAST({_zero_if('', 'dollars_collected')} AS DOUBLE) AS dollars_collected,
               CAST({_zero_if('', 'outstanding_ar')} AS DOUBLE) AS outstanding_ar,
               CAST({_zero_if('-Sales', 'future_bookings')} AS DOUBLE) AS future_bookings
        FROM ten_kpis JOIN regions USING (business_unit) WHERE event_date >= DATE '{SINCE}' GROUP BY 1, 2""",
    regions=REGIONS,
    **TEN_KPI_SQL,
)
def _(d: Domain) -> DataFrame:
    return regional.regional_kpis(ten_kpis(d), d.regions(), SINCE)


@query(
    "reg_02_regional_kpis_by_estimates",
    f"""SELECT event_date, region, CAST({_zero_if('-Sales', 'lead_count')} AS BIGINT) AS lead_count,
               CAST({_zero_if('-Sales', 'estimate_count')} AS BIGINT) AS estimate_count,
               CAST(ROUND({_zero_if('-Sales', 'total_booked')}, 2) AS DOUBLE) AS total_booked,
               {rnd(_weighted('-Sales', 'close_rate', 'estimate_count') + ' * 100', 1)} AS close_rate_percent,
               CAST(ROUND({_zero_if('-Production', 'dollars_produced')}, 2) AS DOUBLE) AS dollars_produced,
               {rnd(_weighted('-Production', 'gpm_percent', 'dollars_produced'), 1)} AS gpm_percent,
               {rnd(_weighted('-Production', 'warranty_percent', 'dollars_produced'))} AS warranty_percent,
               {rnd(_weighted('-Production', 'labor_efficiency', 'dollars_produced'))} AS labor_efficiency,
               CAST({_zero_if('-Production', 'completed_job_count')} AS BIGINT) AS completed_job_count,
               CAST({_zero_if('-Production', 'warranty_job_count')} AS BIGINT) AS warranty_job_count,
               {rnd(ratio(_zero_if('-Sales', 'total_booked'),
                          "SUM(CASE WHEN business_unit LIKE '%-Sales' AND total_booked > 0 THEN estimate_count ELSE 0 END)"))}
                   AS avg_sale_amount
        FROM daily_kpis JOIN regions USING (business_unit) WHERE event_date >= DATE '{SINCE}' GROUP BY 1, 2""",
    regions=REGIONS,
    **DAILY,
)
def _(d: Domain) -> DataFrame:
    return regional.regional_kpis_by_estimates(daily_kpis(d), d.regions(), SINCE)


@query(
    "reg_02_unmapped_units",
    """SELECT business_unit, COUNT(DISTINCT event_date) AS days FROM (
           SELECT CAST(created_on AS DATE) AS event_date, business_unit FROM dim_jobs)
       WHERE business_unit NOT IN (SELECT name FROM units) GROUP BY 1""",
)
def _(d: Domain) -> DataFrame:
    daily = d.dim_jobs().select(F.to_date("created_on").alias("event_date"), "business_unit").distinct()
    return regional.unmapped_units(daily, d.regions())


_PATTERNS = [("Unit 1%", "West"), ("Unit 2%", "East")]
_REGION_CASE = "CASE WHEN bu_key LIKE 'Unit 1%' THEN 'West' WHEN bu_key LIKE 'Unit 2%' THEN 'East' ELSE 'Other' END"


def _measures_sql() -> str:
    money = "CAST({} AS DECIMAL(18,4))".format
    rev, cost = f"SUM({money('job_subtotal')})", f"SUM({money('job_costs')})"
    return f"""CAST(SUM(leads) AS BIGINT) AS total_leads, {rsum(money('collected_amount'))} AS total_collected,
        CAST(SUM(sales_opportunities) AS BIGINT) AS total_opps, CAST(SUM(closed_opportunities) AS BIGINT) AS total_closed,
        {pct('SUM(closed_opportunities)', 'SUM(sales_opportunities)')} AS close_rate_pct,
        {rsum(money('total_sales'))} AS total_sales, CAST(SUM(completed_jobs) AS BIGINT) AS jobs,
        {rsum(money('job_subtotal'))} AS job_revenue, {pct(f'{rev} - {cost}', rev)} AS gm_pct"""


@query(
    "reg_03_region_by_pattern",
    f"""SELECT {_REGION_CASE} AS region, {_measures_sql()} FROM consolidated
        WHERE kpi_date BETWEEN DATE '{WINDOW[0]}' AND DATE '{WINDOW[1]}' GROUP BY 1""",
    **_CONSOLIDATED,
)
def _(d: Domain) -> DataFrame:
    return regional.consolidated_by_region(consolidated(d), _PATTERNS, *WINDOW)


_UNIT_REGIONS = "SELECT 'Unit ' || id AS bu_key, region AS region_label, substr(region, 1, 3) AS region_key FROM units"


def unit_regions(d: Domain) -> DataFrame:
    return d.units().select(
        F.concat(F.lit("Unit "), F.col("id")).alias("bu_key"),
        F.col("region").alias("region_label"),
        F.substring("region", 1, 3).alias("region_key"),
    )


@query(
    "reg_04_regional_consolidated_daily",
    f"""SELECT kpi_date, region_key, region_label, {_measures_sql()} FROM consolidated
        JOIN unit_regions USING (bu_key) GROUP BY 1, 2, 3""",
    unit_regions=_UNIT_REGIONS,
    **_CONSOLIDATED,
)
def _(d: Domain) -> DataFrame:
    return regional.consolidated_daily_by_region(consolidated(d), unit_regions(d))


# --- periods ---------------------------------------------------------------------------------


def _exact(c: str) -> str:
    return f"CAST({c} AS DECIMAL(28,6))"


def _by_produced(c: str) -> str:
    return ratio(
        f"SUM(CAST({c} AS DECIMAL(24,6)) * CAST(dollars_produced AS DECIMAL(14,4)))",
        f"SUM({_exact('dollars_produced')})",
    )


_WEEKLY = f"""SELECT business_unit, CAST(date_trunc('week', event_date) AS DATE) AS week_start,
    CAST(SUM(lead_count) AS BIGINT) AS lead_count, CAST(SUM(estimate_count) AS BIGINT) AS estimate_count,
    CAST(SUM(completed_job_count) AS BIGINT) AS completed_job_count,
    CAST(SUM(payment_count) AS BIGINT) AS payment_count, {rsum(_exact('total_booked'))} AS total_booked,
    {rsum(_exact('dollars_produced'))} AS dollars_produced, {rsum(_exact('dollars_collected'))} AS dollars_collected,
    CAST(SUM(sales_opportunities) AS BIGINT) AS sales_opportunities,
    CAST(SUM(closed_opportunities) AS BIGINT) AS closed_opportunities,
    {pct('SUM(closed_opportunities)', 'SUM(sales_opportunities)')} AS close_rate_pct,
    {rnd(_by_produced('gpm_percent'))} AS gpm_pct, {rnd(_by_produced('warranty_percent'))} AS warranty_pct
    FROM daily_kpis GROUP BY 1, 2"""
WEEKLY = DAILY | {"weekly": _WEEKLY}


@query("per_01_weekly_by_unit", "SELECT * FROM weekly", **WEEKLY)
def weekly(d: Domain) -> DataFrame:
    return periods.weekly_by_unit(daily_kpis(d))


@query(
    "per_02_weekly_by_region",
    f"""SELECT kpi_date - CAST(dayofweek(kpi_date) AS INTEGER) AS week_start, region_label,
               CAST(SUM(leads) AS BIGINT) AS weekly_leads, CAST(SUM(sales_opportunities) AS BIGINT) AS weekly_estimates,
               CAST(SUM(closed_opportunities) AS BIGINT) AS weekly_booked,
               {rsum('CAST(total_sales AS DECIMAL(18,4))')} AS weekly_sales,
               CAST(SUM(completed_jobs) AS BIGINT) AS weekly_jobs,
               {rsum('CAST(collected_amount AS DECIMAL(18,4))')} AS weekly_collections
        FROM consolidated JOIN unit_regions USING (bu_key) GROUP BY 1, 2""",
    unit_regions=_UNIT_REGIONS,
    **_CONSOLIDATED,
)
def _(d: Domain) -> DataFrame:
    return periods.weekly_by_region(consolidated(d), unit_regions(d))


@query(
    "per_03_window_by_unit",
    f"""SELECT bu_key, {_measures_sql()} FROM consolidated
        WHERE kpi_date BETWEEN DATE '{WINDOW[0]}' AND DATE '{WINDOW[1]}' GROUP BY 1""",
    **_CONSOLIDATED,
)
def _(d: Domain) -> DataFrame:
    return periods.window_by_unit(consolidated(d), *WINDOW)


@query(
    "per_04_daily_trend",
    f"""SELECT kpi_date, CAST(SUM(leads) AS BIGINT) AS daily_leads,
               {rsum('CAST(collected_amount AS DECIMAL(18,4))')} AS daily_collected,
               CAST(SUM(sales_opportunities) AS BIGINT) AS daily_opps,
               CAST(SUM(closed_opportunities) AS BIGINT) AS daily_closed,
               {rsum('CAST(total_sales AS DECIMAL(18,4))')} AS daily_sales,
               CAST(SUM(completed_jobs) AS BIGINT) AS daily_jobs,
               {rsum('CAST(job_subtotal AS DECIMAL(18,4))')} AS daily_revenue
        FROM consolidated WHERE kpi_date BETWEEN DATE '{AS_OF}' - 30 AND DATE '{AS_OF}' GROUP BY 1""",
    **_CONSOLIDATED,
)
def _(d: Domain) -> DataFrame:
    return periods.daily_trend(consolidated(d), AS_OF)


@query(
    "per_05_monthly_summary",
    f"""SELECT CAST(date_trunc('month', l.kpi_date) AS DATE) AS month, l.business_unit,
               CAST(SUM(l.n) AS BIGINT) AS monthly_leads,
               CAST(COALESCE(SUM(c.n), 0) AS BIGINT) AS monthly_completions,
               {rnd(ratio('SUM(COALESCE(CAST(o.r AS DECIMAL(28,6)), 0))', 'COUNT(*)'))} AS avg_close_rate
        FROM (SELECT lead_date AS kpi_date, business_unit, COUNT(*) AS n FROM leads_jobs GROUP BY 1, 2) l
        LEFT JOIN (SELECT completed_date AS kpi_date, business_unit, COUNT(*) AS n
                   FROM completed_estimates_jobs GROUP BY 1, 2) c USING (kpi_date, business_unit)
        LEFT JOIN (SELECT opportunity_date AS kpi_date, business_unit,
                          {pct('COUNT(*) FILTER (is_closed_opportunity)', 'COUNT(*)')} AS r
                   FROM opportunity_jobs GROUP BY 1, 2) o USING (kpi_date, business_unit)
        WHERE l.kpi_date >= DATE '{SINCE}' GROUP BY 1, 2""",
)
def _(d: Domain) -> DataFrame:
    return periods.monthly_summary(
        marts.leads_daily_unit(leads(d)),
        marts.completed_estimates_daily(completed(d)),
        opportunity_daily(d),
        SINCE,
    )


@query(
    "per_06_invoice_revenue_by_month",
    f"""SELECT u.name AS business_unit, CAST(date_trunc('month', i.created_on) AS DATE) AS month,
               COUNT(DISTINCT i.id) AS invoice_count, {dsum('i.total')} AS total_revenue,
               {rnd(ratio('SUM(i.total)', 'COUNT(i.total)'))} AS avg_invoice_value
        FROM invoices i JOIN units u ON i.business_unit_id = u.id
        WHERE u.active AND i.created_on >= TIMESTAMP '{SINCE}' GROUP BY 1, 2""",
)
def _(d: Domain) -> DataFrame:
    return periods.invoice_revenue_by_month(d.invoices(), d.units(), SINCE)


def _mean(c: str) -> str:
    return rnd(ratio(f"SUM({_exact(c)})", f"COUNT({c})"))


KPI_WEEKS = TEN_KPI_SQL | {
    "kpi_weeks": f"""SELECT CAST(date_trunc('week', event_date) AS DATE) AS week_start, business_unit,
            CAST(SUM(lead_count) AS BIGINT) AS leads, {rsum(_exact('total_booked'))} AS total_booked,
            {rsum(_exact('dollars_produced'))} AS dollars_produced, {_mean('gpm_percent')} AS avg_gpm_percent,
            {rsum(_exact('dollars_collected'))} AS dollars_collected,
            CAST(SUM(num_estimates) AS BIGINT) AS estimates_count, {_mean('close_rate_percent')} AS avg_close_rate,
            MAX(future_bookings) AS future_bookings, {_mean('warranty_percent')} AS avg_warranty_percent,
            MAX(outstanding_ar) AS outstanding_ar
        FROM ten_kpis WHERE event_date BETWEEN DATE '1998-01-05' AND DATE '1998-03-29' GROUP BY 1, 2"""
}


@query("per_07_weekly_kpi_summary", "SELECT * FROM kpi_weeks", **KPI_WEEKS)
def kpi_weeks(d: Domain) -> DataFrame:
    """Twelve whole weeks."""
    return periods.weekly_kpi_summary(ten_kpis(d, ("1998-01-05", "1998-03-29")), "1998-01-05", "1998-03-29")


@query(
    "per_08_week_over_week_growth",
    f"""SELECT business_unit, week_start, total_booked, prev_week, {rnd(ratio('total_booked - prev_week', 'prev_week') + ' * 100')}
               AS growth_pct
        FROM (SELECT business_unit, week_start, total_booked,
                     LAG(total_booked) OVER (PARTITION BY business_unit ORDER BY week_start) AS prev_week FROM weekly)
        WHERE {ratio('total_booked - prev_week', 'prev_week')} > 0.10""",
    **WEEKLY,
)
def _(d: Domain) -> DataFrame:
    return periods.week_over_week(weekly(d), "total_booked")


@query(
    "per_09_low_margin_days",
    f"""SELECT kpi_date, business_unit, gpm_percent FROM (
            SELECT CAST(start_date AS DATE) AS kpi_date, business_unit,
                   {pct('SUM(gross_profit)', 'SUM(revenue_subtotal)')} AS gpm_percent
            FROM production_jobs GROUP BY 1, 2)
        WHERE gpm_percent < 90 AND kpi_date BETWEEN DATE '1998-03-02' - 60 AND DATE '1998-03-02'""",
)
def _(d: Domain) -> DataFrame:
    return periods.low_margin_days(margin_daily(d), "1998-03-02", limit=90.0, days=60).select(
        "kpi_date", "business_unit", "gpm_percent"
    )


@query(
    "per_10_year_over_year",
    f"""SELECT COALESCE(n.event_date, p.event_date) AS event_date, COALESCE(n.business_unit, p.business_unit) AS business_unit,
               n.total_booked AS current, p.total_booked AS prior,
               {pct('n.total_booked - p.total_booked', 'p.total_booked')} AS change_pct
        FROM (SELECT * FROM daily_kpis WHERE event_date BETWEEN DATE '1999-03-01' AND DATE '1999-03-28') n
        FULL JOIN (SELECT event_date + 365 AS event_date, business_unit, total_booked FROM daily_kpis
                   WHERE event_date + 365 BETWEEN DATE '1999-03-01' AND DATE '1999-03-28') p
        ON n.event_date = p.event_date AND n.business_unit = p.business_unit""",
    **DAILY,
)
def _(d: Domain) -> DataFrame:
    return periods.year_over_year(daily_kpis(d), "total_booked", "1999-03-01", "1999-03-28")


@query(
    "per_11_technician_utilisation",
    f"""SELECT t.name AS technician, u.name AS home_business_unit, a.n AS jobs_assigned,
               CAST(p.h AS DOUBLE) AS total_hours, CAST(p.a AS DOUBLE) AS total_compensation,
               {rnd(ratio('p.a', 'p.h'))} AS avg_hourly_rate
        FROM technicians t LEFT JOIN units u ON t.business_unit_id = u.id
        JOIN (SELECT customer_id AS tech, COUNT(DISTINCT id) AS n FROM jobs
              WHERE completed_on >= TIMESTAMP '{SINCE}' GROUP BY 1) a ON a.tech = t.id
        LEFT JOIN (SELECT employee_id, SUM(paid_duration_hours) AS h, SUM(amount) AS a
                   FROM payroll GROUP BY 1) p ON p.employee_id = t.id
        WHERE COALESCE(t.active, TRUE)""",
)
def _(d: Domain) -> DataFrame:
    """Jobs are assigned to the technician that has the customer's number."""
    jobs = d.jobs().withColumn("technician_id", F.col("customer_id"))
    return periods.technician_utilisation(d.technicians(), d.units(), jobs, d.payroll(), SINCE)


@query(
    "per_12_payroll_by_activity",
    f"""SELECT p.activity, u.name AS business_unit, {dsum('p.paid_duration_hours')} AS total_hours,
               {dsum('p.amount')} AS total_cost, COUNT(DISTINCT p.source_entity_id) AS payroll_entries
        FROM payroll p LEFT JOIN (SELECT 'Unit ' || (id + 3) AS name FROM units) u
             ON p.business_unit_name = u.name
        WHERE p.date >= TIMESTAMP '{SINCE}' GROUP BY 1, 2""",
)
def _(d: Domain) -> DataFrame:
    """The dimension numbers its units differently, so that payroll names some that it does not know."""
    known = d.units().select("id", F.concat(F.lit("Unit "), (F.col("id") + 3).cast("string")).alias("name"))
    return periods.payroll_by_activity(d.payroll(), known, SINCE)


@query(
    "per_13_leader_board",
    f"""SELECT estimator, {dsum('total_sales')} AS total_sales,
               CAST(SUM(sales_opportunities) AS BIGINT) AS sales_opportunities,
               CAST(SUM(closed_opportunities) AS BIGINT) AS closed_opportunities,
               {pct('SUM(closed_opportunities)', 'SUM(sales_opportunities)')} AS close_rate_pct
        FROM report_sales GROUP BY 1 ORDER BY SUM(total_sales) DESC, estimator LIMIT 20""",
)
def _(d: Domain) -> DataFrame:
    return periods.leader_board(d.report_sales())


@query(
    "per_13_company_totals",
    f"""SELECT COUNT(DISTINCT estimator) AS sellers, {dsum('total_sales')} AS total_sales,
               CAST(SUM(sales_opportunities) AS BIGINT) AS sales_opportunities,
               CAST(SUM(closed_opportunities) AS BIGINT) AS closed_opportunities,
               {pct('SUM(closed_opportunities)', 'SUM(sales_opportunities)')} AS close_rate_pct FROM report_sales""",
)
def _(d: Domain) -> DataFrame:
    return periods.company_totals(d.report_sales())


@query(
    "per_14_sign_audit",
    f"""SELECT t.*, s.negative_samples, s.positive_samples FROM (
            SELECT COALESCE(business_unit, 'unknown') AS unit, COUNT(*) AS payments,
                   {rsum('COALESCE(amount, 0)')} AS total_with_negatives,
                   COUNT(*) FILTER (amount > 0) AS positive_count,
                   {rsum('CASE WHEN amount > 0 THEN amount ELSE 0 END')} AS total_positives_only,
                   COUNT(*) FILTER (amount < 0) AS negative_count,
                   {rsum('CASE WHEN amount < 0 THEN amount ELSE 0 END')} AS negative_total,
                   COUNT(*) FILTER (amount IS NULL OR amount = 0) AS zero_count
            FROM collections GROUP BY 1) t
        LEFT JOIN (SELECT unit, string_agg(job_id, ',' ORDER BY r) FILTER (sign = -1) AS negative_samples,
                          string_agg(job_id, ',' ORDER BY r) FILTER (sign = 1) AS positive_samples FROM (
            SELECT COALESCE(business_unit, 'unknown') AS unit, sign(amount) AS sign, job_id, ROW_NUMBER() OVER (
                PARTITION BY COALESCE(business_unit, 'unknown'), sign(amount) ORDER BY payment_date, job_id, amount) AS r
            FROM collections WHERE amount <> 0) WHERE r <= 5 GROUP BY 1) s USING (unit)""",
)
def _(d: Domain) -> DataFrame:
    return periods.sign_audit(d.collections())


@query(
    "per_15_report_totals",
    f"""SELECT COALESCE(bu_name, 'ALL') AS bu_name, CAST(SUM(sales_opportunities) AS BIGINT) AS sales_opportunities,
               CAST(SUM(closed_opportunities) AS BIGINT) AS closed_opportunities, {rsum('total_sales')} AS total_sales
        FROM report_sales GROUP BY ROLLUP (bu_name)""",
)
def _(d: Domain) -> DataFrame:
    return periods.report_totals(d.report_sales())


@query(
    "per_16_lead_filter_funnel",
    """SELECT 'Unit ' || (l_orderkey % 25) AS bu_name, COUNT(*) AS fetched,
              COUNT(*) FILTER (CAST(l_tax AS DECIMAL(4,2)) <> 0.01) AS passed_unit,
              COUNT(*) FILTER (CAST(l_tax AS DECIMAL(4,2)) <> 0.01 AND l_discount <> 0) AS passed_name,
              COUNT(*) FILTER (CAST(l_tax AS DECIMAL(4,2)) <> 0.01 AND l_discount = 0) AS test_names
       FROM lineitem GROUP BY 1""",
)
def _(d: Domain) -> DataFrame:
    return periods.lead_filter_funnel(leads_report(d), "queried_unit")


@query(
    "per_17_job_mix",
    f"""SELECT j.business_unit, j.job_type_name,
               CASE WHEN j.job_type_id IN (3, 5) THEN 'Warranty' ELSE 'Regular' END AS category,
               COUNT(DISTINCT j.id) AS job_count, COUNT(DISTINCT j.customer_id) AS unique_customers,
               {dsum('i.s')} AS revenue
        FROM dim_jobs j LEFT JOIN (SELECT job_id, SUM(subtotal) AS s FROM invoices GROUP BY 1) i ON i.job_id = j.id
        WHERE CAST(j.created_on AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1998-12-31' GROUP BY 1, 2, 3""",
)
def _(d: Domain) -> DataFrame:
    return periods.job_mix(
        d.dim_jobs(), d.invoices(), job_type_warranty_category("job_type_name"), "1998-01-01", "1998-12-31"
    )


@query(
    "per_18_lead_sources",
    """SELECT j.business_unit, j.campaign_id, c.name AS campaign_name, COUNT(DISTINCT j.id) AS lead_count,
              COUNT(DISTINCT j.id) FILTER (e.id IS NOT NULL) AS leads_with_estimates,
              COUNT(DISTINCT j.id) FILTER (e.status = 'Sold') AS leads_sold
       FROM dim_jobs j LEFT JOIN campaigns c ON j.campaign_id = c.id LEFT JOIN estimates e ON e.job_id = j.id
       WHERE j.business_unit LIKE '%-Sales'
         AND CAST(j.created_on AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1998-12-31' GROUP BY 1, 2, 3""",
)
def _(d: Domain) -> DataFrame:
    return periods.lead_sources(
        kpi.unit_jobs(d.dim_jobs(), "-Sales"), d.estimates(), d.campaigns(), "1998-01-01", "1998-12-31"
    )


