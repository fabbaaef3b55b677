"""Stage tables, daily marts and job costing over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkpi.functions.parse import zip5_with_point
from fieldkpi.operators import costing, marts, stage
from fieldkpi.plans.catalog import query
from fieldkpi.plans.domain import Domain
from fieldkpi.plans.oracle import dsum, ldate, pct, ratio, rnd, rsum
from fieldkpi.sources.literals import literal_relation

AS_OF = "2000-01-01"
WEEK = ("1998-03-02", "1998-03-29")


def leads(d: Domain) -> DataFrame:
    return stage.leads_jobs(d.dim_jobs(), d.customers())


def completed(d: Domain) -> DataFrame:
    return stage.completed_estimates_jobs(d.dim_jobs())


def sold(d: Domain) -> DataFrame:
    return stage.sold_estimates(d.estimates(), d.dim_jobs())


def opportunities(d: Domain) -> DataFrame:
    return stage.opportunity_jobs(d.dim_jobs(), d.estimates(), d.invoices())


def job_costing(d: Domain, **options: object) -> DataFrame:
    with_adjustments = options.pop("include_adjustments", False)
    return costing.job_costing(
        d.dim_jobs(),
        d.appointments(),
        d.invoices(),
        d.payroll(),
        d.purchase_orders(),
        d.returns(),
        d.payroll_adjustments() if with_adjustments else None,
        **options,
    )


def production(d: Domain) -> DataFrame:
    return stage.production_jobs(job_costing(d))


def location_zips(d: Domain) -> DataFrame:
    return zip5_with_point(d.locations())


# --- stage ---------------------------------------------------------------------

query("stg_01_leads_jobs", "SELECT * FROM leads_jobs")(leads)
query("stg_02_completed_estimates_jobs", "SELECT * FROM completed_estimates_jobs")(completed)


@query(
    "stg_03_sold_estimates",
    "SELECT * REPLACE (CAST(revenue_amount AS DOUBLE) AS revenue_amount) FROM sold_estimates",
)
def _(d: Domain) -> DataFrame:
    return sold(d).withColumn("revenue_amount", F.col("revenue_amount").cast("double"))


query("stg_04_opportunity_jobs", "SELECT * FROM opportunity_jobs")(opportunities)


@query(
    "stg_05_report_opportunity_jobs",
    f"""
    SELECT j.id AS job_id, j.customer_id, j.business_unit, j.job_type_name, j.job_status,
           j.created_on AS job_created_on, j.completed_on AS job_completed_on,
           {ldate('j.completed_on')} AS completion_date, r.n AS total_estimates,
           r.ns AS sold_estimates, CAST(r.a AS DOUBLE) AS total_estimate_amount,
           CAST(r.b AS DOUBLE) AS total_sold_amount, COALESCE(r.ns > 0, FALSE) AS is_closed
    FROM dim_jobs j LEFT JOIN (
        SELECT job_id, COUNT(*) AS n, COUNT(sold_on) AS ns, SUM(subtotal) AS a,
               SUM(CASE WHEN sold_on IS NULL THEN 0 ELSE subtotal END) AS b
        FROM estimates GROUP BY job_id) r ON r.job_id = j.id
    WHERE j.job_status = 'Completed' AND j.job_type_name IN ('ESTIMATE-RES-EXT','ESTIMATE-COMM-INT')
      AND j.business_unit LIKE '%-Sales'""",
)
def _(d: Domain) -> DataFrame:
    out = stage.report_opportunity_jobs(d.dim_jobs(), d.estimates())
    return out.withColumns(
        {c: F.col(c).cast("double") for c in ("total_estimate_amount", "total_sold_amount")}
    )


_PROD_OUT = """SELECT * REPLACE (CAST(revenue_subtotal AS DOUBLE) AS revenue_subtotal,
    CAST(gross_profit AS DOUBLE) AS gross_profit, CAST(total_cost AS DOUBLE) AS total_cost,
    CAST(labor_cost AS DOUBLE) AS labor_cost,
    CAST(material_cost_net AS DOUBLE) AS material_cost_net) FROM production_jobs"""


@query("stg_06_production_jobs", _PROD_OUT)
def _(d: Domain) -> DataFrame:
    return costing.in_dollars(production(d))


@query(
    "stg_07_jobs_by_first_appointment",
    f"""SELECT job_id, MIN({ldate('scheduled_start')}) AS first_appointment FROM appts
        GROUP BY job_id HAVING MIN({ldate('scheduled_start')})
            BETWEEN DATE '{WEEK[0]}' AND DATE '{WEEK[1]}'""",
)
def _(d: Domain) -> DataFrame:
    return stage.jobs_by_first_appointment(d.appointments(), *WEEK)


# --- marts ----------------------------------------------------------------------


@query(
    "mrt_01_leads_daily",
    """SELECT lead_date AS kpi_date, COUNT(*) AS leads_count,
              COUNT(DISTINCT customer_id) AS unique_customers,
              COUNT(DISTINCT business_unit) AS business_units_with_leads
       FROM leads_jobs GROUP BY 1""",
)
def _(d: Domain) -> DataFrame:
    return marts.leads_daily(leads(d))


@query(
    "mrt_02_leads_daily_unit",
    """SELECT lead_date AS kpi_date, business_unit, COUNT(*) AS leads_count,
              COUNT(DISTINCT customer_id) AS unique_customers
       FROM leads_jobs GROUP BY 1, 2""",
)
def _(d: Domain) -> DataFrame:
    return marts.leads_daily_unit(leads(d))


@query(
    "mrt_03_completed_estimates_daily",
    """SELECT completed_date AS kpi_date, business_unit, COUNT(*) AS completed_estimates_count,
              COUNT(DISTINCT customer_id) AS unique_customers
       FROM completed_estimates_jobs GROUP BY 1, 2""",
)
def _(d: Domain) -> DataFrame:
    return marts.completed_estimates_daily(completed(d))


@query(
    "mrt_04_opportunity_daily",
    f"""SELECT opportunity_date AS kpi_date, business_unit, COUNT(*) AS sales_opportunities,
               COUNT(*) FILTER (is_closed_opportunity) AS closed_opportunities,
               {pct('COUNT(*) FILTER (is_closed_opportunity)', 'COUNT(*)')} AS close_rate_percent,
               COUNT(DISTINCT customer_id) AS unique_customers,
               CAST(SUM(estimate_count) AS BIGINT) AS total_estimates,
               CAST(SUM(sold_estimate_count) AS BIGINT) AS total_sold_estimates
        FROM opportunity_jobs WHERE opportunity_date IS NOT NULL GROUP BY 1, 2""",
)
def opportunity_daily(d: Domain) -> DataFrame:
    return marts.opportunity_daily(opportunities(d))


@query(
    "mrt_05_total_booked_daily",
    f"""SELECT sold_date AS kpi_date, business_unit, {dsum('revenue_amount')} AS total_booked,
               COUNT(*) AS sold_estimate_count, COUNT(DISTINCT job_id) AS unique_jobs_sold,
               COUNT(DISTINCT customer_id) AS unique_customers,
               {ratio('SUM(revenue_amount)', 'COUNT(revenue_amount)')} AS avg_sale_amount
        FROM sold_estimates GROUP BY 1, 2""",
)
def _(d: Domain) -> DataFrame:
    return marts.total_booked_daily(sold(d))


_SALES = f"""SELECT e.id, e.job_id, j.business_unit, e.subtotal, {ldate('e.sold_on')} AS kpi_date
    FROM estimates e JOIN dim_jobs j ON e.job_id = j.id
    WHERE e.status = 'Sold' AND e.sold_on IS NOT NULL AND j.business_unit LIKE '%-Sales'"""


@query(
    "mrt_06_total_sales_daily",
    f"""SELECT kpi_date, {rsum('subtotal')} AS total_sales, COUNT(DISTINCT id) AS sold_estimate_count,
               COUNT(DISTINCT job_id) AS job_count,
               COUNT(DISTINCT business_unit) AS business_units_with_sales,
               {rnd(ratio('SUM(subtotal)', 'COUNT(subtotal)'))} AS avg_sale_amount,
               CAST(ROUND(MIN(subtotal), 2) AS DOUBLE) AS min_sale_amount,
               CAST(ROUND(MAX(subtotal), 2) AS DOUBLE) AS max_sale_amount
        FROM sales_rows GROUP BY 1""",
    sales_rows=_SALES,
)
def _(d: Domain) -> DataFrame:
    return marts.total_sales_daily(marts.sold_in_sales_units(d.estimates(), d.dim_jobs()))


@query(
    "mrt_07_total_sales_daily_unit",
    f"""SELECT kpi_date, business_unit, {rsum('subtotal')} AS total_sales,
               COUNT(DISTINCT id) AS sold_estimate_count, COUNT(DISTINCT job_id) AS job_count,
               {rnd(ratio('SUM(subtotal)', 'COUNT(subtotal)'))} AS avg_sale_amount
        FROM sales_rows GROUP BY 1, 2""",
    sales_rows=_SALES,
)
def _(d: Domain) -> DataFrame:
    return marts.total_sales_daily_unit(marts.sold_in_sales_units(d.estimates(), d.dim_jobs()))


@query(
    "mrt_08_dollars_produced_daily",
    f"""SELECT CAST(start_date AS DATE) AS kpi_date, business_unit,
               {dsum('revenue_subtotal')} AS dollars_produced,
               {dsum('gross_profit')} AS total_gross_profit, {dsum('total_cost')} AS total_cost,
               {dsum('labor_cost')} AS total_labor_cost,
               {dsum('material_cost_net')} AS total_material_cost, COUNT(*) AS total_job_count,
               COUNT(*) FILTER (is_warranty) AS warranty_job_count,
               COUNT(*) FILTER (job_status = 'Completed') AS completed_job_count,
               COUNT(*) FILTER (job_status = 'Hold') AS hold_job_count,
               {ratio('SUM(gross_profit)', 'SUM(revenue_subtotal)')} * 100 AS gpm_percent,
               {ratio('SUM(revenue_subtotal)', 'SUM(labor_cost)')} AS labor_efficiency
        FROM production_jobs GROUP BY 1, 2""",
)
def _(d: Domain) -> DataFrame:
    return marts.dollars_produced_daily(production(d))


@query(
    "mrt_09_margin_daily_unit",
    f"""SELECT CAST(start_date AS DATE) AS kpi_date, business_unit,
               {rsum('revenue_subtotal')} AS total_revenue, {rsum('labor_cost')} AS total_labor_cost,
               {rsum('material_cost_net')} AS total_material_cost, {rsum('total_cost')} AS total_cost,
               {rsum('gross_profit')} AS gross_profit,
               {pct('SUM(gross_profit)', 'SUM(revenue_subtotal)')} AS gpm_percent,
               COUNT(DISTINCT job_id) AS job_count,
               {pct('SUM(labor_cost)', 'SUM(revenue_subtotal)')} AS labor_percent_of_revenue,
               {pct('SUM(material_cost_net)', 'SUM(revenue_subtotal)')} AS material_percent_of_revenue
        FROM production_jobs GROUP BY 1, 2""",
)
def margin_daily(d: Domain) -> DataFrame:
    return marts.margin_daily(production(d))


_WCOST = "SUM(CASE WHEN is_warranty THEN total_cost ELSE 0 END)"


@query(
    "mrt_10_warranty_percent_daily_unit",
    f"""SELECT CAST(start_date AS DATE) AS kpi_date, business_unit,
               CAST(ROUND({_WCOST}, 2) AS DOUBLE) AS warranty_cost,
               {rsum('CASE WHEN is_warranty THEN 0 ELSE total_cost END')} AS non_warranty_cost,
               {rsum('total_cost')} AS total_cost, {rsum('revenue_subtotal')} AS dollars_produced,
               {pct(_WCOST, 'SUM(revenue_subtotal)')} AS warranty_percent, COUNT(*) AS total_jobs,
               COUNT(*) FILTER (is_warranty) AS warranty_jobs,
               COUNT(*) FILTER (NOT is_warranty) AS non_warranty_jobs
        FROM production_jobs GROUP BY 1, 2""",
)
def _(d: Domain) -> DataFrame:
    return marts.warranty_daily(production(d))


@query(
    "mrt_11_collections_daily_unit",
    f"""SELECT CAST(payment_date AS DATE) AS kpi_date, business_unit, COUNT(*) AS payment_count,
               {rsum('amount')} AS total_collections,
               {rnd(ratio('SUM(amount)', 'COUNT(amount)'))} AS avg_payment_amount,
               CAST(ROUND(MIN(amount), 2) AS DOUBLE) AS min_payment,
               CAST(ROUND(MAX(amount), 2) AS DOUBLE) AS max_payment, MAX(updated_on) AS last_updated
        FROM collections WHERE business_unit IS NOT NULL AND amount IS NOT NULL GROUP BY 1, 2""",
)
def _(d: Domain) -> DataFrame:
    return marts.collections_daily(d.collections())


_UNIT_INVOICES = """SELECT i.*, u.name AS unit_name FROM invoices i JOIN jobs j ON i.job_id = j.id
    JOIN units u ON j.business_unit_id = u.id"""


def unit_invoices(d: Domain) -> DataFrame:
    return marts.invoices_with_unit(d.invoices(), d.jobs(), d.units())


@query(
    "mrt_12_outstanding_ar_daily_unit",
    f"""SELECT CAST(invoice_date AS DATE) AS kpi_date, unit_name AS business_unit,
               COUNT(*) AS total_invoices, COUNT(*) FILTER (balance > 0) AS unpaid_invoices,
               COUNT(*) FILTER (balance = 0) AS paid_invoices, {rsum('balance')} AS outstanding_ar,
               {rsum('total')} AS total_invoiced, {rsum('total - balance')} AS total_paid,
               {pct('SUM(total - balance)', 'SUM(total)')} AS collection_rate_percent
        FROM unit_invoices GROUP BY 1, 2""",
    unit_invoices=_UNIT_INVOICES,
)
def _(d: Domain) -> DataFrame:
    return marts.outstanding_daily(unit_invoices(d))


def _aging(name: str, test: str) -> str:
    return f"""COUNT(*) FILTER (balance > 0 AND {test}) AS ar_{name}_count,
        {rsum(f'CASE WHEN balance > 0 AND {test} THEN balance ELSE 0 END')} AS ar_{name}"""


@query(
    "mrt_13_current_ar_by_unit",
    f"""SELECT unit_name AS business_unit, {rsum('balance')} AS current_outstanding_ar,
               COUNT(*) FILTER (balance > 0) AS unpaid_invoice_count,
               {rsum('CASE WHEN balance > 0 THEN total ELSE 0 END')} AS total_invoice_amount,
               {rsum('CASE WHEN balance > 0 THEN total - balance ELSE 0 END')} AS partial_payments_received,
               {_aging('0_30_days', 'age <= 30')}, {_aging('31_60_days', 'age BETWEEN 31 AND 60')},
               {_aging('over_60_days', 'age > 60')}
        FROM (SELECT *, DATE '{AS_OF}' - CAST(invoice_date AS DATE) AS age FROM unit_invoices)
        GROUP BY 1""",
    unit_invoices=_UNIT_INVOICES,
)
def current_ar(d: Domain) -> DataFrame:
    return marts.receivables_by_unit(unit_invoices(d), AS_OF)


@query(
    "mrt_14_future_bookings_daily_unit",
    f"""SELECT CAST(scheduled_start AS DATE) AS scheduled_date, u.name AS business_unit,
               COUNT(DISTINCT v.job_id) AS job_count, {rsum('v.val')} AS total_future_bookings,
               {rnd(ratio('SUM(v.val)', 'COUNT(*)'))} AS avg_booking_value
        FROM (SELECT a.job_id, a.scheduled_start, j.business_unit_id, COALESCE(SUM(i.total), 0) AS val
              FROM appts a JOIN jobs j ON a.job_id = j.id LEFT JOIN invoices i ON i.job_id = a.job_id
              WHERE CAST(a.scheduled_start AS DATE) > DATE '{AS_OF}'
                AND a.status NOT IN ('Canceled', 'Cancelled')
              GROUP BY 1, 2, 3) v
        JOIN units u ON v.business_unit_id = u.id WHERE u.name LIKE '%-Production' GROUP BY 1, 2""",
)
def _(d: Domain) -> DataFrame:
    return marts.future_bookings_daily(d.appointments(), d.jobs(), d.invoices(), d.units(), AS_OF)


@query(
    "mrt_15_report_leads_daily",
    """SELECT CAST(job_created_on AS DATE) AS kpi_date, bu_key, COUNT(*) AS leads FROM report_leads
       WHERE job_created_on IS NOT NULL AND bu_key IS NOT NULL GROUP BY 1, 2""",
)
def _(d: Domain) -> DataFrame:
    return marts.report_leads_daily(d.report_leads())


@query(
    "mrt_16_report_collections_daily",
    f"""SELECT CAST(payment_date AS DATE) AS kpi_date, business_unit, {rsum('amount')} AS amount
        FROM collections WHERE payment_date IS NOT NULL AND business_unit IS NOT NULL GROUP BY 1, 2""",
)
def _(d: Domain) -> DataFrame:
    return marts.report_collections_daily(d.collections())


@query(
    "mrt_17_report_sales_daily",
    f"""SELECT event_date AS kpi_date, bu_name,
               CAST(SUM(sales_opportunities) AS BIGINT) AS sales_opportunities,
               CAST(SUM(closed_opportunities) AS BIGINT) AS closed_opportunities,
               {rnd(ratio('SUM(closed_opportunities)', 'SUM(sales_opportunities)'), 4)} AS close_rate,
               {rsum('total_sales')} AS total_sales,
               {rnd(ratio('SUM(total_sales)', 'SUM(closed_opportunities)'))} AS avg_closed_sale
        FROM report_sales WHERE event_date IS NOT NULL AND bu_name IS NOT NULL GROUP BY 1, 2""",
)
def _(d: Domain) -> DataFrame:
    return marts.report_sales_daily(d.report_sales())


@query(
    "mrt_17_report_sales_passthrough",
    """SELECT event_date AS kpi_date, bu_name, sales_opportunities, closed_opportunities,
              CAST(total_sales AS DOUBLE) AS total_sales,
              CAST(avg_closed_sale AS DOUBLE) AS avg_closed_sale FROM report_sales""",
)
def _(d: Domain) -> DataFrame:
    return marts.report_sales_passthrough(d.report_sales())


@query(
    "mrt_18_report_job_cost_daily",
    f"""SELECT CAST(job_start AS DATE) AS kpi_date, bu_key, COUNT(*) AS jobs,
               {rsum('job_subtotal')} AS job_subtotal, {rsum('job_total_costs')} AS job_total_costs,
               {pct('SUM(job_subtotal) - SUM(job_total_costs)', 'SUM(job_subtotal)')} AS gm_pct
        FROM report_job_cost WHERE job_start IS NOT NULL AND bu_key IS NOT NULL GROUP BY 1, 2""",
)
def _(d: Domain) -> DataFrame:
    return marts.report_job_cost_daily(d.report_job_cost())


@query(
    "mrt_19_jobs_by_zip_window",
    """SELECT z.zip5 AS zip_code, COUNT(*) AS jobs_count, COUNT(DISTINCT j.id) AS jobs_distinct
       FROM jobs j JOIN location_zips z USING (location_id)
       WHERE (j.completed_on IS NULL OR CAST(j.completed_on AS DATE)
              BETWEEN DATE '1998-01-01' AND DATE '1998-12-31') AND j.job_type_id IN (1, 2, 4)
       GROUP BY 1""",
)
def _(d: Domain) -> DataFrame:
    return marts.jobs_by_zip(
        d.jobs(), location_zips(d), start="1998-01-01", end="1998-12-31", job_type_ids=(1, 2, 4)
    )


@query(
    "mrt_20_jobs_by_zip",
    """SELECT z.zip5 AS zip_code, COUNT(*) AS jobs_count, COUNT(DISTINCT j.id) AS jobs_distinct
       FROM jobs j JOIN location_zips z USING (location_id) GROUP BY 1""",
)
def _(d: Domain) -> DataFrame:
    return marts.jobs_by_zip(d.jobs(), location_zips(d))


@query(
    "mrt_20_jobs_by_zip_selected",
    """SELECT z.zip5 AS zip_code, COUNT(*) AS jobs_count, COUNT(DISTINCT j.id) AS jobs_distinct
       FROM jobs j JOIN location_zips z USING (location_id)
       WHERE j.id IN (SELECT job_id FROM rets) GROUP BY 1""",
)
def _(d: Domain) -> DataFrame:
    listed = d.returns().select(F.col("job_id").alias("id")).distinct()
    return marts.jobs_by_zip(d.jobs().join(listed, "id", "left_semi"), location_zips(d))


@query(
    "mrt_21_close_rate_daily",
    f"""SELECT COALESCE(a.d, b.d) AS kpi_date, COALESCE(a.u, b.u) AS business_unit,
               COALESCE(a.n, 0) AS estimates_made, COALESCE(b.n, 0) AS estimates_sold,
               {pct('b.n', 'a.n')} AS close_rate_percent
        FROM (SELECT j.business_unit AS u, {ldate('e.created_on')} AS d, COUNT(*) AS n
              FROM estimates e JOIN dim_jobs j ON e.job_id = j.id GROUP BY 1, 2) a
        FULL JOIN (SELECT j.business_unit AS u, {ldate('e.sold_on')} AS d, COUNT(*) AS n
              FROM estimates e JOIN dim_jobs j ON e.job_id = j.id
              WHERE e.status = 'Sold' GROUP BY 1, 2) b ON a.u = b.u AND a.d = b.d""",
)
def _(d: Domain) -> DataFrame:
    return marts.close_rate_daily(d.estimates(), d.dim_jobs())


@query(
    "mrt_22_estimates_scheduled",
    f"""SELECT j.business_unit, COUNT(DISTINCT e.id) AS estimates_scheduled,
               {dsum('COALESCE(e.total, e.subtotal)')} AS estimate_value
        FROM estimates e JOIN dim_jobs j ON e.job_id = j.id
        WHERE CAST(e.created_on AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1997-06-30'
          AND e.job_id IN (SELECT job_id FROM appts WHERE scheduled_start IS NOT NULL) GROUP BY 1""",
)
def _(d: Domain) -> DataFrame:
    return marts.estimates_scheduled(d.estimates(), d.appointments(), d.dim_jobs(), "1996-01-01", "1997-06-30")


@query(
    "mrt_23_dollars_collected_daily",
    f"""SELECT CAST(p.created_on AS DATE) AS kpi_date, j.business_unit,
               {dsum('p.amount')} AS dollars_collected, COUNT(DISTINCT p.id) AS payment_count
        FROM payments p JOIN invoices i ON p.invoice_id = i.id JOIN dim_jobs j ON i.job_id = j.id
        WHERE j.business_unit LIKE '%-Production' GROUP BY 1, 2""",
)
def _(d: Domain) -> DataFrame:
    return marts.dollars_collected_daily(
        marts.payments_with_unit(d.payments(), d.invoices(), d.dim_jobs())
    )


@query(
    "mrt_24_receivables_with_floor",
    f"""SELECT j.business_unit, {dsum('i.balance')} AS outstanding_ar
        FROM invoices i JOIN dim_jobs j ON i.job_id = j.id
        WHERE i.balance >= 10 AND j.business_unit LIKE '%-Production' GROUP BY 1""",
)
def _(d: Domain) -> DataFrame:
    return marts.receivables_with_floor(d.invoices(), d.dim_jobs())


def excluded_types(d: Domain) -> DataFrame:
    return literal_relation(d.spark, "job_type_name string", marts.EXCLUDED_TYPE_ROWS)


@query(
    "mrt_25_future_bookings_by_invoice",
    f"""SELECT j.business_unit, {dsum('i.total')} AS future_bookings
        FROM invoices i JOIN dim_jobs j ON i.job_id = j.id
        WHERE j.business_unit LIKE '%-Production'
          AND j.job_type_name NOT IN ('PM Inspection', 'Safety Inspection', 'Window/Solar Washing')
          AND CAST(i.invoice_date AS DATE) > DATE '{AS_OF}'
          AND CAST(i.invoice_date AS DATE) <= DATE '2001-01-01' GROUP BY 1""",
)
def _(d: Domain) -> DataFrame:
    return marts.future_bookings_by_invoice(d.invoices(), d.dim_jobs(), excluded_types(d), AS_OF)


# --- job costing -------------------------------------------------------------------


@query(
    "jct_01_job_dates",
    """SELECT job_id, MIN(scheduled_start) AS job_start_date, MAX(scheduled_end) AS job_end_date
       FROM appts GROUP BY 1""",
)
def _(d: Domain) -> DataFrame:
    return costing.job_dates(d.appointments())


_FALLBACK = """SELECT j.id AS job_id,
    COALESCE(MIN(a.scheduled_start), j.completed_on, j.created_on) - INTERVAL 7 HOUR AS job_start_date,
    MAX(a.scheduled_end) - INTERVAL 7 HOUR AS job_end_date
    FROM jobs j LEFT JOIN appts a ON a.job_id = j.id GROUP BY j.id, j.completed_on, j.created_on"""


@query("jct_02_job_dates_with_fallback", _FALLBACK)
def _(d: Domain) -> DataFrame:
    return costing.job_dates_with_fallback(d.jobs(), d.appointments())


def _as_double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


@query(
    "jct_03_invoice_rollup",
    f"""SELECT job_id, {dsum('subtotal')} AS invoice_subtotal, {dsum('total')} AS invoice_total,
               {dsum('sales_tax')} AS invoice_tax, COUNT(*) AS invoice_count
        FROM invoices WHERE job_id IS NOT NULL GROUP BY 1""",
)
def _(d: Domain) -> DataFrame:
    out = costing.invoice_rollup(d.invoices())
    return _as_double(out, "invoice_subtotal", "invoice_total", "invoice_tax")


_LINES = """SELECT DISTINCT job_id, employee_id, date, activity, amount, paid_duration_hours
    FROM payroll WHERE job_id IS NOT NULL"""


@query(
    "jct_04_labor_rollup",
    f"""SELECT job_id, {dsum('amount')} AS total_labor_cost,
               COUNT(DISTINCT employee_id) AS tech_count FROM lines GROUP BY 1""",
    lines=_LINES,
)
def _(d: Domain) -> DataFrame:
    return _as_double(costing.labor_rollup(d.payroll()), "total_labor_cost")


@query(
    "jct_04_labor_rollup_by_line",
    f"""SELECT job_id, {dsum('amount')} AS total_labor_cost, COUNT(*) AS tech_count
        FROM lines GROUP BY 1""",
    lines=_LINES,
)
def _(d: Domain) -> DataFrame:
    return _as_double(costing.labor_rollup(d.payroll(), count_lines=True), "total_labor_cost")


_ADJ = """SELECT i.job_id, SUM(a.amount) AS payroll_adj FROM adjustments a
    JOIN invoices i ON a.invoice_id = i.id WHERE i.job_id IS NOT NULL GROUP BY 1"""


@query("jct_05_adjustment_rollup", "SELECT job_id, CAST(payroll_adj AS DOUBLE) AS payroll_adj FROM adj", adj=_ADJ)
def _(d: Domain) -> DataFrame:
    return _as_double(
        costing.adjustment_rollup(d.payroll_adjustments(), d.invoices()), "payroll_adj"
    )


_PO = "SELECT job_id, SUM(total) AS c, COUNT(*) AS n FROM pos WHERE status <> 'Canceled' GROUP BY 1"
_ITEMS = """SELECT job_id, SUM(cost) AS c, COUNT(*) AS n FROM invoice_items
    WHERE job_id IS NOT NULL AND type IN ('Material', 'Equipment') GROUP BY 1"""


@query("jct_06_purchase_order_rollup", "SELECT job_id, CAST(c AS DOUBLE) AS po_cost, n AS po_count FROM po_sum", po_sum=_PO)
def _(d: Domain) -> DataFrame:
    return _as_double(costing.purchase_order_rollup(d.purchase_orders()), "po_cost")


@query(
    "jct_07_item_material_rollup",
    "SELECT job_id, CAST(c AS DOUBLE) AS invoice_material_cost, n AS material_item_count FROM item_sum",
    item_sum=_ITEMS,
)
def _(d: Domain) -> DataFrame:
    return _as_double(costing.item_material_rollup(d.invoices()), "invoice_material_cost")


_MATERIALS = """SELECT COALESCE(p.job_id, i.job_id) AS job_id,
    COALESCE(p.c, 0) + COALESCE(i.c, 0) AS material_cost, COALESCE(p.n, 0) AS po_count,
    COALESCE(i.n, 0) AS invoice_material_count
    FROM po_sum p FULL JOIN item_sum i ON p.job_id = i.job_id"""


@query(
    "jct_08_combined_materials",
    "SELECT * REPLACE (CAST(material_cost AS DOUBLE) AS material_cost) FROM materials",
    materials=_MATERIALS,
    po_sum=_PO,
    item_sum=_ITEMS,
)
def _(d: Domain) -> DataFrame:
    return _as_double(
        costing.combine_materials(
            costing.purchase_order_rollup(d.purchase_orders()),
            costing.item_material_rollup(d.invoices()),
        ),
        "material_cost",
    )


@query(
    "jct_09_return_rollup",
    f"SELECT job_id, {dsum('total')} AS return_credit FROM rets GROUP BY 1",
)
def _(d: Domain) -> DataFrame:
    return _as_double(costing.return_rollup(d.returns()), "return_credit")


_COST_OUT = """job_id, job_number, job_type, job_status, business_unit_id, business_unit,
    job_start_date, job_end_date, completed_date, created_date,
    CAST(revenue_subtotal AS DOUBLE) AS revenue_subtotal, CAST(revenue_total AS DOUBLE) AS revenue_total,
    CAST(labor_cost AS DOUBLE) AS labor_cost, CAST(material_cost_net AS DOUBLE) AS material_cost_net,
    CAST(total_cost AS DOUBLE) AS total_cost, CAST(gross_profit AS DOUBLE) AS gross_profit,
    CAST(gross_profit AS DOUBLE) / NULLIF(CAST(revenue_subtotal AS DOUBLE), 0) * 100 AS gpm_percent,
    CAST(labor_gross_pay AS DOUBLE) AS labor_gross_pay,
    CAST(material_cost_raw AS DOUBLE) AS material_cost_raw, CAST(return_credit AS DOUBLE) AS return_credit,
    invoice_count, tech_count, po_count, is_warranty"""
_COST_COLUMNS = (
    "job_id job_number job_type job_status business_unit_id business_unit job_start_date job_end_date"
    " completed_date created_date revenue_subtotal revenue_total labor_cost material_cost_net total_cost"
    " gross_profit gpm_percent labor_gross_pay material_cost_raw return_credit invoice_count tech_count"
    " po_count is_warranty"
).split()


@query("jct_10_job_costing", f"SELECT {_COST_OUT} FROM job_costing")
def _(d: Domain) -> DataFrame:
    return costing.in_dollars(job_costing(d)).select(*_COST_COLUMNS)


def _costing_sql(dates: str, adjustments: bool, warranty: str) -> dict[str, str]:
    adj = "COALESCE(x.payroll_adj, 0)" if adjustments else "0"
    return {
        "dates": dates,
        "adj": _ADJ,
        "po_sum": _PO,
        "item_sum": _ITEMS,
        "materials": _MATERIALS,
        "lines": _LINES,
        "inv": """SELECT job_id, SUM(subtotal) AS s, SUM(total) AS t, COUNT(*) AS n
                  FROM invoices GROUP BY 1""",
        "lab": "SELECT job_id, SUM(amount) AS pay, COUNT(*) AS n FROM lines GROUP BY 1",
        "ret": "SELECT job_id, SUM(total) AS c FROM rets GROUP BY 1",
        "costed": f"""
            SELECT *, labor_cost + material_cost_net AS total_cost,
                   revenue_subtotal - labor_cost - material_cost_net AS gross_profit FROM (
            SELECT j.id AS job_id, j.job_number, j.job_type_name AS job_type, j.job_status,
                   j.business_unit_id, j.business_unit, d.job_start_date, d.job_end_date,
                   j.completed_on AS completed_date, j.created_on AS created_date,
                   COALESCE(inv.s, 0) AS revenue_subtotal, COALESCE(inv.t, 0) AS revenue_total,
                   COALESCE(lab.pay, 0) + {adj} AS labor_cost,
                   COALESCE(mt.material_cost, 0) - COALESCE(ret.c, 0) AS material_cost_net,
                   COALESCE(lab.pay, 0) AS labor_gross_pay, {adj} AS payroll_adjustments,
                   COALESCE(mt.material_cost, 0) AS material_cost_raw,
                   COALESCE(ret.c, 0) AS return_credit, COALESCE(inv.n, 0) AS invoice_count,
                   COALESCE(lab.n, 0) AS tech_count, COALESCE(mt.po_count, 0) AS po_count,
                   COALESCE(mt.invoice_material_count, 0) AS invoice_material_count,
                   {warranty} AS is_warranty
            FROM dim_jobs j JOIN dates d ON d.job_id = j.id
            LEFT JOIN inv ON inv.job_id = j.id LEFT JOIN lab ON lab.job_id = j.id
            LEFT JOIN materials mt ON mt.job_id = j.id LEFT JOIN ret ON ret.job_id = j.id
            LEFT JOIN adj x ON x.job_id = j.id WHERE d.job_start_date IS NOT NULL)""",
    }


_LOCAL_DATES = """SELECT job_id, MIN(scheduled_start) - INTERVAL 7 HOUR AS job_start_date,
    MAX(scheduled_end) - INTERVAL 7 HOUR AS job_end_date FROM appts GROUP BY 1"""
_WARRANTY = "COALESCE(j.job_type_name IN ('Warranty', 'Touchup'), FALSE)"
_COST_OUT_ALL = (
    _COST_OUT
    + ", CAST(payroll_adjustments AS DOUBLE) AS payroll_adjustments, invoice_material_count"
)

_V2 = _costing_sql(_LOCAL_DATES, True, _WARRANTY)
_V3 = _costing_sql(_LOCAL_DATES, False, _WARRANTY)
_V4 = _costing_sql(_FALLBACK, False, "FALSE")


@query("jct_11_job_costing_adjusted", f"SELECT {_COST_OUT_ALL} FROM costed", **_V2)
def _(d: Domain) -> DataFrame:
    return costing.in_dollars(
        job_costing(
            d,
            date_rule="appointment_local",
            include_invoice_materials=True,
            include_adjustments=True,
            count_lines=True,
        )
    )


@query("jct_11_job_costing_unadjusted", f"SELECT {_COST_OUT_ALL} FROM costed", **_V3)
def _(d: Domain) -> DataFrame:
    return costing.in_dollars(
        job_costing(
            d, date_rule="appointment_local", include_invoice_materials=True, count_lines=True
        )
    )


def final_costing(d: Domain) -> DataFrame:
    return job_costing(
        d,
        date_rule="fallback_local",
        include_invoice_materials=True,
        count_lines=True,
        warranty_types=(),
    )


@query("jct_12_job_costing_fallback_dates", f"SELECT {_COST_OUT_ALL} FROM costed", **_V4)
def _(d: Domain) -> DataFrame:
    return costing.in_dollars(final_costing(d))


@query(
    "jct_13_margin_listing",
    f"""SELECT business_unit, job_id, CAST(job_start_date AS DATE) AS job_date,
               CAST(ROUND(revenue_subtotal, 2) AS DOUBLE) AS revenue,
               CAST(ROUND(labor_cost, 2) AS DOUBLE) AS labor,
               CAST(ROUND(material_cost_net, 2) AS DOUBLE) AS materials,
               CAST(ROUND(gross_profit, 2) AS DOUBLE) AS gross_profit,
               {pct('gross_profit', 'revenue_subtotal')} AS gpm_percent
        FROM costed WHERE CAST(job_start_date AS DATE) BETWEEN DATE '{WEEK[0]}' AND DATE '{WEEK[1]}'""",
    **_V4,
)
def _(d: Domain) -> DataFrame:
    return costing.margin_listing(final_costing(d), *WEEK)


def _top_sql(measure: str) -> str:
    return f"""SELECT job_id, business_unit, job_status, CAST({measure} AS DOUBLE) AS {measure}
        FROM costed WHERE {measure} > 0 ORDER BY {measure} DESC, job_id LIMIT 20"""


@query("jct_14_top_jobs_by_labor", _top_sql("labor_cost"), **_V4)
def _(d: Domain) -> DataFrame:
    return costing.top_jobs(final_costing(d), "labor_cost")


@query("jct_14_top_jobs_by_material", _top_sql("material_cost_net"), **_V4)
def _(d: Domain) -> DataFrame:
    return costing.top_jobs(final_costing(d), "material_cost_net")


@query(
    "jct_14_top_payroll_rows",
    """SELECT p.job_id, p.employee_id, p.date, p.source_entity_id, CAST(p.amount AS DOUBLE) AS amount,
              c.business_unit, CAST(c.labor_cost AS DOUBLE) AS labor_cost,
              CAST(c.material_cost_net AS DOUBLE) AS material_cost_net
       FROM (SELECT * FROM payroll WHERE job_id IS NOT NULL
             ORDER BY amount DESC, source_entity_id, date, employee_id LIMIT 20) p
       LEFT JOIN job_costing c USING (job_id)""",
)
def _(d: Domain) -> DataFrame:
    rows = d.payroll().select("job_id", "employee_id", "date", "source_entity_id", "amount")
    out = costing.top_cost_rows(
        rows, job_costing(d), tie=("source_entity_id", "date", "employee_id")
    )
    return _as_double(out, "amount", "labor_cost", "material_cost_net")


FACT = _V2 | {"dates": _FALLBACK}
FINAL = _V4


@query(
    "jct_15_job_cost_fact",
    """SELECT job_id, business_unit, CAST(revenue_subtotal AS DOUBLE) AS revenue,
              CAST(total_cost AS DOUBLE) AS total_job_cost,
              CAST(gross_profit AS DOUBLE) AS gross_profit FROM costed""",
    **FACT,
)
def _(d: Domain) -> DataFrame:
    return job_cost_fact(d).select(
        "job_id",
        "business_unit",
        F.col("revenue_subtotal").cast("double").alias("revenue"),
        F.col("total_cost").cast("double").alias("total_job_cost"),
        F.col("gross_profit").cast("double").alias("gross_profit"),
    )


def job_cost_fact(d: Domain) -> DataFrame:
    """Per-job cost from the raw tables, for every job."""
    return job_costing(
        d,
        date_rule="fallback_local",
        include_invoice_materials=True,
        include_adjustments=True,
        count_lines=True,
    )
