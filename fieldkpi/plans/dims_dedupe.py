"""Dedupe policies and dimension joins over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkpi.functions.parse import zip5_with_point
from fieldkpi.operators import dedupe, dims
from fieldkpi.plans.catalog import query
from fieldkpi.plans.domain import Domain
from fieldkpi.plans.stage_marts import opportunities


def _first(table: str, keys: str, order: str, columns: str) -> str:
    """First row per key, ties by the table's columns in their order."""
    return f"""SELECT {columns} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn
        FROM {table}) WHERE rn = 1"""


def _exact(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c, t in df.dtypes if t.startswith("decimal")})


_LEADS = "bu_key, job_created_on, job_type, job_id, updated_on"


@query(
    "ded_01_leads",
    _first("report_leads", "job_id, bu_key", f"job_created_on DESC, updated_on DESC, {_LEADS}", _LEADS),
)
def _(d: Domain) -> DataFrame:
    return dedupe.leads(d.report_leads())


_COLL = "business_unit, payment_date, amount, job_id, updated_on, raw"
_COLL_OUT = "business_unit, payment_date, CAST(amount AS DOUBLE) AS amount, job_id, updated_on, raw"


@query(
    "ded_02_collections",
    _first(
        "(SELECT * REPLACE (CAST(payment_date AS DATE) AS payment_date) FROM collections)",
        "job_id, payment_date",
        "updated_on DESC, business_unit NULLS LAST, payment_date, amount NULLS LAST, raw",
        _COLL_OUT,
    ),
)
def _(d: Domain) -> DataFrame:
    daily = d.collections().withColumn("payment_date", F.to_date("payment_date"))
    return _exact(dedupe.collections(daily))


@query(
    "ded_03_receivables",
    _first(
        "report_receivables",
        "raw",
        "updated_on DESC, bu_key, as_of, location_name, net_amount",
        "bu_key, as_of, location_name, CAST(net_amount AS DOUBLE) AS net_amount, updated_on, raw",
    ),
)
def _(d: Domain) -> DataFrame:
    return _exact(dedupe.receivables(d.report_receivables()))


_COST = "bu_key, job_id, job_start, job_subtotal, job_total_costs, updated_on"
_COST_OUT = """bu_key, job_id, job_start, CAST(job_subtotal AS DOUBLE) AS job_subtotal,
    CAST(job_total_costs AS DOUBLE) AS job_total_costs, updated_on"""


@query("ded_04_job_cost", _first("report_job_cost", "job_id, bu_key", f"updated_on DESC, {_COST}", _COST_OUT))
def _(d: Domain) -> DataFrame:
    return _exact(dedupe.job_cost(d.report_job_cost()))


@query(
    "ded_04_job_cost_by_start",
    _first("report_job_cost", "job_id, bu_key", f"job_start DESC, updated_on DESC, {_COST}", _COST_OUT),
)
def _(d: Domain) -> DataFrame:
    return _exact(dedupe.job_cost(d.report_job_cost(), by_start=True))


_BOOK = "bu_key, job_id, scheduled_date, job_subtotal, as_of_date"
_BOOK_OUT = "bu_key, job_id, scheduled_date, CAST(job_subtotal AS DOUBLE) AS job_subtotal, as_of_date"


@query(
    "ded_05_future_bookings",
    _first("report_future_bookings", "job_id, scheduled_date", f"as_of_date DESC, {_BOOK}", _BOOK_OUT),
)
def _(d: Domain) -> DataFrame:
    return _exact(dedupe.future_bookings(d.report_future_bookings()))


@query(
    "ded_05_future_bookings_per_job",
    _first(
        "report_future_bookings", "job_id, bu_key", f"scheduled_date DESC, as_of_date DESC, {_BOOK}", _BOOK_OUT
    ),
)
def _(d: Domain) -> DataFrame:
    return _exact(dedupe.future_bookings(d.report_future_bookings(), per_job=True))


_SALES = "event_date, bu_name, estimator, sales_opportunities, closed_opportunities, total_sales, avg_closed_sale"


@query(
    "ded_06_sales",
    _first(
        "report_sales",
        "event_date, bu_name, estimator",
        f"total_sales DESC, avg_closed_sale DESC, {_SALES}",
        """event_date, bu_name, estimator, sales_opportunities, closed_opportunities,
           CAST(total_sales AS DOUBLE) AS total_sales, CAST(avg_closed_sale AS DOUBLE) AS avg_closed_sale""",
    ),
)
def _(d: Domain) -> DataFrame:
    return _exact(dedupe.sales(d.report_sales()))


@query(
    "ded_07_by_id",
    _first(
        "estimates",
        "id",
        "modified_on DESC, job_id NULLS LAST, status, created_on, sold_on NULLS LAST, sold_by_id, subtotal",
        "id, job_id, status, modified_on, CAST(subtotal AS DOUBLE) AS subtotal",
    ),
)
def _(d: Domain) -> DataFrame:
    out = dedupe.by_id(d.estimates(), ingested="modified_on")
    return _exact(out.select("id", "job_id", "status", "modified_on", "subtotal"))


@query(
    "ded_08_payroll_lines",
    """SELECT DISTINCT job_id, employee_id, date, activity, CAST(amount AS DOUBLE) AS amount,
              CAST(paid_duration_hours AS DOUBLE) AS paid_duration_hours FROM payroll""",
)
def _(d: Domain) -> DataFrame:
    return _exact(dedupe.payroll_lines(d.payroll()))


# --- dimensions -----------------------------------------------------------------------

_DIM = """id, job_number, customer_id, location_id, business_unit_id, job_status, job_type_id, campaign_id,
    created_on, completed_on, modified_on, bu_name, business_unit, job_type_name"""


@query("dim_01_dim_jobs", f"SELECT {_DIM} FROM dim_jobs")
def _(d: Domain) -> DataFrame:
    return d.dim_jobs()


@query(
    "dim_02_dim_jobs_with_campaign",
    f"""SELECT {_DIM}, c.name AS campaign_name FROM (SELECT * FROM dim_jobs) j
        LEFT JOIN (SELECT id AS c_id, name FROM campaigns) c ON j.campaign_id = c.c_id""",
)
def _(d: Domain) -> DataFrame:
    return dims.dim_jobs(d.jobs(), d.units(), d.job_types(), d.campaigns())


@query(
    "dim_03_region_map",
    """SELECT substr(region, 1, 3) AS region_key, region AS region_label, name AS bu_key,
              CASE WHEN name LIKE '%-Sales' THEN 'sales' ELSE 'production' END AS bu_type FROM units""",
)
def _(d: Domain) -> DataFrame:
    """Unit names gathered into two arrays per region, as a configuration has them.

    The arrays hold the units of a region, so they are as small as the unit list.
    """
    sales = F.col("name").like("%-Sales")
    configured = d.units().groupBy("region").agg(
        F.sort_array(F.collect_list(F.when(sales, F.col("name")))).alias("sales"),
        F.sort_array(F.collect_list(F.when(~sales, F.col("name")))).alias("production"),
    )
    return dims.region_map_from(
        configured.select(
            F.substring("region", 1, 3).alias("region_key"),
            F.col("region").alias("region_label"),
            "sales",
            "production",
        )
    )


@query(
    "dim_04_unit_rollup",
    """SELECT u.id AS business_unit_id, c.bu_name, c.bu_group, c.bu_rollup, u.id IS NOT NULL AS discovered
       FROM (SELECT name AS bu_name, 'SALES' AS bu_group, substr(region, 1, 3) AS bu_rollup FROM units
                 WHERE name LIKE '%-Sales'
             UNION ALL SELECT 'Old ' || r_name, 'SALES', substr(r_name, 1, 3) FROM region) c
       LEFT JOIN units u ON u.name = c.bu_name""",
)
def _(d: Domain) -> DataFrame:
    """Names with blanks around them, and one outdated name per region."""
    named = d.units().where("name LIKE '%-Sales'").select(
        F.concat(F.lit("  "), "name", F.lit(" ")).alias("bu_name"),
        F.lit("SALES").alias("bu_group"),
        F.substring("region", 1, 3).alias("bu_rollup"),
    )
    legacy = d.table("region").select(
        F.concat(F.lit("Old "), "r_name").alias("bu_name"),
        F.lit("SALES").alias("bu_group"),
        F.substring("r_name", 1, 3).alias("bu_rollup"),
    )
    return dims.unit_rollup(named.unionByName(legacy), d.units())


@query(
    "dim_05_enriched_jobs",
    """SELECT j.id, j.job_number, j.job_status, j.created_on, j.completed_on, u.name AS unit_name,
              t.name AS technician_name, c.name AS customer_name, z.location_id IS NOT NULL AS has_zip
       FROM jobs j LEFT JOIN units u ON j.business_unit_id = u.id LEFT JOIN technicians t ON j.customer_id = t.id
       LEFT JOIN customers c ON j.customer_id = c.id LEFT JOIN location_zips z ON j.location_id = z.location_id""",
)
def _(d: Domain) -> DataFrame:
    jobs = d.jobs().withColumn("technician_id", F.col("customer_id"))
    out = dims.enriched_jobs(jobs, d.units(), d.technicians(), d.customers(), d.locations())
    has_zip = F.coalesce(F.col("location_address").rlike(r"\d{5}"), F.lit(False))
    return out.withColumn("has_zip", has_zip).drop("location_address")


@query(
    "dim_06_selected_jobs",
    """SELECT j.id AS job_id, j.job_number, j.job_status, j.completed_on, z.zip5 AS zip_code,
              c.name AS customer_name, t.name AS job_type
       FROM jobs j LEFT JOIN location_zips z ON j.location_id = z.location_id
       LEFT JOIN customers c ON j.customer_id = c.id LEFT JOIN job_types t ON j.job_type_id = t.id
       WHERE j.id IN (SELECT job_id FROM rets)""",
)
def _(d: Domain) -> DataFrame:
    return dims.selected_jobs(
        d.returns().select("job_id"), d.jobs(), zip5_with_point(d.locations()), d.customers(), d.job_types()
    )


@query(
    "dim_07_estimates_with_opportunity",
    """SELECT e.id AS estimate_id, e.job_id, e.status AS estimate_status, e.created_on AS estimate_created_on,
              e.sold_on AS estimate_sold_on, e.sold_by_id, CAST(e.subtotal AS DOUBLE) AS subtotal,
              CAST(e.total_tax AS DOUBLE) AS total_tax, CAST(e.total AS DOUBLE) AS total, o.customer_id,
              o.business_unit, o.job_status, o.opportunity_date, o.is_sales_opportunity, o.is_closed_opportunity,
              o.estimate_count AS job_estimate_count, o.sold_estimate_count AS job_sold_estimate_count,
              COALESCE(e.status = 'Sold' AND e.sold_on = o.earliest_sold_on, FALSE) AS is_winning_estimate
       FROM estimates e JOIN opportunity_jobs o ON e.job_id = o.job_id""",
)
def _(d: Domain) -> DataFrame:
    return dims.estimates_with_opportunity(d.estimates(), opportunities(d))
