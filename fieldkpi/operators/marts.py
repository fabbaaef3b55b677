"""Daily marts (day by unit unless said otherwise) and unit snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldkpi.functions.constants import (
    BUSINESS_TZ,
    CANCELED_APPOINTMENT_STATUSES,
    NON_PRODUCTION_JOB_TYPES,
    PRODUCTION_SUFFIX,
    RECEIVABLE_FLOOR,
    SALES_SUFFIX,
)
from fieldkpi.functions.expr import (
    count_if,
    day_range,
    dollars,
    ends_with,
    local_date,
    money,
    percent,
    ratio,
    rounded,
    sum_if,
    sum_money,
    utc_midnight,
)
from fieldkpi.functions.joins import hot_keys, spread_join


def _daily(df: DataFrame, day: str, *aggs: Column, unit: str | None = "business_unit") -> DataFrame:
    rows = df.where(F.col(day).isNotNull())
    keys = [F.col(day).alias("kpi_date")]
    if unit is not None:
        rows = rows.where(F.col(unit).isNotNull())
        keys.append(F.col(unit).alias("business_unit"))
    return rows.groupBy(*keys).agg(*aggs)


def _avg(c: str | Column) -> Column:
    """Mean of a money column from its exact sum."""
    m = money(c)
    return ratio(F.sum(m), F.count(m))


def leads_daily(leads: DataFrame) -> DataFrame:
    return _daily(
        leads,
        "lead_date",
        F.count("job_id").alias("leads_count"),
        F.countDistinct("customer_id").alias("unique_customers"),
        F.countDistinct("business_unit").alias("business_units_with_leads"),
        unit=None,
    )


def leads_daily_unit(leads: DataFrame) -> DataFrame:
    return _daily(
        leads,
        "lead_date",
        F.count("job_id").alias("leads_count"),
        F.countDistinct("customer_id").alias("unique_customers"),
    )


def completed_estimates_daily(completed: DataFrame) -> DataFrame:
    return _daily(
        completed,
        "completed_date",
        F.count("job_id").alias("completed_estimates_count"),
        F.countDistinct("customer_id").alias("unique_customers"),
    )


def opportunity_daily(opportunities: DataFrame) -> DataFrame:
    offered = count_if(F.col("is_sales_opportunity"))
    closed = count_if(F.col("is_closed_opportunity"))
    return _daily(
        opportunities,
        "opportunity_date",
        offered.alias("sales_opportunities"),
        closed.alias("closed_opportunities"),
        percent(closed, offered).alias("close_rate_percent"),
        F.countDistinct("customer_id").alias("unique_customers"),
        F.sum("estimate_count").alias("total_estimates"),
        F.sum("sold_estimate_count").alias("total_sold_estimates"),
    )


def total_booked_daily(sold: DataFrame) -> DataFrame:
    return _daily(
        sold,
        "sold_date",
        sum_money("revenue_amount").cast("double").alias("total_booked"),
        F.count("estimate_id").alias("sold_estimate_count"),
        F.countDistinct("job_id").alias("unique_jobs_sold"),
        F.countDistinct("customer_id").alias("unique_customers"),
        _avg("revenue_amount").alias("avg_sale_amount"),
    )


def sold_in_sales_units(
    estimates: DataFrame,
    dim_jobs: DataFrame,
    *,
    unit_suffix: str = SALES_SUFFIX,
    tz: str = BUSINESS_TZ,
) -> DataFrame:
    jobs = dim_jobs.where(ends_with("business_unit", unit_suffix)).select(
        F.col("id").alias("job_id"), "business_unit"
    )
    return (
        estimates.where(
            F.col("sold_on").isNotNull() & (F.col("status") == "Sold") & F.col("job_id").isNotNull()
        )
        .join(jobs, "job_id")
        .select(
            "id", "job_id", "business_unit", "subtotal", local_date("sold_on", tz).alias("sold_date")
        )
    )


def total_sales_daily(sold: DataFrame) -> DataFrame:
    return _daily(
        sold,
        "sold_date",
        dollars(sum_money("subtotal")).alias("total_sales"),
        F.countDistinct("id").alias("sold_estimate_count"),
        F.countDistinct("job_id").alias("job_count"),
        F.countDistinct("business_unit").alias("business_units_with_sales"),
        rounded(_avg("subtotal")).alias("avg_sale_amount"),
        dollars(F.min(money("subtotal"))).alias("min_sale_amount"),
        dollars(F.max(money("subtotal"))).alias("max_sale_amount"),
        unit=None,
    )


def total_sales_daily_unit(sold: DataFrame) -> DataFrame:
    return _daily(
        sold,
        "sold_date",
        dollars(sum_money("subtotal")).alias("total_sales"),
        F.countDistinct("id").alias("sold_estimate_count"),
        F.countDistinct("job_id").alias("job_count"),
        rounded(_avg("subtotal")).alias("avg_sale_amount"),
    )


def dollars_produced_daily(production: DataFrame) -> DataFrame:
    revenue, profit = sum_money("revenue_subtotal"), sum_money("gross_profit")
    labor = sum_money("labor_cost")
    return _daily(
        production.withColumn("start_date", F.to_date("start_date")),
        "start_date",
        revenue.cast("double").alias("dollars_produced"),
        profit.cast("double").alias("total_gross_profit"),
        sum_money("total_cost").cast("double").alias("total_cost"),
        labor.cast("double").alias("total_labor_cost"),
        sum_money("material_cost_net").cast("double").alias("total_material_cost"),
        F.count("job_id").alias("total_job_count"),
        count_if(F.col("is_warranty")).alias("warranty_job_count"),
        count_if(F.col("job_status") == "Completed").alias("completed_job_count"),
        count_if(F.col("job_status") == "Hold").alias("hold_job_count"),
        (ratio(profit, revenue) * 100.0).alias("gpm_percent"),
        ratio(revenue, labor).alias("labor_efficiency"),
    )


def margin_daily(production: DataFrame) -> DataFrame:
    revenue, profit = sum_money("revenue_subtotal"), sum_money("gross_profit")
    labor, material = sum_money("labor_cost"), sum_money("material_cost_net")
    return _daily(
        production.withColumn("start_date", F.to_date("start_date")),
        "start_date",
        dollars(revenue).alias("total_revenue"),
        dollars(labor).alias("total_labor_cost"),
        dollars(material).alias("total_material_cost"),
        dollars(sum_money("total_cost")).alias("total_cost"),
        dollars(profit).alias("gross_profit"),
        percent(profit, revenue).alias("gpm_percent"),
        F.countDistinct("job_id").alias("job_count"),
        percent(labor, revenue).alias("labor_percent_of_revenue"),
        percent(material, revenue).alias("material_percent_of_revenue"),
    )


def warranty_daily(production: DataFrame) -> DataFrame:
    warranty = F.col("is_warranty")
    warranty_cost, revenue = sum_if(warranty, "total_cost"), sum_money("revenue_subtotal")
    return _daily(
        production.withColumn("start_date", F.to_date("start_date")),
        "start_date",
        dollars(warranty_cost).alias("warranty_cost"),
        dollars(sum_if(~warranty, "total_cost")).alias("non_warranty_cost"),
        dollars(sum_money("total_cost")).alias("total_cost"),
        dollars(revenue).alias("dollars_produced"),
        percent(warranty_cost, revenue).alias("warranty_percent"),
        F.count("*").alias("total_jobs"),
        count_if(warranty).alias("warranty_jobs"),
        count_if(~warranty).alias("non_warranty_jobs"),
    )


def collections_daily(collections: DataFrame) -> DataFrame:
    return (
        collections.where(F.col("amount").isNotNull())
        .withColumn("payment_day", F.to_date("payment_date"))
        .transform(
            lambda df: _daily(
                df,
                "payment_day",
                F.count("*").alias("payment_count"),
                dollars(sum_money("amount")).alias("total_collections"),
                rounded(_avg("amount")).alias("avg_payment_amount"),
                dollars(F.min(money("amount"))).alias("min_payment"),
                dollars(F.max(money("amount"))).alias("max_payment"),
                F.max("updated_on").alias("last_updated"),
            )
        )
    )


def invoices_with_unit(invoices: DataFrame, jobs: DataFrame, units: DataFrame) -> DataFrame:
    """Invoices of known units; the unit is the one of the invoice's job."""
    owner = jobs.join(
        units.select(F.col("id").alias("business_unit_id"), F.col("name").alias("unit_name")),
        "business_unit_id",
    ).select(F.col("id").alias("job_id"), "unit_name")
    return invoices.join(owner, "job_id").where(F.col("unit_name").isNotNull())


def outstanding_daily(unit_invoices: DataFrame) -> DataFrame:
    paid, total = F.sum(money("total") - money("balance")), sum_money("total")
    return (
        unit_invoices.withColumn("invoice_day", F.to_date("invoice_date"))
        .transform(
            lambda df: _daily(
                df,
                "invoice_day",
                F.count("id").alias("total_invoices"),
                count_if(F.col("balance") > 0).alias("unpaid_invoices"),
                count_if(F.col("balance") == 0).alias("paid_invoices"),
                dollars(sum_money("balance")).alias("outstanding_ar"),
                dollars(total).alias("total_invoiced"),
                dollars(paid).alias("total_paid"),
                percent(paid, total).alias("collection_rate_percent"),
                unit="unit_name",
            )
        )
    )


def receivables_by_unit(unit_invoices: DataFrame, as_of: date | str) -> DataFrame:
    """Open balances per unit, aged by invoice day against ``as_of``."""
    unpaid = F.col("balance") > 0
    age = F.datediff(F.lit(str(as_of)).cast("date"), F.to_date("invoice_date"))
    buckets = {
        "0_30_days": unpaid & (age <= 30),
        "31_60_days": unpaid & age.between(31, 60),
        "over_60_days": unpaid & (age > 60),
    }
    return unit_invoices.groupBy(F.col("unit_name").alias("business_unit")).agg(
        dollars(sum_money("balance")).alias("current_outstanding_ar"),
        count_if(unpaid).alias("unpaid_invoice_count"),
        dollars(sum_if(unpaid, "total")).alias("total_invoice_amount"),
        dollars(sum_if(unpaid, money("total") - money("balance"))).alias("partial_payments_received"),
        *[count_if(test).alias(f"ar_{name}_count") for name, test in buckets.items()],
        *[dollars(sum_if(test, "balance")).alias(f"ar_{name}") for name, test in buckets.items()],
    )


def future_bookings_daily(
    appointments: DataFrame,
    jobs: DataFrame,
    invoices: DataFrame,
    units: DataFrame,
    as_of: date | str,
    *,
    unit_suffix: str = PRODUCTION_SUFFIX,
) -> DataFrame:
    """Booked value by appointment day, for appointments after ``as_of``.

    Each (job, start) counts the job's invoice total once per appointment at that
    start; the total is computed once per job.
    """
    after = utc_midnight(next_day(as_of))
    open_appointments = appointments.where(
        (F.col("scheduled_start") >= after)
        & F.col("job_id").isNotNull()
        & ~F.col("status").isin(*CANCELED_APPOINTMENT_STATUSES)
    )
    starts = open_appointments.groupBy("job_id", "scheduled_start").agg(
        F.count("*").alias("appointments")
    )
    production = units.where(ends_with("name", unit_suffix)).select(
        F.col("id").alias("business_unit_id"), F.col("name").alias("business_unit")
    )
    owner = jobs.join(production, "business_unit_id").select(
        F.col("id").alias("job_id"), "business_unit"
    )
    value = (
        invoices.where(F.col("job_id").isNotNull())
        .groupBy("job_id")
        .agg(sum_money("total").alias("invoice_total"))
    )
    valued = owner.join(value, "job_id", "left")
    booked = (
        spread_join(
            starts,
            valued,
            "job_id",
            salt_by=["scheduled_start"],
            hot=hot_keys(open_appointments, "job_id"),
        )
        .withColumn(
            "booking_value",
            F.coalesce(F.col("invoice_total") * F.col("appointments").cast("decimal(10,0)"), F.lit(0))
            .cast("decimal(28,4)"),
        )
    )
    total = F.sum("booking_value")
    return booked.groupBy(
        F.to_date("scheduled_start").alias("scheduled_date"), "business_unit"
    ).agg(
        F.countDistinct("job_id").alias("job_count"),
        dollars(total).alias("total_future_bookings"),
        rounded(ratio(total, F.count("*"))).alias("avg_booking_value"),
    )


def next_day(day: date | str) -> date:
    return (day if isinstance(day, date) else date.fromisoformat(day)) + timedelta(days=1)


# --- report-fed facts -----------------------------------------------------------


def _dated(rows: DataFrame, day: str, unit: str) -> DataFrame:
    """Rows without a day or a unit are in no fact."""
    return rows.where(F.col(day).isNotNull() & F.col(unit).isNotNull())


def report_leads_daily(leads: DataFrame) -> DataFrame:
    rows = _dated(leads, "job_created_on", "bu_key")
    return rows.groupBy(F.to_date("job_created_on").alias("kpi_date"), "bu_key").agg(
        F.count("*").alias("leads")
    )


def report_collections_daily(collections: DataFrame) -> DataFrame:
    rows = _dated(collections, "payment_date", "business_unit")
    return rows.groupBy(F.to_date("payment_date").alias("kpi_date"), "business_unit").agg(
        dollars(sum_money("amount")).alias("amount")
    )


def report_sales_daily(sales: DataFrame) -> DataFrame:
    """From one row per seller and day; the rates are ratios of sums."""
    offered, closed = F.sum("sales_opportunities"), F.sum("closed_opportunities")
    total = sum_money("total_sales")
    return _dated(sales, "event_date", "bu_name").groupBy(F.col("event_date").alias("kpi_date"), "bu_name").agg(
        offered.alias("sales_opportunities"),
        closed.alias("closed_opportunities"),
        rounded(ratio(closed, offered), 4).alias("close_rate"),
        dollars(total).alias("total_sales"),
        rounded(ratio(total, closed)).alias("avg_closed_sale"),
    )


def report_sales_passthrough(consolidated: DataFrame) -> DataFrame:
    """For rows that the report has already consolidated per unit and day."""
    return consolidated.select(
        F.col("event_date").alias("kpi_date"),
        "bu_name",
        F.coalesce("sales_opportunities", F.lit(0)).alias("sales_opportunities"),
        F.coalesce("closed_opportunities", F.lit(0)).alias("closed_opportunities"),
        F.coalesce(money("total_sales"), F.lit(0)).cast("double").alias("total_sales"),
        F.coalesce(money("avg_closed_sale"), F.lit(0)).cast("double").alias("avg_closed_sale"),
    )


def report_job_cost_daily(job_cost: DataFrame) -> DataFrame:
    """The margin is a percentage of the day's totals."""
    revenue, cost = sum_money("job_subtotal"), sum_money("job_total_costs")
    rows = _dated(job_cost, "job_start", "bu_key")
    return rows.groupBy(F.to_date("job_start").alias("kpi_date"), "bu_key").agg(
        F.count("*").alias("jobs"),
        dollars(revenue).alias("job_subtotal"),
        dollars(cost).alias("job_total_costs"),
        percent(revenue - cost, revenue).alias("gm_pct"),
    )


# --- ZIP, estimates, payments, receivables ------------------------------------------


def jobs_by_zip(
    jobs: DataFrame,
    location_zips: DataFrame,
    *,
    start: date | str | None = None,
    end: date | str | None = None,
    job_type_ids: Sequence[int] = (),
) -> DataFrame:
    """Jobs per ZIP.  With a window, jobs without completion stay in; no type list means all."""
    rows = jobs
    if start is not None and end is not None:
        done = F.col("completed_on")
        rows = rows.where(
            done.isNull() | ((done >= utc_midnight(start)) & (done < utc_midnight(next_day(end))))
        )
    if job_type_ids:
        rows = rows.where(F.col("job_type_id").isin(*job_type_ids))
    return (
        rows.join(location_zips.select("location_id", "zip5"), "location_id")
        .groupBy(F.col("zip5").alias("zip_code"))
        .agg(F.count("*").alias("jobs_count"), F.countDistinct("id").alias("jobs_distinct"))
    )


def close_rate_daily(
    estimates: DataFrame, dim_jobs: DataFrame, *, tz: str = BUSINESS_TZ
) -> DataFrame:
    """Estimates made and sold per unit and day, each on its own date, outer-joined."""
    unit = dim_jobs.select(F.col("id").alias("job_id"), "business_unit")
    rows = estimates.join(unit, "job_id")
    made = rows.groupBy("business_unit", local_date("created_on", tz).alias("kpi_date")).agg(
        F.count("*").alias("estimates_made")
    )
    sold = (
        rows.where((F.col("status") == "Sold") & F.col("sold_on").isNotNull())
        .groupBy("business_unit", local_date("sold_on", tz).alias("kpi_date"))
        .agg(F.count("*").alias("estimates_sold"))
    )
    zero = F.lit(0)
    return made.join(sold, ["business_unit", "kpi_date"], "full").select(
        "kpi_date",
        "business_unit",
        F.coalesce("estimates_made", zero).alias("estimates_made"),
        F.coalesce("estimates_sold", zero).alias("estimates_sold"),
        percent("estimates_sold", "estimates_made").alias("close_rate_percent"),
    )


def estimates_scheduled(
    estimates: DataFrame, appointments: DataFrame, dim_jobs: DataFrame, start: date | str, end: date | str
) -> DataFrame:
    """Estimates made in the window (both days included) whose job has an appointment with a start, per unit.

    Their value is the total, or the subtotal of those without one; no appointment repeats it.
    """
    planned = appointments.where(F.col("scheduled_start").isNotNull()).select("job_id").distinct()
    scheduled = dim_jobs.select(F.col("id").alias("job_id"), "business_unit").join(planned, "job_id", "left_semi")
    made = estimates.where(F.col("job_id").isNotNull() & day_range("created_on", start, end))
    made = made.withColumn("value", F.coalesce("total", "subtotal"))
    return (
        spread_join(made, scheduled, "job_id")
        .groupBy("business_unit")
        .agg(
            F.countDistinct("id").alias("estimates_scheduled"),
            sum_money("value").cast("double").alias("estimate_value"),
        )
    )


def payments_with_unit(
    payments: DataFrame,
    invoices: DataFrame,
    dim_jobs: DataFrame,
    *,
    unit_suffix: str = PRODUCTION_SUFFIX,
) -> DataFrame:
    owner = invoices.where(F.col("job_id").isNotNull()).select(
        F.col("id").alias("invoice_id"), "job_id"
    )
    unit = dim_jobs.where(ends_with("business_unit", unit_suffix)).select(
        F.col("id").alias("job_id"), "business_unit"
    )
    return payments.join(owner, "invoice_id").join(unit, "job_id")


def dollars_collected_daily(unit_payments: DataFrame) -> DataFrame:
    return unit_payments.groupBy(F.to_date("created_on").alias("kpi_date"), "business_unit").agg(
        sum_money("amount").cast("double").alias("dollars_collected"),
        F.countDistinct("id").alias("payment_count"),
    )


def receivables_with_floor(
    invoices: DataFrame,
    dim_jobs: DataFrame,
    *,
    floor: float = RECEIVABLE_FLOOR,
    unit_suffix: str = PRODUCTION_SUFFIX,
) -> DataFrame:
    unit = dim_jobs.where(ends_with("business_unit", unit_suffix)).select(
        F.col("id").alias("job_id"), "business_unit"
    )
    return (
        invoices.where(F.col("balance") >= floor)
        .join(unit, "job_id")
        .groupBy("business_unit")
        .agg(sum_money("balance").cast("double").alias("outstanding_ar"))
    )


def future_bookings_by_invoice(
    invoices: DataFrame,
    dim_jobs: DataFrame,
    excluded_types: DataFrame,
    as_of: date | str,
    *,
    unit_suffix: str = PRODUCTION_SUFFIX,
) -> DataFrame:
    """Invoices dated within the year after ``as_of``, without the excluded job types."""
    first = next_day(as_of)
    last = utc_midnight(next_day(plus_year(as_of)))
    unit = (
        dim_jobs.where(ends_with("business_unit", unit_suffix))
        .join(excluded_types, "job_type_name", "left_anti")
        .select(F.col("id").alias("job_id"), "business_unit")
    )
    return (
        invoices.where(
            (F.col("invoice_date") >= utc_midnight(first)) & (F.col("invoice_date") < last)
        )
        .join(unit, "job_id")
        .groupBy("business_unit")
        .agg(sum_money("total").cast("double").alias("future_bookings"))
    )


def plus_year(day: date | str) -> date:
    d = day if isinstance(day, date) else date.fromisoformat(day)
    try:
        return d.replace(year=d.year + 1)
    except ValueError:
        return d.replace(year=d.year + 1, day=28)


EXCLUDED_TYPE_ROWS = tuple((t,) for t in NON_PRODUCTION_JOB_TYPES)
