"""Weekly, monthly and yearly rollups, trends, alerts and breakdowns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldkpi.functions.expr import (
    count_if,
    day_range,
    dollars,
    monday_week,
    money,
    month_start,
    percent,
    ratio,
    rounded,
    sum_money,
    sunday_week,
    utc_midnight,
)
from fieldkpi.operators.regional import consolidated_measures

_EXACT = "decimal(28,6)"


def _total(c: str) -> Column:
    return F.sum(F.col(c).cast(_EXACT))


def _mean(c: str) -> Column:
    exact = F.col(c).cast(_EXACT)
    return ratio(F.sum(exact), F.count(exact))


def _between(c: str, start: str, end: str) -> Column:
    return F.col(c).between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def weekly_by_unit(
    daily: DataFrame,
    *,
    unit: str = "business_unit",
    sums: Sequence[str] = ("lead_count", "estimate_count", "completed_job_count", "payment_count"),
    amounts: Sequence[str] = ("total_booked", "dollars_produced", "dollars_collected"),
) -> DataFrame:
    """Monday weeks: sums, and rates as ratios of the week's sums."""
    produced = F.coalesce(F.col("dollars_produced").cast(_EXACT), F.lit(0))
    profit = F.sum(
        F.col("gpm_percent").cast("decimal(18,6)") * F.col("dollars_produced").cast("decimal(18,4)")
    )
    warranty = F.sum(
        F.col("warranty_percent").cast("decimal(18,6)")
        * F.col("dollars_produced").cast("decimal(18,4)")
    )
    return daily.groupBy(F.col(unit), monday_week("event_date").alias("week_start")).agg(
        *[F.sum(c).alias(c) for c in sums],
        *[dollars(_total(c)).alias(c) for c in amounts],
        F.sum("sales_opportunities").alias("sales_opportunities"),
        F.sum("closed_opportunities").alias("closed_opportunities"),
        percent(F.sum("closed_opportunities"), F.sum("sales_opportunities")).alias("close_rate_pct"),
        rounded(ratio(profit, F.sum(produced))).alias("gpm_pct"),
        rounded(ratio(warranty, F.sum(produced))).alias("warranty_pct"),
    )


def weekly_by_region(consolidated: DataFrame, regions: DataFrame) -> DataFrame:
    """Sunday weeks per region."""
    return (
        consolidated.join(regions.select("bu_key", "region_label"), "bu_key")
        .groupBy(sunday_week("kpi_date").alias("week_start"), "region_label")
        .agg(
            F.sum("leads").alias("weekly_leads"),
            F.sum("sales_opportunities").alias("weekly_estimates"),
            F.sum("closed_opportunities").alias("weekly_booked"),
            dollars(sum_money("total_sales")).alias("weekly_sales"),
            F.sum("completed_jobs").alias("weekly_jobs"),
            dollars(sum_money("collected_amount")).alias("weekly_collections"),
        )
    )


def window_by_unit(consolidated: DataFrame, start: str, end: str) -> DataFrame:
    return (
        consolidated.where(_between("kpi_date", start, end))
        .groupBy("bu_key")
        .agg(*consolidated_measures())
    )


def daily_trend(consolidated: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    since = F.date_sub(F.lit(as_of).cast("date"), days)
    return (
        consolidated.where((F.col("kpi_date") >= since) & (F.col("kpi_date") <= F.lit(as_of).cast("date")))
        .groupBy("kpi_date")
        .agg(
            F.sum("leads").alias("daily_leads"),
            dollars(sum_money("collected_amount")).alias("daily_collected"),
            F.sum("sales_opportunities").alias("daily_opps"),
            F.sum("closed_opportunities").alias("daily_closed"),
            dollars(sum_money("total_sales")).alias("daily_sales"),
            F.sum("completed_jobs").alias("daily_jobs"),
            dollars(sum_money("job_subtotal")).alias("daily_revenue"),
        )
        .orderBy(F.desc("kpi_date"))
    )


def monthly_summary(leads: DataFrame, completed: DataFrame, opportunities: DataFrame, since: str) -> DataFrame:
    """Per month and unit over the days that have leads."""
    keys = ["kpi_date", "business_unit"]
    rows = (
        leads.where(F.col("kpi_date") >= F.lit(since).cast("date"))
        .join(completed.select(*keys, "completed_estimates_count"), keys, "left")
        .join(opportunities.select(*keys, "close_rate_percent"), keys, "left")
    )
    rate = F.coalesce(F.col("close_rate_percent").cast(_EXACT), F.lit(0))
    return rows.groupBy(month_start("kpi_date").alias("month"), "business_unit").agg(
        F.sum("leads_count").alias("monthly_leads"),
        F.coalesce(F.sum("completed_estimates_count"), F.lit(0)).alias("monthly_completions"),
        rounded(ratio(F.sum(rate), F.count("*"))).alias("avg_close_rate"),
    )


def invoice_revenue_by_month(invoices: DataFrame, units: DataFrame, since: str) -> DataFrame:
    active = units.where("active").select(F.col("id").alias("business_unit_id"), F.col("name").alias("business_unit"))
    return (
        invoices.where(F.col("created_on") >= utc_midnight(since))
        .join(active, "business_unit_id")
        .groupBy("business_unit", month_start("created_on").alias("month"))
        .agg(
            F.countDistinct("id").alias("invoice_count"),
            sum_money("total").cast("double").alias("total_revenue"),
            rounded(ratio(sum_money("total"), F.count(money("total")))).alias("avg_invoice_value"),
        )
    )


def weekly_kpi_summary(daily: DataFrame, start: str, end: str) -> DataFrame:
    """Counts and dollars summed, rates averaged over days, snapshots by their maximum."""
    return (
        daily.where(_between("event_date", start, end))
        .groupBy(monday_week("event_date").alias("week_start"), "business_unit")
        .agg(
            F.sum("lead_count").alias("leads"),
            dollars(_total("total_booked")).alias("total_booked"),
            dollars(_total("dollars_produced")).alias("dollars_produced"),
            rounded(_mean("gpm_percent")).alias("avg_gpm_percent"),
            dollars(_total("dollars_collected")).alias("dollars_collected"),
            F.sum("num_estimates").alias("estimates_count"),
            rounded(_mean("close_rate_percent")).alias("avg_close_rate"),
            F.max("future_bookings").alias("future_bookings"),
            rounded(_mean("warranty_percent")).alias("avg_warranty_percent"),
            F.max("outstanding_ar").alias("outstanding_ar"),
        )
    )


def week_over_week(weekly: DataFrame, measure: str, *, limit: float = 0.10) -> DataFrame:
    """Weeks that grew by more than ``limit`` against the unit's previous week."""
    before = F.lag(measure).over(Window.partitionBy("business_unit").orderBy("week_start"))
    growth = ratio(F.col(measure) - F.col("prev_week"), "prev_week")
    return (
        weekly.select("business_unit", "week_start", measure, before.alias("prev_week"))
        .withColumn("growth", growth)
        .where(F.col("growth") > limit)
        .withColumn("growth_pct", rounded(F.col("growth") * 100.0))
        .drop("growth")
    )


def low_margin_days(margins: DataFrame, as_of: str, *, limit: float = 20.0, days: int = 7) -> DataFrame:
    since = F.date_sub(F.lit(as_of).cast("date"), days)
    return margins.where(
        (F.col("gpm_percent") < limit)
        & (F.col("kpi_date") >= since)
        & (F.col("kpi_date") <= F.lit(as_of).cast("date"))
    )


def year_over_year(daily: DataFrame, measure: str, start: str, end: str) -> DataFrame:
    """The window's days beside the same days 365 days before."""
    keys = ["event_date", "business_unit"]
    shifted = (
        daily.select(F.date_add("event_date", 365).alias("event_date"), "business_unit", F.col(measure).alias("prior"))
        .where(_between("event_date", start, end))
    )
    now = daily.where(_between("event_date", start, end)).select(*keys, F.col(measure).alias("current"))
    return now.join(shifted, keys, "full").select(
        *keys, "current", "prior", percent(F.col("current") - F.col("prior"), "prior").alias("change_pct")
    )


def technician_utilisation(
    technicians: DataFrame, units: DataFrame, jobs: DataFrame, payroll: DataFrame, since: str
) -> DataFrame:
    """Jobs, hours and pay per active technician; each side is summed before the join."""
    assigned = (
        jobs.where(F.col("completed_on") >= utc_midnight(since))
        .groupBy("technician_id")
        .agg(F.countDistinct("id").alias("jobs_assigned"))
    )
    paid = payroll.groupBy(F.col("employee_id").alias("technician_id")).agg(
        sum_money("paid_duration_hours").alias("hours"), sum_money("amount").alias("pay")
    )
    home = units.select(F.col("id").alias("business_unit_id"), F.col("name").alias("home_business_unit"))
    return (
        technicians.where(F.coalesce("active", F.lit(True)))
        .select(F.col("id").alias("technician_id"), F.col("name").alias("technician"), "business_unit_id")
        .join(home, "business_unit_id", "left")
        .join(assigned, "technician_id")
        .join(paid, "technician_id", "left")
        .select(
            "technician",
            "home_business_unit",
            "jobs_assigned",
            F.col("hours").cast("double").alias("total_hours"),
            F.col("pay").cast("double").alias("total_compensation"),
            rounded(ratio("pay", "hours")).alias("avg_hourly_rate"),
        )
    )


def payroll_by_activity(payroll: DataFrame, units: DataFrame, since: str) -> DataFrame:
    """Payroll carries the unit's name, so the unit is matched by name."""
    named = units.select(F.col("name").alias("business_unit_name"), F.col("name").alias("business_unit"))
    return (
        payroll.where(F.col("date") >= utc_midnight(since))
        .join(named, "business_unit_name", "left")
        .groupBy("activity", "business_unit")
        .agg(
            sum_money("paid_duration_hours").cast("double").alias("total_hours"),
            sum_money("amount").cast("double").alias("total_cost"),
            F.countDistinct("source_entity_id").alias("payroll_entries"),
        )
    )


def leader_board(sales: DataFrame, n: int = 20) -> DataFrame:
    """The n sellers with the highest sales."""
    offered, closed = F.sum("sales_opportunities"), F.sum("closed_opportunities")
    total = sum_money("total_sales")
    return (
        sales.groupBy("estimator")
        .agg(
            total.cast("double").alias("total_sales"),
            offered.alias("sales_opportunities"),
            closed.alias("closed_opportunities"),
            percent(closed, offered).alias("close_rate_pct"),
        )
        .orderBy(F.desc("total_sales"), "estimator")
        .limit(n)
    )


def company_totals(sales: DataFrame) -> DataFrame:
    offered, closed = F.sum("sales_opportunities"), F.sum("closed_opportunities")
    return sales.agg(
        F.countDistinct("estimator").alias("sellers"),
        sum_money("total_sales").cast("double").alias("total_sales"),
        offered.alias("sales_opportunities"),
        closed.alias("closed_opportunities"),
        percent(closed, offered).alias("close_rate_pct"),
    )


def sign_audit(collections: DataFrame, *, samples: int = 5, units: Sequence[str] = ("business_unit",)) -> DataFrame:
    """Counts and totals by sign per unit, with the first negative and positive payments.

    The unit is the first of the ``units`` columns that is filled.  Samples are ranked first, so that no more than
    ``samples`` rows per unit and sign are gathered.
    """
    unit = F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in units], F.lit("unknown"))
    rows = collections.withColumn("unit", unit).withColumn("value", money("amount"))
    value = F.col("value")
    zero = F.lit(0).cast("decimal(18,4)")
    totals = rows.groupBy("unit").agg(
        F.count("*").alias("payments"),
        dollars(F.sum(F.coalesce(value, zero))).alias("total_with_negatives"),
        count_if(value > 0).alias("positive_count"),
        dollars(F.sum(F.when(value > 0, value).otherwise(zero))).alias("total_positives_only"),
        count_if(value < 0).alias("negative_count"),
        dollars(F.sum(F.when(value < 0, value).otherwise(zero))).alias("negative_total"),
        count_if(value.isNull() | (value == 0)).alias("zero_count"),
    )
    order = [F.col("payment_date").asc_nulls_last(), F.col("job_id").asc_nulls_last(), F.col("value")]
    signed = rows.where(value != 0).withColumn("negative", value < 0)
    rank = F.row_number().over(Window.partitionBy("unit", "negative").orderBy(*order))
    ranked = signed.select("unit", "negative", "job_id", rank.alias("rank")).where(F.col("rank") <= samples)

    def listed(wanted: Column, name: str) -> Column:
        found = F.sort_array(F.collect_list(F.when(wanted, F.struct("rank", "job_id"))))
        text = F.array_join(F.transform(found, lambda s: s["job_id"]), ",")
        return F.when(F.max(wanted), text).alias(name)

    negative = F.col("negative")
    first = ranked.groupBy("unit").agg(listed(negative, "negative_samples"), listed(~negative, "positive_samples"))
    return totals.join(first, "unit", "left")


def report_totals(sales: DataFrame) -> DataFrame:
    """Per unit, with a grand total under the name ``ALL``."""
    return (
        sales.rollup("bu_name")
        .agg(
            F.grouping("bu_name").alias("is_total"),
            F.sum("sales_opportunities").alias("sales_opportunities"),
            F.sum("closed_opportunities").alias("closed_opportunities"),
            dollars(sum_money("total_sales")).alias("total_sales"),
        )
        .select(
            F.when(F.col("is_total") == 1, "ALL").otherwise(F.col("bu_name")).alias("bu_name"),
            "sales_opportunities",
            "closed_opportunities",
            "total_sales",
        )
    )


def lead_filter_funnel(
    report: DataFrame, unit: str, *, row: str = "row", excluded_names: Sequence[str] = ("test",)
) -> DataFrame:
    """Report rows per queried unit: fetched, of that unit, and with a real name."""
    row_unit = F.nullif(F.get(F.col(row), 6), F.lit(""))
    unit_ok = row_unit.isNull() | (row_unit == F.col(unit))
    name = F.lower(F.coalesce(F.get(F.col(row), 0), F.lit("")))
    name_ok = F.lit(True)
    for token in excluded_names:
        name_ok = name_ok & ~name.contains(token.lower())
    return report.groupBy(F.col(unit).alias("bu_name")).agg(
        F.count("*").alias("fetched"),
        count_if(unit_ok).alias("passed_unit"),
        count_if(unit_ok & name_ok).alias("passed_name"),
        count_if(unit_ok & ~name_ok).alias("test_names"),
    )


def job_mix(dim_jobs: DataFrame, invoices: DataFrame, category: Column, start: str, end: str) -> DataFrame:
    """Jobs, customers and revenue by unit, type and category; invoices are summed per job."""
    revenue = (
        invoices.where(F.col("job_id").isNotNull())
        .groupBy(F.col("job_id").alias("id"))
        .agg(sum_money("subtotal").alias("revenue"))
    )
    return (
        dim_jobs.where(day_range("created_on", start, end))
        .join(revenue, "id", "left")
        .groupBy("business_unit", "job_type_name", category.alias("category"))
        .agg(
            F.countDistinct("id").alias("job_count"),
            F.countDistinct("customer_id").alias("unique_customers"),
            F.sum("revenue").cast("double").alias("revenue"),
        )
    )


def lead_sources(
    sales_jobs: DataFrame, estimates: DataFrame, campaigns: DataFrame, start: str, end: str
) -> DataFrame:
    """Leads per campaign, with how many got an estimate and how many were sold."""
    per_job = (
        estimates.where(F.col("job_id").isNotNull())
        .groupBy(F.col("job_id").alias("id"))
        .agg(F.max(F.col("status") == "Sold").alias("is_sold"))
    )
    names = campaigns.select(F.col("id").alias("campaign_id"), F.col("name").alias("campaign_name"))
    return (
        sales_jobs.where(day_range("created_on", start, end))
        .join(names, "campaign_id", "left")
        .join(per_job, "id", "left")
        .groupBy("business_unit", "campaign_id", "campaign_name")
        .agg(
            F.countDistinct("id").alias("lead_count"),
            F.countDistinct(F.when(F.col("is_sold").isNotNull(), F.col("id"))).alias("leads_with_estimates"),
            F.countDistinct(F.when(F.col("is_sold"), F.col("id"))).alias("leads_sold"),
        )
    )
