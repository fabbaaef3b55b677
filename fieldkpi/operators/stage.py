"""Row-level stage tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkpi.functions.constants import (
    BUSINESS_TZ,
    OPPORTUNITY_JOB_TYPES,
    PRODUCTION_STATUSES,
    PRODUCTION_SUFFIX,
    SALES_SUFFIX,
)
from fieldkpi.functions.expr import (
    contains_ci,
    count_if,
    ends_with,
    is_test_name,
    local_date,
    local_day_until,
    money,
    or_zero,
    sum_if,
    sum_money,
)

_JOB = ("customer_id", "business_unit", "job_type_name", "job_status")


def _job_columns() -> list:
    return [
        F.col("id").alias("job_id"),
        *_JOB,
        F.col("created_on").alias("job_created_on"),
        F.col("completed_on").alias("job_completed_on"),
    ]


def leads_jobs(
    dim_jobs: DataFrame, customers: DataFrame, *, type_word: str = "estimate", tz: str = BUSINESS_TZ
) -> DataFrame:
    """Estimate jobs of real customers, by local creation day.  Null names are real."""
    names = customers.select(F.col("id").alias("customer_id"), F.col("name").alias("customer_name"))
    return (
        dim_jobs.where(
            contains_ci("job_type_name", type_word)
            & F.col("customer_id").isNotNull()
            & F.col("created_on").isNotNull()
        )
        .join(names, "customer_id", "left")
        .where(~is_test_name("customer_name"))
        .select(*_job_columns(), local_date("created_on", tz).alias("lead_date"), "customer_name")
    )


def completed_estimates_jobs(
    dim_jobs: DataFrame, *, type_word: str = "estimate", tz: str = BUSINESS_TZ
) -> DataFrame:
    return dim_jobs.where(
        contains_ci("job_type_name", type_word)
        & (F.col("job_status") == "Completed")
        & F.col("id").isNotNull()
        & F.col("completed_on").isNotNull()
    ).select(*_job_columns(), local_date("completed_on", tz).alias("completed_date"))


def sold_estimates(estimates: DataFrame, dim_jobs: DataFrame, *, tz: str = BUSINESS_TZ) -> DataFrame:
    jobs = dim_jobs.select(F.col("id").alias("job_id"), "customer_id", "business_unit")
    return (
        estimates.where(
            (F.col("status") == "Sold")
            & F.col("sold_on").isNotNull()
            & F.col("id").isNotNull()
            & F.col("job_id").isNotNull()
        )
        .join(jobs, "job_id")
        .select(
            F.col("id").alias("estimate_id"),
            "job_id",
            "customer_id",
            "business_unit",
            F.col("status").alias("estimate_status"),
            F.coalesce(money("total"), money("subtotal")).alias("revenue_amount"),
            F.col("created_on").alias("estimate_created_on"),
            F.col("sold_on").alias("estimate_sold_on"),
            local_date("sold_on", tz).alias("sold_date"),
        )
    )


def estimate_rollup(estimates: DataFrame) -> DataFrame:
    sold = F.col("status") == "Sold"
    return (
        estimates.where(F.col("job_id").isNotNull())
        .groupBy("job_id")
        .agg(
            F.count("*").alias("estimate_count"),
            count_if(sold).alias("sold_estimate_count"),
            F.min(F.when(sold, F.col("sold_on"))).alias("earliest_sold_on"),
        )
    )


def opportunity_jobs(
    dim_jobs: DataFrame,
    estimates: DataFrame,
    invoices: DataFrame,
    *,
    unit_suffix: str = SALES_SUFFIX,
    tz: str = BUSINESS_TZ,
) -> DataFrame:
    """Sales-unit jobs with an estimate or an invoice value; closed if one was sold.

    Both children are rolled up per job first, so no join multiplies rows.
    """
    invoice_value = (
        invoices.where(F.col("job_id").isNotNull())
        .groupBy("job_id")
        .agg(sum_money("subtotal").alias("invoice_subtotal"))
    )
    n_estimates = F.coalesce(F.col("estimate_count"), F.lit(0))
    n_sold = F.coalesce(F.col("sold_estimate_count"), F.lit(0))
    return (
        dim_jobs.where(ends_with("business_unit", unit_suffix) & F.col("id").isNotNull())
        .withColumnRenamed("id", "job_id")
        .join(estimate_rollup(estimates), "job_id", "left")
        .join(invoice_value, "job_id", "left")
        .where((n_estimates > 0) | (F.coalesce(F.col("invoice_subtotal"), F.lit(0)) != 0))
        .select(
            "job_id",
            "customer_id",
            "business_unit",
            "job_status",
            "job_type_name",
            F.col("created_on").alias("job_created_on"),
            F.col("completed_on").alias("job_completed_on"),
            n_estimates.alias("estimate_count"),
            n_sold.alias("sold_estimate_count"),
            "earliest_sold_on",
            local_date(F.coalesce("earliest_sold_on", "completed_on"), tz).alias("opportunity_date"),
            F.lit(True).alias("is_sales_opportunity"),
            (n_sold >= 1).alias("is_closed_opportunity"),
        )
    )


def report_opportunity_jobs(
    dim_jobs: DataFrame,
    estimates: DataFrame,
    *,
    job_types: Sequence[str] = OPPORTUNITY_JOB_TYPES,
    unit_suffix: str = SALES_SUFFIX,
    tz: str = BUSINESS_TZ,
) -> DataFrame:
    """Completed jobs of listed types in sales units; an estimate is sold if it has a date."""
    sold = F.col("sold_on").isNotNull()
    rollup = (
        estimates.where(F.col("job_id").isNotNull())
        .groupBy("job_id")
        .agg(
            F.count("*").alias("total_estimates"),
            count_if(sold).alias("sold_estimates"),
            F.sum(or_zero("subtotal")).alias("total_estimate_amount"),
            sum_if(sold, or_zero("subtotal")).alias("total_sold_amount"),
        )
    )
    return (
        dim_jobs.where(
            (F.col("job_status") == "Completed")
            & F.col("completed_on").isNotNull()
            & F.col("job_type_name").isin(*job_types)
            & ends_with("business_unit", unit_suffix)
        )
        .withColumnRenamed("id", "job_id")
        .join(rollup, "job_id", "left")
        .select(
            "job_id",
            *_JOB,
            F.col("created_on").alias("job_created_on"),
            F.col("completed_on").alias("job_completed_on"),
            local_date("completed_on", tz).alias("completion_date"),
            "total_estimates",
            "sold_estimates",
            "total_estimate_amount",
            "total_sold_amount",
            F.coalesce(F.col("sold_estimates") > 0, F.lit(False)).alias("is_closed"),
        )
    )


def production_jobs(
    job_costing: DataFrame,
    *,
    unit_suffix: str = PRODUCTION_SUFFIX,
    statuses: Sequence[str] = PRODUCTION_STATUSES,
) -> DataFrame:
    return job_costing.where(
        ends_with("business_unit", unit_suffix)
        & F.col("job_status").isin(*statuses)
        & F.col("job_id").isNotNull()
        & F.col("job_start_date").isNotNull()
    ).select(
        "job_id",
        "business_unit",
        "job_status",
        "revenue_subtotal",
        "gross_profit",
        "total_cost",
        "labor_cost",
        "material_cost_net",
        "is_warranty",
        F.col("job_start_date").alias("start_date"),
        F.col("completed_date").alias("completion_date"),
    )


def jobs_by_first_appointment(
    appointments: DataFrame, start: str, end: str, *, tz: str = BUSINESS_TZ
) -> DataFrame:
    """Jobs whose first appointment falls in the window.

    Appointments after the window are dropped at the scan: they cannot be the first
    one in it.  Earlier ones have to stay.
    """
    first = F.min(local_date("scheduled_start", tz))
    return (
        appointments.where(
            F.col("job_id").isNotNull() & local_day_until("scheduled_start", end, tz)
        )
        .groupBy("job_id")
        .agg(first.alias("first_appointment"))
        .where(F.col("first_appointment").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    )
