"""Job costing: every child table is rolled up per job before it is joined."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldkpi.functions.constants import (
    BUSINESS_TZ,
    CANCELED_ORDER_STATUS,
    MATERIAL_ITEM_TYPES,
    WARRANTY_JOB_TYPES,
)
from fieldkpi.functions.expr import json_items, local_time, money, or_zero, ratio, sum_money

PAYROLL_LINE_KEY = (
    "job_id",
    "employee_id",
    "date",
    "activity",
    "amount",
    "paid_duration_hours",
)


def _with_job(df: DataFrame) -> DataFrame:
    return df.where(F.col("job_id").isNotNull())


def job_dates(appointments: DataFrame, *, tz: str | None = None) -> DataFrame:
    """First start and last end per job, in UTC or, with ``tz``, in local time."""
    start, end = F.min("scheduled_start"), F.max("scheduled_end")
    if tz is not None:
        start, end = local_time(start, tz), local_time(end, tz)
    return (
        _with_job(appointments)
        .groupBy("job_id")
        .agg(start.alias("job_start_date"), end.alias("job_end_date"))
    )


def job_dates_with_fallback(
    jobs: DataFrame, appointments: DataFrame, *, tz: str = BUSINESS_TZ
) -> DataFrame:
    """Local start: first appointment, else completion, else creation."""
    base = jobs.select(F.col("id").alias("job_id"), "completed_on", "created_on")
    return base.join(job_dates(appointments, tz=tz), "job_id", "left").select(
        "job_id", start_or_fallback("job_start_date", tz).alias("job_start_date"), "job_end_date"
    )


def start_or_fallback(start: str, tz: str = BUSINESS_TZ) -> Column:
    """A local start, else the job's local completion, else its local creation."""
    return F.coalesce(start, local_time("completed_on", tz), local_time("created_on", tz))


def invoice_rollup(invoices: DataFrame, *, item_types: Sequence[str] = ()) -> DataFrame:
    """Invoice sums per job; with ``item_types`` also the cost and number of the line
    items of those types, added up within each invoice so that one grouping does."""
    rows = _with_job(invoices)
    measures = [
        sum_money("subtotal").alias("invoice_subtotal"),
        sum_money("total").alias("invoice_total"),
        sum_money("sales_tax").alias("invoice_tax"),
        F.count("*").alias("invoice_count"),
    ]
    if item_types:
        picked = F.filter(
            json_items("items", "type string, cost string"), lambda i: i["type"].isin(*item_types)
        )
        rows = rows.withColumn("_picked", picked).withColumn("_cost", _item_cost("_picked"))
        measures += [
            F.sum("_cost").alias("invoice_material_cost"),
            F.sum(F.coalesce(F.size("_picked"), F.lit(0))).alias("material_item_count"),
        ]
    return rows.groupBy("job_id").agg(*measures)


def _item_cost(items: str) -> Column:
    """Sum of the costs that are numbers."""
    zero = F.lit(0).cast("decimal(18,4)")
    return F.aggregate(
        items,
        zero,
        lambda total, i: money(total + F.coalesce(i["cost"].try_cast("decimal(18,4)"), zero)),
    )


def distinct_payroll_lines(payroll: DataFrame) -> DataFrame:
    return payroll.select(*PAYROLL_LINE_KEY).distinct()


def labor_rollup(payroll: DataFrame, *, count_lines: bool = False) -> DataFrame:
    """Pay per job over distinct lines; ``count_lines`` counts lines, else employees."""
    lines = distinct_payroll_lines(_with_job(payroll))
    if count_lines:
        # A line with an empty key part has no composite key, so it is paid but not counted.
        keyed = F.col("employee_id").isNotNull() & F.col("date").isNotNull()
        keyed = keyed & F.col("amount").isNotNull() & F.col("paid_duration_hours").isNotNull()
        techs = F.count_if(keyed)
    else:
        techs = F.countDistinct("employee_id")
    return lines.groupBy("job_id").agg(
        sum_money("amount").alias("total_labor_cost"), techs.alias("tech_count")
    )


def adjustment_rollup(adjustments: DataFrame, invoices: DataFrame) -> DataFrame:
    """Payroll adjustments reach a job through their invoice."""
    per_invoice = (
        adjustments.where(F.col("invoice_id").isNotNull())
        .groupBy("invoice_id")
        .agg(sum_money("amount").alias("amount"))
    )
    owner = _with_job(invoices).select(F.col("id").alias("invoice_id"), "job_id")
    return (
        per_invoice.join(owner, "invoice_id").groupBy("job_id").agg(F.sum("amount").alias("payroll_adj"))
    )


def purchase_order_rollup(
    orders: DataFrame, *, canceled: str = CANCELED_ORDER_STATUS
) -> DataFrame:
    """Orders with a status other than canceled; a missing status is dropped too."""
    return (
        _with_job(orders)
        .where(F.col("status") != canceled)
        .groupBy("job_id")
        .agg(sum_money("total").alias("po_cost"), F.count("*").alias("po_count"))
    )


def invoice_items(invoices: DataFrame) -> DataFrame:
    """One row per invoice line item; a cost that is no number becomes null."""
    return invoices.select(
        "id",
        "job_id",
        F.explode(json_items("items", "type string, cost string, total string")).alias("item"),
    ).select(
        "id",
        "job_id",
        F.col("item.type").alias("type"),
        F.col("item.cost").try_cast("decimal(18,4)").alias("cost"),
        F.col("item.total").try_cast("decimal(18,4)").alias("total"),
    )


def item_material_rollup(
    invoices: DataFrame, *, item_types: Sequence[str] = MATERIAL_ITEM_TYPES
) -> DataFrame:
    return (
        invoice_items(_with_job(invoices))
        .where(F.col("type").isin(*item_types))
        .groupBy("job_id")
        .agg(
            sum_money("cost").alias("invoice_material_cost"),
            F.count("*").alias("material_item_count"),
        )
    )


def combine_materials(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Purchase orders plus invoice items per job; either side may be absent."""
    return orders.join(items, "job_id", "full").select(
        "job_id",
        (or_zero("po_cost") + or_zero("invoice_material_cost")).alias("material_cost"),
        _count("po_count"),
        _count("material_item_count", "invoice_material_count"),
    )


def return_rollup(returns: DataFrame) -> DataFrame:
    return _with_job(returns).groupBy("job_id").agg(sum_money("total").alias("return_credit"))


def _count(c: str, alias: str | None = None) -> Column:
    return F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(alias or c)


def job_costing(
    dim_jobs: DataFrame,
    appointments: DataFrame,
    invoices: DataFrame,
    payroll: DataFrame,
    purchase_orders: DataFrame,
    returns: DataFrame,
    adjustments: DataFrame | None = None,
    *,
    date_rule: str = "appointment_utc",
    include_invoice_materials: bool = False,
    count_lines: bool = False,
    warranty_types: Sequence[str] = WARRANTY_JOB_TYPES,
    tz: str = BUSINESS_TZ,
) -> DataFrame:
    """Revenue, labour, materials and margin per job.

    ``date_rule``: ``appointment_utc`` and ``appointment_local`` need an appointment;
    ``fallback_local`` falls back to completion or creation.  All rollups and the job
    table meet on one hash partitioning of the job key.
    """
    if date_rule not in ("fallback_local", "appointment_local", "appointment_utc"):
        raise ValueError(f"unknown date_rule {date_rule!r}")
    fallback = date_rule == "fallback_local"
    dates = job_dates(appointments, tz=None if date_rule == "appointment_utc" else tz)
    dated = dim_jobs.withColumnRenamed("id", "job_id").join(dates, "job_id", "left" if fallback else "inner")
    if fallback:
        dated = dated.withColumn("job_start_date", start_or_fallback("job_start_date", tz))

    item_types = MATERIAL_ITEM_TYPES if include_invoice_materials else ()
    joined = (
        dated.where(F.col("job_start_date").isNotNull())
        .join(invoice_rollup(invoices, item_types=item_types), "job_id", "left")
        .join(labor_rollup(payroll, count_lines=count_lines), "job_id", "left")
        .join(purchase_order_rollup(purchase_orders), "job_id", "left")
        .join(return_rollup(returns), "job_id", "left")
    )
    material = or_zero("po_cost")
    item_count = F.lit(0).cast("bigint").alias("invoice_material_count")
    if item_types:
        material = money(material + or_zero("invoice_material_cost"))
        item_count = _count("material_item_count", "invoice_material_count")
    adjustment = F.lit(0).cast("decimal(18,4)")
    if adjustments is not None:
        joined = joined.join(adjustment_rollup(adjustments, invoices), "job_id", "left")
        adjustment = or_zero("payroll_adj")

    costed = joined.select(
        "job_id",
        "job_number",
        F.col("job_type_name").alias("job_type"),
        "job_status",
        "business_unit_id",
        "business_unit",
        "job_start_date",
        "job_end_date",
        F.col("completed_on").alias("completed_date"),
        F.col("created_on").alias("created_date"),
        or_zero("invoice_subtotal").alias("revenue_subtotal"),
        or_zero("invoice_total").alias("revenue_total"),
        money(or_zero("total_labor_cost") + adjustment).alias("labor_cost"),
        money(material - or_zero("return_credit")).alias("material_cost_net"),
        or_zero("total_labor_cost").alias("labor_gross_pay"),
        adjustment.alias("payroll_adjustments"),
        material.alias("material_cost_raw"),
        or_zero("return_credit").alias("return_credit"),
        _count("invoice_count"),
        _count("tech_count"),
        _count("po_count"),
        item_count,
        F.coalesce(F.col("job_type_name").isin(*warranty_types), F.lit(False)).alias("is_warranty")
        if warranty_types
        else F.lit(False).alias("is_warranty"),
    )
    return (
        costed.withColumn("total_cost", money(F.col("labor_cost") + F.col("material_cost_net")))
        .withColumn("gross_profit", money(F.col("revenue_subtotal") - F.col("total_cost")))
        .withColumn("gpm_percent", ratio("gross_profit", "revenue_subtotal") * 100.0)
    )


MEASURES = (
    "revenue_subtotal",
    "revenue_total",
    "labor_cost",
    "material_cost_net",
    "labor_gross_pay",
    "payroll_adjustments",
    "material_cost_raw",
    "return_credit",
    "total_cost",
    "gross_profit",
)


def in_dollars(costing: DataFrame) -> DataFrame:
    """The exact decimals as doubles, for output."""
    return costing.withColumns(
        {c: F.col(c).cast("double") for c in MEASURES if c in costing.columns}
    )


def margin_listing(costing: DataFrame, start: str, end: str, *, units: Sequence[str] = ()) -> DataFrame:
    """Per-job margins of jobs that start in the window, highest revenue first."""
    rows = costing.where(
        F.to_date("job_start_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    )
    if units:
        rows = rows.where(F.col("business_unit").isin(*units))
    return rows.select(
        "business_unit",
        "job_id",
        F.to_date("job_start_date").alias("job_date"),
        F.round("revenue_subtotal", 2).cast("double").alias("revenue"),
        F.round("labor_cost", 2).cast("double").alias("labor"),
        F.round("material_cost_net", 2).cast("double").alias("materials"),
        F.round("gross_profit", 2).cast("double").alias("gross_profit"),
        F.round(F.col("gpm_percent").cast("decimal(38,6)"), 2).cast("double").alias("gpm_percent"),
    ).orderBy("business_unit", F.desc("revenue"), "job_id")


def top_jobs(costing: DataFrame, measure: str, n: int = 20) -> DataFrame:
    """The n jobs with the highest measure; ties by job id."""
    return (
        costing.where(F.col(measure) > 0)
        .select("job_id", "business_unit", "job_status", F.col(measure).cast("double").alias(measure))
        .orderBy(F.desc(measure), "job_id")
        .limit(n)
    )


def top_cost_rows(
    rows: DataFrame, costing: DataFrame, *, amount: str = "amount", tie: Sequence[str], n: int = 20
) -> DataFrame:
    """The n largest raw cost rows, with the costing of their jobs.

    The rows are ranked before the join, so only n of them are looked up.
    """
    top = rows.where(F.col("job_id").isNotNull()).orderBy(F.desc(amount), *tie).limit(n)
    jobs = costing.select("job_id", "business_unit", "labor_cost", "material_cost_net")
    return top.join(jobs, "job_id", "left")
