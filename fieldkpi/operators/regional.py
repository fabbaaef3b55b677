"""Regional rollups: percentages are weighted by what they are percentages of."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldkpi.functions.constants import PRODUCTION_SUFFIX, SALES_SUFFIX
from fieldkpi.functions.expr import dollars, ends_with, percent, ratio, rounded, sum_money

_EXACT = "decimal(28,6)"


def _sum(c: str, of: Column) -> Column:
    return F.sum(F.when(of, F.coalesce(F.col(c).cast(_EXACT), F.lit(0))).otherwise(F.lit(0)))


def _weighted(c: str, weight: str, of: Column) -> Column:
    product = F.col(c).cast("decimal(18,6)") * F.col(weight).cast("decimal(18,4)")
    total = F.sum(F.when(of, F.coalesce(product, F.lit(0))).otherwise(F.lit(0)))
    return ratio(total, _sum(weight, of))


def _sides(unit: str = "business_unit") -> tuple[Column, Column]:
    return ends_with(unit, SALES_SUFFIX), ends_with(unit, PRODUCTION_SUFFIX)


def _joined(daily: DataFrame, regions: DataFrame) -> DataFrame:
    """Units without a region are left out, as a map join does; see ``unmapped_units``."""
    return daily.join(regions.select("business_unit", "region"), "business_unit")


def unmapped_units(daily: DataFrame, regions: DataFrame) -> DataFrame:
    return daily.join(regions, "business_unit", "left_anti").groupBy("business_unit").agg(
        F.count("*").alias("days")
    )


def regional_kpis(daily: DataFrame, regions: DataFrame, since: str) -> DataFrame:
    """Sales measures from sales units, production ones from production units."""
    sales, production = _sides()
    leads, estimates = _sum("lead_count", sales), _sum("num_estimates", sales)
    return (
        _joined(daily, regions)
        .where(F.col("event_date") >= F.lit(since).cast("date"))
        .groupBy("event_date", "region")
        .agg(
            leads.cast("bigint").alias("lead_count"),
            _sum("total_booked", sales).cast("double").alias("total_booked"),
            estimates.cast("bigint").alias("num_estimates"),
            (ratio(estimates, leads) * 100.0).alias("close_rate_percent"),
            _sum("dollars_produced", production).cast("double").alias("dollars_produced"),
            _weighted("gpm_percent", "dollars_produced", production).alias("gpm_percent"),
            _weighted("warranty_percent", "dollars_produced", production).alias("warranty_percent"),
            _sum("dollars_collected", F.lit(True)).cast("double").alias("dollars_collected"),
            _sum("outstanding_ar", F.lit(True)).cast("double").alias("outstanding_ar"),
            _sum("future_bookings", sales).cast("double").alias("future_bookings"),
        )
    )


def regional_kpis_by_estimates(daily: DataFrame, regions: DataFrame, since: str) -> DataFrame:
    """Close rate weighted by estimates, average sale and job counts."""
    sales, production = _sides()
    return (
        _joined(daily, regions)
        .where(F.col("event_date") >= F.lit(since).cast("date"))
        .groupBy("event_date", "region")
        .agg(
            _sum("lead_count", sales).cast("bigint").alias("lead_count"),
            _sum("estimate_count", sales).cast("bigint").alias("estimate_count"),
            F.round(_sum("total_booked", sales), 2).cast("double").alias("total_booked"),
            rounded(_weighted("close_rate", "estimate_count", sales) * 100.0, 1).alias("close_rate_percent"),
            F.round(_sum("dollars_produced", production), 2).cast("double").alias("dollars_produced"),
            rounded(_weighted("gpm_percent", "dollars_produced", production), 1).alias("gpm_percent"),
            rounded(_weighted("warranty_percent", "dollars_produced", production)).alias("warranty_percent"),
            rounded(_weighted("labor_efficiency", "dollars_produced", production)).alias("labor_efficiency"),
            _sum("completed_job_count", production).cast("bigint").alias("completed_job_count"),
            _sum("warranty_job_count", production).cast("bigint").alias("warranty_job_count"),
            rounded(
                ratio(
                    _sum("total_booked", sales),
                    _sum("estimate_count", sales & (F.col("total_booked") > 0)),
                )
            ).alias("avg_sale_amount"),
        )
    )


def region_by_pattern(unit: str, patterns: Sequence[tuple[str, str]], other: str = "Other") -> Column:
    """First matching (LIKE pattern, region)."""
    label = None
    for pattern, region in patterns:
        test = F.col(unit).like(pattern)
        label = F.when(test, region) if label is None else label.when(test, region)
    return F.lit(other) if label is None else label.otherwise(other)


def consolidated_measures() -> list[Column]:
    """Sums of the consolidated facts, with rates taken from the sums."""
    offered, closed = F.sum("sales_opportunities"), F.sum("closed_opportunities")
    revenue, cost = sum_money("job_subtotal"), sum_money("job_costs")
    return [
        F.sum("leads").alias("total_leads"),
        dollars(sum_money("collected_amount")).alias("total_collected"),
        offered.alias("total_opps"),
        closed.alias("total_closed"),
        percent(closed, offered).alias("close_rate_pct"),
        dollars(sum_money("total_sales")).alias("total_sales"),
        F.sum("completed_jobs").alias("jobs"),
        dollars(revenue).alias("job_revenue"),
        percent(revenue - cost, revenue).alias("gm_pct"),
    ]


def consolidated_by_region(
    consolidated: DataFrame, patterns: Sequence[tuple[str, str]], start: str, end: str
) -> DataFrame:
    inside = F.col("kpi_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return (
        consolidated.where(inside)
        .groupBy(region_by_pattern("bu_key", patterns).alias("region"))
        .agg(*consolidated_measures())
    )


def consolidated_daily_by_region(consolidated: DataFrame, region_map: DataFrame) -> DataFrame:
    """Day by region over a configured map (bu_key, region_key, region_label)."""
    regions = region_map.select("bu_key", "region_key", "region_label")
    return (
        consolidated.join(regions, "bu_key")
        .groupBy("kpi_date", "region_key", "region_label")
        .agg(*consolidated_measures())
    )
