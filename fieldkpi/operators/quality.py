"""Data-quality checks and their grades."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldkpi.functions.constants import (
    CRITICAL,
    EXCELLENT,
    FLAG_GREEN,
    FLAG_RED,
    FLAG_YELLOW,
    GREEN,
    LOW,
    NO_DATA,
    OK,
    RED,
    WARNING,
    YELLOW,
)
from fieldkpi.functions.expr import (
    as_timestamp,
    count_if,
    month_start,
    percent,
    ratio,
    rounded,
    sum_money,
    utc_midnight,
)
from fieldkpi.functions.frames import union_all


@dataclass(frozen=True)
class Metric:
    """One graded number: an aggregate over a table, and where red and green begin."""

    name: str
    value: Column
    red: float
    green: float
    unit: str = "%"
    higher_is_better: bool = True


def _day(value: str) -> Column:
    return F.lit(value).cast("date")


def last_days(column: str, as_of: str, days: int) -> Column:
    """UTC day of the column not more than ``days`` before ``as_of``, on the bare column."""
    since = as_timestamp(f"{as_of} 00:00:00") - F.make_dt_interval(F.lit(days))
    return F.coalesce(F.col(column) >= since, F.lit(False))


def coverage(column: str, window: Column) -> Column:
    """Percentage of the window's rows whose column is filled."""
    return percent(F.count(F.when(window, F.col(column))), count_if(window))


def hours_old(column: str, now: str) -> Column:
    return F.timestamp_diff("HOUR", F.max(column), as_timestamp(now)).cast("double")


def volume(column: str, day: str) -> Column:
    inside = (F.col(column) >= utc_midnight(day)) & (
        F.col(column) < as_timestamp(f"{day} 00:00:00") + F.make_dt_interval(F.lit(1))
    )
    return count_if(F.coalesce(inside, F.lit(False))).cast("double")


def duplicates(key: str, window: Column) -> Column:
    return (count_if(window) - F.countDistinct(F.when(window, F.col(key)))).cast("double")


def _metric_rows(df: DataFrame, metrics: Sequence[Metric]) -> DataFrame:
    """All metrics of one table in one aggregate, one row each."""
    totals = df.agg(*[m.value.cast("double").alias(f"m{i}") for i, m in enumerate(metrics)])
    return totals.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(m.name).alias("metric"),
                        F.col(f"m{i}").alias("value"),
                        F.lit(m.unit).alias("unit"),
                        F.lit(float(m.red)).alias("red_threshold"),
                        F.lit(float(m.green)).alias("green_threshold"),
                        F.lit(m.higher_is_better).alias("higher_is_better"),
                    )
                    for i, m in enumerate(metrics)
                ]
            )
        )
    )


def stoplight(tables: Sequence[tuple[DataFrame, Sequence[Metric]]]) -> DataFrame:
    """Metrics of several tables, each scanned once, graded red, yellow or green."""
    rows = union_all([_metric_rows(df, metrics) for df, metrics in tables])
    value, up = F.col("value"), F.col("higher_is_better")
    bad = F.when(up, value < F.col("red_threshold")).otherwise(value > F.col("red_threshold"))
    good = F.when(up, value >= F.col("green_threshold")).otherwise(value <= F.col("green_threshold"))
    return rows.withColumn(
        "status", F.when(bad, RED).when(good, GREEN).otherwise(YELLOW)
    ).drop("higher_is_better")


def monthly_coverage(entities: dict[str, tuple[DataFrame, str, str]], since: str) -> DataFrame:
    """Rows per entity and month with the change on the month before.

    ``entities``: name -> (table, date column, column to count distinct values of).
    """
    parts = [
        df.where(F.col(at) >= utc_midnight(since))
        .groupBy(F.lit(name).alias("entity"), month_start(at).alias("month"))
        .agg(F.count("*").alias("record_count"), F.countDistinct(of).alias("distinct_values"))
        for name, (df, at, of) in entities.items()
    ]
    before = F.lag("record_count").over(Window.partitionBy("entity").orderBy("month"))
    return (
        union_all(parts)
        .withColumn("prior", before)
        .select(
            "entity",
            "month",
            "record_count",
            "distinct_values",
            F.when(
                F.col("prior") > 0, percent(F.col("record_count") - F.col("prior"), "prior", 1)
            ).alias("month_over_month_pct"),
            F.when(F.col("record_count") == 0, NO_DATA)
            .when(F.col("record_count") < 100, LOW)
            .otherwise(OK)
            .alias("status"),
        )
    )


def join_integrity(
    tables: Sequence[tuple[DataFrame, str, dict[str, str]]],
    as_of: str,
    *,
    days: int = 90,
    critical: Sequence[str] = ("invoices_to_jobs", "payments_to_invoices", "estimates_to_jobs"),
) -> DataFrame:
    """Share of recent rows whose foreign key is filled, graded.

    ``tables``: (table, date column, check name -> key column); one scan per table.
    """
    parts = []
    for df, at, checks in tables:
        totals = df.where(last_days(at, as_of, days)).agg(
            F.count("*").alias("total"), *[F.count(c).alias(name) for name, c in checks.items()]
        )
        parts.append(
            totals.select(
                F.inline(
                    F.array(
                        *[
                            F.struct(
                                F.lit(name).alias("join_type"),
                                F.col("total").alias("total_records"),
                                F.col(name).alias("records_with_join"),
                            )
                            for name in checks
                        ]
                    )
                )
            )
        )
    name, share = F.col("join_type"), F.col("coverage_percent")
    return (
        union_all(parts)
        .withColumn("records_missing_join", F.col("total_records") - F.col("records_with_join"))
        .withColumn("coverage_percent", percent("records_with_join", "total_records"))
        .withColumn(
            "status",
            F.when(name.isin(*critical) & (share < 85), CRITICAL)
            .when(share < 70, WARNING)
            .when(share >= 95, EXCELLENT)
            .otherwise(OK),
        )
        .withColumn(
            "threshold_percent",
            F.when(name == "payments_to_invoices", 95.0)
            .when(name.isin("invoices_to_jobs", "estimates_to_jobs"), 90.0)
            .when(name.like("%_to_business_units"), 85.0)
            .otherwise(75.0),
        )
    )


def weekly_anomalies(weekly: DataFrame) -> DataFrame:
    """Flags per week: more than two or three deviations off the unit's mean, or a rate
    outside its band."""
    unit = Window.partitionBy("business_unit")

    def spread(c: str) -> Column:
        off = F.abs(F.col(c) - F.avg(c).over(unit))
        sd = F.coalesce(F.stddev_samp(c).over(unit), F.lit(1.0))
        return F.when(off > 3 * sd, FLAG_RED).when(off > 2 * sd, FLAG_YELLOW).otherwise(FLAG_GREEN)

    margin, rate = F.col("avg_gpm_percent"), F.col("avg_close_rate")
    flagged = weekly.select(
        "week_start",
        "business_unit",
        "leads",
        spread("leads").alias("leads_flag"),
        rounded(F.col("total_booked"), 0).alias("total_booked"),
        spread("total_booked").alias("booked_flag"),
        rounded(F.col("dollars_produced"), 0).alias("dollars_produced"),
        spread("dollars_produced").alias("produced_flag"),
        rounded(margin, 1).alias("gpm_pct"),
        F.when(margin < 20, FLAG_RED)
        .when(margin < 30, FLAG_YELLOW)
        .when(margin > 80, FLAG_RED)
        .otherwise(FLAG_GREEN)
        .alias("gpm_flag"),
        rounded(rate, 1).alias("close_rate_pct"),
        F.when(rate < 10, FLAG_RED)
        .when((rate < 20) | (rate > 90), FLAG_YELLOW)
        .otherwise(FLAG_GREEN)
        .alias("close_rate_flag"),
    )
    flags = ("leads_flag", "booked_flag", "produced_flag", "gpm_flag", "close_rate_flag")
    return flagged.withColumn("overall_status", F.concat(*flags))


@dataclass(frozen=True)
class Check:
    rows: DataFrame
    status: str
    failed: Column


def run_suite(checks: dict[str, Check]) -> DataFrame:
    """One row per check: passed or failed, rows, and how many are red, yellow, green."""

    def flagged(check: Check, flag: str) -> Column:
        return count_if(F.col(check.status).contains(flag))

    return union_all(
        [
            c.rows.agg(
                F.when(F.coalesce(c.failed, F.lit(False)), "FAILED").otherwise("PASSED").alias("status"),
                F.count("*").alias("row_count"),
                flagged(c, FLAG_RED).alias("red"),
                flagged(c, FLAG_YELLOW).alias("yellow"),
                flagged(c, FLAG_GREEN).alias("green"),
            ).select(F.lit(name).alias("check"), "*")
            for name, c in checks.items()
        ]
    )


def any_status(status: str, text: str) -> Column:
    return F.max(F.col(status).contains(text))


def suite_samples(checks: dict[str, Check], n: int = 5) -> DataFrame:
    """The first rows of each check in the order of its columns, as JSON of texts, nulls included."""
    return union_all(
        [
            c.rows.orderBy(*c.rows.columns).limit(n).select(
                F.lit(name).alias("check"),
                F.to_json(F.struct(*[F.col(k).cast("string").alias(k) for k in c.rows.columns]), {"ignoreNullFields": "false"}).alias("sample"),
            )
            for name, c in checks.items()
        ]
    )


# --- keys and dates -------------------------------------------------------------------


def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def orphans(child: DataFrame, parent: DataFrame, foreign_key: str, key: str = "id") -> DataFrame:
    """Filled foreign keys without a parent, and how many rows carry each.

    Equal keys are counted before the join, so a frequent key is looked up once.
    """
    return (
        child.where(F.col(foreign_key).isNotNull())
        .groupBy(foreign_key)
        .agg(F.count("*").alias("rows"))
        .join(parent.select(F.col(key).alias(foreign_key)), foreign_key, "left_anti")
    )


def date_gaps(days: DataFrame, leads: DataFrame, completed: DataFrame) -> DataFrame:
    """Per calendar day: both measures, and whether there is no data or no activity."""
    a = leads.groupBy(F.col("kpi_date").alias("date")).agg(F.sum("leads_count").alias("l"))
    b = completed.groupBy(F.col("kpi_date").alias("date")).agg(
        F.sum("completed_estimates_count").alias("c")
    )
    zero = F.lit(0)
    return (
        days.select("date")
        .join(a, "date", "left")
        .join(b, "date", "left")
        .select(
            "date",
            F.coalesce("l", zero).alias("leads"),
            F.coalesce("c", zero).alias("completed"),
            F.when(F.col("l").isNull() & F.col("c").isNull(), "No Data")
            .when((F.col("l") == 0) & (F.col("c") == 0), "Zero Activity")
            .otherwise("OK")
            .alias("status"),
        )
    )


def entity_coverage(entities: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows, first and last day, span and distinct days per entity."""
    return union_all(
        [
            df.agg(
                F.count("*").alias("row_count"),
                F.to_date(F.min(at)).alias("earliest_date"),
                F.to_date(F.max(at)).alias("latest_date"),
                F.countDistinct(F.to_date(at)).alias("distinct_days"),
            ).select(
                F.lit(name).alias("entity"),
                "*",
                F.datediff("latest_date", "earliest_date").alias("days_of_data"),
            )
            for name, (df, at) in entities.items()
        ]
    )


def rows_per_year(rows: DataFrame, column: str = "created_on") -> DataFrame:
    return rows.groupBy(F.year(column).alias("year")).agg(F.count("*").alias("records"))


def ingest_freshness(entities: dict[str, tuple[DataFrame, str]], now: str) -> DataFrame:
    return union_all(
        [
            df.agg(F.max(at).alias("last_ingested"), F.count("*").alias("total_records")).select(
                F.lit(name).alias("entity"),
                "last_ingested",
                F.timestamp_diff("HOUR", F.col("last_ingested"), as_timestamp(now)).alias("hours_old"),
                "total_records",
            )
            for name, (df, at) in entities.items()
        ]
    )


# --- rules over marts and lists ---------------------------------------------------------


def allow_list_found(jobs: DataFrame, type_ids: Sequence[int]) -> DataFrame:
    return jobs.where(F.col("job_type_id").isin(*type_ids)).agg(
        F.countDistinct("job_type_id").alias("job_types_found"), F.count("*").alias("jobs_found")
    )


def allow_list_rows(jobs: DataFrame, type_ids: Sequence[int]) -> DataFrame:
    return (
        jobs.where(F.col("job_type_id").isin(*type_ids))
        .groupBy("job_type_id")
        .agg(F.count("*").alias("job_count"), F.countDistinct("customer_id").alias("unique_customers"))
    )


def completed_above_leads(leads: DataFrame, completed: DataFrame, as_of: str, *, days: int = 30, n: int = 10) -> DataFrame:
    """Newest days on which a unit completed more estimates than it had leads."""
    keys = ["kpi_date", "business_unit"]
    since = F.date_sub(_day(as_of), days)
    done = F.coalesce("completed_estimates_count", F.lit(0))
    return (
        leads.where((F.col("kpi_date") >= since) & (F.col("kpi_date") <= _day(as_of)))
        .join(completed.select(*keys, "completed_estimates_count"), keys, "left")
        .where(done > F.col("unique_customers"))
        .select(*keys, F.col("unique_customers").alias("leads"), done.alias("completed_estimates"))
        .orderBy(F.desc("kpi_date"), "business_unit")
        .limit(n)
    )


def opportunities_without_estimates(opportunities: DataFrame) -> DataFrame:
    return opportunities.agg(count_if(F.col("estimate_count") == 0).alias("jobs_without_estimates"))


def zone_shift(rows: DataFrame, utc: str, local_day: str) -> DataFrame:
    """Share of rows whose UTC day is not their local day."""
    differs = count_if(F.to_date(utc) != F.col(local_day))
    return rows.where(F.col(utc).isNotNull()).agg(
        differs.alias("dates_differ_from_utc"),
        F.count("*").alias("total_rows"),
        percent(differs, F.count("*")).alias("pct_different"),
    )


def unit_distribution(leads: DataFrame, completed: DataFrame, opportunities: DataFrame, as_of: str, days: int = 90) -> DataFrame:
    keys = ["kpi_date", "business_unit"]
    since = F.date_sub(_day(as_of), days)
    zero = F.lit(0)
    return (
        leads.where((F.col("kpi_date") >= since) & (F.col("kpi_date") <= _day(as_of)))
        .join(completed.select(*keys, "completed_estimates_count"), keys, "left")
        .join(opportunities.select(*keys, "sales_opportunities"), keys, "left")
        .groupBy("business_unit")
        .agg(
            F.countDistinct("kpi_date").alias("days_with_data"),
            F.sum("unique_customers").alias("total_leads"),
            F.sum(F.coalesce("completed_estimates_count", zero)).alias("total_completed"),
            F.sum(F.coalesce("sales_opportunities", zero)).alias("total_opportunities"),
        )
    )


def days_since_last(mart: DataFrame, as_of: str) -> DataFrame:
    return mart.agg(F.max("kpi_date").alias("most_recent_date")).select(
        "most_recent_date", F.datediff(_day(as_of), F.col("most_recent_date")).alias("days_since_last_data")
    )


def mart_summary(marts: dict[str, DataFrame]) -> DataFrame:
    """Rows, units and date range of each mart."""
    return union_all(
        [
            df.agg(
                F.count("*").alias("rows"),
                F.countDistinct("business_unit").alias("units"),
                F.min("kpi_date").alias("first_date"),
                F.max("kpi_date").alias("last_date"),
            ).select(F.lit(name).alias("mart"), "*")
            for name, df in marts.items()
        ]
    )


def unlisted_types(rows: DataFrame, allowed: DataFrame, column: str = "job_type_name") -> DataFrame:
    """Names in use that the list lacks; null names are no names."""
    return (
        rows.where(F.col(column).isNotNull())
        .select(column)
        .distinct()
        .join(allowed.select(column), column, "left_anti")
    )


def payroll_coverage(jobs: DataFrame, payroll: DataFrame, since: str) -> DataFrame:
    """Completed jobs per day, those with payroll, and the pay; lines are summed per job."""
    pay = (
        payroll.where(F.col("job_id").isNotNull())
        .groupBy(F.col("job_id").alias("id"))
        .agg(sum_money("amount").alias("pay"))
    )
    return (
        jobs.where(F.col("completed_on") >= utc_midnight(since))
        .join(pay, "id", "left")
        .groupBy(F.to_date("completed_on").alias("job_date"))
        .agg(
            F.countDistinct("id").alias("jobs_completed"),
            F.countDistinct(F.when(F.col("pay").isNotNull(), F.col("id"))).alias("jobs_with_payroll"),
            F.sum("pay").cast("double").alias("total_labor_cost"),
            rounded(ratio(F.sum("pay"), F.countDistinct("id"))).alias("labor_per_job"),
        )
    )
