"""Daily KPI tables: branches of measures per (day, unit), and ways to combine them."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldkpi.functions.constants import (
    BUSINESS_TZ,
    PRODUCED_STATUSES,
    PRODUCTION_SUFFIX,
    RECEIVABLE_FLOOR,
    SALES_SUFFIX,
    WARRANTY_JOB_TYPES,
)
from fieldkpi.functions.expr import (
    contains_ci,
    count_if,
    day_range,
    ends_with,
    is_test_name,
    local_date,
    local_day_range,
    monday_week,
    money,
    or_zero,
    percent,
    ratio,
    sum_if,
    sum_money,
    utc_midnight,
)
from fieldkpi.functions.frames import union_all
from fieldkpi.functions.joins import spread_join
from fieldkpi.operators import marts
from fieldkpi.sources import tables

KEYS = ("event_date", "business_unit")


# --- combining --------------------------------------------------------------------


def stack_max(branches: Iterable[DataFrame], keys: Sequence[str] = KEYS) -> DataFrame:
    """Branches padded with 0 and reduced by MAX.

    A negative measure turns to 0 where another branch has the same key; use
    ``stack_values`` unless that reading is wanted.
    """
    branches = list(branches)
    measures = _measures(branches, keys)
    padded = [
        b.select(
            *keys,
            *[
                (F.col(m) if m in b.columns else F.lit(0).cast(t)).alias(m)
                for m, t in measures.items()
            ],
        )
        for b in branches
    ]
    return union_all(padded).groupBy(*keys).agg(*[F.max(m).alias(m) for m in measures])


def stack_values(
    branches: Iterable[DataFrame], rates: Sequence[str] = (), keys: Sequence[str] = KEYS
) -> DataFrame:
    """Branches padded with null: sums and counts add up (0 where absent), rates stay as
    they are (null where absent).  One shuffle, however many branches there are."""
    branches = list(branches)
    measures = _measures(branches, keys)
    return union_all(branches, pad=True).groupBy(*keys).agg(
        *[
            F.max(m).alias(m) if m in rates else F.coalesce(F.sum(m), F.lit(0).cast(t)).alias(m)
            for m, t in measures.items()
        ]
    )


def spine(
    branches: Iterable[DataFrame],
    snapshots: Iterable[DataFrame] = (),
    *,
    keys: Sequence[str] = KEYS,
    unit: str = "business_unit",
    fill: bool = True,
) -> DataFrame:
    """Every key that any branch has, with the measures of all; 0 (or null) where absent.

    A branch has a key at most once, so the union of null-padded branches reduced per
    key equals the joins on a spine of distinct keys, in one shuffle.  Snapshots are
    per unit and join on the unit alone.
    """
    branches, snapshots = list(branches), list(snapshots)
    measures = _measures(branches, keys)
    out = union_all(branches, pad=True).groupBy(*keys).agg(*[F.max(m).alias(m) for m in measures])
    for s in snapshots:
        out = out.join(s, unit, "left")
        measures |= {c: t for c, t in s.dtypes if c != unit}
    if not fill:
        return out
    return out.withColumns({m: F.coalesce(m, F.lit(0).cast(t)) for m, t in measures.items()})


def _measures(branches: Sequence[DataFrame], keys: Sequence[str]) -> dict[str, str]:
    return {c: t for b in branches for c, t in b.dtypes if c not in keys}


# --- branches ---------------------------------------------------------------------


def unit_jobs(dim_jobs: DataFrame, suffix: str, type_ids: Sequence[int] = ()) -> DataFrame:
    rows = dim_jobs.where(ends_with("business_unit", suffix))
    if type_ids:
        rows = rows.where(F.col("job_type_id").isin(*type_ids))
    return rows


def _keys(day: Column) -> list[Column]:
    return [day.alias("event_date"), F.col("business_unit")]


def _named_jobs(jobs: DataFrame, *columns: str) -> DataFrame:
    return jobs.select(F.col("id").alias("job_id"), "business_unit", *columns)


def _costed_invoices(
    invoices: DataFrame, dim_jobs: DataFrame, cost_fact: DataFrame, since: str, suffix: str
) -> DataFrame:
    """Invoices with their job's unit, type and cost; jobs meet their cost first, one row
    to one."""
    jobs = _named_jobs(unit_jobs(dim_jobs, suffix), "job_type_name").join(
        cost_fact.select("job_id", "total_cost"), "job_id", "left"
    )
    dated = invoices.where(
        (F.col("invoice_date") >= utc_midnight(since)) & F.col("job_id").isNotNull()
    )
    return spread_join(dated, jobs, "job_id")


def invoice_margin(
    invoices: DataFrame,
    dim_jobs: DataFrame,
    cost_fact: DataFrame,
    since: str,
    *,
    excluded_types: Sequence[str],
    warranty_types: Sequence[str] = WARRANTY_JOB_TYPES,
    suffix: str = PRODUCTION_SUFFIX,
) -> DataFrame:
    """Produced dollars, margin and warranty share by invoice day, in one pass.

    A job's cost counts with each of its invoices.  The margin is null unless revenue
    is positive; warranty and its base include the excluded types.
    """
    rows = _costed_invoices(invoices, dim_jobs, cost_fact, since, suffix)
    included = ~F.coalesce(F.col("job_type_name").isin(*excluded_types), F.lit(False))
    warranty = F.col("job_type_name").isin(*warranty_types)
    cost = or_zero("total_cost")
    revenue = F.sum(F.when(included, money("total")))
    spent = F.sum(F.when(included, cost))
    all_revenue = sum_money("total")
    return (
        rows.groupBy(*_keys(F.to_date("invoice_date")))
        .agg(
            revenue.cast("double").alias("dollars_produced"),
            F.when(revenue > 0, ratio(revenue - spent, revenue) * 100.0).alias("gpm_percent"),
            F.when(
                all_revenue > 0, ratio(F.sum(F.when(warranty, cost).otherwise(F.lit(0))), all_revenue) * 100.0
            ).alias("warranty_percent"),
        )
    )


def collected(
    payments: DataFrame,
    invoices: DataFrame,
    dim_jobs: DataFrame,
    since: str | None = None,
    *,
    suffix: str = PRODUCTION_SUFFIX,
) -> DataFrame:
    rows = payments.where(F.col("created_on").isNotNull())
    if since is not None:
        rows = rows.where(F.col("created_on") >= utc_midnight(since))
    return (
        marts.payments_with_unit(rows, invoices, dim_jobs, unit_suffix=suffix)
        .groupBy(*_keys(F.to_date("created_on")))
        .agg(
            sum_money("amount").cast("double").alias("dollars_collected"),
            F.countDistinct("id").alias("payment_count"),
        )
    )


def mean_close_rate(
    estimates: DataFrame, dim_jobs: DataFrame, since: str, *, suffix: str = SALES_SUFFIX
) -> DataFrame:
    """Share of sold estimates by creation day."""
    jobs = unit_jobs(dim_jobs, suffix).where(contains_ci("job_type_name", "estimate"))
    sold = count_if(F.col("status") == "Sold")
    return (
        estimates.where(F.col("created_on") >= utc_midnight(since))
        .join(_named_jobs(jobs), "job_id")
        .groupBy(*_keys(F.to_date("created_on")))
        .agg((ratio(sold, F.count("*")) * 100.0).alias("close_rate_percent"))
    )


def _within(column: str, since: str, window: tuple[str, str] | None) -> Column:
    return F.col(column) >= utc_midnight(since) if window is None else day_range(column, *window) & (F.col(column) >= utc_midnight(since))


def _job_events(
    estimates: DataFrame, invoices: DataFrame, payments: DataFrame, since: str, as_of: str, floor: float, window: tuple[str, str] | None, tz: str
) -> DataFrame:
    """(job_id, event_date, kind, amount, n): what happened to a job on a day, summed per job, day and kind.

    Each source is read once; a date window is a range on its bare date columns.  What stands open, and what is booked
    ahead, has no day.  Summing before the jobs are met leaves a job with very many rows few of them.
    """
    sold_in = F.col("sold_on") >= utc_midnight(since)
    if window is not None:
        sold_in &= local_day_range("sold_on", *window, tz)
    is_sold = F.col("status") == "Sold"
    made_in = _within("created_on", since, window)

    def event(kind: str, day: Column, amount: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), day.alias("event_date"), money(amount).alias("amount"))

    def events(rows: DataFrame, *cases: tuple[Column, Column]) -> DataFrame:
        """The events of each row whose condition holds."""
        some = cases[0][0]
        for condition, _ in cases[1:]:
            some |= condition
        own = F.filter(F.array(*[F.when(c, e) for c, e in cases]), lambda x: x.isNotNull())
        return rows.where(F.col("job_id").isNotNull() & some).select("job_id", F.inline(own))

    no_day = F.lit(None).cast("date")
    ahead = (F.col("invoice_date") >= utc_midnight(marts.next_day(as_of))) & (F.col("invoice_date") < utc_midnight(marts.next_day(marts.plus_year(as_of))))
    paid_in = F.col("created_on").isNotNull() if window is None else day_range("created_on", *window)
    owner = invoices.where(F.col("job_id").isNotNull()).select(F.col("id").alias("invoice_id"), "job_id")
    parts = [
        events(
            estimates,
            (is_sold & sold_in, event("booked", local_date("sold_on", tz), F.col("subtotal"))),
            (made_in, event("made", F.to_date("created_on"), F.when(is_sold, 1).otherwise(0))),
        ),
        events(invoices, (_within("invoice_date", since, window), event("invoiced", F.to_date("invoice_date"), F.col("total")))),
        events(
            invoices,
            (ahead, event("ahead", no_day, F.col("total"))),
            (F.col("balance") >= floor, event("open", no_day, F.col("balance"))),
        ),
        events(payments.where(paid_in).join(owner, "invoice_id"), (F.lit(True), event("paid", F.to_date("created_on"), F.col("amount")))),
    ]
    return union_all(parts).groupBy("job_id", "event_date", "kind").agg(F.sum("amount").alias("amount"), F.count("*").alias("n"))


def _sales_days(dim_jobs: DataFrame, customers: DataFrame, since: str, window: tuple[str, str] | None, suffix: str) -> DataFrame:
    """Lead customers by creation day and completed estimates by completion day, from one pass over the jobs."""
    made, done = _within("created_on", since, window), _within("completed_on", since, window) & (F.col("job_status") == "Completed")
    names = customers.select(F.col("id").alias("customer_id"), F.col("name").alias("customer_name"))
    jobs = unit_jobs(dim_jobs, suffix).where(contains_ci("job_type_name", "estimate") & (made | done)).join(names, "customer_id", "left")
    none = F.lit(None).cast("bigint")
    days = F.array(
        F.when(made & ~is_test_name("customer_name"), F.struct(F.to_date("created_on").alias("event_date"), F.col("customer_id").alias("lead"), none.alias("done"))),
        F.when(done, F.struct(F.to_date("completed_on").alias("event_date"), none.alias("lead"), F.lit(1).cast("bigint").alias("done"))),
    )
    rows = jobs.select("business_unit", F.inline(F.filter(days, lambda x: x.isNotNull())))
    per_customer = rows.groupBy(*KEYS, "lead").agg(F.sum("done").alias("done"))
    return per_customer.groupBy(*KEYS).agg(F.count("lead").alias("lead_count"), F.sum("done").alias("num_estimates"))


def ten_kpis(
    dim_jobs: DataFrame,
    customers: DataFrame,
    estimates: DataFrame,
    invoices: DataFrame,
    payments: DataFrame,
    cost_fact: DataFrame,
    *,
    since: str,
    as_of: str,
    excluded_types: Sequence[str],
    warranty_types: Sequence[str] = WARRANTY_JOB_TYPES,
    floor: float = RECEIVABLE_FLOOR,
    window: tuple[str, str] | None = None,
    units: Sequence[str] = (),
    tz: str = BUSINESS_TZ,
) -> DataFrame:
    """The ten KPIs per day and unit; receivables and future bookings are snapshots per unit.

    All that happens to jobs is brought together per job and day, meets the jobs with their cost once, and is summed
    per day and unit.  ``window`` (both days included) reaches the scans, ``units`` the jobs.
    """
    if units:
        dim_jobs, cost_fact = (df.where(F.col("business_unit").isin(*units)) for df in (dim_jobs, cost_fact))
    events = _job_events(estimates, invoices, payments, since, as_of, floor, window, tz)
    jobs = cost_fact.select("job_id", "business_unit", F.col("job_type").alias("job_type_name"), or_zero("total_cost").alias("cost"))
    kind, amount, n = F.col("kind"), F.col("amount"), F.col("n")
    included = ~F.coalesce(F.col("job_type_name").isin(*excluded_types), F.lit(False))
    of_sales = ends_with("business_unit", SALES_SUFFIX) & (
        (kind == "booked") | ((kind == "made") & contains_ci("job_type_name", "estimate"))
    )
    of_production = ends_with("business_unit", PRODUCTION_SUFFIX) & (kind.isin("invoiced", "paid", "open") | ((kind == "ahead") & included))
    rows = events.join(jobs, "job_id").where(of_sales | of_production)

    def total(condition: Column, value: Column = amount) -> Column:
        return F.sum(F.when(condition, value))

    invoiced = kind == "invoiced"
    spent = F.col("cost") * n  # a job's cost counts with each of its invoices
    revenue, all_revenue = total(invoiced & included), total(invoiced)
    warranty = F.when(F.col("job_type_name").isin(*warranty_types), spent).otherwise(F.lit(0))
    made = rows.groupBy(*KEYS).agg(
        total(kind == "booked").cast("double").alias("total_booked"),
        revenue.cast("double").alias("dollars_produced"),
        F.when(revenue > 0, ratio(revenue - total(invoiced & included, spent), revenue) * 100.0).alias("gpm_percent"),
        F.when(all_revenue > 0, ratio(total(invoiced, warranty), all_revenue) * 100.0).alias("warranty_percent"),
        total(kind == "paid").cast("double").alias("dollars_collected"),
        (ratio(total(kind == "made"), total(kind == "made", n)) * 100.0).alias("close_rate_percent"),
        total(kind == "ahead").cast("double").alias("future_bookings"),
        total(kind == "open").cast("double").alias("outstanding_ar"),
    )
    both = spine([_sales_days(dim_jobs, customers, since, window, SALES_SUFFIX), made], fill=False)
    of_unit = Window.partitionBy("business_unit")  # a unit has a row for each day
    snapshots = {c: F.max(c).over(of_unit) for c in ("future_bookings", "outstanding_ar")}
    days = both.withColumns(snapshots).where(F.col("event_date").isNotNull())
    return days.withColumns({c: F.coalesce(c, F.lit(0).cast(t)) for c, t in days.dtypes if c not in KEYS})


def created_leads(
    dim_jobs: DataFrame, since: str, *, type_ids: Sequence[int], suffix: str = SALES_SUFFIX
) -> DataFrame:
    return (
        unit_jobs(dim_jobs, suffix, type_ids)
        .where(F.col("created_on") >= utc_midnight(since))
        .groupBy(*_keys(F.to_date("created_on")))
        .agg(F.countDistinct("id").alias("lead_count"))
    )


def _sales_rows(
    estimates: DataFrame, dim_jobs: DataFrame, type_ids: Sequence[int], suffix: str
) -> DataFrame:
    jobs = unit_jobs(dim_jobs, suffix)
    listed = F.col("job_type_id").isin(*type_ids) if type_ids else F.lit(True)
    return estimates.join(
        jobs.select(
            F.col("id").alias("job_id"),
            "business_unit",
            "customer_id",
            F.coalesce(listed, F.lit(False)).alias("listed"),
        ),
        "job_id",
    ).withColumn("amount", F.coalesce(money("total"), money("subtotal")))


def sales_by_own_date(
    estimates: DataFrame,
    dim_jobs: DataFrame,
    since: str,
    *,
    type_ids: Sequence[int],
    suffix: str = SALES_SUFFIX,
) -> DataFrame:
    """Estimates by creation day, opportunities and revenue by sale day, in one pass:
    each estimate is counted once per date it has."""
    dates = F.array(
        F.struct(F.lit("made").alias("basis"), F.col("created_on").alias("at")),
        F.struct(F.lit("sold").alias("basis"), F.col("sold_on").alias("at")),
    )
    rows = (
        _sales_rows(estimates, dim_jobs, type_ids, suffix)
        .select("business_unit", "job_id", "id", "status", "amount", "listed", F.inline(dates))
        .where(F.col("at") >= utc_midnight(since))
    )
    is_sale, closed = F.col("basis") == "sold", F.col("status") == "Sold"
    listed = F.col("listed")
    offered = F.countDistinct(F.when(is_sale & listed, F.col("job_id")))
    won = F.countDistinct(F.when(is_sale & listed & closed, F.col("job_id")))
    return rows.groupBy(*_keys(F.to_date("at"))).agg(
        F.countDistinct(F.when(~is_sale & listed, F.col("id"))).alias("estimate_count"),
        offered.alias("sales_opportunities"),
        won.alias("closed_opportunities"),
        ratio(won, offered).alias("close_rate"),
        F.sum(F.when(is_sale & closed, F.col("amount"))).cast("double").alias("total_booked"),
    ).where(
        (F.col("estimate_count") > 0)
        | (F.col("sales_opportunities") > 0)
        | F.col("total_booked").isNotNull()
    )


def made_estimates(
    estimates: DataFrame, dim_jobs: DataFrame, since: str, *, type_ids: Sequence[int], suffix: str = SALES_SUFFIX
) -> DataFrame:
    rows = _sales_rows(estimates, dim_jobs, type_ids, suffix).where("listed")
    return (
        rows.where(F.col("created_on") >= utc_midnight(since))
        .groupBy(*_keys(F.to_date("created_on")))
        .agg(F.countDistinct("id").alias("estimate_count"))
    )


def sold_close_rate(
    estimates: DataFrame, dim_jobs: DataFrame, since: str, *, type_ids: Sequence[int], suffix: str = SALES_SUFFIX
) -> DataFrame:
    rows = _sales_rows(estimates, dim_jobs, type_ids, suffix).where("listed")
    offered = F.countDistinct("job_id")
    won = F.countDistinct(F.when(F.col("status") == "Sold", F.col("job_id")))
    return (
        rows.where(F.col("sold_on") >= utc_midnight(since))
        .groupBy(*_keys(F.to_date("sold_on")))
        .agg(
            offered.alias("sales_opportunities"),
            won.alias("closed_opportunities"),
            ratio(won, offered).alias("close_rate"),
        )
    )


def sold_revenue(
    estimates: DataFrame, dim_jobs: DataFrame, since: str, *, suffix: str = SALES_SUFFIX
) -> DataFrame:
    return (
        _sales_rows(estimates, dim_jobs, (), suffix)
        .where((F.col("status") == "Sold") & (F.col("sold_on") >= utc_midnight(since)))
        .groupBy(*_keys(F.to_date("sold_on")))
        .agg(F.sum("amount").cast("double").alias("total_booked"))
    )


def sold_sales(
    estimates: DataFrame,
    dim_jobs: DataFrame,
    *,
    close_by: str = "job_id",
    suffix: str = SALES_SUFFIX,
) -> DataFrame:
    """Sold estimates only, so its close rate is 1 by construction."""
    rows = _sales_rows(estimates, dim_jobs, (), suffix).where(
        (F.col("status") == "Sold") & F.col("sold_on").isNotNull()
    )
    offered = F.countDistinct(close_by)
    won = F.countDistinct(F.when(F.col("status") == "Sold", F.col(close_by)))
    return rows.groupBy(*_keys(F.to_date("sold_on"))).agg(
        F.countDistinct("job_id").alias("lead_count"),
        F.countDistinct("id").alias("estimate_count"),
        F.sum("amount").cast("double").alias("total_booked"),
        ratio(won, offered).alias("close_rate"),
    )


def created_sales(
    estimates: DataFrame, dim_jobs: DataFrame, since: str, *, suffix: str = SALES_SUFFIX
) -> DataFrame:
    """All estimates by creation day; leads and close rate count customers."""
    sold = F.col("status") == "Sold"
    offered = F.countDistinct("customer_id")
    won = F.countDistinct(F.when(sold, F.col("customer_id")))
    return (
        _sales_rows(estimates, dim_jobs, (), suffix)
        .where(F.col("created_on") >= utc_midnight(since))
        .groupBy(*_keys(F.to_date("created_on")))
        .agg(
            offered.alias("lead_count"),
            F.countDistinct("id").alias("estimate_count"),
            sum_if(sold, "amount").cast("double").alias("total_booked"),
            ratio(won, offered).alias("close_rate"),
        )
    )


def job_opportunities(
    estimates: DataFrame, dim_jobs: DataFrame, since: str, *, suffix: str = SALES_SUFFIX
) -> DataFrame:
    """All sales jobs by creation day with what became of them.

    The estimates are rolled up per job first; an estimate id belongs to one job, so
    distinct ids per job add up.
    """
    per_job = (
        estimates.where(F.col("job_id").isNotNull())
        .groupBy("job_id")
        .agg(
            F.countDistinct("id").alias("n"),
            F.max(F.col("status") == "Sold").alias("is_sold"),
        )
    )
    jobs = unit_jobs(dim_jobs, suffix).where(F.col("created_on") >= utc_midnight(since))
    offered, won = F.countDistinct("job_id"), F.countDistinct(F.when(F.col("is_sold"), F.col("job_id")))
    return (
        _named_jobs(jobs, "created_on")
        .join(per_job, "job_id", "left")
        .groupBy(*_keys(F.to_date("created_on")))
        .agg(
            offered.alias("lead_count"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("estimate_count"),
            ratio(won, offered).alias("close_rate"),
        )
    )


def production_kpis(
    job_costing: DataFrame,
    since: str | None = None,
    *,
    statuses: Sequence[str] = PRODUCED_STATUSES,
    suffix: str = PRODUCTION_SUFFIX,
    positive_revenue_margin: bool = False,
) -> DataFrame:
    """From job costing by start day; optionally the margin of jobs with revenue only."""
    rows = job_costing.where(
        ends_with("business_unit", suffix) & F.col("job_status").isin(*statuses)
    )
    if since is not None:
        rows = rows.where(F.col("job_start_date") >= utc_midnight(since))
    earning = F.col("revenue_subtotal") > 0
    revenue = sum_money("revenue_subtotal")
    if positive_revenue_margin:
        margin = ratio(sum_if(earning, "gross_profit"), sum_if(earning, "revenue_subtotal"))
    else:
        margin = ratio(sum_money("gross_profit"), revenue)
    return rows.groupBy(*_keys(F.to_date("job_start_date"))).agg(
        revenue.cast("double").alias("dollars_produced"),
        (margin * 100.0).alias("gpm_percent"),
        (ratio(sum_if(F.col("is_warranty"), "total_cost"), revenue) * 100.0).alias("warranty_percent"),
        ratio(revenue, sum_money("labor_cost")).alias("labor_efficiency"),
        (ratio(sum_money("material_cost_net"), revenue) * 100.0).alias("material_cost_percent"),
        F.countDistinct("job_id").alias("completed_job_count"),
        F.countDistinct(F.when(F.col("is_warranty"), F.col("job_id"))).alias("warranty_job_count"),
    )


RATES = (
    "close_rate",
    "gpm_percent",
    "warranty_percent",
    "labor_efficiency",
    "material_cost_percent",
)


# --- other definitions ------------------------------------------------------------


def margin_two_ways(
    job_costing: DataFrame,
    start: str,
    end: str,
    *,
    statuses: Sequence[str] = PRODUCED_STATUSES,
    suffix: str = PRODUCTION_SUFFIX,
) -> DataFrame:
    """Mean of the jobs' margins beside the margin of the sums."""
    rows = job_costing.where(
        ends_with("business_unit", suffix)
        & F.col("job_status").isin(*statuses)
        & F.to_date("job_start_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    )
    each = F.col("gpm_percent").cast("decimal(28,6)")
    return rows.groupBy("business_unit").agg(
        F.round(ratio(F.sum(each), F.count(each)).cast("decimal(38,6)"), 2).cast("double").alias("gpm_average"),
        percent(sum_money("gross_profit"), sum_money("revenue_subtotal")).alias("gpm_weighted"),
    )


def report_leads(
    dim_jobs: DataFrame,
    customers: DataFrame,
    start: str,
    end: str,
    *,
    excluded: str = "comm",
    suffix: str = SALES_SUFFIX,
) -> DataFrame:
    """As the leads report counts: distinct customer names, commercial types left out."""
    names = customers.select(F.col("id").alias("customer_id"), F.col("name").alias("customer_name"))
    return (
        unit_jobs(dim_jobs, suffix)
        .where(
            contains_ci("job_type_name", "estimate")
            & ~contains_ci("job_type_name", excluded)
            & day_range("created_on", start, end)
        )
        .join(names, "customer_id", "left")
        .where(~is_test_name("customer_name"))
        .groupBy("business_unit")
        .agg(F.countDistinct("customer_name").alias("lead_count"))
    )


def report_warranty(
    job_costing: DataFrame,
    start: str,
    end: str,
    *,
    excluded_types: Sequence[str],
    warranty_types: Sequence[str] = WARRANTY_JOB_TYPES,
    suffix: str = PRODUCTION_SUFFIX,
) -> DataFrame:
    """Cost of warranty jobs over produced dollars, units with warranty jobs only."""
    rows = job_costing.where(
        ends_with("business_unit", suffix)
        & F.to_date("job_start_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    )
    warranty = F.col("job_type").isin(*warranty_types)
    included = ~F.coalesce(F.col("job_type").isin(*excluded_types), F.lit(False))
    cost, produced = sum_if(warranty, "total_cost"), sum_if(included, "revenue_subtotal")
    return (
        rows.groupBy("business_unit")
        .agg(
            count_if(warranty).alias("warranty_jobs"),
            cost.cast("double").alias("warranty_cost"),
            produced.cast("double").alias("dollars_produced"),
            percent(cost, produced).alias("warranty_percent"),
        )
        .where("warranty_jobs > 0")
    )


def report_receivables(
    report: DataFrame, *, floor: float = RECEIVABLE_FLOOR, excluded_location: str = "Name"
) -> DataFrame:
    """The receivables report: real locations, amounts from the floor on."""
    return (
        report.where(
            F.col("location_name").isNotNull()
            & (F.col("location_name") != excluded_location)
            & (F.col("net_amount") >= floor)
        )
        .groupBy("bu_key")
        .agg(sum_money("net_amount").cast("double").alias("outstanding_ar"))
    )


def report_future_bookings(
    job_costing: DataFrame,
    as_of: str,
    *,
    excluded_types: Sequence[str],
    suffix: str = PRODUCTION_SUFFIX,
) -> DataFrame:
    """Jobs that start from the Monday of ``as_of``'s week to a year after."""
    monday = monday_week(F.lit(as_of).cast("date"))
    start = F.to_date("job_start_date")
    return (
        job_costing.where(
            ends_with("business_unit", suffix)
            & (start >= monday)
            & (start <= F.add_months(monday, 12))
            & ~F.coalesce(F.col("job_type").isin(*excluded_types), F.lit(False))
        )
        .groupBy("business_unit")
        .agg(sum_money("revenue_subtotal").cast("double").alias("future_bookings"))
    )


def refresh_all(named: dict[str, Callable[[], DataFrame]], folder: str) -> list[dict[str, object]]:
    """Rebuild marts one after the other; a failing mart is reported with its message, the rest go on.

    Each mart is one Spark job; only its row count and the seconds it took come back.
    """
    report = []
    for name, build in named.items():
        began = time.monotonic()
        try:
            rows = build()
            version = tables.publish(rows, f"{folder}/{name}")
            outcome = {"status": "ok", "rows": rows.sparkSession.read.parquet(version).count(), "error": None}
        except Exception as error:  # noqa: BLE001
            outcome = {"status": "error", "rows": None, "error": str(error).split("\n")[0] or type(error).__name__}
        report.append({"mart": name, **outcome, "seconds": time.monotonic() - began})
    return report
