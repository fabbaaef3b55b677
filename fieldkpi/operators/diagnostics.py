"""Diagnostic breakdowns: which definition of a figure gives which number."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldkpi.functions.constants import (
    BUSINESS_TZ,
    CANCELED_ORDER_STATUS,
    KNOWN_ITEM_TYPES,
    MATERIAL_ITEM_TYPES,
)
from fieldkpi.functions.expr import (
    contains_ci,
    count_if,
    day_range,
    is_test_name,
    json_items,
    local_date,
    local_day_range,
    money,
    or_zero,
    percent,
    ratio,
    rounded,
    sum_money,
)
from fieldkpi.functions.frames import labelled_rows, union_all
from fieldkpi.operators.costing import invoice_items


# --- populations ------------------------------------------------------------------------


def population_by_date_basis(
    jobs: DataFrame,
    appointments: DataFrame,
    invoices: DataFrame,
    purchase_orders: DataFrame,
    payroll: DataFrame,
    production: DataFrame,
    start: str,
    end: str,
    target: int,
    *,
    statuses: Sequence[str] = ("Completed", "Hold", "Scheduled", "InProgress"),
) -> DataFrame:
    """Jobs in a window by each date that could define it, nearest to the target first.

    Each child table is reduced once to one row per job with a flag per date, and all
    variants are counted in one pass over the jobs.
    """

    def any_in(c: str) -> Column:
        return F.max(F.coalesce(day_range(c, start, end), F.lit(False)))

    def flags(df: DataFrame, **columns: str) -> DataFrame:
        return (
            df.where(F.col("job_id").isNotNull())
            .groupBy(F.col("job_id").alias("id"))
            .agg(*[any_in(c).alias(name) for name, c in columns.items()])
        )

    view = (
        production.where(F.to_date("start_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
        .select(F.col("job_id").alias("id"), F.lit(True).alias("in_view"))
        .distinct()
    )
    rows = (
        jobs.join(flags(appointments, appt="scheduled_start"), "id", "left")
        .join(flags(invoices, inv_date="invoice_date", inv_made="created_on", inv_changed="modified_on"), "id", "left")
        .join(flags(purchase_orders, po="date"), "id", "left")
        .join(flags(payroll, pay="date"), "id", "left")
        .join(view, "id", "left")
        .withColumn("active", F.col("job_status").isin(*statuses))
        .withColumn("done", F.coalesce(day_range("completed_on", start, end), F.lit(False)))
        .withColumn("made", F.coalesce(day_range("created_on", start, end), F.lit(False)))
    )
    for c in ("appt", "inv_date", "inv_made", "inv_changed", "po", "pay", "in_view"):
        rows = rows.withColumn(c, F.coalesce(c, F.lit(False)))
    active = F.col("active")
    variants = {
        "completedOn": active & F.col("done"),
        "createdOn": active & F.col("made"),
        "appointment_scheduledStart": active & F.col("appt"),
        "invoiceDate": active & F.col("inv_date"),
        "invoice_createdOn": active & F.col("inv_made"),
        "invoice_modifiedOn": active & F.col("inv_changed"),
        "appointment_or_completed": active & (F.col("appt") | F.col("done")),
        "invoiceDate_all_statuses": F.col("inv_date"),
        "production_jobs_view": F.col("in_view"),
        "any_financial_activity": F.col("inv_date") | F.col("po") | F.col("pay"),
    }
    # per unit first: a unit counts where any of its jobs does, without a copy of the rows for each variant
    per_unit = rows.groupBy("business_unit_id").agg(*[count_if(test).alias(f"n{i}") for i, test in enumerate(variants.values())])
    known = F.col("business_unit_id").isNotNull()
    totals = per_unit.agg(
        *[F.sum(f"n{i}").alias(f"n{i}") for i in range(len(variants))],
        *[count_if(known & (F.col(f"n{i}") > 0)).alias(f"u{i}") for i in range(len(variants))],
    )
    out = labelled_rows(
        totals,
        "variant",
        [(v, {"job_count": F.col(f"n{i}"), "bu_count": F.col(f"u{i}")}) for i, v in enumerate(variants)],
    )
    return out.withColumn("off_target", F.abs(F.col("job_count") - target)).orderBy("off_target", "variant")


def lead_funnel(
    dim_jobs: DataFrame, customers: DataFrame, start: str, end: str, unit: str, *, tz: str = BUSINESS_TZ
) -> DataFrame:
    """Jobs and customers left after each filter of the lead definition, in one pass."""
    names = customers.select(F.col("id").alias("customer_id"), F.col("name").alias("customer_name"))
    rows = dim_jobs.where(local_day_range("created_on", start, end, tz)).join(names, "customer_id", "left")
    in_unit = F.col("business_unit") == unit
    estimate = in_unit & contains_ci("job_type_name", "estimate")
    real = estimate & ~is_test_name("customer_name")
    steps = [("Jobs created", F.lit(True)), ("In unit", in_unit), ("Estimate jobs", estimate), ("Real customers", real)]
    # the steps that a job passes are bits; a customer has those of all their jobs
    bits = reduce(lambda x, y: x.bitwiseOR(y), [F.when(test, 1 << i).otherwise(0) for i, (_, test) in enumerate(steps)])
    per_customer = rows.groupBy("customer_id").agg(F.bit_or(bits).alias("bits"), *[count_if(test).alias(f"n{i}") for i, (_, test) in enumerate(steps)])
    known = F.col("customer_id").isNotNull()
    totals = per_customer.agg(
        *[F.sum(f"n{i}").alias(f"n{i}") for i in range(len(steps))],
        *[count_if(known & (F.col("bits").bitwiseAND(1 << i) > 0)).alias(f"c{i}") for i in range(len(steps))],
    )
    return labelled_rows(
        totals,
        "step",
        [(s, {"jobs": F.col(f"n{i}"), "unique_customers": F.col(f"c{i}")}) for i, (s, _) in enumerate(steps)],
    )


def booked_by_basis(
    invoices: DataFrame, estimates: DataFrame, dim_jobs: DataFrame, wanted: DataFrame
) -> DataFrame:
    """Booked dollars per wanted (event_date, business_unit, expected) by date basis and
    filter, with the distance to the expected figure.

    Every source is joined and scanned once; its filters are conditions of one grouping.
    """
    jobs = dim_jobs.select(
        F.col("id").alias("job_id"), "business_unit", "job_type_name", "job_status", "completed_on"
    ).join(wanted.select("business_unit").distinct(), "business_unit", "left_semi")
    commercial = F.coalesce(F.upper("job_type_name").like("%COMM%"), F.lit(False))
    estimate = F.coalesce(contains_ci("job_type_name", "estimate"), F.lit(False))

    def variants(
        rows: DataFrame, basis: str, day: str, amount: str, filters: dict[str, Column], documents: Column
    ) -> DataFrame:
        tagged = rows.select(
            F.to_date(day).alias("event_date"), "business_unit", "job_id", F.col(amount).alias("amount"), "doc",
            F.explode(F.array_compact(F.array(*[F.when(test, F.lit(n)) for n, test in filters.items()]))).alias("filter_desc"),
        )
        return (
            tagged.join(wanted.select("event_date", "business_unit"), ["event_date", "business_unit"], "left_semi")
            .groupBy("event_date", "business_unit", F.lit(basis).alias("basis"), "filter_desc")
            .agg(
                F.sum("amount").cast("decimal(38,4)").alias("amount"),
                documents.cast("bigint").alias("num_documents"),
                F.countDistinct("job_id").alias("num_jobs"),
            )
        )

    invoiced = invoices.withColumn("doc", F.col("id")).join(jobs, "job_id")
    sold = estimates.where(F.col("status") == "Sold").withColumn("doc", F.col("id")).join(jobs, "job_id")
    per_job = invoices.where(F.col("job_id").isNotNull()).groupBy("job_id").agg(
        sum_money("total").alias("total"), F.countDistinct("id").alias("documents")
    )
    finished = jobs.where(F.col("job_status") == "Completed").join(per_job, "job_id", "left")
    found = union_all(
        [
            variants(invoiced, "invoice_date", "invoice_date", "total",
                     {"all_jobs": F.lit(True), "exclude_comm": ~commercial}, F.countDistinct("doc")),
            variants(sold, "estimate_created", "created_on", "subtotal",
                     {"all_sold": F.lit(True), "sold_no_comm": ~commercial, "sold_estimate_jobs": estimate}, F.countDistinct("doc")),
            variants(finished.withColumnRenamed("documents", "doc"), "job_completed", "completed_on", "total",
                     {"all_jobs": F.lit(True), "estimate_jobs": estimate}, F.coalesce(F.sum("doc"), F.lit(0))),
        ]
    )
    booked = F.round(F.coalesce("amount", F.lit(0)), 2).cast("double")
    return found.join(wanted, ["event_date", "business_unit"]).select(
        "event_date", "business_unit", "basis", "filter_desc",
        booked.alias("total_booked"), "num_documents", "num_jobs",
        rounded(booked - F.col("expected")).alias("delta"),
    )


# --- materials ------------------------------------------------------------------------


def _listed(df: DataFrame, job_list: DataFrame) -> DataFrame:
    return df.join(job_list.select("job_id").distinct(), "job_id", "left_semi")


def _open_orders(orders: DataFrame, job_list: DataFrame) -> DataFrame:
    return _listed(orders.where(F.col("status") != CANCELED_ORDER_STATUS), job_list)


def material_components(
    job_list: DataFrame, orders: DataFrame, invoices: DataFrame, returns: DataFrame
) -> DataFrame:
    """Parts of the material cost of the listed jobs: orders, items by type, returns."""
    n = F.col("n")
    po = _open_orders(orders, job_list).agg(
        F.count("*").alias("n"), *[sum_money(c).alias(c) for c in ("subtotal", "tax", "shipping", "discount", "total")]
    )
    po_rows = labelled_rows(po, "component", [
        ("PO Subtotal", {"amount": F.col("subtotal"), "count": n}),
        ("PO Tax", {"amount": F.col("tax"), "count": n}),
        ("PO Shipping", {"amount": F.col("shipping"), "count": n}),
        ("PO Discount (negative)", {"amount": -F.col("discount"), "count": n}),
        ("PO Total (header)", {"amount": F.col("total"), "count": n}),
    ])
    items = invoice_items(_listed(invoices, job_list))
    material = F.col("type").isin(*MATERIAL_ITEM_TYPES)
    by_type = items.groupBy("type").agg(
        F.sum("cost").alias("cost"), F.sum("total").alias("price"), F.count("*").alias("n")
    )
    kinds = by_type.where(material | ~F.col("type").isin(*KNOWN_ITEM_TYPES)).select(
        F.when(material, F.concat(F.lit("Invoice "), "type", F.lit(" Cost")))
        .otherwise(F.concat(F.lit("Invoice Type: "), "type"))
        .alias("component"),
        F.col("cost").alias("amount"),
        F.col("n").alias("count"),
    )
    price = by_type.where(material).agg(
        F.lit("Invoice Material Total (price)").alias("component"),
        F.sum("price").alias("amount"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("count"),
    )
    back = _listed(returns, job_list).agg(
        F.count("*").alias("n"), *[sum_money(c).alias(c) for c in ("subtotal", "tax", "total")]
    )
    back_rows = labelled_rows(back, "component", [
        ("Returns Subtotal (credit)", {"amount": -F.col("subtotal"), "count": n}),
        ("Returns Tax (credit)", {"amount": -F.col("tax"), "count": n}),
        ("Returns Total (credit)", {"amount": -F.col("total"), "count": n}),
    ])
    parts = [p.withColumn("amount", F.col("amount").cast("decimal(38,4)")) for p in (po_rows, kinds, price, back_rows)]
    name = F.col("component")
    return (
        union_all(parts)
        .where(F.coalesce("amount", F.lit(0)) != 0)
        .select(
            "component",
            F.round("amount", 2).cast("double").alias("amount"),
            "count",
            F.when(name.like("%Total%"), "Total")
            .when(name.like("%Tax%") | name.like("%Shipping%") | name.like("%Discount%"), "Adjustment")
            .when(name.like("%Returns%"), "Credit")
            .otherwise("Cost")
            .alias("category"),
        )
    )


def order_items(orders: DataFrame) -> DataFrame:
    """Line totals of purchase orders, per job."""
    return (
        orders.select("job_id", F.explode(json_items("items", "total string")).alias("i"))
        .groupBy("job_id")
        .agg(F.sum(F.col("i.total").try_cast("decimal(18,4)")).alias("items_total"))
    )


def _header(orders: DataFrame, *extra: Column) -> DataFrame:
    return orders.groupBy("job_id").agg(sum_money("total").alias("header_total"), *extra)


def order_header_vs_items(job_list: DataFrame, orders: DataFrame) -> DataFrame:
    rows = _open_orders(orders, job_list)
    both = _header(rows).join(order_items(rows), "job_id", "full")
    header, items = or_zero("header_total"), or_zero("items_total")
    totals = both.agg(
        F.sum(header).alias("h"), F.sum(items).alias("i"), F.sum(header - items).alias("d"),
        count_if((header > 0) | (items > 0)).alias("n"),
    )
    return labelled_rows(totals, "metric", [
        ("Total PO Header", {"amount": F.round("h", 2).cast("double")}),
        ("Total PO Items", {"amount": F.round("i", 2).cast("double")}),
        ("Difference (Tax/Shipping/Discount)", {"amount": F.round("d", 2).cast("double")}),
        ("Jobs with POs", {"amount": F.col("n").cast("double")}),
    ])


def material_scenarios(
    job_list: DataFrame, orders: DataFrame, invoices: DataFrame, target: float
) -> DataFrame:
    """Three ways to cost materials, and what each lacks to the target."""
    rows = _open_orders(orders, job_list)
    items = invoice_items(_listed(invoices, job_list)).where(F.col("type").isin(*MATERIAL_ITEM_TYPES))
    extras = F.sum(money("tax") + money("shipping")).alias("tax_ship")
    joined = (
        job_list.select("job_id").distinct()
        .join(_header(rows, extras), "job_id", "left")
        .join(order_items(rows), "job_id", "left")
        .join(items.groupBy("job_id").agg(F.sum("cost").alias("invoice")), "job_id", "left")
    )
    totals = joined.agg(*[F.sum(or_zero(c)).alias(c) for c in ("header_total", "items_total", "tax_ship", "invoice")])

    def entry(amount: Column) -> dict[str, Column]:
        return {
            "total_materials": F.round(amount, 2).cast("double"),
            "gap_to_target": F.round(F.lit(target).cast("decimal(18,4)") - amount, 2).cast("double"),
        }

    invoice = F.col("invoice")
    return labelled_rows(totals, "scenario", [
        ("PO header + invoice materials", entry(F.col("header_total") + invoice)),
        ("PO items + invoice materials", entry(F.col("items_total") + invoice)),
        ("PO items + tax/shipping + invoice materials", entry(F.col("items_total") + F.col("tax_ship") + invoice)),
    ])


def material_sources(
    job_list: DataFrame, orders: DataFrame, invoices: DataFrame, returns: DataFrame, payments: DataFrame
) -> DataFrame:
    """One row per source of material cost, payments for reference."""
    zero = F.lit(0).cast("decimal(18,4)")

    def summary(df: DataFrame, source: str, key: str, total: Column, tax: Column, ship: Column, sub: Column) -> DataFrame:
        return df.agg(
            F.countDistinct(key).alias("job_count"), F.count("*").alias("record_count"),
            F.sum(total).alias("t"), F.sum(tax).alias("x"), F.sum(ship).alias("s"), F.sum(sub).alias("b"),
        ).select(
            F.lit(source).alias("source"), "job_count", "record_count",
            *[F.round(c, 2).cast("double").alias(n) for c, n in
              (("t", "total_amount"), ("x", "tax_amount"), ("s", "shipping_amount"), ("b", "subtotal_amount"))],
        )

    listed_invoices = _listed(invoices, job_list)
    items = invoice_items(listed_invoices).where(F.col("type").isin(*MATERIAL_ITEM_TYPES))
    paid = payments.join(listed_invoices.select(F.col("id").alias("invoice_id")), "invoice_id", "left_semi")
    return union_all([
        summary(_open_orders(orders, job_list), "Purchase Orders", "job_id", money("total"), money("tax"), money("shipping"), money("subtotal")),
        summary(items, "Invoice Materials/Equipment", "job_id", F.col("cost"), zero, zero, F.col("total")),
        summary(_listed(returns, job_list), "Returns (negative)", "job_id", -money("total"), -money("tax"), zero, -money("subtotal")),
        summary(paid, "Payments (for reference)", "invoice_id", money("amount"), zero, zero, zero),
    ])


# --- job lists --------------------------------------------------------------------------


def appointment_facts(
    job_list: DataFrame, jobs: DataFrame, appointments: DataFrame, costing: DataFrame, *, tz: str = BUSINESS_TZ
) -> DataFrame:
    """Appointments of the listed jobs, and whether the job is in the costing table.

    The date list has each local day once, so it is bounded by the calendar.
    """
    facts = _listed(appointments, job_list).groupBy("job_id").agg(
        F.count("id").alias("appt_count"),
        F.min("scheduled_start").alias("first_scheduled"),
        F.max("scheduled_start").alias("last_scheduled"),
        F.array_join(
            F.sort_array(F.collect_set(local_date("scheduled_start", tz).cast("string"))), ", "
        ).alias("all_dates"),
    )
    costed = costing.select("job_id", F.lit(True).alias("c"))
    return (
        _listed(jobs.select(F.col("id").alias("job_id"), "job_status", "created_on", "completed_on"), job_list)
        .join(facts, "job_id", "left")
        .join(costed, "job_id", "left")
        .select(
            "job_id", "job_status", "created_on", "completed_on",
            F.coalesce("appt_count", F.lit(0)).alias("appt_count"),
            "first_scheduled", "last_scheduled", "all_dates",
            F.col("c").isNotNull().alias("in_costing"),
        )
    )


def status_profile(
    job_list: DataFrame, jobs: DataFrame, appointments: DataFrame, invoices: DataFrame
) -> DataFrame:
    """Per job status: how many listed jobs have each date, and its range.  Only rows of listed jobs are grouped."""
    appt = _listed(appointments, job_list).groupBy("job_id").agg(F.to_date(F.min("scheduled_start")).alias("appt"))
    inv = _listed(invoices, job_list).groupBy("job_id").agg(
        F.to_date(F.min("invoice_date")).alias("inv")
    )
    rows = (
        _listed(jobs.select(F.col("id").alias("job_id"), "job_status", F.to_date("completed_on").alias("comp")), job_list)
        .join(appt, "job_id", "left")
        .join(inv, "job_id", "left")
    )
    return rows.groupBy("job_status").agg(
        F.count("*").alias("job_count"),
        F.count("comp").alias("has_completed"),
        F.count("appt").alias("has_appointment"),
        F.count("inv").alias("has_invoice"),
        *[f(c).alias(f"{n}_{c}_date") for c in ("appt", "inv", "comp") for n, f in (("min", F.min), ("max", F.max))],
    )


# --- definitions ------------------------------------------------------------------------


def old_vs_new_leads(dim_jobs: DataFrame, customers: DataFrame, start: str, end: str, *, suffix: str = "-Sales") -> DataFrame:
    """Lead customers by the old rule (no commercial types) and the new one, in one pass."""
    names = customers.select(F.col("id").alias("customer_id"), F.col("name").alias("customer_name"))
    rows = (
        dim_jobs.where(day_range("created_on", start, end) & F.col("business_unit").like(f"%{suffix}"))
        .join(names, "customer_id", "left")
    )
    old = ~F.col("job_type_name").like("%COMM%")
    new = contains_ci("job_type_name", "estimate") & ~is_test_name("customer_name")
    a = F.countDistinct(F.when(old, F.col("customer_id")))
    b = F.countDistinct(F.when(new, F.col("customer_id")))
    return (
        rows.where(old | new)
        .groupBy("business_unit")
        .agg(a.alias("old_lead_count"), b.alias("new_lead_count"))
        .withColumn("delta", F.col("new_lead_count") - F.col("old_lead_count"))
        .withColumn(
            "pct_change",
            percent("delta", F.when(F.col("old_lead_count") == 0, F.lit(1)).otherwise(F.col("old_lead_count"))),
        )
    )


def booked_definitions(
    estimates: DataFrame, dim_jobs: DataFrame, invoices: DataFrame, start: str, end: str, *, tz: str = BUSINESS_TZ
) -> DataFrame:
    """Total booked by sale date, by completion of the job, and by its invoices."""
    amount = F.coalesce(money("total"), money("subtotal"))
    done = dim_jobs.where(
        local_day_range("completed_on", start, end, tz) & contains_ci("job_type_name", "estimate")
    ).select(F.col("id").alias("job_id"), "job_status")
    sold = F.col("status") == "Sold"
    complete = F.col("job_status") == "Completed"

    def method(df: DataFrame, label: str, value: Column) -> DataFrame:
        return df.agg(
            F.countDistinct("id").alias("estimate_count"),
            F.round(F.sum(value), 2).cast("double").alias("total_booked"),
        ).select(F.lit(label).alias("method"), "*")

    of_done = estimates.join(done, "job_id")
    return union_all([
        method(estimates.where(sold & local_day_range("sold_on", start, end, tz)), "Sold in window", amount),
        method(of_done.where(sold), "Sold, job completed in window", amount),
        method(of_done.where(complete), "All estimates of completed jobs", amount),
        method(invoices.join(done, "job_id").where(complete), "Invoices of completed jobs", money("total")),
    ])


def close_rate_definitions(
    opportunities: DataFrame, dim_jobs: DataFrame, estimates: DataFrame, start: str, end: str, *, tz: str = BUSINESS_TZ
) -> DataFrame:
    window = F.col("opportunity_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    offered, closed = count_if(F.col("is_sales_opportunity")), count_if(F.col("is_closed_opportunity"))
    current = opportunities.where(window).agg(
        F.count("*").alias("total_jobs"), offered.alias("sales_opps"), closed.alias("closed_opps"),
        percent(closed, offered).alias("close_rate"),
    )
    won = estimates.where(F.col("status") == "Sold").select(F.col("job_id").alias("id")).distinct()
    rows = dim_jobs.where(
        local_day_range("completed_on", start, end, tz)
        & contains_ci("job_type_name", "estimate")
        & (F.col("job_status") == "Completed")
        & ~contains_ci("job_type_name", "commercial")
    ).join(won.withColumn("won", F.lit(True)), "id", "left")
    n, w = F.countDistinct("id"), count_if(F.col("won"))
    completed = rows.agg(
        n.alias("total_jobs"), n.alias("sales_opps"), w.alias("closed_opps"), percent(w, n).alias("close_rate")
    )
    return union_all([
        current.select(F.lit("Current rule").alias("method"), "*"),
        completed.select(F.lit("Completed estimate jobs").alias("method"), "*"),
    ])


def close_rate_by_unit(dim_jobs: DataFrame, estimates: DataFrame, start: str, end: str, *, tz: str = BUSINESS_TZ) -> DataFrame:
    sold = F.col("status") == "Sold"
    amount = F.coalesce(money("total"), money("subtotal"))
    per_job = estimates.where(sold & F.col("job_id").isNotNull()).groupBy(F.col("job_id").alias("id")).agg(
        F.count("*").alias("sold_count"), F.sum(amount).alias("sold_amount")
    )
    estimate = (F.col("job_status") == "Completed") & contains_ci("job_type_name", "estimate")
    won = estimate & (F.col("sold_count") > 0)
    rows = dim_jobs.where(local_day_range("completed_on", start, end, tz)).join(per_job, "id", "left")
    n, w = count_if(estimate), count_if(won)
    return rows.groupBy("business_unit").agg(
        n.alias("completed_estimates"), n.alias("sales_opportunities"), w.alias("closed_opportunities"),
        percent(w, n).alias("close_rate_percent"),
        F.round(F.sum("sold_amount"), 2).cast("double").alias("total_booked"),
    )


def baseline_vs_current(totals: dict[str, tuple[DataFrame, Column, float]]) -> DataFrame:
    """One row per KPI: baseline, current value, variance.

    ``totals``: name -> (mart rows of the window, aggregate, baseline).
    """
    return union_all([
        df.agg(value.cast("double").alias("current")).select(
            F.lit(name).alias("kpi"),
            F.lit(float(base)).alias("baseline"),
            rounded(F.col("current")).alias("current"),
            rounded(F.col("current") - base).alias("variance"),
            percent(F.col("current") - base, F.lit(float(base))).alias("variance_pct"),
        )
        for name, (df, value, base) in totals.items()
    ])


def completed_job_invoices(dim_jobs: DataFrame, invoices: DataFrame, start: str, end: str, *, suffix: str = "-Production") -> DataFrame:
    """Invoice totals of jobs completed in the window; invoices are summed per job."""
    per_job = invoices.where(F.col("job_id").isNotNull()).groupBy(F.col("job_id").alias("id")).agg(
        F.countDistinct("id").alias("n"), sum_money("total").alias("t")
    )
    return (
        dim_jobs.where(
            F.col("business_unit").like(f"%{suffix}")
            & (F.col("job_status") == "Completed")
            & day_range("completed_on", start, end)
        )
        .join(per_job, "id", "left")
        .groupBy("business_unit")
        .agg(
            F.countDistinct("id").alias("job_count"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("invoice_count"),
            F.round(F.sum("t"), 2).cast("double").alias("total_dollars_produced"),
        )
    )


def batch_extents(rows: DataFrame, n: int = 5) -> DataFrame:
    """First and last start of each load batch, the newest batches."""
    return (
        rows.groupBy("updated_on")
        .agg(F.min("job_start").alias("min_job_start"), F.max("job_start").alias("max_job_start"))
        .orderBy(F.desc("updated_on"))
        .limit(n)
    )


# --- drill-down -------------------------------------------------------------------------


def kpi_day(daily: DataFrame, day: str, unit: str | None = None) -> DataFrame:
    rows = daily.where(F.col("event_date") == F.lit(day).cast("date"))
    return rows if unit is None else rows.where(F.col("business_unit") == unit)


def kpi_window(daily: DataFrame, start: str, end: str) -> DataFrame:
    exact = "decimal(28,6)"

    def mean(c: str) -> Column:
        return rounded(ratio(F.sum(F.col(c).cast(exact)), F.count(c)))

    def dollars(c: str) -> Column:
        return F.round(F.sum(F.col(c).cast(exact)), 2).cast("double")

    return (
        daily.where(F.col("event_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
        .groupBy("business_unit")
        .agg(
            F.sum("lead_count").alias("weekly_leads"),
            dollars("total_booked").alias("weekly_booked"),
            dollars("dollars_produced").alias("weekly_produced"),
            mean("gpm_percent").alias("avg_gpm"),
            dollars("dollars_collected").alias("weekly_collected"),
            F.sum("num_estimates").alias("weekly_estimates"),
            mean("close_rate_percent").alias("avg_close_rate"),
        )
    )


def _type_list(n: int) -> Column:
    return F.array_join(F.slice(F.sort_array(F.collect_set("job_type_name")), 1, n), ",")


def leads_detail(dim_jobs: DataFrame, start: str, end: str, *, n: int = 10) -> DataFrame:
    """Lead customers per day and unit with up to n job types."""
    return (
        dim_jobs.where(day_range("created_on", start, end) & contains_ci("job_type_name", "estimate"))
        .groupBy(F.to_date("created_on").alias("job_date"), "business_unit")
        .agg(
            F.countDistinct("customer_id").alias("lead_count"),
            F.count("*").alias("total_jobs"),
            _type_list(n).alias("job_types"),
        )
    )


def sold_detail(estimates: DataFrame, dim_jobs: DataFrame, start: str, end: str, *, n: int = 5) -> DataFrame:
    jobs = dim_jobs.select(F.col("id").alias("job_id"), "business_unit", "job_type_name")
    return (
        estimates.where((F.col("status") == "Sold") & day_range("created_on", start, end))
        .join(jobs, "job_id")
        .groupBy(F.to_date("created_on").alias("estimate_date"), "business_unit")
        .agg(
            F.count("*").alias("sold_estimates"),
            F.round(sum_money("subtotal"), 2).cast("double").alias("total_booked"),
            rounded(ratio(sum_money("subtotal"), F.count("subtotal"))).alias("avg_estimate_value"),
            _type_list(n).alias("job_types"),
        )
    )
