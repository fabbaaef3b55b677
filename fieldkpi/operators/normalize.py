"""Landed records and report rows to table rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldkpi.functions.parse import (
    bill_total,
    content_key,
    lenient_timestamp,
    parse_number,
    parse_rate,
    parse_scaled,
    parse_whole,
)
from fieldkpi.operators.dedupe import dedupe_latest
from fieldkpi.sources.readers import named_row, row_field
from fieldkpi.sources.schemas import ENTITIES, TYPES, Entity


def flatten_entity(
    records: DataFrame,
    entity: str | Entity,
    *,
    record: str = "record",
    source: str = "landed_files",
    ingested_at: Column | None = None,
) -> DataFrame:
    """JSON records (one text column) to the entity's table rows.

    Nested ids and names are extracted by path, nested leaves stay JSON text, bad
    values become null, and the audit columns are added.
    """
    spec = ENTITIES[entity] if isinstance(entity, str) else entity
    defaults = dict(spec.defaults)
    # One parse per record: the generator keeps the parsed struct from being split into
    # one parse per field.  Leaves are read as text, so a bad value spoils only itself.
    parsed = records.select(F.inline(F.array(F.from_json(record, _record_schema(spec)))))

    def value(path: str, kind: str) -> Column:
        text = F.col(path)
        if kind == "timestamp":
            return lenient_timestamp(text).cast("timestamp_ntz")
        if kind in ("string", "json"):
            return text
        return text.try_cast(TYPES[kind])

    columns = {}
    for f in spec.fields:
        c = value(f.path, f.type)
        if f.column in defaults:
            c = F.coalesce(c, F.lit(defaults[f.column]))
        columns[f.column] = c
    rows = parsed.select(*[c.alias(n) for n, c in columns.items()])
    if spec.hashed:
        natural = F.col(spec.natural) if spec.natural else None
        rows = rows.withColumn(spec.key, content_key(*spec.hashed, natural=natural))
    if {"bill_amount", "tax_amount", "shipping_amount"} <= set(rows.columns):
        rows = rows.withColumn(
            "total", bill_total("bill_amount", "tax_amount", "shipping_amount").cast("double")
        )
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    return rows.withColumn("_ingested_at", stamp.cast("timestamp_ntz")).withColumn(
        "_ingestion_source", F.lit(source)
    )


def _record_schema(spec: Entity) -> T.StructType:
    """The landed record's fields that the entity reads, nested as they are landed."""
    tree: dict[str, set[str]] = {}
    for f in spec.fields:
        head, _, leaf = f.path.partition(".")
        tree.setdefault(head, set()).update([leaf] if leaf else [])
    text = T.StringType()

    def kind(leaves: set[str]) -> T.DataType:
        if not leaves:
            return text
        return T.StructType([T.StructField(leaf, text) for leaf in sorted(leaves)])

    return T.StructType([T.StructField(head, kind(leaves)) for head, leaves in tree.items()])


def _at(row: str, position: int) -> Column:
    """Field of a positional report row; null beyond its end."""
    return F.get(F.col(row), position)


def _text(row: str, position: int) -> Column:
    return F.nullif(_at(row, position), F.lit(""))


Parse = Callable[[Column], Column]


def _as_is(c: Column) -> Column:
    return c


class Cells:
    """The cells of report rows: by column name where ``columns`` names the list of names, else by position.

    ``filled`` takes the first name whose cell is not empty, ``given`` the first one that the row has; a row whose
    length is not that of the list is read by position.  ``parse`` makes a value of the text.  ``select`` takes columns
    made of them.
    """

    def __init__(self, report: DataFrame, row: str, columns: str | None):
        self.report, self.row, self.columns = report, row, columns
        self.prefix = "_" * (max(map(len, report.columns)) + 1)
        self.named: list[tuple[Sequence[str], int | None, bool, Parse]] = []

    def _cell(self, position: int | None, names: Sequence[str], blanks: bool, parse: Parse) -> Column:
        if self.columns is None:
            return parse(F.lit(None).cast("string") if position is None else _at(self.row, position))
        self.named.append((names, position, blanks, parse))
        return F.col(f"{self.prefix}{len(self.named)}")

    def select(self, *columns: Column, keep: Column | None = None) -> DataFrame:
        """The generator keeps a row's map of names, and all that the row is made of, from being made for every cell."""
        rows = self.report
        if self.named:

            def cells(named: Column) -> Column:
                found = (parse(row_field(names, at, row=self.row, blanks=blanks, named=named)) for names, at, blanks, parse in self.named)
                return F.struct(*[c.alias(f"{self.prefix}{i}") for i, c in enumerate(found, 1)])

            rows = rows.select("*", F.inline(F.transform(F.array(named_row(self.columns, self.row)), cells)))
        return (rows if keep is None else rows.where(keep)).select(*columns)

    def filled(self, position: int | None, *names: str, parse: Parse = _as_is) -> Column:
        return self._cell(position, names, False, parse)

    def given(self, position: int | None, *names: str, parse: Parse = _as_is) -> Column:
        return self._cell(position, names, True, parse)


def _full(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0)).cast("decimal(18,4)")


def _stamped(columns: Sequence[Column], row: str, updated_on: Column | None) -> list[Column]:
    stamp = F.current_timestamp().cast("timestamp_ntz") if updated_on is None else updated_on
    return [*columns, stamp.alias("updated_on"), F.to_json(F.col(row)).alias("raw")]


def leads_rows(
    report: DataFrame,
    unit: str | Column,
    *,
    row: str = "row",
    columns: str | None = None,
    excluded_names: Sequence[str] = ("test",),
    fallback_created: Column | None = None,
    updated_on: Column | None = None,
) -> DataFrame:
    """Leads of the queried unit without test names, one row per job and unit.

    Of several rows with one key the earliest created is kept.  Cells are found by name where ``columns`` has the
    names; the creation time stands at a fixed place.
    """
    cells = Cells(report, row, columns)
    unit_col = F.col(unit) if isinstance(unit, str) else unit
    customer = cells.filled(0, "Customer name")
    name = F.lower(F.coalesce(customer, F.lit("")))
    row_unit = _full(cells.filled(6, "Business Unit", "Job Business Unit"))
    created = lenient_timestamp(_at(row, 8)).cast("timestamp_ntz")
    keep = row_unit.isNull() | (row_unit == unit_col)
    for token in excluded_names:
        keep = keep & ~name.contains(token.lower())
    fallback = F.lit(None).cast("timestamp_ntz") if fallback_created is None else fallback_created
    rows = cells.select(
        *_stamped(
            [
                F.coalesce(row_unit, unit_col).alias("bu_key"),
                F.coalesce(created, fallback).alias("job_created_on"),
                created.alias("created_date"),
                _full(customer).alias("customer_name"),
                _full(cells.filled(3, "Job Type")).alias("job_type"),
                F.coalesce(cells.filled(5, "Job #", "Job Number"), F.lit("")).alias("job_id"),
            ],
            row,
            updated_on,
        ),
        keep=keep,
    )
    return dedupe_latest(rows, ["job_id", "bu_key"], [F.col("job_created_on").asc_nulls_last()])


def collections_rows(
    report: DataFrame, *, row: str = "row", columns: str | None = None, updated_on: Column | None = None
) -> DataFrame:
    """Payments; a missing unit is ``unknown``, a missing amount 0.  An empty cell under a known name stays empty."""
    cells = Cells(report, row, columns)
    unit = cells.given(7, "Invoice Business Unit", "Job Business Unit", "Business Unit")
    return cells.select(
        *_stamped(
            [
                F.coalesce(_full(F.trim(unit)), F.lit("unknown")).alias("bu_key"),
                lenient_timestamp(cells.given(0, "Paid On")).cast("timestamp_ntz").alias("payment_date"),
                _zero(parse_number(cells.given(2, "Amount", "Payment Amount"))).alias("amount"),
                F.coalesce(cells.given(3, "Invoice Number"), F.lit("")).alias("job_id"),
                F.coalesce(F.abs(parse_number(cells.given(8, "Invoice Balance"))) > 0.005, F.lit(False)).alias(
                    "has_remaining_balance"
                ),
            ],
            row,
            updated_on,
        )
    )


def keyed_collections_rows(
    report: DataFrame, *, row: str = "row", updated_on: Column | None = None
) -> DataFrame:
    """Payments with a key from their content, so a reload meets the same rows."""
    rows = report.select(
        *_stamped(
            [
                F.coalesce(_at(row, 7), F.lit("")).alias("business_unit"),
                lenient_timestamp(_at(row, 0)).cast("timestamp_ntz").alias("payment_date"),
                _zero(parse_number(_at(row, 2))).alias("amount"),
                _text(row, 3).alias("job_id"),
            ],
            row,
            updated_on,
        )
    )
    key = content_key("business_unit", "payment_date", "amount", "job_id", "raw")
    return rows.select(key.alias("id"), "*")


def job_cost_rows(
    report: DataFrame, *, row: str = "row", updated_on: Column | None = None
) -> DataFrame:
    """The fifteen positional fields of the job-costing report."""

    def amount(position: int) -> Column:
        return _zero(parse_number(_at(row, position)))

    labor, adjustments = amount(8), amount(9)
    revenue, cost = amount(7), amount(12)
    return report.select(
        *_stamped(
            [
                _text(row, 6).alias("job_id"),
                lenient_timestamp(_at(row, 0)).cast("timestamp_ntz").alias("scheduled_date"),
                F.coalesce(_at(row, 1), F.lit("")).alias("business_unit"),
                _text(row, 2).alias("sold_by"),
                _text(row, 3).alias("primary_technician"),
                _text(row, 4).alias("job_type"),
                _text(row, 5).alias("customer_name"),
                _text(row, 14).alias("job_status"),
                revenue.alias("revenue_subtotal"),
                labor.alias("labor_pay"),
                adjustments.alias("payroll_adjustments"),
                (labor + adjustments).cast("decimal(18,4)").alias("labor_total"),
                amount(10).alias("material_costs"),
                amount(11).alias("return_costs"),
                cost.alias("total_costs"),
                (revenue - cost).cast("decimal(18,4)").alias("gross_profit"),
                amount(13).alias("gpm_percent"),
            ],
            row,
            updated_on,
        )
    )


def daily_job_cost_rows(
    report: DataFrame, *, row: str = "row", columns: str | None = None, updated_on: Column | None = None
) -> DataFrame:
    """The subset that the first-generation cost table keeps, rounded; cells by name where ``columns`` has the names."""
    job = _Job(Cells(report, row, columns))
    return job.cells.select(
        *_stamped(
            [
                job.unit.alias("bu_key"),
                job.number.alias("job_id"),
                job.scheduled.alias("job_start"),
                job.kind.alias("job_type"),
                job.subtotal.alias("job_subtotal"),
                _zero(parse_scaled(job.cells.given(12, "Jobs Total Cost", "JobsTotalCost"), 2)).alias("job_total_costs"),
                _zero(parse_scaled(job.cells.given(13, "Jobs Gross Margin %", "JobsGrossMarginPct"), 4)).alias("job_gm_pct"),
            ],
            row,
            updated_on,
        )
    )


class _Job:
    """What the job-costing and the bookings report say of a job."""

    def __init__(self, cells: Cells):
        self.cells = cells
        self.unit = F.coalesce(_full(cells.filled(1, "Business Unit")), F.lit("unknown"))
        self.number = F.coalesce(cells.filled(6, "Job #", "Job Number"), F.lit(""))
        self.scheduled = lenient_timestamp(cells.filled(0, "Scheduled Date", "ScheduledDate")).cast("timestamp_ntz")
        self.kind = _full(cells.filled(4, "Job Type"))
        self.subtotal = _zero(parse_scaled(cells.given(7, "Jobs Subtotal", "JobsSubtotal"), 2))


def future_booking_rows(report: DataFrame, as_of: Column, *, row: str = "row", columns: str | None = None) -> DataFrame:
    job = _Job(Cells(report, row, columns))
    return job.cells.select(
        job.unit.alias("bu_key"),
        job.number.alias("job_id"),
        job.scheduled.alias("scheduled_date"),
        job.kind.alias("job_type"),
        job.subtotal.alias("job_subtotal"),
        as_of.alias("as_of_date"),
        F.to_json(F.col(row)).alias("raw"),
    )


def booking_total(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count("*").alias("items"), F.sum("job_subtotal").cast("double").alias("total_bookings")
    )


def sales_rows(
    report: DataFrame,
    unit: str | Column,
    event_date: Column,
    *,
    row: str = "row",
    columns: str | None = None,
    updated_on: Column | None = None,
) -> DataFrame:
    """One row per seller; average sale = total / booked where something was booked.

    Cells by name where ``columns`` has the names; such rows may also carry their own day.
    """
    cells = Cells(report, row, columns)
    unit_col = F.col(unit) if isinstance(unit, str) else unit
    day = F.coalesce(F.substr(cells.filled(None, "Date", "Day", "Sold On", "Job Creation Date"), F.lit(1), F.lit(10)).try_cast("date"), event_date)
    booked = ("Closed Opportunities", "CompletedJob", "Completed")
    closed = cells.given(1, "Closed Opportunities", "ClosedOpportunities", *booked[1:], parse=parse_whole)
    completed = cells.given(2, *booked, parse=parse_whole)
    total = cells.given(5, "Total Sales", "TotalSales", "TotalRevenue", "SoldAmount", "BookedRevenue", parse=parse_number)
    average = F.when(
        (F.coalesce(completed, F.lit(0)) > 0) & total.isNotNull(),
        F.round((total.cast("double") / completed.cast("double")).cast("decimal(38,6)"), 2),
    ).otherwise(cells.given(6, "Average Closed Sale", "AverageClosedSale", parse=lambda c: parse_scaled(c, 2)))
    stamp = F.current_timestamp().cast("timestamp_ntz") if updated_on is None else updated_on
    return cells.select(
        (event_date if columns is None else day).alias("event_date"),
        unit_col.alias("bu_name"),
        F.coalesce(cells.given(0, "Estimator", "Technician"), F.lit("")).alias("estimator"),
        cells.given(3, "Sales Opportunities", "SalesOpportunities", parse=parse_whole).alias("sales_opportunities"),
        completed.alias("completed_est"),
        closed.alias("closed_opportunities"),
        F.round(cells.given(4, "Close Rate", "CloseRate", parse=parse_rate), 6).alias("close_rate"),
        F.round(total, 2).cast("decimal(18,4)").alias("total_sales"),
        average.cast("decimal(18,4)").alias("avg_closed_sale"),
        stamp.alias("updated_on"),
    )


def consolidated_sales_rows(
    report: DataFrame, event_date: Column, *, row: str = "row", columns: str | None = None, updated_on: Column | None = None
) -> DataFrame:
    """One row per unit; missing numbers are 0, the rate stays null if unreadable; cells by name where ``columns`` has them."""
    cells = Cells(report, row, columns)

    def whole(cell: Column) -> Column:
        return F.round(_zero(parse_number(cell)), 0).cast("bigint")

    def dollars(cell: Column) -> Column:
        return _zero(parse_scaled(cell, 2))

    return cells.select(
        *_stamped(
            [
                event_date.alias("event_date"),
                F.coalesce(_full(cells.filled(0, "Name")), F.lit("unknown")).alias("bu_name"),
                cells.filled(1, "Sales Opportunity", parse=whole).alias("sales_opportunities"),
                cells.filled(2, "Closed Opportunities", parse=whole).alias("closed_opportunities"),
                cells.filled(3, "Close rate", parse=parse_rate).alias("close_rate"),
                cells.filled(4, "Completed Jobs", parse=whole).alias("completed_est"),
                cells.filled(5, "Total Sales", parse=dollars).alias("total_sales"),
                cells.filled(6, "Closed Average Sale", parse=dollars).alias("avg_closed_sale"),
            ],
            row,
            updated_on,
        )
    )


def with_default_active(dimension: DataFrame) -> DataFrame:
    return dimension.withColumn("active", F.coalesce("active", F.lit(True)))
