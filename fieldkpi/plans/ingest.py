"""Sources, sinks, incremental loads, normalisation, schema checks and streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldkpi.functions import parse
from fieldkpi.functions.constants import WARRANTY_JOB_TYPES
from fieldkpi.functions.expr import day_range, local_date
from fieldkpi.operators import dedupe, dims, incremental, marts, normalize
from fieldkpi.plans.catalog import query
from fieldkpi.plans.domain import Domain
from fieldkpi.plans.oracle import EVENT_VALUE, PRICE, QTY, dsum, ldate, m, pct, ratio, rnd
from fieldkpi.plans.stage_marts import AS_OF, sold
from fieldkpi.sources import loads, readers, schema_ops, sinks, tables
from fieldkpi.sources.literals import literal_relation
from fieldkpi.sources.store import Layout, Store, Transaction
from fieldkpi.sources.workspace import new_folder
from fieldkpi.streaming import jobs as streams

NOW = "2024-01-31 00:00:00"


def as_double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


# --- sources ----------------------------------------------------------------------


def invoice_records(d: Domain) -> DataFrame:
    """Invoices as the API gives them: two records per page, ids nested."""
    records = d.invoices().select(
        F.to_json(
            F.struct(
                F.col("id"),
                F.struct(F.col("job_id").alias("id")).alias("job"),
                F.struct(F.col("business_unit_id").alias("id")).alias("businessUnit"),
                F.struct(F.col("customer_id").alias("id")).alias("customer"),
                F.date_format("invoice_date", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("invoiceDate"),
                F.col("subtotal").cast("double").alias("subTotal"),
                F.col("total").cast("double").alias("total"),
                F.col("balance").cast("double").alias("balance"),
                F.parse_json("items").alias("items"),
            )
        ).alias("record")
    )
    return records


_FLAT = """SELECT id, job_id, business_unit_id, customer_id, invoice_date,
    CAST(subtotal AS DOUBLE) AS sub_total, CAST(total AS DOUBLE) AS total,
    CAST(balance AS DOUBLE) AS balance, len(from_json(items, '["JSON"]')) AS n_items FROM invoices"""


def flat_invoices(records: DataFrame) -> DataFrame:
    return normalize.flatten_entity(records, "invoices").select(
        "id",
        "job_id",
        "business_unit_id",
        "customer_id",
        "invoice_date",
        "sub_total",
        "total",
        "balance",
        F.json_array_length("items").cast("bigint").alias("n_items"),
    )


@query("src_01_entity_pages", _FLAT)
def _(d: Domain) -> DataFrame:
    folder = new_folder(d.spark, "pages")
    pages = invoice_records(d).select(
        F.concat(F.lit('{"page":1,"data":['), F.col("record"), F.lit("]}")).alias("value")
    )
    pages.write.text(folder)
    return flat_invoices(readers.read_entity_pages(d.spark, folder))


@query(
    "src_02_report_rows",
    """SELECT o_orderkey AS job_number, CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DOUBLE) AS total_sales,
              CASE WHEN k = 1 THEN o_orderstatus END AS status FROM invoice_parts""",
)
def _(d: Domain) -> DataFrame:
    """Two rows per report page, the first without a status."""
    folder = new_folder(d.spark, "report")
    cells = "CAST(o_orderkey AS STRING), CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS STRING)"
    d.table("orders").selectExpr(
        "array(named_struct('name', 'Job #', 'label', 'Job'),"
        " named_struct('name', 'Total Sales', 'label', 'Sales'),"
        " named_struct('name', 'Status', 'label', 'Status')) AS fields",
        f"array(array({cells}, NULL), array({cells}, o_orderstatus)) AS data",
    ).write.json(folder)
    return readers.read_report(d.spark, folder).select(
        readers.row_field(["Job #", "Job Number"], 0).cast("bigint").alias("job_number"),
        readers.row_field(["Total Sales"], 1).cast("double").alias("total_sales"),
        readers.row_field(["Status"], 2).alias("status"),
    )


_EXPORT = """SELECT name AS business_unit, o_orderkey AS job_id, CAST(o_orderdate AS DATE) AS job_date,
    CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DOUBLE) AS revenue
    FROM orders LEFT JOIN units ON o_custkey % 25 = units.id"""


def export_folder(d: Domain) -> str:
    folder = new_folder(d.spark, "export")
    d.table("orders").join(
        d.units(), F.col("o_custkey") % 25 == F.col("id"), "left"
    ).select(
        F.col("name").alias("business_unit"),
        F.col("o_orderkey").alias("job_id"),
        F.to_date("o_orderdate").alias("job_date"),
        F.col("o_totalprice").cast("decimal(14,2)").alias("revenue"),
    ).write.csv(folder, header=True)
    return folder


@query("src_03_csv_export", _EXPORT)
def _(d: Domain) -> DataFrame:
    return readers.read_csv(
        d.spark, export_folder(d), "business_unit string, job_id bigint, job_date date, revenue double"
    )


@query("src_04_id_list", "SELECT CAST(o_orderkey AS VARCHAR) AS job_id FROM orders WHERE o_orderstatus = 'F'")
def _(d: Domain) -> DataFrame:
    folder = new_folder(d.spark, "ids")
    lines = d.table("orders").selectExpr(
        "CASE WHEN o_orderstatus = 'F' THEN concat('  ', o_orderkey, ' ') ELSE '   ' END AS value"
    )
    lines.write.text(folder)
    return readers.read_id_list(d.spark, folder)


@query(
    "src_05_mapped_export",
    f"""SELECT job_id AS id, business_unit AS business_unit_name, job_date AS created_on,
               revenue AS total FROM ({_EXPORT})""",
)
def _(d: Domain) -> DataFrame:
    text = readers.read_csv(
        d.spark, export_folder(d), "business_unit string, job_id string, job_date string, revenue string"
    )
    return readers.mapped_export(
        text,
        {
            "id": ("job_id", "bigint"),
            "business_unit_name": ("business_unit", "string"),
            "created_on": ("job_date", "date"),
            "total": ("revenue", "double"),
        },
    )


@query(
    "src_06_jobs_of_listed_types",
    """SELECT job_type_name, COUNT(*) AS jobs FROM dim_jobs
       WHERE job_type_name IN ('Warranty', 'Touchup') GROUP BY 1""",
)
def _(d: Domain) -> DataFrame:
    listed = literal_relation(d.spark, "job_type_name string", [(t,) for t in WARRANTY_JOB_TYPES])
    return d.dim_jobs().join(listed, "job_type_name").groupBy("job_type_name").agg(
        F.count("*").alias("jobs")
    )


@query(
    "src_07_calendar",
    """SELECT CAST(d AS DATE) AS date, CAST(date_trunc('week', d) AS DATE) AS week_start
       FROM (SELECT unnest(generate_series(MIN(o_orderdate), MAX(o_orderdate), INTERVAL 1 DAY)) AS d
             FROM orders)""",
)
def _(d: Domain) -> DataFrame:
    bounds = d.table("orders").agg(
        F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last")
    )
    return readers.calendar(bounds)


# --- sinks ------------------------------------------------------------------------


def job_rows(d: Domain) -> DataFrame:
    return d.jobs().select("id", "job_status", "business_unit_id", "created_on", "modified_on")


_JOB_ROWS = "SELECT id, job_status, business_unit_id, created_on, modified_on FROM jobs"
_LOADED = "1998-01-01 00:00:00"


def first_load(d: Domain) -> DataFrame:
    """What a first load left behind: jobs created until the load, all still scheduled."""
    return (
        job_rows(d)
        .where(F.col("created_on") < F.expr(f"TIMESTAMP_NTZ'{_LOADED}'"))
        .withColumn("job_status", F.lit("Scheduled"))
        .withColumn("modified_on", F.col("created_on"))
    )


def changed_jobs(d: Domain) -> DataFrame:
    """The next batch: jobs changed or created since; each comes twice, once outdated."""
    fresh = job_rows(d).where(F.col("modified_on") >= F.expr(f"TIMESTAMP_NTZ'{_LOADED}'"))
    outdated = fresh.withColumn("job_status", F.lit("Draft")).withColumn(
        "modified_on", F.col("modified_on") - F.expr("INTERVAL 1 DAY")
    )
    return fresh.unionByName(outdated)


_UPSERTED = f"""SELECT id, CASE WHEN modified_on >= TIMESTAMP '{_LOADED}' THEN job_status
        ELSE 'Scheduled' END AS job_status, business_unit_id, created_on,
        CASE WHEN modified_on >= TIMESTAMP '{_LOADED}' THEN modified_on ELSE created_on END AS modified_on
    FROM jobs WHERE created_on < TIMESTAMP '{_LOADED}' OR modified_on >= TIMESTAMP '{_LOADED}'"""
_NEWEST = ["modified_on"]


def new_store(d: Domain) -> Store:
    return Store(d.spark, new_folder(d.spark, "store"))


def add(t: Transaction, table: str, rows: DataFrame, layout: Layout | None = None) -> None:
    """The rows into a table that is made, or grows their columns, first."""
    t.ensure(table, rows.schema, layout)
    t.append(table, rows)


@query(
    "snk_01_day_partitioned_table",
    "SELECT id, job_status, business_unit_id, created_on, modified_on, CAST(modified_on AS DATE) AS day FROM jobs",
)
def _(d: Domain) -> DataFrame:
    """Parted by the day of the change, ordered by unit and status within a day, and read back with the day."""
    store = new_store(d)
    rows = job_rows(d)
    store.run("load", lambda t: add(t, "jobs", rows, Layout(("id",), "modified_on", cluster=("business_unit_id", "job_status"))))
    return store.read("jobs")


@query(
    "snk_01_bucketed_tables",
    """SELECT j.id AS job_id, j.job_status, i.n AS invoice_count FROM jobs j
       JOIN (SELECT job_id, COUNT(*) AS n FROM invoices GROUP BY 1) i ON i.job_id = j.id""",
)
def _(d: Domain) -> DataFrame:
    """Jobs and their invoice counts, written into equal buckets and joined in place."""
    folder = new_folder(d.spark, "buckets")
    tag = folder.rsplit("-", 1)[1]
    jobs = d.jobs().select(F.col("id").alias("job_id"), "job_status")
    counts = d.invoices().where(F.col("job_id").isNotNull()).groupBy("job_id").agg(
        F.count("*").alias("invoice_count")
    )
    left = tables.write_bucketed(jobs, f"jobs_{tag}", f"{folder}/jobs", ["job_id"], 8)
    right = tables.write_bucketed(counts, f"counts_{tag}", f"{folder}/counts", ["job_id"], 8)
    return left.hint("merge").join(right, "job_id")


@query(
    "snk_02_additive_schema",
    f"""SELECT id, job_status, CASE WHEN created_on >= TIMESTAMP '{_LOADED}' THEN job_number END AS job_number,
               created_on, CASE WHEN created_on >= TIMESTAMP '{_LOADED}' THEN campaign_id END AS campaign_id FROM jobs""",
)
def _(d: Domain) -> DataFrame:
    """A table written with an old schema, whose ids were shorter, and then with a new one; all its files read."""
    store, jobs = new_store(d), d.jobs()
    cut = F.col("created_on") >= F.expr(f"TIMESTAMP_NTZ'{_LOADED}'")
    old = jobs.where(~cut).select(F.col("id").cast("int").alias("id"), "job_status", "created_on")
    new = jobs.where(cut).select("job_number", "id", "job_status", "created_on", "campaign_id")
    store.run("old", lambda t: add(t, "jobs", old))
    store.run("new", lambda t: add(t, "jobs", new))
    return store.read("jobs")


@query(
    "snk_03_append",
    "SELECT id, job_status, created_on FROM jobs",
)
def _(d: Domain) -> DataFrame:
    """Two appends; the second batch brings a field that the table does not know."""
    folder = new_folder(d.spark, "append")
    schema = job_rows(d).select("id", "job_status", "created_on").schema
    cut = F.expr(f"TIMESTAMP_NTZ'{_LOADED}'")
    tables.append(job_rows(d).where(F.col("created_on") < cut), folder, schema)
    tables.append(
        job_rows(d).where(F.col("created_on") >= cut).withColumn("surprise", F.lit(1)), folder, schema
    )
    return d.spark.read.parquet(folder)


@query("snk_04_upsert", _UPSERTED)
def _(d: Domain) -> DataFrame:
    table = new_folder(d.spark, "upsert")
    tables.publish(first_load(d), table)
    merged = tables.upsert(
        tables.current(d.spark, table), changed_jobs(d), ["id"], dedupe.newest(*_NEWEST)
    )
    tables.publish(merged, table, mode="upsert")
    return tables.current(d.spark, table)


@query("snk_04_upsert_days", _UPSERTED)
def _(d: Domain) -> DataFrame:
    """The same into a table by day of change, so that keys move between days; only files that hold a key are rewritten."""
    store = new_store(d)
    store.run("first", lambda t: add(t, "jobs", first_load(d), Layout(("id",), "modified_on")))
    store.run("second", lambda t: t.upsert("jobs", changed_jobs(d), dedupe.newest(*_NEWEST)))
    return store.read("jobs").drop("day")


_WINDOW = ("1998-03-01", "1998-03-31")


@query(
    "snk_05_replace_range",
    f"""SELECT id, job_status, created_on FROM jobs
            WHERE CAST(created_on AS DATE) NOT BETWEEN DATE '{_WINDOW[0]}' AND DATE '{_WINDOW[1]}'
        UNION ALL SELECT id, 'Reloaded', created_on FROM jobs
            WHERE CAST(created_on AS DATE) BETWEEN DATE '{_WINDOW[0]}' AND DATE '{_WINDOW[1]}'
              AND job_status = 'Completed'""",
)
def _(d: Domain) -> DataFrame:
    rows = job_rows(d).select("id", "job_status", "created_on")
    batch = d.jobs().where(
        F.to_date("created_on").between(*[F.lit(x).cast("date") for x in _WINDOW])
        & (F.col("job_status") == "Completed")
    )
    batch = batch.select("id", F.lit("Reloaded").alias("job_status"), "created_on")
    store = new_store(d)
    store.run("load", lambda t: add(t, "jobs", rows, Layout(("id",), "created_on")))
    store.run("window", lambda t: t.replace_range("jobs", batch, "created_on", *_WINDOW))
    return store.read("jobs").drop("day")


_BOOKED = f"""SELECT sold_date AS kpi_date, business_unit, {dsum('revenue_amount')} AS total_booked
    FROM sold_estimates GROUP BY 1, 2"""


def booked(d: Domain) -> DataFrame:
    return marts.total_booked_daily(sold(d)).select("kpi_date", "business_unit", "total_booked")


@query("snk_06_rebuild", _BOOKED)
def _(d: Domain) -> DataFrame:
    return tables.rebuild(booked(d), new_folder(d.spark, "rebuild"))


@query("snk_07_view", _BOOKED)
def _(d: Domain) -> DataFrame:
    booked(d).createOrReplaceTempView("total_booked_by_day")
    return d.spark.sql("SELECT kpi_date, business_unit, total_booked FROM total_booked_by_day")


@query(
    "snk_08_rolling_refresh",
    f"""SELECT kpi_date, business_unit, CASE WHEN kpi_date < DATE '{AS_OF}' - 7 THEN 0
               ELSE total_booked END AS total_booked FROM ({_BOOKED})""",
)
def _(d: Domain) -> DataFrame:
    """An outdated table (all zero) whose last seven days, and later ones, are refreshed."""
    view = booked(d)
    outdated = view.withColumn("total_booked", F.lit(0.0))
    store = new_store(d)
    store.run("outdated", lambda t: add(t, "booked", outdated, Layout(day="kpi_date")))
    store.run("refresh", lambda t: sinks.refresh_stored(t, "booked", view, "kpi_date", AS_OF))
    return store.read("booked").drop("day")


def status_counts(jobs: DataFrame) -> DataFrame:
    """Jobs per day of their last change, unit and status."""
    return jobs.groupBy(F.to_date("modified_on").alias("kpi_date"), "business_unit_id", "job_status").agg(F.count("*").alias("jobs"))


@query(
    "snk_08_changed_days",
    f"""SELECT CAST(modified_on AS DATE) AS kpi_date, business_unit_id, job_status, COUNT(*) AS jobs
        FROM ({_UPSERTED}) GROUP BY 1, 2, 3""",
)
def _(d: Domain) -> DataFrame:
    """A mart that follows an upsert of its source by the days that changed, in the same commit."""
    store = new_store(d)

    def first(t: Transaction) -> None:
        add(t, "jobs", first_load(d), Layout(("id",), "modified_on"))
        add(t, "status", status_counts(t.read("jobs")), Layout(day="kpi_date"))

    def second(t: Transaction) -> None:
        t.upsert("jobs", changed_jobs(d), dedupe.newest(*_NEWEST), changes="job_changes")
        sinks.refresh_changed(t, "status", "jobs", t.read("job_changes"), "modified_on", status_counts)

    store.run("first", first)
    store.run("second", second)
    return store.read("status").drop("day")


@query(
    "snk_09_snapshot",
    f"""SELECT DATE '1999-12-31' AS snapshot_date, business_unit, CAST(0 AS DOUBLE) AS outstanding_ar FROM ar
        UNION ALL SELECT DATE '{AS_OF}', business_unit, outstanding_ar FROM ar""",
    ar=f"""SELECT j.business_unit, {dsum('i.balance')} AS outstanding_ar FROM invoices i
           JOIN dim_jobs j ON i.job_id = j.id
           WHERE i.balance >= 10 AND j.business_unit LIKE '%-Production' GROUP BY 1""",
)
def _(d: Domain) -> DataFrame:
    """Two days' snapshots; the second day ran twice."""
    view = marts.receivables_with_floor(d.invoices(), d.dim_jobs())
    store = new_store(d)
    store.run("one", lambda t: sinks.store_snapshot(t, "ar", view.withColumn("outstanding_ar", F.lit(0.0)), "1999-12-31"))
    for turn in ("two", "again"):
        store.run(turn, lambda t: sinks.store_snapshot(t, "ar", view, AS_OF))
    return store.read("ar").drop("day")


@query(
    "snk_10_repaired_foreign_key",
    """SELECT i.id, COALESCE(i.job_id, j.id) AS job_id,
              COALESCE(i.business_unit_id, CASE WHEN i.job_id IS NULL THEN j.business_unit_id END)
                  AS business_unit_id
       FROM invoices i LEFT JOIN jobs j ON i.job_number = j.job_number""",
)
def _(d: Domain) -> DataFrame:
    """The stored invoices, of which only the files with rows to repair are rewritten."""
    store = new_store(d)
    invoices = d.invoices()
    store.run("load", lambda t: add(t, "invoices", invoices, Layout(("id",))))
    store.run("repair", lambda t: t.upsert("invoices", tables.repaired_rows(t.read("invoices"), d.jobs()), [F.col("id")]))
    return store.read("invoices").select("id", "job_id", "business_unit_id")


# --- incremental ------------------------------------------------------------------


@query(
    "inc_01_last_watermarks",
    f"""SELECT e.entity_type, COALESCE(s.t, TIMESTAMP '{NOW}' - INTERVAL 7 DAY) AS last_sync_time
        FROM (SELECT DISTINCT entity_type FROM sync_state UNION ALL SELECT 'never_run') e
        LEFT JOIN (SELECT entity_type, arg_max(last_sync_time, updated_at) AS t
                   FROM sync_state GROUP BY 1) s USING (entity_type)""",
)
def _(d: Domain) -> DataFrame:
    state = d.sync_state()
    entities = state.select("entity_type").distinct().union(
        d.spark.sql("SELECT 'never_run' AS entity_type")
    )
    return incremental.last_watermarks(state, entities, NOW)


@query(
    "inc_02_state_row",
    f"""SELECT entity_type, last_sync_time, last_sync_status, records_processed, updated_at FROM sync_state
        UNION ALL SELECT 'jobs', TIMESTAMP '{NOW}', 'success', COUNT(*), TIMESTAMP '{NOW}' FROM jobs""",
)
def _(d: Domain) -> DataFrame:
    row = incremental.state_row(d.jobs(), "jobs", NOW, "success", F.count("*"))
    return d.sync_state().unionByName(row)


_MARK = "1999-06-01 00:00:00"


@query(
    "inc_03_incremental_slice_all",
    f"""SELECT id, created_on, modified_on FROM jobs
        WHERE modified_on >= TIMESTAMP '{_MARK}' - INTERVAL 168 HOUR
          AND created_on >= TIMESTAMP '{_MARK}' - INTERVAL 168 HOUR""",
)
def _(d: Domain) -> DataFrame:
    return incremental.incremental_slice(d.jobs(), _MARK, "jobs").select(
        "id", "created_on", "modified_on"
    )


@query(
    "inc_03_incremental_slice_any",
    f"""SELECT id, created_on, modified_on FROM estimates
        WHERE modified_on >= TIMESTAMP '{_MARK}' - INTERVAL 4320 HOUR
           OR created_on >= TIMESTAMP '{_MARK}' - INTERVAL 4320 HOUR""",
)
def _(d: Domain) -> DataFrame:
    return incremental.incremental_slice(d.estimates(), _MARK, "estimates", mode="any").select(
        "id", "created_on", "modified_on"
    )


_NOW_DAY = date(2001, 12, 31)


@query(
    "inc_04_year_chunks",
    """SELECT y AS year, make_date(y, 1, 1) AS start_date, make_date(y + 1, 1, 1) AS end_date,
              (SELECT COUNT(*) FROM jobs WHERE year(created_on) = y) AS rows
       FROM (SELECT unnest(generate_series(1994, 2001)) AS y)""",
)
def _(d: Domain) -> DataFrame:
    return incremental.year_chunk_counts(d.jobs(), 1994, _NOW_DAY)


def job_entity(d: Domain) -> loads.Entity:
    return loads.Entity("jobs", job_rows(d).schema, Layout(("id",)), tuple(dedupe.newest(*_NEWEST)), ("id", "created_on"))


def ticking(start: datetime) -> Callable[[], datetime]:
    """A clock that moves one second with each look."""
    times = iter(start + timedelta(seconds=n) for n in range(1, 1_000_000))
    return lambda: next(times)


class Interrupted(RuntimeError):
    """The planned end of a worker."""


def backfilled(d: Domain) -> Store:
    """Jobs loaded year by year: the first worker fails on one chunk and its second try succeeds."""
    store, failed = new_store(d), []

    def fetch(start: date, end: date) -> DataFrame:
        if start.year == 1995 and not failed:
            failed.append(start)
            raise Interrupted("connection lost")
        return incremental.chunk(job_rows(d), start, end)

    wanted = loads.chunks(d.jobs(), 1994, _NOW_DAY)
    loads.backfill(store, job_entity(d), wanted[:5], fetch, worker="one", clock=ticking(datetime(2024, 1, 31)))
    loads.backfill(store, job_entity(d), wanted, fetch, worker="two", clock=ticking(datetime(2024, 2, 1)))
    return store


@query(
    "inc_04_backfill",
    "SELECT id, job_status, business_unit_id, created_on, modified_on FROM jobs",
)
def _(d: Domain) -> DataFrame:
    return backfilled(d).read("raw_jobs")


@query(
    "inc_04_backfill_ledger",
    """SELECT y.y AS year, 'done' AS status, CASE WHEN y.y <= 1998 THEN 'one' ELSE 'two' END AS worker,
              (SELECT COUNT(*) FROM jobs j WHERE year(j.created_on) = y.y) AS rows,
              CAST(CASE WHEN y.y = 1995 THEN 1 ELSE 0 END AS BIGINT) AS failures
       FROM (SELECT unnest(generate_series(1994, 2001)) AS y) y""",
)
def _(d: Domain) -> DataFrame:
    """Which worker loaded which year, with how many rows, after how many failures."""
    own = loads.ledger(backfilled(d), "jobs")
    return own.select(F.year("start_date").cast("bigint").alias("year"), "status", "worker", "rows", "failures")


@query(
    "inc_05_open_windows",
    """SELECT CAST(s AS DATE) AS window_from, LEAST(CAST(s AS DATE) + 6, l) AS window_to
       FROM (SELECT unnest(generate_series(MIN(o_orderdate), MAX(o_orderdate), INTERVAL 7 DAY)) AS s,
                    CAST(MAX(o_orderdate) AS DATE) AS l FROM orders)
       WHERE CAST(s AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders
                                     WHERE o_totalprice > 400000)""",
)
def _(d: Domain) -> DataFrame:
    """A window counts as done if a very large job fell on its first day."""
    orders = d.table("orders")
    bounds = orders.agg(
        F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last")
    )
    windows = incremental.date_windows(bounds, 7)
    big_days = orders.where("o_totalprice > 400000").select(F.to_date("o_orderdate").alias("window_from"))
    done = windows.join(big_days, "window_from", "left_semi")
    return incremental.date_windows(bounds, 7, done=done)


@query(
    "inc_06_trailing_windows",
    """SELECT w AS "window", COUNT(*) AS jobs FROM (
           SELECT CASE WHEN CAST(created_on AS DATE) BETWEEN DATE '1999-12-03' AND DATE '2000-01-01' THEN 'this'
                       WHEN CAST(created_on AS DATE) BETWEEN DATE '1998-12-03' AND DATE '1999-01-01' THEN 'prior'
                  END AS w FROM jobs) WHERE w IS NOT NULL GROUP BY 1""",
)
def _(d: Domain) -> DataFrame:
    """The last 30 days and the same days a year before."""
    this, prior = (incremental.trailing_window(AS_OF, 30, o) for o in (0, 365))
    label = F.when(day_range("created_on", *this), "this").when(
        day_range("created_on", *prior), "prior"
    )
    return (
        d.jobs()
        .where(day_range("created_on", *this) | day_range("created_on", *prior))
        .groupBy(label.alias("window"))
        .agg(F.count("*").alias("jobs"))
    )


_MOD, _WORK = ("1998-08-10", "1998-10-31"), ("1998-08-01", "1998-08-31")


def payroll_first_lines(d: Domain) -> DataFrame:
    """One payroll line per source id."""
    lines = d.payroll().select("source_entity_id", "job_id", "date", "amount", "modified_on")
    return dedupe.dedupe_latest(
        lines.withColumnRenamed("source_entity_id", "id"), ["id"], dedupe.newest("modified_on", "amount")
    )


def payroll_before(d: Domain) -> DataFrame:
    """The table as it was while lines changed later were missing."""
    return payroll_first_lines(d).where(F.col("modified_on") < F.expr("TIMESTAMP_NTZ'1998-08-10 00:00:00'"))


_PAY = """SELECT source_entity_id AS id, job_id, date, amount, modified_on FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY source_entity_id ORDER BY modified_on DESC, amount DESC,
        job_id NULLS LAST) AS rn FROM payroll) WHERE rn = 1"""


@query(
    "inc_07_late_repair",
    """SELECT id, job_id, date, CAST(amount AS DOUBLE) AS amount, modified_on FROM pay
       WHERE modified_on < TIMESTAMP '1998-08-10' OR (modified_on < TIMESTAMP '1998-11-01'
             AND date >= TIMESTAMP '1998-08-01' AND date < TIMESTAMP '1998-09-01')""",
    pay=_PAY,
)
def _(d: Domain) -> DataFrame:
    out = incremental.late_repair(payroll_before(d), payroll_first_lines(d), _MOD, _WORK)
    return as_double(out, "amount")


@query(
    "inc_07_late_repair_stats",
    """SELECT a.n AS records_before, b.n AS records_after, a.j AS jobs_before, b.j AS jobs_after,
              a.s AS labor_before, b.s AS labor_after, b.n - a.n AS records_delta,
              b.j - a.j AS jobs_delta, CAST(b.e - a.e AS DOUBLE) AS labor_delta
       FROM (SELECT COUNT(*) AS n, COUNT(DISTINCT job_id) AS j, CAST(SUM(amount) AS DOUBLE) AS s,
                    SUM(amount) AS e FROM pay WHERE date >= TIMESTAMP '1998-08-01'
                    AND date < TIMESTAMP '1998-09-01' AND modified_on < TIMESTAMP '1998-08-10') a,
            (SELECT COUNT(*) AS n, COUNT(DISTINCT job_id) AS j, CAST(SUM(amount) AS DOUBLE) AS s,
                    SUM(amount) AS e FROM pay WHERE date >= TIMESTAMP '1998-08-01'
                    AND date < TIMESTAMP '1998-09-01') b""",
    pay=_PAY,
)
def _(d: Domain) -> DataFrame:
    before = payroll_before(d)
    after = incremental.late_repair(before, payroll_first_lines(d), _MOD, _WORK)
    return incremental.repair_stats(before, after, _WORK)


@query(
    "inc_08_run_log_row",
    """SELECT 'jobs' AS entity_type, 'run-1' AS run_id, TIMESTAMP '2024-01-30 23:59:50' AS start_time,
              TIMESTAMP '2024-01-31 00:00:00' AS end_time, 'success' AS status,
              COUNT(*) AS records_fetched, COUNT(*) AS records_inserted, CAST(10000 AS BIGINT) AS duration_ms,
              NULL::VARCHAR AS error_message FROM jobs""",
)
def _(d: Domain) -> DataFrame:
    return incremental.run_log_row(d.jobs(), "jobs", "run-1", "2024-01-30 23:59:50", NOW, "success")


@query(
    "inc_09_recent_runs",
    """SELECT * FROM run_log WHERE entity_type = 'click' ORDER BY start_time DESC, run_id DESC LIMIT 10""",
)
def _(d: Domain) -> DataFrame:
    return incremental.recent_runs(d.run_log(), "click")


@query(
    "inc_10_success_rates",
    f"""SELECT entity_type, COUNT(*) AS total_runs, COUNT(*) FILTER (status = 'success') AS successful_runs,
               {pct("COUNT(*) FILTER (status = 'success')", 'COUNT(*)')} AS success_rate_pct
        FROM run_log WHERE start_time >= TIMESTAMP '{NOW}' - INTERVAL 30 DAY GROUP BY 1""",
)
def _(d: Domain) -> DataFrame:
    return incremental.success_rates(d.run_log(), NOW)


@query(
    "inc_10_recent_failures",
    f"""SELECT entity_type, start_time, error_message FROM run_log
        WHERE status = 'failed' AND start_time >= TIMESTAMP '{NOW}' - INTERVAL 7 DAY""",
)
def _(d: Domain) -> DataFrame:
    return incremental.recent_failures(d.run_log(), NOW)


@query(
    "inc_11_run_health",
    f"""SELECT entity_type, MAX(start_time) AS last_run,
               {ratio('SUM(duration_ms)', 'COUNT(*)')} AS avg_duration_ms,
               date_sub('hour', MAX(start_time), TIMESTAMP '{NOW}') AS hours_ago
        FROM run_log WHERE status = 'success' AND start_time > TIMESTAMP '{NOW}' - INTERVAL 7 DAY GROUP BY 1""",
)
def _(d: Domain) -> DataFrame:
    return incremental.run_health(d.run_log(), NOW)


_RUNS = ("1998-01-01", "1998-04-01", "2010-01-01")


def entity_loads(d: Domain) -> Store:
    """Three runs over the jobs: the second fails on rows without an id and is run again, the third one twice."""
    store, entity, jobs = new_store(d), job_entity(d), job_rows(d)
    broken = [True]

    def fetch(until: str) -> Callable[[datetime], DataFrame]:
        def run(mark: datetime) -> DataFrame:
            first = mark < datetime(1998, 1, 1)
            since = F.lit(True) if first else F.col("modified_on") >= F.expr(f"TIMESTAMP_NTZ'{mark}'")
            rows = jobs.where(since & (F.col("modified_on") < F.expr(f"TIMESTAMP_NTZ'{until}'")))
            if not first and broken.pop():
                rows = rows.withColumn("id", F.when(F.col("id") % 7 != 0, F.col("id")))
            return rows

        return run

    for run_id, until in zip(("r1", "r2", "r2", "r3", "r3"), (_RUNS[0], _RUNS[1], _RUNS[1], _RUNS[2], _RUNS[2]), strict=True):
        try:
            loads.load_entity(store, entity, run_id, fetch(until), clock=ticking(datetime.fromisoformat(until) - timedelta(seconds=1)))
        except loads.Invalid:
            broken.append(False)
        else:
            broken.append(not broken or run_id == "r1")
    return store


@query("inc_12_entity_load", "SELECT id, job_status, business_unit_id, created_on, modified_on FROM jobs")
def _(d: Domain) -> DataFrame:
    """The table after all runs: nothing double, nothing lost."""
    return entity_loads(d).read("raw_jobs")


_PARTS = f"""(SELECT 'r1' AS run_id, TIMESTAMP '{_RUNS[0]}' AS t, COUNT(*) AS n FROM jobs WHERE modified_on < TIMESTAMP '{_RUNS[0]}'
    UNION ALL SELECT 'r2', TIMESTAMP '{_RUNS[1]}', COUNT(*) FROM jobs
        WHERE modified_on >= TIMESTAMP '{_RUNS[0]}' AND modified_on < TIMESTAMP '{_RUNS[1]}'
    UNION ALL SELECT 'r3', TIMESTAMP '{_RUNS[2]}', COUNT(*) FROM jobs
        WHERE modified_on >= TIMESTAMP '{_RUNS[1]}' AND modified_on < TIMESTAMP '{_RUNS[2]}')"""


@query(
    "inc_12_load_state",
    f"""SELECT 'jobs' AS entity_type, t AS last_sync_time, 'success' AS last_sync_status,
               n AS records_processed FROM {_PARTS} WHERE n > 0""",
)
def _(d: Domain) -> DataFrame:
    return entity_loads(d).read(loads.STATE).select("entity_type", "last_sync_time", "last_sync_status", "records_processed")


@query(
    "inc_12_load_log",
    f"""SELECT run_id, 'success' AS status, n AS records_fetched, n AS records_inserted, NULL::VARCHAR AS error_message FROM {_PARTS}
        UNION ALL SELECT 'r2', 'failed', NULL, 0, CAST(COUNT(*) AS VARCHAR) || ' rows without id' FROM jobs
            WHERE modified_on >= TIMESTAMP '{_RUNS[0]}' AND modified_on < TIMESTAMP '{_RUNS[1]}' AND id % 7 = 0""",
)
def _(d: Domain) -> DataFrame:
    return entity_loads(d).read(loads.LOG).select("run_id", "status", "records_fetched", "records_inserted", "error_message")


# --- normalisation ------------------------------------------------------------------


@query("nrm_01_flatten_invoices", _FLAT)
def _(d: Domain) -> DataFrame:
    return flat_invoices(invoice_records(d))


def _iso(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def as_records(rows: DataFrame, **fields: str | Column) -> DataFrame:
    """Rows as the API's JSON records; plain names are columns."""
    values = [(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in fields.items()]
    return rows.select(F.to_json(F.struct(*values)).alias("record"))


@query(
    "nrm_01_flatten_jobs",
    "SELECT id, job_number, customer_id, job_status, business_unit_id, created_on, completed_on FROM jobs",
)
def _(d: Domain) -> DataFrame:
    records = as_records(
        d.jobs(),
        id="id",
        jobNumber="job_number",
        customerId="customer_id",
        jobStatus="job_status",
        businessUnitId="business_unit_id",
        createdOn=_iso("created_on"),
        completedOn=_iso("completed_on"),
    )
    return normalize.flatten_entity(records, "jobs").select(
        "id", "job_number", "customer_id", "job_status", "business_unit_id", "created_on", "completed_on"
    )


@query(
    "nrm_01_flatten_estimates",
    """SELECT id, job_id, status, created_on, sold_on, sold_by_id, CAST(subtotal AS DOUBLE) AS subtotal,
              CAST(total AS DOUBLE) AS total FROM estimates""",
)
def _(d: Domain) -> DataFrame:
    """The status is an object and the seller has another name in the record."""
    records = as_records(
        d.estimates(),
        id="id",
        jobId="job_id",
        status=F.struct(F.lit(1).alias("value"), F.col("status").alias("name")),
        createdOn=_iso("created_on"),
        soldOn=_iso("sold_on"),
        soldBy="sold_by_id",
        subtotal="subtotal",
        total="total",
    )
    return normalize.flatten_entity(records, "estimates").select(
        "id", "job_id", "status", "created_on", "sold_on", "sold_by_id", "subtotal", "total"
    )


@query(
    "nrm_02_flatten_appointments",
    """SELECT id, job_id, scheduled_start, scheduled_end, status FROM appts""",
)
def _(d: Domain) -> DataFrame:
    records = as_records(
        d.appointments(),
        id="id",
        jobId="job_id",
        start=_iso("scheduled_start"),
        end=_iso("scheduled_end"),
        status="status",
    )
    return normalize.flatten_entity(records, "appointments").select(
        "id", "job_id", "scheduled_start", "scheduled_end", "status"
    )


@query(
    "nrm_02_flatten_customers",
    "SELECT id, name, type, CAST(balance AS DOUBLE) AS balance FROM customers",
)
def _(d: Domain) -> DataFrame:
    records = as_records(d.customers(), id="id", name="name", type="type", balance="balance")
    return normalize.flatten_entity(records, "customers").select("id", "name", "type", "balance")


@query(
    "nrm_02_flatten_locations",
    """SELECT c.id, c.id AS customer_id, z.zip5 FROM customers c LEFT JOIN location_zips z ON z.location_id = c.id""",
)
def _(d: Domain) -> DataFrame:
    """The address object stays JSON, read late for its ZIP."""
    records = as_records(
        d.locations(), id="id", customerId="customer_id", address=F.parse_json("address")
    )
    return normalize.flatten_entity(records, "locations").select(
        "id", "customer_id", parse.zip5("address").alias("zip5")
    )


@query(
    "nrm_02_flatten_payments",
    """SELECT id, invoice_id, CAST(amount AS DOUBLE) AS amount, payment_type_id,
              date_trunc('second', created_on) AS created_on FROM payments""",
)
def _(d: Domain) -> DataFrame:
    records = as_records(
        d.payments(),
        id="id",
        invoiceId="invoice_id",
        amount="amount",
        typeId="payment_type_id",
        createdOn=_iso("created_on"),
    )
    return normalize.flatten_entity(records, "payments").select(
        "id", "invoice_id", "amount", "payment_type_id", "created_on"
    )


@query(
    "nrm_02_flatten_job_types",
    """SELECT t.id, t.name, TRUE AS active, COUNT(*) AS jobs FROM job_types t
       JOIN jobs j ON j.job_type_id = t.id GROUP BY 1, 2""",
)
def _(d: Domain) -> DataFrame:
    """Types without the active flag, with the jobs that use them."""
    types = normalize.flatten_entity(as_records(d.job_types(), id="id", name="name"), "job_types")
    used = d.jobs().groupBy(F.col("job_type_id").alias("id")).agg(F.count("*").alias("jobs"))
    return types.join(used, "id").select("id", "name", "active", "jobs")


@query(
    "nrm_03_dimension_defaults",
    "SELECT id, name, COALESCE(active, TRUE) AS active FROM technicians",
)
def _(d: Domain) -> DataFrame:
    records = d.technicians().select(F.to_json(F.struct("id", "name", "active")).alias("record"))
    return normalize.flatten_entity(records, "technicians").select("id", "name", "active")


@query(
    "nrm_04_lenient_timestamps",
    """SELECT event_id, CASE WHEN event_type IN ('error', 'view') THEN NULL
                             ELSE date_trunc('second', ts) END AS parsed FROM events""",
)
def _(d: Domain) -> DataFrame:
    text = (
        F.when(F.col("event_type") == "error", F.lit(""))
        .when(F.col("event_type") == "view", F.lit("soon"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    )
    return d.table("events").select(
        "event_id", parse.lenient_timestamp(text).cast("timestamp_ntz").alias("parsed")
    )


@query(
    "nrm_05_nested_fields",
    "SELECT event_id, props->>'$.k' AS k, 'none' AS label FROM events",
)
def _(d: Domain) -> DataFrame:
    nested = d.table("events").withColumn("payload", F.concat(F.lit('{"data":'), "props", F.lit("}")))
    return nested.select(
        "event_id",
        parse.nested_field("payload", "data.k").alias("k"),
        parse.nested_field("payload", "data.label.name", "none").alias("label"),
    )


def _money_text(value: str, places: int = 2) -> str:
    """Report text of a number: dollars and commas, or brackets for a negative."""
    return (
        f"CASE WHEN {value} < 0 THEN concat('($', format_number(-({value}), {places}), ')')"
        f" ELSE concat(' $', format_number({value}, {places}), ' ') END"
    )


_BAL = "CAST(c_acctbal AS DECIMAL(14,2))"


@query(
    "nrm_06_money_text",
    f"""SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL
               ELSE CAST({_BAL} AS DOUBLE) END AS amount FROM customer""",
)
def _(d: Domain) -> DataFrame:
    text = F.expr(f"CASE WHEN c_mktsegment = 'BUILDING' THEN 'n/a' ELSE {_money_text(_BAL)} END")
    return d.table("customer").select(
        "c_custkey", parse.parse_number(text).cast("double").alias("amount")
    )


@query(
    "nrm_07_rate_text",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN NULL
              WHEN event_type = 'click' THEN CAST(props->>'$.k' AS INTEGER) / 100.0::DOUBLE
              WHEN CAST(props->>'$.k' AS INTEGER) > 1 THEN CAST(props->>'$.k' AS INTEGER) / 100.0::DOUBLE
              ELSE CAST(props->>'$.k' AS DOUBLE) END AS rate FROM events""",
)
def _(d: Domain) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    text = (
        F.when(F.col("event_type") == "view", "n/a")
        .when(F.col("event_type") == "click", (k.cast("int") / 100).cast("decimal(6,2)").cast("string"))
        .otherwise(F.concat(k, F.lit("%")))
    )
    return d.table("events").select("event_id", parse.parse_rate(text).cast("double").alias("rate"))


@query(
    "nrm_08_scaled_numbers",
    f"""SELECT c_custkey, CAST(ROUND({_BAL}, 1) AS DOUBLE) AS rounded,
               CAST(TRUNC({_BAL}) AS BIGINT) AS whole FROM customer""",
)
def _(d: Domain) -> DataFrame:
    text = F.expr(_money_text(_BAL))
    return d.table("customer").select(
        "c_custkey",
        parse.parse_scaled(text, 1).cast("double").alias("rounded"),
        parse.parse_whole(text).alias("whole"),
    )


@query(
    "nrm_09_content_keys",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN l_orderkey * 10 + l_linenumber
              ELSE CAST(('0x' || substr(sha256(l_suppkey || '|' || l_orderkey || '|' ||
                   strftime(l_shipdate, '%Y-%m-%d') || '|' || CASE WHEN l_returnflag = 'N' THEN 'Paint'
                   ELSE '' END || '|' || CAST(l_quantity AS INTEGER)), 1, 15)) AS BIGINT) END AS key
       FROM lineitem""",
)
def _(d: Domain) -> DataFrame:
    natural = F.when(F.col("l_returnflag") == "A", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return d.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        parse.content_key(
            "l_suppkey",
            "l_orderkey",
            F.to_date("l_shipdate"),
            F.when(F.col("l_returnflag") == "N", "Paint"),
            F.col("l_quantity").cast("int"),
            natural=natural,
        ).alias("key"),
    )


@query(
    "nrm_10_bill_totals",
    f"""SELECT l_orderkey * 10 + l_linenumber AS id, CAST({m(f'{PRICE} * CAST(0.1 AS DECIMAL(2,1))')}
            + CASE WHEN l_tax > 0 THEN {m(f'{PRICE} * CAST(l_tax AS DECIMAL(4,2))')} ELSE 0 END
            + CASE WHEN l_returnflag = 'N' THEN {m(f'{QTY} * CAST(0.5 AS DECIMAL(2,1))')} ELSE 0 END
            AS DOUBLE) AS total FROM lineitem""",
)
def _(d: Domain) -> DataFrame:
    total = parse.bill_total("bill_amount", "tax_amount", "shipping_amount")
    return d.inventory_bills().select("id", total.cast("double").alias("total"))


def shuffled(report: DataFrame, names: Sequence[str], order: Sequence[int]) -> DataFrame:
    """The report with its cells in another order, and the names that tell them apart."""
    cells = F.array(*[F.get(F.col("row"), i) for i in order])
    return report.withColumns({"row": cells, "columns": F.array(*[F.lit(names[i]) for i in order])})


def leads_report(d: Domain) -> DataFrame:
    """Positional rows, several per job; some name another unit or a test customer."""
    return d.table("lineitem").selectExpr(
        "concat('Unit ', l_orderkey % 25) AS queried_unit",
        "array(CASE WHEN l_discount = 0 THEN 'A Test Person' WHEN l_discount = 0.01 THEN NULL"
        " ELSE concat('Customer ', l_suppkey) END, NULL, NULL, 'ESTIMATE-RES-EXT', NULL,"
        " CAST(l_orderkey AS STRING), CASE WHEN l_tax = 0 THEN '' WHEN l_tax = 0.01 THEN 'Unit X'"
        " ELSE concat('Unit ', l_orderkey % 25) END, NULL, CASE WHEN l_quantity = 1 THEN ''"
        " ELSE date_format(l_shipdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") END) AS row",
    )


_LEADS_ROWS = """SELECT bu_key, job_id, MIN(created) AS job_created_on, 'ESTIMATE-RES-EXT' AS job_type FROM (
           SELECT 'Unit ' || (l_orderkey % 25) AS bu_key, CAST(l_orderkey AS VARCHAR) AS job_id,
                  CASE WHEN l_quantity = 1 THEN TIMESTAMP '1990-01-01' ELSE l_shipdate END AS created
           FROM lineitem WHERE CAST(l_discount AS DECIMAL(4,2)) <> 0 AND CAST(l_tax AS DECIMAL(4,2)) <> 0.01)
       GROUP BY 1, 2"""


@query("nrm_11_leads_rows", _LEADS_ROWS)
def _(d: Domain) -> DataFrame:
    return normalize.leads_rows(
        leads_report(d), "queried_unit", fallback_created=F.expr("TIMESTAMP_NTZ'1990-01-01 00:00:00'")
    ).select("bu_key", "job_id", "job_created_on", "job_type")


@query("nrm_11_leads_rows_by_name", _LEADS_ROWS)
def _(d: Domain) -> DataFrame:
    """The same from rows in another order; the creation time stays in its place, and empty cells stand where cells by
    position would be looked for."""
    names = ("Customer name", "A", "B", "Job Type", "C", "Job Number", "Job Business Unit", "D", "Created Date")
    report = shuffled(leads_report(d), names, (2, 5, 0, 6, 3, 7, 1, 4, 8))
    fallback = F.expr("TIMESTAMP_NTZ'1990-01-01 00:00:00'")
    return normalize.leads_rows(report, "queried_unit", columns="columns", fallback_created=fallback).select(
        "bu_key", "job_id", "job_created_on", "job_type"
    )


def payments_report(d: Domain) -> DataFrame:
    value = "CAST(value AS DECIMAL(14,2))"
    return d.table("events").selectExpr(
        "event_id",
        "array(CASE WHEN event_type = 'signup' THEN 'unknown' ELSE"
        " date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") END, 'Someone',"
        f" CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'view' THEN"
        f" concat('(', format_number({value}, 2), ')') ELSE concat('$', format_number({value}, 2)) END,"
        " CAST(user_id AS STRING), NULL, NULL, NULL,"
        " CASE WHEN user_id % 25 = 0 THEN '  ' ELSE concat(' Unit ', user_id % 25, ' ') END,"
        " CASE WHEN event_type = 'click' THEN '0.004' ELSE '12.5' END) AS row",
    )


_PAYMENT_AMOUNT = f"""CASE event_type WHEN 'error' THEN 0 WHEN 'view' THEN -CAST({EVENT_VALUE} AS DOUBLE)
    ELSE CAST({EVENT_VALUE} AS DOUBLE) END"""


_COLLECTIONS_ROWS = f"""SELECT CASE WHEN user_id % 25 = 0 THEN 'unknown' ELSE 'Unit ' || (user_id % 25) END AS bu_key,
               CASE WHEN event_type <> 'signup' THEN date_trunc('second', ts) END AS payment_date,
               {_PAYMENT_AMOUNT} AS amount, CAST(user_id AS VARCHAR) AS job_id,
               event_type <> 'click' AS has_remaining_balance FROM events"""


@query("nrm_12_collections_rows", _COLLECTIONS_ROWS)
def _(d: Domain) -> DataFrame:
    out = normalize.collections_rows(payments_report(d)).drop("updated_on", "raw")
    return as_double(out, "amount")


@query("nrm_12_collections_rows_by_name", _COLLECTIONS_ROWS)
def _(d: Domain) -> DataFrame:
    names = ("Paid On", "Customer", "Payment Amount", "Invoice Number", "A", "B", "C", "Invoice Business Unit", "Invoice Balance")
    out = normalize.collections_rows(shuffled(payments_report(d), names, range(8, -1, -1)), columns="columns")
    return as_double(out.drop("updated_on", "raw"), "amount")


@query(
    "nrm_16_keyed_collections_rows",
    f"""SELECT CASE WHEN user_id % 25 = 0 THEN '  ' ELSE ' Unit ' || (user_id % 25) || ' ' END AS business_unit,
               CASE WHEN event_type <> 'signup' THEN date_trunc('second', ts) END AS payment_date,
               {_PAYMENT_AMOUNT} AS amount, CAST(user_id AS VARCHAR) AS job_id, TRUE AS has_key FROM events""",
)
def _(d: Domain) -> DataFrame:
    out = normalize.keyed_collections_rows(payments_report(d))
    return as_double(out, "amount").select(
        "business_unit", "payment_date", "amount", "job_id", F.col("id").isNotNull().alias("has_key")
    )


def job_cost_report(d: Domain) -> DataFrame:
    def text(expr: str) -> str:
        return _money_text(f"CAST({expr} AS DECIMAL(14,4))", 4)

    price = "CAST(l_extendedprice AS DECIMAL(14,2))"
    return d.table("lineitem").selectExpr(
        "array(date_format(l_shipdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\"), concat('Unit ', l_orderkey % 25),"
        " concat('Seller ', l_suppkey), '', 'Exterior', NULL, CAST(l_orderkey AS STRING),"
        f" {text(price)}, {text('CAST(l_quantity AS DECIMAL(8,2)) * 10')},"
        f" {text('-CAST(l_quantity AS DECIMAL(8,2))')},"
        f" CASE WHEN l_tax = 0 THEN NULL ELSE {text(price + ' * 0.25BD')} END, '0',"
        f" {text(price + ' * 0.5BD')}, concat(CAST(CAST(l_discount AS DECIMAL(4,2)) AS STRING), '5'),"
        " l_linestatus) AS row"
    )


_HALF = f"{PRICE} * CAST(0.5 AS DECIMAL(2,1))"
_QUARTER = f"{PRICE} * CAST(0.25 AS DECIMAL(3,2))"


@query(
    "nrm_13_job_cost_rows",
    f"""SELECT CAST(l_orderkey AS VARCHAR) AS job_id, l_shipdate AS scheduled_date,
               'Unit ' || (l_orderkey % 25) AS business_unit, 'Seller ' || l_suppkey AS sold_by,
               NULL::VARCHAR AS primary_technician, 'Exterior' AS job_type, l_linestatus AS job_status,
               CAST({PRICE} AS DOUBLE) AS revenue_subtotal, l_quantity * 10 AS labor_pay,
               -l_quantity AS payroll_adjustments, l_quantity * 9 AS labor_total,
               CASE WHEN l_tax = 0 THEN 0 ELSE CAST({_QUARTER} AS DOUBLE) END AS material_costs,
               CAST({_HALF} AS DOUBLE) AS total_costs,
               CAST({PRICE} - {_HALF} AS DOUBLE) AS gross_profit FROM lineitem""",
)
def _(d: Domain) -> DataFrame:
    out = normalize.job_cost_rows(job_cost_report(d)).drop(
        "updated_on", "raw", "customer_name", "return_costs", "gpm_percent"
    )
    return as_double(out, *[c for c, t in out.dtypes if t.startswith("decimal")])


_DAILY_COST_ROWS = f"""SELECT 'Unit ' || (l_orderkey % 25) AS bu_key, CAST(l_orderkey AS VARCHAR) AS job_id,
               l_shipdate AS job_start, 'Exterior' AS job_type, CAST({PRICE} AS DOUBLE) AS job_subtotal,
               CAST(ROUND({_HALF}, 2) AS DOUBLE) AS job_total_costs,
               CAST(CAST(l_discount AS DECIMAL(4,2)) + CAST(0.005 AS DECIMAL(5,4)) AS DOUBLE) AS job_gm_pct
        FROM lineitem"""


@query("nrm_13_daily_job_cost_rows", _DAILY_COST_ROWS)
def _(d: Domain) -> DataFrame:
    out = normalize.daily_job_cost_rows(job_cost_report(d)).drop("updated_on", "raw")
    return as_double(out, "job_subtotal", "job_total_costs", "job_gm_pct")


_COST_NAMES = (
    "Scheduled Date", "Business Unit", "Sold By", "Primary Technician", "Job Type", "Customer Name", "Job #", "Jobs Subtotal",
    "Labor Pay", "Payroll Adjustments", "Material Cost", "Returns", "Jobs Total Cost", "Jobs Gross Margin %", "Status",
)


@query("nrm_13_daily_job_cost_rows_by_name", _DAILY_COST_ROWS)
def _(d: Domain) -> DataFrame:
    report = shuffled(job_cost_report(d), _COST_NAMES, range(14, -1, -1))
    out = normalize.daily_job_cost_rows(report, columns="columns").drop("updated_on", "raw")
    return as_double(out, "job_subtotal", "job_total_costs", "job_gm_pct")


_BOOKING_ROWS = f"""SELECT 'Unit ' || (l_orderkey % 25) AS bu_key, CAST(l_orderkey AS VARCHAR) AS job_id,
               l_shipdate AS scheduled_date, CAST({PRICE} AS DOUBLE) AS job_subtotal,
               TIMESTAMP '{NOW}' AS as_of_date FROM lineitem"""


@query("nrm_14_future_booking_rows", _BOOKING_ROWS)
def _(d: Domain) -> DataFrame:
    out = booking_rows(d).drop("raw", "job_type")
    return as_double(out, "job_subtotal")


@query("nrm_14_future_booking_rows_by_name", _BOOKING_ROWS)
def _(d: Domain) -> DataFrame:
    report = shuffled(job_cost_report(d), _COST_NAMES, range(14, -1, -1))
    out = normalize.future_booking_rows(report, F.expr(f"TIMESTAMP_NTZ'{NOW}'"), columns="columns")
    return as_double(out.drop("raw", "job_type"), "job_subtotal")


def booking_rows(d: Domain) -> DataFrame:
    return normalize.future_booking_rows(job_cost_report(d), F.expr(f"TIMESTAMP_NTZ'{NOW}'"))


@query(
    "nrm_14_booking_total",
    f"SELECT COUNT(*) AS items, CAST(SUM({PRICE}) AS DOUBLE) AS total_bookings FROM lineitem",
)
def _(d: Domain) -> DataFrame:
    return normalize.booking_total(booking_rows(d))


def sales_report(d: Domain) -> DataFrame:
    """Seller, closed, completed, opportunities, rate, total, average."""
    price = "CAST(l_extendedprice AS DECIMAL(14,2))"
    return d.table("lineitem").selectExpr(
        "concat('Unit ', l_suppkey % 25) AS unit",
        "CAST(l_shipdate AS DATE) AS day",
        "array(concat('Seller ', l_suppkey), CAST(l_linenumber AS STRING),"
        " CAST(CASE WHEN l_tax = 0 THEN 0 ELSE l_linenumber END AS STRING),"
        " concat(CAST(CAST(l_quantity AS INT) AS STRING), '.9'), concat(l_linenumber, '%'),"
        f" concat('$', format_number({price}, 2)), '9.999') AS row",
    )


_SALES_ROWS = f"""SELECT CAST(l_shipdate AS DATE) AS event_date, 'Unit ' || (l_suppkey % 25) AS bu_name,
               'Seller ' || l_suppkey AS estimator, CAST(l_quantity AS BIGINT) AS sales_opportunities,
               CAST(CASE WHEN l_tax = 0 THEN 0 ELSE l_linenumber END AS BIGINT) AS completed_est,
               CAST(l_linenumber AS BIGINT) AS closed_opportunities,
               CASE WHEN l_linenumber > 1 THEN l_linenumber / 100.0::DOUBLE ELSE 1 END AS close_rate,
               CAST({PRICE} AS DOUBLE) AS total_sales,
               CASE WHEN l_tax = 0 THEN 10 ELSE {rnd(ratio(PRICE, 'l_linenumber'))} END AS avg_closed_sale
        FROM lineitem"""


@query("nrm_15_sales_rows", _SALES_ROWS)
def _(d: Domain) -> DataFrame:
    out = normalize.sales_rows(sales_report(d), "unit", F.col("day")).drop("updated_on")
    return as_double(out, "close_rate", "total_sales", "avg_closed_sale")


@query(
    "nrm_15_sales_rows_by_name",
    f"""SELECT CAST(l_shipdate AS DATE) AS event_date, 'Unit ' || (l_suppkey % 25) AS bu_name,
               'Seller ' || l_suppkey AS estimator, CAST(l_quantity AS BIGINT) AS sales_opportunities,
               CAST(l_linenumber AS BIGINT) AS completed_est, CAST(l_linenumber AS BIGINT) AS closed_opportunities,
               CASE WHEN l_linenumber > 1 THEN l_linenumber / 100.0::DOUBLE ELSE 1 END AS close_rate,
               CAST({PRICE} AS DOUBLE) AS total_sales, {rnd(ratio(PRICE, 'l_linenumber'))} AS avg_closed_sale FROM lineitem""",
)
def _(d: Domain) -> DataFrame:
    """By name closed opportunities are what was booked; rows carry their own day."""
    day = F.date_format("day", "yyyy-MM-dd'T'HH:mm:ss")
    report = sales_report(d).withColumn("row", F.concat("row", F.array(day)))
    names = ("Estimator", "Closed Opportunities", "Other", "Sales Opportunities", "Close Rate", "TotalSales", "Average Closed Sale", "Sold On")
    report = shuffled(report, names, range(7, -1, -1))
    out = normalize.sales_rows(report, "unit", F.lit("1970-01-01").cast("date"), columns="columns").drop("updated_on")
    return as_double(out, "close_rate", "total_sales", "avg_closed_sale")


_UNIT_SALES_ROWS = f"""SELECT CAST(l_shipdate AS DATE) AS event_date, 'Unit ' || (l_suppkey % 25) AS bu_name,
               CAST(l_quantity AS BIGINT) AS sales_opportunities, CAST(l_linenumber AS BIGINT) AS closed_opportunities,
               CAST(CAST(l_discount AS DECIMAL(4,2)) AS DOUBLE) AS close_rate,
               CAST(0 AS BIGINT) AS completed_est, CAST({PRICE} AS DOUBLE) AS total_sales,
               CAST(0 AS DOUBLE) AS avg_closed_sale FROM lineitem"""


def unit_sales_report(d: Domain) -> DataFrame:
    return d.table("lineitem").selectExpr(
        "CAST(l_shipdate AS DATE) AS day",
        "array(concat('Unit ', l_suppkey % 25), CAST(CAST(l_quantity AS INT) AS STRING),"
        " CAST(l_linenumber AS STRING), CAST(CAST(l_discount AS DECIMAL(4,2)) AS STRING), '',"
        " concat('$', format_number(CAST(l_extendedprice AS DECIMAL(14,2)), 2)), NULL) AS row",
    )


@query("nrm_15_consolidated_sales_rows", _UNIT_SALES_ROWS)
def _(d: Domain) -> DataFrame:
    out = normalize.consolidated_sales_rows(unit_sales_report(d), F.col("day")).drop("updated_on", "raw")
    return as_double(out, "close_rate", "total_sales", "avg_closed_sale")


@query("nrm_15_consolidated_sales_rows_by_name", _UNIT_SALES_ROWS)
def _(d: Domain) -> DataFrame:
    """In an order in which no place that stands in for an empty cell holds a number."""
    names = ("Name", "Sales Opportunity", "Closed Opportunities", "Close rate", "Completed Jobs", "Total Sales", "Closed Average Sale")
    report = shuffled(unit_sales_report(d), names, (1, 2, 3, 5, 4, 0, 6))
    out = normalize.consolidated_sales_rows(report, F.col("day"), columns="columns").drop("updated_on", "raw")
    return as_double(out, "close_rate", "total_sales", "avg_closed_sale")


@query("nrm_17_zip5", "SELECT location_id, zip5, lon, lat FROM location_zips")
def _(d: Domain) -> DataFrame:
    return parse.zip5_with_point(d.locations()).select(
        "location_id", "zip5", F.col("geo_point.lon").alias("lon"), F.col("geo_point.lat").alias("lat")
    )


@query(
    "nrm_18_zip5_from_lines",
    """SELECT c_custkey, CASE WHEN c_mktsegment <> 'AUTOMOBILE'
                              THEN CAST(85001 + c_nationkey AS VARCHAR) END AS zip5 FROM customer""",
)
def _(d: Domain) -> DataFrame:
    rows = d.table("customer").selectExpr(
        "c_custkey",
        "CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN array('12 Main St', 'Town') ELSE"
        " array('12 Main St', concat('Town AZ ', 85001 + c_nationkey, '-0001')) END AS lines",
    )
    return rows.select("c_custkey", parse.zip5_from_lines("lines").alias("zip5"))


@query(
    "nrm_18_zip5_from_addresses",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN NULL
              WHEN 'BUILDING' THEN CAST(85001 + c_nationkey AS VARCHAR)
              ELSE CAST(86001 + c_nationkey AS VARCHAR) END AS zip5 FROM customer""",
)
def _(d: Domain) -> DataFrame:
    """A first, plain address and a preferred one that may lack its ZIP."""
    rows = d.table("customer").selectExpr(
        "c_custkey",
        "CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN array(named_struct('postalCode', 'none', 'isPrimary', true))"
        " ELSE array(named_struct('postalCode', CAST(85001 + c_nationkey AS STRING), 'isPrimary', false),"
        " named_struct('postalCode', CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE"
        " CAST(86001 + c_nationkey AS STRING) END, 'isPrimary', true)) END AS addresses",
    )
    return rows.select("c_custkey", parse.zip5_from_addresses("addresses").alias("zip5"))


@query(
    "nrm_19_unit_labels",
    """SELECT id, CASE business_unit_id WHEN 1 THEN 'East-Production' WHEN 3 THEN 'East-Production'
              WHEN 5 THEN 'West-Production' ELSE 'BU-' || business_unit_id END AS unit_label,
              business_unit FROM dim_jobs""",
)
def _(d: Domain) -> DataFrame:
    label = dims.unit_label_by_id(
        "business_unit_id", {1: "East-Production", 3: "East-Production", 5: "West-Production"}
    )
    return d.dim_jobs().select("id", label.alias("unit_label"), "business_unit")


@query(
    "nrm_20_job_type_categories",
    """SELECT id, CASE job_type_id WHEN 1 THEN 'RESIDENTIAL' WHEN 2 THEN 'COMMERCIAL' ELSE 'OTHER' END
              AS segment, CASE WHEN job_type_id IN (3, 5) THEN 'Warranty' ELSE 'Regular' END AS category
       FROM jobs""",
)
def _(d: Domain) -> DataFrame:
    return d.dim_jobs().select(
        "id",
        parse.job_type_segment("job_type_name").alias("segment"),
        parse.job_type_warranty_category("job_type_name").alias("category"),
    )


@query("nrm_21_local_dates", f"SELECT event_id, {ldate('ts')} AS local_date FROM events")
def _(d: Domain) -> DataFrame:
    return d.table("events").select("event_id", local_date("ts").alias("local_date"))


# --- schema checks -------------------------------------------------------------------

REGISTRY: schema_ops.Registry = {
    "id": ("INT64", True),
    "status": ("STRING", True),
    "total": ("INT64", False),
    "day": ("DATE", False),
    "campaign": ("INT64", True),
}


def order_records(d: Domain) -> DataFrame:
    return d.table("orders").select(
        F.to_json(
            F.struct(
                F.col("o_orderkey").alias("id"),
                F.col("o_orderstatus").alias("status"),
                F.col("o_totalprice").alias("total"),
                F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
                F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("created"),
                (F.col("o_orderstatus") == "F").alias("done"),
                F.struct("o_custkey").alias("customer"),
                F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey") % 5).alias("campaign"),
            )
        ).alias("record")
    )


_N = "(SELECT COUNT(*) FROM orders)"
_N_CAMPAIGN = "(SELECT COUNT(*) FROM orders WHERE o_orderpriority <> '5-LOW')"
_FIELDS = f"""SELECT * FROM (VALUES ('id', 'INT64', {_N}), ('status', 'STRING', {_N}),
    ('total', 'FLOAT64', {_N}), ('day', 'DATE', {_N}), ('created', 'TIMESTAMP', {_N}),
    ('done', 'BOOL', {_N}), ('customer', 'JSON', {_N}), ('campaign', 'INT64', {_N_CAMPAIGN}))
    t(field, inferred_type, n_present)"""


@query("sch_01_inferred_fields", f"SELECT *, CAST(0 AS BIGINT) AS n_null FROM ({_FIELDS})")
def _(d: Domain) -> DataFrame:
    return schema_ops.profile(order_records(d))


@query(
    "sch_01_nested_fields",
    f"""SELECT * FROM (VALUES ('id', 'INT64', {_N}, CAST(0 AS BIGINT)), ('tags', 'ARRAY<STRING>', {_N}, 0),
        ('marks', 'ARRAY<FLOAT64>', {_N}, 0), ('days', 'ARRAY<TIMESTAMP>', {_N}, 0), ('none', 'ARRAY<STRING>', {_N}, 0),
        ('lines', 'ARRAY<JSON>', {_N}, 0), ('customer', 'JSON', {_N}, 0), ('customer.id', 'INT64', {_N}, 0),
        ('customer.since', 'DATE', {_N}, 0), ('customer.place', 'JSON', {_N}, 0),
        ('either', 'STRING', {_N}, (SELECT COUNT(*) FROM orders WHERE o_orderpriority = '5-LOW')))
        t(field, inferred_type, n_present, n_null)""",
)
def _(d: Domain) -> DataFrame:
    """Arrays by the elements of all rows, and the fields of objects one level down."""
    low, day = "o_orderpriority = '5-LOW'", "date_format(o_orderdate, 'yyyy-MM-dd')"
    records = d.table("orders").selectExpr(
        "concat('{\"id\":', o_orderkey, ',\"none\":[],\"tags\":', CASE WHEN o_orderstatus = 'F' THEN '[]' ELSE '[\"a\",null]' END,"
        f" ',\"marks\":', CASE WHEN {low} THEN '[1,2.5]' ELSE '[3]' END,"
        f" ',\"days\":[\"', {day}, '\"', CASE WHEN {low} THEN ',\"2020-01-01T00:00:00\"' ELSE '' END, '],\"lines\":[{{\"n\":1}}]',"
        f" ',\"either\":', CASE WHEN {low} THEN 'null' WHEN o_orderpriority = '2-HIGH' THEN '[1]' ELSE '7' END,"
        f" ',\"customer\":{{\"id\":', o_custkey, ',\"since\":\"', {day}, '\",\"place\":{{\"zip\":1}}}}}}') AS record"
    )
    return schema_ops.profile(records, depth=2)


@query(
    "sch_02_validation",
    f"""SELECT 'total' AS field, 'warning' AS level, 'type_mismatch' AS issue, 'INT64' AS expected_type,
               'FLOAT64' AS inferred_type, CAST(0 AS BIGINT) AS n_missing
        UNION ALL SELECT 'campaign', 'error', 'required_missing', 'INT64', 'INT64', {_N} - {_N_CAMPAIGN}
        UNION ALL SELECT field, 'warning', 'unknown_field', NULL, inferred_type, 0 FROM ({_FIELDS})
            WHERE field IN ('created', 'done', 'customer')""",
)
def _(d: Domain) -> DataFrame:
    return schema_ops.validate(order_records(d), REGISTRY)


@query(
    "sch_03_drift",
    f"""SELECT *, CAST(0 AS BIGINT) AS n_null FROM ({_FIELDS}) WHERE field IN ('created', 'done', 'customer')""",
)
def _(d: Domain) -> DataFrame:
    return schema_ops.drift(order_records(d), REGISTRY)


@query(
    "sch_04_coerced_rows",
    """SELECT o_orderkey AS id, o_orderstatus AS status, CAST(floor(o_totalprice) AS BIGINT) AS total,
              CAST(o_orderdate AS DATE) AS day, NULL::BIGINT AS campaign FROM orders""",
)
def _(d: Domain) -> DataFrame:
    text = d.table("orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast("string").alias("total"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.col("o_orderpriority").alias("campaign"),
    )
    return schema_ops.coerce(text, REGISTRY)


@query(
    "sch_05_registered_schema",
    """SELECT o_orderkey AS id, o_orderstatus AS status, NULL::BIGINT AS total,
              CAST(o_orderdate AS DATE) AS day, CAST(o_custkey % 5 AS BIGINT) AS campaign FROM orders""",
)
def _(d: Domain) -> DataFrame:
    """Rows read back through the schema that the registry gives."""
    records = d.table("orders").select(
        F.to_json(
            F.struct(
                F.col("o_orderkey").alias("id"),
                F.col("o_orderstatus").alias("status"),
                F.to_date("o_orderdate").alias("day"),
                (F.col("o_custkey") % 5).alias("campaign"),
            )
        ).alias("record")
    )
    parsed = F.from_json("record", schema_ops.table_schema(REGISTRY))
    return records.select(parsed.alias("r")).select("r.*")


# --- streams ---------------------------------------------------------------------------

_EVENT_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)


@query(
    "str_01_stream_upsert",
    """SELECT user_id, MAX(ts) AS modified_on, CAST(arg_max(value, ts) AS DOUBLE) AS value
       FROM events GROUP BY 1""",
)
def _(d: Domain) -> DataFrame:
    """The newest event of each user, from a stream of events."""
    table = new_folder(d.spark, "stream-table")
    stream = streams.read_landed(d.spark, d.sf_dir, _EVENT_SCHEMA, pattern="events.parquet").select(
        "user_id", F.col("ts").alias("modified_on"), "value"
    )
    streams.stream_upsert(
        stream,
        table,
        ["user_id"],
        modified="modified_on",
        checkpoint=new_folder(d.spark, "stream-upsert"),
    )
    return tables.current(d.spark, table)


@query(
    "str_02_stream_daily_totals",
    f"""SELECT CAST(ts AS DATE) AS day, event_type AS unit, COUNT(*) AS n, CAST(SUM({EVENT_VALUE}) AS DOUBLE) AS total
        FROM events WHERE CAST(ts AS DATE) + 1 <= (SELECT MAX(ts) FROM events) - INTERVAL 1 HOUR
        GROUP BY 1, 2""",
)
def _(d: Domain) -> DataFrame:
    """Days that are closed, an hour behind the newest event."""
    out = new_folder(d.spark, "daily-totals")
    stream = streams.read_landed(d.spark, d.sf_dir, _EVENT_SCHEMA, pattern="events.parquet").select(
        "ts", F.col("event_type").alias("unit"), F.col("value").cast("decimal(14,2)").alias("value")
    )
    streams.stream_daily_totals(
        stream,
        out,
        event_time="ts",
        unit="unit",
        amount="value",
        lookback="1 hour",
        checkpoint=new_folder(d.spark, "stream-totals"),
    )
    return d.spark.read.parquet(out)


_HALF_WAY = "2024-01-21 00:00:00"


@query(
    "str_02_closed_days",
    f"""SELECT CAST(ts AS DATE) AS day, event_type AS unit, COUNT(*) AS n, CAST(SUM({EVENT_VALUE}) AS DOUBLE) AS total,
               COUNT(*) FILTER (ts < TIMESTAMP '{_HALF_WAY}' AND event_id % 10 >= 8) AS late
        FROM events GROUP BY 1, 2""",
)
def _(d: Domain) -> DataFrame:
    """Events in three landed files out of order: most of the first days, all later days, and what was left of the first.
    The last revision of each day counts; the last days come out when the stream ends."""
    folder, store = new_folder(d.spark, "landed"), new_store(d)
    events = d.table("events").withColumn("value", F.col("value").cast("decimal(14,2)"))
    early, rest = F.col("ts") < F.expr(f"TIMESTAMP_NTZ'{_HALF_WAY}'"), F.col("event_id") % 10 >= 8
    for part in (events.where(early & ~rest), events.where(~early), events.where(early & rest)):
        part.coalesce(1).write.mode("append").parquet(folder)
        stream = streams.read_landed(d.spark, folder, ", ".join(f"{n} {t}" for n, t in events.dtypes))
        streams.stream_closed_days(
            stream, store, "days", event_time="ts", unit="event_type", amount="value", lookback=timedelta(hours=1), checkpoint=f"{store.root}/checkpoint"
        )
    streams.close_days(store, "days")
    last = dedupe.dedupe_latest(store.read("days").drop("cell_day"), ["day", "unit"], [F.desc("revision")])
    return last.select("day", "unit", "n", F.col("total").cast("double").alias("total"), "late")
