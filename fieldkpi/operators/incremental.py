"""Incremental loads: watermarks, slices, windows, late repair, run log."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldkpi.functions.constants import FIRST_SYNC_DAYS, LOOKBACK_HOURS
from fieldkpi.functions.expr import as_timestamp, day_range, percent, ratio, sum_money
from fieldkpi.sources.tables import upsert


def last_watermarks(
    state: DataFrame, entities: DataFrame, now: str, *, first_days: int = FIRST_SYNC_DAYS
) -> DataFrame:
    """Newest sync time per entity; one that never ran starts some days before ``now``."""
    newest = state.groupBy("entity_type").agg(
        F.max_by("last_sync_time", F.struct("updated_at", "last_sync_time")).alias("last_sync_time")
    )
    start = as_timestamp(now) - F.make_dt_interval(F.lit(first_days))
    return entities.join(newest, "entity_type", "left").select(
        "entity_type", F.coalesce("last_sync_time", start).alias("last_sync_time")
    )


def state_row(state: DataFrame, entity: str, at: str, status: str, records: Column) -> DataFrame:
    """A state row to append, its count taken from ``state``'s rows (a loaded batch)."""
    return state.agg(records.cast("bigint").alias("records_processed")).select(
        F.lit(entity).alias("entity_type"),
        as_timestamp(at).alias("last_sync_time"),
        F.lit(status).alias("last_sync_status"),
        "records_processed",
        as_timestamp(at).alias("updated_at"),
    )


def incremental_slice(
    rows: DataFrame,
    watermark: str,
    entity: str = "",
    *,
    mode: str = "all",
    lookback_hours: int | None = None,
    modified: str = "modified_on",
    created: str = "created_on",
) -> DataFrame:
    """Rows since the watermark less the entity's lookback.

    ``all`` wants both times in the slice, so an old row that was changed now is
    missed; ``any`` takes it.
    """
    hours = LOOKBACK_HOURS.get(entity, 0) if lookback_hours is None else lookback_hours
    since = as_timestamp(watermark) - F.make_dt_interval(hours=F.lit(hours))
    by_modified, by_created = F.col(modified) >= since, F.col(created) >= since
    if mode == "all":
        return rows.where(by_modified & by_created)
    if mode == "any":
        return rows.where(by_modified | by_created)
    raise ValueError(f"unknown mode {mode!r}")


def year_chunks(first_year: int, now: date) -> list[tuple[date, date]]:
    """Half-open calendar years; the last one ends after ``now``."""
    ends = [date(y + 1, 1, 1) for y in range(first_year, now.year)] + [now + timedelta(days=1)]
    return [(date(first_year + i, 1, 1), end) for i, end in enumerate(ends)]


def chunk(rows: DataFrame, start: date, end: date, *, column: str = "created_on") -> DataFrame:
    return rows.where(
        (F.col(column) >= as_timestamp(f"{start} 00:00:00"))
        & (F.col(column) < as_timestamp(f"{end} 00:00:00"))
    )


def year_chunk_counts(rows: DataFrame, first_year: int, now: date, *, column: str = "created_on") -> DataFrame:
    """Rows per backfill chunk, chunks without rows included; one scan for all chunks."""
    chunks = year_chunks(first_year, now)
    counts = rows.agg(
        *[
            F.count_if(
                (F.col(column) >= as_timestamp(f"{a} 00:00:00"))
                & (F.col(column) < as_timestamp(f"{b} 00:00:00"))
            ).alias(f"y{a.year}")
            for a, b in chunks
        ]
    )
    entries = [
        F.struct(F.lit(a.year).alias("year"), F.lit(a).alias("start_date"), F.lit(b).alias("end_date"), F.col(f"y{a.year}").alias("rows"))
        for a, b in chunks
    ]
    return counts.select(F.inline(F.array(*entries)))


def date_windows(bounds: DataFrame, step_days: int, *, done: DataFrame | None = None) -> DataFrame:
    """Fixed-width windows over one row of (first, last), without those already done."""
    step = F.make_dt_interval(F.lit(step_days))
    starts = bounds.select(
        F.explode(F.sequence(F.col("first"), F.col("last"), step)).alias("window_from"), "last"
    )
    windows = starts.select(
        "window_from",
        F.least(F.date_add("window_from", step_days - 1), F.col("last")).alias("window_to"),
    )
    return windows if done is None else windows.join(done, ["window_from", "window_to"], "left_anti")


def trailing_window(as_of: str, days: int, offset: int = 0) -> tuple[date, date]:
    """Last ``days`` days that end ``offset`` days before ``as_of``; 365 is the year before."""
    end = date.fromisoformat(as_of) - timedelta(days=offset)
    return end - timedelta(days=days - 1), end


def late_repair(
    target: DataFrame,
    source: DataFrame,
    modified_range: tuple[str, str],
    work_range: tuple[str, str],
    *,
    key: str = "id",
    modified: str = "modified_on",
    work_day: str = "date",
) -> DataFrame:
    """Rows changed in one range whose work falls in another, upserted into the target."""
    batch = source.where(day_range(modified, *modified_range) & day_range(work_day, *work_range))
    return upsert(target, batch, [key], [F.col(modified).desc_nulls_last()])


def repair_stats(
    before: DataFrame, after: DataFrame, work_range: tuple[str, str], *, work_day: str = "date"
) -> DataFrame:
    """Records, jobs and pay in the work range before and after, and their differences."""

    def totals(df: DataFrame, tag: str) -> DataFrame:
        return df.where(day_range(work_day, *work_range)).agg(
            F.count("*").alias(f"records_{tag}"),
            F.countDistinct("job_id").alias(f"jobs_{tag}"),
            F.coalesce(sum_money("amount"), F.lit(0)).alias(f"labor_{tag}"),
        )

    both = (
        totals(before, "before")
        .unionByName(totals(after, "after"), allowMissingColumns=True)
        .agg(*[F.max(f"{m}_{t}").alias(f"{m}_{t}") for m in ("records", "jobs", "labor") for t in ("before", "after")])
    )
    return both.select(
        *[F.col(f"{m}_{t}").cast("double" if m == "labor" else "bigint").alias(f"{m}_{t}")
          for m in ("records", "jobs", "labor") for t in ("before", "after")],
        (F.col("records_after") - F.col("records_before")).alias("records_delta"),
        (F.col("jobs_after") - F.col("jobs_before")).alias("jobs_delta"),
        (F.col("labor_after") - F.col("labor_before")).cast("double").alias("labor_delta"),
    )


# --- run log ----------------------------------------------------------------------


def run_log_row(batch: DataFrame, entity: str, run_id: str, start: str, end: str, status: str) -> DataFrame:
    """The log row of one run over ``batch``."""
    return batch.agg(F.count("*").alias("records_fetched")).select(
        F.lit(entity).alias("entity_type"),
        F.lit(run_id).alias("run_id"),
        as_timestamp(start).alias("start_time"),
        as_timestamp(end).alias("end_time"),
        F.lit(status).alias("status"),
        "records_fetched",
        F.col("records_fetched").alias("records_inserted"),
        (
            F.unix_millis(as_timestamp(end).cast("timestamp"))
            - F.unix_millis(as_timestamp(start).cast("timestamp"))
        ).alias("duration_ms"),
        F.lit(None).cast("string").alias("error_message"),
    )


def recent_runs(log: DataFrame, entity: str, n: int = 10) -> DataFrame:
    return (
        log.where(F.col("entity_type") == entity)
        .orderBy(F.desc("start_time"), F.desc("run_id"))
        .limit(n)
    )


def _since(now: str, days: int) -> Column:
    return as_timestamp(now) - F.make_dt_interval(F.lit(days))


def success_rates(log: DataFrame, now: str, days: int = 30) -> DataFrame:
    good = F.count_if(F.col("status") == "success")
    return (
        log.where(F.col("start_time") >= _since(now, days))
        .groupBy("entity_type")
        .agg(
            F.count("*").alias("total_runs"),
            good.alias("successful_runs"),
            percent(good, F.count("*")).alias("success_rate_pct"),
        )
    )


def recent_failures(log: DataFrame, now: str, days: int = 7) -> DataFrame:
    return log.where(
        (F.col("status") == "failed") & (F.col("start_time") >= _since(now, days))
    ).select("entity_type", "start_time", "error_message")


def run_health(log: DataFrame, now: str, days: int = 7) -> DataFrame:
    """Last good run, hours since then and mean seconds per entity."""
    return (
        log.where((F.col("start_time") > _since(now, days)) & (F.col("status") == "success"))
        .groupBy("entity_type")
        .agg(
            F.max("start_time").alias("last_run"),
            ratio(F.sum("duration_ms"), F.count("duration_ms")).alias("avg_duration_ms"),
        )
        .withColumn(
            "hours_ago", F.timestamp_diff("HOUR", F.col("last_run"), as_timestamp(now))
        )
    )
