"""Streams that close days and correct them."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from fieldkpi.sources.store import Store
from fieldkpi.streaming import jobs as streams

SCHEMA = "at timestamp_ntz, unit string, amount decimal(14,2)"
EVENTS = "at timestamp_ntz, unit string, amount double"


def land(frame, folder, rows):
    frame(EVENTS, rows).withColumn("amount", F.col("amount").cast("decimal(14,2)")).coalesce(1).write.mode("append").parquet(folder)


def test_days_close_and_are_corrected(spark, frame, tmp_path):
    folder, store = f"{tmp_path}/landed", Store(spark, f"{tmp_path}/store")

    def run():
        streams.stream_closed_days(
            streams.read_landed(spark, folder, SCHEMA), store, "days", event_time="at", unit="unit", amount="amount",
            lookback=timedelta(hours=2), checkpoint=f"{tmp_path}/check",
        )

    def out():
        return sorted((r.day.day, r.unit, r.revision, r.n, float(r.total), r.late) for r in store.read("days").collect())

    land(frame, folder, [("2024-01-01T10:00", "a", 1.0), ("2024-01-01T11:00", "b", 2.0), ("2024-01-02T01:00", "a", 4.0), (None, "a", 9.0)])
    run()
    assert out() == []  # the first day ends an hour before the newest event
    land(frame, folder, [("2024-01-01T23:00", "a", 8.0), ("2024-01-02T02:00", None, 16.0)])
    run()
    closed = [(1, "a", 0, 2, 9.0, 0), (1, "b", 0, 1, 2.0, 0)]
    assert out() == closed
    land(frame, folder, [("2024-01-01T01:00", "a", 32.0), ("2024-01-01T02:00", "c", 64.0), ("2024-01-03T09:00", "a", 128.0)])
    run()
    corrected = [(1, "a", 1, 3, 41.0, 1), (1, "c", 1, 1, 64.0, 1), (2, "a", 0, 1, 4.0, 0), (2, "unknown", 0, 1, 16.0, 0)]
    assert out() == sorted(closed + corrected)
    run()
    assert out() == sorted(closed + corrected)
    streams.close_days(store, "days")
    streams.close_days(store, "days")
    assert out() == sorted([*closed, *corrected, (3, "a", 0, 1, 128.0, 0)])
    assert store.read("days_marks").agg(F.sum("undated")).first()[0] == 1


def test_a_batch_that_comes_again_changes_nothing(spark, frame, tmp_path):
    store = Store(spark, f"{tmp_path}/store")
    rows = frame(EVENTS, [("2024-01-01T10:00", "a", 1.0), ("2024-01-05T10:00", "a", 1.0)]).select(F.to_date("at").alias("day"), "at", "unit", "amount")
    for number in (0, 0, 1, 0):
        store.run(f"b{number}", lambda t, n=number: streams._take(t, "days", rows, n, timedelta(hours=1)))
    got = sorted((r.day, r.n, r.revision, r.late) for r in store.read("days").collect())
    assert got == [(date(2024, 1, 1), 1, 0, 0), (date(2024, 1, 1), 2, 1, 1)]
    assert streams._open_from(datetime(2024, 1, 2, 0, 30), timedelta(hours=1)) == date(2024, 1, 1)


def test_without_events(spark, frame, tmp_path):
    store = Store(spark, f"{tmp_path}/store")
    rows = frame(EVENTS, []).select(F.to_date("at").alias("day"), "at", "unit", "amount")
    store.run("b0", lambda t: streams._take(t, "days", rows, 0, timedelta(hours=1)))
    streams.close_days(store, "days")
    assert store.read("days").count() == 0
