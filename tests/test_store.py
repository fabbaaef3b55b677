"""Stored tables: commits, upserts by files, schemas, loads and backfills."""

from __future__ import annotations

import threading
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldkpi.sources import files, loads, sinks
from fieldkpi.sources.store import CELLS, Conflict, Layout, Store, evolved, key_cells

JOBS = "id bigint, status string, modified_on timestamp_ntz"


def newest():
    return (F.col("modified_on").desc_nulls_last(),)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, f"{tmp_path}/store")


def schema(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)


def at(day: int, hour: int = 0) -> str:
    return str(datetime(2024, 1, 1, hour) + timedelta(days=day))


@pytest.fixture
def jobs(frame):
    return lambda rows: frame(JOBS, rows)


LAYOUT = Layout(keys=("id",), day="modified_on")


def loaded(store, jobs, rows):
    def work(t):
        t.ensure("jobs", schema(JOBS), LAYOUT)
        t.append("jobs", jobs(rows))

    store.run("first", work)


def held(df):
    return sorted(((r.id, r.status, r.modified_on and str(r.modified_on), r.day) for r in df.collect()), key=str)


def test_a_file_is_created_once(spark, tmp_path):
    path, wins = f"{tmp_path}/commits/1.json", []
    threads = [threading.Thread(target=lambda k=k: wins.append((files.create_once(spark, path, f"writer {k}"), k))) for k in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    winner = [k for won, k in wins if won]
    assert len(winner) == 1 and files.read(spark, path) == f"writer {winner[0]}"
    assert files.names(spark, f"{tmp_path}/commits") == ["1.json"]
    assert files.names(spark, f"{tmp_path}/nothing") == []


def test_upsert_moves_days_and_keeps_rows_without_key_or_day(store, jobs):
    loaded(store, jobs, [(1, "a", at(0)), (2, "a", at(0)), (3, "a", at(1)), (None, "n", at(1)), (4, "a", None)])
    batch = jobs([(1, "old", at(4)), (1, "b", at(5)), (4, "b", at(0, 7)), (9, "b", None), (None, "m", None)])
    change = store.run("second", lambda t: t.upsert("jobs", batch, newest()))
    assert (change.inserted, change.updated) == (1, 2)
    day = lambda n: date(2024, 1, 1) + timedelta(days=n)
    assert held(store.read("jobs")) == sorted(
        [(1, "b", at(5), day(5)), (2, "a", at(0), day(0)), (3, "a", at(1), day(1)), (None, "n", at(1), day(1)),
         (4, "b", at(0, 7), day(0)), (9, "b", None, None), (None, "m", None, None)], key=str
    )
    assert store.read("jobs", 1).count() == 5
    assert held(store.read("jobs").where("day IS NULL")) == sorted([(9, "b", None, None), (None, "m", None, None)], key=str)


def test_keep_newer_leaves_late_rows_out(store, jobs):
    loaded(store, jobs, [(1, "new", at(5)), (2, "old", at(0))])
    store.run("late", lambda t: t.upsert("jobs", jobs([(1, "late", at(1)), (2, "new", at(3))]), newest(), keep_newer=True))
    assert [(r.id, r.status) for r in store.read("jobs").orderBy("id").collect()] == [(1, "new"), (2, "new")]


def test_an_upsert_rewrites_the_files_of_its_keys_only(store, jobs, spark):
    loaded(store, jobs, [(100 * d + k, "a", at(d)) for d in range(20) for k in range(5)])
    before = {r.path for r in store.manifest(store.commit().tables["jobs"]).collect()}
    change = store.run("few", lambda t: t.upsert("jobs", jobs([(302, "b", at(3)), (1704, "b", at(17)), (350, "new", at(3))]), newest()))
    after = {r.path for r in store.manifest(store.commit().tables["jobs"]).collect()}
    assert change.files == len(before) == 20
    assert change.candidates == change.rewritten == 2 and len(before - after) == 2
    assert (change.inserted, change.updated) == (1, 2) and store.read("jobs").count() == 101
    read = store.read("jobs").where("day = DATE'2024-01-04'")
    assert "PartitionFilters: [isnotnull(day" in read._jdf.queryExecution().toString()
    assert read.count() == 6


def test_files_are_found_by_their_key_column_alone(store, jobs):
    loaded(store, jobs, [(k, "a", at(k % 3)) for k in range(30)])
    t = store.begin()
    state = t.tables["jobs"]
    plan = t._key_paths("jobs", state, [r.path for r in store.manifest(state).collect()])._jdf.queryExecution().toString()
    assert "ReadSchema: struct<id:bigint>" in plan


def test_cells_of_keys(spark):
    own = spark.range(0, 100_000, 7).withColumnRenamed("id", "k")
    cells = key_cells(own, "k", T.LongType())
    assert len(cells) <= CELLS and cells[0][0] == 0 and cells[-1][1] == 99_995
    assert all(a <= b for a, b in cells) and all(x[1] < y[0] for x, y in zip(cells, cells[1:], strict=False))
    most = (1 << 63) - 1
    wide = spark.createDataFrame([(-most,), (most,), (0,)], "k bigint")
    assert key_cells(wide, "k", T.LongType()) == [(-most, -most), (0, 0), (most, most)]
    assert key_cells(own.limit(0), "k", T.LongType()) == []


def test_two_writers_of_one_table_both_survive(store, jobs):
    loaded(store, jobs, [(1, "a", at(0)), (2, "a", at(0))])
    mine, theirs = store.begin(), store.begin()
    mine.upsert("jobs", jobs([(1, "mine", at(1))]), newest())
    theirs.upsert("jobs", jobs([(2, "theirs", at(1))]), newest())
    theirs.commit("theirs")
    with pytest.raises(Conflict):
        mine.commit("mine")
    turns = []

    def work(t):
        turns.append(1)
        t.upsert("jobs", jobs([(1, "mine", at(2))]), newest())
        if len(turns) == 1:  # another writer comes first
            store.run("other", lambda o: o.upsert("jobs", jobs([(3, "other", at(1))]), newest()))

    store.run("mine", work)
    assert len(turns) == 2
    assert [(r.id, r.status) for r in store.read("jobs").orderBy("id").collect()] == [(1, "mine"), (2, "theirs"), (3, "other")]


def test_appends_and_other_tables_do_not_conflict(store, jobs, frame):
    loaded(store, jobs, [(1, "a", at(0))])
    one, two, other = store.begin(), store.begin(), store.begin()
    one.append("jobs", jobs([(2, "one", at(0))]))
    two.append("jobs", jobs([(3, "two", at(0))]))
    other.ensure("notes", schema("note string"))
    other.append("notes", frame("note string", [("x",)]))
    for k, t in enumerate((one, two, other)):
        t.commit(f"run-{k}")
    assert store.numbers() == [1, 2, 3, 4]
    assert [r.id for r in store.read("jobs").orderBy("id").collect()] == [1, 2, 3]
    assert store.read("notes").count() == 1


def test_old_commits_go_and_the_newest_stays(store, jobs):
    loaded(store, jobs, [(k, "a", at(k)) for k in range(5)])
    for k in range(3):
        store.run(f"run-{k}", lambda t, k=k: t.upsert("jobs", jobs([(k, "b", at(k))]), newest()))
    want = held(store.read("jobs"))
    assert store.clean(keep=1) == [1, 2, 3]
    assert store.numbers() == [4] and held(store.read("jobs")) == want
    store.run("after", lambda t: t.upsert("jobs", jobs([(4, "c", at(4))]), newest()))
    assert store.numbers() == [4, 5]


def test_many_appends_are_gathered(store, frame):
    store.run("make", lambda t: t.ensure("log", schema("n bigint")))
    for k in range(30):
        store.run(f"r{k}", lambda t, k=k: t.append("log", frame("n bigint", [(k,)])))
    assert sorted(r.n for r in store.read("log").collect()) == list(range(30))
    assert len(store.commit().tables["log"].parts) < 30


def test_replaced_range_leaves_other_days_alone(store, jobs):
    loaded(store, jobs, [(d, "a", at(d)) for d in range(10)] + [(99, "a", None)])
    new = jobs([(50, "r", at(3)), (51, "r", at(4))])
    change = store.run("range", lambda t: t.replace_range("jobs", new, "modified_on", "2024-01-03", "2024-01-05"))
    assert (change.files, change.rewritten) == (11, 3)
    assert sorted(r.id for r in store.read("jobs").collect()) == [0, 1, 5, 6, 7, 8, 9, 50, 51, 99]


def test_schemas_grow(store, frame):
    old, new = schema("id int, a string"), schema("b double, id bigint, a string")
    assert evolved(old, new) == schema("id bigint, a string, b double")
    assert evolved(new, old) == schema("b double, id bigint, a string")
    with pytest.raises(ValueError, match="column a cannot turn from string to int"):
        evolved(old, schema("a int"))

    def first(t):
        t.ensure("t", old, Layout(keys=("id",)))
        t.append("t", frame("id int, a string", [(1, "x"), (2, "y")]))

    def second(t):
        t.ensure("t", new)
        t.upsert("t", frame("id bigint, a string, b double", [(2, "z", 0.5), (1 << 40, "w", 1.5)]), (F.col("b").desc(),))

    store.run("first", first)
    store.run("second", second)
    assert sorted(tuple(r) for r in store.read("t").collect()) == [(1, "x", None), (2, "z", 0.5), (1 << 40, "w", 1.5)]
    assert sorted(tuple(r) for r in store.read("t", 1).collect()) == [(1, "x"), (2, "y")]
    assert len(store.commit().tables["t"].schemas) == 2


def test_changes_of_an_upsert(store, jobs):
    loaded(store, jobs, [(1, "a", at(0)), (2, "a", at(0))])
    store.run("up", lambda t: t.upsert("jobs", jobs([(1, "b", at(1)), (3, "b", at(1)), (None, "k", None)]), newest(), changes="jobs_changes"))
    got = sorted(((r.id, r.status, r._change) for r in store.read("jobs_changes").collect()), key=str)
    assert got == sorted([(1, "a", -1), (1, "b", 1), (3, "b", 1), (None, "k", 1)], key=str)


def test_a_mart_follows_the_days_that_changed(store, jobs):
    def counts(rows):
        return rows.groupBy(F.to_date("modified_on").alias("kpi_date"), "status").agg(F.count("*").alias("n"))

    def first(t):
        t.ensure("jobs", schema(JOBS), LAYOUT)
        t.append("jobs", jobs([(100 * d + k, "a", at(d)) for d in range(12) for k in range(3)]))
        t.ensure("mart", schema("kpi_date date, status string, n bigint"), Layout(day="kpi_date"))
        t.append("mart", counts(t.read("jobs")))

    def second(t):
        # one row moves, one is new, and the last of day 7 leaves it
        t.upsert("jobs", jobs([(300, "b", at(5)), (999, "b", at(9)), *[(700 + k, "b", at(8)) for k in range(3)]]), newest(), changes="log")
        plan = t.read("jobs").where(F.col("day").isin(*sinks.changed_days(t.read("log"), "modified_on")))
        assert "PartitionFilters: [day" in plan._jdf.queryExecution().toString()
        return sinks.refresh_changed(t, "mart", "jobs", t.read("log"), "modified_on", counts)

    store.run("first", first)
    change = store.run("second", second)
    assert (change.files, change.rewritten) == (12, 5)  # days 3, 5, 7, 8 and 9
    got = sorted((r.kpi_date, r.status, r.n) for r in store.read("mart").collect())
    assert got == sorted((r.kpi_date, r.status, r.n) for r in counts(store.read("jobs")).collect())


# --- loads ----------------------------------------------------------------------


class Times:
    def __init__(self):
        self.now = datetime(2024, 1, 31)

    def __call__(self):
        self.now += timedelta(seconds=1)
        return self.now


def entity():
    return loads.Entity("jobs", schema(JOBS), LAYOUT, newest(), ("id",))


def test_load_is_whole_or_not_at_all(store, jobs):
    clock, marks = Times(), []

    def fetch(rows):
        def run(mark):
            marks.append(mark)
            return jobs(rows)

        return run

    assert loads.load_entity(store, entity(), "r1", fetch([(1, "a", at(0)), (2, "a", at(1))]), clock=clock)
    with pytest.raises(loads.Invalid, match="1 rows without id"):
        loads.load_entity(store, entity(), "r2", fetch([(2, "b", at(2)), (None, "b", at(2))]), clock=clock)
    assert store.read("raw_jobs").where("status = 'b'").isEmpty()
    assert store.read(loads.STATE).count() == 1
    assert loads.load_entity(store, entity(), "r2", fetch([(2, "b", at(2)), (3, "b", at(2))]), clock=clock)
    assert not loads.load_entity(store, entity(), "r2", fetch([(2, "again", at(3))]), clock=clock)
    assert loads.load_entity(store, entity(), "r3", fetch([]), clock=clock)
    assert [(r.id, r.status) for r in store.read("raw_jobs").orderBy("id").collect()] == [(1, "a"), (2, "b"), (3, "b")]
    log = [(r.run_id, r.status, r.records_fetched, r.error_message) for r in store.read(loads.LOG).orderBy("start_time").collect()]
    assert log == [("r1", "success", 2, None), ("r2", "failed", None, "1 rows without id"), ("r2", "success", 2, None), ("r3", "success", 0, None)]
    states = store.read(loads.STATE).orderBy("last_sync_time").collect()
    assert [s.records_processed for s in states] == [2, 2]
    assert marks[0] == datetime(2024, 1, 24, 0, 0, 1) and marks[1] == marks[2] == states[0].last_sync_time and marks[3] == states[1].last_sync_time


def test_a_load_with_new_columns(store, jobs):
    loads.load_entity(store, entity(), "r1", lambda m: jobs([(1, "a", at(0))]), clock=Times())
    loads.load_entity(store, entity(), "r2", lambda m: jobs([(2, "b", at(0))]).withColumn("note", F.lit("x")), clock=Times())
    assert sorted((r.id, r.note) for r in store.read("raw_jobs").collect()) == [(1, None), (2, "x")]
    with pytest.raises(loads.Invalid, match="no column id"):
        loads.load_entity(store, entity(), "r3", lambda m: jobs([(2, "b", at(0))]).drop("id"), clock=Times())


def test_chunks_hold_at_most_so_many_rows(jobs):
    days = [0, 0, 0, 3, 3, 5, 200, 201, 202, 202, 202, 202, 400]
    rows = jobs([(k, "a", at(d)) for k, d in enumerate(days)])
    got = loads.chunks(rows, 2023, date(2025, 6, 1), 3, column="modified_on")
    assert got[0] == (date(2023, 1, 1), date(2024, 1, 1)) and got[-1][1] == date(2025, 6, 2)
    assert all(a[1] == b[0] for a, b in zip(got, got[1:], strict=False))
    per_day = {date(2024, 1, 1) + timedelta(days=d): days.count(d) for d in days}
    sizes = [(sum(n for d, n in per_day.items() if a <= d < b), sum(a <= d < b for d in per_day)) for a, b in got]
    assert sum(n for n, _ in sizes) == len(days) and all(n <= 3 or k == 1 for n, k in sizes)
    assert loads.chunks(rows, 2023, date(2025, 6, 1)) == [(date(2023, 1, 1), date(2024, 1, 1)), (date(2024, 1, 1), date(2025, 1, 1)), (date(2025, 1, 1), date(2025, 6, 2))]


def test_backfill_goes_on_after_an_interruption(store, jobs):
    rows = [(k, "a", at(40 * k)) for k in range(40)]
    clock = Times()
    wanted = [(date(2024 + y, 1, 1), date(2025 + y, 1, 1)) for y in range(5)]
    calls = []

    def fetch(start, end):
        calls.append(start.year)
        if start.year == 2025 and calls.count(2025) == 1:
            raise OSError("line lost\nand more")
        if start.year == 2026 and calls.count(2026) == 1:
            raise KeyboardInterrupt  # the worker is gone, its claim stays
        return jobs([r for r in rows if str(start) <= r[2] < str(end)])

    with pytest.raises(KeyboardInterrupt):
        loads.backfill(store, entity(), wanted, fetch, worker="one", clock=clock)
    state = {r.start_date.year: (r.status, r.failures) for r in loads.ledger(store, "jobs").collect()}
    # the failed chunk came first again, and went through
    assert state == {2024: ("done", 0), 2025: ("done", 1), 2026: ("claimed", 0)}
    assert loads.backfill(store, entity(), wanted, fetch, worker="two", clock=clock) == 2
    assert {r.start_date.year for r in loads.ledger(store, "jobs").where("status = 'done'").collect()} == {2024, 2025, 2027, 2028}
    clock.now += timedelta(hours=7)
    assert loads.backfill(store, entity(), wanted, fetch, worker="two", clock=clock) == 1
    assert sorted(r.id for r in store.read("raw_jobs").collect()) == list(range(40))
    assert loads.ledger(store, "jobs").agg(F.sum("rows")).first()[0] == 40
    assert loads.backfill(store, entity(), wanted, fetch, worker="three", clock=clock) == 0


def test_a_chunk_that_keeps_failing_is_left(store):
    def fetch(start, end):
        raise OSError("no")

    wanted = [(date(2024, 1, 1), date(2025, 1, 1))]
    assert loads.backfill(store, entity(), wanted, fetch, worker="one", clock=Times(), tries=3) == 0
    last = loads.ledger(store, "jobs").first()
    assert (last.status, last.failures, last.error_message) == ("failed", 3, "no")
    assert loads.ledger(store, "other").isEmpty()
