from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import by, rows
from fieldkpi.operators import dedupe, incremental, normalize
from fieldkpi.sources import readers, schema_ops, tables, workspace
from fieldkpi.sources.literals import literal_relation
from fieldkpi.sources.schemas import ENTITIES
from fieldkpi.streaming import jobs as streams

VERSIONS = "id bigint, at timestamp_ntz, note string"


def key(r: dict) -> tuple:
    return tuple(str(v) for v in r.values())


# --- tables ---------------------------------------------------------------------------


def test_upsert_replaces_adds_and_keeps(frame):
    target = frame(VERSIONS, [(1, "2025-01-01", "old"), (2, "2025-01-01", "kept"), (None, None, "keyless")])
    batch = frame(VERSIONS, [(1, "2025-01-02", "new"), (1, "2025-01-01", "stale"), (3, "2025-01-02", "added"), (None, None, "also")])
    once = tables.upsert(target, batch, ["id"], dedupe.newest("at"))
    got = sorted((str(r["id"]), r["note"]) for r in rows(once))
    assert got == [("1", "new"), ("2", "kept"), ("3", "added"), ("None", "also"), ("None", "keyless")]
    keyed = batch.where("id IS NOT NULL")
    twice = tables.upsert(once, keyed, ["id"], dedupe.newest("at"))
    assert sorted(map(key, rows(twice))) == sorted(map(key, rows(once)))


def test_upsert_may_keep_the_newer_target_row(frame):
    target = frame(VERSIONS, [(1, "2025-01-05", "newer")])
    batch = frame(VERSIONS, [(1, "2025-01-02", "late")])
    plain = rows(tables.upsert(target, batch, ["id"], dedupe.newest("at")))
    careful = rows(tables.upsert(target, batch, ["id"], dedupe.newest("at"), keep_newer=True))
    assert (plain[0]["note"], careful[0]["note"]) == ("late", "newer")


def test_upsert_days_rewrites_only_touched_days(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    tables.write_by_day(frame(VERSIONS, [(1, "2025-01-01", "a"), (2, "2025-01-02", "b")]), path, "at")
    before = {f.name for f in (tmp_path / "t" / "day=2025-01-01").glob("*.parquet")}
    tables.upsert_days(spark, path, frame(VERSIONS, [(2, "2025-01-02", "c"), (3, "2025-01-02", "d")]), ["id"], dedupe.newest("at"), "at")
    after = {f.name for f in (tmp_path / "t" / "day=2025-01-01").glob("*.parquet")}
    got = {r["id"]: r["note"] for r in rows(spark.read.parquet(path))}
    assert got == {1: "a", 2: "c", 3: "d"} and before == after


def test_upsert_days_keeps_rows_without_a_day(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    tables.write_by_day(frame(VERSIONS, [(1, None, "a"), (2, None, "b"), (3, "2025-01-01", "c")]), path, "at")
    tables.upsert_days(spark, path, frame(VERSIONS, [(2, None, "new"), (4, None, "d")]), ["id"], dedupe.newest("at"), "at")
    assert {r["id"]: r["note"] for r in rows(spark.read.parquet(path))} == {1: "a", 2: "new", 3: "c", 4: "d"}


def test_upsert_days_moves_a_key_to_its_new_day(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    first = [(1, "2025-01-01", "a"), (2, "2025-01-02", "b"), (3, "2025-01-02", "c"), (4, None, "d")]
    tables.write_by_day(frame(VERSIONS, first), path, "at")
    batch = frame(VERSIONS, [(1, "2025-02-01", "moved"), (2, "2025-02-01", "moved"), (4, "2025-02-03", "moved")])
    for _ in range(2):
        tables.upsert_days(spark, path, batch, ["id"], dedupe.newest("at"), "at")
        got = sorted((r["id"], str(r["day"]), r["note"]) for r in rows(spark.read.parquet(path)))
        assert got == [(1, "2025-02-01", "moved"), (2, "2025-02-01", "moved"), (3, "2025-01-02", "c"), (4, "2025-02-03", "moved")]


def test_refresh_and_snapshot_keep_rows_without_a_date(frame):
    old = frame("day date, n bigint", [(None, 1)]).unionByName(frame("n bigint", [(2,)]).selectExpr("DATE'2025-01-01' AS day", "n"))
    view = frame("n bigint", [(3,)]).selectExpr("DATE'2025-01-30' AS day", "n")
    assert sorted(r["n"] for r in rows(tables.refresh_last_days(old, view, "day", "2025-01-31"))) == [1, 2, 3]
    shots = old.withColumnRenamed("day", "snapshot_date")
    assert sorted(r["n"] for r in rows(tables.append_snapshot(shots, frame("n bigint", [(9,)]), "2025-01-31"))) == [1, 2, 9]


def test_replace_range_includes_both_days(frame):
    target = frame(VERSIONS, [(1, "2025-01-01 23:59:59", "a"), (2, "2025-01-02", "b"), (3, "2025-01-03 23:00:00", "c"), (4, "2025-01-04", "d"), (5, None, "e")])
    out = tables.replace_range(target, frame(VERSIONS, [(9, "2025-01-02", "n")]), "at", "2025-01-02", "2025-01-03")
    assert sorted(r["id"] for r in rows(out)) == [1, 4, 5, 9]


def test_versions_keep_the_old_table_readable(spark, frame, tmp_path):
    table = str(tmp_path / "t")
    tables.publish(frame(VERSIONS, [(1, None, "a")]), table)
    old = tables.current(spark, table)
    tables.publish(frame(VERSIONS, [(2, None, "b")]), table)
    assert [r["id"] for r in rows(tables.current(spark, table))] == [2]
    assert [r["id"] for r in rows(old)] == [1]


def test_snapshot_is_idempotent_per_day(frame):
    view = frame("unit string, ar double", [("a", 1.0)])
    one = tables.append_snapshot(None, view, "2025-01-01")
    two = tables.append_snapshot(one, view, "2025-01-02")
    again = tables.append_snapshot(two, view, "2025-01-02")
    assert again.count() == 2


def test_repair_takes_the_unit_only_for_repaired_rows(frame):
    invoices = frame("id bigint, job_id bigint, job_number string, business_unit_id bigint",
                     [(1, None, "J1", None), (2, None, "J2", 5), (3, 9, "J1", None), (4, None, None, None), (5, None, "J9", None)])
    jobs = frame("id bigint, job_number string, business_unit_id bigint", [(1, "J1", 7), (2, "J2", 7)])
    got = by(tables.repair_foreign_key(invoices, jobs), "id")
    assert [(got[i]["job_id"], got[i]["business_unit_id"]) for i in range(1, 6)] == [
        (1, 7), (2, 5), (9, None), (None, None), (None, None)]


def test_shared_folder_comes_from_the_session(spark):
    assert workspace.new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


# --- readers and records -----------------------------------------------------------------


def test_report_rows_by_name_need_matching_lengths(spark, tmp_path):
    (tmp_path / "r.json").write_text(
        '{"fields":[{"name":"A"},{"name":"B"}],"data":[["1","2"],["3"]]}\n', encoding="utf-8")
    got = rows(readers.read_report(spark, str(tmp_path)).select(readers.named_row().alias("r")))
    assert [r["r"] for r in got] == [{"A": "1", "B": "2"}, {}]


def test_report_fields_fall_back_to_the_position(spark, tmp_path):
    (tmp_path / "r.json").write_text(
        '{"fields":[{"name":"Old"},{"name":"B"}],"data":[["1","2"],["3"],["4","5","6"],["","7"],[]]}\n', encoding="utf-8")
    report = readers.read_report(spark, str(tmp_path))
    got = rows(report.select(readers.row_field(["New", "Old"], 0).alias("a"), readers.row_field(["B"], 1).alias("b")))
    assert [(r["a"], r["b"]) for r in got] == [("1", "2"), ("3", None), ("4", "5"), ("", "7"), (None, None)]


def test_pages_flatten_nested_fields(spark, tmp_path):
    (tmp_path / "p.json").write_text(
        '{"page":1,"data":[{"id":1,"category":{"id":5,"name":"Web"},"createdOn":"2025-01-01T10:00:00Z"},'
        '{"id":"x","active":false}]}', encoding="utf-8")
    records = readers.read_entity_pages(spark, str(tmp_path), multi_line=True)
    got = rows(normalize.flatten_entity(records, "campaigns"))
    first = next(r for r in got if r["category"] == "Web")
    other = next(r for r in got if r is not first)
    assert first["id"] == 1 and first["category_id"] == 5 and str(first["created_on"]) == "2025-01-01 10:00:00"
    assert other["id"] is None and other["active"] is False
    assert first["_ingestion_source"] == "landed_files" and first["_ingested_at"] is not None


def test_every_entity_flattens_to_its_schema(spark):
    record = spark.createDataFrame([("{}",)], "record string")
    for name, entity in ENTITIES.items():
        out = normalize.flatten_entity(record, name)
        assert out.columns == entity.schema().fieldNames(), name


def test_bills_and_adjustments(spark):
    bill = spark.createDataFrame([('{"id":3,"billAmount":"10.5","taxAmount":null,"vendor":{"id":4}}',)], "record string")
    got = rows(normalize.flatten_entity(bill, "inventory_bills"))[0]
    assert got["total"] == 10.5 and got["vendor_id"] == 4 and got["inventory_bill_id"] == 3 and got["id"] > 3
    adjustment = spark.createDataFrame([('{"id":3}',)], "record string")
    assert rows(normalize.flatten_entity(adjustment, "payroll_adjustments"))[0]["active"] is True


def test_leads_rows(spark):
    data = [
        (["Ann", "", "", "EST", "", "1", "U", "", "2025-01-02T00:00:00Z"],),
        (["Ann", "", "", "EST", "", "1", "U", "", "2025-01-01T00:00:00Z"],),
        (["A TEST", "", "", "EST", "", "2", "U", "", ""],),
        ([None, "", "", "EST", "", "3", "", "", ""],),
        (["Bob", "", "", "EST", "", "4", "Other", "", ""],),
    ]
    report = spark.createDataFrame(data, "row array<string>").withColumn("unit", F.lit("U"))
    got = by(normalize.leads_rows(report, "unit", fallback_created=F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'")), "job_id")
    assert set(got) == {"1", "3"}
    assert str(got["1"]["job_created_on"]) == "2025-01-01 00:00:00"
    assert str(got["3"]["job_created_on"]) == "2024-01-01 00:00:00" and got["3"]["created_date"] is None


def test_cells_by_name_come_from_one_map_a_row(spark):
    names = ["Created", "Job Number", "Customer name", "Job Type", "Business Unit", "A", "B", "C", "When"]
    data = [
        (["x", "1", "Ann", "EST", "U", "", "", "", "2025-01-01T00:00:00Z"], names),
        (["x", "2", "A Test", "EST", "U", "", "", "", ""], names),
        (["Bob", "", "", "EST", "", "3", "U", "", "2025-01-03T00:00:00Z"], names[:8]),
        (["x", "4", "Cid", "EST", "V", "", "", "", ""], None),
    ]
    report = spark.createDataFrame(data, "row array<string>, columns array<string>").withColumn("unit", F.lit("U"))
    out = normalize.leads_rows(report, "unit", columns="columns")
    got = by(out, "job_id")
    assert {k: r["customer_name"] for k, r in got.items()} == {"1": "Ann", "3": "Bob", "": "x"}
    assert str(got["1"]["job_created_on"]) == "2025-01-01 00:00:00" and got["1"]["bu_key"] == "U"
    for df in (out, normalize.sales_rows(report, "unit", F.lit("2025-01-01").cast("date"), columns="columns")):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("map_from_arrays") == 1


def test_collections_key_is_stable(spark):
    report = spark.createDataFrame([(["2025-01-01", "x", "(5)", "9", None, None, None, "U"],)], "row array<string>")
    first = rows(normalize.keyed_collections_rows(report))[0]
    second = rows(normalize.keyed_collections_rows(report.union(report)))
    assert first["amount"] == -5 and {r["id"] for r in second} == {first["id"]}


def test_calendar_and_literals(spark):
    days = rows(readers.dashboard_calendar(spark, "2023-01-03"))
    assert days[0] == {"date": date(2023, 1, 1), "week_start": date(2022, 12, 26)}
    assert days[-1]["date"] == date(2024, 1, 3)
    got = rows(literal_relation(spark, "a string, b array<string>, c date", [("x", ["y"], "2025-01-01"), (None, [], None)]))
    assert got[0] == {"a": "x", "b": ["y"], "c": date(2025, 1, 1)} and got[1]["a"] is None
    assert literal_relation(spark, "a string", []).count() == 0


# --- schema checks ----------------------------------------------------------------------


def test_types_of_arrays_and_nested_fields_join_over_all_rows(spark):
    rows_ = ['{"a":[1],"b":[],"c":[[1]],"d":[{"x":1}],"e":[null],"f":[1],"o":{"x":1,"y":[true]}}', '{"a":[2.5,3],"b":[],"c":[],"d":[],"e":[],"f":"t","o":{"x":"s"}}',
             '{"a":[],"g":["2020-01-01"],"o":null}', "no json", '{"g":["2020-01-01T00:00:00"],"h":["x",1]}']
    records = spark.createDataFrame([(r,) for r in rows_], "record string").repartition(3)
    got = {r.field: (r.inferred_type, r.n_present, r.n_null) for r in schema_ops.profile(records, depth=2).where("field IS NOT NULL").collect()}
    assert got == {
        "a": ("ARRAY<FLOAT64>", 3, 0), "b": ("ARRAY<STRING>", 2, 0), "c": ("ARRAY<JSON>", 2, 0), "d": ("ARRAY<JSON>", 2, 0),
        "e": ("ARRAY<STRING>", 2, 0), "f": ("STRING", 2, 0), "g": ("ARRAY<TIMESTAMP>", 2, 0), "h": ("ARRAY<STRING>", 1, 0),
        "o": ("JSON", 3, 1), "o.x": ("STRING", 2, 0), "o.y": ("ARRAY<BOOL>", 1, 0),
    }
    registry = {"n": ("ARRAY<INT64>", False), "t": ("ARRAY<DATE>", True)}
    assert schema_ops.table_schema(registry).simpleString() == "struct<n:array<bigint>,t:array<date>>"
    coerced = schema_ops.coerce(spark.createDataFrame([("[1,2]", "x")], "n string, t string"), registry).first()
    assert coerced.n == [1, 2] and coerced.t is None


def test_profile_and_validation(spark):
    records = spark.createDataFrame(
        [('{"a":1,"b":"2025-01-01","c":null,"e":[1]}',), ('{"a":1.5,"b":"2025-01-01T00:00:00","d":{"x":1}}',)], "record string")
    got = by(schema_ops.profile(records), "field")
    assert {f: r["inferred_type"] for f, r in got.items()} == {
        "a": "FLOAT64", "b": "TIMESTAMP", "c": "STRING", "d": "JSON", "e": "ARRAY<INT64>"}
    registry = {"a": ("FLOAT64", True), "c": ("STRING", True), "z": ("STRING", False), "b": ("DATE", False)}
    issues = by(schema_ops.validate(records, registry), "field")
    assert issues["c"]["level"] == "error" and issues["c"]["n_missing"] == 2
    assert issues["b"]["issue"] == "type_mismatch" and "z" not in issues and "a" not in issues
    grown = schema_ops.extended(registry, schema_ops.drift(records, registry))
    assert grown["d"] == ("JSON", False) and grown["a"] == ("FLOAT64", True)


def test_coerce_nulls_what_does_not_fit(spark):
    df = spark.createDataFrame([("1.9", "x", "yes"), (None, "2", "maybe")], "a string, b string, c string")
    got = rows(schema_ops.coerce(df, {"a": ("INT64", False), "b": ("FLOAT64", False), "c": ("BOOL", False)}))
    assert got == [{"a": 1, "b": None, "c": True}, {"a": None, "b": 2.0, "c": None}]
    assert schema_ops.table_schema({"a": ("INT64", True)}).simpleString() == "struct<a:bigint>"


# --- incremental ------------------------------------------------------------------------


def test_slices(frame):
    schema = "id int, created_on timestamp_ntz, modified_on timestamp_ntz"
    df = frame(schema, [(1, "2025-01-10", "2025-01-10"), (2, "2024-01-01", "2025-01-10"), (3, "2025-01-03 00:00:00", "2025-01-03 00:00:00"), (4, "2025-01-02 23:59:59", "2025-01-02 23:59:59")])
    at = "2025-01-10 00:00:00"
    assert sorted(r["id"] for r in rows(incremental.incremental_slice(df, at, "jobs"))) == [1, 3]
    assert sorted(r["id"] for r in rows(incremental.incremental_slice(df, at, mode="any"))) == [1, 2]
    with pytest.raises(ValueError):
        incremental.incremental_slice(df, at, mode="some")


def test_year_chunks_are_half_open():
    got = incremental.year_chunks(2023, date(2025, 8, 18))
    assert got == [
        (date(2023, 1, 1), date(2024, 1, 1)), (date(2024, 1, 1), date(2025, 1, 1)), (date(2025, 1, 1), date(2025, 8, 19))]


def test_windows(spark):
    bounds = spark.sql("SELECT DATE'2025-01-01' AS first, DATE'2025-01-10' AS last")
    got = sorted(map(key, rows(incremental.date_windows(bounds, 4))))
    assert got == [("2025-01-01", "2025-01-04"), ("2025-01-05", "2025-01-08"), ("2025-01-09", "2025-01-10")]
    assert incremental.trailing_window("2025-01-31", 7, 365) == (date(2024, 1, 26), date(2024, 2, 1))
    assert incremental.trailing_window("2025-01-31", 7) == (date(2025, 1, 25), date(2025, 1, 31))


# --- streams ----------------------------------------------------------------------------


@pytest.mark.parametrize("day_column", [None, "made"])
def test_stream_upsert_equals_batch(spark, frame, tmp_path, day_column):
    schema = "id bigint, made timestamp_ntz, at timestamp_ntz, note string"
    source, table = str(tmp_path / "in"), str(tmp_path / "table")
    made = "2025-01-01 08:00:00"
    batches = [
        [(1, made, "2025-01-01 10:00:00", "a"), (2, made, "2025-01-01 10:00:00", "b"), (1, made, "2025-01-01 10:00:00", "a")],
        [(1, made, "2025-01-02 10:00:00", "c"), (2, made, "2025-01-01 09:00:00", "late")],
    ]
    for i, data in enumerate(batches):
        frame(schema, data).coalesce(1).write.mode("append").parquet(source)
        stream = streams.read_landed(spark, source, schema, files_per_batch=1)
        streams.stream_upsert(stream, table, ["id"], modified="at",
                              checkpoint=str(tmp_path / "cp"), day_column=day_column)
    out = tables.current(spark, table) if day_column is None else spark.read.parquet(table)
    assert {r["id"]: r["note"] for r in rows(out)} == {1: "c", 2: "b"}


@pytest.mark.parametrize("day_column", [None, "made", "at"])
def test_stream_upsert_keeps_late_new_keys(spark, frame, tmp_path, day_column):
    schema = "id bigint, made timestamp_ntz, at timestamp_ntz, note string"
    source, table = str(tmp_path / "in"), str(tmp_path / "table")
    batches = [
        [(1, "2025-06-01", "2025-06-01", "a"), (2, "2025-06-01", "2025-06-01", "b")],
        [(1, "2025-06-01", "2025-06-20", "newer")],
        [(9, "2025-01-01", "2025-01-01", "months late"), (2, "2025-06-01", "2025-05-01", "older")],
    ]
    for data in batches:
        frame(schema, data).coalesce(1).write.mode("append").parquet(source)
        stream = streams.read_landed(spark, source, schema, files_per_batch=1)
        streams.stream_upsert(stream, table, ["id"], modified="at", checkpoint=str(tmp_path / "cp"), day_column=day_column)
    out = tables.current(spark, table) if day_column is None else spark.read.parquet(table)
    assert sorted((r["id"], r["note"]) for r in rows(out)) == [(1, "newer"), (2, "b"), (9, "months late")]
