from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import by, rows
from fieldkpi.functions.constants import CAUTION, FLAG_RED, TICK
from fieldkpi.operators import dims, kpi, periods, quality, reconcile, regional
from fieldkpi.operators.quality import Check, Metric

D1, D2 = date(2025, 8, 18), date(2025, 8, 19)


@pytest.fixture
def branches(frame):
    keys = "event_date date, business_unit string, "
    return [
        frame(keys + "leads bigint", [(D1, "a", 3), (D2, "a", 1)]),
        frame(keys + "margin double, dollars double", [(D1, "a", -5.0, 100.0), (D1, "b", -7.0, 0.0)]),
    ]


def test_stack_max_hides_a_negative_beside_another_branch(branches):
    got = by(kpi.stack_max(branches), "event_date", "business_unit")
    assert got[(D1, "a")]["margin"] == 0.0  # padded
    assert got[(D1, "b")]["margin"] == -7.0  # alone, nothing to hide behind
    assert got[(D2, "a")] == {"event_date": D2, "business_unit": "a", "leads": 1, "margin": 0.0, "dollars": 0.0}


def test_stack_values_keeps_negatives_and_missing_rates(branches):
    got = by(kpi.stack_values(branches, rates=("margin",)), "event_date", "business_unit")
    assert got[(D1, "a")]["margin"] == -5.0 and got[(D1, "a")]["leads"] == 3
    assert got[(D2, "a")]["margin"] is None and got[(D2, "a")]["dollars"] == 0.0


def test_spine_joins_snapshots_on_the_unit(branches, frame):
    snapshot = frame("business_unit string, ar double", [("a", 9.0)])
    got = by(kpi.spine(branches, [snapshot]), "event_date", "business_unit")
    assert got[(D2, "a")]["ar"] == 9.0 and got[(D1, "b")]["ar"] == 0.0 and len(got) == 3
    loose = by(kpi.spine(branches, fill=False), "event_date", "business_unit")
    assert loose[(D2, "a")]["margin"] is None


def test_regions_weight_by_dollars(frame):
    daily = frame(
        "event_date date, business_unit string, lead_count bigint, total_booked double, num_estimates bigint,"
        " dollars_produced double, gpm_percent double, warranty_percent double, dollars_collected double,"
        " outstanding_ar double, future_bookings double".replace(",event", ", event"),
        [
            (D1, "x-Sales", 4, 10.0, 1, 5.0, 99.0, 9.0, 1.0, 0.0, 7.0),
            (D1, "x-Production", 9, 0.0, 9, 100.0, 50.0, None, 2.0, 3.0, 8.0),
            (D1, "y-Production", 0, 0.0, 0, 300.0, 10.0, 4.0, 0.0, 0.0, 0.0),
            (D1, "Unknown", 1, 1.0, 1, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0),
        ],
    )
    regions = frame("business_unit string, region string", [("x-Sales", "R"), ("x-Production", "R"), ("y-Production", "R")])
    got = rows(regional.regional_kpis(daily, regions, "2020-01-01"))
    assert len(got) == 1
    r = got[0]
    assert (r["lead_count"], r["num_estimates"], r["close_rate_percent"]) == (4, 1, 25.0)
    assert r["gpm_percent"] == 20.0 and r["warranty_percent"] == 3.0
    assert r["dollars_collected"] == 3.0 and r["future_bookings"] == 7.0
    assert rows(regional.unmapped_units(daily, regions)) == [{"business_unit": "Unknown", "days": 1}]


def test_region_map_and_rollup(spark, frame):
    mapped = dims.region_map(spark, [("N", "North", ["a", "b"], ["c"]), ("S", "South", [], ["d"])])
    assert sorted((r["region_key"], r["bu_key"], r["bu_type"]) for r in rows(mapped)) == [
        ("N", "a", "sales"), ("N", "b", "sales"), ("N", "c", "production"), ("S", "d", "production")]
    units = frame("id bigint, name string", [(1, " North-Sales "), (2, "Other")])
    wanted = frame("bu_name string, bu_group string, bu_rollup string",
                   [("North-Sales", "SALES", "N"), ("Old North - Sales", "SALES", "N")])
    got = by(dims.unit_rollup(wanted, units), "bu_name")
    assert got["North-Sales"]["business_unit_id"] == 1 and got["North-Sales"]["discovered"]
    assert got["Old North - Sales"]["discovered"] is False


def test_growth_alert_needs_a_previous_week(frame):
    weekly = frame("business_unit string, week_start date, x double",
                   [("a", date(2025, 8, 4), 100.0), ("a", date(2025, 8, 11), 111.0), ("a", date(2025, 8, 18), 122.0), ("b", date(2025, 8, 4), 9.0)])
    got = rows(periods.week_over_week(weekly, "x"))
    assert [(r["week_start"], r["growth_pct"]) for r in got] == [(date(2025, 8, 11), 11.0)]


def test_year_over_year_keeps_one_sided_days(frame):
    daily = frame("event_date date, business_unit string, x double",
                  [(date(2025, 8, 18), "a", 6.0), (date(2024, 8, 18), "a", 5.0), (date(2024, 8, 19), "a", 5.0)])
    got = by(periods.year_over_year(daily, "x", "2025-08-18", "2025-08-20"), "event_date")
    assert got[D1]["change_pct"] == 20.0 and got[D2]["current"] is None and len(got) == 2


def test_sign_audit_samples_are_few(frame):
    data = [("a", f"2025-01-{i:02d}", -1.0 if i < 9 else 2.0, str(i)) for i in range(1, 11)] + [(" ", None, None, "x"), (None, None, 0.0, "y")]
    df = frame("business_unit string, payment_date timestamp_ntz, amount decimal(18,4), job_id string", data)
    got = by(periods.sign_audit(df), "unit")
    assert got["a"]["negative_samples"] == "1,2,3,4,5" and got["a"]["negative_count"] == 8
    assert got["unknown"]["zero_count"] == 2 and got["unknown"]["negative_samples"] is None


def test_report_totals_add_up(frame):
    df = frame("bu_name string, sales_opportunities bigint, closed_opportunities bigint, total_sales decimal(18,4)",
               [("a", 1, 1, 1.5), ("b", 2, 0, 2.5), (None, 1, 0, 1.0)])
    got = rows(periods.report_totals(df))
    assert len(got) == 4
    assert next(r for r in got if r["bu_name"] == "ALL")["total_sales"] == 5.0


def test_stoplight_directions(frame):
    df = frame("a bigint", [(1,), (None,)])
    metrics = [
        Metric("share", F.lit(80.0), 90, 95), Metric("age", F.lit(5), 48, 4, "hours", False),
        Metric("volume", F.count("*"), 1, 2, "records"), Metric("copies", F.lit(11), 10, 1, "records", False),
    ]
    got = {r["metric"]: r["status"][2:] for r in rows(quality.stoplight([(df, metrics)]))}
    assert got == {"share": "RED", "age": "YELLOW", "volume": "GREEN", "copies": "RED"}


def test_suite_counts_and_fails(frame):
    df = frame("status string", [("🔴 RED",), ("🟢 GREEN",), ("🟢 GREEN",)])
    got = rows(quality.run_suite({"c": Check(df, "status", quality.any_status("status", "RED")),
                                  "d": Check(df.limit(0), "status", quality.any_status("status", "RED"))}))
    assert got[0] == {"check": "c", "status": "FAILED", "row_count": 3, "red": 1, "yellow": 0, "green": 2}
    assert got[1]["status"] == "PASSED"


def test_orphans_and_duplicates(frame):
    child = frame("k bigint", [(1,), (1,), (9,), (9,), (None,)])
    assert rows(quality.orphans(child, frame("id bigint", [(1,)]), "k")) == [{"k": 9, "rows": 2}]
    assert {r["k"] for r in rows(quality.duplicate_keys(child, ["k"]))} == {1, 9}


def test_unlisted_types_ignore_null_entries(frame):
    used = frame("job_type_name string", [("a",), ("b",), (None,)])
    allowed = frame("job_type_name string", [("a",), (None,)])
    assert rows(quality.unlisted_types(used, allowed)) == [{"job_type_name": "b"}]


def test_variance_bands(frame):
    schema = "k string, n double, d double"
    actual = frame(schema, [("a", 11.0, 100.0), ("b", 20.0, 150.0)])
    expected = frame(schema, [("a", 10.0, 100.0), ("b", 10.0, 100.0), ("c", 1.0, 0.0)])
    got = by(reconcile.variance_by_key(actual, expected, "k", {"n": reconcile.COUNT_BAND, "d": reconcile.DOLLAR_BAND}), "k")
    assert got["a"]["n_status"].endswith("EXACT") and got["a"]["d_status"].endswith("EXACT")
    assert got["b"]["n_status"].endswith("MAJOR") and got["b"]["d_status"].endswith("MINOR")
    assert got["c"]["actual_n"] is None and got["c"]["d_pct"] is None


def test_long_comparison_ticks(frame):
    schema = "u string, a double, b double, c double, d double"
    got = by(reconcile.long_comparison(frame(schema, [("x", 100.5, 105.0, 120.0, 5.0)]),
                                       frame(schema, [("x", 100.0, 100.0, 100.0, 0.0)]), "u", ["a", "b", "c", "d"]), "kpi")
    assert [got[k]["status"] for k in "abcd"] == [TICK, CAUTION, FLAG_RED, CAUTION]


def test_job_comparison_signs(frame):
    schema = "job_id bigint, business_unit string, labor decimal(18,4), materials decimal(18,4)"
    ours = frame(schema, [(1, "a", 10.0, 0.0), (2, "a", 5.0, 5.0), (3, "a", 0.0, 0.0), (5, "a", 1.0, 1.0)])
    theirs = frame(schema, [(2, "b", 7.0, 5.0), (4, "b", 0.0, 3.0), (5, "a", 1.005, 1.0)])
    got = by(reconcile.compare_jobs(ours, theirs), "job_id")
    assert {k: (r["type"], float(r["labor_diff"]), float(r["materials_diff"])) for k, r in got.items()} == {
        1: ("DB_ONLY", -10.0, 0.0), 2: ("DIFFERENT", -2.0, 0.0), 4: ("ST_ONLY", 0.0, 3.0)}
    assert got[2]["business_unit"] == "b"


def test_missing_extra_reasons(frame):
    schema = "job_id bigint, revenue decimal(18,4)"
    listed = frame(schema, [(1, 10.0), (2, 10.0), (3, 10.0), (4, 10.0)])
    jobs = frame(schema, [(2, 10.0), (3, 0.0), (4, 9.0), (5, 3.0), (6, 0.0)])
    issues = reconcile.missing_and_extra(listed, jobs)
    assert {r["job_id"]: r["reason"] for r in rows(issues)} == {
        1: "Job not found", 3: "Job without revenue", 4: "Revenue mismatch", 5: "Not listed"}
    totals = by(reconcile.impact_totals(issues, listed, jobs), "issue_type")
    assert totals["Missing"]["total_revenue"] == 30.0 and totals["Extra"]["total_revenue"] == 3.0


def test_fan_out_equals_the_join_it_avoids(frame):
    jobs = frame("id bigint", [(1,), (2,), (3,)])
    a = frame("job_id bigint, x decimal(18,4)", [(1, 1.0), (1, 2.0), (2, 5.0), (None, 9.0)])
    b = frame("job_id bigint, y decimal(18,4)", [(1, 10.0), (1, 20.0), (1, 30.0)])
    got = rows(reconcile.fan_out_totals([(a, "x"), (b, "y")], jobs))[0]
    joined = jobs.withColumnRenamed("id", "job_id").join(a, "job_id", "left").join(b, "job_id", "left").agg(F.sum("x"), F.sum("y")).first()
    assert (got["joined_x"], got["joined_y"]) == (float(joined[0]), float(joined[1])) == (14.0, 120.0)
    assert (got["true_x"], got["true_y"]) == (8.0, 60.0)


def test_markets_join_both_sides(frame):
    sales = frame("business_unit string, leads bigint", [("x-Sales", 1), ("y-Sales", 2)])
    made = frame("business_unit string, produced double", [("x-Production", 5.0), ("z-Production", 6.0)])
    got = by(reconcile.by_market([sales, made]), "market")
    assert set(got) == {"x", "y", "z"} and got["x"] == {"market": "x", "leads": 1, "produced": 5.0}


def test_fan_out_of_one_hot_job_does_not_overflow(spark):
    children = [(spark.range(60_000).selectExpr("1L AS job_id", f"CAST(1 AS decimal(18,4)) AS c{i}"), f"c{i}") for i in range(4)]
    got = rows(reconcile.fan_out_totals(children, spark.range(1, 2)))[0]
    assert got["true_c0"] == 60_000 and got["joined_c0"] == 60_000.0**4
