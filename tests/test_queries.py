"""Registered queries against their SQL twins, and the plans they get."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry
import check
from pyspark.sql import functions as F

from fieldkpi.operators import kpi, marts
from fieldkpi.plans.domain import Domain

SF = "/root/testdata/sf0.001"
SAMPLE = (
    "snk_04_upsert_days mrt_04_opportunity_daily mrt_14_future_bookings_daily_unit jct_11_job_costing_adjusted"
    " kpi_05_own_dates kpi_06_consolidated reg_02_regional_kpis_by_estimates per_14_sign_audit"
    " dq_03_join_integrity rec_05_missing_and_extra dgn_04_material_components nrm_13_job_cost_rows"
    " ded_06_sales dim_07_estimates_with_opportunity inc_07_late_repair sch_02_validation str_01_stream_upsert"
    " snk_02_additive_schema nrm_13_daily_job_cost_rows_by_name dq_05_suite_samples sch_01_nested_fields"
).split()
NAMES = list(entry.queries()) if os.environ.get("FIELDKPI_ALL") else SAMPLE

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in check.TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_twin(spark, con, name):
    result = check.compare(spark, con, SF, name)
    assert result.startswith(("ok", "rows")), result


def test_all_kpis_by_market_take_rows_of_all_times(spark, con):
    """The window is another query's; both have twins."""
    names = ("rec_03_all_kpis_by_market", "rec_03_all_kpis_by_market_window")
    assert all(check.compare(spark, con, SF, name).startswith(("ok", "rows")) for name in names)
    whole, window = (sum(r["estimates"] or 0 for r in entry.queries()[name](spark, SF).collect()) for name in names)
    assert whole > window > 0


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_twin_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 200


def plan(spark, name: str) -> str:
    return entry.queries()[name](spark, SF)._jdf.queryExecution().toString()


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "inc_03_incremental_slice_all")
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in text
    scan = plan(spark, "jct_01_job_dates")
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in scan


def test_bucketed_tables_join_without_a_shuffle(spark):
    df = entry.queries()["snk_01_bucketed_tables"](spark, SF)
    assert df.count() > 0
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_one_pass_sales_equal_separate_branches(spark):
    d = Domain(spark, SF)
    args = (d.estimates(), d.dim_jobs(), "1997-01-01")
    separate = kpi.stack_values(
        [
            kpi.made_estimates(*args, type_ids=(1, 2)),
            kpi.sold_close_rate(*args, type_ids=(1, 2)),
            kpi.sold_revenue(*args),
        ],
        kpi.RATES,
    )
    columns = separate.columns
    one_pass = kpi.stack_values([kpi.sales_by_own_date(*args, type_ids=(1, 2))], kpi.RATES)
    assert sorted(map(str, one_pass.select(*columns).collect())) == sorted(map(str, separate.collect()))


def test_spine_equals_stack_where_nothing_is_negative(spark):
    d = Domain(spark, SF)
    branches = [
        kpi.created_leads(d.dim_jobs(), "1997-01-01", type_ids=(1, 2)),
        kpi.sold_revenue(d.estimates(), d.dim_jobs(), "1997-01-01"),
    ]
    results = [kpi.spine(branches), kpi.stack_max(branches), kpi.stack_values(branches)]
    columns = results[0].columns
    first, *others = [sorted(map(str, r.select(*columns).collect())) for r in results]
    assert all(o == first for o in others)


def test_units_add_up_to_the_company(spark):
    d = Domain(spark, SF)
    sold = marts.sold_in_sales_units(d.estimates(), d.dim_jobs())
    by_unit = marts.total_sales_daily_unit(sold).agg(F.sum("sold_estimate_count")).first()[0]
    company = marts.total_sales_daily(sold).agg(F.sum("sold_estimate_count")).first()[0]
    assert by_unit == company


@pytest.mark.parametrize("name", ["mrt_04_opportunity_daily", "jct_10_job_costing", "kpi_01_ten_kpis", "dgn_02_booked_by_basis"])
def test_no_pair_products_and_no_python(spark, name):
    text = plan(spark, name)
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval"):
        assert word not in text


def scans(spark, name: str) -> int:
    return entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_kpis_read_each_source_few_times(spark):
    """All ten KPIs come from one pass over each source but the jobs and invoices, which their costing reads too."""
    assert scans(spark, "kpi_01_ten_kpis") <= 19
    assert scans(spark, "jct_12_job_costing_fallback_dates") <= 8


def test_a_window_of_kpis_reaches_the_scan(spark):
    text = plan(spark, "dgn_15_kpi_day_one_unit")
    assert "GreaterThanOrEqual(ts,1998-03-04T00:00), LessThan(ts,1998-03-05T00:00)" in text


@pytest.mark.parametrize("name", ["dgn_01_population_by_date_basis", "dgn_03_lead_funnel"])
def test_steps_are_counted_without_copies_of_the_rows(spark, name):
    assert "Expand" not in entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
