from __future__ import annotations

from datetime import date

import pytest

from conftest import by, rows
from fieldkpi.operators import costing, dims, marts, stage

JOBS = (
    "id bigint, job_number string, customer_id bigint, location_id bigint, business_unit_id bigint,"
    " job_status string, job_type_id bigint, campaign_id bigint, created_on timestamp_ntz,"
    " completed_on timestamp_ntz, modified_on timestamp_ntz"
)


@pytest.fixture
def domain(frame):
    units = frame("id bigint, name string, active boolean", [(1, "North-Sales", True), (2, "North-Production", None)])
    types = frame("id bigint, name string", [(1, "ESTIMATE-RES-EXT"), (2, "Warranty"), (3, "Exterior")])
    at = "2025-08-18 06:59:59"
    jobs = frame(
        JOBS,
        [
            (1, "J1", 10, 1, 1, "Completed", 1, None, at, "2025-08-20 07:00:00", at),
            (2, "J2", 11, 1, 1, "Scheduled", 1, None, "2025-08-18 07:00:00", None, at),
            (3, "J3", 12, 1, 1, "Hold", 1, None, at, None, at),
            (4, "J4", 13, 1, 2, "Completed", 2, None, at, at, at),
            (5, "J5", 13, 1, 2, "Completed", 3, None, at, at, at),
            (6, "J6", 14, 1, None, "Completed", None, None, at, at, at),
        ],
    )
    customers = frame("id bigint, name string", [(10, "Ann"), (11, "Testy Co"), (12, None)])
    estimates = frame(
        "id bigint, job_id bigint, status string, created_on timestamp_ntz, sold_on timestamp_ntz,"
        " sold_by_id bigint, subtotal decimal(18,4), total_tax decimal(18,4), total decimal(18,4)",
        [
            (100, 1, "Sold", at, "2025-08-19 06:00:00", 7, 100.0, None, None),
            (101, 1, "Sold", at, "2025-08-19 06:00:00", 7, 50.0, 5.0, 55.0),
            (102, 1, "Open", at, None, 7, 10.0, None, None),
            (103, 2, "Dismissed", at, None, 7, 10.0, None, None),
            (104, None, "Sold", at, at, 7, 10.0, None, None),
        ],
    )
    invoices = frame(
        "id bigint, job_id bigint, business_unit_id bigint, customer_id bigint, invoice_date timestamp_ntz,"
        " created_on timestamp_ntz, modified_on timestamp_ntz, subtotal decimal(18,4),"
        " sales_tax decimal(18,4), total decimal(18,4), balance decimal(18,4), items string",
        [
            (1, 4, 2, 13, "2025-08-18 00:00:00", at, at, 200.0, 20.0, 220.0, 0.0,
             '[{"type":"Material","cost":"30","total":"60"},{"type":"Equipment","cost":"n/a"},{"type":"Labor","cost":"9"}]'),
            (2, 4, 2, 13, "2025-07-19 00:00:00", at, at, 100.0, 10.0, 110.0, 110.0, "[]"),
            (3, 5, 2, 13, "2025-06-19 00:00:00", at, at, 0.0, 0.0, 0.0, -5.0, None),
            (4, 5, 2, 13, "2025-06-18 00:00:00", at, at, 0.0, 0.0, 0.0, 40.0, None),
            (5, None, 2, 13, "2025-06-18 00:00:00", at, at, 70.0, 0.0, 70.0, 70.0, None),
        ],
    )
    return units, types, jobs, customers, estimates, invoices


def dim(domain):
    units, types, jobs, *_ = domain
    return dims.dim_jobs(jobs, units, types)


def test_dim_jobs_keeps_jobs_without_unit(domain):
    got = by(dim(domain), "id")
    assert got[6]["business_unit"] == "Unknown" and got[6]["job_type_name"] is None
    assert got[4]["business_unit"] == "North-Production"


def test_leads_by_local_day_without_test_names(domain):
    got = by(stage.leads_jobs(dim(domain), domain[3]), "job_id")
    assert set(got) == {1, 3}  # 2 is a test name, 3 has no name
    assert got[1]["lead_date"] == date(2025, 8, 17)


def test_sold_estimates_fall_back_to_subtotal(domain):
    got = by(stage.sold_estimates(domain[4], dim(domain)), "estimate_id")
    assert set(got) == {100, 101}
    assert (got[100]["revenue_amount"], got[101]["revenue_amount"]) == (100, 55)


def test_opportunities(domain):
    opp = stage.opportunity_jobs(dim(domain), domain[4], domain[5])
    got = by(opp, "job_id")
    assert set(got) == {1, 2}  # 3 has neither estimate nor invoice value
    assert got[1]["is_closed_opportunity"] and got[1]["estimate_count"] == 3
    assert got[1]["opportunity_date"] == date(2025, 8, 18)
    assert not got[2]["is_closed_opportunity"] and got[2]["opportunity_date"] is None
    daily = rows(marts.opportunity_daily(opp))
    assert len(daily) == 1 and daily[0]["close_rate_percent"] == 100.0


def test_both_estimates_of_one_moment_win(domain):
    opp = stage.opportunity_jobs(dim(domain), domain[4], domain[5])
    got = by(dims.estimates_with_opportunity(domain[4], opp), "estimate_id")
    assert [got[i]["is_winning_estimate"] for i in (100, 101, 102, 103)] == [True, True, False, False]
    assert 104 not in got


def test_receivable_ages(domain):
    units, _, jobs, *_ = domain
    rows_ = marts.invoices_with_unit(domain[5], jobs, units)
    got = rows(marts.receivables_by_unit(rows_, "2025-08-18"))[0]
    # 30 days old, then 61; the credit counts in the total only
    assert got["ar_0_30_days"] == 110.0 and got["ar_over_60_days"] == 40.0
    assert got["current_outstanding_ar"] == 145.0 and got["unpaid_invoice_count"] == 2


def costing_inputs(frame):
    at = "2025-08-18 07:30:00"
    appts = frame(
        "id bigint, job_id bigint, scheduled_start timestamp_ntz, scheduled_end timestamp_ntz, status string",
        [(1, 4, at, "2025-08-18 09:00:00", "Done"), (2, 4, "2025-08-17 02:00:00", "2025-08-17 03:00:00", "Done")],
    )
    payroll = frame(
        "employee_id bigint, job_id bigint, date timestamp_ntz, activity string, amount decimal(18,4),"
        " paid_duration_hours decimal(18,4), source_entity_id bigint",
        [
            (1, 4, at, "Paint", 50.0, 2.0, 9),
            (1, 4, at, "Paint", 50.0, 2.0, 9),  # exported twice
            (1, 4, at, "Paint", 25.0, 1.0, 9),  # same source, other amount
            (2, 4, at, None, 10.0, 1.0, 8),
            (2, None, at, None, 10.0, 1.0, 8),
        ],
    )
    orders = frame(
        "job_id bigint, status string, total decimal(18,4)",
        [(4, "Received", 40.0), (4, "Canceled", 1000.0), (4, None, 1000.0)],
    )
    returns = frame("job_id bigint, total decimal(18,4)", [(4, 100.0)])
    adjustments = frame("invoice_id bigint, amount decimal(18,4)", [(1, -5.0), (5, -7.0)])
    return appts, payroll, orders, returns, adjustments


def test_job_costing(domain, frame):
    appts, payroll, orders, returns, _ = costing_inputs(frame)
    got = by(costing.job_costing(dim(domain), appts, domain[5], payroll, orders, returns), "job_id")
    assert set(got) == {4}  # only job 4 has an appointment
    job = got[4]
    assert job["labor_cost"] == 85 and job["tech_count"] == 2
    assert job["material_cost_net"] == -60  # more returned than bought
    assert job["revenue_subtotal"] == 300 and job["total_cost"] == 25 and job["gross_profit"] == 275
    assert job["is_warranty"] and job["po_count"] == 1 and job["invoice_count"] == 2


def test_job_costing_variants(domain, frame):
    appts, payroll, orders, returns, adjustments = costing_inputs(frame)
    got = by(
        costing.job_costing(
            dim(domain), appts, domain[5], payroll, orders, returns, adjustments,
            date_rule="fallback_local", include_invoice_materials=True, count_lines=True, warranty_types=(),
        ),
        "job_id",
    )
    assert set(got) == {1, 2, 3, 4, 5, 6}
    assert got[4]["labor_cost"] == 80 and got[4]["payroll_adjustments"] == -5
    assert got[4]["material_cost_raw"] == 70 and got[4]["invoice_material_count"] == 2
    assert got[4]["tech_count"] == 3 and not got[4]["is_warranty"]
    assert str(got[4]["job_start_date"]) == "2025-08-16 19:00:00"
    assert str(got[5]["job_start_date"]) == "2025-08-17 23:59:59"
    assert got[5]["gpm_percent"] is None  # no revenue


def test_margin_of_negative_profit(domain, frame):
    appts, payroll, orders, returns, _ = costing_inputs(frame)
    orders = frame("job_id bigint, status string, total decimal(18,4)", [(4, "Received", 900.0)])
    production = stage.production_jobs(
        costing.job_costing(dim(domain), appts, domain[5], payroll, orders, returns)
    )
    got = rows(marts.margin_daily(production))
    assert got[0]["gpm_percent"] == -195.0 and got[0]["kpi_date"] == date(2025, 8, 17)


def test_future_bookings_start_after_the_day(domain, frame):
    units, _, jobs, *_ = domain
    appts = frame(
        "id bigint, job_id bigint, scheduled_start timestamp_ntz, status string",
        [
            (1, 4, "2025-08-18 23:59:00", "Scheduled"),
            (2, 4, "2025-08-19 00:00:00", "Scheduled"),
            (3, 4, "2025-08-20 00:00:00", "Canceled"),
            (4, 5, "2025-08-19 00:00:00", "Scheduled"),
            (5, 1, "2025-08-19 00:00:00", "Scheduled"),
        ],
    )
    got = rows(marts.future_bookings_daily(appts, jobs, domain[5], units, "2025-08-18"))
    assert got == [
        {"scheduled_date": date(2025, 8, 19), "business_unit": "North-Production", "job_count": 2,
         "total_future_bookings": 330.0, "avg_booking_value": 165.0}
    ]
