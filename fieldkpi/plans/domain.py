"""The benchmark star schema seen as field-service tables.

Every domain table is a narrow projection of one given table (no shuffle); event
times stay bare columns, so that filters on them reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldkpi.operators import dims
from fieldkpi.sources.literals import literal_relation

# The job types of the test data.
JOB_TYPES = (
    (1, "ESTIMATE-RES-EXT"),
    (2, "ESTIMATE-COMM-INT"),
    (3, "Warranty"),
    (4, "Exterior Paint"),
    (5, "Touchup"),
    (6, "PM Inspection"),
)

# Amounts of the given tables have two decimals.  They are taken as whole cents, so
# that products stay exact and are computed as longs.
PRICE = "CAST(floor(l_extendedprice * 100 + 0.5D) AS BIGINT)"
DISCOUNT = "CAST(floor(l_discount * 100 + 0.5D) AS BIGINT)"
TAX = "CAST(floor(l_tax * 100 + 0.5D) AS BIGINT)"
QTY = "CAST(l_quantity AS BIGINT)"
LINE_ID = "l_orderkey * 10 + l_linenumber"
EVENT_VALUE = "CAST(floor(value * 100 + 0.5D) AS BIGINT) * 100"


def _money(ten_thousandths: str) -> str:
    """decimal(18,4) from a whole number of ten-thousandths."""
    return f"(CAST({ten_thousandths} AS DECIMAL(13,0)) * 0.0001BD)"


class Domain:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}
        self._jobs: DataFrame | None = None

    def table(self, name: str) -> DataFrame:
        """A given table; its footer is read once per query."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    # --- dimensions -------------------------------------------------------

    def units(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
            "CAST(n_nationkey AS BIGINT) AS id",
            "concat(n_name, CASE WHEN n_nationkey % 2 = 0 THEN '-Sales' ELSE '-Production' END)"
            " AS name",
            "r_name AS region",
            "CASE r_name WHEN 'AFRICA' THEN false WHEN 'ASIA' THEN NULL ELSE true END AS active",
        )

    def regions(self) -> DataFrame:
        return self.units().selectExpr("name AS business_unit", "region")

    def job_types(self) -> DataFrame:
        return literal_relation(self.spark, "id bigint, name string", JOB_TYPES)

    def campaigns(self) -> DataFrame:
        return self.table("region").selectExpr(
            "CAST(r_regionkey AS BIGINT) AS id",
            "concat('Campaign ', r_name) AS name",
            "CASE WHEN r_name = 'ASIA' THEN NULL ELSE true END AS active",
        )

    def technicians(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            "s_suppkey AS id",
            "s_name AS name",
            "CAST(s_nationkey AS BIGINT) AS business_unit_id",
            "CASE WHEN s_acctbal < 0 THEN false ELSE NULL END AS active",
        )

    def customers(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey AS id",
            "CASE WHEN c_acctbal < 0 AND c_mktsegment IN ('MACHINERY', 'HOUSEHOLD')"
            " THEN concat('TEST ', c_name)"
            " WHEN c_acctbal < 0 AND c_mktsegment = 'BUILDING' THEN NULL ELSE c_name END AS name",
            "CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'Commercial'"
            " ELSE 'Residential' END AS type",
            f"{_money('CAST(floor(c_acctbal * 100 + 0.5D) AS BIGINT) * 100')} AS balance",
        )

    def locations(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey AS id",
            "c_custkey AS customer_id",
            "CASE c_mktsegment"
            " WHEN 'HOUSEHOLD' THEN concat('{\"street\":\"1 Main\",\"postalCode\":\"',"
            "   lpad(CAST(501 + c_nationkey AS STRING), 5, '0'), '-1234\"}')"
            " WHEN 'BUILDING' THEN concat('{\"zip\":\"', CAST(85001 + c_nationkey AS STRING),"
            "   '\",\"longitude\":\"', CAST(c_nationkey AS STRING), '.5\",\"latitude\":\"33.25\"}')"
            " WHEN 'FURNITURE' THEN concat('{\"line\":\"Unit ',"
            "   CAST(90001 + c_nationkey AS STRING), ' North\"}')"
            " WHEN 'MACHINERY' THEN concat('{\"postalCode\":\"n/a\",\"zip\":\"',"
            "   CAST(89001 + c_nationkey AS STRING), '\",\"longitude\":\"west\"}')"
            " ELSE '{\"city\":\"none\"}' END AS address",
        )

    # --- facts ------------------------------------------------------------

    def jobs(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey AS id",
            "concat('J', CAST(o_orderkey AS STRING)) AS job_number",
            "o_custkey AS customer_id",
            "o_custkey AS location_id",
            "CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL"
            " ELSE o_custkey % 25 END AS business_unit_id",
            "CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Scheduled'"
            " ELSE CASE o_orderpriority WHEN '1-URGENT' THEN 'InProgress'"
            "   WHEN '2-HIGH' THEN 'Canceled' ELSE 'Hold' END END AS job_status",
            "CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED' THEN 6L"
            " ELSE CAST(substr(o_orderpriority, 1, 1) AS BIGINT) END AS job_type_id",
            "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey % 5 END AS campaign_id",
            "o_orderdate AS created_on",
            "CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 30 DAYS END AS completed_on",
            "CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 45 DAYS ELSE o_orderdate"
            " END AS modified_on",
        )

    def dim_jobs(self) -> DataFrame:
        if self._jobs is None:
            self._jobs = dims.dim_jobs(self.jobs(), self.units(), self.job_types())
        return self._jobs

    def estimates(self) -> DataFrame:
        subtotal = _money(f"{PRICE} * (100 - {DISCOUNT})")
        return self.table("lineitem").selectExpr(
            f"{LINE_ID} AS id",
            "CASE WHEN l_returnflag = 'A' AND l_linenumber = 7 THEN NULL ELSE l_orderkey END"
            " AS job_id",
            "CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'Sold'"
            " WHEN l_returnflag = 'R' THEN 'Dismissed' ELSE 'Open' END AS status",
            "l_shipdate - INTERVAL 14 DAYS AS created_on",
            "CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN l_shipdate END AS sold_on",
            "l_shipdate AS modified_on",
            "l_suppkey AS sold_by_id",
            f"{subtotal} AS subtotal",
            f"CASE WHEN l_tax > 0 THEN {_money(f'{PRICE} * {TAX}')} END AS total_tax",
            f"CASE WHEN l_tax > 0 THEN {_money(f'{PRICE} * (100 - {DISCOUNT} + {TAX})')} END AS total",
        )

    def invoices(self) -> DataFrame:
        """Two invoices per job: a deposit (k = 0) and a final one (k = 1)."""
        cents = "CAST(floor(o_totalprice * 100 + 0.5D) AS BIGINT)"
        share = "CASE WHEN k = 0 THEN 3 ELSE 7 END"
        subtotal = _money(f"{cents} * {share} * 10")
        tax = _money(f"{cents} * {share}")
        total = _money(f"{cents} * {share} * 11")

        def item(kind: str, cost: str, price: str) -> str:
            return (
                f"concat('{{\"type\":\"{kind}\",\"cost\":\"', {cost},"
                f" '\",\"total\":\"', {price}, '\"}}')"
            )

        def text(percent: int) -> str:
            return f"CAST({_money(f'{cents} * {percent}')} AS STRING)"

        items = (
            "CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN NULL WHEN '5-LOW' THEN '[]' ELSE"
            " concat('[', CASE WHEN k = 0 THEN concat("
            + item("Material", f"CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'n/a' ELSE {text(11)} END", text(20))
            + ", ',', "
            + item("Service", text(1), text(10))
            + ") ELSE concat("
            + item("Equipment", text(5), text(15))
            + ", ',', "
            + item("Permit", text(2), text(2))
            + ") END, ']') END"
        )
        return (
            self.table("orders")
            .selectExpr("*", "explode(array(0, 1)) AS k")
            .selectExpr(
                "o_orderkey * 2 + k AS id",
                "CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' AND k = 0 THEN NULL"
                " ELSE o_orderkey END AS job_id",
                "concat('J', CAST(o_orderkey AS STRING)) AS job_number",
                "CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL"
                " ELSE o_custkey % 25 END AS business_unit_id",
                "o_custkey AS customer_id",
                "o_orderdate + make_dt_interval(15 * k) AS invoice_date",
                "o_orderdate + make_dt_interval(15 * k) AS created_on",
                "o_orderdate + make_dt_interval(20 * k) AS modified_on",
                f"{subtotal} AS subtotal",
                f"{tax} AS sales_tax",
                f"{total} AS total",
                f"CASE o_orderstatus WHEN 'F' THEN {_money('0')} WHEN 'O' THEN {subtotal}"
                f" ELSE {total} END AS balance",
                f"{items} AS items",
            )
        )

    def payments(self) -> DataFrame:
        value = _money(EVENT_VALUE)
        return self.table("events").selectExpr(
            "event_id AS id",
            "CASE WHEN event_type = 'error' THEN NULL ELSE event_id * 2 + 1 END AS invoice_id",
            f"CASE WHEN event_type = 'view' THEN -{value} ELSE {value} END AS amount",
            "user_id AS payment_type_id",
            "ts AS created_on",
            "ts AS modified_on",
        )

    def payroll(self) -> DataFrame:
        """First lines were exported twice, so exact duplicates occur."""
        return (
            self.table("lineitem")
            .selectExpr("*", "explode(CASE WHEN l_linenumber = 1 THEN array(0, 1) ELSE array(0) END)")
            .selectExpr(
                "l_suppkey AS employee_id",
                "CASE WHEN l_returnflag = 'A' AND l_linenumber = 7 THEN NULL ELSE l_orderkey END"
                " AS job_id",
                "l_shipdate AS date",
                "CASE WHEN l_linenumber <= 3 THEN 'Paint' WHEN l_linenumber <= 6 THEN 'Prep' END"
                " AS activity",
                f"{_money(f'{QTY} * 255000')} AS amount",
                f"{_money(f'{QTY} * 10000')} AS paid_duration_hours",
                f"{LINE_ID} AS source_entity_id",
                "concat('Unit ', CAST(l_suppkey % 25 AS STRING)) AS business_unit_name",
                "l_shipdate + INTERVAL 2 DAYS AS modified_on",
            )
        )

    def payroll_adjustments(self) -> DataFrame:
        return self.table("lineitem").where("l_returnflag = 'R'").selectExpr(
            f"{LINE_ID} AS id",
            "l_orderkey * 2 + 1 AS invoice_id",
            "l_suppkey AS employee_id",
            f"{_money(f'-{QTY} * 15000')} AS amount",
            "l_shipdate AS posted_on",
        )

    def purchase_orders(self) -> DataFrame:
        subtotal = _money(f"{PRICE} * 10")
        return self.table("lineitem").selectExpr(
            f"{LINE_ID} AS id",
            "l_orderkey AS job_id",
            "l_suppkey AS vendor_id",
            "CASE WHEN l_returnflag = 'R' THEN CASE WHEN l_linestatus = 'O' THEN 'Canceled' END"
            " WHEN l_returnflag = 'A' THEN 'Received' ELSE 'Pending' END AS status",
            "l_shipdate AS date",
            f"{subtotal} AS subtotal",
            f"{_money(f'{QTY} * 2500')} AS tax",
            f"{_money(f'{QTY} * 5000')} AS shipping",
            f"{_money(f'{QTY} * 1000')} AS discount",
            f"{_money(f'{PRICE} * 10 + {QTY} * 6500')} AS total",
            "concat('[{\"total\":\"',"
            f" CAST({_money(f'{PRICE} * 6')} AS STRING), '\"}},{{\"total\":\"',"
            f" CAST({_money(f'{PRICE} * 4')} AS STRING), '\"}}]') AS items",
            "l_shipdate AS modified_on",
        )

    def returns(self) -> DataFrame:
        return self.table("lineitem").where("l_returnflag = 'R'").selectExpr(
            f"{LINE_ID} AS id",
            "l_orderkey AS job_id",
            "l_suppkey AS vendor_id",
            "l_shipdate + INTERVAL 20 DAYS AS return_date",
            f"{_money(f'{QTY} * 22500')} AS subtotal",
            f"{_money(f'{QTY} * 2500')} AS tax",
            f"{_money(f'{QTY} * 25000')} AS total",
        )

    def appointments(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            f"{LINE_ID} AS id",
            "l_orderkey AS job_id",
            "l_shipdate AS scheduled_start",
            "l_shipdate + make_dt_interval(0, CAST(l_quantity AS INT)) AS scheduled_end",
            "CASE l_returnflag WHEN 'A' THEN 'Done' WHEN 'N' THEN 'Scheduled'"
            " ELSE CASE WHEN l_linestatus = 'O' THEN 'Canceled' ELSE 'Cancelled' END END AS status",
            "l_shipdate - INTERVAL 10 DAYS AS created_on",
            "l_shipdate AS modified_on",
        )

    def inventory_bills(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            f"{LINE_ID} AS id",
            "l_suppkey AS vendor_id",
            "l_orderkey AS job_id",
            "l_shipdate AS bill_date",
            f"{_money(f'{PRICE} * 10')} AS bill_amount",
            f"CASE WHEN l_tax > 0 THEN {_money(f'{PRICE} * {TAX}')} END AS tax_amount",
            f"CASE WHEN l_returnflag = 'N' THEN {_money(f'{QTY} * 5000')} END AS shipping_amount",
        )

    # --- run log and report tables ----------------------------------------

    def run_log(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_type AS entity_type",
            "event_id AS run_id",
            "ts AS start_time",
            "CASE WHEN CAST(get_json_object(props, '$.k') AS INT) < 10 THEN 'failed'"
            " ELSE 'success' END AS status",
            "CAST(get_json_object(props, '$.k') AS BIGINT) AS records_fetched",
            "CAST(floor(value * 100 + 0.5D) AS BIGINT) * 10 AS duration_ms",
            "CASE WHEN CAST(get_json_object(props, '$.k') AS INT) < 10"
            " THEN concat('code ', get_json_object(props, '$.k')) END AS error_message",
        )

    def sync_state(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_type AS entity_type",
            "ts - INTERVAL 1 HOUR AS last_sync_time",
            "CASE WHEN CAST(get_json_object(props, '$.k') AS INT) < 10 THEN 'failed'"
            " ELSE 'success' END AS last_sync_status",
            "CAST(get_json_object(props, '$.k') AS BIGINT) AS records_processed",
            "ts AS updated_at",
        )

    def collections(self) -> DataFrame:
        """Rows of the payments report; unit names come as text."""
        value = _money(EVENT_VALUE)
        return self.table("events").selectExpr(
            "CASE WHEN event_type = 'error' THEN NULL ELSE concat('Unit ',"
            " CAST(user_id % 25 AS STRING)) END AS business_unit",
            "ts AS payment_date",
            "CASE WHEN event_type = 'view' THEN -" + value
            + " WHEN event_type = 'signup' AND user_id < 10 THEN NULL"
            + " WHEN event_type = 'click' AND user_id < 10 THEN CAST(0 AS DECIMAL(18,4))"
            + f" ELSE {value} END AS amount",
            "CAST(user_id AS STRING) AS job_id",
            "ts + INTERVAL 1 HOUR AS updated_on",
            "props AS raw",
        )

    def report_leads(self) -> DataFrame:
        """Landed several times over, so keys repeat."""
        return self.table("lineitem").selectExpr(
            "concat('Unit ', CAST(l_orderkey % 25 AS STRING)) AS bu_key",
            "l_shipdate AS job_created_on",
            "CASE WHEN l_orderkey % 3 = 0 THEN 'ESTIMATE-RES-EXT' ELSE 'ESTIMATE-COMM-INT' END"
            " AS job_type",
            "CAST(l_orderkey AS STRING) AS job_id",
            "l_shipdate + make_dt_interval(l_linenumber) AS updated_on",
        )

    def report_job_cost(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "concat('Unit ', CAST(l_orderkey % 25 AS STRING)) AS bu_key",
            "CAST(l_orderkey AS STRING) AS job_id",
            "l_shipdate AS job_start",
            f"{_money(f'{PRICE} * 100')} AS job_subtotal",
            f"{_money(f'{PRICE} * (50 + {DISCOUNT})')} AS job_total_costs",
            "l_shipdate + make_dt_interval(l_linenumber) AS updated_on",
        )

    def report_future_bookings(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "concat('Unit ', CAST(l_orderkey % 25 AS STRING)) AS bu_key",
            "CAST(l_orderkey AS STRING) AS job_id",
            "l_shipdate AS scheduled_date",
            f"{_money(f'{PRICE} * 100')} AS job_subtotal",
            "l_shipdate - make_dt_interval(l_linenumber) AS as_of_date",
        )

    def report_sales(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "CAST(l_shipdate AS DATE) AS event_date",
            "concat('Unit ', CAST(l_suppkey % 25 AS STRING)) AS bu_name",
            "concat('Seller ', CAST(l_suppkey AS STRING)) AS estimator",
            "CAST(l_quantity AS BIGINT) AS sales_opportunities",
            "CAST(l_linenumber AS BIGINT) AS closed_opportunities",
            f"{_money(f'{PRICE} * 100')} AS total_sales",
            f"{_money(f'{PRICE} * {DISCOUNT}')} AS avg_closed_sale",
        )

    def report_receivables(self) -> DataFrame:
        return self.table("events").selectExpr(
            "concat('Unit ', CAST(user_id % 25 AS STRING)) AS bu_key",
            "ts AS as_of",
            "event_type AS location_name",
            f"{_money(EVENT_VALUE)} AS net_amount",
            "ts AS updated_on",
            "props AS raw",
        )
