"""Dedupe policies: keep the newest row per key.

Ranking filters to the first row per key, which Spark applies once before the
shuffle (window group limit), so a key with very many copies sends at most one row
per input partition to its task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldkpi.operators.costing import PAYROLL_LINE_KEY


def newest(*columns: str) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def dedupe_latest(rows: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """One row per key by ``order``; ties fall to the remaining columns, so that the
    result does not depend on how the rows were read."""
    ties = [F.col(c).asc_nulls_last() for c, t in rows.dtypes if _sortable(t)]
    window = Window.partitionBy(*keys).orderBy(*order, *ties)
    return rows.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def _sortable(dtype: str) -> bool:
    return "map<" not in dtype and "variant" not in dtype


def leads(rows: DataFrame) -> DataFrame:
    return dedupe_latest(rows, ["job_id", "bu_key"], newest("job_created_on", "updated_on"))


def collections(rows: DataFrame) -> DataFrame:
    return dedupe_latest(rows, ["job_id", "payment_date"], newest("updated_on"))


def receivables(rows: DataFrame, *, payload: str = "raw") -> DataFrame:
    """Equal payloads are copies.  The payload is hashed, so the shuffle key is short."""
    return dedupe_latest(rows, [F.sha2(F.col(payload), 256)], newest("updated_on"))


def job_cost(rows: DataFrame, *, by_start: bool = False) -> DataFrame:
    order = ("job_start", "updated_on") if by_start else ("updated_on",)
    return dedupe_latest(rows, ["job_id", "bu_key"], newest(*order))


def future_bookings(rows: DataFrame, *, per_job: bool = False) -> DataFrame:
    """Per scheduled day or, with ``per_job``, the latest schedule of each job."""
    if per_job:
        return dedupe_latest(rows, ["job_id", "bu_key"], newest("scheduled_date", "as_of_date"))
    return dedupe_latest(rows, ["job_id", "scheduled_date"], newest("as_of_date"))


def sales(rows: DataFrame) -> DataFrame:
    return dedupe_latest(
        rows, ["event_date", "bu_name", "estimator"], newest("total_sales", "avg_closed_sale")
    )


def by_id(rows: DataFrame, *, key: str = "id", ingested: str = "_ingested_at") -> DataFrame:
    return dedupe_latest(rows, [key], newest(ingested))


def payroll_lines(rows: DataFrame) -> DataFrame:
    return rows.select(*PAYROLL_LINE_KEY).distinct()
