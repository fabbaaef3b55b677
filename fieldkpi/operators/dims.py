"""Dimensions and the joins that enrich rows with them.

No side is forced to broadcast: dimension files are small enough for Spark's own
size threshold, and one that outgrows it is joined by shuffle instead.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldkpi.functions.constants import UNKNOWN_UNIT
from fieldkpi.functions.joins import spread_join
from fieldkpi.sources.literals import literal_relation


def dim_jobs(
    jobs: DataFrame,
    units: DataFrame,
    job_types: DataFrame,
    campaigns: DataFrame | None = None,
) -> DataFrame:
    """Jobs with unit, job type and, if given, campaign names."""
    out = jobs.join(
        units.select(F.col("id").alias("business_unit_id"), F.col("name").alias("bu_name")),
        "business_unit_id",
        "left",
    ).join(
        job_types.select(F.col("id").alias("job_type_id"), F.col("name").alias("job_type_name")),
        "job_type_id",
        "left",
    )
    out = out.withColumn("business_unit", F.coalesce("bu_name", F.lit(UNKNOWN_UNIT)))
    if campaigns is not None:
        out = out.join(
            campaigns.select(F.col("id").alias("campaign_id"), F.col("name").alias("campaign_name")),
            "campaign_id",
            "left",
        )
    return out


def region_map(spark: SparkSession, regions: Iterable[tuple[str, str, list[str], list[str]]]) -> DataFrame:
    """(key, label, sales units, production units) per region, one row per unit."""
    configured = literal_relation(
        spark,
        "region_key string, region_label string, sales array<string>, production array<string>",
        regions,
    )
    return region_map_from(configured)


def region_map_from(configured: DataFrame) -> DataFrame:
    """The same from a table with two array columns."""

    def side(column: str) -> DataFrame:
        return configured.select(
            "region_key",
            "region_label",
            F.explode(column).alias("bu_key"),
            F.lit(column).alias("bu_type"),
        )

    return side("sales").unionByName(side("production"))


def unit_rollup(configured: DataFrame, units: DataFrame) -> DataFrame:
    """Configured unit names matched to the unit dimension; unmatched names are kept.

    ``configured``: bu_name, bu_group, bu_rollup (legacy names share one rollup).
    """
    known = units.select(
        F.trim("name").alias("matched_name"), F.col("id").alias("business_unit_id")
    )
    return (
        configured.withColumn("bu_name", F.trim("bu_name"))
        .join(known, F.col("bu_name") == F.col("matched_name"), "left")
        .select(
            "business_unit_id",
            "bu_name",
            "bu_group",
            "bu_rollup",
            F.col("business_unit_id").isNotNull().alias("discovered"),
        )
    )


def enriched_jobs(
    jobs: DataFrame,
    units: DataFrame,
    technicians: DataFrame,
    customers: DataFrame,
    locations: DataFrame,
) -> DataFrame:
    def named(df: DataFrame, key: str, label: str, source: str = "name") -> DataFrame:
        return df.select(F.col("id").alias(key), F.col(source).alias(label))

    return (
        jobs.join(named(units, "business_unit_id", "unit_name"), "business_unit_id", "left")
        .join(named(technicians, "technician_id", "technician_name"), "technician_id", "left")
        .join(named(customers, "customer_id", "customer_name"), "customer_id", "left")
        .join(named(locations, "location_id", "location_address", "address"), "location_id", "left")
        .select(
            "id",
            "job_number",
            "job_status",
            "created_on",
            "completed_on",
            "unit_name",
            "technician_name",
            "customer_name",
            "location_address",
        )
    )


def selected_jobs(
    job_ids: DataFrame,
    jobs: DataFrame,
    location_zips: DataFrame,
    customers: DataFrame,
    job_types: DataFrame,
) -> DataFrame:
    """Detail of the listed jobs: ZIP, customer and job type."""
    return (
        jobs.join(job_ids.select(F.col("job_id").alias("id")).distinct(), "id", "left_semi")
        .join(location_zips.select("location_id", "zip5"), "location_id", "left")
        .join(
            customers.select(F.col("id").alias("customer_id"), F.col("name").alias("customer_name")),
            "customer_id",
            "left",
        )
        .join(
            job_types.select(F.col("id").alias("job_type_id"), F.col("name").alias("job_type")),
            "job_type_id",
            "left",
        )
        .select(
            F.col("id").alias("job_id"),
            "job_number",
            "job_status",
            "completed_on",
            F.col("zip5").alias("zip_code"),
            "customer_name",
            "job_type",
        )
    )


def unit_label_by_id(unit_id: str, names: dict[int, str]) -> Column:
    """Fixed id -> name table with a ``BU-<id>`` fallback."""
    fallback = F.concat(F.lit("BU-"), F.col(unit_id).cast("string"))
    if not names:
        return fallback
    label = None
    for key, name in names.items():
        test = F.col(unit_id) == F.lit(key)
        label = F.when(test, name) if label is None else label.when(test, name)
    return label.otherwise(fallback)


def estimates_with_opportunity(estimates: DataFrame, opportunities: DataFrame) -> DataFrame:
    opp = opportunities.select(
        "job_id",
        "customer_id",
        "business_unit",
        "job_status",
        "opportunity_date",
        "is_sales_opportunity",
        "is_closed_opportunity",
        F.col("estimate_count").alias("job_estimate_count"),
        F.col("sold_estimate_count").alias("job_sold_estimate_count"),
        "earliest_sold_on",
    )
    return (
        spread_join(estimates.where(F.col("id").isNotNull() & F.col("job_id").isNotNull()), opp, "job_id")
        .select(
            F.col("id").alias("estimate_id"),
            "job_id",
            F.col("status").alias("estimate_status"),
            F.col("created_on").alias("estimate_created_on"),
            F.col("sold_on").alias("estimate_sold_on"),
            "sold_by_id",
            F.col("subtotal").cast("double").alias("subtotal"),
            F.col("total_tax").cast("double").alias("total_tax"),
            F.col("total").cast("double").alias("total"),
            "customer_id",
            "business_unit",
            "job_status",
            "opportunity_date",
            "is_sales_opportunity",
            "is_closed_opportunity",
            "job_estimate_count",
            "job_sold_estimate_count",
            F.coalesce(
                (F.col("status") == "Sold") & (F.col("sold_on") == F.col("earliest_sold_on")),
                F.lit(False),
            ).alias("is_winning_estimate"),
        )
    )
