"""Readers for landed files: entity pages, reports, CSV exports, id lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The calendar of the dashboards starts here.
CALENDAR_START = "2023-01-01"


def read_entity_pages(spark: SparkSession, path: str, *, multi_line: bool = False) -> DataFrame:
    """Records of API pages ``{"data": [...]}``: one JSON text per record.

    Pages are files (``multi_line``) or lines; the records keep their nesting, and the
    entity's flattening picks what it needs.
    """
    pages = spark.read.schema("data array<string>").json(path, multiLine=multi_line)
    return pages.select(F.explode("data").alias("record"))


def read_report(spark: SparkSession, path: str, *, multi_line: bool = False) -> DataFrame:
    """Rows of report files ``{"fields": [{"name"}], "data": [[...]]}``: positions and names."""
    envelope = "fields array<struct<name:string,label:string>>, data array<array<string>>"
    pages = spark.read.schema(envelope).json(path, multiLine=multi_line)
    return pages.select(
        F.transform("fields", lambda f: f["name"]).alias("columns"), F.explode("data").alias("row")
    )


def named_row(columns: str | Column = "columns", row: str | Column = "row") -> Column:
    """Report row as a map from column name to value; empty where the lengths differ."""
    c = F.col(columns) if isinstance(columns, str) else columns
    r = F.col(row) if isinstance(row, str) else row
    fits = F.size(c) == F.size(r)
    return F.when(fits, F.map_from_arrays(c, r)).otherwise(
        F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    )


def row_field(
    names: Sequence[str],
    position: int | None,
    columns: str | Column = "columns",
    row: str | Column = "row",
    *,
    blanks: bool = False,
    named: Column | None = None,
) -> Column:
    """A field of a report row: by its names in turn, then by its position (from 0); empty cells count as absent.

    With ``blanks`` an empty cell under one of the names is the value.  Without a position only names count.  The names
    of a row that is shorter or longer than the column list are not known; its position is.  ``named`` is the row's map
    where it has been made already.
    """
    r = F.col(row) if isinstance(row, str) else row
    named = named_row(columns, row) if named is None else named
    cells = [named[n] if blanks else F.nullif(named[n], F.lit("")) for n in names]
    return F.coalesce(*cells, F.lit(None).cast("string") if position is None else F.get(r, F.lit(position)))


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """An export with a header line; cells that do not fit the schema become null."""
    return spark.read.schema(schema).csv(path, header=True, mode="PERMISSIVE")


def read_id_list(spark: SparkSession, path: str, *, name: str = "job_id") -> DataFrame:
    """One id per line; blank lines are skipped."""
    text = F.trim("value")
    return spark.read.text(path).select(text.alias(name)).where(F.col(name) != "")


def mapped_export(export: DataFrame, mapping: dict[str, tuple[str, str]]) -> DataFrame:
    """CSV history to the raw schema: target -> (source column, type); bad cells are null."""
    return export.select(
        *[F.col(f"`{src}`").try_cast(kind).alias(name) for name, (src, kind) in mapping.items()]
    )


def calendar(bounds: DataFrame, first: str = "first", last: str = "last") -> DataFrame:
    """One row per day between the bounds (one input row), with its Monday."""
    days = bounds.select(F.explode(F.sequence(F.col(first), F.col(last))).alias("date"))
    return days.withColumn("week_start", F.to_date(F.date_trunc("week", "date")))


def dashboard_calendar(spark: SparkSession, as_of: str) -> DataFrame:
    """From the fixed start to a year after ``as_of``."""
    day = F.lit(as_of).cast("date")
    bounds = spark.sql("SELECT 1").select(
        F.lit(CALENDAR_START).cast("date").alias("first"), F.date_add(day, 365).alias("last")
    )
    return calendar(bounds)
