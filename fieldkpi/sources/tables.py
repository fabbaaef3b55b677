"""Tables on files: layout, append, upsert, range replacement, refresh, snapshots."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldkpi.functions.expr import day_range
from fieldkpi.operators.dedupe import dedupe_latest

DAY = "day"


# --- layout ---------------------------------------------------------------------


def with_day(rows: DataFrame, column: str) -> DataFrame:
    return rows.withColumn(DAY, F.to_date(column))


def write_by_day(
    rows: DataFrame,
    path: str,
    column: str,
    *,
    cluster: Sequence[str] = (),
    mode: str = "append",
    max_records_per_file: int = 5_000_000,
) -> None:
    """Write a table partitioned by the day of ``column``, sorted by its cluster columns.

    The rebalance gathers each day into few files and lets adaptive execution split a
    day that is much larger than the others.
    """
    laid_out = with_day(rows, column).hint("rebalance", DAY)
    if cluster:
        laid_out = laid_out.sortWithinPartitions(DAY, *cluster)
    (
        laid_out.write.partitionBy(DAY)
        .mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records_per_file)
        .parquet(path)
    )


def write_bucketed(
    rows: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int
) -> DataFrame:
    """Write a catalog table bucketed and sorted by its key, and return it.

    Tables with the same buckets join on the key without a shuffle.  Meant for tables
    with one row per key, such as job dimensions and job costing: rows of one key share
    a bucket, so a very frequent key belongs in a day-partitioned table instead.
    """
    (
        rows.repartition(buckets, *keys)
        .write.bucketBy(buckets, *keys)
        .sortBy(*keys)
        .mode("overwrite")
        .option("path", path)
        .saveAsTable(name)
    )
    return rows.sparkSession.table(name)


def evolve(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the schema's missing columns as nulls; never drop or retype one."""
    missing = [f for f in schema.fields if f.name not in rows.columns]
    return rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])


def merge_schemas(old: DataFrame, new: DataFrame) -> DataFrame:
    """Both, with the union of their columns."""
    return old.unionByName(new, allowMissingColumns=True)


def known_columns(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows in the table's schema: unknown fields dropped, absent ones null."""
    return evolve(rows, schema).select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def append(rows: DataFrame, path: str, schema: T.StructType) -> None:
    known_columns(rows, schema).write.mode("append").parquet(path)


# --- versions -------------------------------------------------------------------


def publish(rows: DataFrame, table: str, *, mode: str = "rebuild") -> str:
    """Write a new version of the table beside the old ones, then point to it.

    Readers see the old version until the pointer row is written, and a lost job
    leaves no half-written table.
    """
    version = f"{table}/data/{uuid.uuid4().hex}"
    rows.write.parquet(version)
    pointer = rows.sparkSession.sql("SELECT 1").select(
        F.lit(version).alias("path"), F.current_timestamp().alias("published_at"), F.lit(mode).alias("mode")
    )
    pointer.write.mode("append").parquet(f"{table}/versions")
    return version


def current(spark: SparkSession, table: str) -> DataFrame:
    """The newest published version."""
    newest = (
        spark.read.parquet(f"{table}/versions").agg(F.max_by("path", "published_at")).first()[0]
    )
    return spark.read.parquet(newest)


# --- changes --------------------------------------------------------------------


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    *,
    keep_newer: bool = False,
) -> DataFrame:
    """Target rows whose key the batch has are replaced, other batch rows are added.

    Of several batch rows with one key the first by ``order`` counts; with
    ``keep_newer`` the target's row competes with them, so that a late, older row
    changes nothing.  A null key matches nothing, so such rows are kept as they are.
    """
    has_key = None
    for k in keys:
        has_key = F.col(k).isNotNull() if has_key is None else has_key & F.col(k).isNotNull()
    candidates = batch.where(has_key)
    if keep_newer:
        rivals = target.join(candidates.select(*keys).distinct(), list(keys), "left_semi")
        candidates = candidates.unionByName(rivals, allowMissingColumns=True)
    newest = dedupe_latest(candidates, keys, order)
    return (
        target.join(newest.select(*keys), list(keys), "left_anti")
        .unionByName(newest, allowMissingColumns=True)
        .unionByName(batch.where(~has_key), allowMissingColumns=True)
    )


def upsert_days(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    column: str,
    *,
    keep_newer: bool = False,
) -> None:
    """Upsert into a day-partitioned table; rows without a day are a partition of their own.

    Rewritten are the days of the batch and the days where the table has its keys, so a
    key whose day moves is not left behind.  To find those only the key and day columns
    of the table are read; the semi join prunes the other partitions when the query
    runs.  Files are swapped when the write commits; days left without a row go last, and
    a rerun after a loss in between removes them.
    """
    table = spark.read.parquet(path)
    days = with_day(batch, column)
    held = table.join(batch.select(*keys).distinct(), list(keys), "left_semi").select(DAY)
    wanted = days.select(DAY).unionByName(held).distinct().withColumnRenamed(DAY, "_wanted")
    touched = table.join(wanted, table[DAY].eqNullSafe(wanted["_wanted"]), "left_semi")
    merged = upsert(touched, days, keys, order, keep_newer=keep_newer)
    left = with_day(merged, column).select(F.col(DAY).alias("_left")).distinct()
    emptied = touched.select(DAY).distinct().join(left, F.col(DAY).eqNullSafe(left["_left"]), "left_anti").collect()
    write_by_day(merged, path, column, mode="overwrite")
    for row in emptied:
        name = "__HIVE_DEFAULT_PARTITION__" if row[0] is None else row[0].isoformat()
        _drop(spark, f"{path}/{DAY}={name}")


def _drop(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def replace_range(
    target: DataFrame, batch: DataFrame, column: str, start: str, end: str
) -> DataFrame:
    """Delete the target's rows dated in the window (both days included), then insert."""
    inside = F.coalesce(day_range(column, start, end), F.lit(False))
    return target.where(~inside).unionByName(batch, allowMissingColumns=True)


def replace_days(batch: DataFrame, path: str, column: str) -> None:
    """The same in place for whole days: each day in the batch replaces its partition."""
    write_by_day(batch, path, column, mode="overwrite")


def refresh_last_days(
    materialized: DataFrame, view: DataFrame, column: str, as_of: str, days: int = 7
) -> DataFrame:
    """Keep the table's older days and its rows without a date, take the last ``days`` from the view."""
    since = F.date_sub(F.lit(as_of).cast("date"), days)
    kept = materialized.where((F.col(column) < since) | F.col(column).isNull())
    return kept.unionByName(view.where(F.col(column) >= since))


def append_snapshot(snapshots: DataFrame | None, view: DataFrame, as_of: str) -> DataFrame:
    """The view stamped with its date; a second run on one date replaces the first."""
    stamped = view.select(F.lit(as_of).cast("date").alias("snapshot_date"), "*")
    if snapshots is None:
        return stamped
    kept = snapshots.where(~F.col("snapshot_date").eqNullSafe(F.lit(as_of).cast("date")))
    return kept.unionByName(stamped, allowMissingColumns=True)


def repaired_rows(invoices: DataFrame, jobs: DataFrame) -> DataFrame:
    """The rows that lack a job id and have a job number: with the number's job, if there is one, and then its unit."""
    lookup = dedupe_latest(
        jobs.where(F.col("job_number").isNotNull()).select(
            "job_number", F.col("id").alias("found_id"), F.col("business_unit_id").alias("found_unit")
        ),
        ["job_number"],
        [F.col("found_id").asc_nulls_last()],
    )
    return (
        invoices.where(F.col("job_id").isNull() & F.col("job_number").isNotNull())
        .join(lookup, "job_number", "left")
        .withColumn("job_id", F.col("found_id"))
        .withColumn("business_unit_id", F.coalesce("business_unit_id", "found_unit"))
        .select(*invoices.columns)
    )


def repair_foreign_key(invoices: DataFrame, jobs: DataFrame) -> DataFrame:
    """Fill a missing job id, and then unit, through the job number.

    Only rows to repair are looked up; the others pass without a shuffle.
    """
    broken = F.col("job_id").isNull() & F.col("job_number").isNotNull()
    return invoices.where(~broken).unionByName(repaired_rows(invoices, jobs))


def rebuild(rows: DataFrame, table: str) -> DataFrame:
    """Full rebuild of a table from a query."""
    publish(rows, table)
    return current(rows.sparkSession, table)
