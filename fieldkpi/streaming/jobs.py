"""Streaming twins of the incremental loads."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fieldkpi.functions.expr import sum_money
from fieldkpi.sources import files, tables
from fieldkpi.sources.literals import literal_relation
from fieldkpi.sources.store import Layout, Store, Transaction


def read_landed(spark: SparkSession, folder: str, schema: str, *, pattern: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream, a bounded number per batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def stream_upsert(
    stream: DataFrame,
    table: str,
    keys: Sequence[str],
    *,
    modified: str,
    checkpoint: str,
    day_column: str | None = None,
) -> None:
    """Keep a table at the newest version of each key, from a stream of versions.

    Each batch is upserted, and a row older than the table's is ignored, so replaying a
    batch changes nothing and the first row of a key counts, however late.  The table is
    the only state.  Rows without a key are added as they come, also by a replay.

    With ``day_column`` the table is partitioned by its day and a batch rewrites only the
    days it touches: the way for large tables.  Without it each batch publishes a new
    version of the whole table.
    """
    spark = stream.sparkSession

    def merge(batch: DataFrame, _: int) -> None:
        if batch.isEmpty():
            return
        newest = [F.col(modified).desc_nulls_last()]
        batch = batch.persist()
        try:
            _merged(spark, batch, table, keys, newest, day_column)
        finally:
            batch.unpersist()

    query = (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _merged(spark, batch, table, keys, newest, day_column) -> None:
    if day_column is not None:
        if _exists(spark, table):
            tables.upsert_days(spark, table, batch, keys, newest, day_column, keep_newer=True)
        else:
            tables.write_by_day(_first_rows(batch, keys, newest), table, day_column)
    elif _exists(spark, f"{table}/versions"):
        old = tables.current(spark, table)
        tables.publish(tables.upsert(old, batch, keys, newest, keep_newer=True), table, mode="upsert")
    else:
        tables.publish(_first_rows(batch, keys, newest), table)


def _first_rows(batch: DataFrame, keys: Sequence[str], newest: list) -> DataFrame:
    """The first batch into a table; like any other it keeps all rows without a key."""
    return tables.upsert(batch.limit(0), batch, keys, newest)


def _exists(spark: SparkSession, folder: str) -> bool:
    return files.exists(spark, folder)


def stream_daily_totals(
    stream: DataFrame,
    out: str,
    *,
    event_time: str,
    unit: str,
    amount: str,
    lookback: str,
    checkpoint: str,
) -> None:
    """Daily totals per unit, written once a day is behind the watermark."""
    totals = (
        stream.withColumn("_event_time", F.col(event_time).cast("timestamp"))
        .withWatermark("_event_time", lookback)
        .groupBy(F.window("_event_time", "1 day").alias("w"), F.col(unit))
        .agg(
            F.count("*").alias("n"),
            F.sum(F.col(amount).cast("decimal(18,4)")).alias("total"),
        )
        .select(F.to_date("w.start").alias("day"), unit, "n", F.col("total").cast("double").alias("total"))
    )
    query = (
        totals.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


# --- days that close, and corrections ---------------------------------------------------

CELLS = "day date, unit string, n bigint, total decimal(28,4), late bigint, revision int"
MARKS = "batch bigint, seen timestamp_ntz, lookback_seconds bigint, undated bigint"
_CELL_LAYOUT = Layout(keys=("day", "unit"), day="day", folder="cell_day")
#: The number of the entry that closes a stream.
END = 1 << 62


def stream_closed_days(
    stream: DataFrame, store: Store, out: str, *, event_time: str, unit: str, amount: str, lookback: timedelta, checkpoint: str
) -> None:
    """Daily totals per unit: a day comes out once it is closed, and again whenever late rows change it.

    A day is closed when the newest event seen is ``lookback`` past its end.  Table ``out`` gets a row for each cell
    (day, unit) of a closed day with revision 0; a batch with rows of a closed day adds the cell's new totals under the
    next revision, ``late`` counting all late rows of the cell.  So the sums of last revisions are those of all rows.
    Running totals are a table too, of which a batch rewrites the files of its days; totals, output and
    the mark of what was seen are one commit per batch, and a batch that comes again does nothing.
    Rows without a unit are ``unknown``, those without a time are counted in the marks; ``close_days`` closes what is
    open at the end.
    """

    def take(batch: DataFrame, number: int) -> None:
        rows = batch.select(
            F.to_date(event_time).alias("day"), F.col(event_time).cast("timestamp_ntz").alias("at"), F.col(unit).cast("string").alias("unit"), F.col(amount).alias("amount")
        )
        store.run(f"{out}-{number}", lambda t: _take(t, out, rows, number, lookback))

    query = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def close_days(store: Store, out: str) -> None:
    """The end of a stream: all days still open come out."""

    def work(t: Transaction) -> None:
        last, seen, lookback = _last(t, out)
        if last < END:
            if seen is not None:
                t.append(out, _cells(t, out, _open_from(seen, lookback), None))
            _mark(t, out, END, datetime(9998, 12, 31), timedelta(0), 0)

    store.run(f"{out}-end", work)


def _take(t: Transaction, out: str, rows: DataFrame, number: int, lookback: timedelta) -> None:
    last, seen, before = _last(t, out)
    if number <= last:
        return
    rows = t.staged(rows.withColumn("unit", F.coalesce("unit", F.lit("unknown"))))
    newest, undated, first, final = rows.agg(F.max("at"), F.count_if(F.col("at").isNull()), F.min("day"), F.max("day")).first()
    now = max((x for x in (seen, newest) if x is not None), default=None)
    for table in (f"{out}_cells", out):
        t.ensure(table, StructType.fromDDL(CELLS), _CELL_LAYOUT)
    if newest is not None:
        late = F.lit(False) if seen is None else F.col("day") < F.lit(_open_from(seen, before))
        fresh = rows.where("day IS NOT NULL").groupBy("day", "unit").agg(F.count("*").alias("n"), sum_money("amount").alias("total"))
        have = t.read(f"{out}_cells").where(F.col("cell_day").between(F.lit(first), F.lit(final)))
        have = have.select("day", "unit", *[F.col(c).alias(f"old_{c}") for c in ("n", "total", "late", "revision")])
        zero = F.lit(0)
        cells = fresh.join(have, ["day", "unit"], "left").select(
            "day", "unit",
            (F.col("n") + F.coalesce("old_n", zero)).alias("n"),
            (F.coalesce("total", zero) + F.coalesce("old_total", zero)).cast("decimal(28,4)").alias("total"),
            (F.coalesce("old_late", zero) + F.when(late, F.col("n")).otherwise(zero)).alias("late"),
            (F.coalesce("old_revision", zero) + late.cast("int")).cast("int").alias("revision"),
        )
        cells = t.staged(cells)
        t.upsert(f"{out}_cells", cells, [F.desc("n")])
        t.append(out, cells.where(late))
        t.append(out, _cells(t, out, None if seen is None else _open_from(seen, before), _open_from(now, lookback)))
    _mark(t, out, number, now, lookback, undated)


def _cells(t: Transaction, out: str, first: date | None, end: date | None) -> DataFrame:
    """The running totals of the days from ``first`` on and before ``end``."""
    rows = t.read(f"{out}_cells")
    day = F.col("cell_day")
    rows = rows if first is None else rows.where(day >= F.lit(first))
    return (rows if end is None else rows.where(day < F.lit(end))).drop("cell_day")


def _open_from(seen: datetime, lookback: timedelta) -> date:
    """The first day that is not closed when the newest event was seen at that time."""
    return (seen - lookback).date()


def _last(t: Transaction, out: str) -> tuple[int, datetime | None, timedelta]:
    """The last batch taken (-1: none), the newest event seen, and the lookback that then held."""
    if not t.has(f"{out}_marks"):
        return -1, None, timedelta(0)
    last = t.read(f"{out}_marks").agg(F.max_by(F.struct("batch", "seen", "lookback_seconds"), "batch")).first()[0]
    return last.batch, last.seen, timedelta(seconds=last.lookback_seconds)


def _mark(t: Transaction, out: str, number: int, seen: datetime | None, lookback: timedelta, undated: int) -> None:
    row = (number, None if seen is None else seen.isoformat(" "), int(lookback.total_seconds()), undated)
    rows = literal_relation(t.spark, MARKS, [row])
    t.ensure(f"{out}_marks", rows.schema)
    t.append(f"{out}_marks", rows)
