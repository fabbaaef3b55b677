"""Rolling refreshes and snapshots of stored tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkpi.sources.store import Change, Layout, Transaction

LAST_DAY = date(9998, 12, 31)


def refresh_stored(t: Transaction, table: str, view: DataFrame, column: str, as_of: str, days: int = 7) -> Change:
    """Keep the table's older days and its rows without a date; its last ``days``, and later ones, are replaced by the view's."""
    since = date.fromisoformat(as_of) - timedelta(days=days)
    return t.replace_range(table, view.where(F.col(column) >= F.lit(since)), column, since, LAST_DAY)


def changed_days(changes: DataFrame, column: str) -> list[date]:
    """The days that rows taken out or put in are dated; bounded by the calendar."""
    return sorted(r[0] for r in changes.select(F.to_date(column)).where(F.col(column).isNotNull()).distinct().collect())


def refresh_changed(
    t: Transaction, mart: str, source: str, changes: DataFrame, column: str, build: Callable[[DataFrame], DataFrame]
) -> Change:
    """Bring a mart up to date with its source after an upsert whose ``changes`` are given.

    A row that was changed counts on the day it was dated before and on the day it is dated now.  The source's files of
    those days are read, ``build`` makes their rows of the mart, and these take the place of the mart's; both tables
    are parted by that day.  Other days are neither read nor written.
    """
    days = changed_days(changes, column)
    folder = t.tables[source].layout.folder
    rows = t.read(source).where(F.col(folder).isin(*days)) if days else t.read(source).limit(0)
    return t.replace_days(mart, build(rows), days)


def store_snapshot(t: Transaction, table: str, view: DataFrame, as_of: str) -> Change:
    """The view stamped with its date into a stored table parted by it; a second run on one date replaces the first."""
    stamped = view.select(F.lit(as_of).cast("date").alias("snapshot_date"), "*")
    t.ensure(table, stamped.schema, Layout(day="snapshot_date"))
    return t.replace_range(table, stamped, "snapshot_date", as_of, as_of)
