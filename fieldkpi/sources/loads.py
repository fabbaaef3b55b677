"""Loads of an entity into a store: rows, sync state and run log in one commit, and backfills chunk by chunk."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldkpi.operators.incremental import chunk, last_watermarks, year_chunks
from fieldkpi.sources.literals import literal_relation
from fieldkpi.sources.store import Change, Layout, Store, Transaction

STATE, LOG, LEDGER = "sync_state", "ingestion_logs", "backfill_ledger"
STATE_ROWS = "entity_type string, last_sync_time timestamp_ntz, last_sync_status string, records_processed bigint, updated_at timestamp_ntz"
LOG_ROWS = (
    "entity_type string, run_id string, start_time timestamp_ntz, end_time timestamp_ntz, status string,"
    " records_fetched bigint, records_inserted bigint, duration_ms bigint, error_message string"
)
LEDGER_ROWS = (
    "entity_type string, start_date date, end_date date, status string, worker string, rows bigint,"
    " at timestamp_ntz, turn bigint, error_message string"
)

Clock = Callable[[], datetime]


def utc_now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


@dataclass(frozen=True)
class Entity:
    """What is loaded: its name and schema, how the table lies, which version of a row is the newest, and the columns
    that no row may lack."""

    name: str
    schema: T.StructType
    layout: Layout
    newest: tuple[Column, ...]
    required: tuple[str, ...] = ()

    @property
    def table(self) -> str:
        return f"raw_{self.name}"


class Invalid(ValueError):
    """A batch that the entity's schema does not allow."""


def _append(t: Transaction, table: str, schema: str, row: tuple, *, alone: bool = False) -> None:
    rows = literal_relation(t.spark, schema, [tuple(v.isoformat(" ") if isinstance(v, datetime) else v for v in row)])
    t.ensure(table, rows.schema)
    t.append(table, rows, alone=alone)


def check(batch: DataFrame, entity: Entity) -> int:
    """The batch's number of rows; Invalid if a required column is absent, or null in any row."""
    absent = [c for c in entity.required if c not in batch.columns]
    if absent:
        raise Invalid(f"no column {', '.join(absent)}")
    counts = batch.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in entity.required]).first()
    lacking = [f"{counts[c]} rows without {c}" for c in entity.required if counts[c]]
    if lacking:
        raise Invalid("; ".join(lacking))
    return counts["_rows"]


def load(t: Transaction, entity: Entity, batch: DataFrame) -> tuple[int, Change]:
    """Check a batch and upsert it; the table is made, or grows new columns, as the batch needs."""
    batch = t.staged(batch)
    n = check(batch, entity)
    known = {f.name for f in entity.schema.fields}
    t.ensure(entity.table, T.StructType([*entity.schema.fields, *[f for f in batch.schema.fields if f.name not in known]]), entity.layout)
    return n, t.upsert(entity.table, batch, entity.newest)


def load_entity(
    store: Store, entity: Entity, run_id: str, fetch: Callable[[datetime], DataFrame], *, clock: Clock = utc_now, first_days: int | None = None
) -> bool:
    """One run: fetch what is new since the entity's last good run, check it, upsert it.

    The rows, the state row that moves the watermark and the log row appear in one commit, so a run that fails or is
    lost before it leaves none of them, and a run id that the log has as a success does nothing (False).  A run
    without new rows is logged and moves no watermark.  A failure is logged with its message and raised.
    """
    start = clock()

    def work(t: Transaction) -> bool:
        if t.has(LOG) and not t.read(LOG).where((F.col("run_id") == run_id) & (F.col("status") == "success")).isEmpty():
            return False
        known = t.read(STATE) if t.has(STATE) else literal_relation(store.spark, STATE_ROWS, [])
        entities = literal_relation(store.spark, "entity_type string", [(entity.name,)])
        good = known.where("last_sync_status = 'success'")
        options = {} if first_days is None else {"first_days": first_days}
        mark = last_watermarks(good, entities, str(start), **options).first().last_sync_time
        n, _ = load(t, entity, fetch(mark))
        end = clock()
        if n:
            _append(t, STATE, STATE_ROWS, (entity.name, start, "success", n, end))
        _append(t, LOG, LOG_ROWS, (entity.name, run_id, start, end, "success", n, n, _millis(end - start), None))
        return True

    try:
        return store.run(run_id, work)
    except Exception as error:
        end, message = clock(), str(error).split("\n")[0]
        store.run(f"{run_id}-failed", lambda t: _append(t, LOG, LOG_ROWS, (entity.name, run_id, start, end, "failed", None, 0, _millis(end - start), message)))
        raise


def _millis(span: timedelta) -> int:
    return span // timedelta(milliseconds=1)


# --- backfill -------------------------------------------------------------------


def chunks(rows: DataFrame, first_year: int, now: date, most: int | None = None, *, column: str = "created_on") -> list[tuple[date, date]]:
    """Half-open calendar years, those with more than ``most`` rows split between days into parts of at most as many.

    A day is never split.  Counted per day in one scan: what the driver sees is bounded by the calendar.
    """
    years = year_chunks(first_year, now)
    if most is None:
        return years
    counted = chunk(rows, years[0][0], years[-1][1], column=column).groupBy(F.to_date(column).alias("day")).agg(F.count("*").alias("n"))
    per_day = sorted((r.day, r.n) for r in counted.collect())
    out = []
    for start, end in years:
        begin, held = start, 0
        for day, n in per_day:
            if start <= day < end:
                if held and held + n > most:
                    out.append((begin, day))
                    begin, held = day, 0
                held += n
        out.append((begin, end))
    return out


def ledger(store: Store, entity: str) -> DataFrame:
    """The last entry of each chunk of an entity, and how often it failed."""
    if not store.has(LEDGER):
        return literal_relation(store.spark, f"{LEDGER_ROWS}, failures bigint", [])
    return _latest(store.read(LEDGER), entity)


def _latest(rows: DataFrame, entity: str) -> DataFrame:
    own = rows.where(F.col("entity_type") == entity)
    rest = ["status", "worker", "rows", "at", "turn", "error_message"]
    last = own.groupBy("entity_type", "start_date", "end_date").agg(
        F.max_by(F.struct(*rest), "turn").alias("last"), F.count_if(F.col("status") == "failed").alias("failures")
    )
    return last.select("entity_type", "start_date", "end_date", "last.*", "failures")


def backfill(
    store: Store,
    entity: Entity,
    wanted: Sequence[tuple[date, date]],
    fetch: Callable[[date, date], DataFrame],
    *,
    worker: str,
    clock: Clock = utc_now,
    patience: timedelta = timedelta(hours=6),
    tries: int = 2,
) -> int:
    """Load the chunks that no one has loaded, one by one; gives how many this worker did.

    A worker claims the first chunk that is neither done, nor claimed by another within ``patience``, nor failed ``tries``
    times.  Two workers cannot claim one chunk: a claim is a commit that fails if the ledger changed.  The rows of a
    chunk and its entry as done are one commit, so after a loss it is loaded again or not at all.  A chunk that
    fails is entered with its message, and the others go on.
    """

    def claim(t: Transaction) -> tuple[date, date] | None:
        seen = {(r.start_date, r.end_date): r for r in _latest(t.read(LEDGER), entity.name).collect()} if t.has(LEDGER) else {}
        for start, end in wanted:
            last = seen.get((start, end))
            if last is None or _open(last, worker, clock() - patience, tries):
                note(t, start, end, "claimed", None, None, alone=True)
                return start, end
        return None

    def note(t: Transaction, start: date, end: date, status: str, n: int | None, message: str | None, *, alone: bool = False) -> None:
        # the commit that a transaction builds on counts the turns of a chunk
        _append(t, LEDGER, LEDGER_ROWS, (entity.name, start, end, status, worker, n, clock(), t.base.number, message), alone=alone)

    done = 0
    while (own := store.run(f"claim-{worker}", claim)) is not None:

        def work(t: Transaction, start=own[0], end=own[1]) -> None:
            n, _ = load(t, entity, fetch(start, end))
            note(t, start, end, "done", n, None)

        try:
            store.run(f"{entity.name}-{own[0]}-{own[1]}", work)
            done += 1
        except Exception as error:  # noqa: BLE001  any failure of a chunk is entered, and the next one tried
            message = str(error).split("\n")[0]
            store.run(f"failed-{worker}", lambda t, m=message, o=own: note(t, *o, "failed", None, m))
    return done


def _open(last, worker: str, since: datetime, tries: int) -> bool:
    if last.status == "done" or last.failures >= tries:
        return False
    return last.status == "failed" or last.worker == worker or last.at < since
