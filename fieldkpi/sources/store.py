"""Several tables under one sequence of commits: changes of all of them become visible together, or not at all.

A commit is a small file with the next number, created only if there is none: of two writers with the same number one
fails, looks at what the other did, and goes on from there.  For each table it names the manifests, tables of data
files with their day and range of keys.  Data files are never changed; an upsert writes those anew that hold a
key of the batch and leaves the others.  Rows, manifests and key ranges are read, joined and written by Spark;
the driver holds commits and the paths of files that a scan reads.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldkpi.functions.expr import day_range
from fieldkpi.operators.dedupe import dedupe_latest
from fieldkpi.sources import files
from fieldkpi.sources.tables import known_columns

#: Cells of a batch's keys whose ranges are held against those of the files; bounds what the driver sees of a batch.
CELLS = 256
#: Manifests of a table before an append gathers them into one.
PARTS = 24
#: Rows, and days, for which a write takes one more task.
TASK_ROWS, TASK_DAYS = 1_000_000, 32
#: Files that one task looks up when a table is read.
LOOKED_UP = 256
#: Turns that a load takes when others commit at the same time.
TURNS = 20

# Types that a column may grow into, and what readers make of older files.
WIDER = {
    "tinyint": ("smallint", "int", "bigint"),
    "smallint": ("int", "bigint"),
    "int": ("bigint",),
    "float": ("double",),
}

_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


class Conflict(RuntimeError):
    """Another writer changed the same table first."""


@dataclass(frozen=True)
class Layout:
    """How a table lies: its key, the time whose day parts it (rows without one are a part of their own), the name of
    that part's column, and columns that order rows within a file."""

    keys: tuple[str, ...] = ()
    day: str | None = None
    folder: str = "day"
    cluster: tuple[str, ...] = ()


@dataclass(frozen=True)
class State:
    """A table as of a commit: its layout, the manifests of its files, and its schemas, oldest first."""

    layout: Layout
    parts: tuple[str, ...] = ()
    schemas: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schemas[-1]))


@dataclass(frozen=True)
class Commit:
    number: int = 0
    run_id: str = ""
    tables: dict[str, State] = field(default_factory=dict)

    def to_json(self) -> str:
        tables = {n: {"layout": s.layout.__dict__, "parts": s.parts, "schemas": s.schemas} for n, s in self.tables.items()}
        return json.dumps({"number": self.number, "run_id": self.run_id, "tables": tables})

    @classmethod
    def from_json(cls, text: str) -> Commit:
        body = json.loads(text)
        tables = {}
        for name, s in body["tables"].items():
            layout = Layout(**{k: tuple(v) if isinstance(v, list) else v for k, v in s["layout"].items()})
            tables[name] = State(layout, tuple(s["parts"]), tuple(s["schemas"]))
        return cls(body["number"], body["run_id"], tables)


def evolved(old: T.StructType, new: T.StructType) -> T.StructType:
    """The old columns, as wide as either schema has them, and then the new ones, which older rows have as nulls.

    A column of the old schema that the new one lacks stays.  Whole numbers and floats may get wider; a column
    of another type is an error.
    """
    incoming = {f.name: f for f in new.fields}
    fields = []
    for f in old.fields:
        other = incoming.get(f.name, f).dataType
        a, b = f.dataType.simpleString(), other.simpleString()
        if a != b and b not in WIDER.get(a, ()) and a not in WIDER.get(b, ()):
            raise ValueError(f"column {f.name} cannot turn from {a} to {b}")
        fields.append(T.StructField(f.name, other if b in WIDER.get(a, ()) else f.dataType))
    known = {f.name for f in old.fields}
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in new.fields if f.name not in known])


class Store:
    """Tables under one folder that every executor can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    # --- commits --------------------------------------------------------------

    def _commit_path(self, number: int) -> str:
        return f"{self.root}/commits/{number:012d}.json"

    def numbers(self) -> list[int]:
        """The commits that can be read, in order."""
        return [int(n.split(".")[0]) for n in files.names(self.spark, f"{self.root}/commits") if n.endswith(".json") and not n.startswith(".")]

    def commit(self, number: int | None = None) -> Commit:
        """A commit, by default the newest; before the first there are no tables."""
        if number is None:
            have = self.numbers()
            if not have:
                return Commit()
            number = have[-1]
        return Commit.from_json(files.read(self.spark, self._commit_path(number)))

    def run(self, run_id: str, work: Callable[[Transaction], object]) -> object:
        """``work`` as one transaction, again on the newest commit whenever another writer was first."""
        for _ in range(TURNS):
            transaction = self.begin()
            result = work(transaction)
            try:
                transaction.commit(run_id)
                return result
            except Conflict:
                continue
        raise Conflict(f"{run_id} gave way {TURNS} times")

    def begin(self) -> Transaction:
        return Transaction(self, self.commit())

    # --- reading --------------------------------------------------------------

    def has(self, table: str) -> bool:
        return table in self.commit().tables

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """A table as of a commit, in its schema then, with the column of its day."""
        return self.rows(table, self.commit(version).tables[table])

    def data(self, table: str) -> str:
        return f"{self.root}/{table}/data"

    def manifest(self, state: State) -> DataFrame:
        """path, day, n, low and high of the table's files."""
        return self.spark.read.schema(_manifest_schema(state)).parquet(*state.parts)

    def rows(self, table: str, state: State, paths: Sequence[str] | None = None) -> DataFrame:
        """The rows of the table, or of some of its files; nulls where a file is older than a column."""
        if paths is None:
            paths = [r.path for r in self.manifest(state).select("path").collect()] if state.parts else []
        layout, schema = state.layout, state.schema
        if layout.day:
            schema = T.StructType([*schema.fields, T.StructField(layout.folder, T.DateType())])
        if not paths:
            return self.spark.createDataFrame([], schema)
        own = T.StructType([*schema.fields, T.StructField("write", T.StringType())])
        return self._scan(table, own, paths).select(*schema.names)

    def _scan(self, table: str, schema: T.StructType, paths: Sequence[str]) -> DataFrame:
        """Files of a table."""
        base = self.data(table)
        with self.looking_up(len(paths)):
            return self.spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{p}" for p in paths])

    @contextmanager
    def looking_up(self, n: int) -> Iterator[None]:
        """While Spark looks up n files or folders, by default each in a task of its own: few tasks do for many."""
        setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
        before = self.spark.conf.get(setting)
        self.spark.conf.set(setting, str(max(1, min(int(before), n // LOOKED_UP))))
        try:
            yield
        finally:
            self.spark.conf.set(setting, before)

    def clean(self, keep: int = 1) -> list[int]:
        """Forget all commits but the last ``keep``, and delete the data that only they name.  Gives the numbers that went.

        For times without writers: files of a transaction that is under way are named by no commit yet.
        """
        have = self.numbers()
        gone, left = have[:-keep], [self.commit(n) for n in have[-keep:]]
        files.delete(self.spark, f"{self.root}/staged")
        for number in gone:
            files.delete(self.spark, self._commit_path(number))
        for table in {t for c in left for t in c.tables}:
            states = [c.tables[table] for c in left if table in c.tables]
            writes = set()
            for state in states:
                if state.parts:
                    writes |= {r[0] for r in self.manifest(state).select(F.substring_index("path", "/", 1)).distinct().collect()}
            for folder, wanted in (("data", writes), ("manifests", {p.rsplit("/", 1)[1] for s in states for p in s.parts})):
                for name in files.names(self.spark, f"{self.root}/{table}/{folder}"):
                    if name not in wanted:
                        files.delete(self.spark, f"{self.root}/{table}/{folder}/{name}")
        return gone


def _key_type(state: State) -> T.DataType:
    keys = state.layout.keys
    return state.schema[keys[0]].dataType if keys and keys[0] in state.schema.names else T.StringType()


def _manifest_schema(state: State) -> T.StructType:
    kind = T.LongType() if isinstance(_key_type(state), _NUMBERS) else T.StringType()
    return T.StructType(
        [T.StructField("path", T.StringType()), T.StructField("day", T.DateType()), T.StructField("n", T.LongType()),
         T.StructField("low", kind), T.StructField("high", kind), T.StructField("keyless", T.LongType())]
    )


@dataclass(frozen=True)
class Change:
    """What an upsert did: files of the table, those whose key range the batch touches, those written anew, and rows."""

    files: int
    candidates: int
    rewritten: int
    inserted: int
    updated: int


class Transaction:
    """Changes on top of a commit; nobody sees them before ``commit``."""

    def __init__(self, store: Store, base: Commit):
        self.store, self.spark, self.base = store, store.spark, base
        self.tables = dict(base.tables)
        self._added: dict[str, list[str]] = {}
        self._gathered: dict[str, tuple[tuple[str, ...], str]] = {}
        self._rewritten: set[str] = set()

    # --- reading --------------------------------------------------------------

    def has(self, table: str) -> bool:
        return table in self.tables

    def read(self, table: str) -> DataFrame:
        """The table with this transaction's changes."""
        return self.store.rows(table, self.tables[table])

    # --- writing --------------------------------------------------------------

    def ensure(self, table: str, schema: T.StructType, layout: Layout | None = None) -> None:
        """Create the table, or let its schema grow to hold the given one."""
        if table in self.tables:
            state = self.tables[table]
            grown = evolved(state.schema, schema)
            if grown != state.schema:
                self._rewritten.add(table)
                self.tables[table] = replace(state, schemas=(*state.schemas, grown.json()))
        else:
            self._rewritten.add(table)
            nullable = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
            self.tables[table] = State(layout or Layout(), (), (nullable.json(),))

    def append(self, table: str, rows: DataFrame, *, alone: bool = False) -> None:
        """Add rows in the table's schema.  Appends of others do not hinder this one, unless it must be ``alone``."""
        part = self._written(table, rows)
        state = self.tables[table]
        if len(state.parts) >= PARTS and table not in self._gathered:
            self._gathered[table] = state.parts, self._manifest(table, self.store.manifest(state))
            state = replace(state, parts=(self._gathered[table][1],))
        if part:
            self.tables[table] = replace(state, parts=(*state.parts, part))
            self._added.setdefault(table, []).append(part)
        if alone:
            self._rewritten.add(table)

    def overwrite(self, table: str, rows: DataFrame) -> None:
        """The given rows in place of all."""
        part = self._written(table, rows)
        self._rewritten.add(table)
        self.tables[table] = replace(self.tables[table], parts=(part,) if part else ())

    def replace_range(self, table: str, rows: DataFrame, column: str, start: str | date, end: str | date) -> Change:
        """Delete the rows dated in the window (both days included), then add the given ones.

        Files of days outside the window are left alone where the table is parted by that column.
        """
        state = self.tables[table]
        manifest = self.store.manifest(state) if state.parts else None
        touched, total = [], 0
        if manifest is not None:
            total = manifest.count()
            if state.layout.day == column:
                manifest = manifest.where(F.col("day").between(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")))
            touched = [r.path for r in manifest.select("path").collect()]
        inside = F.coalesce(day_range(column, str(start), str(end)), F.lit(False))
        kept = self.store.rows(table, state, touched).where(~inside)
        self._swap(table, touched, known_columns(kept, state.schema).unionByName(known_columns(rows, state.schema)))
        return Change(total, len(touched), len(touched), 0, 0)

    def replace_days(self, table: str, rows: DataFrame, days: Sequence[date]) -> Change:
        """The given rows in place of the files of these days; both are of no other day."""
        state = self.tables[table]
        total, gone = 0, []
        if state.parts:
            manifest = self.store.manifest(state)
            total = manifest.count()
            gone = [r.path for r in manifest.where(F.col("day").isin(*days)).select("path").collect()] if days else []
        self._swap(table, gone, known_columns(rows, state.schema))
        return Change(total, len(gone), len(gone), 0, 0)

    def upsert(
        self, table: str, batch: DataFrame, order: Sequence[Column], *, keep_newer: bool = False, changes: str | None = None
    ) -> Change:
        """Rows whose key the batch has are replaced in all columns, other batch rows are added.

        Of several batch rows with one key the first by ``order`` counts; with ``keep_newer`` the table's row competes
        with them.  Rows with a null in their key match nothing and are added.  Looked at are the files whose range of
        (first) keys meets a cell of the batch's keys, and of those only the key columns; written anew are the files
        that hold one.  A key whose day moves is so found wherever it is.

        ``changes`` names a table that gets a row for every version taken out (``_change`` -1) or put in (+1).
        """
        state = self.tables[table]
        keys, store = list(state.layout.keys), self.store
        batch = self.staged(known_columns(batch, state.schema))
        has_key = F.lit(True)
        for k in keys:
            has_key &= F.col(k).isNotNull()
        newest = self.staged(dedupe_latest(batch.where(has_key), keys, order))
        total, candidates = self._candidates(state, newest)
        wanted = newest.select(*keys)
        touched: list[str] = []
        if candidates:
            own = self._key_paths(table, state, candidates).join(wanted, keys, "left_semi")
            touched = [r[0] for r in own.select("_path").distinct().collect()]
        old = known_columns(store.rows(table, state, touched), state.schema)
        rivals = old.join(wanted, keys, "left_semi")
        if keep_newer and touched:
            newest = self.staged(dedupe_latest(newest.unionByName(rivals), keys, order))
        kept = old.join(wanted, keys, "left_anti") if touched else old
        keyless = batch.where(~has_key)
        updated = rivals.count() if touched else 0
        if changes is not None:
            before, after = rivals.withColumn("_change", F.lit(-1)), newest.unionByName(keyless).withColumn("_change", F.lit(1))
            both = self.staged(before.unionByName(after))
            self.ensure(changes, both.schema)
            self.append(changes, both)
        inserted = newest.count() - updated
        self._swap(table, touched, kept.unionByName(newest).unionByName(keyless))
        return Change(total, len(candidates), len(touched), inserted, updated)

    # --- the end --------------------------------------------------------------

    def commit(self, run_id: str) -> Commit:
        """Make the changes visible.

        A writer who was first is no hindrance if it touched other tables, or if both only added rows; else Conflict.
        """
        touched = self._rewritten | set(self._added)
        base = self.base
        while True:
            new = Commit(base.number + 1, run_id, base.tables | {n: self._merged(n, base) for n in touched})
            if files.create_once(self.spark, self.store._commit_path(new.number), new.to_json()):
                return new
            base = self.store.commit()
            for n in self._rewritten:
                if base.tables.get(n) != self.base.tables.get(n):
                    raise Conflict(f"table {n} was changed by {base.run_id}")

    def _merged(self, table: str, base: Commit) -> State:
        own = self.tables[table]
        if table in self._rewritten:
            return own
        theirs = base.tables[table]
        parts = theirs.parts
        before, gathered = self._gathered.get(table, ((), ""))
        if before and parts[: len(before)] == before:
            parts = (gathered, *parts[len(before) :])
        return replace(theirs, parts=(*parts, *self._added[table]))

    # --- files ----------------------------------------------------------------

    def staged(self, rows: DataFrame) -> DataFrame:
        """The rows as a table of their own: computed once, and read again by whoever needs them."""
        path = f"{self.store.root}/staged/{uuid.uuid4().hex}"
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _written(self, table: str, rows: DataFrame) -> str | None:
        """Write rows as new files of the table and their manifest, whose path is returned; None without rows.

        Rows are dealt by ranges of day and key, sampled, so that a day of many rows becomes several files with narrow
        ranges of keys.
        """
        state = self.tables[table]
        layout, base = state.layout, self.store.data(table)
        rows = known_columns(rows, state.schema)
        by = []
        if layout.day:
            rows, by = rows.withColumn(layout.folder, F.to_date(layout.day)), [layout.folder]
        order = [*by, *layout.cluster, *[k for k in layout.keys if k not in layout.cluster]]
        ranges = [*by, *layout.keys] or None
        days = 0
        if ranges:
            tasks, days = self._tasks(rows, by)
            rows = rows.repartitionByRange(tasks, *ranges).sortWithinPartitions(*order)
        write = f"write=w{uuid.uuid4().hex}"
        rows.write.partitionBy(*by).parquet(f"{base}/{write}")
        if not any(n.startswith(("part-", f"{layout.folder}=")) for n in files.names(self.spark, f"{base}/{write}")):
            return None
        kind = _manifest_schema(state)["low"].dataType
        key = F.col(layout.keys[0]).cast(kind) if layout.keys else F.lit(None).cast(kind)
        schema = state.schema if not by else T.StructType([*state.schema.fields, T.StructField(layout.folder, T.DateType())])
        with self.store.looking_up(days):
            own = self.spark.read.schema(schema).parquet(f"{base}/{write}")
        path = F.concat(F.lit(f"{write}/"), F.element_at(F.split("_metadata.file_path", f"{write}/"), 2))
        day = F.first(layout.folder) if by else F.lit(None).cast("date")
        listed = own.withColumn("path", path).groupBy("path").agg(
            day.alias("day"), F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high"), F.count_if(key.isNull()).alias("keyless")
        )
        return self._manifest(table, listed)

    def _tasks(self, rows: DataFrame, by: list[str]) -> tuple[int, int]:
        """How many tasks write, and about how many days: enough for the rows and, as each day is a file at least, for those.

        Counted over the day column alone.  Adaptive execution sees bytes only, and would give few rows of many days
        to one task.
        """
        n, days = rows.agg(F.count("*"), F.approx_count_distinct(by[0]) if by else F.lit(0)).first()
        return min(int(self.spark.conf.get("spark.sql.shuffle.partitions")), 1 + n // TASK_ROWS + days // TASK_DAYS), days

    def _manifest(self, table: str, listed: DataFrame) -> str | None:
        part = f"{self.store.root}/{table}/manifests/{uuid.uuid4().hex}"
        listed.write.parquet(part)
        return part if self.spark.read.schema(listed.schema).parquet(part).limit(1).count() else None

    def _swap(self, table: str, gone: list[str], rows: DataFrame) -> None:
        """Take files out and put rows in."""
        new = self._written(table, rows)
        self._rewritten.add(table)
        state = self.tables[table]
        parts = state.parts
        if gone or len(parts) >= PARTS:
            kept = self.store.manifest(state)
            if gone:
                out = self.spark.createDataFrame([(p,) for p in gone], "path string")
                kept = kept.join(out, "path", "left_anti")
            part = self._manifest(table, kept)
            parts = (part,) if part else ()
        self.tables[table] = replace(state, parts=(*parts, new) if new else parts)

    def _key_paths(self, table: str, state: State, paths: list[str]) -> DataFrame:
        """The keys that files hold, and in which (``_path``); no other column is read."""
        keys = list(state.layout.keys)
        own = self.store._scan(table, T.StructType([state.schema[k] for k in keys]), paths)
        return own.select(*keys, F.substring_index("_metadata.file_path", f"/{self._name(table)}/data/", -1).alias("_path"))

    def _name(self, table: str) -> str:
        return f"{self.store.root.rstrip('/').rsplit('/', 1)[-1]}/{table}"

    def _candidates(self, state: State, newest: DataFrame) -> tuple[int, list[str]]:
        """How many files there are, and those whose range of keys meets one of the batch's cells."""
        if not state.parts:
            return 0, []
        manifest = self.store.manifest(state)
        cells = key_cells(newest, state.layout.keys[0], _manifest_schema(state)["low"].dataType)
        # a file meets a cell: at most CELLS ranges, in one array
        ranges = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in cells])
        meets = F.exists(ranges, lambda c: (c["a"] <= F.col("high")) & (c["b"] >= F.col("low"))) if cells else F.lit(False)
        return manifest.count(), [r.path for r in manifest.where(F.coalesce(meets, F.lit(False))).select("path").collect()]


def key_cells(rows: DataFrame, key: str, kind: T.DataType, cells: int = CELLS) -> list[tuple]:
    """The least and the greatest key in each of at most ``cells`` equal parts of the keys' range; one part for texts."""
    own = rows.select(F.col(key).cast(kind).alias("key"))
    low, high = own.agg(F.min("key"), F.max("key")).first()
    if low is None:
        return []
    if not isinstance(kind, T.LongType):
        return [(low, high)]
    width = max(1, -(-(high - low + 1) // cells))
    cell = F.floor((F.col("key").cast("decimal(20,0)") - F.lit(low)) / F.lit(width))
    ends = own.groupBy(cell).agg(F.min("key").alias("low"), F.max("key").alias("high")).collect()
    return sorted((r.low, r.high) for r in ends)
