"""Written tables between the steps of an operator, and columns that Arrow functions return."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldkpi.sources.workspace import new_folder

#: Narrow rows that one task writes.
ROWS_A_TASK = 50_000


def importable(spark: SparkSession) -> None:
    """Lets the workers of a local session import this library from where the driver has it; clusters get it shipped."""
    if spark.sparkContext.master.startswith("local["):
        root = str(Path(__file__).resolve().parents[2])
        have = spark.sparkContext.environment.get("PYTHONPATH", "")
        if root not in have.split(os.pathsep):
            spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, have]))


def written(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """The frame as a table in the shared folder: lost executors read it again, not compute it.

    With a bound on its ``rows`` a small table of narrow rows is written by a task for each core or ROWS_A_TASK rows,
    not by one for every shuffle partition.
    """
    if rows is not None:
        df = df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, rows // ROWS_A_TASK))
    path = new_folder(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Deletes ``written`` tables that no later step reads; shuffle files of steps that are done go with the driver's garbage."""
    for table in tables:
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            jvm = table.sparkSession.sparkContext._jvm
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
    if tables:
        tables[0].sparkSession.sparkContext._jvm.System.gc()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def spare(df: DataFrame, n: int = 1) -> list[str]:
    """n column names that the frame does not have, in any spelling."""
    most = max(map(len, df.columns), default=0)
    return ["_" * (most + 1 + i) for i in range(n)]


def keyed(docs: DataFrame, key: str) -> DataFrame:
    """The documents with a number of their own for every row that has an id, in column ``key`` (null without an id).

    An id that occurs once is its row's number.  Of rows that share an id one takes it, the others get numbers that are
    no document's id, above the greatest or below the least.  Only rows that share an id are written, so that the
    numbers stay the same when a lost executor's work is done again.
    """
    id_ = F.col("doc_id").cast("long")
    again, low, high = spare(docs.withColumn(key, F.lit(0)), 3)
    shared = written(docs.select(id_.alias(again)).where(F.col(again).isNotNull()).groupBy(again).agg(F.count("*").alias(low)).where(F.col(low) > 1).select(again), "shared-ids")
    if shared.isEmpty():
        return docs.withColumn(key, id_)
    single = docs.join(shared, id_ == F.col(again), "left_anti").withColumn(key, id_)
    several = docs.join(shared, id_ == F.col(again), "left_semi").withColumn(again, F.monotonically_increasing_id())
    several = written(several, "shared-id-rows")
    least, greatest = docs.agg(F.min(id_), F.max(id_)).first()
    most = several.agg(F.max(again)).first()[0] + 1
    if greatest + most < 1 << 63:
        number = F.lit(greatest) + 1 + F.col(again)
    elif least - most >= -(1 << 63):
        number = F.lit(least) - 1 - F.col(again)
    else:
        raise OverflowError("rows share an id, and the ids leave no room for further numbers")
    first = written(several.groupBy(id_.alias(low)).agg(F.min(again).alias(high)), "first-rows")
    numbered = several.join(first, (id_ == F.col(low)) & (F.col(again) == F.col(high)), "left").withColumn(key, F.coalesce(low, number))
    return single.unionByName(numbered.select(*[F.col(f"`{c}`") for c in docs.columns], key))


def per_batch(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``function`` on every Arrow batch; it may return fewer or more rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = function(batch)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


def remainder(doc_id, modulus: int):
    """crc32 of the id's digits, modulo."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def bounded(df: DataFrame, key: str, most: int) -> DataFrame:
    """All rows, or about ``most`` of them where there are more: those with the lowest hash of the key."""
    n = df.count()
    if n <= most:
        return df
    return df.where(F.shiftrightunsigned(F.xxhash64(F.lit(11), F.col(key)), 11) < int(most / n * (1 << 53)))


def label_of(table: DataFrame, column: str, fold: int, held_out: int) -> DataFrame:
    """(id, y): the mean 0/1 label of each labelled document outside the held-out fold; nulls are left out."""
    known = table.select(F.col("doc_id").cast("long").alias("id"), F.col(column).cast("double").alias("y")).where("id IS NOT NULL AND y IS NOT NULL")
    return known.where(remainder(F.col("id"), fold) != held_out).groupBy("id").agg(F.avg("y").alias("y"))
