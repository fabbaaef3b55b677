"""Mix sources to target weights: whole repeats, a proportional share by length, and a knapsack for the rest."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fieldkpi.llm import frames, text

#: The knapsack's table has so many entries at most; a rest beyond them is first drawn down greedily.
BUDGET = 1 << 18
#: Ranks within one (source, size) are counted in so many parts by hash, so that a frequent size is not one task's.
PARTS = 64


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size: the words of every whole text (null: 0)."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text.word_counts(b.column(2)))], ["doc_id", "source", "size"])

    return docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string")).mapInArrow(
        count, "doc_id long, source string, size long"
    )


def weighted(per_source: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """Adds the weight of each source: the given ones in turn, by code point of the name, null last.

    The order is dealt over range partitions; only the number of sources per partition goes through one window.
    """
    spread = per_source.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last())
    spread = frames.written(spread.withColumn("part", F.spark_partition_id()), "sources")
    before = F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = spread.groupBy("part").agg(F.count("*").alias("n")).select("part", before.alias("before"))
    place = F.row_number().over(W.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("before") + F.col("place") - 1) % len(weights) + 1).cast("int"))
    return spread.withColumn("place", place).join(offsets, "part").select("source", "source_size", weight.alias("weight"))


def with_targets(sources: DataFrame, most_repeats: float, share: float = 1.0) -> DataFrame:
    """Adds the target: total * share by weight, at most ``most_repeats`` times the source's size.

    What a full source cannot take is shared again among the others, until none is above its limit.
    Each turn is one sum over the sources; a turn only ever fills more of them.
    """
    limit = F.col("source_size") * float(most_repeats)
    total = (sources.agg(F.sum("source_size")).first()[0] or 0) * share
    per_weight, full = 0.0, -1
    while True:
        is_full = limit <= F.col("weight") * per_weight
        row = sources.agg(
            F.sum(F.when(is_full, limit).otherwise(0.0)).alias("held"),
            F.sum(F.when(is_full, 0.0).otherwise(F.col("weight"))).alias("open"),
            F.sum(is_full.cast("int")).alias("full"),
        ).first()
        if not row.open or row.full == full:
            break
        full, per_weight = row.full, max(per_weight, (total - row.held) / row.open)
    return sources.withColumn("target", F.least(limit, F.col("weight") * per_weight))


def subset(lengths: np.ndarray, counts: np.ndarray, budget: int, most_table: int = BUDGET) -> np.ndarray:
    """How many documents of each length sum to the budget or just below it.

    Bounded knapsack over length counts.  A share of every length is taken in proportion; what is then left
    is drawn down from the longest lengths until it fits the table, and fitted by dynamic programming over
    binary-split counts, one bit for each reachable sum.
    """
    take = np.zeros(len(lengths), np.int64)
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    if budget <= 0 or total == 0:
        return take
    usable = lengths > 0
    room = max(0, budget - most_table)
    take[usable] = (counts[usable].astype(object) * room // total).astype(np.int64)
    rest = budget - int((take * lengths).sum())
    for i in np.argsort(-lengths, kind="stable"):
        if rest <= most_table or not lengths[i]:
            break
        more = min(int(counts[i] - take[i]), (rest - most_table) // int(lengths[i]))
        take[i] += more
        rest -= more * int(lengths[i])
    rest_at = rest
    fit = min(rest, most_table)
    reach, steps, mask = 1, [], (1 << (fit + 1)) - 1
    for i in np.argsort(lengths, kind="stable"):
        size = int(lengths[i])
        if not 0 < size <= fit:
            continue
        left, part = min(int(counts[i] - take[i]), fit // size), 1
        while left > 0:
            n = min(part, left)
            steps.append((i, n, reach))
            reach |= (reach << (n * size)) & mask
            left -= n
            part *= 2
        if reach >> fit & 1:
            break
    at = reach.bit_length() - 1
    for i, n, before in reversed(steps):
        if not before >> at & 1:
            take[i] += n
            at -= n * int(lengths[i])
    assert rest_at >= 0 and at == 0
    return take


def mix(docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), most_repeats: float = 3.0, share: float = 1.0, seed: int = 1, most_table: int = BUDGET) -> DataFrame:
    """doc_id, source, size, source_size, target, repeats and taken of every document.

    The size of a document is its number of words.  Every document of a source is taken as often as its target
    holds whole copies of the source; of the rest, ``subset`` says how many documents of each size are taken
    once more, and those with the lowest seeded hash of their id are.  A source so comes as near below its
    target as its sizes allow, and no document beyond ``most_repeats`` times.

    Null text has size 0; a null source is a source of its own; equal rows (same id, source and size) each
    keep a row and are ranked by order of arrival, which does not change any sum; an empty table gives no
    rows; other columns are ignored.
    """
    counted = frames.written(sizes(docs), "sizes")
    by_length = frames.written(counted.groupBy("source", "size").agg(F.count("*").alias("n")), "lengths")
    per_source = by_length.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size"))
    targets = frames.written(with_targets(frames.written(weighted(per_source, weights), "weights"), most_repeats, share), "targets")

    def quota(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size", kind="stable")
        size, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
        whole = int(target // size) if size else 0
        extra = subset(group["size"].to_numpy(), group["n"].to_numpy(), int(target - whole * size), most_table) if size else np.zeros(len(group), np.int64)
        return pd.DataFrame({"source": group["source"], "size": group["size"], "source_size": size, "target": target, "whole": whole, "extra": extra})

    keyed = by_length.withColumnRenamed("source", "s")
    joined = keyed.join(targets, F.col("s").eqNullSafe(F.col("source"))).select("source", "size", "n", "source_size", "target")
    quotas = joined.groupBy("source").applyInPandas(quota, "source string, size long, source_size long, target double, whole long, extra long")
    quotas = frames.written(quotas, "quotas")

    draw = F.xxhash64(F.lit(seed), F.col("doc_id"))
    ranked = counted.withColumn("draw", draw).withColumn("part", F.shiftrightunsigned("draw", 64 - PARTS.bit_length() + 1).cast("int"))
    key = ["source", "size"]
    per_part = ranked.groupBy(*key, "part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy(*key).orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    q = quotas.withColumnsRenamed({"source": "qs", "size": "qz"})
    offsets = per_part.withColumn("before", before).join(q, F.col("source").eqNullSafe(F.col("qs")) & (F.col("size") == F.col("qz"))).drop("qs", "qz", "n")
    offsets = offsets.withColumnsRenamed({"source": "os", "size": "oz", "part": "op"})
    on = F.col("source").eqNullSafe(F.col("os")) & (F.col("size") == F.col("oz")) & (F.col("part") == F.col("op"))
    order = W.partitionBy("source", "size", "part").orderBy(F.shiftleft("draw", PARTS.bit_length() - 1), "draw", "doc_id")
    rank = F.col("before") + F.row_number().over(order)
    repeats = F.col("whole") + (F.col("rank") <= F.col("extra")).cast("long")
    return (
        ranked.join(offsets, on)
        .withColumn("rank", rank)
        .withColumn("repeats", repeats)
        .select("doc_id", "source", "size", "source_size", "target", "repeats", (F.col("size") * F.col("repeats")).alias("taken"))
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents themselves, each as often as the mix takes it, whatever other columns they have."""
    key, times, rows, copy = frames.spare(docs, 4)
    plan = mix(docs, **options).groupBy(F.col("doc_id").alias(key)).agg(F.sum("repeats").alias(times), F.count("*").alias(rows))
    kept = docs.join(plan, F.col("doc_id").cast("long").eqNullSafe(F.col(key))).where(F.col(times) >= F.col(rows))
    each = F.explode(F.sequence(F.lit(1), F.floor(F.col(times) / F.col(rows)))).alias(copy)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns], each).drop(copy)
