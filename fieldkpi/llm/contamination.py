"""Benchmark decontamination: short test items inside long documents, by containment of word shingles."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldkpi.llm import frames, text

WIDTH = 5
SIMILARITY = 0.8
#: The items are taken in blocks of about so many shingles (8 MB); every block is held against all documents.
BLOCK_SHINGLES = 1 << 20
FOUND = "doc_id long, item_id long, n_shared long, n_item long, containment double"


class Items(NamedTuple):
    """A block of test items: the full shingle sets, and the sketches' entries in ascending order."""

    ids: list
    sets: list[np.ndarray]
    keys: np.ndarray
    owners: np.ndarray


def sketch_size(n: int, least: float) -> int:
    """Entries of the sketches of the size class (between powers of two) that a set of n shingles belongs to.

    A document that holds ``least`` of an item's n shingles lacks floor((1 - least) * n) of them at most, so one of
    any more entries is in it: with as many for the largest set of the class no item is missed.
    """
    largest = (1 << n.bit_length()) - 1
    return min(n, int((1 - least) * largest + 1e-9) + 1)


def block(ids: list, sets: list[np.ndarray], least: float) -> Items:
    """The lowest scrambled hashes of a set are its MinHash sketch; its size is that of the set's size class."""
    keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for i, s in enumerate(sets):
        order = np.argsort(text.mix(s ^ np.uint64(0x5DEECE66D)))[: sketch_size(len(s), least)]
        keys.append(s[order])
        owners.append(np.full(len(order), i))
    k, o = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(k, kind="stable")
    return Items(ids, sets, k[order], o[order])


def blocks(benchmark: DataFrame, width: int, least: float, most: int = BLOCK_SHINGLES) -> Iterator[Items]:
    """All items, block by block; an item without words is in none."""
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    sets = frames.per_batch(rows, _sets(width), "item_id long, shingles binary")
    sets = frames.written(sets, "items")
    total = (sets.agg(F.sum(F.length("shingles"))).first()[0] or 0) // 8
    parts = max(1, -(-total // most))
    for part in range(parts):
        own = sets.where(F.pmod(F.xxhash64("shingles"), F.lit(parts)) == part).collect()
        if own:
            yield block([r.item_id for r in own], [np.frombuffer(r.shingles, np.uint64) for r in own], least)


def _sets(width: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        at, sets = [], []
        for part in text.slices(batch.column(1)):
            s = text.document_shingles(part, width)
            bounds = np.searchsorted(s.docs, np.arange(part.last - part.first + 1))
            for i in np.flatnonzero(np.diff(bounds)):
                at.append(part.first + int(i))
                sets.append(s.hashes[bounds[i] : bounds[i + 1]].tobytes())
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(sets, pa.binary())], ["item_id", "shingles"])

    return run


def search(part: text.Texts, items: Items, width: int, least: float) -> list[tuple[int, int, int]]:
    """(document, item, shared shingles) of a slice: sketch entries propose, the full sets decide."""
    s = text.document_shingles(part, width)
    low, high = np.searchsorted(items.keys, s.hashes, "left"), np.searchsorted(items.keys, s.hashes, "right")
    hit = np.flatnonzero(high > low)
    proposed = {(int(s.docs[h]), int(o)) for h in hit for o in items.owners[low[h] : high[h]]}
    bounds = np.searchsorted(s.docs, np.arange(part.last - part.first + 1))
    found = []
    for doc, item in sorted(proposed):
        own, wanted = s.hashes[bounds[doc] : bounds[doc + 1]], items.sets[item]
        at = np.minimum(np.searchsorted(own, wanted), len(own) - 1)
        shared = int((own[at] == wanted).sum())
        if shared >= least * len(wanted) - 1e-9:
            found.append((part.first + doc, item, shared))
    return found


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, least: float = SIMILARITY, most: int = BLOCK_SHINGLES) -> DataFrame:
    """doc_id, item_id, n_shared, n_item, containment: every document that holds ``least`` of an item's shingles.

    Words are lower-cased (A-Z).  An item of fewer words than ``width`` has its whole sequence as one shingle and is
    found in documents that consist of it; an item or document with null text, or without words, matches
    nothing.  Null ids stay null.  Repeated rows each give rows; empty tables give none; other columns are ignored.
    Whole documents are read, and no documents are shuffled.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = None
    for items in blocks(benchmark, width, least, most):
        found = frames.per_batch(rows, _finder(rows.sparkSession, items, width, least), FOUND)
        out = found if out is None else out.unionByName(found)
    return rows.sparkSession.createDataFrame([], FOUND) if out is None else out


def _finder(spark: SparkSession, items: Items, width: int, least: float):
    sent = spark.sparkContext.broadcast(items)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        held = sent.value
        found = [f for part in text.slices(batch.column(1)) for f in search(part, held, width, least)]
        docs, at, shared = (np.array([f[i] for f in found], np.int64) for i in range(3))
        sizes = np.array([len(s) for s in held.sets], np.int64)[at]
        ids = pa.array([held.ids[i] for i in at], pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(docs)), ids, pa.array(shared), pa.array(sizes), pa.array(shared / np.maximum(sizes, 1))], ["doc_id", "item_id", "n_shared", "n_item", "containment"])

    return run


def clean(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, least: float = SIMILARITY, most: int = BLOCK_SHINGLES) -> DataFrame:
    """The documents that hold no test item, as they are, whatever other columns they have."""
    searched = frames.spare(docs)[0]
    fields = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    for items in blocks(benchmark, width, least, most):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def keep(batch: pa.RecordBatch, sent=sent) -> pa.RecordBatch:
            stays = np.ones(batch.num_rows, bool)
            for part in text.slices(batch.column(batch.num_columns - 1)):
                stays[[f[0] for f in search(part, sent.value, width, least)]] = False
            return batch.select(range(batch.num_columns - 1)).filter(pa.array(stays))

        docs = frames.per_batch(docs.select("*", F.col("text").cast("string").alias(searched)), keep, fields)
    return docs
