"""Quality scores: a Gaussian kernel over document statistics by random Fourier features, ridge regression, isotonic calibration."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkpi.llm import frames, stats
from fieldkpi.llm.text import slices as text_slices

#: Labelled rows that the model is fitted on at most (by lowest hash of the id).
MOST_LABELLED = 200_000
WAVES = 256
GRID = 2_000
THRESHOLD = 0.3
FOLD, HELD_OUT = 5, 0


class Kernel(NamedTuple):
    """Random Fourier features of the standardised statistics."""

    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    phases: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.column_stack([np.ones(len(x)), z, np.sqrt(2 / len(self.phases)) * np.cos(z @ self.waves + self.phases)])


class Model(NamedTuple):
    kernel: Kernel
    weights: np.ndarray
    steps: np.ndarray
    levels: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.kernel(x) @ self.weights
        level = np.interp(raw, self.steps, self.levels)
        # the raw score orders documents that the calibration holds equal
        return np.clip(0.999 * level + 0.001 / (1 + np.exp(-4 * (raw - 0.5))), 0, 1)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least-squares non-decreasing fit of y over ascending x (pool adjacent violators): block centres and levels."""
    blocks: list[list[float]] = []
    for a, b, w in zip(x, y, weight, strict=True):
        blocks.append([a * w, b * w, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last, strict=True)]
    sums = np.array(blocks).reshape(-1, 3)
    return sums[:, 0] / sums[:, 2], sums[:, 1] / sums[:, 2]


def _sums(df: DataFrame, function, width: int) -> dict[int, np.ndarray]:
    """Sums over all partitions of the rows (numbered) of the matrices that ``function`` gives for batches."""

    def partial(batches):
        total = None
        for b in batches:
            if b.num_rows:
                m = function(b)
                total = m if total is None else total + m
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["at", "sums"])

    def add(table: pa.Table) -> pa.Table:
        values = np.vstack([np.asarray(v) for v in table.column("sums").to_pylist()]).sum(0)
        return pa.table({"at": table.column("at")[:1], "sums": pa.array([values], pa.list_(pa.float64()))})

    rows = df.mapInArrow(partial, "at int, sums array<double>").groupBy("at").applyInArrow(add, "at int, sums array<double>").collect()
    return {r.at: np.array(r.sums) for r in rows} or {0: np.zeros(width)}


def fit(counted: DataFrame, labelled: DataFrame, most: int = MOST_LABELLED, waves: int = WAVES, ridge: float = 1e-3, seed: int = 5) -> Model | float:
    """The model, or the constant score where the labels hold one class or none.

    ``counted``: stats.of_documents; ``labelled``: (id, y).  The statistics of the labelled documents are
    summed per partition: first moments, then the normal equations of two halves.  The halves' models score
    each other's rows, and the calibration is fitted on these scores, on a grid of at most GRID cells.
    """
    known = counted.join(labelled, counted.doc_id == labelled.id).drop("id")
    known = frames.written(frames.bounded(known, "doc_id", most).withColumn("half", F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(2)).cast("int")).repartition(16), "labelled")

    def target(b: pa.RecordBatch) -> np.ndarray:
        return b.column("y").to_numpy(zero_copy_only=False)

    def moments(b: pa.RecordBatch) -> np.ndarray:
        x, y = stats.features(b), target(b)
        return np.vstack([x.sum(0), (x * x).sum(0), np.full(x.shape[1], len(x)), np.full(x.shape[1], y.sum())])

    m = _sums(known, moments, len(stats.FEATURES))
    if len(m) < 4 or not 0 < m[3][0] < m[2][0]:
        return float(m[3][0] / m[2][0]) if len(m) == 4 else 0.5
    mean = m[0] / m[2]
    scale = np.sqrt(np.maximum(m[1] / m[2] - mean**2, 1e-8))
    random = np.random.default_rng(seed)
    kernel = Kernel(mean, scale, random.normal(0, 0.35, (len(mean), waves)), random.uniform(0, 2 * np.pi, waves))

    def equations(b: pa.RecordBatch) -> np.ndarray:
        z, y, half = kernel(stats.features(b)), target(b), b.column("half").to_numpy(zero_copy_only=False)
        return np.vstack([np.column_stack([z[half == h].T @ z[half == h], z[half == h].T @ y[half == h]]) for h in (0, 1)])

    size = 1 + len(mean) + waves
    e = _sums(known, equations, size + 1)
    both = np.vstack([e[i] for i in range(2 * size)]).reshape(2, size, size + 1)

    def solve(sums: np.ndarray) -> np.ndarray:
        n = max(1.0, sums[0, 0])
        return np.linalg.solve(sums[:, :-1] + ridge * n * np.eye(size), sums[:, -1])

    first, second, weights = solve(both[0]), solve(both[1]), solve(both.sum(0))

    def cells(b: pa.RecordBatch) -> np.ndarray:
        z, y, half = kernel(stats.features(b)), target(b), b.column("half").to_numpy(zero_copy_only=False)
        raw = np.where(half == 0, z @ second, z @ first)
        cell = np.clip((raw + 0.5) / 2 * GRID, 0, GRID - 1).astype(int)
        return np.vstack([np.bincount(cell, v, GRID) for v in (np.ones(len(y)), raw, y)])

    c = _sums(known, cells, GRID)
    some = c[0] > 0
    steps, levels = isotonic(c[1][some] / c[0][some], c[2][some] / c[0][some], c[0][some])
    return Model(kernel, weights, steps, levels)


def score(counted: DataFrame, model: Model | float, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of stats.of_documents."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        s = np.full(b.num_rows, model) if isinstance(model, float) else model.score(stats.features(b))
        return pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    scored = frames.per_batch(counted, run, "doc_id long, score double, predicted int")
    held = F.coalesce(frames.remainder(F.col("doc_id"), FOLD) == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted")


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted of every document.

    Only documents' texts feed the score.  Labels are learned from rows with crc32(id) mod 5 other than 0; a
    document with several label rows counts with their mean, null labels and ids not at all.  Null and empty
    texts are scored as documents without words.  Repeated rows are each scored; an empty table gives no
    rows; without labels of both classes every score is the labels' mean (0.5 without any).
    """
    counted = frames.written(stats.of_documents(docs), "counts")
    return score(counted, fit(counted, frames.label_of(labels, "quality", FOLD, HELD_OUT), **options), threshold)


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not rejected, as they are.  Copies of an id stay or go by their own text."""
    counted = frames.written(stats.of_documents(docs), "counts")
    model = fit(counted, frames.label_of(labels, "quality", FOLD, HELD_OUT))

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = [stats.count(p) for p in text_slices(batch.column(batch.num_columns - 1))]
        if not parts:
            return batch
        table = pa.RecordBatch.from_pydict({c: np.concatenate([p[c] for p in parts]) for c in stats.COUNTS})
        s = np.full(batch.num_rows, model) if isinstance(model, float) else model.score(stats.features(table))
        return batch.filter(pa.array(s >= threshold)).select(range(batch.num_columns - 1))

    fields = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    return frames.per_batch(docs.select("*", F.col("text").cast("string").alias(frames.spare(docs)[0])), keep, fields)
