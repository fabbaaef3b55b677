"""Quality rules: fixed limits on counts, then gradient-boosted trees over document statistics."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkpi.llm import frames, stats

#: Labelled rows that the trees are fitted on at most (by lowest hash of the id): 8 MB of counts on the driver.
MOST_LABELLED = 50_000
TREES, DEPTH, RATE, BINS, LEAST_WEIGHT, RIDGE = 60, 3, 0.2, 32, 2.0, 1.0
#: More of these never makes a document better.
MONOTONIC = {"symbols": -1, "same_next": -1, "repeats": -1, "dup_lines": -1}
THRESHOLD = 0.3
FOLD, HELD_OUT = 5, 0


class Trees(NamedTuple):
    """All nodes of all trees in flat arrays; a leaf is its own left and right."""

    roots: np.ndarray
    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        at = np.repeat(self.roots[None, :], len(x), axis=0)
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            at = np.where(x[rows, self.feature[at]] <= self.limit[at], self.left[at], self.right[at])
        return 1 / (1 + np.exp(-(self.start + self.value[at].sum(1))))


def fit(x: np.ndarray, y: np.ndarray, signs: np.ndarray, trees: int = TREES) -> Trees:
    """Logistic loss, second-order leaves, histogram splits.

    A split on a feature with a sign is only made if its leaves are in that order, and what lies below is held on
    its side of the middle, so the whole score is monotonic in the feature.
    """
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)])
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(rate / (1 - rate)))
    raw = np.full(len(y), start)
    feature, limit, left, right, value, roots = [], [], [], [], [], []

    def node() -> int:
        me = len(feature)
        for column, v in ((feature, 0), (limit, 0.0), (left, me), (right, me), (value, 0.0)):
            column.append(v)
        return me

    def leaf(g: float, h: float, low: float, high: float) -> float:
        return float(np.clip(-g / (h + RIDGE), low, high))

    def best_split(rows: np.ndarray, g: np.ndarray, h: np.ndarray, low: float, high: float):
        total_g, total_h = g[rows].sum(), h[rows].sum()
        best = (1e-6, None)
        for f, e in enumerate(edges):
            if not len(e):
                continue
            gl = np.cumsum(np.bincount(binned[rows, f], g[rows], len(e) + 1))[:-1]
            hl = np.cumsum(np.bincount(binned[rows, f], h[rows], len(e) + 1))[:-1]
            gr, hr = total_g - gl, total_h - hl
            wl, wr = np.clip(-gl / (hl + RIDGE), low, high), np.clip(-gr / (hr + RIDGE), low, high)
            gain = gl**2 / (hl + RIDGE) + gr**2 / (hr + RIDGE) - total_g**2 / (total_h + RIDGE)
            fits = (hl >= LEAST_WEIGHT) & (hr >= LEAST_WEIGHT) & (signs[f] * (wr - wl) >= 0)
            gain = np.where(fits, gain, -1.0)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), (f, k, float(wl[k]), float(wr[k])))
        return best[1]

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, low: float, high: float) -> int:
        me = node()
        split = best_split(rows, g, h, low, high) if depth else None
        if split is None:
            value[me] = RATE * leaf(g[rows].sum(), h[rows].sum(), low, high)
            raw[rows] += value[me]
            return me
        f, k, wl, wr = split
        middle = (wl + wr) / 2
        goes = binned[rows, f] <= k
        feature[me], limit[me] = f, float(edges[f][k])
        bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)), 0: ((low, high), (low, high))}[int(signs[f])]
        left[me] = grow(rows[goes], g, h, depth - 1, *bounds[0])
        right[me] = grow(rows[~goes], g, h, depth - 1, *bounds[1])
        return me

    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        roots.append(grow(np.arange(len(y)), p - y, np.maximum(p * (1 - p), 1e-6), DEPTH, -4.0, 4.0))
    return Trees(*(np.array(c) for c in (roots, feature, limit, left, right, value)), start)


def learned(counted: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Trees | float:
    """The trees, or the constant score where the labels hold one class or none."""
    known = counted.join(frames.label_of(labels, "quality", FOLD, HELD_OUT), counted.doc_id == F.col("id")).drop("id")
    table = frames.bounded(frames.written(known, "labelled"), "doc_id", most).toArrow().combine_chunks()
    if not table.num_rows:
        return 0.5
    order = np.argsort(table.column("doc_id").to_numpy(), kind="stable")
    batch = table.to_batches()[0]
    x, y = stats.features(batch)[order], batch.column("y").to_numpy(zero_copy_only=False)[order]
    if y.min() == y.max():
        return float(y.min())
    return fit(x, y, np.array([MONOTONIC.get(name, 0) for name in stats.FEATURES]))


def judged(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and score of every document.

    base_failed: n_words < 10, or 100 * n_repeat_words > 20 * n_words.  What passes is kept if the trees' score
    reaches ``threshold``.  Learned from are labels of ids whose crc32 mod 5 is not 0.  Null and empty texts
    have no words and fail; rows with a null id are judged like others; repeated rows each keep a row; without
    labels every score is 0.5; an empty table gives no rows.
    """
    counted = frames.written(stats.of_documents(docs), "counts")
    model = learned(counted, labels)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        s = np.full(b.num_rows, model) if isinstance(model, float) else model.score(stats.features(b))
        names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        return pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(s)], [*names, "score"])

    out = frames.per_batch(counted, run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return out.select(*out.columns[:-1], failed.alias("base_failed"), (~failed & (F.col("score") >= threshold)).alias("kept"), "score")
