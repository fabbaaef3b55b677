"""Masked pseudo-likelihood: a small window network predicts every word from the words on both sides.

A word is one of FORMS hashed, lower-cased forms, on both sides of the prediction.  The network gives the probability of
every form at a place from the forms around it: a softmax over how many binary digits the form's rank by frequency has,
then one yes or no for each further digit, on the way down a tree.  All of these answers follow from the words around
the place, and the probabilities of all forms add up to 1.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkpi.llm import frames, text

FORMS = 1 << 16
#: Every form is a class of its own, numbered by its rank: class 0 is the most frequent form.
CLASSES = FORMS
#: Ranks of 0, 1, ... 16 binary digits.
GROUPS = 17
DIGITS = np.array([r.bit_length() for r in range(FORMS)], np.uint8)
SIDE = 2
WIDTH = 16
ROUNDS = 2
#: A round fits every so many words of each text (others each round); counts and scores take all words.
STRIDE = 1
BLOCK = 4096
RATE = 0.2
OFFSETS = [o for o in range(-SIDE, SIDE + 1) if o]
#: Numbers of a vector that travel in one row.
CHUNK = 1 << 13


class Network(NamedTuple):
    """Rows of ``inputs`` by class (the last one stands for places outside the text), weighed by offset.

    ``outputs`` and ``bias`` have a row for each group, then one for each node of the groups' trees.
    """

    inputs: np.ndarray
    gains: np.ndarray
    outputs: np.ndarray
    bias: np.ndarray

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self])

    @staticmethod
    def shaped(values: np.ndarray) -> Network:
        shapes = [(CLASSES + 1, WIDTH), (len(OFFSETS), WIDTH), (GROUPS + FORMS, WIDTH), (GROUPS + FORMS,)]
        cuts = np.cumsum([np.prod(s) for s in shapes])[:-1]
        return Network(*[v.astype(np.float32).reshape(s) for v, s in zip(np.split(values, cuts), shapes, strict=True)])


class Vocabulary(NamedTuple):
    classes: np.ndarray  # of each form
    within: np.ndarray  # log share of each form in its class: a class is one form
    shares: np.ndarray  # log share of each class


def _leaves(group: int) -> slice:
    return slice(1 << group >> 1, 1 << group)


def start(vocabulary: Vocabulary, seed: int = 5) -> Network:
    """Small seeded weights; the bias follows the shares, so an unfitted network is close to a word-count model."""
    rows = CLASSES + 1 + GROUPS + FORMS
    noise = (text.stream(seed, rows * WIDTH) / 2.0**64 - 0.5).reshape(rows, WIDTH) * 0.4
    bias = np.zeros(GROUPS + FORMS)
    for group in range(GROUPS):
        below = np.exp(vocabulary.shares[_leaves(group)])
        bias[group] = np.log(below.sum())
        while len(below) > 1:  # nodes of a level stand together, the top one first
            first = GROUPS + (1 << group >> 1) + len(below) // 2
            bias[first : first + len(below) // 2] = np.log(below[1::2] / below[::2])
            below = below[::2] + below[1::2]
    outputs = noise[CLASSES + 1 :]
    return Network.shaped(np.concatenate([noise[: CLASSES + 1].ravel(), np.ones(len(OFFSETS) * WIDTH), outputs.ravel(), bias]))


def vocabulary(counts: np.ndarray) -> Vocabulary:
    """Ranks and shares; every form counts half a word more, so none has share 0."""
    order = np.lexsort((np.arange(FORMS), -counts))
    classes = np.empty(FORMS, np.int32)
    classes[order] = np.arange(FORMS)
    weight = counts[order] + 0.5
    return Vocabulary(classes, np.zeros(FORMS), np.log(weight / weight.sum()))


def hidden(net: Network, near: np.ndarray) -> np.ndarray:
    return _hidden(net, net.inputs[near])


def _hidden(net: Network, beside: np.ndarray) -> np.ndarray:
    total = beside[0] * net.gains[0]
    for i in range(1, len(OFFSETS)):
        total += beside[i] * net.gains[i]
    return np.tanh(total)


def _groups(net: Network, h: np.ndarray) -> np.ndarray:
    """Log-probabilities of the groups, one row per word."""
    z = h @ net.outputs[:GROUPS].T + net.bias[:GROUPS]
    z -= z.max(1, keepdims=True)
    return z - np.log(np.exp(z).sum(1, keepdims=True))


def _log_yes(z: np.ndarray) -> np.ndarray:
    return np.minimum(z, 0) - np.log1p(np.exp(-np.abs(z)))


def log_classes(net: Network, h: np.ndarray) -> np.ndarray:
    """Log-probabilities of all classes, one row per word; for few words, fits and scores go down to their own form."""
    groups, out = _groups(net, h), np.empty((len(h), CLASSES), np.float32)
    z = h @ net.outputs[GROUPS:].T + net.bias[GROUPS:]
    yes, no = _log_yes(z), _log_yes(-z)
    for group in range(GROUPS):
        log = groups[:, group : group + 1]
        for level in range(group - 1):
            at = slice((1 << group >> 1) + (1 << level), (1 << group >> 1) + (2 << level))
            log = np.stack([log + no[:, at], log + yes[:, at]], axis=2).reshape(len(h), -1)
        out[:, _leaves(group)] = log
    return out


class Ways(NamedTuple):
    """The questions on the way to some classes, from the last to the first: whose, at which row, and the answer."""

    who: np.ndarray
    row: np.ndarray
    yes: np.ndarray
    asked: np.ndarray  # words with a question, and where theirs begin
    first: np.ndarray


def _ways(middle: np.ndarray) -> Ways:
    digits = DIGITS[middle].astype(np.int32)
    n = np.maximum(digits - 1, 0)
    first = text.exclusive(n) if len(n) else n
    who = np.repeat(np.arange(len(middle)), n)
    rank, step = middle[who], np.arange(len(who)) - first[who]
    row = GROUPS + (1 << digits[who] >> 1) + (rank >> step + 1)
    asked = np.flatnonzero(n)
    return Ways(who, row, rank >> step & 1, asked, first[asked])


def log_of(net: Network, h: np.ndarray, middle: np.ndarray) -> np.ndarray:
    """The log-probability of one class per word."""
    w = _ways(middle)
    z = np.einsum("ij,ij->i", h[w.who], net.outputs[w.row]) + net.bias[w.row]
    out = _groups(net, h)[np.arange(len(h)), DIGITS[middle]].astype(np.float64)
    return out + np.bincount(w.who, _log_yes(np.where(w.yes, z, -z)), len(h))


def _by_row(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by row, where each row's entries begin in it, and the different rows."""
    order = np.argsort(rows.astype(np.uint16) if len(rows) and rows.max() < 1 << 16 else rows, kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1])) if len(rows) else np.zeros(0, np.int64)
    return order, first, rows[first]


def slopes(net: Network, near: np.ndarray, middle: np.ndarray) -> list[tuple[np.ndarray | slice, np.ndarray]]:
    """Of the mean negative log-probability of the middle classes: for each array the rows concerned and their slopes."""
    n = len(middle)
    beside = net.inputs[near]
    h, w = _hidden(net, beside), _ways(middle)
    p = np.exp(_groups(net, h))
    p[np.arange(n), DIGITS[middle]] -= 1
    p /= n
    back = p @ net.outputs[:GROUPS]
    rows, slope, shift = np.arange(GROUPS), p.T @ h, p.sum(0)
    if len(w.asked):
        nodes = net.outputs[w.row]
        z = np.einsum("ij,ij->i", h[w.who], nodes) + net.bias[w.row]
        off = (1 / (1 + np.exp(-z)) - w.yes).astype(np.float32) / np.float32(n)
        nodes *= off[:, None]
        back[w.asked] += np.add.reduceat(nodes, w.first, axis=0)
        order, first, asked = _by_row(w.row - GROUPS)
        off = off[order]
        own = h[w.who[order]]
        own *= off[:, None]
        rows = np.append(rows, asked + GROUPS)
        slope, shift = np.concatenate([slope, np.add.reduceat(own, first, axis=0)]), np.append(shift, np.add.reduceat(off, first))
    back *= 1 - h * h
    gains = np.einsum("onj,nj->oj", beside, back)
    order, first, seen = _by_row(near.ravel())
    moved = back[order % n]
    moved *= net.gains[order // n]
    return [(seen, np.add.reduceat(moved, first, axis=0)), (slice(None), gains), (rows, slope), (rows, shift)]


def gradient(net: Network, near: np.ndarray, middle: np.ndarray) -> Network:
    """``slopes`` as a whole network."""
    out = Network.shaped(np.zeros(len(net.flat())))
    for x, (rows, slope) in zip(out, slopes(net, near, middle), strict=True):
        x[rows] = slope
    return out


def _placed(tokens: list[np.ndarray], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes of some texts with places outside them between, and where each word stands."""
    sizes = np.array([len(t) for t in tokens], np.int64)
    n = int(sizes.sum())
    at = np.arange(n) + SIDE * (np.repeat(np.arange(len(tokens)), sizes) + 1)
    out = np.full(n + SIDE * (len(tokens) + 1), CLASSES, np.int32)
    out[at] = classes[np.concatenate(tokens)] if n else 0
    return out, at


def _near(placed: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.stack([placed[at + o] for o in OFFSETS])


def _texts(batch: pa.RecordBatch, most: int = 1 << 18) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Rows of a batch, some at a time: the first one's number and the forms of each."""
    first, held, size = 0, [], 0
    for i, value in enumerate(batch.column("tokens")):
        held.append(np.frombuffer(value.as_buffer(), np.uint16))
        size += len(held[-1])
        if size >= most:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def tokens(docs: DataFrame) -> DataFrame:
    """doc_id, tokens: the forms of all words of each text, two bytes each."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[bytes] = []
        for part in text.slices(batch.column(1)):
            data = text.lowered(part.data)
            w = text.words(data, part.offsets)
            forms = (text.span_hashes(text.prefix_sums(data), w.starts, w.ends) % np.uint64(FORMS)).astype(np.uint16)
            out += [forms[a:b].tobytes() for a, b in zip(w.bounds[:-1], w.bounds[1:], strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "tokens"])

    return frames.per_batch(rows, run, "doc_id long, tokens binary")


def _summed(df: DataFrame, vector: Callable[[Iterable[pa.RecordBatch]], np.ndarray], size: int) -> np.ndarray:
    """The sum over partitions of a vector of fixed size, added up on Spark, in chunks; those of zeros do not travel."""

    def chunks(values: dict[int, np.ndarray]) -> pa.RecordBatch:
        some = {c: v for c, v in values.items() if v.any()}
        return pa.RecordBatch.from_arrays([pa.array(list(some), pa.int32()), pa.array([v.tobytes() for v in some.values()], pa.binary())], ["chunk", "part"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = vector(batches).astype(np.float32)
        yield chunks({i // CHUNK: values[i : i + CHUNK] for i in range(0, size, CHUNK)})

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                sums[chunk] = sums.get(chunk, 0.0) + np.frombuffer(part.as_buffer(), np.float32).astype(np.float64)
        yield chunks(sums)

    out = np.zeros(size)
    for r in df.mapInArrow(run, "chunk int, part binary").repartition("chunk").mapInArrow(add, "chunk int, part binary").toArrow().to_pylist():
        part = np.frombuffer(r["part"])
        out[r["chunk"] * CHUNK : r["chunk"] * CHUNK + len(part)] = part
    return out


def counts(read: DataFrame) -> np.ndarray:
    def vector(batches: Iterable[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros(FORMS)
        for batch in batches:
            for _, held in _texts(batch):
                out += np.bincount(np.concatenate(held), minlength=FORMS)
        return out

    return _summed(read, vector, FORMS)


def fitted(read: DataFrame, known: Vocabulary, rounds: int = ROUNDS, stride: int = STRIDE) -> Network:
    """Each round every partition goes on from the same network over its texts; the results are averaged by words.

    Without words the network stays as it starts.
    """
    net = start(known)
    size = len(net.flat())
    for turn in range(rounds):

        def vector(batches: Iterable[pa.RecordBatch], net: Network = net, turn: int = turn) -> np.ndarray:
            own = Network.shaped(net.flat())
            squares = Network.shaped(np.full(size, 1e-4))
            seen = 0
            for batch in batches:
                for _, held in _texts(batch):
                    placed, at = _placed(held, known.classes)
                    at = at[turn % stride :: stride]
                    at = at[np.argsort(text.mix(at.astype(np.uint64)))]
                    for i in range(0, len(at), BLOCK):
                        some = at[i : i + BLOCK]
                        for w, s, (rows, g) in zip(own, squares, slopes(own, _near(placed, some), placed[some]), strict=True):
                            s[rows] += g * g
                            w[rows] -= RATE / (turn + 1) * g / np.sqrt(s[rows])
                    seen += len(at)
            # what moved: rows that no word of the partition touches are zeros
            return np.append((own.flat() - net.flat()).astype(np.float64) * seen, seen)

        sums = _summed(read, vector, size + 1)
        if sums[-1]:
            net = Network.shaped(net.flat() + sums[:-1] / sums[-1])
    return net


def scores(read: DataFrame, net: Network, known: Vocabulary) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, sums = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
        for first, held in _texts(batch):
            placed, at = _placed(held, known.classes)
            log = known.within[np.concatenate(held)]
            for i in range(0, len(at), BLOCK):
                some = at[i : i + BLOCK]
                log[i : i + BLOCK] += log_of(net, hidden(net, _near(placed, some)), placed[some])
            own = np.array([len(t) for t in held])
            sizes[first : first + len(held)] = own
            sums[first : first + len(held)] = np.bincount(np.repeat(np.arange(len(held)), own), log, len(held))
        mean = pa.array(sums / np.maximum(sizes, 1), mask=sizes == 0)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.array(sums), mean], ["doc_id", "n_tokens", "log_likelihood", "mean_log_likelihood"])

    return frames.per_batch(read, run, "doc_id long, n_tokens long, log_likelihood double, mean_log_likelihood double")


def scored(docs: DataFrame, rounds: int = ROUNDS, stride: int = STRIDE) -> DataFrame:
    """doc_id, n_tokens, log_likelihood (sum over all words), mean_log_likelihood; one row for every row.

    Word counts come from all texts; the network is fitted on every ``stride``-th word of every text, so both grow
    with the corpus.  Null texts and texts without words have 0 words, the sum 0 and a null mean.  Equal texts have
    equal scores but for float rounding; ids are never read, so null and repeated ones do no harm.  Other columns are
    ignored.  An empty table gives no rows.
    """
    read = frames.written(tokens(docs), "tokens")
    known = vocabulary(counts(read))
    return scores(read, fitted(read, known, rounds, stride), known)
