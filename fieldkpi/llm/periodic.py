"""Runs of repeated words: stretches that repeat with a period, found by longest common extensions over a difference cover.

Many documents are joined into one array of word codes, each behind a separator of its own, so that nothing extends
from one into the next.  Two places of an array meet a pair of sampled places within a few words; beyond that the
common extension is a range minimum over the common prefixes of the sampled suffixes in sorted order.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkpi.llm import text

LEAST = 12
SLICE_BYTES = 1 << 20
#: The cover: every difference of two numbers modulo 31 is one of two of these (a perfect difference set).
MODULUS, COVER = 31, (1, 5, 11, 24, 25, 27)


def _shifts() -> np.ndarray:
    """shift[i mod m, (j - i) mod m]: the fewest words after which both i and j are sampled."""
    inside = np.isin(np.arange(MODULUS), COVER)
    out = np.zeros((MODULUS, MODULUS), np.int64)
    for i in range(MODULUS):
        for d in range(MODULUS):
            out[i, d] = next(k for k in range(MODULUS) if inside[(i + k) % MODULUS] and inside[(i + k + d) % MODULUS])
    return out


SHIFT = _shifts()


class Extensions:
    """Longest common extensions to the right in an array whose documents end in separators of their own.

    Asked are only places of one document, so suffixes are sorted within their document; the sort looks at further
    words only where suffixes agree so far, and after MODULUS words at the ranks of the sampled suffixes behind them.
    """

    def __init__(self, codes: np.ndarray, docs: np.ndarray):
        n = len(codes)
        self.codes = np.concatenate([codes, np.arange(1, MODULUS + 2) + int(codes.max(initial=0))])
        at = np.flatnonzero(np.isin(np.arange(n) % MODULUS, COVER))
        self.sampled = np.full(n + MODULUS + 1, -1, np.int64)
        self.sampled[at] = np.arange(len(at))
        levels = self._levels(at, docs)
        order = np.argsort(levels[-1], kind="stable")
        self.rank = np.empty(len(at), np.int64)
        self.rank[order] = np.arange(len(at))
        common = self._common(at[order[:-1]], at[order[1:]], levels) if len(at) else np.zeros(0, np.int64)
        #: table[k][r]: the least common prefix among 2 ** k neighbours from r on.
        self.table = [common]
        while (1 << len(self.table)) <= len(common):
            half, last = 1 << (len(self.table) - 1), self.table[-1]
            self.table.append(np.minimum(last[:-half], last[half:]))

    def _levels(self, at: np.ndarray, docs: np.ndarray) -> list[np.ndarray]:
        """Ranks of the sampled suffixes by their document and first MODULUS words, then by twice as many each time."""
        group = _ranked(docs[at])
        for k in range(MODULUS):
            open_ = _shared(group)
            if not len(open_):
                break
            group = _split(group, open_, self.codes[at[open_] + k])
        levels, reach = [group], MODULUS
        while len(open_ := _shared(group)):
            # agreeing in all words so far, both have a sampled suffix behind them: none of them has met its separator
            group = _split(group, open_, group[self.sampled[at[open_] + reach]])
            levels.append(group)
            reach *= 2
        return levels

    def _common(self, a: np.ndarray, b: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Words that the sampled suffixes at a and b share (0 across documents)."""
        done = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            x, y = self.sampled[a + done], self.sampled[b + done]
            same = (levels[k][x] == levels[k][y]) & (x >= 0) & (y >= 0)
            done[same] += MODULUS << k
        alive = np.arange(len(a))
        for _ in range(MODULUS):
            alive = alive[self.codes[a[alive] + done[alive]] == self.codes[b[alive] + done[alive]]]
            done[alive] += 1
        return done

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal words from i and from j on; i < j, both of one document or a separator behind it."""
        out = np.zeros(len(i), np.int64)
        wait = SHIFT[i % MODULUS, (j - i) % MODULUS]
        alive = np.arange(len(i))
        for k in range(MODULUS):
            alive = alive[wait[alive] > k]
            alive = alive[self.codes[i[alive] + k] == self.codes[j[alive] + k]]
            if not len(alive):
                break
            out[alive] = k + 1
        met = np.flatnonzero(out == wait)
        x, y = self.sampled[i[met] + wait[met]], self.sampled[j[met] + wait[met]]
        inside = (x >= 0) & (y >= 0)
        met, x, y = met[inside], self.rank[x[inside]], self.rank[y[inside]]
        low, high = np.minimum(x, y), np.maximum(x, y)
        power = np.frexp((high - low).astype(np.float64))[1] - 1
        for k in np.unique(power):
            own = np.flatnonzero(power == k)
            out[met[own]] += np.minimum(self.table[k][low[own]], self.table[k][high[own] - (1 << int(k))])
        return out


def _ranked(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].astype(np.int64)


def _shared(group: np.ndarray) -> np.ndarray:
    """Places whose group holds others too."""
    return np.flatnonzero(np.bincount(group)[group] > 1) if len(group) else np.zeros(0, np.int64)


def _split(group: np.ndarray, at: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The groups, those at ``at`` parted in the order of the keys; a group's number leaves room for its parts."""
    first = np.zeros(len(group) + 1, np.int64)
    np.cumsum(np.bincount(group, minlength=len(group)), out=first[1:])
    out = first[group]  # how many are in lower groups
    order = np.lexsort([keys, group[at]])
    g, k = group[at][order], keys[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (k[1:] != k[:-1])
    begins = np.flatnonzero(new)
    within = np.arange(len(g)) - np.maximum.accumulate(np.where(np.concatenate([[True], g[1:] != g[:-1]]), np.arange(len(g)), 0))
    out[at[order]] += within[begins][np.cumsum(new) - 1]
    return _ranked(out)


class Runs(NamedTuple):
    """In order of start, then period; starts count from the array's begin."""

    starts: np.ndarray
    lengths: np.ndarray
    periods: np.ndarray


def _grid(codes: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of neighbouring grid points k * period and (k + 1) * period with equal words.

    Documents stand in descending length: those that can hold two periods end at ``limit``.  A run holds two
    neighbouring points of its period's grid, so no other places need a look.  Small periods are taken one by one,
    the points of all greater ones together by k.
    """
    most = int(lengths[0]) // 2 if len(lengths) else 0
    periods = np.arange(most + 1)
    limit = np.concatenate([[0], ends])[np.searchsorted(-lengths, -2 * periods, "right")]
    small = min(most, int(len(codes) ** 0.5) + 1)
    for p in range(1, small + 1):
        points = codes[: limit[p] : p]
        k = np.flatnonzero(points[1:] == points[:-1])
        yield k * p, np.full(len(k), p)
    for k in range(limit[small + 1] // (small + 1) if most > small else 0):
        # (k + 1) * p < limit[p]: the left side grows with p and the right side does not
        last = small + int(np.searchsorted((k + 1) * periods[small + 1 :] >= limit[small + 1 :], True))
        if last <= small:
            break
        p = periods[small + 1 : last + 1]
        p = p[codes[k * p] == codes[(k + 1) * p]]
        yield k * p, p


def found(codes: np.ndarray, docs: np.ndarray, ends: np.ndarray, lengths: np.ndarray, least: int = LEAST) -> Runs:
    """All maximal stretches of at least ``least`` words and two periods, each with its smallest period.

    ``codes``: documents in descending length, each behind a separator, and one at the end; no two separators are
    equal, none is a word.  ``ends``: where each document ends.  ``docs``: the document of each place.
    """
    n = len(codes)
    parts = [np.zeros((0, 3), np.int64)]
    right = left = None
    for at, period in _gathered(_grid(codes, ends, lengths)):
        own = docs[at] == docs[at + period]
        at, period = at[own], period[own]
        if not len(at):
            continue
        if right is None:
            # to the left: the places before, in the reversed array
            right, left = Extensions(codes, docs), Extensions(codes[::-1].copy(), docs[::-1].copy())
        after = right(at, at + period)
        before = left(n - at - period, n - at)
        rows = np.column_stack([at - before, before + period + after, period])
        parts.append(np.unique(rows[(before + after >= period) & (rows[:, 1] >= least)], axis=0))
    rows = np.unique(np.concatenate(parts), axis=0)
    # the same stretch with a multiple of its period comes after it
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])
    rows = rows[first]
    rows = rows[np.lexsort([rows[:, 2], rows[:, 0]])]
    return Runs(rows[:, 0], rows[:, 1], rows[:, 2])


def _gathered(pairs: Iterator[tuple[np.ndarray, np.ndarray]], most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs in parts of about ``most``, so that a text of one word does not fill the memory."""
    places, periods, held = [], [], 0
    for at, period in pairs:
        places.append(at)
        periods.append(period)
        held += len(at)
        if held >= most:
            yield np.concatenate(places), np.concatenate(periods)
            places, periods, held = [], [], 0
    if held:
        yield np.concatenate(places), np.concatenate(periods)


class Document(NamedTuple):
    words: list[bytes]
    runs: list[tuple[int, int, int]]  # start, length, period

    def collapsed(self) -> bytes:
        """The words without those that a run repeats: of each run its first period stays, unless another run drops it."""
        if not self.runs:
            return b" ".join(self.words)
        keep = np.ones(len(self.words), bool)
        for start, length, period in self.runs:
            keep[start + period : start + length] = False
        return b" ".join([w for w, k in zip(self.words, keep, strict=True) if k])


Changed = Callable[[int | None, int], np.ndarray | None]


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """The original word that stands at each place, where the id says that the text's end is made to repeat; else None.

    With h the crc32 of the id's digits and g = h // 10: if h ends in 0, every word from a = g mod n on becomes one
    of the p = 1 + (n - a) // (3 + g mod 8) words from a on, in turn.  Documents without an id stay.
    """
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % p)


def documents(part: text.Texts, ids: list, changed: Changed | None, least: int = LEAST) -> list[Document]:
    """The runs of each document of a slice."""
    w = text.words(part.data, part.offsets)
    size = w.ends - w.starts
    bounds = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    letters = part.data[np.repeat(w.starts - bounds[:-1], size) + np.arange(bounds[-1])]
    column = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(letters.tobytes())]).dictionary_encode()
    names = column.dictionary.to_pylist()
    codes = column.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    own = []
    for i, (a, b) in enumerate(zip(w.bounds[:-1], w.bounds[1:], strict=True)):
        at = changed(ids[i], int(b - a)) if changed else None
        own.append(codes[a:b] if at is None else codes[a:b][at])
    sizes = np.array([len(c) for c in own], np.int64)
    order = np.argsort(-sizes, kind="stable")
    n, words = len(own), len(names)
    joined = [v for k, i in enumerate(order) for v in ([words + k], own[i])]
    array = np.concatenate([*joined, [words + n]])
    docs = np.concatenate([np.repeat(np.arange(n), sizes[order] + 1), [n]])
    ends = np.cumsum(sizes[order] + 1)
    runs = found(array, docs, ends, sizes[order], least)
    first = ends - sizes[order]
    of = docs[runs.starts]
    cut = np.searchsorted(of, np.arange(n + 1))
    out: list[Document] = [None] * n
    for k, i in enumerate(order):
        a, b = cut[k], cut[k + 1]
        rows = zip((runs.starts[a:b] - first[k]).tolist(), runs.lengths[a:b].tolist(), runs.periods[a:b].tolist(), strict=True)
        out[i] = Document([names[c] for c in own[i].tolist()], list(rows))
    return out


COLLAPSED = "doc_id long, runs array<struct<start: long, length: long, period: long>>, text string"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
DIGESTS = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def _over(docs: DataFrame, changed: Changed | None, least: int, rows: Callable[[list, list[Document]], pa.RecordBatch], schema: str) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text.slices(batch.column(1), SLICE_BYTES):
                ids = batch.column(0).slice(part.first, part.last - part.first).to_pylist()
                yield rows(ids, documents(part, ids, changed, least))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def collapsed(docs: DataFrame, changed: Changed | None = None, least: int = LEAST) -> DataFrame:
    """doc_id, runs and text of every document: its runs (start, length, period), and the text without repeated periods.

    A run is a stretch of words with smallest period q and at least ``least`` and 2 * q words that no neighbouring
    word extends; words are numbered from 0 and compared byte by byte.  The words left are joined by one space.
    ``changed`` may put other words of a document into its places first.

    Null and empty texts have no runs and an empty text left.  Null ids stay null; repeated rows each give a row; an
    empty table gives none; other columns are ignored.  Nothing is shuffled; a worker holds about a MB of texts,
    or one document, at a time.
    """

    def rows(ids: list, own: list[Document]) -> pa.RecordBatch:
        runs = pa.array([[{"start": s, "length": n, "period": p} for s, n, p in d.runs] for d in own], _RUNS)
        texts = pa.array([d.collapsed().decode("utf-8", "replace") for d in own], pa.string())
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), runs, texts], ["doc_id", "runs", "text"])

    return _over(docs, changed, least, rows, COLLAPSED)


def digests(docs: DataFrame, changed: Changed | None = None, least: int = LEAST) -> DataFrame:
    """For each document of ``collapsed`` the number of runs, the longest one (ties: smallest start, then period; nulls
    without a run), its length by its period in thousandths, and hashes of the runs and of the text left."""

    def row(d: Document) -> tuple:
        start, length, period = max(d.runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in d.runs)
        exponent = None if length is None else 1000 * length // period
        return len(d.runs), start, length, period, exponent, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(d.collapsed()).hexdigest()

    def rows(ids: list, own: list[Document]) -> pa.RecordBatch:
        columns = list(zip(*(row(d) for d in own), strict=True))
        types = [pa.int64()] * 5 + [pa.string()] * 2
        arrays = [pa.array(ids, pa.int64()), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])

    return _over(docs, changed, least, rows, DIGESTS)
