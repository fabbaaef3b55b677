"""Texts of an Arrow column as byte arrays: words, hashes and counts without a loop over words.

A word is a maximal run of bytes other than space and \\t to \\r, so it never crosses a document.
All hashes are fixed functions of the bytes; they agree between executors and reruns.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (splitmix64's finisher)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def stream(seed: int, n: int) -> np.ndarray:
    """n scrambled 64-bit numbers that depend on the seed alone."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=_U) + _U(seed) * _U(1_000_003)) * _U(0x9E3779B97F4A7C15))


_BASE = int(0x9E3779B97F4A7C15)
_BASE_BACK = pow(_BASE, -1, 1 << 64)
_BYTES = stream(7, 256)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0..n-1 modulo 2 ** 64; kept for the slices that follow."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, _U(base), _U)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 4 * SLICE_BYTES:
            _powers[base] = have
    return have[:n]


class Texts(NamedTuple):
    """Consecutive documents: their bytes joined, and where each begins (one more entry for the end)."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray


def slices(column: pa.Array, most_bytes: int = SLICE_BYTES) -> Iterator[Texts]:
    """Parts of a string column of at most so many bytes, or of one document; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if n == 0:
        return
    _, ends, body = column.buffers()
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most_bytes, "right")) - 1
        last = min(n, max(first + 1, last))
        yield Texts(first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; other letters stay."""
    return _LOWER[data]


def code_points(data: np.ndarray) -> np.ndarray:
    """True at the first byte of each code point."""
    return (data & 0xC0) != 0x80


class Words(NamedTuple):
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray  # document i has words bounds[i] to bounds[i + 1]


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = ~_SPACE[data]
    n = len(inside)
    begins, stops = inside.copy(), inside.copy()
    if n:
        begins[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        cut = offsets[1:-1]
        cut = cut[(cut > 0) & (cut < n)]
        begins[cut] = inside[cut]
        stops[cut - 1] = inside[cut - 1]
    starts = np.flatnonzero(begins)
    return Words(starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets))


def word_counts(column: pa.Array) -> np.ndarray:
    out = np.zeros(len(column), np.int64)
    for part in slices(column):
        out[part.first : part.last] = np.diff(words(part.data, part.offsets).bounds)
    return out


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which span_hashes takes the hash of any run of bytes."""
    out = np.empty(len(data) + 1, _U)
    out[0] = 0
    np.cumsum(_BYTES[data] * powers(_BASE, len(data)), out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, scrambled with its length."""
    back = powers(_BASE_BACK, len(sums))
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93))


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hash of every run of ``width`` entries, document borders not regarded."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, _U)
    out = np.zeros(n, _U)
    for j in range(width):
        out = out * _U(0x9FB21C651E98DF25) + hashes[j : j + n]
    return mix(out)


class Shingled(NamedTuple):
    hashes: np.ndarray
    docs: np.ndarray  # of each hash, ascending
    words: np.ndarray  # words of each document


def document_shingles(part: Texts, width: int) -> Shingled:
    """Each document's distinct lower-cased word shingles, in ascending order within the document.

    A document with fewer words than the width has its whole sequence as its one shingle; one
    without words has none.
    """
    data = lowered(part.data)
    w = words(data, part.offsets)
    counts = np.diff(w.bounds)
    own = span_hashes(prefix_sums(data), w.starts, w.ends)
    all_of = shingles(own, width)
    docs = np.repeat(np.arange(len(counts)), np.maximum(counts - width + 1, 0))
    at = np.arange(len(docs)) - np.repeat(exclusive(np.maximum(counts - width + 1, 0)), np.maximum(counts - width + 1, 0))
    hashes = all_of[w.bounds[:-1][docs] + at] if len(docs) else np.zeros(0, _U)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        whole = np.array([_whole(own[w.bounds[i] : w.bounds[i + 1]]) for i in short], _U)
        hashes, docs = np.concatenate([hashes, whole]), np.concatenate([docs, short])
    order = by_group(hashes, docs, len(counts))
    hashes, docs = hashes[order], docs[order]
    if len(hashes):
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])
        hashes, docs = hashes[new], docs[new]
    return Shingled(hashes, docs, counts)


def by_group(keys: np.ndarray, groups: np.ndarray, n_groups: int) -> np.ndarray:
    """The order by group, then key."""
    order = np.argsort(keys)
    small = groups.astype(np.uint16) if n_groups < 1 << 16 else groups
    return order[np.argsort(small[order], kind="stable")]


def _whole(hashes: np.ndarray) -> np.uint64:
    return shingles(hashes, len(hashes))[0] ^ _U(len(hashes))


def exclusive(counts: np.ndarray) -> np.ndarray:
    """Running sums before each entry."""
    out = np.zeros(len(counts), np.int64)
    np.cumsum(counts[:-1], out=out[1:])
    return out
