"""Suffix arrays and repeated strings against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from fieldkpi.llm import frames, suffixes


def test_suffix_array_and_common_prefixes():
    draw = random.Random(2)
    for _ in range(150):
        t = [draw.randrange(1, draw.choice([2, 3, 5])) for _ in range(draw.randrange(1, 60))] + [0]
        order = suffixes.suffix_array(np.array(t, np.int16))
        assert order.tolist() == sorted(range(len(t)), key=lambda i: t[i:])
        prefix = suffixes.common_prefixes(np.array(t, np.int16), order)
        for a, b in zip(order, order[1:], strict=False):
            same = next(i for i in range(len(t)) if t[a + i] != t[b + i])
            assert prefix[b] == same


def expected(rows, length):
    data = [(t or "").encode() for _, t in rows]
    often = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    for (doc_id, _), d in zip(rows, data, strict=True):
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - length + 1):
            if often[d[i : i + length]] > 1:
                gone[i : i + length] = True
        gone[-1] = False
        kept = bytes(x for x, g in zip(d, gone, strict=False) if not g)
        yield (doc_id, len(d), int(gone.sum()), int((gone[:-1] < gone[1:]).sum() + (len(d) and gone[0])), hashlib.sha256(kept).hexdigest())


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(9)
    new = lambda n: "".join(draw.choice("abcdeß ") for _ in range(n))
    shared = [new(n) for n in (20, 39, 40, 41, 70, 300)]
    out = [(i, new(draw.randrange(0, 80)) + draw.choice(shared) + new(draw.randrange(0, 60)) + draw.choice([*shared, ""])) for i in range(90)]
    base = new(500)
    for i in range(100, 120):
        copy = list(base)
        for _ in range(draw.randrange(0, 6)):
            copy[draw.randrange(len(copy))] = "x"
        out.append((i, "".join(copy)))
    out += [(200, None), (201, ""), (202, "z" * 39), (203, "y" * 40), (204, "q" * 300), (205, "ab" * 200), (206, new(9000))]
    return [*out, (None, shared[5]), (None, None), out[3], out[3], (300, out[3][1])]


@pytest.mark.parametrize("sizes", [{}, {"shard_bytes": 200, "most_contexts": 3}])
def test_repeated_strings_match_brute_force(spark, rows, sizes):
    frames.importable(spark)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, key string, copy int")
    got = [tuple(r) for r in suffixes.digests(docs, 40, **sizes).collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(got, key=order) == sorted(expected(rows, 40), key=order)


def test_empty_table(spark):
    frames.importable(spark)
    assert suffixes.digests(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_contexts_without_a_string_of_another_are_not_sorted():
    draw, length = np.random.default_rng(6), 40
    rim = length - suffixes._gram(length)
    keys, pieces, wanted = [], [], []
    for key in range(200):  # two contexts of an anchor that agree in so many bytes to its left and right
        left, right = int(draw.integers(0, rim + 1)), int(draw.integers(0, rim + 1))
        a = draw.integers(1, 120, rim + length).astype(np.uint8)
        b = a.copy()
        b[: rim - left] += 100
        b[length + right :] += 100
        keys += [key, key]
        pieces += [a.tobytes(), b.tobytes()]
        wanted += [left + right >= rim] * 2
    keys, wanted = np.array(keys), np.array(wanted)
    got = suffixes._shared(keys, np.ones(len(keys), np.int64), pieces, length)
    assert got[wanted].all() and not got[~wanted].all()
    first = suffixes._shared(keys, (np.arange(len(keys)) != 6).astype(np.int64), pieces, length)
    assert first[6:8].all()
