"""Runs of repeated words against a plain search."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fieldkpi.llm import frames, periodic, text


@pytest.fixture(autouse=True)
def _importable(spark):
    frames.importable(spark)


def plain(words: list, least: int = 12) -> list[tuple[int, int, int]]:
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, 2 * q):
                found.setdefault((start, i + q - start), q)
            i += 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def drawn(draw: random.Random) -> list[str]:
    n, kinds = draw.randrange(400), draw.choice([1, 2, 3, 60])
    words = [f"w{draw.randrange(kinds)}" for _ in range(n)]
    if draw.random() < 0.5 and n:
        a = draw.randrange(n)
        p = 1 + (n - a) // draw.randrange(2, 9)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words * 2 if draw.random() < 0.2 else words


def test_the_cover_meets_every_difference():
    met = {(a - b) % periodic.MODULUS for a in periodic.COVER for b in periodic.COVER}
    assert met == set(range(periodic.MODULUS))


def test_runs_match_the_plain_search():
    draw = random.Random(3)
    for _ in range(40):
        docs = [drawn(draw) for _ in range(draw.randrange(1, 20))]
        for part in text.slices(pa.array([" ".join(d) for d in docs])):
            got = periodic.documents(part, [None] * len(docs), None)
            assert [d.runs for d in got] == [plain(d) for d in docs]


def test_extensions_match_word_by_word():
    draw = np.random.default_rng(5)
    for kinds in (1, 2, 30):
        body = draw.integers(0, kinds, 500)
        codes, docs = np.concatenate([body, [kinds]]), np.zeros(501, np.int64)
        i = draw.integers(0, 499, 2000)
        j = i + 1 + draw.integers(0, 500 - i)
        equal = [next(k for k in range(502) if b + k > 500 or codes[a + k] != codes[b + k]) for a, b in zip(i, j, strict=True)]
        assert periodic.Extensions(codes, docs)(i, j).tolist() == equal


def wanted(doc_id, value) -> tuple:
    words = re.findall(rb"[^\x20\x09-\x0D]+", (value or "").encode())
    at = periodic.planted(doc_id, len(words))
    words = words if at is None else [words[k] for k in at]
    runs = plain(words)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
    left = b" ".join(w for k, w in enumerate(words) if k not in gone)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(listed).hexdigest(), hashlib.sha256(left).hexdigest())


def test_documents_of_every_kind(spark):
    draw = random.Random(8)
    rows = [(i, " é\t" + " ".join(drawn(draw))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \n "), (None, "a b " * 30), (None, None), (7, "x " * 50), (7, "x " * 50), (103, "a" * 5000), (104, "aé\r\nb\x0bc\x0c" * 900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit(1).alias("runs"), F.lit(2).alias("start"))
    got = [tuple(r) for r in periodic.digests(docs, periodic.planted).collect()]
    order = lambda r: tuple((v is None, v) for v in r)
    assert sorted(got, key=order) == sorted((wanted(*r) for r in rows), key=order)
    left = {r.doc_id: (r.text, [tuple(x) for x in r.runs]) for r in periodic.collapsed(docs).where("doc_id = 7").collect()}
    assert left == {7: ("x", [(0, 50, 1)])}
    assert periodic.digests(docs.limit(0)).count() == 0
