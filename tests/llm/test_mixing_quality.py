"""Mixing against exact sums on small tables; quality scores on held-out labels."""

from __future__ import annotations

import random
import re
import zlib
from itertools import product

import numpy as np
import pytest

from fieldkpi.llm import classifier, frames, mixing


def test_subset_is_the_best_sum():
    draw = random.Random(1)
    for _ in range(60):
        lengths = np.array(sorted(draw.sample(range(1, 30), 4)))
        counts = np.array([draw.randrange(1, 5) for _ in lengths])
        budget = draw.randrange(0, 200)
        sums = {int(np.dot(c, lengths)) for c in product(*[range(n + 1) for n in counts])}
        take = mixing.subset(lengths, counts, budget)
        assert (take >= 0).all() and (take <= counts).all()
        assert int(take @ lengths) == max(s for s in sums if s <= budget)


def test_subset_beyond_its_table_comes_near():
    lengths, counts = np.arange(1, 200), np.full(199, 50)
    take = mixing.subset(lengths, counts, 400_000, most_table=1000)
    assert (take <= counts).all() and int(take @ lengths) == 400_000


def test_mix_takes_its_targets(spark):
    frames.importable(spark)
    draw = random.Random(2)
    rows = [(i, " ".join(["w"] * draw.randrange(1, 40)), draw.choice(["a", "b", "B", "é", None])) for i in range(400)]
    rows += [(500, None, "a"), (501, "", "b"), (502, " \n", None), (503, "", "only empty"), (None, "x y", "a"), rows[3], rows[3]]
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, source string, size int, part string")
    got = mixing.mix(docs).collect()
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs).collect())) and len(got) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    own = {}
    for _, t, s in rows:
        own[s] = own.get(s, 0) + size(t)
    order = sorted((s for s in own if s is not None)) + [None]
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    target, open_, total = {}, set(own), sum(own.values())
    while True:
        rest = total - sum(target.values())
        unit = rest / sum(weight[s] for s in open_) if open_ else 0
        full = {s for s in open_ if unit * weight[s] >= 3 * own[s]}
        if not full:
            target |= {s: unit * weight[s] for s in open_}
            break
        target |= {s: 3 * own[s] for s in full}
        open_ -= full
    taken = {}
    for r in got:
        assert r.source_size == own[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in own:
        assert target[s] - 1 <= taken[s] <= target[s] + 1e-6
    assert mixing.mix(docs.where("false")).collect() == []


def test_quality_on_held_out_labels(spark):
    frames.importable(spark)
    draw = random.Random(5)
    rows = []
    for i in range(400):
        good = " ".join("".join(draw.choices("aeioulnrst", k=draw.randrange(2, 9))) for _ in range(draw.randrange(40, 90))) + "."
        rows.append((i, good if i % 2 else "BUY NOW!!! $$$ #1 " * draw.randrange(5, 20)))
    rows += [(900, None), (901, ""), (902, "x" * 60_000), (None, rows[1][1]), rows[1]]
    docs = spark.createDataFrame([(*r, 0.5, "q") for r in rows], "doc_id long, text string, score double, quality string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(None, 1), (7, None), (8, 0)], "doc_id long, quality int")
    got = classifier.quality(docs, labels).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r.held_out and r.doc_id < 400]
    assert len(held) > 40 and np.mean([r.predicted == r.doc_id % 2 for r in held]) > 0.95
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    assert {r.score for r in classifier.quality(docs, labels.where("false")).collect()} == {0.5}
    assert classifier.quality(docs.where("false"), labels).collect() == []
    kept = classifier.accepted(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {i for i in range(400) if i % 2}
