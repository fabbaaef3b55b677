"""The window network: its gradient, the whole of its probabilities, scores against a plain loop, and what it learns."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from fieldkpi.llm import frames, pseudo


@pytest.fixture(scope="module")
def known():
    return pseudo.vocabulary(np.random.default_rng(1).integers(0, 50, pseudo.FORMS).astype(float))


def test_probabilities_of_all_forms_add_up_to_one(known):
    net = pseudo.start(known)
    near = np.random.default_rng(2).integers(0, pseudo.CLASSES + 1, (len(pseudo.OFFSETS), 5))
    p = np.exp(pseudo.log_classes(net, pseudo.hidden(net, near)))
    every = p[:, known.classes] * np.exp(known.within)
    assert np.allclose(every.sum(1), 1, atol=1e-4)


def test_gradient_matches_differences(known):
    draw = np.random.default_rng(3)
    net = pseudo.start(known)
    near, middle = draw.integers(0, pseudo.CLASSES + 1, (len(pseudo.OFFSETS), 40)), draw.integers(0, pseudo.CLASSES, 40)

    def loss(values):
        n = pseudo.Network.shaped(values)
        return -pseudo.log_classes(n, pseudo.hidden(n, near))[np.arange(40), middle].astype(float).mean()

    flat, slope = net.flat().astype(float), pseudo.gradient(net, near, middle).flat()
    for _ in range(5):
        way = draw.normal(size=len(flat))
        step = 1e-3 * way
        assert (loss(flat + step) - loss(flat - step)) / 2e-3 == pytest.approx(float(slope @ way), rel=0.03, abs=2e-3)


def rows():
    draw = random.Random(4)
    pattern = "the cat sat on a mat and the dog ran to a big house".split()
    out = [(i, " ".join((pattern[draw.randrange(13):] + pattern * 30)[:200])) for i in range(60)]
    shuffled = pattern * 15
    draw.shuffle(shuffled)
    out += [(100, " ".join(shuffled)), (101, None), (102, ""), (103, " \n\t"), (104, "cat"), (105, "x" * 70_000), (106, " ".join(pattern * 3000))]
    return [*out, (None, out[0][1]), out[0], out[0]]


def test_scores_match_a_plain_loop_and_order_counts(spark):
    frames.importable(spark)
    docs = spark.createDataFrame([(*r, 1, "y") for r in rows()], "doc_id long, text string, n_tokens int, tokens string")
    read = frames.written(pseudo.tokens(docs), "test-tokens")
    known = pseudo.vocabulary(pseudo.counts(read))
    net = pseudo.fitted(read, known, rounds=2, stride=1)
    got = pseudo.scores(read, net, known).collect()
    assert len(got) == len(rows())
    forms = {r.doc_id: np.frombuffer(r.tokens, np.uint16) for r in read.collect()}
    for r in got:
        own = forms[r.doc_id]
        assert r.n_tokens == len(own)
        if r.doc_id == 106:
            continue
        total = 0.0
        for i in range(len(own)):
            near = [[known.classes[own[i + o]] if 0 <= i + o < len(own) else pseudo.CLASSES] for o in pseudo.OFFSETS]
            p = pseudo.log_classes(net, pseudo.hidden(net, np.array(near)))[0]
            total += float(p[known.classes[own[i]]]) + known.within[own[i]]
        assert math.isclose(r.log_likelihood, total, rel_tol=1e-4, abs_tol=1e-3)
        assert (r.mean_log_likelihood is None) == (len(own) == 0)
    mean = {r.doc_id: r.mean_log_likelihood for r in got}
    assert min(mean[i] for i in range(60)) > mean[100] + 0.5


def test_empty_table(spark):
    frames.importable(spark)
    assert pseudo.scored(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_words_beyond_the_frequent_ones_follow_the_words_beside_them(spark):
    """Two words of one frequency, none of them among the most frequent, each beside a word of its own."""
    frames.importable(spark)
    draw, first, twin = random.Random(8), {}, None
    for name in (f"w{i}" for i in range(500)):  # forms 16 apart, also where classes are dealt by hash
        form = int(np.frombuffer(pseudo.tokens(spark.createDataFrame([(0, name)], "doc_id long, text string")).first().tokens, np.uint16)[0])
        if twin := first.get(form % 16):
            twin = (twin, name)
            break
        first[form % 16] = name
    fill = [f"f{i}" for i in range(60)]
    texts = []
    for _ in range(1200):
        body = [draw.choice(fill) for _ in range(300)]
        for word, beside in zip(twin, ("left", "right"), strict=True):
            at = draw.randrange(0, 290)
            body[at : at + 3] = [beside, word, beside]
        texts.append(" ".join(body))
    tests = [f"{beside} {word} {beside}" for beside in ("left", "right") for word in twin]
    rows = [*enumerate(texts), *((9000 + i, t) for i, t in enumerate(tests))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    a, b, c, d = [r.log_likelihood for r in pseudo.scored(docs).where("doc_id >= 9000").orderBy("doc_id").collect()]
    assert (a - b) + (d - c) > 1
