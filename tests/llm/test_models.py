"""Languages, quality rules and the pipeline on small tables."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np

import corpus_pipeline
from fieldkpi.llm import frames, language, rules, stats

SYLLABLES = {"aa": "ba ke lo mi nu".split(), "bb": "sch tze rung ff ört".split()}


def table(spark, n=120):
    frames.importable(spark)
    draw = random.Random(3)
    rows = []
    for i in range(n):
        lang = ("aa", "bb")[i % 2]
        words = ["".join(draw.choices(SYLLABLES[lang], k=draw.randrange(1, 4))) for _ in range(60)]
        if i % 3 == 0:
            words = ["buy", "now", "#1", "$$$", "!!!"] * 4 + words[:40]
        rows.append((i, " ".join(words), lang, "s", "x"))
    rows += [(900, None, "aa", "s", "x"), (901, "", None, "s", "x"), (902, "123 !!", None, None, "x"), (None, "ba ke lo", None, "s", "x"), (1, rows[1][1], "bb", "s", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, id string"), rows


def test_languages(spark):
    docs, rows = table(spark)
    got = language.languages(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if r.doc_id in (900, 901, 902):
            assert r.lang_pred == "und" and r.score == 0 and r.rejected
        elif r.doc_id is not None:
            assert r.lang_pred == ("aa", "bb")[r.doc_id % 2]
    assert {r.lang_pred for r in language.languages(docs.withColumn("lang", docs.lang.substr(9, 1)).where("false")).collect()} == set()


def counted(text: str | None) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_rules_counts_and_verdicts(spark):
    docs, rows = table(spark)
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(120)] + [(None, 1), (5, None)], "doc_id long, quality int")
    got = rules.judged(docs, labels).collect()
    assert len(got) == len(rows)
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        counts = counted(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0])
        assert not (r.base_failed and r.kept)
        if r.doc_id is not None and r.doc_id < 120 and not r.base_failed:
            assert r.kept == (r.doc_id % 3 != 0)


def test_trees_are_monotonic():
    random_ = np.random.default_rng(1)
    x = random_.normal(size=(600, len(stats.FEATURES)))
    signs = np.array([rules.MONOTONIC.get(n, 0) for n in stats.FEATURES])
    y = (x[:, 0] + 0.5 * x[:, stats.FEATURES.index("repeats")] + random_.normal(size=600) > 0).astype(float)
    model = rules.fit(x, y, signs)
    for f in np.flatnonzero(signs):
        low, high = x.copy(), x.copy()
        high[:, f] += 1.5
        assert (signs[f] * (model.score(high) - model.score(low)) >= -1e-12).all()
    assert ((model.score(x) > 0.5) == (y > 0)).mean() > 0.8


def test_pipeline_stages_keep_the_columns(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = frames.documents(spark, sf_dir)
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = frames.written(stage(spark, docs, sf_dir), name)
        assert out.dtypes == docs.dtypes
        assert out.count() <= n
        docs, n = out, out.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert last.count() == n
