"""Phrases against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldkpi.llm import collocations, frames


@pytest.fixture(autouse=True)
def _importable(spark):
    frames.importable(spark)


def plain(rows, longest, least, top):
    count, total = Counter(), Counter()
    for lang, value in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), value or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                count.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    some = {g: a for g, a in count.items() if len(g[1]) > 1 and a >= least}
    out = []
    for (lang, phrase), a in some.items():
        score, cut = min((1000 * a * total[lang] // (count[lang, phrase[:k]] * count[lang, phrase[k:]]), k) for k in range(1, len(phrase)))
        inside = any(m[0] == lang and len(m[1]) > len(phrase) and b >= a and any(m[1][i : i + len(phrase)] == phrase for i in range(len(m[1]))) for m, b in some.items())
        if not inside:
            out.append((lang, " ".join(phrase), a, count[lang, phrase[:cut]], count[lang, phrase[cut:]], total[lang], score))
    ranked = []
    for lang in total:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(lang, i + 1, *r[1:]) for i, r in enumerate(own[:top])]
    return sorted(ranked)


def drawn(seed: int, n: int):
    draw = random.Random(seed)
    common = ["the Same old story, again", "a b a b a b", "New\tYork  City", "é ß x!y?z:w;v", "one two three four five six seven"]
    rows = []
    for _ in range(n):
        parts = [draw.choice(common) if draw.random() < 0.4 else f"w{draw.randrange(30)}" for _ in range(draw.randrange(40))]
        rows.append((draw.choice(["en", "de", None, "und"]), draw.choice([" ", " ", "\n", ". "]).join(parts)))
    return rows + [("en", None), ("en", ""), (None, " \t .,\r\n "), ("fr", "only " * 3), ("en", "same " * 3000)]


@pytest.mark.parametrize(("longest", "least", "top"), [(5, 3, 50), (3, 10, 2000), (5, 10**6, 10)])
def test_phrases_match_plain_counting(spark, longest, least, top):
    rows = drawn(longest, 150)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    docs = docs.select("*", F.lit(1).alias("block"), F.lit(1).alias("n"), F.lit(1).alias("word"))
    got = collocations.collocations(docs, longest, least, top).drop("cut")
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, longest, least, top)


def test_blocks_do_not_change_the_counts(spark, monkeypatch):
    rows = drawn(9, 60)
    docs = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    whole = collocations.collocations(docs, 4, 4).collect()
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 200)
    assert sorted(collocations.collocations(docs, 4, 4).collect()) == sorted(whole)


def test_products_beyond_64_bits(spark):
    big = spark.sql("SELECT 9000000000000L AS a, 4000000000000000L AS total, 9000000000001L AS l, 9000000000002L AS r")
    score = big.select(F.expr("CAST(CAST(1000 AS decimal(38,0)) * a * total DIV (CAST(l AS decimal(38,0)) * r) AS long)")).first()[0]
    assert score == 1000 * 9000000000000 * 4000000000000000 // (9000000000001 * 9000000000002)


def test_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0
