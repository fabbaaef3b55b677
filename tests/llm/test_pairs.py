"""Near-duplicates, passages and decontamination against brute force on small tables."""

from __future__ import annotations

import random
import re

import pytest

from fieldkpi.llm import contamination, frames, graphs, neardup, passages

EXTRA = "id string, n string, bucket string, _id string, _spans string, _searched string, _kept string"
BLANK = ("x",) * 7


def words(value: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in value or ""))


def shingles(value: str | None, width: int) -> set:
    w = words(value)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


@pytest.fixture(scope="module")
def texts() -> list[tuple[int | None, str | None]]:
    draw = random.Random(4)
    vocabulary = [f"Wörd{i}" for i in range(3000)]
    new = lambda n: [draw.choice(vocabulary) for _ in range(n)]
    out: list[tuple[int | None, str | None]] = []
    base = new(120)
    for i in range(160):
        if i % 4 == 0:
            copy = list(base)
            for _ in range(draw.randrange(0, 9)):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            out.append((i, " ".join(copy)))
        else:
            out.append((i, " ".join(new(draw.randrange(1, 150)))))
    out += [(200, None), (201, ""), (202, " \n"), (203, "one two"), (204, "ONE\ttwo"), (205, "ß" * 90_000), (206, " ".join(new(30_000)))]
    return [*out, (None, out[1][1]), out[5], out[5], (300, out[5][1])]


def documents(spark, rows):
    frames.importable(spark)
    return spark.createDataFrame([(*r, *BLANK) for r in rows], f"doc_id long, text string, {EXTRA}")


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_match_brute_force(spark, texts, width, percent):
    sets = {i: shingles(t, width) for i, t in texts if i is not None}
    lowest = {i: i for i in sets}

    def find(i):
        while lowest[i] != i:
            i = lowest[i]
        return i

    for a in sets:
        for b in sets:
            same = len(sets[a] & sets[b])
            if a < b and sets[a] and sets[b] and 100 * same >= percent * (len(sets[a]) + len(sets[b]) - same):
                x, y = find(a), find(b)
                lowest[max(x, y)] = min(x, y)
    got = neardup.near_duplicates(documents(spark, texts), width, percent).collect()
    assert len(got) == len(texts)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), find(r.doc_id), find(r.doc_id) == r.doc_id)
    if width == 5:
        docs = documents(spark, texts)
        left = neardup.deduplicated(docs)
        assert left.columns == docs.columns
        kept = sorted(r.doc_id for r in left.collect() if r.doc_id is not None)
        assert kept == sorted(i for i in sets if find(i) == i)


def test_bayes_bounds_grow_with_the_batches():
    bounds = neardup.needed(85)
    assert (bounds[1:] >= bounds[:-1]).all() and 0 < bounds[-1] < 85


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r.id: r.component for r in graphs.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 160)}


def test_further_links_follow_only_what_they_join(spark, monkeypatch):
    """Further links inside components cost no turn; others give the components of all links."""
    turns, lowest = [], graphs._lowest
    monkeypatch.setattr(graphs, "_lowest", lambda *a: turns.append(1) or lowest(*a))
    frame = lambda links: spark.createDataFrame(links, "a long, b long")
    found = lambda df: {r.id: r.component for r in df.collect()}
    joined = graphs.components(frame([(i, i + 1) for i in range(10, 40)] + [(100, i) for i in range(101, 160)]))
    turns.clear()
    assert found(graphs.extended(joined, frame([(12, 30), (101, 159), (None, 5), (7, 7)]))) == found(joined)
    assert not turns
    more = graphs.extended(joined, frame([(25, 130), (3, 110), (200, 201), (None, 5)]))
    assert found(more) == dict.fromkeys([*range(10, 41), *range(100, 160)], 3) | {201: 200}
    assert found(graphs.components(frame([(5, 4)]))) == {5: 4}


def test_few_pairs_are_compared_in_blocks_at_once(spark, monkeypatch):
    """Further hubs are drawn only where blocks would compare many pairs; the components are the same."""
    draw = random.Random(12)
    new = lambda n: [f"w{draw.randrange(10**6)}" for _ in range(n)]
    base = new(100)
    texts = [" ".join([*base, *new(3)]) for _ in range(30)] + [" ".join([*base[:70], *new(30)]) for _ in range(60)]
    turns, apart = [], neardup._apart
    monkeypatch.setattr(neardup, "_apart", lambda *a: turns.append(1) or apart(*a))
    for most in (neardup.PAIRS, 0):
        monkeypatch.setattr(neardup, "PAIRS", most)
        got = {r.doc_id: r.component_id for r in neardup.near_duplicates(documents(spark, list(enumerate(texts))), 3, 85).collect()}
        assert got == {i: 0 if i < 30 else i for i in range(90)}
        assert bool(turns) == (most == 0)


def test_contamination_matches_brute_force(spark, texts):
    longest = words(texts[-5][1])
    items = [(1, " ".join(longest[500:540])), (2, " ".join(longest[90:110] + ["x"] + longest[111:130])), (3, None), (4, ""), (5, "one two"), (None, texts[1][1]), (7, texts[5][1]), (7, texts[5][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(spark, texts)
    wanted = []
    for i, t in texts:
        for k, item in items:
            own, of = shingles(t, 5), shingles(item, 5)
            if of and len(own & of) >= 0.8 * len(of):
                wanted.append((i, k, len(own & of)))
    order = lambda r: tuple((x is None, x or 0) for x in r)
    for most in (1 << 20, 16):
        got = [(r.doc_id, r.item_id, r.n_shared) for r in contamination.contaminated(docs, benchmark, most=most).collect()]
        assert sorted(got, key=order) == sorted(wanted, key=order)
    hit = {w[0] for w in wanted}
    assert sorted((r.doc_id for r in contamination.clean(docs, benchmark).collect()), key=lambda x: (x is None, x)) == sorted((i for i, _ in texts if i not in hit), key=lambda x: (x is None, x))


def test_passages_exact_and_fuzzy(spark):
    draw = random.Random(9)
    new = lambda n: [f"w{draw.randrange(5000)}" for _ in range(n)]
    passage, fuzzy = new(60), new(80)
    changed = list(fuzzy)
    for i in (12, 30, 47, 66):
        changed[i] = "zz"
    bodies = [new(200) for _ in range(12)]
    bodies[2][50:50] = passage
    bodies[7][10:10] = passage
    bodies[3][100:100] = fuzzy
    bodies[9][20:20] = changed
    rows = [(i, " ".join(b)) for i, b in enumerate(bodies)] + [(50, None), (51, ""), (None, " ".join(passage))]
    docs = documents(spark, rows)
    got = sorted((r.doc_id, r.start_word, r.end_word, r.other_id, r.other_start, r.other_end, r.similarity) for r in passages.passages(docs).collect())
    assert got == [(7, 10, 70, 2, 50, 110, 1.0), (9, 20, 100, 3, 100, 180, 0.95)]
    left = {r.doc_id: r.text for r in passages.without_repeats(docs).collect()}
    assert len(left) == len(rows) and left[50] is None
    assert words(left[7]) == bodies[7][:10] + bodies[7][70:] and words(left[2]) == bodies[2]


def test_edit_distance_matches_the_plain_table():
    draw = random.Random(2)
    for _ in range(200):
        a, b = ([draw.randrange(4) for _ in range(draw.randrange(80))] for _ in range(2))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(new[-1] + 1, row[j + 1] + 1, row[j] + (x != y)))
            row = new
        assert passages.distance(a, b) == row[-1]


def test_empty_tables(spark):
    none = documents(spark, [])
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert neardup.near_duplicates(none).count() == 0
    assert passages.passages(none).count() == 0
    assert contamination.contaminated(none, benchmark).count() == 0


def test_hubs_of_later_turns_are_held_against_blocks_not_pairs(spark, monkeypatch):
    """Texts that share a bucket with a large group without being linked to it: only the first turn makes a row of each pair."""
    draw = random.Random(12)
    new = lambda n: [f"w{draw.randrange(10**6)}" for _ in range(n)]
    base = new(100)
    texts = [" ".join([*base, *new(3)]) for _ in range(30)] + [" ".join([*base[:70], *new(30)]) for _ in range(60)]
    joined, whole = [], neardup._verified

    def counted(pairs, *rest):
        joined.append(pairs.count())
        return whole(pairs, *rest)

    monkeypatch.setattr(neardup, "_verified", counted)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(documents(spark, list(enumerate(texts))), 3, 85).collect()}
    assert sum(joined[1:]) < len(texts) < joined[0]
    assert got == {i: 0 if i < 30 else i for i in range(90)}
