"""Phrases that occur more often together than their parts suggest, mined level by level from occurrence relations.

The relation of a level holds, for each place of a text, the frequent phrase of so many words that begins there.  It is
kept in blocks of whole documents in the order of piece and position, with a break wherever two neighbours do not belong
to one piece or one of them is not frequent.  A phrase of one more word is two neighbours of the relation (each fixes
the phrase without its last or first word), so a level is its predecessor merged with itself at the next position.

Each block deals its distinct phrases and their counts into parts by hash, sorted and packed.  A part sums the counts of
all blocks, numbers the frequent phrases, and tells each block which of its own those are: the semi-join that the
block's places go through before the next level.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldkpi.llm import frames, text

#: Bytes of text in a block; a block may hold one longer document.
BLOCK_BYTES = 1 << 23
BREAKS = b".,;:!?"
UNKNOWN = "und"
LONGEST = 5
LEAST = 100
TOP = 2000

_BREAK = np.zeros(256, bool)
_BREAK[list(BREAKS) + [10, 11, 12, 13]] = True
_FLAT = np.arange(256, dtype=np.uint8)
_FLAT[list(BREAKS)] = 10
_FLAT[65:91] += 32

#: Bytes of text, and places of a level, for each part that phrases are dealt into.
PART_BYTES, PART_PLACES = 1 << 25, 1 << 21

#: A block: its places (part -1), and for each part its phrases and their counts.  Words are joined by line breaks,
#: ``before`` and ``after`` are packed numbers.  The block's codes of a row's phrases begin at ``first`` and go on by
#: ``step``, the most frequent one first: codes of frequent phrases are low, and places take less room.
LEVEL = "block long, part long, lang string, first long, step long, size long, words binary, before binary, after binary, counts binary, places binary"
#: What a part gives back: for a block which phrases of a row are frequent, and their numbers; and, without a block, the phrases.
GIVEN = "block long, first long, step long, size long, codes binary, ids binary, lang string, words array<string>, befores array<long>, afters array<long>, n array<long>, id array<long>, total long"


def _placed(codes: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """Codes with -1 before each entry of ``breaks``; runs of -1 become one, since nothing joins across them."""
    out = np.insert(codes, np.flatnonzero(breaks), -1)
    same = np.zeros(len(out), bool)
    same[1:] = (out[1:] < 0) & (out[:-1] < 0)
    return out[~same]


def packed(values: np.ndarray) -> bytes:
    """Whole numbers as compressed planes of bytes: high bytes that are all alike take no room."""
    planes = np.ascontiguousarray(values, np.int64).view(np.uint8).reshape(-1, 8).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, size: int) -> np.ndarray:
    planes = pa.decompress(data, decompressed_size=8 * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, size).T).view(np.int64).ravel()


class Words(NamedTuple):
    """The distinct words of a slice: language, word, hash and count of each, and the places of all words."""

    langs: list[str]
    kinds: np.ndarray
    words: pa.Array
    hashes: np.ndarray
    counts: np.ndarray
    codes: np.ndarray
    breaks: np.ndarray


def block_words(part: text.Texts, langs: np.ndarray) -> Words:
    """``langs``: the language of each document."""
    data = _FLAT[part.data]
    w = text.words(data, part.offsets)
    docs = np.repeat(np.arange(len(part.offsets) - 1), np.diff(w.bounds))
    piece = np.searchsorted(np.flatnonzero(_BREAK[part.data]), w.starts)
    breaks = np.ones(len(docs), bool)
    breaks[1:] = (piece[1:] != piece[:-1]) | (docs[1:] != docs[:-1])
    bounds = np.concatenate([[0], np.cumsum(w.ends - w.starts)]).astype(np.int32)
    letters = data[(data != 32) & ((data < 9) | (data > 13))]
    column = pa.Array.from_buffers(pa.binary(), len(docs), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(letters.tobytes())]).dictionary_encode()
    names, kinds = np.unique(langs, return_inverse=True)
    distinct = max(1, len(column.dictionary))
    key = kinds[docs] * distinct + column.indices.to_numpy(zero_copy_only=False)
    counts = np.bincount(key, minlength=len(names) * distinct)
    some = np.flatnonzero(counts)
    code = np.full(len(counts), -1)
    code[some] = np.arange(len(some))
    words = column.dictionary
    ends = np.frombuffer(words.buffers()[1], np.int32)[: len(words) + 1]
    body = np.frombuffer(words.buffers()[2], np.uint8) if len(words) else np.zeros(0, np.uint8)
    hashes = text.span_hashes(text.prefix_sums(body), ends[:-1], ends[1:])
    at = some % distinct
    return Words(names.tolist(), some // distinct, words.take(pa.array(at)), hashes[at], counts[some], code[key], breaks)


def merged(places: np.ndarray, codes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The next level of a block: number before, number after and count of each distinct pair of neighbours, and its code
    at each place (-1: none).

    ``codes`` and ``ids``: the block's own codes of frequent phrases and the numbers that these have everywhere.
    """
    at = np.full(int(max(places.max(initial=-1), codes.max(initial=-1))) + 2, -1)  # the last entry is that of -1
    at[codes] = np.arange(len(codes))
    own = at[places]
    before, after = own[:-1], own[1:]
    both = (before >= 0) & (after >= 0)
    key, code, counts = np.unique(before[both] * len(ids) + after[both], return_inverse=True, return_counts=True)
    out = np.full(len(both), -1)
    out[both] = code
    return ids[key // max(1, len(ids))], ids[key % max(1, len(ids))], counts, out


def _dealt(block: int, groups: np.ndarray, n_groups: int, order: np.ndarray, codes: np.ndarray, breaks: np.ndarray | None, entry) -> pa.RecordBatch:
    """LEVEL rows of a block: its places, and ``entry`` of each run of equal ``groups`` among its phrases in this order."""
    cuts = np.flatnonzero(np.diff(groups[order], prepend=-1))
    sizes = np.diff(cuts, append=len(order))
    new = np.empty(len(order), np.int64)
    new[order] = groups[order] + (np.arange(len(order)) - np.repeat(cuts, sizes)) * n_groups
    places = np.where(codes < 0, -1, new[codes]) if len(order) else codes
    places = _placed(places, np.zeros(len(places), bool) if breaks is None else breaks)
    rows = [{"block": block, "part": -1, "size": len(places), "places": packed(places)}]
    for a, n in zip(cuts.tolist(), sizes.tolist(), strict=True):
        own = order[a : a + n]
        rows.append({"block": block, "first": int(groups[own[0]]), "step": n_groups, "size": n} | entry(own))
    return pa.RecordBatch.from_pylist(rows, _SCHEMA)


_SCHEMA = pa.schema(
    [("block", pa.int64()), ("part", pa.int64()), ("lang", pa.string())]
    + [(c, pa.int64()) for c in ("first", "step", "size")]
    + [(c, pa.binary()) for c in ("words", "before", "after", "counts", "places")]
)


def _words(docs: DataFrame) -> DataFrame:
    """The first level."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    parts = 1 + (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PART_BYTES

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in text.slices(batch.column(1), BLOCK_BYTES):
                w = block_words(part, np.array(batch.column(0).slice(part.first, part.last - part.first).to_pylist(), object))
                to = (w.hashes % np.uint64(parts)).astype(np.int64)
                langs = max(1, len(w.langs))
                groups = to * langs + w.kinds

                def entry(at: np.ndarray, w=w, to=to) -> dict:
                    words = b"\n".join(w.words.take(pa.array(at)).to_pylist())
                    words = pa.compress(words, codec="zstd", asbytes=True) + len(words).to_bytes(4, "little")
                    return {"part": int(to[at[0]]), "lang": w.langs[w.kinds[at[0]]], "words": words, "counts": packed(w.counts[at])}

                yield _dealt(number, groups, langs * parts, np.lexsort([w.hashes, -w.counts, groups]), w.codes, w.breaks, entry)
                number += 1

    return frames.written(rows.mapInArrow(run, LEVEL), "words")


def _extended(level: DataFrame, given: DataFrame) -> DataFrame:
    """The next level, of the blocks that still hold frequent phrases."""
    places = level.where("part < 0").select("block", "places", "size")
    parts = 1 + (places.agg(F.sum("size")).first()[0] or 0) // PART_PLACES
    held = given.where("block IS NOT NULL").groupBy("block").agg(F.collect_list(F.struct("first", "step", "size", "codes", "ids")).alias("held"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own, size = batch.column(3)[i].as_py(), batch.column(2)[i].as_py()
                codes = np.concatenate([h["first"] + h["step"] * np.cumsum(unpacked(h["codes"], h["size"])) for h in own])
                ids = np.concatenate([np.cumsum(unpacked(h["ids"], h["size"])) for h in own])
                before, after, counts, at = merged(unpacked(batch.column(1)[i].as_py(), size), codes, ids)
                if not len(counts):
                    continue
                with np.errstate(over="ignore"):
                    to = (text.mix(text.mix(before) + after.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)

                def entry(own: np.ndarray, to=to, before=before, after=after, counts=counts) -> dict:
                    steps = np.diff(before[own], prepend=0)  # ascending among those of a count
                    return {"part": int(to[own[0]]), "before": packed(steps), "after": packed(after[own]), "counts": packed(counts[own])}

                yield _dealt(batch.column(0)[i].as_py(), to, parts, np.lexsort([after, before, -counts, to]), at, None, entry)

    return frames.written(places.join(held, "block").mapInArrow(run, LEVEL), "pairs")


def _summed(level: DataFrame, least: int) -> DataFrame:
    """GIVEN of all parts.  A part holds about PART_PLACES phrases, and of any phrase one entry a block."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        sizes = [r["size"] for r in rows]
        counts = np.concatenate([unpacked(r["counts"], r["size"]) for r in rows])
        langs = sorted({r["lang"] or "" for r in rows})
        if rows[0]["words"] is not None:
            words = [w for r in rows for w in pa.decompress(r["words"][:-4], int.from_bytes(r["words"][-4:], "little"), "zstd", asbytes=True).split(b"\n")]
            column = pa.array(words, pa.binary()).dictionary_encode()
            lang = np.repeat([langs.index(r["lang"]) for r in rows], sizes)
            pair = lang, column.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        else:
            pair = (
                np.concatenate([np.cumsum(unpacked(r["before"], r["size"])) for r in rows]),
                np.concatenate([unpacked(r["after"], r["size"]) for r in rows]),
            )
        order = np.lexsort(pair[::-1])
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(pair[0][order]) != 0) | (np.diff(pair[1][order]) != 0)
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(new) - 1
        first, second = (p[order[new]] for p in pair)
        total = np.bincount(group, counts).astype(np.int64)
        number = np.where(total >= least, np.cumsum(total >= least) - 1 + (key[0].as_py() << 32), -1)
        out = []
        for r, own in zip(rows, np.split(number[group], np.cumsum(sizes)[:-1]), strict=True):
            codes = np.flatnonzero(own >= 0)
            if len(codes):
                steps = [packed(np.diff(v, prepend=0)) for v in (codes, own[codes])]
                out.append({"block": r["block"], "first": r["first"], "step": r["step"], "size": len(codes), "codes": steps[0], "ids": steps[1]})
        if rows[0]["words"] is None:
            often = np.flatnonzero(number >= 0)
            out.append({"befores": first[often], "afters": second[often], "n": total[often], "id": number[often]})
        else:
            for k, name in enumerate(langs):
                often = np.flatnonzero((number >= 0) & (first == k))
                words = [w.decode("utf-8", "replace") for w in column.dictionary.take(pa.array(second[often])).to_pylist()]
                out.append({"lang": name, "words": words, "n": total[often], "id": number[often], "total": int(total[first == k].sum())})
        return pa.Table.from_pylist(out, _GIVEN)

    return frames.written(level.where("part >= 0").drop("places").groupBy("part").applyInArrow(run, GIVEN), "counted")


_GIVEN = pa.schema(
    [(c, pa.int64()) for c in ("block", "first", "step", "size")]
    + [("codes", pa.binary()), ("ids", pa.binary()), ("lang", pa.string()), ("words", pa.list_(pa.string()))]
    + [(c, pa.list_(pa.int64())) for c in ("befores", "afters", "n", "id")]
    + [("total", pa.int64())]
)


def mined(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, k, n) of all phrases of at most ``longest`` words that occur ``least`` times in their language, and
    (lang, total): how many words each language has."""
    level = _words(docs)
    given = _summed(level, least)
    totals = given.where("total IS NOT NULL").groupBy("lang").agg(F.sum("total").alias("total"))
    named = _phrases(given, "words").select("id", "lang", F.col("words").alias("phrase"), F.col("words").alias("last"), "n")
    out = named.select("lang", "phrase", F.lit(1).alias("k"), "n")
    for k in range(2, longest + 1):
        level = _extended(level, given)
        given = _summed(level, least)
        found = _phrases(given, "befores", "afters")
        if found.isEmpty():
            break
        front = named.select(F.col("id").alias("befores"), "lang", "phrase")
        back = named.select(F.col("id").alias("afters"), "last")
        own = found.drop("lang").join(front, "befores").join(back, "afters")
        named = frames.written(own.select("id", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", "n"), "named")
        out = out.unionByName(named.select("lang", "phrase", F.lit(k).alias("k"), "n"))
    return out, totals


def _phrases(given: DataFrame, *arrays: str) -> DataFrame:
    """A row for each frequent phrase that the parts give."""
    zipped = F.explode(F.arrays_zip("id", "n", *arrays)).alias("e")
    return given.where("block IS NULL").select("lang", zipped).select("lang", "e.*")


def _part(start: Column, size: Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), start, size), " ")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score and cut: each language's ``top`` phrases of 2 to ``longest`` words.

    Texts are lower-cased (A-Z) and split at ``.,;:!?`` and line breaks into pieces, those at spaces and tabs into words.
    Counted are all occurrences within pieces, overlapping ones too, per language (null: ``und``).  Candidates occur
    a >= ``least`` times.  Cut in two, with n words of the language, l occurrences of the first and r of the second part, a
    candidate scores floor(1000 a n / (l r)); the cut with the lowest score counts, the first of equals.  Products are
    decimals of 38 digits.  A candidate inside a longer one that occurs as often is left out: if there is one of any
    length, so there is one of one more word, since every phrase between the two occurs as often.  Ranked are score, a
    (both descending) and phrase (in byte order).

    Null and empty texts hold nothing; rows of an id each count; an empty table, or no phrase often enough, gives no
    rows; other columns are ignored.
    """
    grams, totals = mined(docs, longest, least)
    grams = frames.written(grams, "phrases")
    candidates = grams.where("k > 1")
    cuts = candidates.withColumnRenamed("n", "a").withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.withColumn("first", _part(F.lit(1), F.col("cut"))).withColumn("second", _part(F.col("cut") + 1, F.col("k") - F.col("cut")))
    for side, count in (("first", "l"), ("second", "r")):
        cuts = cuts.join(grams.select("lang", F.col("phrase").alias(side), F.col("n").alias(count)), ["lang", side])
    scored = cuts.join(totals, "lang").withColumn("score", F.expr("CAST(CAST(1000 AS decimal(38,0)) * a * total DIV (CAST(l AS decimal(38,0)) * r) AS long)"))
    best = scored.groupBy("lang", "phrase", "a", F.col("total").alias("n")).agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))

    longer = candidates.where("k > 2").select("lang", F.explode(F.array(_part(F.lit(1), F.col("k") - 1), _part(F.lit(2), F.col("k") - 1))).alias("phrase"), "n")
    longer = longer.groupBy("lang", "phrase").agg(F.max("n").alias("most"))
    kept = best.join(longer, ["lang", "phrase"], "left").where("most IS NULL OR most < a")
    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long"), "phrase", "a", "best.l", "best.r", "n", "best.score", F.col("best.cut"))
