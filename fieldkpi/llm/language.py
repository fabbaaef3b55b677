"""Language of a text: the nearest of several centroids per language, by cosine of TF-IDF byte-trigram vectors."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkpi.llm import frames, text
from fieldkpi.llm.classifier import _sums

GRAM, DIMS = 3, 4096
CENTROIDS, TURNS = 3, 4
#: Documents per language that the centroids are fitted on at most (by lowest hash of the id); the weights take all.
MOST_PER_LANGUAGE = 5_000
#: Below this cosine the nearest centroid is too far: the prediction is marked as rejected.
FARTHEST = 0.15
FOLD, HELD_OUT = 4, 2
UNKNOWN = "und"
ROWS = 256

_FOLDED = np.arange(256, dtype=np.uint64)
_FOLDED[:128] = 32
_FOLDED[97:123] = np.arange(97, 123)
_FOLDED[65:91] = np.arange(97, 123)


def counts(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, matrix of hashed trigram counts) of at most ROWS documents at a time; ASCII non-letters are blanks."""
    for first in range(0, len(column), ROWS):
        for part in text.slices(column.slice(first, ROWS)):
            folded = _FOLDED[part.data]
            out = np.zeros((part.last - part.first, DIMS), np.float32)
            if len(folded) >= GRAM:
                whole = folded[:-2] << np.uint64(16) | folded[1:-1] << np.uint64(8) | folded[2:]
                place = (text.mix(whole) % np.uint64(DIMS)).astype(np.int64)
                place[whole == 0x202020] = -1
                for i in range(len(out)):
                    own = place[part.offsets[i] : max(part.offsets[i], part.offsets[i + 1] - GRAM + 1)]
                    out[i] = np.bincount(own[own >= 0], minlength=DIMS)
            yield first + part.first, out


def vectors(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.sqrt(tf) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)


class Model(NamedTuple):
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # CENTROIDS rows per language, of length one

    def nearest(self, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The row of the nearest centroid, and its cosine."""
        cosine = vectors(tf, self.idf) @ self.centroids.T
        at = cosine.argmax(1)
        return at, cosine[np.arange(len(at)), at]


def _unit(m: np.ndarray) -> np.ndarray:
    return (m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def fit(known: DataFrame, most: int = MOST_PER_LANGUAGE) -> Model | None:
    """``known``: id, text, lang, all to be learned from.  Weights and centroids are sums over partitions."""
    per = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not per:
        return None
    languages = sorted(per)

    def document_counts(b: pa.RecordBatch) -> np.ndarray:
        total = np.zeros((2, DIMS))
        for _, tf in counts(b.column("text")):
            total[0] += (tf > 0).sum(0)
            total[1] += len(tf)
        return total

    df = _sums(known.select("text"), document_counts, DIMS)
    idf = (np.log((1 + df[1]) / (1 + df[0])) + 1).astype(np.float32)
    drawn = F.shiftrightunsigned(F.xxhash64(F.lit(17), "id"), 11) / float(1 << 53)
    share = F.create_map(*[F.lit(x) for lang, n in per.items() for x in (lang, most / n)])
    sample = known.where(drawn < share[F.col("lang")])
    first = F.array_position(F.array(*[F.lit(x) for x in languages]), F.col("lang")).cast("int") - 1
    sample = frames.written(sample.select("text", first.alias("at"), F.pmod(F.xxhash64(F.lit(19), "id"), F.lit(CENTROIDS)).cast("int").alias("part")).repartition(16), "sample")
    size = len(languages) * CENTROIDS
    held: np.ndarray | None = None
    for _ in range(TURNS):

        def add(b: pa.RecordBatch, held=held) -> np.ndarray:
            total, at, part = np.zeros((size, DIMS)), b.column("at").to_numpy(), b.column("part").to_numpy()
            for begin, tf in counts(b.column("text")):
                v, rows = vectors(tf, idf), slice(begin, begin + len(tf))
                own = part[rows]
                if held is not None:
                    own = np.einsum("ncd,nd->nc", held.reshape(-1, CENTROIDS, DIMS)[at[rows]], v).argmax(1)
                np.add.at(total, at[rows] * CENTROIDS + own, v)
            return total

        sums = _sums(sample, add, DIMS)
        new = np.vstack([sums.get(i, np.zeros(DIMS)) for i in range(size)])
        empty = ~new.any(1)
        whole = np.repeat(new.reshape(-1, CENTROIDS, DIMS).sum(1), CENTROIDS, axis=0)
        new[empty] = whole[empty] if held is None else held[empty]
        held = _unit(new)
    return Model(languages, idf, held)


def languages(docs: DataFrame, most: int = MOST_PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred, score (the cosine, 0 to 1) and rejected of every document.

    Whole texts are read.  Learned from are documents with a text, a lang and an id whose crc32 mod 4 is not 2.
    ``rejected`` marks texts farther than FARTHEST from all centroids; their nearest language is still
    given.  Null text, and text without a letter, is ``und`` with score 0 and rejected; so is every text where there
    is nothing to learn from.  Ties take the first language by name; repeated rows each keep a row; an empty table
    gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    model = fit(rows.where("text IS NOT NULL AND lang IS NOT NULL").where(frames.remainder(F.col("id"), FOLD) != HELD_OUT), most)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, scores = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
        letter = batch.column("letter").to_pylist()
        if model is not None:
            for begin, tf in counts(batch.column("text")):
                at, cosine = model.nearest(tf)
                for i in range(len(tf)):
                    if letter[begin + i]:
                        names[begin + i], scores[begin + i] = model.languages[at[i] // CENTROIDS], min(1.0, max(0.0, float(cosine[i])))
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(names, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    asked = rows.select("id", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letter"))
    out = frames.per_batch(asked, run, "doc_id long, lang_pred string, score double")
    held = F.coalesce(frames.remainder(F.col("doc_id"), FOLD) == HELD_OUT, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score", (F.col("score") < FARTHEST).alias("rejected"))
