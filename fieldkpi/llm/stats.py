"""Counts over whole documents that the quality operators judge by."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkpi.llm import frames, text

SYMBOLS = b"#*$%&|<>"
WINDOW = 5

COUNTS = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_distinct n_chars_all n_upper n_lower n_digits n_marks n_wide n_same_next max_word"
).split()
SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)

_CLASSES = {
    "n_symbols": SYMBOLS,
    "n_upper": bytes(range(65, 91)),
    "n_lower": bytes(range(97, 123)),
    "n_digits": b"0123456789",
    "n_marks": b".,;:!?\"'()-",
    "n_wide": bytes(range(0xC0, 0x100)),
    "n_chars_all": bytes(b for b in range(256) if b & 0xC0 != 0x80),
    "word_chars": bytes(b for b in range(256) if b & 0xC0 != 0x80 and b not in (9, 10, 11, 12, 13, 32)),
}
_MASK = np.zeros((256, len(_CLASSES)), np.int64)
for _i, _bytes in enumerate(_CLASSES.values()):
    _MASK[list(_bytes), _i] = 1


def _repeats(hashes: np.ndarray, groups: np.ndarray, n_groups: int) -> tuple[np.ndarray, np.ndarray]:
    """For each entry whether its group has the hash again; and by group, how many equal an earlier one."""
    order = text.by_group(hashes, groups, n_groups)
    h, g = hashes[order], groups[order]
    same = np.zeros(len(h) + 1, bool)
    same[1:-1] = (h[1:] == h[:-1]) & (g[1:] == g[:-1])
    often = np.zeros(len(h), bool)
    often[order] = same[1:] | same[:-1]
    return often, np.bincount(g[same[:-1]], minlength=n_groups)


def count(part: text.Texts) -> dict[str, np.ndarray]:
    """The counts of each document of a slice."""
    data, offsets = part.data, part.offsets
    n = len(offsets) - 1
    out: dict[str, np.ndarray] = {}
    bytes_of = np.zeros((n, 256), np.int64)
    for i in range(n):
        bytes_of[i] = np.bincount(data[offsets[i] : offsets[i + 1]], minlength=256)
    classes = bytes_of @ _MASK
    out |= {name: classes[:, i] for i, name in enumerate(_CLASSES)}

    w = text.words(data, offsets)
    out["n_words"] = np.diff(w.bounds)
    docs = np.repeat(np.arange(n), out["n_words"])
    sums = text.prefix_sums(data)
    own = text.span_hashes(sums, w.starts, w.ends)
    out["n_distinct"] = out["n_words"] - _repeats(own, docs, n)[1]
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, docs, w.ends - w.starts)
    out["max_word"] = longest
    next_same = np.flatnonzero((own[1:] == own[:-1]) & (docs[1:] == docs[:-1])) if len(own) else np.zeros(0, np.int64)
    out["n_same_next"] = np.bincount(docs[next_same], minlength=n)

    windows = text.shingles(own, WINDOW)
    inside = np.flatnonzero(docs[: len(windows)] == docs[WINDOW - 1 :]) if len(windows) else np.zeros(0, np.int64)
    often, _ = _repeats(windows[inside], docs[inside], n)
    change = np.zeros(len(own) + 1, np.int64)
    np.add.at(change, inside[often], 1)
    np.add.at(change, inside[often] + WINDOW, -1)
    covered = np.cumsum(change[:-1]) > 0
    out["n_repeat_words"] = np.bincount(docs[covered], minlength=n)

    breaks = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    starts = starts[starts < len(data)]
    line_doc = np.searchsorted(offsets, starts, "right") - 1
    ends = np.append(starts[1:], len(data))
    first_word = np.searchsorted(w.starts, starts)
    with_word = (first_word < len(w.starts)) & (np.append(w.starts, len(data))[first_word] < ends)
    starts, ends, line_doc = starts[with_word], ends[with_word], line_doc[with_word]
    ends = ends - (data[ends - 1] == 10)
    out["n_lines"] = np.bincount(line_doc, minlength=n)
    out["n_dup_lines"] = _repeats(text.span_hashes(sums, starts, ends), line_doc, n)[1]
    return out


def of_documents(docs: DataFrame) -> DataFrame:
    """doc_id and COUNTS of every whole text; null and empty texts count nothing."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns: dict[str, list[np.ndarray]] = {c: [] for c in COUNTS}
        for part in text.slices(batch.column(1)):
            for name, values in count(part).items():
                columns[name].append(values)
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(np.concatenate(columns[c]), pa.int64()) for c in COUNTS)], ["doc_id", *COUNTS])

    return frames.per_batch(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), lambda b: run(b) if b.num_rows else None, SCHEMA)


FEATURES = "log_words chars_per_word symbols upper digits marks wide same_next distinct repeats dup_lines words_per_line longest".split()


def features(batch: pa.RecordBatch) -> np.ndarray:
    """A matrix with a row per document and a column per entry of FEATURES, from the columns of COUNTS."""
    c = {n: batch.column(n).to_numpy(zero_copy_only=False).astype(float) for n in COUNTS}
    words, chars, lines = np.maximum(c["n_words"], 1), np.maximum(c["n_chars_all"], 1), np.maximum(c["n_lines"], 1)
    return np.column_stack(
        [
            np.log1p(c["n_words"]),
            np.minimum(c["word_chars"] / words, 50),
            c["n_symbols"] / words,
            c["n_upper"] / np.maximum(c["n_upper"] + c["n_lower"], 1),
            c["n_digits"] / chars,
            c["n_marks"] / words,
            c["n_wide"] / chars,
            c["n_same_next"] / words,
            c["n_distinct"] / words,
            c["n_repeat_words"] / words,
            c["n_dup_lines"] / lines,
            np.log1p(c["n_words"] / lines),
            np.log1p(c["max_word"]),
        ]
    )
