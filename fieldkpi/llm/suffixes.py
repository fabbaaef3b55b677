"""Exactly repeated byte strings: anchors bring places together, suffix arrays by induced sorting judge them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkpi.llm import frames, text

LENGTH = 400
#: Bytes of contexts that one suffix array holds, but for the group that goes past it.
SHARD_BYTES = 1 << 20
#: A group of more different contexts is dealt out by its strings, not sorted in one shard.
MOST_CONTEXTS = 4096
#: Stretches around an anchor that tell, by hash, which contexts can share a string.
WINDOWS = 8
_PLACE = "doc long, copy long, start int, end int"


# --- suffix arrays ---


def _smaller(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one after it; the last one, a sentinel, is."""
    n = len(t)
    differ = np.append(np.flatnonzero(t[1:] != t[:-1]), n - 1)
    next_differ = differ.repeat(np.diff(differ, prepend=-1))
    up = np.ones(n, bool)
    up[:-1] = t[1:] > t[:-1]
    return up[next_differ]


def _ranks(c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stable order by bucket, rank within the bucket, the buckets and their sizes; called for every block of a scan."""
    order = c.argsort(kind="stable")
    s = c[order]
    new = np.empty(len(s), bool)
    new[:1] = True
    np.not_equal(s[1:], s[:-1], out=new[1:])
    first = new.nonzero()[0]
    sizes = np.empty(len(first), np.int64)
    sizes[-1:] = len(s)
    sizes[:-1] = first[1:]
    sizes -= first
    return order, np.arange(len(s)) - first.repeat(sizes), s[first], sizes


def _induce(t: np.ndarray, up: np.ndarray, ends: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """All suffixes from the order of the leftmost-smaller ones: two linear scans, in blocks.

    A block of the scan is as long as no suffix of it lands inside it, so its entries are final when it is read.
    """
    n = len(t)
    out = np.full(n, -1, np.int64)
    heads, tails, down = np.append(0, ends[:-1]), ends.copy(), ~up
    order, rank, buckets, sizes = _ranks(t[seeds])
    placed = np.zeros(len(ends), np.int64)
    placed[buckets] = sizes
    c = t[seeds][order]
    out[tails[c] - placed[c] + rank] = seeds[order]
    at, size = 0, 1024
    while at < n:
        stop = min(n, at + size)
        block = out[at:stop]
        who = (block > 0).nonzero()[0]
        before = block[who] - 1
        larger = down[before]
        who, before = who[larger], before[larger]
        size = min(2 * size, 1 << 17)
        c = t[before]
        if len(who):
            low = int(heads[c].min())
            if low < stop:
                stop, size = low, max(64, 2 * (low - at))
                kept = who.searchsorted(low - at)
                before, c = before[:kept], c[:kept]
        if len(before):
            order, rank, buckets, sizes = _ranks(c)
            out[heads[c[order]] + rank] = before[order]
            heads[buckets] += sizes
        at = stop
    out[(out >= 0) & up[out]] = -1
    out[0] = n - 1
    at, size = n, 1024
    while at > 0:
        stop = max(0, at - size)
        block = out[stop:at][::-1]
        who = (block > 0).nonzero()[0]
        before = block[who] - 1
        less = up[before]
        who, before = who[less], before[less]
        size = min(2 * size, 1 << 17)
        c = t[before]
        if len(who):
            high = int(tails[c].max())
            if high > stop:
                stop, size = high, max(64, 2 * (at - high))
                kept = who.searchsorted(at - high)
                before, c = before[:kept], c[:kept]
        if len(before):
            order, rank, buckets, sizes = _ranks(c)
            out[tails[c[order]] - 1 - rank] = before[order]
            tails[buckets] -= sizes
        at = stop
    return out


def suffix_array(t: np.ndarray) -> np.ndarray:
    """The suffixes of t in order; t holds numbers from 0 and ends with its only 0."""
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int64)
    up = _smaller(t)
    ends = np.cumsum(np.bincount(t))
    left = np.zeros(n, bool)
    left[1:] = up[1:] & ~up[:-1]
    lms = np.flatnonzero(left)
    ordered = _induce(t, up, ends, lms)
    ordered = ordered[left[ordered]]
    # equal substrings, each up to and with the next one's first entry, have one name
    length = np.zeros(n, np.int64)
    length[lms] = np.append(np.diff(lms), 0) + 1
    a, b = ordered[:-1], ordered[1:]
    new = np.append(True, length[a] != length[b])
    open_, off = np.flatnonzero(~new[1:]), 0
    while len(open_):
        same = t[a[open_] + off] == t[b[open_] + off]
        new[open_[~same] + 1] = True
        open_, off = open_[same], off + 1
        open_ = open_[length[a[open_]] > off]
    names = np.cumsum(new) - 1
    if names[-1] + 1 < len(lms):
        of = np.zeros(n, np.int64)
        of[ordered] = names
        ordered = lms[suffix_array(of[lms])]
    return _induce(t, up, ends, ordered)


def common_prefixes(t: np.ndarray, order: np.ndarray) -> np.ndarray:
    """By place in the text: the length of the prefix shared with the suffix before it in the order.

    Only where the entries before the two suffixes differ is text compared; elsewhere it is one less than at the
    place before.
    """
    n = len(t)
    back = np.empty(n, np.int64)
    back[order[1:]] = order[:-1]
    back[order[0]] = -1
    at = np.arange(n)
    own = (at == 0) | (back <= 0)
    own[1:] |= t[at[1:] - 1] != t[back[1:] - 1]
    first = np.flatnonzero(own)
    out = np.zeros(n, np.int64)
    a, b = first[back[first] >= 0], back[first][back[first] >= 0]
    padded = np.concatenate([t.astype(np.int16), np.full(4, -1, np.int16)])
    wide = np.ndarray((n + 1,), np.uint64, padded.tobytes(), 0, (2,))
    live, shared = np.arange(len(a)), np.zeros(len(a), np.int64)
    while len(live):
        p, q = np.minimum(a[live] + shared[live], n), np.minimum(b[live] + shared[live], n)
        live = live[wide[p] == wide[q]]
        shared[live] += 4
    for _ in range(3):
        p, q = a + shared, b + shared
        shared += padded[np.minimum(p, n)] == padded[np.minimum(q, n)]
    out[a] = shared
    since = first[np.cumsum(own) - 1]
    return np.maximum(out[since] - (at - since), 0)


# --- anchors ---


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) of every ``width`` entries in a row."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = pick(x[:-step], x[step:])
        have += step
    return x


def _anchors(part: text.Texts, length: int) -> tuple[np.ndarray, ...]:
    """(hash, hash of the context, document, place in the slice, first, end) of the anchors of a slice.

    Every string of ``length`` bytes inside a document holds an anchor: the grams with the lowest hash in it.  Equal
    strings so have equal anchors at equal places.  first to end is what such strings around the anchor cover.
    """
    gram = _gram(length)
    width = length - gram + 1
    n = len(part.data)
    none = tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64, np.int64))
    if n < length:
        return none
    starts = np.arange(n - gram + 1)
    sums = text.prefix_sums(part.data)
    hashes = text.span_hashes(sums, starts, starts + gram)
    lowest = _sliding(hashes, width, np.minimum)
    sizes = np.diff(part.offsets)
    begin, end = np.repeat(part.offsets[:-1], sizes), np.repeat(part.offsets[1:], sizes)
    lowest[end[: len(lowest)] < starts[: len(lowest)] + length] = 0
    rim = np.zeros(width - 1, np.uint64)
    reached = _sliding(np.concatenate([rim, lowest, rim]), width, np.maximum)
    at = np.flatnonzero((reached == hashes) & (end[: len(hashes)] - begin[: len(hashes)] >= length) & (starts + gram <= end[: len(hashes)]))
    docs = np.searchsorted(part.offsets, at, "right") - 1
    first, last = np.maximum(begin[at], at - width + 1), np.minimum(end[at], at + length)
    # the anchor's place inside belongs to the context: clipped ones differ from whole ones
    context = text.mix(text.span_hashes(sums, first, last) + (at - first).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    return hashes[at], context, docs, at, first, last


def _digest(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def anchors(rows: DataFrame, length: int) -> DataFrame:
    """key, context, doc, copy, start, end: the anchors and a digest of the bytes around each."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in text.slices(batch.column(2)):
            keys, context, docs, _, first, end = _anchors(part, length)
            if not len(keys):
                continue
            base = part.offsets[docs]
            who = pa.array(docs + part.first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(context.view(np.int64)), batch.column(0).take(who), batch.column(1).take(who)]
                + [pa.array((x - base).astype(np.int32)) for x in (first, end)],
                ["key", "context", "doc", "copy", "start", "end"],
            )

    def every(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from run(batch)

    return rows.mapInArrow(every, f"key long, context long, {_PLACE}")


# --- judging ---


def _judge(pieces: list[bytes], doc: np.ndarray, start: np.ndarray, n: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(piece, offset) of the strings that start at two places or more; a piece with n above 1 stands for several."""
    sizes = np.array([len(p) + 1 for p in pieces])
    first = np.append(0, np.cumsum(sizes))
    joined = np.frombuffer(b"\0".join(pieces) + b"\0\0", np.uint8).astype(np.int16) + 2
    joined[first[1:] - 1] = 1
    joined[-1] = 0
    order = suffix_array(joined)
    prefix = common_prefixes(joined, order)
    piece = np.repeat(np.arange(len(pieces)), sizes)
    at = np.arange(len(piece)) - first[piece]
    order = order[order < len(piece)]
    order = order[at[order] + length < sizes[piece[order]]]  # no shorter suffix stands between two that share the string
    if not len(order):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    run = np.flatnonzero(np.append(True, prefix[order][1:] < length))
    p = piece[order]
    places = (doc[p] << 32) + start[p] + at[order]
    several = (np.minimum.reduceat(places, run) != np.maximum.reduceat(places, run)) | (np.maximum.reduceat(n[p], run) > 1)
    hit = np.repeat(several, np.diff(np.append(run, len(order))))
    return p[hit], at[order][hit]


def _gram(length: int) -> int:
    return max(1, length * 5 // 8)


def _shared(keys: np.ndarray, start: np.ndarray, pieces: list[bytes], length: int) -> np.ndarray:
    """True for contexts that may have a string with another one of their key: others have none and need no sorting.

    A string has its anchor at one of ``length`` - gram + 1 places, so two contexts that share it agree in some bytes
    to the left and to the right of the anchor: in one of WINDOWS stretches around it, compared by hash.  Where a
    context of the key begins with its document, its anchor's place is not known, and all of the key stay.
    """
    gram = _gram(length)
    rim = length - gram
    sizes = np.array([len(p) for p in pieces], np.int64)
    first = text.exclusive(sizes)
    sums = text.prefix_sums(np.frombuffer(b"".join(pieces), np.uint8))
    new = np.append(True, keys[1:] != keys[:-1])
    group = np.cumsum(new) - 1
    out = ~np.logical_and.reduceat(start > 0, np.flatnonzero(new))[group]
    open_ = np.flatnonzero(~out)
    step = rim // WINDOWS + 1
    for left in range(0, rim + 1, step):
        right = max(0, rim - left - step + 1)
        who = open_[sizes[open_] >= rim + gram + right]
        at = first[who] + rim
        seen = text.span_hashes(sums, at - left, at + gram + right) ^ text.mix(group[who].astype(np.uint64))
        _, same, count = np.unique(seen, return_inverse=True, return_counts=True)
        out[who] |= count[same.reshape(-1)] > 1
    return out


def _shards(length: int, most_bytes: int):
    """Spans of the repeated strings of (key, doc, copy, start, n, bytes) rows sorted by key; a key is never cut."""

    def emit(rows: pa.Table) -> pa.RecordBatch | None:
        shared = _shared(rows.column(0).to_numpy(), rows.column(3).to_numpy(), rows.column(5).to_pylist(), length)
        if not shared.any():
            return None
        rows = rows.filter(pa.array(shared))
        ids = np.stack([rows.column(i).to_numpy() for i in (1, 2)], axis=1)
        doc = np.unique(ids, axis=0, return_inverse=True)[1].reshape(-1).astype(np.int64)
        start = rows.column(3).to_numpy().astype(np.int64)
        piece, at = _judge(rows.column(5).to_pylist(), doc, start, rows.column(4).to_numpy(), length)
        if not len(piece):
            return None
        by = np.lexsort((at, piece))
        piece, at = piece[by], at[by]
        cut = np.append(True, (piece[1:] != piece[:-1]) | (at[1:] > at[:-1] + length))
        first, last = np.flatnonzero(cut), np.append(np.flatnonzero(cut)[1:], len(cut)) - 1
        who = piece[first]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[who, 0]), pa.array(ids[who, 1]), pa.array((start[who] + at[first]).astype(np.int32)), pa.array((start[who] + at[last] + length).astype(np.int32))],
            ["doc", "copy", "start", "end"],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy()
            if held and size >= most_bytes and held[-1].column(0)[-1].as_py() != keys[0]:
                out = emit(pa.Table.from_batches(held))
                held, size = [], 0
                if out is not None:
                    yield out
            lengths = np.array([len(b) for b in batch.column(5).to_pylist()])
            new = np.flatnonzero(np.append(False, keys[1:] != keys[:-1]))
            sums, begin = np.append(0, np.cumsum(lengths)), 0
            for border in new.tolist():
                if size + sums[border] - sums[begin] >= most_bytes:
                    held.append(batch.slice(begin, border - begin))
                    out = emit(pa.Table.from_batches(held))
                    held, size, begin = [], 0, border
                    if out is not None:
                        yield out
            held.append(batch.slice(begin))
            size += sums[-1] - sums[begin]
        if held:
            out = emit(pa.Table.from_batches(held))
            if out is not None:
                yield out

    return run


def _strings(length: int):
    """Every string of the contexts of a crowded group, as a key of its own."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        c = [batch.column(i).to_pylist() for i in range(6)]
        out = [
            (_digest(b[i : i + length]), d, copy, s + i, s + i + length, n)
            for _, d, copy, s, n, b in zip(*c, strict=True)
            for i in range(len(b) - length + 1)
        ]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out, strict=True), types, strict=True)], ["string", "doc", "copy", "start", "end", "n"]) if out else None

    return run


def _identified(docs: DataFrame) -> DataFrame:
    """doc, copy, text: copy is 0, or a number that tells rows of one id (or of none) apart."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), F.lit(0).cast("long").alias("copy"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    again = frames.written(rows.groupBy("doc").agg(F.count("*").alias("n")).where("n > 1 AND doc IS NOT NULL").select("doc"), "suffix-ids")
    odd = rows.where("doc IS NULL")
    single = rows.where("doc IS NOT NULL")
    if again.isEmpty() and odd.isEmpty():
        return single
    odd = odd.unionByName(single.join(again, "doc", "left_semi"))
    odd = frames.written(odd.withColumn("copy", F.monotonically_increasing_id() + 1), "suffix-odd")
    return single.join(again, "doc", "left_anti").unionByName(odd)


def _spans(rows: DataFrame, length: int, shard_bytes: int, most_contexts: int) -> DataFrame:
    keyed = rows.withColumn("doc", F.coalesce("doc", F.lit(0).cast("long"))).where(F.octet_length("text") >= length)
    found = frames.written(anchors(keyed, length), "anchors")
    often = frames.written(found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "anchors-often")
    cand = frames.written(found.join(often, "key", "left_semi"), "anchors-again")
    place = F.struct("doc", "copy", "start", "end")
    contexts = frames.written(cand.groupBy("key", "context").agg(F.count("*").alias("n"), F.min(place).alias("at")).select("key", "context", "n", "at.*"), "contexts")
    # a context that occurs again: all of its strings do
    whole = cand.join(contexts.where("n > 1").select("key", "context"), ["key", "context"], "left_semi").select("doc", "copy", "start", "end")
    mixed = contexts.groupBy("key").agg(F.count("*").alias("n_contexts")).where("n_contexts > 1")
    # the hash of the key's group is small beside its contexts; each context goes to its document's text
    places = frames.written(contexts.join(mixed, "key").select("key", "doc", "copy", "start", "end", "n", "n_contexts"), "contexts-mixed")
    per_doc = places.groupBy("doc", "copy").agg(F.collect_list(F.struct("key", "start", "end", "n", "n_contexts")).alias("places"))
    texts = keyed.join(per_doc, ["doc", "copy"]).select("doc", "copy", F.encode("text", "utf-8").alias("data"), F.explode("places").alias("p"))
    texts = texts.select("p.key", "doc", "copy", "p.start", "p.n", F.expr("substring(data, p.start + 1, p.end - p.start)").alias("data"), "p.n_contexts")
    texts = frames.written(texts, "context-bytes")
    sorted_ = texts.where(F.col("n_contexts") <= most_contexts).drop("n_contexts").repartition("key").sortWithinPartitions("key")
    spans = whole.unionByName(sorted_.mapInArrow(_shards(length, shard_bytes), _PLACE))
    crowded = texts.where(F.col("n_contexts") > most_contexts).drop("n_contexts")
    strings = frames.written(frames.per_batch(crowded, _strings(length), f"string long, {_PLACE}, n long"), "strings")
    key = F.struct("doc", "copy", "start")
    again = strings.groupBy("string").agg(F.min(key).alias("a"), F.max(key).alias("b"), F.max("n").alias("n")).where("a <> b OR n > 1").select("string")
    return spans.unionByName(strings.join(again, "string", "left_semi").select("doc", "copy", "start", "end"))


def repeated(docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES, most_contexts: int = MOST_CONTEXTS) -> DataFrame:
    """doc_id, text, spans (start, end bytes): the bytes covered by a ``length``-byte string that starts elsewhere too.

    Every string of that length holds an anchor, so equal strings meet in their anchor's group.  A group whose
    contexts (all bytes that strings around the anchor cover) are equal is repeated whole.  Others are packed into
    shards; a suffix array by induced sorting and permuted common prefixes tells which of their strings are equal.
    A group with more than ``most_contexts`` different contexts is spread by its single strings instead.

    Null texts are empty and, like texts shorter than ``length``, have no spans.  Each row is a document, also rows
    of equal or null id and of equal text.  Spans of a row may overlap and are in no order; other columns are
    ignored.  An empty table gives no rows.
    """
    rows = _identified(docs)
    found = _spans(rows, length, shard_bytes, most_contexts)
    found = found.groupBy("doc", "copy").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    found = found.select(F.col("doc").alias("_doc"), F.col("copy").alias("_copy"), "spans")
    same = (F.coalesce(F.col("doc"), F.lit(0).cast("long")) == F.col("_doc")) & (F.col("copy") == F.col("_copy"))
    return rows.join(found, same, "left").select(F.col("doc").alias("doc_id"), "text", "spans")


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted((r["start"], r["end"]) for r in spans or ()):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def digests(docs: DataFrame, length: int = LENGTH, **sizes: int) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (of the bytes outside ``repeated``'s spans), one row per row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for value, spans in zip(batch.column(1).cast(pa.large_binary()), batch.column(2), strict=True):
            data, cuts = value.as_py(), merged(spans.as_py())
            sha, at = hashlib.sha256(), 0
            for s, e in cuts:
                sha.update(data[at:s])
                at = e
            sha.update(data[at:])
            out.append((len(data), sum(e - s for s, e in cuts), len(cuts), sha.hexdigest()))
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        types = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return frames.per_batch(repeated(docs, length, **sizes), run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
