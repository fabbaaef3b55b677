"""MinHash near-duplicates: banded candidates, sequential Bayesian verification of signatures, exact check of survivors."""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkpi.llm import frames, graphs, text

BANDS, ROWS = 25, 4
HASHES = BANDS * ROWS
#: Bits that tell whether an odd number of shingles fall on each place: two sets differ in at least as many shingles as bits.
PARITY = 2048
#: 32-bit numbers of a signature: the minima, the parity bits, the set's size.
SIGNATURE = HASHES + PARITY // 32 + 1
#: Bytes of a brief signature: of the minima only the last byte.
BRIEF = HASHES + PARITY // 8 + 4
#: Signatures are compared so many hashes at a time.
BATCH = 10
#: A pair goes when the posterior probability that it is similar enough falls below this.
MISS = 1e-6
#: Members of a bucket are compared in blocks of about so many.
BLOCK = 128
#: How often members outside their bucket's largest component are held against further hubs before blocks are compared.
TURNS = 2
#: Blocks are compared at once where that is no more than so many pairs for each different text.
PAIRS = 500
#: What a pair with its signatures, and with its sets, weighs for the tasks that compare them, in narrow rows.
SIGNED, WITH_SETS = 16, 64
_U = np.uint64
_SEEDS, _FACTORS = text.stream(101, HASHES), text.stream(103, HASHES) | _U(1)


def signatures(part: text.Texts, shingled: text.Shingled) -> np.ndarray:
    """Of each document's shingle set HASHES minima (without shingles: all ones), the parity bits and the size."""
    n = part.last - part.first
    counts = np.bincount(shingled.docs, minlength=n)
    some = np.flatnonzero(counts)
    out = np.full((n, SIGNATURE), 0xFFFFFFFF, np.uint32)
    bit = (text.mix(shingled.hashes ^ _U(0x7F4A7C15)) % _U(PARITY)).astype(np.int64)
    parity = np.zeros(n * (PARITY // 32), np.uint32)
    np.bitwise_xor.at(parity, shingled.docs * (PARITY // 32) + (bit >> 5), np.uint32(1) << (bit & 31).astype(np.uint32))
    out[:, HASHES:-1] = parity.reshape(n, -1)
    out[:, -1] = np.minimum(counts, 0xFFFFFFFF)
    if len(some):
        starts = text.exclusive(counts)[some]
        x = np.empty_like(shingled.hashes)
        for i in range(HASHES):
            np.bitwise_xor(shingled.hashes, _SEEDS[i], out=x)
            x *= _FACTORS[i]
            x ^= x >> _U(32)
            x *= _U(0x9FB21C651E98DF25)
            out[some, i] = np.minimum.reduceat(x, starts) >> _U(32)
    return out


def _signed(width: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, first, second, sigs, briefs, bands = [], [], [], [], [], []
        for part in text.slices(batch.column(1)):
            n = part.last - part.first
            s = text.document_shingles(part, width)
            counts = np.bincount(s.docs, minlength=n)
            sums = np.zeros((2, n + 1), _U)
            bounds = np.append(text.exclusive(counts), len(s.hashes))
            for k, salt in enumerate((0xA24BAED4963EE407, 0x9FB21C651E98DF25)):
                total = np.append(_U(0), np.cumsum(text.mix(s.hashes ^ _U(salt)), dtype=_U))
                sums[k, :n] = total[bounds[1:]] - total[bounds[:-1]]
            sig = signatures(part, s)
            rows = sig[:, :HASHES].reshape(n, BANDS, ROWS).astype(_U)
            band = np.arange(BANDS, dtype=_U)[None, :] * _U(0xD6E8FEB86659FD93)
            for r in range(ROWS):
                band = text.mix(band ^ rows[:, :, r])
            sizes.append(counts)
            first.append(sums[0, :n].view(np.int64))
            second.append(sums[1, :n].view(np.int64))
            sigs += [row.tobytes() for row in sig]
            briefs += [row.tobytes() for row in np.hstack([sig[:, :HASHES].astype(np.uint8), sig[:, HASHES:].copy().view(np.uint8)])]
            bands.append(band.view(np.int64))
        flat = np.concatenate(bands)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, flat.size + 1, BANDS, dtype=np.int32)), pa.array(flat.ravel()))
        arrays = [batch.column(0), pa.array(np.concatenate(sizes)), pa.array(np.concatenate(first)), pa.array(np.concatenate(second)), pa.array(sigs, pa.binary()), pa.array(briefs, pa.binary()), lists]
        return pa.RecordBatch.from_arrays(arrays, ["id", "n", "k1", "k2", "sig", "brief", "bands"])

    return lambda batch: run(batch) if batch.num_rows else None


def _sets(width: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = []
        for part in text.slices(batch.column(1)):
            s = text.document_shingles(part, width)
            bounds = np.searchsorted(s.docs, np.arange(part.last - part.first + 1))
            sets += [s.hashes[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["id", "shingles"])

    return run


@cache
def needed(percent: int, miss: float = MISS) -> np.ndarray:
    """The fewest agreeing hashes after each batch with which a pair is kept.

    With a uniform prior, the posterior of a similarity of t or more after m agreements in n is the probability
    that a binomial of n + 1 trials with chance t does not exceed m.
    """
    t, out = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        below, m = 0.0, 0
        while True:
            below += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if below >= miss:
                break
            m += 1
        out.append(m)
    return np.array(out)


def survivors(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Rows of two signature matrices that no batch prunes, and that do not differ in too many shingles for sure."""
    return _survivors((a[:, :HASHES], a[:, HASHES:]), (b[:, :HASHES], b[:, HASHES:]), np.arange(len(a)), np.arange(len(a)), percent)


def _survivors(one: tuple, two: tuple, p: np.ndarray, q: np.ndarray, percent: int) -> np.ndarray:
    """Of the pairs of rows p and q of two (minima, parity bits and size) those that survive.

    Of minima cut to their last byte no fewer agree than of whole ones, so with these no pair is lost.
    """
    alive, agree = np.arange(len(p)), np.zeros(len(p), np.int64)
    for k, least in enumerate(needed(percent)):
        at = slice(k * BATCH, (k + 1) * BATCH)
        agree = agree + (one[0][p[alive], at] == two[0][q[alive], at]).sum(1)
        stays = agree >= least
        alive, agree = alive[stays], agree[stays]
    x, y = one[1][p[alive]], two[1][q[alive]]
    differ = np.bitwise_count(x[:, :-1] ^ y[:, :-1]).sum(1, dtype=np.int64)
    total = x[:, -1].astype(np.int64) + y[:, -1]
    return alive[differ * (100 + percent) <= (100 - percent) * total]


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, SIGNATURE)


def _brief(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The last bytes of the minima; the parity bits and the size."""
    rows = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BRIEF)
    return rows[:, :HASHES], rows[:, HASHES:].copy().view(np.uint32)


def _verified(pairs: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different ids that survive."""
    one = signed.select(F.col("id").alias("a"), F.col("sig").alias("sa"))
    two = signed.select(F.col("id").alias("b"), F.col("sig").alias("sb"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        if batch.num_rows == 0:
            return None
        return batch.select(["a", "b"]).take(pa.array(survivors(_matrix(batch.column("sa")), _matrix(batch.column("sb")), percent)))

    return frames.per_batch(pairs.join(one, "a").join(two, "b").select("a", "b", "sa", "sb"), run, "a long, b long")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets have 100 * intersection >= percent * union."""
    one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        stays = np.zeros(batch.num_rows, bool)
        for i, (x, y) in enumerate(zip(batch.column("sa"), batch.column("sb"), strict=True)):
            p, q = (np.frombuffer(v.as_buffer(), _U) for v in (x, y))
            if 100 * min(len(p), len(q)) >= percent * max(len(p), len(q)):
                both = np.concatenate([p, q])
                both.sort()
                same = int((both[1:] == both[:-1]).sum())
                stays[i] = 100 * same >= percent * (len(p) + len(q) - same)
        return batch.select(["a", "b"]).filter(pa.array(stays))

    return frames.per_batch(pairs.join(one, "a").join(two, "b").select("a", "b", "sa", "sb"), run, "a long, b long")


def _hubs(seed: int, members=None) -> list:
    """Two members that a hash of bucket and id draws, so that the buckets of a large group have different ones."""
    draw = F.xxhash64(F.lit(seed), F.col("bucket"), F.col("id"))
    who = F.col("id") if members is None else F.when(members, F.col("id"))
    draw = draw if members is None else F.when(members, draw)
    return [F.min_by(who, draw).alias(f"low{seed}"), F.max_by(who, draw).alias(f"high{seed}")]


def _hub_pairs(placed: DataFrame) -> DataFrame:
    """Each member with the hubs of its bucket (columns low* and high*)."""
    hubs = [c for c in placed.columns if c.startswith(("low", "high"))]
    pairs = placed.select("id", F.explode(F.array(*hubs)).alias("hub")).where("id <> hub")
    return pairs.select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()


def _giants(members: DataFrame) -> DataFrame:
    """(bucket, giant, all, rest) of the buckets that hold several components: the largest, all members, the others."""
    parts = members.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    per = parts.groupBy("bucket").agg(F.max_by("component", F.col("n")).alias("giant"), F.max("n").alias("most"), F.sum("n").alias("all"), F.count("*").alias("kinds"))
    return frames.written(per.where("kinds > 1").select("bucket", "giant", "all", (F.col("all") - F.col("most")).alias("rest")), "mixed", members.count())


def _members(large: DataFrame, joined: DataFrame) -> DataFrame:
    """(bucket, id, component, giant, all, rest) of the members of the buckets that hold several components."""
    members = large.join(joined, "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("component"))
    members = frames.written(members, "labelled")
    return frames.written(members.join(_giants(members), "bucket"), "members", members.count())


def _pairs(members: DataFrame) -> int:
    """How many pairs blocks of the members would compare."""
    return members.where("component <> giant").agg(F.sum("all")).first()[0] or 0


def _blocks(rows: DataFrame, n, name: str) -> DataFrame:
    """The members (bucket, id, component, brief) of each bucket in blocks of about BLOCK; ``n``: how many the bucket has."""
    block = F.pmod(F.xxhash64(F.lit(5), "id"), F.greatest(F.lit(1), F.floor(n / BLOCK))).alias("block")
    return rows.groupBy("bucket", block).agg(F.collect_list(F.struct("id", "component", "brief")).alias(name)).drop("block")


def _held(left: DataFrame, right: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that their brief signatures do not prune, of the members of a left and a right block (ma, mb) of a bucket that are of different components."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [np.zeros((0, 2), np.int64)]
        for i in range(batch.num_rows):
            sides = []
            for c in ("ma", "mb"):
                v = batch.column(c)[i].values
                sides.append((v.field("id").to_numpy(), v.field("component").to_numpy(), _brief(v.field("brief"))))
            (x, cx, sx), (y, cy, sy) = sides
            first = (sx[0][:, None, :BATCH] == sy[0][None, :, :BATCH]).sum(2) >= needed(percent)[0]
            p, q = np.nonzero(first & (cx[:, None] != cy[None, :]))
            stays = _survivors(sx, sy, p, q, percent)
            pair = np.column_stack([x[p[stays]], y[q[stays]]])
            found.append(np.column_stack([pair.min(1), pair.max(1)]))
        out = np.unique(np.concatenate(found), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(out[:, 0].copy()), pa.array(out[:, 1].copy())], ["a", "b"])

    return frames.per_batch(left.join(right, "bucket").select("ma", "mb"), run, "a long, b long").distinct()


def _apart(members: DataFrame, reps: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """Blocks of the members outside the largest component of their bucket, and of hubs drawn from it and from the others.

    A block meets the bucket's few hubs in one row, so no row is made for a member and a hub.  Each member is a component
    of its own here: hubs are also held against members that are joined to them already.
    """
    giant = F.col("component") == F.col("giant")
    hubs = members.groupBy("bucket").agg(*_hubs(10 * turn, giant), *_hubs(10 * turn + 1, giant), *_hubs(10 * turn + 2, ~giant))
    hubs = hubs.select("bucket", F.explode(F.array(*[c for c in hubs.columns if c != "bucket"])).alias("id")).distinct()
    signed = reps.select("id", F.col("id").alias("component"), "brief")
    left = _blocks(members.where(~giant).select("bucket", "id", "rest").join(signed, "id"), F.col("rest"), "ma")
    return frames.written(left, "left"), frames.written(_blocks(hubs.join(signed, "id"), F.lit(1), "mb"), "hubs")


def _blocked(members: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that their brief signatures do not prune, of members of a bucket that are of different components, in blocks.

    Two members of the bucket's largest component need no comparison: each block of the others is held against every
    block of the bucket.
    """
    own = frames.written(members.join(reps.select("id", "brief"), "id"), "briefs")
    left = frames.written(_blocks(own.where("component <> giant"), F.col("rest"), "ma"), "left")
    right = frames.written(_blocks(own, F.col("all"), "mb"), "right")
    return _held(left, right, percent)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and n_links of every document.

    Words are lower-cased (A-Z); a document's set are its distinct shingles of ``width`` words (its whole
    sequence if it has fewer).  Documents are linked if 100 * intersection >= percent * union; component_id is
    the smallest doc_id reachable.  Equal sets are one class from the start.  The classes of a bucket are first
    held against drawn hubs, and against further ones where many pairs are left; then what the links so found do not
    already join is compared in blocks, so every pair of a bucket is joined or compared.  n_links counts the confirmed
    links of the document's class in which it was compared.

    Null or empty texts have no shingles and are linked with nothing, as are rows with a null id (component
    null, kept).  Rows that share an id are one node of the graph and each keep a row.  An empty table gives no
    rows; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string"))
    signed = frames.written(frames.per_batch(rows, _signed(width), "id long, n long, k1 long, k2 long, sig binary, brief binary, bands array<long>"), "signed")
    some = signed.where("n > 0 AND id IS NOT NULL")
    classes = frames.written(some.groupBy("k1", "k2", "n").agg(F.min("id").alias("rep")), "classes")
    reps = classes.select(F.col("rep").alias("id"), "n", "k1", "k2").join(some.select("id", "n", "k1", "k2", "sig", "brief", "bands"), ["id", "n", "k1", "k2"]).dropDuplicates(["id", "k1", "k2"])
    reps = frames.written(reps.select("id", "sig", "brief", "bands"), "reps")
    buckets = reps.select("id", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n"), *_hubs(1)).where("n > 1")
    n_reps = reps.count()
    placed = frames.written(buckets.join(frames.written(shared, "shared", BANDS * n_reps), "bucket"), "placed", BANDS * n_reps)
    n_placed = placed.count()
    pairs = frames.written(_hub_pairs(placed), "pairs", 2 * n_placed)
    wanted = frames.written(placed.select("id").distinct(), "wanted", n_placed)
    sets = frames.written(frames.per_batch(rows.join(wanted, "id", "left_semi"), _sets(width), "id long, shingles binary"), "sets")
    alive = frames.written(_verified(pairs, reps, percent), "alive", SIGNED * pairs.count())
    links = frames.written(_linked(alive, sets, percent), "hub-links", WITH_SETS * alive.count())
    joined = graphs.components(links, links.count())

    large = frames.written(placed.where("n > 3").select("bucket", "id"), "large")
    members, most = _members(large, joined), PAIRS * n_reps
    for turn in range(TURNS):
        if _pairs(members) <= most:
            break
        apart = frames.written(_held(*_apart(members, reps, turn + 2), percent), "apart")
        more = frames.written(_linked(frames.written(_verified(apart, reps, percent), "alive"), sets, percent), "hub-links")
        links, joined = links.unionByName(more), graphs.extended(joined, more)
        members = _members(large, joined)
    rest = frames.written(_blocked(members, reps, percent), "rest")
    alive = frames.written(_verified(rest, reps, percent), "alive", SIGNED * rest.count())
    more = frames.written(_linked(alive, sets, percent), "rest-links", WITH_SETS * alive.count())
    links, joined = links.unionByName(more).distinct(), graphs.extended(joined, more)
    degree = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("n_links"))
    known = classes.join(joined, classes.rep == joined.id, "left").drop("id").join(degree, F.col("rep") == degree.id, "left").drop("id")
    known = frames.written(known.select("k1", "k2", "n", F.coalesce("component", "rep").alias("component"), F.coalesce("n_links", F.lit(0)).alias("n_links")), "known")
    out = signed.select("id", "n", "k1", "k2").join(known, ["k1", "k2", "n"], "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    component = F.when(F.col("id").isNotNull(), F.coalesce(component, "id"))
    return out.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def deduplicated(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, as it is: the one with the smallest id.

    Judged are rows, not ids: of rows that share an id each is a document of its own, and goes only if its own text
    is linked to one that stays.  Rows with a null id, and rows without words, stay.  Other columns are kept,
    whatever their names; an empty table gives no rows.
    """
    key, gone = frames.spare(docs, 2)
    rows = frames.keyed(docs, key)
    judged = near_duplicates(rows.select(F.col(key).alias("doc_id"), "text"), width, percent)
    lost = frames.written(judged.where(~F.col("kept")).select(F.col("doc_id").alias(gone)), "not-kept")
    return rows.join(lost, F.col(key) == F.col(gone), "left_anti").drop(key)
