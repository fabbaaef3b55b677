"""Judge urls by host and path rules, and by a list of hosts held in a cascade of Bloom filters."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldkpi.llm import frames

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A shard of the key universe has about so many keys: at most 30 MB of filters.
SHARD_KEYS = 1 << 24
_U = np.uint64


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """The longest rule that fits (null: none) and its verdict.  A rule fits its host and all subdomains."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.host) + len(r.path), r.host + r.path)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, verdict = F.when(fits, F.lit(r.host + r.path)).otherwise(name), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


class Level(NamedTuple):
    bits: int
    hashes: int
    words: np.ndarray


def _size(n_in: int, n_out: int, rate: float) -> tuple[int, int]:
    """Bits and hash count for n_in keys; the first level lets pass about as many others as it holds."""
    rate = min(0.5, max(rate, 1e-4))
    bits = max(64, int(np.ceil(-n_in * np.log(rate) / np.log(2) ** 2 / 64)) * 64)
    return bits, max(1, round(bits / max(1, n_in) * np.log(2)))


def _positions(key: Column, level: int, bits: int, hashes: int) -> Column:
    seeds = F.array(*[F.xxhash64(F.lit(level * 64 + i), key) for i in range(hashes)])
    return F.transform(seeds, lambda h: F.pmod(h, F.lit(bits)))


def _filter(keys: DataFrame, level: int, bits: int, hashes: int) -> np.ndarray:
    """The bits that the keys set, joined into 64-bit words before they leave the executors."""
    at = keys.select(F.explode(_positions(F.col("key"), level, bits, hashes)).alias("at"))
    words = at.groupBy(F.floor(F.col("at") / 64).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(at % 64 AS int))")).alias("on"))
    out = np.zeros(bits // 64, np.int64)
    for b in words.toArrow().to_batches():
        out[b.column(0).to_numpy(zero_copy_only=False)] = b.column(1).to_numpy(zero_copy_only=False)
    return out.view(_U)


def _passes(keys: DataFrame, level: int, f: Level) -> DataFrame:
    """Keys whose bits are all set."""
    table = f.words
    positions = keys.select("*", _positions(F.col("key"), level, f.bits, f.hashes).alias("at"))

    def test(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        on = (table[at >> 6] >> (at & 63).astype(_U)) & _U(1)
        keep = on.reshape(batch.num_rows, -1).all(1)
        return batch.select(range(batch.num_columns - 1)).filter(pa.array(keep))

    fields = ", ".join(f"{n} {t}" for n, t in keys.dtypes)
    return frames.per_batch(positions, test, fields)


def cascade(universe: DataFrame, most_levels: int = 64) -> list[Level]:
    """Filters whose alternation answers membership exactly for every key of the universe.

    ``universe``: distinct ``key`` (string) and ``listed`` (boolean).  Level 0 holds the listed keys, level 1
    the unlisted ones that pass level 0, level 2 the listed ones that pass level 1, and so on until nothing
    passes.  A key is listed if the first level it fails is odd.
    """
    sides = {True: universe.where("listed").select("key"), False: universe.where("NOT listed").select("key")}
    n = {side: df.count() for side, df in sides.items()}
    levels: list[Level] = []
    held = True
    while n[held]:
        if len(levels) == most_levels:
            raise RuntimeError("the cascade does not end: a key is both listed and not listed")
        bits, hashes = _size(n[held], n[not held], n[held] / max(1, n[not held]) / 1.41 if not levels else 0.5)
        levels.append(Level(bits, hashes, _filter(sides[held], len(levels), bits, hashes)))
        others = frames.written(_passes(sides[not held], len(levels) - 1, levels[-1]), "cascade")
        sides[not held], n[not held] = others, others.count()
        held = not held
    return levels


def _members(levels: list[Level]):
    def member(batch: pa.RecordBatch) -> np.ndarray:
        n = batch.num_rows
        alive, answer = np.ones(n, bool), np.zeros(n, bool)
        for depth, f in enumerate(levels):
            at = batch.column(f"at{depth}").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            on = ((f.words[at >> 6] >> (at & 63).astype(_U)) & _U(1)).reshape(n, -1).all(1)
            answer[alive & ~on] = depth % 2 == 1
            alive &= on
        answer[alive] = len(levels) % 2 == 1
        return answer

    return member


def with_membership(df: DataFrame, key: str, universe: DataFrame, name: str = "listed", shard_keys: int = SHARD_KEYS) -> DataFrame:
    """Adds whether the key is listed, read from the cascade alone.

    The universe must hold every key of ``df``.  It is cut by hash into shards of about ``shard_keys`` keys,
    each with a cascade of its own, and each shard's rows are answered in a pass of their own: what is sent to
    the tasks stays at a few bytes for each of ``shard_keys`` keys, however many the corpus has.
    """
    n_shards = max(1, -(-universe.count() // shard_keys))
    if n_shards == 1:
        return _answered(df, key, cascade(universe), name)
    shard = lambda k: F.pmod(F.xxhash64(F.lit(-1), k), F.lit(n_shards))
    parts = [_answered(df.where(shard(F.col(key)) == s), key, cascade(universe.where(shard(F.col("key")) == s)), name) for s in range(n_shards)]
    return reduce(DataFrame.unionByName, parts)


def _answered(df: DataFrame, key: str, levels: list[Level], name: str) -> DataFrame:
    if not levels:
        return df.withColumn(name, F.lit(False))
    member, columns = _members(levels), df.columns
    asked = df.select("*", *[_positions(F.col(key), i, f.bits, f.hashes).alias(f"at{i}") for i, f in enumerate(levels)])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(columns))), pa.array(member(batch))], [*columns, name])

    return frames.per_batch(asked, run, ", ".join([*(f"`{n}` {t}" for n, t in df.dtypes), f"{name} boolean"]))


def judge(pages: DataFrame, rules: tuple[Rule, ...], listed: Column) -> DataFrame:
    """page_id, host, path, rule, listed and verdict of every url.

    The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; the path
    is what follows, up to ``?``, ``#`` or the end.  The longest rule whose host is the url's host or a parent
    domain, and whose path begins the url's path, decides.  Where none fits, hosts for which ``listed`` (an
    expression over ``host``) holds are blocked; the cascade over all hosts of the pages answers that.

    A null url, or one without ``://``, has an empty host and path, fits no rule and is allowed unless the
    empty host is listed.  Repeated rows stay; an empty table gives no rows; other columns are ignored.
    """
    url = F.col("url").cast("string")
    parts = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    hosts = parts.select("host").distinct()
    universe = frames.written(hosts.select(F.col("host").alias("key"), F.coalesce(listed, F.lit(False)).alias("listed")), "hosts")
    known = with_membership(parts, "host", universe)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("listed"), "block").otherwise("allow")
    return known.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "listed")
