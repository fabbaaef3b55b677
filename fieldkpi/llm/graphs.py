"""Connected components of links, by stars that shrink until each component is one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkpi.llm import frames


def _lowest(pairs: DataFrame, label: str, rows: int) -> DataFrame:
    """(u, low) of every u; written, so that the join that follows deals both sides and can split a frequent u."""
    return frames.written(pairs.groupBy("u").agg(F.min("v").alias("low")), label, rows)


def _stars(edges: DataFrame) -> bool:
    """True if every u has one link and no v has one of its own: no turn would change such links."""
    ends = [edges.select(F.col(c).alias("id"), F.lit(int(c == "u")).alias("up"), F.lit(int(c == "v")).alias("down")) for c in ("u", "v")]
    degrees = ends[0].unionByName(ends[1]).groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not degrees.where("up > 1 OR (up > 0 AND down > 0)").count()


def components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """(id, component): the smallest id reachable, for every id of the links (a, b) that is not itself the smallest.

    Each turn links every node's larger neighbours to its smallest one, then its smaller ones likewise.  A node
    with many neighbours is only ever summed (its smallest neighbour) and joined, never gathered.  Links with
    a null, and of an id with itself, are ignored; without links there are no rows.  ``rows``: a bound on the links, if
    known.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = frames.written(edges, "links", rows)
    most = 2 * edges.count()  # a turn makes no more of them
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both.join(_lowest(both, "large", most), "u").where("v > u")
        edges = frames.written(near.select(F.col("v").alias("u"), F.least("u", "low").alias("v")).distinct(), "large-star", most)
        low = _lowest(edges, "small", most)
        near = edges.join(low, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        edges = frames.written(near.unionByName(low.select("u", F.col("low").alias("v"))).distinct(), "small-star", most)
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))


def extended(joined: DataFrame, links: DataFrame) -> DataFrame:
    """``components`` of the links that gave ``joined`` and of further ones: only what these join is followed anew."""
    one, two = (joined.select(F.col("id").alias(c), F.col("component").alias(f"of_{c}")) for c in ("a", "b"))
    named = links.join(one, "a", "left").join(two, "b", "left")
    more = components(named.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")), links.count())
    if more.isEmpty():
        return joined
    moved = more.select(F.col("id").alias("component"), F.col("component").alias("now"))
    moved = joined.join(moved, "component", "left").select("id", F.coalesce("now", "component").alias("component"))
    return frames.written(moved.unionByName(more), "components", joined.count() + more.count())
