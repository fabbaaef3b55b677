"""Small helpers on whole DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(frames: Sequence[DataFrame], *, pad: bool = False) -> DataFrame:
    """All rows, columns matched by name; with ``pad`` absent columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=pad), frames)


def labelled_rows(
    totals: DataFrame, label: str, entries: Sequence[tuple[str, dict[str, Column]]]
) -> DataFrame:
    """One-row totals turned into one row per entry."""
    structs = [
        F.struct(F.lit(name).alias(label), *[c.alias(k) for k, c in columns.items()])
        for name, columns in entries
    ]
    return totals.select(F.inline(F.array(*structs)))
