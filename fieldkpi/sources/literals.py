"""Inline literal relations: allow-lists, expected values, id lists."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_relation(
    spark: SparkSession, schema: str, rows: Iterable[Sequence[object]]
) -> DataFrame:
    """Rows given in code, as constants of the plan: their size is known to the
    optimizer and no job ships them.  ``schema`` is DDL like ``"name string, goal double"``."""
    fields = T._parse_datatype_string(schema).fields
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(fields, row, strict=True)])
        for row in rows
    ]
    if not structs:
        return spark.createDataFrame([], T.StructType(fields))
    return spark.sql("SELECT 1").select(F.inline(F.array(*structs)))
