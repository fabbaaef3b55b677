"""Schema inference, validation, drift and coercion over landed JSON records.

All checks look at every row: the records are profiled once into one row per field,
and the checks compare that profile with the registered schema.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldkpi.sources.literals import literal_relation

# field -> (type, required)
Registry = dict[str, tuple[str, bool]]

#: New fields that a registry takes in at once.
MOST_FIELDS = 10_000

# The type names of a registered schema.
TYPES: dict[str, T.DataType] = {
    "INT64": T.LongType(),
    "FLOAT64": T.DoubleType(),
    "BOOL": T.BooleanType(),
    "STRING": T.StringType(),
    "TIMESTAMP": T.TimestampType(),
    "DATE": T.DateType(),
    "JSON": T.StringType(),
}


ARRAY = re.compile(r"ARRAY<(\w+)>")


def data_type(kind: str) -> T.DataType:
    """The column type of a registered type name; unknown names are text."""
    element = ARRAY.fullmatch(kind)
    return T.ArrayType(data_type(element[1])) if element else TYPES.get(kind, T.StringType())


def _value_type(value: Column) -> Column:
    kind = F.schema_of_variant(value)
    text = F.try_variant_get(value, "$", "string")
    return (
        F.when(kind == "VOID", F.lit(None).cast("string"))
        .when(kind == "BOOLEAN", "BOOL")
        .when(kind == "BIGINT", "INT64")
        .when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), "FLOAT64")
        .when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), "JSON")
        .when(text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"), "TIMESTAMP")
        .when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), "DATE")
        .otherwise("STRING")
    )


def _kinds(value: Column) -> Column:
    """The types seen in one value: its own, or of an array those of its elements (of an empty one ``ARRAY<>``)."""
    elements = F.try_variant_get(value, "$", "array<variant>")
    inner = F.array_distinct(F.transform(elements, lambda x: F.concat(F.lit("ARRAY<"), F.coalesce(_value_type(x), F.lit("")), F.lit(">"))))
    own = F.when(F.size(inner) > 0, F.sort_array(inner)).otherwise(F.array(F.lit("ARRAY<>")))
    scalar = _value_type(value)
    return F.when(F.schema_of_variant(value).startswith("ARRAY"), own).when(scalar.isNotNull(), F.array(scalar))


def _joined(kinds: Column) -> Column:
    """The least type that holds all of a set: numbers widen, days become times, any other mixture is text."""

    def only(*names: str) -> Column:
        return F.size(F.array_except(kinds, F.array(*[F.lit(n) for n in names]))) == 0

    return (
        F.when(F.size(kinds) == 0, "STRING")
        .when(F.size(kinds) == 1, F.get(kinds, 0))
        .when(only("INT64", "FLOAT64"), "FLOAT64")
        .when(only("DATE", "TIMESTAMP"), "TIMESTAMP")
        .otherwise("STRING")
    )


def profile(records: DataFrame, *, record: str = "record", depth: int = 1) -> DataFrame:
    """Per field: inferred type, rows that have it, rows where it is null.

    Types of all rows are joined, in partial sets on the executors: mixed whole and broken numbers are FLOAT64, days
    and times TIMESTAMP, any other mixture STRING.  An array has the joined type of all its elements in all
    rows (arrays and objects within it are JSON; if all are empty it is ``ARRAY<STRING>``).  With a ``depth`` above 1
    the fields of objects come too, as ``object.field``.
    """
    spark = records.sparkSession
    parsed = records.select(F.lit("").alias("at"), F.try_parse_json(record).alias("v"))
    levels = []
    for _ in range(depth):
        own = parsed.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
        level = own.select(F.concat("at", "key").alias("field"), F.col("value").alias("v"))
        levels.append(level)
        parsed = level.where(F.schema_of_variant("v").startswith("OBJECT")).select(F.concat("field", F.lit(".")).alias("at"), "v")
    fields = levels[0]
    for level in levels[1:]:
        fields = fields.unionByName(level)
    seen = fields.select("field", _kinds(F.col("v")).alias("kinds"))
    counts = seen.groupBy("field").agg(
        F.count("*").alias("n_present"),
        F.count_if(F.col("kinds").isNull()).alias("n_null"),
        F.array_distinct(F.flatten(F.collect_set("kinds"))).alias("kinds"),
    )
    is_array = F.exists("kinds", lambda k: k.startswith("ARRAY"))
    mixed = is_array & F.exists("kinds", lambda k: ~k.startswith("ARRAY"))
    inner = F.transform("kinds", lambda k: F.regexp_extract(k, "ARRAY<(.*)>", 1))
    element = _joined(F.filter(inner, lambda k: k != ""))
    inferred = F.when(mixed, "STRING").when(is_array, F.concat(F.lit("ARRAY<"), element, F.lit(">"))).otherwise(_joined(F.col("kinds")))
    return counts.select("field", inferred.alias("inferred_type"), "n_present", "n_null")


def _registered(records: DataFrame, registry: Registry) -> DataFrame:
    rows = [(f, t, r) for f, (t, r) in registry.items()]
    return literal_relation(
        records.sparkSession, "field string, expected_type string, required boolean", rows
    )


def validate(records: DataFrame, registry: Registry, *, record: str = "record") -> DataFrame:
    """Required fields absent or null in some row are errors; unknown fields and other
    types are warnings."""
    total = records.agg(F.count("*").alias("n_rows")).scalar()
    found = profile(records, record=record)
    joined = (
        _registered(records, registry)
        .join(found, "field", "full")
        .withColumn("n_missing", total - F.coalesce("n_present", F.lit(0)) + F.coalesce("n_null", F.lit(0)))
    )
    issue = (
        F.when(F.col("expected_type").isNull(), "unknown_field")
        .when(F.col("required") & (F.col("n_missing") > 0), "required_missing")
        .when(
            F.col("inferred_type").isNotNull() & (F.col("inferred_type") != F.col("expected_type")),
            "type_mismatch",
        )
    )
    return (
        joined.withColumn("issue", issue)
        .where(F.col("issue").isNotNull())
        .select(
            "field",
            F.when(F.col("issue") == "required_missing", "error").otherwise("warning").alias("level"),
            "issue",
            "expected_type",
            "inferred_type",
            "n_missing",
        )
    )


def drift(records: DataFrame, registry: Registry, *, record: str = "record") -> DataFrame:
    """Fields that the registry does not know, with their inferred types."""
    return profile(records, record=record).join(
        _registered(records, registry).select("field"), "field", "left_anti"
    )


def extended(registry: Registry, new_fields: DataFrame) -> Registry:
    """The registry with drifted fields added as optional.  One row per field comes back."""
    found = {r["field"]: (r["inferred_type"], False) for r in new_fields.limit(MOST_FIELDS + 1).collect()}
    if len(found) > MOST_FIELDS:
        raise ValueError(f"more than {MOST_FIELDS} new fields: keys of these records are data, not names")
    return registry | {f: t for f, t in found.items() if f not in registry}


def coerce(rows: DataFrame, registry: Registry) -> DataFrame:
    """Registered columns cast to their types; a value that does not fit becomes null."""

    def cast(name: str) -> Column:
        if name not in registry:
            return F.col(name)
        kind = registry[name][0]
        if kind == "INT64":
            return F.floor(F.col(name).try_cast("double")).cast("bigint").alias(name)
        if ARRAY.fullmatch(kind) and rows.schema[name].dataType == T.StringType():
            return F.from_json(F.col(name), data_type(kind)).alias(name)
        return F.col(name).try_cast(data_type(kind)).alias(name)

    return rows.select(*[cast(c) for c in rows.columns])


def table_schema(registry: Registry) -> T.StructType:
    return T.StructType(
        [
            T.StructField(name, data_type(kind), nullable=not required)
            for name, (kind, required) in registry.items()
        ]
    )
