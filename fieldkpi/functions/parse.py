"""Parsing of text as it comes from reports and nested JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldkpi.functions.expr import col


def lenient_timestamp(c: str | Column) -> Column:
    """Null for anything that is no timestamp; a zone suffix is honoured."""
    return F.try_to_timestamp(F.nullif(F.trim(col(c)), F.lit("")))


def nested_field(json: str | Column, path: str, default: object = None) -> Column:
    """A dotted path into a JSON text, or the default."""
    found = F.get_json_object(col(json), f"$.{path}")
    return found if default is None else F.coalesce(found, F.lit(default))


def parse_number(c: str | Column) -> Column:
    """Money text to a decimal: ``$1,234.50``, ``(12.30)`` is negative, junk is null."""
    text = F.trim(col(c))
    negative = text.rlike(r"^\(.*\)$")
    digits = F.nullif(F.regexp_replace(text, r"[^0-9.\-]", ""), F.lit(""))
    value = digits.try_cast("decimal(24,6)")
    return F.when(negative, -value).otherwise(value)


def parse_rate(c: str | Column) -> Column:
    """``45%`` and ``45`` are 0.45, ``0.45`` stays."""
    value = F.nullif(F.trim(F.regexp_replace(col(c), "%", "")), F.lit("")).try_cast("decimal(18,6)")
    return F.when(value > 1, (value / 100).cast("decimal(18,8)")).otherwise(
        value.cast("decimal(18,8)")
    )


def parse_scaled(c: str | Column, scale: int) -> Column:
    return F.round(parse_number(c), scale)


def parse_whole(c: str | Column) -> Column:
    """Truncates towards zero."""
    return parse_number(c).cast("bigint")


def content_key(*columns: str | Column, natural: Column | None = None) -> Column:
    """60-bit key from the first 15 hex digits of SHA-256 over the ``|``-joined fields.

    Only field values go in, never a position, so the key is the same on every load.
    A natural key wins where it is present.
    """
    fields = [F.coalesce(col(c).cast("string"), F.lit("")) for c in columns]
    digest = F.substring(F.sha2(F.concat_ws("|", *fields), 256), 1, 15)
    key = F.conv(digest, 16, 10).cast("bigint")
    return key if natural is None else F.coalesce(natural.cast("bigint"), key)


def bill_total(amount: str | Column, tax: str | Column, shipping: str | Column) -> Column:
    parts = [F.coalesce(col(c).cast("decimal(18,4)"), F.lit(0)) for c in (amount, tax, shipping)]
    return (parts[0] + parts[1] + parts[2]).cast("decimal(18,4)")


def five_digits(text: str | Column) -> Column:
    return F.nullif(F.regexp_extract(col(text), r"(\d{5})", 1), F.lit(""))


def zip5(address: str | Column) -> Column:
    """First 5-digit run of postalCode, else zip, else the whole address JSON."""
    found = F.coalesce(
        five_digits(F.get_json_object(col(address), "$.postalCode")),
        five_digits(F.get_json_object(col(address), "$.zip")),
        five_digits(address),
    )
    return F.lpad(found, 5, "0")


def zip5_with_point(locations: DataFrame, *, key: str = "id", address: str = "address") -> DataFrame:
    """location_id, zip5 and a point where both coordinates are numbers; no ZIP, no row."""
    lon = F.get_json_object(address, "$.longitude").try_cast("double")
    lat = F.get_json_object(address, "$.latitude").try_cast("double")
    return (
        locations.select(F.col(key).alias("location_id"), zip5(address).alias("zip5"), lon.alias("lon"), lat.alias("lat"))
        .where(F.col("zip5").isNotNull())
        .select(
            "location_id",
            "zip5",
            F.when(
                F.col("lon").isNotNull() & F.col("lat").isNotNull(), F.struct("lon", "lat")
            ).alias("geo_point"),
        )
    )


def zip5_from_lines(lines: str | Column) -> Column:
    """From an array of address lines."""
    return F.lpad(five_digits(F.concat_ws(" ", col(lines))), 5, "0")


def zip5_from_addresses(addresses: str | Column, *, preferred: str = "isPrimary") -> Column:
    """From an array of address structs (postalCode, ``preferred``): the preferred entry
    with a ZIP first, else the first one that has a ZIP."""
    found = F.transform(
        col(addresses),
        lambda a: F.struct(
            F.coalesce(a[preferred], F.lit(False)).alias("first"),
            five_digits(a["postalCode"]).alias("zip"),
        ),
    )
    usable = F.filter(found, lambda a: a["zip"].isNotNull())
    best = F.coalesce(
        F.try_element_at(F.filter(usable, lambda a: a["first"]), F.lit(1)),
        F.try_element_at(usable, F.lit(1)),
    )
    return F.lpad(best["zip"], 5, "0")


def job_type_segment(name: str | Column) -> Column:
    text = F.lower(col(name))
    return (
        F.when(text.like("%comm%"), "COMMERCIAL")
        .when(text.like("%res%"), "RESIDENTIAL")
        .otherwise("OTHER")
    )


def job_type_warranty_category(name: str | Column) -> Column:
    text = F.lower(col(name))
    # Patterns of warranty-like job types.
    patterns = ("%warranty%", "%touch%up%", "%callback%", "%repair%")
    found = F.lit(False)
    for pattern in patterns:
        found = found | text.like(pattern)
    return F.when(found, "Warranty").otherwise("Regular")
