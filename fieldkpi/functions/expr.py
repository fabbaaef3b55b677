"""Column expressions used across operators.  All stay inside Catalyst."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldkpi.functions.constants import BUSINESS_TZ

MONEY = "decimal(18,4)"
ROUNDING = "decimal(38,6)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column) -> Column:
    """Exact money: sums of it do not depend on the order of the rows."""
    return col(c).cast(MONEY)


def sum_money(c: str | Column) -> Column:
    return F.sum(money(c))


def sum_if(condition: Column, c: str | Column) -> Column:
    return F.sum(F.when(condition, money(c)).otherwise(F.lit(0).cast(MONEY)))


def or_zero(c: str | Column) -> Column:
    return F.coalesce(money(c), F.lit(0).cast(MONEY))


def double(c: str | Column) -> Column:
    return col(c).cast("double")


def ratio(num: str | Column, den: str | Column) -> Column:
    """num / den as a double; null where the denominator is zero or null."""
    return F.try_divide(double(num), double(den))


def rounded(c: Column, scale: int = 2) -> Column:
    """Half-up rounding; done on a decimal since rounding doubles is engine-specific."""
    return F.round(c.cast(ROUNDING), scale).cast("double")


def percent(num: str | Column, den: str | Column, scale: int = 2) -> Column:
    return rounded(ratio(num, den) * 100.0, scale)


def dollars(c: str | Column, scale: int = 2) -> Column:
    """A money sum for output: rounded to cents."""
    return F.round(col(c), scale).cast("double")


def local_time(ts: str | Column, tz: str = BUSINESS_TZ) -> Column:
    """UTC wall clock (zoneless) to the business zone's wall clock."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), col(ts).cast("timestamp_ntz"))


def local_date(ts: str | Column, tz: str = BUSINESS_TZ) -> Column:
    return F.to_date(local_time(ts, tz))


def utc_midnight(day: date | str) -> Column:
    return F.lit(str(day)).cast("timestamp_ntz")


def day_range(ts: str | Column, start: date | str, end: date | str) -> Column:
    """start <= UTC day of ts <= end, on the bare column so that scans can skip files."""
    first, last = _day(start), _day(end)
    return (col(ts) >= utc_midnight(first)) & (col(ts) < utc_midnight(last + timedelta(days=1)))


def local_day_range(
    ts: str | Column, start: date | str, end: date | str, tz: str = BUSINESS_TZ
) -> Column:
    """start <= business day of ts <= end; the zone shift is applied to the two literals."""
    return (col(ts) >= _local_midnight(_day(start), tz)) & local_day_until(ts, end, tz)


def local_day_until(ts: str | Column, end: date | str, tz: str = BUSINESS_TZ) -> Column:
    """Business day of ts <= end."""
    return col(ts) < _local_midnight(_day(end) + timedelta(days=1), tz)


def _local_midnight(day: date, tz: str) -> Column:
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), utc_midnight(day))


def monday_week(day: str | Column) -> Column:
    return F.to_date(F.date_trunc("week", col(day)))


def sunday_week(day: str | Column) -> Column:
    return F.date_sub(col(day), F.dayofweek(col(day)) - 1)


def month_start(day: str | Column) -> Column:
    return F.to_date(F.date_trunc("month", col(day)))


def count_if(condition: Column) -> Column:
    return F.count_if(condition)


def contains_ci(c: str | Column, needle: str) -> Column:
    return F.lower(col(c)).like(f"%{needle.lower()}%")


def is_test_name(c: str | Column) -> Column:
    """A null name is not a test name."""
    return contains_ci(F.coalesce(col(c), F.lit("")), "test")


def ends_with(c: str | Column, suffix: str) -> Column:
    return col(c).like(f"%{suffix}")


def json_items(items: str | Column, fields: str) -> Column:
    """A JSON array of objects as an array of structs; null stays null."""
    return F.from_json(col(items), f"array<struct<{fields}>>")


def as_timestamp(value: datetime | str) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


def _day(value: date | str) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)
