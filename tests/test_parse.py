from __future__ import annotations

from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from fieldkpi.functions import expr, parse


def values(frame, texts, column):
    df = frame("i int, t string", list(enumerate(texts)))
    return [r["v"] for r in rows(df.select("i", column.alias("v")).orderBy("i"))]


def test_number_text(frame):
    texts = ["$1,234.50", "(12.30)", " ( 5 ) ", "abc", "", None, "-7", "1 000", "1.2.3", "$ 0"]
    got = values(frame, texts, parse.parse_number("t").cast("double"))
    assert got == [1234.5, -12.3, -5.0, None, None, None, -7.0, 1000.0, None, 0.0]


def test_rate_text(frame):
    got = values(frame, ["45%", "45", "0.45", "1", "", "x", None, "1.5%"], parse.parse_rate("t").cast("double"))
    assert got == [0.45, 0.45, 0.45, 1.0, None, None, None, 0.015]


def test_whole_and_scaled(frame):
    assert values(frame, ["-1.9", "1.9", "x"], parse.parse_whole("t")) == [-1, 1, None]
    assert values(frame, ["1.005", "-2.345"], parse.parse_scaled("t", 2).cast("double")) == [1.01, -2.35]


def test_lenient_timestamp(frame):
    texts = ["2025-08-18T06:59:59Z", "2025-08-18", "soon", "", None, "2025-08-18T00:00:00-07:00"]
    got = values(frame, texts, F.date_format(parse.lenient_timestamp("t"), "yyyy-MM-dd HH:mm:ss"))
    assert got == ["2025-08-18 06:59:59", "2025-08-18 00:00:00", None, None, None, "2025-08-18 07:00:00"]


def test_nested_field_default(frame):
    texts = ['{"a":{"b":3}}', '{"a":{}}', "no json", None]
    assert values(frame, texts, parse.nested_field("t", "a.b", "0")) == ["3", "0", "0", "0"]


@pytest.mark.parametrize(
    ("address", "zip5"),
    [
        ('{"postalCode":"85001-1234","zip":"99999"}', "85001"),
        ('{"postalCode":"n/a","zip":"00501"}', "00501"),
        ('{"street":"Unit 90210 North"}', "90210"),
        ('{"city":"none"}', None),
        (None, None),
    ],
)
def test_zip5(frame, address, zip5):
    assert values(frame, [address], parse.zip5("t")) == [zip5]


def test_zip_point_and_missing_zip(frame):
    df = frame(
        "id bigint, address string",
        [
            (1, '{"zip":"85001","longitude":"-112.5","latitude":"33.25"}'),
            (2, '{"zip":"85002","longitude":"west","latitude":"33"}'),
            (3, '{"city":"none"}'),
        ],
    )
    got = {r["location_id"]: r for r in rows(parse.zip5_with_point(df))}
    assert set(got) == {1, 2}
    assert got[1]["geo_point"].lon == -112.5
    assert got[2]["geo_point"] is None


def test_content_key_ignores_nothing_but_position(frame):
    df = frame("a string, b bigint, n bigint", [("x", 1, None), ("x", 1, None), ("x", 2, None), (None, 1, 9)])
    got = [r["k"] for r in rows(df.select(parse.content_key("a", "b", natural=F.col("n")).alias("k")))]
    assert got[0] == got[1] != got[2]
    assert got[3] == 9
    assert all(0 <= k < 2**60 for k in got)


def test_local_day_boundary(frame):
    df = frame("t timestamp_ntz", [("2025-08-18 06:59:59",), ("2025-08-18 07:00:00",), (None,)])
    got = [r["d"] for r in rows(df.select(expr.local_date("t").alias("d")))]
    assert got == [date(2025, 8, 17), date(2025, 8, 18), None]
    inside = df.where(expr.local_day_range("t", "2025-08-18", "2025-08-18")).count()
    assert inside == 1


@settings(max_examples=5, deadline=None)
@given(hours=st.lists(st.integers(0, 24 * 40), min_size=1, max_size=30))
def test_local_range_equals_local_date(spark, hours):
    df = spark.createDataFrame([(h,) for h in hours], "h int").selectExpr(
        "TIMESTAMP_NTZ'2025-03-01 00:30:00' + make_dt_interval(0, h) AS t"
    )
    by_range = df.where(expr.local_day_range("t", "2025-03-05", "2025-03-09")).count()
    by_date = df.where(expr.local_date("t").between("2025-03-05", "2025-03-09")).count()
    assert by_range == by_date


def test_weeks(frame):
    df = frame("d date", [(date(2025, 8, 17),), (date(2025, 8, 18),), (date(2025, 8, 23),)])
    got = rows(df.select(expr.monday_week("d").alias("m"), expr.sunday_week("d").alias("s")))
    assert [r["m"] for r in got] == [date(2025, 8, 11), date(2025, 8, 18), date(2025, 8, 18)]
    assert [r["s"] for r in got] == [date(2025, 8, 17)] * 3


def test_ratio_of_zero(frame):
    df = frame("a double, b double", [(1.0, 0.0), (1.0, None), (1.0, 4.0)])
    got = rows(df.select(expr.ratio("a", "b").alias("r"), expr.percent("a", "b").alias("p")))
    assert [(r["r"], r["p"]) for r in got] == [(None, None), (None, None), (0.25, 25.0)]


def test_job_type_words(frame):
    texts = ["ESTIMATE-COMM-EXT", "Estimate-RES-INT", "Touch up", "Callback", None]
    assert values(frame, texts, parse.job_type_segment("t")) == [
        "COMMERCIAL", "RESIDENTIAL", "OTHER", "OTHER", "OTHER",
    ]
    assert values(frame, texts[:4], parse.job_type_warranty_category("t")) == [
        "Regular", "Regular", "Warranty", "Warranty",
    ]
