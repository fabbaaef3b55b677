from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import rows
from fieldkpi.functions import joins
from fieldkpi.operators import dedupe


def key(r: dict) -> tuple:
    return tuple(str(v) for v in r.values())


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_plain_join(spark, how):
    many = spark.range(6000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 0 THEN NULL ELSE id END AS k", "id AS v"
    )
    one = spark.range(4000).selectExpr("id AS k", "id * 2 AS w")
    plain = many.join(one, "k", how)
    spread = joins.spread_join(many, one, "k", how, min_rows=100, salts=8)
    assert sorted(map(key, rows(spread))) == sorted(map(key, rows(plain)))


def test_hot_key_is_spread(spark):
    many = spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "id AS v")
    hot = rows(joins.hot_keys(many, "k", 1000))
    assert hot == [{"k": 7, "_hot": True}]


def test_latest_row_with_ties(frame):
    schema = "id bigint, at timestamp_ntz, note string"
    data = [(1, "2025-01-01", "b"), (1, "2025-01-01", "a"), (1, None, "z"), (2, None, "c")]
    got = {r["id"]: r["note"] for r in rows(dedupe.dedupe_latest(frame(schema, data), ["id"], dedupe.newest("at")))}
    assert got == {1: "a", 2: "c"}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(0, 9)), min_size=1, max_size=20))
def test_dedupe_twice_is_dedupe_once(spark, data):
    df = spark.createDataFrame(data, "k int, at int, v int")
    once = dedupe.dedupe_latest(df, ["k"], dedupe.newest("at"))
    twice = dedupe.dedupe_latest(once, ["k"], dedupe.newest("at"))
    assert sorted(map(key, rows(once))) == sorted(map(key, rows(twice)))
    assert {r["k"] for r in rows(once)} == {k for k, _, _ in data}


def test_dedupe_limits_each_partition_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS at")
    plan = dedupe.dedupe_latest(df, ["k"], dedupe.newest("at"))._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_receivables_by_payload(frame):
    df = frame("raw string, updated_on int", [("{a}", 1), ("{a}", 2), ("{b}", 1)])
    assert sorted((r["raw"], r["updated_on"]) for r in rows(dedupe.receivables(df))) == [("{a}", 2), ("{b}", 1)]
