from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory: pytest.TempPathFactory) -> SparkSession:
    session = (
        SparkSession.builder.master("local[4]")
        .appName("fieldkpi-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark: SparkSession):
    """Rows to a DataFrame; ``timestamp_ntz`` columns take ISO text."""

    def build(schema: str, rows: list[tuple]) -> DataFrame:
        parts = [p.strip().split(None, 1) for p in schema.split(", ")]
        times = [i for i, (_, t) in enumerate(parts) if t == "timestamp_ntz"]
        fixed = [
            tuple(datetime.fromisoformat(v) if i in times and v is not None else v for i, v in enumerate(r))
            for r in rows
        ]
        plain = ", ".join(f"{n} {'double' if t.startswith('decimal') else t}" for n, t in parts)
        df = spark.createDataFrame(fixed, plain)
        return df.selectExpr(*[f"CAST({n} AS {t}) AS {n}" for n, t in parts])

    return build


def rows(df: DataFrame) -> list[dict]:
    return [r.asDict() for r in df.collect()]


def by(df: DataFrame, *keys: str) -> dict:
    out = {}
    for r in rows(df):
        k = tuple(r[x] for x in keys)
        out[k if len(keys) > 1 else k[0]] = r
    return out
