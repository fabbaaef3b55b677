"""The registry of named queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fieldkpi.plans import oracle
from fieldkpi.plans.domain import Domain

Plan = Callable[[Domain], DataFrame]

PLANS: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, **extra: str) -> Callable[[Plan], Plan]:
    """Register a plan; ``sql`` may name any domain table of the oracle module."""

    def register(plan: Plan) -> Plan:
        if name in PLANS:
            raise ValueError(f"query {name} registered twice")
        PLANS[name] = plan
        if sql is not None:
            ORACLES[name] = oracle.sql(sql, **extra)
        return plan

    return register


def runnable(name: str) -> Callable[[SparkSession, str], DataFrame]:
    plan = PLANS[name]
    return lambda spark, sf_dir: plan(Domain(spark, sf_dir))
