"""Named queries over the test tables; importing this package registers all of them."""

from fieldkpi.plans.catalog import ORACLES, PLANS, runnable
from fieldkpi.plans import checks, dims_dedupe, ingest, kpis, stage_marts  # noqa: F401

__all__ = ["ORACLES", "PLANS", "runnable"]
