"""Comparison of computed figures with expected ones, and of job lists with each other."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldkpi.functions.constants import CAUTION, CROSS, EXACT, FLAG_RED, MAJOR, MINOR, TICK
from fieldkpi.functions.expr import count_if, money, or_zero, percent, rounded, sum_money
from fieldkpi.functions.frames import union_all


@dataclass(frozen=True)
class Band:
    """Up to ``exact`` a difference is none, up to ``minor`` it is small."""

    exact: float
    minor: float
    inclusive: bool = False

    def status(self, delta: Column) -> Column:
        size = F.abs(delta)
        if self.inclusive:
            return F.when(size <= self.exact, EXACT).when(size <= self.minor, MINOR).otherwise(MAJOR)
        return F.when(size < self.exact, EXACT).when(size < self.minor, MINOR).otherwise(MAJOR)


# How far a figure may be off.
COUNT_BAND = Band(1, 5, inclusive=True)
DOLLAR_BAND = Band(0.01, 100)
MARGIN_BAND = Band(1, 5)
WARRANTY_BAND = Band(0.5, 2)


def _delta(a: str, b: str) -> Column:
    return rounded(F.col(a) - F.col(b))


def variance_by_key(
    actual: DataFrame, expected: DataFrame, key: str, bands: dict[str, Band]
) -> DataFrame:
    """Wide: per expected key and measure the two figures, delta, percentages, status."""
    renamed = actual.select(key, *[F.col(m).alias(f"actual_{m}") for m in bands])
    wanted = expected.select(key, *[F.col(m).alias(f"expected_{m}") for m in bands])
    joined = wanted.join(renamed, key, "left")
    columns: list[Column] = [F.col(key)]
    for m, band in bands.items():
        a, e = f"actual_{m}", f"expected_{m}"
        delta = F.col(a) - F.col(e)
        columns += [
            F.col(e),
            rounded(F.col(a)).alias(a),
            rounded(delta).alias(f"{m}_delta"),
            percent(delta, e).alias(f"{m}_pct"),
            percent(a, e).alias(f"{m}_accuracy"),
            band.status(rounded(delta)).alias(f"{m}_status"),
        ]
    return joined.select(*columns)


def variance_rows(
    actual: DataFrame, expected: DataFrame, keys: Sequence[str], *, band: Band = DOLLAR_BAND
) -> DataFrame:
    """Long: one row per actual key; an absent expectation counts as 0."""
    return (
        actual.join(expected, list(keys), "left")
        .withColumn("expected", F.coalesce("expected", F.lit(0.0)))
        .withColumn("variance", _delta("actual", "expected"))
        .withColumn("variance_percent", percent(F.col("actual") - F.col("expected"), "expected"))
        .withColumn("status", band.status(F.col("variance")))
    )


def market(unit: str | Column) -> Column:
    """A unit's name without its side, so that sales and production units meet."""
    c = F.col(unit) if isinstance(unit, str) else unit
    return F.regexp_replace(c, "-(Sales|Production)$", "")


def by_market(parts: Sequence[DataFrame], unit: str = "business_unit") -> DataFrame:
    """All measures of sales and production units, one row per market.

    Stacked with null padding and reduced per key; a measure comes from one part, with
    one row per market, as in a chain of full outer joins on the derived key.
    """
    keyed = [p.withColumn("market", market(unit)).drop(unit) for p in parts]
    stacked = union_all(keyed, pad=True)
    measures = [c for c in stacked.columns if c != "market"]
    return stacked.groupBy("market").agg(*[F.max(m).alias(m) for m in measures])


def long_comparison(
    actual: DataFrame, expected: DataFrame, key: str, measures: Sequence[str]
) -> DataFrame:
    """Every unit and KPI with expectation, actual, variance, percent and a tick.

    A tick turns to a caution above 1 % and red above 10 %; a missing or zero figure on
    either side is a caution.
    """
    a = actual.select(key, F.inline(_pairs(measures, "actual")))
    e = expected.select(key, F.inline(_pairs(measures, "expected")))
    joined = e.join(a, [key, "kpi"], "left")
    known = F.coalesce((F.col("expected") != 0) & (F.col("actual") != 0), F.lit(False))
    pct = percent(F.col("actual") - F.col("expected"), "expected")
    return joined.select(
        key,
        "kpi",
        "expected",
        "actual",
        F.when(known, _delta("actual", "expected")).alias("variance"),
        F.when(known, pct).alias("variance_percent"),
        F.when(~known, CAUTION)
        .when(F.abs(pct) > 10, FLAG_RED)
        .when(F.abs(pct) > 1, CAUTION)
        .otherwise(TICK)
        .alias("status"),
    )


def _pairs(measures: Sequence[str], label: str) -> Column:
    return F.array(
        *[F.struct(F.lit(m).alias("kpi"), F.col(m).cast("double").alias(label)) for m in measures]
    )


def comparison_summary(rows: DataFrame) -> DataFrame:
    return rows.agg(
        count_if(F.col("status") == TICK).alias("perfect"),
        count_if(F.col("status") == CAUTION).alias("minor"),
        count_if(F.col("status") == FLAG_RED).alias("major"),
    )


# --- job lists ------------------------------------------------------------------------


def missing_and_extra(listed: DataFrame, jobs: DataFrame) -> DataFrame:
    """Listed jobs that are absent or differ, and jobs with revenue that are not listed.

    ``listed``: job_id, revenue; ``jobs``: job_id, revenue.  Reason codes per job.
    """
    joined = listed.select("job_id", F.col("revenue").alias("listed_revenue"), F.lit(True).alias("l")).join(
        jobs.select("job_id", "revenue", F.lit(True).alias("j")), "job_id", "full"
    )
    reason = (
        F.when(F.col("j").isNull(), "Job not found")
        .when(F.col("l").isNull(), F.when(F.col("revenue") > 0, "Not listed"))
        .when(F.col("revenue") == 0, "Job without revenue")
        .when(F.col("revenue") != F.col("listed_revenue"), "Revenue mismatch")
    )
    return joined.select("job_id", "listed_revenue", "revenue", reason.alias("reason")).where(
        F.col("reason").isNotNull()
    )


def impact_totals(issues: DataFrame, listed: DataFrame, jobs: DataFrame) -> DataFrame:
    """Jobs and revenue behind the issues, beside both totals."""
    extra = F.col("reason") == "Not listed"

    def totals(df: DataFrame, label: str, amount: str) -> DataFrame:
        return df.agg(
            F.count("*").alias("job_count"),
            F.round(F.coalesce(sum_money(amount), F.lit(0)), 2).cast("double").alias("total_revenue"),
        ).select(F.lit(label).alias("issue_type"), "*")

    return (
        totals(issues.where(~extra), "Missing", "listed_revenue")
        .unionByName(totals(issues.where(extra), "Extra", "revenue"))
        .unionByName(totals(jobs, "Computed total", "revenue"))
        .unionByName(totals(listed, "Listed total", "revenue"))
    )


def compare_jobs(ours: DataFrame, theirs: DataFrame, *, tolerance: float = 0.01) -> DataFrame:
    """Jobs on one side only or with other labour or materials.

    Both sides: job_id, business_unit, labor, materials.  One-sided jobs count if they
    have any cost.
    """
    left = ours.select(
        "job_id", F.col("business_unit").alias("our_unit"), money("labor").alias("our_labor"),
        money("materials").alias("our_materials"), F.lit(True).alias("o"),
    )
    right = theirs.select(
        "job_id", F.col("business_unit").alias("their_unit"), money("labor").alias("their_labor"),
        money("materials").alias("their_materials"), F.lit(True).alias("t"),
    )
    joined = left.join(right, "job_id", "full")
    both = F.col("o").isNotNull() & F.col("t").isNotNull()
    # A job on their side only counts with its costs, one on ours with their negatives.
    sign = F.when(both, F.lit(1)).otherwise(F.lit(-1))
    labor = ((or_zero("our_labor") - or_zero("their_labor")) * sign).cast("decimal(18,4)")
    materials = ((or_zero("our_materials") - or_zero("their_materials")) * sign).cast("decimal(18,4)")
    ours_cost = (F.col("our_labor") > 0) | (F.col("our_materials") > 0)
    their_cost = (F.col("their_labor") > 0) | (F.col("their_materials") > 0)
    kind = (
        F.when(F.col("t").isNull(), F.when(ours_cost, "DB_ONLY"))
        .when(F.col("o").isNull(), F.when(their_cost, "ST_ONLY"))
        .when((F.abs(labor) > tolerance) | (F.abs(materials) > tolerance), "DIFFERENT")
    )
    return joined.select(
        "job_id",
        F.coalesce("their_unit", "our_unit").alias("business_unit"),
        kind.alias("type"),
        labor.alias("labor_diff"),
        materials.alias("materials_diff"),
    ).where(F.col("type").isNotNull())


def differences_by_unit(differences: DataFrame) -> DataFrame:
    return differences.groupBy("business_unit").agg(
        F.count("*").alias("jobs"),
        F.sum("labor_diff").cast("double").alias("labor_diff"),
        F.sum("materials_diff").cast("double").alias("materials_diff"),
    )


def largest_differences(differences: DataFrame, n: int = 20) -> DataFrame:
    size = F.abs(F.col("labor_diff")) + F.abs(F.col("materials_diff"))
    return differences.orderBy(size.desc(), "job_id").limit(n)


def id_difference(ours: DataFrame, theirs: DataFrame, key: str = "job_id") -> DataFrame:
    """Ids on one side only, each once."""
    a, b = ours.select(key), theirs.select(key)
    return (
        a.subtract(b)
        .withColumn("side", F.lit("ours"))
        .unionByName(b.subtract(a).withColumn("side", F.lit("theirs")))
    )


# --- reports --------------------------------------------------------------------------


def _money_text(c: Column) -> Column:
    return F.concat(F.lit("$"), F.round(c, 2).cast("decimal(38,2)").cast("string"))


def _percent_text(num: Column, den: Column) -> Column:
    return F.concat(_two(percent(num, den)), F.lit("%"))


def _two(c: Column) -> Column:
    return c.cast("decimal(38,2)").cast("string")


def section_report(
    jobs: DataFrame, targets: dict[str, float], *, revenue: str = "revenue", labor: str = "labor"
) -> DataFrame:
    """Section, metric, value: totals of the listed jobs and how far they are off.

    ``jobs``: revenue, labor, po_materials, invoice_materials, return_credits.
    """
    materials = money(
        or_zero("po_materials") + or_zero("invoice_materials") - or_zero("return_credits")
    )
    t = jobs.withColumn("materials", materials).agg(
        F.count("*").alias("n"),
        F.coalesce(sum_money(revenue), F.lit(0)).alias("revenue"),
        F.coalesce(sum_money(labor), F.lit(0)).alias("labor"),
        F.coalesce(sum_money("po_materials"), F.lit(0)).alias("po"),
        F.coalesce(sum_money("invoice_materials"), F.lit(0)).alias("invoice"),
        F.coalesce(F.sum("materials"), F.lit(0)).alias("materials"),
    ).withColumn("profit", F.col("revenue") - F.col("labor") - F.col("materials"))

    def target(name: str) -> Column:
        return F.lit(targets[name]).cast("decimal(18,4)")

    entries = [
        ("Metrics", "Job Count", F.col("n").cast("string")),
        ("Metrics", "Total Revenue", _money_text(F.col("revenue"))),
        ("Metrics", "Total Labor", _money_text(F.col("labor"))),
        ("Metrics", "PO Materials", _money_text(F.col("po"))),
        ("Metrics", "Invoice Materials", _money_text(F.col("invoice"))),
        ("Metrics", "Total Materials", _money_text(F.col("materials"))),
        ("Metrics", "Gross Profit", _money_text(F.col("profit"))),
        ("Metrics", "GPM %", _percent_text(F.col("profit"), F.col("revenue"))),
        ("Variances", "Revenue Variance", _money_text(F.col("revenue") - target("revenue"))),
        ("Variances", "Labor Variance", _money_text(F.col("labor") - target("labor"))),
        ("Variances", "Materials Variance", _money_text(F.col("materials") - target("materials"))),
    ]
    return t.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(s).alias("section"), F.lit(m).alias("metric"), v.alias("value"))
                    for s, m, v in entries
                ]
            )
        )
    )


def tolerance_report(costing: DataFrame, targets: dict[str, tuple[float, float]]) -> DataFrame:
    """Overall figures against (target, tolerance), then the margin of each unit."""
    measures = [
        F.count("*").alias("jobs"),
        sum_money("revenue_subtotal").alias("revenue"),
        sum_money("labor_cost").alias("labor"),
        sum_money("material_cost_net").alias("materials"),
        sum_money("gross_profit").alias("profit"),
    ]
    total = costing.agg(*measures).withColumn("gpm", percent("profit", "revenue"))

    def row(label: str, name: str, value: Column) -> Column:
        goal, tolerance = targets[name]
        value = rounded(value)
        off = rounded(value - F.lit(goal))
        within = F.abs(off) <= tolerance
        return F.struct(
            F.lit("OVERALL").alias("section"),
            F.lit(label).alias("metric"),
            value.alias("computed"),
            F.lit(float(goal)).alias("target"),
            off.alias("variance"),
            F.when(within, TICK).otherwise(CROSS).alias("status"),
        )

    overall = total.select(
        F.inline(
            F.array(
                row("Job Count", "jobs", F.col("jobs")),
                row("Revenue", "revenue", F.col("revenue")),
                row("Labor", "labor", F.col("labor")),
                row("Materials", "materials", F.col("materials")),
                row("GPM %", "gpm", F.col("gpm")),
            )
        )
    )
    units = costing.groupBy("business_unit").agg(*measures).select(
        F.concat(F.lit("BU: "), "business_unit").alias("section"),
        F.lit("GPM %").alias("metric"),
        percent("profit", "revenue").alias("computed"),
        F.lit(None).cast("double").alias("target"),
        F.lit(None).cast("double").alias("variance"),
        F.lit("N/A").alias("status"),
    )
    return overall.unionByName(units)


def window_totals(costing: DataFrame, start: str, end: str, *, units: Sequence[str] = ()) -> DataFrame:
    """Totals of the jobs that start in the window, in the named units."""
    rows = costing.where(
        F.to_date("job_start_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    )
    if units:
        rows = rows.where(F.col("business_unit").isin(*units))
    return rows.agg(
        F.countDistinct("job_id").alias("job_count"),
        F.round(sum_money("revenue_subtotal"), 2).cast("double").alias("total_revenue"),
        F.round(sum_money("labor_cost"), 2).cast("double").alias("total_labor"),
        F.round(sum_money("material_cost_net"), 2).cast("double").alias("total_materials"),
        F.round(sum_money("total_cost"), 2).cast("double").alias("total_costs"),
        percent(sum_money("gross_profit"), sum_money("revenue_subtotal")).alias("gpm_percent"),
    )


def fan_out_totals(parts: Sequence[tuple[DataFrame, str]], jobs: DataFrame) -> DataFrame:
    """What a join of all children would sum to, beside the true sums.

    In such a join each child row repeats once per row combination of the others, so a
    job's sum is multiplied by the other children's row counts.  No row is repeated
    here: sums and counts per job are enough.
    """
    joined = jobs.select(F.col("id").alias("job_id"))
    for df, name in parts:
        rolled = (
            df.where(F.col("job_id").isNotNull())
            .groupBy("job_id")
            .agg(F.sum(name).alias(name), F.count("*").alias(f"n_{name}"))
        )
        joined = joined.join(rolled, "job_id", "left")
    names = [name for _, name in parts]

    def repeated(name: str) -> Column:
        factor = F.lit(1).cast("decimal(12,0)")
        for other in names:
            if other != name:
                factor = factor * F.coalesce(F.col(f"n_{other}"), F.lit(1)).cast("decimal(12,0)")
        return F.sum(F.col(name).cast("decimal(24,4)") * factor.cast("decimal(38,0)"))

    return joined.agg(
        *[F.sum(name).cast("double").alias(f"true_{name}") for name in names],
        *[repeated(name).cast("double").alias(f"joined_{name}") for name in names],
    )


