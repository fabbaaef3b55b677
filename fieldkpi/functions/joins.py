"""Many-to-one joins whose key may be very uneven."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 256
TRACKED_KEYS = 10_000
SALTS = 64


def hot_keys(rows: DataFrame, key: str, min_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with at least ``min_rows`` rows, at most ``MAX_HOT_KEYS`` of them.

    One pass over the key column with a sketch of fixed size; nothing is shuffled by key.
    Which keys it finds decides only how a join is spread, never its result.
    """
    top = rows.where(F.col(key).isNotNull()).select(
        F.expr(f"approx_top_k({key}, {MAX_HOT_KEYS}, {TRACKED_KEYS})").alias("top")
    )
    return (
        top.select(F.inline("top"))
        .where(F.col("count") >= min_rows)
        .select(F.col("item").alias(key), F.lit(True).alias("_hot"))
    )


def spread_join(
    many: DataFrame,
    one: DataFrame,
    key: str,
    how: str = "inner",
    *,
    salt_by: Sequence[str] = (),
    hot: DataFrame | None = None,
    min_rows: int = HOT_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """``many`` joined to ``one`` (unique by key) with hot keys spread over several tasks.

    Rows of a hot key get one of ``salts`` numbers and meet a copy of the key's row that
    carries the same number.  Adaptive execution splits an uneven join by itself where
    both sides come straight from a shuffle; this is for sides that are already
    partitioned by the key, as an aggregate is.

    ``salt_by`` names columns that tell the rows of one key apart; without them the
    position in the scanned file does, so ``many`` should then come from a scan.
    ``hot`` gives keys already looked for in the rows behind an aggregated ``many``.
    """
    hot = F.broadcast(hot_keys(many, key, min_rows) if hot is None else hot)
    mark = F.xxhash64(*salt_by) if salt_by else F.monotonically_increasing_id()
    number = F.pmod(mark, F.lit(salts)).cast("int")
    left = many.join(hot, key, "left").withColumn(
        "_salt", F.when(F.col("_hot") | F.col(key).isNull(), number).otherwise(0)
    )
    right = one.join(hot, key, "left").withColumn(
        "_salt",
        F.explode(
            F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        ),
    )
    return left.drop("_hot").join(right.drop("_hot"), [key, "_salt"], how).drop("_salt")
