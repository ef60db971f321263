"""Joins that hold when one key has a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 16
#: A side whose files, or whose plan's estimate, are at most so many bytes is broadcast as it is.
SMALL_BYTES = 256 << 10
#: Up to so many times the planner's own limit, columns that are dropped later may bring the copies' estimate under it.
UNSURE = 32


def planned_bytes(df: DataFrame) -> int:
    """The planner's estimate of a frame's size: its files' bytes, or more where it can't know better."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def salted_join(big: DataFrame, small: DataFrame, on: list[str], spread_by: str | list[str], how: str = "inner", salts: int = SALTS) -> DataFrame:
    """``big`` joined to ``small`` on ``on``, each key of ``big`` spread over ``salts`` tasks by a hash of ``spread_by``.

    A ``small`` of at most ``SMALL_BYTES`` is broadcast, without salts. Else it is repeated once per salt; the planner, whose
    estimate doesn't see that it is, is kept from broadcasting the copies up to ``UNSURE`` times its limit, and beyond that
    does it only by their measured size. Null keys of an outer join are spread as well.
    """
    limit = int(big.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    size = planned_bytes(small)
    if size <= min(SMALL_BYTES, limit) and how in ("inner", "left", "left_anti", "left_semi"):
        return big.join(F.broadcast(small), on, how)
    spread = big.withColumn("__salt", F.pmod(F.xxhash64(*([spread_by] if isinstance(spread_by, str) else spread_by)), F.lit(salts)).cast("int"))
    copies = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    if size <= UNSURE * limit:
        copies = copies.hint("merge")
    return spread.join(copies, [*on, "__salt"], how).drop("__salt")
