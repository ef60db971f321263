"""Rankings, caps and samples. Ties always break by a stated key.

Top lists are ``orderBy(...).limit(k)``: every task keeps its own k. Caps per group first rank inside slices of the group
that different tasks hold, so that a group with a third of all rows sends at most ``slices`` times its cap to one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(k)


def cap_per_group(df: DataFrame, group: list[str], order: list[Column], cap: int, slices: int = 32, spread_by: str | None = None) -> DataFrame:
    """The first ``cap`` rows of each group in ``order``, which must be total; with ``__rank`` from 1."""
    key = F.pmod(F.xxhash64(spread_by) if spread_by else F.xxhash64(*df.columns), F.lit(slices))
    part = df.withColumn("__slice", key)
    own = F.row_number().over(Window.partitionBy(*group, "__slice").orderBy(*order))
    few = part.withColumn("__rank", own).filter(F.col("__rank") <= cap)
    return few.withColumn("__rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col("__rank") <= cap).drop("__slice")


def stratified_sample(df: DataFrame, strata: list[str], id_col: str, per_stratum: int, seed: int) -> DataFrame:
    """At most ``per_stratum`` rows of each stratum, those with the smallest hash of seed and id."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    return cap_per_group(df.withColumn("__h", h), strata, [F.col("__h"), F.col(id_col)], per_stratum, spread_by=id_col).drop("__h", "__rank")


def fair_cap(df: DataFrame, group: str, order: str, cap: int) -> DataFrame:
    """``cap`` rows in turns: the first of every group, then the second, groups in order of their first row."""
    few = cap_per_group(df, [group], [F.col(order)], cap, spread_by=order)
    seen = few.filter("__rank = 1").select(group, F.col(order).alias("__seen"))
    return few.join(seen, group).orderBy("__rank", "__seen").limit(cap).drop("__seen").withColumnRenamed("__rank", "turn")


def page_batches(df: DataFrame, order: str, size: int) -> DataFrame:
    """Consecutive batches of ``size`` rows by a dense whole-number order column."""
    return df.withColumn("batch", F.floor(F.col(order) / size))


def dense_numbers(df: DataFrame, order: list[str], name: str = "number") -> DataFrame:
    """Rows numbered from 0 in order, without gathering them in one task: range partitions are counted first."""
    from lodestrata.lineage import cut

    parts = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id() % F.lit(1 << 33)))
    sizes = parts.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    offset = F.coalesce(F.sum("__size").over(Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("__part", offset.alias("__start"))
    return parts.join(F.broadcast(starts), "__part").withColumn(name, F.col("__start") + F.col("__at")).drop("__part", "__at", "__start")


def numbers_per_group(df: DataFrame, group: list[str], order: list[Column], name: str) -> DataFrame:
    """Rows numbered from 1 within their group, in an order that is total; no group is sorted in one task.

    The rows are range-partitioned by group and order, counted per partition and group, and each partition starts where the
    ones before it end; those counts, at most one per partition and group that crosses it, are all that meets."""
    from lodestrata.lineage import cut

    keys = [F.col(g).alias(f"__g{i}") for i, g in enumerate(group)] + [c.alias(f"__o{i}") for i, c in enumerate(order)]
    names = [f"__g{i}" for i in range(len(group))] + [f"__o{i}" for i in range(len(order))]
    at = df.select("*", *keys).repartitionByRange(*names).sortWithinPartitions(*names).withColumn("__part", F.spark_partition_id())
    parts = cut(at.withColumn("__n", F.row_number().over(Window.partitionBy("__part", *names[: len(group)]).orderBy(*names[len(group) :]))))
    sizes = parts.groupBy("__part", *names[: len(group)]).agg(F.count(F.lit(1)).alias("__size"))
    before = F.sum("__size").over(Window.partitionBy(*names[: len(group)]).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("__part", *[F.col(n).alias(f"{n}s") for n in names[: len(group)]], F.coalesce(before, F.lit(0)).alias("__start")).filter("__start > 0").withColumnRenamed("__part", "__parts")
    same = F.col("__part") == F.col("__parts")
    for n in names[: len(group)]:
        same = same & F.col(n).eqNullSafe(F.col(f"{n}s"))
    return parts.join(starts, same, "left").withColumn(name, F.coalesce("__start", F.lit(0)) + F.col("__n")).select(*df.columns, name)


def quota_left(log: DataFrame, time: str, as_of: Column, quota: int) -> DataFrame:
    """One row: calls ``used`` on the day of ``as_of``, calls ``left`` of the quota; a new day starts with all of it."""
    used = F.count_if(F.coalesce(F.to_date(time) == F.to_date(as_of), F.lit(False)))
    return log.agg(used.alias("used")).select("used", F.greatest(F.lit(0), F.lit(quota) - F.col("used")).cast("bigint").alias("left"))


def best_candidate(df: DataFrame, key: str, value: str, score: str, rank: str, least: float) -> DataFrame:
    """Per key the candidate with the best score at or above ``least``; of equal ones the one ranked first."""
    return df.filter(F.col(score) >= least).groupBy(key).agg(F.max_by(value, F.struct(F.col(score), -F.col(rank))).alias(value), F.max(score).alias(score))


def quota_cut(df: DataFrame, priority: list[Column], quota: int) -> DataFrame:
    """The ``quota`` rows that come first."""
    return df.orderBy(*priority).limit(max(0, quota))
