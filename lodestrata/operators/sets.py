"""Deduplication, set differences and unions that keep what must be kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.operators.concentration import first_per_key
from lodestrata.skew import salted_join


def dedupe_keep_blank(df: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """The first row of each key; rows with a blank key all stay."""
    keyed = df.withColumn("__key", F.coalesce(key, F.lit("")))
    once = first_per_key(keyed.filter("__key <> ''"), "__key", order)
    return keyed.filter("__key = ''").unionByName(once).drop("__key")


def new_rows(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't done yet; rows without a key aren't."""
    from lodestrata.operators.joins import _spread

    return salted_join(df, done.select(key).distinct(), [key], _spread(df, key), "left_anti")


def changed_values(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """Keys in both runs whose value differs; null differs from a value."""
    a = old.groupBy(key).agg(F.min(value).alias("before"))
    b = new.groupBy(key).agg(F.min(value).alias("after"))
    return a.join(b, key).filter(~F.col("before").eqNullSafe(F.col("after")))


def key_difference(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys of either side with where they are: both, only_old, only_new."""
    a = old.select(key).distinct().withColumn("__a", F.lit(1))
    b = new.select(key).distinct().withColumn("__b", F.lit(1))
    side = F.when(F.col("__a").isNull(), "only_new").when(F.col("__b").isNull(), "only_old").otherwise("both")
    return a.join(b, key, "full").select(key, side.alias("side"))


def merge_sites(df: DataFrame, key: str, host: str, order: str) -> DataFrame:
    """The hosts of each site, one row per key and host: its rows, and the order in which it first appears.

    In this form a portal with any number of hosts is no large value; ordered by ``first`` it is the site's host list."""
    return df.groupBy(key, host).agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n_rows"))


def explode_or_blank(df: DataFrame, keep: list[str], items: Column, name: str) -> DataFrame:
    """One row per item, or one with a blank item where there is none."""
    return df.select(*keep, F.explode_outer(F.filter(items, lambda x: x != "")).alias(name)).withColumn(name, F.coalesce(name, F.lit("")))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All frames by column name; columns that some lack are null there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def ordered_distinct(df: DataFrame, by: list[str], value: str, order: list[str]) -> DataFrame:
    """``by``.., ``value``, ``position`` from 1: each group's distinct values in the order of their first row; null is none.

    Positions are counted over a group's distinct values, in slices that different tasks sort."""
    from lodestrata.operators.ranking import numbers_per_group

    first = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.min(F.struct(*order)).alias("__first"))
    return numbers_per_group(first, by, [F.col("__first"), F.col(value)], "position").select(*by, value, "position")


def side_by_side(a: DataFrame, b: DataFrame, index: str) -> DataFrame:
    """The columns of two frames on one row number; rows that one of them lacks are null there. Names that both have get
    ``_2`` in the second."""
    names = {c: f"{c}_2" for c in b.columns if c != index and c in a.columns}
    return a.join(b.withColumnsRenamed(names), index, "full")
