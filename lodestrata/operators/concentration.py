"""Concentration of rows on keys: Herfindahl-Hirschman index, shares, coverage, top keys, modal labels.

Counts are aggregated with map-side combining first; everything after works on one row per key, so a key that holds a
third of all rows costs one partial row per map task.

Defined results: null and blank keys count in the sample but not as valid; equal counts are ordered by key; an empty
group has an index of 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.bands import coverage_band, hhi_band, percent
from lodestrata.functions.cells import strip

MIN_RELIABLE = 10


def _valid(key: Column) -> Column:
    return F.nullif(strip(key.cast("string")), F.lit(""))


def key_counts(df: DataFrame, key: str, by: list[str] | None = None) -> DataFrame:
    """``by``.., ``key`` (trimmed text, null where not valid), ``n``."""
    return df.groupBy(*(by or []), _valid(F.col(key)).alias("key")).agg(F.count(F.lit(1)).alias("n"))


def hhi(df: DataFrame, key: str, by: list[str] | None = None) -> DataFrame:
    """The index per group: sum of squared percentage shares, 0 to 10000."""
    return summary(df, key, by).select(*(by or []), "hhi")


def summary(df: DataFrame, key: str, by: list[str] | None = None, min_valid: int = 0) -> DataFrame:
    """Per group: sample size, valid rows, coverage and its band, distinct keys, index and its band, whether it is reliable."""
    by = by or []
    counts = key_counts(df, key, by)
    n = F.when(F.col("key").isNotNull(), F.col("n"))
    agg = counts.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_total"), F.coalesce(F.sum(n), F.lit(0)).alias("n_valid"),
        F.count("key").alias("n_keys"), F.sum(n.cast("double") * n).alias("__squares"),
    )
    index = F.when(F.col("n_valid") > 0, F.round(10000.0 * F.col("__squares") / (F.col("n_valid").cast("double") * F.col("n_valid")), 1)).otherwise(F.lit(0.0))
    out = agg.withColumn("coverage_pct", percent(F.col("n_valid"), F.col("n_total"))).withColumn("hhi", index)
    return out.filter(F.col("n_valid") >= min_valid).select(
        *by, "n_total", "n_valid", "coverage_pct", coverage_band(F.col("coverage_pct")).alias("coverage"), "n_keys", "hhi",
        hhi_band(F.col("hhi")).alias("band"), (F.col("n_valid") >= MIN_RELIABLE).alias("reliable"),
    )


def modal_labels(df: DataFrame, key: str, label: str) -> DataFrame:
    """Per valid key its most frequent label that isn't blank; of equal ones the first in alphabet; the key without any."""
    counts = df.groupBy(_valid(F.col(key)).alias("key"), _valid(F.col(label)).alias("label")).agg(F.count(F.lit(1)).alias("n")).filter("key is not null")
    best = F.min_by("label", F.when(F.col("label").isNotNull(), F.struct((-F.col("n")).alias("n"), F.col("label").alias("l"))))
    return counts.groupBy("key").agg(best.alias("label"), F.sum("n").alias("n")).select("key", F.coalesce("label", "key").alias("label"), "n")


def top_keys(df: DataFrame, key: str, label: str, k: int = 10) -> DataFrame:
    """The ``k`` most frequent keys with label, count and share of the valid rows."""
    rows = modal_labels(df, key, label)
    total = rows.agg(F.sum("n").alias("total"))
    return rows.join(F.broadcast(total)).select("key", "label", "n", percent(F.col("n"), F.col("total")).alias("share_pct")).orderBy(F.desc("n"), "key").limit(k)


def first_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key, combined on the map side: no key's rows meet in one task."""
    row = F.struct(*df.columns)
    least = df.groupBy(key).agg(F.min_by(row, F.struct(*order)).alias("__row"))
    return least.select("__row.*")


def deduplicated_summary(df: DataFrame, key: str, host: str, order: list[str]) -> DataFrame:
    """``summary`` over the first row of each host."""
    return summary(first_per_key(df, host, order), key)


def presence_summary(df: DataFrame, cell: Column) -> DataFrame:
    """Concentration of the distinct items of a list cell, each counted once per row; coverage is rows with an item."""
    items = F.array_distinct(F.filter(F.transform(cell, strip), lambda x: x != ""))
    rows = df.select(items.alias("items"))
    base = rows.agg(F.count(F.lit(1)).alias("n_total"), F.count_if(F.size("items") > 0).alias("n_covered"))
    counts = rows.select(F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    c = counts.agg(F.count(F.lit(1)).alias("n_items"), F.sum("n").alias("s"), F.sum(F.col("n").cast("double") * F.col("n")).alias("q"))
    index = F.when(F.col("s") > 0, F.round(10000.0 * F.col("q") / (F.col("s").cast("double") * F.col("s")), 1)).otherwise(F.lit(0.0))
    return base.join(F.broadcast(c)).select("n_total", "n_covered", percent(F.col("n_covered"), F.col("n_total")).alias("coverage_pct"), "n_items", index.alias("hhi"), hhi_band(index).alias("band"), (F.col("n_covered") >= MIN_RELIABLE).alias("reliable"))


def shares(df: DataFrame, key: str) -> DataFrame:
    """Per key its count and percentage of all rows."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("__total"))
    return counts.join(F.broadcast(total)).select(key, "n", percent(F.col("n"), F.col("__total")).alias("pct"))
