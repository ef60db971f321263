"""Joins of entities, hosts and measurements.

The side with many rows per key is salted, as a portal or a default value may hold a third of all rows; the other side is
left to the planner, which broadcasts it where its measured size allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.skew import salted_join


def _spread(df: DataFrame, key: str) -> list[str]:
    """What the rows of one key are spread by: all their other columns that can be hashed."""
    plain = [f.name for f in df.schema.fields if f.name != key and "map<" not in f.dataType.simpleString()]
    return plain or [key]


def lookup_dimension(df: DataFrame, dim: DataFrame, key: str, columns: list[str], default: str | None = "", how: str = "left") -> DataFrame:
    """Join to a dimension, whose keys are distinct; what it lacks comes out as ``default``, or not at all for an inner join."""
    out = salted_join(df, dim.select(key, *columns), [key], _spread(df, key), how)
    return out if default is None else out.withColumns({c: F.coalesce(c, F.lit(default)) for c in columns})


def wide_export(base: DataFrame, key: str, tables: dict[str, DataFrame]) -> DataFrame:
    """``base`` left-joined to every table on ``key``; columns that collide get the table's name as suffix. Keys that
    repeat in a table fan out, as they do in the base."""
    out = base
    for name, t in tables.items():
        clash = {c: f"{c}_{name}" for c in t.columns if c != key and c in out.columns}
        out = salted_join(out, t.withColumnsRenamed(clash), [key], _spread(out, key), "left")
    return out


def membership_status(df: DataFrame, key: str, measured: DataFrame, listed: DataFrame) -> DataFrame:
    """Whether a key was measured, only listed, or neither."""
    m = measured.select(key).distinct().withColumn("__m", F.lit(True))
    s = listed.select(key).distinct().withColumn("__l", F.lit(True))
    state = F.when(F.col("__m"), "measured").when(F.col("__l"), "listed").otherwise("absent")
    own = salted_join(salted_join(df, m, [key], _spread(df, key), "left"), s, [key], _spread(df, key), "left")
    return own.withColumn("state", state).drop("__m", "__l")


def fan_out(entities: DataFrame, hosts: DataFrame, host: str) -> DataFrame:
    """Facts measured once per host, given to every entity on it."""
    return salted_join(entities, hosts, [host], _spread(entities, host), "left")


def block_representatives(ips: DataFrame, ip: str, order: str, block: Column) -> DataFrame:
    """One IP per block, the first by ``order``."""
    return ips.withColumn("block", block).filter("block is not null").groupBy("block").agg(F.min_by(ip, order).alias("representative"), F.count(F.lit(1)).alias("n_ips"))


def by_block(ips: DataFrame, block: Column, facts: DataFrame) -> DataFrame:
    """IPs with the facts of their block."""
    own = ips.withColumn("block", block)
    return salted_join(own, facts, ["block"], _spread(own, "block"), "left")


def latest_per_key(df: DataFrame, key: list[str], time: str, tie: str, values: list[str]) -> DataFrame:
    """The last state of each key: by time, then ``tie``."""
    return df.groupBy(*key).agg(F.max_by(F.struct(time, *values), F.struct(F.col(time).alias("a"), F.col(tie).alias("b"))).alias("__l")).select(*key, f"__l.{time}", *[f"__l.{v}" for v in values])


def carry_forward(new: DataFrame, old: DataFrame, key: str, flags: dict[str, object]) -> DataFrame:
    """New rows with the human's columns of the old ones, and defaults where there is none."""
    prev = old.groupBy(key).agg(*[F.max(c).alias(f"__{c}") for c in flags])
    return salted_join(new, prev, [key], _spread(new, key), "left").withColumns({c: F.coalesce(F.col(f"__{c}"), F.lit(d)) for c, d in flags.items()}).drop(*[f"__{c}" for c in flags])


def values_by_host(df: DataFrame, host: str, columns: list[str]) -> DataFrame:
    """Distinct filled values of each column per host, one row each: ``host``, ``column``, ``value``."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
    return df.select(host, cells.alias("c")).select(host, "c.*").filter("value <> ''").distinct()


def attach_results(rows: DataFrame, row_id: str, sites: DataFrame, results: DataFrame, site: str, columns: list[str], default: str = "") -> DataFrame:
    """Every output row with its site's result: ``sites`` says which row (``row_id``) belongs to which site; rows without a
    site, or whose site has no result, get ``default``. Columns of the rows that the result has too are the result's."""
    of_row = salted_join(sites.select(row_id, site).filter(F.col(row_id).isNotNull()).dropDuplicates([row_id]), results.select(site, *columns), [site], row_id, "left")
    out = rows.drop(*columns).join(of_row.select(row_id, *columns), row_id, "left")
    return out.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(default)) for c in columns})


def fill_from_cache(df: DataFrame, key: str, column: str, cache: DataFrame, found: str) -> DataFrame:
    """Blank cells of ``column`` filled from a cache of one ``found`` value per ``key``; '' where that has none either."""
    own = salted_join(df, cache.select(key, F.col(found).alias("__found")), [key], _spread(df, key), "left")
    return own.withColumn(column, F.coalesce(F.nullif(column, F.lit("")), "__found", F.lit(""))).drop("__found")


def dependency_columns(df: DataFrame, key: str, answers: DataFrame, dependency: str, share: str, error: str) -> DataFrame:
    """Rows with the main dependency, its share to three decimals and the error of a service's captured answer for ``key``;
    what an answer lacks, or a missing answer, is ''. An answer that failed contributes its error only."""
    once = answers.groupBy(key).agg(F.max_by(F.struct(dependency, share, error), F.struct(F.col(error).isNull(), share, dependency)).alias("__a"))
    own = salted_join(df, once, [key], _spread(df, key), "left")
    bad = F.coalesce(F.col(f"__a.{error}"), F.lit("")) != ""
    return own.withColumns({
        dependency: F.when(bad, "").otherwise(F.coalesce(F.col(f"__a.{dependency}").cast("string"), F.lit(""))),
        share: F.when(bad, "").otherwise(F.coalesce(F.round(F.col(f"__a.{share}"), 3).cast("string"), F.lit(""))), error: F.coalesce(F.col(f"__a.{error}"), F.lit("")),
    }).drop("__a")
