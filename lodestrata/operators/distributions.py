"""Distributions, rates and quantiles in one aggregation each; percentages are of all rows, 0 where there are none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.functions.bands import percent
from lodestrata.functions.cells import strip

def rates(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """Percentage of rows for which each flag is true; null counts as not."""
    return df.agg(F.count(F.lit(1)).alias("n"), *[percent(F.count_if(F.coalesce(c, F.lit(False))), F.count(F.lit(1))).alias(k) for k, c in flags.items()])


def counts_where(df: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """One row: how many rows pass each test."""
    return df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in tests.items()])


def distribution(df: DataFrame, key: Column, name: str = "key") -> DataFrame:
    """Count and percentage of all rows per filled value."""
    total = df.agg(F.count(F.lit(1)).alias("total"))
    counts = df.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("n")).filter(F.coalesce(strip(F.col(name).cast("string")), F.lit("")) != "")
    return counts.join(F.broadcast(total)).select(name, "n", percent(F.col("n"), F.col("total")).alias("pct"))


def top_items(df: DataFrame, items: Column, k: int, name: str = "item") -> DataFrame:
    """The most frequent items of a list column; equal counts by item."""
    return df.select(F.explode(items).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), name).limit(k)


#: Groups of up to so many rows are ranked by the built-in aggregates, whose memory grows with a group's distinct values.
IN_MEMORY_ROWS = 5_000_000
#: Slots that a range is cut into, and the distinct values up to which a range is ranked in one window.
_SLOTS, _FEW = 32, 1_000_000


def _largest_group(rows: DataFrame, by: list[str]) -> int:
    return rows.groupBy(*by).count().agg(F.max("count")).first()[0] or 0


def order_statistics(rows: DataFrame, by: list[str], ranks: dict[str, Column], few: int = _FEW) -> DataFrame:
    """Values at given 0-based ranks of the column ``v`` per group, exactly, however large a group is.

    ``ranks`` are expressions of the group's size ``n``. Equal values are counted together first, so no value is hot. A
    group's range is cut at quantiles of its distinct values, so that every slot has about as many of them whatever their
    distribution; rows are counted per slot, and only the slots that hold a wanted rank are cut again, until none has more
    than ``few`` distinct values; these are ranked by value. No task ever holds a group: slots are few, and the joins to the
    group's few rows are salted by value.
    """
    from lodestrata.lineage import cut

    names = [f"k{i}" for i in range(len(by))]
    once = rows.select(*[F.col(c).alias(n) for c, n in zip(by, names, strict=True)], "v").groupBy(*names, "v").agg(F.count(F.lit(1)).alias("m"))
    keyed = cut(once.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(16)).cast("int")))
    groups = keyed.groupBy(*names).agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("m").alias("n"), F.count(F.lit(1)).alias("k"))
    wanted = F.explode(F.array(*[F.struct(F.lit(k).alias("name"), r.cast("bigint").alias("rank")) for k, r in ranks.items()]))
    ranges = cut(groups.withColumn("w", wanted).select(*names, "w.name", "lo", "hi", "k", "w.rank"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(15))).alias("rsalt")
    span = [*names, "lo", "hi"]

    def within(r: DataFrame, *more: str) -> DataFrame:
        few_ = r.select(*[F.col(n).alias(f"r{n}") for n in names], "lo", "hi", *more).distinct().select("*", salts)
        same = F.col("salt") == F.col("rsalt")
        for n in names:
            same = same & F.col(n).eqNullSafe(F.col(f"r{n}"))
        return keyed.join(few_, same & F.col("v").between(F.col("lo"), F.col("hi"))).select(*names, "lo", "hi", "v", "m", *more)

    def narrowed(r: DataFrame, cell: str) -> DataFrame:
        inside = within(r) if cell == "v" else within(r, "cuts").withColumn("slot", F.size(F.filter("cuts", lambda c: c < F.col("v"))))
        counts = inside.groupBy(*span, cell).agg(F.sum("m").alias("c"), F.min("v").alias("a"), F.max("v").alias("b"), F.count(F.lit(1)).alias("k"))
        w = Window.partitionBy(*span).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("before", F.coalesce(F.sum("c").over(w), F.lit(0)))
        on = (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("c"))
        for n in span:
            on = on & F.col(n).eqNullSafe(F.col(f"q_{n}"))
        asked = r.select(*[F.col(n).alias(f"q_{n}") for n in span], "name", "rank")
        return counts.join(asked, on).select(*names, "name", F.col("a").alias("lo"), F.col("b").alias("hi"), "k", (F.col("rank") - F.col("before")).alias("rank"))

    grid = [(i + 1) / _SLOTS for i in range(_SLOTS - 1)]
    while (ranges.agg(F.max("k")).first()[0] or 0) > few:
        cuts = within(ranges).groupBy(*span).agg(F.array_distinct(F.percentile_approx("v", grid, 10_000)).alias("cuts"))
        same = F.lit(True)
        for n in span:
            same = same & F.col(n).eqNullSafe(F.col(f"c_{n}"))
        with_cuts = ranges.join(cuts.select(*[F.col(n).alias(f"c_{n}") for n in span], "cuts"), same).select(*ranges.columns, "cuts")
        ranges = cut(narrowed(with_cuts, "slot"))
    return narrowed(ranges, "v").select(*[F.col(n).alias(c) for c, n in zip(by, names, strict=True)], "name", F.col("lo").alias("value"))


def spread(df: DataFrame, value: Column, by: list[str] | None = None, digits: int = 1, in_memory: int = IN_MEMORY_ROWS) -> DataFrame:
    """Count, mean, median, interpolated 95th percentile and maximum of a number; nulls left out.

    The largest group is counted first; above ``in_memory`` rows the quantiles come from ``order_statistics``.
    """
    by = by or []
    rows = df.select(*by, value.cast("double").alias("v"))
    plain = [F.count("v").alias("n"), F.round(F.avg("v"), digits).alias("mean"), F.round(F.max("v"), digits).alias("max")]
    if _largest_group(rows, by) <= in_memory:
        out = rows.groupBy(*by).agg(*plain, F.round(F.median("v"), digits).alias("median"), F.round(F.percentile("v", 0.95), digits).alias("p95"))
        return out.select(*by, "n", "mean", "median", "p95", "max")
    at = {f"{name}{end}": f((F.col("n") - 1) * q) for name, q in (("median", 0.5), ("p95", 0.95)) for end, f in (("_lo", F.floor), ("_hi", F.ceil))}
    found = order_statistics(rows.filter("v is not null"), by, at).groupBy(*by).agg(*[F.max(F.when(F.col("name") == k, F.col("value"))).alias(k) for k in at])
    names = {c: f"__{c}" for c in by}
    base = rows.groupBy(*by).agg(*plain)
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(names[c]))
    both = base.join(found.withColumnsRenamed(names), same, "left")

    def quantile(name: str, q: float) -> Column:
        exact = (F.col("n") - 1) * q
        return F.round(F.col(f"{name}_lo") + (F.col(f"{name}_hi") - F.col(f"{name}_lo")) * (exact - F.floor(exact)), digits).alias(name)

    return both.select(*by, "n", "mean", quantile("median", 0.5), quantile("p95", 0.95), "max")


def nearest_rank(df: DataFrame, by: list[str], value: str, q: float = 0.95, in_memory: int = IN_MEMORY_ROWS) -> DataFrame:
    """The nearest-rank percentile per group: position round(q * (n - 1)), half to even, of the sorted values; exact.

    Counts per distinct value are accumulated; where a group is larger than ``in_memory``, by ``order_statistics``.
    """
    rows = df.filter(F.col(value).isNotNull()).select(*by, F.col(value).alias("v"))
    rank = F.bround(F.lit(q) * (F.col("n") - 1), 0)
    total = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    if _largest_group(rows, by) > in_memory:
        found = order_statistics(rows, by, {"x": rank}).select(*[F.col(c).alias(f"__{c}") for c in by], "value")
        same = F.lit(True)
        for c in by:
            same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
        return total.join(found, same).select(*by, "value", "n")
    counts = rows.groupBy(*by, "v").agg(F.count(F.lit(1)).alias("c"))
    own = Window.partitionBy(*by)
    upto, n = F.sum("c").over(own.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)), F.sum("c").over(own)
    placed = counts.withColumns({"upto": upto, "n": n})
    return placed.filter(F.col("upto") > rank).groupBy(*by).agg(F.min("v").alias("value"), F.max("n").alias("n"))


def matrix_with_total(df: DataFrame, row: str, column: str, columns: list[str], total: str = "TOTALE") -> DataFrame:
    """Counts of rows by two keys, given columns across, absent ones 0, and a total row."""
    cells = [F.count_if(F.col(column) == c).alias(c) for c in columns]
    own = df.groupBy(F.col(row).alias(row)).agg(*cells)
    return own.unionByName(df.agg(*cells).withColumn(row, F.lit(total)).select(row, *columns))


def error_summary(df: DataFrame, errors: Column, classes: Column) -> DataFrame:
    """Counts per error type and class of a ``type:detail`` list column. ``classes`` maps the columns type and detail."""
    each = df.select(F.explode(errors).alias("e")).select(strip(F.split_part("e", F.lit(":"), F.lit(1))).alias("type"), strip(F.regexp_extract("e", r"^[^:]*:(.*)$", 1)).alias("detail"))
    return each.filter("type <> ''").withColumn("class", classes).groupBy("type", "class").agg(F.count(F.lit(1)).alias("n"))


def expiry_bands(df: DataFrame, days: Column) -> DataFrame:
    d = days.cast("int")
    return counts_where(df, {"known": d.isNotNull(), "expired": d < 0, "within_30": d.between(0, 30), "later": d > 30})


def success_rate(df: DataFrame, ok: Column, by: list[str], min_tries: int = 10, least: float = 50.0) -> DataFrame:
    """Share of successes per group and whether it is alarming: enough tries and below ``least`` per cent."""
    agg = df.groupBy(*by).agg(F.count(F.lit(1)).alias("tries"), F.count_if(F.coalesce(ok, F.lit(False))).alias("ok"))
    rate = percent(F.col("ok"), F.col("tries"))
    return agg.withColumn("rate", rate).withColumn("alarm", (F.col("tries") >= min_tries) & (rate < least))


def agreement(df: DataFrame, ours: str, theirs: str, comparable: list[str]) -> DataFrame:
    """Share of rows where two classes agree, over rows whose other class is comparable."""
    rows = df.filter(F.col(theirs).isin(*comparable))
    return rows.agg(F.count(F.lit(1)).alias("n"), percent(F.count_if(F.coalesce(F.col(ours) == F.col(theirs), F.lit(False))), F.count(F.lit(1))).alias("agree_pct"))


def dependency_index(dims: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Weighted mean, 0 to 100, of the dimensions (columns, 0 to 1) that aren't null, weights renewed over those."""
    from lodestrata.functions.bands import index_band

    used = [F.when(F.col(k).isNotNull(), F.lit(w)).otherwise(F.lit(0.0)) for k, w in weights.items()]
    value = [F.when(F.col(k).isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(k).cast("double")))).otherwise(F.lit(0.0)) * w for k, w in weights.items()]
    total, top = sum(used[1:], used[0]), sum(value[1:], value[0])
    index = F.when(total > 0, F.round(100 * top / total, 1))
    names = F.array_join(F.array_compact(F.array(*[F.when(F.col(k).isNotNull(), F.lit(k)) for k in weights])), ",")
    return dims.select(*dims.columns, index.alias("index"), index_band(index).alias("band"), F.round(total, 2).alias("weight"), names.alias("used"))
