"""Level-wise search over a captured link graph: queue order, perimeter, traps, caps, visited set, origin of each page.

The search is that of a queue worked level by level. A page stands in its level's queue where the first page of the level
before that links to it stands, and there by the order of the links; it belongs to the seed that reached it first. The
place is a text that sorts like the queue: the place of the parent followed by the link's number, so no level has to be
sorted or numbered as a whole.

Shape of the job: each level joins the links to the frontier (salted by target), keeps the first way to each target with
map-side combining, and takes off what has been seen. Every level is one table in the shared folder and is written once;
what has been seen is the union of these tables, never a rewritten one.

Defined results: a seed given more than once counts where it comes first; pages of the current level are visited; a page
that ``level_cap`` leaves out can be reached again later and keeps its first seed; links without a number come last; a
link to nowhere (null) is none.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.functions.urls import in_domain_list, is_file_url, looks_like_trap, tld_matches, url_signature
from lodestrata.lineage import cut
from lodestrata.operators.ranking import cap_per_group
from lodestrata.skew import salted_join

_LONGEST = (1 << 63) - 1


def in_perimeter(host: Column, domains: list[str], tlds: list[str], excluded: list[str] | None = None) -> Column:
    """Whether a host belongs to the search: on or below a listed domain, or under a listed TLD, and below no excluded one."""
    h = F.coalesce(host, F.lit(""))
    inside = (in_domain_list(h, domains) if domains else F.lit(False)) | (tld_matches(h, tlds) if tlds else F.lit(False))
    return (h != "") & inside & ~(in_domain_list(h, excluded) if excluded else F.lit(False))


def _sortable(number: Column) -> Column:
    """A whole number as a text of fixed length that sorts like it."""
    return F.lpad(F.hex(F.coalesce(number.cast("bigint"), F.lit(_LONGEST)).bitwiseXOR(F.lit(-_LONGEST - 1))), 16, "0")


def level_search(
    edges: DataFrame, seeds: DataFrame, max_depth: int, level_cap: int | None = None, allowed: DataFrame | None = None,
    within: Callable[[Column], Column] | None = None, skip_traps: bool = False, skip_files: bool = False, signature_cap: int | None = None,
) -> DataFrame:
    """``url``, ``level``, ``seed`` of every page reached.

    ``edges``: src, dst, dst_host, ord; ``seeds``: url, ord. ``level_cap`` keeps that many new pages of each level, in
    turns over hosts; ``allowed`` (one column url) and ``within``, a test of the host, are the perimeter. ``skip_traps`` and
    ``skip_files`` leave out URLs that look like traps or name files; ``signature_cap`` keeps that many new pages of each URL
    signature over all levels, in queue order.
    """
    first = seeds.filter("url is not null").groupBy("url").agg(F.min("ord").alias("ord"))
    frontier = cut(first.select("url", F.lit(0).alias("level"), F.col("url").alias("seed"), _sortable(F.col("ord")).alias("place")))
    levels, used, dropped = [frontier], None, None
    links = edges.filter("dst is not null")
    for level in range(1, max_depth + 1):
        step = salted_join(links, frontier.select(F.col("url").alias("src"), "seed", F.col("place").alias("from")), ["src"], "dst")
        way = F.struct(F.concat("from", _sortable(F.col("ord"))).alias("place"), "seed", F.coalesce(F.col("dst_host").cast("string"), F.lit("")).alias("host"))
        found = step.groupBy("dst").agg(F.min(way).alias("w")).select("dst", "w.place", "w.seed", "w.host")
        seen = reduce(DataFrame.unionByName, [t.select(F.col("url").alias("dst")) for t in levels])
        found = found.join(seen, "dst", "left_anti")
        if allowed is not None:
            found = found.join(allowed.select(F.col("url").alias("dst")).distinct(), "dst", "left_semi")
        if within is not None:
            found = found.filter(within(F.col("host")))
        text = F.col("dst").cast("string")
        if skip_traps:
            found = found.filter(~looks_like_trap(text))
        if skip_files:
            found = found.filter(~is_file_url(text))
        if dropped is not None:
            found = found.join(dropped, "dst", "left").withColumn("seed", F.coalesce("first_seed", "seed")).drop("first_seed")
        if signature_cap is not None:
            found = found.withColumn("__sig", url_signature(text))
            ranked = cap_per_group(found, ["__sig"], [F.col("place"), F.col("dst")], signature_cap, spread_by="dst")
            if used is not None:
                ranked = ranked.join(used, "__sig", "left").filter(F.col("__rank") + F.coalesce("__used", F.lit(0)) <= signature_cap).drop("__used")
            found = cut(ranked.drop("__rank"))
            now = found.groupBy("__sig").agg(F.count(F.lit(1)).alias("__used"))
            used = cut(now if used is None else now.unionByName(used).groupBy("__sig").agg(F.sum("__used").alias("__used")))
            found = found.drop("__sig")
        if level_cap is not None:
            every = cut(found)
            if every.count() > level_cap:
                found = _in_turns(every, level_cap)
                frontier = cut(found.select(F.col("dst").alias("url"), F.lit(level).alias("level"), "seed", "place"))
                late = every.join(frontier.select(F.col("url").alias("dst")), "dst", "left_anti").select("dst", F.col("seed").alias("first_seed"))
                dropped = cut(late if dropped is None else late.unionByName(dropped).groupBy("dst").agg(F.first("first_seed").alias("first_seed")))
                levels.append(frontier)
                continue
            found = every
        frontier = cut(found.select(F.col("dst").alias("url"), F.lit(level).alias("level"), "seed", "place"))
        if frontier.isEmpty():
            break
        levels.append(frontier)
    return reduce(DataFrame.unionByName, levels).select("url", "level", "seed")


def _in_turns(found: DataFrame, cap: int) -> DataFrame:
    """``cap`` pages: the first of every host, then the second, hosts in order of their first page; their places follow that."""
    few = cap_per_group(found, ["host"], [F.col("place"), F.col("dst")], cap, spread_by="dst")
    hosts = few.filter("__rank = 1").select("host", F.struct("place", "dst").alias("__seen"))
    turns = few.join(hosts, "host").orderBy("__rank", "__seen").limit(cap)
    return turns.select("dst", "seed", "host", F.concat(_sortable(F.col("__rank")), F.col("__seen.place")).alias("place"))


def pagination_runs(pages: DataFrame, template: str, number: str, digest: str, new_links: str, start: int = 1, max_pages: int = 500, stop_after: int = 2) -> DataFrame:
    """Per page template: how far its numbered pages are followed, which ends where ``stop_after`` pages in a row bring
    nothing: no new link, the text of the page before, or no page captured. ``pages``: how many were read until then,
    ``last``: the last number among them, ``useful``: how many brought something.

    A template has at most ``max_pages`` numbers, so a window holds no more rows than that once pages are made distinct.
    """
    inside = pages.filter(F.col(number).between(start, start + max_pages - 1) & F.col(template).isNotNull())
    once = inside.groupBy(template, number).agg(F.min(digest).alias("__digest"), F.max(F.coalesce(F.col(new_links), F.lit(0))).alias("__new"))
    w = Window.partitionBy(template).orderBy(number)
    good = (F.col("__new") > 0) & ~F.coalesce(F.lag("__digest").over(w) == F.col("__digest"), F.lit(False))
    before = F.coalesce(F.max(F.when(F.col("__good"), F.col(number))).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(start - 1))
    marked = once.withColumn("__good", good).withColumn("__before", before)
    idle = F.col(number) - F.col("__before") - F.col("__good").cast("int")
    stop = F.min(F.when(idle >= stop_after, F.col("__before") + stop_after)).over(Window.partitionBy(template))
    read = marked.withColumn("__stop", stop).filter(F.col("__stop").isNull() | (F.col(number) <= F.col("__stop")))
    return read.groupBy(template).agg(F.count(F.lit(1)).alias("pages"), F.max(number).alias("last"), F.count_if("__good").alias("useful"))
