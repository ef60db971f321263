"""Rollups of occurrences, cookies, software, probes and crawls: one aggregation with map-side combining each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.network import outside_eea
from lodestrata.operators.ranking import cap_per_group
from lodestrata.skew import salted_join
from lodestrata.functions.cells import strip


def first_seen(df: DataFrame, key: str, time: str, row_id: str, keep: list[str], page: str) -> DataFrame:
    """Per key its first row (by time, then id; unknown times last), and how many distinct pages it was seen on."""
    order = F.struct(F.col(time).isNull().alias("u"), F.col(time).alias("t"), F.col(row_id).alias("i"))
    return df.groupBy(key).agg(F.min_by(F.struct(*keep), order).alias("__first"), F.count_distinct(page).alias("n_pages")).select(key, *[F.col(f"__first.{c}").alias(c) for c in keep], "n_pages")


def third_party_by_host(df: DataFrame, host: str, domain: str, category: str, parent: str, country: str) -> DataFrame:
    """Per host: distinct third parties, their categories and parents, those outside the EEA, those of unknown country.

    Rows are made distinct before they are gathered, so a list is as long as a host has third parties."""
    one = df.groupBy(host, domain).agg(F.min(category).alias("c"), F.min(parent).alias("p"), F.min(F.nullif(strip(country), F.lit(""))).alias("y"))
    outside = F.when(outside_eea(F.col("y")), F.concat(F.col(domain), F.lit("("), F.col("y"), F.lit(")")))
    join = lambda c: F.array_join(F.array_sort(c), ";")
    return one.groupBy(host).agg(
        F.count(F.lit(1)).alias("n_third"), join(F.collect_set("c")).alias("categories"), join(F.collect_list(domain)).alias("domains"),
        join(F.collect_set("p")).alias("parents"), F.count(outside).alias("n_outside"), join(F.collect_list(outside)).alias("outside"),
        F.count_if(F.col("y").isNull()).alias("n_unknown"),
    )


def cookies_by_host(df: DataFrame, host: str, name: str, klass: Column) -> DataFrame:
    """Per host: cookies in all, technical, profiling and unknown ones, the names of profiling ones."""
    one = df.select(host, name).distinct().withColumn("k", klass)
    return one.groupBy(host).agg(
        F.count(F.lit(1)).alias("n_cookies"), F.count_if(F.col("k") == "tecnico").alias("n_technical"), F.count_if(F.col("k") == "profilazione").alias("n_profiling"),
        F.count_if(F.col("k") == "sconosciuto").alias("n_unknown"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("k") == "profilazione", F.col(name)))), ";").alias("profiling"),
    )


def software_by_host(df: DataFrame, host: str) -> DataFrame:
    """Per host, from rows as ``rules.software_found`` gives them: software, versions and licences found, and whether all of
    it is known to be open source. The lists are as long as the rules have entries."""
    one = df.groupBy(host, "software").agg(F.max("version").alias("version"), F.min("licence").alias("licence"), F.bool_and(F.coalesce("open_source", F.lit(False))).alias("open"))
    return one.groupBy(host).agg(
        F.array_join(F.array_sort(F.collect_list("software")), ";").alias("software"), F.array_join(F.array_sort(F.collect_set("licence")), ";").alias("licences"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("version") != "", F.concat("software", F.lit(" "), "version")))), ";").alias("versions"), F.bool_and("open").alias("all_open"),
    )


def resilience_by_host(ns: DataFrame, endpoints: DataFrame) -> DataFrame:
    """Per host: share of reachable name servers, whether they disagree on mail hosts, endpoints that answer, median and
    nearest-rank 95th latency, and the mean of the known shares."""
    from lodestrata.operators.distributions import nearest_rank

    reach = F.col("reachable")
    first_mx = F.min_by("mx", F.when(reach, F.col("ord")))
    own = ns.groupBy("hostname").agg(
        F.count(F.lit(1)).alias("n_ns"), F.count_if(reach).alias("n_reachable"), first_mx.alias("first_mx"), F.count_distinct(F.when(reach, F.col("mx"))).alias("n_mx_views")
    ).select("hostname", "n_ns", "n_reachable", F.round(F.col("n_reachable") / F.col("n_ns"), 4).alias("ns_ratio"), (F.col("n_mx_views") > 1).alias("mx_differ"))
    ends = endpoints.groupBy("hostname").agg(
        F.count(F.lit(1)).alias("n_endpoints"), F.count_if("tcp_ok").alias("tcp_ok"), F.count_if("tls_ok").alias("tls_ok"), F.count_if("http_ok").alias("http_ok"), F.round(F.median("latency_ms"), 1).alias("median_ms")
    ).withColumn("http_ratio", F.round(F.col("http_ok") / F.col("n_endpoints"), 4))
    p95 = nearest_rank(endpoints, ["hostname"], "latency_ms").select("hostname", F.col("value").alias("p95_ms"))
    both = own.join(ends, "hostname", "full").join(p95, "hostname", "left")
    parts = F.array_compact(F.array("ns_ratio", "http_ratio"))
    return both.withColumn("score", F.when(F.size(parts) > 0, F.round(F.round(F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / F.size(parts), 9), 4)))


def domain_meta(df: DataFrame, domain: str, country: str, page: str, kind: str, url: str) -> DataFrame:
    """Per domain: distinct pages across countries, kinds of reference, whether every reference is https."""
    return df.groupBy(domain).agg(
        F.count_distinct(F.concat_ws(": ", country, page)).alias("n_pages"), F.array_join(F.array_sort(F.collect_set(kind)), ",").alias("kinds"),
        F.bool_and(F.lower(url).startswith("https://")).alias("https_only"),
    )


def third_parties_long(df: DataFrame, host: str, domain: str, category: str, parent: str, country: str) -> DataFrame:
    """One row per host and third party with its category, parent, country and whether that is outside the EEA: the form for
    hosts with any number of them; ``third_party_by_host`` joins them to the lists of the export's format."""
    one = df.groupBy(host, domain).agg(F.min(category).alias("category"), F.min(parent).alias("parent"), F.min(F.nullif(strip(country), F.lit(""))).alias("country"))
    return one.withColumn("outside", F.coalesce(outside_eea(F.col("country")), F.lit(False)))


def crawl_counts(df: DataFrame, by: str, scope: str, outcome: str) -> DataFrame:
    """Per group, and over all as ``TOTALE``: rows by scope and by outcome, one row each: ``by``, ``kind``, ``key``, ``n``."""
    filled = lambda c: F.coalesce(c, F.lit("")).alias(c)
    one = df.groupBy(by, filled(scope), filled(outcome)).agg(F.count(F.lit(1)).alias("n"))
    own = one.unionByName(one.withColumn(by, F.lit("TOTALE"))).filter(F.col(by).isNotNull())
    each = lambda kind, c: own.groupBy(by, F.lit(kind).alias("kind"), F.col(c).alias("key")).agg(F.sum("n").alias("n"))
    return each("scope", scope).unionByName(each("outcome", outcome))


def crawl_stats(df: DataFrame, by: str, scope: str, outcome: str) -> DataFrame:
    """Per group and over all: rows by scope and by outcome, as maps."""
    filled = lambda c: F.coalesce(c, F.lit("")).alias(c)
    one = df.groupBy(by, filled(scope), filled(outcome)).agg(F.count(F.lit(1)).alias("n"))
    own = one.unionByName(one.withColumn(by, F.lit("TOTALE"))).filter(F.col(by).isNotNull())
    s = own.groupBy(by, scope).agg(F.sum("n").alias("n")).groupBy(by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(scope).alias("k"), "n")))).alias("by_scope"))
    o = own.groupBy(by, outcome).agg(F.sum("n").alias("n")).groupBy(by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(outcome).alias("k"), "n")))).alias("by_outcome"))
    return s.join(o, by)


def summary_by(df: DataFrame, by: list[str], distinct: dict[str, str] | None = None, last: dict[str, str] | None = None) -> DataFrame:
    """Per group: rows ``n``, distinct values and greatest values of the columns named; null keys are a group."""
    counts = [F.count_distinct(c).alias(n) for n, c in (distinct or {}).items()] + [F.max(c).alias(n) for n, c in (last or {}).items()]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *counts)


def progress(df: DataFrame, seed: str, level: str, host: str) -> DataFrame:
    """Per seed and level: pages and distinct hosts."""
    return df.groupBy(seed, level).agg(F.count(F.lit(1)).alias("pages"), F.count_distinct(host).alias("hosts"))


def registry(df: DataFrame, root: str, host: str, order: str, keep: list[str], flags: list[str], max_hosts: int = 50) -> DataFrame:
    """Per root domain: its first row's columns, the first ``max_hosts`` distinct hosts in order, flags or-ed together.

    The cap is the registry's own format; hosts are numbered after they are made distinct, and the ranking runs over a
    root's distinct hosts only.
    """
    once = df.groupBy(root, host).agg(F.min(order).alias("o"))
    few = cap_per_group(once, [root], [F.col("o"), F.col(host)], max_hosts, spread_by=host).withColumnRenamed("__rank", "r")
    hosts = few.groupBy(root).agg(F.transform(F.array_sort(F.collect_list(F.struct("r", host))), lambda x: x[host]).alias("hosts"))
    first = df.groupBy(root).agg(F.min_by(F.struct(*keep), order).alias("f"), *[F.bool_or(c).alias(c) for c in flags]).select(root, *[F.col(f"f.{c}").alias(c) for c in keep], *flags)
    return first.join(hosts, root).withColumn("hosts", F.array_join("hosts", "|"))


def shared_hosts(df: DataFrame, host: str, keep: list[str]) -> DataFrame:
    """Rows with a flag whether their host serves several rows; blank hosts serve none."""
    n = df.filter(F.coalesce(strip(host), F.lit("")) != "").groupBy(host).agg(F.count(F.lit(1)).alias("n_sharing"))
    own = salted_join(df.select(*keep, host), n, [host], keep[0], "left")
    return own.select(*keep, host, F.coalesce("n_sharing", F.lit(0)).alias("n_sharing"), (F.coalesce("n_sharing", F.lit(0)) > 1).alias("shared"))
