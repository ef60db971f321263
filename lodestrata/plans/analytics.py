"""Queries of the analytic operators over the test tables, each with its SQL where SQL can say it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.functions import bands, html, network, pages, text, urls
from lodestrata.functions.cells import strip
from lodestrata.operators import concentration, distributions, graph, joins, ranking, rollups, rules, scoring, sets
from lodestrata.session import table
from lodestrata.skew import salted_join

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def keep(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = _stripping(sql)
        return f

    return keep


def _stripping(sql: str) -> str:
    """The SQL with each ``trim(x)`` taking off white space of any script, as ``strip`` does."""
    while m := re.search(r"(?<![\w.])trim\(", sql):
        depth, end, quoted = 1, m.end(), False
        while depth:
            quoted ^= sql[end] == "'"
            depth += 0 if quoted else {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        sql = f"{sql[: m.start()]}regexp_replace({sql[m.end() : end - 1]}, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g'){sql[end:]}"
    return sql


RECORDS, TYPES, SITES = "site_records", "tipo_ente_possibili_non_pubblici", "siti_classificati"
_HOST_SQL = "rtrim(lower(regexp_extract(trim(coalesce({0}, '')), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '.')"
_FOLD_SQL = "regexp_replace(regexp_replace(regexp_replace(lower(strip_accents(coalesce({0}, ''))), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), '[\\s\\p{{Z}}]+', ' ', 'g'), '^ | $', '', 'g')"
_BARE_SQL = "trim(lower(regexp_replace(regexp_replace(trim(coalesce({0}, '')), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '(?s)[/?#:].*$', '')))"


_SUFFIXES_SQL = "list_transform(range(1, len(string_split({0}, '.')) + 1), lambda i: array_to_string(string_split({0}, '.')[i:], '.'))"
_TRIM_SQL = "regexp_replace({0}, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')"


def _infrastructure_sql(host: str) -> str:
    h = f"rtrim(lower({host}), '.')"
    labels = ", ".join(f"'{x}'" for x in urls.INFRASTRUCTURE_LABELS)
    root = f"CASE WHEN len(string_split({h}, '.')) >= 2 THEN string_split({h}, '.')[-2] ELSE string_split({h}, '.')[1] END"
    return f"({host} <> '' AND (list_has_any({_SUFFIXES_SQL.format(h)}, [{', '.join(repr(d) for d in dict.fromkeys(urls.INFRASTRUCTURE))}]) OR {root} IN ({labels})))"


def _site_sql(source: str, value: str, key: str) -> str:
    """CTEs that end in ``sites``: ``key``, ``value`` and its normal form ``url``, '' where it is no site."""
    nulls = ", ".join(f"'{t}'" for t in urls.NULL_TOKENS)
    auth = "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?"
    label = "[\\p{L}\\p{N}](?:[\\p{L}\\p{N}-]{0,61}[\\p{L}\\p{N}])?"
    octet = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    return f"""v0 AS (SELECT {key}, {value} AS value FROM {source}),
v1 AS (SELECT *, regexp_replace({_TRIM_SQL.format("coalesce(value, '')")}, '^[<>"'' ]+|[<>"'' ]+$', '', 'g') AS s FROM v0),
v2 AS (SELECT *, lower({_TRIM_SQL.format('s')}) IN ({nulls}) OR regexp_matches(lower(s), '^(?:mailto|tel|javascript):') OR regexp_matches(s, '(?i)^[^@\\s/]+@[^@\\s/]+\\.[a-z]{{2,}}$') AS none, CASE WHEN contains(s, '://') THEN s WHEN starts_with(s, '//') THEN 'https:' || s ELSE 'https://' || s END AS f FROM v1),
v3 AS (SELECT *, {_TRIM_SQL.format('f')} AS u FROM v2),
v4 AS (SELECT *, lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme, regexp_extract(u, '{auth}(?:\\[[^\\]/?#]*\\]|[^/?#:]*):([0-9]+)', 1) AS port, regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(u, '^[^?#]*\\?([^#]*)', 1) AS query, rtrim(lower(regexp_extract(u, '{auth}(\\[[^\\]/?#]*\\]|[^/?#:]*)', 1)), '.') AS bare FROM v3),
v5 AS (SELECT *, CASE WHEN starts_with(bare, '[') THEN regexp_extract(bare, '^\\[([0-9a-f:.]+)\\]$', 1) WHEN contains(bare, '[') THEN '' ELSE bare END AS host FROM v4),
sites AS (SELECT {key}, value, CASE WHEN none OR scheme NOT IN ('http', 'https') OR NOT (regexp_matches(host, '^(?:{label}\\.)+\\p{{L}}{{2,}}$') OR regexp_matches(host, '^{octet}(?:\\.{octet}){{3}}$') OR contains(host, ':')) THEN ''
ELSE scheme || '://' || CASE WHEN port IN ('', '80', '443') THEN host ELSE host || ':' || port END || regexp_replace(regexp_replace(path, '/{{2,}}', '/', 'g'), '/+$', '') || CASE WHEN query <> '' THEN '?' || query ELSE '' END END AS url FROM v5)"""


_PIECES_SQL = f"""p0 AS (SELECT rec_id, host_osservati AS cell, {_TRIM_SQL.format("coalesce(host_osservati, '')")} AS s FROM site_records),
p1 AS (SELECT rec_id, cell, regexp_split_to_array(regexp_replace(s, '(?i)\\s+(?:e|et|und|y|and|en|och|og|ja)\\s+(https?://|www\\.)', chr(10) || '\\1', 'g'), '[;\\n\\r\\t|]+|,\\s+|\\s{{2,}}') AS l FROM p0 WHERE lower(s) NOT IN ({", ".join(f"'{t}'" for t in urls.NULL_TOKENS)})),
p2 AS (SELECT rec_id, list_filter(list_transform(l, lambda x: regexp_replace({_TRIM_SQL.format('x')}, '^[<>"'' ]+|[<>"'' ]+$', '', 'g')), lambda x: x <> '') AS l FROM p1),
p3 AS (SELECT rec_id, flatten(list_transform(l, lambda x: CASE WHEN contains(x, ' ') AND len(list_filter(regexp_split_to_array(x, '\\s+'), lambda y: y <> '')) > 1 AND len(list_filter(regexp_split_to_array(x, '\\s+'), lambda y: y <> '' AND NOT contains(y, '.'))) = 0 THEN list_filter(regexp_split_to_array(x, '\\s+'), lambda y: y <> '') ELSE [x] END)) AS l FROM p2),
pieces AS (SELECT rec_id, (i - 1)::INT AS pos, l[i] AS value FROM (SELECT rec_id, l, unnest(range(1, len(l) + 1)) AS i FROM p3))"""


def _bare(c: Column) -> Column:
    return strip(F.lower(F.regexp_replace(F.regexp_replace(strip(F.coalesce(c, F.lit(""))), r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), r"(?s)[/?#:].*\z", "")))


# -- SQL of rule tables


def _quoted(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def _vendor_sql(url: str, what: str) -> str:
    """The category, vendor or parent of a URL by the first rule in it."""
    value = {"category": lambda r: r.category, "vendor": lambda r: r.vendor, "parent": lambda r: r.parent or r.vendor}[what]
    other = "'altro_terzo_parte'" if what == "category" else f"lower(regexp_extract({url}, '://([^/?#:]*)', 1))"
    return "CASE " + " ".join(f"WHEN contains(lower({url}), {_quoted(r.pattern)}) THEN {_quoted(value(r))}" for r in rules.VENDORS) + f" ELSE {other} END"


def _cookie_sql(name: str) -> str:
    tests = [(f"lower({name}) = {_quoted(p)}" if len(p) <= 4 else f"contains(lower({name}), {_quoted(p)})", c) for p, c, _ in rules.COOKIES]
    return "CASE " + " ".join(f"WHEN {t} THEN '{c}'" for t, c in tests) + " ELSE 'sconosciuto' END"


#: The software marks and one for what the test texts name.
_MARKS = [*rules.SOFTWARE, rules.Software("software", "html", "software", "altro", "n/d", None, r"software[^0-9]{0,20}([0-9]+\.[0-9]+\.[0-9]+)"), rules.Software("versione", "html", "software", "altro", "n/d", None, "versione ([0-9.]+)"), rules.Software("cookie", "html", "cookies", "altro", "aperta", True)]


def _software_sql(keep: str) -> str:
    """One row per text and software in it, from ``documents``."""
    names: dict[str, list] = {}
    for r in _MARKS:
        if r.source == "html":
            names.setdefault(r.name, []).append(r)
    parts = []
    for name, marks in names.items():
        on = lambda r: f"contains(t, {_quoted(r.pattern)})"
        version = ", ".join(f"CASE WHEN {on(r)} THEN nullif(regexp_extract(o, {_quoted('(?i)' + r.version)}, 1), '') END" for r in marks if r.version)
        first = lambda f: "CASE " + " ".join(f"WHEN {on(r)} THEN {f(r)}" for r in marks) + " END"  # noqa: E731, B023
        parts.append(f"SELECT {keep}, {_quoted(name)} AS software, {first(lambda r: _quoted(r.licence))} AS licence, {first(lambda r: 'NULL' if r.open_source is None else str(r.open_source).lower())}::BOOLEAN AS open, coalesce({version + ', ' if version else ''}'') AS version FROM d WHERE {' OR '.join(map(on, marks))}")
    return "d AS (SELECT *, replace(coalesce(text, ''), chr(39), chr(34)) AS o, lower(replace(coalesce(text, ''), chr(39), chr(34))) AS t FROM documents), f AS (" + " UNION ALL ".join(parts) + ")"


# -- concentration and its relatives


def _summary_sql(source: str, key: str, by: list[str] | None = None, least: int = 0) -> str:
    b = "".join(f"{x}, " for x in by or [])
    return f"""WITH c AS (SELECT {b}nullif(trim(CAST({key} AS VARCHAR)), '') AS key, count(*) AS n FROM {source} GROUP BY ALL),
a AS (SELECT {b}coalesce(sum(n), 0)::BIGINT AS n_total, coalesce(sum(n) FILTER (key IS NOT NULL), 0)::BIGINT AS n_valid, count(key) AS n_keys,
  sum(n::DOUBLE * n) FILTER (key IS NOT NULL) AS q FROM c GROUP BY ALL),
b AS (SELECT *, CASE WHEN n_total > 0 THEN round(100.0::DOUBLE * n_valid / n_total, 1) ELSE 0.0 END::DOUBLE AS coverage_pct,
  CASE WHEN n_valid > 0 THEN round(10000.0::DOUBLE * q / (n_valid::DOUBLE * n_valid), 1) ELSE 0.0 END::DOUBLE AS hhi FROM a)
SELECT {b}n_total, n_valid, coverage_pct, CASE WHEN coverage_pct < 50 THEN 'bassa' WHEN coverage_pct < 80 THEN 'media' ELSE 'alta' END AS coverage, n_keys, hhi,
  CASE WHEN hhi < 1500 THEN 'non concentrato' WHEN hhi < 2500 THEN 'moderatamente concentrato' ELSE 'altamente concentrato' END AS band, n_valid >= 10 AS reliable
FROM b WHERE n_valid >= {least}"""


@query(_summary_sql("lineitem", "l_suppkey"))
def concentration_suppliers(spark: SparkSession, root: str) -> DataFrame:
    return concentration.summary(table(spark, root, "lineitem"), "l_suppkey")


@query("WITH c AS (SELECT l_suppkey AS k, count(*) AS n FROM lineitem GROUP BY 1) SELECT round(sum(pow(n * 100.0::DOUBLE / (SELECT sum(n) FROM c), 2)), 1)::DOUBLE AS hhi FROM c")
def ag1_hhi(spark: SparkSession, root: str) -> DataFrame:
    return concentration.hhi(table(spark, root, "lineitem"), "l_suppkey")


@query(_summary_sql(RECORDS, "dominio_radice"))
def ag2_concentration_block(spark: SparkSession, root: str) -> DataFrame:
    return concentration.summary(table(spark, root, RECORDS), "dominio_radice")


_MODAL = """c AS (SELECT nullif(trim(dominio_radice), '') AS key, nullif(trim(nome_ente), '') AS label, count(*) AS n FROM site_records GROUP BY ALL),
m AS (SELECT key, sum(n)::BIGINT AS n, coalesce(first(label ORDER BY n DESC, label) FILTER (label IS NOT NULL), key) AS label FROM c WHERE key IS NOT NULL GROUP BY key)"""


@query(f"WITH {_MODAL} SELECT key, label, n FROM m")
def ag3_modal_label(spark: SparkSession, root: str) -> DataFrame:
    return concentration.modal_labels(table(spark, root, RECORDS), "dominio_radice", "nome_ente")


@query(_summary_sql("(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1)", "o_orderpriority"))
def ag4_concentration_first_per_key(spark: SparkSession, root: str) -> DataFrame:
    return concentration.deduplicated_summary(table(spark, root, "orders"), "o_orderpriority", "o_custkey", ["o_orderkey"])


@query("""WITH e AS (SELECT trim(x) AS x FROM (SELECT unnest(string_split(http_errore_classificazione, ';')) AS x FROM tipo_ente_possibili_non_pubblici) WHERE trim(x) <> '')
SELECT type, class, count(*) AS n FROM (SELECT trim(split_part(x, ':', 1)) AS type, CASE WHEN lower(x) LIKE '%429%' THEN 'rate_limited' WHEN lower(x) LIKE '%timeout%' OR lower(x) LIKE '%timed out%' THEN 'timeout'
 WHEN regexp_matches(lower(x), 'connectionrefused|connectionreset|connectionerror|connection refused') THEN 'connessione_rifiutata' WHEN regexp_matches(lower(x), 'nxdomain|noanswer|nonameservers') THEN 'dns_non_risolto'
 WHEN regexp_matches(lower(x), 'sslerror|sslcertverificationerror|handshake|certificateerror') THEN 'tls_fallito' WHEN regexp_matches(lower(x), '403|406|503|forbidden') THEN 'bloccato_http' ELSE 'sconosciuto' END AS class FROM e) WHERE type <> '' GROUP BY ALL""")
def ag5_error_summary(spark: SparkSession, root: str) -> DataFrame:
    return distributions.error_summary(table(spark, root, TYPES), text.split_list(F.col("http_errore_classificazione")), network.error_class(F.col("type"), F.col("detail")))


@query("""SELECT confidenza_natura AS key, count(*) AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM siti_classificati), 1)::DOUBLE AS pct FROM siti_classificati
WHERE coalesce(trim(confidenza_natura), '') <> '' GROUP BY 1""")
def ag6_policy_distribution(spark: SparkSession, root: str) -> DataFrame:
    return distributions.distribution(table(spark, root, SITES), F.col("confidenza_natura"))


_DAYS_SQL = "CAST(floor((epoch(l_shipdate) - epoch(TIMESTAMP '1997-01-01')) / 86400) AS INT)"


@query(f"SELECT count(*) AS n, count(d) AS known, count(*) FILTER (d < 0) AS expired, count(*) FILTER (d BETWEEN 0 AND 30) AS within_30, count(*) FILTER (d > 30) AS later FROM (SELECT {_DAYS_SQL} AS d FROM lineitem)")
def ag7_expiry_bands(spark: SparkSession, root: str) -> DataFrame:
    return distributions.expiry_bands(table(spark, root, "lineitem"), network.days_left(F.col("l_shipdate"), F.lit("1997-01-01").cast("timestamp")))


@query("""SELECT CASE WHEN http_status_classificazione BETWEEN 200 AND 299 THEN '2xx' WHEN http_status_classificazione BETWEEN 300 AND 399 THEN '3xx' WHEN http_status_classificazione BETWEEN 400 AND 499 THEN '4xx'
WHEN http_status_classificazione BETWEEN 500 AND 599 THEN '5xx' WHEN http_status_classificazione IS NULL THEN 'nessuna_risposta' ELSE 'altro' END AS band, count(*) AS n FROM tipo_ente_possibili_non_pubblici GROUP BY 1""")
def ag8_status_bands(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, TYPES).groupBy(bands.status_band(F.col("http_status_classificazione")).alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH g AS (SELECT CASE WHEN lower(p_name) LIKE '%aws%' THEN 'USA' WHEN lower(p_name) LIKE '%google%' THEN 'USA' ELSE 'Non riconosciuto (IT)' END AS area FROM part)
SELECT area AS key, count(*) AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM g), 1)::DOUBLE AS pct FROM g GROUP BY 1""")
def ag9_macro_areas(spark: SparkSession, root: str) -> DataFrame:
    label = network.jurisdiction(F.col("p_name"), F.lit("IT"))
    return distributions.distribution(table(spark, root, "part"), network.macro_area(label))


def _category_items() -> Column:
    return F.transform(text.split_list(F.col("categorie_rilevate_punteggi")), lambda x: strip(F.split_part(x, F.lit(":"), F.lit(1))))


@query("""SELECT item, count(*) AS n FROM (SELECT trim(split_part(x, ':', 1)) AS item FROM (SELECT unnest(string_split(categorie_rilevate_punteggi, ';')) AS x FROM tipo_ente_possibili_non_pubblici) WHERE x <> '')
GROUP BY 1 ORDER BY n DESC, item LIMIT 10""")
def ag10_top_categories(spark: SparkSession, root: str) -> DataFrame:
    return distributions.top_items(table(spark, root, TYPES), _category_items(), 10)


@query("""WITH r AS (SELECT list_distinct(list_filter(list_transform(string_split(coalesce(stadi, ''), '+'), lambda x: trim(x)), lambda x: x <> '')) AS items FROM siti_classificati),
b AS (SELECT count(*) AS n_total, count(*) FILTER (len(items) > 0) AS n_covered FROM r), c AS (SELECT item, count(*) AS n FROM (SELECT unnest(items) AS item FROM r) GROUP BY 1),
h AS (SELECT count(*) AS n_items, round(10000.0::DOUBLE * sum(n::DOUBLE * n) / (sum(n)::DOUBLE * sum(n)), 1)::DOUBLE AS hhi FROM c)
SELECT n_total, n_covered, round(100.0::DOUBLE * n_covered / n_total, 1)::DOUBLE AS coverage_pct, n_items, hhi,
CASE WHEN hhi < 1500 THEN 'non concentrato' WHEN hhi < 2500 THEN 'moderatamente concentrato' ELSE 'altamente concentrato' END AS band, n_covered >= 10 AS reliable FROM b, h""")
def ag11_presence_concentration(spark: SparkSession, root: str) -> DataFrame:
    return concentration.presence_summary(table(spark, root, SITES), text.split_list(F.col("stadi"), "+"))


@query(f"WITH {_software_sql('doc_id')} SELECT software, count(*) AS n FROM f GROUP BY 1")
def ag12_software(spark: SparkSession, root: str) -> DataFrame:
    found = rules.software_found(table(spark, root, "documents"), ["doc_id"], "text", rules=_MARKS)
    return found.groupBy("software").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(value) AS n, round(avg(value), 4)::DOUBLE AS mean, round(median(value), 4)::DOUBLE AS median, round(quantile_cont(value, 0.95), 4)::DOUBLE AS p95, round(max(value), 4)::DOUBLE AS max FROM events")
def ag13_score_summary(spark: SparkSession, root: str) -> DataFrame:
    return distributions.spread(table(spark, root, "events"), F.col("value"), digits=4)


_DIMS = {"hosting": 0.35, "mail": 0.20, "dns": 0.15, "terze_parti": 0.30}


@query("""WITH d AS (SELECT c_mktsegment, CASE WHEN avg(c_acctbal) > 4500 THEN least(1.0, avg(c_acctbal) / 10000) END AS hosting, least(1.0, count(*) / 1000.0::DOUBLE) AS mail, CASE WHEN min(c_custkey) > 3 THEN 0.5::DOUBLE END AS dns, count(DISTINCT c_nationkey) / 100.0::DOUBLE AS terze_parti FROM customer GROUP BY 1),
i AS (SELECT *, (CASE WHEN hosting IS NULL THEN 0 ELSE 0.35 END + 0.2 + CASE WHEN dns IS NULL THEN 0 ELSE 0.15 END + 0.3)::DOUBLE AS w, (coalesce(hosting, 0) * 0.35 + mail * 0.2 + coalesce(dns, 0) * 0.15 + terze_parti * 0.3)::DOUBLE AS s FROM d)
SELECT c_mktsegment, round(100 * s / w, 1)::DOUBLE AS index, CASE WHEN 100 * s / w < 25 THEN 'basso' WHEN 100 * s / w < 50 THEN 'moderato' WHEN 100 * s / w < 75 THEN 'alto' ELSE 'molto alto' END AS band,
round(w, 2)::DOUBLE AS weight, concat_ws(',', CASE WHEN hosting IS NOT NULL THEN 'hosting' END, 'mail', CASE WHEN dns IS NOT NULL THEN 'dns' END, 'terze_parti') AS used FROM i""")
def ag14_weighted_index(spark: SparkSession, root: str) -> DataFrame:
    mean = F.avg("c_acctbal")
    dims = table(spark, root, "customer").groupBy("c_mktsegment").agg(
        F.when(mean > 4500, F.least(F.lit(1.0), mean / 10000)).alias("hosting"), F.least(F.lit(1.0), F.count(F.lit(1)) / 1000).alias("mail"),
        F.when(F.min("c_custkey") > 3, F.lit(0.5)).alias("dns"), (F.count_distinct("c_nationkey") / 100).alias("terze_parti"),
    )
    return distributions.dependency_index(dims, _DIMS).drop(*_DIMS)


@query("""SELECT tipo_ente_rilevato, count(tempo_download_pagina_ms) AS n, round(avg(tempo_download_pagina_ms), 3)::DOUBLE AS mean, round(median(tempo_download_pagina_ms), 3)::DOUBLE AS median,
round(quantile_cont(tempo_download_pagina_ms, 0.95), 3)::DOUBLE AS p95, round(max(tempo_download_pagina_ms), 3)::DOUBLE AS max FROM tipo_ente_possibili_non_pubblici GROUP BY 1""")
def ag15_type_times(spark: SparkSession, root: str) -> DataFrame:
    return distributions.spread(table(spark, root, TYPES), F.col("tempo_download_pagina_ms"), ["tipo_ente_rilevato"], 3)


@query("""SELECT count(*) AS n, round(100.0::DOUBLE * count(*) FILTER (probabile_non_pubblico) / count(*), 1)::DOUBLE AS non_public, round(100.0::DOUBLE * count(*) FILTER (pagina_troncata) / count(*), 1)::DOUBLE AS truncated,
round(100.0::DOUBLE * count(*) FILTER (pagina_probabilmente_bloccata) / count(*), 1)::DOUBLE AS blocked FROM tipo_ente_possibili_non_pubblici""")
def ag16_adoption_rates(spark: SparkSession, root: str) -> DataFrame:
    return distributions.rates(table(spark, root, TYPES), {"non_public": F.col("probabile_non_pubblico"), "truncated": F.col("pagina_troncata"), "blocked": F.col("pagina_probabilmente_bloccata")})


@query("SELECT count(*) AS n, count(*) FILTER (punteggio_top <= 1) AS not_redundant FROM tipo_ente_possibili_non_pubblici")
def ag17_low_redundancy(spark: SparkSession, root: str) -> DataFrame:
    return distributions.counts_where(table(spark, root, TYPES), {"not_redundant": F.col("punteggio_top") <= 1})


_EEA_SQL = ", ".join(f"'{c}'" for c in network.EEA)


@query(f"""SELECT count(*) AS n, count(*) FILTER (source_name = 'crawl') AS crawled, count(*) FILTER (coalesce(trim(country_code), '') <> '' AND upper(trim(country_code)) NOT IN ({_EEA_SQL})) AS outside,
count(*) FILTER (source_name = 'crawl' AND coalesce(trim(country_code), '') <> '' AND upper(trim(country_code)) NOT IN ({_EEA_SQL})) AS crawled_outside FROM site_records""")
def ag18_cross_counts(spark: SparkSession, root: str) -> DataFrame:
    crawl, out = F.col("source_name") == "crawl", network.outside_eea(F.col("country_code"))
    return distributions.counts_where(table(spark, root, RECORDS), {"crawled": crawl, "outside": out, "crawled_outside": crawl & out})


@query("SELECT event_type, count(value) AS n, round(avg(value), 3)::DOUBLE AS mean, round(median(value), 3)::DOUBLE AS median, round(quantile_cont(value, 0.95), 3)::DOUBLE AS p95, round(max(value), 3)::DOUBLE AS max FROM events GROUP BY 1")
def ag19_response_times(spark: SparkSession, root: str) -> DataFrame:
    return distributions.spread(table(spark, root, "events"), F.col("value"), ["event_type"], 3)


@query("""WITH g AS (SELECT CASE WHEN l_linenumber IS NULL OR l_quantity IS NULL THEN '' WHEN l_linenumber = 1 THEN 'D' WHEN l_quantity * 8 < 128 THEN 'C' WHEN l_returnflag <> 'N' THEN 'B' ELSE 'A' END AS grade FROM lineitem)
SELECT count(*) AS n, count(*) FILTER (grade = 'A') AS A, count(*) FILTER (grade = 'B') AS B, count(*) FILTER (grade = 'C') AS C, count(*) FILTER (grade = 'D') AS D FROM g""")
def ag20_grades(spark: SparkSession, root: str) -> DataFrame:
    protocols = F.when(F.col("l_linenumber") == 1, F.array(F.lit("TLSv1"), F.lit("TLSv1.2"))).otherwise(F.array(F.lit("TLSv1.2")))
    grade = network.tls_grade(protocols, F.col("l_quantity") * 8, F.col("l_returnflag") == "N")
    return distributions.counts_where(table(spark, root, "lineitem").withColumn("g", grade), {g: F.col("g") == g for g in "ABCD"})


@query(_summary_sql(RECORDS, "dominio_radice", ["sector"], 10))
def ag21_by_sector(spark: SparkSession, root: str) -> DataFrame:
    return concentration.summary(table(spark, root, RECORDS), "dominio_radice", ["sector"], min_valid=10)


@query("WITH s AS (" + _summary_sql(TYPES, "regione", ["tipo_ente_rilevato"]) + """), m AS (SELECT tipo_ente_rilevato, round(median(peso_pagina_kb), 3)::DOUBLE AS median_kb FROM tipo_ente_possibili_non_pubblici GROUP BY 1)
SELECT s.tipo_ente_rilevato, n_total, median_kb, CASE WHEN reliable THEN hhi END AS hhi FROM s JOIN m ON s.tipo_ente_rilevato IS NOT DISTINCT FROM m.tipo_ente_rilevato""")
def ag22_by_type_with_medians(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, TYPES)
    own = concentration.summary(rows, "regione", ["tipo_ente_rilevato"])
    mid = rows.groupBy(F.col("tipo_ente_rilevato").alias("t")).agg(F.round(F.median("peso_pagina_kb"), 3).alias("median_kb"))
    return own.join(mid, own["tipo_ente_rilevato"].eqNullSafe(mid["t"])).select("tipo_ente_rilevato", "n_total", "median_kb", F.when(F.col("reliable"), F.col("hhi")).alias("hhi"))


@query(_summary_sql("(SELECT * FROM site_records WHERE coalesce(trim(regione), '') <> '')", "dominio_radice", ["regione"], 10))
def ag23_by_region(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, RECORDS).filter(F.coalesce(strip("regione"), F.lit("")) != "")
    return concentration.summary(rows, "dominio_radice", ["regione"], min_valid=10)


@query("""WITH h AS (SELECT hostname, count(*) AS n FROM site_records WHERE coalesce(trim(hostname), '') <> '' GROUP BY 1)
SELECT rec_id, hostname, coalesce(n, 0) AS n_sharing, coalesce(n, 0) > 1 AS shared FROM site_records LEFT JOIN h USING (hostname)""")
def ag24_shared_hosts(spark: SparkSession, root: str) -> DataFrame:
    return rollups.shared_hosts(table(spark, root, RECORDS), "hostname", ["rec_id"])


@query("""SELECT user_id, arg_min(event_type, struct_pack(u := ts IS NULL, t := ts, i := event_id)) AS event_type, arg_min(value, struct_pack(u := ts IS NULL, t := ts, i := event_id)) AS value, count(DISTINCT event_type) AS n_pages FROM events GROUP BY 1""")
def ag25_first_seen(spark: SparkSession, root: str) -> DataFrame:
    return rollups.first_seen(table(spark, root, "events"), "user_id", "ts", "event_id", ["event_type", "value"], "event_type")


@query(f"""WITH r AS (SELECT doc_id, country_code, u, lower(regexp_extract(u, '://([^/?#:]*)', 1)) AS d FROM (SELECT doc_id, country_code, unnest(regexp_extract_all(text, 'src="([^"]+)"', 1)) AS u FROM documents)),
o AS (SELECT doc_id, d, min({_vendor_sql('u', 'category')}) AS c, min({_vendor_sql('u', 'parent')}) AS p, min(nullif(trim(country_code), '')) AS y FROM r GROUP BY 1, 2), x AS (SELECT *, CASE WHEN upper(trim(y)) NOT IN ({_EEA_SQL}) THEN d || '(' || y || ')' END AS o FROM o)
SELECT doc_id, count(*) AS n_third, array_to_string(list_sort(list_distinct(list(c))), ';') AS categories, array_to_string(list_sort(list(d)), ';') AS domains, array_to_string(list_sort(list_distinct(list(p))), ';') AS parents, count(o) AS n_outside, coalesce(array_to_string(list_sort(list(o) FILTER (o IS NOT NULL)), ';'), '') AS outside,
count(*) FILTER (y IS NULL) AS n_unknown FROM x GROUP BY 1""")
def ag26_third_parties_by_page(spark: SparkSession, root: str) -> DataFrame:
    refs = table(spark, root, "documents").select("doc_id", "country_code", F.explode(F.regexp_extract_all("text", F.lit('src="([^"]+)"'), F.lit(1))).alias("u"))
    rows = refs.select("doc_id", "country_code", urls.host_of(F.col("u")).alias("domain"), rules.third_party(F.col("u")).alias("t")).select("*", "t.category", "t.parent")
    return rollups.third_party_by_host(rows, "doc_id", "domain", "category", "parent", "country_code")


@query(f"""WITH c AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, 'cookie (\\S+)', 1)) AS name FROM documents), k AS (SELECT doc_id, name, {_cookie_sql('name')} AS k FROM c)
SELECT doc_id, count(*) AS n_cookies, count(*) FILTER (k = 'tecnico') AS n_technical, count(*) FILTER (k = 'profilazione') AS n_profiling, count(*) FILTER (k = 'sconosciuto') AS n_unknown,
coalesce(array_to_string(list_sort(list(name) FILTER (k = 'profilazione')), ';'), '') AS profiling FROM k GROUP BY 1""")
def ag27_cookies_by_page(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"cookie (\S+)"), F.lit(1))).alias("name"))
    return rollups.cookies_by_host(rows, "doc_id", "name", rules.cookie_class(F.col("name")))


@query(f"""WITH {_software_sql('hostname')}, o AS (SELECT hostname, software, max(version) AS version, min(licence) AS licence, bool_and(coalesce(open, false)) AS open FROM f GROUP BY 1, 2)
SELECT hostname, array_to_string(list_sort(list(software)), ';') AS software, array_to_string(list_sort(list_distinct(list(licence))), ';') AS licences, coalesce(array_to_string(list_sort(list(software || ' ' || version) FILTER (version <> '')), ';'), '') AS versions, bool_and(open) AS all_open FROM o GROUP BY 1""")
def ag28_software_by_host(spark: SparkSession, root: str) -> DataFrame:
    return rollups.software_by_host(rules.software_found(table(spark, root, "documents"), ["hostname"], "text", rules=_MARKS), "hostname")


@query("""WITH r AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events WHERE value IS NOT NULL)
SELECT user_id, value, n FROM r WHERE i = CASE WHEN abs(0.95 * (n - 1) - floor(0.95 * (n - 1)) - 0.5) < 1e-9 THEN 2 * round(0.95 * (n - 1) / 2) ELSE round(0.95 * (n - 1)) END""")
def ag29_nearest_rank(spark: SparkSession, root: str) -> DataFrame:
    return distributions.nearest_rank(table(spark, root, "events"), ["user_id"], "value").select("user_id", "value", "n")


@query("""WITH n AS (SELECT 'h' || user_id AS hostname, event_id AS ord, event_type <> 'error' AS ok, event_type AS mx, value AS v FROM events),
o AS (SELECT hostname, count(*) AS n_ns, count(*) FILTER (ok) AS n_reachable, arg_min(mx, CASE WHEN ok THEN ord END) AS first_mx, round(count(*) FILTER (ok) / count(*)::DOUBLE, 4) AS ns_ratio, count(DISTINCT CASE WHEN ok THEN mx END) > 1 AS mx_differ FROM n GROUP BY 1),
e AS (SELECT hostname, count(*) AS n_endpoints, count(*) FILTER (v > 10) AS tcp_ok, count(*) FILTER (v > 20) AS tls_ok, count(*) FILTER (v > 30) AS http_ok, round(median(v), 1)::DOUBLE AS median_ms, round(count(*) FILTER (v > 30) / count(*)::DOUBLE, 4) AS http_ratio FROM n GROUP BY 1),
r AS (SELECT hostname, v, row_number() OVER (PARTITION BY hostname ORDER BY v) - 1 AS i, count(*) OVER (PARTITION BY hostname) AS n FROM n WHERE v IS NOT NULL),
p AS (SELECT hostname, v AS p95_ms FROM r WHERE i = CASE WHEN abs(0.95 * (n - 1) - floor(0.95 * (n - 1)) - 0.5) < 1e-9 THEN 2 * round(0.95 * (n - 1) / 2) ELSE round(0.95 * (n - 1)) END)
SELECT o.hostname, n_ns, n_reachable, ns_ratio, mx_differ, n_endpoints, tcp_ok, tls_ok, http_ok, median_ms, http_ratio, p95_ms, round(((round(ns_ratio * 10000)::BIGINT + round(http_ratio * 10000)::BIGINT + 1) // 2) / 10000.0::DOUBLE, 4)::DOUBLE AS score FROM o JOIN e ON o.hostname = e.hostname LEFT JOIN p ON o.hostname = p.hostname""")
def ag29_resilience(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "events")
    host = F.concat(F.lit("h"), F.col("user_id"))
    ns = rows.select(host.alias("hostname"), F.col("event_id").alias("ord"), (F.col("event_type") != "error").alias("reachable"), F.col("event_type").alias("mx"))
    ends = rows.select(host.alias("hostname"), (F.col("value") > 10).alias("tcp_ok"), (F.col("value") > 20).alias("tls_ok"), (F.col("value") > 30).alias("http_ok"), F.col("value").alias("latency_ms"))
    return rollups.resilience_by_host(ns, ends)


_COUNTRIES = ["IT", "FR", "DE", "ES"]
_CELLS = ", ".join(f"count(*) FILTER (country_code = '{c}') AS {c}" for c in _COUNTRIES)


@query(f"SELECT sector, {_CELLS} FROM site_records GROUP BY 1 UNION ALL SELECT 'TOTALE' AS sector, {_CELLS} FROM site_records")
def ag30_matrix_with_total(spark: SparkSession, root: str) -> DataFrame:
    return distributions.matrix_with_total(table(spark, root, RECORDS), "sector", "country_code", _COUNTRIES)


@query("SELECT country_code, count(*) AS n, count(DISTINCT hostname) AS n_hosts, max(retrieved_at) AS last FROM site_records GROUP BY 1")
def ag31_country_summary(spark: SparkSession, root: str) -> DataFrame:
    return rollups.summary_by(table(spark, root, RECORDS), ["country_code"], distinct={"n_hosts": "hostname"}, last={"last": "retrieved_at"})


@query("""WITH r AS (SELECT country_code, coalesce(tipo_link, '') AS scope, coalesce(source_name, '') AS outcome FROM site_records), b AS (SELECT * FROM r UNION ALL SELECT 'TOTALE', scope, outcome FROM r)
SELECT country_code, 'scope' AS kind, scope AS key, count(*) AS n FROM b WHERE country_code IS NOT NULL GROUP BY 1, 3 UNION ALL SELECT country_code, 'outcome', outcome, count(*) FROM b WHERE country_code IS NOT NULL GROUP BY 1, 3""")
def ag32_crawl_stats(spark: SparkSession, root: str) -> DataFrame:
    return rollups.crawl_counts(table(spark, root, RECORDS), "country_code", "tipo_link", "source_name")


@query("""SELECT dominio_radice, count(DISTINCT concat_ws(': ', country_code, found_on)) AS n_pages, coalesce(array_to_string(list_sort(list_distinct(list(tipo_link) FILTER (tipo_link IS NOT NULL))), ','), '') AS kinds,
bool_and(starts_with(lower(hostname), 'https://')) AS https_only FROM site_records GROUP BY 1""")
def ag33_domain_meta(spark: SparkSession, root: str) -> DataFrame:
    return rollups.domain_meta(table(spark, root, RECORDS), "dominio_radice", "country_code", "found_on", "tipo_link", "hostname")


@query("SELECT rec_id AS id, hostname FROM site_records UNION ALL SELECT riga_id AS id, hostname FROM siti_classificati")
def ag34_union_of_occurrences(spark: SparkSession, root: str) -> DataFrame:
    return sets.union_all([table(spark, root, RECORDS).select(F.col("rec_id").alias("id"), "hostname"), table(spark, root, SITES).select(F.col("riga_id").alias("id"), "hostname")])


@query("SELECT source_seed, sector, count(*) AS pages, count(DISTINCT hostname) AS hosts FROM site_records GROUP BY 1, 2")
def ag35_progress(spark: SparkSession, root: str) -> DataFrame:
    return rollups.progress(table(spark, root, RECORDS), "source_seed", "sector", "hostname")


@query("""WITH h AS (SELECT dominio_radice, hostname, min(rec_id) AS o FROM site_records GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY dominio_radice ORDER BY o, hostname) AS r FROM h),
l AS (SELECT dominio_radice, array_to_string(list(hostname ORDER BY r) FILTER (hostname IS NOT NULL), '|') AS hosts FROM r WHERE r <= 50 GROUP BY 1),
f AS (SELECT dominio_radice, arg_min(nome_ente, rec_id) AS nome_ente, bool_or(tls) AS tls FROM (SELECT *, coalesce(tls_error, '') <> '' AS tls FROM site_records) GROUP BY 1)
SELECT f.dominio_radice, nome_ente, tls, coalesce(hosts, '') AS hosts FROM f JOIN l ON f.dominio_radice = l.dominio_radice""")
def ag36_registry(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, RECORDS).withColumn("name", F.struct("nome_ente")).withColumn("tls", F.coalesce("tls_error", F.lit("")) != "")
    return rollups.registry(rows, "dominio_radice", "hostname", "rec_id", ["name"], ["tls"]).select("dominio_radice", F.col("name.nome_ente").alias("nome_ente"), "tls", "hosts")


@query("SELECT source_seed, country_code, count(*) AS n FROM site_records GROUP BY 1, 2")
def ag37_pages_per_seed_level(spark: SparkSession, root: str) -> DataFrame:
    return rollups.summary_by(table(spark, root, RECORDS), ["source_seed", "country_code"])


@query("SELECT natura, tipo, count(*) AS n FROM siti_classificati GROUP BY 1, 2")
def ag38_nature_type_counts(spark: SparkSession, root: str) -> DataFrame:
    return rollups.summary_by(table(spark, root, SITES), ["natura", "tipo"])


@query("""WITH s AS (SELECT regione, count(*) AS tries, count(*) FILTER (http_status_classificazione < 400) AS ok FROM tipo_ente_possibili_non_pubblici GROUP BY 1)
SELECT *, round(100.0::DOUBLE * ok / tries, 1)::DOUBLE AS rate, tries >= 10 AND round(100.0::DOUBLE * ok / tries, 1) < 50 AS alarm FROM s""")
def ag39_success_rate(spark: SparkSession, root: str) -> DataFrame:
    return distributions.success_rate(table(spark, root, TYPES), F.col("http_status_classificazione") < 400, ["regione"])


# -- rankings


@query(f"WITH {_MODAL} SELECT key, label, n, round(100.0::DOUBLE * n / (SELECT sum(n) FROM m), 1)::DOUBLE AS share_pct FROM m ORDER BY n DESC, key LIMIT 10")
def tk1_top_keys(spark: SparkSession, root: str) -> DataFrame:
    return concentration.top_keys(table(spark, root, RECORDS), "dominio_radice", "nome_ente")


@query("SELECT source, count(*) AS n FROM documents GROUP BY 1 ORDER BY n, source LIMIT 5")
def tk2_rarest(spark: SparkSession, root: str) -> DataFrame:
    return ranking.top_k(table(spark, root, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n")), 5, F.asc("n"), F.asc("source"))


@query("SELECT riga_id, punteggio_top FROM tipo_ente_possibili_non_pubblici ORDER BY punteggio_top DESC NULLS LAST, riga_id LIMIT 100")
def tk3_risk_order(spark: SparkSession, root: str) -> DataFrame:
    return ranking.top_k(table(spark, root, TYPES).select("riga_id", "punteggio_top"), 100, F.desc_nulls_last("punteggio_top"), F.asc("riga_id"))


@query("SELECT riga_id, natura, confidenza_natura FROM siti_classificati ORDER BY CASE natura WHEN 'privato' THEN 0 WHEN 'incerto' THEN 1 ELSE 2 END, confidenza_natura DESC NULLS LAST, riga_id LIMIT 200")
def tk4_shortlist_order(spark: SparkSession, root: str) -> DataFrame:
    verdict = F.when(F.col("natura") == "privato", 0).when(F.col("natura") == "incerto", 1).otherwise(2)
    return ranking.top_k(table(spark, root, SITES).select("riga_id", "natura", "confidenza_natura"), 200, verdict, F.desc_nulls_last("confidenza_natura"), F.asc("riga_id"))


@query("SELECT found_on, count(DISTINCT hostname) AS n FROM site_records GROUP BY 1 ORDER BY n, found_on NULLS FIRST LIMIT 50")
def tk5_by_rarity(spark: SparkSession, root: str) -> DataFrame:
    return ranking.top_k(table(spark, root, RECORDS).groupBy("found_on").agg(F.count_distinct("hostname").alias("n")), 50, F.asc("n"), F.asc_nulls_first("found_on"))


@query("""WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS turn, min(doc_id) OVER (PARTITION BY source) AS seen FROM documents)
SELECT doc_id, source, turn FROM r ORDER BY turn, seen LIMIT 120""")
def tk6_fair_cap(spark: SparkSession, root: str) -> DataFrame:
    return ranking.fair_cap(table(spark, root, "documents").select("doc_id", "source"), "source", "doc_id", 120).select("doc_id", "source", "turn")


_SAMPLE = "SELECT riga_id, natura, tipo FROM (SELECT *, row_number() OVER (PARTITION BY natura, tipo ORDER BY md5('7:' || riga_id), riga_id) AS rn FROM {}) WHERE rn <= 5"


@query(_SAMPLE.format("siti_classificati"))
def tk7_stratified_sample(spark: SparkSession, root: str) -> DataFrame:
    return ranking.stratified_sample(table(spark, root, SITES).select("riga_id", "natura", "tipo"), ["natura", "tipo"], "riga_id", 5, 7)


_OLD_NEW = """o AS (SELECT dominio_radice, min(sector) AS before FROM site_records WHERE source_name = 'crawl' GROUP BY 1), w AS (SELECT dominio_radice, min(sector) AS after FROM site_records WHERE source_name <> 'crawl' GROUP BY 1),
d AS (SELECT dominio_radice, before, after FROM o JOIN w USING (dominio_radice) WHERE before IS DISTINCT FROM after)"""


def _changed(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, RECORDS)
    return sets.changed_values(rows.filter("source_name = 'crawl'"), rows.filter("source_name <> 'crawl'"), "dominio_radice", "sector")


@query(f"WITH {_OLD_NEW} SELECT dominio_radice, before, after FROM (SELECT *, row_number() OVER (PARTITION BY before, after ORDER BY md5('3:' || dominio_radice), dominio_radice) AS rn FROM d) WHERE rn <= 3")
def tk8_changed_sample(spark: SparkSession, root: str) -> DataFrame:
    return ranking.stratified_sample(_changed(spark, root), ["before", "after"], "dominio_radice", 3, 3)


@query("SELECT riga_id FROM tipo_ente_possibili_non_pubblici WHERE probabile_non_pubblico OR punteggio_top >= 10 OR peso_pagina_kb > 300 ORDER BY CASE WHEN probabile_non_pubblico THEN 0 ELSE 1 END, punteggio_top DESC NULLS LAST, riga_id LIMIT 480")
def tk9_candidates_by_priority(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, TYPES).filter("probabile_non_pubblico or punteggio_top >= 10 or peso_pagina_kb > 300")
    order = [F.when(F.col("probabile_non_pubblico"), 0).otherwise(1), F.desc_nulls_last("punteggio_top"), F.asc("riga_id")]
    return ranking.quota_cut(rows, order, 480).select("riga_id")


@query("""SELECT codice_ipa, arg_max(hostname, struct_pack(s := s, r := -rec_id)) AS hostname, max(s) AS score FROM (SELECT codice_ipa, hostname, rec_id, length(coalesce(dominio_radice, ''))::DOUBLE / 100 AS s FROM site_records WHERE hostname IS NOT NULL AND codice_ipa IS NOT NULL) WHERE s >= 0.1 GROUP BY 1""")
def tk11_best_candidate(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, RECORDS).filter("hostname is not null and codice_ipa is not null").select("codice_ipa", "hostname", "rec_id", (F.length(F.coalesce("dominio_radice", F.lit(""))) / 100).alias("score"))
    return ranking.best_candidate(rows, "codice_ipa", "hostname", "score", "rec_id", 0.1)


_KEYWORDS = {"comune": ["comune", "commune", "gemeinde"], "scuola": ["scuola", "école", "schule"], "polizia": ["polizia", "police", "polizei"]}
_POINTS = ", ".join("({})::BIGINT AS {}".format(" + ".join(f"CASE WHEN contains(h, '{w}') THEN 3 WHEN contains(b, '{w}') THEN 1 ELSE 0 END" for w in ws), c) for c, ws in _KEYWORDS.items())


_HEAD_BODY = "t AS (SELECT riga_id, lower(coalesce(nome_ente, '') || ' ' || coalesce(ente_rilevato, '')) AS h, lower(coalesce(evidenza, '')) AS b FROM siti_classificati)"


def _keyword_points(spark: SparkSession, root: str) -> DataFrame:
    head = F.concat_ws(" ", F.coalesce("nome_ente", F.lit("")), F.coalesce("ente_rilevato", F.lit("")))
    return rules.keyword_scores(table(spark, root, SITES), ["riga_id"], head, F.col("evidenza"), _KEYWORDS)


@query(f"""WITH {_HEAD_BODY}, s AS (SELECT riga_id, {_POINTS} FROM t)
SELECT riga_id, CASE WHEN greatest(comune, scuola, polizia) = 0 THEN NULL WHEN comune >= scuola AND comune >= polizia THEN 'comune' WHEN scuola >= polizia THEN 'scuola' ELSE 'polizia' END AS category FROM s""")
def tk12_top_category(spark: SparkSession, root: str) -> DataFrame:
    return _keyword_points(spark, root).select("riga_id", rules.top_category(list(_KEYWORDS)).alias("category"))


@query("SELECT rec_id, dominio_radice FROM (SELECT *, row_number() OVER (PARTITION BY dominio_radice ORDER BY rec_id) AS rn FROM site_records) WHERE rn <= 3")
def tk13_cap_per_domain(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, RECORDS).select("rec_id", "dominio_radice")
    return ranking.cap_per_group(rows, ["dominio_radice"], [F.col("rec_id")], 3, spread_by="rec_id").drop("__rank")


@query("SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 500 AS batch FROM documents")
def tk14_batches(spark: SparkSession, root: str) -> DataFrame:
    numbered = ranking.dense_numbers(table(spark, root, "documents").select("doc_id"), ["doc_id"])
    return ranking.page_batches(numbered, "number", 500).select("doc_id", "batch")


# -- sets


@query("""SELECT rec_id, hostname FROM (SELECT rec_id, hostname, lower(trim(coalesce(hostname, ''))) AS k, row_number() OVER (PARTITION BY lower(trim(coalesce(hostname, ''))) ORDER BY rec_id) AS rn FROM site_records) WHERE k = '' OR rn = 1""")
def st1_dedupe_keep_blank(spark: SparkSession, root: str) -> DataFrame:
    return sets.dedupe_keep_blank(table(spark, root, RECORDS).select("rec_id", "hostname"), F.lower(strip("hostname")), ["rec_id"])


@query("SELECT rec_id, hostname FROM (SELECT *, row_number() OVER (PARTITION BY hostname ORDER BY rec_id) AS rn FROM site_records) WHERE rn = 1")
def st2_first_per_host(spark: SparkSession, root: str) -> DataFrame:
    return concentration.first_per_key(table(spark, root, RECORDS).select("rec_id", "hostname"), "hostname", ["rec_id"])


@query("SELECT dominio_radice, hostname, min(rec_id) AS first, count(*) AS n_rows FROM site_records GROUP BY 1, 2")
def st3_merge_sites(spark: SparkSession, root: str) -> DataFrame:
    return sets.merge_sites(table(spark, root, RECORDS), "dominio_radice", "hostname", "rec_id")


@query("SELECT DISTINCT hostname, tipo_link, found_on FROM site_records")
def st4_distinct_occurrences(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, RECORDS).select("hostname", "tipo_link", "found_on").dropDuplicates()


@query("SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)")
def st7_frontier_minus_done(spark: SparkSession, root: str) -> DataFrame:
    done = table(spark, root, "customer").filter("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    return sets.new_rows(table(spark, root, "orders"), done, "o_custkey").select("o_orderkey")


@query("""WITH a AS (SELECT DISTINCT dominio_radice FROM site_records WHERE source_name = 'crawl' AND dominio_radice IS NOT NULL), b AS (SELECT DISTINCT dominio_radice FROM site_records WHERE source_name <> 'crawl' AND dominio_radice IS NOT NULL)
SELECT coalesce(a.dominio_radice, b.dominio_radice) AS dominio_radice, CASE WHEN a.dominio_radice IS NULL THEN 'only_new' WHEN b.dominio_radice IS NULL THEN 'only_old' ELSE 'both' END AS side FROM a FULL JOIN b ON a.dominio_radice = b.dominio_radice""")
def st8_key_difference(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, RECORDS).filter("dominio_radice is not null")
    return sets.key_difference(rows.filter("source_name = 'crawl'"), rows.filter("source_name <> 'crawl'"), "dominio_radice")


@query("""SELECT riga_id, x AS stadio FROM (SELECT riga_id, unnest(CASE WHEN len(l) = 0 THEN [''] ELSE l END) AS x FROM (SELECT riga_id, list_filter(string_split(coalesce(stadi, ''), '+'), lambda x: x <> '') AS l FROM siti_classificati))""")
def st10_explode_or_blank(spark: SparkSession, root: str) -> DataFrame:
    return sets.explode_or_blank(table(spark, root, SITES), ["riga_id"], text.split_list(F.col("stadi"), "+"), "stadio")


# -- joins


@query("SELECT c_custkey, coalesce(n_name, '') AS n_name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) ON c_nationkey = n_nationkey")
def jn1_lookup_dimension(spark: SparkSession, root: str) -> DataFrame:
    dim = table(spark, root, "nation").filter("n_nationkey < 20").withColumnRenamed("n_nationkey", "c_nationkey")
    return joins.lookup_dimension(table(spark, root, "customer"), dim, "c_nationkey", ["n_name"]).select("c_custkey", "n_name")


_BY_HOST = "(SELECT hostname, {} FROM {} WHERE hostname IS NOT NULL GROUP BY 1)"


@query(f"""SELECT b.hostname, b.n, t.n AS n_types, c.n AS n_sites, t.kb FROM {_BY_HOST.format('count(*) AS n', RECORDS)} b LEFT JOIN {_BY_HOST.format('count(*) AS n, max(peso_pagina_kb) AS kb', TYPES)} t ON b.hostname = t.hostname
LEFT JOIN {_BY_HOST.format('count(*) AS n', SITES)} c ON b.hostname = c.hostname""")
def jn2_wide_export(spark: SparkSession, root: str) -> DataFrame:
    per = lambda name, *more: table(spark, root, name).filter("hostname is not null").groupBy("hostname").agg(F.count(F.lit(1)).alias("n"), *more)
    return joins.wide_export(per(RECORDS), "hostname", {"types": per(TYPES, F.max("peso_pagina_kb").alias("kb")), "sites": per(SITES)})


@query("""SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000) THEN 'measured' WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') THEN 'listed' ELSE 'absent' END AS state FROM orders""")
def jn3_membership_status(spark: SparkSession, root: str) -> DataFrame:
    keys = table(spark, root, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return joins.membership_status(table(spark, root, "orders"), "o_custkey", keys.filter("c_acctbal > 5000"), keys.filter("c_mktsegment = 'BUILDING'")).select("o_orderkey", "state")


@query("SELECT o_orderkey, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def jn4_measurements_with_sector(spark: SparkSession, root: str) -> DataFrame:
    dim = table(spark, root, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return joins.lookup_dimension(table(spark, root, "orders"), dim, "o_custkey", ["c_mktsegment"], None).select("o_orderkey", "c_mktsegment")


@query("SELECT l_orderkey, l_linenumber, p_type FROM lineitem JOIN part ON l_partkey = p_partkey")
def jn5_measurements_with_type(spark: SparkSession, root: str) -> DataFrame:
    dim = table(spark, root, "part").withColumnRenamed("p_partkey", "l_partkey")
    return joins.lookup_dimension(table(spark, root, "lineitem"), dim, "l_partkey", ["p_type"], None, "inner").select("l_orderkey", "l_linenumber", "p_type")


@query("""WITH s AS (SELECT codice_ipa, min(sector) AS sector FROM site_records WHERE codice_ipa <> '' GROUP BY 1), j AS (SELECT tipo_ente_rilevato, sector FROM tipo_ente_possibili_non_pubblici JOIN s USING (codice_ipa) WHERE sector IN ('comune', 'scuola', 'universita', 'sanita'))
SELECT count(*) AS n, CASE WHEN count(*) > 0 THEN round(100.0::DOUBLE * count(*) FILTER (tipo_ente_rilevato = sector) / count(*), 1) ELSE 0.0 END::DOUBLE AS agree_pct FROM j""")
def jn6_agreement(spark: SparkSession, root: str) -> DataFrame:
    sector = table(spark, root, RECORDS).filter("codice_ipa <> ''").groupBy("codice_ipa").agg(F.min("sector").alias("sector"))
    return distributions.agreement(table(spark, root, TYPES).join(sector, "codice_ipa"), "tipo_ente_rilevato", "sector", ["comune", "scuola", "universita", "sanita"])


@query(f"SELECT rec_id, kb FROM site_records r LEFT JOIN {_BY_HOST.format('max(peso_pagina_kb) AS kb', TYPES)} h ON r.hostname = h.hostname")
def jn7_host_fan_out(spark: SparkSession, root: str) -> DataFrame:
    facts = table(spark, root, TYPES).filter("hostname is not null").groupBy("hostname").agg(F.max("peso_pagina_kb").alias("kb"))
    return joins.fan_out(table(spark, root, RECORDS).select("rec_id", "hostname"), facts, "hostname").select("rec_id", "kb")


_IPS_SQL = "(SELECT doc_id, unnest(regexp_extract_all(text, '\\d{1,3}\\.\\d{1,3}\\.\\d{1,3}\\.\\d{1,3}')) AS ip FROM documents)"


@query(f"SELECT regexp_replace(ip, '\\.\\d+$', '.0/24') AS block, arg_min(ip, struct_pack(d := doc_id, i := ip)) AS representative, count(*) AS n_ips FROM {_IPS_SQL} GROUP BY 1")
def jn8_block_representatives(spark: SparkSession, root: str) -> DataFrame:
    ips = table(spark, root, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})"), F.lit(1))).alias("ip"))
    return joins.block_representatives(ips.withColumn("o", F.struct("doc_id", "ip")), "ip", "o", network.ip_block(F.col("ip")))


@query(f"WITH {_OLD_NEW} SELECT * FROM d")
def jn9_changed_between_runs(spark: SparkSession, root: str) -> DataFrame:
    return _changed(spark, root)


@query("""SELECT n.c_custkey, coalesce(p.flag, false) AS flag FROM customer n LEFT JOIN (SELECT c_custkey, max(c_acctbal > 8000) AS flag FROM customer WHERE c_nationkey < 10 GROUP BY 1) p ON n.c_custkey = p.c_custkey""")
def jn10_carry_forward(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "customer")
    old = rows.filter("c_nationkey < 10").withColumn("flag", F.col("c_acctbal") > 8000)
    return joins.carry_forward(rows.select("c_custkey"), old, "c_custkey", {"flag": False}).select("c_custkey", "flag")


@query("SELECT rec_id, coalesce(v.natura, 'non_controllato') AS verdict FROM site_records r LEFT JOIN (SELECT hostname, min(natura) AS natura FROM siti_classificati WHERE hostname IS NOT NULL GROUP BY 1) v ON r.hostname = v.hostname")
def jn11_verdict_or_default(spark: SparkSession, root: str) -> DataFrame:
    v = table(spark, root, SITES).filter("hostname is not null").groupBy("hostname").agg(F.min("natura").alias("verdict"))
    out = salted_join(table(spark, root, RECORDS).select("rec_id", "hostname"), v, ["hostname"], "rec_id", "left")
    return out.select("rec_id", F.coalesce("verdict", F.lit("non_controllato")).alias("verdict"))


@query(f"""WITH h AS (SELECT rec_id, rtrim({_BARE_SQL.format('hostname')}, '.') AS h FROM site_records), d AS (SELECT DISTINCT dominio_radice AS domain FROM site_records WHERE dominio_radice <> '' AND regexp_matches(dominio_radice, '^[a-z0-9-]+(\\.[a-z0-9-]+)*$'))
SELECT rec_id, domain FROM h JOIN d ON h = domain OR ends_with(h, '.' || domain) OR (h <> '' AND ends_with(domain, '.' || h))""")
def jn12_suffix_match(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, RECORDS)
    listed = rows.select(F.col("dominio_radice").alias("domain")).filter("domain <> '' and domain rlike '^[a-z0-9-]+(\\\\.[a-z0-9-]+)*$'").distinct()
    return rules.match_either_way(rows.select("rec_id", _bare(F.col("hostname")).alias("host")), "host", listed, "domain", "rec_id").select("rec_id", "domain")


@query("SELECT DISTINCT hostname, 'wikidata' AS \"column\", wikidata AS value FROM siti_classificati WHERE wikidata <> '' UNION SELECT DISTINCT hostname, 'tipo', tipo FROM siti_classificati WHERE tipo <> ''")
def jn13_values_by_host(spark: SparkSession, root: str) -> DataFrame:
    return joins.values_by_host(table(spark, root, SITES), "hostname", ["wikidata", "tipo"])


@query("SELECT user_id, event_type, max(ts) AS ts, arg_max(value, struct_pack(a := ts, b := event_id)) AS value FROM events GROUP BY 1, 2")
def jn15_latest_per_key(spark: SparkSession, root: str) -> DataFrame:
    return joins.latest_per_key(table(spark, root, "events"), ["user_id", "event_type"], "ts", "event_id", ["value"])


@query("SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def fl4_resume_anti_join(spark: SparkSession, root: str) -> DataFrame:
    done = table(spark, root, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return sets.new_rows(table(spark, root, "orders"), done, "o_orderkey").select("o_orderkey")


# -- filters


@query(f"SELECT rec_id FROM site_records WHERE sector IN ('comune', 'scuola') AND {_FOLD_SQL.format('regione')} = {_FOLD_SQL.format("'Regione  IT-5!'")}")
def fl1_category_and_region(spark: SparkSession, root: str) -> DataFrame:
    wanted = text.same_text(F.col("regione"), F.lit("Regione  IT-5!"))
    return table(spark, root, RECORDS).filter(F.col("sector").isin("comune", "scuola") & wanted).select("rec_id")


_CLEAN_SQL = "regexp_matches(rtrim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(coalesce(hostname, ''))), '^[a-z][a-z0-9+.-]*://', ''), '(?s)[/?#].*$', ''), '^[^@]*@', ''), ':\\d+$', ''), '.'), '^[^\\s./]+(?:\\.[^\\s./]+)+$')"


@query(f"SELECT rec_id FROM site_records WHERE {_CLEAN_SQL} ORDER BY rec_id LIMIT 500")
def fl2_limit_after_cleanup(spark: SparkSession, root: str) -> DataFrame:
    return ranking.top_k(table(spark, root, RECORDS).filter(urls.clean_hostname(F.col("hostname")).isNotNull()).select("rec_id"), 500, F.asc("rec_id"))


@query(f"SELECT rec_id, CASE WHEN {_CLEAN_SQL} THEN 'valid' ELSE 'rejected' END AS side FROM site_records")
def fl3_valid_and_rejected(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, RECORDS).select("rec_id", F.when(urls.clean_hostname(F.col("hostname")).isNotNull(), "valid").otherwise("rejected").alias("side"))


@query("SELECT rec_id FROM site_records WHERE trim(codice_ipa) <> ''")
def fl5_filled_key(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, RECORDS).filter(strip("codice_ipa") != "").select("rec_id")


@query(f"SELECT rec_id FROM site_records WHERE coalesce(trim(country_code), '') <> '' AND upper(trim(country_code)) NOT IN ({_EEA_SQL})")
def fl7_outside_area(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, RECORDS).filter(network.outside_eea(F.col("country_code"))).select("rec_id")


@query("SELECT riga_id FROM siti_classificati WHERE natura = 'incerto' OR coalesce(try_cast(confidenza_natura AS DOUBLE), 0) < 0.5 OR da_rivedere = 'si'")
def fl11_needs_review(spark: SparkSession, root: str) -> DataFrame:
    low = F.coalesce(F.expr("try_cast(confidenza_natura as double)"), F.lit(0.0)) < 0.5
    return table(spark, root, SITES).filter(F.coalesce((F.col("natura") == "incerto") | low | (F.col("da_rivedere") == "si"), F.lit(False))).select("riga_id")


# -- rules


@query(f"""SELECT doc_id, u AS url, {_vendor_sql('u', 'category')} AS category, {_vendor_sql('u', 'vendor')} AS vendor, {_vendor_sql('u', 'parent')} AS parent FROM (SELECT doc_id, unnest(regexp_extract_all(text, 'src="([^"]+)"', 1)) AS u FROM documents)""")
def rule1_third_party(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit('src="([^"]+)"'), F.lit(1))).alias("url"))
    return rows.select("doc_id", "url", rules.third_party(F.col("url")).alias("t")).select("doc_id", "url", "t.category", "t.vendor", "t.parent")


@query("""SELECT l_orderkey, coalesce(arg_min(f, p) FILTER (f <> 'N'), 'N') AS l_returnflag FROM (SELECT l_orderkey, l_linenumber * 10000000 + l_partkey AS p, l_returnflag AS f FROM lineitem) GROUP BY 1""")
def rule2_best_class(spark: SparkSession, root: str) -> DataFrame:
    return rules.best_class(table(spark, root, "lineitem").withColumn("p", F.col("l_linenumber") * 10_000_000 + F.col("l_partkey")), ["l_orderkey"], "p", "l_returnflag", generic="N")


@query(f"SELECT name, {_cookie_sql('name')} AS klass, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, 'cookie (\\S+)', 1)) AS name FROM documents) GROUP BY 1, 2")
def rule3_cookie_class(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "documents").select(F.explode(F.regexp_extract_all("text", F.lit(r"cookie (\S+)"), F.lit(1))).alias("name"))
    return rows.groupBy("name", rules.cookie_class(F.col("name")).alias("klass")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_software_sql('doc_id')} SELECT doc_id, software, version, licence, coalesce(open::VARCHAR, '') AS open_source FROM f")
def rule4_software_versions(spark: SparkSession, root: str) -> DataFrame:
    return rules.software_found(table(spark, root, "documents"), ["doc_id"], "text", rules=_MARKS).select("doc_id", "software", "version", "licence", F.coalesce(F.col("open_source").cast("string"), F.lit("")).alias("open_source"))


@query(f"WITH {_HEAD_BODY} SELECT riga_id, {_POINTS} FROM t")
def rule5_keyword_scores(spark: SparkSession, root: str) -> DataFrame:
    return _keyword_points(spark, root)


@query("""SELECT doc_id, array_to_string(list_filter([CASE WHEN regexp_matches(lower(text), '(^|[^\\p{L}\\p{N}])spa($|[^\\p{L}\\p{N}])') THEN 'forma_societaria:spa' END, CASE WHEN regexp_matches(lower(text), '(^|[^\\p{L}\\p{N}])as($|[^\\p{L}\\p{N}])') THEN 'forma_societaria:as' END,
CASE WHEN contains(lower(text), 'carta') THEN 'commerciale:carta' END], lambda x: x IS NOT NULL), ';') AS signals FROM documents WHERE text IS NOT NULL""")
def rule6_signals(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "documents").filter("text is not null")
    return rows.select("doc_id", F.array_join(rules.word_signals(F.col("text"), ["spa", "as"], ["carta"]), ";").alias("signals"))


@query("SELECT riga_id, CASE WHEN contains(lower(coalesce(ente_rilevato, '')), 'istituto comprensivo') THEN 'scuola' WHEN contains(lower(coalesce(ente_rilevato, '')), 'comune') THEN 'comune' WHEN contains(lower(coalesce(ente_rilevato, '')), 'città') THEN 'comune' END AS tipo FROM siti_classificati")
def rule7_longest_keyword(spark: SparkSession, root: str) -> DataFrame:
    kinds = {"comune": "comune", "città": "comune", "istituto comprensivo": "scuola"}
    return table(spark, root, SITES).select("riga_id", rules.longest_keyword(F.col("ente_rilevato"), kinds).alias("tipo"))


# -- scores and votes

_RISK_SQL = """CASE WHEN coalesce(l_linenumber, 0) <= 1 THEN 'nessuna ridondanza NS' END, CASE WHEN lower(coalesce(l_returnflag, '')) <> 'r' THEN 'DMARC non attivo (assente o solo osservazione)' END,
CASE WHEN NOT coalesce(l_linestatus = 'F', false) THEN 'DNSSEC assente' END, CASE WHEN l_quantity <= 30 THEN 'certificato TLS scaduto o in scadenza entro 30 giorni' END"""


@query(f"SELECT l_orderkey, l_linenumber, len(r)::BIGINT AS risk, array_to_string(r, '; ') AS reasons FROM (SELECT l_orderkey, l_linenumber, list_filter([{_RISK_SQL}], lambda x: x IS NOT NULL) AS r FROM lineitem)")
def sc1_entity_risk(spark: SparkSession, root: str) -> DataFrame:
    policy = F.when(F.lower("l_returnflag") == "r", "reject").otherwise("none")
    rows = table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_linenumber").alias("n_ns_operators"), policy.alias("dmarc_policy"), (F.col("l_linestatus") == "F").alias("dnssec"), F.col("l_quantity").alias("tls_days_left"))
    points, reasons = scoring.entity_risk(rows)
    return rows.select("l_orderkey", "l_linenumber", points.cast("bigint").alias("risk"), reasons.alias("reasons"))


_SUSPICION_SQL = [(f"list_contains(string_split(kinds, ','), '{k}')", p, f"reference:{k}") for k, p in scoring.REFERENCE_POINTS.items()] + [
    ("NOT coalesce(https_only, false)", 1, "not https"), ("regexp_matches(d, '^(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?:\\.|$)){4}$') OR contains(d, ':')", 2, "ip literal"), ("regexp_matches(d, '(^|\\.)xn--')", 2, "punycode"),
    ("string_split(d, '.')[-1] IN ({})".format(", ".join(f"'{t}'" for t in scoring.ODD_TLDS)), 2, "odd tld"), ("regexp_matches(d, '{}')".format("|".join(scoring.ODD_WORDS)), 2, "odd word"), ("n_pages = 1", 2, "single page"),
]


@query(f"""WITH m AS (SELECT dominio_radice, lower(coalesce(dominio_radice, '')) AS d, count(DISTINCT concat_ws(': ', country_code, found_on)) AS n_pages, coalesce(array_to_string(list_sort(list_distinct(list(tipo_link) FILTER (tipo_link IS NOT NULL))), ','), '') AS kinds,
bool_and(starts_with(lower(hostname), 'https://')) AS https_only FROM site_records GROUP BY 1)
SELECT dominio_radice, ({" + ".join(f"CASE WHEN {t} THEN {p} ELSE 0 END" for t, p, _ in _SUSPICION_SQL)})::BIGINT AS points, concat_ws('; ', {", ".join(f"CASE WHEN {t} THEN '{r}' END" for t, _, r in _SUSPICION_SQL)}) AS reasons FROM m""")
def sc2_domain_suspicion(spark: SparkSession, root: str) -> DataFrame:
    meta = rollups.domain_meta(table(spark, root, RECORDS), "dominio_radice", "country_code", "found_on", "tipo_link", "hostname")
    points, reasons = scoring.domain_suspicion(F.col("dominio_radice"), F.split("kinds", ","), F.col("n_pages"), F.col("https_only"))
    return meta.select("dominio_radice", points.cast("bigint").alias("points"), reasons.alias("reasons"))


@query(f"""WITH t AS (SELECT riga_id, {_BARE_SQL.format('hostname')} AS h FROM siti_classificati), i AS (SELECT *, {_infrastructure_sql('h')} AS infra, list_filter(list_transform(regexp_split_to_array(h, '[.\\-_]'), lambda p: replace({_FOLD_SQL.format('p')}, ' ', '')), lambda p: p <> '' AND p <> 'www' AND NOT ({" OR ".join(f"starts_with(p, '{x}')" for x in scoring.TOKEN_EXCLUDED)})) AS parts FROM t),
k AS (SELECT riga_id, parts, unnest([{", ".join(f"{{'kind': '{k}', 'rx': '^(?:" + "|".join(x[:-1] + '$' if x[-1] == '!' else x for x in ws) + f")', 'public': {str(k in scoring.PUBLIC_BY_NATURE).lower()}}}" for k, ws in scoring.HOST_TOKENS.items())}]) AS r FROM i WHERE NOT infra),
hit AS (SELECT riga_id, r.kind AS kind, r.public AS public, list_filter(parts, lambda p: regexp_matches(p, r.rx))[1] AS token FROM k)
SELECT riga_id, 'natura' AS field, 'infrastruttura' AS value, 0.95::DOUBLE AS conf, 'dominio infrastrutturale noto' AS evidence FROM i WHERE infra UNION ALL SELECT riga_id, 'natura', 'pubblico', 0.9, 'suffisso' FROM i WHERE NOT infra AND regexp_matches(h, '{scoring.GOV_HOST}')
UNION ALL SELECT riga_id, 'tipo', kind, 0.6, 'token host ' || token FROM hit WHERE token IS NOT NULL UNION ALL SELECT riga_id, 'natura', 'pubblico', 0.5, 'token host ' || token FROM hit WHERE token IS NOT NULL AND public""")
def sc6_host_votes(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, SITES).select("riga_id", F.explode(scoring.host_votes(_bare(F.col("hostname")))).alias("v"))
    return rows.select("riga_id", "v.field", "v.value", "v.conf", "v.evidence")


_STEMS = ["comune di", "mairie", "gemeinde", "scuola", "école!"]
_HITS_SQL = "least(len(list_distinct(regexp_extract_all({0}, '\\b(?:comune\\s+di|gemeinde|mairie|scuola|ecole\\b)'))), 3)"


@query(f"SELECT riga_id, (3.0 * {_HITS_SQL.format(_FOLD_SQL.format('nome_ente'))} + 1.0 * {_HITS_SQL.format(_FOLD_SQL.format('evidenza'))})::DOUBLE AS score FROM siti_classificati")
def sc7_weighted_score(spark: SparkSession, root: str) -> DataFrame:
    fields = {"title": F.col("nome_ente"), "body": F.col("evidenza")}
    return table(spark, root, SITES).select("riga_id", scoring.weighted_score(fields, _STEMS).alias("score"))


_KINDS = {"comune": ["comune", "commune", "gemeinde", "ayuntamiento"], "scuola": ["scuola", "ecole", "schule", "colegio"], "sanita": ["azienda sanitaria", "hopital", "gesundheitsamt"]}
_KIND_SQL = ", ".join("{{'s': 3.0 * {0} + 1.0 * {1}, 'k': '{2}'}}".format(*[f"least(len(list_distinct(regexp_extract_all({c}, '\\b(?:{'|'.join(sorted((w.replace(' ', '[ ]') for w in ws), key=lambda w: (-len(w), w)))})'))), 3)" for c in ("t", "b")], k) for k, ws in _KINDS.items())


@query(f"""WITH f AS (SELECT riga_id, {_FOLD_SQL.format('nome_ente')} AS t, {_FOLD_SQL.format('evidenza')} AS b FROM siti_classificati), r AS (SELECT riga_id, list_reverse_sort(list_filter([{_KIND_SQL}], lambda x: x.s > 0)) AS l FROM f)
SELECT riga_id, 'tipo' AS field, l[1].k AS value, round(0.95 * (1 - exp(-l[1].s / 4.0)) * (0.5 + 0.5 * (l[1].s - coalesce(l[2].s, 0)) / l[1].s), 3)::DOUBLE AS conf FROM r WHERE l[1].s >= 3""")
def sc8_lexicon_votes(spark: SparkSession, root: str) -> DataFrame:
    kinds = _KINDS
    fields = {"title": F.col("nome_ente"), "body": F.col("evidenza")}
    scores = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(k).alias("k"), scoring.weighted_score(fields, ws).alias("v")) for k, ws in kinds.items()]), lambda e: e["v"] > 0))
    return table(spark, root, SITES).select("riga_id", scores.alias("s")).select("riga_id", scoring.lexicon_vote(F.col("s")).alias("v")).filter("v is not null").select("riga_id", "v.field", "v.value", "v.conf")


_VOTES_SQL = """v AS (SELECT hostname, natura AS value, try_cast(confidenza_natura AS DOUBLE) AS conf, riga_id AS ord FROM siti_classificati WHERE natura <> '' AND try_cast(confidenza_natura AS DOUBLE) IS NOT NULL),
p AS (SELECT hostname, value, 1 - exp(sum(ln(1 - greatest(0.0, least(0.99, conf))))) AS c, min(ord) AS o FROM v GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY hostname ORDER BY round(c, 9) DESC, o) AS rn FROM p),
w AS (SELECT hostname, max(value) FILTER (rn = 1) AS value, max(round(c, 9)) FILTER (rn = 1) AS a, coalesce(max(round(c, 9)) FILTER (rn = 2), 0) AS b FROM r GROUP BY 1)"""


@query(f"WITH {_VOTES_SQL} SELECT hostname, value, round(greatest(0.0, a - 0.5 * b), 3)::DOUBLE AS conf, b >= 0.5 * a AND b >= 0.4 AS conflict FROM w")
def sc10_noisy_or(spark: SparkSession, root: str) -> DataFrame:
    votes = table(spark, root, SITES).select("hostname", F.col("natura").alias("value"), F.expr("try_cast(confidenza_natura as double)").alias("conf"), F.col("riga_id").alias("ord")).filter("value <> '' and conf is not null")
    return scoring.noisy_or(votes, ["hostname"], "value", "conf", "ord")


def _votes(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, SITES)
    one = lambda f, v, c: rows.select(F.col("hostname").alias("host"), F.lit(f).alias("field"), F.col(v).alias("value"), F.expr(f"try_cast({c} as double)").alias("conf"), F.lit("stadio3").alias("stage"), F.col("wikidata").alias("evidence"), F.col("riga_id").alias("ord"))
    return one("natura", "natura", "confidenza_natura").unionByName(one("tipo", "tipo", "confidenza_tipo")).filter("host <> '' and value <> '' and conf is not null")


@query("""WITH v AS (SELECT * FROM (SELECT hostname AS host, 'natura' AS field, natura AS value, try_cast(confidenza_natura AS DOUBLE) AS conf, wikidata AS evidence, riga_id AS ord FROM siti_classificati UNION ALL SELECT hostname, 'tipo', tipo, try_cast(confidenza_tipo AS DOUBLE), wikidata, riga_id FROM siti_classificati) WHERE host <> '' AND value <> '' AND conf IS NOT NULL),
p AS (SELECT host, field, value, round(1 - exp(sum(ln(1 - greatest(0.0, least(0.99, conf))))), 9) AS c, min(ord) AS o FROM v GROUP BY 1, 2, 3), r AS (SELECT *, row_number() OVER (PARTITION BY host, field ORDER BY c DESC, o, value DESC) AS rn FROM p),
w AS (SELECT host, field, max(value) FILTER (rn = 1) AS value, max(c) FILTER (rn = 1) AS a, coalesce(max(c) FILTER (rn = 2), 0) AS b FROM r GROUP BY 1, 2), x AS (SELECT host, field, value, round(greatest(0.0, a - 0.5 * b), 3)::DOUBLE AS conf, b >= 0.5 * a AND b >= 0.4 AS conflict FROM w),
y AS (SELECT host, max(value) FILTER (field = 'natura') AS n, max(conf) FILTER (field = 'natura') AS cn, max(value) FILTER (field = 'tipo') AS t, max(conf) FILTER (field = 'tipo') AS ct, bool_or(conflict) AS conflict FROM x GROUP BY 1),
e AS (SELECT v.host, 'stadio3:' || evidence AS e, row_number() OVER (PARTITION BY v.host ORDER BY v.conf DESC, ord, 'stadio3:' || evidence) AS k FROM v JOIN x ON v.host = x.host AND v.field = x.field AND v.value = x.value WHERE evidence <> ''), f AS (SELECT host, string_agg(e, ' || ' ORDER BY k) AS evidence FROM e WHERE k <= 4 GROUP BY 1)
SELECT y.host, coalesce(n, 'non_classificabile') AS natura, coalesce(cn, 0.0) AS conf_natura, CASE WHEN n = 'infrastruttura' THEN 'non_applicabile' ELSE coalesce(t, 'sconosciuto') END AS tipo, CASE WHEN n = 'infrastruttura' THEN cn ELSE coalesce(ct, 0.0) END AS conf_tipo, conflict, 'stadio3' AS stages, evidence FROM y LEFT JOIN f ON y.host = f.host""")
def sc11_verdicts(spark: SparkSession, root: str) -> DataFrame:
    return scoring.verdicts(_votes(spark, root))


@query("""SELECT riga_id, CASE WHEN stadi = '0' THEN 1 WHEN coalesce(wikidata, '') <> '' THEN 2 WHEN evidenza <> '' THEN 3 END::INT AS stage FROM siti_classificati""")
def sc12_cascade(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, SITES).select("riga_id", "stadi", "wikidata", "evidenza")
    return scoring.cascade(rows, "riga_id", [lambda r: r.filter("stadi = '0'"), lambda r: r.filter("coalesce(wikidata, '') <> ''"), lambda r: r.filter("evidenza <> ''")])


@query("SELECT riga_id, coalesce(nullif(trim(nome_ente), ''), nullif(trim(ente_rilevato), ''), nullif(trim(host_classificato), ''), '') AS name FROM siti_classificati")
def sc13_entity_name(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, SITES).select("riga_id", scoring.entity_name(F.col("nome_ente"), F.col("ente_rilevato"), F.col("host_classificato")).alias("name"))


@query("""SELECT riga_id, 'natura' AS field, natura AS value, round(0.8 * CASE WHEN natura = 'incerto' THEN 0.5 ELSE 1 END, 3)::DOUBLE AS conf FROM siti_classificati
UNION ALL SELECT riga_id, 'tipo', tipo, round(0.8 * CASE WHEN tipo = 'altro' THEN 0.6 ELSE 1 END, 3)::DOUBLE FROM siti_classificati WHERE tipo <> 'non_applicabile' AND natura <> 'infrastruttura'""")
def sc14_answer_votes(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, SITES).select("riga_id", F.explode(scoring.answer_votes(F.col("natura"), F.col("tipo"), F.lit(0.8))).alias("v"))
    return rows.select("riga_id", "v.field", "v.value", "v.conf")


@query("""WITH s AS (SELECT l_orderkey, l_suppkey, l_partkey % 100 AS own, l_discount * 10 AS share FROM lineitem)
SELECT l_orderkey, arg_max(l_suppkey, struct_pack(a := share, b := l_suppkey)) AS transit, round(max(share), 3)::DOUBLE AS share FROM s WHERE l_suppkey <> own AND l_suppkey <> 0 AND share >= 0.5 GROUP BY 1""")
def sc15_transit_dependency(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "lineitem").select("l_orderkey", "l_suppkey", (F.col("l_partkey") % 100).alias("own"), (F.col("l_discount") * 10).alias("share"))
    return scoring.transit_dependency(rows, "l_orderkey", "l_suppkey", "own", "share")


def _search_sql(depth: int, cap: int | None = None) -> str:
    """The search unrolled level by level, each level's queue numbered as a whole."""
    out = """e AS (SELECT DISTINCT l_orderkey AS src, l_partkey AS dst, l_partkey % 7 AS host, l_linenumber AS ord FROM lineitem),
l0 AS (SELECT p_partkey AS url, p_partkey AS seed, row_number() OVER (ORDER BY p_partkey) AS place FROM part WHERE p_size = 1), seen0 AS (SELECT url FROM l0), d0 AS (SELECT NULL::BIGINT AS url, NULL::BIGINT AS seed WHERE false)"""
    for n in range(1, depth + 1):
        m = n - 1
        out += f""",
w{n} AS (SELECT dst AS url, arg_min(seed, struct_pack(a := place, b := ord)) AS seed, min(struct_pack(a := place, b := ord, c := dst)) AS k, any_value(host) AS host FROM e JOIN l{m} ON src = url WHERE dst NOT IN (SELECT url FROM seen{m}) GROUP BY dst),
f{n} AS (SELECT w{n}.url, coalesce(d{m}.seed, w{n}.seed) AS seed, k, host FROM w{n} LEFT JOIN d{m} ON w{n}.url = d{m}.url),
t{n} AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY k) AS turn, min(k) OVER (PARTITION BY host) AS first, count(*) OVER () AS n FROM f{n}),
o{n} AS (SELECT *, CASE WHEN n > {cap or "n"} THEN row_number() OVER (ORDER BY turn, first) ELSE row_number() OVER (ORDER BY k) END AS place FROM t{n}),
l{n} AS (SELECT url, seed, place FROM o{n} WHERE place <= {cap or "n"}), seen{n} AS (SELECT url FROM seen{m} UNION ALL SELECT url FROM l{n}),
d{n} AS (SELECT url, seed FROM o{n} WHERE place > {cap or "n"} UNION SELECT url, seed FROM d{m})"""
    return f"WITH {out} " + " UNION ALL ".join(f"SELECT url, {n} AS level, seed FROM l{n}" for n in range(depth + 1))


def _links(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    edges = table(spark, root, "lineitem").select(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst"), (F.col("l_partkey") % 7).alias("dst_host"), F.col("l_linenumber").alias("ord")).distinct()
    return edges, table(spark, root, "part").filter("p_size = 1").select(F.col("p_partkey").alias("url"), F.col("p_partkey").alias("ord"))


@query(_search_sql(3))
def gr1_level_search(spark: SparkSession, root: str) -> DataFrame:
    """The search over all links from all seeds, with the seed that each page comes from."""
    return graph.level_search(*_links(spark, root), 3)


@query(_search_sql(3, 100))
def gr1_capped_search_with_origin(spark: SparkSession, root: str) -> DataFrame:
    return graph.level_search(*_links(spark, root), 3, level_cap=100)


@query("""WITH RECURSIVE s AS (SELECT l_orderkey AS t, l_linenumber AS n, min(l_returnflag) AS g, max(CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END) AS new FROM lineitem WHERE l_linenumber BETWEEN 1 AND 6 GROUP BY 1, 2),
r AS (SELECT DISTINCT t, 0::BIGINT AS n, 0::BIGINT AS idle, NULL::VARCHAR AS g, 0::BIGINT AS pages, 0::BIGINT AS last, 0::BIGINT AS useful FROM s
UNION ALL SELECT r.t, r.n + 1, CASE WHEN s.new > 0 AND s.g IS DISTINCT FROM r.g THEN 0 ELSE r.idle + 1 END, coalesce(s.g, r.g), r.pages + CASE WHEN s.t IS NULL THEN 0 ELSE 1 END, CASE WHEN s.t IS NULL THEN r.last ELSE r.n + 1 END, r.useful + CASE WHEN s.new > 0 AND s.g IS DISTINCT FROM r.g THEN 1 ELSE 0 END
FROM r LEFT JOIN s ON s.t = r.t AND s.n = r.n + 1 WHERE r.n < 6 AND r.idle < 2)
SELECT t AS l_orderkey, max(pages) AS pages, max(last) AS last, max(useful) AS useful FROM r GROUP BY 1 HAVING max(pages) > 0""")
def gr4_pagination_runs(spark: SparkSession, root: str) -> DataFrame:
    pages_ = table(spark, root, "lineitem").withColumn("new", (F.col("l_quantity") > 25).cast("int"))
    return graph.pagination_runs(pages_, "l_orderkey", "l_linenumber", "l_returnflag", "new", max_pages=6)


@query(f"""SELECT rec_id, h <> '' AND (h = 'sportello-condiviso.example' OR ends_with(h, '.sportello-condiviso.example') OR string_split(h, '.')[-1] = 'example') AND NOT (h = 'www.sportello-condiviso.example' OR ends_with(h, '.www.sportello-condiviso.example')) AS inside FROM (SELECT rec_id, rtrim({_BARE_SQL.format('hostname')}, '.') AS h FROM site_records)""")
def fl12_perimeter(spark: SparkSession, root: str) -> DataFrame:
    inside = graph.in_perimeter(F.rtrim(_bare(F.col("hostname")), F.lit(".")), ["sportello-condiviso.example"], ["example"], ["www.sportello-condiviso.example"])
    return table(spark, root, RECORDS).select("rec_id", inside.alias("inside"))


# -- functions


@query(f"SELECT rec_id, {_HOST_SQL.format('hostname')} AS host FROM site_records")
def fn7_host_of(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, RECORDS).select("rec_id", urls.host_of(F.col("hostname")).alias("host"))


@query(f"""SELECT rec_id, CASE WHEN len(p) >= 2 THEN p[-2] || '.' || p[-1] ELSE p[1] END AS level2 FROM (SELECT rec_id, string_split(rtrim(h, '.'), '.') AS p FROM (SELECT rec_id, {_BARE_SQL.format('hostname')} AS h FROM site_records))""")
def fn13_second_level(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, RECORDS).select("rec_id", urls.second_level(_bare(F.col("hostname"))).alias("level2"))


@query(f"""WITH p AS (SELECT rec_id, string_split(rtrim({_BARE_SQL.format('hostname')}, '.'), '.') AS p FROM site_records) SELECT rec_id, CASE WHEN len(p) < 2 THEN '' WHEN p[-2] || '.' || p[-1] IN ({", ".join(f"'{s}'" for s in urls.PUBLIC_SUFFIXES)}) OR regexp_matches(p[-2] || '.' || p[-1], '^(?:{"|".join(urls.REGISTRY_LABELS)})\\.[a-z]{{2}}$') THEN CASE WHEN len(p) >= 3 THEN p[-3] || '.' || p[-2] || '.' || p[-1] ELSE '' END ELSE p[-2] || '.' || p[-1] END AS root FROM p""")
def fn12_root_domain(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, RECORDS).select("rec_id", urls.root_domain(_bare(F.col("hostname"))).alias("root"))


@query(f"WITH {_PIECES_SQL} SELECT rec_id, pos, value FROM pieces")
def fn3_split_url_values(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, RECORDS).select("rec_id", F.posexplode(urls.split_url_values(F.col("host_osservati"))).alias("pos", "value"))


@query(f"""WITH {_PIECES_SQL}, {_site_sql('pieces', 'value', 'rec_id, pos')}, d AS (SELECT rec_id, url, min(pos) AS o FROM sites WHERE url <> '' GROUP BY 1, 2) SELECT rec_id, (row_number() OVER (PARTITION BY rec_id ORDER BY o) - 1)::INT AS pos, url FROM d""")
def fn5_normalize_url_values(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, RECORDS).select("rec_id", F.posexplode(urls.normalize_url_values(F.col("host_osservati"))).alias("pos", "url"))


_TRACKED_SQL = "lower(x.k) IN ({}) OR regexp_matches(lower(x.k), '^(?:{})')".format(", ".join(f"'{t}'" for t in urls.TRACKING), "|".join(urls.TRACKING_PREFIX))


@query(f"""WITH a AS (SELECT rec_id, found_on, {_TRIM_SQL.format("coalesce(found_on, '')")} AS u FROM site_records),
b AS (SELECT *, lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme, regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?[^/?#:]*:([0-9]+)', 1) AS port, regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(u, '^[^?#]*\\?([^#]*)', 1) AS query, {_HOST_SQL.format('found_on')} AS host FROM a),
c AS (SELECT *, regexp_replace(regexp_replace(path, ';[^/]*', '', 'g'), '/{{2,}}', '/', 'g') AS p, list_filter(list_transform(list_filter(string_split(query, '&'), lambda x: x <> ''), lambda x: {{'k': url_decode(replace(split_part(x, '=', 1), '+', ' ')), 'v': url_decode(replace(regexp_extract(x, '^[^=]*=(.*)$', 1), '+', ' '))}}), lambda x: NOT ({_TRACKED_SQL})) AS pairs FROM b),
d AS (SELECT *, CASE WHEN length(p) > 1 AND regexp_replace(p, '/+$', '') <> '' THEN regexp_replace(p, '/+$', '') ELSE '/' END AS shown, array_to_string(list_transform(list_sort(pairs), lambda x: replace(url_encode(x.k), '%20', '+') || '=' || replace(url_encode(x.v), '%20', '+')), '&') AS q FROM c)
SELECT rec_id, CASE WHEN scheme IN ('http', 'https') AND host <> '' THEN scheme || '://' || host || CASE WHEN port = '' OR (scheme = 'http' AND port = '80') OR (scheme = 'https' AND port = '443') THEN '' ELSE ':' || port END || shown || CASE WHEN q <> '' THEN '?' || q ELSE '' END ELSE found_on END AS url FROM d""")
def fn6_canonical_url(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, RECORDS).select("rec_id", urls.canonical_url(F.col("found_on")).alias("url"))


@query(f"""SELECT rec_id, {_HOST_SQL.format('found_on')} || regexp_replace(CASE WHEN p = '' THEN '/' ELSE p END, '\\d+', '#', 'g') || '?' || array_to_string(list_sort(list_distinct(list_transform(list_filter(string_split(q, '&'), lambda x: x <> ''), lambda x: lower(split_part(x, '=', 1))))), ',') AS signature
FROM (SELECT rec_id, found_on, regexp_extract(coalesce(found_on, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS p, regexp_extract(coalesce(found_on, ''), '^[^?#]*\\?([^#]*)', 1) AS q FROM site_records)""")
def fn9_url_signature(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, RECORDS).select("rec_id", urls.url_signature(F.col("found_on")).alias("signature"))


@query("""WITH p AS (SELECT rec_id, coalesce(found_on, '') AS u, list_filter(string_split(regexp_extract(coalesce(found_on, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS l FROM site_records)
SELECT rec_id, length(u) > 2000 OR len(l) > 14 OR len(list_filter(list_distinct(l), lambda x: (len(list_filter(l, lambda y: y = x)) >= 3 AND length(x) > 1) OR len(list_filter(l, lambda y: y = x)) >= 4)) > 0 AS trap FROM p""")
def fn10_traps(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, RECORDS).select("rec_id", urls.looks_like_trap(F.col("found_on")).alias("trap"))


@query(f"""WITH {_site_sql(RECORDS, 'hostname', 'rec_id')} SELECT rec_id, CASE WHEN url = '' THEN lower(trim(coalesce(value, ''))) ELSE regexp_replace(regexp_replace(lower(url), '^https?://(?:www\\.)?', ''), '[?].*$', '') END AS key FROM sites""")
def fn11_dedupe_key(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, RECORDS).select("rec_id", urls.dedupe_key(F.col("hostname")).alias("key"))


@query(f"SELECT rec_id, CASE WHEN {_CLEAN_SQL} THEN rtrim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(coalesce(hostname, ''))), '^[a-z][a-z0-9+.-]*://', ''), '(?s)[/?#].*$', ''), '^[^@]*@', ''), ':\\d+$', ''), '.') END AS host FROM site_records")
def fn14_clean_hostname(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, RECORDS).select("rec_id", urls.clean_hostname(F.col("hostname")).alias("host"))


@query(f"SELECT rec_id, {_FOLD_SQL.format('nome_ente')} AS folded FROM site_records")
def fn16_fold(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, RECORDS).select("rec_id", text.fold(F.col("nome_ente")).alias("folded"))


@query("SELECT riga_id, regexp_extract(lower(trim(coalesce(lang, ''))), '^([^-_]*)', 1) AS lang FROM siti_classificati")
def fn18_primary_lang(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, SITES).select("riga_id", text.primary_lang(F.col("lang")).alias("lang"))


@query(f"SELECT rec_id, {_infrastructure_sql('h')} AS infrastructure FROM (SELECT rec_id, {_BARE_SQL.format('hostname')} AS h FROM site_records)")
def fn19_infrastructure(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, RECORDS).select("rec_id", urls.is_infrastructure(_bare(F.col("hostname"))).alias("infrastructure"))


@query(f"SELECT rec_id, ends_with(rtrim({_BARE_SQL.format('hostname')}, '.'), '.example') AS matches FROM site_records")
def fn21_tld_match(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, RECORDS).select("rec_id", urls.tld_matches(_bare(F.col("hostname")), ["example", "gov"]).alias("matches"))


@query("SELECT rec_id, CASE WHEN regexp_matches(coalesce(found_on, ''), '(?i)[?&/](?:page|pagina|seite|p|pag|pg|start|offset)[=/_-]?\\d+') THEN regexp_replace(found_on, '(?i)([?&/](?:page|pagina|seite|p|pag|pg|start|offset)[=/_-]?)(\\d+)', '\\1{}', 'g') END AS template FROM site_records")
def fn24_pagination_template(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, RECORDS).select("rec_id", urls.pagination_template(F.col("found_on")).alias("template"))


@query()
def fn25_visible_text_length(spark: SparkSession, root: str) -> DataFrame:
    return pages.page_states(table(spark, root, "documents"), "doc_id", "text").select("page_id", "n_text")


@query()
def fn26_page_states(spark: SparkSession, root: str) -> DataFrame:
    return pages.page_states(table(spark, root, "documents"), "doc_id", "text")


_MARKS_SQL = " OR ".join(f"contains(lower(coalesce(page, '')), '{m}')" for m in pages.CHALLENGE_MARKS)


@query(f"""WITH p AS (SELECT hostname, max(text) AS page FROM documents WHERE hostname IS NOT NULL GROUP BY 1)
SELECT riga_id, coalesce(http_status_classificazione IN (403, 406, 429, 503), false) AND (length(coalesce(page, '')) < 2000 OR {_MARKS_SQL}) AS blocked FROM tipo_ente_possibili_non_pubblici t LEFT JOIN p ON t.hostname = p.hostname""")
def fn27_probably_blocked(spark: SparkSession, root: str) -> DataFrame:
    """Every row with the page captured of its host, if any."""
    page = table(spark, root, "documents").filter("hostname is not null").groupBy("hostname").agg(F.max("text").alias("page"))
    rows = joins.fan_out(table(spark, root, TYPES).select("riga_id", "hostname", "http_status_classificazione"), page, "hostname")
    return rows.select("riga_id", pages.probably_blocked(F.col("http_status_classificazione"), F.col("page")).alias("blocked"))


@query("SELECT l_orderkey, l_linenumber, CAST(floor((epoch(l_shipdate) - epoch(TIMESTAMP '1997-01-01')) / 86400) AS BIGINT) AS days FROM lineitem")
def fn38_days_left(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", network.days_left(F.col("l_shipdate"), F.lit("1997-01-01").cast("timestamp")).alias("days"))


@query("SELECT riga_id, CASE WHEN peso_pagina_kb < 25 THEN 'basso' WHEN peso_pagina_kb < 50 THEN 'moderato' WHEN peso_pagina_kb < 75 THEN 'alto' WHEN peso_pagina_kb IS NOT NULL THEN 'molto alto' END AS band FROM tipo_ente_possibili_non_pubblici")
def fn40_bands(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, TYPES).select("riga_id", bands.index_band(F.col("peso_pagina_kb")).alias("band"))


@query("SELECT riga_id, CASE tipo_ente_rilevato WHEN 'comune' THEN 'ente locale' WHEN 'scuola' THEN 'istruzione' ELSE 'altro' END AS sector FROM tipo_ente_possibili_non_pubblici")
def fn41_sector(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, TYPES).select("riga_id", text.lookup(F.col("tipo_ente_rilevato"), {"comune": "ente locale", "scuola": "istruzione"}, "altro").alias("sector"))


@query("SELECT rec_id, CASE WHEN regexp_matches(trim(coalesce(regione, '')), '^9[78]') THEN substring(trim(coalesce(regione, '')), 1, 3) ELSE substring(trim(coalesce(regione, '')), 1, 2) END AS dep FROM site_records")
def fn42_department(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, RECORDS).select("rec_id", text.department_code(F.col("regione")).alias("dep"))


@query("SELECT rec_id, coalesce(nullif(trim(host_osservati), ''), nullif(trim(hostname), ''), nullif(trim(found_on), ''), '') AS first FROM site_records")
def fn43_first_filled(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, RECORDS).select("rec_id", text.first_filled(F.col("host_osservati"), F.col("hostname"), F.col("found_on")).alias("first"))


@query("SELECT event_id, round(1 - exp(-greatest(value, 0) / 6.0), 9)::DOUBLE AS squashed FROM events")
def fn44_squash(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "events").select("event_id", F.round(text.squash(F.col("value")), 9).alias("squashed"))


@query(f"""WITH t AS (SELECT rec_id, lower(coalesce(hostname, '')) AS h, list_distinct(list_filter(string_split({_FOLD_SQL.format('nome_ente')}, ' '), lambda w: length(w) >= 4 AND w NOT IN ({", ".join(f"'{w}'" for w in text.GENERIC_WORDS)}))) AS l FROM site_records)
SELECT rec_id, CASE WHEN len(l) = 0 THEN 1.0 ELSE len(list_filter(l, lambda w: contains(h, w))) / len(l)::DOUBLE END::DOUBLE AS score FROM t""")
def fn45_name_match(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, RECORDS).select("rec_id", text.name_match(F.col("nome_ente"), F.coalesce("hostname", F.lit(""))).alias("score"))


@query("SELECT rec_id, regexp_replace(found_on, '(?i)([?&](?:key|apikey|api_key|token|access_token|secret|password)=)[^&\\s]+', '\\1***', 'g') AS url FROM site_records")
def fn46_redact(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, RECORDS).select("rec_id", urls.redact_secrets(F.col("found_on")).alias("url"))


@query("SELECT event_id, ts IS NULL OR ts < TIMESTAMP '2024-01-20' - INTERVAL 7 DAY AS expired FROM events")
def fn47_expired(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "events").select("event_id", network.expired(F.col("ts"), F.lit("2024-01-20").cast("timestamp"), 7).alias("expired"))


_REFS_SQL = """r AS (SELECT doc_id AS page_id, hostname, (i - 1)::INT AS ord, 'script' AS kind, l[i] AS ref FROM (SELECT doc_id, hostname, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, hostname, regexp_extract_all(text, '<script src="([^"]+)"', 1) AS l FROM documents)))"""


@query(f"WITH {_REFS_SQL} SELECT page_id, ord, kind, ref FROM r")
def ht1_links_and_resources(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "documents").withColumn("url", F.concat(F.lit("https://"), "hostname", F.lit("/")))
    return html.page_refs(rows, "doc_id", "url", "text")


@query(f"""WITH {_REFS_SQL}, h AS (SELECT *, lower(regexp_extract(ref, '://([^/?#:]*)', 1)) AS host, lower(trim(coalesce(hostname, ''))) AS own FROM r)
SELECT page_id, host, lower(ref) AS url, 0 AS rank, min(ord) AS ord FROM h WHERE array_to_string(string_split(host, '.')[-2:], '.') <> array_to_string(string_split(own, '.')[-2:], '.') GROUP BY 1, 2, 3""")
def ht3_third_party_resources(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "documents").withColumn("url", F.concat(F.lit("https://"), "hostname", F.lit("/")))
    own = rows.select(F.col("doc_id").alias("page_id"), F.col("hostname").alias("own"))
    return html.third_party_refs(html.page_refs(rows, "doc_id", "url", "text"), own)


@query()
def ht5_page_evidence(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "documents").withColumn("url", F.concat(F.lit("https://"), "hostname", F.lit("/")))
    return html.page_evidence(rows, "doc_id", "url", "text").select("page_id", "lang", "title", "text_len")


@query("""SELECT riga_id, substring(array_to_string(list_filter([CASE WHEN trim(coalesce(nome_ente, '')) <> '' THEN 'name: ' || nome_ente END, CASE WHEN trim(coalesce(evidenza, '')) <> '' THEN 'evidence: ' || evidenza END], lambda x: x IS NOT NULL), chr(10)), 1, 2200) AS packet FROM siti_classificati""")
def ht8_evidence_text(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, SITES).select("riga_id", pages.evidence_text({"name": F.col("nome_ente"), "evidence": F.col("evidenza")}).alias("packet"))


@query("SELECT rec_id, list_extract(l, 1) AS first_host, array_to_string(l[2:], '|') AS others FROM (SELECT rec_id, list_filter(string_split(coalesce(host_osservati, ''), '|'), lambda x: x <> '') AS l FROM site_records) WHERE len(l) > 0")
def mn3_first_host_and_rest(spark: SparkSession, root: str) -> DataFrame:
    hosts = text.split_list(F.col("host_osservati"), "|")
    rows = table(spark, root, RECORDS).select("rec_id", urls.first_and_rest(hosts).alias("h")).filter("h.first is not null")
    return rows.select("rec_id", F.col("h.first").alias("first_host"), F.array_join("h.rest", "|").alias("others"))


@query("""WITH c AS (SELECT nome_ente, min(hostname) AS found FROM site_records WHERE hostname <> '' GROUP BY 1) SELECT rec_id, coalesce(nullif(hostname, ''), found, '') AS host FROM site_records r LEFT JOIN c ON r.nome_ente = c.nome_ente""")
def mn4_fill_blank_hosts(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, RECORDS).select("rec_id", "nome_ente", "hostname")
    found = rows.filter("hostname <> ''").groupBy("nome_ente").agg(F.min("hostname").alias("found"))
    return joins.fill_from_cache(rows, "nome_ente", "hostname", found, "found").select("rec_id", F.col("hostname").alias("host"))


@query(f"SELECT rec_id, unnest(CASE WHEN b = '' THEN [] ELSE ['https://' || b, 'https://' || b || '/', 'http://' || b, 'http://' || b || '/', 'https://www.' || b, 'https://www.' || b || '/', 'http://www.' || b, 'http://www.' || b || '/'] END) AS variant FROM (SELECT rec_id, regexp_replace({_BARE_SQL.format('hostname')}, '^www\\.', '') AS b FROM site_records)")
def mn9_site_variants(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, RECORDS).select("rec_id", F.explode(urls.site_variants(_bare(F.col("hostname")))).alias("variant"))
