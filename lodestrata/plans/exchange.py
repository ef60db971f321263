"""Queries of sources and sinks as round trips over the test tables, and of single functions that no other query runs."""

from __future__ import annotations

import io
import json
import tarfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lodestrata.functions import html, network, pages, urls
from lodestrata.functions.cells import strip
from lodestrata.lineage import folder
from lodestrata.operators import joins, rules, scoring, sets
from lodestrata.plans import analytics as o
from lodestrata.schemas import RECORD_COLUMNS, SITE_RECORD
from lodestrata.session import table
from lodestrata.sources import config, files, sinks

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = o._stripping(sql)
        return f

    return keep


_BARE = o._BARE_SQL.format("hostname")


def _first_sql(rules_: list[tuple[str, str]], what: str, other: str = "NULL") -> str:
    return "CASE " + " ".join(f"WHEN contains({what}, {o._quoted(p)}) THEN {o._quoted(v)}" for p, v in rules_) + f" ELSE {other} END"


def _nations(spark: SparkSession, root: str) -> list:
    """The nations, a table of 25 rows: what small files for the driver are made of."""
    return table(spark, root, "nation").orderBy("n_nationkey").limit(1000).collect()


# -- files in and out


@query("SELECT s_suppkey::VARCHAR AS s_suppkey, s_name, CASE WHEN s_acctbal > 5000 THEN s_name END AS note FROM supplier")
def src3_src4_src10_snk4_workbook(spark: SparkSession, root: str) -> DataFrame:
    """A workbook written and read again, its columns by letter."""
    path = f"{folder(spark, 'book')}.xlsx"
    rows = table(spark, root, "supplier").select("s_suppkey", "s_name", F.when(F.col("s_acctbal") > 5000, F.col("s_name")).alias("note"))
    sinks.write_xlsx(rows, path, ["s_suppkey"])
    return files.read_sheets(spark, path, {"s_suppkey": "A", "s_name": "B", "note": "C"}).select("s_suppkey", "s_name", "note")


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def src5_xml_round_trip(spark: SparkSession, root: str) -> DataFrame:
    path = folder(spark, "xml")
    rows = table(spark, root, "customer").select("c_custkey", "c_name", "c_mktsegment")
    rows.write.format("xml").option("rowTag", "ente").save(path)
    return files.read_xml(spark, path, "ente", rows.schema)


@query("""SELECT c_custkey AS row_id, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE '' END AS kind FROM customer""")
def src9_first_texts(spark: SparkSession, root: str) -> DataFrame:
    """Names among candidate tags, the record's own before deeper ones, outside the contact's subtree."""
    deep = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("<b><p:tipo>"), "c_mktsegment", F.lit("</p:tipo></b>"))).otherwise("")
    xml = F.concat(F.lit('<p:ente xmlns:p="urn:x"><contatto><p:naam>no</p:naam><tipo>no</tipo></contatto><a><p:naam>deep</p:naam></a>'), deep, F.lit("<p:titolo> </p:titolo><p:naam> "), "c_name", F.lit(" </p:naam></p:ente>"))
    rows = table(spark, root, "customer").select("c_custkey", xml.alias("xml"))
    return files.xml_first_texts(rows, "c_custkey", "xml", {"name": ["titolo", "naam"], "kind": ["tipo"]}, ["contatto"])


@query("SELECT c_nationkey AS page_id, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1)::INT AS position, c_name AS name, '/e/' || c_custkey AS link, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE '' END AS kind FROM customer")
def src7_list_items(spark: SparkSession, root: str) -> DataFrame:
    """Lists in captured pages, one per nation, by a selector for the items and one for each field."""
    kind = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("<span class='tag x'>"), "c_mktsegment", F.lit("</span>"))).otherwise("")
    item = F.concat(F.lit("<li class='ente y'><a href='/e/"), "c_custkey", F.lit("'><b>"), "c_name", F.lit("</b></a>"), kind, F.lit("<span>no</span></li><li class='other'><b>no</b></li>"))
    each = table(spark, root, "customer").groupBy("c_nationkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", item.alias("i")))), lambda x: x["i"]), "").alias("items"))
    page = each.select("c_nationkey", F.concat(F.lit("<div id='list'><ul>"), "items", F.lit("</ul></div><li class='ente'><b>no</b></li>")).alias("html"))
    return html.select_fields(page, "c_nationkey", "html", "#list li.ente", {"name": "a b", "link": "a::attr(href)", "kind": "span.tag"})


@query("SELECT n_nationkey, n_name FROM nation")
def src8_archives(spark: SparkSession, root: str) -> DataFrame:
    """Archives with records under a container key, as a list, and one per line."""
    rows = [{"n_nationkey": r["n_nationkey"], "n_name": r["n_name"]} for r in _nations(spark, root)]
    bodies = {"a.json": json.dumps({"meta": 1, "service": rows[0::3]}), "b.json": json.dumps(rows[1::3]), "c.ndjson": "\n".join(map(json.dumps, rows[2::3])) + "\nno json\n"}
    raw = io.BytesIO()
    with tarfile.open(fileobj=raw, mode="w:bz2") as tar:
        for name, body in bodies.items():
            info = tarfile.TarInfo(name)
            info.size = len(body.encode())
            tar.addfile(info, io.BytesIO(body.encode()))
    path = f"{folder(spark, 'archive')}.tar.bz2"
    sinks._put(spark, path, raw.getvalue())
    return files.read_archives(spark, path).select(F.from_json("record", "n_nationkey bigint, n_name string").alias("r")).select("r.*")


@query("SELECT lpad(o_orderkey::VARCHAR, 12, '0') AS codice, CASE WHEN o_custkey % 5 > 0 THEN '00' || o_custkey END AS cap FROM orders")
def src12_text_columns(spark: SparkSession, root: str) -> DataFrame:
    """Results whose codes look like numbers stay text."""
    path = folder(spark, "codes")
    rows = table(spark, root, "orders").select(F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("codice"), F.when(F.col("o_custkey") % 5 > 0, F.concat(F.lit("00"), "o_custkey")).alias("cap"))
    rows.write.option("header", True).option("sep", ",").csv(path)
    return files.read_csv(spark, path, StructType([StructField("codice", StringType()), StructField("cap", StringType())]), ",")


@query("SELECT 'N' || n_regionkey AS country, n_name, true AS readable FROM nation UNION ALL SELECT 'XX', NULL, false")
def src14_checkpoints(spark: SparkSession, root: str) -> DataFrame:
    """Checkpoint documents per country, and those that can't be read."""
    path = folder(spark, "checkpoints")
    for r in _nations(spark, root):
        sinks._put(spark, f"{path}/country=N{r['n_regionkey']}/c{r['n_nationkey']}.json", json.dumps({"n_name": r["n_name"]}, indent=1).encode())
    sinks._put(spark, f"{path}/country=XX/broken.json", b'{"n_name": ')
    good, bad = files.read_checkpoints(spark, path, StructType([StructField("n_name", StringType())]))
    return good.select("country", "n_name", F.lit(True).alias("readable")).unionByName(bad.select("country", F.lit(None).cast("string").alias("n_name"), F.lit(False).alias("readable")))


@query("""WITH w AS (SELECT DISTINCT n_regionkey::VARCHAR AS category, lower(n_name) AS word FROM nation) SELECT category, word, (row_number() OVER (PARTITION BY category ORDER BY length(word) DESC, word) - 1)::INT AS position FROM w""")
def src16_lexicon(spark: SparkSession, root: str) -> DataFrame:
    """Word lists per category and language, put together, longest first; categories are checked."""
    raw: dict = {}
    for r in _nations(spark, root):
        raw.setdefault(str(r["n_regionkey"]), {}).setdefault(["it", "fr"][r["n_nationkey"] % 2], []).extend([r["n_name"], r["n_name"].lower()])
    lists = config.checked_types(config.keyword_lists(raw), tuple(map(str, range(5))))
    return spark.createDataFrame([(c, w, i) for c, ws in lists.items() for i, w in enumerate(ws)], "category string, word string, position int")


@query("SELECT n_regionkey::VARCHAR AS key, count(*) - 1 AS repeats, max(n_nationkey) AS value FROM nation GROUP BY 1")
def src17_repeated_keys(spark: SparkSession, root: str) -> DataFrame:
    """Keys given more than once in a settings file; the last one counts."""
    data, twice = config.load_text("{" + ", ".join(f'"{r["n_regionkey"]}": {r["n_nationkey"]}' for r in _nations(spark, root)) + "}")
    return spark.createDataFrame([(k, twice.count(k), v) for k, v in data.items()], "key string, repeats bigint, value bigint")


@query("SELECT n_name AS key, n_regionkey AS region, CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey ELSE 0 END AS x FROM nation")
def src18_merged_settings(spark: SparkSession, root: str) -> DataFrame:
    """Defaults overlaid with one's own settings, level by level."""
    rows = _nations(spark, root)
    defaults = {"paesi": {r["n_name"]: {"region": r["n_regionkey"], "x": 0} for r in rows}}
    own = {"paesi": {r["n_name"]: {"x": r["n_nationkey"]} for r in rows if r["n_nationkey"] % 2 == 0}}
    merged = config.merged(defaults, own)["paesi"]
    return spark.createDataFrame([(k, v["region"], v["x"]) for k, v in merged.items()], "key string, region bigint, x bigint")


@query("SELECT 'https://' || lower(n_name) || '.example' AS url, n_nationkey AS ord FROM nation")
def src19_seeds(spark: SparkSession, root: str) -> DataFrame:
    path = f"{folder(spark, 'seeds')}.txt"
    lines = [f"# {r['n_regionkey']}\n\n https://{r['n_name'].lower()}.example " for r in _nations(spark, root)]
    sinks._put(spark, path, ("﻿" + "\r\n".join(lines)).encode())
    return files.read_seeds(spark, path)


@query("SELECT " + ", ".join(f"nullif({c}, '') AS {c}" for c in RECORD_COLUMNS) + " FROM site_records")
def snk1_single_csv(spark: SparkSession, root: str) -> DataFrame:
    """One CSV file with a byte order mark, written as a whole and read again."""
    path = f"{folder(spark, 'siti')}.csv"
    sinks.write_single_csv(table(spark, root, o.RECORDS).select(*RECORD_COLUMNS), path, order=["rec_id"] if "rec_id" in RECORD_COLUMNS else None)
    return files.read_csv(spark, path, SITE_RECORD, ",")


@query("SELECT r_regionkey, false AS new FROM region UNION ALL SELECT n_nationkey, true FROM nation")
def snk3_backup(spark: SparkSession, root: str) -> DataFrame:
    """A result that is written again: the old one is moved aside first."""
    path = f"{folder(spark, 'result')}/out"
    old = table(spark, root, "region").select("r_regionkey")
    old.write.parquet(path)
    kept = sinks.backup_existing(spark, path)
    table(spark, root, "nation").select(F.col("n_nationkey").alias("r_regionkey")).write.parquet(path)
    return spark.read.parquet(kept).withColumn("new", F.lit(False)).unionByName(spark.read.parquet(path).withColumn("new", F.lit(True)))


@query("SELECT 'righe ' || count(*) || ', con host ' || count(hostname) || ', n/d' AS line FROM site_records")
def snk6_summary(spark: SparkSession, root: str) -> DataFrame:
    row = table(spark, root, o.RECORDS).agg(F.count(F.lit(1)).alias("n"), F.count("hostname").alias("hosts"), F.max(F.lit(None).cast("string")).alias("nothing")).first()
    return spark.createDataFrame([(sinks.markdown_summary(row.asDict(), "righe {n}, con host {hosts}, {nothing}"),)], "line string")


@query("SELECT riga_id, punteggio_top AS points, string_split(coalesce(segnali_non_pubblico_rilevati, ''), ';') AS signals FROM tipo_ente_possibili_non_pubblici ORDER BY punteggio_top DESC NULLS LAST, riga_id LIMIT 50")
def snk9_shortlist(spark: SparkSession, root: str) -> DataFrame:
    """A short list as JSON, CSV and Markdown; the JSON is read again."""
    order = [F.desc_nulls_last("points"), F.asc("riga_id")]
    rows = table(spark, root, o.TYPES).select("riga_id", F.col("punteggio_top").alias("points"), F.split(F.coalesce("segnali_non_pubblico_rilevati", F.lit("")), ";").alias("signals"))
    paths = sinks.write_shortlist(rows.orderBy(*order).limit(50), f"{folder(spark, 'shortlist')}/lista", "riga_id", [("Punti", "points"), ("Segnali", "signals")], order, "Da verificare", ("signals",))
    return spark.read.schema("riga_id bigint, points int, signals array<string>").option("multiLine", True).json(paths[0])


@query("""WITH s AS (SELECT trim(hostname) AS hostname, tipo_link, rec_id FROM site_records WHERE coalesce(trim(hostname), '') <> '') SELECT hostname, arg_min(tipo_link, rec_id) AS tipo_link FROM (SELECT hostname, coalesce(tipo_link, '') AS tipo_link, rec_id FROM s) GROUP BY 1""")
def mn1_first_links(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, o.RECORDS).select(strip("hostname").alias("hostname"), F.coalesce("tipo_link", F.lit("")).alias("tipo_link"), "rec_id")
    return files.first_links(rows.filter("hostname is null"), rows, "hostname", "tipo_link", "rec_id")


@query("SELECT " + ", ".join(f"coalesce({c}, '') AS {c}" for c in RECORD_COLUMNS) + " FROM site_records")
def mn2_read_own(spark: SparkSession, root: str) -> DataFrame:
    path = folder(spark, "own")
    table(spark, root, o.RECORDS).select(*RECORD_COLUMNS).write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return files.read_own(spark, path, SITE_RECORD)


@query(f"SELECT rec_id, h <> '' AND NOT (h = 'sportello-condiviso.example' OR ends_with(h, '.sportello-condiviso.example')) AS plausible FROM (SELECT rec_id, rtrim({_BARE}, '.') AS h FROM site_records)")
def mn5_plausible_site(spark: SparkSession, root: str) -> DataFrame:
    host = F.rtrim(o._bare(F.col("hostname")), F.lit("."))
    return table(spark, root, o.RECORDS).select("rec_id", urls.plausible_site(host, ["sportello-condiviso.example"]).alias("plausible"))


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN false ELSE true END AS html FROM documents")
def mn10_html_types(spark: SparkSession, root: str) -> DataFrame:
    kind = F.element_at(F.array(F.lit("Text/HTML; charset=utf-8"), F.lit("application/xhtml+xml"), F.lit("application/pdf"), F.lit(None)), (F.col("doc_id") % 4).cast("int") + 1)
    return table(spark, root, "documents").select("doc_id", pages.is_html_type(kind).alias("html"))


@query("SELECT doc_id AS page_id, text FROM documents WHERE text IS NOT NULL")
def mn11_decoded_answers(spark: SparkSession, root: str) -> DataFrame:
    """Answers in UTF-8, in UTF-16 with a byte order mark, with the set in the header, and with it in the page."""
    k = F.col("doc_id") % 4
    rows = table(spark, root, "documents").filter("text is not null").select("doc_id", "text", k.alias("k"))
    wide = rows.select("doc_id", F.when(F.col("k") == 1, F.encode("text", "UTF-16")).otherwise(F.encode("text", "UTF-8")).alias("raw"), F.when(F.col("k") == 2, "text/html; charset='UTF-8'").otherwise("text/html").alias("type"))
    return files.charsets(wide, "doc_id", "raw", "type").select("page_id", "text")


@query(f"""WITH e AS (SELECT riga_id, {_first_sql(network.ERROR_CLASSES, "lower(coalesce(http_errore_classificazione, '') || ' ')", "'sconosciuto'")} AS k FROM tipo_ente_possibili_non_pubblici)
SELECT riga_id, k AS class, k IN ({", ".join(f"'{c}'" for c in network.RETRYABLE)}) AS again FROM e""")
def fn39_mn12_error_classes(spark: SparkSession, root: str) -> DataFrame:
    k = network.error_class(F.col("http_errore_classificazione"), F.lit(""))
    return table(spark, root, o.TYPES).select("riga_id", k.alias("class")).withColumn("again", network.retry_worthwhile(F.col("class")))


@query("SELECT count(*) + 10 + (SELECT least(500, count(*)) FROM site_records WHERE tls_error <> '') AS n_lines FROM (SELECT DISTINCT source_seed, country_code FROM site_records)")
def mn13_crawl_report(spark: SparkSession, root: str) -> DataFrame:
    """The number of lines of the report: one per seed and level, one per error, and ten around them."""
    rows = table(spark, root, o.RECORDS)
    report = sinks.crawl_report(rows, rows.filter("tls_error <> ''"), "source_seed", "country_code", "hostname", "loaded_at", ["hostname", "tls_error"])
    return spark.createDataFrame([(report.count("\n") + 1,)], "n_lines bigint")


@query("SELECT country_code AS country, bool_or(coalesce(tls_error, '') <> '') AS failed, count(*) AS total, (SELECT max(CASE WHEN tls_error <> '' THEN 1 ELSE 0 END) FROM site_records WHERE country_code IS NOT NULL)::INT AS code FROM site_records WHERE country_code IS NOT NULL GROUP BY 1")
def mn14_run_summary(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, o.RECORDS).filter("country_code is not null")
    body, code = sinks.run_summary(rows, "country_code", F.col("tls_error") != "", F.lit(1))
    return spark.createDataFrame([(k, v["failed"], v["total"], code) for k, v in json.loads(body).items()], "country string, failed boolean, total bigint, code int")


@query("SELECT count(*) AS n FROM site_records")
def mn15_history(spark: SparkSession, root: str) -> DataFrame:
    """A report with a dated copy beside it, which is read."""
    path = f"{folder(spark, 'report')}/report.json"
    sinks._put(spark, path, json.dumps({"n": table(spark, root, o.RECORDS).count()}).encode())
    return spark.read.schema("n bigint").json(sinks.keep_history(spark, path, "2026-01-31"))


@query("""WITH a AS (SELECT l_orderkey AS k, max_by({'d': l_suppkey, 's': l_tax::DOUBLE, 'e': CASE WHEN l_linenumber = 7 THEN 'timeout' END}, {'u': CASE WHEN l_linenumber = 7 THEN 0 ELSE 1 END, 's': l_tax::DOUBLE, 'd': l_suppkey}) AS a FROM lineitem WHERE l_linenumber > 4 GROUP BY 1)
SELECT o_orderkey, CASE WHEN a.e IS NOT NULL THEN '' ELSE coalesce(a.d::VARCHAR, '') END AS dipendenza, coalesce(a.e, '') AS errore, CASE WHEN a.e IS NULL THEN round(a.s, 3) END::DOUBLE AS quota FROM orders LEFT JOIN a ON o_orderkey = k""")
def mn17_dependency_columns(spark: SparkSession, root: str) -> DataFrame:
    answers = table(spark, root, "lineitem").filter("l_linenumber > 4").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("dipendenza"), F.col("l_tax").cast("double").alias("quota"), F.when(F.col("l_linenumber") == 7, "timeout").alias("errore"))
    out = joins.dependency_columns(table(spark, root, "orders").select("o_orderkey"), "o_orderkey", answers, "dipendenza", "quota", "errore")
    return out.select("o_orderkey", "dipendenza", "errore", F.col("quota").try_cast("double").alias("quota"))


@query("""WITH v AS (SELECT hostname, min(natura) AS natura FROM siti_classificati WHERE hostname IS NOT NULL GROUP BY 1) SELECT rec_id, coalesce(v.natura, 'non_classificato') AS natura FROM site_records r LEFT JOIN v ON r.hostname = v.hostname""")
def jn14_attach_results(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, o.RECORDS).select("rec_id", "hostname")
    results = table(spark, root, o.SITES).filter("hostname is not null").groupBy("hostname").agg(F.min("natura").alias("natura"))
    return joins.attach_results(rows, "rec_id", rows, results, "hostname", ["natura"], "non_classificato").select("rec_id", "natura")


@query("""SELECT dominio_radice, hostname, row_number() OVER (PARTITION BY dominio_radice ORDER BY o, hostname) AS position FROM (SELECT dominio_radice, hostname, min(rec_id) AS o FROM site_records WHERE hostname IS NOT NULL GROUP BY 1, 2)""")
def st5_ordered_distinct(spark: SparkSession, root: str) -> DataFrame:
    return sets.ordered_distinct(table(spark, root, o.RECORDS), ["dominio_radice"], "hostname", ["rec_id"])


@query("SELECT coalesce(n_nationkey, s_suppkey) AS i, n_name, s_name FROM nation FULL JOIN supplier ON n_nationkey = s_suppkey")
def st9_side_by_side(spark: SparkSession, root: str) -> DataFrame:
    a = table(spark, root, "nation").select(F.col("n_nationkey").cast("bigint").alias("i"), "n_name")
    return sets.side_by_side(a, table(spark, root, "supplier").select(F.col("s_suppkey").cast("bigint").alias("i"), "s_name"), "i")


# -- single functions


@query("SELECT doc_id, ip, CASE WHEN contains(ip, ':') THEN '2001:db8:' || ltrim(lower(to_hex(doc_id % 65536)), '0') || '::/48' ELSE regexp_replace(ip, '\\.\\d+$', '.0/24') END AS block FROM (SELECT doc_id, unnest(['192.0.2.' || (doc_id % 256), '2001:0DB8:' || upper(to_hex(doc_id % 65536)) || '::' || (doc_id % 10)]) AS ip FROM documents WHERE doc_id % 65536 > 0)")
def fn31_ip_blocks(spark: SparkSession, root: str) -> DataFrame:
    low = F.lower(F.hex(F.col("doc_id") % 65536))
    ips = F.array(F.concat(F.lit("192.0.2."), F.col("doc_id") % 256), F.concat(F.lit("2001:0DB8:"), F.upper(low), F.lit("::"), F.col("doc_id") % 10))
    rows = table(spark, root, "documents").filter("doc_id % 65536 > 0").select("doc_id", F.explode(ips).alias("ip"))
    return rows.select("doc_id", "ip", network.ip_block(F.col("ip")).alias("block"))


@query(f"""WITH j AS (SELECT rec_id, coalesce({_first_sql(network.JURISDICTIONS, "lower(coalesce(nome_ente, ''))")}, CASE WHEN coalesce(country_code, '') <> '' THEN '(non riconosciuto; Paese ASN: ' || country_code || ')' END, '') AS label FROM site_records)
SELECT rec_id, label, CASE WHEN regexp_extract(label, 'Paese ASN:\\s*([A-Z]{{2}})', 1) <> '' THEN 'Non riconosciuto (' || regexp_extract(label, 'Paese ASN:\\s*([A-Z]{{2}})', 1) || ')' WHEN trim(regexp_extract(label, '^([^(]+)\\s*\\(', 1)) <> '' THEN trim(regexp_extract(label, '^([^(]+)\\s*\\(', 1)) ELSE trim(label) END AS area FROM j""")
def fn34_fn35_jurisdictions(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, o.RECORDS).select("rec_id", network.jurisdiction(F.col("nome_ente"), F.col("country_code")).alias("label"))
    return rows.withColumn("area", network.macro_area(F.col("label")))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 5 THEN '' WHEN l_linenumber = 1 THEN 'D' WHEN l_quantity * 8 < 128 THEN 'C' WHEN l_returnflag <> 'N' THEN 'B' ELSE 'A' END AS grade FROM lineitem")
def fn36_tls_grades(spark: SparkSession, root: str) -> DataFrame:
    n = F.col("l_linenumber")
    protocols = F.when(n == 1, F.array(F.lit("TLSv1.1"), F.lit("TLSv1.2"))).when(n != 5, F.array(F.lit("TLSv1.2"), F.lit("TLSv1.3")))
    return table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", network.tls_grade(protocols, F.col("l_quantity") * 8, F.when(n != 6, F.col("l_returnflag") == "N").otherwise(F.col("l_returnflag") == "N")).alias("grade"))


@query("""WITH t AS (SELECT riga_id, upper(coalesce(country_code, '')) AS c, regexp_extract(lower(trim(coalesce(lang, ''))), '^([^-_]*)', 1) AS l, lower(coalesce(evidenza, '')) AS e FROM siti_classificati)
SELECT riga_id, (CASE WHEN regexp_matches(e, '\\bcomune') THEN 1 ELSE 0 END + CASE WHEN regexp_matches(e, '\\bconseil') THEN 1 ELSE 0 END + CASE WHEN c = 'IT' AND l = 'it' AND regexp_matches(e, '\\bufficio') THEN 1 ELSE 0 END)::INT AS n FROM t""")
def sc9_gated_words(spark: SparkSession, root: str) -> DataFrame:
    """Words that count on every page, and one that counts on Italian pages in Italian only."""
    n = scoring.gated_pattern(["comune", "conseil"], ["ufficio"], F.col("country_code"), F.col("lang"), ("IT", "it"), F.lower(F.coalesce("evidenza", F.lit(""))))
    return table(spark, root, o.SITES).select("riga_id", n.alias("n"))


@query("""WITH s AS (SELECT event_id, greatest(value, 0)::DOUBLE AS a, (event_id % 7)::DOUBLE AS b, (event_id % 11)::DOUBLE AS c FROM events WHERE value IS NOT NULL),
r AS (SELECT event_id, list_reverse_sort([{'s': a, 'k': 'pubblico'}, {'s': b, 'k': 'privato'}, {'s': c, 'k': 'terzo_settore'}]) AS l FROM s)
SELECT event_id, l[1].k AS value, round(0.85 * (1 - exp(-greatest(l[1].s - l[2].s, 0) / 6.0)), 3)::DOUBLE AS conf FROM r WHERE l[1].s >= 3 AND l[1].s > 1.2 * l[2].s""")
def sc8_nature_votes(spark: SparkSession, root: str) -> DataFrame:
    v = scoring.nature_vote(F.greatest(F.col("value"), F.lit(0)), F.col("event_id") % 7, F.col("event_id") % 11)
    rows = table(spark, root, "events").filter("value is not null").select("event_id", v.alias("v")).filter("v is not null")
    return rows.select("event_id", "v.value", "v.conf")


@query("""SELECT hostname, d AS domain, {c} AS category, {p} AS parent, min(nullif(trim(country_code), '')) AS country FROM (SELECT hostname, country_code, u, lower(regexp_extract(u, '://([^/?#:]*)', 1)) AS d FROM (SELECT hostname, country_code, unnest(regexp_extract_all(text, 'src="([^"]+)"', 1)) AS u FROM documents)) GROUP BY 1, 2""".replace("{c}", "min(" + o._vendor_sql("u", "category") + ")").replace("{p}", "min(" + o._vendor_sql("u", "parent") + ")"))
def ag26_third_parties_long(spark: SparkSession, root: str) -> DataFrame:
    from lodestrata.operators import rollups

    refs = table(spark, root, "documents").select("hostname", "country_code", F.explode(F.regexp_extract_all("text", F.lit('src="([^"]+)"'), F.lit(1))).alias("u"))
    rows = refs.select("hostname", "country_code", urls.host_of(F.col("u")).alias("domain"), rules.third_party(F.col("u")).alias("t")).select("*", "t.category", "t.parent")
    return rollups.third_parties_long(rows, "hostname", "domain", "category", "parent", "country_code").drop("outside")
