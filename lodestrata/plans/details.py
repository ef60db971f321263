"""Queries of single functions, sources, sinks and streams over the test tables, each with its SQL where SQL can say it."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestrata.functions import network, pages, text, urls
from lodestrata.functions.cells import strip
from lodestrata.lineage import folder
from lodestrata.operators import distributions, joins, ranking, sets
from lodestrata.plans import analytics as o
from lodestrata.schemas import RECORD_COLUMNS, SITE_RECORD
from lodestrata.session import table
from lodestrata.sources import config, files, sinks
from lodestrata.streaming import incremental

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


def _records(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, o.RECORDS)


# -- sources and sinks


@query("SELECT " + ", ".join(f"nullif({c}, '') AS {c}" for c in RECORD_COLUMNS) + " FROM site_records")
def src1_csv_round_trip(spark: SparkSession, root: str) -> DataFrame:
    path = folder(spark, "csv")
    _records(spark, root).select(*RECORD_COLUMNS).write.option("header", True).option("sep", ";").option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return files.read_csv(spark, path, SITE_RECORD)


@query("SELECT c_custkey, c_name, CAST(c_acctbal AS DOUBLE) AS c_acctbal FROM customer")
def src6_json_records(spark: SparkSession, root: str) -> DataFrame:
    """Captured pages of an interface, a hundred records each, one page captured twice."""
    rows = table(spark, root, "customer").select("c_custkey", "c_name", F.col("c_acctbal").cast("double").alias("c_acctbal"))
    answers = rows.groupBy(F.floor(F.col("c_custkey") / 100).alias("p")).agg(F.array_sort(F.collect_list(F.struct(*rows.columns))).alias("items"))
    body = answers.select(F.to_json(F.struct(F.struct("items").alias("data"))).alias("value"), "p")
    path = folder(spark, "pages")
    for name, part in (("all", body), ("again", body.filter("p = 0"))):
        part.write.partitionBy("p").text(f"{path}/{name}")
    shape = StructType.fromDDL("data struct<items: array<struct<c_custkey: bigint, c_name: string, c_acctbal: double>>>")
    return files.read_json_pages(spark, f"{path}/*/p=*", shape, "data.items", min_records=100)


@query("SELECT c_custkey, coalesce(n_name, '') AS n_name, coalesce(r_name, '') AS r_name FROM customer LEFT JOIN (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 7) ON c_nationkey = n_nationkey")
def src11_reference_dimension(spark: SparkSession, root: str) -> DataFrame:
    """A dimension out of nested JSON, joined to what refers to it; one key is missing from it."""
    nested = table(spark, root, "nation").filter("n_nationkey <> 7").join(F.broadcast(table(spark, root, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    path = folder(spark, "dimension")
    rows = F.collect_list(F.struct(F.col("n_nationkey").alias("codice"), "n_name", F.struct(F.struct("r_name").alias("nome")).alias("area")))
    nested.agg(F.to_json(rows).alias("value")).write.text(path)
    shape = StructType.fromDDL("codice bigint, n_name string, area struct<nome: struct<r_name: string>>")
    dim = files.dimension_from_json(spark, path, shape, {"c_nationkey": "codice", "n_name": "n_name", "r_name": "area.nome.r_name"})
    own = table(spark, root, "customer").withColumn("c_nationkey", F.col("c_nationkey").cast("string"))
    return joins.lookup_dimension(own, dim, "c_nationkey", ["n_name", "r_name"]).select("c_custkey", "n_name", "r_name")


@query("SELECT 'own' AS source, rec_id AS id FROM site_records UNION ALL SELECT 'fallback', riga_id FROM siti_classificati")
def src13_input_cascade(spark: SparkSession, root: str) -> DataFrame:
    """The first input where it has a host, the second where all of the first one's are blank."""
    rows, sites = _records(spark, root).select(F.col("rec_id").alias("id"), "hostname"), table(spark, root, o.SITES).select(F.col("riga_id").alias("id"), "hostname")
    blank = rows.filter("coalesce(trim(hostname), '') = ''")
    own, other = files.first_with_rows(rows, sites, "hostname"), files.first_with_rows(blank, sites, "hostname")
    return own.select(F.lit("own").alias("source"), "id").unionByName(other.select(F.lit("fallback").alias("source"), "id"))


@query("SELECT (row_number() OVER (ORDER BY n_nationkey) - 1)::INT AS rule_order, lower(n_name) AS pattern, n_nationkey::VARCHAR AS vendor, CASE WHEN n_regionkey > 1 THEN n_regionkey::VARCHAR END AS organizzazione_madre FROM nation")
def src15_rule_table(spark: SparkSession, root: str) -> DataFrame:
    """Rules as a file lists them, in its order; the file is written from the nations, a table of 25 rows."""
    rows = table(spark, root, "nation").orderBy("n_nationkey").limit(100).collect()
    text_ = json.dumps({"regole": [{"pattern": r["n_name"], "vendor": r["n_nationkey"], **({"organizzazione_madre": r["n_regionkey"]} if r["n_regionkey"] > 1 else {})} for r in rows]})
    return config.rule_table(spark, config.load_text(text_)[0]["regole"], ["pattern", "vendor", "organizzazione_madre"])


@query("SELECT rec_id FROM site_records")
def snk2_append_resumes(spark: SparkSession, root: str) -> DataFrame:
    path = folder(spark, "append")
    rows = _records(spark, root).select("rec_id")
    sinks.append_new(rows.filter("rec_id % 3 = 0"), path, "rec_id")
    sinks.append_new(rows, path, "rec_id")
    return spark.read.parquet(path)


@query("SELECT to_json({'id': {'s_suppkey': s_suppkey, 's_nationkey': s_nationkey}, 'name': {'s_name': s_name}})::VARCHAR AS document FROM supplier")
def snk5_json_documents(spark: SparkSession, root: str) -> DataFrame:
    return sinks.json_document(table(spark, root, "supplier"), {"id": ["s_suppkey", "s_nationkey"], "name": ["s_name"]})


@query("SELECT dominio_radice, n, '- ' || dominio_radice || ' (' || n || ')' AS line FROM (SELECT dominio_radice, count(*) AS n FROM site_records WHERE dominio_radice IS NOT NULL GROUP BY 1)")
def snk7_markdown_lines(spark: SparkSession, root: str) -> DataFrame:
    counts = _records(spark, root).filter("dominio_radice is not null").groupBy("dominio_radice").agg(F.count(F.lit(1)).alias("n"))
    return sinks.markdown_lines(counts, "- %s (%d)", ["dominio_radice", "n"])


@query(f"SELECT rec_id, found_on, coalesce(v.natura, 'non_controllato') AS verdict FROM site_records r LEFT JOIN {o._BY_HOST.format('min(natura) AS natura', o.SITES)} v ON r.hostname = v.hostname")
def snk8_all_occurrences(spark: SparkSession, root: str) -> DataFrame:
    v = table(spark, root, o.SITES).filter("hostname is not null").groupBy("hostname").agg(F.min("natura").alias("verdict"))
    out = joins.fan_out(_records(spark, root).select("rec_id", "hostname", "found_on"), v, "hostname")
    return out.select("rec_id", "found_on", F.coalesce("verdict", F.lit("non_controllato")).alias("verdict"))


@query("SELECT count(*) AS n_rows, count(*) FILTER (da_rivedere = 'si') AS n_review FROM siti_classificati")
def snk10_review_counters(spark: SparkSession, root: str) -> DataFrame:
    return sinks.review_split(table(spark, root, o.SITES), F.col("da_rivedere") == "si")[1]


@query("SELECT paese AS country, arg_max(run_id, struct_pack(a := run_ts, b := run_id)) AS run_id, max(run_ts) AS updated FROM dark_stack_manifest GROUP BY 1")
def snk11_latest_runs(spark: SparkSession, root: str) -> DataFrame:
    return sinks.latest_runs(table(spark, root, "dark_stack_manifest").select(F.col("paese").alias("country"), "run_id", F.col("run_ts").alias("updated")))


# -- streams


def _event_stream(spark: SparkSession, root: str) -> tuple[str, object]:
    schema = table(spark, root, "events").selectExpr("event_id", "cast(ts as timestamp) as ts", "user_id", "event_type", "value").schema
    path = folder(spark, "source")
    table(spark, root, "events").selectExpr("event_id", "cast(ts as timestamp) as ts", "user_id", "event_type", "value").write.parquet(path)
    return path, schema


@query("SELECT event_id, user_id, event_type FROM events")
def ss2_incremental_once(spark: SparkSession, root: str) -> DataFrame:
    path, schema = _event_stream(spark, root)
    target = f"{path}-out"
    for _ in range(2):
        incremental.ingest(spark, path, schema, target, "events", {"path": path}, ["event_id"], "ts", late="60 days").awaitTermination()
    return spark.read.schema(schema).parquet(target).select("event_id", "user_id", "event_type")


@query("SELECT user_id::VARCHAR AS key, epoch_us(max(ts)) // 1000 AS at FROM events WHERE ts IS NOT NULL GROUP BY 1")
def ss5_latest_within_ttl(spark: SparkSession, root: str) -> DataFrame:
    """The last state of each key as the stream's states give it: of the changes that it emits the last one."""
    path, schema = _event_stream(spark, root)
    changes = incremental.latest_with_ttl(spark.readStream.schema(schema).parquet(path), "user_id", "ts", "event_type", "3650 days")
    out = _run(spark, changes, f"{path}-ttl")
    return out.groupBy("key").agg(F.max(F.unix_millis("at")).alias("at"))


def _run(spark: SparkSession, stream: DataFrame, target: str, mode: str = "update") -> DataFrame:
    """Runs a stream over what there is and gives back the rows it wrote."""

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    stream.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", f"{target}-state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(target)


@query("SELECT date_trunc('day', ts)::DATE AS day, count(*) AS n FROM events WHERE ts IS NOT NULL GROUP BY 1")
def ss6_daily_counts(spark: SparkSession, root: str) -> DataFrame:
    path, schema = _event_stream(spark, root)
    out = _run(spark, incremental.daily_counts(spark.readStream.schema(schema).parquet(path), "ts", "3650 days"), f"{path}-days")
    return out.groupBy("day").agg(F.max("n").alias("n"))


@query("SELECT event_id, user_id FROM events")
def ss3_upserted_batches(spark: SparkSession, root: str) -> DataFrame:
    """Micro-batches applied once each: a batch that comes again replaces itself."""
    path, schema = _event_stream(spark, root)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    target = f"{path}-upserts"
    for _ in range(2):
        incremental.upsert_batches(stream, incremental.replace_batch(target), f"{target}-state").awaitTermination()
    return spark.read.parquet(target).select("event_id", "user_id")


@query("""WITH RECURSIVE e AS (SELECT user_id, event_type = 'error' AS bad, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n, event_id FROM events),
s AS (SELECT user_id, 0::BIGINT AS n, 0 AS errors, 0 AS streak, 0 AS retries, NULL::BIGINT AS event_id, '' AS outcome FROM (SELECT DISTINCT user_id FROM events)
UNION ALL SELECT s.user_id, e.n, CASE WHEN bad THEN errors + 1 ELSE 0 END, CASE WHEN bad THEN 0 WHEN streak + 1 >= 5 AND retries > 0 THEN 0 ELSE streak + 1 END,
CASE WHEN bad AND errors + 1 >= 2 AND retries < 3 THEN retries + 1 WHEN NOT bad AND streak + 1 >= 5 AND retries > 0 THEN retries - 1 ELSE retries END, e.event_id,
CASE WHEN NOT bad THEN 'ok' WHEN errors + 1 >= 2 AND retries < 3 THEN 'paused' ELSE 'given_up' END FROM s JOIN e ON s.user_id = e.user_id AND e.n = s.n + 1)
SELECT event_id, outcome, retries FROM s WHERE n > 0""")
def gr3_cooldown(spark: SparkSession, root: str) -> DataFrame:
    """Attempts per host as a stream of states: paused after errors in a row, given up when retries are used, forgiven after successes."""
    path = folder(spark, "attempts")
    rows = table(spark, root, "events").select("event_id", F.col("user_id").cast("string").alias("host"), F.when(F.col("event_type") == "error", "error").otherwise("ok").alias("result"))
    rows.write.parquet(path)
    stream = incremental.host_cooldown(spark.readStream.schema(rows.schema).parquet(path), "host", "event_id", "result", after_errors=2, after_dead=8, retries=3, forgive_after=5)
    return _run(spark, stream, f"{path}-states", "append").select(F.col("seq").alias("event_id"), "outcome", "retries")


# -- functions


@query("SELECT coalesce(nome_ente, '') AS name, coalesce(CAST(rec_id AS VARCHAR), '') AS id, 'IT' AS stamp FROM site_records")
def fn1_field_mapping(spark: SparkSession, root: str) -> DataFrame:
    nested = _records(spark, root).select("rec_id", F.struct(F.struct("nome_ente").alias("b")).alias("a"))
    return files.select_paths(nested, {"name": "a.b.nome_ente", "id": "rec_id"}, stamp="IT")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity = floor(l_quantity) THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) ELSE CAST(CAST(l_quantity AS DOUBLE) AS VARCHAR) END AS quantity, CASE WHEN l_extendedprice = floor(l_extendedprice) THEN CAST(CAST(l_extendedprice AS BIGINT) AS VARCHAR) ELSE CAST(CAST(l_extendedprice AS DOUBLE) AS VARCHAR) END AS price FROM lineitem")
def fn2_cell_text(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", text.cell_text(F.col("l_quantity")).alias("quantity"), text.cell_text(F.col("l_extendedprice")).alias("price"))


@query(f"WITH {o._site_sql(o.RECORDS, 'hostname', 'rec_id')} SELECT rec_id, url FROM sites")
def fn4_normalize_url_value(spark: SparkSession, root: str) -> DataFrame:
    return _records(spark, root).select("rec_id", urls.normalize_url_value(F.col("hostname")).alias("url"))


@query(f"SELECT doc_id, ip, true AS v4 FROM {o._IPS_SQL}")
def fn8_ip_literals(spark: SparkSession, root: str) -> DataFrame:
    ips = table(spark, root, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})"), F.lit(1))).alias("ip"))
    return ips.select("doc_id", "ip", urls.is_ipv4(F.col("ip")).alias("v4"))


@query(f"SELECT rec_id, CASE WHEN contains({_BARE}, '.') AND regexp_matches({_BARE}, '[A-Za-z0-9]') THEN 'http://' || regexp_replace({_BARE}, '^www\\.', '') END AS url FROM site_records")
def fn15_registry_url(spark: SparkSession, root: str) -> DataFrame:
    return _records(spark, root).select("rec_id", urls.registry_url(o._bare(F.col("hostname"))).alias("url"))


@query(f"SELECT rec_id, array_to_string(list_transform(list_sort(list_transform(list_distinct(l), lambda x: {{'i': list_position(l, x), 'x': x}})), lambda y: y.x), ',') AS stems FROM (SELECT rec_id, regexp_extract_all({o._FOLD_SQL.format('nome_ente')}, '\\b(?:comune\\s+di|gemeinde|mairie|ecole\\b)') AS l FROM site_records)")
def fn17_stem_matches(spark: SparkSession, root: str) -> DataFrame:
    found = text.distinct_matches(text.stems_pattern(["comune di", "mairie", "gemeinde", "ecole!"]), text.fold(F.col("nome_ente")))
    return _records(spark, root).select("rec_id", F.array_join(found, ",").alias("stems"))


@query(f"SELECT rec_id, rtrim({_BARE}, '.') = 'sportello-condiviso.example' OR ends_with(rtrim({_BARE}, '.'), '.sportello-condiviso.example') AS inside FROM site_records")
def fn20_domain_list(spark: SparkSession, root: str) -> DataFrame:
    return _records(spark, root).select("rec_id", urls.in_domain_list(o._bare(F.col("hostname")), ["sportello-condiviso.example", "x.example"]).alias("inside"))


@query(f"SELECT rec_id, (CASE WHEN regexp_matches({_BARE}, '(?:^|[.-])(?:gov|gob|gouv|gv)(?:[.-]|$)') THEN 1 ELSE 0 END)::INT AS points FROM site_records")
def fn22_domain_points(spark: SparkSession, root: str) -> DataFrame:
    return _records(spark, root).select("rec_id", urls.domain_points(o._bare(F.col("hostname")), F.lit("zz")).alias("points"))


@query(f"SELECT rec_id, regexp_matches(lower(regexp_replace(coalesce(found_on, ''), '(?s)[?#].*$', '')), '\\.(?:{'|'.join(urls.FILE_ENDINGS)})$') AS file FROM site_records")
def fn23_file_urls(spark: SparkSession, root: str) -> DataFrame:
    return _records(spark, root).select("rec_id", urls.is_file_url(F.col("found_on")).alias("file"))


_TXT_SQL = "replace(regexp_replace({0}, '^\"+|\"+$', '', 'g'), '\" \"', '')"


@query(f"""WITH t AS (SELECT rec_id, [tls_error, '"v=spf1 include:' || hostname || '" " -all"', '"v=spf1 ' || dominio_radice || '"', 'v=DMARC1; p=none; rua=' || sector || '; P=' || sector] AS r FROM site_records),
u AS (SELECT rec_id, list_transform(r, lambda x: {_TXT_SQL.format('x')}) AS r FROM t), w AS (SELECT rec_id, list_filter(r, lambda x: starts_with(lower(x), 'v=spf1')) AS s, list_filter(r, lambda x: starts_with(lower(x), 'v=dmarc1')) AS d FROM u)
SELECT rec_id, s[1] AS spf, regexp_replace(list_filter(list_transform(string_split(d[1], ';'), lambda x: trim(x)), lambda x: starts_with(lower(x), 'p='))[-1], '^[pP]=', '') AS policy FROM w""")
def fn28_fn29_mail_policies(spark: SparkSession, root: str) -> DataFrame:
    """Records built from every row's cells, quotes and nulls included."""
    txt = F.array(F.col("tls_error"), F.concat(F.lit('"v=spf1 include:'), "hostname", F.lit('" " -all"')), F.concat(F.lit('"v=spf1 '), "dominio_radice", F.lit('"')), F.concat(F.lit("v=DMARC1; p=none; rua="), "sector", F.lit("; P="), "sector"))
    return _records(spark, root).select("rec_id", network.spf_record(txt).alias("spf"), network.dmarc_policy(txt).alias("policy"))


@query(f"""WITH m AS (SELECT rec_id, [rec_id % 30 || ' ' || dominio_radice || '.', '0 .', rec_id % 7 || '  ' || upper(country_code) || '.Mail.', nome_ente] AS l FROM site_records),
p AS (SELECT rec_id, list_filter(list_transform(l, lambda x: {{'n': try_cast(regexp_extract(x, '^(\\d+)', 1) AS INT), 'h': rtrim(lower(regexp_extract(x, '^\\d+\\s+(\\S*)$', 1)), '.')}}), lambda x: x.h <> '') AS l FROM m)
SELECT rec_id, array_to_string(list_transform(list_sort(l), lambda x: x.h), ',') AS mx FROM p""")
def fn30_mail_hosts(spark: SparkSession, root: str) -> DataFrame:
    """Answers built from every row's cells: hosts, a null MX, a text that is none."""
    mx = F.array(F.concat(F.col("rec_id") % 30, F.lit(" "), "dominio_radice", F.lit(".")), F.lit("0 ."), F.concat(F.col("rec_id") % 7, F.lit("  "), F.upper("country_code"), F.lit(".Mail.")), F.col("nome_ente"))
    return _records(spark, root).select("rec_id", F.array_join(network.mail_hosts(mx), ",").alias("mx"))


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 4 > 1 THEN s_suppkey::VARCHAR END AS asn, CASE WHEN s_suppkey % 4 > 1 THEN '192.0.2.' || s_nationkey END AS ip, CASE WHEN s_suppkey % 4 > 1 THEN s_name END AS name FROM supplier""")
def fn32_bulk_asn_lines(spark: SparkSession, root: str) -> DataFrame:
    """Lines with a number, and headers and unknown networks among them."""
    first = F.when(F.col("s_suppkey") % 4 == 0, "AS").when(F.col("s_suppkey") % 4 == 1, "NA").otherwise(F.col("s_suppkey").cast("string"))
    line = F.concat_ws(" | ", first, F.concat(F.lit("192.0.2."), "s_nationkey"), F.lit("192.0.2.0/24"), F.lit("IT"), "s_name")
    return table(spark, root, "supplier").select("s_suppkey", network.bulk_asn_fields(line).alias("f")).select("s_suppkey", "f.asn", "f.ip", "f.name")


@query("SELECT riga_id, CASE WHEN trim(coalesce(nome_ente, '')) = '' OR trim(coalesce(country_code, '')) = '' OR contains(upper(trim(nome_ente)), upper(trim(country_code))) THEN trim(coalesce(nome_ente, '')) ELSE trim(nome_ente) || ' (' || trim(country_code) || ')' END AS label FROM siti_classificati")
def fn33_org_labels(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, o.SITES).select("riga_id", network.org_label(F.col("nome_ente"), F.col("country_code")).alias("label"))


@query("""SELECT l_orderkey, l_linenumber, concat_ws(',', CASE WHEN n % 11 = 0 OR n % 13 = 1 THEN 'Cloudflare' END, CASE WHEN n % 11 = 1 OR n % 13 = 2 THEN 'Akamai' END, CASE WHEN n % 11 = 2 OR n % 7 = 1 THEN 'Amazon CloudFront' END,
CASE WHEN n % 11 = 3 OR n % 7 = 2 OR n % 5 = 1 THEN 'Fastly' END, CASE WHEN n % 13 = 3 THEN 'Google Frontend' END, CASE WHEN n % 7 = 3 THEN 'Varnish (generico)' END, CASE WHEN n % 11 = 4 THEN 'Sucuri' END, CASE WHEN n % 11 = 5 OR n % 5 = 2 THEN 'Imperva/Incapsula' END) AS cdn
FROM (SELECT l_orderkey, l_linenumber, l_partkey AS n FROM lineitem)""")
def fn37_cdns(spark: SparkSession, root: str) -> DataFrame:
    """Headers built from every row's number, so that each sign of each network occurs, alone and with others."""
    n = F.col("l_partkey")
    pick = lambda m, values: F.element_at(F.array(*[F.lit(v) for v in values] + [F.lit("")] * (m - len(values))), (n % m).cast("int") + 1)
    own = F.map_from_arrays(F.array(F.concat(pick(11, ["cf-ray", "x-akamai-transformed", "x-amz-cf-id", "x-fastly-request-id", "x-sucuri-id", "x-iinfo"]), F.lit("")), F.lit("server"), F.lit("via"), F.lit("x-served-by"), F.lit("x-cdn")), F.array(
        F.lit("1"), pick(13, ["nginx", "Cloudflare", "AkamaiGHost", "GWS"]), pick(7, ["", "1.1 abc.CloudFront.net", "1.1 fastly", "1.1 varnish"]), F.when(n % 5 == 1, "cache-fra1").otherwise(""), F.when(n % 5 == 2, "Incapsula").otherwise(""),
    ))
    return table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", F.array_join(network.cdns(own), ",").alias("cdn"))


@query("SELECT rec_id, found_on AS target FROM site_records WHERE found_on <> ''")
def fn48_redirect_targets(spark: SparkSession, root: str) -> DataFrame:
    wrapped = F.concat(F.lit("https://d.example/l/?uddg="), F.url_encode("found_on"), F.lit("&rut=1"))
    return _records(spark, root).filter("found_on <> ''").select("rec_id", urls.redirect_target(wrapped).alias("target"))


@query("""WITH h AS (SELECT rec_id, list_filter(list_transform(string_split(coalesce(host_osservati, ''), '|'), lambda x: trim(replace(replace(x, '<', ''), '&', ''))), lambda x: x <> '') AS l FROM site_records)
SELECT rec_id, array_to_string(l[1:200], '|') AS loc FROM h""")
def ht6_sitemap(spark: SparkSession, root: str) -> DataFrame:
    """Sitemaps that list each row's hosts."""
    locs = F.filter(F.transform(F.split(F.coalesce("host_osservati", F.lit("")), r"\|"), lambda x: strip(F.regexp_replace(x, "[<&]", ""))), lambda x: x != "")
    xml = F.concat(F.lit("<urlset>"), F.array_join(F.transform(locs, lambda x: F.concat(F.lit("<url><LOC>\n "), x, F.lit(" </loc></url>"))), ""), F.lit("</urlset>"))
    return _records(spark, root).select("rec_id", F.array_join(pages.sitemap_urls(xml), "|").alias("loc"))


@query("""WITH s AS (SELECT 'r' || n_regionkey AS sitemap, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey, c_custkey) AS position, 'n' || c_nationkey || '/' || c_custkey AS page FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT * FROM s WHERE position <= 200 UNION ALL SELECT 'n' || c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS position, 'n' || c_nationkey || '/' || c_custkey FROM customer QUALIFY position <= 200""")
def ht6_sitemap_index(spark: SparkSession, root: str) -> DataFrame:
    """A sitemap per nation that lists its customers, and an index per region that lists its nations' sitemaps."""
    loc = lambda c: F.concat(F.lit("<loc>"), c, F.lit("</loc>"))
    key = lambda c: F.concat(F.lit("n"), c)
    one = table(spark, root, "customer").groupBy("c_nationkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list("c_custkey")), lambda k: loc(F.concat(key(F.col("c_nationkey")), F.lit("/"), k))), "").alias("l"))
    maps = one.select(key(F.col("c_nationkey")).alias("url"), F.concat(F.lit("<urlset>"), "l", F.lit("</urlset>")).alias("xml"))
    index = table(spark, root, "nation").groupBy("n_regionkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list("n_nationkey")), lambda k: loc(key(k))), "").alias("l"))
    maps = maps.unionByName(index.select(F.concat(F.lit("r"), "n_regionkey").alias("url"), F.concat(F.lit("<sitemapindex>"), "l", F.lit("</sitemapindex>")).alias("xml")))
    return pages.sitemap_pages(maps, "url", "xml").select("sitemap", F.col("position").cast("bigint").alias("position"), "page")


@query("SELECT doc_id, array_to_string(regexp_extract_all(text, 'cookie (\\S+)', 1), ',') AS names FROM documents WHERE text IS NOT NULL")
def ht7_cookie_names(spark: SparkSession, root: str) -> DataFrame:
    """Headers that set the cookies which the texts name."""
    header = F.transform(F.regexp_extract_all("text", F.lit(r"cookie (\S+)"), F.lit(1)), lambda c: F.concat(c, F.lit(" =a=b; Path=/")))
    return table(spark, root, "documents").filter("text is not null").select("doc_id", F.array_join(pages.cookie_names(header), ",").alias("names"))


@query("SELECT count(*) FILTER (http_status_classificazione BETWEEN 200 AND 299) AS s2, count(*) FILTER (http_status_classificazione BETWEEN 500 AND 599) AS s5, count(*) AS n FROM tipo_ente_possibili_non_pubblici")
def fl6_range_buckets(spark: SparkSession, root: str) -> DataFrame:
    s = F.col("http_status_classificazione")
    return distributions.counts_where(table(spark, root, o.TYPES), {"s2": s.between(200, 299), "s5": s.between(500, 599)})


_PAGE_STATUS_SQL = """CASE WHEN coalesce(http_errore_classificazione, '') <> '' THEN CASE WHEN http_errore_classificazione = 'timeout' THEN 'timeout' WHEN starts_with(http_errore_classificazione, 'dns:') THEN 'dns_error' WHEN starts_with(http_errore_classificazione, 'tls:') THEN 'tls_error' ELSE 'http_error' END
WHEN http_status_classificazione IS NULL THEN 'no_answer' WHEN http_status_classificazione < 400 THEN 'ok' WHEN http_status_classificazione IN (401, 403, 406, 429) THEN 'blocked' ELSE 'http_error' END"""


@query(f"SELECT riga_id, {_PAGE_STATUS_SQL} AS status FROM tipo_ente_possibili_non_pubblici")
def mn7_homepage_status(spark: SparkSession, root: str) -> DataFrame:
    status = network.page_status(F.col("http_errore_classificazione"), F.col("http_status_classificazione"))
    return table(spark, root, o.TYPES).select("riga_id", status.alias("status"))


@query(f"SELECT hostname, arg_min(s, list_position(['ok', 'blocked', 'tls_error', 'timeout', 'dns_error', 'http_error', 'no_answer'], s)) AS status FROM (SELECT hostname, {_PAGE_STATUS_SQL} AS s FROM tipo_ente_possibili_non_pubblici) GROUP BY 1")
def mn8_best_status(spark: SparkSession, root: str) -> DataFrame:
    """The best status of every host, errors and missing answers included."""
    status = network.page_status(F.col("http_errore_classificazione"), F.col("http_status_classificazione"))
    rank = F.array_position(F.array(*[F.lit(x) for x in network.STATUS_PRIORITY]), F.col("status"))
    return table(spark, root, o.TYPES).select("hostname", status.alias("status")).groupBy("hostname").agg(F.min_by("status", rank).alias("status"))


@query(f"""WITH h AS (SELECT rec_id, {_BARE} AS h FROM site_records), v AS (SELECT rec_id, h, CASE WHEN starts_with(h, 'www.') THEN substring(h, 5) ELSE 'www.' || h END AS a FROM h)
SELECT rec_id, 'https://' || h || '/ https://' || a || '/ http://' || h || '/ http://' || a || '/' AS candidates FROM v""")
def mn6_candidate_urls(spark: SparkSession, root: str) -> DataFrame:
    return _records(spark, root).select("rec_id", F.array_join(urls.candidate_urls(o._bare(F.col("hostname"))), " ").alias("candidates"))


@query("""WITH r AS (SELECT riga_id, http_status_classificazione AS s, coalesce(http_errore_classificazione, '') AS e, riga_id % 3 AS k FROM tipo_ente_possibili_non_pubblici)
SELECT riga_id, CASE WHEN e <> '' OR s IS NULL THEN true WHEN s BETWEEN 500 AND 599 THEN false WHEN s BETWEEN 200 AND 299 THEN k <> 1 ELSE true END AS allowed, CASE WHEN e = '' AND s BETWEEN 200 AND 299 THEN CASE k WHEN 1 THEN 7.0 WHEN 2 THEN 30.0 ELSE 0.0 END ELSE 0.0 END::DOUBLE AS delay FROM r""")
def mn19_robots(spark: SparkSession, root: str) -> DataFrame:
    """Every row's answer, with rules of three kinds: none, one that forbids the path, one that asks for too long a delay."""
    rules_ = F.element_at(F.array(F.lit(""), F.lit("User-agent: *\nCrawl-delay: 7\nDisallow: /atti\n"), F.lit("User-agent: osservatorio\nCrawl-delay: 900\nDisallow: /privato\n")), (F.col("riga_id") % 3).cast("int") + 1)
    rows = table(spark, root, o.TYPES).select("riga_id", F.lit("https://a.example/atti/1").alias("url"), F.col("http_status_classificazione").alias("status"), F.col("http_errore_classificazione").alias("error"), rules_.alias("robots"))
    return network.robots_decisions(rows, "riga_id", "url", "status", "error", "robots", agent="osservatorio", max_delay=30.0).select(F.col("row_id").alias("riga_id"), "allowed", "delay")


@query("SELECT count(*) FILTER (ts::DATE = DATE '2024-01-15') AS used, greatest(0, 500 - count(*) FILTER (ts::DATE = DATE '2024-01-15')) AS left FROM events")
def mn16_same_day(spark: SparkSession, root: str) -> DataFrame:
    """The quota of a day: what its calls used and left."""
    return ranking.quota_left(table(spark, root, "events"), "ts", F.lit("2024-01-15").cast("timestamp"), 500)


@query("SELECT rec_id, trim(regexp_replace(coalesce(nome_ente, ''), '[^\\x20-\\x7e]', '', 'g')) AS contact FROM site_records")
def mn18_plain_contact(spark: SparkSession, root: str) -> DataFrame:
    return _records(spark, root).select("rec_id", text.plain_contact(F.col("nome_ente")).alias("contact"))


@query("SELECT rec_id, CASE WHEN source_name = 'crawl' THEN 'a' ELSE 'b' END AS part FROM site_records")
def st6_union_of_parts(spark: SparkSession, root: str) -> DataFrame:
    rows = _records(spark, root)
    crawl = F.coalesce(F.col("source_name") == "crawl", F.lit(False))
    return sets.union_all([rows.filter(crawl).select("rec_id", F.lit("a").alias("part")), rows.filter(~crawl).select("rec_id", F.lit("b").alias("part"))])


@query("SELECT riga_id FROM tipo_ente_possibili_non_pubblici ORDER BY punteggio_top DESC NULLS LAST, riga_id LIMIT 20")
def tk10_quota(spark: SparkSession, root: str) -> DataFrame:
    return ranking.quota_cut(table(spark, root, o.TYPES), [F.desc_nulls_last("punteggio_top"), F.asc("riga_id")], 20).select("riga_id")


@query("SELECT user_id, date_trunc('hour', ts) AS start, count(*) AS n FROM events WHERE ts IS NOT NULL GROUP BY 1, 2")
def extra_hourly_windows(spark: SparkSession, root: str) -> DataFrame:
    """An engine capability beyond the analytic operators: a stream's counts per hour of event time."""
    path, schema = _event_stream(spark, root)
    rows = incremental.windowed(spark.readStream.schema(schema).parquet(path), "ts", "1 hour", None, ["user_id"], late="3650 days")
    out = _run(spark, rows, f"{path}-hours")
    return out.groupBy("user_id", "start").agg(F.max("n").alias("n"))
