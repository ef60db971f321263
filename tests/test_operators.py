"""Operators on small tables with ties, nulls and repeats."""

import math

import pytest
from pyspark.sql import functions as F

from lodestrata.functions import html, network
from lodestrata.operators import concentration, distributions, graph, joins, ranking, rollups, rules, scoring, sets
from lodestrata.plans import analytics, details


def test_concentration_invariants(spark):
    rows = [("a",)] * 6 + [("b",)] * 3 + [(None,)] * 2 + [(" ",)]
    r = concentration.summary(spark.createDataFrame(rows, "k string"), "k").first()
    assert (r["n_total"], r["n_valid"], r["n_keys"], r["reliable"]) == (12, 9, 2, False)
    assert math.isclose(r["hhi"], (6 / 9 * 100) ** 2 + (3 / 9 * 100) ** 2, abs_tol=0.06) and r["coverage"] == "media"
    empty = concentration.summary(spark.createDataFrame([], "k string"), "k").first()
    assert empty["hhi"] == 0 and empty["n_total"] == 0
    labels = spark.createDataFrame([("1", "x"), ("1", "y"), ("1", " "), ("2", None)], "k string, l string")
    assert {r["key"]: r["label"] for r in concentration.modal_labels(labels, "k", "l").collect()} == {"1": "x", "2": "2"}


def test_presence(spark):
    df = spark.createDataFrame([("a;b;a",), ("a",), ("",), (None,)], "c string")
    r = concentration.presence_summary(df, F.split(F.coalesce("c", F.lit("")), ";")).first()
    assert (r["n_total"], r["n_covered"], r["n_items"]) == (4, 2, 2) and r["hhi"] == round(10000 * 5 / 9, 1)


def test_percentiles(spark):
    df = spark.createDataFrame([("g", float(x)) for x in (1, 2, 10, 40)] + [("h", None)], "k string, v double")
    assert distributions.spread(df, F.col("v"), ["k"]).filter("k = 'g'").first()["p95"] == 35.5
    assert distributions.nearest_rank(df, ["k"], "v").first()["value"] == 40.0
    many = spark.range(3000).select(F.when(F.col("id") < 2000, "a").when(F.col("id") < 2900, "b").alias("k"), F.round(F.exp(F.pmod(F.xxhash64("id"), F.lit(1000)) / 50), 3).alias("v"))
    for call in (lambda m: distributions.spread(many, F.col("v"), ["k"], 6, m), lambda m: distributions.spread(many, F.col("v"), None, 6, m), lambda m: distributions.nearest_rank(many, ["k"], "v", 0.95, m)):
        assert sorted(map(str, call(10**9).collect())) == sorted(map(str, call(0).collect()))
    assert distributions.rates(df, {"x": F.col("v") > 5}).first()["x"] == 40.0
    wide = spark.range(4000).select((F.col("id") % 2).alias("k"), F.when(F.col("id") < 1500, F.lit(7.0)).otherwise(F.exp((F.pmod(F.xxhash64("id"), F.lit(2000)) - 1000) / 3.0)).alias("v"))
    asked = {f"r{q}": F.floor((F.col("n") - 1) * q / 100) for q in (0, 3, 50, 97, 100)}
    tables = [sorted(map(str, distributions.order_statistics(wide, ["k"], asked, few).collect())) for few in (10**6, 40, 1)]
    assert tables[0] == tables[1] == tables[2] and len(tables[0]) == 10


@pytest.mark.parametrize("cap", [1, 12])
def test_fair_cap(spark, cap):
    rows = [("x", i) for i in range(50)] + [("y", 100 + i) for i in range(5)] + [("z", 200 + i) for i in range(5)]
    got = ranking.fair_cap(spark.createDataFrame(rows, "h string, o int"), "h", "o", cap).groupBy("h").count().collect()
    assert sorted(r["count"] for r in got) == ([4, 4, 4] if cap == 12 else [1])


def test_caps_and_numbers(spark):
    df = spark.range(1000).withColumn("g", F.when(F.col("id") < 700, 0).otherwise(F.col("id")))
    assert sorted(r["id"] for r in ranking.cap_per_group(df, ["g"], [F.col("id")], 5, slices=8).filter("g = 0").collect()) == [0, 1, 2, 3, 4]
    numbered = ranking.dense_numbers(df.repartition(7), ["id"]).collect()
    assert all(r["id"] == r["number"] for r in numbered)
    one, two = (sorted(r["id"] for r in ranking.stratified_sample(df, ["g"], "id", 3, s).filter("g = 0").collect()) for s in (1, 1))
    assert one == two and len(one) == 3
    assert one != sorted(r["id"] for r in ranking.stratified_sample(df, ["g"], "id", 3, 2).filter("g = 0").collect())


def test_sets(spark):
    df = spark.createDataFrame([(1, "a"), (2, "A "), (3, ""), (4, None), (5, "")], "i int, k string")
    assert sorted(r["i"] for r in sets.dedupe_keep_blank(df, F.lower(F.trim("k")), ["i"]).collect()) == [1, 3, 4, 5]
    old, new = spark.createDataFrame([("x", "1"), ("y", None), ("z", "1")], "k string, v string"), spark.createDataFrame([("x", "1"), ("y", "2"), ("w", "1")], "k string, v string")
    assert [tuple(r) for r in sets.changed_values(old, new, "k", "v").collect()] == [("y", None, "2")]
    assert {tuple(r) for r in sets.key_difference(old, new, "k").collect()} == {("x", "both"), ("y", "both"), ("z", "only_old"), ("w", "only_new")}
    assert [r["x"] for r in sets.explode_or_blank(df.limit(1), ["i"], F.array().cast("array<string>"), "x").collect()] == [""]
    assert sets.union_all([old, new.withColumn("u", F.lit(1))]).columns == ["k", "v", "u"]


def test_joins(spark):
    base = spark.createDataFrame([("k", 1), ("k", 2)], "k string, v int")
    out = joins.wide_export(base, "k", {"t": spark.createDataFrame([("k", 9), ("k", 8)], "k string, v int")})
    assert out.columns == ["k", "v", "v_t"] and out.count() == 4
    latest = joins.latest_per_key(spark.createDataFrame([("a", 1, 1, "x"), ("a", 1, 2, "y")], "k string, t int, i int, v string"), ["k"], "t", "i", ["v"]).first()
    assert latest["v"] == "y"
    hosts = spark.createDataFrame([("a.b.google.com",), ("notgoogle.com",)], "h string")
    assert [r["h"] for r in rules.match_domains(hosts, "h", spark.createDataFrame([("Google.com",)], "d string"), "d").collect()] == ["a.b.google.com"]


def test_best_class(spark):
    rows = [("h", 1, "altro_terzo_parte"), ("h", 2, "video"), ("h", 3, "social"), ("g", 1, "altro_terzo_parte"), ("g", 2, "altro_terzo_parte")]
    got = {r["h"]: r["c"] for r in rules.best_class(spark.createDataFrame(rows, "h string, p int, c string"), ["h"], "p", "c").collect()}
    assert got == {"h": "video", "g": "altro_terzo_parte"}


def test_risk(spark):
    df = spark.createDataFrame([(None, "none", None, None, "C"), ("2", "reject", True, "31", "A")], "n_ns_operators string, dmarc_policy string, dnssec boolean, tls_days_left string, tls_grade string")
    points, reasons = scoring.entity_risk(df)
    a, b = df.select(points.alias("p"), reasons.alias("r")).collect()
    assert (a["p"], b["p"], b["r"]) == (4, 0, "") and a["r"].startswith("nessuna ridondanza NS; DMARC")
    few = df.select("dnssec")
    assert few.select(scoring.entity_risk(few)[0].alias("p")).collect()[0]["p"] == 1


def test_verdicts(spark):
    rows = [
        ("a", "natura", "pubblico", 0.6, "stadio0", "x", 1), ("a", "tipo", "comune", 0.6, "stadio0", "y", 2), ("a", "tipo", "comune", 0.7, "stadio3", "z", 3),
        ("b", "natura", "infrastruttura", 0.95, "stadio0", "i", 1), ("b", "tipo", "comune", 0.5, "stadio3", "t", 2), ("c", "tipo", "scuola", 0.5, "stadio3", "", 1),
    ]
    v = {r["host"]: r for r in scoring.verdicts(spark.createDataFrame(rows, "host string, field string, value string, conf double, stage string, evidence string, ord int")).collect()}
    assert (v["a"]["tipo"], v["a"]["conf_tipo"], v["a"]["stages"], v["a"]["evidence"]) == ("comune", 0.88, "stadio0+stadio3", "stadio3:z || stadio0:x || stadio0:y")
    assert (v["b"]["tipo"], v["b"]["conf_tipo"]) == ("non_applicabile", 0.95)
    assert (v["c"]["natura"], v["c"]["conf_natura"], v["c"]["evidence"]) == ("non_classificabile", 0.0, None)


def test_index_renormalises(spark):
    df = spark.createDataFrame([(0.5, None), (0.5, 1.0), (None, None)], "a double, b double")
    rows = distributions.dependency_index(df, {"a": 0.35, "b": 0.65}).collect()
    assert [r["index"] for r in rows] == [50.0, 82.5, None] and rows[0]["used"] == "a"


def test_level_search(spark):
    edges = [("s", "a"), ("s", "b"), ("t", "b"), ("a", "c"), ("c", "d"), ("b", "s"), ("d", "e")]
    e = spark.createDataFrame([(x, y, y, i) for i, (x, y) in enumerate(edges)], "src string, dst string, dst_host string, ord int")
    seeds = spark.createDataFrame([("s", 0), ("t", 1)], "url string, ord int")
    got = {r["url"]: (r["level"], r["seed"]) for r in graph.level_search(e, seeds, 2).collect()}
    assert got == {"s": (0, "s"), "t": (0, "t"), "a": (1, "s"), "b": (1, "s"), "c": (2, "s")}
    allowed = spark.createDataFrame([("a",)], "url string")
    assert {r["url"] for r in graph.level_search(e, seeds, 3, allowed=allowed).collect()} == {"s", "t", "a"}
    assert {r["url"] for r in graph.level_search(e, seeds, 1, level_cap=1).collect()} == {"s", "t", "a"}
    order = [("a", "p", 5), ("b", "q", 1), ("p", "x", 0), ("q", "x", 0), ("q", None, 1)]
    two = graph.level_search(spark.createDataFrame([(x, y, y, o) for x, y, o in order], "src string, dst string, dst_host string, ord int"), spark.createDataFrame([("a", 0), ("b", 1), ("a", 9)], "url string, ord int"), 2)
    assert {tuple(r) for r in two.collect()} == {("a", 0, "a"), ("b", 0, "b"), ("p", 1, "a"), ("q", 1, "b"), ("x", 2, "a")}
    inside = spark.createDataFrame([("a.b.it", True), ("b.it", True), ("x.gov", True), ("no.b.it", False), ("c.it", False), (None, False), ("", False)], "h string, e boolean")
    assert inside.filter(graph.in_perimeter(F.col("h"), ["b.it"], ["gov"], ["no.b.it"]) != F.col("e")).isEmpty()


def queue_search(links, seeds, depth, cap=None, sig=None, cap_sig=None):
    """The search with a queue; links are (src, dst, host, ord)."""
    out = {}
    for u in seeds:
        out.setdefault(u, (0, u))
    queue, origin, counts = list(out), {u: u for u in out}, {}
    for level in range(1, depth + 1):
        upcoming = {}
        for page in queue:
            for _, dst, host, _ in sorted((x for x in links if x[0] == page), key=lambda x: (x[3], x[1])):
                if dst in out or dst in upcoming:
                    continue
                origin.setdefault(dst, origin[page])
                if cap_sig and counts.get(sig(dst), 0) >= cap_sig:
                    continue
                counts[sig(dst) if sig else dst] = counts.get(sig(dst) if sig else dst, 0) + 1
                upcoming[dst] = host
        queue = list(upcoming)
        if cap and len(queue) > cap:
            hosts = {}
            for u in queue:
                hosts.setdefault(upcoming[u], []).append(u)
            queue = [us[i] for i in range(len(queue)) for us in hosts.values() if i < len(us)][:cap]
        out |= {u: (level, origin[u]) for u in queue}
    return out


@pytest.mark.parametrize(("cap", "sig"), [(None, None), (7, None), (None, 3), (5, 2)])
def test_search_against_a_queue(spark, cap, sig):
    import random

    rng = random.Random(sum(map(ord, f"{cap}{sig}")))
    url = lambda n: f"https://h{n % 5}.it/{'abc'[n % 3]}/{n}"
    links = sorted({(url(rng.randrange(120)), url(rng.randrange(120)), None, i) for i in range(330)}, key=lambda x: x[3])
    links = [(s, d, d.split("/")[2], o) for s, d, _, o in links]
    seeds = [url(n) for n in (3, 50, 7)]
    e = spark.createDataFrame(links, "src string, dst string, dst_host string, ord int")
    got = graph.level_search(e, spark.createDataFrame(list(zip(seeds, range(3))), "url string, ord int"), 4, level_cap=cap, signature_cap=sig)
    template = lambda u: u.rsplit("/", 1)[0]
    assert {r["url"]: (r["level"], r["seed"]) for r in got.collect()} == queue_search(links, seeds, 4, cap, template, sig)


def test_pagination(spark):
    rows = [("t", 1, "x", 2), ("t", 2, "y", 1), ("t", 3, "y", 1), ("t", 4, "z", 1), ("t", 5, "w", 0), ("t", 6, "v", 0), ("t", 7, "u", 9), ("g", 1, "a", 1), ("g", 4, "b", 1), ("e", 1, "a", 0), ("e", 2, "b", None), ("e", 3, "c", 5), ("l", 2, "a", 1), ("l", 2, "a", 1), (None, 1, "a", 1)]
    got = graph.pagination_runs(spark.createDataFrame(rows, "t string, n int, d string, k int"), "t", "n", "d", "k")
    assert {tuple(r) for r in got.collect()} == {("t", 6, 6, 3), ("g", 1, 1, 1), ("e", 2, 2, 0), ("l", 1, 2, 1)}


def test_traps_and_signatures(spark):
    u = "https://x.example/"
    links = [("", "p/1"), ("", "p/2"), ("", "p/3"), ("", "aa/aa/aa"), ("", "q?id=1"), ("p/1", "p/4"), ("p/1", "q?id=2"), ("p/2", "q?id=3"), ("p/3", "r"), ("aa/aa/aa", "s")]
    e = spark.createDataFrame([(u + x, u + y, "x.example", i) for i, (x, y) in enumerate(links)], "src string, dst string, dst_host string, ord int")
    seeds = spark.createDataFrame([(u, 0)], "url string, ord int")
    reached = lambda **k: {r["url"].removeprefix(u) for r in graph.level_search(e, seeds, 2, **k).collect()}
    everything = {""} | {y for _, y in links}
    assert reached() == everything and reached(skip_traps=True) == everything - {"aa/aa/aa", "s"}
    assert reached(signature_cap=2) == everything - {"p/3", "p/4", "q?id=3", "r"}


def test_statuses_of_every_host(spark, tmp_path):
    rows = [
        ("a", 500, None), ("a", None, "tls:scaduto"), ("b", 404, None), ("c", None, None), ("d", None, "timeout"), ("d", None, "dns:nxdomain"), ("e", None, "dns:nxdomain"),
        ("e", 404, ""), ("f", 200, None), ("f", None, "timeout"), ("g", 403, None), ("g", None, "tls:scaduto"), ("h", 503, "timeout"), ("i", None, "altro"),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "riga_id long, hostname string, http_status_classificazione int, http_errore_classificazione string")
    df.write.parquet(f"{tmp_path}/{analytics.TYPES}.parquet")
    got = {r["hostname"]: r["status"] for r in details.mn8_best_status(spark, str(tmp_path)).collect()}
    assert got == {"a": "tls_error", "b": "http_error", "c": "no_answer", "d": "timeout", "e": "dns_error", "f": "ok", "g": "blocked", "h": "timeout", "i": "http_error"}
    assert details.mn7_homepage_status(spark, str(tmp_path)).count() == len(rows)


def test_robots(spark):
    rules_ = "User-agent: bot\nDisallow: /no\nCrawl-delay: 99\n\nUser-agent: *\nDisallow: /"
    rows = [("https://a.it/x", 200, None, rules_), ("https://a.it/no/1", 200, "", rules_), ("https://a.it/x", 503, None, rules_), ("https://a.it/x", 404, None, rules_), ("https://a.it/x", None, None, None), ("https://a.it/x", 200, "timeout", rules_), ("mailto:x", 200, None, rules_), (None, 200, None, None), ("https://a.it/x", 301, None, rules_), ("https://a.it/x", 200, None, "\x00<html>")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, url string, s int, e string, t string")
    got = [tuple(r)[1:3] for r in network.robots_decisions(df, "id", "url", "s", "e", "t", "bot", 30.0).orderBy("row_id").collect()]
    assert got == [(True, 30.0), (False, 30.0), (False, 0.0), (True, 0.0), (True, 0.0), (True, 0.0), (True, 0.0), (True, 0.0), (True, 0.0), (True, 0.0)]


PAGE = """<html lang="it"><head><title> Comune  di X </title><base href="https://x.example/d/"><meta name="description" content="desc"><meta property="og:site_name" content="Sito">
<script type="application/ld+json">{"@type":["City","Place"],"name":"X","address":{"@type":"PostalAddress"}}</script><link href="/s.css"><script src="https://cdn.terzi.example/a.js"></script></head>
<body><nav><a href="uffici">Uffici</a><a href="mailto:a@b">m</a></nav><h1>Titolo</h1><p>Testo<style>no</style></p><iframe src="//video.example/1"></iframe><img src="i.png"><footer>Note legali<a href="#x">y</a></footer>"""


def test_html(spark):
    df = spark.createDataFrame([(1, "https://x.example/", PAGE), (2, None, None), (3, "https://x.example/", "<a href='http://[bad'>")], "page_id long, url string, html string")
    refs = html.page_refs(df, "page_id", "url", "html")
    assert [(r["kind"], r["ref"]) for r in refs.orderBy("page_id", "ord").collect()] == [
        ("link_risorsa", "https://x.example/s.css"), ("script", "https://cdn.terzi.example/a.js"), ("link", "https://x.example/d/uffici"), ("iframe", "https://video.example/1"), ("img", "https://x.example/d/i.png"),
    ]
    own = spark.createDataFrame([(1, "www.x.example")], "page_id long, own string")
    assert [r["host"] for r in html.third_party_refs(refs, own).orderBy("rank").collect()] == ["cdn.terzi.example", "video.example"]
    e = html.page_evidence(df, "page_id", "url", "html").orderBy("page_id").first()
    assert (e["lang"], e["title"], e["description"], e["site_name"], e["h1"], e["nav"]) == ("it", "Comune di X", "desc", "Sito", ["Titolo"], ["Uffici", "m"])
    assert e["jsonld_types"] == ["City", "Place", "PostalAddress"] and e["jsonld_names"] == ["X"] and "no" not in e["body"].split() and "Note legali" in e["footer"]
    lists = spark.createDataFrame([(1, "<li class='x y'>A <a href='u'>b</a></li><li>C</li>")], "page_id long, html string")
    assert [(r["text"], r["href"]) for r in html.select_items(lists, "page_id", "html", "li", "x").collect()] == [("A b", "u")]


def test_rollups(spark):
    rows = [("h", "a.com", "x", "P", "US"), ("h", "a.com", "x", "P", "US"), ("h", "b.it", "y", "Q", "IT"), ("h", "c.org", "y", None, "")]
    r = rollups.third_party_by_host(spark.createDataFrame(rows, "h string, d string, c string, p string, y string"), "h", "d", "c", "p", "y").first()
    assert (r["n_third"], r["domains"], r["categories"], r["parents"], r["outside"], r["n_unknown"]) == (3, "a.com;b.it;c.org", "x;y", "P;Q", "a.com(US)", 1)
    ns = spark.createDataFrame([("h", 1, True, "m1"), ("h", 2, True, "m2"), ("h", 3, False, None)], "hostname string, ord int, reachable boolean, mx string")
    ends = spark.createDataFrame([("h", True, True, True, 10.0), ("h", True, False, False, 30.0), ("g", False, False, False, None)], "hostname string, tcp_ok boolean, tls_ok boolean, http_ok boolean, latency_ms double")
    got = {x["hostname"]: x for x in rollups.resilience_by_host(ns, ends).collect()}
    assert (got["h"]["ns_ratio"], got["h"]["mx_differ"], got["h"]["median_ms"], got["h"]["p95_ms"], got["h"]["score"]) == (0.6667, True, 20.0, 30.0, 0.5834)
    assert got["g"]["score"] == 0.0 and got["g"]["p95_ms"] is None
