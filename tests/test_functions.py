"""Literal cases of the column functions."""

import pytest
from pyspark.sql import functions as F

from lodestrata.functions import bands, network, pages, text, urls
from lodestrata.operators import rules, scoring


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("url", "host"),
    [
        ("https://user:pw@host.example.be:8080/x", "host.example.be"), ("http://[bad-ipv6/x", ""), ("HTTP://Example.BE./p", "example.be"), ("http://[2001:db8::1]/x", "2001:db8::1"), ("no url", ""), (None, ""),
    ],
)
def test_host_of(spark, url, host):
    assert value(spark, urls.host_of(F.lit(url).cast("string"))) == host


def test_canonical(spark):
    six = ["https://www.example.be/p", "https://www.example.be/p/", "HTTPS://WWW.example.be/p#a", "https://www.example.be:443/p?utm_source=x", "https://www.example.be//p", "https://www.example.be/p;jsessionid=1?fbclid=2"]
    assert {value(spark, urls.canonical_url(F.lit(u))) for u in six} == {"https://www.example.be/p"}
    assert value(spark, urls.canonical_url(F.lit("http://a.example/?b=2&a=1"))) == "http://a.example/?a=1&b=2"
    assert value(spark, urls.canonical_url(F.lit("http://a.example:8080"))) == "http://a.example:8080/"
    assert value(spark, urls.canonical_url(F.lit("mailto:x@y.z"))) == "mailto:x@y.z"


@pytest.mark.parametrize(
    ("host", "tlds", "expected"),
    [("de.wikipedia.org", ["de", "gov"], False), ("revenue.gov.ie", ["ie", "gov"], True), ("gov.pl", ["gov"], True), ("evil.gov.com", ["be", "gov"], False), ("x.be", ["be"], True), ("", ["be"], False)],
)
def test_tld(spark, host, tlds, expected):
    assert value(spark, urls.tld_matches(F.lit(host), tlds)) is expected


def test_traps_and_signatures(spark):
    assert value(spark, urls.looks_like_trap(F.lit("https://a.example/" + "x" * 2100)))
    assert value(spark, urls.looks_like_trap(F.lit("https://a.example/a/b/a/b/a/b/a/b")))
    assert not value(spark, urls.looks_like_trap(F.lit("https://a.example/a/b")))
    one, two = (value(spark, urls.url_signature(F.lit(f"https://a.example/cal/2026/{m}/03?month={m}"))) for m in (10, 11))
    assert one == two == "a.example/cal/#/#/#?month"


@pytest.mark.parametrize(
    ("cell", "expected"),
    [
        ("www.y.es; www.z.es", ["https://www.y.es", "https://www.z.es"]), ("nan", []), ("info@y.es", []), ("testo libero", []), (None, []), ("http://www.X.es/ HTTPS://x.es", ["http://www.x.es", "https://x.es"]),
        ("https://a.example/p/?q=1", ["https://a.example/p?q=1"]),
    ],
)
def test_url_values(spark, cell, expected):
    assert value(spark, urls.normalize_url_values(F.lit(cell).cast("string"))) == expected


def test_dedupe_key(spark):
    keys = {value(spark, urls.dedupe_key(F.lit(u))) for u in ("http://www.X.es/", "HTTPS://x.es")}
    assert keys == {"x.es"} and value(spark, urls.dedupe_key(F.lit("nan"))) == "nan"


def test_hosts_and_domains(spark):
    assert value(spark, urls.second_level(F.lit("single"))) == "single"
    assert value(spark, urls.root_domain(F.lit("a.b.gov.uk"))) == "b.gov.uk"
    roots = {"www.comune.x.gov.it": "x.gov.it", "a.asso.fr": "a.asso.fr", "gob.es": "", "x.com.example": "com.example", "a.b.example": "b.example", "10.0.0.1": "", "x": "", "A.B.Or.At.": "b.or.at"}
    assert {h: value(spark, urls.root_domain(F.lit(h))) for h in roots} == roots
    assert value(spark, urls.root_domain(F.lit("10.0.0.1"))) == ""
    assert value(spark, urls.is_infrastructure(F.lit("www.google.de"))) and not value(spark, urls.is_infrastructure(F.lit("comune.it")))
    assert value(spark, urls.clean_hostname(F.lit("http://A.example:80/x"))) == "a.example" and value(spark, urls.clean_hostname(F.lit("a b"))) is None
    assert value(spark, urls.punycode(F.lit("münchen.de"))) == "xn--mnchen-3ya.de"
    assert [value(spark, urls.ip_version(F.lit(h))) for h in ("::1", "1.2.3.4", "x")] == [6, 4, 0]
    assert value(spark, urls.redirect_target(F.lit("https://d.example/l/?uddg=https%3A%2F%2Fa.example%2F&x=1"))) == "https://a.example/"
    assert value(spark, urls.pagination_template(F.lit("https://a.example/n?page=3"))) == "https://a.example/n?page={}"
    assert len(value(spark, urls.site_variants(F.lit("www.a.example")))) == 8
    assert value(spark, urls.registry_url(F.lit("www.a.example"))) == "http://a.example"
    assert value(spark, urls.is_file_url(F.lit("https://a.example/x.PDF?a=1")))


def test_text(spark):
    assert [value(spark, text.cell_text(F.lit(x).cast("double"))) for x in (12345.0, 12.5, None)] == ["12345", "12.5", None]
    assert value(spark, text.fold(F.lit("Città  d'Ávila – Δήμος"))) == "citta d avila δημος"
    assert value(spark, text.primary_lang(F.lit("nl-NL"))) == "nl"
    rx = text.stems_pattern(["comune di", "sindaco!"])
    assert sorted(value(spark, text.distinct_matches(rx, F.lit("il comune di x e i sindaco sindacone comune  di")))) == ["comune  di", "comune di", "sindaco"]
    assert value(spark, text.name_match(F.lit("Ayuntamiento de Sevilla"), F.lit("www.sevilla.org"))) == 1.0
    assert value(spark, text.name_match(F.lit("Ayuntamiento de Sevilla"), F.lit("www.madrid.es"))) == 0.0
    assert value(spark, text.name_match(F.lit("Comune"), F.lit("x"))) == 1.0
    assert [value(spark, text.department_code(F.lit(c))) for c in ("75056", "97411")] == ["75", "974"]


def test_network(spark):
    txt = F.array(F.lit('"v=DMARC1; p=none; P=reject"'), F.lit("v=spf1 -all"))
    assert value(spark, network.dmarc_policy(txt)) == "reject" and value(spark, network.spf_record(txt)) == "v=spf1 -all"
    assert value(spark, network.mail_hosts(F.array(F.lit("20 B.example."), F.lit("10 a.example."), F.lit("0 .")))) == ["a.example", "b.example"]
    assert [value(spark, network.ip_block(F.lit(i))) for i in ("192.0.2.7", "2001:db8:0:1::5", "x")] == ["192.0.2.0/24", "2001:db8::/48", None]
    assert value(spark, network.bulk_asn_fields(F.lit("15169 | 8.8.8.8 | 8.8.8.0/24 | US | GOOGLE, US")))["name"] == "GOOGLE, US"
    assert value(spark, network.org_label(F.lit("GOOGLE, US"), F.lit("US"))) == "GOOGLE, US" and value(spark, network.org_label(F.lit("ACME"), F.lit("IT"))) == "ACME (IT)"
    assert value(spark, network.jurisdiction(F.lit("Amazon.com"), F.lit("IT"))) == "USA (Amazon/AWS)" and value(spark, network.jurisdiction(F.lit("x"), F.lit(""))) == ""
    assert value(spark, network.macro_area(F.lit("(non riconosciuto; Paese ASN: XX)"))) == "Non riconosciuto (XX)" and value(spark, network.macro_area(F.lit("Italia (Aruba)"))) == "Italia"
    grade = lambda p, b, h: value(spark, network.tls_grade(F.array(*[F.lit(x) for x in p]), F.lit(b), F.lit(h)))
    assert [grade(["TLSv1", "TLSv1.2"], 256, True), grade(["TLSv1.2"], 56, True), grade(["TLSv1.2"], 128, False), grade(["TLSv1.3"], 256, True)] == ["D", "C", "B", "A"]
    headers = F.create_map(F.lit("cf-ray"), F.lit("1"), F.lit("via"), F.lit("varnish"))
    assert value(spark, network.cdns(headers)) == ["Cloudflare", "Varnish (generico)"]
    assert value(spark, network.error_class(F.lit("Timeout"), F.lit("HTTP 429"))) == "rate_limited"
    assert [value(spark, network.outside_eea(F.lit(c))) for c in ("US", "IT", "")] == [True, False, False]


def test_pages(spark):
    state = lambda h: dict(zip(("title", "n_text", "n_links", "challenge", "shell", "parked", "default"), pages.state_of(h), strict=True))
    assert state("<title>Just a moment...</title>")["challenge"] == "title" and state("<p>captcha</p>")["challenge"] == "captcha" and state("x" * 7000 + "captcha")["challenge"] is None
    assert state("<p>Request unsuccessful. Incapsula incident</p>")["challenge"] == "mark" and state(None)["challenge"] is None
    assert state('<div id="root"></div>')["shell"] and state("<noscript>Please enable JavaScript</noscript>")["shell"] and state("<script>window.__NUXT__={}</script>")["shell"]
    assert not state('<div id="root">' + "word " * 60 + "</div>")["shell"] and not state('<div id="root"></div>' + "<a href='x'>y</a>" * 10)["shell"]
    assert state("Dieses Domain steht zum Verkauf")["parked"] and state("see dan.com/buy now")["parked"] and state("Welcome to nginx")["default"]
    assert not state("coming soon " + "word " * 400)["default"] and state("<p>a <script>x</script> b</p>")["n_text"] == 3 and state("<b>a</b><i>b</i>&amp;")["n_text"] == 5
    df = spark.createDataFrame([(1, None), (2, ""), (3, "<p>" * 5000 + "x" * 200_000)], "i int, h string")
    assert [(r["page_id"], r["n_text"]) for r in pages.page_states(df, "i", "h").orderBy("page_id").collect()] == [(1, 0), (2, 0), (3, 200_000)]
    assert value(spark, pages.probably_blocked(F.lit(403), F.lit("x"))) and not value(spark, pages.probably_blocked(F.lit(200), F.lit("x")))
    assert value(spark, pages.sitemap_urls(F.lit("<loc> a </loc><loc>b</loc>"))) == ["a", "b"]


def test_bands_and_rules(spark):
    assert [value(spark, bands.hhi_band(F.lit(x))) for x in (1499.9, 1500.0, 2500.0)] == ["non concentrato", "moderatamente concentrato", "altamente concentrato"]
    assert value(spark, rules.third_party(F.lit("https://cdn.x.example/a.js")))["vendor"] == "cdn.x.example"
    assert value(spark, rules.third_party(F.lit("https://www.google-analytics.com/a.js")))["parent"] == "Google"
    assert [value(spark, rules.cookie_class(F.lit(c))) for c in ("_ga", "_ga_x", "xfr", "PHPSESSID")] == ["profilazione", "sconosciuto", "sconosciuto", "tecnico"]
    one = spark.createDataFrame([(1, "Comune", "comune scuola"), (2, None, None), (3, "", "b a")], "i int, h string, b string")
    scores = rules.keyword_scores(one, ["i"], F.col("h"), F.col("b"), {"comune": ["comune"], "scuola": ["scuola"], "x": ["zz"]})
    assert [tuple(r) for r in scores.orderBy("i").collect()] == [(1, 3, 1, 0), (2, 0, 0, 0), (3, 0, 0, 0)]
    assert [r[0] for r in scores.orderBy("i").select(rules.top_category(["x", "comune", "scuola"])).collect()] == ["comune", None, None]
    ties = spark.createDataFrame([(2, 2)], "b int, a int")
    assert ties.select(rules.top_category(["b", "a"])).first()[0] == "b"
    pages_ = spark.createDataFrame([(1, "<meta name='generator' content='WordPress 6.1'> wp-includes", "nginx/1.2", None), (2, None, "Apache", "PHP/8.1 ASP.NET"), (3, "", None, None)], "i int, h string, s string, p string")
    found = rules.software_found(pages_, ["i"], "h", "s", "p")
    assert {(r["i"], r["software"], r["version"]) for r in found.collect()} == {(1, "WordPress", ""), (1, "nginx", "1.2"), (2, "Apache HTTP Server", ""), (2, "PHP", "8.1"), (2, "ASP.NET", "")}
    both = spark.createDataFrame([(1, "wp-content <meta content='WordPress 6.1'>")], "i int, h string")
    assert [r["version"] for r in rules.software_found(both, ["i"], "h").collect()] == ["6.1"]
    assert rules.vendors_of([{"pattern": "X.y", "categoria": "c", "vendor": "v"}])[0] == rules.Vendor("x.y", "c", "v") and rules.software_of([{"pattern": "P", "fonte": "html", "software": "s", "categoria": "c", "licenza": "l"}])[0].open_source is None
    hosts = spark.createDataFrame([(1, "a.b.it"), (2, "b.it."), (3, "it"), (4, ""), (5, None)], "i int, h string")
    listed = spark.createDataFrame([("b.it",), ("C.a.b.it",)], "d string")
    assert {(r["i"], r["d"]) for r in rules.match_either_way(hosts, "h", listed, "d", "i").collect()} == {(1, "b.it"), (2, "b.it"), (1, "C.a.b.it"), (2, "C.a.b.it"), (3, "b.it"), (3, "C.a.b.it")}
    assert value(spark, rules.longest_keyword(F.lit("primary school district"), {"school": "s", "school district": "d"})) == "d"


def test_host_votes(spark):
    votes = lambda h: {(v["field"], v["value"]) for v in value(spark, scoring.host_votes(F.lit(h)))}
    assert votes("www.google.de") == {("natura", "infrastruttura")}
    assert ("natura", "pubblico") in votes("sede.gob.es")
    assert votes("gemeente-utrecht.nl") == {("tipo", "comune"), ("natura", "pubblico")}
    assert ("tipo", "comune") not in votes("stadtwerke-x.de") and ("natura", "pubblico") not in votes("school-supplies-shop.com")


def test_noisy_or(spark):
    rows = [("a", "comune", 0.6, 1), ("a", "comune", 0.7, 2), ("b", "scuola", 0.7, 1), ("b", "sanita", 0.65, 2), ("c", "x", 1.0, 1)]
    out = {r["h"]: r for r in scoring.noisy_or(spark.createDataFrame(rows, "h string, v string, c double, o int"), ["h"], "v", "c", "o").collect()}
    assert out["a"]["conf"] == 0.88 and not out["a"]["conflict"]
    assert out["b"]["conflict"] and out["b"]["conf"] < 0.5 and out["b"]["v"] == "scuola"
    assert out["c"]["conf"] == 0.99
