"""Captured DNS, TLS, HTTP and routing facts as column expressions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.urls import is_ipv4
from lodestrata.operators.rules import first_match
from lodestrata.functions.cells import strip

#: Operator names, in order, and the jurisdiction they stand for.
JURISDICTIONS = [
    ("amazon", "USA (Amazon/AWS)"), ("aws", "USA (Amazon/AWS)"), ("microsoft", "USA (Microsoft/Azure)"), ("azure", "USA (Microsoft/Azure)"),
    ("google", "USA (Google)"), ("cloudflare", "USA (Cloudflare)"), ("oracle", "USA (Oracle Cloud)"), ("digitalocean", "USA (DigitalOcean)"),
    ("akamai", "USA (Akamai)"), ("linode", "USA (Akamai/Linode)"), ("meta platforms", "USA (Meta)"), ("ovh", "Francia (OVH)"),
    ("hetzner", "Germania (Hetzner)"), ("ionos", "Germania (IONOS)"), ("aruba", "Italia (Aruba)"), ("seeweb", "Italia (Seeweb)"),
    ("register.it", "Italia (Register.it)"), ("telecom italia", "Italia (TIM)"), ("tim s.p.a", "Italia (TIM)"), ("fastweb", "Italia (Fastweb)"),
    ("leaseweb", "Paesi Bassi (Leaseweb)"), ("hostinger", "Lituania (Hostinger)"),
]
#: Parts of error names and texts, in order, and their class.
ERROR_CLASSES = [
    ("ratelimit", "rate_limited"), ("rate_limit", "rate_limited"), ("too many requests", "rate_limited"), ("429", "rate_limited"),
    ("timeout", "timeout"), ("timed out", "timeout"), ("connectionrefused", "connessione_rifiutata"), ("connectionreset", "connessione_rifiutata"),
    ("connectionerror", "connessione_rifiutata"), ("connection refused", "connessione_rifiutata"), ("nxdomain", "dns_non_risolto"),
    ("noanswer", "dns_non_risolto"), ("nonameservers", "dns_non_risolto"), ("sslerror", "tls_fallito"), ("sslcertverificationerror", "tls_fallito"),
    ("handshake", "tls_fallito"), ("certificateerror", "tls_fallito"), ("ipdefinederror", "ip_non_pubblico"), ("asnregistryerror", "registro_asn_sconosciuto"),
    ("httplookuperror", "lookup_http_fallito"), ("403", "bloccato_http"), ("406", "bloccato_http"), ("503", "bloccato_http"), ("forbidden", "bloccato_http"),
]
#: Classes of errors after which a new try is worthwhile, and protocols that are weak.
RETRYABLE = ("rate_limited", "timeout", "connessione_rifiutata", "lookup_http_fallito")
WEAK_PROTOCOLS = ("SSLv2", "SSLv3", "TLSv1", "TLSv1.1", "TLS 1.0", "TLS 1.1")
#: Countries of the European Economic Area.
EEA = "AT BE BG HR CY CZ DK EE FI FR DE GR HU IE IT LV LT LU MT NL PL PT RO SK SI ES SE IS LI NO".split()


def _txt(record: Column) -> Column:
    return F.replace(F.regexp_replace(record, r'^"+|"+$', ""), F.lit('" "'), F.lit(""))


def spf_record(txt: Column) -> Column:
    """The first SPF record among TXT records, or null."""
    return F.try_element_at(F.filter(F.transform(txt, _txt), lambda t: F.lower(t).startswith("v=spf1")), F.lit(1))


def dmarc_policy(txt: Column) -> Column:
    """The policy of the first DMARC record: its last ``p=``; null without record or policy."""
    record = F.try_element_at(F.filter(F.transform(txt, _txt), lambda t: F.lower(t).startswith("v=dmarc1")), F.lit(1))
    tags = F.filter(F.transform(F.split(record, ";"), strip), lambda p: F.lower(p).startswith("p="))
    return F.regexp_replace(F.try_element_at(tags, F.lit(-1)), "^[pP]=", "")


def mail_hosts(mx: Column) -> Column:
    """Hosts of MX answers such as ``10 mail.example.``, null MX left out, by preference."""
    parsed = F.transform(mx, lambda m: F.struct(F.regexp_extract(m, r"^(\d+)", 1).try_cast("int").alias("n"), F.rtrim(F.lower(F.regexp_extract(m, r"^\d+\s+(\S*)\z", 1)), F.lit(".")).alias("h")))
    return F.transform(F.filter(F.array_sort(parsed), lambda p: p["h"] != ""), lambda p: p["h"])


def ip_block(ip: Column) -> Column:
    """The /24 of an IPv4 address, the /48 of a full or compressed IPv6 one; null for anything else."""
    groups = F.split(F.split_part(F.lower(ip), F.lit("::"), F.lit(1)), ":")
    filled = F.slice(F.concat(F.filter(groups, lambda g: g != ""), F.array_repeat(F.lit("0"), 3)), 1, 3)
    short = F.array_join(F.transform(filled, lambda g: F.coalesce(F.nullif(F.ltrim(g, F.lit("0")), F.lit("")), F.lit("0"))), ":")
    v6 = F.concat(F.regexp_replace(short, r"(?::0)+\z", ""), F.lit("::/48"))
    return F.when(is_ipv4(ip), F.concat(F.substring_index(ip, ".", 3), F.lit(".0/24"))).when(F.lower(ip).rlike(r"^[0-9a-f:]*:[0-9a-f:]*\z"), v6)


def bulk_asn_fields(line: Column) -> Column:
    """``asn``, ``ip``, ``country``, ``name`` of a pipe-delimited answer line; null for headers and unknown ones."""
    p = F.transform(F.split(line, r"\|"), strip)
    at = lambda i: F.try_element_at(p, F.lit(i))
    good = (F.size(p) >= 5) & at(1).rlike(r"^\d+\z")
    return F.when(good, F.struct(at(1).alias("asn"), at(2).alias("ip"), at(4).alias("country"), F.try_element_at(p, F.lit(-1)).alias("name")))


def org_label(name: Column, country: Column) -> Column:
    """The operator's name with its country, unless the name has it already."""
    n, c = strip(F.coalesce(name, F.lit(""))), strip(F.coalesce(country, F.lit("")))
    return F.when((n == "") | (c == "") | F.upper(n).contains(F.upper(c)), n).otherwise(F.concat(n, F.lit(" ("), c, F.lit(")")))


def holder_country(holder: Column) -> Column:
    return F.regexp_extract(strip(F.coalesce(holder, F.lit(""))), r",\s*([A-Z]{2})\z", 1)


def jurisdiction(org: Column, country: Column) -> Column:
    """By the first operator name found in ``org``; else the network's country, marked as such; else ''."""
    known = first_match(F.lower(F.coalesce(org, F.lit(""))), JURISDICTIONS)
    other = F.when(F.coalesce(country, F.lit("")) != "", F.concat(F.lit("(non riconosciuto; Paese ASN: "), country, F.lit(")")))
    return F.coalesce(known, other, F.lit(""))


def macro_area(label: Column) -> Column:
    unknown = F.regexp_extract(label, r"Paese ASN:\s*([A-Z]{2})", 1)
    area = strip(F.regexp_extract(label, r"^([^(]+)\s*\(", 1))
    return F.when(unknown != "", F.concat(F.lit("Non riconosciuto ("), unknown, F.lit(")"))).when(area != "", area).otherwise(strip(label))


def tls_grade(protocols: Column, bits: Column, hsts: Column) -> Column:
    """D with a weak protocol, C with a short key, B without HSTS, else A; '' without data."""
    weak = F.arrays_overlap(protocols, F.array(*[F.lit(p) for p in WEAK_PROTOCOLS]))
    return (
        F.when(protocols.isNull() | bits.isNull(), F.lit("")).when(weak, F.lit("D")).when(bits < 128, F.lit("C"))
        .when(~F.coalesce(hsts, F.lit(False)), F.lit("B")).otherwise(F.lit("A"))
    )


def cdns(headers: Column) -> Column:
    """Every delivery network that the lower-cased response headers (a map) give away, in a fixed order."""
    h = lambda k: F.coalesce(F.lower(F.try_element_at(headers, F.lit(k))), F.lit(""))
    has = lambda k: F.coalesce(F.map_contains_key(headers, k), F.lit(False))
    tests = (
        ("Cloudflare", has("cf-ray") | h("server").contains("cloudflare")),
        ("Akamai", h("server").contains("akamai") | has("x-akamai-transformed")),
        ("Amazon CloudFront", has("x-amz-cf-id") | h("via").contains("cloudfront")),
        ("Fastly", has("x-fastly-request-id") | h("via").contains("fastly") | h("x-served-by").contains("cache-")),
        ("Google Frontend", h("server").isin("gws", "esf", "sffe", "gse")),
        ("Varnish (generico)", h("via").contains("varnish")),
        ("Sucuri", has("x-sucuri-id")),
        ("Imperva/Incapsula", has("x-iinfo") | h("x-cdn").contains("incapsula")),
    )
    return F.array_compact(F.array(*[F.when(t, F.lit(n)) for n, t in tests]))


def days_left(not_after: Column, as_of: Column) -> Column:
    return F.floor((F.unix_timestamp(not_after) - F.unix_timestamp(as_of)) / 86400)


def error_class(name: Column, detail: Column) -> Column:
    text = F.lower(F.concat(F.coalesce(name, F.lit("")), F.lit(" "), F.coalesce(detail, F.lit(""))))
    return F.coalesce(first_match(text, ERROR_CLASSES), F.lit("sconosciuto"))


def retry_worthwhile(klass: Column) -> Column:
    return klass.isin(*RETRYABLE)


def expired(stamp: Column, as_of: Column, days: int) -> Column:
    """Whether a time stamp is missing or older than ``days``."""
    return stamp.isNull() | (stamp < as_of - F.make_interval(days=F.lit(days)))


def outside_eea(country: Column) -> Column:
    """Known and not in the area; an unknown country is neither in nor out."""
    c = F.upper(strip(F.coalesce(country, F.lit(""))))
    return (c != "") & ~c.isin(*EEA)


def page_status(error: Column, status: Column) -> Column:
    """One word for how a page fetch went; an error is a class known by name, or led by the layer that failed (``dns:``, ``tls:``)."""
    k = error_class(error, F.lit(""))
    layer = F.lower(F.regexp_extract(error, r"(?i)^\s*(dns|tls):", 1))
    return (
        F.when(F.coalesce(error, F.lit("")) == "", F.when(status.isNull(), "no_answer").when(status < 400, "ok").when(status.isin(401, 403, 406, 429), "blocked").otherwise("http_error"))
        .when(k == "timeout", "timeout").when((k == "dns_non_risolto") | (layer == "dns"), "dns_error").when((k == "tls_fallito") | (layer == "tls"), "tls_error").otherwise("http_error")
    )


STATUS_PRIORITY = ("ok", "blocked", "tls_error", "timeout", "dns_error", "http_error", "no_answer")


_ROBOTS = "row_id bigint, allowed boolean, delay double, note string"


def robots_decisions(df: DataFrame, id_col: str, url_col: str, status_col: str, error_col: str, text_col: str, agent: str, max_delay: float = 60.0) -> DataFrame:
    """``row_id``, ``allowed``, ``delay``, ``note`` of every URL, by its site's captured robots answer: no answer, an error of
    the network and anything but 2xx and 5xx allow, 5xx forbids, 2xx goes by the rules for ``agent``, whose delay is kept
    within 0 and ``max_delay``; rules that can't be read, and URLs that aren't http(s), allow."""
    from functools import lru_cache
    from urllib.parse import urlsplit
    from urllib.robotparser import RobotFileParser

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        @lru_cache(maxsize=10_000)
        def rules(text: str) -> RobotFileParser:
            parser = RobotFileParser()
            parser.parse(text.splitlines())
            return parser

        def decide(url: str | None, status: float, error: str | None, text: str | None) -> tuple[bool, float, str]:
            try:
                parts = urlsplit(url or "")
            except ValueError:
                return True, 0.0, ""
            if parts.scheme not in ("http", "https") or not parts.netloc:
                return True, 0.0, ""
            if error or pd.isna(status):
                return True, 0.0, "unreachable"
            if 500 <= status < 600:
                return False, 0.0, "server error"
            if not 200 <= status < 300:
                return True, 0.0, "none"
            try:
                parser = rules(text or "")
                allowed, delay = parser.can_fetch(agent, url), float(parser.crawl_delay(agent) or 0.0)
            except ValueError:
                return True, 0.0, ""
            return allowed, min(max(delay, 0.0), max_delay), "" if allowed else "forbidden"

        for b in batches:
            rows = [(i, *decide(u, s, e, t)) for i, u, s, e, t in zip(b["row_id"], b["url"], b["status"], b["error"], b["text"], strict=True)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _ROBOTS.split(", ")])

    src = df.select(df[id_col].cast("bigint").alias("row_id"), df[url_col].alias("url"), df[status_col].cast("double").alias("status"), df[error_col].alias("error"), df[text_col].alias("text"))
    return src.mapInPandas(run, _ROBOTS)
