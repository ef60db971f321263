"""URLs and hosts as column expressions; everything stays inside code generation but ``punycode`` and ``ip_version``."""

from __future__ import annotations

import ipaddress

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType
from lodestrata.functions.cells import strip

#: Cells that say "no value".
NULL_TOKENS = ("", "nan", "none", "null", "n/a", "na", "n/d", "nd", "-", "--", "—", "?", "#n/a", "non disponibile", "non disponible", "geen", "keine", "ninguno", "nincs")
#: Query parameters of sessions and tracking, whole names and prefixes.
TRACKING = (
    "fbclid gclid dclid msclkid yclid mc_cid mc_eid _ga _gl igshid ref_src sessionid session_id sid phpsessid jsessionid cfid cftoken aspsessionid sessid"
).split()
TRACKING_PREFIX = ("utm_", "mtm_", "pk_", "hsa_", "vero_")
#: Labels that registries of countries put before their own to register names under.
REGISTRY_LABELS = "ac asso co com edu gob gouv gov gub gv mil muni net nom or org sch".split()
#: Second levels under which registries register names, besides those labels under a country's TLD.
PUBLIC_SUFFIXES = ("co.uk", "gov.uk", "org.uk", "ac.uk", "gov.it", "edu.it", "gouv.fr", "asso.fr", "gob.es", "com.es", "org.es", "gov.pt", "com.pt", "gov.pl", "com.pl", "org.pl", "edu.pl", "gov.gr", "com.gr", "gov.ie", "com.ro", "gov.ro", "co.at", "gv.at", "or.at")
#: Domains that are infrastructure under any page, by suffix, and root labels that are so under any TLD.
INFRASTRUCTURE = (
    # software
    "adobe.com acrobat.com microsoft.com office.com live.com microsoftonline.com apple.com mozilla.org mozilla.com oracle.com java.com zoom.us skype.com dropbox.com slack.com atlassian.net "
    "github.com gitlab.com sourceforge.net "
    # standards and site software
    "w3.org wordpress.org wordpress.com wp.com joomla.org drupal.org typo3.org creativecommons.org schema.org whatwg.org opensource.org "
    # stores and messages
    "whatsapp.com telegram.org telegram.me signal.org play.google.com apps.apple.com itunes.apple.com "
    # delivery and widgets
    "cloudflare.com cloudfront.net akamaihd.net akamaized.net fastly.net googleapis.com gstatic.com googleusercontent.com googletagmanager.com google-analytics.com doubleclick.net recaptcha.net "
    "addthis.com sharethis.com addtoany.com disqus.com gravatar.com fontawesome.com jsdelivr.net unpkg.com bootstrapcdn.com jquery.com hotjar.com matomo.cloud statcounter.com "
    "vimeo.com soundcloud.com spotify.com issuu.com scribd.com slideshare.net flickr.com giphy.com imgur.com bing.com yahoo.com duckduckgo.com openstreetmap.org maps.app.goo.gl "
    # social
    "facebook.com fb.com instagram.com twitter.com x.com linkedin.com youtube.com tiktok.com pinterest.com reddit.com tumblr.com xing.com snapchat.com threads.net mastodon.social bsky.app "
    "bsky.social twitch.tv medium.com wikipedia.org wikimedia.org wikidata.org archive.org "
    # short links
    "bit.ly t.co goo.gl tinyurl.com ow.ly is.gd buff.ly lnkd.in cutt.ly rebrand.ly rb.gy shorturl.at t.ly s.id tiny.cc youtu.be fb.me wa.me t.me amzn.to linktr.ee lnk.bio smarturl.it"
).split()
INFRASTRUCTURE_LABELS = "google facebook youtube twitter instagram linkedin microsoft apple whatsapp tiktok cloudflare amazonaws".split()
#: File endings that are no pages.
FILE_ENDINGS = "pdf doc docx xls xlsx ppt pptx odt ods zip rar gz 7z tar jpg jpeg png gif svg webp ico bmp tif tiff mp3 mp4 avi mov wmv wav ogg webm css js json xml rss ics csv txt exe dmg apk".split()

_SCHEME, _AUTH = r"^[A-Za-z][A-Za-z0-9+.-]*://", r"(?:[^/?#@]*@)?"


def _nz(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def null_token(value: Column) -> Column:
    """Whether a cell says "no value"."""
    return F.lower(strip(_nz(value))).isin(*NULL_TOKENS)


def host_of(url: Column) -> Column:
    """The URL's host, lower-cased, without user, port and final dot; '' where there is none or it is malformed."""
    raw = F.regexp_extract(strip(_nz(url)), _SCHEME + _AUTH + r"(\[[^\]/?#]*\]|[^/?#:]*)", 1)
    bare = F.rtrim(F.lower(raw), F.lit("."))
    v6 = F.regexp_extract(bare, r"^\[([0-9a-f:.]+)\]\z", 1)
    return F.when(bare.startswith("["), v6).when(bare.contains("["), F.lit("")).otherwise(bare)


@F.pandas_udf(StringType())
def punycode(hosts: pd.Series) -> pd.Series:
    """Hosts with international labels in punycode; where that fails, as they are. Use over distinct hosts."""

    def one(h: str | None) -> str | None:
        try:
            return h if h is None or h.isascii() else h.encode("idna").decode("ascii")
        except (UnicodeError, ValueError):
            return h

    return hosts.map(one)


@F.pandas_udf(IntegerType())
def ip_version(hosts: pd.Series) -> pd.Series:
    """4 or 6 for an IP literal, else 0. Use over distinct hosts."""

    def one(h: str | None) -> int:
        try:
            return ipaddress.ip_address((h or "").strip("[]")).version
        except ValueError:
            return 0

    return hosts.map(one)


def is_ipv4(host: Column) -> Column:
    octet = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
    return _nz(host).rlike(rf"^{octet}(?:\.{octet}){{3}}\z")


def labels(host: Column) -> Column:
    return F.split(_nz(host), r"\.")


def second_level(host: Column) -> Column:
    """The last two labels; one label as it is."""
    parts = F.split(F.rtrim(F.lower(strip(_nz(host))), F.lit(".")), r"\.")
    return F.when(F.size(parts) >= 2, F.array_join(F.slice(parts, -2, 2), ".")).otherwise(F.array_join(parts, "."))


def root_domain(host: Column, suffixes: tuple[str, ...] = PUBLIC_SUFFIXES) -> Column:
    """The registrable domain: a name below a public suffix, which is a listed one or a registry's label under a TLD of two
    letters; '' for IP literals, single labels and suffixes. A longer list can be given."""
    h = F.rtrim(F.lower(strip(_nz(host))), F.lit("."))
    parts = F.split(h, r"\.")
    two = F.array_join(F.slice(parts, -2, 2), ".")
    three = F.array_join(F.slice(parts, -3, 3), ".")
    return (
        F.when((F.size(parts) < 2) | is_ipv4(h) | h.contains(":"), F.lit(""))
        .when(two.isin(*suffixes) | two.rlike("^(?:" + "|".join(REGISTRY_LABELS) + r")\.[a-z]{2}\z"), F.when(F.size(parts) >= 3, three).otherwise(F.lit("")))
        .otherwise(two)
    )


def _parts(url: Column) -> tuple[Column, Column, Column, Column]:
    u = strip(_nz(url))
    scheme = F.lower(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    port = F.regexp_extract(u, _SCHEME + _AUTH + r"(?:\[[^\]/?#]*\]|[^/?#:]*):(\d+)", 1)
    path = F.regexp_extract(u, _SCHEME + r"[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1)
    return scheme, port, path, query


def _with_port(scheme: Column, host: Column, port: Column) -> Column:
    plain = (port == "") | ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443"))
    shown = F.when(host.contains(":"), F.concat(F.lit("["), host, F.lit("]"))).otherwise(host)
    return F.when(plain, shown).otherwise(F.concat(shown, F.lit(":"), port))


def clean_query(query: Column) -> Column:
    """The query's pairs without tracking, sorted and encoded anew."""
    pairs = F.transform(
        F.filter(F.split(query, "&"), lambda p: p != ""),
        lambda p: F.struct(
            F.coalesce(F.try_url_decode(F.split_part(p, F.lit("="), F.lit(1))), F.split_part(p, F.lit("="), F.lit(1))).alias("k"),
            F.coalesce(F.try_url_decode(F.regexp_extract(p, r"^[^=]*=(.*)\z", 1)), F.regexp_extract(p, r"^[^=]*=(.*)\z", 1)).alias("v"),
        ),
    )
    low = lambda p: F.lower(p["k"])
    kept = F.filter(pairs, lambda p: ~low(p).isin(*TRACKING) & ~low(p).rlike("^(?:" + "|".join(TRACKING_PREFIX) + ")"))
    enc = lambda c: F.replace(F.replace(F.url_encode(c), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))
    return F.array_join(F.transform(F.array_sort(kept), lambda p: F.concat(enc(p["k"]), F.lit("="), enc(p["v"]))), "&")


def canonical_url(url: Column) -> Column:
    """One spelling per page: host lower-cased, no default port, path parameters, doubled or final slashes, tracking or
    fragment, query sorted; anything that is no http(s) URL stays as it is."""
    scheme, port, path, query = _parts(url)
    host = host_of(url)
    p = F.regexp_replace(F.regexp_replace(path, r";[^/]*", ""), r"/{2,}", "/")
    p = F.when(F.length(p) > 1, F.regexp_replace(p, r"/+\z", "")).otherwise(F.lit("/"))
    p = F.when(p == "", F.lit("/")).otherwise(p)
    q = clean_query(query)
    made = F.concat(scheme, F.lit("://"), _with_port(scheme, host, port), p, F.when(q != "", F.concat(F.lit("?"), q)).otherwise(F.lit("")))
    return F.when(scheme.isin("http", "https") & (host != ""), made).otherwise(url)


def url_signature(url: Column) -> Column:
    """Host, path with numbers as ``#``, and the query's sorted keys: pages of one template share it."""
    _, _, path, query = _parts(url)
    keys = F.transform(F.filter(F.split(query, "&"), lambda p: p != ""), lambda p: F.lower(F.split_part(p, F.lit("="), F.lit(1))))
    shown = F.when(path == "", F.lit("/")).otherwise(path)
    return F.concat(host_of(url), F.regexp_replace(shown, r"\d+", "#"), F.lit("?"), F.array_join(F.array_sort(F.array_distinct(keys)), ","))


def looks_like_trap(url: Column, max_len: int = 2000, max_depth: int = 14) -> Column:
    """Very long or deep URLs, and paths that repeat a segment three times (one-letter ones four times)."""
    _, _, path, _ = _parts(url)
    segs = F.filter(F.split(path, "/"), lambda s: s != "")
    times = lambda s: F.size(F.filter(segs, lambda x: x == s))
    loop = F.exists(F.array_distinct(segs), lambda s: ((times(s) >= 3) & (F.length(s) > 1)) | (times(s) >= 4))
    return (F.length(_nz(url)) > max_len) | (F.size(segs) > max_depth) | loop


def split_url_values(cell: Column) -> Column:
    """The pieces of a cell that may hold several URLs."""
    s = strip(_nz(cell))
    cuts = r"(?i)[;\n\r\t|]+|,\s+|\s{2,}|\s+(?:e|et|und|y|and|en|och|og|ja)\s+(?=(?:https?://|www\.))"
    parts = F.transform(F.split(s, cuts), lambda p: F.regexp_replace(strip(p), r"^[<>\"' ]+|[<>\"' ]+\z", ""))
    spaced = lambda p: F.filter(F.split(p, r"\s+"), lambda x: x != "")
    several = lambda p: p.contains(" ") & (F.size(spaced(p)) > 1) & F.forall(spaced(p), lambda x: x.contains("."))
    out = F.flatten(F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.when(several(p), spaced(p)).otherwise(F.array(p))))
    return F.when(null_token(cell), F.array().cast("array<string>")).otherwise(out)


def normalize_url_value(value: Column) -> Column:
    """``scheme://host[:port][/path][?query]`` of one value, '' where it is no site."""
    s = F.regexp_replace(strip(_nz(value)), r"^[<>\"' ]+|[<>\"' ]+\z", "")
    no_site = null_token(s) | F.lower(s).rlike("^(?:mailto|tel|javascript):") | s.rlike(r"(?i)^[^@\s/]+@[^@\s/]+\.[a-z]{2,}\z")
    full = F.when(s.contains("://"), s).when(s.startswith("//"), F.concat(F.lit("https:"), s)).otherwise(F.concat(F.lit("https://"), s))
    scheme, port, path, query = _parts(full)
    host = host_of(full)
    label = r"[\p{L}\p{N}](?:[\p{L}\p{N}-]{0,61}[\p{L}\p{N}])?"
    good = host.rlike(rf"^(?:{label}\.){{1,126}}\p{{L}}{{2,}}\z") | is_ipv4(host) | host.contains(":")
    p = F.regexp_replace(F.regexp_replace(path, r"/{2,}", "/"), r"/+\z", "")
    shown = F.when(port.isin("", "80", "443"), host).otherwise(F.concat(host, F.lit(":"), port))
    made = F.concat(scheme, F.lit("://"), shown, p, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))
    return F.when(no_site | ~scheme.isin("http", "https") | ~good, F.lit("")).otherwise(made)


def normalize_url_values(cell: Column) -> Column:
    """The distinct sites of a cell, in order."""
    return F.array_distinct(F.filter(F.transform(split_url_values(cell), normalize_url_value), lambda u: u != ""))


def dedupe_key(url: Column) -> Column:
    """Host without ``www.`` and path, scheme ignored; what is no site, trimmed and lower-cased."""
    n = normalize_url_value(url)
    body = F.regexp_replace(F.regexp_replace(F.lower(n), r"^https?://(?:www\.)?", ""), r"[?].*\z", "")
    return F.when(n == "", F.lower(strip(_nz(url)))).otherwise(body)


def clean_hostname(raw: Column) -> Column:
    """A bare host out of a host, URL or host:port cell; null where nothing usable is left."""
    s = F.lower(strip(_nz(raw)))
    bare = F.regexp_replace(F.regexp_replace(s, r"^[a-z][a-z0-9+.-]*://", ""), r"(?s)[/?#].*\z", "")
    bare = F.rtrim(F.regexp_replace(F.regexp_replace(bare, r"^[^@]*@", ""), r":\d+\z", ""), F.lit("."))
    return F.when(bare.rlike(r"^[^\s./]+(?:\.[^\s./]+)+\z"), bare)


def hostname_changed(raw: Column) -> Column:
    return F.coalesce(clean_hostname(raw) != raw, F.lit(True))


def registry_url(raw: Column) -> Column:
    """A registry's site cell as ``scheme://host...``; null without dot or letter."""
    s = strip(_nz(raw))
    full = F.when(s.rlike(r"(?i)^https?://"), s).otherwise(F.concat(F.lit("http://"), s))
    out = F.regexp_replace(full, r"(?i)^(https?://)www\.", "$1")
    rest = F.regexp_replace(out, r"(?i)^https?://", "")
    return F.when(rest.contains(".") & rest.rlike(r"[A-Za-z0-9]"), out)


def suffixes(host: Column) -> Column:
    """Every suffix of a host at a label border, the whole first: the keys for an equi-join with a domain list."""
    parts = labels(F.rtrim(F.lower(_nz(host)), F.lit(".")))
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def in_domain_list(host: Column, domains: list[str]) -> Column:
    """Whether the host is one of the domains or below one."""
    return F.arrays_overlap(suffixes(host), F.array(*[F.lit(d.lower()) for d in domains]))


def is_infrastructure(host: Column, extra: tuple[str, ...] = ()) -> Column:
    parts = labels(F.rtrim(F.lower(_nz(host)), F.lit(".")))
    root = F.when(F.size(parts) >= 2, F.try_element_at(parts, F.lit(-2))).otherwise(F.try_element_at(parts, F.lit(1)))
    return (_nz(host) != "") & (in_domain_list(host, [*INFRASTRUCTURE, *extra]) | root.isin(*INFRASTRUCTURE_LABELS))


def tld_matches(host: Column, tlds: list[str]) -> Column:
    """The host's TLD is listed, or a listed government label stands just before a two-letter TLD."""
    parts = labels(F.rtrim(F.lower(_nz(host)), F.lit(".")))
    last, before = F.try_element_at(parts, F.lit(-1)), F.try_element_at(parts, F.lit(-2))
    government = [t for t in tlds if t in ("gov", "gob", "gouv", "gv", "govt", "government", "admin")]
    second = (F.length(last) == 2) & before.isin(*government) if government else F.lit(False)
    return F.coalesce(last.isin(*[t.lower() for t in tlds]) | second & (F.size(parts) >= 2), F.lit(False))


def domain_points(host: Column, country: Column) -> Column:
    """0 to 2: one for the country's own TLD, one for a ``gov`` label."""
    h = F.lower(_nz(host))
    own = F.try_element_at(labels(h), F.lit(-1)) == F.lower(_nz(country))
    return (own.cast("int") + h.rlike(r"(?:^|[.-])(?:gov|gob|gouv|gv)(?:[.-]|$)").cast("int")).cast("int")


def is_file_url(url: Column) -> Column:
    return F.lower(F.regexp_replace(_nz(url), r"[?#].*\z", "")).rlike(r"\.(?:" + "|".join(FILE_ENDINGS) + r")\z")


def pagination_template(url: Column) -> Column:
    """The URL with its page number as ``{}``; null without one."""
    rx = r"(?i)([?&/](?:page|pagina|seite|p|pag|pg|start|offset)[=/_-]?)(\d+)"
    return F.when(_nz(url).rlike(rx), F.regexp_replace(url, rx, "$1{}"))


def redirect_target(url: Column, parameter: str = "uddg") -> Column:
    """The URL wrapped in a redirect's parameter, or the URL itself."""
    raw = F.regexp_extract(_nz(url), rf"[?&]{parameter}=([^&#]*)", 1)
    return F.when(raw != "", F.coalesce(F.try_url_decode(raw), raw)).otherwise(url)


def redact_secrets(text: Column) -> Column:
    """Values of key-like query parameters as ``***``."""
    return F.regexp_replace(text, r"(?i)([?&](?:key|apikey|api_key|token|access_token|secret|password)=)[^&\s]+", "$1***")


def site_variants(host: Column) -> Column:
    """The ways an official site may be written: http(s), with and without www, with and without slash; none for no host."""
    bare = F.regexp_replace(_nz(host), r"^www\.", "")
    hosts = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.array(bare, F.concat(F.lit("www."), bare)))
    return F.flatten(F.transform(hosts, lambda h: F.array(*[F.concat(F.lit(f"{s}://"), h, F.lit(e)) for s in ("https", "http") for e in ("", "/")])))


def candidate_urls(host: Column, limit: int = 4) -> Column:
    """Addresses to try for a host, best first: https before http, as given before with or without www."""
    bare = F.regexp_replace(_nz(host), r"^www\.", "")
    other = F.when(_nz(host).startswith("www."), bare).otherwise(F.concat(F.lit("www."), bare))
    hosts = F.array(_nz(host), other)
    every = F.concat(F.transform(hosts, lambda h: F.concat(F.lit("https://"), h, F.lit("/"))), F.transform(hosts, lambda h: F.concat(F.lit("http://"), h, F.lit("/"))))
    return F.slice(F.array_distinct(every), 1, limit)


def plausible_site(host: Column, blocked: list[str]) -> Column:
    """Whether a host can be an entity's own site: given, and on or below no domain of the block list."""
    return (_nz(host) != "") & ~(in_domain_list(host, blocked) if blocked else F.lit(False))


def first_and_rest(values: Column, observed: Column | None = None) -> Column:
    """``first`` of a list of hosts, and the ``rest`` after those already observed, each once, in order."""
    others = F.slice(values, 2, F.greatest(F.size(values), F.lit(1)))
    rest = F.array_distinct(F.concat(observed, others)) if observed is not None else others
    return F.struct(F.try_element_at(values, F.lit(1)).alias("first"), rest.alias("rest"))
