"""Ordered rules on text: first match, all matches, keyword scores.

Up to about a hundred rules fold into one expression of the scan's own stage; larger domain lists go through suffix
keys and an equi-join instead of comparing every row with every rule.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.skew import salted_join

#: Domains of a list that is broadcast, at most.
LISTED = 100_000


def first_match(text: Column, rules: list[tuple[str, str]]) -> Column:
    """The value of the first rule whose pattern the text contains, or null."""
    return F.coalesce(*[F.when(text.contains(pattern), F.lit(value)) for pattern, value in rules], F.lit(None).cast("string"))


@dataclass(frozen=True)
class Vendor:
    pattern: str
    category: str
    vendor: str
    parent: str | None = None


#: What third-party resources are recognised by, in order; the first match counts.
VENDORS = [
    Vendor("fonts.googleapis.com", "cdn_font", "Google Fonts", "Google"),
    Vendor("fonts.gstatic.com", "cdn_font", "Google Fonts", "Google"),
    Vendor("cdnjs.cloudflare.com", "cdn_font", "cdnjs (Cloudflare)", "Cloudflare"),
    Vendor("cdn.jsdelivr.net", "cdn_font", "jsDelivr"),
    Vendor("unpkg.com", "cdn_font", "unpkg"),
    Vendor("use.fontawesome.com", "cdn_font", "Font Awesome"),
    Vendor("maxcdn.bootstrapcdn.com", "cdn_font", "BootstrapCDN"),
    Vendor("stackpath.bootstrapcdn.com", "cdn_font", "BootstrapCDN"),
    Vendor("google-analytics.com", "analytics", "Google Analytics", "Google"),
    Vendor("googletagmanager.com", "analytics", "Google Tag Manager", "Google"),
    Vendor("connect.facebook.net", "analytics", "Meta Pixel", "Meta"),
    Vendor("facebook.net", "analytics", "Meta (Facebook) SDK", "Meta"),
    Vendor("hotjar.com", "analytics", "Hotjar"),
    Vendor("clarity.ms", "analytics", "Microsoft Clarity", "Microsoft"),
    Vendor("matomo.cloud", "analytics", "Matomo Cloud"),
    Vendor("google.com/recaptcha", "captcha", "Google reCAPTCHA", "Google"),
    Vendor("gstatic.com/recaptcha", "captcha", "Google reCAPTCHA", "Google"),
    Vendor("challenges.cloudflare.com", "captcha", "Cloudflare Turnstile", "Cloudflare"),
    Vendor("hcaptcha.com", "captcha", "hCaptcha"),
    Vendor("cookiebot.com", "cookie_banner", "Cookiebot"),
    Vendor("iubenda.com", "cookie_banner", "iubenda"),
    Vendor("onetrust.com", "cookie_banner", "OneTrust"),
    Vendor("tawk.to", "chat_supporto", "Tawk.to"),
    Vendor("zdassets.com", "chat_supporto", "Zendesk"),
    Vendor("intercom.io", "chat_supporto", "Intercom"),
    Vendor("youtube.com", "video", "YouTube", "Google"),
    Vendor("ytimg.com", "video", "YouTube", "Google"),
    Vendor("vimeo.com", "video", "Vimeo"),
    Vendor("vimeocdn.com", "video", "Vimeo"),
    Vendor("googleapis.com", "sdk_generico", "Google APIs", "Google"),
    Vendor("gstatic.com", "sdk_generico", "Google (statico)", "Google"),
]
#: Cookie names, in order, with their class and vendor; the first match counts.
COOKIES = [
    ("_ga", "profilazione", "Google Analytics"),
    ("_gid", "profilazione", "Google Analytics"),
    ("_gat", "profilazione", "Google Analytics"),
    ("_fbp", "profilazione", "Meta Pixel"),
    ("_fbc", "profilazione", "Meta Pixel"),
    ("fr", "profilazione", "Meta (Facebook) Ads"),
    ("ide", "profilazione", "Google DoubleClick/Ads"),
    ("_hjid", "profilazione", "Hotjar"),
    ("_hjsession", "profilazione", "Hotjar"),
    ("_clck", "profilazione", "Microsoft Clarity"),
    ("_clsk", "profilazione", "Microsoft Clarity"),
    ("_gcl_", "profilazione", "Google Ads (conversion linker)"),
    ("_pk_id", "profilazione", "Matomo (modalità non anonimizzata)"),
    ("muid", "profilazione", "Microsoft Advertising"),
    ("nid", "profilazione", "Google (pubblicità/preferenze)"),
    ("phpsessid", "tecnico", "Sessione applicativa (PHP)"),
    ("jsessionid", "tecnico", "Sessione applicativa (Java)"),
    ("asp.net_sessionid", "tecnico", "Sessione applicativa (ASP.NET)"),
    ("csrftoken", "tecnico", "Protezione CSRF"),
    ("csrf_token", "tecnico", "Protezione CSRF"),
    ("xsrf-token", "tecnico", "Protezione CSRF"),
    ("cookieconsent", "tecnico", "Banner cookie (memorizza la scelta dell'utente)"),
    ("cookielawinfo", "tecnico", "Banner cookie (CookieYes/CookieLaw)"),
    ("cookie_notice", "tecnico", "Banner cookie"),
    ("euconsent", "tecnico", "IAB TCF (registra il consenso, non traccia di per sé)"),
    ("wordpress_", "tecnico", "WordPress (autenticazione/sessione)"),
    ("wp-settings", "tecnico", "WordPress (preferenze pannello)"),
    ("cfid", "tecnico", "ColdFusion (sessione)"),
    ("cftoken", "tecnico", "ColdFusion (sessione)"),
    ("lang", "tecnico", "Preferenza lingua"),
    ("cookiesession", "tecnico", "Sessione generica"),
    ("session_id", "tecnico", "Sessione generica"),
    ("sessionid", "tecnico", "Sessione generica"),
    ("remember_token", "tecnico", "Autenticazione persistente"),
]


def vendors_of(rules: list[dict]) -> list[Vendor]:
    """Vendors out of the mappings of a rule file, in its order."""
    return [Vendor(str(r["pattern"]).lower(), r["categoria"], r["vendor"], r.get("organizzazione_madre")) for r in rules]


def cookies_of(rules: list[dict]) -> list[tuple[str, str, str]]:
    """Cookie rules out of the mappings of a rule file, in its order."""
    return [(str(r["pattern"]).lower(), r["categoria"], r["vendor"]) for r in rules]


def third_party(url: Column, rules: list[Vendor] | None = None, unmatched: str = "host") -> Column:
    """``category``, ``vendor``, ``parent`` of a resource by the first rule in its URL.

    Without one the category is ``altro_terzo_parte`` and vendor and parent are the host, or with ``unmatched="url"``
    the whole URL.
    """
    from lodestrata.functions.urls import host_of

    rules = VENDORS if rules is None else rules
    other = host_of(url) if unmatched == "host" else url
    low = F.lower(F.coalesce(url, F.lit("")))
    made = lambda c, v, p: F.struct(F.lit(c).alias("category"), v.alias("vendor"), p.alias("parent"))
    hits = [F.when(low.contains(r.pattern.lower()), made(r.category, F.lit(r.vendor), F.lit(r.parent or r.vendor))) for r in rules]
    return F.coalesce(*hits, made("altro_terzo_parte", other, other))


def cookie_class(name: Column, rules: list[tuple[str, str, str]] | None = None) -> Column:
    """A cookie's class: patterns of up to four characters must be the whole name, longer ones part of it; first wins."""
    n = F.lower(F.coalesce(name, F.lit("")))
    tests = [F.when((n == p) if len(p) <= 4 else n.contains(p), F.lit(c)) for p, c, _ in (COOKIES if rules is None else rules)]
    return F.coalesce(*tests, F.lit("sconosciuto"))


def best_class(resources: DataFrame, keys: list[str], position: str, category: str, generic: str = "altro_terzo_parte") -> DataFrame:
    """Per key, the class of its first resource that isn't generic; the last generic one where all are."""
    is_generic = F.col(category) == generic
    rank = F.struct(is_generic.alias("g"), F.when(is_generic, -F.col(position)).otherwise(F.col(position)).alias("p"))
    return resources.groupBy(*keys).agg(F.min_by(category, rank).alias(category))


@dataclass(frozen=True)
class Software:
    """A mark of site software: ``source`` is html, header_server or header_powered_by; ``version`` a pattern with one group."""

    pattern: str
    source: str
    name: str
    kind: str
    licence: str
    open_source: bool | None
    version: str = ""


#: Marks of site software, in order.
SOFTWARE = [
    Software("wp-content", "html", "WordPress", "cms", "GPL-2.0-or-later", True, 'content="WordPress ([0-9.]+)'),
    Software("wp-includes", "html", "WordPress", "cms", "GPL-2.0-or-later", True),
    Software("/media/jui/", "html", "Joomla!", "cms", "GPL-2.0-or-later", True),
    Software('content="joomla', "html", "Joomla!", "cms", "GPL-2.0-or-later", True, 'content="joomla! ([0-9.]+)'),
    Software("sites/default/files", "html", "Drupal", "cms", "GPL-2.0-or-later", True),
    Software('content="drupal', "html", "Drupal", "cms", "GPL-2.0-or-later", True, 'content="drupal ([0-9.]+)'),
    Software("typo3conf", "html", "TYPO3", "cms", "GPL-2.0-or-later", True),
    Software("/++resource++plone", "html", "Plone", "cms", "GPL-2.0-or-later", True),
    Software("/html/js/liferay", "html", "Liferay", "cms", "LGPL-2.1", True),
    Software("liferay.portal", "html", "Liferay", "cms", "LGPL-2.1", True),
    Software("__dnn", "html", "DNN (DotNetNuke)", "cms", "MIT", True),
    Software("/desktopmodules/", "html", "DNN (DotNetNuke)", "cms", "MIT", True),
    Software("umbraco", "html", "Umbraco", "cms", "MIT", True),
    Software("/typo3temp/", "html", "TYPO3", "cms", "GPL-2.0-or-later", True),
    Software("bootstrap-italia", "html", "Bootstrap Italia / Design System Italia", "framework", "BSD-3-Clause", True),
    Software("it-header-slim-wrapper", "html", "Bootstrap Italia / Design System Italia", "framework", "BSD-3-Clause", True),
    Software("sitecore", "html", "Sitecore", "cms", "proprietaria", False),
    Software("x-powered-by: sitecore", "header_powered_by", "Sitecore", "cms", "proprietaria", False),
    Software("php/", "header_powered_by", "PHP", "framework", "PHP License 3.01", True, "php/([0-9.]+)"),
    Software("asp.net", "header_powered_by", "ASP.NET", "framework", "MIT", True),
    Software("apache", "header_server", "Apache HTTP Server", "server_web", "Apache-2.0", True, "apache/([0-9.]+)"),
    Software("nginx", "header_server", "nginx", "server_web", "BSD-2-Clause", True, "nginx/([0-9.]+)"),
    Software("microsoft-iis", "header_server", "Microsoft IIS", "server_web", "proprietaria", False, "microsoft-iis/([0-9.]+)"),
]


def software_of(rules: list[dict]) -> list[Software]:
    """Software marks out of the mappings of a rule file, in its order."""
    return [Software(str(r["pattern"]).lower(), r["fonte"], r["software"], r["categoria"], r["licenza"], r.get("open_source"), r.get("version_regex") or "") for r in rules]


def software_found(df: DataFrame, keep: list[str], html: str, server: str | None = None, powered_by: str | None = None, rules: list[Software] | None = None) -> DataFrame:
    """``keep``.., ``software``, ``kind``, ``licence``, ``open_source``, ``version``: all software that a page or its headers
    show, once each, in the order of the first mark that matches, with the first version that a mark gives, or ''.

    Single quotes count as double ones. The texts are lowered once, in a projection of their own.
    """
    columns = {"html": html, "header_server": server, "header_powered_by": powered_by}
    text = lambda c: F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("'"), F.lit('"')) if c else F.lit("")
    shown = df.select(*keep, *[text(c).alias(f"__{k}") for k, c in columns.items()])
    low = shown.select("*", *[F.lower(f"__{k}").alias(f"__low_{k}") for k in columns])
    by_name: dict[str, list[tuple[int, Software]]] = {}
    for n, rule in enumerate(SOFTWARE if rules is None else rules):
        by_name.setdefault(rule.name, []).append((n, rule))
    hits = []
    for name, marks in by_name.items():
        on = [(n, r, F.col(f"__low_{r.source}").contains(r.pattern)) for n, r in marks]
        fact = lambda n, r: F.struct(F.lit(n).alias("at"), F.lit(r.kind).alias("kind"), F.lit(r.licence).alias("licence"), F.lit(r.open_source).cast("boolean").alias("open_source"))
        first = F.coalesce(*[F.when(hit, fact(n, r)) for n, r, hit in on])
        versions = [F.when(hit, F.nullif(F.regexp_extract(f"__{r.source}", f"(?i){r.version}", 1), F.lit(""))) for _, r, hit in on if r.version]
        version = F.coalesce(*versions, F.lit(""))
        hits.append(F.when(first.isNotNull(), F.struct(first["at"].alias("at"), F.lit(name).alias("software"), first["kind"].alias("kind"), first["licence"].alias("licence"), first["open_source"].alias("open_source"), version.alias("version"))))
    found = low.select(*keep, F.explode(F.array_sort(F.array_compact(F.array(*hits)))).alias("s"))
    return found.select(*keep, "s.software", "s.kind", "s.licence", "s.open_source", "s.version")


def keyword_scores(df: DataFrame, keep: list[str], head: Column, body: Column, keywords: dict[str, list[str]]) -> DataFrame:
    """``keep``.. and a column of points per category: three for each keyword in the head, else one if it is in the body.

    Head and body are lowered once, in a projection of their own; the points are plain columns.
    """
    low = df.select(*keep, F.lower(F.coalesce(head, F.lit(""))).alias("__h"), F.lower(F.coalesce(body, F.lit(""))).alias("__b"))
    points = lambda w: F.when(F.col("__h").contains(w), 3).when(F.col("__b").contains(w), 1).otherwise(0)
    return low.select(*keep, *[sum((points(w) for w in words), F.lit(0)).cast("bigint").alias(c) for c, words in keywords.items()])


def top_category(order: list[str]) -> Column:
    """The column of points with the most; of equal ones the first in ``order``; null where all are 0."""
    most = F.greatest(*order) if len(order) > 1 else F.col(order[0])
    return F.when(most > 0, F.coalesce(*[F.when(F.col(c) == most, F.lit(c)) for c in order]))


def word_signals(text: Column, whole: list[str], parts: list[str]) -> Column:
    """``forma_societaria:x`` for whole words and ``commerciale:y`` for parts found in a text, in list order."""
    import re

    low = F.lower(F.coalesce(text, F.lit("")))
    hits = [F.when(low.rlike(rf"(?<![\p{{L}}\p{{N}}]){re.escape(w)}(?![\p{{L}}\p{{N}}])"), F.lit(f"forma_societaria:{w}")) for w in whole]
    hits += [F.when(low.contains(w), F.lit(f"commerciale:{w}")) for w in parts]
    return F.array_compact(F.array(*hits))


def longest_keyword(label: Column, keywords: dict[str, str]) -> Column:
    """The value of the longest keyword in a label; of equally long ones the first in alphabet; null without one."""
    ordered = sorted(keywords, key=lambda k: (-len(k), k))
    return first_match(F.lower(F.coalesce(label, F.lit(""))), [(k, keywords[k]) for k in ordered])


def match_domains(hosts: DataFrame, host_col: str, domains: DataFrame, domain_col: str, spread_by: str | None = None, how: str = "inner") -> DataFrame:
    """Hosts joined to the domains that they are or lie below, by equality on their suffixes; no nested loop.

    ``domains`` must hold each domain once. A host below several comes out once for each. Every host has the suffix of its
    top-level domain: suffixes that are no listed domain are taken off before anything is shuffled where the list is at
    most ``LISTED`` domains, which are broadcast; beyond that the suffixes are salted.
    """
    from lodestrata.functions.urls import suffixes

    spread_by = spread_by or host_col
    listed = domains.withColumn("__suffix", F.lower(F.rtrim(F.col(domain_col), F.lit("."))))
    keyed = hosts.withColumn("__suffix", F.explode_outer(suffixes(F.col(host_col))))
    if len(listed.select("__suffix").limit(LISTED + 1).collect()) <= LISTED:
        return keyed.join(F.broadcast(listed), "__suffix", how).drop("__suffix")
    return salted_join(keyed, listed, ["__suffix"], spread_by, how).drop("__suffix")


def match_either_way(hosts: DataFrame, host_col: str, domains: DataFrame, domain_col: str, spread_by: str | None = None) -> DataFrame:
    """Hosts joined to the domains that they are, lie below or lie above: ``a.b.it`` and ``b.it`` go together both ways."""
    below = match_domains(hosts, host_col, domains, domain_col, spread_by)
    names = {c: f"__own_{c}" for c in domains.columns}
    once = hosts.select(F.lower(F.rtrim(F.col(host_col), F.lit("."))).alias("__host")).filter("__host <> ''").distinct()
    above = match_domains(domains.withColumnsRenamed(names), names[domain_col], once, "__host").filter(F.col("__host") != F.lower(F.rtrim(F.col(names[domain_col]), F.lit("."))))
    small = above.withColumnsRenamed({v: k for k, v in names.items()})
    back = salted_join(hosts.withColumn("__host", F.lower(F.rtrim(F.col(host_col), F.lit(".")))), small, ["__host"], spread_by or host_col).drop("__host")
    return below.unionByName(back.select(*below.columns))
