"""Points with reasons, votes and verdicts as expressions and single aggregations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.operators.ranking import cap_per_group
from lodestrata.skew import salted_join


def points_with_reasons(tests: list[tuple[Column, int, str]], sep: str = "; ") -> tuple[Column, Column]:
    """(sum of the points of the tests that hold, their reasons in order); a test that is null doesn't hold."""
    held = [(F.coalesce(t, F.lit(False)), p, r) for t, p, r in tests]
    points = sum((F.when(t, F.lit(p)).otherwise(F.lit(0)) for t, p, _ in held), F.lit(0))
    return points, F.array_join(F.array_compact(F.array(*[F.when(t, F.lit(r)) for t, _, r in held])), sep)


def entity_risk(df: DataFrame) -> tuple[Column, Column]:
    """0 to 5 points and reasons; a measurement whose column is absent contributes nothing."""
    have = set(df.columns)
    tests = []
    if "n_ns_operators" in have:
        tests.append((F.coalesce(F.expr("try_cast(n_ns_operators as double)"), F.lit(0.0)) <= 1, 1, "nessuna ridondanza NS"))
    if "dmarc_policy" in have:
        tests.append((~F.lower(F.coalesce("dmarc_policy", F.lit(""))).isin("reject", "quarantine"), 1, "DMARC non attivo (assente o solo osservazione)"))
    if "dnssec" in have:
        tests.append((~F.coalesce("dnssec", F.lit(False)), 1, "DNSSEC assente"))
    if "tls_days_left" in have:
        tests.append((F.expr("try_cast(tls_days_left as double)") <= 30, 1, "certificato TLS scaduto o in scadenza entro 30 giorni"))
    if "tls_grade" in have:
        tests.append((F.col("tls_grade").isin("C", "D"), 1, "voto TLS basso (C/D: cipher debole o protocolli deprecati attivi)"))
    return points_with_reasons(tests)


#: Points of references and oddities of a domain.
REFERENCE_POINTS = {"script": 3, "iframe": 3, "link_risorsa": 1, "img": 1, "link": 1}
ODD_TLDS = "zip mov top xyz click gq tk ml cf work loan win rest surf".split()
ODD_WORDS = ("login", "verify", "secure-", "update", "wallet")


def domain_suspicion(domain: Column, kinds: Column, n_pages: Column, https_only: Column) -> tuple[Column, Column]:
    """Points and reasons that order a domain for review; never a verdict."""
    from lodestrata.functions.urls import is_ipv4, labels

    d = F.lower(F.coalesce(domain, F.lit("")))
    tests = [(F.array_contains(kinds, k), p, f"reference:{k}") for k, p in REFERENCE_POINTS.items()]
    tests += [
        (~F.coalesce(https_only, F.lit(False)), 1, "not https"), (is_ipv4(d) | d.contains(":"), 2, "ip literal"), (d.rlike(r"(^|\.)xn--"), 2, "punycode"),
        (F.try_element_at(labels(d), F.lit(-1)).isin(*ODD_TLDS), 2, "odd tld"), (d.rlike("|".join(ODD_WORDS)), 2, "odd word"), (n_pages == 1, 2, "single page"),
    ]
    return points_with_reasons(tests)


def noisy_or(votes: DataFrame, by: list[str], value: str, conf: str, order: str) -> DataFrame:
    """Per group the winning value: confidences of one value combine as 1 - prod(1 - c), c within 0 and .99; the
    winner's is lowered by half the runner-up's; conflict where that has at least half of it and .4. Equal ones: the
    value voted for first."""
    c = F.greatest(F.lit(0.0), F.least(F.lit(0.99), F.col(conf)))
    per = votes.groupBy(*by, value).agg((1 - F.exp(F.sum(F.log(1 - c)))).alias("c"), F.min(order).alias("o"))
    score = F.struct(F.round("c", 9).alias("c"), (-F.col("o")).alias("o"), F.col(value).alias("v"))
    first = per.select(*by, score.alias("s")).groupBy(*by).agg(F.max("s").alias("first"))
    scores = per.select(*[F.col(b).alias(f"__{i}") for i, b in enumerate(by)], score.alias("s"))
    same = F.lit(True)
    for i, b in enumerate(by):
        same = same & F.col(b).eqNullSafe(F.col(f"__{i}"))
    both = scores.join(first, same)
    second = F.max(F.when(F.col("s") != F.col("first"), F.col("s")["c"]))
    best = both.groupBy(*by).agg(F.first("first").alias("t"), second.alias("b")).withColumn("a", F.col("t")["c"]).withColumn("b", F.coalesce("b", F.lit(0.0)))
    return best.select(
        *by, F.col("t")["v"].alias(value), F.round(F.greatest(F.lit(0.0), F.col("a") - 0.5 * F.col("b")), 3).alias("conf"), ((F.col("b") >= 0.5 * F.col("a")) & (F.col("b") >= 0.4)).alias("conflict")
    )


def verdicts(votes: DataFrame, host: str = "host") -> DataFrame:
    """Votes (host, field, value, conf, stage, evidence, ord) combined to one verdict per host: nature, type, their
    confidences, conflict, stages in order, up to four pieces of evidence of the winners. Infrastructure has no type."""
    won = noisy_or(votes, [host, "field"], "value", "conf", "ord")
    wide = won.groupBy(host).agg(
        *[F.max(F.when(F.col("field") == f, F.col(c))).alias(n) for f, c, n in (("natura", "value", "natura"), ("natura", "conf", "conf_natura"), ("tipo", "value", "tipo"), ("tipo", "conf", "conf_tipo"))],
        F.bool_or("conflict").alias("conflict"),
    )
    infra = F.coalesce(F.col("natura") == "infrastruttura", F.lit(False))
    wide = wide.select(
        host, F.coalesce("natura", F.lit("non_classificabile")).alias("natura"), F.coalesce("conf_natura", F.lit(0.0)).alias("conf_natura"),
        F.when(infra, F.lit("non_applicabile")).otherwise(F.coalesce("tipo", F.lit("sconosciuto"))).alias("tipo"),
        F.when(infra, F.col("conf_natura")).otherwise(F.coalesce("conf_tipo", F.lit(0.0))).alias("conf_tipo"), "conflict",
    )
    stages = votes.groupBy(host, "stage").agg(F.min("ord").alias("o")).groupBy(host).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "stage"))), lambda x: x["stage"]), "+").alias("stages"))
    winners = salted_join(votes, won.select(host, "field", "value"), [host, "field", "value"], ["ord", "stage"]).filter("evidence <> ''")
    best = cap_per_group(winners.select(host, "conf", "ord", F.concat_ws(":", "stage", "evidence").alias("e")), [host], [F.desc("conf"), F.asc("ord"), F.asc("e")], 4, spread_by="ord")
    proof = best.groupBy(host).agg(F.transform(F.array_sort(F.collect_list(F.struct("__rank", "e"))), lambda x: x["e"]).alias("p"))
    return wide.join(stages, host).join(proof.select(host, F.array_join("p", " || ").alias("evidence")), host, "left")


#: Classes that are public by nature, and tokens in host names that give a class away (``!`` whole label).
PUBLIC_BY_NATURE = ("comune", "regione_provincia", "governo_centrale", "polizia_sicurezza", "giustizia", "parlamento", "emergenza", "ambiente")
HOST_TOKENS = {
    "comune": ["comune", "gemeente", "gemeinde", "ayuntamiento", "mairie", "ville!", "stadt!", "gmina", "kommun", "dimos"], "regione_provincia": ["regione", "provincia", "region!", "landkreis"],
    "polizia_sicurezza": ["polizia", "polizei", "policia", "police!", "politie"], "scuola": ["scuola", "school!", "schule", "colegio", "ecole!", "liceo"],
    "universita": ["universit", "uni!", "hochschule"], "sanita": ["ospedale", "hospital", "asl!", "klinik"], "giustizia": ["tribunale", "tribunal", "gericht"],
}
TOKEN_EXCLUDED = ("stadtwerke", "gemeinschaft")
GOV_HOST = r"(?:^|\.)(?:gov|gob|gouv|gv|gub)\.[a-z]{2}$|\.(?:gov|europa\.eu)$"


def _matching(pattern: str) -> Callable[[Column], Column]:
    return lambda part: part.rlike(pattern)


def host_votes(host: Column) -> Column:
    """Votes that a host name alone gives: infrastructure ends it; else a government suffix, and one type per token."""
    from lodestrata.functions.text import fold
    from lodestrata.functions.urls import is_infrastructure

    vote = lambda f, v, c, e: F.struct(F.lit(f).alias("field"), F.lit(v).alias("value"), F.lit(c).alias("conf"), F.lit("stadio0").alias("stage"), e.alias("evidence"))
    h = F.lower(F.coalesce(host, F.lit("")))
    parts = F.filter(F.transform(F.split(h, r"[.\-_]"), lambda p: F.replace(fold(p), F.lit(" "), F.lit(""))), lambda p: (p != "") & (p != "www") & ~F.exists(F.array(*[F.lit(x) for x in TOKEN_EXCLUDED]), lambda x: p.startswith(x)))
    out = [F.when(h.rlike(GOV_HOST), vote("natura", "pubblico", 0.9, F.lit("suffisso")))]
    for kind, tokens in HOST_TOKENS.items():
        pattern = "^(?:" + "|".join(x[:-1] + "$" if x[-1] == "!" else x for x in tokens) + ")"
        hit = F.try_element_at(F.filter(parts, _matching(pattern)), F.lit(1))
        out.append(F.when(hit.isNotNull(), vote("tipo", kind, 0.6, F.concat(F.lit("token host "), hit))))
        if kind in PUBLIC_BY_NATURE:
            out.append(F.when(hit.isNotNull(), vote("natura", "pubblico", 0.5, F.concat(F.lit("token host "), hit))))
    infra = F.array(vote("natura", "infrastruttura", 0.95, F.lit("dominio infrastrutturale noto")))
    return F.when(is_infrastructure(h), infra).otherwise(F.array_compact(F.array(*out)))


#: Weights of a page's fields.
FIELD_WEIGHTS = {"title": 3.0, "site_name": 3.0, "h1": 2.0, "jsonld": 2.5, "description": 2.0, "legal": 1.5, "footer": 1.5, "nav": 0.7, "body": 1.0}


def weighted_score(fields: dict[str, Column], stems: list[str], max_distinct: int = 3) -> Column:
    """Sum over fields of the weight times the number of distinct stems found there, at most ``max_distinct`` each."""
    from lodestrata.functions.text import distinct_matches, fold, stems_pattern

    rx = stems_pattern(stems)
    return sum((F.lit(FIELD_WEIGHTS.get(n, 1.0)) * F.least(F.size(distinct_matches(rx, fold(c))), F.lit(max_distinct)) for n, c in fields.items()), F.lit(0.0))


def lexicon_vote(scores: Column, least: float = 3.0, scale: float = 4.0) -> Column:
    """The vote of a map of type scores: the best, surer the higher and the further ahead; null below ``least``."""
    from lodestrata.functions.text import squash

    ranked = F.reverse(F.array_sort(F.transform(F.map_entries(scores), lambda e: F.struct(e["value"].alias("s"), e["key"].alias("k")))))
    a, b = F.try_element_at(ranked, F.lit(1)), F.coalesce(F.try_element_at(ranked, F.lit(2))["s"], F.lit(0.0))
    conf = F.round(0.95 * squash(a["s"], scale) * (0.5 + 0.5 * (a["s"] - b) / a["s"]), 3)
    return F.when(a["s"] >= least, F.struct(F.lit("tipo").alias("field"), a["k"].alias("value"), conf.alias("conf")))


def nature_vote(public: Column, private: Column, third: Column, least: float = 3.0, lead: float = 1.2) -> Column:
    """The vote of three nature scores: the best, if high and clearly ahead."""
    from lodestrata.functions.text import squash

    arr = F.reverse(F.array_sort(F.array(*[F.struct(s.cast("double").alias("s"), F.lit(n).alias("k")) for n, s in (("terzo_settore", third), ("privato", private), ("pubblico", public))])))
    a, b = arr[0], arr[1]
    return F.when((a["s"] >= least) & (a["s"] > lead * b["s"]), F.struct(F.lit("natura").alias("field"), a["k"].alias("value"), F.round(0.85 * squash(a["s"] - b["s"]), 3).alias("conf")))


def gated_pattern(base: list[str], extra: list[str], country: Column, page_lang: Column, where: tuple[str, str], text: Column) -> Column:
    """Distinct matches of a word list; ``extra`` counts only on pages of that country *and* that declared language."""
    from lodestrata.functions.text import distinct_matches, primary_lang, stems_pattern

    on = (F.upper(F.coalesce(country, F.lit(""))) == where[0]) & (primary_lang(page_lang) == where[1])
    return F.when(on, F.size(distinct_matches(stems_pattern(base + extra), text))).otherwise(F.size(distinct_matches(stems_pattern(base), text)))


def cascade(rows: DataFrame, key: str, stages: list[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """``key``, ``stage`` from 1: which stage settled each row. Every stage gets the rows that none before it settled and
    returns those of its own; a row that no stage settles has stage null. Keys are distinct."""
    open_, done = rows, None
    for n, stage in enumerate(stages, 1):
        own = stage(open_).select(key).distinct().withColumn("stage", F.lit(n))
        done = own if done is None else done.unionByName(own)
        open_ = open_.join(own.select(key), key, "left_anti")
    return rows.select(key).join(done, key, "left")


def answer_votes(nature: Column, kind: Column, confidence: Column) -> Column:
    """Votes of a given answer: uncertain nature counts half, type ``altro`` six tenths, infrastructure has no type."""
    v = lambda f, val, c: F.struct(F.lit(f).alias("field"), val.alias("value"), c.alias("conf"))
    n = v("natura", nature, F.round(confidence * F.when(nature == "incerto", 0.5).otherwise(1.0), 3))
    t = F.when((kind != "non_applicabile") & (nature != "infrastruttura"), v("tipo", kind, F.round(confidence * F.when(kind == "altro", 0.6).otherwise(1.0), 3)))
    return F.array_compact(F.array(n, t))


def entity_name(*candidates: Column) -> Column:
    """The first filled name: register, knowledge base, then the page's own."""
    from lodestrata.functions.text import first_filled

    return first_filled(*candidates)


def transit_dependency(df: DataFrame, host: str, asn: str, own: str, share: str, least: float = 0.5) -> DataFrame:
    """Per host the foreign network that most of its paths cross, if at least ``least``; the larger AS number breaks ties."""
    rows = df.filter((F.col(asn) != F.col(own)) & (F.col(asn) != 0) & (F.col(share) >= least))
    return rows.groupBy(host).agg(F.max_by(asn, F.struct(share, asn)).alias("transit"), F.round(F.max(share), 3).alias("share"))
