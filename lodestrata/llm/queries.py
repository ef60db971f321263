"""Queries of the text operators, over their whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm import canonical, langseg, mixing, mojibake, packing, pii
from lodestrata.schemas import RECORD_COLUMNS
from lodestrata.session import table


#: What stands in ``evidenza`` besides running text, whose column is cut at so many characters.
EVIDENCE_NOISE = langseg.Noise(
    marks=tuple("tld status conf jsonld wikidata nav host lang http score stage".split()),
    tlds=(*langseg.HOST_TLDS, "example"),
    cut_names=tuple("title meta description body footer header main h1 h2 h3 nav legal tld status conf jsonld wikidata".split()),
)
EVIDENCE_CUT = 400


def _identified(spark: SparkSession, root: str, every_row: bool) -> DataFrame:
    return langseg.identify(table(spark, root, "siti_classificati"), "riga_id", "lang", "evidenza", EVIDENCE_CUT, every_row, EVIDENCE_NOISE)


def p1_languages(spark: SparkSession, root: str) -> DataFrame:
    """Every row: its language with a confidence, and its stretches; without running text no language and confidence 0."""
    return _identified(spark, root, True)


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    rows = _identified(spark, root, False)
    cases = rows.filter("n_langs > 1 or not agrees")
    return cases.select(F.col("row_id").alias("riga_id"), F.explode("stretches").alias("s")).select(
        "riga_id", F.col("s.position").alias("posizione"), F.col("s.lang").alias("lingua")
    )


COMPARED = [c for c in RECORD_COLUMNS if c != "retrieved_at"]


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    pairs = canonical.copy_pairs(table(spark, root, "site_records"), "rec_id", COMPARED)
    return pairs.select(F.col("keep").alias("rec_id_a"), F.col("copy").alias("rec_id_b"))


def p2_collapsed(spark: SparkSession, root: str) -> DataFrame:
    """One record each, with its number of copies."""
    return canonical.collapse_copies(table(spark, root, "site_records"), "rec_id", COMPARED)


def p2_collisions(spark: SparkSession, root: str) -> DataFrame:
    """How many different records and hashes there are, and how many hashes stand for several records."""
    prints = canonical.fingerprints(table(spark, root, "site_records"), "rec_id", COMPARED)
    return canonical.hash_collisions(canonical.copy_groups(prints))


def p4_restored(spark: SparkSession, root: str) -> DataFrame:
    """The damaged fields with the restored text."""
    return mojibake.repair(table(spark, root, "site_records"), "rec_id", ["nome_ente", "comune"])


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    return p4_restored(spark, root).select(F.col("row_id").alias("rec_id"), F.col("field").alias("campo"))


def p7_packed(spark: SparkSession, root: str) -> DataFrame:
    """Container and place of every document, for each capacity."""
    capacities = packing.capacities_of(table(spark, root, "pack_capacity"), "pack_id", "capacity_tokens")
    return packing.pack(table(spark, root, "documents"), "doc_id", "text", capacities)


def p7_fill(spark: SparkSession, root: str) -> DataFrame:
    """How full the containers of each capacity are."""
    return packing.fill_report(p7_packed(spark, root), table(spark, root, "pack_capacity"))


def p8_mixed(spark: SparkSession, root: str) -> DataFrame:
    """The documents drawn for each mix."""
    return mixing.mix(table(spark, root, "documents"), "doc_id", "text", "source", table(spark, root, "mix_targets"))


def p8_shares(spark: SparkSession, root: str) -> DataFrame:
    """The shares reached by each mix."""
    return mixing.share_report(p8_mixed(spark, root), table(spark, root, "mix_targets"))


def p9_replacements(spark: SparkSession, root: str) -> DataFrame:
    """Every item with its entity and its surrogate."""
    return pii.replacements(table(spark, root, "documents"), "doc_id", "text", key="lodestrata")


def p9_found(spark: SparkSession, root: str) -> DataFrame:
    """The items for which surrogates are made."""
    return p9_replacements(spark, root).select("doc_id", F.col("start").alias("inizio"), F.col("kind").alias("tipo"))


def p9_redacted(spark: SparkSession, root: str) -> DataFrame:
    """Every document with a typed placeholder for each item."""
    return pii.redact(table(spark, root, "documents"), "doc_id", "text")


def p9_surrogates(spark: SparkSession, root: str) -> DataFrame:
    """Every document with a keyed surrogate for each item."""
    return pii.surrogates(table(spark, root, "documents"), "doc_id", "text", key="lodestrata")


_CANON = "array_to_string(list_sort(list_filter([{}], lambda x: x <> '')), chr(1))".format(
    ", ".join(f"lower(regexp_replace(nfc_normalize(coalesce({c}, '')), '[^\\p{{L}}\\p{{N}}]', '', 'g'))" for c in COMPARED)
)
_GROUPS = f"""WITH t AS (SELECT *, {_CANON} AS canon FROM site_records),
g AS (SELECT canon, min(rec_id) AS keep, count(*) AS n_copies FROM t GROUP BY canon)"""

QUERIES = {f.__name__: f for f in (p1_found, p1_languages, p2_found, p2_collapsed, p2_collisions, p4_found, p4_restored, p7_packed, p7_fill, p8_mixed, p8_shares, p9_found, p9_replacements, p9_redacted, p9_surrogates)}
ORACLES = {
    "p2_found": f"{_GROUPS} SELECT keep AS rec_id_a, rec_id AS rec_id_b FROM t JOIN g USING (canon) WHERE rec_id <> keep",
    "p2_collapsed": f"{_GROUPS} SELECT s.*, g.n_copies FROM site_records s JOIN g ON s.rec_id = g.keep",
    "p2_collisions": f"{_GROUPS} SELECT count(*) AS n_records, count(DISTINCT md5(canon)) AS n_hashes, count(*) - count(DISTINCT md5(canon)) AS n_collisions FROM g",
}
