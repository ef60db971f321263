"""Copies that differ only in formatting: canonical form, 128-bit hash, counts.

A record's canonical form composes its characters (a letter followed by its combining marks is the accented letter),
keeps the letters and digits of every field, lower-cased, drops empty fields and sorts the rest, so that case, white
space, punctuation, the spelling of accents and the order of the fields play no part. Accents do.

Shape of the job: one pass computes a 128-bit hash and an independent 64-bit check per row; the counts are
aggregated with map-side combining, so a group that holds a third of all rows reaches the reducers as one partial
row per map task. Grouping is by hash *and* check: two different records would have to collide in both. Members
are joined back to their groups in two ways: groups above a thousandth of all rows, of which there can be fewer
than a thousand, are broadcast and their members never shuffled; all others go through an ordinary join in which
no key is hot.

Defined results: a null field counts as empty; a row of empty fields only is a record like any other and equals the
other such rows; a row with a null id is counted but named in no pair, and shown as its record's row only where all rows
of the record lack an id; rows that share an id are rows like any others, but no pair names an id with itself; marks that
no composed letter holds are dropped; an empty table gives an empty result; other columns are not compared.
"""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.lineage import cut

#: A group is hot above this share of all rows; so fewer than its inverse can be hot.
HOT_SHARE = 1 / 1000
_SEP = "\u0001"


def _composed_letters() -> dict[str, str]:
    """Letters with marks as sequences -> composed letters, from the Unicode decompositions."""
    out = {}
    for cp in range(0xC0, sys.maxunicode + 1):
        c = chr(cp)
        apart = unicodedata.normalize("NFD", c)
        if len(apart) > 1 and all(map(unicodedata.combining, apart[1:])) and unicodedata.normalize("NFC", apart) == c:
            out[apart] = c
    return out


_COMPOSED = _composed_letters()


def composed(text: Column) -> Column:
    """The text with every letter and its marks as one composed letter where there is one; only texts with marks are touched."""
    table = F.map_from_arrays(F.array(*map(F.lit, _COMPOSED)), F.array(*map(F.lit, _COMPOSED.values())))
    whole = F.transform(F.regexp_extract_all(text, F.lit(r"(?s)(\P{M}\p{M}+|.)"), F.lit(1)), lambda x: F.coalesce(F.try_element_at(table, x), x))
    marked = (F.octet_length(text) > F.length(text)) & text.rlike(r"\p{M}")
    return F.when(marked, F.array_join(whole, "")).otherwise(text)


def canonical_text(fields: list[Column]) -> Column:
    """Letters and digits of each field, composed and lower-cased; empty ones dropped, the others sorted."""
    return _cleaned(composed(_joined(fields)))


def _joined(fields: list[Column]) -> Column:
    return F.concat_ws(_SEP, *[F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit(_SEP), F.lit("")) for c in fields])


def _cleaned(text: Column) -> Column:
    kept = F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}\x01]+", ""))
    return F.array_join(F.sort_array(F.array_remove(F.split(kept, _SEP), "")), _SEP)


def _with_text(df: DataFrame, fields: list[str], name: str) -> DataFrame:
    """``df`` with the canonical text, made in steps so that none is worked out twice."""
    return df.withColumn(name, _joined([df[f] for f in fields])).withColumn(name, composed(F.col(name))).withColumn(name, _cleaned(F.col(name)))


def fingerprints(df: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """``id``, ``hash`` (16 bytes) and ``check`` (64 bits) of every row."""
    return _with_text(df, fields, "__text").select(F.col(id_col).alias("id"), F.unhex(F.md5("__text")).alias("hash"), F.xxhash64("__text").alias("check"))


def copy_groups(prints: DataFrame) -> DataFrame:
    """One row per record: ``hash``, ``check``, ``keep`` (its smallest id) and ``n_copies``."""
    return prints.groupBy("hash", "check").agg(F.min("id").alias("keep"), F.count(F.lit(1)).alias("n_copies"))


def hash_collisions(groups: DataFrame) -> DataFrame:
    """One row: how many records, hashes, and hashes that stand for more than one record (told apart by the check)."""
    per_hash = groups.groupBy("hash").agg(F.count(F.lit(1)).alias("k"))
    return per_hash.agg(
        F.coalesce(F.sum("k"), F.lit(0)).alias("n_records"), F.count(F.lit(1)).alias("n_hashes"), F.count_if(F.col("k") > 1).alias("n_collisions")
    )


def copy_pairs(df: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """``keep``, ``copy``: for each group of copies, its smallest id with each of the others."""
    prints = cut(fingerprints(df, id_col, fields))
    total = prints.count()
    hot = F.col("n_copies") > F.lit(max(1.0, total * HOT_SHARE))
    groups = copy_groups(prints).filter("n_copies > 1")
    key = ["hash", "check"]
    hot_members = prints.join(F.broadcast(groups.filter(hot)), key)
    members = prints.join(groups.filter(~hot), key)
    return (
        hot_members.unionByName(members)
        .filter(F.col("id") != F.col("keep"))
        .select("keep", F.col("id").alias("copy"))
    )


def collapse_copies(df: DataFrame, id_col: str, fields: list[str], count_col: str = "n_copies") -> DataFrame:
    """One row per record, as its row with the smallest id has it, and ``count_col``, its number of copies.

    Of rows with the same id the one whose fields come first is shown. A single aggregation with map-side combining: a
    group that holds a third of all rows sends one row per map task. A column already named ``count_col`` is an error.
    """
    if count_col in df.columns:
        raise ValueError(f"there is a column {count_col} already")
    order = F.struct(F.col(id_col).isNull().alias("a"), F.col(id_col).alias("b"), *[F.col(f).alias(f"f{i}") for i, f in enumerate(fields)])
    rows = _with_text(df, fields, "__text").select(F.struct(*df.columns).alias("row"), order.alias("order"), F.unhex(F.md5("__text")).alias("hash"), F.xxhash64("__text").alias("check"))
    once = rows.groupBy("hash", "check").agg(F.min_by("row", "order").alias("row"), F.count(F.lit(1)).alias(count_col))
    return once.select("row.*", count_col)
