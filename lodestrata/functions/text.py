"""Cells and words as column expressions."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestrata.functions.cells import strip


def _fold_table() -> tuple[str, str, str]:
    """Accented letters and their base letters, made from the Unicode decompositions; and the combining marks."""
    plain, base = [], []
    for cp in [*range(0xC0, 0x250), *range(0x370, 0x400), *range(0x400, 0x460), *range(0x1E00, 0x2000)]:
        c = chr(cp)
        d = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)).lower()
        if len(d) == 1 and d != c:
            plain.append(c)
            base.append(d)
    return "".join(plain), "".join(base), "".join(chr(c) for c in range(0x300, 0x370))


_FROM, _TO, _MARKS = _fold_table()


def fold(text: Column) -> Column:
    """Lower case without accents; punctuation becomes space, spaces are squeezed."""
    t = F.lower(F.translate(F.coalesce(text, F.lit("")), _FROM + _MARKS, _TO))
    return strip(F.regexp_replace(F.regexp_replace(t, r"[^\p{L}\p{N}_\s]", " "), r"\s+", " "))


def cell_text(value: Column) -> Column:
    """A spreadsheet number as text: whole numbers without decimals; null for NaN."""
    d = value.cast("double")
    whole = d == F.floor(d)
    plain = F.regexp_replace(d.cast("decimal(38,9)").cast("string"), r"(?<=\.\d{1,9})0+\z", "")
    near = (F.abs(d) >= 1e-3) & (F.abs(d) < 1e7)
    return (
        F.when(d.isNull() | F.isnan(d), F.lit(None)).when(whole & (F.abs(d) < 1e15), d.cast("bigint").cast("string"))
        .when(near | (F.abs(d) >= 1e15), d.cast("string")).otherwise(plain)
    )


def list_text(values: Column) -> Column:
    return F.array_join(values, "|")


def first_filled(*candidates: Column) -> Column:
    """The first value that is neither null nor blank, trimmed; '' where none is."""
    return F.coalesce(*[F.nullif(strip(c), F.lit("")) for c in candidates], F.lit(""))


def split_list(cell: Column, sep: str = ";") -> Column:
    """The non-empty parts of a joined cell."""
    return F.filter(F.split(F.coalesce(cell, F.lit("")), re.escape(sep)), lambda x: x != "")


def primary_lang(tag: Column) -> Column:
    return F.regexp_extract(F.lower(strip(F.coalesce(tag, F.lit("")))), r"^([^-_]*)", 1)


def stems_pattern(stems: list[str]) -> str:
    """One pattern for a word list: entries match from a word's start, with a final ``!`` the whole word; longest first."""

    def body(s: str) -> str:
        words = unicodedata.normalize("NFKD", s.rstrip("!"))
        words = "".join(c for c in words if not unicodedata.combining(c)).lower()
        return r"\s+".join(re.escape(w) for w in re.sub(r"[^\w\s]", " ", words).split())

    parts = sorted({body(s) + (r"\b" if s.endswith("!") else "") for s in stems if body(s)}, key=lambda p: (-len(p), p))
    return r"\b(?:" + "|".join(parts) + ")"


def distinct_matches(pattern: str, folded: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(folded, F.lit(f"({pattern})"), F.lit(1)))


#: Words in names of entities that tell none apart.
GENERIC_WORDS = "comune commune gemeinde gemeente ayuntamiento camara city council town municipality provincia regione istituto institut instituto scuola school ministero ministry ville stadt unione".split()


def distinctive_tokens(name: Column) -> Column:
    """Words of four letters and more that tell an entity apart."""
    return F.array_distinct(F.filter(F.split(fold(name), " "), lambda w: (F.length(w) >= 4) & ~w.isin(*GENERIC_WORDS)))


def name_match(name: Column, host: Column) -> Column:
    """Share of a name's distinctive words that the host contains; 1 for a name without any."""
    words = distinctive_tokens(name)
    hit = F.size(F.filter(words, lambda w: F.lower(host).contains(w)))
    return F.when(F.size(words) == 0, F.lit(1.0)).otherwise(hit / F.size(words))


def squash(score: Column, scale: float = 6.0) -> Column:
    return 1 - F.exp(-F.greatest(score, F.lit(0.0)) / scale)


def department_code(insee: Column) -> Column:
    """The department of a municipality code: two characters, three overseas."""
    c = strip(F.coalesce(insee, F.lit("")))
    return F.when(c.rlike("^9[78]"), F.substring(c, 1, 3)).otherwise(F.substring(c, 1, 2))


def plain_contact(text: Column) -> Column:
    """Printable ASCII only, for request headers."""
    return strip(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20-\x7e]", ""))


def lookup(value: Column, table: dict[str, str], default: str) -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, value), F.lit(default))


def same_text(a: Column, b: Column) -> Column:
    """Whether two texts are equal apart from case, accents, punctuation and white space; null equals the empty text."""
    return fold(a) == fold(b)
