"""Cells that hold several values: one row per value, with its position.

The cell is split on its quote characters; the odd pieces are literals, the even ones are split on delimiters, and
array folds put the values together again in order. All of it is SQL expressions inside one projection and one
generator: no shuffle, no Python, and a row is read once.

What keeps a delimiter *inside* a value from splitting it is the field's grammar, given as two patterns: how a value
starts, and how one ends. A quote opens only at a value's start and closes only before a delimiter or the end; an
unquoted delimiter splits only between something that ends like a value and something that starts like one.

Defined results: a null, empty or blank cell and a cell of delimiters only give no rows; empty values between
delimiters are skipped and not counted; repeats stay; an unclosed quote is an ordinary character; the control characters
2 and 3 count as blanks; the other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MARK, _CUT = "\u0002", "\u0003"


@dataclass(frozen=True)
class Grammar:
    """``start``: pattern at which a value begins. ``end``: pattern with which it ends, without limit of length, or ''.

    ``bare_slash``: whether a slash without white space around it separates too.
    """

    start: str = r"[^\s;,|]"
    end: str = ""
    bare_slash: bool = False


_HOST_LABEL = r"[\p{L}\p{N}_](?:[\p{L}\p{N}_-]{0,61}[\p{L}\p{N}_])?"
HOSTS = Grammar(
    start=r"(?:https?://|(?!\d+\b)(?=[\p{N}_.-]*+\p{L})" + _HOST_LABEL + r"(?:\." + _HOST_LABEL + r"){0,126}\."
    r"(?!(?:html?|php|aspx?|jsp|pdf|xml|json|txt|csv|css|js|png|jpe?g|gif)\b)\p{L}[\p{L}\p{N}-]+(?=$|[\s;,|/:?#\"'\x02]))"
)
#: Label and score, whole or with decimals after a point or comma; a bare number is no start, so a decimal comma doesn't split.
SCORES = Grammar(start=r"(?!\d++(?:[\s;,|/\x02\"']|$))[^\s;,|/]", end=r":\s*+[+-]?\d++(?:[.,]\d++)?(?![^\s;,|/\x02\"'])", bare_slash=True)


def kinds(*names: str) -> Grammar:
    """Values of the form ``kind:text``: of the kinds given, or without any of every kind written as one lower-case word.

    With open kinds a word before a colon inside a text begins a value too."""
    kind = "|".join(map(re.escape, names)) if names else r"(?-i:\p{Ll}[\p{Ll}\p{N}_]*+)(?!://)"
    return Grammar(start=rf"(?:{kind})\s*+:", bare_slash=True)


def packed_values(cell: Column, grammar: Grammar) -> Column:
    """The cell's values as an array of strings, in order."""
    start, end = grammar.start, grammar.end
    delim = r"[\s;,|/]" if grammar.bare_slash else r"[\s;,|]"
    quoted = F.replace(F.replace(cell, F.lit(_MARK), F.lit(" ")), F.lit(_CUT), F.lit(" "))
    # loops are possessive: no backtracking and no recursion, whatever their length
    for q in ('"', "'"):
        if end:
            closing = rf"{end}\s*+{q}(?!{q})"
            body = rf"(?:(?!{closing})(?:[^{q}\x02]|{q}{q}))*+{end}"
        else:
            body = rf"[^{q}\x02]*+(?:{q}{q}[^{q}\x02]*+)*+"
        quoted = F.regexp_replace(
            quoted,
            rf"(?i)(?:^|(?<=[\s;,|/\x02])){q}(?=\s*+{start})({body})\s*+{q}(?={delim}|/|$|\x02)",
            _MARK + ("2" if q == '"' else "1") + "$1" + _MARK,
        )
    pieces = F.split(quoted, _MARK)
    slash = "" if grammar.bare_slash else r"|(?<=\s)/(?=\s)"
    between = rf"(?i)({end})(?:{delim}{slash})++(?={start})" if end else rf"(?i)()(?<!{delim})(?:{delim}{slash})++(?={start})"
    edges = rf"^(?:{delim}|/(?=\s|\z))++|(?<!{delim})(?:{delim}|(?<=\s)/)++\z"

    def literal(piece: Column) -> Column:
        text = F.trim(F.substring(piece, 2, 1 << 30))
        return F.when(piece.startswith("2"), F.replace(text, F.lit('""'), F.lit('"'))).otherwise(
            F.replace(text, F.lit("''"), F.lit("'"))
        )

    def fold(piece: Column, i: Column) -> Column:
        plain = F.split(F.regexp_replace(F.regexp_replace(piece, edges, ""), between, "$1" + _CUT), _CUT)
        return F.when(i % 2 == 1, F.array(literal(piece))).otherwise(plain)

    values = F.transform(F.flatten(F.transform(pieces, fold)), lambda v: F.regexp_replace(v, r"^\s++|(?<!\s)\s++\z", ""))
    return F.filter(values, lambda v: (v != "") & ~v.rlike(r"^[\s;,|/\"']*$"))


def split_packed(df: DataFrame, id_col: str, cell_col: str, grammar: Grammar) -> DataFrame:
    """``row_id``, ``position`` (from 1), ``value``, ``n_values`` of every value of ``cell_col``."""
    cells = df.filter(F.col(cell_col).rlike(r"[^\s;,|/]")).select(
        F.col(id_col).alias("row_id"), packed_values(F.col(cell_col), grammar).alias("values")
    )
    return cells.select("row_id", F.size("values").alias("n_values"), F.posexplode("values").alias("p", "value")).select(
        "row_id", (F.col("p") + 1).alias("position"), "value", "n_values"
    )
