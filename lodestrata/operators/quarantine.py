"""Delimited lines whose shape differs from file to file: valid records on one side, rejects with a reason on the other.

Each file's header line sets its delimiter, its columns and their order. A line is checked for its structure first
(quoting, then number of fields). Value checks run once per *distinct* value: the distinct values of each checked
column are tested, the ones that fail make a dictionary of invalid values with reasons, and that is joined back. A
column with a billion rows and a million spellings is tested a million times.

Skew: headers and dictionary are the small sides; Spark broadcasts them while their measured size allows. Beyond
that both joins are salted, so a file or a value that holds a third of all rows is spread over
as many tasks. The distinct step combines on the map side.

Defined results: a null line counts as an empty one; a file without header line takes ``default_header``; of several
header lines of one file the one with the smallest id counts; columns of a header that the record doesn't have are
checked for number only and then left out, record columns that a header doesn't have come out null; a line with
several faults has the first in the order quoting, column_count, then the value rules in the order given. An empty field
goes through its rule like any other value, so whether it is valid is for the rule to say; a column that a file's header
doesn't have is not tested.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.lineage import cut
from lodestrata.skew import salted_join

DELIMITERS = (";", ",", "\t", "|")
_BLANKS = r"[\s ﻿]"


@dataclass(frozen=True)
class ValueRule:
    """``valid`` tests a trimmed value; a value that fails is rejected as ``reason``."""

    column: str
    valid: Callable[[Column], Column]
    reason: str


def trimmed(value: Column) -> Column:
    return F.regexp_replace(value, rf"^{_BLANKS}++|(?<!{_BLANKS}){_BLANKS}++\z", "")


def valid_host(value: Column) -> Column:
    """Empty, or a dotted name of two or more labels with an optional scheme, final dot, port and path."""
    label = r"[\p{L}\p{N}](?:[\p{L}\p{N}-]{0,61}[\p{L}\p{N}])?"
    shape = rf"^(?i:https?://)?({label}(?:\.{label})++)\.?(?::\d{{1,5}})?(?:[/?#].*)?\z"
    name = F.regexp_extract(value, "(?s)" + shape, 1)
    return (value == "") | ((name != "") & (F.length(name) <= 253))


def valid_entity_code(value: Column) -> Column:
    """A UUID, or 1-6 letters, an underscore and 3-6 letters or digits; an empty code is neither."""
    return value.rlike(
        r"^(?:[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}|[A-Za-z]{1,6}_[A-Za-z0-9]{3,6})\z"
    )


def _header(line: Column) -> tuple[Column, Column]:
    """Delimiter and column names of a header line."""
    counts = [F.struct((F.length(line) - F.length(F.replace(line, F.lit(d), F.lit("")))).alias("n"), F.lit(-i).alias("i"), F.lit(d).alias("d")) for i, d in enumerate(DELIMITERS)]
    delim = F.greatest(*counts)["d"]
    names = F.transform(F.split(line, F.concat(F.lit(r"\Q"), delim, F.lit(r"\E"))), lambda n: F.regexp_replace(n, rf'^[\s﻿"]+|[\s"]+$', ""))
    return delim, names


def parsed_lines(df: DataFrame, id_col: str, file_col: str, number_col: str, line_col: str, default_header: str) -> DataFrame:
    """``id``, ``file``, ``names``, ``fields`` (unquoted) and ``fault`` (structural or null) of the lines after each header."""
    lines = df.select(
        df[id_col].alias("id"), df[file_col].alias("file"), df[number_col].alias("no"), F.coalesce(df[line_col], F.lit("")).alias("line")
    )
    delim, names = _header(F.col("header"))
    headers = (
        lines.filter("no = 1").groupBy("file").agg(F.min_by("line", "id").alias("header"))
        .select("file", delim.alias("delim"), names.alias("names"))
    )
    default_delim, default_names = _header(F.lit(default_header))
    body = lines.filter("no <> 1 or no is null")
    joined = salted_join(body, headers, ["file"], "id", "left").select(
        "id", "file", "line", F.coalesce("delim", default_delim).alias("delim"), F.coalesce("names", default_names).alias("names")
    )
    quoted, one = r'"[^"]*+(?:""[^"]*+)*+"', F.concat(F.lit(r"\Q"), F.col("delim"), F.lit(r"\E"))
    plain = F.concat(F.lit(r'[^"'), one, F.lit("]*+"))
    field = F.concat(F.lit(rf"(?:{quoted}|"), plain, F.lit(")"))
    whole = F.concat(F.lit("^"), field, F.lit("(?:"), one, field, F.lit(r")*+\z"))
    cells = F.regexp_extract_all(F.concat("delim", "line"), F.concat(one, F.lit("("), field, F.lit(")")), F.lit(1))
    unquoted = F.transform(
        cells, lambda c: F.when(c.startswith('"'), F.replace(c.substr(F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c)
    )
    return joined.withColumn("sound", F.regexp_like("line", whole)).select(
        "id", "file", "names", F.when(F.col("sound"), unquoted).alias("fields"), "sound"
    ).select(
        "id", "file", "names", "fields",
        F.when(~F.col("sound"), "quoting").when(F.size("fields") != F.size("names"), "column_count").alias("fault"),
    )


def _value(column: str) -> Column:
    at = F.array_position("names", column).cast("int")
    return F.when(F.col("fault").isNull() & (at > 0), F.try_element_at("fields", F.when(at > 0, at).otherwise(1)))


def invalid_values(values: DataFrame, rules: list[ValueRule]) -> DataFrame:
    """The dictionary: ``column``, ``value``, ``reason`` of each distinct value that fails its rule."""
    verdict = F.lit(None).cast("string")
    for rule in rules:
        failed = (F.col("column") == rule.column) & ~F.coalesce(rule.valid(F.col("value")), F.lit(False))
        verdict = F.coalesce(verdict, F.when(failed, F.lit(rule.reason)))
    return values.distinct().select("column", "value", verdict.alias("reason")).filter("reason is not null")


def quarantine(
    df: DataFrame, id_col: str, file_col: str, number_col: str, line_col: str, rules: list[ValueRule], default_header: str
) -> DataFrame:
    """``id``, ``file``, ``names``, ``fields``, ``reason``: every line after the headers, ``reason`` null where it is valid."""
    lines = parsed_lines(df, id_col, file_col, number_col, line_col, default_header)
    for k, rule in enumerate(rules):
        lines = lines.withColumn(f"v{k}", trimmed(_value(rule.column)))
    lines = cut(lines)
    pairs = F.explode(F.array(*[F.struct(F.lit(r.column).alias("column"), F.col(f"v{k}").alias("value")) for k, r in enumerate(rules)]))
    bad = invalid_values(lines.select(pairs.alias("p")).select("p.*").filter("value is not null"), rules)
    out = lines
    for k, rule in enumerate(rules):
        own = bad.filter(F.col("column") == rule.column).select(F.col("value").alias(f"v{k}"), F.col("reason").alias(f"r{k}"))
        out = salted_join(out, own, [f"v{k}"], "id", "left")
    reasons = F.coalesce("fault", *[F.col(f"r{k}") for k in range(len(rules))])
    return out.select("id", "file", "names", "fields", reasons.alias("reason"))


def valid_records(lines: DataFrame, columns: list[str]) -> DataFrame:
    """The valid lines as records of ``columns``, whatever the order and set of columns in their file."""
    good = lines.filter("reason is null").withColumn("fault", F.lit(None).cast("string"))
    return good.select(F.col("id").alias("raw_id"), F.col("file").alias("source_file"), *[_value(c).alias(c) for c in columns])
