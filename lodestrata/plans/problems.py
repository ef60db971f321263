"""Queries of the core data-preparation operators, over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.operators import drift, packed, quarantine
from lodestrata.schemas import RECORD_COLUMNS
from lodestrata.session import table


_MANIFEST = ("dark_stack_manifest", "file_id", "serie", "run_ts", "payload")
#: Members that state the value of a count or path written as an object.
_VALUE_MEMBERS = ("totale", "path")


def _schemas(spark: SparkSession, root: str) -> DataFrame:
    name, *columns = _MANIFEST
    return drift.file_schemas(table(spark, root, name), *columns)


def _changes(spark: SparkSession, root: str) -> DataFrame:
    schemas = _schemas(spark, root)
    return drift.field_changes(schemas, drift.learn_names(schemas))


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    return _changes(spark, root).filter("level = 1").select("file_id", F.col("field").alias("campo"), F.col("change").alias("cambio"))


def p3_changes(spark: SparkSession, root: str) -> DataFrame:
    """Every change, of nested members too, with its series and the types before and after."""
    return _changes(spark, root)


def p3_fields(spark: SparkSession, root: str) -> DataFrame:
    """All files in one long table of typed branches."""
    name, *columns = _MANIFEST
    return drift.union_fields(table(spark, root, name), *columns, drift.learn_names(_schemas(spark, root)), _VALUE_MEMBERS)


def p3_schema(spark: SparkSession, root: str) -> DataFrame:
    """The fused schema with its alternatives."""
    return drift.union_schema(p3_fields(spark, root))


def p3_alternatives(spark: SparkSession, root: str) -> DataFrame:
    """Every alternative that appears after a path's first, with the file in which it does."""
    return drift.appearing_alternatives(p3_fields(spark, root))


def p3_table(spark: SparkSession, root: str) -> DataFrame:
    """All files in one table of one column per field, each with its tag."""
    return drift.consistent_table(p3_fields(spark, root))


SIGNAL_KINDS = ("forma_societaria", "commerciale")
#: Table, id, column and grammar of each packed column.
PACKED = (
    ("site_records", "rec_id", "host_osservati", packed.HOSTS),
    ("tipo_ente_possibili_non_pubblici", "riga_id", "categorie_rilevate_punteggi", packed.SCORES),
    ("tipo_ente_possibili_non_pubblici", "riga_id", "segnali_non_pubblico_rilevati", packed.kinds(*SIGNAL_KINDS)),
)


def _split_all(spark: SparkSession, root: str) -> DataFrame:
    out = None
    for name, key, column, grammar in PACKED:
        rows = packed.split_packed(table(spark, root, name), key, column, grammar).withColumn("campo", F.lit(column))
        out = rows if out is None else out.unionByName(rows)
    return out


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    return _split_all(spark, root).filter("n_values > 1").select(
        "campo", F.col("row_id").alias("riga_id"), F.col("position").alias("posizione"), F.col("value").alias("valore")
    )


def p5_values(spark: SparkSession, root: str) -> DataFrame:
    """Every value, of cells with one value too."""
    return _split_all(spark, root)


RECORD_RULES = [
    quarantine.ValueRule("hostname", quarantine.valid_host, "hostname"),
    quarantine.ValueRule("codice_ipa", quarantine.valid_entity_code, "codice_ipa"),
]


def _quarantined(spark: SparkSession, root: str) -> DataFrame:
    return quarantine.quarantine(
        table(spark, root, "raw_site_lines"), "raw_id", "source_file", "line_no", "raw_line", RECORD_RULES, ";".join(RECORD_COLUMNS)
    )


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    return _quarantined(spark, root).filter("reason is not null").select(F.col("id").alias("raw_id"), F.col("reason").alias("motivo"))


def p6_records(spark: SparkSession, root: str) -> DataFrame:
    """The lines that are valid, as records."""
    return quarantine.valid_records(_quarantined(spark, root), RECORD_COLUMNS)


QUERIES = {
    f.__name__: f for f in (p3_found, p3_changes, p3_fields, p3_schema, p3_alternatives, p3_table, p5_found, p5_values, p6_found, p6_records)
}


def _quarantine_sql(records: bool = False) -> str:
    """The reasons of rejected lines in SQL, or the valid records: one pattern per delimiter, as SQL patterns can't come from a column."""
    shown = {";": ";", ",": ",", "\t": "\\t", "|": "\\|"}
    quoted = '"(?:[^"]|"")*"'
    sound = " ".join(f"WHEN delim = '{d}' THEN regexp_matches(line, '^(?:{quoted}|[^\"{e}]*)(?:{e}(?:{quoted}|[^\"{e}]*))*$')" for d, e in shown.items())
    cells = " ".join(f"WHEN delim = '{d}' THEN regexp_extract_all('{d}' || line, '{e}({quoted}|[^\"{e}]*)', 1)" for d, e in shown.items())
    most = ", ".join(f"length(header) - length(replace(header, '{d}', ''))" for d in shown)
    first = " ".join(f"WHEN length(header) - length(replace(header, '{d}', '')) = greatest({most}) THEN '{d}'" for d in shown)
    label = r"[\p{L}\p{N}](?:[\p{L}\p{N}-]{0,61}[\p{L}\p{N}])?"
    host = rf"^(?i:https?://)?({label}(?:\.{label})+)\.?(?::\d{{1,5}})?(?:[/?#](?s:.*))?$"
    code = "^(?:[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}|[A-Za-z]{1,6}_[A-Za-z0-9]{3,6})$"
    value = "regexp_replace(CASE WHEN starts_with({0}, '\"') THEN replace(substring({0}, 2, length({0}) - 2), '\"\"', '\"') ELSE {0} END, '^[\\s\\p{{Z}}\\x{{feff}}]+|[\\s\\p{{Z}}\\x{{feff}}]+$', '', 'g')"
    field = "CASE WHEN starts_with({0}, '\"') THEN replace(substring({0}, 2, length({0}) - 2), '\"\"', '\"') ELSE {0} END"
    cells_ = ", ".join(f"{field.format(f'cells[list_position(names, {c!r})]')} AS {c}" for c in RECORD_COLUMNS)
    end = f"SELECT raw_id, source_file, {cells_} FROM m WHERE motivo IS NULL" if records else "SELECT raw_id, motivo FROM m WHERE motivo IS NOT NULL"
    return f"""WITH h AS (SELECT source_file, arg_min(raw_line, raw_id) AS header FROM raw_site_lines WHERE line_no = 1 GROUP BY 1), d AS (SELECT *, CASE {first} END AS delim FROM h),
n AS (SELECT source_file, delim, [regexp_replace(x, '^[\\s\\x{{feff}}"]+|[\\s"]+$', '', 'g') for x in string_split(header, delim)] AS names FROM d),
l AS (SELECT raw_id, r.source_file, coalesce(raw_line, '') AS line, delim, names FROM raw_site_lines r JOIN n ON r.source_file = n.source_file WHERE line_no <> 1),
c AS (SELECT *, CASE {sound} END AS sound, CASE {cells} END AS cells FROM l),
v AS (SELECT *, CASE WHEN sound AND len(cells) = len(names) THEN cells[list_position(names, 'hostname')] END AS h, CASE WHEN sound AND len(cells) = len(names) THEN cells[list_position(names, 'codice_ipa')] END AS k FROM c),
t AS (SELECT *, {value.format("h")} AS hv, {value.format("k")} AS kv FROM v),
m AS (SELECT raw_id, source_file, cells, names, CASE WHEN NOT sound THEN 'quoting' WHEN len(cells) <> len(names) THEN 'column_count'
  WHEN hv <> '' AND (regexp_extract(hv, '{host}', 1) = '' OR length(regexp_extract(hv, '{host}', 1)) > 253) THEN 'hostname' WHEN NOT regexp_matches(kv, '{code}') THEN 'codice_ipa' END AS motivo FROM t)
{end}"""


ORACLES: dict[str, str] = {"p6_found": _quarantine_sql(), "p6_records": _quarantine_sql(records=True)}
