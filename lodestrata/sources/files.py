"""Registry files as tables: delimited text in any encoding, spreadsheets, XML, JSON in pages and archives, page lists.

Files are read where they lie, one task per file or split; nothing is parsed on the driver but configuration.
"""

from __future__ import annotations

import bz2
import codecs
import io
import json
import re
import tarfile
import unicodedata
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Legacy code page to try per country, after UTF-8 and before the rest.
COUNTRY_CODE_PAGES = {"PL": "cp1250", "CZ": "cp1250", "SK": "cp1250", "HU": "cp1250", "RO": "cp1250", "HR": "cp1250", "SI": "cp1250", "GR": "cp1253", "EL": "cp1253", "BG": "cp1251", "LT": "cp1257", "LV": "cp1257", "EE": "cp1257"}


#: Character sets that the detector chooses among, and letters outside Latin that are frequent in their script.
_FREQUENT = frozenset("αοιετσνηυρόίάέή" "оеаинтсрвл")
DETECTED = ("cp1252", "cp1250", "cp1253", "cp1251", "iso8859_7", "iso8859_2")
_META_CHARSET = re.compile(rb"""<meta[^>]{0,200}?charset\s*=\s*["']?\s*([A-Za-z0-9_.:-]+)""", re.I)


def detected_charset(raw: bytes) -> str | None:
    """The single-byte set under which the bytes read most like words: letters beside letters of their script and case,
    few symbols and control characters, no accented Latin letter between two others; None where none reads so. Of equals the
    first."""
    best, most = None, 0.0
    for charset in DETECTED:
        try:
            text = raw.decode(charset)
        except UnicodeDecodeError:
            continue
        points = 0.0
        for m in re.finditer("[^\x00-\x7f]", text):
            c, before, after = m[0], text[m.start() - 1 : m.start()], text[m.end() : m.end() + 1]
            if not c.isalpha():
                points -= 1.0 if unicodedata.category(c) in ("Cc", "So", "Sm", "Sk") else 0.2
                continue
            beside = [x for x in (before, after) if x.isalpha()]
            script = lambda x: unicodedata.name(x, "?").split(" ")[0]
            points += 0.5 if not beside else sum(1.0 if script(x) == script(c) else -1.0 for x in beside) / len(beside)
            points += 0.5 * (c in _FREQUENT)
            points -= 2.0 * (script(c) == "LATIN" and len(beside) == 2 and not any(x.isascii() for x in beside))
            points -= 1.5 * (c.isupper() and before.islower())
        if points > most:
            best, most = charset, points
    # a few odd bytes alone say nothing
    return best if most >= 4 or re.search(rb"[A-Za-z]", raw) else None


def guess_charset(raw: bytes, content_type: str | None = None) -> str:
    """The character set of a captured answer: byte order mark, then the header, the page's meta tag, UTF-8 if it fits, the
    detector, and UTF-8 for want of better. Names that are no character set are passed over."""

    def known(name: str | None) -> str | None:
        try:
            return codecs.lookup(name).name if name else None
        except LookupError:
            return None

    for mark, name in ((codecs.BOM_UTF8, "utf-8-sig"), (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16")):
        if raw.startswith(mark):
            return name
    header = re.search(r"charset\s*=\s*[\"']?([\w.:-]+)", content_type or "", re.I)
    meta = _META_CHARSET.search(raw[:8192])
    named = known(header and header[1]) or known(meta and meta[1].decode("ascii"))
    if named:
        return named
    try:
        raw.decode("utf-8")
        return "utf-8"
    except UnicodeDecodeError:
        return detected_charset(raw) or "utf-8"


def charsets(df: DataFrame, id_col: str, content_col: str, type_col: str) -> DataFrame:
    """``page_id``, ``charset``, ``text`` of captured answers, bytes that don't fit replaced."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, raw, kind in zip(b["page_id"], b["raw"], b["type"], strict=True):
                raw = bytes(raw) if raw is not None else b""
                name = guess_charset(raw, kind)
                rows.append((i, name, raw.decode(name, "replace")))
            yield pd.DataFrame(rows, columns=["page_id", "charset", "text"])

    src = df.select(df[id_col].cast("bigint").alias("page_id"), df[content_col].alias("raw"), df[type_col].alias("type"))
    return src.mapInPandas(run, "page_id bigint, charset string, text string")


def decode_bytes(raw: bytes, configured: str | None = None, country: str | None = None) -> tuple[str, str, int]:
    """(text, encoding used, characters lost): strict attempts in order, with the detector before the last, then replacement."""
    tried = ["utf-8-sig", configured, COUNTRY_CODE_PAGES.get((country or "").upper()), None, "cp1252"]
    for enc in dict.fromkeys(tried):
        enc = detected_charset(raw) if enc is None else enc
        try:
            return raw.decode(enc), enc, 0
        except (UnicodeDecodeError, LookupError, TypeError):
            continue
    text = raw.decode("utf-8", "replace")
    return text, "utf-8/replace", text.count("�")


def read_csv(spark: SparkSession, path: str, schema: StructType, sep: str = ";", encoding: str = "UTF-8") -> DataFrame:
    """Delimited text with a header and an explicit schema."""
    return spark.read.schema(schema).option("header", True).option("sep", sep).option("encoding", encoding).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)


def read_text_any_encoding(spark: SparkSession, path: str, configured: str | None = None, country: str | None = None) -> DataFrame:
    """``path``, ``text``, ``encoding``, ``lost`` of every file, decoded by the first encoding that fits."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(p, *decode_bytes(c, configured, country)) for p, c in zip(b["path"], b["content"], strict=True)]
            yield pd.DataFrame(rows, columns=["path", "text", "encoding", "lost"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, text string, encoding string, lost int")


_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def sheet_rows(content: bytes, sheet: int = 1) -> Iterator[dict[str, str]]:
    """Cells of a sheet by column letter, row by row, from the workbook's own XML; rows of blanks are left out."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_NS}si"):
                shared.append("".join(t.text or "" for t in si.iter(f"{_NS}t")))
        for row in ElementTree.fromstring(z.read(f"xl/worksheets/sheet{sheet}.xml")).iter(f"{_NS}row"):
            cells = {}
            for c in row.iter(f"{_NS}c"):
                v = c.find(f"{_NS}v")
                text = "".join(t.text or "" for t in c.iter(f"{_NS}t")) if c.get("t") == "inlineStr" else (v.text or "") if v is not None else ""
                cells[(c.get("r") or "").rstrip("0123456789")] = shared[int(text)] if c.get("t") == "s" and text else text
            if any(x.strip() for x in cells.values()):
                yield cells


def read_sheets(spark: SparkSession, path: str, columns: dict[str, str], skip_rows: int = 1, sheet: int = 1) -> DataFrame:
    """All workbooks under a path: ``columns`` maps names to column letters; ``source_file`` and ``row_no`` are added."""
    names = list(columns)
    shape = ", ".join(["source_file string", "row_no int"] + [f"`{n}` string" for n in names])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for p, content in zip(b["path"], b["content"], strict=True):
                for n, cells in enumerate(sheet_rows(content, sheet)):
                    if n >= skip_rows:
                        rows.append((p.rsplit("/", 1)[-1], n, *[cells.get(columns[c]) for c in names]))
            yield pd.DataFrame(rows, columns=["source_file", "row_no", *names])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, shape)


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: StructType | None = None) -> DataFrame:
    """One row per ``row_tag`` element."""
    reader = spark.read.format("xml").option("rowTag", row_tag)
    return (reader.schema(schema) if schema else reader).load(path)


def _tag(name: str) -> str:
    return name.rpartition("}")[2].rpartition(":")[2].lower()


def xml_first_texts(df: DataFrame, id_col: str, xml_col: str, fields: dict[str, list[str]], skip: list[str] | None = None) -> DataFrame:
    """``row_id`` and a column per field: the first filled text among its candidate tags, by tag and not by place in the
    list; children of the record first, then deeper elements in document order, outside the subtrees to skip. Namespaces
    don't matter; '' without a text or for a fragment that can't be read."""
    away = {s.lower() for s in skip or []}

    def inner(node: ElementTree.Element) -> Iterator[ElementTree.Element]:
        for child in node:
            if _tag(child.tag) not in away:
                yield child
                yield from inner(child)

    def first(root: ElementTree.Element, tags: list[str]) -> str:
        for tag in tags:
            direct = [c for c in root if _tag(c.tag) == tag.lower() and _tag(c.tag) not in away]
            for node in (*direct, *(n for n in inner(root) if _tag(n.tag) == tag.lower())):
                text = " ".join((node.text or "").split())
                if text:
                    return text
        return ""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, xml in zip(b["row_id"], b["xml"], strict=True):
                try:
                    root = ElementTree.fromstring(xml or "")
                except (ElementTree.ParseError, RecursionError):
                    root = ElementTree.Element("none")
                rows.append((i, *[first(root, tags) for tags in fields.values()]))
            yield pd.DataFrame(rows, columns=["row_id", *fields])

    shape = "row_id bigint, " + ", ".join(f"`{f}` string" for f in fields)
    return df.select(df[id_col].cast("bigint").alias("row_id"), df[xml_col].alias("xml")).mapInPandas(run, shape)


def first_text(xml: Column, tags: list[str], skip: list[str] | None = None) -> Column:
    """The first filled text among candidate tags of an XML fragment, in order, outside the subtrees to skip; '' without."""
    body = xml
    for s in skip or []:
        body = F.regexp_replace(body, rf"(?is)<(?:\w+:)?{s}\b.*?</(?:\w+:)?{s}>", "")
    found = [F.nullif(F.trim(F.regexp_extract(body, rf"(?is)<(?:\w+:)?{t}(?:\s[^>]*)?>\s*([^<]*)</", 1)), F.lit("")) for t in tags]
    return F.coalesce(*found, F.lit(""))


def read_json_pages(spark: SparkSession, path: str, schema: StructType, records: str, min_records: int = 0) -> DataFrame:
    """Records of captured API pages: pages with the same content count once; too few records is an error."""
    raw = spark.read.text(path, wholetext=True).dropDuplicates(["value"])
    rows = raw.select(F.from_json("value", schema).alias("p")).select(F.explode_outer(f"p.{records}").alias("r")).filter("r is not null").select("r.*")
    if min_records and rows.limit(min_records).count() < min_records:
        raise ValueError(f"fewer than {min_records} records under {path}")
    return rows


def read_ndjson(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """(records, lines that are none) of newline-delimited JSON."""
    bad = "_corrupt"
    full = StructType(schema.fields).add(bad, "string")
    rows = spark.read.text(path).filter(F.trim("value") != "").select(F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}).alias("r")).select("r.*")
    return rows.filter(f"{bad} is null").drop(bad), rows.filter(f"{bad} is not null").select(F.col(bad).alias("line"))


CONTAINERS = ("services", "service", "records", "data", "items", "results")


def archive_records(content: bytes) -> Iterator[dict]:
    """Records of the JSON files of a tar.bz2, one file unpacked at a time: under a known container key, as a plain list, or
    one per line."""
    with tarfile.open(fileobj=bz2.open(io.BytesIO(content)), mode="r|") as tar:
        for member in tar:
            f = tar.extractfile(member)
            text = decode_bytes(f.read())[0] if f else ""
            try:
                data = json.loads(text)
            except ValueError:
                for line in text.splitlines():
                    try:
                        row = json.loads(line)
                    except ValueError:
                        continue
                    if isinstance(row, dict):
                        yield row
                continue
            rows = data if isinstance(data, list) else next((data[k] for k in CONTAINERS if isinstance(data.get(k), list)), [data])
            yield from (r for r in rows if isinstance(r, dict))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``source_file``, ``record`` (JSON text) of every record in the archives under a path."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(p.rsplit("/", 1)[-1], json.dumps(r, ensure_ascii=False)) for p, c in zip(b["path"], b["content"], strict=True) for r in archive_records(c)]
            yield pd.DataFrame(rows, columns=["source_file", "record"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "source_file string, record string")


def dimension_from_json(spark: SparkSession, path: str, schema: StructType, fields: dict[str, str]) -> DataFrame:
    """A dimension out of nested JSON: output names mapped to dotted paths."""
    return select_paths(spark.read.schema(schema).option("multiLine", True).json(path), fields)


def select_paths(df: DataFrame, fields: dict[str, str], **stamps: str) -> DataFrame:
    """Output columns from dotted source paths, as text, null as ''; ``stamps`` are constant columns."""
    return df.select(*[F.coalesce(F.col(p).cast("string"), F.lit("")).alias(n) for n, p in fields.items()], *[F.lit(v).alias(k) for k, v in stamps.items()])


def first_with_rows(primary: DataFrame, fallback: DataFrame, filled: str) -> DataFrame:
    """``primary`` if any row has ``filled``, else ``fallback``."""
    return primary if not primary.filter(F.coalesce(F.trim(filled), F.lit("")) != "").isEmpty() else fallback


def read_checkpoints(spark: SparkSession, root: str, schema: StructType, countries: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(checkpoint documents under ``country=XX`` folders, ``country`` and ``source_file`` of those that can't be read)."""
    full = StructType(schema.fields).add("_corrupt", "string")
    raw = spark.read.option("basePath", root).text(f"{root}/country=*", wholetext=True).withColumn("source_file", F.col("_metadata.file_name"))
    if countries:
        raw = raw.filter(F.col("country").isin(*countries))
    parsed = raw.select("country", "source_file", F.from_json("value", full, {"columnNameOfCorruptRecord": "_corrupt"}).alias("r"))
    bad = F.col("r").isNull() | F.col("r._corrupt").isNotNull()
    return parsed.filter(~bad).select("r.*", "country").drop("_corrupt"), parsed.filter(bad).select("country", "source_file")


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """Seeds of text files, without blanks and comments, numbered by file and line."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source_file"), F.posexplode(F.split("value", r"\r\n|\r|\n")).alias("line", "text"))
    seeds = whole.select("source_file", "line", F.trim(F.regexp_replace("text", "^\ufeff", "")).alias("url")).filter((F.col("url") != "") & ~F.col("url").startswith("#"))
    from lodestrata.operators.ranking import dense_numbers

    return dense_numbers(seeds, ["source_file", "line"], "ord").select("url", "ord")


def read_own(spark: SparkSession, path: str, schema: StructType, sep: str = ",") -> DataFrame:
    """A result of one's own read again as records: cells that are missing come out as ''."""
    return read_csv(spark, path, schema, sep).na.fill("")


def first_links(crawl: DataFrame | None, sites: DataFrame, host: str, link: str, order: str) -> DataFrame:
    """``host``, ``link`` of the first row of each filled host: from the crawl's rows if it has any, else from the sites'."""
    from lodestrata.operators.concentration import first_per_key

    source = sites if crawl is None else first_with_rows(crawl, sites, host)
    rows = source.select(F.trim(host).alias(host), link, order).filter(F.coalesce(host, F.lit("")) != "")
    return first_per_key(rows, host, [order, link]).select(host, link)


#: Readers by the type that a configuration names; further ones are added here.
READERS = {"csv": read_csv, "xml": read_xml, "sheets": read_sheets, "json_pages": read_json_pages, "archives": read_archives}


def reader_of(source_type: str) -> Callable:
    """The reader of a source type; a type that isn't known is an error."""
    if source_type not in READERS:
        raise ValueError(f"unknown source type {source_type}; known: {', '.join(sorted(READERS))}")
    return READERS[source_type]
