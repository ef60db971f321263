"""Results as files: committed as a whole, versioned by run, never over an earlier one."""

from __future__ import annotations

import io
import json
import re
import uuid
import zipfile
from datetime import UTC, datetime
from xml.sax.saxutils import escape

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _files(spark: SparkSession, path: str) -> tuple[object, object, object]:
    """(file system, path, configuration) of the cluster's own file layer."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(conf), at, conf


def backup_existing(spark: SparkSession, path: str, stamp: str | None = None) -> str | None:
    """Moves a file or folder that lies where a result is to go to ``name_backup-<time>`` beside it; None if there is none."""
    fs, at, _ = _files(spark, path)
    if not fs.exists(at):
        return None
    stamp = stamp or datetime.now(UTC).strftime("%Y%m%dT%H%M%SZ")
    folder, _, name = path.rstrip("/").rpartition("/")
    stem, dot, end = name.rpartition(".")
    new = f"{folder}/{stem}_backup-{stamp}.{end}" if dot and stem else f"{folder}/{name}_backup-{stamp}"
    if not fs.rename(at, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(new)):
        raise OSError(f"{path} could not be moved to {new}")
    return new


def _put(spark: SparkSession, path: str, content: bytes) -> None:
    """Writes one small file as a whole: beside its place first, then moved there."""
    fs, at, _ = _files(spark, path)
    part = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(part)
    out.write(bytearray(content))
    out.close()
    if fs.exists(at):
        fs.delete(at, False)
    if not fs.rename(part, at):
        raise OSError(f"{path} could not be written")


def write_single_csv(df: DataFrame, path: str, sep: str = ",", bom: bool = True, order: list[str] | None = None) -> str:
    """One CSV file with a header and, for spreadsheets, a byte order mark; returns where it lies.

    The parts are written by the executors and then joined byte by byte, so no task and not the driver holds the rows. The
    file appears as a whole; one that can't be replaced stays, and the new one gets the time in its name.
    """
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    folder = f"{path}.{uuid.uuid4().hex}.parts"
    rows = df.orderBy(*order) if order else df
    rows.write.option("header", False).option("sep", sep).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("emptyValue", "").csv(folder)
    fs, at, conf = _files(spark, path)
    whole = jvm.org.apache.hadoop.fs.Path(f"{folder}.tmp")
    out = fs.create(whole)
    quoted = lambda c: '"' + c.replace('"', '""') + '"' if any(x in c for x in (sep, '"', "\n", "\r")) else c
    out.write(bytearray((("\ufeff" if bom else "") + sep.join(map(quoted, df.columns)) + "\n").encode()))
    parts = sorted(str(f.getPath()) for f in fs.listStatus(jvm.org.apache.hadoop.fs.Path(folder)) if f.getPath().getName().startswith("part-"))
    for part in parts:
        source = fs.open(jvm.org.apache.hadoop.fs.Path(part))
        jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, conf, False)
        source.close()
    out.close()
    fs.delete(jvm.org.apache.hadoop.fs.Path(folder), True)
    if (not fs.exists(at) or fs.delete(at, False)) and fs.rename(whole, at):
        return path
    stem, _, end = path.rpartition(".")
    other = f"{stem}.{datetime.now(UTC).strftime('%Y%m%d-%H%M%S')}.{end}"
    if not fs.rename(whole, jvm.org.apache.hadoop.fs.Path(other)):
        raise OSError(f"{path} could not be written; the rows are in {whole}")
    return other


#: Rows that a worksheet holds.
SHEET_ROWS = 1_048_575
_BAD_XML = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]")


def _letters(n: int) -> str:
    out = ""
    while n:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


def write_xlsx(df: DataFrame, path: str, order: list[str] | None = None, sheet: str = "Sheet1") -> str:
    """A workbook with one sheet: a header row and the rows as text or numbers. More rows than a worksheet holds is an
    error, raised before anything is written; the rows pass through the driver partition by partition."""
    spark = df.sparkSession
    if df.limit(SHEET_ROWS + 1).count() > SHEET_ROWS:
        raise ValueError(f"more than {SHEET_ROWS} rows; write CSV or Parquet")
    names = [_letters(i + 1) for i in range(len(df.columns))]

    def cell(at: str, value: object) -> str:
        if value is None:
            return ""
        if isinstance(value, (int, float)) and not isinstance(value, bool) and value == value and abs(value) != float("inf"):
            return f'<c r="{at}"><v>{value}</v></c>'
        return f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{escape(_BAD_XML.sub("", str(value)))}</t></is></c>'

    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
        office = "http://schemas.openxmlformats.org"
        z.writestr("[Content_Types].xml", f'{head}<Types xmlns="{office}/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>')
        z.writestr("_rels/.rels", f'{head}<Relationships xmlns="{office}/package/2006/relationships"><Relationship Id="rId1" Type="{office}/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'{head}<workbook xmlns="{office}/spreadsheetml/2006/main" xmlns:r="{office}/officeDocument/2006/relationships"><sheets><sheet name="{escape(sheet)}" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="{office}/package/2006/relationships"><Relationship Id="rId1" Type="{office}/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
        with z.open("xl/worksheets/sheet1.xml", "w") as f:
            f.write(f'{head}<worksheet xmlns="{office}/spreadsheetml/2006/main"><sheetData>'.encode())
            f.write(("<row r=\"1\">" + "".join(cell(f"{a}1", c) for a, c in zip(names, df.columns, strict=True)) + "</row>").encode())
            for n, row in enumerate((df.orderBy(*order) if order else df).toLocalIterator(), 2):
                f.write((f'<row r="{n}">' + "".join(cell(f"{a}{n}", v) for a, v in zip(names, row, strict=True)) + "</row>").encode())
            f.write(b"</sheetData></worksheet>")
    _put(spark, path, buffer.getvalue())
    return path


#: Rows of a list for people to read, at most.
SHORTLIST_ROWS = 100_000


def write_shortlist(df: DataFrame, stem: str, key: str, lines: list[tuple[str, str]], order: list[Column], title: str = "", lists: tuple[str, ...] = ()) -> list[str]:
    """The same short list as ``stem``.json, .csv and .md; returns their paths.

    ``lines``: (label, column) of what Markdown shows under each key; columns in ``lists`` are lists, joined by ``;`` in CSV
    and one line each in Markdown. More than ``SHORTLIST_ROWS`` rows is an error.
    """
    spark = df.sparkSession
    rows = df.orderBy(*order).limit(SHORTLIST_ROWS + 1).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j")).collect()
    if len(rows) > SHORTLIST_ROWS:
        raise ValueError(f"more than {SHORTLIST_ROWS} rows is no short list")
    items = [json.loads(r["j"]) for r in rows]
    _put(spark, f"{stem}.json", json.dumps(items, ensure_ascii=False, indent=2).encode())
    flat = df.select(*[F.array_join(c, ";").alias(c) if c in lists else F.col(c) for c in df.columns])
    write_single_csv(flat.orderBy(*order), f"{stem}.csv", bom=False)
    text = [f"# {title}\n"] if title else []
    for item in items:
        text.append(f"## {item[key]}\n")
        for label, column in lines:
            value = item.get(column)
            if column in lists:
                text += [f"- {label}:", *[f"  - {x}" for x in value or []]]
            else:
                text.append(f"- {label}: {'n/d' if value in (None, '') else value}")
        text.append("")
    _put(spark, f"{stem}.md", ("\n".join(text) + "\n").encode())
    return [f"{stem}.{end}" for end in ("json", "csv", "md")]


def crawl_report(pages: DataFrame, errors: DataFrame, seed: str, level: str, host: str, at: str, error_columns: list[str], last: int = 500) -> str:
    """A Markdown report: pages and hosts per seed and level, and the ``last`` errors, newest first. Seeds are a bounded list
    (``SHORTLIST_ROWS`` lines at most)."""
    table = pages.groupBy(seed, level).agg(F.count(F.lit(1)).alias("pages"), F.count_distinct(host).alias("hosts")).orderBy(seed, level).limit(SHORTLIST_ROWS + 1).collect()
    if len(table) > SHORTLIST_ROWS:
        raise ValueError(f"more than {SHORTLIST_ROWS} seeds and levels")
    newest = errors.orderBy(F.desc(at), *error_columns).limit(last).select(at, *error_columns).collect()
    cells = lambda values: "| " + " | ".join("" if v is None else str(v).replace("|", "\\|").replace("\n", " ") for v in values) + " |"
    out = ["# Pages", "", cells([seed, level, "pages", "hosts"]), "|---|---|---|---|", *map(cells, table), "", "# Errors", "", cells([at, *error_columns]), "|---" * (1 + len(error_columns)) + "|", *map(cells, newest)]
    return "\n".join(out) + "\n"


def run_summary(results: DataFrame, country: str, failed: Column, total: Column) -> tuple[str, int]:
    """(JSON of every country's total and whether it failed, exit code 1 if any did). Countries are a bounded list."""
    rows = results.groupBy(country).agg(F.bool_or(F.coalesce(failed, F.lit(False))).alias("failed"), F.sum(total).alias("total")).orderBy(country).limit(SHORTLIST_ROWS).collect()
    body = {str(r[country]): {"failed": r["failed"], "total": r["total"]} for r in rows}
    return json.dumps(body, ensure_ascii=False, sort_keys=True), int(any(r["failed"] for r in rows))


def keep_history(spark: SparkSession, path: str, day: str, folder: str = "history") -> str:
    """A dated copy of a small report beside it: ``history/<name>_<day>.<end>``; one of that day is replaced."""
    fs, at, conf = _files(spark, path)
    base, _, name = path.rpartition("/")
    stem, _, end = name.rpartition(".")
    target = f"{base}/{folder}/{stem}_{day}.{end}"
    to = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    if not spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, at, fs, to, False, True, conf):
        raise OSError(f"{path} could not be copied to {target}")
    return target


def write_run(df: DataFrame, root: str, country: str, run_id: str, fmt: str = "parquet") -> str:
    """One run's folder ``country=../run_id=..``; an existing one is an error, so nothing is overwritten."""
    path = f"{root}/country={country}/run_id={run_id}"
    df.write.mode("errorifexists").format(fmt).option("header", True).save(path)
    return path


def append_new(df: DataFrame, path: str, key: str) -> None:
    """Appends the rows whose key the target doesn't have yet. For one writer at a time: two that run together would both
    append what neither has seen."""
    spark = df.sparkSession
    try:
        done = spark.read.parquet(path).select(key)
    except Exception as e:  # the target doesn't exist before the first append
        if "PATH_NOT_FOUND" not in str(e):
            raise
        done = None
    (df if done is None else df.join(done.distinct(), key, "left_anti")).write.mode("append").parquet(path)


def latest_runs(runs: DataFrame) -> DataFrame:
    """Per country its latest run by update time, then id."""
    return runs.groupBy("country").agg(F.max_by("run_id", F.struct("updated", "run_id")).alias("run_id"), F.max("updated").alias("updated"))


def read_latest(spark: SparkSession, root: str, runs: DataFrame) -> DataFrame:
    """The tables of every country's latest run."""
    rows = spark.read.option("basePath", root).parquet(f"{root}/country=*")
    return rows.join(F.broadcast(latest_runs(runs).select("country", F.col("run_id").cast("string").alias("run_id"))), ["country", "run_id"], "left_semi")


def json_document(df: DataFrame, sections: dict[str, list[str]]) -> DataFrame:
    """One JSON text per row, columns grouped into sections."""
    return df.select(F.to_json(F.struct(*[F.struct(*cols).alias(name) for name, cols in sections.items()])).alias("document"))


def assembled_report(sections: dict[str, DataFrame | None]) -> DataFrame:
    """One JSON document of all sections: a section is the list of its frame's rows; sections without a frame are left out.

    Sections are results of aggregations, with few rows each: more than ``SHORTLIST_ROWS`` is an error."""
    for name, df in sections.items():
        if df is not None and df.limit(SHORTLIST_ROWS + 1).count() > SHORTLIST_ROWS:
            raise ValueError(f"section {name} has more than {SHORTLIST_ROWS} rows: write it as a table")
    parts = [(n, df.select(F.to_json(F.struct("*")).alias("j")).agg(F.array_sort(F.collect_list("j")).alias("rows")).withColumn("name", F.lit(n))) for n, df in sections.items() if df is not None]
    out = parts[0][1]
    for _, p in parts[1:]:
        out = out.unionByName(p)
    body = out.select(F.concat(F.lit('"'), "name", F.lit('":['), F.array_join("rows", ","), F.lit("]")).alias("s"))
    return body.agg(F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list("s")), ","), F.lit("}")).alias("document"))


def markdown_lines(df: DataFrame, template: str, columns: list[str]) -> DataFrame:
    """One Markdown line per row from a printf template."""
    return df.select(*columns, F.format_string(template, *columns).alias("line"))


def markdown_summary(values: dict[str, object], template: str) -> str:
    """A text with ``{slots}`` filled; slots without a value read n/d."""

    class Slots(dict):
        def __missing__(self, key: str) -> str:
            return "n/d"

    return template.format_map(Slots({k: v for k, v in values.items() if v is not None}))


def review_split(df: DataFrame, needs_review: Column) -> tuple[DataFrame, DataFrame]:
    """(rows to review, counters) of a classified table."""
    flag = F.coalesce(needs_review, F.lit(False))
    return df.filter(flag), df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(flag).alias("n_review"))
