"""Files in and out, configuration, and streams that restart."""

import bz2
import io
import json
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestrata.schemas import SITE_RECORD
from lodestrata.sources import config, files, sinks
from lodestrata.functions import html
from lodestrata.operators import joins, ranking, sets
from lodestrata.streaming import incremental


def test_decoding():
    assert files.decode_bytes("città".encode()) == ("città", "utf-8", 0) or files.decode_bytes("città".encode())[1] == "utf-8-sig"
    assert files.decode_bytes("Książ".encode("cp1250"), country="PL")[:2] == ("Książ", "cp1250")
    assert files.decode_bytes("città".encode("cp1252"))[:2] == ("città", "cp1252")
    assert files.decode_bytes(b"\x81\x8d")[2] == 2
    assert files.decode_bytes("Κεντρική Μακεδονία".encode("cp1253"))[:2] == ("Κεντρική Μακεδονία", "cp1253")
    assert files.detected_charset("Департамент культуры".encode("cp1251")) == "cp1251"


@pytest.mark.parametrize(
    ("raw", "header", "charset"),
    [
        ("\ufeffà".encode(), "text/html; charset=cp1252", "utf-8-sig"), ("à".encode("utf-16"), None, "utf-16"), (b"x", "text/html; charset=ISO-8859-1", "iso8859-1"), (b"<meta charset='windows-1250'>\xea", "text/html; charset=nonsense", "cp1250"),
        ("città".encode(), "text/html", "utf-8"), ("Δήμος Αθηναίων <p>".encode("cp1253"), None, "cp1253"), (b"", None, "utf-8"), (b"\x81", None, "utf-8"), (b'<meta http-equiv="x" content="text/html; charset=utf-8">\xff', "", "utf-8"),
    ],
)
def test_charset_guess(raw, header, charset):
    assert files.guess_charset(raw, header) == charset


def test_csv_and_encodings(spark, tmp_path):
    p = tmp_path / "siti.csv"
    p.write_text(";".join(SITE_RECORD.fieldNames()) + '\nwww.a.example;x;"Ente; ""uno""\ndue";;;;;;;;;;;;\n')
    row = files.read_csv(spark, str(p), SITE_RECORD).first()
    assert row["hostname"] == "www.a.example" and row["nome_ente"] == 'Ente; "uno"\ndue'
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.csv").write_bytes("Książ".encode("cp1250"))
    assert files.read_text_any_encoding(spark, str(tmp_path / "raw"), country="PL").first()["text"] == "Książ"


def workbook(rows):
    cells = "".join(f'<row r="{i}">' + "".join(f'<c r="{c}{i}" t="inlineStr"><is><t>{v}</t></is></c>' for c, v in zip("ABC", r, strict=False)) + "</row>" for i, r in enumerate(rows, 1))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{cells}</sheetData></worksheet>')
    return out.getvalue()


def test_workbooks(spark, tmp_path):
    for n in ("a", "b"):
        (tmp_path / f"{n}.xlsx").write_bytes(workbook([["nome", "sito"], [f"Ente {n}", "x.example"], ["", ""]]))
    rows = files.read_sheets(spark, str(tmp_path / "*.xlsx"), {"nome": "A", "sito": "B"}).orderBy("source_file").collect()
    assert [(r["source_file"], r["nome"], r["sito"]) for r in rows] == [("a.xlsx", "Ente a", "x.example"), ("b.xlsx", "Ente b", "x.example")]


def test_xml_json_archives(spark, tmp_path):
    (tmp_path / "r.xml").write_text("<l><o><n>Uno</n><u>a.example</u></o><o><n>Due</n></o></l>")
    assert [tuple(r) for r in files.read_xml(spark, str(tmp_path / "r.xml"), "o", StructType().add("n", "string").add("u", "string")).collect()] == [("Uno", "a.example"), ("Due", None)]
    text = spark.range(1).select(files.first_text(F.lit("<o><contact><url>no</url></contact><ns:url> a.example </ns:url></o>"), ["web", "url"], ["contact"]).alias("x")).first()["x"]
    assert text == "a.example"
    (tmp_path / "pages").mkdir()
    for i, page in enumerate(['{"d":{"r":[{"a":"1"},{"a":"2"}]}}', '{"d":{"r":[{"a":"1"},{"a":"2"}]}}', '{"d":{"r":[]}}']):
        (tmp_path / "pages" / f"{i}.json").write_text(page)
    schema = StructType.fromDDL("d struct<r:array<struct<a:string>>>")
    assert files.read_json_pages(spark, str(tmp_path / "pages"), schema, "d.r").count() == 2
    with pytest.raises(ValueError, match="fewer"):
        files.read_json_pages(spark, str(tmp_path / "pages"), schema, "d.r", min_records=3)
    (tmp_path / "n.ndjson").write_text('{"a":"1"}\n\noops\n{"a":"2"}\n')
    good, bad = files.read_ndjson(spark, str(tmp_path / "n.ndjson"), StructType().add("a", "string"))
    assert good.count() == 2 and bad.count() == 1
    tar = io.BytesIO()
    with tarfile.open(fileobj=tar, mode="w") as t:
        for name, body in (("a.json", '{"service":[{"x":1},{"x":2}]}'), ("b.json", '{"x":3}\nbad\n{"x":4}')):
            info = tarfile.TarInfo(name)
            info.size = len(body)
            t.addfile(info, io.BytesIO(body.encode()))
    (tmp_path / "r.tar.bz2").write_bytes(bz2.compress(tar.getvalue()))
    records = files.read_archives(spark, str(tmp_path / "r.tar.bz2")).collect()
    assert sorted(json.loads(r["record"])["x"] for r in records) == [1, 2, 3, 4]


def test_checkpoints_seeds_and_choice(spark, tmp_path):
    for c, body in (("IT", '{"n":"1"}'), ("FR", "{broken")):
        d = tmp_path / f"country={c}"
        d.mkdir()
        (d / "c.json").write_text(body)
    good, bad = files.read_checkpoints(spark, str(tmp_path), StructType().add("n", "string"))
    assert [(r["country"], r["n"]) for r in good.collect()] == [("IT", "1")] and [tuple(r) for r in bad.collect()] == [("FR", "c.json")]
    (tmp_path / "seeds.txt").write_text("# x\n\nhttps://a.example\n https://b.example \n")
    assert [r["url"] for r in files.read_seeds(spark, str(tmp_path / "seeds.txt")).orderBy("ord").collect()] == ["https://a.example", "https://b.example"]
    a, b = spark.createDataFrame([("",)], "h string"), spark.createDataFrame([("x",)], "h string")
    assert files.first_with_rows(a, b, "h").first()["h"] == "x"
    nested = spark.createDataFrame([((("v",),),)], "a struct<b:struct<c:string>>")
    assert files.select_paths(nested, {"out": "a.b.c"}, country="IT").first().asDict() == {"out": "v", "country": "IT"}


def test_config(spark):
    pytest.importorskip("yaml")
    data, twice = config.load_text("a: 1\nb: {c: 2}\na: 3\n")
    assert data == {"a": 3, "b": {"c": 2}} and twice == ["a"]
    assert config.load_text('{"a": 1, "a": 2}') == ({"a": 2}, ["a"])
    assert config.merged({"a": {"b": 1, "c": 2}, "l": [1]}, {"a": {"b": 9}, "l": [2]}) == {"a": {"b": 9, "c": 2}, "l": [2]}
    rules = config.rule_table(spark, [{"pattern": "Foo", "v": "x"}, {"pattern": "bar", "v": None}], ["pattern", "v"])
    assert [tuple(r) for r in rules.orderBy("rule_order").collect()] == [(0, "foo", "x"), (1, "bar", None)]
    assert config.keyword_lists({"c": {"it": ["Comune di", "x"], "fr": ["x"]}}) == {"c": ["comune di", "x"]}
    with pytest.raises(ValueError, match="unknown"):
        config.checked_types({"zz": []}, ("comune",))


def test_runs(spark, tmp_path):
    root = str(tmp_path / "runs")
    for run in ("2026-01-01", "2026-01-02"):
        sinks.write_run(spark.createDataFrame([(run,)], "v string"), root, "IT", run)
    with pytest.raises(Exception, match="(?i)exist"):
        sinks.write_run(spark.createDataFrame([("x",)], "v string"), root, "IT", "2026-01-01")
    runs = spark.createDataFrame([("IT", "2026-01-01", "1"), ("IT", "2026-01-02", "2")], "country string, run_id string, updated string")
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    assert [r["v"] for r in sinks.read_latest(spark, root, runs).collect()] == ["2026-01-02"]
    spark.conf.unset("spark.sql.sources.partitionColumnTypeInference.enabled")
    target = str(tmp_path / "app")
    for _ in range(2):
        sinks.append_new(spark.createDataFrame([(1,), (2,)], "k int"), target, "k")
    assert spark.read.parquet(target).count() == 2


def test_single_files(spark, tmp_path):
    rows = [(1, 'a "b", c', None), (2, "due\nrighe", "x"), (3, "\tq ", "")]
    df = spark.createDataFrame(rows, "n int, t string, u string")
    p = f"file://{tmp_path}/out.csv"
    for _ in range(2):
        assert sinks.write_single_csv(df.repartition(3), p, order=["n"]) == p
    raw = (tmp_path / "out.csv").read_bytes()
    assert raw.startswith(b"\xef\xbb\xbfn,t,u\n") and raw.count(b"n,t,u") == 1 and not list(tmp_path.glob("*.parts")) and not list(tmp_path.glob("*tmp"))
    import csv

    assert [r[1] for r in list(csv.reader(raw.decode("utf-8-sig").splitlines(keepends=True)))[1:]] == [r[1] for r in rows]
    book = f"file://{tmp_path}/b.xlsx"
    sinks.write_xlsx(df, book, ["n"])
    assert [tuple(r) for r in files.read_sheets(spark, book, {"n": "A", "t": "B"}).select("n", "t").orderBy("n").collect()] == [(str(n), t) for n, t, _ in rows]
    assert sinks.backup_existing(spark, f"file://{tmp_path}/none") is None
    moved = sinks.backup_existing(spark, p, "S")
    assert moved.endswith("/out_backup-S.csv") and (tmp_path / "out_backup-S.csv").exists() and not (tmp_path / "out.csv").exists()
    lists = spark.createDataFrame([("d", 2, ["p1", "p2"]), ("e", None, [])], "k string, s int, pages array<string>")
    paths = sinks.write_shortlist(lists, f"file://{tmp_path}/l", "k", [("Score", "s"), ("Pages", "pages")], [F.desc_nulls_last("s")], "List", ("pages",))
    text = (tmp_path / "l.md").read_text()
    assert len(paths) == 3 and text.index("## d") < text.index("## e") and "- Score: n/d" in text and "  - p2" in text
    assert json.loads((tmp_path / "l.json").read_text())[0]["pages"] == ["p1", "p2"] and (tmp_path / "l.csv").read_text().splitlines()[1] == "d,2,p1;p2"
    copy = sinks.keep_history(spark, f"file://{tmp_path}/l.json", "2026-01-02")
    assert copy.endswith("history/l_2026-01-02.json") and (tmp_path / "history" / "l_2026-01-02.json").exists()


def test_reports(spark, monkeypatch):
    log = spark.createDataFrame([("s", 1, "h", None, 1), ("s", 1, "g", "bad|x", 2), ("t", 2, None, "", 3)], "seed string, level int, host string, e string, at int")
    report = sinks.crawl_report(log, log.filter("e <> ''"), "seed", "level", "host", "at", ["host", "e"])
    assert "| s | 1 | 2 | 2 |" in report and "bad\\|x" in report
    body, code = sinks.run_summary(log, "seed", F.col("e") == "bad|x", F.lit(1))
    assert json.loads(body) == {"s": {"failed": True, "total": 2}, "t": {"failed": False, "total": 1}} and code == 1
    monkeypatch.setattr(sinks, "SHORTLIST_ROWS", 1)
    with pytest.raises(ValueError, match="more than"):
        sinks.assembled_report({"x": log})


def test_xml_texts(spark):
    rows = [(1, "<r><c><n>no</n></c><a><n>deep</n></a><N> own </N></r>"), (2, "<r><n/><x:m xmlns:x='u'>other</x:m></r>"), (3, "<broken"), (4, None)]
    got = files.xml_first_texts(spark.createDataFrame(rows, "i int, x string"), "i", "x", {"t": ["n", "m"]}, ["C"]).orderBy("row_id").collect()
    assert [r["t"] for r in got] == ["own", "other", "", ""]


def test_selectors(spark):
    page = "<div id=l><ul><li class='e f'><a href=u1 title='x'>A &amp; <b>b</b></a><p>1</p></li><li>no</li><li class=e data-k=v><p>2<br>3</p></ul></div>"
    df = spark.createDataFrame([(1, page), (2, None), (3, "<p>unclosed")], "i int, h string")
    got = html.select_fields(df, "i", "h", "#l li.e", {"t": "a", "u": "a[title=x]::attr(href)", "p": "p::text", "k": "::attr(data-k)"}).orderBy("position").collect()
    assert [tuple(r) for r in got] == [(1, 0, "A & b", "u1", "1", ""), (1, 1, "", "", "23", "v")]
    with pytest.raises(ValueError, match="not understood"):
        html.select_fields(df, "i", "h", "li > a", {})


def test_sets_and_results(spark):
    rows = spark.createDataFrame([("g", "b", 1), ("g", "a", 2), ("g", "b", 3), (None, "z", 4), ("g", None, 0), (None, "y", 4)], "g string, v string, o int")
    assert {tuple(r) for r in sets.ordered_distinct(rows, ["g"], "v", ["o"]).collect()} == {("g", "b", 1), ("g", "a", 2), (None, "y", 1), (None, "z", 2)}
    many = spark.range(5000).select(F.when(F.col("id") < 3000, "hot").otherwise(F.col("id").cast("string")).alias("g"), F.col("id").cast("string").alias("v"), "id")
    hot = sets.ordered_distinct(many.repartition(5), ["g"], "v", ["id"]).filter("g = 'hot'")
    assert hot.filter(F.col("position") != F.col("v").cast("int") + 1).isEmpty() and hot.count() == 3000
    both = sets.side_by_side(spark.createDataFrame([(0, "a"), (1, "b")], "i int, x string"), spark.createDataFrame([(1, "c"), (2, "d")], "i int, x string"), "i")
    assert {tuple(r) for r in both.collect()} == {(0, "a", None), (1, "b", "c"), (2, None, "d")}
    out = joins.attach_results(spark.createDataFrame([(1, "old"), (2, "old"), (3, None)], "i int, n string"), "i", spark.createDataFrame([(1, "h"), (2, "k"), (None, "h")], "i int, host string"), spark.createDataFrame([("h", "new")], "host string, n string"), "host", ["n"], "none")
    assert {tuple(r) for r in out.collect()} == {(1, "new"), (2, "none"), (3, "none")}
    left = ranking.quota_left(spark.createDataFrame([("2026-01-01 10:00:00",), ("2025-12-31 10:00:00",), (None,)], "t string"), "t", F.lit("2026-01-01"), 1).first()
    assert tuple(left) == (1, 0)


def test_cooldown(spark, tmp_path):
    log = [("h", i, r) for i, r in enumerate(["error", "error", "error", "ok", "ok", "dead", "error", "error", "error"])] + [("g", 20, "ok"), (None, 1, "error")]
    df = spark.createDataFrame(log, "host string, seq long, r string")
    df.repartition(3).write.parquet(str(tmp_path / "log"))
    states = incremental.host_cooldown(spark.readStream.schema(df.schema).parquet(str(tmp_path / "log")), "host", "seq", "r", after_errors=2, retries=2, pause=10, forgive_after=2)
    got = {(r["host"], r["seq"]): (r["outcome"], r["retries"]) for r in run_stream(spark, states, "cool", "append")}
    assert [got["h", i] for i in range(9)] == [("given_up", 0), ("paused", 1), ("paused", 2), ("ok", 2), ("ok", 1), ("dead", 1), ("paused", 2), ("given_up", 2), ("given_up", 2)] and got["g", 20] == ("ok", 0)


def test_documents(spark):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    assert json.loads(sinks.json_document(df, {"x": ["n"], "y": ["s"]}).first()["document"]) == {"x": {"n": 1}, "y": {"s": "a"}}
    assert json.loads(sinks.assembled_report({"one": df, "absent": None, "two": df}).first()["document"]) == {"one": [{"n": 1, "s": "a"}], "two": [{"n": 1, "s": "a"}]}
    assert sinks.markdown_lines(df, "- %s (%d)", ["s", "n"]).first()["line"] == "- a (1)"
    assert sinks.markdown_summary({"a": 1, "b": None}, "{a} {b}") == "1 n/d"
    review, counters = sinks.review_split(df, F.col("n") == 1)
    assert review.count() == 1 and counters.first()["n_review"] == 1


def test_stream_restarts_without_repeats(spark, tmp_path):
    src, dst = str(tmp_path / "in"), str(tmp_path / "out")
    schema = StructType.fromDDL("id long, ts timestamp")
    day = lambda ids: spark.createDataFrame([(i,) for i in ids], "id long").withColumn("ts", F.lit("2026-01-01 10:00:00").cast("timestamp"))
    for ids in ([1, 2], [2, 3]):
        day(ids).write.mode("append").parquet(src)
        incremental.ingest(spark, src, schema, dst, str(tmp_path), {"v": 1}, ["id"], "ts").awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(dst).collect()) == [1, 2, 3]
    assert incremental.checkpoint_for(spark, "n", {"v": 1}) != incremental.checkpoint_for(spark, "n", {"v": 2})


def run_stream(spark, df, name, mode):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name).collect()


def test_daily_counts_and_ttl(spark, tmp_path):
    rows = [("k", "a", "2026-01-01 10:00:00"), ("k", "b", "2026-01-01 11:00:00"), ("k", "old", "2026-01-01 09:00:00"), ("m", "c", "2026-01-02 10:00:00")]
    df = spark.createDataFrame(rows, "key string, value string, t string").withColumn("ts", F.to_timestamp("t"))
    src = str(tmp_path / "s")
    df.coalesce(1).write.parquet(src)
    stream = lambda: spark.readStream.schema(df.schema).parquet(src)
    assert {(str(r["day"]), r["n"]) for r in run_stream(spark, incremental.daily_counts(stream(), "ts"), "daily", "complete")} == {("2026-01-01", 3), ("2026-01-02", 1)}
    latest = run_stream(spark, incremental.latest_with_ttl(stream(), "key", "ts", "value", "30 days"), "ttl", "update")
    assert {(r["key"], r["value"], r["live"]) for r in latest} == {("k", "b", True), ("m", "c", True)}
    wins = run_stream(spark, incremental.windowed(stream(), "ts", "1 hour", None, ["key"]), "win", "complete")
    assert sum(r["n"] for r in wins) == 4
