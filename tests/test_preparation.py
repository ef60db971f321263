"""Packed cells, line quarantine and field drift: brute force on odd inputs, and defined results at the edges."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lodestrata.operators import drift, packed, quarantine
from lodestrata.plans.problems import RECORD_RULES, SIGNAL_KINDS


def split(spark, cell, grammar):
    df = spark.createDataFrame([(1, cell)], "id long, cell string")
    return [r["value"] for r in packed.split_packed(df, "id", "cell", grammar).orderBy("position").collect()]


@pytest.mark.parametrize(
    ("cell", "expected"),
    [
        ("a.example;https://b.example/x", ["a.example", "https://b.example/x"]),
        ('"https://a.example/area;jsessionid=1?v=1|2"|b.example', ["https://a.example/area;jsessionid=1?v=1|2", "b.example"]),
        ("https://a.example/atti,55,628.html, b.example", ["https://a.example/atti,55,628.html", "b.example"]),
        ("http://a.example/portal/ | b.example |", ["http://a.example/portal/", "b.example"]),
        (" 'a.example'\n\n'b.example' ", ["a.example", "b.example"]),
        ("a.example a.example", ["a.example", "a.example"]),
        ("https://a.example/area;jsessionid=D6", ["https://a.example/area;jsessionid=D6"]),
        ('"https://a.example/x?tag=a, b", c.example', ["https://a.example/x?tag=a, b", "c.example"]),
        (";;, |", []), ("", []), (None, []),
    ],
)
def test_hosts(spark, cell, expected):
    assert split(spark, cell, packed.HOSTS) == expected


@pytest.mark.parametrize(
    ("cell", "expected"),
    [
        ("scuola:17/universita:1", ["scuola:17", "universita:1"]),
        ("'giustizia:1'//universita:1", ["giustizia:1", "universita:1"]),
        ("polizia; carabinieri:1", ["polizia; carabinieri:1"]),
        ('"regione, provincia:1";comune:2', ["regione, provincia:1", "comune:2"]),
        ("regione:12 provincia:1 comune:1", ["regione:12", "provincia:1", "comune:1"]),
        ("sanita:8; ; regione:4;", ["sanita:8", "regione:4"]),
        ("comune: 2.5; scuola: 1.5", ["comune: 2.5", "scuola: 1.5"]), ("comune:2,5, scuola:1,25;asl:3", ["comune:2,5", "scuola:1,25", "asl:3"]), ("comune:1,scuola:2", ["comune:1", "scuola:2"]),
        ("a:12345678901234567890; b:-1", ["a:12345678901234567890", "b:-1"]), ("'comune:1" + " " * 50 + "';scuola:2", ["comune:1", "scuola:2"]), ("via 3, regione:2;x:1", ["via 3, regione:2", "x:1"]),
    ],
)
def test_scores(spark, cell, expected):
    assert split(spark, cell, packed.SCORES) == expected


@pytest.mark.parametrize(
    ("cell", "expected"),
    [
        ('commerciale:sconto "estate", saldi', ['commerciale:sconto "estate", saldi']),
        ('"commerciale:sconto ""estate"", saldi";forma_societaria:a/s', ['commerciale:sconto "estate", saldi', "forma_societaria:a/s"]),
        ("commerciale:l'offre du jour; -20%, forma_societaria:ag", ["commerciale:l'offre du jour; -20%", "forma_societaria:ag"]),
        ("commerciale:spedizione 24/48h / forma_societaria:gmbh & co. kg", ["commerciale:spedizione 24/48h", "forma_societaria:gmbh & co. kg"]),
    ],
)
def test_signals(spark, cell, expected):
    assert split(spark, cell, packed.kinds(*SIGNAL_KINDS)) == expected


def test_open_kinds(spark):
    assert split(spark, "premio:oro; commerciale:a, b / altro_tipo:x", packed.kinds()) == ["premio:oro", "commerciale:a, b", "altro_tipo:x"]
    assert split(spark, "premio:oro; commerciale:a", packed.kinds("commerciale")) == ["premio:oro", "commerciale:a"]


def test_random_round_trip(spark):
    rng = random.Random(5)
    values = ["forma_societaria:s.r.l.", "commerciale:achat | vente", "commerciale:l'offre; -2%", "forma_societaria:a/s", 'commerciale:x "y", z']
    rows, expected = [], []
    for i in range(200):
        chosen = [rng.choice(values) for _ in range(rng.randrange(1, 6))]
        sep = rng.choice([";", "; ", " | ", "|", ",", "\n", " / ", ";;"])
        written = ['"' + v.replace('"', '""') + '"' if rng.random() < 0.5 else v for v in chosen]
        rows.append((i, sep.join(written)))
        expected += [(i, p, v, len(chosen)) for p, v in enumerate(chosen, 1)]
    df = spark.createDataFrame(rows, "id long, cell string")
    got = packed.split_packed(df, "id", "cell", packed.kinds(*SIGNAL_KINDS)).select("row_id", "position", "value", "n_values").collect()
    assert sorted(map(tuple, got)) == sorted(expected)


HEAD = "hostname;codice_ipa;nome_ente"


def reasons(spark, lines, header=HEAD):
    df = spark.createDataFrame([(0, "f", 1, header)] + [(i, "f", i + 1, x) for i, x in enumerate(lines, 1)], "raw_id long, source_file string, line_no int, raw_line string")
    out = quarantine.quarantine(df, "raw_id", "source_file", "line_no", "raw_line", RECORD_RULES, HEAD)
    return {r["id"]: r["reason"] for r in out.collect()}, out


def test_reasons(spark):
    lines = {
        'a.example;c_ab12;"x;y"': None, 'a.example;c_ab12;"x ""q"" y"': None, ";c_ab12;": None, ";;": "codice_ipa", "a.example;;": "codice_ipa", "a.example; \t ;": "codice_ipa", 'https://a.example:8443/p?x=1#f;"";z': "codice_ipa", " ;C_AB12;z": None, '"";c_ab12;': None, 'https://a.example:8443/p?x=1#f;"c_ab12";z': None, "a.example.;3473f5b9-0998-4fce-a347-552649fa12ed;": None,
        'a.example;;"open': "quoting", 'a.example;;Coll"ege': "quoting", 'a.example;; "x"': "quoting", 'a.example;;"x"y': "quoting",
        "a.example;": "column_count", "": "column_count", None: "column_count", "a.example;;x;y": "column_count", 'a.example;c_ab12;"two\nlines"': None,
        "n/d;;": "hostname", "https://;;": "hostname", "www..a.example;;": "hostname", "http:/a.example;;": "hostname", "mailto:x@a.example;;": "hostname", "-a.example;;": "hostname",
        "x" * 64 + ".example;;": "hostname", "a_b.example;;": "hostname", ".".join(["abcdefgh"] * 30) + ";;": "hostname", " a.example ; c_ab12 ;": None,
        "a.example;c_ab;": "codice_ipa", "a.example;n/d;": "codice_ipa", "a.example;abcdefg_123;": "codice_ipa", "n/d;n/d;": "hostname",
    }
    got, _ = reasons(spark, list(lines))
    assert [(x, got[i]) for i, x in enumerate(lines, 1)] == list(lines.items())


def test_header_shapes(spark):
    rows = [
        (1, "a", 1, '﻿"codice_ipa"\t"hostname"\t"altro"'), (2, "a", 2, '"c_ab12"\t"x.example"\t"y"'), (3, "b", 1, "hostname|codice_ipa"), (4, "b", 2, "|c_ab12"),
        (5, "c", 2, "x.example;c_ab12;n"), (6, "a", 1, "hostname"), (7, None, None, "x.example;c_ab12;"), (8, "d", 1, "hostname;nome_ente"), (9, "d", 2, "y.example;n"),
    ]
    df = spark.createDataFrame(rows, "raw_id long, source_file string, line_no int, raw_line string").withColumn("line", F.lit(1)).withColumn("id", F.lit("clash"))
    out = quarantine.quarantine(df, "raw_id", "source_file", "line_no", "raw_line", RECORD_RULES, HEAD)
    assert all(r["reason"] is None for r in out.collect())
    records = {r["raw_id"]: (r["hostname"], r["codice_ipa"], r["nome_ente"]) for r in quarantine.valid_records(out, ["hostname", "codice_ipa", "nome_ente"]).collect()}
    assert records == {2: ("x.example", "c_ab12", None), 4: ("", "c_ab12", None), 5: ("x.example", "c_ab12", "n"), 7: ("x.example", "c_ab12", ""), 9: ("y.example", None, "n")}


def test_empty_tables(spark):
    lines = spark.createDataFrame([], "raw_id long, source_file string, line_no int, raw_line string")
    assert quarantine.quarantine(lines, "raw_id", "source_file", "line_no", "raw_line", RECORD_RULES, HEAD).count() == 0
    files = spark.createDataFrame([], "file_id long, serie string, run_ts timestamp, payload string")
    schemas = drift.file_schemas(files, "file_id", "serie", "run_ts", "payload")
    assert drift.learn_names(schemas) == {} and drift.field_changes(schemas, {}).count() == 0
    fields = drift.union_fields(files, "file_id", "serie", "run_ts", "payload", {})
    assert fields.count() == 0 and drift.consistent_table(fields).count() == 0 and drift.appearing_alternatives(fields).count() == 0


def sequential(files, names):
    """Field changes by one pass over sorted files."""
    out, prev, last = [], None, {}
    for series, _, fid, payload in sorted(files, key=lambda f: f[:3]):
        d = drift.read_object(payload)
        if d is None:
            continue
        now = drift.schema_of(d)
        if prev is None or prev[0] != series:
            last = dict(now)
        else:
            changes, onward = drift.compare(prev[1], now, names)
            out += [(fid, k.replace(drift.SEP, "."), c) for k, c in changes]
            fresh = {}
            for k, t in now.items():
                before = last[onward[k]] if k in onward else None
                if t and before and t != before:
                    out.append((fid, k.replace(drift.SEP, "."), "type_changed"))
                fresh[k] = t or before
            last = fresh
        prev = (series, now)
    return sorted(out)


def pairs_of(files):
    """Pairs of names that change places, by one pass over sorted files."""
    found, prev, last = drift._Handovers(), None, {}
    for series, _, _, payload in sorted(files, key=lambda f: f[:3]):
        d = drift.read_object(payload)
        if d is None:
            continue
        now = drift.prints_of(d)
        if prev is not None and prev[0] == series:
            found.step(last, set(prev[1]), now)
        else:
            last = {}
        last = {k: v or last.get(k, []) for k, v in now.items()}
        prev = (series, now)
    return found


@pytest.mark.parametrize("partitions", [1, 3, 9])
def test_drift_in_segments(spark, partitions):
    rng = random.Random(partitions)
    names = [["n_regole", "n_rules", "regole_n"], ["resume", "is_resume"], ["scartate_path", "path_scartate"], ["os"], ["note_operatore"]]
    files = []
    for s in ("A", "B", "C"):
        used = {0: 0, 1: 0, 2: 0}
        for i in range(60 if s == "A" else 6):
            d = {}
            for c in list(used):
                if rng.random() < 0.08:
                    del used[c]
            for c in range(5):
                if c not in used and rng.random() < 0.1:
                    used[c] = 0
                if c in used:
                    if rng.random() < 0.15:
                        used[c] = rng.randrange(len(names[c]))
                    d[names[c][used[c]]] = rng.choice([1, 1, 1, "x", None, 2.5, True, [1], [{"q": 1}, {"q": "z"}], {"a": 1}, {"a": "x", "b": 1}, {"a": None}])
            files.append((s, f"2026-01-{1 + i // 3:02d} 00:00:00", len(files), rng.choice(["", "\ufeff "]) + json.dumps(d) if rng.random() > 0.05 else rng.choice(["[1]", "{", None])))
    df = spark.createDataFrame(files, "serie string, ts string, file_id long, payload string").withColumn("run_ts", F.to_timestamp("ts")).withColumn("series", F.lit("clash"))
    schemas = drift.file_schemas(df, "file_id", "serie", "run_ts", "payload")
    fields = {n: ns[0] for ns in names for n in ns}
    got = drift.field_changes(schemas, fields, partitions).select("file_id", "field", "change").collect()
    assert sorted(map(tuple, got)) == sequential(files, fields) and any("." in r["field"] for r in got)
    found, learned = pairs_of(files), drift.learn_names(schemas, partitions)
    scores = {p: drift.name_likeness(*p) + (found.agreed[p] / found.compared[p] if found.compared[p] else 0) for p in found.pairs}
    good = {p: x for p, x in scores.items() if x >= drift.LEAST}
    sets_ = [set(d) for *_, p in files if (d := drift.read_object(p))]
    both = {(a, b): sum(a in x and b in x for x in sets_) for a in fields for b in fields if a < b}
    assert learned == drift.joined_names([(*p, x) for p, x in good.items()], {n: sum(n in x for x in sets_) for n in fields}, both)


def test_names_of_one_field_are_learned(spark):
    """Renames without a common word, with another type, and at the time of an unrelated change; fields that stand together stay apart."""
    rng, files = random.Random(3), []
    spellings = {"misure": ["misure", "measurements"], "righe": ["n_righe", "nRows", "rows_n"], "percorso": ["out_path", "file_uscita"], "regole": ["n_regole", "n_rules"], "regole_c": ["n_cookie_regole"], "limite": ["limite_s"], "note": ["note"]}
    for s in range(40):
        used, present = {k: rng.randrange(len(v)) for k, v in spellings.items()}, {k for k in spellings if rng.random() < 0.9}
        for i in range(12):
            for k, v in spellings.items():
                if rng.random() < 0.1:
                    used[k] = rng.randrange(len(v))
                if rng.random() < 0.08:
                    present ^= {k}
            n = 1000 + 10 * i
            values = {"misure": {"cookie": i % 2 == 0, "terze_parti": True}, "righe": rng.choice([n, str(n), float(n), f"{n // 1000}'{n % 1000:03d}", {"totale": n}, None]), "percorso": rng.choice([f"data/{i}/scarti.csv", f"data\\{i}\\scarti.csv", [f"data/{i}/scarti.csv"]]), "regole": 31, "regole_c": 34, "limite": 10.0, "note": "rete lenta"}
            files.append((f"s{s}", i, len(files), json.dumps({spellings[k][used[k]]: values[k] for k in sorted(present)})))
    df = spark.createDataFrame(files, "serie string, t int, file_id long, payload string").withColumn("run_ts", F.timestamp_seconds("t"))
    learned = drift.learn_names(drift.file_schemas(df, "file_id", "serie", "run_ts", "payload"))
    groups = {frozenset(n for n, f in learned.items() if f == x) for x in learned.values()}
    assert groups == {frozenset(v) for v in spellings.values() if len(v) > 1}


@pytest.mark.parametrize(
    ("a", "b", "alike"),
    [
        ("n_hostname_normalizzati", "nHostnameNormalizzati", 1.0), ("N-HOSTNAME-NORMALIZZATI", "hostname_normalizzati_n", 1.0), ("pythonVersion", "python_version", 1.0), ("misurazioni", "timeout", 0.0), ("x", "x", 1.0), ("", "y", 0.0),
    ],
)
def test_name_likeness(a, b, alike):
    assert drift.name_likeness(a, b) == alike


@pytest.mark.parametrize(
    ("value", "text"),
    [
        (1904.0, "1904"), ("1'904", "1904"), ("1 904", "1904"), ("1.904", "1.904"), ("12.500", "12.500"), ("1.904.000", "1904000"), (2.5, "2.5"), (True, "true"), (None, None), (["a"], "a"),
        ({"x": 1}, '{"x": 1}'), ({"path": "a\\b"}, "a/b"), (float("nan"), "nan"), ([], "[]"),
    ],
)
def test_canonical_values(value, text):
    assert drift.canonical_value(value, ("path",)) == text


def union(spark, rows, names):
    df = spark.createDataFrame(rows, "file_id long, serie string, payload string").withColumn("run_ts", F.timestamp_seconds("file_id"))
    return drift.union_fields(df, "file_id", "serie", "run_ts", "payload", names, ("path",))


def test_union_table(spark):
    rows = [(1, "A", '{"n_regole": 31, "resume": true}'), (2, "A", '{"regole_n": "1.904", "resume": null}'), (3, "A", "oops"), (4, "A", '{"n_rules": 31.0, "x": {"path": "a\\\\b"}, "readable": "1.904"}')]
    fields = union(spark, rows, dict.fromkeys(("n_regole", "n_rules", "regole_n"), "n_regole"))
    wide = {r["file_id"]: r.asDict() for r in drift.consistent_table(fields).collect()}
    assert [wide[i]["n_regole"] for i in (1, 2, 3, 4)] == ["31", "1904", None, "31"]
    assert [wide[i]["n_regole__type"] for i in (1, 2, 4)] == ["integer", "string", "number"]
    assert wide[4]["x"] == "a/b" and wide[3]["readable"] is False and wide[2]["resume__type"] == "null" and wide[4]["readable_"] == "1.904"
    assert {r["type"] for r in drift.union_schema(fields).filter("concept = 'n_regole'").collect()} == {"integer", "string", "number"}
    with pytest.raises(ValueError, match="more than"):
        drift.consistent_table(fields, max_columns=1)


def test_alternatives_of_nested_paths(spark):
    rows = [(1, "A", '{"cfg": {"x": 1, "l": [1, "a", null]}}'), (2, "A", '{"cfg": {"x": "one", "l": []}}'), (3, "A", '{"cfg": 5}'), (4, "B", '{"cfg": {"x": "two"}}')]
    fields = union(spark, rows, {})
    got = {tuple(r) for r in drift.appearing_alternatives(fields).collect()}
    assert got == {("A", "cfg", "integer", 3, "object", 1), ("A", "cfg.x", "string", 2, "integer", 1), ("A", "cfg.l.[]", "string", 1, "integer", 1)}
    df = spark.createDataFrame(rows, "file_id long, serie string, payload string").withColumn("run_ts", F.timestamp_seconds("file_id"))
    changes = drift.field_changes(drift.file_schemas(df, "file_id", "serie", "run_ts", "payload"), {}).select("file_id", "field", "level", "change", "before", "after").collect()
    assert {tuple(r) for r in changes} == {(2, "cfg.x", 2, "type_changed", "integer", "string"), (2, "cfg.l.[]", 3, "removed", None, None), (3, "cfg", 1, "type_changed", "object", "integer")}


def test_very_long_inputs(spark):
    cells = ['"https://a.example/x?y=' + "z;" * 100_000 + '"|b.example', "'https://a.example/" + "''q" * 50_000 + "'|b.example", " " * 100_000 + "a.example ; b.example" + ";" * 100_000, "a.example" + ";" * 100_000 + "?" + ";" * 100_000 + "b.example", "a." * 50_000 + "example;b.example"]
    assert [len(split(spark, c, packed.HOSTS)) for c in cells] == [2, 2, 2, 2, 2]
    assert len(split(spark, ";".join(f"c{i}:1" for i in range(20_000)), packed.SCORES)) == 20_000
    assert split(spark, '"' + "x;" * 50_000 + 'y:1"|b:' + "9" * 50_000 + "|c:2", packed.SCORES) == ["x;" * 50_000 + "y:1", "b:" + "9" * 50_000, "c:2"]
    lines = {'a.example;c_ab12;"' + '""x' * 100_000 + '"': None, ";" * 100_000: "column_count", '"' * 100_001: "quoting", ".".join(["a"] * 50_000) + ";;": "hostname", "a.example/" + "p" * 300_000 + ";c_ab12;": None, " " * 100_000 + "a.example;c_ab12;": None}
    got, _ = reasons(spark, list(lines))
    assert [got[i] for i in range(1, 7)] == list(lines.values())


def test_several_keys_of_one_field_in_a_file(spark):
    payloads = ['{"resume": null, "is_resume": true, "n_rules": "x9", "n_regole": 12, "paese": "IT"}', '{"n_rules": 7}', "no object"]
    fields = union(spark, [(i, "s", p) for i, p in enumerate(payloads)], {"resume": "resume", "is_resume": "resume", "n_rules": "rules", "n_regole": "rules"})
    got = {r["file_id"]: r.asDict() for r in drift.consistent_table(fields).collect()}
    assert (got[0]["resume"], got[0]["resume__type"], got[0]["rules"], got[0]["rules__type"]) == ("true", "boolean", "12", "integer")
    assert {tuple(x)[1:] for x in got[0]["further_keys"]} == {("resume", "null", None), ("n_rules", "string", "x9")}
    assert (got[1]["rules"], got[1]["rules__type"], got[1]["further_keys"]) == ("7", "integer", []) and got[2]["further_keys"] == [] and not got[2]["readable"]
