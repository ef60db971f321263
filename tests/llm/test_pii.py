import re

import pytest

from lodestrata.llm import pii

NAMES = pii.Names({"anna", "luc", "käthe", "σοφία", "marco", "nuno"}, {"branani", "torvard", "selmmäuser", "βρυσκάκης", "ulmini", "quardoso", "lorvães"})


def found(text):
    return [(text[f.start : f.end], f.kind) for f in pii.find(text, NAMES)]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Scrivere a urp+x.y@ente.example.", [("urp+x.y@ente.example", "email")]), ("mailto:a [at] b [dot] example", [("a [at] b [dot] example", "email")]), ("posta A AT mail DOT example", [("A AT mail DOT example", "email")]), ("a(at)b-c.example", [("a(at)b-c.example", "email")]),
        ("a @ b.example", [("a @ b.example", "email")]), ("come @nome_ente per", []), ("visto @ roma", []), ("NOI ANDIAMO AT", []),
        ("tel. +39 948 555 9658.", [("+39 948 555 9658", "phone")]), ("(0305) 555.2488", [("(0305) 555.2488", "phone")]), ("0039 976 5558475 Il", [("0039 976 5558475", "phone")]), ("+49 (0)922 555-1813, Mail", [("+49 (0)922 555-1813", "phone")]), ("0965-555-7696", [("0965-555-7696", "phone")]), ("0933 555 98 58", [("0933 555 98 58", "phone")]), ("(0904/5552824)", [("0904/5552824", "phone")]), ("+33 948 555 8845", [("+33 948 555 8845", "phone")]),
        ("rif. 2020-0555-5802, prot. 00049/2017, ticket #84000216, P.O. 735955 / 334, ISO 27001:2022, rev. 5082350e, 192.0.2.25, 2021-02-23, 1.602,50", []),
        ("C.F. NMN GLR 61A02 Z929S.", [("NMN GLR 61A02 Z929S", "id_number")]), ("C.F. vrnbzm53t05z944p", [("vrnbzm53t05z944p", "id_number")]), ("NIR 2 54 05 99 499 351 05.", [("2 54 05 99 499 351 05", "id_number")]), ("DNI 45.669.708-S)", [("45.669.708-S", "id_number")]), ("PESEL 76122408982)", [("76122408982", "id_number")]), ("BSN 5635.97.412)", [("5635.97.412", "id_number")]), ("personnr 951007-9234.", [("951007-9234", "id_number")]), ("PPSN 5202435K.", [("5202435K", "id_number")]),
        ("in piazza Tre Fossi 62/d,", [("piazza Tre Fossi 62/d", "address")]), ("au 40 ter chemin des Trois Chênes.", [("40 ter chemin des Trois Chênes", "address")]), ("Wohnhaft Am Mühlenplatz 45,", [("Am Mühlenplatz 45", "address")]), ("at 44 Mill Race Sq. The", [("44 Mill Race Sq.", "address")]), ("C/ de los Almendros, 154 y", [("C/ de los Almendros, 154", "address")]), ("Λεωφ. Ανέμων 105,", [("Λεωφ. Ανέμων 105", "address")]), ("ul. Łąkowa 41a.", [("ul. Łąkowa 41a", "address")]), ("Rua do Moinho, n.º 154.", [("Rua do Moinho, n.º 154", "address")]), ("más alejadas. La versión 2.7.3", []),
        ("Ref. Anna Branani\nvia", [("Anna Branani", "name")]), ("SELMMÄUSER Käthe, x", [("SELMMÄUSER Käthe", "name")]), ("M. Luc Torvard-Branani – x", [("Luc Torvard-Branani", "name")]), ("D. A. Quardoso (x", [("A. Quardoso", "name")]), ("Anna Marco Ulmini dice", [("Anna Marco Ulmini", "name")]), ("ΣΟΦΊΑ ΒΡΥΣΚΆΚΗΣ,", [("ΣΟΦΊΑ ΒΡΥΣΚΆΚΗΣ", "name")]),
        ("L'istituto «Anna Branani» resta", []), ("Le lycée « Luc Torvard » est", []), ("A escola «Nuno Lorvães»\nfecha", []), ("The Marco Ulmini Community College", []), ("Het lyceum ‘Anna Ulmini’ blijft", []), ("Anna dice. La scuola", []), ("", []), (None, []),
    ],
)
def test_findings(text, expected):
    assert found(text) == expected


def test_learns_names_from_labels():
    assert sorted(pii.sightings("Ref. Anna Rossi\nwhois: BIANCHI Paolo, Mme X. Verdi (")) == [("family", "bianchi"), ("family", "rossi"), ("family", "verdi"), ("family", "verdi"), ("given", "anna"), ("given", "paolo")]
    assert not list(pii.sightings("p. La Scuola Ref. il comune"))


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Il Sig. Zoran Petkovic ha firmato", ["Zoran Petkovic"]), ("whois: PETKOVIC Zoran, x", ["PETKOVIC Zoran"]), ("Mme X. Petkovic (x", ["X. Petkovic"]), ("Ref. M. Zoran Petkovic.", ["Zoran Petkovic"]), ("Mr. Zoran Mihail Petkovic, x", ["Zoran Mihail Petkovic"]),
        ("Sig. Zoran Anna Branani, x", ["Zoran Anna Branani"]), ("Sig. Zoran Branani Comune", ["Zoran Branani"]), ("bellen met Branani Branani Petkovic, x", ["Branani Branani Petkovic"]), ("de heer Zoran Petkovic en Anna Branani", ["Zoran Petkovic", "Anna Branani"]), ("Anna Branani e pan Zoran Petkovic", ["Anna Branani", "Zoran Petkovic"]),
        ("contact Zoran Petkovic College", []), ("p. La Scuola", []), ("Ref. Team4 Rete5", []), ("Zoran Petkovic ha firmato", []),
    ],
)
def test_unknown_names_after_labels(text, expected):
    assert [s for s, _ in found(text)] == expected


def test_a_name_seen_once_is_found_in_all_queries(spark):
    df = spark.createDataFrame([(1, "Il Sig. Zoran Petkovic ha firmato."), (2, "nulla")], "doc_id long, text string")
    assert [tuple(r) for r in pii.entities(df, "doc_id", "text").collect()] == [(1, 8, 22, "name", "Zoran Petkovic")]
    assert pii.redact(df, "doc_id", "text").filter("doc_id = 1").first()["redacted"] == "Il Sig. [NAME] ha firmato."
    new = pii.surrogates(df, "doc_id", "text", "k").filter("doc_id = 1").first()["text"]
    assert re.fullmatch(r"Il Sig\. \w+ \w+ ha firmato\.", new) and "Zoran" not in new and "Petkovic" not in new


def corpus(spark):
    filler = [(i, f"Ref. {g} {f}\nwhois: {f.upper()} {g}, x") for i, (g, f) in enumerate([(g, f) for g in ("Anna", "Marco") for f in ("Branani", "Ulmini")] * 2)]
    more = [
        (100, "La domanda di Anna Branani (C.F. NMN GLR 61A02 Z929S), tel. +39 948 555 9658, è ok."), (101, "BRANANI Anna, +39 9485559658"), (102, ""), (103, None),
        (104, "parola " * 60_000 + "scrivere a a.b@c.example"), (105, "Marco Ulmini"), (106, "nulla"),
    ]
    return spark.createDataFrame(filler + more, "doc_id long, text string").selectExpr("*", "1 as start", "'clash' as kind", "'e' as entity")


def test_redaction_and_surrogates(spark):
    df = corpus(spark)
    red = {r["doc_id"]: r["redacted"] for r in pii.redact(df, "doc_id", "text").collect()}
    assert red[100] == "La domanda di [NAME] (C.F. [ID_NUMBER]), tel. [PHONE], è ok." and red[102] == "" and red[103] is None and red[106] == "nulla"
    assert red[104].endswith("scrivere a [EMAIL]") and len(red[104]) > 400_000
    one, two = ({r["doc_id"]: r["text"] for r in pii.surrogates(df, "doc_id", "text", key).collect()} for key in ("k1", "k2"))
    assert one[102] == "" and one[103] is None and one[106] == "nulla" and one[100] != two[100]
    name = re.match(r"La domanda di (\w+) (\w+) \(C\.F\. [A-Z]{3} [A-Z]{3} \d\d[A-Z]\d\d [A-Z]\d{3}[A-Z]\), tel\. \+39 ", one[100])
    assert name
    assert one[101].startswith(f"{name[2].upper()} {name[1]}, ")
    digits = lambda t: re.sub(r"\D", "", t)
    assert digits(one[101]) == digits(one[100].split("tel.")[1])
    assert "Branani" not in "".join(t or "" for t in one.values())


@pytest.mark.parametrize("most", [1, 3])
def test_rare_names_are_kept_beyond_the_broadcast(spark, monkeypatch, most):
    more = [(100, "Anna-Maria Ulmini e Marco Branani-Rossi"), (107, "Marco Ulmini"), (107, "ha scritto BRANANI Anna"), (None, "Marco Branani, Annabella-Ulmini Marco"), (108, "Annabella-Branani Anna")]
    df = corpus(spark).select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))

    def results():
        texts = pii.surrogates(df.filter("doc_id is not null and doc_id <> 107"), "doc_id", "text", "k")
        return [sorted(map(str, t.collect())) for t in (pii.entities(df, "doc_id", "text"), pii.redact(df, "doc_id", "text"), texts)]

    whole = results()
    monkeypatch.setattr(pii, "MAX_NAME_WORDS", most)
    assert results() == whole and sum(map(len, pii.learn_names(df.select("text"))[:2])) == most
    assert sum("'name'" in r for r in whole[0]) > 20


def test_equal_surrogates_are_drawn_again(spark, monkeypatch):
    monkeypatch.setitem(pii._CONSONANTS, "latin", "b")
    monkeypatch.setitem(pii._VOWELS, "latin", "ae")
    rows = [(i, f"scrivere a persona{i}@x.example") for i in range(40)] + [(99, "Scrivere a PERSONA1@X.EXAMPLE")]
    got = {r["doc_id"]: r["text"] for r in pii.surrogates(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", "k").collect()}
    assert len({got[i] for i in range(40)}) == 40 and got[99].split()[-1].lower() == got[1].split()[-1].lower()


def rewritten(spark, texts, key="k"):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["text"] for r in pii.surrogates(df, "doc_id", "text", key).orderBy("doc_id").collect()]


PEOPLE = ["Ref. Anna Rossi e Sig. Marco Rossi", "Ref. Anna Verdi e Sig. Aldo Verdi", "Sig.ra Anna Rossi, Sig.ra Anna Verdi, Sig. Marco Verdi, Sig. Aldo Rossi"]


def test_mentions_of_one_person_go_together(spark):
    texts = [*PEOPLE, "Anna Rossi scrive", "ROSSI Anna scrive", "Sig.ra A. Rossi scrive", "Marco Rossi scrive", "Sig. A. Verdi scrive"]
    out = rewritten(spark, texts)
    first, family = out[3].split()[:2]
    assert out[4] == f"{family.upper()} {first} scrive" and out[5] == f"Sig.ra {first[0]}. {family} scrive"
    assert out[6].split()[1] == family and out[6].split()[0] != first and first[-1] == "a" and out[6].split()[0][-1] == "o"
    assert out[7].split()[1] == f"{first[0]}." and out[7].split()[2] != family


def test_numbers_and_addresses_follow_the_entity(spark):
    spellings = ["+39 021234567", "+39021234567", "0039 021234567", "+39 (0)21 234 567"]
    out = rewritten(spark, [f"tel. {s}, x" for s in spellings])
    digits = {re.sub(r"^00", "", re.sub(r"\(0\)|\D", "", t)) for t in out}
    assert len(digits) == 2 and all(d.startswith("39") for d in digits) and all("1234567" not in d for d in digits)
    mails = rewritten(spark, ["a mario@rossi-famiglia.it x", "a MARIO [at] rossi-famiglia [dot] it x", "a lia@rossi-famiglia.it x", "a mario@altro.it x"])
    a, b, c, d = (t[2:-2] for t in mails)
    assert b.lower().replace(" [at] ", "@").replace(" [dot] ", ".") == a and " [at] " in b and " [dot] it" in b and b.split()[0].isupper()
    assert c.split("@")[1] == a.split("@")[1] != d.split("@")[1] and d.split("@")[0] == a.split("@")[0] and "rossi" not in a
    streets = rewritten(spark, ["in via Verdi 12, x", "in VIA VERDI 12, x", "in via Verdi 14, x", "in via di mezzo 3, x", "in via Blu 12, x"])
    assert streets[0].upper() == streets[1].upper() and streets[0].split()[2] == streets[2].split()[2] and streets[0] != streets[2] and "Verdi" not in streets[0] and "Blu" not in streets[4]
    assert len(set(streets)) == 5


def test_surrogates_are_no_real_entity(spark, monkeypatch):
    real = pii.draw
    texts = [f"tel. +39 02 123 45{i:02d}, x" for i in range(30)]
    monkeypatch.setattr(pii, "draw", lambda kind, unit, hint, key, round_=0: f"+390212345{(int(unit[-2:]) + 1) % 30:02d}" if round_ == 0 else real(kind, unit, hint, key, round_))
    out = rewritten(spark, texts)
    assert len(set(out)) == 30 and not set(out) & set(texts)


def test_no_window_cuts_an_item():
    local, street = "x" * 3000 + ".y" * 200, "Via " + "Ab" * 900 + " " + "Lungonome" * 30 + " 12"
    assert found(f"a {local}@b.example z")[0] == (f"{local}@b.example", "email")
    assert found(f"in {street}, x") == [(street, "address")]
    names = pii.Names({"anna"}, {"rossi"})
    long = "R" * 500
    assert [(f.start, f.end) for f in pii.find(f"x {long} Anna y", names)] == [(2, 507)]


def test_rows_that_repeat_or_lack_an_id(spark):
    rows = [(1, "scrivere a a.b@c.example"), (1, "scrivere a a.b@c.example"), (1, "tel. +39 948 555 9658 x"), (None, "scrivere a a.b@c.example"), (None, None), (2, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((str(r["doc_id"]), r["start"]) for r in pii.replacements(df, "doc_id", "text", "k").collect()) == [("1", 5), ("1", 11), ("1", 11), ("None", 11)]
    out = [tuple(r) for r in pii.surrogates(df, "doc_id", "text", "k").collect()]
    mails = {t for _, t in out if t and "@" in t}
    assert len(out) == 6 and len(mails) == 1 and "a.b@" not in mails.pop() and (None, None) in out and (2, "") in out


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert pii.entities(df, "doc_id", "text").count() == 0 and pii.redact(df, "doc_id", "text").count() == 0 and pii.surrogates(df, "doc_id", "text", "k").count() == 0 and pii.replacements(df, "doc_id", "text", "k").count() == 0
