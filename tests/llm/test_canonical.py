import itertools
import random
import unicodedata
from collections import defaultdict

from lodestrata.llm import canonical


def canon(values):
    clean = ("".join(c for c in v or "" if unicodedata.category(c)[0] in "LN").lower() for v in values)
    return tuple(sorted(v for v in clean if v))


def test_pairs_and_counts_against_brute_force(spark):
    rng = random.Random(3)
    base = [("Città di Roma", "roma.example", None), ("Δήμος", "", "x"), ("a-b", "c", "d1²"), ("", None, ""), ("é", "e", "x" * 5000)]
    rows = []
    for i in range(300):
        v = list(rng.choice(base))
        rng.shuffle(v)
        v = [None if x is None else rng.choice([x, x.upper(), f" {x}. ", x.replace(" ", "_"), x + "​"]) for x in v]
        rows.append((1000 - i, *v))
    rows += [(2000 + i, *base[0]) for i in range(200)]
    df = spark.createDataFrame(rows, "rec_id long, a string, b string, hash string").selectExpr("*", "'z' as id", "1 as keep", "'t' as text")
    groups = defaultdict(list)
    for r in rows:
        groups[canon(r[1:])].append(r[0])
    got = canonical.copy_pairs(df, "rec_id", ["a", "b", "hash"]).collect()
    assert sorted(map(tuple, got)) == sorted((min(g), i) for g in groups.values() for i in g if i != min(g))
    counts = canonical.collapse_copies(df, "rec_id", ["a", "b", "hash"], "n").collect()
    assert {r["rec_id"]: r["n"] for r in counts} == {min(g): len(g) for g in groups.values()}
    assert tuple(canonical.hash_collisions(canonical.copy_groups(canonical.fingerprints(df, "rec_id", ["a", "b", "hash"]))).first()) == (len(groups), len(groups), 0)


def test_field_order_and_separator(spark):
    rows = [(1, "x\u0001y", None), (2, "xy", ""), (3, None, "XY"), (4, "x", "y"), (None, "x y", None)]
    df = spark.createDataFrame(rows, "rec_id long, a string, b string")
    assert sorted(map(tuple, canonical.copy_pairs(df, "rec_id", ["a", "b"]).collect())) == [(1, 2), (1, 3)]


def test_collisions_are_told_apart(spark):
    rows = list(itertools.product([b"h"], [1, 2], [5, 6]))
    prints = spark.createDataFrame(rows, "hash binary, check long, id long")
    groups = canonical.copy_groups(prints)
    assert groups.count() == 2 and canonical.hash_collisions(groups).first()["n_records"] == 2


def test_empty(spark):
    df = spark.createDataFrame([], "rec_id long, a string")
    assert canonical.copy_pairs(df, "rec_id", ["a"]).count() == 0 and canonical.collapse_copies(df, "rec_id", ["a"]).count() == 0


def test_rows_without_id_and_repeated_ids(spark):
    rows = [(None, "x", 1), (None, "X", 2), (7, "y", 3), (7, "Y.", 4), (7, "z", 5), (8, "z ", 6)]
    df = spark.createDataFrame(rows, "rec_id long, a string, extra int")
    got = sorted((str(r["rec_id"]), r["a"], r["extra"], r["n_copies"]) for r in canonical.collapse_copies(df, "rec_id", ["a"]).collect())
    assert got == [("7", "Y.", 4, 2), ("7", "z", 5, 2), ("None", "X", 2, 2)]
    assert [tuple(r) for r in canonical.copy_pairs(df, "rec_id", ["a"]).collect()] == [(7, 8)]


def test_accents_apart_from_their_letters(spark):
    words = ["Città di Nîmes", "Citta di Nimes", "Ἀθῆναι", "ǖx", "Żółć"]
    rows = [(i, unicodedata.normalize(form, w)) for i, (w, form) in enumerate((w, f) for w in words for f in ("NFC", "NFD"))]
    df = spark.createDataFrame(rows, "rec_id long, a string")
    pairs = {tuple(r) for r in canonical.copy_pairs(df, "rec_id", ["a"]).collect()}
    assert pairs == {(2 * i, 2 * i + 1) for i in range(len(words))}
