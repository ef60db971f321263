import random
from collections import defaultdict

import numpy as np
import pytest
import tiktoken

from lodestrata.llm import mixing, packing
from lodestrata.llm.tokens import PATTERN, Sizer

WORDS = "la scuola comunica gli orari di apertura entro il mese città über naïve Δήμος 12 3.4 l'anno".split()


def texts(n, seed=1, top=400):
    rng = random.Random(seed)
    return [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(0, top))) for _ in range(n)]


@pytest.mark.parametrize("text", ["", " ", "a b", "a  b", "a   b", "a \n b", "a\n\n b", " a", "a ", "a  ", "x\n\n\ny", "\t a  b  c", "don't l'anno  12²", "😀 x  😀"])
def test_token_counts_are_exact(text):
    s = Sizer()
    assert s.measure(text)[0] == len(s.encoding.encode_ordinary(text))


def test_token_counts_on_random_text():
    s, rng = Sizer(), random.Random(2)
    assert isinstance(s.encoding, tiktoken.Encoding) and PATTERN
    for _ in range(300):
        t = "".join(rng.choice([" ", " ", "\n", "a", "é", "1", ".", "ab", "  "]) for _ in range(40))
        assert s.measure(t)[0] == len(s.encoding.encode_ordinary(t))


def test_hilbert_is_a_curve():
    bits = 3
    pts = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)])
    keys = packing.hilbert_keys(pts, bits)
    assert sorted(keys) == list(range(512))
    path = pts[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_packing(spark):
    ts = texts(500) + ["", None, "x " * 3000] + ["same text again"] * 50
    df = spark.createDataFrame(list(enumerate(ts)), "doc_id long, text string").selectExpr("*", "1 as n_tokens", "2 as key", "'c' as x0")
    got = packing.pack(df, "doc_id", "text", [(1, 64), (2, 1000)]).collect()
    sizer = Sizer()
    sizes = {i: sizer.measure(t)[0] for i, t in enumerate(ts)}
    for pack_id, capacity in ((1, 64), (2, 1000)):
        rows = [r for r in got if r["pack_id"] == pack_id]
        by_doc, by_box = defaultdict(list), defaultdict(list)
        for r in rows:
            by_doc[r["doc_id"]].append(r)
            by_box[r["container"]].append(r)
        assert set(by_doc) == set(sizes)
        for d, rs in by_doc.items():
            assert sum(r["n_tokens"] for r in rs) == sizes[d]
            assert len(rs) == max(1, -(-sizes[d] // capacity))
            assert sorted((r["piece"], r["start_token"]) for r in rs) == [(k, k * capacity) for k in range(len(rs))]
        for rs in by_box.values():
            assert sum(r["n_tokens"] for r in rs) <= capacity
            assert sorted(r["place"] for r in rs) == list(range(len(rs)))
        used = sum(1 for rs in by_box.values() if sum(r["n_tokens"] for r in rs))
        assert sum(sizes.values()) / (used * capacity) > 0.93


def test_capacities(spark):
    t = spark.createDataFrame([(1, 10), (1, 10), (2, None), (3, 0)], "pack_id int, capacity_tokens int")
    assert packing.capacities_of(t, "pack_id", "capacity_tokens") == [(1, 10)]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(empty, "doc_id", "text", [(1, 10)]).count() == 0


def test_mixing(spark):
    ts, rng = texts(900, 4, 60), random.Random(1)
    names = ["big"] * 6 + ["mid"] * 3 + ["small"]
    rows = [(i, t, rng.choice(names)) for i, t in enumerate(ts)] + [(5000, None, "big"), (5001, "x", None), (5002, "x", "unused")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 as h", "2 as whole")
    targets = spark.createDataFrame(
        [(1, "big", 0.5, 1), (1, "mid", 0.3, 2), (1, "small", 0.2, 3), (2, "big", 0.8, 5), (2, "small", 0.2, 1), (3, "mid", 0.5, 1), (3, "nowhere", 0.5, 4), (4, "big", None, 1), (5, "big", 1.0, 0)],
        "mix_id int, source string, target_share double, max_repeats int",
    )
    drawn = mixing.mix(df, "doc_id", "text", "source", targets)
    got = drawn.collect()
    caps = {(r["mix_id"], r["source"]): r["max_repeats"] for r in targets.collect()}
    assert {r["mix_id"] for r in got} == {1, 2, 3}
    assert all(1 <= r["n_repeats"] <= caps[r["mix_id"], r["source"]] for r in got)
    shares = {(r["mix_id"], r["source"]): r for r in mixing.share_report(drawn, targets).collect()}
    longest = max(r["n_tokens"] for r in got)
    for m in (1, 2):
        total = sum(r["tokens"] for k, r in shares.items() if k[0] == m)
        for (mix, _), r in shares.items():
            if mix == m:
                assert abs(r["tokens"] - r["target_share"] * total) <= 2 * longest
    assert shares[3, "nowhere"]["actual_share"] == 0 and shares[3, "mid"]["actual_share"] == 1
    low, high = ({r["doc_id"] for r in got if r["mix_id"] == m and r["source"] == "small" and r["n_repeats"] >= 1} for m in (2, 1))
    assert low <= high or high <= low


def test_mixing_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    targets = spark.createDataFrame([(1, "a", 1.0, 1)], "mix_id int, source string, target_share double, max_repeats int")
    assert mixing.mix(df, "doc_id", "text", "source", targets).count() == 0
