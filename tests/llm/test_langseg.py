import numpy as np
import pytest

from lodestrata.llm import langseg
from lodestrata.llm.queries import EVIDENCE_NOISE

TEXTS = {
    "it": "Il consiglio comunica gli orari di apertura entro la fine del mese", "fr": "Le conseil municipal présente le budget prévisionnel avec effet immédiat",
    "de": "Das Steueramt erneuert die Liste der Leistungen bis zum nächsten Herbst", "en": "The tax office announces the mobility plan until next autumn for all residents",
    "pl": "Biblioteka publiczna odnawia formularze do końca miesiąca bez kosztów", "el": "Η βιβλιοθήκη διαθέτει τους οριστικούς πίνακες μέχρι το επόμενο φθινόπωρο",
}


@pytest.mark.parametrize(("lang", "code"), [("it_CH", "it"), ("ITA", "it"), ("Italiano", "it"), ("fre", "fr"), ("ελληνικά", "el"), ("und", None), ("", None), (None, None), ("ro", None), ("{{lang}}", None), ("pt-PT", "pt")])
def test_declared(lang, code):
    assert langseg.declared_code(lang) == code


def test_running_words():
    words = lambda t, **k: [w for w, _, _ in langseg.running_words(t, noise=EVIDENCE_NOISE, **k)]
    assert words("h1=La scuola || nav:53 || wikidata:Q99 tld:gov conf=0.55 no_site") == ["la", "scuola"]
    assert words("title: Der Rat www.x.example https://a.b/c?d x@y.example 123") == ["der", "rat"]
    assert words("status=403") == [] and words("") == [] and words(None) == []
    assert words("La scuola appro", cut_at=15) == ["la", "scuola"]
    assert [w for w, _, _ in langseg.running_words("title: tld conf: host a.example x.com")] == ["tld", "conf", "host", "a", "example"]
    assert langseg.plain_words("İstanbul è") == ["i̇stanbul", "è"]


@pytest.mark.parametrize("n", [9, 16, 17, 40])
def test_long_texts_against_one_scan(monkeypatch, n):
    rng = np.random.default_rng(n)
    k = len(langseg.LANGS)
    model = langseg.blank_model(np.ones((langseg.BUCKETS, k)))
    model.trans = rng.normal(size=(k, k))
    emissions = {f"w{i}": rng.normal(size=k).astype(np.float32) * 3 for i in range(n)}
    monkeypatch.setattr(langseg.Crf, "emission", lambda self, w: emissions[w])
    texts = [[f"w{i}" for i in range(n)], ["w1"], [], ["w3", "w2", "w0"]]
    whole = model.posteriors(texts)
    e, mask = langseg._pad([np.stack([emissions[w] for w in texts[0]])])
    assert np.allclose(whole[0], langseg.forward_backward(e, mask, model.trans)[0][0], atol=1e-4)
    monkeypatch.setattr(langseg, "CHUNK", 8)
    monkeypatch.setattr(langseg, "BLOCK_WORDS", 4)
    assert all(np.allclose(a, b, atol=1e-4) and a.shape == b.shape for a, b in zip(model.posteriors(texts), whole, strict=True))


def test_a_million_words_beside_short_texts(spark):
    words = TEXTS["it"].split()
    long = " ".join(words * (500_000 // len(words)) + TEXTS["fr"].split() * 50_000)
    df = spark.createDataFrame([(0, "it", long), (1, "it", "x" * 300_000)] + [(i + 2, k, TEXTS[k]) for i, k in enumerate(list(TEXTS) * 43)], "riga_id long, lang string, evidenza string")
    got = {r["row_id"]: r for r in langseg.identify(df, "riga_id", "lang", "evidenza").collect()}
    assert got[0]["lang"] in ("it", "fr") and [s["lang"] for s in got[0]["stretches"]] == ["it", "fr"] and got[0]["stretches"][1]["end"] == len(long)
    assert len(got) == 260 and got[2]["lang"] == "it"


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(0)
    k, n = len(langseg.LANGS), 3
    e, trans = rng.normal(size=(1, n, k)), rng.normal(size=(k, k))
    scores = e[0, 0][:, None, None] + e[0, 1][None, :, None] + e[0, 2][None, None, :] + trans[:, :, None] + trans[None, :, :]
    p = np.exp(scores - scores.max())
    p /= p.sum()
    padded = np.concatenate([e, np.zeros((1, 2, k))], 1)
    mask = np.array([[True] * n + [False] * 2])
    post, pairs, _ = langseg.forward_backward(padded, mask, trans)
    assert np.allclose(post[0, 0], p.sum((1, 2))) and np.allclose(post[0, 2], p.sum((0, 1)))
    assert np.allclose(pairs, p.sum(2) + p.sum(0))


@pytest.fixture(scope="module")
def rows(spark):
    data = []
    for i in range(300):
        lang = list(TEXTS)[i % 6]
        words = TEXTS[lang].split()
        data.append((i, lang if i % 11 else ["und", "xx", None][i % 3], "h1=" + " ".join(words[i % 3 :] + words) + ". || tld:gov"))
    data += [(900, "it", f"{TEXTS['it']}. {TEXTS['de']}. / {TEXTS['it']}"), (901, "it", ""), (902, "it", None), (903, "it", "status=403"), (904, "it", " ".join([TEXTS["fr"]] * 300)), (905, "it", TEXTS["it"].upper())]
    df = spark.createDataFrame(data, "riga_id long, lang string, evidenza string").selectExpr("*", "'clash' as text", "0 as row_id")
    return {r["row_id"]: r for r in langseg.identify(df, "riga_id", "lang", "evidenza", noise=EVIDENCE_NOISE).collect()}


def test_languages(rows):
    assert all(rows[i]["lang"] == list(TEXTS)[i % 6] and rows[i]["n_langs"] == 1 for i in range(300))
    assert [(s["position"], s["lang"]) for s in rows[900]["stretches"]] == [(1, "it"), (2, "de"), (3, "it")]
    assert not {901, 902, 903} & set(rows) and rows[904]["lang"] == "fr" and not rows[904]["agrees"] and rows[905]["agrees"]
    assert all(0 < r["confidence"] <= 1 for r in rows.values())


def test_every_row(spark):
    df = spark.createDataFrame([(1, "it", TEXTS["it"]), (2, "de_CH", ""), (3, None, None), (4, "it", "status=403")] + [(10 + i, k, TEXTS[k]) for i, k in enumerate(list(TEXTS) * 20)], "riga_id long, lang string, evidenza string")
    got = {r["row_id"]: r for r in langseg.identify(df, "riga_id", "lang", "evidenza", every_row=True, noise=EVIDENCE_NOISE).collect()}
    assert len(got) == df.count() and got[1]["lang"] == "it"
    assert [tuple(got[i])[1:] for i in (2, 3, 4)] == [(None, 0.0, c, None, 0, []) for c in ("de", None, "it")]


def test_empty(spark):
    assert langseg.identify(spark.createDataFrame([], "riga_id long, lang string, evidenza string"), "riga_id", "lang", "evidenza").count() == 0
