import pytest

from lodestrata.llm import mojibake

CLEAN = ["Città di Roccacervà", "Comune di Valsorbì", "Mairie de Château-bœuf-l’Étang", "Gesundheitsamt für den Kreis Großbrühl", "Ayuntamiento de Peñagüera", "Urząd Gminy Książęnice", "Δήμος Άνω Καρυώτη", "Öståby kommun"]
FIELDS = ["nome_ente", "comune"]


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, CLEAN[i % 8] + f" {i % 37}", CLEAN[(i * 3) % 8]) for i in range(1200)]
    hurt = {
        5000: "Città di Roccacervà".encode().decode("cp1252", "replace").replace("�", "\xa0"), 5001: "Château-bœuf-l’Étang".encode().decode("mac_roman"), 5002: "Gesundheitsamt für den Kreis".encode("cp1252").decode("cp1251"),
        5003: "Öståby kommun".encode().decode("cp1252").encode().decode("cp1252"), 5004: "Mairie de Ch�teau", 5005: "Δήμος Άνω".encode("iso8859_7").decode("cp1252"), 5006: "Δήμος " + "Άνω".encode().decode("cp1252", "replace").replace("�", "\x89"),
    }
    sound = {6000: "CITTÀ DI ROCCACERVÀ", 6001: "Città​ di Roccacervà", 6002: "Città\xa0di Roccacervà", 6003: "", 6004: None, 6005: "plain ascii?", 6006: "x" * 20000}
    rows += [(k, v, "Öståby kommun") for k, v in {**hurt, **sound}.items()]
    df = spark.createDataFrame(rows, "rec_id long, nome_ente string, comune string").selectExpr("*", "'clash' as value", "1 as row_id")
    return {(r["row_id"], r["field"]): r for r in mojibake.repair(df, "rec_id", FIELDS).collect()}


def test_finds_exactly_the_damaged(table):
    assert set(table) == {(k, "nome_ente") for k in range(5000, 5007)}


def test_restores(table):
    assert table[5001, "nome_ente"]["restored"] == "Château-bœuf-l’Étang"
    assert table[5002, "nome_ente"]["restored"] == "Gesundheitsamt für den Kreis"
    assert table[5003, "nome_ente"]["restored"] == "Öståby kommun"
    assert table[5004, "nome_ente"]["restored"] is None


@pytest.mark.parametrize("charset", ["cp1252", "cp1250", "mac_roman", "cp437", "cp850"])
def test_round_trip_of_every_charset(charset):
    model = mojibake.Model({}, 0)
    counts = mojibake._grams(CLEAN * 20)
    for g, n in counts.items():
        model.counts[mojibake._bucket(g)] = model.counts.get(mojibake._bucket(g), 0) + n
        model.total += n if len(g) == 1 else 0
    for text in CLEAN:
        try:
            hurt = text.encode().decode(charset)
        except UnicodeDecodeError:
            continue
        assert model.judge(hurt)[0] == text


def test_every_chain_can_damage_and_restore_counts_whole_texts():
    c = mojibake.chains()
    hurt = {c.hurt("Città di Valsorbì", k) for k in range(2 * len(mojibake.WRONG) * len(mojibake.RIGHT))}
    assert len(hurt) > 30 and "CittÃ\xa0 di ValsorbÃ¬" in hurt
    model = mojibake.Model({}, 0)
    for g, n in mojibake._grams(CLEAN * 20).items():
        model.counts[mojibake._bucket(g)] = model.counts.get(mojibake._bucket(g), 0) + n
        model.total += n if len(g) == 1 else 0

    def score(text):
        t = f"\x03\x03{text.lower()}\x03".replace("\u200b", "")
        inner = sum(x.islower() and y.isupper() for x, y in zip(text, text[1:], strict=False) if not y.isascii() or not x.isascii())
        return sum(model.gram(t[i : i + 3]) for i in range(len(t) - 2)) - 3.0 * inner

    for text in hurt | {x.upper() for x in CLEAN} | {"aÀ", "éB", ""}:
        for _, new in c.single_steps(text):
            assert abs((score(new) - score(text)) - (model.cost(text) - model.cost(new))) < 1e-9
    best = model.restore("CittÃ\xa0 di ValsorbÃ¬")
    assert best[0] == "Città di Valsorbì" and best[2] > 5 and model.restore("Città di Valsorbì")[2] <= mojibake.MIN_MARGIN


def test_empty(spark):
    assert mojibake.repair(spark.createDataFrame([], "rec_id long, nome_ente string, comune string"), "rec_id", FIELDS).count() == 0
