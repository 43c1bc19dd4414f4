import pytest

from scriptorium.llm import names


@pytest.mark.parametrize("a,b,same", [("Bourg-Lolanoga", "Bg Lolanoga", True), ("BRILEM-SUR-ORLE", "Brilem s/Orle", True), ("Brilem/Orle", "brilem sur orle", True), ("Flota l. Eaux", "Flota-les-Eaux", True), ("ville de Val de Sul", "Val-de-Sul (Îles)", True), ("Ste Murpi", "Sainte-Murpi, Haute-Marge", True), ("Saint-Pol", "Sainte-Pol", False), ("Fen-sur-Orle", "Fen-les-Eaux", False)])
def test_place_keys(a, b, same):
    assert (names.place_key(a) == names.place_key(b)) is same


def test_readings():
    assert ("anselme", "garsel") in names.readings("Garsel, Anselme") and len(names.readings("Garsel, A.")) == 1
    assert ("", "garsel") in names.readings("Frère Garsel") and ("m.", "garsel") in names.readings("M. Garsel")
    assert ("jean-baptiste", "mel") in names.readings("Past. Jean Baptiste MEL")
    assert names.readings("Moldu Kelba GmbH") == names.readings("Moldu Kelba") and ("", "moldu") in names.readings("Moldu S.A.")
    assert names.readings("") == [] and names.readings("Dr") == [("", "dr")]


def test_near():
    assert names.near("abc", "abc") and names.near("abc", "abxc") and names.near("abc", "ac") and names.near("abcd", "acbd") and not names.near("abcd", "badc")
    assert set(names.deletions("abcd")) & set(names.deletions("acbd"))


def test_persons(spark):
    full = ["Anselme Garsel", "Anselme Moldu", "Yolande Garsel", "Yolande Pirat", "Yolande Torka", "Dorothée Moldu", "Dorothée Kelba", "Dorothée Sulfen", "Anselme Belzan"]
    variants = {"Anselme Garsel": ["A. Garsel", "GARSEL, Anselme", "anselme garsel", "Ansselme Garsel", "Anse. Garsel", "Pasteur Anselme Garsel"], "Dorothée Sulfen": ["Doro Sulfen", "Frère Sulfen", "Dorothee SULFEN", "Dorothée Sulfn"], "Dorothée Kelba": ["Doro Kelba"]}
    rows = [(n, 20) for n in full] + [(v, 2) for vs in variants.values() for v in vs] + [("Frère Garsel", 3), ("X. Garsel", 1)]
    got = {r.name: r.entity for r in names.person_entities(spark.createDataFrame(rows, "name string, n long")).collect()}
    for whole, vs in variants.items():
        assert {got[v] for v in vs} == {got[whole]}
    assert got["Anselme Garsel"] != got["Yolande Garsel"]  # one family name, two people
    assert "Frère Garsel" not in got and "X. Garsel" not in got  # several or none could be meant


def test_names_column(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("",), ("  ",), ("x" * 5000,)], "x string")
    assert {r.name for r in names.distinct_names(df, "x").collect()} == {"a", "x" * 5000}
    empty = names.distinct_names(df.limit(0), "x")
    assert names.linked(names.person_entities(empty)).isEmpty() and names.linked(names.place_entities(empty)).isEmpty()


def test_places(spark):
    rows = [("Bourg-Lolanoga", 50), ("Bg Lolanoga", 5), ("Bourg-Lolangoa", 6), ("Mont-Rogagrimi", 30), ("MONT-ROGAGRIMI", 2)]
    got = {tuple(r) for r in names.linked(names.place_entities(spark.createDataFrame(rows, "name string, n long"))).collect()}
    assert got == {("Bg Lolanoga", "Bourg-Lolangoa"), ("Bg Lolanoga", "Bourg-Lolanoga"), ("Bourg-Lolangoa", "Bourg-Lolanoga"), ("MONT-ROGAGRIMI", "Mont-Rogagrimi")}
