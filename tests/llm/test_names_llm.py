"""Encoding repair, look-alikes and name parsing on small fixtures."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from voltlace.llm import confusables as C
from voltlace.llm import mojibake as M
from voltlace.llm.names import one_edit, parse, unit_key
from voltlace.session import cut

SOUND = ["Łużóstok power station", "(Żółćęśń),", "Üt", "Bełchatów", "Řužihiov-South", "Bôtếphinh Tân", "Ποβεκινος", "Побекинов", "ボセナサワ火力発電所", "Plain – Energy Park", "Plain power station (?)", "RANÃO do Sul", "Tå­dø​genes", "Bо wer", "Tilø sol"]


def garble(s, true, read):
    return s.encode(true).decode(read)


def test_repair(spark):
    bad = {
        "Łużóstok power station".encode().decode("latin-1"): "Łużóstok power station",
        garble("Bełchatów", "utf-8", "mac-roman"): "Bełchatów",
        garble(garble("Bełchatów", "utf-8", "latin-1"), "utf-8", "latin-1"): "Bełchatów",
        garble("Bełchatów", "utf-8", "cp850"): "Bełchatów",
        "Be?chat?w": "Bełchatów",
        "Be��chat��w": "Bełchatów",
        garble("Bôtếphinh", "utf-8", "latin-1").upper() + " Tân": "BÔTẾPHINH Tân",
        garble("Побекинов", "cp1251", "latin-1"): "Побекинов",
        garble("Řužihiov", "cp1250", "latin-1") + "-South": "Řužihiov-South",
        garble("ボセナサワ火力発電所", "euc_jp", "latin-1"): "ボセナサワ火力発電所",
        garble("Nowhere – Main Site", "utf-8", "cp1252"): "Nowhere – Main Site",
        "Unk?own?": None,
        "(" + garble("Żółćęśń", "utf-8", "latin-1") + "),": "(Żółćęśń),",
        garble("Żółć", "utf-8", "latin-1") + "ęśń": "Żółćęśń",  # some signs only, of a word of many
        garble("Üt", "utf-8", "latin-1") + " B01": "Üt B01",
        "Be" + garble("ł", "cp852", "cp1251") + "chat" + garble("ó", "cp852", "cp1251") + "w": "Bełchatów",
        garble("Unbekóżst", "utf-8", "latin-1"): "Unbekóżst",
        "x" * 5000 + "Ã³": "x" * 5000 + "ó",
    }
    names = SOUND * 2 + list(bad) + ["Nowhere", None, "", " "]
    rows = spark.createDataFrame([("t", i, n, 9) for i, n in enumerate(names)], "table_name string, row_id long, name string, restored_by long")
    all_rows = M.repair_names(rows, None, cut).collect()
    got = [r for r in all_rows if r.garbled]
    assert {r.name: r.restored for r in got} == bad
    assert len(got) == len(bad) and "restored_by" in got[0].asDict() and len(all_rows) == len(names)
    how = {r.name: r.evidence for r in got}
    assert how["Be?chat?w"] == "word" and how["Unk?own?"] == "marks" and how[garble("Unbekóżst", "utf-8", "latin-1")] == "signs"
    assert M.repair_names(rows.limit(0), None, cut).count() == 0


def test_garbled_forms_cover_chains():
    forms = M.garbled_forms("Łóź")
    for true, read in (("utf-8", "latin-1"), ("utf-8", "cp437"), ("cp1250", "cp1252"), ("cp852", "latin-1"), ("utf-8", "cp866")):
        assert M.key_of(garble("Łóź", true, read)) in forms
    assert M.garbled_forms("plain") == set() and M.key_of("Łóź") not in forms


VARIANTS = {
    "Ｐower Ⅱ": "Power II", "Bo​gu": "Bogu", "a\xa0b": "a b", "Púz": "Púz", "Loca‐South": "Loca-South", "рower рlant": "power plant", "Ea\xadst": "East", "ﬁrst": "first", "Ри́декиво"[:2] + "дeкиво": "Ридекиво",
    "ｸモゲ": "クモゲ", "Lоndоn Ꮩale": "London Vale", "Bаձa": "Baձa", "Ｒiver 𝐀": "River A", "Cаfё": "Cafë", "Unit А": "Unit A", "　x": " x",
}


@pytest.mark.parametrize("name,form", VARIANTS.items())
def test_variants(name, form):
    assert C.canonical(name) == form != name
    assert C.skeleton(name) == C.skeleton(form)


@pytest.mark.parametrize("name", ["Łużóstok", "Ридекиво B01", "Καγαμαπολι", "クモゲヤマ発電所", "Plain – Energy Park", "  two  spaces ", "MiXed Case", "TPP_Ридекиво"])
def test_sound_names_are_no_variants(name):
    assert C.canonical(name) == name


def test_lookalike_table_is_unicodes():
    table = C.lookalikes()
    assert len(table) > 6000 and table["а"] == "a" and table["ο"] == "o" and table["Ꭺ"] == "A" and table["ꓑ"] == "P" and table["𝟎"] == "O"
    assert C.in_script("Ꮩ", "LATIN") == "V" and C.in_script("ё", "LATIN") == "ë" and C.in_script("П", "LATIN") is None and C.in_script("e", "CYRILLIC") == "е"


def test_cases_come_from_skeleton_groups(spark, monkeypatch):
    rows = spark.createDataFrame([("t", i, n) for i, n in enumerate(["Bogu Il", "Bоgu Il", "Bogu I1", "Bogu lI"])], "table_name string, row_id long, name string")
    names, groups = C.grouped(rows)
    assert {r.name for r in C.variants(names, groups).collect()} == {"Bоgu Il"} and groups.select("skeleton").distinct().count() == 1
    # without skeletons there are no groups, and without groups no name is known as a sound one or not
    assert C.variants(names.withColumn("skeleton", F.lit(None).cast("string")), groups).count() == 4 and C.variants(names.limit(0), groups).count() == 0


def test_unify(spark):
    names = ["Bogu", "Bogu", "Bo​gu", "Воgu", None, "​", "", "Bogu"]
    rows = spark.createDataFrame([("t", i, n, "x") for i, n in enumerate(names)], "table_name string, row_id long, name string, form string").drop("form")
    got = {r.row_id: (r.form, r.variant) for r in C.unify(rows).collect()}
    assert {k: v for k, v in got.items() if k not in (5, 6)} == {0: ("Bogu", False), 1: ("Bogu", False), 2: ("Bogu", True), 3: ("Bogu", True), 7: ("Bogu", False)}
    assert got[5] == ("", True) and got[6] == ("", False)
    assert C.unify(rows.limit(0)).count() == 0


@pytest.mark.parametrize(
    "name,want",
    [
        ("ボセナサワ火力発電所", ("bosenasawa", "")), ("Elektrownia Łóżyź-Zdrój B02", ("lozyz", "zdroj")), ("GEM: Debihones hydroelectric plant", ("debihones", "")), ("Kivis III Extension PS", ("kivis", "iii extension")),
        ("Bajelakou – Main Site", ("bajelakou", "")), ("Foo noorth power statoin (score: 84)", ("foo", "north")), ("power station", (None, None)), (None, (None, None)), ("", (None, None)), ("De?f?l power plant", ("de?f?l", "")), ("MIBEVI EAST A.P.S.", ("mibevi", "east")),
    ],
)
def test_parse(name, want):
    assert parse(name)[:2] == want


def test_unit_keys_and_edits():
    same = ["Unit 1", "U1", "#1", "1", "unit1", "Unit-01", "Block 1", "Unit I"]
    assert {unit_key(x) for x in same} == {"u1"} and unit_key("--") is None and unit_key(None) is None
    assert unit_key("Gas turbine 2") == unit_key("GT-2") == "gt2" and unit_key("Unit A") == "ua" != unit_key("Unit B")
    assert one_edit("abc", "acb") and one_edit("abc", "ab") and one_edit("abc", "abd") and not one_edit("abc", "cba") and one_edit("", "a")


def test_damage_that_letters_show():
    bad = ["Øuèovìlom", "Žoèepaštejn", "Rinъroquйn", "Ratßgobß", "BinunuranÒ", "Œeczopówice", "DURIHUVĂŤN", "Kabùøaèany", "NÕkyladal", "TomφbolΓndia", "Paœiburzno"]
    good = ["Sèvres", "cœur", "Œuvre", "straße", "vicìlữt", "Bình", "Пeрумолово", "Вotіkugawa", "Καγαμαπολι", "GOLEΜESTAN", "Ţodă", "ŽABĂ", "Perù", "Ålesund", "RANÃO", "Strøm", "Ørsted", "(?)"]
    assert [w for w in bad if not M.loud(w)] == [] and [w for w in good if M.loud(w)] == []
