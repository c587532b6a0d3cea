from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from voltlace.functions import text as X


def apply(spark, rows, expr, schema="a string"):
    df = spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema)
    return [r[0] for r in df.withColumn("__i", F.monotonically_increasing_id()).select(expr(df).alias("x"), "__i").orderBy("__i").select("x").collect()]


@pytest.mark.parametrize(
    "name,key",
    [
        ("KORBA STPS", "KORBA"), ("BOKARO TPS EXT", "BOKARO"), ("ANPARA D TPS", "ANPARA D"), ("Foo power station", "FOO"), ("Foo power plant", "FOO"), ("Foo Thermal Power Station", "FOO"),
        ("BARAUNI TPS (Liq.)", "BARAUNI"), ("Vindhyachal Thermal Power Station", "VINDHYACHAL"), ("WEST EXTENSION", "WEST EXTENSION"), ("PUNTA IMPERIAL", "PUNTA IMPERIAL"), ("FOO TPS POWER PLANT", "FOO TPS"),
        ("TPS", "TPS"), ("---", ""), ("(Liq.)", ""), ("Bełchatów", "BE CHATOW"), ("Beł".encode().decode("latin-1"), "BE"),
    ],
)
def test_comparison_key(spark, name, key):
    assert apply(spark, [name], lambda d: X.comparison_key(X.fold_diacritics(d.a))) == [key]


@pytest.mark.parametrize("name,key", [(None, ""), ("TUTICORIN BLOCK A", "TUTICORIN"), ("BLOCKHAUS STATION", "BLOCKHAUS STATION"), ("Foo (old) Power Plant", "FOO OLD")])
def test_second_key(spark, name, key):
    assert apply(spark, [name], lambda d: X.second_key(X.fold_diacritics(d.a))) == [key]


def test_base_name_keeps_case(spark):
    assert apply(spark, ["SINGRAULI STPS", "Foo tps", "X TPS (Liq.)"], lambda d: X.base_name(d.a)) == ["SINGRAULI", "Foo tps", "X"]


@pytest.mark.parametrize(
    "plant,matched,ok",
    [
        ("KORBA STPS", "Korba power station", True), ("Tucunare", "Tucunaré power station", True), ("CSP", "CSP power station", True), ("GNA I", "GNA I power station", True), ("Sol", "Sol", True),
        ("GNA I", "GNA-I power station", True), ("BOBOV DOL", "Bobov_Dol", True), ("GNA I", "GNAI power station", False), ("TE_STANARI", "Stanari Thermal Power Plant", True), ("TPP_BOBOV_DOL", "Bobov Dol power station", True), ("Bełchatów B01".encode().decode("latin-1"), "Bełchatów", True),
        ("BHADRA HPS", "Bhandara power station", False), ("THERMAL POWER LTD", "Other Thermal Power", False), ("Altos", "Atos power station", False), ("", "x", False), (None, "x", False), ("a.c", "abc", False),
    ],
)
def test_validates(spark, plant, matched, ok):
    df = spark.createDataFrame([(plant, matched)], "a string, b string").select(X.fold_diacritics(X.base_name(F.col("a"))).alias("x"), X.fold_diacritics(F.col("b")).alias("y")).cache()
    assert df.select(X.validates(df.x, df.y)).first()[0] is ok
    df.unpersist()


def test_fix_mojibake(spark):
    broken = "Bełchatów B01".encode().decode("latin-1")
    assert apply(spark, [broken, "plain ascii", "café", "ł", None, ""], lambda d: X.fix_mojibake(d.a)) == ["Bełchatów B01", "plain ascii", "café", "ł", None, ""]


def naive_strip(s: str, suffixes: list[str]) -> str:
    s = s.rstrip()
    while True:
        hit = next((x for x in sorted(suffixes, key=len, reverse=True) if s.endswith(x)), None)
        if hit is None:
            return s
        s = s[: -len(hit)].rstrip()


def test_suffixes_equal_repeated_cutting(spark):
    rng = random.Random(3)
    parts = ["FOO", " TPS", " EXT", " ST-1", "  ", " power plant", " D.G", "X", " (Liq.)", " PH I", "TPS"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 6))) for _ in range(1500)]
    assert apply(spark, texts, lambda d: X.strip_suffixes(d.a, X.FEED_SUFFIXES)) == [naive_strip(t, X.FEED_SUFFIXES) for t in texts]


def test_clean_match(spark):
    got = apply(spark, ["GEM: Korba power station", "GPPD: Tuticorin (score: 87)", "Plain", None], lambda d: X.clean_match(d.a))
    assert [(r.source, r.name) for r in got] == [("GEM", "Korba power station"), ("GPPD", "Tuticorin"), (None, "Plain"), (None, None)]


def test_flags_and_ids(spark):
    assert apply(spark, ["BHADRA HPS", "KORBA STPS", None, "X GT-2"], lambda d: X.likely_not_coal(d.a)) == [True, False, False, True]
    assert [tuple(r) for r in apply(spark, ["1|2", "1 | 2", "1", "1|2|3", None], lambda d: X.split_pair(d.a))] == [("1", "2"), ("1", "2"), (None, None), (None, None), (None, None)]
    assert apply(spark, ["EIA: 7, X: 2", "X: 1", None], lambda d: X.labelled_id(d.a)) == ["7", None, None]
    assert apply(spark, ["High", " MEDIUM ", None], lambda d: X.confidence_key(d.a)) == ["high", "medium", None]
    assert apply(spark, ["GEM: Foo", "Bar"], lambda d: X.without_label(d.a)) == ["foo", "bar"]
    assert apply(spark, [(86.5,), (87.5,)], lambda d: X.candidate_line(F.lit("GEM"), F.lit("n"), d.a), "a double") == ["  GEM: n (score: 86)", "  GEM: n (score: 88)"]
    assert re.fullmatch("plantid", X.column_key(" Plant Id "))
