from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from voltlace.functions import domain as D
from voltlace.functions.similarity import Catalogue, _Block, lcs_length, ratio


def one(spark, values, f, kind="string"):
    return [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, a {kind}").orderBy("i").select(f(F.col("a"))).collect()]


def test_capacities(spark):
    assert one(spark, ["660.0 MW", "50MW", "1,200", "800", "", None, "1.0d", "abc"], D.catalogue_capacity) == [660.0, 50.0, None, 800.0, None, None, None, None]
    assert one(spark, ["96.0 MW", "1,200 MW", "1.2.3", "MW", None], D.leading_capacity) == [96.0, 1.0, None, None, None]


def test_fuels_and_technologies(spark):
    fuels = ["coal: bituminous", "coal: bituminous, natural gas", "coal: waste coal", "coal: unknown", "coal", "natural gas, coal: lignite", None, " Coal: Lignite "]
    assert one(spark, fuels, D.coal_type) == ["bituminous", "bituminous", "waste", None, None, None, None, "lignite"]
    assert one(spark, fuels, D.coal_type_word) == ["bituminous", "bituminous", "waste", "unknown", "unknown", "lignite", "unknown", "unknown"]
    assert one(spark, fuels, D.is_coal) == [True, True, True, True, True, False, False, True]
    assert one(spark, ["Ultra-Supercritical", "USC", "cfb", "IGCC", "gas turbine", "unknown", None], D.combustion_tech) == ["ultra-supercritical", "ultra-supercritical", "CFB", "IGCC", None, None, None]


def test_coordinates(spark):
    df = spark.createDataFrame([(0.0, 0.0), (52.5, 13.4), (-33.8, 151.2), (91.0, 0.0), (10.0, 181.0), (float("nan"), 13.4), (None, 1.0), (0.0, 5.0)], "a double, b double")
    assert [r[0] for r in df.select(D.valid_coordinates(df.a, df.b)).collect()] == [False, True, True, False, False, False, False, True]


def naive_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b):
            row[j + 1] = last[j] + 1 if x == y else max(last[j + 1], row[j])
    return row[-1]


def test_similarity():
    assert round(ratio("VINDHYACHAL", "VINDHYANCHAL"), 2) == 95.65
    assert round(ratio("BHADRA", "BHANDARA"), 2) == 85.71
    assert ratio("", "") == 100.0 and ratio("", "A") == 0.0
    rng = random.Random(1)
    for _ in range(400):
        a, b = ("".join(rng.choices("ABCD ", k=rng.randint(0, 90))) for _ in range(2))
        assert lcs_length(a, b) == naive_lcs(a, b)
        scores = Catalogue([b, a, "", b + a]).scores(a)
        assert list(scores) == [ratio(x, a) for x in (b, a, "", b + a)]


def test_best_equals_all_scores_sorted():
    rng = random.Random(2)
    for case in range(40):
        letters = ("abc", "ABCDEFGHIJKLMNOPQRSTUVWXYZ 0", "aé\U0001f600" + "".join(map(chr, range(300, 500))))[case % 3]
        longest = (6, 20, 40, 150)[case % 4]
        make = lambda: "".join(rng.choices(letters, k=rng.randint(0, longest)))
        keys, k, cutoff = [make() for _ in range(rng.choice((0, 3, 200)))], rng.choice((1, 3, 15, 999)), rng.choice((None, 50.0, 80.0))
        texts, ords = [make() + "#" for _ in range(9)] + keys[:9], np.array([rng.randint(0, 20) for _ in keys], np.int64)
        for text, (places, scores) in zip(texts, Catalogue(keys).best(texts, k, cutoff, ords)):
            want = sorted((-s, o) for s, o in zip((ratio(x, text) for x in keys), ords) if cutoff is None or s >= cutoff)[:k]
            assert list(zip(-scores, ords[places])) == want and [ratio(keys[i], text) for i in places] == list(scores)


def test_without_a_cutoff_lengths_and_common_endings_save_work(monkeypatch):
    looked, steps = [], []
    lcs, room = _Block.lcs, np.bitwise_xor
    monkeypatch.setattr(_Block, "lcs", lambda self, text: looked.append(self.size) or lcs(self, text))
    monkeypatch.setattr(np, "bitwise_xor", lambda *a: steps.append(1) or room(*a))
    names = [x + "QZX" for x in "ABCDEFGH"]
    catalogue = Catalogue(names + ["A" * 40] * 50)
    found = catalogue.best(names, 1, None, np.arange(58))
    assert [(p[0], s[0]) for p, s in found] == [(i, 100.0) for i in range(8)]
    assert looked == [8] * 8 and len(steps) == 8 + 3  # long keys cannot beat an equal one; the ending is done once
