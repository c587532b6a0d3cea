from __future__ import annotations

import random

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from voltlace.functions.similarity import ratio
from voltlace.operators import dedup, folds, joins, reports
from voltlace.operators.orphans import eia_orphans
from voltlace.operators.similarity_join import top_matches


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_top_matches_equal_brute_force_in_any_block_size(spark):
    names = [("A", "ALPHA BETA"), ("A", "GAMMA"), ("B", "ALPHA"), ("A", ""), ("A", None), ("C", "X")]
    cat = [("A", "BETA ALPHA", "n0", 0), ("A", "GAMMAS", "n1", 1), ("A", "GAMMA", "n2", 2), ("A", "GAMMA", "n3", 3), ("B", "ALPHAS", "n4", 4), ("B", "BETA", "n5", 5)]
    want = []
    for g, k in names:
        if not k:
            continue
        scored = sorted(((-ratio(" ".join(sorted(k.split())), " ".join(sorted(c.split()))), o, n) for gg, c, n, o in cat if gg == g), key=lambda x: x[:2])
        want += [(g, k, n, o, -s) for s, o, n in scored[:2] if -s >= 50]
    n, c = spark.createDataFrame(names, "grp string, key string"), spark.createDataFrame(cat, "grp string, key string, name string, ord long")
    for block in (100, 2):
        got = top_matches(n, c, 2, 50.0, block).drop("rank")
        assert rows(got) == sorted(want, key=str)
    assert top_matches(n.limit(0), c).count() == 0 and top_matches(n, c.limit(0)).count() == 0


def test_lengths_rule_out_no_hit(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abc", k=rng.randint(1, 9)))
    names = [("A", f"{word()} {word()}") for _ in range(40)] + [("A", "x" * 70)]
    cat = [("A", k, f"n{i}", i) for i, k in enumerate([f"{word()} {word()}" for _ in range(60)] + ["x" * 66, "x" * 300])]
    n, c = spark.createDataFrame(names, "grp string, key string"), spark.createDataFrame(cat, "grp string, key string, name string, ord long")
    tidy = lambda k: " ".join(sorted(k.split()))
    for cutoff in (80.0, 60.0):
        want = {(k, o) for _, k in set(names) for _, x, _, o in cat if ratio(tidy(k), tidy(x)) >= cutoff}
        assert {(r.key, r.ord) for r in top_matches(n, c, 99, cutoff).collect()} == want


def test_scorer_of_ones_own(spark):
    n, c = spark.createDataFrame([("A", "ab"), ("A", "xyz")], "grp string, key string"), spark.createDataFrame([("A", "abc", "n0", 0), ("A", "b", "n1", 1)], "grp string, key string, name string, ord long")
    got = top_matches(n, c, 1, 50.0, scorer=lambda a, b: 100.0 * (a[0] == b[0]))
    assert [(r.key, r.name, r.score) for r in got.collect()] == [("ab", "n0", 100.0)]


def test_fold_units(spark):
    u = spark.createDataFrame(
        [("P", "wind", "5 MW", None, 1.0, 1.0, 0), ("P", "coal: lignite", "10 MW", "CFB", 2.0, 2.0, 1), ("P", "coal: bituminous", None, "USC", 3.0, 3.0, 2), ("P", "coal", "7", None, 4.0, 4.0, 3), ("Q", "gas", "9", "CFB", 5.0, None, 4), (None, "coal", "1", None, 0.0, 0.0, 5)],
        "name string, fuel string, capacity string, technology string, latitude double, longitude double, ord long",
    )
    assert rows(folds.fold_units(u)) == [("P", 0, 2.0, 2.0, "lignite", "CFB", 17.0), ("Q", 4, 5.0, None, None, None, None)]


def test_curated_fold(spark):
    u = spark.createDataFrame(
        [("A", 0, "coal: unknown", "10", None, None, 1.0, "x", None, "s"), ("A", 1, "coal: lignite", "5", "CFB", 2.0, 3.0, "y", "st", None), ("B", 2, None, None, None, 1.0, None, None, None, None), (None, 3, None, None, None, 1.0, 1.0, None, None, None)],
        "plant string, ord long, fuel string, capacity string, technology string, latitude double, longitude double, project_name string, state string, sector string",
    )
    assert rows(folds.curated_fold(u)) == [("A", 2.0, 3.0, 15.0, "lignite", "CFB", "x", "st", "s")]


def test_dedup(spark):
    df = spark.createDataFrame([("a", 1.0, 3), ("a", None, 1), ("a", 1.0, 2), (None, 5.0, 4), (None, 6.0, 5)], "k string, v double, t int")
    assert rows(dedup.keep_highest(df, "k", "v", "t")) == sorted([("a", 1.0, 2), (None, 5.0, 4), (None, 6.0, 5)], key=str)
    assert dedup.duplicate_row_count(df, "k").first()[0] == 3 and dedup.duplicate_row_count(df.limit(0), "k").first()[0] == 0
    names = spark.createDataFrame([("Foo TPS", 1), ("Foo", 0), ("(Liq.)", 2), ("Foo", 3), (None, 4)], "name string, ord long")
    cut = lambda c: F.trim(F.regexp_replace(F.upper(c), r" TPS$|\(LIQ\.\)", ""))
    assert rows(dedup.name_index(names, cut)) == [("FOO", "Foo", 0)]
    assert rows(dedup.name_collisions(names, cut)) == [("FOO", 2)]


def test_joins_with_nulls(spark):
    left = spark.createDataFrame([("a", None), ("b", "x"), (None, None)], "n string, f string")
    right = spark.createDataFrame([("a", None), (None, None), (None, None)], "n string, f string")
    assert rows(joins.anti_join(left, right, ["n", "f"])) == [("b", "x")]
    cat = spark.createDataFrame([("GEM", "a", 1.0), ("GPPD", "a", 2.0), ("GPPD", "b", 3.0)], "source string, name string, v double")
    asked = spark.createDataFrame([(1, "GEM", "a"), (2, None, "a"), (3, "GEM", "b"), (4, "GEM", "c")], "id int, source string, name string")
    assert rows(joins.unique_holder(asked, cat, ["v"])) == [(1, "GEM", "a", 1.0), (2, None, "a", None), (3, "GPPD", "b", 3.0), (4, "GEM", "c", None)]
    old = spark.createDataFrame([("a", "EIA"), ("b", None), ("c", "OE")], "n string, f string")
    assert rows(joins.replace_partitions(old, old.where("n = 'a'"), "f", ["EIA"])) == sorted([("a", "EIA"), ("b", None), ("c", "OE")], key=str)


def test_reports(spark):
    df = spark.createDataFrame([("x", 1), ("x", None), ("y", None)], "g string, v int")
    got = reports.coverage(df, "g", "v")
    assert rows(got.drop("pct")) == [("all", 3, 1), ("x", 2, 1), ("y", 1, 0)]
    assert {r.g: round(r.pct, 6) for r in got.collect()} == {"all": 33.333333, "x": 50.0, "y": 0.0}


def t(day):
    return None if day is None else datetime(2020, 1, day)


GEN = "gen_row_id long, plant_code string, generator_id string, report_date timestamp, loaded_at timestamp, extra string"
INFO = "info_row_id long, plant_code string, generator_id string, loaded_at timestamp, deleted_at timestamp"
LOOK = "plant_code string, loaded_at timestamp, deleted_at timestamp"


def brute(gen, info, look):
    def code(s):
        s = s.strip()
        whole, _, frac = s.partition(".")
        return int(whole) if whole.isdigit() and set(frac) <= {"0"} else None

    blank = lambda s: s is None or not s.strip()
    refs = [("eia_generation_data", g[0], "eia_plant_lookup", code(g[1]), None, g[4]) for g in gen if not blank(g[1])]
    refs += [("eia_generation_data", g[0], "eia_generator_info", code(g[1]), g[2].strip().upper(), g[4]) for g in gen if not blank(g[1]) and not blank(g[2])]
    refs += [("eia_generator_info", i[0], "eia_plant_lookup", code(i[1]), None, i[3]) for i in info if not blank(i[1])]
    targets = [("eia_plant_lookup", code(x[0]), None, x[1], x[2]) for x in look if not blank(x[0])]
    targets += [("eia_generator_info", code(x[1]), x[2].strip().upper(), x[3], x[4]) for x in info if not blank(x[1]) and not blank(x[2])]
    out = []
    for table, row, target, c, g, at in refs:
        own = [x for x in targets if x[0] == target and c is not None and x[1] == c and x[2] == g]
        begun = [x for x in own if x[3] is not None and at is not None and x[3] <= at]
        if not any(x[4] is None or x[4] > at for x in begun):
            out.append((table, row, target, "deleted" if begun else "late" if own else "missing"))
    return sorted(out, key=str)


@pytest.mark.parametrize("salts", [1, 5])
def test_orphans_equal_brute_force(spark, salts):
    gen = [(i, c, g, t(3), t(d), "z") for i, (c, g, d) in enumerate([("1", "A", 5), (" 001.0 ", "a ", 5), ("1", "B", 5), ("2", "A", 2), ("2", "A", 9), ("x", "A", 5), ("", "A", 5), (None, "A", 5), ("1", " ", 5), ("3", "A", 5), ("1", "A", None), ("1", "A", 4), ("3", None, 8), ("1.5", "A", 5)])]
    info = [(100, "1", "A", t(4), None), (101, "2", "a", t(1), t(6)), (102, "9", "Q", t(1), None), (103, "01", None, t(1), None), (104, None, "Z", t(2), None), (105, "3", "A", None, None)]
    look = [("1", t(1), None), ("2", t(3), t(9)), ("3", t(8), None)]
    g, i, k = spark.createDataFrame(gen, GEN), spark.createDataFrame(info, INFO), spark.createDataFrame(look, LOOK)
    got = eia_orphans(g, i, k, salts)
    assert rows(got.drop("period")) == brute(gen, info, look)
    assert eia_orphans(g.limit(0), i.limit(0), k).count() == 0
    assert eia_orphans(g, i, k.limit(0)).where("target_table = 'eia_plant_lookup'").count() == len([x for x in brute(gen, info, []) if x[2] == "eia_plant_lookup"])
