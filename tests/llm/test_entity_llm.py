"""Entity matching, belief propagation and survivorship on small fixtures."""

from __future__ import annotations

import itertools
import random
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from voltlace.llm import entity, survivor
from voltlace.session import cut

ROWS = "table_name string, row_id long, name string, hint string, country string, state string, fuel string, latitude double, longitude double, restored string, garbled boolean, block string"
G, P, X = "gem_database", "gppd", "unified_plant_crosswalk"


def rows_of(spark, rows):
    full = [(t, i, n, None, c, s, f, la, lo, None, None, "clash") for t, i, n, c, s, f, la, lo in rows]
    return spark.createDataFrame(full, ROWS)


PLANTS = [
    (G, 1, "Bogusawa power station", "JPN", "Kita", "coal", 40.0, 140.0), (G, 2, "Bogusawa Power Plant", "JPN", None, "coal", None, None), (G, 3, "Bogusswa power station", "JPN", "Kita", None, 40.003, 140.002), (G, 4, "Bogusawa power station", "JPN", "Kita", "coal", 40.0, -140.0),
    (G, 5, "Bogusawa power station", "JPN", "Nishi", "wind", 33.0, 131.0), (G, 6, "Bogusawa II power station", "JPN", "Kita", "coal", 40.0, 140.0), (G, 7, None, None, None, None, None, None), (G, 8, "power station", "JPN", None, None, 1.0, 1.0),
    (P, 11, "BOGUSAWA", "JPN", None, "coal", 40.001, 140.001), (P, 12, "Bogusawa", "JPN", None, "wind", None, None), (P, 13, "Bogusawa II", "JPN", None, None, None, None), (P, 14, "BOGUSAWA", "JPN", None, "coal", 40.001, 140.001), (P, 15, "Bogusawa", "BRA", None, "coal", None, None),
    (X, 21, "ボグサワ発電所", "JPN", "Kita", None, 40.002, 140.0), (X, 22, "Bogusawa B01", "JPN", "Nishi", None, None, None), (X, 23, "Bogusawa B02", "JPN", "Nishi", None, 33.001, 131.0),
]


def test_match(spark):
    sites = [{1, 2, 3, 4, 11, 14, 21}, {5, 12, 22, 23}, {6, 13}]
    table = {r[1]: r[0] for r in PLANTS}
    want = {(a, b) for s in sites for a, b in itertools.combinations(sorted(s), 2) if table[a] != table[b]}
    got = entity.match(rows_of(spark, PLANTS), cut).collect()
    assert {(r.id_a, r.id_b) for r in got} == want and len(got) == len(want)
    assert all(0.5 <= r.confidence <= 1 for r in got)
    assert entity.match(rows_of(spark, PLANTS).limit(0), cut).count() == 0
    assert entity.match(rows_of(spark, PLANTS[:4]), cut).count() == 0


def exact_marginals(pairs):
    """Sum over all one-to-one assignments (per mention and other table)."""
    total, hits = 0.0, [0.0] * len(pairs)
    for choice in itertools.product((0, 1), repeat=len(pairs)):
        used, w, ok = set(), 1.0, True
        for on, (a, b, ta, tb, odds) in zip(choice, pairs):
            if on:
                keys = {(a, ta, tb), (b, tb, ta)}
                if used & keys:
                    ok = False
                    break
                used |= keys
                w *= odds
        if ok:
            total += w
            for i, on in enumerate(choice):
                hits[i] += w * on
    return [h / total for h in hits]


def test_belief_propagation_is_exact_on_trees_and_near_on_loops(spark):
    tree = [("a1", "b1", G, P, 20.0), ("a1", "b2", G, P, 5.0), ("a2", "b2", G, P, 3.0), ("a1", "c1", G, X, 2.0), ("d1", "e1", G, P, 4.0)]
    loop = [("a1", "b1", G, P, 20.0), ("a1", "b2", G, P, 1.0), ("a2", "b1", G, P, 2.0), ("a2", "b2", G, P, 9.0)]
    for pairs, near in ((tree, 0.01), (loop, 0.08)):
        df = spark.createDataFrame(pairs, "a string, b string, table_a string, table_b string, odds double")
        got = {(r.a, r.b, r.table_b): r.marginal for r in entity.propagate(df, cut, 120, 1e-4).collect()}
        for p, m in zip(pairs, exact_marginals(pairs)):
            assert abs(got[p[0], p[1], p[3]] - m) < near
    assert entity.propagate(df.limit(0), cut).count() == 0


def test_message_rounds_that_do_not_settle_are_reported(spark):
    loop = [("a1", "b1", G, P, 20.0), ("a1", "b2", G, P, 1.0), ("a2", "b1", G, P, 2.0), ("a2", "b2", G, P, 9.0), ("a9", "b9", G, P, 9.0)]
    df = spark.createDataFrame(loop, "a string, b string, table_a string, table_b string, odds double")
    with pytest.warns(UserWarning, match="after 1 rounds"):
        got = {r.a: r.settled for r in entity.propagate(df, cut, 1).collect()}
    assert got == {"a1": False, "a2": False, "a9": True}


def test_block_of_many_combinations():
    """Time grows with their number: 100,000 combinations of one name, most without coordinates of use."""
    rng = random.Random(4)
    one = lambda i, t: {"combo": i, "table_name": t, "base": "santa", "country": rng.choice(["BRA", "CHL", None]), "state": rng.choice(["s%d" % rng.randint(0, 30), None]), "fuel": rng.choice(["hydro", "wind", None]), "n": 1}
    rows = [one(i, rng.choice((G, P, X))) | ({"la": round(rng.uniform(-60, 60), 2), "lo": round(rng.uniform(-90, 90), 2)} if i % 3 else {"la": None, "lo": None}) for i in range(100_000)]
    began = time.process_time()
    members, pairs = entity.judge_block("santa", rows)
    assert len(members) == len({m for m, _ in members}) == 100_000 and len(pairs) < 40 * 100_000
    assert time.process_time() - began < 120


def test_plant_of_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(entity, "SLICE", 7)
    rows = [(G, i, "Bogusawa power station", "JPN", "Kita", "coal", 40.0, 140.0) for i in range(60)] + [(P, 1000 + i, "BOGUSAWA", "JPN", None, "coal", 40.0, 140.0) for i in range(9)]
    rows += [(G, 2000 + i, f"Place{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]} plant", "JPN", None, "coal", 1.0 + i, 1.0) for i in range(99)]
    got = entity.match(rows_of(spark, rows), cut).select("id_a", "id_b").collect()
    assert len(got) == len(set(got)) == 60 * 9 and {r.id_a for r in got} == set(range(60))


GEM = "gem_row_id long, unit_id string, project_name string, unit_name string, country string, subnational string, fuel string, capacity string, technology string, status string, latitude double, longitude double, record_source string, last_updated timestamp, plant string, unit string"


def gem_rows(spark):
    t = lambda d: datetime(2020, 1, d)
    r = [
        (1, "G1", "Foo", "Unit 1", None, None, "coal", "5", None, "operating", 1.0, 2.0, "good", t(1)), (2, "G9", "foo", "#1", "IN", None, None, "6", " CFB ", "retired", None, 3.0, "bad", t(5)), (3, "G1", "FOO", None, "XX", "S", None, None, None, None, 0.0, 0.0, "bad", t(6)),
        (4, "G2", "Foo", "Unit 2", None, None, None, None, None, None, None, None, None, None), (5, None, "Foo", None, None, None, None, None, None, None, None, None, None, None),
        (6, "H1", "Bar", None, None, None, None, None, None, None, None, None, "odd", None), (7, None, "Bar", "Unit A", None, None, None, "7", None, None, None, None, "good", t(1)),
    ]
    gem = spark.createDataFrame([(*x, "clash", "clash") for x in r], GEM).drop("plant", "unit")
    members = spark.createDataFrame([(G, x[0], "foo@1" if x[2].lower() == "foo" else "bar@1") for x in r], "table_name string, row_id long, mention string")
    return gem, members


def test_unit_pairs_and_survivors(spark, monkeypatch):
    gem, members = gem_rows(spark)
    groups = survivor.unit_groups(gem, members)
    sources = spark.createDataFrame([("good", 1), ("bad", 2)], "record_source string, trust_rank int")
    records = survivor.surviving_units(gem, sources, groups)
    for size in (1000, 1):
        monkeypatch.setattr(survivor, "SLICE", size)
        pairs = survivor.duplicate_pairs(records, groups).collect()
        assert {tuple(r) for r in pairs} == {(1, 2), (1, 3), (2, 3), (6, 7)} and len(pairs) == 4
    assert survivor.duplicate_pairs(records.limit(0), groups).count() == 0  # no survivor, no pairs
    best = {(r.plant, r.unit): r for r in records.collect()}
    foo = best["foo@1", "u1"]
    assert (foo.country, foo.subnational, foo.capacity, foo.technology, foo.status, foo.latitude, foo.longitude, foo.n_rows) == ("XX", "S", "5", "CFB", "operating", 1.0, 2.0, 3)
    assert best["bar@1", "ua"].capacity == "7" and best["bar@1", "ua"].unit_id == "H1" and len(best) == 4
    assert survivor.surviving_units(gem.limit(0), sources, survivor.unit_groups(gem.limit(0), members)).count() == 0


def test_rows_without_a_place_survive(spark):
    gem, members = gem_rows(spark)
    groups = survivor.unit_groups(gem, members.where("row_id not in (6, 7)"))
    sources = spark.createDataFrame([("good", 1)], "record_source string, trust_rank int")
    best = {(r.plant, r.unit): r for r in survivor.surviving_units(gem, sources, groups).collect()}
    assert best["row 6", "row 6"].unit_id == "H1" and best["row 7", "row 7"].capacity == "7" and sum(r.n_rows for r in best.values()) == 7


def test_survivors_equal_brute_force(spark):
    import random

    rng = random.Random(5)
    data = [(rng.choice("ab"), rng.choice([None, "x", "y", "z"]), rng.randint(1, 3), rng.choice([None, 1, 2, 3])) for _ in range(60)]
    df = spark.createDataFrame(data, "k string, v string, p int, t int")
    got = {r.k: r.v for r in survivor.survivors(df, ["k"], {"v": F.col("v")}, F.col("p"), F.col("t")).collect()}
    key = lambda r: (r[1] is not None, r[2], r[3] is not None, r[3] or 0, r[1] or "")
    assert got == {k: max((r for r in data if r[0] == k), key=key)[1] for k in "ab"}
