"""Leakage, mixing and personal information on small fixtures."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltlace.llm import leakage, mixing, pii
from voltlace.llm.fmindex import FMIndex, suffix_array
from voltlace.session import cut


def test_fm_index_equals_brute_force():
    rng = np.random.default_rng(1)
    for n, sigma in ((1, 2), (50, 3), (400, 2), (700, 40)):
        text = rng.integers(1, sigma + 1, n)
        full = np.append(text, 0)
        assert list(suffix_array(full)) == sorted(range(n + 1), key=lambda i: list(full[i:]))
        index = FMIndex(text, 7)
        phrases = np.array([text[i : i + 3] for i in range(max(1, n - 2)) if i + 3 <= n] + [[1, 1, 1], [sigma, 1, 900]])
        lo, hi = index.search(phrases)
        for p, a, b in zip(phrases, lo, hi):
            want = [i for i in range(n - 2) if list(text[i : i + 3]) == list(p)]
            assert sorted(index.locate(np.arange(a, b))) == want


WORDS = [f"w{i}" for i in range(400)] + ["fly-ash", "last year's"]


def passage(rng, n):
    return " ".join(rng.choices(WORDS, k=n)) + "."


def test_leakage(spark):
    rng = random.Random(2)
    items = [(i, passage(rng, 60), passage(rng, 24)) for i in range(6)] + [(90, None, None), (91, "", "x"), (92, None, passage(rng, 30))]
    p = {i: (a, b) for i, a, b in items}
    other = lambda k: " ".join(f"z{rng.randint(0, 99)}" for _ in range(k))
    cut12 = lambda t, k, n: " ".join(t.split()[k : k + n])
    changed = p[2][0].split()
    for i in range(0, len(changed), 9):
        changed[i] = "other"
    docs = [
        (1, f"{other(30)} {cut12(p[0][0], 5, 14)} {other(30)}", {0}), (2, f"{other(9)} {cut12(p[0][0], 5, 9)} {other(9)}", set()), (3, f"{other(3)}\n\n{p[1][1].upper()} {other(2)}", {1}),
        (4, " ".join(changed), {2}), (5, p[3][0].replace(" ", "  \n ").replace("-", "‐").replace(".", " !"), {3}), (6, p[4][0].replace("fly-ash", "flyash") + " " + p[5][0].replace("fly-ash", "fly ash"), {4, 5}),
        (7, None, set()), (8, "", set()), (9, other(20000) + " " + p[0][0] + other(2000), {0}), (10, f"{cut12(p[92][1], 0, 20)}", {92}), (1, "again " + cut12(p[0][0], 5, 14), {0}), (11, cut12(p[0][0], 0, 6) + " x " + cut12(p[1][0], 0, 6), set()),
    ]
    d = spark.createDataFrame([(i, t, "clash") for i, t, _ in docs], "doc_id long, text string, item_id string").drop("item_id")
    it = spark.createDataFrame(items, "item_id long, passage string, question string")
    want = {(i, k) for i, _, ks in docs for k in ks}
    for shard, block in ((200_000, 5000), (50, 4)):
        spans = leakage.find_spans(d, it, shard, block)
        assert {tuple(r) for r in leakage.leaked_items(spans).collect()} == want
    text = dict((i, t) for i, t, _ in docs[1:])
    for r in leakage.removal_spans(spans.where("doc_id = 9")).collect():
        assert leakage.Words([]).spans(text[9][r.first_char : r.end_char])[0][0] == leakage.Words([]).spans(p[0][0])[0][0]
    assert leakage.find_spans(d.limit(0), it).count() == 0 and leakage.find_spans(d, it.limit(0)).count() == 0


def test_removal_covers_edited_passages_whole():
    item = [f"w{i}" for i in range(60)]
    edit = lambda step, keep=0: [w if i < keep or i % step else "edited" for i, w in enumerate(item)]
    other = lambda n: [f"z{i}" for i in range(n)]

    def removed(words):
        material = leakage.Material([(1, " ".join(item), None)])
        text = " ".join(words)
        hit = {k for *_, a, b in leakage._search_shard(material, [(7, material.words.spans(text))]) for k in range(a, b)}
        places = leakage.Words([]).spans(text)
        return [i for i, (_, a, b) in enumerate(places) if a in hit and b - 1 in hit]

    assert removed(other(50) + edit(9, 15) + other(50)) == list(range(50, 110))  # one run of 12 words and more, the others shorter
    assert set(removed(other(20) + edit(9) + other(30) + edit(9) + other(9))) == {*range(21, 80), *range(111, 170)}  # two copies; what lies between stays
    assert removed(other(5) + edit(9)[:20] + other(5)) == []


def test_removal_spans_merge(spark):
    df = spark.createDataFrame([(1, 0, 5), (1, 5, 9), (1, 3, 4), (1, 20, 30), (2, 1, 2)], "doc_id long, first_char int, end_char int")
    assert sorted(tuple(r) for r in leakage.removal_spans(df).collect()) == [(1, 0, 9), (1, 20, 30), (2, 1, 2)]


@pytest.mark.parametrize("per_range", [1000, 1])
def test_mixing(spark, per_range):
    rng = random.Random(3)
    docs = [(i, rng.choice(["big"] * 6 + ["small", "free", None]), " word" * rng.randint(1, 40)) for i in range(300)] + [(900, "big", None), (901, "small", "")]
    d = spark.createDataFrame([(*x, "clash") for x in docs], "doc_id long, source string, text string, tokens string")
    t = spark.createDataFrame([("big", 0.5, 1), ("small", 0.3, 3), ("gone", 0.2, 2), ("small", 0.1, 4), (None, 0.5, 1), ("free", None, 1)], "source string, target_share double, max_repeats int")
    got = mixing.mix(d, t, docs_per_range=per_range, cut=cut)
    shares = {r.source: r for r in got.shares.collect()}
    size = {s: sum(len((x[2] or "").split()) for x in docs if x[1] == s) for s in ("big", "small")}
    assert {s: shares[s].available_tokens for s in size} == size and shares["gone"].actual_share == 0 and shares["free"].actual_tokens == 0
    total = min(size["big"] * 1 / (0.5 / 0.9), size["small"] * 3 / (0.4 / 0.9))
    for s, share in (("big", 0.5 / 0.9), ("small", 0.4 / 0.9)):
        assert 0 <= total * share - shares[s].actual_tokens <= 41 and abs(shares[s].actual_share - share) < 0.1
    chosen = got.documents.collect()
    assert all(r.repeats <= {"big": 1, "small": 3}[r.source] for r in chosen) and len({r.doc_id for r in chosen}) == len(chosen)
    assert {r.repeats for r in chosen if r.source == "small"} <= {shares["small"].most_repeats, shares["small"].most_repeats - 1}
    again = mixing.mix(d, t, docs_per_range=7, cut=cut).documents
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, chosen))
    assert mixing.mix(d.limit(0), t, cut=cut).documents.count() == 0 and mixing.mix(d, t.limit(0), cut=cut).documents.count() == 0


FOUND = [
    ("Reply to jo.doe+x@mail.example.com.", [("email", "jo.doe+x@mail.example.com")]),
    ("cc: a-b (at) grid (dot) example (dot) org; c_d AT desk DOT example", [("email", "a-b (at) grid (dot) example (dot) org"), ("email", "c_d AT desk DOT example")]),
    ("On duty was Tobin Pelocke (07700 900941).", [("person_name", "Tobin Pelocke"), ("phone", "07700 900941")]),
    ("Badge issued to VELLVANE, Rowan, national id QQ 31 37 57 D, phone (607) 555-0153.", [("person_name", "VELLVANE, Rowan"), ("national_id", "QQ 31 37 57 D"), ("phone", "(607) 555-0153")]),
    ("Gate log: W. Quervane, identity number 07571066407, arrived.", [("person_name", "W. Quervane"), ("national_id", "07571066407")]),
    ("Send the samples to 161/3 Signal Avenue, Foo 85430.", [("street_address", "161/3 Signal Avenue")]),
    ("Adres: ul. Kwiatowa 71a, Foo 68119.", [("street_address", "ul. Kwiatowa 71a")]),
    ("Anschrift: Uferstraße 2B, Foo 14201. Telefon (607) 555-0153, Herr Eike Grauwede.", [("street_address", "Uferstraße 2B"), ("phone", "(607) 555-0153"), ("person_name", "Eike Grauwede")]),
    ("Endereço: Rua do Moinho, 131a, Foo 02744.", [("street_address", "Rua do Moinho, 131a")]),
    ("Documento 000.180.238-15 em nome de Jacinto Braga-Novas.", [("national_id", "000.180.238-15"), ("person_name", "Jacinto Braga-Novas")]),
    ("Her SSN 123 45 6789.", [("national_id", "123 45 6789")]),
    ("Please call us Montag 0171 555 1234.", [("phone", "0171 555 1234")]),
    ("Maria Lopez called about the outage.", [("person_name", "Maria Lopez")]),
    ("Then the operator Anna Kowalska said no.", [("person_name", "Anna Kowalska")]),
    ("Contact:\nWilma Marroway\n225 Tannery Close\nFoo 25249\nTel. +1 212 555 0144\nx_y@a.example", [("person_name", "Wilma Marroway"), ("street_address", "225 Tannery Close"), ("phone", "+1 212 555 0144"), ("email", "x_y@a.example")]),
]
CLEAN = [
    "Serial 89822066737 is stamped. Serial 2295 8820 6309 is stamped. Serial SN7575515 too.", "Order 152-30-1641/B and Drawing 134-11-C938. The permit 2020-80-2706/P covers 12.5 MW.", "Meter M-4893 3796 read 23283 kWh.",
    "The Farrah Vellerly hydro scheme, named after its first engineer.", "Thornoway & Partners Ltd won the order.", "Traffic on Quarry Road was diverted. In July 2018 the yaw drive ran.", "id G100820043525 at 20.8543, 80.2101", "", None,
]


@pytest.mark.parametrize("text,want", FOUND)
def test_pii_found(text, want):
    assert [(s.kind, text[s.start : s.end]) for s in pii.find_spans(text)] == want


@pytest.mark.parametrize("text", CLEAN)
def test_pii_clean(text):
    assert pii.find_spans(text) == [] and pii.masked(text) == text


def test_values_are_masked_everywhere():
    text = "On duty was Tobin Pelocke (07700 900941). Later Tobin Pelocke left; Tobin Pelockes did not. Passport AB123456. Copy of AB123456, not of AB1234567."
    assert pii.masked(text) == "On duty was [PERSON_NAME] ([PHONE]). Later [PERSON_NAME] left; Tobin Pelockes did not. Passport [NATIONAL_ID]. Copy of [NATIONAL_ID], not of AB1234567."
    assert pii.masked("Gate log: Tobin Pelocke. Send it to Tobin Pelocke-Marr.") == "Gate log: [PERSON_NAME]. Send it to [PERSON_NAME]-Marr."


# confirmed without a label, refuted without one, carried by a label all the same
NUMBERS = [
    ("111.444.777-35", "111.444.777-36"), ("44051401359", "44051401358"), ("2341 2341 2346", "2341 2341 2347"), ("12345678Z", "12345678A"), ("8001015009087", "8001015009086"), ("811218-9876", "811218-9875"),
    ("123-45-6789", "923-45-6789"), ("AB 12 34 56 C", "QQ 12 34 56 C"), ("2 55 08 14 168 025 38", "2 55 08 14 168 025 39"),
]


@pytest.mark.parametrize("right,wrong", NUMBERS)
def test_checks_decide(right, wrong, monkeypatch):
    found = lambda t: [t[s.start : s.end] for s in pii.find_spans(t) if s.kind == "national_id"]
    assert found(f"He wrote {right} on the form.") == [right] and found(f"He wrote {wrong} on the form.") == []
    assert found(f"His identity number {wrong} is known.") == [wrong]
    assert found(f"It is meter {right} here.") == []
    monkeypatch.setattr(pii, "VALIDATORS", {})
    assert found(f"He wrote {right} on the form.") == [] or found(f"He wrote {wrong} on the form.") == [wrong]


def test_checks_refuse_what_a_hint_alone_would_carry():
    found = lambda t: [s.kind for s in pii.find_spans(t)]
    assert found("44051401359 issued to nobody") == ["national_id"] and found("44051401358 issued to nobody") == []
    # accounts and cards are neither identity nor phone numbers
    assert found("Pay 4539 1488 0343 6467 or GB82 WEST 1234 5698 7654 32.") == []


def test_checksums():
    assert pii.luhn("4539148803436467") and not pii.luhn("4539148803436468")
    assert pii.mod97("GB82WEST12345698765432"[4:] + "GB82") and pii.mod11_pair("11144477735") and pii.weighted10("44051401359") and pii.verhoeff("2363") and not pii.verhoeff("2364")


def test_pii_tables(spark):
    long = "x. " * 100_000 + FOUND[0][0]
    docs = [(i, t, "clash") for i, (t, _) in enumerate(FOUND)] + [(50, None, "c"), (51, "", "c"), (52, long, "c"), (53, f"{FOUND[0][0]} {FOUND[0][0]}", "c")]
    d = spark.createDataFrame(docs, "doc_id long, text string, pii_kind string")
    got = {tuple(r) for r in pii.find(d).collect()}
    assert got == {(i, *w) for i, (_, ws) in enumerate(FOUND) for w in ws} | {(52, *FOUND[0][1][0]), (53, *FOUND[0][1][0])}
    assert pii.find(d).count() == len(got) and pii.find(d.limit(0)).count() == 0
    masked = {r.doc_id: r.text for r in pii.redact(d.drop("pii_kind")).collect()}
    assert masked[2] == "On duty was [PERSON_NAME] ([PHONE])." and masked[50] is None and masked[51] == "" and masked[53] == "Reply to [EMAIL]. Reply to [EMAIL]."
    assert d.select(F.count("*")).first()[0] == len(docs)
