from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from voltlace.functions import text as X
from voltlace.plans import matchers as M
from voltlace.plans import stages, unified
from voltlace.schema import OUTPUT
from voltlace.session import cut

UNITS = "unit_id string, name string, country string, fuel string, capacity string, technology string, latitude double, longitude double, ord long"
PLANTS = "name string, country string, latitude double, longitude double, ord long"
FEEDS = "plant_name string, plant_code string, source_system string, latitude double, longitude double"


@pytest.fixture(scope="module")
def inputs(spark):
    units = [
        ("u1", "Korba power station", "India", "coal: bituminous", "500 MW", "USC", 22.0, 82.0, 0), ("u2", "Korba power station", "India", "coal: bituminous", "100 MW", "USC", 22.0, 82.0, 1),
        ("u3", "Bhandara power station", "India", "coal", "10", None, 21.0, 79.0, 2), ("u4", "Zero power station", "India", "wind", "1", None, 0.0, 0.0, 3),
        ("u5", "Smith power station", "United States", "gas", "1", None, 40.0, -80.0, 4), ("u6", "Korba power station", "Japan", "wind", "1", None, 35.0, 135.0, 5),
    ]
    plants = [("Tuticorin", "IND", 8.7, 78.1, 0), ("Zero", "IND", 10.0, 76.0, 1), ("Sakura", "JPN", 36.0, 138.0, 2)]
    feeds = [
        ("KORBA STPS", None, "NPP", None, None), ("KORBA HPS", None, "NPP", None, None), ("BHADRA HPS", None, "NPP", None, None), ("TUTICORIN TPS", None, "NPP", None, None), ("ZERO TPS", None, "NPP", None, None),
        ("(Liq.)", None, "NPP", None, None), ("  ", None, "NPP", None, None), (None, None, "NPP", None, None), ("Sun", None, "OE", -30.0, 140.0), ("Sun", None, "OE", 0.0, 0.0), ("Moon", None, "OE", 95.0, 1.0),
        ("x", "7", "EIA", None, None), ("x", "8", "EIA", None, None), ("x", "9", "EIA", None, None), ("桜", None, "OCCTO", None, None),
    ]
    lookup = [("7", "Smith"), ("8", "Smith")]
    make = spark.createDataFrame
    return unified.Inputs(make(feeds, FEEDS), make(units, UNITS), make(plants, PLANTS), make(lookup, "plant_code string, plant_name string"))


def by_name(df):
    return {(r.plant_name, r.plant_code): r for r in df.collect()}


def test_unified_build(spark, inputs):
    out = unified.build(inputs, cut)
    assert out.schema == OUTPUT
    got = by_name(out)
    korba = got["KORBA STPS", None]
    assert (korba.ref_source, korba.ref_matched_name, korba.capacity_mw, korba.coal_type, korba.combustion_tech, korba.latitude) == ("GEM", "Korba power station", 600.0, "bituminous", "ultra-supercritical", 22.0)
    hydro = got["KORBA HPS", None]  # coordinates stay, coal attributes go
    assert (hydro.latitude, hydro.coal_type, hydro.capacity_mw) == (22.0, None, None)
    assert got["BHADRA HPS", None].matching_method is None  # score in the 80s without a common word
    assert got["TUTICORIN TPS", None].ref_source == "GPPD"
    assert got["ZERO TPS", None].ref_source == "GPPD"  # the best hit has no valid coordinates: next stage
    assert got["(Liq.)", None].ref_source is None and got["  ", None].ref_source is None and (None, None) not in got
    assert got["Sun", None].ref_source == "OE-direct" and got["Sun", None].latitude == -30.0 or got["Sun", None].latitude is None
    assert got["Moon", None].matching_method is None
    assert got["Smith", "7"].latitude == got["Smith", "8"].latitude == 40.0 and got["9", "9"].matching_method is None


def test_model_stage_and_merge(spark, inputs):
    class Says(M.NameMatcher):
        name = "says"

        def match(self, plant_name, candidates, source_system=None):
            if plant_name == "桜":
                assert "GPPD: Sakura" in candidates and "GEM: Korba power station" in candidates
                return M.MatchResult(plant_name, "GPPD: Sakura", "Crosswalk", " High ", "reads alike")
            if plant_name == "BHADRA HPS":
                assert candidates.split("\n")[0].startswith("  GEM: ")
                return M.MatchResult(plant_name, "Bhandara power station (score: 86)", {"a": 1}, "medium", "")
            return M.MatchResult(plant_name, {"no": "text"}, None, "high", "")

    out = by_name(unified.build(inputs, cut, Says))
    assert (out["桜", None].ref_source, out["桜", None].confidence, out["桜", None].latitude) == ("GPPD", "high", 36.0)
    bhadra = out["BHADRA HPS", None]
    assert (bhadra.matching_method, bhadra.ref_source, bhadra.latitude, bhadra.capacity_mw) == ("llm", "GEM", 21.0, None)
    existing = unified.build(inputs, cut)
    merged = unified.build(inputs, cut, sources=["EIA"], existing=existing)
    assert merged.count() == existing.count()
    with pytest.raises(FileNotFoundError):
        unified.build(unified.Inputs(inputs.feeds, inputs.units, inputs.plants, None), cut, sources=["EIA"])
    assert unified.named_feeds(unified.Inputs(inputs.feeds, inputs.units, inputs.plants, None), ["OE"]).count() == 3


def test_text_of_all_candidates_is_sent_once(spark, monkeypatch):
    """In the feed that gets whole catalogues no row carries the text itself."""
    plants = spark.createDataFrame([(f"桜{i}", None, "OCCTO", None, None) for i in range(50)] + [("KORBA", None, "NPP", None, None)], FEEDS)
    units = spark.createDataFrame([(f"u{i}", f"Plant {i}", "Japan", "coal", "1 MW", None, 30.0, 130.0, i) for i in range(200)] + [("k", "Korba", "India", "coal", "1 MW", None, 21.0, 82.0, 900)], UNITS)
    sent, run = [], stages.run_matcher
    monkeypatch.setattr(stages, "run_matcher", lambda candidates, *a: sent.append(candidates.agg(F.sum(F.length("candidates"))).first()[0]) or run(candidates, *a))

    class Last(M.NameMatcher):
        name = "last"

        def match(self, plant_name, candidates, source_system=None):
            lines = candidates.split("\n")
            assert len(lines) == (200 if source_system == "OCCTO" else 1)
            return M.MatchResult(plant_name, lines[-1], "GEM", "high", "")

    indexes, infos = {"GEM": stages.catalogue(spark, units, "GEM", X.comparison_key)}, {"GEM": stages.gem_info(spark, units)}
    got = stages.model_match(plants, indexes, infos, Last, cut).groupBy("ref_matched_name").count().collect()
    assert sorted(map(tuple, got)) == [("Korba", 1), ("Plant 199", 50)] and sent[0] < 100


def test_stand_in_is_no_model(spark, inputs):
    got = unified.build(inputs, cut, M.OfflineMatcher).where("confidence is not null").select("plant_name", "matching_method").collect()
    assert ("BHADRA HPS", "offline") in [tuple(r) for r in got] and {r.matching_method for r in got} == {"offline"}


def test_curated(spark, inputs):
    curated = spark.createDataFrame([("Coal", "korba  stps", "u1", "CG", None, 0), ("coal", "korba  stps", "u2", None, "Central", 1), ("coal", "none", "u1", None, None, 2), ("gas", "ZERO TPS", "u1", None, None, 3)], "type string, plant string, unit_id string, state string, sector string, ord long")
    r = by_name(stages.curated_match(inputs.feeds, curated, inputs.units))
    assert list(r) == [("KORBA STPS", None)]
    k = r["KORBA STPS", None]
    assert (k.capacity_mw, k.state, k.sector, k.confidence, k.matching_method, k.latitude) == (600.0, "CG", "Central", "high", "direct", 22.0)


def scripted(*replies):
    calls, slept = [], []

    def generate(system, user):
        calls.append(user)
        r = replies[min(len(calls), len(replies)) - 1]
        if isinstance(r, Exception):
            raise r
        return r

    return M.RemoteMatcher(generate, slept.append), calls, slept


def test_remote_matcher():
    good = json.dumps({"match": "GEM: A", "source": "GEM", "confidence": "high", "reasoning": "r"})
    m, calls, _ = scripted(f"Here: {good} ok")
    assert m.match("A", "").match == "GEM: A" and len(calls) == 1
    m, calls, slept = scripted(None)
    assert m.match("A", "").reasoning.startswith("API_FAILURE") and len(calls) == 3 and slept == [5.0, 10.0]
    m, calls, _ = scripted(M.RemoteError("busy", 503), good)
    assert m.match("A", "").match == "GEM: A" and len(calls) == 2
    m, calls, _ = scripted(M.RemoteError("bad key", 401))
    assert m.match("A", "").reasoning.startswith("API_FAILURE") and len(calls) == 1
    m, _, _ = scripted('{"match": null, "reasoning": "none"}')
    assert "FAILURE" not in m.match("A", "").reasoning
    for broken in ("no json", '{"match": ', '{"a": 1} x }'):
        assert scripted(broken)[0].match("A", "").reasoning.startswith("PARSE_FAILURE")
    assert M.system_prompt("NPP") != M.system_prompt(None) and "JSON" in M.system_prompt("OE")


def test_usable_reply(spark):
    cases = [('{"match": "a", "confidence": "High"}', True), ('x {"match": "a", "confidence": "medium"} y', True), ('{"match": "a", "confidence": "low"}', False), ('{"match": "", "confidence": "high"}', False), ('{"match": {"b": 1}, "confidence": "high"}', False), ('{"match": ["b"], "confidence": "high"}', False), ('{"match": 42, "confidence": "high"}', False), ('{"match": null, "confidence": "high"}', False), ("none", False), (None, False)]
    df = spark.createDataFrame([(c[0], c[1]) for c in cases], "a string, want boolean")
    assert all(r[0] == r[1] for r in df.select(M.usable_reply(F.col("a")), "want").collect())


def test_catalogue_first_wins(spark):
    rows = spark.createDataFrame([("Foo TPS", "India", 1), ("Foo", "India", 0), ("---", "India", 2), ("Foo", "Japan", 3)], "name string, country string, ord long")
    got = sorted(tuple(r) for r in stages.catalogue(spark, rows, "GEM", X.comparison_key).collect())
    assert got == [("NPP", "FOO", "Foo", 0), ("OCCTO", "FOO", "Foo", 3)]
