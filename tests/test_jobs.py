from __future__ import annotations

import zipfile

import pytest

from tests.test_plans import FEEDS, PLANTS, UNITS
from tests.test_sources import workbook
from voltlace import cli
from voltlace.plans import evaluation, matchers, stages
from voltlace.sources.lookup import build_lookup


@pytest.fixture
def files(spark, tmp_path):
    make = spark.createDataFrame
    make([("u1", "Korba power station", "India", "coal: lignite", "500 MW", "USC", 22.0, 82.0, 0), ("u2", "Korba TPS", "Japan", None, None, None, 35.0, 135.0, 1), ("u3", "Korba", "Japan", None, None, None, 35.0, 135.0, 2)], UNITS).write.parquet(str(tmp_path / "units"))
    make([("Sakura", "JPN", 36.0, 138.0, 0)], PLANTS).write.parquet(str(tmp_path / "plants"))
    make([("KORBA STPS", None, "NPP", None, None), ("桜", None, "OCCTO", None, None), (None, "7", "EIA", None, None)], FEEDS).write.parquet(str(tmp_path / "feeds"))
    make([("7", "Smith")], "plant_code string, plant_name string").write.parquet(str(tmp_path / "lookup"))
    return tmp_path


def test_build_job(spark, files, capsys):
    base = ["build"] + [x for n in ("units", "plants", "feeds", "lookup", "out") for x in (f"--{n}", str(files / n))]
    run = lambda *more, ask=None: cli.build(spark, cli.parser().parse_args([*base, *more]), ask or (lambda q: pytest.fail("asked")))
    assert run("--no-llm") == 0
    out = spark.read.parquet(str(files / "out"))
    assert out.count() == 3 and out.where("matching_method is not null").count() == 1
    capsys.readouterr()
    assert run("--no-llm") == 0 and "all" in capsys.readouterr().out  # the result is there: report only
    asked = []
    assert run("--sources", "NPP", ask=lambda q: asked.append(q) or "n") == 0 and "3 names" in asked[0]
    assert spark.read.parquet(str(files / "out")).count() == 3
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["publish", "--data", "a", "--out", "b", "--schema-only", "--coal-only"])


def says_sakura(system, user):
    return '{"match": "GPPD: Sakura", "source": "GPPD", "confidence": "high", "reasoning": "reads alike"}' if "桜" in user else '{"match": null}'


def test_build_job_calls_the_configured_model_only(spark, files, capsys):
    spark.createDataFrame([("KORBA EAST", None, "NPP", None, None), ("桜", None, "OCCTO", None, None)], FEEDS).write.mode("overwrite").parquet(str(files / "feeds"))
    base = ["build", "--yes", "--force"] + [x for n in ("units", "plants", "feeds", "lookup") for x in (f"--{n}", str(files / n))]
    run = lambda out, *more: cli.build(spark, cli.parser().parse_args([*base, "--out", str(files / out), *more]))
    rows = lambda out: {r.plant_name: (r.matching_method, r.ref_matched_name) for r in spark.read.parquet(str(files / out)).collect()}
    assert run("none") == 0 and "No model is configured" in capsys.readouterr().out
    assert rows("none") == {"KORBA EAST": (None, None), "桜": (None, None)}  # 67 points: refused by the similarity stages, and by no stand-in brought back
    assert run("model", "--model", "tests.test_jobs:says_sakura") == 0
    assert rows("model") == {"KORBA EAST": (None, None), "桜": ("llm", "Sakura")}
    with pytest.raises(ValueError):
        run("bad", "--model", "tests.test_jobs:nothing")


def test_build_job_reads_the_curated_list(spark, files):
    (files / "list.csv").write_text('Type,DGR plant name,GEM unit/phase ID,State,Sector\nCoal," korba  stps",u1,CG,\ncoal," korba  stps",u1,,Central\ngas,x,u1,,\n')
    args = ["build", "--no-llm", "--sources", "NPP", "--curated", str(files / "list.csv")] + [x for n in ("units", "plants", "feeds", "lookup", "out") for x in (f"--{n}", str(files / n))]
    assert cli.build(spark, cli.parser().parse_args(args)) == 0
    r = spark.read.parquet(str(files / "out")).first()
    assert (r.plant_name, r.matching_method, r.confidence, r.state, r.sector, r.capacity_mw, r.ref_matched_name) == ("KORBA STPS", "direct", "high", "CG", "Central", 1000.0, "Korba power station")


def test_publish_job(spark, tmp_path):
    (tmp_path / "data").mkdir()
    row = [("a", None, "EIA")]
    spark.createDataFrame(row, "plant_name string, plant_code string, source_system string").write.parquet(str(tmp_path / "data/unified.parquet"))
    (tmp_path / "data/generators.xlsx").write_bytes(workbook({"S": [["t"], ["Plant Code", "Generator ID", "Technology", "Prime Mover", "Energy Source 1", "Nameplate Capacity (MW)"], [7, "A", "x", "y", "z", 1.5]]}))
    args = lambda *more: cli.parser().parse_args(["publish", "--data", str(tmp_path / "data"), "--out", str(tmp_path / "out"), *more])
    assert cli.publish_tables(spark, args()) == 0
    assert spark.read.parquet(str(tmp_path / "out/unified_plant_crosswalk")).count() == spark.read.parquet(str(tmp_path / "out/eia_generator_info")).count() == 1
    assert cli.publish_tables(spark, args("--trial-only")) == 0 and not (tmp_path / "out/npp_llm_test").exists()


def test_lookup_job(spark, tmp_path):
    for year, name in ((2011, "Old"), (2012, "New")):
        with zipfile.ZipFile(tmp_path / f"f{year}.zip", "w") as z:
            z.writestr(f"EIA923_Schedules_{year}.xlsx", workbook({"Page 6 Plant Frame": [["t"], [], [], [], ["Plant Id", "Plant Name"], [7, name], [9 if year == 2011 else 10, "Other"]]}))
    with zipfile.ZipFile(tmp_path / "f2013.zip", "w") as z:
        z.writestr("EIA923_2013.xlsx", b"no workbook")
    got = [tuple(r) for r in build_lookup(spark, str(tmp_path / "*.zip"), str(tmp_path / "csv")).collect()]
    assert got == [("7", "New"), ("9", "Other"), ("10", "Other")]
    assert [tuple(r) for r in spark.read.csv(str(tmp_path / "csv"), header=True).collect()] == got


def test_candidates_and_evaluation(spark, files):
    units, plants = spark.read.parquet(str(files / "units")), spark.read.parquet(str(files / "plants"))
    from voltlace.functions import text as X

    indexes = {"GEM": stages.catalogue(spark, units, "GEM", X.comparison_key), "GPPD": stages.catalogue(spark, plants, "GPPD", X.second_key)}
    infos = {"GEM": stages.gem_info(spark, units), "GPPD": stages.gppd_info(spark, plants)}
    feeds = spark.read.parquet(str(files / "feeds")).where("plant_name is not null")
    text = {r.plant_name: r.candidates for r in stages.candidate_text(feeds, indexes, infos).collect()}
    assert text["KORBA STPS"] == "  GEM: Korba power station (score: 100)"
    assert text["桜"] == "  GEM: Korba TPS\n  GEM: Korba\n  GPPD: Sakura"  # names that share a key are all there
    resolved = spark.createDataFrame([("KORBA STPS", "NPP", "rapidfuzz", "GEM", "Korba power station"), ("B", "NPP", None, None, None), ("C", "NPP", "llm", "GEM", "c")], "plant_name string, source_system string, matching_method string, ref_source string, ref_matched_name string")
    known = evaluation.sample_known(resolved, "NPP", 5, 42)
    checked = evaluation.check_matcher(known, stages.candidate_text(feeds, indexes, infos), matchers.OfflineMatcher)
    assert [(r.listed, r.passed) for r in checked.collect()] == [(True, True)] and evaluation.pass_rate(checked).first().rate == 1.0
    assert [(r.stage, r.cumulative) for r in evaluation.trial_funnel(resolved).orderBy("ord").collect()] == [("similar GEM", 1), ("model", 2), ("unmatched", 3)]


def test_build_job_reads_published_files_and_goes_on_without_missing_ones(spark, files, capsys):
    (files / "units.csv").write_text('Project Name,Unit Name,Country/Area,Fuel,Capacity,Technology,Unit ID,Latitude,Longitude\nKorba power station,1,India,coal: lignite,500 MW,USC,u1,22.0,82.0\n"Odd, place",1,India,gas,,,u2,x,\n')
    (files / "lookup.csv").write_text("plant_code,plant_name\n7,Smith\n")
    args = ["build", "--no-llm", "--units", str(files / "units.csv"), "--plants", str(files / "gone.csv"), "--feeds", str(files / "feeds"), "--lookup", str(files / "lookup.csv"), "--curated", str(files / "gone_too.csv"), "--out", str(files / "out")]
    with pytest.warns(UserWarning, match="gone.csv is missing"):
        assert cli.build(spark, cli.parser().parse_args(args)) == 0
    assert "gone_too.csv is missing" in capsys.readouterr().out
    rows = {r.plant_name: r for r in spark.read.parquet(str(files / "out")).collect()}
    assert (rows["KORBA STPS"].ref_matched_name, rows["KORBA STPS"].coal_type, rows["KORBA STPS"].latitude) == ("Korba power station", "lignite", 22.0)
    assert rows["Smith"].plant_code == "7" and rows["Smith"].matching_method is None
    with pytest.raises(FileNotFoundError):
        cli.build(spark, cli.parser().parse_args([*args[:-6], "--lookup", str(files / "gone.csv"), "--out", str(files / "out2")]))


def test_trial_and_model_check_jobs(spark, files, capsys):
    base = [x for n in ("units", "plants", "feeds", "lookup") for x in (f"--{n}", str(files / n))]
    assert cli.trial(spark, cli.parser().parse_args(["trial", *base, "--out", str(files / "trial")])) == 0
    assert "similar GEM" in capsys.readouterr().out and spark.read.parquet(str(files / "trial")).count() == 1
    args = ["check-model", *base, "--known", str(files / "trial"), "--model", "tests.test_jobs:says_sakura"]
    assert cli.check_model(spark, cli.parser().parse_args(args)) == 0 and "n_passed" in capsys.readouterr().out


def test_retriever_and_exports(spark):
    import voltlace

    assert all(getattr(voltlace, n) is not None for n in voltlace.__all__)
    source = lambda *names: spark.createDataFrame(list(zip(names, range(len(names)))), "name string, ord long")
    r = voltlace.CandidateRetriever({"GEM": source("Korba TPS", "KORBA STPS", "Sipat", "Sipat"), "GPPD": source("Korba Block A")})
    got = {x.plant_name: x.candidates for x in r.candidates(spark.createDataFrame([("Korba",)], "plant_name string"), 2).collect()}
    assert got["Korba"].split("\n")[:2] == ["  GEM: Korba TPS (score: 100)", "  GPPD: Korba Block A (score: 100)"] and len(got["Korba"].split("\n")) == 3
    assert r.all_candidates().first()[0].split("\n") == ["  GEM: Korba TPS", "  GEM: KORBA STPS", "  GEM: Sipat", "  GPPD: Korba Block A"]


def test_cut_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from voltlace import session

    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: d), sparkContext=SimpleNamespace(master="spark://host:7077", applicationId="a"))
    with pytest.raises(ValueError):
        session.checkpoint_root(cluster)


def test_cut_tables_are_released(spark):
    from voltlace.session import cut, release

    a, b = cut(spark.range(3).toDF("x")), cut(spark.range(2).toDF("x"))
    path = a.inputFiles()[0]
    release(a)
    release(spark.range(1))  # nothing of cut: nothing happens
    import os

    assert not os.path.exists(path.removeprefix("file://")) and b.count() == 2
