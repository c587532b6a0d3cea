from __future__ import annotations

import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlace.sources import excel, publish, readers


def workbook(sheets: dict[str, list[list]]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        names = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets, 1))
        main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{names}</sheets></workbook>')
        rels = "".join(f'<Relationship Id="r{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{rels}</Relationships>')
        for i, rows in enumerate(sheets.values(), 1):
            cells = ""
            for r, row in enumerate(rows, 1):
                cs = "".join(
                    f'<c r="{chr(65 + k)}{r}"><v>{v}</v></c>' if isinstance(v, (int, float)) else f'<c r="{chr(65 + k)}{r}" t="inlineStr"><is><t>{v}</t></is></c>' for k, v in enumerate(row) if v is not None
                )
                cells += f'<row r="{r}">{cs}</row>' if cs else ""
            z.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{main}"><sheetData>{cells}</sheetData></worksheet>')
    return out.getvalue()


def test_excel_source(spark, tmp_path):
    p = tmp_path / "form.xlsx"
    p.write_bytes(workbook({"S": [["title"], ["Plant Code", "Generator ID", "Technology", "Prime Mover", "Energy Source 1", "Nameplate Capacity (MW)", "Other"], [7, "A1", "Coal", "ST", "BIT", 12.5, "z"], [None, None, None, None, None, None, "note"]]}))
    df = excel.read_excel(spark, str(p), skip_rows=1)
    assert df.columns[:2] == ["Plant Code", "Generator ID"] and df.count() == 2
    info = publish.generator_info(df).collect()
    assert [tuple(r) for r in info] == [("7", "A1", "Coal", "ST", "BIT", 12.5)]


def test_plant_frame_and_lookup(spark, tmp_path):
    old = workbook({"Page 6 Plant Frame": [["t"], [], [], [], ["Plant Id", "x", "Plant Name"], [1, 0, "Old"], [2, 0, "Two"], [1, 0, "Again"]]})
    new = workbook({"Page 6 Plant Frame": [["t"], [], [], ["PLANT  CODE", "Plant Name"], [1, "New"]]})
    assert excel.plant_frame(old) == [("1", "Old"), ("2", "Two")] and excel.plant_frame(new) == [("1", "New")]
    assert excel.plant_frame(workbook({"Other": [["a"]]})) is None
    z = tmp_path / "f.zip"
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("readme.txt", "x")
        f.writestr("EIA923_2012.xlsx", b"data")
    got = readers.zip_members(spark, str(z), r"schedules.*2012", r".*2012.*\.xlsx?").collect()
    assert [(r.member, bytes(r.content)) for r in got] == [("EIA923_2012.xlsx", b"data")]
    frames = spark.createDataFrame([("1", "Old", 2011), ("2.0", "Two", 2011), ("1", "New", 2012), (None, "x", 2012), ("10", "Ten", 2010)], "plant_code string, plant_name string, year int")
    assert [tuple(r) for r in readers.code_names(frames).collect()] == [("1", "New"), ("2", "Two"), ("10", "Ten")]


def test_tracker(spark, tmp_path):
    t = readers.Tracker(spark, tmp_path)
    assert t.load().count() == 0 and t.by_country(["India"]).count() == 0
    head = "Project Name,Unit Name,Country/Area,Latitude,Longitude,Status,Capacity,EIA plant + unit ID\n"
    (tmp_path / "gcpt_global_a.csv").write_text(head + 'A,1,United States,1.5,bad,operating,5,"7|1"\nB,1,India,2,3,retired,6,\nB,1,India,4,5,retired,6,"7|2|3"\nC,1,Germany,,,,,\n')
    (tmp_path / "gcpt_global_b.csv").write_text(head + "old,1,India,2,3,retired,6,\n")
    os.utime(tmp_path / "gcpt_global_b.csv", (1, 1))
    assert readers.find_tracker_file(tmp_path).name == "gcpt_global_a.csv"
    t = readers.Tracker(spark, tmp_path)
    assert t.load().count() == 4 and "capacity_mw" in t.load().columns
    assert t.us_plants().first().longitude is None and t.by_status(["retired"]).count() == 2 and t.european_plants().count() == 1
    made = publish.feed_products(t)
    assert [r.latitude for r in made["NPP"].collect()] == [2.0] and made["ENTSOE"].count() == 0
    assert [(r.plant_code, r.generator_id) for r in made["EIA"].collect()] == [(None, None)]
    assert publish.save_product(made["NPP"], str(tmp_path / "out")) is True
    publish.write_csv(made["NPP"], str(tmp_path / "csv"))


def test_missing_files_and_csv(spark, tmp_path):
    s = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.DoubleType())])
    assert readers.read_csv(spark, str(tmp_path / "no.csv"), s, ["a"]).columns == ["a"] and readers.read_table(spark, str(tmp_path / "no"), s).count() == 0
    (tmp_path / "x.csv").write_text('a,b\n"one\ntwo",1.5\n')
    assert [tuple(r) for r in readers.read_csv(spark, str(tmp_path / "x.csv"), s).collect()] == [("one\ntwo", 1.5)]


def test_connection():
    got = readers.connection({"DATABASE_URL": "postgresql://me:pw@host:5/db?sslmode=require"})
    assert got["url"] == "jdbc:postgresql://host:5/db?sslmode=require&connectTimeout=30" and got["user"] == "me" and got["queryTimeout"] == "120"
    assert "host:5432/d?sslmode=require" in readers.connection({"DB_HOST": "host", "DB_NAME": "d", "DB_USER": "u", "DB_PASSWORD": "p"})["url"]
    with pytest.raises(ValueError):
        readers.connection({})
    assert readers.feed_query("OE") == "SELECT DISTINCT facility_name AS plant_name, latitude, longitude FROM oe_facility_generation_data WHERE facility_name IS NOT NULL"


def test_replace_table(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", "1"), ("b", None)], "plant_name string, plant_code string").withColumn("source_system", F.lit("EIA"))
    assert publish.publish_unified(df, path) == 2
    for bad in (df.limit(0), df.unionByName(df), df.withColumn("source_system", F.lit(None).cast("string"))):
        with pytest.raises(publish.PublishError):
            publish.publish_unified(bad, path)
        assert spark.read.parquet(path).count() == 2
    assert publish.publish_trial(spark.read.parquet(path).limit(1), path) == 1 and spark.read.parquet(path).count() == 1
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    assert publish.publish_all({"x": lambda: 1}) == {"x": 1} and publish.alive(spark)


def test_guarded_drop(spark):
    spark.sql("CREATE OR REPLACE TEMP VIEW none AS SELECT 1 AS a WHERE false")
    spark.sql("CREATE OR REPLACE TEMP VIEW some AS SELECT 1 AS a")
    with pytest.raises(publish.PublishError):
        publish.guarded_drop(spark, "none", ["old"])
    publish.guarded_drop(spark, "some", ["old"])
    assert publish.run_ddl(spark, ["SELECT 1; SELECT 2", None, ""]) == 2
