from __future__ import annotations

from voltlace.functions import text as X
from voltlace.plans import stages
from voltlace.streaming.match_stream import start


def test_stream_resolves_like_a_batch(spark, tmp_path):
    units = spark.createDataFrame([("u", "Korba power station", "India", "coal: lignite", "5", None, 22.0, 82.0, 0)], "unit_id string, name string, country string, fuel string, capacity string, technology string, latitude double, longitude double, ord long").cache()
    schema = "plant_name string, plant_code string, source_system string, latitude double, longitude double"
    for i, rows in enumerate([[("KORBA STPS", None, "NPP", None, None)], [("Nowhere", None, "NPP", None, None), ("Sun", None, "OE", 1.0, 2.0)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    feed = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    seen = []
    q = start(feed, [("GEM", stages.catalogue(spark, units, "GEM", X.comparison_key), stages.gem_info(spark, units))], str(tmp_path / "out"), str(tmp_path / "ckpt"), seen.append)
    q.awaitTermination(240)
    assert len(seen) == 2
    assert sorted(r.plant_name for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["KORBA STPS", "Sun"]
