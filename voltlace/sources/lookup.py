"""Lookup from plant codes to names, built from yearly archives of workbooks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlace.sources.excel import plant_frame
from voltlace.sources.readers import code_names, zip_members
from voltlace.sources.publish import write_csv


def frames(members: DataFrame) -> DataFrame:
    """(plant_code, plant_name, year) of workbooks ``members(member, content)``; one that cannot be read gives no rows."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for year, data in zip(pdf["year"], pdf["content"]):
                try:
                    rows += [(code, name, int(year)) for code, name in plant_frame(data) or []]
                except Exception:  # noqa: BLE001 - a broken workbook is left out
                    continue
            yield pd.DataFrame(rows, columns=["plant_code", "plant_name", "year"]).astype({"year": "int32"})

    dated = members.withColumn("year", F.regexp_extract("member", r"(20\d{2})", 1).try_cast("int")).where("year is not null")
    return dated.select("year", "content").mapInPandas(read, "plant_code string, plant_name string, year int")


def build_lookup(spark: SparkSession, archives: str, out: str | None = None) -> DataFrame:
    """The latest name per code over all archives; also written as CSV to ``out``."""
    lookup = code_names(frames(zip_members(spark, archives, r"schedules.*20\d{2}.*\.xlsx?$", r"20\d{2}.*\.xlsx?$")))
    if out is not None:
        write_csv(lookup, out)
    return lookup
