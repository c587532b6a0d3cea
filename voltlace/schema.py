"""Schemas and fixed configuration of the resolved table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _D = T.StringType(), T.DoubleType()
OUTPUT = T.StructType(
    [
        T.StructField(n, t)
        for n, t in [
            ("plant_name", _S), ("plant_code", _S), ("source_system", _S), ("latitude", _D), ("longitude", _D), ("ref_source", _S), ("matching_method", _S), ("confidence", _S),
            ("ref_matched_name", _S), ("reasoning", _S), ("coal_type", _S), ("combustion_tech", _S), ("capacity_mw", _D), ("state", _S), ("sector", _S),
        ]
    ]
)

# The one country of a feed, by catalogue.
ONE_COUNTRY = {
    "NPP": ("India", "IND"), "EIA": ("United States", "USA"), "ONS": ("Brazil", "BRA"), "OE": ("Australia", "AUS"), "OCCTO": ("Japan", "JPN"), "CHILE": ("Chile", "CHL"),
}
# The countries of the European feed, by ISO code and by name.
EUROPE_CODES = "AUT BEL BGR HRV CZE DNK EST FIN FRA DEU GRC HUN IRL ITA LVA LTU LUX NLD POL PRT ROU SVK SVN ESP SWE GBR NOR CHE SRB BIH MNE MKD ALB XKX".split()
EUROPE_NAMES = [
    "Albania", "Austria", "Belgium", "Bosnia and Herzegovina", "Bulgaria", "Croatia", "Czech Republic", "Denmark", "Estonia", "Finland", "France", "Germany", "Greece", "Hungary", "Ireland",
    "Italy", "Kosovo", "Latvia", "Lithuania", "Luxembourg", "Montenegro", "Netherlands", "North Macedonia", "Norway", "Poland", "Portugal", "Romania", "Serbia", "Slovakia", "Slovenia",
    "Spain", "Sweden", "Switzerland", "United Kingdom",
]
# Countries that the tracker's European filter knows.
TRACKER_EUROPE = [
    "Germany", "France", "Poland", "United Kingdom", "Italy", "Spain", "Netherlands", "Belgium", "Czech Republic", "Greece", "Romania", "Bulgaria", "Austria", "Hungary", "Slovakia",
    "Finland", "Denmark", "Portugal", "Ireland", "Slovenia", "Croatia", "Estonia", "Latvia", "Lithuania", "Luxembourg",
]


def feed_countries() -> list[tuple[str, str, str]]:
    """(source_system, catalogue, country) in long form."""
    rows = [(f, c, country) for f, both in ONE_COUNTRY.items() for c, country in zip(("GEM", "GPPD"), both)]
    return rows + [("ENTSOE", "GPPD", c) for c in EUROPE_CODES] + [("ENTSOE", "GEM", c) for c in EUROPE_NAMES]


def country_table(spark) -> DataFrame:
    return spark.createDataFrame(feed_countries(), "source_system string, catalogue string, country string")


def as_output(df: DataFrame) -> DataFrame:
    """The fixed columns in their order; missing ones are null."""

    def cast(f: T.StructField) -> Column:
        return (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)

    return df.select(*[cast(f) for f in OUTPUT.fields])


def empty_output(spark) -> DataFrame:
    return spark.createDataFrame([], OUTPUT)
