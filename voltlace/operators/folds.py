"""Folding unit rows into plants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlace.functions.domain import catalogue_capacity, coal_type, combustion_tech, is_coal


def fold_units(units: DataFrame) -> DataFrame:
    """One row per project: the first coal row's attributes and the sum of coal capacities, else the first row without coal attributes.

    ``units`` has name, fuel, capacity, technology, latitude, longitude and
    ord (the order that says which row is first).
    """
    coal = is_coal(F.col("fuel"))
    rows = units.where("name is not null").select(
        "name", "ord", "latitude", "longitude", coal.alias("coal"), F.when(coal, catalogue_capacity(F.col("capacity"))).alias("cap"),
        F.when(coal, coal_type(F.col("fuel"))).alias("coal_type"), F.when(coal, combustion_tech(F.col("technology"))).alias("combustion_tech"),
    )
    leading = F.struct((~F.col("coal")).alias("other"), "ord")
    return (
        rows.groupBy("name")
        .agg(F.min("ord").alias("ord"), F.min_by(F.struct("latitude", "longitude", "coal_type", "combustion_tech"), leading).alias("lead"), F.sum("cap").alias("capacity_mw"))
        .select("name", "ord", "lead.latitude", "lead.longitude", "lead.coal_type", "lead.combustion_tech", "capacity_mw")
    )


def first_coordinates(plants: DataFrame) -> DataFrame:
    """First coordinates per name; ``plants`` has name, latitude, longitude, ord."""
    return (
        plants.where("name is not null")
        .groupBy("name")
        .agg(F.min("ord").alias("ord"), F.min_by(F.struct("latitude", "longitude"), "ord").alias("p"))
        .select("name", "ord", "p.latitude", "p.longitude")
    )


def curated_fold(units: DataFrame) -> DataFrame:
    """One row per curated plant: sums and first known values of its units; plants without a unit that has both coordinates are left out.

    ``units`` has plant, ord, fuel, capacity, technology, latitude, longitude,
    project_name (of the unit's catalogue row, null if none), state and sector.
    """
    first = lambda c: F.min_by(c, F.when(c.isNotNull(), F.col("ord")))
    place = F.when(F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & ~F.isnan("latitude") & ~F.isnan("longitude"), F.struct("latitude", "longitude"))
    return (
        units.where("plant is not null")
        .groupBy("plant")
        .agg(
            F.sum(catalogue_capacity(F.col("capacity"))).alias("capacity_mw"),
            F.coalesce(first(coal_type(F.col("fuel"))), F.lit("unknown")).alias("coal_type"),
            first(combustion_tech(F.col("technology"))).alias("combustion_tech"),
            first(F.col("project_name")).alias("ref_matched_name"),
            first(F.col("state")).alias("state"),
            first(F.col("sector")).alias("sector"),
            first(place).alias("place"),
        )
        .where("place is not null")
        .select("plant", "place.latitude", "place.longitude", "capacity_mw", "coal_type", "combustion_tech", "ref_matched_name", "state", "sector")
    )
