"""Best representative of each duplicate group (problem 4).

Method. Rows that list the same unit of the same plant form a group; one
aggregation takes, attribute by attribute, the maximum of a composite struct
(non-null, source priority, timestamp, value), so the surviving record has the
best value of each field, also where no single row has them all. Coordinates
survive as one field, so that they stay a pair.

Groups: rows of one plant (see :mod:`voltlace.llm.entity`) with the same unit
label in one form; a row without a label takes the label that most rows with
its unit id have, or the plant's only label; without either, rows with the
same unit id, and else nothing, are the same unit.

Cases: null values never beat others; sources without a rank come last; equal
rank and time go to the greater value; repeated rows group together; null
labels and ids match nothing by themselves; rows whose name tells no place are
paired with nothing and survive one by one; an empty table gives no rows.
Groups are aggregated with partial maxima and never gathered. Each survivor
tells how many rows it stands for; the pairs of those rows, which the query
asks for, are made in slices of ``SLICE`` rows, so a unit that holds most rows
is no single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlace.llm.names import unit_keys

LAST_RANK = 2**31 - 1
SLICE = 1000


def unit_groups(gem: DataFrame, members: DataFrame) -> DataFrame:
    """(gem_row_id, plant, unit): ``unit`` is equal for rows of the same unit.

    ``members`` has (table_name, row_id, mention) for the rows of gem.
    """
    plants = members.where("table_name = 'gem_database'").select(F.col("row_id").alias("gem_row_id"), F.col("mention").alias("plant"))
    rows = gem.select("gem_row_id", F.upper(F.trim("unit_id")).alias("unit_id"), unit_keys("unit_name").alias("label")).join(plants, "gem_row_id")
    by_id = rows.where("label is not null and unit_id is not null").groupBy("plant", "unit_id").agg(F.mode("label", deterministic=True).alias("id_label"))
    one = F.when(F.count_distinct("label") == 1, F.max("label")).when((F.count("label") == 0) & (F.count_distinct("unit_id") <= 1), "only")
    of_plant = rows.groupBy("plant").agg(one.alias("plant_label"))
    return (
        rows.join(of_plant, "plant")
        .join(by_id, ["plant", "unit_id"], "left")
        .select("gem_row_id", "plant", F.coalesce("label", "id_label", "plant_label", F.concat(F.lit("id "), "unit_id"), F.concat(F.lit("row "), F.col("gem_row_id"))).alias("unit"))
    )


def best_value(value: Column, priority: Column, timestamp: Column) -> Column:
    """Aggregate: the value of the non-null row of best priority, then latest time, then greatest value."""
    return F.max(F.struct(value.isNotNull().alias("known"), priority.alias("priority"), timestamp.alias("at"), value.alias("value")))["value"]


def survivors(rows: DataFrame, keys: list[str], attributes: dict[str, Column], priority: Column, timestamp: Column) -> DataFrame:
    """One record per ``keys`` with the best value of each attribute and the number of rows behind it."""
    return rows.groupBy(*keys).agg(*[best_value(c, priority, timestamp).alias(name) for name, c in attributes.items()], F.count("*").alias("n_rows"))


def duplicate_pairs(survivors: DataFrame, groups: DataFrame) -> DataFrame:
    """(row_id_a, row_id_b): pairs of the rows that one survivor (plant, unit, n_rows) stands for."""
    parts = F.ceil(F.col("n_rows") / SLICE).cast("int")
    many = survivors.where("n_rows > 1").select("plant", "unit", parts.alias("parts"))
    rows = groups.join(many, ["plant", "unit"]).withColumn("slice", F.pmod(F.xxhash64("gem_row_id"), "parts").cast("int"))
    a = rows.select("plant", "unit", F.col("slice").alias("slice_a"), F.col("gem_row_id").alias("row_id_a"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("slice_b"))
    b = rows.select("plant", "unit", F.col("slice").alias("slice_b"), F.col("gem_row_id").alias("row_id_b"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("slice_a"))
    return a.join(b, ["plant", "unit", "slice_a", "slice_b"]).where("row_id_a < row_id_b").select("row_id_a", "row_id_b")


def surviving_units(gem: DataFrame, sources: DataFrame, groups: DataFrame) -> DataFrame:
    """One record per listed unit of the catalogue; rows that ``groups`` lacks, whose name tells no place, are a group each."""
    trust = sources.groupBy("record_source").agg(F.min("trust_rank").alias("trust_rank"))
    own = F.concat(F.lit("row "), F.col("gem_row_id"))
    grouped = gem.join(groups, "gem_row_id", "left").withColumn("plant", F.coalesce("plant", own)).withColumn("unit", F.coalesce("unit", own))
    rows = grouped.join(trust, "record_source", "left")
    text = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    lat, lon = F.col("latitude"), F.col("longitude")
    sound = lat.between(-90, 90) & lon.between(-180, 180) & ~((lat == 0) & (lon == 0)) & ~F.isnan(lat) & ~F.isnan(lon)
    attributes = {c: text(c) for c in ("unit_id", "project_name", "unit_name", "country", "subnational", "fuel", "capacity", "technology", "status")}
    attributes["place"] = F.when(sound, F.struct(lat.alias("latitude"), lon.alias("longitude")))
    best = survivors(rows, ["plant", "unit"], attributes, -F.coalesce("trust_rank", F.lit(LAST_RANK)), F.col("last_updated"))
    return best.withColumn("latitude", F.col("place.latitude")).withColumn("longitude", F.col("place.longitude")).drop("place")
