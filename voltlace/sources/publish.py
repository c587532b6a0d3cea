"""Sinks: tables written aside, checked, and put in place; published products and their rules."""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from voltlace.functions import domain as D
from voltlace.functions import text as X
from voltlace.operators.dedup import keep_first, keep_highest
from voltlace.operators.joins import select_existing
from voltlace.sources.readers import Tracker


class PublishError(Exception):
    pass


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def replace_table(df: DataFrame, path: str, unique: list | None = None) -> int:
    """Puts ``df`` in place of the table at ``path``; returns its rows.

    It is written beside the table first. Nothing is replaced if it has no
    rows, lost rows on the way, or breaks ``unique`` (columns that must be
    known and unique together). The old table goes only after the new one
    stands; if the swap fails, it is put back.
    """
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}__staging_{uuid.uuid4().hex[:8]}"
    fs, target = _fs(spark, path)
    _, staging = _fs(spark, staged)
    try:
        watch = Observation()
        df.observe(watch, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(staged)
        written = spark.read.schema(df.schema).parquet(staged)
        n = written.count()
        if n == 0:
            raise PublishError(f"refused: no rows for {path}")
        if n != watch.get["n"]:
            raise PublishError(f"refused: {n} of {watch.get['n']} rows arrived for {path}")
        if unique:
            cols = [F.col(c) if isinstance(c, str) else c for c in unique]
            keyed = written.select(*[c.alias(f"k{i}") for i, c in enumerate(cols)])
            keys = keyed.columns
            if not keyed.where(" or ".join(f"{k} is null" for k in keys)).isEmpty():
                raise PublishError(f"refused: null key for {path}")
            if not keyed.groupBy(*keys).count().where("count > 1").isEmpty():
                raise PublishError(f"refused: key of {path} is not unique")
        _, old = _fs(spark, f"{path.rstrip('/')}__old_{uuid.uuid4().hex[:8]}")
        had = fs.exists(target)
        if had and not fs.rename(target, old):
            raise PublishError(f"could not move {path} aside")
        if not fs.rename(staging, target):
            if had:
                fs.rename(old, target)
            raise PublishError(f"could not put {path} in place")
        if had:
            fs.delete(old, True)
        return n
    finally:
        if fs.exists(staging):
            fs.delete(staging, True)


def publish_unified(df: DataFrame, path: str) -> int:
    """Unique by code (or name) and feed; written in the order of feed and name, so that filters on them skip files."""
    return replace_table(df.sortWithinPartitions("source_system", "plant_name"), path, [F.coalesce("plant_code", "plant_name"), "source_system"])


def publish_trial(df: DataFrame, path: str) -> int:
    return replace_table(df, path, ["plant_name", "source_system"])


# Headers of the generator form -> names. Fixed values.
GENERATOR_COLUMNS = {
    "Plant Code": "plant_code", "Generator ID": "generator_id", "Technology": "technology", "Prime Mover": "prime_mover", "Energy Source 1": "energy_source_1",
    "Nameplate Capacity (MW)": "nameplate_capacity_mw",
}


def generator_info(form: DataFrame) -> DataFrame:
    """Rows with both keys; keys as texts, codes as whole numbers."""
    df = form.select(*[F.col(f"`{k}`").alias(v) for k, v in GENERATOR_COLUMNS.items()]).na.drop(subset=["plant_code", "generator_id"])
    return df.withColumn("plant_code", F.col("plant_code").try_cast("double").cast("long").cast("string")).withColumn("generator_id", F.col("generator_id").cast("string")).withColumn(
        "nameplate_capacity_mw", F.col("nameplate_capacity_mw").try_cast("double")
    )


def publish_generator_info(form: DataFrame, path: str) -> int:
    return replace_table(generator_info(form), path, ["plant_code", "generator_id"])


def coal_metadata(units: DataFrame) -> DataFrame:
    """Coal units of the catalogue; of rows with the same American unit id the one of highest capacity.

    ``units``: unit_id, project_name, unit_name, fuel, technology, capacity, country, location_ids, other_ids.
    """
    coal = units.where(F.coalesce(F.lower("fuel").contains("coal"), F.lit(False)) & F.col("unit_id").isNotNull())
    rows = coal.select(
        F.col("unit_id").alias("gcpt_unit_id"),
        X.composite_id(X.labelled_id(F.col("location_ids")), X.labelled_id(F.col("other_ids"))).alias("eia_unit_id"),
        F.col("project_name").alias("plant_name"),
        "unit_name",
        D.coal_type_word(F.col("fuel")).alias("coal_type"),
        D.tidy_technology(F.col("technology")).alias("technology"),
        D.leading_capacity(F.col("capacity")).alias("capacity_mw"),
        "country",
    )
    return keep_highest(rows, "eia_unit_id", "capacity_mw", "gcpt_unit_id")


def publish_coal_metadata(units: DataFrame, path: str) -> int:
    return replace_table(coal_metadata(units), path, ["gcpt_unit_id"])


def publish_all(jobs: dict[str, Callable[[], int]]) -> dict[str, int]:
    return {name: job() for name, job in jobs.items()}


def run_ddl(spark: SparkSession, scripts: list[str | None]) -> int:
    """Runs the statements of the scripts in order, leaving out missing ones; returns how many ran."""
    n = 0
    for script in scripts:
        for statement in (script or "").split(";"):
            if statement.strip():
                spark.sql(statement)
                n += 1
    return n


def guarded_drop(spark: SparkSession, guard: str, tables: list[str]) -> None:
    """Drops ``tables`` only while the table that replaces them has rows."""
    if not spark.catalog.tableExists(guard) or spark.table(guard).isEmpty():
        raise PublishError(f"refused: {guard} is empty")
    for t in tables:
        spark.sql(f"DROP TABLE IF EXISTS {t}")


def alive(spark: SparkSession) -> bool:
    return spark.sql("SELECT 1").first()[0] == 1


# -- per-feed products -------------------------------------------------------

EIA_COLUMNS = ["eia_plant_unit_id", "plant_code", "generator_id", "project_name", "unit_name", "latitude", "longitude", "subnational", "status"]
PLANT_COLUMNS = ["project_name", "unit_name", "country", "subnational", "latitude", "longitude", "status", "capacity_mw"]


def eia_product(tracker: DataFrame) -> DataFrame:
    """Units with an American id, split in code and generator, that have coordinates."""
    rows = tracker.where("eia_plant_unit_id is not null").withColumn("p", X.split_pair(F.col("eia_plant_unit_id")))
    return select_existing(rows.select("*", "p.plant_code", "p.generator_id").na.drop(subset=["latitude", "longitude"]), EIA_COLUMNS)


def unit_product(tracker: DataFrame) -> DataFrame:
    """Units with coordinates, the first of equal project and unit."""
    located = tracker.na.drop(subset=["latitude", "longitude"])
    return select_existing(keep_first(located, ["project_name", "unit_name"], [F.col("ord")]), PLANT_COLUMNS)


def feed_products(tracker: Tracker) -> dict[str, DataFrame]:
    return {"EIA": eia_product(tracker.load()), "ENTSOE": unit_product(tracker.european_plants()), "NPP": unit_product(tracker.indian_plants())}


def save_product(df: DataFrame, path: str) -> bool:
    """Writes a product; false if that failed."""
    try:
        df.write.mode("overwrite").parquet(path)
    except Exception as e:  # noqa: BLE001 - the caller goes on with the other products
        warnings.warn(f"{path} was not written: {e}", stacklevel=2)
        return False
    return True


def write_csv(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)
