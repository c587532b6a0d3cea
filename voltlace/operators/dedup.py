"""First, last, highest: deduplication with an explicit order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key in ``order``; a group is never gathered beyond its leading rows."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def keep_highest(df: DataFrame, key: str, value: str, tie: str) -> DataFrame:
    """Rows with a key keep the one of highest value (nulls last, then lowest ``tie``); rows without a key stay."""
    keyed = keep_first(df.where(F.col(key).isNotNull()), [key], [F.desc_nulls_last(value), F.col(tie)])
    return keyed.unionByName(df.where(F.col(key).isNull()))


def duplicate_row_count(df: DataFrame, key: str) -> DataFrame:
    """(n_rows): rows whose key occurs more than once."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where("n > 1").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))


def latest_per_key(df: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """The value of the last row per key; partial maxima before the shuffle."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(value))


def name_index(names: DataFrame, normalizer: Callable[[Column], Column]) -> DataFrame:
    """(key, name, ord): first name per key; empty keys are left out. ``names`` has name and ord."""
    keyed = names.where("name is not null").withColumn("key", normalizer(F.col("name")))
    return keyed.where("key <> ''").groupBy("key").agg(F.min_by("name", "ord").alias("name"), F.min("ord").alias("ord"))


def name_collisions(names: DataFrame, normalizer: Callable[[Column], Column]) -> DataFrame:
    """(key, n_names): keys that different names share."""
    keyed = names.where("name is not null").withColumn("key", normalizer(F.col("name"))).where("key <> ''")
    return keyed.groupBy("key").agg(F.count_distinct("name").alias("n_names")).where("n_names > 1")
