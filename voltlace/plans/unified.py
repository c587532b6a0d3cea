"""The unified build: feeds to resolved rows, stage by stage."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlace.functions import text as X
from voltlace.operators.dedup import keep_first
from voltlace.operators.joins import anti_join, fan_out, replace_partitions, resolve_codes
from voltlace.plans import stages
from voltlace.plans.matchers import NameMatcher
from voltlace.schema import as_output

KEYS = ["plant_name", "source_system"]


@dataclass
class Inputs:
    """Everything the build reads.

    feeds: plant_name, source_system, plant_code (EIA: code instead of a name), latitude, longitude.
    units: unit_id, name, country, fuel, capacity, technology, latitude, longitude, ord.
    plants: name, country, latitude, longitude, ord. lookup: plant_code, plant_name. curated: see :func:`stages.curated_match`, or None.
    """

    feeds: DataFrame
    units: DataFrame
    plants: DataFrame
    lookup: DataFrame | None
    curated: DataFrame | None = None


def named_feeds(inputs: Inputs, sources: list[str] | None = None) -> DataFrame:
    """Distinct feed rows with names; codes of the American feed are resolved by the lookup."""
    feeds = inputs.feeds if sources is None else inputs.feeds.where(F.col("source_system").isin(sources))
    eia = feeds.where("source_system = 'EIA' and plant_code is not null").drop("plant_name").distinct()
    others = feeds.where("source_system <> 'EIA' and plant_name is not null").withColumn("plant_code", F.lit(None).cast("string")).distinct()
    if sources is not None and "EIA" not in sources:
        return others
    if inputs.lookup is None:
        raise FileNotFoundError("the lookup from plant codes to names is missing; leave out the EIA feed or make it")
    return others.unionByName(resolve_codes(eia, inputs.lookup, "plant_code", "plant_name").select(others.columns))


def build(
    inputs: Inputs,
    cut: Callable[[DataFrame], DataFrame],
    matcher: Callable[[], NameMatcher] | None = None,
    sources: list[str] | None = None,
    existing: DataFrame | None = None,
) -> DataFrame:
    """One row per feed name (per code in the American feed) with how it was matched; other feeds' ``existing`` rows are kept."""
    spark = inputs.feeds.sparkSession
    all_rows = cut(named_feeds(inputs, sources))
    codes = all_rows.where("source_system = 'EIA'").select("plant_name", "plant_code")
    order = [F.asc_nulls_last("latitude"), F.asc_nulls_last("longitude"), F.asc_nulls_last("plant_code")]
    plants = cut(keep_first(all_rows, KEYS, order))
    done = [stages.direct_match(plants)]
    if inputs.curated is not None:
        done.append(stages.curated_match(plants, inputs.curated, inputs.units))
    matched = cut(done[0] if len(done) == 1 else done[0].unionByName(done[1]))
    left = anti_join(plants, matched, KEYS)
    gem_index, gppd_index = cut(stages.catalogue(spark, inputs.units, "GEM", X.comparison_key)), cut(stages.catalogue(spark, inputs.plants, "GPPD", X.second_key))
    gem_info, gppd_info = cut(stages.gem_info(spark, inputs.units)), cut(stages.gppd_info(spark, inputs.plants))
    for which, index, info in (("GEM", gem_index, gem_info), ("GPPD", gppd_index, gppd_info)):
        matched = cut(matched.unionByName(stages.similar_match(left, index, info, which)))
        left = cut(anti_join(plants, matched, KEYS))
    if matcher is not None:
        matched = cut(matched.unionByName(stages.model_match(left, {"GEM": gem_index, "GPPD": gppd_index}, {"GEM": gem_info, "GPPD": gppd_info}, matcher, cut)))
        left = anti_join(plants, matched, KEYS)
    result = matched.unionByName(as_output(left.select("plant_name", "plant_code", "source_system")))
    eia = result.where("source_system = 'EIA'")
    result = result.where("source_system <> 'EIA'").unionByName(as_output(fan_out(eia, codes, "plant_name", "plant_code")))
    if existing is not None and sources is not None:
        result = as_output(replace_partitions(existing, result, "source_system", sources))
    return result
