"""The stages of the matching cascade: direct, curated, similar names, language model."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlace.functions import text as X
from voltlace.functions.domain import valid_coordinates
from voltlace.operators.dedup import keep_first, name_index
from voltlace.operators.folds import curated_fold, first_coordinates, fold_units
from voltlace.operators.joins import first_match_lookup, normalized_key_join, unique_holder
from voltlace.operators.similarity_join import top_matches
from voltlace.plans.matchers import ALL_CANDIDATES_FEED, NameMatcher, run_matcher, usable
from voltlace.schema import as_output, country_table

THRESHOLD = 80.0
TRUST = 90.0
COAL = ("coal_type", "combustion_tech", "capacity_mw")


def direct_match(plants: DataFrame) -> DataFrame:
    """Rows of the feed that brings valid coordinates itself."""
    return as_output(
        plants.where((F.col("source_system") == "OE") & valid_coordinates(F.col("latitude"), F.col("longitude"))).select(
            "plant_name", "plant_code", "source_system", "latitude", "longitude", F.lit("OE-direct").alias("ref_source"), F.lit("direct").alias("matching_method"), F.col("plant_name").alias("ref_matched_name")
        )
    )


def curated_match(plants: DataFrame, curated: DataFrame, units: DataFrame) -> DataFrame:
    """Rows of the Indian feed by a curated list of plant units.

    ``curated``: type, plant, unit_id, state, sector, ord. ``units``: unit_id,
    name, fuel, capacity, technology, latitude, longitude, ord. Coordinates
    need only be known here, and a unit listed twice counts twice.
    """
    feed = plants.where("source_system = 'NPP' and plant_name is not null").select("plant_name").distinct()
    coal = curated.where((F.lower(F.col("type").cast("string")) == "coal") & F.col("plant").isNotNull())
    named = normalized_key_join(coal, feed, X.spaced_lower(F.col("plant")), X.spaced_lower, "plant_name")
    unit_rows = units.select("unit_id", F.col("name").alias("project_name"), "fuel", "capacity", "technology", "latitude", "longitude", F.col("ord").alias("unit_ord"))
    values = ["project_name", "fuel", "capacity", "technology", "latitude", "longitude"]
    found = first_match_lookup(named, unit_rows, "unit_id", values, "unit_ord")
    # state and sector come from the list's rows, also those without a unit
    with_units = named.join(found.select("plant", F.col("ord").alias("o"), *values), (named.plant == found.plant) & (named.ord == F.col("o")), "left").select(named["*"], *values)
    folded = curated_fold(with_units)
    names = named.select("plant", "plant_name").distinct()
    rows = folded.join(names, "plant")
    return as_output(
        keep_first(rows, ["plant_name"], [F.col("plant")])
        .withColumn("source_system", F.lit("NPP"))
        .withColumn("ref_source", F.lit("GEM"))
        .withColumn("matching_method", F.lit("direct"))
        .withColumn("confidence", F.lit("high"))
    )


def catalogue(spark, rows: DataFrame, which: str, key: Callable[[Column], Column]) -> DataFrame:
    """First-wins index per feed: (grp, key, name, ord). ``rows``: name, country, ord."""
    countries = country_table(spark).where(F.col("catalogue") == which)
    folded = X.per_distinct(rows.where("name is not null"), "name", {"folded": X.fold_diacritics(F.col("name"))}).withColumn("key", key(F.col("folded")))
    per_feed = folded.join(F.broadcast(countries), "country").where("key <> ''")  # a fixed table of some 80 rows
    return per_feed.groupBy(F.col("source_system").alias("grp"), "key").agg(F.min_by("name", "ord").alias("name"), F.min("ord").alias("ord"))


def similar_match(plants: DataFrame, index: DataFrame, info: DataFrame, which: str) -> DataFrame:
    """Best similar name per plant and feed; the best hit alone is judged.

    ``index`` is a :func:`catalogue`; ``info`` has grp, name, latitude,
    longitude and the coal attributes. Hits below ``TRUST`` need a common word.
    """
    key = X.comparison_key if which == "GEM" else X.second_key
    named = plants.where(F.trim("plant_name") != "")
    keyed = (
        X.per_distinct(named, "plant_name", {"folded": X.fold_diacritics(F.col("plant_name")), "base_folded": X.fold_diacritics(X.base_name(F.col("plant_name")))})
        .withColumn("key", key(F.col("folded")))
        .where((F.col("key") != "") & (X.comparison_key(F.col("folded")) != ""))
    )
    hits = top_matches(keyed.select(F.col("source_system").alias("grp"), "key"), index, 1, THRESHOLD)
    matched = X.per_distinct(hits, "name", {"name_folded": X.fold_diacritics(F.col("name"))})
    rows = keyed.join(matched, (keyed.source_system == matched.grp) & (keyed.key == matched.key)).drop(matched.key)
    trusted = rows.where((F.col("score") >= TRUST) | X.validates(F.col("base_folded"), F.col("name_folded")))
    found = trusted.select("plant_name", "plant_code", "source_system", F.col("name").alias("ref_matched_name")).join(
        info.select(F.col("grp").alias("source_system"), F.col("name").alias("ref_matched_name"), "latitude", "longitude", *[c for c in COAL if c in info.columns]), ["source_system", "ref_matched_name"]
    )
    found = found.where(valid_coordinates(F.col("latitude"), F.col("longitude")))
    return as_output(without_foreign_coal(found.withColumn("ref_source", F.lit(which)).withColumn("matching_method", F.lit("rapidfuzz"))))


def without_foreign_coal(df: DataFrame) -> DataFrame:
    """Coal attributes cleared where an Indian plant's name says it is no coal plant; coordinates stay."""
    foreign = (F.col("source_system") == "NPP") & X.likely_not_coal(F.col("plant_name"))
    for c in COAL:
        if c in df.columns:
            df = df.withColumn(c, F.when(~foreign, F.col(c)))
    return df


def gem_info(spark, units: DataFrame) -> DataFrame:
    """Folded plants of the first catalogue per feed: grp, name, ord, coordinates, coal attributes. ``units`` also has country."""
    countries = country_table(spark).where("catalogue = 'GEM'")
    per_feed = units.join(F.broadcast(countries), "country").withColumn("name", F.concat_ws("\x01", "source_system", "name"))
    folded = fold_units(per_feed.where("name is not null"))
    return folded.withColumn("grp", F.substring_index("name", "\x01", 1)).withColumn("name", F.expr("substr(name, instr(name, '\x01') + 1)"))


def gppd_info(spark, plants: DataFrame) -> DataFrame:
    countries = country_table(spark).where("catalogue = 'GPPD'")
    per_feed = plants.join(F.broadcast(countries), "country").where("name is not null").withColumn("name", F.concat_ws("\x01", "source_system", "name"))
    folded = first_coordinates(per_feed)
    return folded.withColumn("grp", F.substring_index("name", "\x01", 1)).withColumn("name", F.expr("substr(name, instr(name, '\x01') + 1)"))


def all_candidates(names: dict[str, DataFrame], feed: str = ALL_CANDIDATES_FEED) -> DataFrame:
    """(candidates): every name of the feed's catalogues (grp, name, ord), one per line; as long as one prompt, so one task makes it."""
    every = None
    for o, (label, index) in enumerate(names.items()):
        part = index.where(F.col("grp") == feed).select(F.lit(o).alias("o"), "ord", F.concat(F.lit(f"  {label}: "), "name").alias("text"))
        every = part if every is None else every.unionByName(part)
    return every.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("o", "ord", "text"))), lambda x: x["text"]), "\n").alias("candidates"))


class CandidateRetriever:
    """Candidates for names from named reference sources: label -> (name, ord). The label GPPD has its own key."""

    def __init__(self, sources: dict[str, DataFrame]):
        self.names = {label: rows.where("name is not null").groupBy("name").agg(F.min("ord").alias("ord")).withColumn("grp", F.lit("all")) for label, rows in sources.items()}
        self.indexes = {}
        for label, rows in self.names.items():
            key = X.second_key if label == "GPPD" else X.comparison_key
            self.indexes[label] = name_index(rows, lambda c, key=key: key(X.fold_diacritics(c))).withColumn("grp", F.lit("all"))

    def candidates(self, plants: DataFrame, limit: int = 15) -> DataFrame:
        """(plant_name, candidates): the ``limit`` best names of each source, best first."""
        asked = plants.select("plant_name", F.lit("all").alias("source_system"))
        return candidate_text(asked, self.indexes, k=limit).select("plant_name", "candidates")

    def all_candidates(self) -> DataFrame:
        return all_candidates(self.names, "all")


def candidate_text(plants: DataFrame, indexes: dict[str, DataFrame], names: dict[str, DataFrame] | None = None, k: int = 15, whole: bool = True) -> DataFrame:
    """(plant_name, source_system, candidates): the ``k`` best names of each catalogue, best first, one per line.

    The feed in another script gets every name of its catalogues instead,
    also those that share a key: ``names`` (grp, name, ord), each name once.
    That text is the same for all its rows and as long as the catalogues;
    without ``whole`` these rows have null instead, and :func:`run_matcher`
    takes the text once.
    """
    folded = X.per_distinct(plants.select("plant_name", "source_system").distinct(), "plant_name", {"folded": X.fold_diacritics(F.col("plant_name"))})
    lines = None
    for o, (label, index) in enumerate(indexes.items()):
        key = X.second_key if label == "GPPD" else X.comparison_key
        keyed = folded.where(F.col("source_system") != ALL_CANDIDATES_FEED).withColumn("key", key(F.col("folded")))
        hits = top_matches(keyed.select(F.col("source_system").alias("grp"), "key"), index, k, None)
        got = keyed.join(hits, (keyed.source_system == hits.grp) & (keyed.key == hits.key)).select("plant_name", "source_system", F.lit(label).alias("label"), F.lit(o).alias("o"), "name", "ord", "score")
        lines = got if lines is None else lines.unionByName(got)
    line = F.struct((-F.col("score")).alias("s"), "o", "ord", X.candidate_line(F.col("label"), F.col("name"), F.col("score")).alias("text"))
    best = lines.groupBy("plant_name", "source_system").agg(F.array_join(F.transform(F.sort_array(F.collect_list(line)), lambda x: x["text"]), "\n").alias("candidates"))
    left = folded.select("plant_name", "source_system").where(F.col("source_system") != ALL_CANDIDATES_FEED)
    near = left.join(best, ["plant_name", "source_system"], "left").withColumn("candidates", F.coalesce("candidates", F.lit("")))
    rest = folded.select("plant_name", "source_system").where(F.col("source_system") == ALL_CANDIDATES_FEED)
    if not whole:
        return near.unionByName(rest.withColumn("candidates", F.lit(None).cast("string")))
    return near.unionByName(rest.crossJoin(F.broadcast(all_candidates(names or indexes))).withColumn("candidates", F.coalesce("candidates", F.lit(""))))


def model_match(plants: DataFrame, indexes: dict[str, DataFrame], infos: dict[str, DataFrame], build: Callable[[], NameMatcher], cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows a matcher (a language model, or a stand-in under its own label) finds; its replies are written once before they are used."""
    every = all_candidates(infos).first()["candidates"]
    replies = cut(run_matcher(candidate_text(plants, indexes, whole=False), build, {ALL_CANDIDATES_FEED: every or ""}))
    good = replies.where(usable(F.col("match"), F.col("confidence"))).withColumn("m", X.clean_match(F.col("match")))
    answers = good.select("plant_name", "source_system", F.coalesce("m.source", "source").alias("source"), F.col("m.name").alias("name"), X.confidence_key(F.col("confidence")).alias("confidence"), "reasoning", "method")
    holders = None
    for label, info in infos.items():
        part = info.select(F.lit(label).alias("ref"), "grp", "name", "latitude", "longitude", *[(F.col(c) if c in info.columns else F.lit(None)).alias(c) for c in COAL])
        holders = part if holders is None else holders.unionByName(part)
    # a feed's catalogues are its own: the feed is part of the name
    tagged = holders.select(F.col("ref").alias("source"), F.concat_ws("\x01", "grp", "name").alias("name"), "latitude", "longitude", *COAL)
    asked = answers.withColumn("name", F.concat_ws("\x01", "source_system", "name"))
    resolved = unique_holder(asked, tagged, ["latitude", "longitude", *COAL]).withColumn("name", F.expr("substr(name, instr(name, '\x01') + 1)"))
    found = resolved.where(valid_coordinates(F.col("latitude"), F.col("longitude")))
    codes = plants.select("plant_name", "source_system", "plant_code").distinct()
    rows = found.join(codes, ["plant_name", "source_system"], "left")
    return as_output(
        without_foreign_coal(rows.withColumn("ref_source", F.col("source")).withColumn("matching_method", F.col("method")).withColumn("ref_matched_name", F.col("name")))
    )


