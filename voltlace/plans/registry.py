"""Queries of the reference's operators over whole tables, and the SQL they are checked with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlace.functions import domain as D
from voltlace.functions import similarity as S
from voltlace.functions import text as X
from voltlace.operators import dedup, folds, joins, reports
from voltlace.operators.similarity_join import top_matches
from voltlace.plans import evaluation, matchers, stages, unified
from voltlace.plans import sqltext as Q
from voltlace.session import cut, scratch, table
from voltlace.sources import publish, readers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


def gem_units(s: SparkSession, d: str) -> DataFrame:
    """The first catalogue as the cascade reads it; its row id says which row is first."""
    return table(s, d, "gem_database").select("unit_id", F.col("project_name").alias("name"), "country", "fuel", "capacity", "technology", "latitude", "longitude", F.col("gem_row_id").alias("ord"))


def gppd_plants(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "gppd").select("name", "country", "latitude", "longitude", F.col("gppd_row_id").alias("ord"))


def feeds(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "unified_plant_crosswalk").select("plant_name", "plant_code", "source_system", "latitude", "longitude")


def all_names(s: SparkSession, d: str) -> DataFrame:
    g, p, x = table(s, d, "gem_database"), table(s, d, "gppd"), table(s, d, "unified_plant_crosswalk")
    return g.select(F.col("project_name").alias("name")).unionByName(p.select("name")).unionByName(x.select(F.col("plant_name").alias("name"))).where("name is not null").distinct()


# -- sources, projections, filters -------------------------------------------


@query(
    """SELECT DISTINCT plant_name, plant_code, source_system, latitude, longitude FROM (
    SELECT plant_code AS plant_name, plant_code, 'EIA' AS source_system, NULL::DOUBLE AS latitude, NULL::DOUBLE AS longitude FROM eia_generation_data WHERE plant_code IS NOT NULL
    UNION ALL SELECT name, NULL, 'OE', latitude, longitude FROM gppd WHERE name IS NOT NULL
    UNION ALL SELECT plant_name, NULL, 'NPP', NULL, NULL FROM unified_plant_crosswalk WHERE plant_name IS NOT NULL)"""
)
def distinct_names_union(s, d):
    parts = [("eia_generation_data", "EIA", "plant_code", ()), ("gppd", "OE", "name", ("latitude", "longitude")), ("unified_plant_crosswalk", "NPP", "plant_name", ())]
    out = None
    for t, feed, name, more in parts:
        one = readers.distinct_names(table(s, d, t), feed, name, more)
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT s_suppkey, s_name AS supplier, s_acctbal AS balance FROM supplier")
def select_existing_rename(s, d):
    df = table(s, d, "supplier").withColumnsRenamed({"s_name": "supplier", "s_acctbal": "balance", "no_such": "x"})
    return joins.select_existing(df, ["s_suppkey", "supplier", "balance", "missing"])


@query(
    """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus IN ('F','O') THEN 'in' ELSE 'out' END AS side FROM (
    SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus FROM orders)"""
)
def filter_isin_not_isin(s, d):
    o = table(s, d, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"))
    inside = F.col("o_orderstatus").isin("F", "O")
    return o.where(inside).withColumn("side", F.lit("in")).unionByName(o.where(~F.coalesce(inside, F.lit(False))).withColumn("side", F.lit("out")))


@query("SELECT gem_row_id, fuel FROM gem_database WHERE contains(lower(fuel), 'coal') OR lower(status) = 'retired'")
def filter_contains_ci(s, d):
    g = table(s, d, "gem_database")
    return g.where(F.coalesce(F.lower("fuel").contains("coal"), F.lit(False)) | F.coalesce(F.lower("status") == "retired", F.lit(False))).select("gem_row_id", "fuel")


@query(
    """SELECT gem_row_id, coalesce(latitude IS NOT NULL AND longitude IS NOT NULL AND NOT (latitude = 0 AND longitude = 0) AND latitude BETWEEN -90 AND 90
    AND longitude BETWEEN -180 AND 180, false) AS valid FROM gem_database"""
)
def valid_coordinates(s, d):
    return table(s, d, "gem_database").select("gem_row_id", D.valid_coordinates(F.col("latitude"), F.col("longitude")).alias("valid"))


@query(
    f"""SELECT gem_row_id, {Q.number("replace(lower(trim(capacity)), 'mw', '')")} AS catalogue_mw,
    {Q.number("nullif(regexp_extract(capacity, '^([0-9.]+)', 1), '')")} AS leading_mw, {Q.number("capacity")} AS plain FROM gem_database"""
)
def numeric_coercion(s, d):
    c = F.col("capacity")
    return table(s, d, "gem_database").select("gem_row_id", D.catalogue_capacity(c).alias("catalogue_mw"), D.leading_capacity(c).alias("leading_mw"), D.to_number(c).alias("plain"))


@query(
    f"""SELECT gem_row_id, {Q.is_coal("fuel")} AS coal, {Q.coal_type("fuel")} AS coal_type, coalesce(nullif(regexp_extract(fuel, 'coal:\\s*([\\w-]+)', 1), ''), 'unknown') AS coal_word,
    {Q.tech("technology")} AS tech, trim(lower(coalesce(technology, 'unknown'))) AS tidy FROM gem_database"""
)
def category_parse(s, d):
    f, t = F.col("fuel"), F.col("technology")
    return table(s, d, "gem_database").select(
        "gem_row_id", D.is_coal(f).alias("coal"), D.coal_type(f).alias("coal_type"), D.coal_type_word(f).alias("coal_word"), D.combustion_tech(t).alias("tech"), D.tidy_technology(t).alias("tidy")
    )


# -- text ---------------------------------------------------------------------

NAMES = "SELECT project_name AS name FROM gem_database UNION SELECT name FROM gppd UNION SELECT plant_name FROM unified_plant_crosswalk"


@query(f"SELECT name, {Q.strip('name', X.FEED_SUFFIXES)} AS cut, {Q.trim(Q.strip('name', X.FEED_SUFFIXES))} AS base FROM ({NAMES}) WHERE name IS NOT NULL")
def strip_suffixes(s, d):
    return all_names(s, d).select("name", X.strip_suffixes(F.col("name"), X.FEED_SUFFIXES).alias("cut"), X.base_name(F.col("name")).alias("base"))


@query(f"SELECT name, {Q.fix('name')} AS fixed FROM ({NAMES}) WHERE name IS NOT NULL")
def fix_mojibake(s, d):
    return all_names(s, d).select("name", X.fix_mojibake(F.col("name")).alias("fixed"))


@query(f"SELECT name, {Q.key1('folded')} AS key FROM (SELECT name, {Q.fold('name')} AS folded FROM ({NAMES}) WHERE name IS NOT NULL)")
def normalize_names(s, d):
    return all_names(s, d).select("name", X.comparison_key(X.fold_diacritics(F.col("name"))).alias("key"))


@query(f"SELECT name, {Q.key2('folded')} AS key FROM (SELECT name, {Q.fold('name')} AS folded FROM ({NAMES}) WHERE name IS NOT NULL)")
def normalize_names_alt(s, d):
    return all_names(s, d).select("name", X.second_key(X.fold_diacritics(F.col("name"))).alias("key"))


@query(
    f"""WITH pairs AS (SELECT DISTINCT plant_name, ref_matched_name FROM unified_plant_crosswalk WHERE plant_name IS NOT NULL AND ref_matched_name IS NOT NULL),
    folded AS (SELECT *, {Q.fold(Q.trim(Q.strip('plant_name', X.FEED_SUFFIXES)))} AS b, {Q.fold('ref_matched_name')} AS m FROM pairs)
    SELECT plant_name, ref_matched_name, {Q.validates('b', 'm')} AS ok FROM folded"""
)
def validate_word_match(s, d):
    pairs = table(s, d, "unified_plant_crosswalk").select("plant_name", "ref_matched_name").na.drop().distinct()
    one = X.per_distinct(pairs, "plant_name", {"b": X.fold_diacritics(X.base_name(F.col("plant_name")))})
    both = X.per_distinct(one, "ref_matched_name", {"m": X.fold_diacritics(F.col("ref_matched_name"))})
    return both.select("plant_name", "ref_matched_name", X.validates(F.col("b"), F.col("m")).alias("ok"))


@query(f"SELECT xwalk_row_id, {Q.not_coal('plant_name')} AS other, lower({Q.trim(Q.spaces('coalesce(plant_name, ' + chr(39) + 'nan' + chr(39) + ')'))}) AS key FROM unified_plant_crosswalk")
def flag_tokens_regex(s, d):
    c = F.col("plant_name")
    return table(s, d, "unified_plant_crosswalk").select("xwalk_row_id", X.likely_not_coal(c).alias("other"), X.spaced_lower(c).alias("key"))


@query(
    r"""WITH ids AS (SELECT info_row_id, plant_code || '|' || generator_id || CASE WHEN info_row_id % 5 = 0 THEN '|x' ELSE '' END AS id, 'EIA: ' || plant_code || ', ISO: 7' AS a, generator_id AS b FROM eia_generator_info)
    SELECT info_row_id, CASE WHEN len(string_split(id, '|')) = 2 THEN trim(string_split(id, '|')[1]) END AS plant_code, CASE WHEN len(string_split(id, '|')) = 2 THEN trim(string_split(id, '|')[2]) END AS generator_id,
    nullif(trim(regexp_extract(a, 'EIA:\s*([^,]+)', 1)), '') AS labelled,
    CASE WHEN trim(regexp_extract(a, 'EIA:\s*([^,]+)', 1)) <> '' AND trim(b) <> '' THEN trim(regexp_extract(a, 'EIA:\s*([^,]+)', 1)) || '|' || b END AS composite FROM ids"""
)
def split_composite_id(s, d):
    g = table(s, d, "eia_generator_info")
    ids = g.select(
        "info_row_id", (F.concat("plant_code", F.lit("|"), "generator_id", F.when(F.col("info_row_id") % 5 == 0, "|x").otherwise(""))).alias("id"),
        F.concat(F.lit("EIA: "), "plant_code", F.lit(", ISO: 7")).alias("a"), F.col("generator_id").alias("b"),
    )
    lab = X.labelled_id(F.col("a"))
    return ids.select("info_row_id", X.split_pair(F.col("id")).alias("p"), lab.alias("labelled"), X.composite_id(lab, F.col("b")).alias("composite")).select("info_row_id", "p.plant_code", "p.generator_id", "labelled", "composite")


@query(
    rf"""SELECT xwalk_row_id, nullif(regexp_extract({Q.trim('ref_matched_name')}, '^(GEM|GPPD): ', 1), '') AS source,
    {Q.trim(r"regexp_replace(regexp_replace(" + Q.trim('ref_matched_name') + r", '^(?:GEM|GPPD): ', ''), '\s*\(score: \d+(?:\.\d+)?\)\s*$', '')")} AS name,
    lower({Q.trim('confidence')}) AS confidence, lower(trim(regexp_replace(ref_matched_name, '^(?s).*?: ', ''))) AS bare FROM unified_plant_crosswalk"""
)
def clean_match_text(s, d):
    m = F.col("ref_matched_name")
    x = table(s, d, "unified_plant_crosswalk").withColumn("m", X.clean_match(m))
    return x.select("xwalk_row_id", "m.source", "m.name", X.confidence_key(F.col("confidence")).alias("confidence"), X.without_label(m).alias("bare"))


@query(
    """WITH raw AS (SELECT event_id, 'Sure: ' || CASE WHEN event_id % 3 = 0 THEN '{"match": ' || event_id || ', "confidence": "high"}' WHEN event_id % 3 = 1
    THEN '{"match": "' || event_type || '", "confidence": "' || CASE WHEN event_id % 2 = 0 THEN 'Medium' ELSE 'low' END || '"}' ELSE 'no reply' END || ' done' AS raw FROM events),
    j AS (SELECT event_id, try_cast(nullif(regexp_extract(raw, '(?s)\\{.*\\}', 0), '') AS JSON) AS v FROM raw)
    SELECT event_id, coalesce(json_type(v, '$.match') = 'VARCHAR' AND v->>'$.match' <> '' AND lower(trim(v->>'$.confidence')) IN ('high', 'medium'), false) AS usable FROM j"""
)
def extract_json_reply(s, d):
    e = table(s, d, "events")
    i = F.col("event_id")
    text = F.when(i % 3 == 0, F.concat(F.lit('{"match": '), i.cast("string"), F.lit(', "confidence": "high"}'))).when(
        i % 3 == 1, F.concat(F.lit('{"match": "'), "event_type", F.lit('", "confidence": "'), F.when(i % 2 == 0, "Medium").otherwise("low"), F.lit('"}'))
    ).otherwise("no reply")
    return e.select("event_id", matchers.usable_reply(F.concat(F.lit("Sure: "), text, F.lit(" done"))).alias("usable"))


@query(
    f"""SELECT part.p_partkey, '  GEM: ' || p_name || ' (score: ' || cast(round_even(p_size * 1.5, 0) AS INTEGER) || ')' AS line,
    'Name: ' || p_name || chr(10) || 'Candidates:' || chr(10) || p_brand AS prompt, p_partkey * 0.001::DOUBLE AS cost FROM part"""
)
def prompt_text(s, d):
    return table(s, d, "part").select(
        "p_partkey", X.candidate_line(F.lit("GEM"), F.col("p_name"), F.col("p_size") * 1.5).alias("line"),
        F.concat(F.lit(matchers.user_prompt("", "").split("\n")[0]), "p_name", F.lit("\nCandidates:\n"), "p_brand").alias("prompt"), D.cost_estimate(F.col("p_partkey")).alias("cost"),
    )


# -- joins ---------------------------------------------------------------------


@query("SELECT i.info_row_id, i.plant_code, coalesce(l.plant_name, i.plant_code) AS plant_name FROM eia_generator_info i LEFT JOIN eia_plant_lookup l ON i.plant_code = l.plant_code")
def lookup_left_join(s, d):
    return joins.resolve_codes(table(s, d, "eia_generator_info"), table(s, d, "eia_plant_lookup"), "plant_code", "plant_name").select("info_row_id", "plant_code", "plant_name")


@query(
    """WITH m AS (SELECT DISTINCT name AS plant_name FROM gppd UNION SELECT plant_name FROM eia_plant_lookup)
    SELECT m.plant_name, c.plant_code FROM m LEFT JOIN (SELECT DISTINCT plant_name, plant_code FROM eia_plant_lookup) c ON m.plant_name = c.plant_name"""
)
def fanout_left_join(s, d):
    lookup = table(s, d, "eia_plant_lookup")
    names = table(s, d, "gppd").select(F.col("name").alias("plant_name")).union(lookup.select("plant_name")).distinct()
    return joins.fan_out(names.withColumn("plant_code", F.lit("old")), lookup, "plant_name", "plant_code")


@query(
    """SELECT DISTINCT x.plant_name, x.source_system, x.state FROM unified_plant_crosswalk x WHERE NOT EXISTS (
    SELECT 1 FROM unified_plant_crosswalk y WHERE y.matching_method = 'rapidfuzz' AND y.plant_name IS NOT DISTINCT FROM x.plant_name AND y.state IS NOT DISTINCT FROM x.state)"""
)
def anti_join_nullsafe(s, d):
    x = table(s, d, "unified_plant_crosswalk").select("plant_name", "source_system", "state", "matching_method")
    return joins.anti_join(x.drop("matching_method"), x.where("matching_method = 'rapidfuzz'").select("plant_name", "state"), ["plant_name", "state"]).distinct()


@query(
    """WITH f AS (SELECT plant_code, arg_min(technology, info_row_id) AS technology, min(info_row_id) AS m FROM (SELECT * FROM eia_generator_info WHERE technology IS NOT NULL) GROUP BY 1)
    SELECT g.gen_row_id, g.plant_code, f.technology FROM eia_generation_data g JOIN f ON g.plant_code = f.plant_code"""
)
def first_match_lookup(s, d):
    info = table(s, d, "eia_generator_info").where("technology is not null")
    return joins.first_match_lookup(table(s, d, "eia_generation_data").select("gen_row_id", "plant_code"), info, "plant_code", ["technology"], "info_row_id")


@query(
    f"""WITH i AS (SELECT lower({Q.trim(Q.spaces("coalesce(project_name, 'nan')"))}) AS k, max(project_name) AS project_name FROM gem_database WHERE project_name IS NOT NULL GROUP BY 1)
    SELECT x.xwalk_row_id, i.project_name FROM unified_plant_crosswalk x JOIN i ON i.k = lower({Q.trim(Q.spaces("coalesce(x.ref_matched_name, 'nan')"))})"""
)
def normalized_key_join(s, d):
    x = table(s, d, "unified_plant_crosswalk").select("xwalk_row_id", "ref_matched_name")
    g = table(s, d, "gem_database").select("project_name")
    return joins.normalized_key_join(x, g, X.spaced_lower(F.col("ref_matched_name")), X.spaced_lower, "project_name").select("xwalk_row_id", "project_name")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def semi_join(s, d):
    return table(s, d, "customer").join(table(s, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi").select("c_custkey", "c_name")


@query(
    f"""WITH {Q.top_input()}, {Q.scored('q', 'c')}
    SELECT grp, key, name, ord, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY grp, key ORDER BY score DESC, ord) AS rn FROM scored WHERE score >= 80) WHERE rn = 1"""
)
def similarity_top1(s, d):
    """Every feed's names against its own catalogue."""
    names, catalogue = _top_input(s, d)
    return top_matches(names, catalogue).select("grp", "key", "name", "ord", F.round("score", 6).alias("score"))


@query(
    f"""WITH {Q.top_input()}, {Q.scored('q', 'c', bound=False)}
    SELECT grp, key, name, ord, round(score, 6) AS score, rn AS rank FROM (SELECT *, row_number() OVER (PARTITION BY grp, key ORDER BY score DESC, ord) AS rn FROM scored) WHERE rn <= 5"""
)
def similarity_topk(s, d):
    names, catalogue = _top_input(s, d)
    return top_matches(names, catalogue, 5, None).select("grp", "key", "name", "ord", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


def _top_input(s, d):
    named = feeds(s, d).where((F.trim("plant_name") != "") & F.col("source_system").isNotNull())
    keyed = X.per_distinct(named, "plant_name", {"folded": X.fold_diacritics(F.col("plant_name"))})
    return keyed.select(F.col("source_system").alias("grp"), X.comparison_key(F.col("folded")).alias("key")), cut(stages.catalogue(s, gem_units(s, d), "GEM", X.comparison_key))


@query(
    """WITH q AS (SELECT DISTINCT p_brand AS key FROM part), c AS (SELECT p_type AS name, min(p_partkey) AS ord FROM part GROUP BY 1),
    m AS (SELECT q.key, c.name, c.ord, (100 - abs(length(q.key) - length(array_to_string(list_sort(string_split(c.name, ' ')), ' '))))::DOUBLE AS score FROM q, c)
    SELECT key, name, ord, score FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY score DESC, ord) AS rn FROM m WHERE score >= 90) WHERE rn = 1"""
)
def similarity_own_scorer(s, d):
    """A scorer of one's own: here, how near two texts are in length."""
    part = table(s, d, "part")
    catalogue = part.groupBy(F.col("p_type").alias("name")).agg(F.min("p_partkey").alias("ord")).select(F.lit("part").alias("grp"), F.col("name").alias("key"), "name", "ord")
    names = part.select(F.lit("part").alias("grp"), F.col("p_brand").alias("key"))
    return top_matches(names, catalogue, 1, 90.0, scorer=lambda a, b: 100.0 - abs(len(a) - len(b))).select("key", "name", "ord", "score")


@query(
    """WITH n AS (SELECT 0 AS o, project_name AS name, min(gem_row_id) AS ord, '  GEM: ' AS label FROM gem_database WHERE country = 'Japan' AND project_name IS NOT NULL GROUP BY 2
    UNION ALL SELECT 1, name, min(gppd_row_id), '  GPPD: ' FROM gppd WHERE country = 'JPN' AND name IS NOT NULL GROUP BY 2)
    SELECT string_agg(label || name, chr(10) ORDER BY o, ord, name) AS candidates FROM n"""
)
def all_candidates(s, d):
    return stages.all_candidates({"GEM": stages.gem_info(s, gem_units(s, d)), "GPPD": stages.gppd_info(s, gppd_plants(s, d))})


@query(None)
def retriever_candidates(s, d):
    """The retriever over named sources, for every feed name."""
    g, p = gem_units(s, d).select("name", "ord"), gppd_plants(s, d).select("name", "ord")
    return stages.CandidateRetriever({"GEM": g, "GPPD": p}).candidates(feeds(s, d).where("plant_name is not null"), 3)


_HOLDERS = """cat AS (SELECT 'GEM' AS source, project_name AS name, min(gem_row_id) AS v FROM gem_database WHERE project_name IS NOT NULL GROUP BY 2
    UNION ALL SELECT 'GPPD', name, min(gppd_row_id) FROM gppd WHERE name IS NOT NULL GROUP BY 2)"""


@query(
    f"""WITH {_HOLDERS}, one AS (SELECT name, any_value(source) AS source, any_value(v) AS v FROM cat GROUP BY name HAVING count(*) = 1),
    a AS (SELECT xwalk_row_id, ref_source AS source, ref_matched_name AS name FROM unified_plant_crosswalk)
    SELECT a.xwalk_row_id, CASE WHEN c.v IS NOT NULL THEN a.source ELSE coalesce(o.source, a.source) END AS source, a.name, coalesce(c.v, o.v) AS v
    FROM a LEFT JOIN cat c ON c.source = a.source AND c.name = a.name LEFT JOIN one o ON o.name = a.name"""
)
def resolve_unique_holder(s, d):
    g, p = table(s, d, "gem_database"), table(s, d, "gppd")
    cat = g.where("project_name is not null").groupBy(F.col("project_name").alias("name")).agg(F.min("gem_row_id").alias("v")).select(F.lit("GEM").alias("source"), "name", "v")
    cat = cat.unionByName(p.where("name is not null").groupBy("name").agg(F.min("gppd_row_id").alias("v")).select(F.lit("GPPD").alias("source"), "name", "v"))
    answers = table(s, d, "unified_plant_crosswalk").select("xwalk_row_id", F.col("ref_source").alias("source"), F.col("ref_matched_name").alias("name"))
    return joins.unique_holder(answers, cat, ["v"])


# -- folds and dedup -------------------------------------------------------------


@query(f"WITH {Q.fold_units('SELECT project_name AS name, gem_row_id AS ord, * FROM gem_database')} SELECT name, ord, latitude, longitude, coal_type, combustion_tech, round(capacity_mw, 6) AS capacity_mw FROM folded")
def fold_units(s, d):
    return folds.fold_units(gem_units(s, d)).withColumn("capacity_mw", F.round("capacity_mw", 6))


@query(
    f"""WITH u AS (SELECT project_name AS plant, gem_row_id AS ord, {Q.number("replace(lower(trim(capacity)), 'mw', '')")} AS cap, {Q.coal_type('fuel')} AS ct, {Q.tech('technology')} AS tech, unit_name, subnational,
    status, latitude, longitude, latitude IS NOT NULL AND longitude IS NOT NULL AND NOT isnan(latitude) AND NOT isnan(longitude) AS located FROM gem_database WHERE project_name IS NOT NULL)
    SELECT plant, arg_min(latitude, ord) FILTER (located) AS latitude, arg_min(longitude, ord) FILTER (located) AS longitude, round(sum(cap), 6) AS capacity_mw, coalesce(arg_min(ct, ord) FILTER (ct IS NOT NULL), 'unknown') AS coal_type,
    arg_min(tech, ord) FILTER (tech IS NOT NULL) AS combustion_tech, arg_min(unit_name, ord) FILTER (unit_name IS NOT NULL) AS ref_matched_name, arg_min(subnational, ord) FILTER (subnational IS NOT NULL) AS state,
    arg_min(status, ord) FILTER (status IS NOT NULL) AS sector FROM u GROUP BY plant HAVING count(*) FILTER (located) > 0"""
)
def curated_fold(s, d):
    u = table(s, d, "gem_database").select(
        F.col("project_name").alias("plant"), F.col("gem_row_id").alias("ord"), "fuel", "capacity", "technology", "latitude", "longitude", F.col("unit_name").alias("project_name"), F.col("subnational").alias("state"), F.col("status").alias("sector")
    )
    return folds.curated_fold(u).withColumn("capacity_mw", F.round("capacity_mw", 6))


@query("SELECT xwalk_row_id, plant_name, source_system FROM (SELECT *, row_number() OVER (PARTITION BY plant_name, source_system ORDER BY xwalk_row_id) AS rn FROM unified_plant_crosswalk) WHERE rn = 1")
def dedup_keep_first(s, d):
    return dedup.keep_first(table(s, d, "unified_plant_crosswalk").select("xwalk_row_id", "plant_name", "source_system"), ["plant_name", "source_system"], [F.col("xwalk_row_id")])


@query(f"SELECT key, arg_min(name, ord) AS name, min(ord) AS ord FROM (SELECT project_name AS name, gem_row_id AS ord, {Q.key1(Q.fold('project_name'))} AS key FROM gem_database) WHERE key <> '' GROUP BY key")
def norm_index_first_wins(s, d):
    return dedup.name_index(table(s, d, "gem_database").select(F.col("project_name").alias("name"), F.col("gem_row_id").alias("ord")), lambda c: X.comparison_key(X.fold_diacritics(c)))


@query(f"SELECT key, count(DISTINCT name) AS n_names FROM (SELECT project_name AS name, {Q.key1(Q.fold('project_name'))} AS key FROM gem_database) WHERE key <> '' GROUP BY key HAVING count(DISTINCT name) > 1")
def norm_index_collisions(s, d):
    return dedup.name_collisions(table(s, d, "gem_database").select(F.col("project_name").alias("name"), F.col("gem_row_id").alias("ord")), lambda c: X.comparison_key(X.fold_diacritics(c)))


@query(
    f"""WITH u AS (SELECT gem_row_id, unit_id, {Q.number("nullif(regexp_extract(capacity, '^([0-9.]+)', 1), '')")} AS mw FROM gem_database)
    SELECT gem_row_id, unit_id, mw FROM (SELECT *, row_number() OVER (PARTITION BY unit_id ORDER BY mw DESC NULLS LAST, gem_row_id) AS rn FROM u WHERE unit_id IS NOT NULL) WHERE rn = 1
    UNION ALL SELECT gem_row_id, unit_id, mw FROM u WHERE unit_id IS NULL"""
)
def dedup_keep_highest(s, d):
    return dedup.keep_highest(table(s, d, "gem_database").select("gem_row_id", "unit_id", D.leading_capacity(F.col("capacity")).alias("mw")), "unit_id", "mw", "gem_row_id")


@query("SELECT coalesce(sum(n), 0)::BIGINT AS n_rows FROM (SELECT count(*) AS n FROM gem_database WHERE unit_id IS NOT NULL GROUP BY unit_id HAVING count(*) > 1)")
def duplicate_key_rows(s, d):
    return dedup.duplicate_row_count(table(s, d, "gem_database"), "unit_id")


@query("SELECT plant_code, generator_id, arg_max(net_generation_mwh, (loaded_at, gen_row_id)) AS net_generation_mwh FROM eia_generation_data WHERE net_generation_mwh IS NOT NULL GROUP BY ALL")
def latest_per_key(s, d):
    g = table(s, d, "eia_generation_data").where("net_generation_mwh is not null")
    return dedup.latest_per_key(g, ["plant_code", "generator_id"], "net_generation_mwh", ["loaded_at", "gen_row_id"])


@query("SELECT count(DISTINCT project_name) AS n_projects, count(DISTINCT country) AS n_countries FROM gem_database")
def distinct_count(s, d):
    return table(s, d, "gem_database").agg(F.count_distinct("project_name").alias("n_projects"), F.count_distinct("country").alias("n_countries"))


# -- reports ----------------------------------------------------------------------


@query(
    """SELECT coalesce(source_system, 'all') AS source_system, count(*) AS n_rows, count(ref_source) AS n_matched, 100.0 * count(ref_source)::DOUBLE / count(*)::DOUBLE AS pct
    FROM unified_plant_crosswalk GROUP BY GROUPING SETS ((source_system), ())"""
)
def coverage_by_group(s, d):
    return reports.coverage(table(s, d, "unified_plant_crosswalk").select("source_system", "ref_source"), "source_system", "ref_source")


@query("SELECT coalesce(matching_method, 'unmatched') AS matching_method, count(*) AS n FROM unified_plant_crosswalk GROUP BY 1")
def value_counts_with_null(s, d):
    return reports.value_counts(table(s, d, "unified_plant_crosswalk").select("matching_method"), "matching_method")


@query(
    """WITH st AS (SELECT stage, ord, count(*) AS n FROM (SELECT CASE matching_method WHEN 'direct' THEN 'direct' WHEN 'rapidfuzz' THEN 'similar' WHEN 'llm' THEN 'model' ELSE 'unmatched' END AS stage,
    CASE matching_method WHEN 'direct' THEN 1 WHEN 'rapidfuzz' THEN 2 WHEN 'llm' THEN 3 ELSE 4 END AS ord FROM unified_plant_crosswalk) GROUP BY ALL)
    SELECT stage, ord, n, sum(n) OVER (ORDER BY ord)::BIGINT AS cumulative, 100.0 * (sum(n) OVER (ORDER BY ord))::DOUBLE / (sum(n) OVER ())::DOUBLE AS cumulative_pct, 100.0 * n::DOUBLE / (sum(n) OVER ())::DOUBLE AS uplift_pct FROM st"""
)
def stage_funnel(s, d):
    m = F.col("matching_method")
    st = table(s, d, "unified_plant_crosswalk").select(
        F.when(m == "direct", "direct").when(m == "rapidfuzz", "similar").when(m == "llm", "model").otherwise("unmatched").alias("stage"),
        F.when(m == "direct", 1).when(m == "rapidfuzz", 2).when(m == "llm", 3).otherwise(4).alias("ord"),
    )
    return reports.funnel(st.groupBy("stage", "ord").agg(F.count("*").alias("n")))


@query(
    r"""WITH p AS (SELECT item_id, 'https://data.example/form/index.html' AS base, '<p><a href="files/f_' || (2001 + item_id % 25) || '.zip">' || suite || '</a> <a href="/x/f_2015_' || item_id || '.zip">y</a></p>' AS html FROM eval_items)
    SELECT year, url FROM (SELECT year, url, row_number() OVER (PARTITION BY year ORDER BY pos, url) AS rn FROM (
      SELECT (2001 + item_id % 25)::INTEGER AS year, 'https://data.example/form/files/f_' || (2001 + item_id % 25) || '.zip' AS url, 0 AS pos FROM p
      UNION ALL SELECT 2015, 'https://data.example/x/f_2015_' || item_id || '.zip', 1 FROM p) WHERE year >= 2009) WHERE rn = 1"""
)
def link_year_scan(s, d):
    i = F.col("item_id")
    year = (2001 + i % 25).cast("string")
    page = F.concat(F.lit('<p><a href="files/f_'), year, F.lit('.zip">'), "suite", F.lit('</a> <a href="/x/f_2015_'), i.cast("string"), F.lit('.zip">y</a></p>'))
    return readers.zip_links(table(s, d, "eval_items").select(page.alias("html")), "html", F.lit("https://data.example/form/index.html"))


@query(None)
def seeded_sample(s, d):
    """A sample of a stated size is the feature here."""
    return table(s, d, "unified_plant_crosswalk").orderBy(F.xxhash64("xwalk_row_id", F.lit(42)), "xwalk_row_id").select("xwalk_row_id", "plant_name").limit(5)


@query(
    """SELECT plant_name, source_system, 'old' AS version FROM unified_plant_crosswalk WHERE source_system IS NULL OR source_system NOT IN ('EIA')
    UNION ALL SELECT plant_name, 'EIA', 'new' FROM eia_plant_lookup"""
)
def merge_replace_partition(s, d):
    old = table(s, d, "unified_plant_crosswalk").select("plant_name", "source_system", F.lit("old").alias("version"))
    new = table(s, d, "eia_plant_lookup").select("plant_name", F.lit("EIA").alias("source_system"), F.lit("new").alias("version"))
    return joins.replace_partitions(old, new, "source_system", ["EIA"])


# -- stages ------------------------------------------------------------------------


@query(
    """SELECT plant_name, latitude, longitude, 'OE-direct' AS ref_source, 'direct' AS matching_method FROM unified_plant_crosswalk WHERE source_system = 'OE' AND latitude BETWEEN -90 AND 90
    AND longitude BETWEEN -180 AND 180 AND NOT (latitude = 0 AND longitude = 0)"""
)
def direct_match(s, d):
    return stages.direct_match(feeds(s, d)).select("plant_name", "latitude", "longitude", "ref_source", "matching_method")


def _inputs(s, d) -> unified.Inputs:
    return unified.Inputs(feeds(s, d), gem_units(s, d), gppd_plants(s, d), table(s, d, "eia_plant_lookup"))


def curated_units(s: SparkSession, d: str) -> DataFrame:
    """A list as the curated one, derived from the tables: the units of the project that an Indian feed name was matched to, under an irregularly spaced name."""
    x = table(s, d, "unified_plant_crosswalk").where("source_system = 'NPP' and plant_name is not null").groupBy("plant_name").agg(F.min("ref_matched_name").alias("project_name"))
    g = table(s, d, "gem_database").where("country = 'India'").select("project_name", "unit_id", "fuel", "subnational", "status", F.col("gem_row_id").alias("ord"))
    kind = F.when(F.coalesce(F.lower(F.trim("fuel")).startswith("coal"), F.lit(False)), "Coal").otherwise("other")
    return x.join(g, "project_name").select(kind.alias("type"), F.concat(F.lit(" "), F.lower(F.replace("plant_name", F.lit(" "), F.lit("  ")))).alias("plant"), "unit_id", F.col("subnational").alias("state"), F.col("status").alias("sector"), "ord")


@query(
    f"""WITH feed AS (SELECT plant_name, min(ref_matched_name) AS project FROM unified_plant_crosswalk WHERE source_system = 'NPP' AND plant_name IS NOT NULL GROUP BY 1),
    lst AS (SELECT CASE WHEN {Q.is_coal('g.fuel')} THEN 'coal' ELSE 'other' END AS type, ' ' || lower(replace(f.plant_name, ' ', '  ')) AS plant, g.unit_id, g.subnational AS state, g.status AS sector, g.gem_row_id AS ord
      FROM feed f JOIN gem_database g ON g.project_name = f.project AND g.country = 'India'),
    idx AS (SELECT lower({Q.trim(Q.spaces('plant_name'))}) AS k, max(plant_name) AS plant_name FROM feed GROUP BY 1),
    named AS (SELECT lst.*, idx.plant_name FROM lst JOIN idx ON idx.k = lower({Q.trim(Q.spaces('plant'))}) WHERE type = 'coal'),
    u AS (SELECT * FROM (SELECT unit_id, project_name, fuel, capacity, technology, latitude, longitude, row_number() OVER (PARTITION BY unit_id ORDER BY gem_row_id) AS rn FROM gem_database WHERE unit_id IS NOT NULL) WHERE rn = 1),
    w AS (SELECT n.plant, n.plant_name, n.ord, n.state, n.sector, u.project_name, {Q.number("replace(lower(trim(u.capacity)), 'mw', '')")} AS cap, {Q.coal_type('u.fuel')} AS ct, {Q.tech('u.technology')} AS tech, u.latitude, u.longitude,
      u.latitude IS NOT NULL AND u.longitude IS NOT NULL AS located FROM named n LEFT JOIN u ON u.unit_id = n.unit_id),
    folded AS (SELECT plant, plant_name, sum(cap) AS capacity_mw, coalesce(arg_min(ct, ord) FILTER (ct IS NOT NULL), 'unknown') AS coal_type, arg_min(tech, ord) FILTER (tech IS NOT NULL) AS combustion_tech,
      arg_min(project_name, ord) FILTER (project_name IS NOT NULL) AS ref_matched_name, arg_min(state, ord) FILTER (state IS NOT NULL) AS state, arg_min(sector, ord) FILTER (sector IS NOT NULL) AS sector,
      arg_min(latitude, ord) FILTER (located) AS latitude, arg_min(longitude, ord) FILTER (located) AS longitude FROM w GROUP BY ALL HAVING count(*) FILTER (located) > 0)
    SELECT plant_name, NULL::VARCHAR AS plant_code, 'NPP' AS source_system, latitude, longitude, 'GEM' AS ref_source, 'direct' AS matching_method, 'high' AS confidence, ref_matched_name, NULL::VARCHAR AS reasoning,
    coal_type, combustion_tech, round(capacity_mw, 6) AS capacity_mw, state, sector FROM (SELECT *, row_number() OVER (PARTITION BY plant_name ORDER BY plant) AS rn FROM folded) WHERE rn = 1"""
)
def curated_match(s, d):
    """The curated stage over a derived list."""
    return stages.curated_match(feeds(s, d), curated_units(s, d), gem_units(s, d)).withColumn("capacity_mw", F.round("capacity_mw", 6))


@query(None)
def unified_build_curated(s, d):
    """The whole build with the curated stage, over the same list."""
    return unified.build(replace(_inputs(s, d), curated=curated_units(s, d)), cut)


_SHOWN = ["plant_name", "plant_code", "source_system", "latitude", "longitude", "ref_source", "matching_method", "ref_matched_name", "coal_type", "combustion_tech", "capacity_mw"]


@query(f"WITH {Q.cascade()} SELECT {', '.join(_SHOWN[:-1])}, round(capacity_mw, 6) AS capacity_mw FROM cascade")
def match_cascade(s, d):
    """Both similarity stages over every feed name."""
    plants = cut(dedup.keep_first(feeds(s, d).where("plant_name is not null").distinct(), unified.KEYS, [F.asc_nulls_last("latitude"), F.asc_nulls_last("longitude"), F.asc_nulls_last("plant_code")]))
    one = cut(stages.similar_match(plants, stages.catalogue(s, gem_units(s, d), "GEM", X.comparison_key), stages.gem_info(s, gem_units(s, d)), "GEM"))
    left = joins.anti_join(plants, one, unified.KEYS)
    two = stages.similar_match(left, stages.catalogue(s, gppd_plants(s, d), "GPPD", X.second_key), stages.gppd_info(s, gppd_plants(s, d)), "GPPD")
    return one.unionByName(two).select(*_SHOWN[:-1], F.round("capacity_mw", 6).alias("capacity_mw"))


@query(f"WITH {Q.unified()} SELECT {', '.join(_SHOWN[:-1])}, round(capacity_mw, 6) AS capacity_mw FROM unified")
def unified_build(s, d):
    return unified.build(_inputs(s, d), cut).select(*_SHOWN[:-1], F.round("capacity_mw", 6).alias("capacity_mw"))


@query(None)
def llm_stage_offline(s, d):
    return unified.build(_inputs(s, d), cut, matchers.OfflineMatcher).where("matching_method = 'offline'")


_KEYED = "SELECT plant_name, plant_code, source_system FROM (SELECT *, row_number() OVER (PARTITION BY coalesce(plant_code, plant_name), source_system ORDER BY xwalk_row_id) AS rn FROM unified_plant_crosswalk WHERE coalesce(plant_code, plant_name) IS NOT NULL AND source_system IS NOT NULL) WHERE rn = 1"


def _keyed(s, d, key):
    x = table(s, d, "unified_plant_crosswalk").withColumn("__k", key).where("__k is not null and source_system is not null")
    return dedup.keep_first(x, ["__k", "source_system"], [F.col("xwalk_row_id")]).select("plant_name", "plant_code", "source_system")


@query(_KEYED)
def publish_checks(s, d):
    """The resolved table published twice over the same place, its key checked, and read again."""
    path, df = scratch(s), _keyed(s, d, F.coalesce("plant_code", "plant_name"))
    publish.publish_unified(df.limit(1), path)
    publish.publish_unified(df, path)
    return s.read.parquet(path)


@query("SELECT plant_name, plant_code, source_system FROM (SELECT *, row_number() OVER (PARTITION BY plant_name, source_system ORDER BY xwalk_row_id) AS rn FROM unified_plant_crosswalk WHERE plant_name IS NOT NULL AND source_system IS NOT NULL) WHERE rn = 1")
def publish_trial(s, d):
    path = scratch(s)
    publish.publish_trial(_keyed(s, d, F.col("plant_name")), path)
    return s.read.parquet(path)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def csv_columns(s, d):
    """A table written as CSV and read again: three of its columns, by a stated schema."""
    path, df = scratch(s), table(s, d, "customer")
    publish.write_csv(df, path)
    return readers.read_csv(s, path, df.schema, ["c_custkey", "c_name", "c_acctbal"])


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey < 0")
def missing_files(s, d):
    """Missing files count as empty tables."""
    schema = table(s, d, "supplier").select("s_suppkey", "s_name").schema
    return readers.read_csv(s, f"{scratch(s)}.csv", schema).unionByName(readers.read_table(s, scratch(s), schema))


@query(
    f"""WITH r AS (SELECT unit_id || '#' || gem_row_id AS gcpt_unit_id, CASE WHEN trim(record_source) <> '' AND trim(unit_name) <> '' THEN trim(split_part(record_source, ',', 1)) || '|' || trim(split_part(unit_name, ',', 1)) END AS eia_unit_id, project_name AS plant_name, unit_name,
    coalesce(nullif(regexp_extract(fuel, 'coal:\\s*([\\w-]+)', 1), ''), 'unknown') AS coal_type, trim(lower(coalesce(technology, 'unknown'))) AS technology, {Q.number("nullif(regexp_extract(capacity, '^([0-9.]+)', 1), '')")} AS capacity_mw, country
    FROM gem_database WHERE contains(lower(fuel), 'coal') AND unit_id IS NOT NULL)
    SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY eia_unit_id ORDER BY capacity_mw DESC NULLS LAST, gcpt_unit_id) AS rn FROM r WHERE eia_unit_id IS NOT NULL) WHERE rn = 1
    UNION ALL SELECT * FROM r WHERE eia_unit_id IS NULL"""
)
def coal_metadata(s, d):
    """Published and read again, all columns."""
    g = table(s, d, "gem_database")
    u = g.select(
        F.concat("unit_id", F.lit("#"), "gem_row_id").alias("unit_id"), "project_name", "unit_name", "fuel", "technology", "capacity", "country", F.concat(F.lit("EIA: "), "record_source").alias("location_ids"), F.concat(F.lit("EIA: "), "unit_name").alias("other_ids")
    )
    path = scratch(s)
    publish.publish_coal_metadata(u, path)
    return s.read.parquet(path)


@query(
    """SELECT try_cast(try_cast(plant_code AS DOUBLE) AS BIGINT)::VARCHAR AS plant_code, generator_id, technology, prime_mover, energy_source_1, nameplate_capacity_mw FROM eia_generator_info WHERE plant_code IS NOT NULL AND generator_id IS NOT NULL"""
)
def generator_info(s, d):
    names = {v: k for k, v in publish.GENERATOR_COLUMNS.items()}
    return publish.generator_info(table(s, d, "eia_generator_info").withColumnsRenamed(names))


@query(
    """SELECT unit_id || '|' || unit_name AS eia_plant_unit_id, CASE WHEN len(string_split(unit_id || '|' || unit_name, '|')) = 2 THEN trim(unit_id) END AS plant_code, CASE WHEN len(string_split(unit_id || '|' || unit_name, '|')) = 2 THEN trim(unit_name) END AS generator_id,
    project_name, unit_name, latitude, longitude, subnational, status FROM gem_database WHERE unit_id IS NOT NULL AND unit_name IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL"""
)
def eia_product(s, d):
    return publish.eia_product(table(s, d, "gem_database").withColumn("eia_plant_unit_id", F.concat("unit_id", F.lit("|"), "unit_name")))


@query(
    """WITH st AS (SELECT stage, ord, count(*) AS n FROM (SELECT CASE WHEN matching_method = 'direct' THEN 'direct' WHEN matching_method = 'rapidfuzz' AND ref_source = 'GEM' THEN 'similar GEM' WHEN matching_method = 'rapidfuzz' THEN 'similar GPPD' WHEN matching_method = 'llm' THEN 'model' ELSE 'unmatched' END AS stage,
    CASE WHEN matching_method = 'direct' THEN 0 WHEN matching_method = 'rapidfuzz' AND ref_source = 'GEM' THEN 1 WHEN matching_method = 'rapidfuzz' THEN 2 WHEN matching_method = 'llm' THEN 3 ELSE 4 END AS ord FROM unified_plant_crosswalk) GROUP BY ALL)
    SELECT stage, ord, n, sum(n) OVER (ORDER BY ord)::BIGINT AS cumulative, 100.0 * (sum(n) OVER (ORDER BY ord))::DOUBLE / (sum(n) OVER ())::DOUBLE AS cumulative_pct, 100.0 * n::DOUBLE / (sum(n) OVER ())::DOUBLE AS uplift_pct FROM st"""
)
def trial_funnel(s, d):
    return evaluation.trial_funnel(table(s, d, "unified_plant_crosswalk"))


@query("SELECT confidence, count(*) AS n FROM (SELECT coalesce(confidence, 'unmatched') AS confidence FROM unified_plant_crosswalk WHERE matching_method = 'llm') GROUP BY 1")
def confidence_counts(s, d):
    return evaluation.confidence_counts(table(s, d, "unified_plant_crosswalk"))


@query(None)
def matcher_check(s, d):
    """A sample of known matches put to the stand-in matcher; a sample of a stated size is the feature."""
    i = _inputs(s, d)
    indexes = {"GEM": cut(stages.catalogue(s, i.units, "GEM", X.comparison_key)), "GPPD": cut(stages.catalogue(s, i.plants, "GPPD", X.second_key))}
    infos = {"GEM": cut(stages.gem_info(s, i.units)), "GPPD": cut(stages.gppd_info(s, i.plants))}
    known = cut(evaluation.sample_known(table(s, d, "unified_plant_crosswalk"), "NPP", 10, 42))
    return evaluation.check_matcher(known, stages.candidate_text(known, indexes, infos), matchers.OfflineMatcher)


@query(
    """SELECT project_name, unit_name, country, latitude, longitude FROM (SELECT *, row_number() OVER (PARTITION BY project_name, unit_name ORDER BY gem_row_id) AS rn FROM gem_database
    WHERE country = 'India' AND latitude IS NOT NULL AND longitude IS NOT NULL) WHERE rn = 1"""
)
def unit_product(s, d):
    g = table(s, d, "gem_database").where("country = 'India'").withColumnRenamed("gem_row_id", "ord")
    return publish.unit_product(g).select("project_name", "unit_name", "country", "latitude", "longitude")


@query(
    f"""SELECT xwalk_row_id, round({Q.lcs_score("ra", "rb")}, 6) AS score FROM (SELECT xwalk_row_id, {Q.sorted_tokens("plant_name")} AS ra, {Q.sorted_tokens("ref_matched_name")} AS rb FROM unified_plant_crosswalk
    WHERE plant_name IS NOT NULL AND ref_matched_name IS NOT NULL)"""
)
def token_sort_score(s, d):
    x = table(s, d, "unified_plant_crosswalk").where("plant_name is not null and ref_matched_name is not null")
    return x.select("xwalk_row_id", F.round(S.token_sort_ratio(F.col("plant_name"), F.col("ref_matched_name")), 6).alias("score"))
