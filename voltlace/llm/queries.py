"""Queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlace.llm import confusables, entity, leakage, mixing, mojibake, pii, survivor
from voltlace.session import cut, table


def name_rows(spark: SparkSession, d: str, gppd: bool) -> DataFrame:
    """(table_name, row_id, name) of the name columns."""
    rows = (
        table(spark, d, "gem_database")
        .selectExpr("'gem_database' table_name", "gem_row_id row_id", "project_name name")
        .unionByName(table(spark, d, "unified_plant_crosswalk").selectExpr("'unified_plant_crosswalk' table_name", "xwalk_row_id row_id", "plant_name name"))
    )
    if gppd:
        rows = rows.unionByName(table(spark, d, "gppd").selectExpr("'gppd' table_name", "gppd_row_id row_id", "name"))
    return rows


def _corpus(spark: SparkSession, d: str) -> DataFrame:
    """Names of all columns: their clean words are what garbled ones may have been."""
    x = table(spark, d, "unified_plant_crosswalk")
    return name_rows(spark, d, gppd=True).select("name").unionByName(x.select(F.col("ref_matched_name").alias("name")))


def _repaired(spark: SparkSession, d: str, rows: DataFrame) -> DataFrame:
    """``rows`` (whose names are of the corpus) with ``garbled`` and ``restored``."""
    x = table(spark, d, "unified_plant_crosswalk")
    return mojibake.repair_names(rows, x.select(F.col("ref_matched_name").alias("name")), cut)


def _garbled(spark: SparkSession, d: str) -> DataFrame:
    corpus = table(spark, d, "gppd").select("name").unionByName(table(spark, d, "unified_plant_crosswalk").select(F.col("ref_matched_name").alias("name")))
    return mojibake.repair_names(name_rows(spark, d, gppd=False), corpus, cut).where("garbled").drop("garbled")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _garbled(spark, d).select("table_name", "row_id")


def p1_restored(spark: SparkSession, d: str) -> DataFrame:
    return _garbled(spark, d)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose name its skeleton's group has not among its sound forms, but for the cases of p1 (names of gppd never are)."""
    rows = name_rows(spark, d, gppd=True)
    names, _ = confusables.grouped(rows)
    names = cut(names)
    odd = cut(confusables.variants(names, names.groupBy("skeleton", "form").agg(F.sum("n").alias("n"))).select("name"))
    # only these names are asked about; their originals are looked for in the whole corpus
    judged = mojibake.repair_names(odd, _corpus(spark, d), cut).select("name", "garbled")
    return rows.join(judged, "name").where("not garbled or table_name = 'gppd'").select("table_name", "row_id")


def p3_unified(spark: SparkSession, d: str) -> DataFrame:
    return confusables.unify(name_rows(spark, d, gppd=True), cut)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return pii.find(table(spark, d, "documents"))


def p8_redacted(spark: SparkSession, d: str) -> DataFrame:
    return pii.redact(table(spark, d, "documents").select("doc_id", "text"))


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return leakage.find_spans(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked_items(_leaks(spark, d))


def p6_removal(spark: SparkSession, d: str) -> DataFrame:
    return leakage.removal_spans(_leaks(spark, d))


def _mix(spark: SparkSession, d: str) -> mixing.Mix:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"), cut=cut)


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d).documents


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d).shares


def _plant_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the three tables with the originals of garbled names."""
    rows = (
        entity.gem_rows(table(spark, d, "gem_database"))
        .unionByName(entity.gppd_rows(table(spark, d, "gppd")))
        .unionByName(entity.crosswalk_rows(table(spark, d, "unified_plant_crosswalk")))
    )
    return _repaired(spark, d, rows)


def p2_matches(spark: SparkSession, d: str) -> DataFrame:
    return entity.match(_plant_rows(spark, d), cut)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return p2_matches(spark, d).select("id_a", "id_b")


def _unit_groups(spark: SparkSession, d: str) -> DataFrame:
    members, _ = entity.resolve(_plant_rows(spark, d), cut)
    return survivor.unit_groups(table(spark, d, "gem_database"), members)


def _survivors(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    groups = cut(_unit_groups(spark, d))
    return survivor.surviving_units(table(spark, d, "gem_database"), table(spark, d, "record_sources"), groups), groups


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of the rows that one surviving record stands for."""
    best, groups = _survivors(spark, d)
    return survivor.duplicate_pairs(cut(best), groups)


def p4_survivors(spark: SparkSession, d: str) -> DataFrame:
    return _survivors(spark, d)[0]


QUERIES = {"p1_found": p1_found, "p1_restored": p1_restored, "p2_found": p2_found, "p2_matches": p2_matches, "p3_found": p3_found, "p3_unified": p3_unified, "p4_found": p4_found, "p4_survivors": p4_survivors, "p6_found": p6_found, "p6_removal": p6_removal, "p7_mix": p7_mix, "p7_shares": p7_shares, "p8_found": p8_found, "p8_redacted": p8_redacted}
ORACLE: dict[str, str] = {}
