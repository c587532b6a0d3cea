"""Queries of problem 5 and the SQL they are checked with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltlace.operators.orphans import eia_orphans, orphan_report
from voltlace.session import table


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    return eia_orphans(table(spark, d, "eia_generation_data"), table(spark, d, "eia_generator_info"), table(spark, d, "eia_plant_lookup"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).select("table_name", "row_id", "target_table")


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    return orphan_report(_orphans(spark, d))


QUERIES = {"p5_found": p5_found, "p5_report": p5_report}

_CODE = r"nullif(regexp_extract(plant_code, '^\s*\+?0*([0-9]+)(?:\.0*)?\s*$', 1), '')"
_WITH = rf"""
WITH refs AS (
  SELECT 'eia_generation_data' AS table_name, gen_row_id AS row_id, 'eia_plant_lookup' AS target_table,
         {_CODE} AS code, '' AS gen, loaded_at AS at, strftime(report_date, '%Y-%m') AS period
  FROM eia_generation_data WHERE trim(plant_code) <> ''
  UNION ALL
  SELECT 'eia_generation_data', gen_row_id, 'eia_generator_info', {_CODE}, upper(trim(generator_id)), loaded_at, strftime(report_date, '%Y-%m')
  FROM eia_generation_data WHERE trim(plant_code) <> '' AND trim(generator_id) <> ''
  UNION ALL
  SELECT 'eia_generator_info', info_row_id, 'eia_plant_lookup', {_CODE}, '', loaded_at, strftime(loaded_at, '%Y-%m')
  FROM eia_generator_info WHERE trim(plant_code) <> ''
), targets AS (
  SELECT 'eia_plant_lookup' AS target_table, {_CODE} AS code, '' AS gen, loaded_at, deleted_at FROM eia_plant_lookup
  UNION ALL
  SELECT 'eia_generator_info', {_CODE}, upper(trim(generator_id)), loaded_at, deleted_at FROM eia_generator_info
), judged AS (
  SELECT r.table_name, r.row_id, r.target_table, r.period,
         bool_or(t.loaded_at <= r.at AND (t.deleted_at IS NULL OR t.deleted_at > r.at)) AS ok,
         bool_or(t.loaded_at <= r.at) AS begun, count(t.code) AS known
  FROM refs r LEFT JOIN targets t ON t.target_table = r.target_table AND t.code = r.code AND t.gen = r.gen
  GROUP BY ALL
), orphans AS (
  SELECT table_name, row_id, target_table, period,
         CASE WHEN known = 0 THEN 'missing' WHEN coalesce(begun, false) THEN 'deleted' ELSE 'late' END AS verdict
  FROM judged WHERE NOT coalesce(ok, false)
)
"""
ORACLE = {
    "p5_found": _WITH + "SELECT table_name, row_id, target_table FROM orphans",
    "p5_report": _WITH + "SELECT table_name, target_table, period, verdict, count(*) AS n_orphans FROM orphans GROUP BY ALL",
}
