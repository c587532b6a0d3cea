"""Coverage, value counts and stage funnels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltlace.functions.domain import percent


def coverage(df: DataFrame, group: str, value: str) -> DataFrame:
    """Share of rows with a value, per group and in all (group null)."""
    return (
        df.rollup(group)
        .agg(F.grouping(group).alias("__all"), F.count("*").alias("n_rows"), F.count(value).alias("n_matched"))
        .select(F.when(F.col("__all") == 1, "all").otherwise(F.col(group)).alias(group), "n_rows", "n_matched", percent(F.col("n_matched"), F.col("n_rows")).alias("pct"))
    )


def value_counts(df: DataFrame, column: str, null_label: str = "unmatched") -> DataFrame:
    return df.groupBy(F.coalesce(column, F.lit(null_label)).alias(column)).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def funnel(stages: DataFrame, total: int | None = None) -> DataFrame:
    """Rows per stage with the running share; ``stages`` has stage, ord and n (a handful of rows)."""
    so_far = Window.partitionBy(F.lit(0)).orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    whole = F.lit(total) if total is not None else F.sum("n").over(Window.partitionBy(F.lit(0)))
    return stages.withColumn("cumulative", F.sum("n").over(so_far)).withColumn("cumulative_pct", percent(F.col("cumulative"), whole)).withColumn("uplift_pct", percent(F.col("n"), whole))
