"""Joins with the semantics the cascade needs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resolve_codes(rows: DataFrame, lookup: DataFrame, code: str, name: str) -> DataFrame:
    """Adds ``name`` from ``lookup``; codes it lacks stand for themselves."""
    return rows.join(lookup.select(code, name), code, "left").withColumn(name, F.coalesce(name, code))


def fan_out(matched: DataFrame, codes: DataFrame, name: str, code: str) -> DataFrame:
    """Each matched row once for each code of its name."""
    return matched.drop(code).join(codes.select(name, code).distinct(), name, "left")


def anti_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` whose keys ``right`` lacks; null keys are equal to each other."""
    done = right.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    on = None
    for k in keys:
        e = left[k].eqNullSafe(done[f"__{k}"])
        on = e if on is None else on & e
    return left.join(done, on, "left_anti")


def first_match_lookup(left: DataFrame, right: DataFrame, key: str, values: list[str], order: str) -> DataFrame:
    """Inner join with the first row of ``right`` per key."""
    first = right.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*values), order).alias("__v")).select(key, "__v.*")
    return left.join(first, key)


def normalized_key_join(left: DataFrame, right: DataFrame, left_key, right_key, right_name: str) -> DataFrame:
    """Adds the greatest ``right_name`` of equal normalised key to the rows of ``left`` that have one."""
    index = right.where(F.col(right_name).isNotNull()).groupBy(right_key(F.col(right_name)).alias("__k")).agg(F.max(right_name).alias(right_name))
    return left.withColumn("__k", left_key).join(index, "__k").drop("__k")


def unique_holder(answers: DataFrame, catalogue: DataFrame, values: list[str]) -> DataFrame:
    """Adds the catalogue's ``values`` for (source, name): the named source's, else those of the only source that has the name.

    ``catalogue`` has source, name and values, one row per source and name.
    """
    exact = catalogue.select(F.col("source").alias("source"), "name", F.struct(*values).alias("__exact"))
    only = catalogue.groupBy("name").agg(F.count("*").alias("__n"), F.first("source").alias("__src"), F.first(F.struct(*values)).alias("__only")).where("__n = 1").drop("__n")
    out = answers.join(exact, ["source", "name"], "left").join(only, "name", "left")
    got = F.coalesce("__exact", "__only")
    return out.withColumn("source", F.when(F.col("__exact").isNotNull(), F.col("source")).otherwise(F.coalesce("__src", "source"))).select(
        *answers.columns, *[got[v].alias(v) for v in values]
    )


def select_existing(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select([c for c in columns if c in df.columns])


def replace_partitions(existing: DataFrame, fresh: DataFrame, key: str, replaced: list[str]) -> DataFrame:
    """Rows of other partitions, those of a null key among them, and the fresh rows."""
    kept = existing.where(~F.coalesce(F.col(key).isin(replaced), F.lit(False)))
    return kept.unionByName(fresh, allowMissingColumns=True)
