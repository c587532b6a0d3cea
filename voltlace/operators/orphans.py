"""References to records that do not exist (problem 5).

References and the validity intervals of their targets are brought together
by key in one shuffle, sorted by time, and read as one merged stream: a
running maximum over the intervals that have begun says until when the key is
in force at each reference. No join is made, so a key that nearly every row
refers to is never gathered: references are spread over ``salts`` parts and
only the (few) target rows are repeated for each part.

Verdicts: ``missing`` - no target row ever has the key; ``late`` - all such
rows are loaded after the reference; ``deleted`` - those loaded before it are
deleted by then.

Defined results: a null or blank part makes no reference; a reference without
a load time has no target in force and is an orphan (``late`` if its key
exists, else ``missing``); a target without a load time is never in force;
equal times count as loaded before, and a target deleted at the very moment
as deleted; repeated rows are judged one by one; empty tables give no rows or
only orphans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NEVER = "0001-01-01"
FOREVER = "9999-12-31"


def whole_number_key(c: Column) -> Column:
    """Canonical text of a whole number: no leading zeros, outer spaces or zero fraction. Other text gives null."""
    digits = F.regexp_extract(c, r"(?U)^\s*\+?0*([0-9]+)(?:\.0*)?\s*$", 1)
    return F.when(digits != "", digits)


def label_key(c: Column) -> Column:
    """Canonical text of a label: no outer spaces, upper case; blank gives null."""
    trimmed = F.upper(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))
    return F.when(trimmed != "", trimmed)


def is_blank(c: Column) -> Column:
    return c.isNull() | (F.regexp_replace(c, r"(?U)\s", "") == "")


def references(df: DataFrame, table_name: str, target: str, row_id: str, codes: list[Column], given: Column, loaded: Column, period: Column) -> DataFrame:
    """One row per reference; ``codes`` are its canonical key parts, null where the text is no possible key."""
    return df.where(given).select(
        F.lit(table_name).alias("table_name"),
        F.col(row_id).cast("long").alias("row_id"),
        F.lit(target).alias("target_table"),
        period.alias("period"),
        *[c.alias(f"k{i}") for i, c in enumerate(codes)],
        loaded.cast("timestamp_ntz").alias("at"),
    )


def targets(df: DataFrame, target: str, codes: list[Column], loaded: Column, deleted: Column) -> DataFrame:
    """Validity intervals of the target rows."""
    return df.select(
        F.lit(target).alias("target_table"),
        *[c.alias(f"k{i}") for i, c in enumerate(codes)],
        loaded.cast("timestamp_ntz").alias("at"),
        F.coalesce(deleted.cast("timestamp_ntz"), F.lit(FOREVER).cast("timestamp_ntz")).alias("until"),
    )


def find_orphans(refs: DataFrame, intervals: DataFrame, keys: int, salts: int = 16) -> DataFrame:
    """Orphans among ``refs`` with their verdict.

    ``keys`` is the number of key parts. Each target row gives two marks: one
    at the beginning of time, that its key exists, and one at its load time.
    """
    ks = [f"k{i}" for i in range(keys)]
    never = F.lit(NEVER).cast("timestamp_ntz")
    asked = refs.withColumn("salt", F.pmod(F.xxhash64("row_id"), F.lit(salts)).cast("byte")).select(
        "target_table", *ks, "salt", F.coalesce("at", never).alias("at"), F.lit(True).alias("asks"),
        F.lit(None).cast("timestamp_ntz").alias("until"), "table_name", "row_id", "period",
    )
    known = intervals.na.drop(subset=ks)
    marks = (
        known.withColumn(
            "m",
            F.explode(
                F.array(
                    F.struct(never.alias("at"), never.alias("until")),
                    F.struct(F.col("at"), F.col("until")),
                )
            ),
        )
        .where("m.at is not null")
        .withColumn("salt", F.explode(F.expr(f"transform(sequence(0, {salts - 1}), x -> cast(x as byte))")))
        .select(
            "target_table", *ks, "salt", F.col("m.at").alias("at"), F.lit(False).alias("asks"), F.col("m.until").alias("until"),
            F.lit(None).cast("string").alias("table_name"), F.lit(None).cast("long").alias("row_id"), F.lit(None).cast(refs.schema["period"].dataType).alias("period"),
        )
    )
    merged = Window.partitionBy("target_table", *ks, "salt").orderBy("at", "asks").rowsBetween(Window.unboundedPreceding, 0)
    return (
        asked.unionByName(marks)
        .withColumn("in_force_until", F.max("until").over(merged))
        .where(F.col("asks") & (F.col("in_force_until").isNull() | (F.col("in_force_until") <= F.col("at"))))
        .select(
            "table_name",
            "row_id",
            "target_table",
            "period",
            F.when(F.col("in_force_until").isNull(), "missing").when(F.col("in_force_until") == never, "late").otherwise("deleted").alias("verdict"),
        )
    )


def eia_orphans(generation: DataFrame, info: DataFrame, lookup: DataFrame, salts: int = 16) -> DataFrame:
    """Orphans of the three EIA references; ``period`` is the month of report_date or loaded_at."""
    month = lambda c: F.date_format(F.col(c), "yyyy-MM")
    code, none = whole_number_key(F.col("plant_code")), F.lit("")
    # no possible key: a text that no target can have
    asked = F.coalesce(code, F.concat(F.lit("not a number: "), F.col("plant_code")))
    has_code = ~is_blank(F.col("plant_code"))
    generator = label_key(F.col("generator_id"))
    refs = (
        references(generation, "eia_generation_data", "eia_plant_lookup", "gen_row_id", [asked, none], has_code, F.col("loaded_at"), month("report_date"))
        .unionByName(references(generation, "eia_generation_data", "eia_generator_info", "gen_row_id", [asked, generator], has_code & generator.isNotNull(), F.col("loaded_at"), month("report_date")))
        .unionByName(references(info, "eia_generator_info", "eia_plant_lookup", "info_row_id", [asked, none], has_code, F.col("loaded_at"), month("loaded_at")))
    )
    intervals = targets(lookup, "eia_plant_lookup", [code, none], F.col("loaded_at"), F.col("deleted_at")).unionByName(
        targets(info, "eia_generator_info", [code, generator], F.col("loaded_at"), F.col("deleted_at"))
    )
    return find_orphans(refs, intervals, 2, salts)


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Orphans per table, target, month and verdict."""
    return orphans.groupBy("table_name", "target_table", "period", "verdict").agg(F.count("*").alias("n_orphans"))
