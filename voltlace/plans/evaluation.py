"""Trials: one feed through the stages with a funnel, and a sampled check of a matcher against known matches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlace.functions import text as X
from voltlace.operators import reports
from voltlace.plans.matchers import NameMatcher, run_matcher


def sample_known(resolved: DataFrame, source: str, n: int, seed: int) -> DataFrame:
    """``n`` rows of a feed that the similarity stage matched, drawn by the hash of their name."""
    known = resolved.where((F.col("source_system") == source) & (F.col("matching_method") == "rapidfuzz") & F.col("ref_matched_name").isNotNull())
    return known.select("plant_name", "source_system", "ref_matched_name").distinct().orderBy(F.xxhash64("plant_name", F.lit(seed)), "plant_name").limit(n)


def check_matcher(known: DataFrame, candidates: DataFrame, build: Callable[[], NameMatcher]) -> DataFrame:
    """(plant_name, ref_matched_name, match, listed, passed): whether the matcher names the known match, label and case aside.

    ``listed`` says whether the known match is among the candidates at all.
    """
    asked = candidates.join(known, ["plant_name", "source_system"])
    replies = run_matcher(asked.select("plant_name", "source_system", "candidates"), build).select("plant_name", "source_system", "match", "confidence", "reasoning")
    same = X.without_label(F.col("match")) == F.lower(F.trim("ref_matched_name"))
    scored = X.without_label(F.regexp_replace("match", r"\s*\(score: \d+(?:\.\d+)?\)\s*$", "")) == F.lower(F.trim("ref_matched_name"))
    return asked.join(replies, ["plant_name", "source_system"]).select(
        "plant_name",
        "ref_matched_name",
        "match",
        "confidence",
        F.contains(F.lower("candidates"), F.lower("ref_matched_name")).alias("listed"),
        F.coalesce(same | scored, F.lit(False)).alias("passed"),
        "reasoning",
    )


def pass_rate(checked: DataFrame) -> DataFrame:
    return checked.agg(F.count("*").alias("n"), F.sum(F.col("passed").cast("long")).alias("n_passed"), F.avg(F.col("passed").cast("double")).alias("rate"))


def stage_of(method: str = "matching_method", source: str = "ref_source"):
    """(stage, ord) of a resolved row."""
    m, s = F.col(method), F.col(source)
    stage = F.when(m == "direct", "direct").when((m == "rapidfuzz") & (s == "GEM"), "similar GEM").when(m == "rapidfuzz", "similar GPPD").when(m == "llm", "model").otherwise("unmatched")
    order = F.when(m == "direct", 0).when((m == "rapidfuzz") & (s == "GEM"), 1).when(m == "rapidfuzz", 2).when(m == "llm", 3).otherwise(4)
    return stage, order


def trial_funnel(resolved: DataFrame) -> DataFrame:
    """Rows per stage with running coverage and each stage's gain."""
    stage, order = stage_of()
    return reports.funnel(resolved.groupBy(stage.alias("stage"), order.alias("ord")).agg(F.count("*").alias("n")))


def confidence_counts(resolved: DataFrame) -> DataFrame:
    return reports.value_counts(resolved.where("matching_method = 'llm'").select("confidence"), "confidence")
