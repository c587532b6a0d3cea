"""Command line: build the resolved table, publish the products.

    spark-submit -m voltlace.cli build --units F --plants F [--feeds F] --lookup F [--curated F] --out DIR [--sources NPP EIA ...] [--model MODULE:FUNCTION | --no-llm] [--force] [--yes]
    spark-submit -m voltlace.cli trial --units F --plants F [--feeds F] [--sources NPP] [--model MODULE:FUNCTION] --out DIR
    spark-submit -m voltlace.cli check-model --units F --plants F [--feeds F] [--sources NPP] --known DIR --model MODULE:FUNCTION [--n 10] [--seed 42]
    spark-submit -m voltlace.cli products --tracker DIR --out DIR
    spark-submit -m voltlace.cli publish --data DIR --out DIR [--schema-only | --data-only | --trial-only | --generators-only | --coal-only]
    spark-submit -m voltlace.cli drop-old
    spark-submit -m voltlace.cli lookup --archives "DIR/*.zip" --out DIR
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from voltlace.functions.domain import cost_estimate
from voltlace.functions import text as X
from voltlace.operators import reports
from voltlace.plans import evaluation, matchers, stages, unified
from voltlace.session import cut
from voltlace.sources import publish, readers


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="voltlace")
    sub = p.add_subparsers(dest="job", required=True)
    b = sub.add_parser("build")
    b.add_argument("--units", required=True, help="first catalogue: its CSV file, or parquet")
    b.add_argument("--plants", required=True, help="second catalogue: its CSV file, or parquet")
    b.add_argument("--feeds", help="names of the feeds as parquet; without it they are pulled from the database that the environment names")
    b.add_argument("--lookup", help="plant codes and names of the American feed, parquet or CSV")
    b.add_argument("--out", required=True)
    b.add_argument("--curated", help="list of units of the Indian feed: the CSV file as published, or parquet with type, plant, unit_id, state, sector, ord")
    b.add_argument("--sources", nargs="+", choices=sorted(readers.FEEDS))
    model = b.add_mutually_exclusive_group()
    model.add_argument("--model", metavar="MODULE:FUNCTION", help="function of the system and the user prompt that calls a language model and returns its text; without it no model is called")
    model.add_argument("--no-llm", action="store_true")
    b.add_argument("--force", action="store_true", help="build anew although a result is there (without --sources)")
    b.add_argument("--yes", action="store_true", help="do not ask before the model is called")
    for job in ("trial", "check-model"):
        t = sub.add_parser(job)
        for name in ("units", "plants", "feeds", "lookup", "curated"):
            t.add_argument(f"--{name}", required=name in ("units", "plants"))
        t.add_argument("--sources", nargs=1, default=["NPP"], choices=sorted(readers.FEEDS))
        t.add_argument("--model", metavar="MODULE:FUNCTION", required=job == "check-model")
        if job == "trial":
            t.add_argument("--out", required=True)
        else:
            t.add_argument("--known", required=True, help="a resolved table")
            t.add_argument("--n", type=int, default=10)
            t.add_argument("--seed", type=int, default=42)
    q = sub.add_parser("products")
    q.add_argument("--tracker", required=True)
    q.add_argument("--out", required=True)
    r = sub.add_parser("publish")
    r.add_argument("--data", required=True)
    r.add_argument("--out", required=True)
    only = r.add_mutually_exclusive_group()
    for part in ("schema", "data", "trial", "generators", "coal"):
        only.add_argument(f"--{part}-only", action="store_true")
    sub.add_parser("drop-old")
    m = sub.add_parser("lookup")
    m.add_argument("--archives", required=True)
    m.add_argument("--out", required=True)
    return p


def read_inputs(spark: SparkSession, args: argparse.Namespace) -> unified.Inputs:
    """Missing catalogues and a missing curated list count as empty and are told; a missing lookup is an error only where the American feed is built."""
    lookup = None
    if args.lookup and readers.exists(spark, args.lookup):
        lookup = spark.read.csv(args.lookup, header=True).select("plant_code", "plant_name") if args.lookup.lower().endswith(".csv") else spark.read.parquet(args.lookup)
    curated = readers.curated_list(spark, args.curated) if args.curated and readers.exists(spark, args.curated) else None
    if args.curated and curated is None:
        print(f"{args.curated} is missing: the curated stage is left out.")
    feeds = spark.read.parquet(args.feeds) if args.feeds else cut(readers.pull_feeds(spark, args.sources))
    return unified.Inputs(feeds, readers.catalogue_file(spark, args.units, readers.UNIT_COLUMNS), readers.catalogue_file(spark, args.plants, readers.PLANT_COLUMNS), lookup, curated)


def trial(spark: SparkSession, args: argparse.Namespace) -> int:
    """One feed through all stages: its rows, the funnel of the stages and the counts of confidence."""
    matcher = matchers.remote(args.model) if args.model else None
    result = cut(unified.build(read_inputs(spark, args), cut, matcher, args.sources))
    publish.publish_trial(result, args.out)
    evaluation.trial_funnel(result).orderBy("ord").show(truncate=False)
    evaluation.confidence_counts(result).show()
    return 0


def check_model(spark: SparkSession, args: argparse.Namespace) -> int:
    """A sample of known matches put to the model; the share it finds again."""
    inputs = read_inputs(spark, args)
    known = cut(evaluation.sample_known(spark.read.parquet(args.known), args.sources[0], args.n, args.seed))
    indexes = {"GEM": cut(stages.catalogue(spark, inputs.units, "GEM", X.comparison_key)), "GPPD": cut(stages.catalogue(spark, inputs.plants, "GPPD", X.second_key))}
    infos = {"GEM": cut(stages.gem_info(spark, inputs.units)), "GPPD": cut(stages.gppd_info(spark, inputs.plants))}
    checked = cut(evaluation.check_matcher(known, stages.candidate_text(known, indexes, infos), matchers.remote(args.model)))
    checked.show(args.n, truncate=False)
    evaluation.pass_rate(checked).show()
    return 0


def build(spark: SparkSession, args: argparse.Namespace, ask=input) -> int:
    there = readers.exists(spark, args.out)
    existing = spark.read.parquet(args.out) if there else None
    if there and not args.sources and not args.force:
        reports.coverage(existing, "source_system", "ref_source").show(truncate=False)
        return 0
    inputs = read_inputs(spark, args)
    matcher = matchers.remote(args.model) if args.model else None
    if not args.no_llm and not args.yes:
        n = inputs.feeds.select(F.count_distinct(F.coalesce("plant_name", "plant_code"), "source_system")).first()[0]
        price = spark.range(1).select(cost_estimate(F.lit(n))).first()[0]
        if ask(f"Up to {n} names go to the model, at most about {price:.2f} dollars. Go on? [y/N] ").strip().lower() != "y":
            matcher = None
    if not args.no_llm and args.model is None:
        print("No model is configured (--model): the model stage is left out.")
    result = cut(unified.build(inputs, cut, matcher, args.sources, existing))
    publish.publish_unified(result, args.out)
    reports.coverage(result, "source_system", "ref_source").show(truncate=False)
    reports.value_counts(result.select("matching_method"), "matching_method").show()
    return 0


def publish_products(spark: SparkSession, args: argparse.Namespace) -> int:
    from pathlib import Path

    made = publish.feed_products(readers.Tracker(spark, Path(args.tracker)))
    ok = [publish.save_product(df, f"{args.out}/{name.lower()}_crosswalk.parquet") for name, df in made.items()]
    return 0 if all(ok) else 1


# Schema scripts in the order they are run.
SCHEMA_SCRIPTS = (
    "extraction_metadata.sql",
    "eia_generation.sql",
    "eia_generator_info.sql",
    "gcpt_coal_metadata.sql",
    "entsoe_generation.sql",
    "npp_generation.sql",
    "ons_generation.sql",
    "oe_generation.sql",
    "oe_facility_generation.sql",
    "occto_generation.sql",
    "chile_generation.sql",
    "materialized_views.sql",
)
# Superseded tables, dropped once the table that replaces them has rows.
GUARD_TABLE = "plant_crosswalk"
OLD_TABLES = ["plant_coordinates_eia", "plant_coordinates_entsoe", "plant_coordinates_npp", "gppd_global", "gcpt_global", "npp_gipt_crosswalk"]


def publish_tables(spark: SparkSession, args: argparse.Namespace) -> int:
    """Publishes from ``data``: unified.parquet, trial.parquet, generators.xlsx and units.parquet; what is missing is skipped."""
    from pathlib import Path

    from voltlace.sources.excel import read_excel

    data = Path(args.data)
    if not publish.alive(spark):
        return 1

    def of(name: str, job):
        path = data / name
        if not path.exists():
            print(f"skipped: {path} is missing")
            return 0
        return job(str(path))

    jobs = {
        "unified": lambda: of("unified.parquet", lambda p: publish.publish_unified(spark.read.parquet(p), f"{args.out}/unified_plant_crosswalk")),
        "generators": lambda: of("generators.xlsx", lambda p: publish.publish_generator_info(read_excel(spark, p, skip_rows=1), f"{args.out}/eia_generator_info")),
        "coal": lambda: of("units.parquet", lambda p: publish.publish_coal_metadata(spark.read.parquet(p), f"{args.out}/gcpt_coal_metadata")),
    }
    trial = {"trial": lambda: of("trial.parquet", lambda p: publish.publish_trial(spark.read.parquet(p), f"{args.out}/npp_llm_test"))}
    one = next((x for x in ("trial", "generators", "coal") if getattr(args, f"{x}_only")), None)
    if one is not None:
        print(publish.publish_all({one: {**jobs, **trial}[one]}))
        return 0
    if not args.data_only:
        scripts = [data / "schema" / n for n in SCHEMA_SCRIPTS]
        publish.run_ddl(spark, [p.read_text() if p.exists() else None for p in scripts])
    if not args.schema_only:
        print(publish.publish_all(jobs))
    return 0


def build_lookup(spark: SparkSession, args: argparse.Namespace) -> int:
    from voltlace.sources import lookup

    lookup.build_lookup(spark, args.archives, args.out)
    return 0


def drop_old(spark: SparkSession, args: argparse.Namespace) -> int:
    publish.guarded_drop(spark, GUARD_TABLE, OLD_TABLES)
    return 0


JOBS = {"trial": trial, "check-model": check_model, "drop-old": drop_old, "build": build, "products": publish_products, "publish": publish_tables, "lookup": build_lookup}


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("voltlace").getOrCreate()
    return JOBS[args.job](spark, args)


if __name__ == "__main__":
    sys.exit(main())
