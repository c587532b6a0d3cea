"""Similarity top-1 / top-k join of names with a catalogue, exhaustive within a group.

The catalogue is a stated set: it goes to the tasks in blocks of at most
``block`` names (checked by counting; some 80 MB), and each block is scored
against the distinct names. A name only meets the part of its group's catalogue
whose lengths can reach the cutoff or, once ``k`` names are found, the least of
their scores, which the score's definition bounds exactly; so no hit is lost.
Names are spread evenly over all cores first, whatever their group and however
few bytes they are, so a group that holds most names is no hot spot; those with
the same ending come together and share the work on it. More than one block
costs one more pass each and a last merge per name.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltlace.functions.similarity import Catalogue, Pairwise, token_sorted

BLOCK = 750_000


def top_matches(names: DataFrame, catalogue: DataFrame, k: int = 1, cutoff: float | None = 80.0, block: int = BLOCK, scorer: Callable[[str, str], float] | None = None) -> DataFrame:
    """(grp, key, name, ord, score, rank): the ``k`` best names of the catalogue for each distinct (grp, key).

    ``names`` has grp and key, ``catalogue`` grp, key, name and ord. Equal
    scores go to the lower ``ord``. Null or empty keys of names find nothing.
    ``scorer`` takes two token-sorted keys and gives 0 to 100; without one the
    bit-parallel token-sort ratio scores.
    """
    spark = names.sparkSession
    queries = names.where("key <> ''").select("grp", "key").distinct().withColumn("sorted", token_sorted(F.col("key"))).repartitionByRange(4 * spark.sparkContext.defaultParallelism, F.reverse("sorted"), "grp")
    refs = catalogue.where("key is not null").select("grp", "name", F.col("ord").cast("long").alias("ord"), token_sorted(F.col("key")).alias("sorted"))
    whole = refs.limit(block + 1).toPandas()  # at most one name over a block
    blocks = 1 if len(whole) <= block else math.ceil(refs.count() / block)
    schema = "grp string, key string, name string, ord long, score double"

    def search(part: pd.DataFrame):
        by_length = part.assign(length=part["sorted"].str.len()).sort_values(["length", "ord"])
        sent = spark.sparkContext.broadcast({g: (p["sorted"].tolist(), p["name"].to_numpy(object), p["ord"].to_numpy()) for g, p in by_length.groupby("grp")})
        make = Catalogue if scorer is None else Pairwise(scorer)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            built: dict[str, Catalogue | Pairwise] = {}
            for pdf in batches:
                out: list[tuple] = []
                for g, asked in pdf.groupby("grp"):
                    if g not in sent.value:
                        continue
                    keys, labels, ords = sent.value[g]
                    if g not in built:
                        built[g] = make(keys)
                    for key, (places, scores) in zip(asked["key"], built[g].best(asked["sorted"].tolist(), k, cutoff, ords)):
                        out += [(g, key, labels[i], int(ords[i]), float(x)) for i, x in zip(places, scores)]
                yield pd.DataFrame(out, columns=["grp", "key", "name", "ord", "score"]).astype({"ord": "int64", "score": "float64"})

        return run

    found = None
    for b in range(blocks):
        part = refs.where(F.pmod(F.xxhash64("ord", "name"), F.lit(blocks)) == b).toPandas() if blocks > 1 else whole
        hits = queries.mapInPandas(search(part), schema)
        found = hits if found is None else found.unionAll(hits)
    order = Window.partitionBy("grp", "key").orderBy(F.desc("score"), "ord")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
