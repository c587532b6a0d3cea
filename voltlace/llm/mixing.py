"""Mixing sources to target weights (problem 7).

Method. Every document gets a hash-random key; within its source, documents
stand in the order of that key. The key's leading bits cut each source into
ranges of like size, whatever the source's size; token sums per range give,
added up in order, the sum before each range, and a window inside the range
gives the prefix sum of each document. A source is cut where its prefix sum
passes its exact budget; a source smaller than its budget is taken in whole
epochs first, at most ``max_repeats`` times in all.

The size of the mix is a parameter; by default it is the largest for which
every source that has documents can give its share.

Cases: documents without a source or whose source has no target are not taken;
targets without documents are reported with an actual share of 0, and the
others' shares are scaled to sum to 1; a target listed twice has its shares
added and the smaller cap; null shares count as 0 and null caps as 1; null
texts have no tokens and are taken with the source's first whole epoch;
repeated texts count as they stand; ties of the key go by doc_id.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Byte-level BPE's published split pattern. Fixed value.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Mix(NamedTuple):
    documents: DataFrame
    shares: DataFrame


@lru_cache(2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(text: Column, tokenizer: str = TOKENIZER) -> Column:
    """Tokens of whole texts; null has none."""

    @F.pandas_udf(T.LongType())
    def count(texts: pd.Series) -> pd.Series:
        encoding = _encoding(tokenizer)
        return texts.map(lambda t: len(encoding.encode_ordinary(t)) if t else 0).astype("int64")

    return count(text)


def mix(
    docs: DataFrame,
    targets: DataFrame,
    total_tokens: int | None = None,
    seed: int = 7,
    tokenizer: str = TOKENIZER,
    docs_per_range: int = 100_000,
    cut: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> Mix:
    """The chosen documents with their repeats, and target and actual share per source."""
    wanted = targets.where("source is not null").groupBy("source").agg(F.sum(F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0))).alias("target_share"), F.min(F.coalesce("max_repeats", F.lit(1))).alias("max_repeats"))
    sized = cut(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            "source",
            count_tokens(F.col("text"), tokenizer).alias("tokens"),
            F.xxhash64(F.col("doc_id").cast("long"), F.lit(seed)).alias("key"),
        )
    )
    # one row per source that has a target
    per_source = wanted.join(sized.groupBy("source").agg(F.sum("tokens").alias("available"), F.count("*").alias("docs")), "source", "left").na.fill(0, ["available", "docs"])
    plan = per_source.collect()
    usable = [r for r in plan if r.available > 0 and r.target_share > 0 and r.max_repeats > 0]
    whole = sum(r.target_share for r in usable)
    if total_tokens is None:
        total_tokens = int(min((r.available * r.max_repeats * whole / r.target_share for r in usable), default=0))
    budgets = [(r.source, min(int(total_tokens * r.target_share / whole), r.available * r.max_repeats), r.available) for r in usable]
    budget = docs.sparkSession.createDataFrame(
        [(s, b // n, b % n) for s, b, n in budgets], "source string, epochs long, rest long"
    )
    bits = max(0, (sum(r.docs for r in plan) // docs_per_range).bit_length())
    chosen = sized.join(F.broadcast(budget), "source").withColumn("range", F.shiftright(F.col("key"), 64 - bits) if bits else F.lit(0).cast("long"))
    per_range = chosen.groupBy("source", "range").agg(F.sum("tokens").alias("in_range"))
    before = per_range.select(
        "source", "range", (F.sum("in_range").over(Window.partitionBy("source").orderBy("range")) - F.col("in_range")).alias("before")
    )
    inside = Window.partitionBy("source", "range").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    placed = chosen.join(before, ["source", "range"]).withColumn("prefix", F.col("before") + F.sum("tokens").over(inside))
    documents = (
        placed.withColumn("repeats", F.col("epochs") + ((F.col("prefix") <= F.col("rest")) & (F.col("tokens") > 0)).cast("long"))
        .where("repeats > 0")
        .select("doc_id", "source", "tokens", "repeats")
    )
    taken = documents.groupBy("source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("actual_tokens"), F.max("repeats").alias("most_repeats"))
    shares = (
        per_source.join(taken, "source", "left")
        .na.fill(0, ["actual_tokens", "most_repeats"])
        .withColumn("all_tokens", F.sum("actual_tokens").over(Window.partitionBy(F.lit(0))))  # one row per source
        .select(
            "source",
            "target_share",
            "max_repeats",
            F.col("available").alias("available_tokens"),
            "actual_tokens",
            "most_repeats",
            F.try_divide("actual_tokens", "all_tokens").alias("actual_share"),
        )
    )
    return Mix(documents, shares)
