"""Resolving feed names as they arrive: each micro-batch runs the similarity stages against static catalogues.

Every stage is stateless per row, so batches are independent; results go to
the sink with the batch number, and a batch that is replayed replaces its own
files only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from voltlace.operators.joins import anti_join
from voltlace.plans import stages
from voltlace.plans.unified import KEYS


def resolve_batch(batch: DataFrame, catalogues: list[tuple[str, DataFrame, DataFrame]]) -> DataFrame:
    """Rows of a batch that a catalogue (label, index, info) matches, the first catalogue that does."""
    todo = batch.where("plant_name is not null").dropDuplicates(KEYS)
    out = stages.direct_match(todo)
    for which, index, info in catalogues:
        out = out.unionByName(stages.similar_match(anti_join(todo, out, KEYS), index, info, which))
    return out


def start(feed: DataFrame, catalogues: list[tuple[str, DataFrame, DataFrame]], path: str, checkpoint: str, done: Callable[[int], None] | None = None) -> StreamingQuery:
    """Starts the stream; ``feed`` has plant_name, plant_code, source_system, latitude, longitude."""

    def sink(batch: DataFrame, number: int) -> None:
        resolve_batch(batch, catalogues).write.mode("overwrite").parquet(f"{path}/batch={number}")
        if done is not None:
            done(number)

    return feed.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
