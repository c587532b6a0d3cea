"""Evaluation texts leaking into training text (problem 6).

Method. Each shard of the training texts is turned into word numbers and an
FM-index is built over it; phrases of the test material are backward-searched
through the ranks of its wavelet matrix, occurrences are located by sampled
suffix positions, and the located phrases are merged into removal spans.

A document holds an item if it has ``RUN`` consecutive words of its passage or
question, or if ``SHARE`` of the passage's words lie in phrases of ``SEED``
words found together in one stretch of the text (single words may be changed,
dropped or added between them). Letter case, punctuation, hyphens, line breaks
and width of signs do not count.

The test material is a stated query set: it is sent to the tasks in blocks of
``BLOCK`` items, each block searched in all texts. Texts are only read where
they lie; nothing is shuffled. Cases: null and empty texts and items give no
row; a text longer than a shard makes a shard of its own and is read whole;
repeated texts are each reported.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlace.llm.fmindex import FMIndex

RUN = 12
SEED = 4
SHARE = 0.5
BLOCK = 5_000
SHARD_WORDS = 200_000

_JOIN = regex.compile(r"(?<=\p{L})[-‐‑­]\s*\n?\s*(?=\p{L})")
_WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")
_DROP = regex.compile(r"(?<=\w)['’ʼ](?=\w)|[​-‏⁠﻿­]")


class Words:
    """Splits texts into comparable words; knows the compounds of the test material, however they are written."""

    def __init__(self, material: list[str]):
        pairs = {m.group().lower() for t in material for m in regex.finditer(r"\p{L}+(?:-\p{L}+)+", t)}
        loose = [r"[-\s‐‑]*".join(map(regex.escape, p.split("-"))) for p in sorted(pairs, key=len, reverse=True)]
        self.compound = regex.compile(r"(?<!\w)(?:" + "|".join(loose) + r")(?!\w)") if loose else None

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """Words with their places in ``text``."""
        low = text.lower()
        if len(low) != len(text) or not unicodedata.is_normalized("NFKC", text):
            folded = [unicodedata.normalize("NFKC", c).lower() for c in text]
            places = [i for i, c in enumerate(folded) for _ in c]
            low = "".join(folded)
        else:
            places = None
        out: list[tuple[str, int, int]] = []
        merged = set()
        if self.compound is not None:
            for m in self.compound.finditer(low):
                out.append((regex.sub(r"\W", "", m.group()), m.start(), m.end()))
                merged.update(range(m.start(), m.end()))
        joined = {m.start(): m.end() for m in _JOIN.finditer(low)} | {m.start(): m.end() for m in _DROP.finditer(low)}
        found = [(m.group(), *m.span()) for m in _WORD.finditer(low)]
        if merged:
            found = [w for w in found if w[1] not in merged]
        parts: list[tuple[str, int, int]] = [] if joined else found
        for word in found if joined else ():
            if parts and joined.get(parts[-1][2]) == word[1]:
                parts[-1] = (parts[-1][0] + word[0], parts[-1][1], word[2])
            else:
                parts.append(word)
        out += parts
        if merged:
            out.sort(key=lambda x: x[1])
        if places is not None:
            out = [(w, places[a], places[b - 1] + 1) for w, a, b in out]
        return out


class Material:
    """Test items as word numbers, with their distinct seeds."""

    def __init__(self, items: list[tuple[int, str | None, str | None]]):
        texts = [t for _, *fields in items for t in fields if t]
        self.words = Words(texts)
        self.number: dict[str, int] = {}
        self.fields: list[tuple[int, bool, np.ndarray]] = []
        where: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for item, passage, question in items:
            for is_passage, t in ((True, passage), (False, question)):
                nums = [self.number.setdefault(w, len(self.number) + 2) for w, _, _ in self.words.spans(t)] if t else []
                if len(nums) >= SEED:
                    f = len(self.fields)
                    self.fields.append((item, is_passage, np.array(nums)))
                    for k in range(len(nums) - SEED + 1):
                        where.setdefault(tuple(nums[k : k + SEED]), []).append((f, k))
        self.seeds = np.array(list(where), np.int64).reshape(-1, SEED)
        self.where = list(where.values())


def _edited(seeds: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    """(first word, last word) of all stretches that hold ``SHARE`` of a passage of ``n`` words, from its sorted seeds.

    Every seed of a stretch counts, wherever the stretch begins. Words between
    two seeds belong to the passage if it goes on there by about as many words;
    other words, as those between two copies, do not.
    """
    reach = n * 3 // 2
    times: Counter = Counter()
    held, begin = [False] * len(seeds), 0
    last = 0  # seeds before this one are in the window, or were
    for i, (p, k) in enumerate(seeds):
        while last < len(seeds) and seeds[last][0] - p <= reach:
            times.update(range(seeds[last][1], seeds[last][1] + SEED))
            last += 1
        if len(times) >= SHARE * n:
            for j in range(max(i, begin), last):
                held[j] = True
            begin = last
        for x in range(k, k + SEED):
            times[x] -= 1
            if not times[x]:
                del times[x]
    kept = [s for s, h in zip(seeds, held) if h]
    out: list[tuple[int, int]] = []
    for i, (p, k) in enumerate(kept):
        end = p
        for q, m in kept[i + 1 :]:
            if q - p > reach:
                break
            if q - p < 2 * SEED or (m > k and q - p <= (m - k) * 3 // 2 + RUN):
                end = q
        if out and p <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], end + SEED - 1))
        else:
            out.append((p, end + SEED - 1))
    return out


def _judge(material: Material, hits: dict[int, set[tuple[int, int]]]) -> list[tuple[int, int, int]]:
    """(field, first word, last word) of the fields a document holds, from its seeds as field -> {(text place, field place)}."""
    out = []
    for f, seeds in hits.items():
        _, is_passage, nums = material.fields[f]
        diagonals: dict[int, list[int]] = {}
        for p, k in seeds:
            diagonals.setdefault(p - k, []).append(p)
        stretches = []
        for ps in diagonals.values():
            ps.sort()
            begin = last = ps[0]
            for p in [*ps[1:], None]:
                if p is not None and p == last + 1:
                    last = p
                    continue
                if last - begin + SEED >= RUN:
                    stretches.append((f, begin, last + SEED - 1))
                begin = last = p
        # all seeds together must reach the share before a stretch of them can
        if is_passage and SEED * len(seeds) >= SHARE * len(nums) and len({x for _, k in seeds for x in range(k, k + SEED)}) >= SHARE * len(nums):
            stretches += [(f, a, b) for a, b in _edited(sorted(seeds), len(nums))]
        out += stretches
    return out


def _search_shard(material: Material, docs: list[tuple[int, list[tuple[str, int, int]]]]) -> Iterator[tuple[int, int, bool, int, int]]:
    """(doc, item, is_passage, first char, end char) of the spans found in a shard."""
    symbols: list[int] = []
    doc_of: list[int] = []
    place_of: list[int] = []
    number = material.number
    for d, (_, words) in enumerate(docs):
        before_other = False
        for place, (w, _, _) in enumerate(words):
            s = number.get(w, 1)
            if s == 1 and before_other:  # a stretch of words foreign to the test material is one sign
                continue
            before_other = s == 1
            symbols.append(s)
            doc_of.append(d)
            place_of.append(place)
        symbols.append(1)
        doc_of.append(d)
        place_of.append(len(words))
    if not symbols or not len(material.seeds):
        return
    index = FMIndex(np.array(symbols))
    lo, hi = index.search(material.seeds)
    found = np.flatnonzero(hi > lo)
    if not len(found):
        return
    sizes = hi[found] - lo[found]
    seed_of = np.repeat(found, sizes)
    rows = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(lo[found], sizes)
    places = index.locate(rows)
    per_doc: dict[int, dict[int, set[tuple[int, int]]]] = {}
    for s, p in zip(seed_of.tolist(), places.tolist()):
        fields = per_doc.setdefault(doc_of[p], {})
        for f, k in material.where[s]:
            fields.setdefault(f, set()).add((place_of[p], k))
    for d, fields in per_doc.items():
        doc_id, words = docs[d]
        for f, a, b in _judge(material, fields):
            item, is_passage, _ = material.fields[f]
            yield doc_id, item, is_passage, words[a][1], words[min(b, len(words) - 1)][2]


def find_spans(docs: DataFrame, items: DataFrame, shard_words: int = SHARD_WORDS, block: int = BLOCK) -> DataFrame:
    """(doc_id, item_id, is_passage, first_char, end_char): passages and questions of ``items`` found in ``docs(doc_id, text)``."""
    rows = [tuple(r) for r in items.select("item_id", "passage", "question").where("passage is not null or question is not null").orderBy("item_id").collect()]
    schema = "doc_id long, item_id long, is_passage boolean, first_char int, end_char int"
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")

    def search(part: list[tuple]):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            material = Material(part)
            shard: list[tuple[int, list[tuple[str, int, int]]]] = []
            size = 0

            def flush() -> pd.DataFrame:
                out = pd.DataFrame(list(_search_shard(material, shard)), columns=["doc_id", "item_id", "is_passage", "first_char", "end_char"])
                return out.astype({"doc_id": "int64", "item_id": "int64", "is_passage": bool, "first_char": "int32", "end_char": "int32"})

            for pdf in batches:
                for i, t in zip(pdf["doc_id"], pdf["text"]):
                    words = material.words.spans(t)
                    shard.append((i, words))
                    size += len(words)
                    if size >= shard_words:
                        yield flush()
                        shard, size = [], 0
            if shard:
                yield flush()

        return run

    found = [texts.mapInPandas(search(rows[k : k + block]), schema) for k in range(0, len(rows), block)]
    if not found:
        return docs.sparkSession.createDataFrame([], schema)
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out


def leaked_items(spans: DataFrame) -> DataFrame:
    """(doc_id, item_id): one row per document and leaked item."""
    return spans.select("doc_id", "item_id").distinct()


def removal_spans(spans: DataFrame) -> DataFrame:
    """(doc_id, first_char, end_char): overlapping and touching spans of a document merged into one."""
    from pyspark.sql import Window

    seen = Window.partitionBy("doc_id").orderBy("first_char", "end_char")
    return (
        spans.select("doc_id", "first_char", "end_char")
        .withColumn("before", F.max("end_char").over(seen.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("part", F.sum((F.col("before").isNull() | (F.col("before") < F.col("first_char"))).cast("int")).over(seen))
        .groupBy("doc_id", "part")
        .agg(F.min("first_char").alias("first_char"), F.max("end_char").alias("end_char"))
        .drop("part")
    )
