"""Language-model matchers: interface, remote client with its failure rules, offline stand-in, and the operator that runs them."""

from __future__ import annotations

import importlib
import json
import re
import time
from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a feed's names look like; goes into the prompt.
CONTEXT = {
    "NPP": ("Indian power stations", "TPS and STPS are (super) thermal power stations, CCPP combined cycle; transliterations, initials and company words vary"),
    "EIA": ("power stations of the United States", "owner names and facility words come and go; CC, CT and GT are technologies"),
    "ENTSOE": ("European power stations", "names are in local languages, often per block; words such as Kraftwerk, Elektrownia or Centrale mean a power station"),
    "ONS": ("Brazilian power stations", "UTE is thermal, UHE hydro, EOL wind, UFV solar; saints and river names are shortened"),
    "OE": ("Australian power stations", "names are short; stage and unit numbers may be added"),
    "OCCTO": ("Japanese power stations", "names are in Japanese script and candidates in Latin letters; compare by reading"),
    "CHILE": ("Chilean power stations", "names are in Spanish; words such as Central and Termoeléctrica mean a power station"),
}
ALL_CANDIDATES_FEED = "OCCTO"


@dataclass(frozen=True)
class MatchResult:
    plant_name: str | None
    match: object
    source: object
    confidence: object
    reasoning: str | None


def system_prompt(source_system: str | None = None) -> str:
    field, habits = CONTEXT.get(source_system or "", ("power stations worldwide", "spelling, suffixes and languages vary"))
    return (
        f"You know {field}. You are given the name of a power station and candidates from reference catalogues. Decide whether one candidate is the same physical site. "
        f"Habits of these names: {habits}. Answer with one JSON object with the keys match (the candidate's text with its catalogue label, or null), source, "
        "confidence (high, medium or low) and reasoning, and nothing else."
    )


def user_prompt(plant_name: str, candidates: str) -> str:
    return f"Name: {plant_name}\nCandidates:\n{candidates}"


class NameMatcher(ABC):
    """Plug-in: takes a name and the text of its candidates; ``method`` is what its rows are published as."""

    method = "llm"

    @property
    @abstractmethod
    def name(self) -> str: ...

    @abstractmethod
    def match(self, plant_name: str, candidates: str, source_system: str | None = None) -> MatchResult: ...


class RemoteError(Exception):
    """Failure of a call; ``status`` is the HTTP status if there was one."""

    def __init__(self, message: str, status: int | None = None):
        super().__init__(message)
        self.status = status


def parse_reply(plant_name: str, text: str) -> MatchResult:
    """Result of the JSON object between the first and the last brace; the rest is a labelled failure."""
    a, b = text.find("{"), text.rfind("}")
    failed = MatchResult(plant_name, None, None, None, f"PARSE_FAILURE: {text[:100]}")
    if a < 0 or b < a:
        return failed
    try:
        reply = json.loads(text[a : b + 1])
    except ValueError:
        return failed
    return MatchResult(plant_name, reply.get("match"), reply.get("source"), reply.get("confidence"), reply.get("reasoning", ""))


class RemoteMatcher(NameMatcher):
    """Calls ``generate(system, user)``: three attempts, pauses of 5 and 10 s; client errors are not tried again; no text is an error."""

    ATTEMPTS = 3
    PAUSE_S = 5.0

    def __init__(self, generate: Callable[[str, str], str | None], sleep: Callable[[float], None] = time.sleep):
        self.generate, self.sleep = generate, sleep

    @property
    def name(self) -> str:
        return "remote"

    def match(self, plant_name: str, candidates: str, source_system: str | None = None) -> MatchResult:
        error: Exception | None = None
        for attempt in range(self.ATTEMPTS):
            if attempt:
                self.sleep(self.PAUSE_S * attempt)
            try:
                text = self.generate(system_prompt(source_system), user_prompt(plant_name, candidates))
                if text is None:
                    raise RemoteError("no text in the reply")
                return parse_reply(plant_name, text)
            except Exception as e:  # noqa: BLE001 - any failure of the call is reported, not raised
                error = e
                if 400 <= (getattr(e, "status", None) or 0) < 500:
                    break
        return MatchResult(plant_name, None, None, None, f"API_FAILURE: {error}")


def remote(target: str) -> Callable[[], RemoteMatcher]:
    """Builder of a remote matcher over the function ``MODULE:FUNCTION``, which tasks import themselves."""
    module, _, function = target.partition(":")
    if not callable(getattr(importlib.import_module(module), function, None)):
        raise ValueError(f"{target} names no function; give MODULE:FUNCTION")
    return lambda: RemoteMatcher(getattr(importlib.import_module(module), function))


class OfflineMatcher(NameMatcher):
    """Stand-in without a model: takes the first candidate line from ``minimum`` points on; high confidence from 90."""

    method = "offline"

    def __init__(self, minimum: int = 60):
        self.minimum = minimum

    @property
    def name(self) -> str:
        return "offline"

    def match(self, plant_name: str, candidates: str, source_system: str | None = None) -> MatchResult:
        line = candidates.split("\n", 1)[0].strip()
        m = re.search(r"\(score: (\d+)\)$", line)
        if not m or int(m.group(1)) < self.minimum:
            return MatchResult(plant_name, None, None, None, "no candidate is close")
        return MatchResult(plant_name, line, line.split(":", 1)[0], "high" if int(m.group(1)) >= 90 else "medium", "closest candidate")


REPLY = "plant_name string, source_system string, match string, source string, confidence string, reasoning string, status string, method string"


def run_matcher(candidates: DataFrame, build: Callable[[], NameMatcher], shared: dict[str, str] | None = None) -> DataFrame:
    """Replies for ``candidates(plant_name, source_system, candidates)``; only strings count as match, source and confidence.

    The matcher is built once per task. Calls cost money, so write the result
    before using it twice. ``shared`` holds, by feed, the text of rows whose
    candidates are null; it goes to the tasks once, not with each row.
    """
    sent = candidates.sparkSession.sparkContext.broadcast(shared or {})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = build()
        text = lambda x: x if isinstance(x, str) else None
        for pdf in batches:
            rows = []
            for plant, feed, cands in zip(pdf["plant_name"], pdf["source_system"], pdf["candidates"]):
                r = asdict(matcher.match(plant, cands if isinstance(cands, str) else sent.value.get(feed, ""), feed))
                reason = text(r["reasoning"]) or ""
                status = "failed" if re.match("(API|PARSE)_FAILURE", reason) else ("match" if isinstance(r["match"], str) and r["match"] else "no match")
                rows.append((plant, feed, text(r["match"]), text(r["source"]), text(r["confidence"]), reason, status, matcher.method))
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in REPLY.split(", ")], dtype=object)

    return candidates.mapInPandas(run, REPLY)


def usable(match: Column, confidence: Column) -> Column:
    """A non-empty text at high or medium confidence."""
    return F.coalesce((match != "") & F.lower(F.trim(confidence)).isin("high", "medium"), F.lit(False))


def usable_reply(raw: Column) -> Column:
    """The same, of a JSON reply in free text, without Python: a match of another type than string is refused."""
    v = F.try_parse_json(F.nullif(F.regexp_extract(raw, r"(?s)\{.*\}", 0), F.lit("")))
    is_text = F.schema_of_variant(F.try_variant_get(v, "$.match", "variant")) == "STRING"
    return F.coalesce(is_text, F.lit(False)) & usable(F.try_variant_get(v, "$.match", "string"), F.try_variant_get(v, "$.confidence", "string"))
