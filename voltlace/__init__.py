"""Plants of several feeds resolved against reference catalogues, on Spark."""

from __future__ import annotations

import importlib

# what the package offers, and where it lies; loaded when asked for
_PLACES = {
    "Tracker": "sources.readers", "data_dir": "sources.readers", "crosswalk_dir": "sources.readers", "pull_feeds": "sources.readers", "save_product": "sources.publish", "publish_unified": "sources.publish",
    "NameMatcher": "plans.matchers", "RemoteMatcher": "plans.matchers", "OfflineMatcher": "plans.matchers", "MatchResult": "plans.matchers", "CandidateRetriever": "plans.stages", "Inputs": "plans.unified", "build": "plans.unified",
    "base_name": "functions.text", "comparison_key": "functions.text", "second_key": "functions.text", "validates": "functions.text", "fix_mojibake": "functions.text", "name_index": "operators.dedup", "top_matches": "operators.similarity_join",
}
__all__ = sorted(_PLACES)
__version__ = "0.2.0"


def __getattr__(name: str):
    if name not in _PLACES:
        raise AttributeError(name)
    return getattr(importlib.import_module(f"voltlace.{_PLACES[name]}"), name)
