"""Text functions on columns: repair, folding, suffix stripping, keys, matching text."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words that carry no meaning in a plant name.
STOP_WORDS = [
    "power", "plant", "energy", "thermal", "station", "project", "limited", "ltd", "pvt", "private", "corporation", "corp",
    "company", "group", "industries", "generation", "electric",
]
# Endings of feed names.
FEED_SUFFIXES = [
    " REPLACEMENT POWER PROJECT", " SUPER THERMAL POWER STATION", " STPS", " STPP", " TPS", " TPP", " UMTPP", " SCTPP", " NCTPP", " CCPP", " CCGT", " HPS", " HEP",
    " A.P.S.", " PSP", " PSS", " GPS", " GT", " DG", " D.G", " ST-I", " ST-II", " ST-III", " ST-IV", " ST-1", " ST-2", " ST-3", " ST-4", " PH-I", " PH-II", " EXTN", " EXT",
    " EXP", " IMP", " PH I", " PH II", " (Liq.)", " (NCTPP)",
]
# Endings of catalogue names.
CATALOGUE_SUFFIXES = [
    " power station", " power plant", " thermal power plant", " thermal power station", " super thermal power station", " Super Thermal Power Station",
    " Thermal Power Plant", " Power Station", " Power Plant", " project", " Project",
]
# Technologies that are not coal, and the one ending that is cut from names of the second catalogue.
NON_COAL = r"(?i)(?:^|[\s\W])(?:HPS|HEP|HEPP|CCPP|OCGT|CCGT|GT-?\d|NUCLEAR|NPP|WIND|SOLAR|PV|HYDRO|HYDEL|RES)(?:$|[\s\W])"
SECOND_ENDING = r"\s+(?:POWER\s+PLANT|POWER\s+STATION|THERMAL|TPS|CCPP|CCGT|HPS|GT|DG|BLOCK\s*[A-Z0-9]*)\s*$"

SPACE = r"(?U)\s+"


def fix_mojibake(c: Column) -> Column:
    """UTF-8 text once read as Latin-1, read aright; any other text unchanged."""
    again = F.encode(c, "ISO-8859-1").cast("string")
    narrow = c.rlike(r"^[\x{00}-\x{FF}]*$")
    return F.when(narrow & F.is_valid_utf8(F.when(narrow, again)), F.when(narrow, again)).otherwise(c)


@F.pandas_udf(T.StringType())
def _without_marks(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)))


def fold_diacritics(c: Column) -> Column:
    """Repaired text in compatibility form without combining marks. Letters without a decomposition stay."""
    return _without_marks(fix_mojibake(c))


def per_distinct(df: DataFrame, column: str, outputs: dict[str, Column]) -> DataFrame:
    """Adds ``outputs`` (expressions of ``column``), each computed once per distinct value."""
    values = df.select(column).distinct().where(F.col(column).isNotNull())
    return df.join(values.select(column, *[c.alias(n) for n, c in outputs.items()]), column, "left")


def suffix_pattern(suffixes: list[str]) -> str:
    """One pattern that cuts what repeated cutting of the longest suffix and trimming would cut."""
    ordered = sorted(suffixes, key=len, reverse=True)
    return r"(?U)(?:\s*(?:" + "|".join(re.escape(s).replace("\\ ", " ") for s in ordered) + r"))+\s*$"


def strip_suffixes(c: Column, suffixes: list[str]) -> Column:
    return F.regexp_replace(F.regexp_replace(c, suffix_pattern(suffixes), ""), r"(?U)\s+$", "")


def trim_space(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def base_name(c: Column) -> Column:
    """Raw text without feed endings (case counts)."""
    return trim_space(strip_suffixes(c, FEED_SUFFIXES))


def _scrub(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"[^A-Z0-9\s]", " "), r"\s+", " "))


def comparison_key(folded: Column) -> Column:
    """Key of a folded name: upper case, no bracketed parts, feed then catalogue endings cut once each, plain words."""
    up = trim_space(F.regexp_replace(trim_space(F.upper(folded)), r"\([^)]*\)", ""))
    cut = strip_suffixes(strip_suffixes(up, FEED_SUFFIXES), [s.upper() for s in CATALOGUE_SUFFIXES])
    return _scrub(cut)


def second_key(folded: Column) -> Column:
    """Key of a folded name in the second catalogue: brackets stay, one ending more is cut; null gives ''."""
    cut = strip_suffixes(F.upper(F.coalesce(folded, F.lit(""))), FEED_SUFFIXES)
    return _scrub(F.regexp_replace(cut, SECOND_ENDING, ""))


def validates(plant_folded: Column, matched_folded: Column, min_word_len: int = 4) -> Column:
    """Whether a word of the plant's base name that means something stands in the matched name as a whole word.

    Both sides are folded; the plant side is a base name. Hyphens and
    underscores count as spaces on both sides. Without such a word
    the whole phrase must stand there; an empty phrase never does.
    """
    phrase = F.trim(F.regexp_replace(F.regexp_replace(F.lower(plant_folded), "[-_]", " "), SPACE, " "))
    text = F.regexp_replace(F.lower(matched_folded), "[-_]", " ")
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])
    words = F.filter(F.split(phrase, " "), lambda w: (F.length(w) >= min_word_len) & ~F.array_contains(stop, w))
    stands = lambda w: F.regexp_like(text, F.concat(F.lit(r"(?<![\p{L}\p{N}_])\Q"), w, F.lit(r"\E(?![\p{L}\p{N}_])")))
    return F.coalesce(
        F.when(F.size(words) > 0, F.exists(words, stands)).when(phrase != "", stands(phrase)).otherwise(F.lit(False)),
        F.lit(False),
    )


def spaced_lower(c: Column) -> Column:
    """Key that ignores case and spacing; null gives the text 'nan'."""
    return F.lower(trim_space(F.regexp_replace(F.coalesce(c, F.lit("nan")), SPACE, " ")))


def likely_not_coal(c: Column) -> Column:
    return F.coalesce(c.rlike(NON_COAL), F.lit(False))


def clean_match(c: Column) -> Column:
    """struct(source, name) of a returned match: a leading catalogue label becomes the source, a trailing score goes."""
    t = trim_space(c)
    source = F.nullif(F.regexp_extract(t, "^(GEM|GPPD): ", 1), F.lit(""))
    name = trim_space(F.regexp_replace(F.regexp_replace(t, "^(?:GEM|GPPD): ", ""), r"\s*\(score: \d+(?:\.\d+)?\)\s*$", ""))
    return F.struct(source.alias("source"), name.alias("name"))


def confidence_key(c: Column) -> Column:
    return F.lower(trim_space(c))


def without_label(c: Column) -> Column:
    """Text after the first ': ', lower case."""
    return F.lower(F.trim(F.regexp_replace(c, r"^(?s).*?: ", "")))


def split_pair(c: Column) -> Column:
    """struct(plant_code, generator_id) of 'a|b'; both null unless there are exactly two parts."""
    parts = F.split(c, r"\|")
    two = F.size(parts) == 2
    return F.struct(F.when(two, F.trim(F.get(parts, F.lit(0)))).alias("plant_code"), F.when(two, F.trim(F.get(parts, F.lit(1)))).alias("generator_id"))


def labelled_id(c: Column, label: str = "EIA") -> Column:
    """First id after 'LABEL:' in a list of ids."""
    return F.nullif(F.trim(F.regexp_extract(c, rf"{label}:\s*([^,]+)", 1)), F.lit(""))


def composite_id(a: Column, b: Column) -> Column:
    given = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    return F.when(given(a) & given(b), F.concat_ws("|", a, b))


def candidate_line(label: Column, name: Column, score: Column) -> Column:
    """One line of a candidate list; the score is rounded half to even."""
    return F.concat(F.lit("  "), label, F.lit(": "), name, F.lit(" (score: "), F.bround(score, 0).cast("int").cast("string"), F.lit(")"))


def column_key(name: str) -> str:
    """Header text that ignores case and spaces."""
    return name.lower().replace(" ", "").strip()
