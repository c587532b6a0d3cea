"""Plant names brought down to what they name: used by entity matching and survivorship."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlace.llm.confusables import adopt, canonical, lookalikes

# Words for the kind of plant or site, in the languages of the feeds. Fixed values.
TYPE_WORDS = frozenset(
    """power station plant generating energy center centre park farm solar wind hydro hydroelectric nuclear thermal
    pp ps tps stps tpp ccpp ccgt ocgt gt hps hep hepp npp res pv hatsudensho karyoku
    elektrownia ec elektrocieplownia kraftwerk kw hkw ct cte central usina ute uhe pch cgh eol ufv termoelectrica
    elektrarna termocentrala kraftverk tets tec ahs elektra aps ass cpp stpp santrali site main coastal industrial gem gppd""".split()
)
SITE_SUFFIX = re.compile(r"\s+[–—-]\s+(?:energy park|main site|coastal site|industrial park)\s*$", re.I)
FUEL_WORDS = {
    "solar": "solar", "ufv": "solar", "pv": "solar", "wind": "wind", "eol": "wind", "hydro": "hydro", "hydroelectric": "hydro", "uhe": "hydro",
    "pch": "hydro", "cgh": "hydro", "hps": "hydro", "hep": "hydro", "hepp": "hydro", "nuclear": "nuclear", "npp": "nuclear",
}
_LONG_TYPES = sorted(w for w in TYPE_WORDS if len(w) >= 4)
_MIXED_TYPES = frozenset("".join(sorted(w)) for w in TYPE_WORDS if len(w) >= 3)
QUALIFIERS = ("north", "south", "east", "west", "nord", "upper", "lower", "city", "road", "extension", "velho", "nuevo", "alto", "zdroj", "iii")

CYRILLIC = dict(zip("абвгдезийклмнопрстуфхцьэ", "a b v g d e z i y k l m n o p r s t u f h ts y e".split())) | {
    "ж": "zh", "ч": "ch", "ш": "sh", "щ": "sht", "ъ": "a", "ю": "yu", "я": "ya", "ё": "e", "ы": "y",
}
GREEK = dict(zip("αβγδεζηικλμνξοπρστυφωςχψθ", "a b g d e z i i k l m n x o p r s t u f o s h ps th".split()))
# Kana syllables by row and vowel (Kunrei). Rows of fewer vowels are spelt out below.
_ROWS = {"": "アイウエオ", "k": "カキクケコ", "g": "ガギグゲゴ", "s": "サシスセソ", "z": "ザジズゼゾ", "t": "タチツテト", "d": "ダヂヅデド", "n": "ナニヌネノ", "h": "ハヒフヘホ", "b": "バビブベボ", "p": "パピプペポ", "m": "マミムメモ", "r": "ラリルレロ"}
KANA = {kana: row + vowel for row, kanas in _ROWS.items() for kana, vowel in zip(kanas, "aiueo")} | {"ヤ": "ya", "ユ": "yu", "ヨ": "yo", "ワ": "wa", "ヲ": "o", "ン": "n", "ー": "", "ッ": ""}
_LETTERS = {"ł": "l", "ø": "o", "ß": "ss", "đ": "d", "ı": "i", "æ": "ae", "œ": "oe", "þ": "th", "ð": "d"}
_TRANSLATE = str.maketrans(CYRILLIC | GREEK | KANA | _LETTERS)


def fold(text: str) -> str:
    """Lower-case Latin letters without marks, whatever the script."""
    if text.isascii():
        return text.lower()
    s = re.sub("火力発電所|水力発電所|原子力発電所|発電所", " tps ", text)
    s = unicodedata.normalize("NFC", s).lower().translate(_TRANSLATE)
    s = "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))
    return s.translate(_TRANSLATE)


def one_edit(a: str, b: str) -> bool:
    """Equal, or apart by one letter added, dropped, changed or swapped with its neighbour."""
    if a == b:
        return True
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    if len(a) < len(b):
        return a[i:] == b[i + 1 :]
    return a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])


def alike(a: str, b: str) -> bool:
    """Two edits apart at most; a lost sign stands for up to three letters."""
    if "?" in a or "?" in b:
        if "?" in b:
            a, b = b, a
        return re.fullmatch(".{1,3}".join(map(re.escape, re.split(r"\?+", a))), b) is not None
    if abs(len(a) - len(b)) > 2:
        return False
    row = list(range(len(b) + 1))
    before: list[int] = []
    for i, x in enumerate(a, 1):
        last, row, older = row, [i], before
        before = last
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, older[j - 2] + 1)
            row.append(d)
    return row[-1] <= 2


@lru_cache(1 << 16)
def is_type(word: str) -> bool:
    return word in TYPE_WORDS or "".join(sorted(word)) in _MIXED_TYPES or (len(word) >= 4 and word not in QUALIFIERS and any(abs(len(t) - len(word)) <= 1 and t[0] == word[0] and one_edit(word, t) for t in _LONG_TYPES))


_LABEL = re.compile(r"^\s*(?:GEM|GPPD)\s*:\s*", re.I)
_BRACKETS = re.compile(r"\([^)]*\)?")
_DASH = re.compile("\\s[–—-]\\s")
_INITIALS = re.compile(r"(?<![a-z])(?:[a-z]\.){2,}")
_PIECE = re.compile(r"[^\W_]+|\?+")
_BLOCK = re.compile(r"b\d\d?")


def parse(name: str | None) -> tuple[str | None, str | None, str | None]:
    """(base, qualifiers, fuel): the place's own word, what tells it from its namesakes, and a fuel the kind of plant implies."""
    if not name:
        return None, None, None
    s = canonical(name)
    if "\ufffd" in s:
        s = re.sub("\ufffd+", "?", s)
    if ":" in s:
        s = _LABEL.sub("", s)
    if "(" in s:
        s = _BRACKETS.sub(" ", s)
    s = fold(SITE_SUFFIX.sub("", s) if _DASH.search(s) else s)
    if "." in s:
        s = _INITIALS.sub(lambda m: m.group().replace(".", "") + " ", s)
    words = _PIECE.findall(s)
    glued: list[str] = []
    for w in words:  # a lost sign is part of its word
        if glued and (w[0] == "?" or glued[-1][-1] == "?"):
            glued[-1] += w
        else:
            glued.append(w)
    fuel = next((FUEL_WORDS[w] for w in glued if w in FUEL_WORDS), None)
    kept = [w for w in glued if not is_type(w) and not _BLOCK.fullmatch(w)]
    if not kept:
        return None, None, fuel
    return kept[0], " ".join(map(qualifier, kept[1:])), fuel


@lru_cache(1 << 16)
def qualifier(word: str) -> str:
    """A word that tells namesakes apart, without a slip of the pen."""
    if word in ("ext", "extn"):
        return "extension"
    if len(word) < 4 or word in QUALIFIERS:
        return word
    return next((q for q in QUALIFIERS if len(q) >= 4 and one_edit(word, q)), word)


def sound(base: str) -> str:
    """Letters that another script writes alike."""
    return base.replace("v", "b")


_PARSED = T.StructType([T.StructField(c, T.StringType()) for c in ("base", "quals", "name_fuel", "sound")])


def parse_names(name: str) -> Column:
    table = dict(lookalikes())

    @F.pandas_udf(_PARSED)
    def parsed(names: pd.Series) -> pd.DataFrame:
        adopt(table)
        rows = [parse(n) for n in names]
        return pd.DataFrame([(*p, sound(p[0]) if p[0] else None) for p in rows], columns=["base", "quals", "name_fuel", "sound"], dtype=object)

    return parsed(name)


def stands_in(name: str, hint: str) -> bool:
    """Whether ``hint`` has the letters that are left of the name's longest damaged word, in their order."""
    damaged = [w for w in name.split() if re.search(r"[^A-Za-z0-9_.-]", w)]
    if not damaged:
        return False
    left = [x.lower() for x in re.split(r"[^A-Za-z]+", max(damaged, key=len))]
    if sum(map(len, left)) < 3:
        return False
    return re.search(r"\b" + ".{0,4}".join(left) + r"\w{0,2}\b", fold(hint)) is not None


@F.pandas_udf(T.StringType())
def stand_in(names: pd.Series, hints: pd.Series) -> pd.Series:
    """The hint where it may stand in for the damaged name, else the name."""
    return pd.Series([h if n and h and stands_in(n, h) else n for n, h in zip(names, hints)], dtype=object)


_ROMAN = {"i": 1, "ii": 2, "iii": 3, "iv": 4, "v": 5, "vi": 6, "vii": 7, "viii": 8, "ix": 9, "x": 10, "xi": 11, "xii": 12}


def unit_key(label: str | None) -> str | None:
    """A unit's label in one form: kind and number or letter; null for no label."""
    if not label:
        return None
    s = fold(canonical(label)).strip()
    s = re.sub(r"gas turbine", "gt", re.sub(r"steam turbine", "st", s))
    m = re.search(r"(?:^|[^a-z])(gt|st|cc|u|unit|block|blk|bl|phase|no|nr|#)?[\s.#:-]*(?:(\d+)([a-z]?)|([a-z]{1,4}))\s*$", s)
    if not m:
        return None if not re.search(r"[a-z0-9]", s) else s
    kind = m.group(1) if m.group(1) in ("gt", "st", "cc") else "u"
    if m.group(2):
        return f"{kind}{int(m.group(2))}{m.group(3)}"
    word = m.group(4)
    return f"{kind}{_ROMAN.get(word, word)}"


def unit_keys(label: str) -> Column:
    table = dict(lookalikes())

    @F.pandas_udf(T.StringType())
    def keys(labels: pd.Series) -> pd.Series:
        adopt(table)
        return labels.map(unit_key)

    return keys(label)


@F.pandas_udf(T.ArrayType(T.StringType()))
def deletions(words: pd.Series) -> pd.Series:
    """The word and all words that are one letter shorter; a lost sign counts as dropped."""
    return words.map(lambda w: sorted({w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}))


@F.pandas_udf(T.BooleanType())
def within_one_edit(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([one_edit(x, y) for x, y in zip(a, b)], dtype=bool)


@F.pandas_udf(T.BooleanType())
def look_alike(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([alike(x, y) for x, y in zip(a, b)], dtype=bool)
