"""Visually identical text with different characters (problem 3).

Method. Confusables skeleton: decompose the text, replace every character by
its prototype from a look-alike table, decompose again; originals with equal
skeletons form a group. The table is Unicode's own list of confusables, read
from the ICU library that Spark brings along, and by rule compatibility forms,
format signs, space signs and hyphens; a few letter pairs that the list lacks
are named here.

A group's sound forms are its members with look-alikes written in the script
of their word, which the table's classes of equal prototype tell; the most
frequent one is the group's one form. A name is a case if its group has it
not among its sound forms. Letters and digits that look alike within ASCII
(``l I 1``) fall into one group and are no cases.

Cases: null names give no row; a name of nothing but invisible signs has the
form ``''``; repeated rows each give their own row; ties between forms go to
the alphabetically first. Letter case and doubled plain spaces stay.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import zipfile
from functools import lru_cache
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters that look like a Latin letter. Fixed values.
CYRILLIC = dict(zip("АВЕЅІЈКМНОРСТУХҮԌԚԜаеіјорсухѕһԁԛԝүӏ", "ABESIJKMHOPCTYXYGQWaeijopcyxshdqwyl"))
GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹϳανικορτυϲ", "ABEZHIKMNOPTYXCjavikoptuc"))
# those that make a word of nothing but look-alikes in a Latin name suspect
TO_LATIN = CYRILLIC | {k: v for k, v in GREEK.items() if k not in "ατ"} | {"ɑ": "a", "ɡ": "g", "ı": "ı"}
HYPHENS = "‐‑⁃−﹣－"
INVISIBLE = "͏ᅟᅠ᠎ㅤﾠ⠀"
# Scripts that are written together in one word.
TOGETHER = {"CJK", "KATAKANA", "HIRAGANA", "KATAKANA-HIRAGANA", "HANGUL", "BOPOMOFO"}
# Main blocks of scripts; other letters of theirs are not what a word is rewritten in.
MAIN = {"LATIN": (0x41, 0x24F), "CYRILLIC": (0x400, 0x45F), "GREEK": (0x386, 0x3CE)}


def icu_confusables(data: bytes) -> dict[str, str]:
    """ICU's table of confusables: after a header, sorted keys (code point and length of the prototype), places, and the prototypes' text."""
    data = data[struct.unpack(">H", data[:2])[0] :]
    keys_at, n_keys, places_at, n_places, text_at, n_text = struct.unpack(">6i", data[12:36])
    keys = struct.unpack(f">{n_keys}I", data[keys_at : keys_at + 4 * n_keys])
    places = struct.unpack(f">{n_places}H", data[places_at : places_at + 2 * n_places])
    text = data[text_at : text_at + 2 * n_text]
    out = {}
    for key, place in zip(keys, places):
        n = (key >> 24) + 1
        raw = struct.pack(">H", place) if n == 1 else text[2 * place : 2 * (place + n)]
        out[chr(key & 0xFFFFFF)] = raw.decode("utf-16-be")
    return out


_table: dict[str, str] = {}


def lookalikes() -> dict[str, str]:
    """Character -> prototype. Where Spark comes without ICU, only the letters named here.

    The library lies where the driver runs; column functions carry the table
    (some 6,400 entries, as many as Unicode has) to the tasks: see :func:`adopt`.
    """
    if not _table:
        import pyspark

        named, table = CYRILLIC | GREEK, {}
        for jar in sorted(Path(pyspark.__file__).parent.glob("jars/icu4j-*.jar")):
            with zipfile.ZipFile(jar) as z:
                table = icu_confusables(z.read("com/ibm/icu/impl/data/icudata/confusables.cfu"))
        _table.update(table | {c: table.get(x, x) for c, x in named.items()})
    return _table


def adopt(table: dict[str, str]) -> None:
    """Takes a table over in a task, before anything there needs one."""
    if not _table:
        _table.update(table)


_BREAK = re.compile(r"([\s\-_/().,;:&+‐‑–—]+)")


@lru_cache(1 << 16)
def prototype(c: str) -> str:
    """What a sign looks like, as plain signs; itself if it stands for nothing else."""
    if c.isascii():
        return " " if c in "\t\n\r\x0b\x0c" else c
    kind = unicodedata.category(c)
    if kind == "Cf" or c in INVISIBLE or "︀" <= c <= "️":
        return ""
    if kind in ("Zs", "Zl", "Zp"):
        return " "
    if c in HYPHENS:
        return "-"
    if c in "–—―…":
        return c
    if unicodedata.decomposition(c).startswith("<"):
        return "".join(prototype(x) for x in unicodedata.normalize("NFKC", c)) if unicodedata.normalize("NFKC", c) != c else c
    return c


@lru_cache(1 << 16)
def script_of(c: str) -> str:
    """Script of a letter, by the first word of its name."""
    return unicodedata.name(c, "other").split(" ", 1)[0]


def _base(c: str) -> tuple[str, str]:
    """Letter and its marks."""
    d = unicodedata.normalize("NFD", c)
    return d[0], d[1:]


@lru_cache(1)
def _classes() -> dict[tuple[str, str, bool], str]:
    """(prototype, script, capital) -> the letter of that script, in its main block, that looks so; listed pairs go first."""
    out: dict[tuple[str, str, bool], str] = {}
    table = lookalikes()
    plain = [chr(o) for o in range(0x41, 0x7B) if chr(o).isalpha()]
    for c in [*plain, *CYRILLIC, *GREEK, *sorted(table), *sorted({p for p in table.values() if len(p) == 1})]:
        s = script_of(c)
        lo, hi = MAIN.get(s, (0, 0x110000))
        if c.isalpha() and lo <= ord(c) <= hi and s not in TOGETHER:
            out.setdefault((table.get(c, c), s, c.isupper()), c)
    return out


@lru_cache(1 << 16)
def in_script(c: str, script: str) -> str | None:
    """The letter of another script that looks like ``c``; None if there is none."""
    if script_of(c) == script:
        return c
    base, marks = _base(c)
    twin = _classes().get((lookalikes().get(base, base), script, base.isupper()))
    if twin is None and script == "LATIN":
        twin = (CYRILLIC | GREEK).get(base)
    return unicodedata.normalize("NFC", twin + marks) if twin else None


def one_script(word: str, latin_name: bool) -> str:
    """The word in the script of the letters that look like no other's."""
    letters = [c for c in word if c.isalpha() and script_of(c) not in TOGETHER]
    scripts = {script_of(c) for c in letters}
    if len(scripts) < 2 and not (latin_name and scripts - {"LATIN"}):
        return word
    own = {s: sum(script_of(c) == s for c in letters) for s in scripts}
    fits = [s for s in scripts if all(in_script(c, s) for c in letters)]
    if latin_name or (not fits and "LATIN" in scripts):
        target = "LATIN"
    elif fits:
        # letters that look like no other script's decide, then Latin, then their number
        alone = {s: sum(script_of(c) == s and not any(in_script(c, t) for t in scripts - {s}) for c in letters) for s in fits}
        target = max(sorted(fits), key=lambda s: (alone[s], s == "LATIN", own[s]))
    else:
        return word
    return "".join((in_script(c, target) or c) if c.isalpha() and script_of(c) not in TOGETHER else c for c in word)


def canonical(name: str) -> str:
    """The name in plain signs, composed, each word in one script."""
    if name.isascii() and name.isprintable():
        return name
    s = "".join(prototype(c) for c in unicodedata.normalize("NFC", name))
    s = unicodedata.normalize("NFC", s)
    parts = _BREAK.split(s)
    words = parts[::2]
    # a word of look-alikes only, in a name that is otherwise Latin, is meant in Latin
    foreign = [c for w in words for c in w if c.isalpha() and script_of(c) not in TOGETHER and script_of(c) != "LATIN"]
    latin = any(script_of(c) == "LATIN" for w in words for c in w if c.isalpha())
    latin_name = latin and bool(foreign) and all(c in TO_LATIN for c in foreign)
    if foreign and (latin or len({script_of(c) for c in foreign}) > 1):
        parts[::2] = [one_script(w, latin_name) for w in words]
    return unicodedata.normalize("NFC", "".join(parts))


def skeleton(name: str) -> str:
    """Decompose, replace by prototypes, decompose again."""
    table = lookalikes()
    if name.isascii() and name.isprintable():
        return "".join(table.get(c, c) for c in name)
    s = "".join(prototype(c) for c in unicodedata.normalize("NFD", name))
    s = "".join(table.get(c, c) for c in unicodedata.normalize("NFD", s))
    return unicodedata.normalize("NFD", s)


_FORMS = T.StructType([T.StructField("form", T.StringType()), T.StructField("skeleton", T.StringType())])


def _forms(name: str) -> Column:
    table = dict(lookalikes())

    @F.pandas_udf(_FORMS)
    def forms(names: pd.Series) -> pd.DataFrame:
        adopt(table)
        return pd.DataFrame({"form": [canonical(x) for x in names], "skeleton": [skeleton(x) for x in names]}, dtype=object)

    return forms(name)


def grouped(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Names and groups of ``rows(name)``: (name, n, skeleton, form) per distinct name, and (skeleton, form, n) per sound form of a group."""
    names = rows.where("name is not null").groupBy("name").agg(F.count("*").alias("n")).withColumn("f", _forms("name")).select("name", "n", "f.skeleton", "f.form")
    return names, names.groupBy("skeleton", "form").agg(F.sum("n").alias("n"))


def variants(names: DataFrame, groups: DataFrame) -> DataFrame:
    """Names that their group does not have among its sound forms."""
    return names.join(groups.select("skeleton", F.col("form").alias("name")), ["skeleton", "name"], "left_anti")


def unify(rows: DataFrame, cut=lambda df: df) -> DataFrame:
    """Adds ``form`` (one per group of equal skeletons) and ``variant`` to ``rows(table_name, row_id, name)``.

    Names are aggregated before the Python step and groups by partial sums.
    Only the last join sees rows, by name: distinct names on its other side,
    so a name of many rows can be split there.
    """
    names, groups = grouped(rows)
    names = cut(names)
    groups = names.groupBy("skeleton", "form").agg(F.sum("n").alias("n"))
    # most rows first, then the alphabetically first form
    chosen = groups.groupBy("skeleton").agg(F.min_by("form", F.struct(-F.col("n"), F.col("form"))).alias("chosen"))
    odd = variants(names, groups).select("name", F.lit(True).alias("variant"))
    per_name = names.select("name", "skeleton").join(chosen, "skeleton").join(odd, "name", "left")
    return rows.join(per_name, "name").select("table_name", "row_id", "name", F.col("chosen").alias("form"), "skeleton", F.coalesce("variant", F.lit(False)).alias("variant"))
