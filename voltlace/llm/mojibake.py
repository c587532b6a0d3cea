"""Garbled text from a wrong character encoding (problem 1).

Method. Every distinct clean word of the corpus is garbled under all encoding
chains (and the case changes that may come before or after); the garbled forms
are a table ``(key, original)``. The words of the records are hash-joined with
it and replaced by verified originals. A form is only made if it consists of
signs that suspicious words hold, since no other can be joined.

Words whose original occurs nowhere clean in the corpus cannot be in that
table. Those that show damage by their own signs are undone sign by sign, by
the garbled forms of the corpus' letters; what is left are words whose signs
are lost. ``evidence`` tells the three apart: ``word``, ``signs``, ``marks``.

Cases: null or blank names give no row; repeated rows each give their own
row; a name of any length is handled whole; ``(?)`` is the compiler's remark
and no damage; brackets, quotes and commas around a word do not hide it. Ties
between originals go to the better supported, then the alphabetically first.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlace.llm.confusables import CYRILLIC, GREEK

# (true encoding, encoding it was read in). Fixed values.
SINGLE_BYTE = (
    "cp1250", "cp1251", "cp1252", "cp1253", "cp1254", "cp1257", "cp1258", "iso8859-2", "iso8859-5",
    "iso8859-7", "iso8859-9", "iso8859-16", "cp437", "cp850", "cp852", "cp866", "koi8-r", "mac-roman",
)
MULTI_BYTE = ("shift_jis", "euc_jp", "gb18030")
READ_AS = ("latin-1", "cp1252", "cp1250", "cp1251", "cp1254", "iso8859-2", "cp437", "cp850", "cp852", "cp866", "mac-roman", "mac-cyrillic", "mac-greek")
TWICE = ("latin-1", "cp1252", "cp1250", "cp437", "cp850", "mac-roman")

_GONE = re.compile("[\x00-\x1f\x7f-\xa0\xad]")
_WORD = re.compile(r"[^\W\d_]{2,}|[–—]")
_EDGE = "()[]\"',;:"
_SPLIT = re.compile("([ \t\r\n\u3000\u2003\u2007\u2009\u202f-]+)")
_CASE_ODD = re.compile("[a-zß-öø-ÿ][À-ÖØ-ÞŒŠŽŸĂĄĆČĎĐĘĚĞĹĽŁŃŇŐŘŚŞŤŮŰŹŻȘȚ]|^[A-Z][À-ÖØ-ÞŒŸ][a-z]")
_LEADS = re.compile("[ÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑ][\x80-\x9f\xa1-\xac\xae-\xbf]|Ã[\xa0\xad]|[ÃÅÄ][ŒœŸŽžŠš]|[ĂĹ][ŠŚŤŽŹšśťžźŁĄŞŻłąşĽľż]|ĆŻ")
# letters in places where no language of theirs has them: sharp s after a consonant, the oe ligature beside other
# vowels, u with grave inside a word that is not Vietnamese, grave vowels beside Nordic o or carons
_PLACES = re.compile(r"(?i:(?<![aeiouyäöüáéíóú])ß|[aeiouy]œ|œ[aeoyónwz])|ù[a-zß-ÿ]|[øØ].*[èùì]|[èùì].*[øØ]|[èùì].*[šžřčěůďťň]|[ŠŽŘČšžřčěůďťň].*[èùì]")
_VIETNAMESE = re.compile("[ơưạảấ-ỹƠƯ]")
_FRENCH = frozenset("éèêëàâîïôûùüÿçœæ")
_ASCII_ODD = re.compile(r"[\\{}|^~`]|[^\W\d_]\?|\?[^\W\d_]|\?\?")


class _Chain(dict):
    """Translation table of one chain: sign -> what it was read as. A sign the true encoding lacks is mapped to a mark."""

    def __init__(self, true: str, read: str):
        super().__init__()
        self.true, self.read = true, read

    def __missing__(self, o: int) -> str:
        try:
            data = chr(o).encode(self.true)
            self[o] = "".join(_byte(b, self.read) for b in data)
        except UnicodeEncodeError:
            self[o] = "\x00"
        return self[o]


def _byte(b: int, codec: str) -> str:
    try:
        return bytes([b]).decode(codec)
    except UnicodeDecodeError:  # undefined bytes pass as controls
        return chr(b)


# bytes are read one by one, so a chain acts sign by sign
_UTF8 = {r: _Chain("utf-8", r) for r in READ_AS}
_CHAINS = [*_UTF8.values(), *(_Chain(t, r) for t in (*MULTI_BYTE, *SINGLE_BYTE) for r in READ_AS if r != t)]
_TWO_STEPS = [(_UTF8[g], _UTF8[h]) for g in TWICE for h in TWICE]


def key_of(word: str) -> str:
    """Join key: lower case, without control signs, no-break spaces and soft hyphens, which tools drop."""
    return _GONE.sub("", word.lower().replace("µ", "μ").replace("ı", "i").replace("i̇", "i"))


def bare(word: str) -> str:
    """The word without brackets, quotes and commas around it."""
    return word.strip(_EDGE) or word


PAIR_BITS = 1 << 20


def pair_bit(pair: str) -> int:
    return crc32(pair.encode("utf-8", "surrogatepass")) & (PAIR_BITS - 1)


class Garbler:
    """Makes the garbled forms of clean words; with ``pairs``, only those that may be made of known pairs of neighbouring signs.

    ``pairs`` is a bitmap of fixed size, by the pairs' hash, of the words that
    the forms will be joined with; ``^`` and ``$`` stand for their ends. Which
    chains can have garbled a sign beside a given neighbour is worked out once
    per sign and neighbour, as a set of bits, one for each chain.
    """

    def __init__(self, pairs: bytes | None = None):
        self.pairs = pairs
        self.chains: list[Callable[[str], str]] = [lambda w, t=t: w.translate(t) for t in _CHAINS]
        self.chains += [lambda w, g=g, h=h: w.translate(g).translate(h) for g, h in _TWO_STEPS]
        self.all = (1 << len(self.chains)) - 1
        self.signs: dict[str, list[tuple[int, str]]] = {}
        self.bits: dict[str, int] = {}
        self.known: dict[str, bool] = {}

    def _pair(self, pair: str) -> bool:
        seen = self.known.get(pair)
        if seen is None:
            seen = self.known[pair] = bool(self.pairs[pair_bit(pair)])
        return seen

    def _fits(self, s: str) -> bool:
        if self.pairs is None:
            return True
        last, known = "^", self.known
        for c in s + "$":
            pair = last + c
            seen = known.get(pair)
            if not (self._pair(pair) if seen is None else seen):
                return False
            last = c
        return True

    def _sign(self, sign: str) -> list[tuple[int, str]]:
        """(bit, form) of the chains that can have garbled the sign, wherever it stands."""
        found = self.signs.get(sign)
        if found is None:
            found = self.signs[sign] = []
            for k, chain in enumerate(self.chains):
                raw = chain(sign)
                f = key_of(raw)
                if "\x00" not in raw and (self.pairs is None or all(self._pair(f[i : i + 2]) for i in range(len(f) - 1))):
                    found.append((1 << k, f))
        return found

    def _beside(self, left: str, sign: str, right: str) -> int:
        """Bits of the chains that can have garbled the sign between two neighbours; an empty one is not looked at."""
        found = self.bits.get(at := f"{left}\n{sign}\n{right}")
        if found is None:
            forms = self._sign(sign)
            if self.pairs is not None:  # of a form without signs nothing is known
                forms = [(b, f) for b, f in forms if not f or ((not left or self._pair(left + f[0])) and (not right or self._pair(f[-1] + right)))]
            found = self.bits[at] = sum(b for b, _ in forms)
        return found

    def forms(self, word: str) -> set[str]:
        """Keys of all garbled forms of a clean word, without its own key."""
        if word.isascii():
            return set()
        word = unicodedata.normalize("NFC", word)
        out: set[str] = set()
        # keys have no case: in lower case the word differs from itself only by signs beyond ASCII
        lower = () if all(c.isascii() or c.islower() == c.isalpha() for c in word) else (word.lower(),)
        for w in {word, word.upper(), *lower}:
            left = self.all
            x = f"^{w}$"
            for i in range(1, len(x) - 1):
                if not x[i].isascii():
                    before, after = (c.lower() if c.isascii() else "" for c in (x[i - 1], x[i + 1]))
                    left &= self._beside(before, x[i], "") & self._beside("", x[i], after)
            while left:
                k = left.bit_length() - 1
                left ^= 1 << k
                out.add(self.chains[k](w).lower())
            out |= _lossy(w)
        own = key_of(word)
        return {k for s in out if (k := key_of(s)) and k != own and self._fits(k)}


def _lossy(word: str) -> set[str]:
    """Forms in which signs were lost: other encodings read as UTF-8, and text written or read as ASCII, also after a wrong reading."""
    out = {word.encode().decode("ascii", "replace"), word.encode("ascii", "replace").decode(), "".join("??" if not c.isascii() else c for c in word)}
    out |= {word.translate(_UTF8[g]).encode("ascii", "replace").decode() for g in TWICE}
    for true in (*MULTI_BYTE, *SINGLE_BYTE):
        try:
            out.add(word.encode(true).decode("utf-8", "replace"))
        except UnicodeEncodeError:
            pass
    return out


def garbled_forms(word: str) -> set[str]:
    """Keys of all garbled forms of a clean word."""
    return Garbler().forms(word)


def _odd_sign(c: str) -> bool:
    """A sign that sound names do not hold inside words."""
    if c == "�" or "\x80" <= c <= "\x9f" or c in "ªºƒƑˆ˜ˇⁿ":
        return True
    if c.isascii() or "＀" <= c <= "￯" or c in "–—’‘´º":
        return c == "´"
    return unicodedata.category(c) in ("Sm", "Sc", "Sk", "So", "No", "Po", "Pi", "Pf", "Ps", "Pe", "Co", "Cn", "Cc")


def script(c: str) -> str:
    """Rough script of a letter."""
    o = ord(c)
    if o < 0x250 or 0x1E00 <= o < 0x1F00:
        return "latin"
    if 0x370 <= o < 0x400 or 0x1F00 <= o < 0x2000:
        return "greek"
    if 0x400 <= o < 0x530:
        return "cyrillic"
    return "kana" if 0x3040 <= o < 0xA000 else "other"


def _misplaced(w: str) -> bool:
    """Letters of the Latin script where they cannot stand, or of other scripts that look like no Latin one among Latin letters."""
    m = _PLACES.search(w)
    if m and not _VIETNAMESE.search(w):
        return True
    low = w.lower()
    if "œ" in low and any(not c.isascii() and c.isalpha() and c not in _FRENCH for c in low):
        return True
    for kind, like in (("cyrillic", CYRILLIC), ("greek", GREEK)):
        own = [c for c in w if script(c) == kind]
        if any(c not in like for c in own) and any(c.isalpha() and script(c) == "latin" and c not in _LIKE[kind] for c in w):
            return True
    return False


_LIKE = {"cyrillic": frozenset(CYRILLIC.values()), "greek": frozenset(GREEK.values())}


def loud(word: str) -> bool:
    """Damage that the word's own signs show."""
    if word in ("(?)", "?"):
        return False
    w = word[:-3] if word.endswith("(?)") else word
    if any(_odd_sign(c) for c in w) or _CASE_ODD.search(w) or _LEADS.search(w) or _ASCII_ODD.search(w):
        return True
    if not w.isascii() and _misplaced(w):
        return True
    kinds = {script(c) for c in w if c.isalpha() and not c.isascii()}
    if {"latin", "kana"} <= kinds:
        return True
    letters = [c for c in w if c.isalpha()]
    foreign = sum("À" <= c <= "ÿ" for c in letters)
    return len(letters) >= 4 and foreign > 0.7 * len(letters)


def is_clean(word: str) -> bool:
    """Words that may be originals: two letters or more of one script, or a long dash, without a sign of damage."""
    if not _WORD.fullmatch(word) or loud(word) or unicodedata.normalize("NFKC", word) != word:
        return False
    return len({script(c) for c in word}) == 1


def split_name(name: str) -> list[str]:
    """Words and what stands between them, alternately; both together give the name again."""
    return _SPLIT.split(name)


def word_table(names: DataFrame) -> DataFrame:
    """Distinct words of ``names(name, n, asked)``, with the rows that hold them, their key, and whether they are asked about, clean or loud."""

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows: dict[str, tuple[int, bool]] = {}
            for name, n, asked in zip(pdf["name"], pdf["n"], pdf["asked"]):
                for w in {w for w in split_name(name)[::2] if w}:
                    m, a = rows.get(w, (0, False))
                    rows[w] = (m + int(n), a or asked)
            yield pd.DataFrame([(w, n, a) for w, (n, a) in rows.items()], columns=["word", "n", "asked"]).astype({"word": object, "n": "int64", "asked": bool})

    found = names.mapInPandas(words, "word string, n long, asked boolean").groupBy("word").agg(F.sum("n").alias("n"), F.max("asked").alias("asked"))

    def traits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["bare"] = [bare(w) for w in pdf["word"]]
            pdf["key"] = [key_of(w) for w in pdf["bare"]]
            pdf["loud"] = [loud(w) for w in pdf["word"]]
            pdf["clean"] = [is_clean(w) for w in pdf["bare"]]
            pdf["plain"] = [w.isascii() for w in pdf["word"]]
            yield pdf

    return found.mapInPandas(traits, "word string, n long, asked boolean, bare string, key string, loud boolean, clean boolean, plain boolean")


def garble_table(clean: DataFrame, df: dict[str, int], pairs: bytes | None = None) -> DataFrame:
    """(key, original, support, rarest): the garbled forms of every distinct clean word.

    ``df`` tells in how many clean words a sign occurs; ``rarest`` is that of
    the original's rarest sign. ``pairs``: see :class:`Garbler`.
    """

    def forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["key", "original", "support", "rarest"]
        garbler = Garbler(pairs)
        for pdf in batches:
            for lo in range(0, len(pdf), 500):
                rows = [(k, w, n, rarest(w, df)) for w, n in zip(pdf["original"][lo : lo + 500], pdf["support"][lo : lo + 500]) for k in garbler.forms(w)]
                yield pd.DataFrame(rows, columns=columns).astype({"key": object, "original": object, "support": "int64", "rarest": "int64"})

    return clean.mapInPandas(forms, "key string, original string, support long, rarest long")


def rarest(word: str, df: dict[str, int]) -> int:
    """In how many clean words the word's rarest sign beyond ASCII occurs; many for a word without one."""
    return min((df.get(c, 1) for c in word.lower() if not c.isascii()), default=1 << 40)


def signs_of(words: DataFrame, column: str) -> dict[str, int]:
    """In how many of the words each sign beyond ASCII occurs: at most one row per sign of Unicode."""
    signs = words.select(F.explode(F.array_distinct(F.split(F.lower(column), ""))).alias("c")).where("c > '\u007f'")
    return {r[0]: r[1] for r in signs.groupBy("c").count().collect()}


def pairs_of(words: DataFrame) -> bytes:
    """Bitmap of the pairs of neighbouring signs in the words' keys: at most ``PAIR_BITS`` numbers come to the driver, however many words there are."""
    framed = F.concat(F.lit("^"), "key", F.lit("$"))
    pairs = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("key") + 1), lambda i: F.substring(framed, i, F.lit(2)))).alias("pair"))
    bits = pairs.select(F.pmod(F.crc32(F.encode("pair", "UTF-8")), F.lit(PAIR_BITS)).cast("int").alias("bit")).distinct().toPandas()["bit"].to_numpy()
    out = np.zeros(PAIR_BITS, np.uint8)
    out[bits] = 1
    return out.tobytes()


def find_garbled_words(words: DataFrame, clean: DataFrame, df: dict[str, int]) -> DataFrame:
    """(word, bare, original): damaged words; original is null where no clean word of the corpus is it.

    ``words`` is a :func:`word_table`, ``clean`` its clean words by key. Words
    that show damage take the best supported original; quiet ones (all letters
    sound) only one that has more support and no rarer signs, or signs far
    more common.
    """

    @F.pandas_udf("long")
    def own_rarest(w: pd.Series) -> pd.Series:
        return w.map(lambda x: rarest(x, df) if x is not None else 1 << 40).astype("int64")

    # garbling is heavy for its few rows: spread it over all cores, also where the table is one small file
    cores = words.sparkSession.sparkContext.defaultParallelism
    suspects = words.where("asked and (loud or not plain and word not in ('–', '—'))").select("word", "bare", "key", "loud")
    forms = garble_table(clean.where(F.col("original").rlike("[^\\x00-\\x7F]")).repartition(4 * cores), df, pairs_of(suspects))
    own = clean.select("key", F.col("support").alias("own_support"), own_rarest("original").alias("own_rarest"))
    # words of which some signs only were garbled: what undoing them gives is looked up among the clean words
    partly = partly_undone(signs_with_capitals(df))
    undone = suspects.select(F.col("key").alias("form"), F.explode(partly("bare")).alias("key")).join(clean, "key").select(F.col("form").alias("key"), "original", "support", own_rarest("original").alias("rarest"))
    forms = forms.unionByName(undone)
    hits = suspects.join(forms, "key", "left").groupBy("word", "bare", "key", "loud").agg(F.max(F.struct("support", "rarest", "original")).alias("best"))
    judged = hits.join(own, "key", "left")
    quiet = (
        F.col("own_support").isNull()
        | (F.col("own_rarest") * 4 < F.col("best.rarest"))
        | ((F.col("best.support") >= 2 * F.col("own_support")) & (F.col("own_rarest") <= F.col("best.rarest")))
    )
    return judged.where(F.col("loud") | (F.col("best.original").isNotNull() & quiet)).select("word", "bare", F.col("best.original").alias("original"))


def undone(word: str, table: dict[str, str], longest: int) -> str:
    """The word with each sign that the table knows as garbled put back, the longest first."""
    out, i = [], 0
    while i < len(word):
        for n in range(min(longest, len(word) - i), 0, -1):
            if word[i : i + n] in table:
                out.append(table[word[i : i + n]])
                i += n
                break
        else:
            out.append(word[i])
            i += 1
    return "".join(out)


def undo_signs(word: str, inverse: list[dict[str, str]]) -> str | None:
    """The word with its garbled signs put back by one chain, if that leaves a word without a sign of damage."""
    for table in inverse:
        if (s := undone(word, table, max(map(len, table), default=0))) != word and not loud(s):
            return undo_signs(s, inverse) or s
    return None


def inverse_tables(signs: list[str]) -> list[dict[str, str]]:
    """For each chain from UTF-8: garbled form of a sign -> the sign. ``signs`` are letters of Unicode, so this is bounded."""
    once = [{c.translate(chain): c for c in signs} for chain in _UTF8.values()]
    return once + [{c.translate(g).translate(h): c for c in signs} for g, h in _TWO_STEPS]


def signs_with_capitals(df: dict[str, int]) -> list[str]:
    return sorted({x for c in df for x in (c, c.upper()) if len(x) == 1})


def partly_undone(signs: list[str]):
    """Column function: keys of what undoing a word's garbled signs gives, by each chain from UTF-8; no entry for most words."""

    @F.pandas_udf("array<string>")
    def keys(words: pd.Series) -> pd.Series:
        tables = [(t, max(map(len, t), default=0)) for t in inverse_tables(signs)]
        heads: dict[str, set[int]] = {}
        for k, (t, _) in enumerate(tables):
            for g in t:
                if len(g) > 1:
                    heads.setdefault(g[:2], set()).add(k)

        def of(word: str) -> list[str]:
            may = set().union(*(heads.get(word[i : i + 2], ()) for i in range(len(word) - 1) if not word[i].isascii()))
            return sorted({key_of(s) for k in may if (s := undone(word, *tables[k])) != word})

        return words.map(of)

    return keys


def match_case(original: str, word: str) -> str:
    """The original in the damaged word's case, as its ASCII letters tell it."""
    plain = [c for c in word if c.isascii() and c.isalpha()]
    if plain and all(c.isupper() for c in plain) and (len(plain) > 1 or word.isupper()):
        return original.upper()
    return original.lower() if plain and word.islower() else original


def repair_names(rows: DataFrame, corpus: DataFrame | None = None, cut=None) -> DataFrame:
    """``rows`` with ``garbled`` (whether the name is damaged), ``restored`` (its original; null where a word's is unknown) and ``evidence``.

    ``rows`` has a name and any other columns. ``corpus(name)`` are further
    names whose clean words may be originals. ``cut`` writes a table once and
    reads it back. Names are split, their words joined with the damaged ones,
    and only names that hold one are put together again.
    """
    cut = cut or (lambda df: df)
    alln = rows.select("name", F.lit(True).alias("asked"))
    if corpus is not None:
        alln = alln.unionByName(corpus.select("name", F.lit(False).alias("asked")))
    words = cut(word_table(alln.where("name is not null").groupBy("name").agg(F.count("*").alias("n"), F.max("asked").alias("asked"))))
    clean = cut(words.where("clean").groupBy("key").agg(F.max_by("bare", F.struct("n", "bare")).alias("original"), F.sum("n").alias("support")))
    df = signs_of(clean, "original")
    signs = signs_with_capitals(df)

    @F.pandas_udf("struct<fixed string, evidence string>")
    def mend(word: pd.Series, bare_word: pd.Series, original: pd.Series) -> pd.DataFrame:
        out, inverse = [], None
        for w, b, o in zip(word, bare_word, original):
            if o is not None:
                out.append((w.replace(b, match_case(o, b), 1), "word"))
                continue
            inverse = inverse or inverse_tables(signs)
            s = undo_signs(w, inverse)
            out.append((s, "signs" if s is not None else "marks"))
        return pd.DataFrame(out, columns=["fixed", "evidence"], dtype=object)

    damaged = cut(find_garbled_words(words, clean, df).select("word", mend("word", "bare", "original").alias("m")).select("word", "m.*"))

    @F.pandas_udf("array<string>")
    def split(s: pd.Series) -> pd.Series:
        return s.map(lambda x: sorted({w for w in split_name(x)[::2] if w}))

    @F.pandas_udf("string")
    def put(name: pd.Series, fixes: pd.Series) -> pd.Series:
        def whole(x: str, fs) -> str | None:
            fixed = {f["word"]: f["fixed"] for f in fs}
            if None in fixed.values():
                return None
            parts = split_name(x)
            parts[::2] = [fixed.get(w, w) for w in parts[::2]]
            return "".join(parts)

        return pd.Series([whole(x, fs) for x, fs in zip(name, fixes)], dtype=object)

    # a name without a sign beyond ASCII or of the odd ASCII ones holds no suspect
    may = F.col("name").rlike("[^\\x00-\\x7F]") | F.col("name").rlike(_ASCII_ODD.pattern.replace("[^\\W\\d_]", "[A-Za-z]"))
    names = rows.select("name").where(may).distinct().select("name", F.explode(split("name")).alias("word"))
    # at most the words of one name come together
    fixed = (
        names.join(damaged, "word")
        .groupBy("name")
        .agg(F.collect_list(F.struct("word", "fixed")).alias("fixes"), F.min("evidence").alias("evidence"))
        .select("name", F.lit(True).alias("garbled"), put("name", "fixes").alias("restored"), "evidence")
    )
    return rows.join(fixed, "name", "left").select(*rows.columns, F.coalesce("garbled", F.lit(False)).alias("garbled"), "restored", "evidence")
