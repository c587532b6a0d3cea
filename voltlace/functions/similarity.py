"""Token-sorted similarity: 200 * LCS / (length + length), 100 for two empty texts."""

from __future__ import annotations

import bisect
import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def token_sorted(c: Column) -> Column:
    """Words in order, joined by one space."""
    words = F.filter(F.split(F.trim(c), r"(?U)\s+"), lambda w: w != "")
    return F.array_join(F.array_sort(words), " ")


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence, bit-parallel over the letters of ``a``."""
    places: dict[str, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for y in b:
        u = s & places.get(y, 0)
        s = ((s + u) | (s - u)) & full
    return len(a) - s.bit_count()


def ratio(a: str, b: str) -> float:
    return 200.0 * lcs_length(a, b) / (len(a) + len(b)) if a or b else 100.0


@F.pandas_udf(T.DoubleType())
def _ratios(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else ratio(x, y) for x, y in zip(a, b)], dtype="float64")


def token_sort_ratio(a: Column, b: Column) -> Column:
    return _ratios(token_sorted(a), token_sorted(b))


class _Block:
    """Keys of much the same length, their letters' places as bits of the least word that holds them, and the LCS states of one text's beginnings."""

    DEPTH = 64  # beginnings whose states are kept

    def __init__(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, letters: str, first: int, pool: list[np.ndarray]):
        self.first, self.size = first, len(lengths)
        longest = int(lengths[-1])
        kind = np.uint16 if longest <= 16 else np.uint32 if longest <= 32 else np.uint64
        here = np.unique(codes[starts[0] : starts[-1] + longest])
        row = np.zeros(len(letters), np.int64)
        row[here] = np.arange(len(here))
        masks = np.zeros((len(here), self.size), kind)
        for p in range(longest):
            a = int(np.searchsorted(lengths, p, "right"))  # keys that have such a place
            masks[row[codes[starts[a:] + p]], np.arange(a, self.size)] |= kind(1 << p)
        self.masks = {letters[x]: masks[i] for i, x in enumerate(here)}
        sizes, at = np.unique(lengths, return_index=True)
        self.slices = list(zip(sizes.tolist(), at.tolist(), [*at[1:].tolist(), self.size]))
        self.pool, self.u = pool, np.empty(self.size, kind)
        self.end()
        self.count, self.good = np.empty(self.size, np.uint8), np.empty(self.size, bool)

    def begin(self) -> None:
        """To be called where other blocks have been used since."""
        self.text = ""
        self.states = [np.full(self.size, ~self.u.dtype.type(0))]
        self.own: list[np.ndarray] = []

    def end(self) -> None:
        self.text, self.states, self.own = "", [], []

    def _room(self, depth: int) -> np.ndarray:
        while len(self.own) <= depth:
            if len(self.pool) == len(self.own):
                self.pool.append(np.empty(Catalogue.BLOCK, np.uint64))
            self.own.append(self.pool[len(self.own)].view(self.u.dtype)[: self.size])
        return self.own[depth]

    def lcs(self, text: str) -> np.ndarray:
        """Longest common subsequences with all keys; what the last text began with as well is not done again."""
        same = 0
        for x, y in zip(text[: self.DEPTH], self.text):
            if x != y:
                break
            same += 1
        del self.states[same + 1 :]
        s, u = self.states[-1], self.u
        self._room(len(text) if len(text) <= self.DEPTH else self.DEPTH + 1)
        for d in range(same, len(text)):
            m = self.masks.get(text[d])
            if m is not None:
                to = self.own[min(d, self.DEPTH)]
                if to is s:
                    to = self.own[self.DEPTH + 1]
                np.bitwise_and(s, m, u)
                np.bitwise_xor(s, u, to)
                np.add(s, u, u)
                np.bitwise_or(to, u, to)
                s = to
            if d < self.DEPTH:
                self.states.append(s)
        self.text = text[: self.DEPTH]
        return np.bitwise_count(np.invert(s, u), self.count)


class Catalogue:
    """Names scored all at once against one text, exactly: one machine word of LCS state per name.

    Keys are kept by length in blocks that fit the processor's cache, in words
    of 16, 32 or 64 bits; longer ones are scored one by one. Texts are taken in
    the order of their endings, so that texts with the same ending share the
    states of it, and each goes to the block of its own length first. The
    ``k``-th best score found there, or the cutoff, tells which lengths can still matter:
    a common part is at most as long as the shorter text.
    """

    BLOCK = 1 << 15

    def __init__(self, keys: list[str]):
        lengths = np.fromiter(map(len, keys), np.int64, len(keys))
        self.order = np.argsort(lengths, kind="stable")
        self.lengths = lengths[self.order]
        short = int(np.searchsorted(self.lengths, 64, "right"))
        self.long = [keys[i][::-1] for i in self.order[short:]]
        points = np.frombuffer("".join(keys[i][::-1] for i in self.order[:short]).encode("utf-32-le", "surrogatepass"), np.uint32)
        known = np.zeros(0x110000, bool)
        known[points] = True
        letters = "".join(map(chr, np.flatnonzero(known)))
        codes = (np.cumsum(known, dtype=np.int32) - 1)[points]
        starts = np.cumsum(self.lengths) - self.lengths
        self.blocks: list[_Block] = []
        pool: list[np.ndarray] = []  # one block is at work at a time
        at = 0
        for bits in (16, 32, 64):
            end = int(np.searchsorted(self.lengths, bits, "right"))
            for lo in range(at, end, self.BLOCK):
                hi = min(lo + self.BLOCK, end)
                self.blocks.append(_Block(codes, starts[lo:hi], self.lengths[lo:hi], letters, lo, pool))
            at = end

    def scores(self, text: str) -> np.ndarray:
        """Scores of all keys as they were given."""
        out = np.empty(len(self.lengths))
        ((places, scores),) = self.best([text], len(self.lengths), None, np.zeros(len(self.lengths), np.int64))
        out[places] = scores
        return out

    def best(self, texts: list[str], k: int, cutoff: float | None, ords: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(places, scores) for each text: its ``k`` best keys of ``cutoff`` or more; of equal scores the lower of ``ords`` first."""
        search = _Search(self, texts, k, 0.0 if cutoff is None else max(cutoff, 0.0), ords[self.order])
        turn = sorted(range(len(texts)), key=lambda i: texts[i][::-1])
        ends = [int(self.lengths[b.first + b.size - 1]) for b in self.blocks]
        home = [bisect.bisect_left(ends, len(x)) for x in texts]
        for other in (False, True):
            for b, block in enumerate(self.blocks):
                block.begin()
                for i in turn:
                    if (min(home[i], len(self.blocks) - 1) != b) == other:
                        search.look(block, i)
                block.end()
        for i in turn:
            search.look_long(self.long, len(self.lengths) - len(self.long), i)
        return [(self.order[keys], scores) for keys, scores in search.found]


class _Search:
    """The best keys found so far for some texts."""

    def __init__(self, catalogue: Catalogue, texts: list[str], k: int, cutoff: float, ords: np.ndarray):
        self.lengths, self.k, self.cutoff, self.ords = catalogue.lengths, k, cutoff, ords
        self.texts = [x[::-1] for x in texts]
        self.found = [(np.empty(0, np.int64), np.empty(0))] * len(texts)
        self.level = [cutoff] * len(texts)  # what a key must score to matter
        self.guess = 70.0

    def _slices(self, block: _Block, n: int, level: float) -> list[tuple[int, int, int]]:
        """Least common length, from and to, of the block's keys that can score ``level`` with a text of length ``n``."""
        out = []
        for size, x, y in block.slices:
            least = max(math.ceil(level * (n + size) / 200.0 - 1e-9), 0)
            if least <= min(n, size):
                out.append((least, x, y))
        return out

    def look(self, block: _Block, i: int) -> None:
        text = self.texts[i]
        slices = self._slices(block, len(text), self.level[i])
        if not slices:
            return
        count = block.lcs(text)
        level = self.level[i]
        if len(self.found[i][0]) < self.k and level < self.guess:  # a higher level is enough if it gives k keys
            tried = self._pass(block, count, self._slices(block, len(text), self.guess))
            if len(tried) >= self.k:
                self._add(i, block.first + tried, count[tried])
                self.guess = self.level[i]
                return
            self.guess = max(self.guess - 1.0, 40.0)
        passed = self._pass(block, count, slices)
        if len(passed):
            self._add(i, block.first + passed, count[passed])

    def _pass(self, block: _Block, count: np.ndarray, slices: list[tuple[int, int, int]]) -> np.ndarray:
        if not slices:
            return np.empty(0, np.int64)
        good = block.good
        for (least, x, y), last in zip(slices, [slices[0][1], *(s[2] for s in slices)]):
            good[last:x] = False
            np.greater_equal(count[x:y], least, out=good[x:y])
        lo, hi = slices[0][1], slices[-1][2]
        return lo + np.flatnonzero(good[lo:hi])

    def look_long(self, keys: list[str], first: int, i: int) -> None:
        text, new, lcs = self.texts[i], [], []
        for j, key in enumerate(keys):
            if 200.0 * min(len(text), len(key)) >= self.level[i] * (len(text) + len(key)) - 1e-6:
                new.append(first + j)
                lcs.append(lcs_length(key, text))
        if new:
            self._add(i, np.array(new), np.array(lcs))

    def _add(self, i: int, keys: np.ndarray, lcs: np.ndarray) -> None:
        total = self.lengths[keys] + len(self.texts[i])
        scores = np.where(total > 0, 200.0 * lcs / np.maximum(total, 1), 100.0)
        had, at = self.found[i]
        keys, scores = np.concatenate([had, keys]), np.concatenate([at, scores])
        if len(scores) > 4 * self.k + 64:  # all equal to the k-th stay, since the order number decides among them
            few = np.flatnonzero(scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k])
            keys, scores = keys[few], scores[few]
        top = np.lexsort((self.ords[keys], -scores))[: self.k]
        top = top[scores[top] >= self.cutoff]
        self.found[i] = keys[top], scores[top]
        if len(top) == self.k:
            self.level[i] = max(self.level[i], float(scores[top[-1]]))


class Pairwise:
    """A catalogue under any scorer of two texts (0 to 100), one pair at a time; no length is ruled out."""

    def __init__(self, scorer: Callable[[str, str], float]):
        self.scorer, self.keys = scorer, []

    def __call__(self, keys: list[str]) -> Pairwise:
        out = Pairwise(self.scorer)
        out.keys = keys
        return out

    def best(self, texts: list[str], k: int, cutoff: float | None, ords: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        out = []
        for text in texts:
            scores = np.array([self.scorer(text, x) for x in self.keys], np.float64)
            good = np.flatnonzero(scores >= cutoff) if cutoff is not None else np.arange(len(scores))
            top = good[np.lexsort((ords[good], -scores[good]))[:k]]
            out.append((top, scores[top]))
        return out
