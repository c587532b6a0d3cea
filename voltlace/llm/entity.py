"""Matching entities across sources without keys (problem 2).

Method. Names are repaired, brought to one form and parsed; rows that agree in
all that is compared are one combination, and combinations of a table that
tell of one place are a mention of it. Mentions of different tables that share
a name block are candidate pairs, with odds from several noisy attributes.
Loopy belief propagation over these pairs, with the factor that a mention has
at most one partner in each other table, exchanges messages through joins and
aggregations until they stand still, with more damping the longer that takes;
the marginal of a pair is its confidence. ``settled`` is false for pairs whose
messages still moved after ``ROUNDS`` rounds, of which a warning tells, too.
Pairs with a marginal of ``ACCEPT`` or more are expanded to the rows of both.

Scale. A plant that a third of all rows describe is a handful of combinations,
since rows are aggregated (with partial sums) before anything is paired, and
its rows are expanded in slices of ``SLICE``. A block is judged from its
combinations - map points to a hundredth of a degree, regions, fuels - of one
place name, never from its rows, in time that grows with their number: within
it, mentions with coordinates meet through map cells, of which each holds few
places, and those without by country, one for each kind of region and fuel.
Only pairs that compete with others take part in the message rounds; a round
writes its state to the shared folder and the last round's table is dropped.

Cases: rows without a usable name are matched to nothing; coordinates that are
missing, out of range or (0, 0) count as unknown, mirrored or swapped ones are
turned round where the block's other rows support it; repeated rows all count;
equal marginals need no order, since every accepted pair is reported; empty
tables give no pairs.
"""

from __future__ import annotations

import math
import warnings
from collections import Counter, defaultdict
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlace.llm.names import deletions, look_alike, parse_names, stand_in, within_one_edit
from voltlace.session import release

ACCEPT = 0.5
NEAR = 0.12  # degrees within which coordinates mean the same site
FAR = 0.36
ROUNDS = 120
STILL = 1e-3
DAMPING = (0.5, 0.75, 0.9, 0.97)  # for each quarter of the rounds
SLICE = 1000

# log-odds of the evidence
PRIOR = 1.5
ODDS = {"near": 6.0, "far": -7.0, "state": 2.5, "other_state": -3.5, "country": 0.5, "other_country": -7.0, "fuel": 1.0, "other_fuel": -1.5, "base": 0.5, "other_base": -0.7}

# Country of a feed, and ISO codes of country names. Fixed values.
FEED_COUNTRY = {"EIA": "USA", "NPP": "IND", "ONS": "BRA", "OE": "AUS", "OCCTO": "JPN", "CHILE": "CHL"}
ISO3 = {
    "United States": "USA", "India": "IND", "China": "CHN", "Brazil": "BRA", "Japan": "JPN", "Chile": "CHL", "Poland": "POL", "Germany": "DEU", "Norway": "NOR",
    "Spain": "ESP", "Türkiye": "TUR", "Turkey": "TUR", "Australia": "AUS", "Romania": "ROU", "Greece": "GRC", "Bulgaria": "BGR", "Vietnam": "VNM", "Czech Republic": "CZE", "Czechia": "CZE",
    "France": "FRA", "Italy": "ITA", "United Kingdom": "GBR", "Netherlands": "NLD", "Belgium": "BEL", "Austria": "AUT", "Switzerland": "CHE", "Portugal": "PRT", "Sweden": "SWE", "Finland": "FIN",
    "Denmark": "DNK", "Hungary": "HUN", "Slovakia": "SVK", "Slovenia": "SVN", "Croatia": "HRV", "Serbia": "SRB", "Ukraine": "UKR", "Russia": "RUS", "South Korea": "KOR", "Indonesia": "IDN", "South Africa": "ZAF", "Mexico": "MEX", "Argentina": "ARG",
}
FUELS = (("coal", "coal"), ("gas", "gas"), ("hydro", "hydro"), ("wind", "wind"), ("solar", "solar"), ("bio", "bio"), ("nuclear", "nuclear"), ("oil", "oil"), ("waste", "bio"), ("geo", "geo"))


def _lookup(c: Column, values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[c]


def _fuel(c: Column) -> Column:
    word = F.regexp_extract(F.lower(F.trim(c)), "^(?:fossil )?(" + "|".join(w for w, _ in FUELS) + ")", 1)
    return _lookup(F.nullif(word, F.lit("")), dict(FUELS))


def _null() -> Column:
    return F.lit(None).cast("string")


def gem_rows(gem: DataFrame) -> DataFrame:
    return gem.select(
        F.lit("gem_database").alias("table_name"), F.col("gem_row_id").alias("row_id"), F.col("project_name").alias("name"), _null().alias("hint"),
        _lookup(F.col("country"), ISO3).alias("country"), F.trim("subnational").alias("state"), _fuel(F.col("fuel")).alias("fuel"), "latitude", "longitude",
    )


def gppd_rows(gppd: DataFrame) -> DataFrame:
    return gppd.select(
        F.lit("gppd").alias("table_name"), F.col("gppd_row_id").alias("row_id"), "name", _null().alias("hint"),
        F.upper(F.trim("country")).alias("country"), _null().alias("state"), _fuel(F.col("primary_fuel")).alias("fuel"), "latitude", "longitude",
    )


def crosswalk_rows(xwalk: DataFrame) -> DataFrame:
    return xwalk.select(
        F.lit("unified_plant_crosswalk").alias("table_name"), F.col("xwalk_row_id").alias("row_id"), F.col("plant_name").alias("name"), F.col("ref_matched_name").alias("hint"),
        _lookup(F.col("source_system"), FEED_COUNTRY).alias("country"), F.trim("state").alias("state"), F.when(F.col("coal_type").isNotNull(), "coal").alias("fuel"), "latitude", "longitude",
    )


COMPARED = ["table_name", "base", "sound", "quals", "country", "state", "fuel", "la", "lo"]


def parse_rows(rows: DataFrame) -> DataFrame:
    """(row_id, combo, and what is compared): each distinct name is parsed once.

    ``rows`` also has ``restored`` (the original of a garbled name) and
    ``garbled``. Where an original is unknown, an earlier match of the row
    (``hint``) that agrees in the letters that are left stands in for it.
    """
    lost = F.coalesce(F.col("garbled"), F.lit(False)) & F.col("restored").isNull() & F.col("hint").isNotNull()
    named = rows.withColumn("shown", F.when(lost, stand_in("name", "hint")).otherwise(F.coalesce("restored", "name")))
    lat, lon = F.col("latitude"), F.col("longitude")
    known = lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon) & ~((lat == 0) & (lon == 0))
    fine = lambda c: F.when(known, F.round(c, 2))
    parsed = named.where("shown is not null").withColumn("p", parse_names("shown")).where("p.base is not null")
    flat = parsed.select("table_name", "row_id", "p.base", "p.sound", "p.quals", "country", "state", F.coalesce("fuel", "p.name_fuel").alias("fuel"), fine(lat).alias("la"), fine(lon).alias("lo"))
    return flat.withColumn("combo", F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in COMPARED]))


def block_spellings(combos: DataFrame, cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Adds ``block``: spellings one edit apart, with equal qualifiers, share the block of the most frequent one."""
    parts = (
        combos.groupBy("sound", "quals")
        .agg(F.sum("n").alias("n"))
        .where(F.length("sound") >= 5)
        .withColumn("part", F.explode(deletions("sound")))
    )
    rank = lambda s: F.struct(F.col(f"{s}.n"), F.col(f"{s}.sound"))
    up = cut(
        parts.alias("a")
        .join(parts.alias("b"), (F.col("a.part") == F.col("b.part")) & (F.col("a.quals") == F.col("b.quals")) & (rank("a") < rank("b")))
        .groupBy(F.col("a.sound").alias("sound"), F.col("a.quals").alias("quals"), F.col("b.sound").alias("other"))
        .agg(F.max("b.n").alias("n"))
        .where(within_one_edit("sound", "other"))
        .groupBy("sound", "quals")
        .agg(F.max_by("other", F.struct("n", "other")).alias("up"))
    )
    # pointers double their reach until all point to a spelling that points nowhere; ranks rise along them, so there is no circle
    top = F.col("top")
    while True:
        far = cut(up.alias("a").join(up.select(F.col("sound").alias("up"), "quals", F.col("up").alias("top")), ["up", "quals"], "left").select("sound", "quals", F.coalesce(top, "up").alias("up"), top.isNotNull().alias("moved")))
        moved = far.where("moved").limit(1).count()
        up = far.drop("moved")
        if not moved:
            break
    return combos.join(up, ["sound", "quals"], "left").withColumn("block", F.concat_ws(" ", F.coalesce("up", "sound"), F.nullif("quals", F.lit("")))).drop("up")


def rejoin_lonely(combos: DataFrame) -> DataFrame:
    """Combinations whose block only one table knows join the block of a like spelling (two edits, lost signs) at the same site."""
    tables = combos.groupBy("block").agg((F.min("table_name") == F.max("table_name")).alias("lonely"))
    cell = lambda c: F.floor(F.col(c) * 20).cast("int")
    points = combos.where("la is not null").join(tables, "block").groupBy("block", "sound", "quals", "la", "lo", "lonely").agg(F.sum("n").alias("n")).withColumn("ca", cell("la")).withColumn("co", cell("lo"))
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("da"), F.lit(j).alias("do")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    lonely = points.where("lonely").withColumn("d", steps).withColumn("ca", F.col("ca") + F.col("d.da")).withColumn("co", F.col("co") + F.col("d.do"))
    rank = lambda s: F.struct(~F.col(f"{s}.lonely"), F.col(f"{s}.n"), F.col(f"{s}.block"))
    moved = (
        lonely.alias("x")
        .join(points.alias("y"), ["ca", "co", "quals"])
        .where((F.col("x.block") != F.col("y.block")) & (rank("y") > rank("x")) & (F.abs(F.col("x.la") - F.col("y.la")) < 0.03) & (F.abs(F.col("x.lo") - F.col("y.lo")) < 0.03))
        .select(F.col("x.block").alias("block"), F.col("x.sound").alias("s"), F.col("y.sound").alias("t"), F.col("y.block").alias("new"), F.col("y.n").alias("n"))
        .where(look_alike("s", "t"))
        .groupBy("block")
        .agg(F.max_by("new", F.struct("n", "new")).alias("new"))
    )
    return combos.join(moved, "block", "left").withColumn("block", F.coalesce("new", "block")).drop("new")


# -- one block ----------------------------------------------------------------


class _Place:
    __slots__ = ("la", "lo", "n", "into", "key")

    def __init__(self, la: float, lo: float, n: int):
        self.la, self.lo, self.n, self.into, self.key = la, lo, n, None, (la, lo)


class _Map:
    """Places found again by their coordinates."""

    def __init__(self) -> None:
        self.cells: dict[tuple[int, int], list[_Place]] = defaultdict(list)

    def add(self, p: _Place) -> None:
        self.cells[math.floor(p.la / FAR), math.floor(p.lo / FAR)].append(p)

    def near(self, la: float, lo: float, reach: float = NEAR) -> list[_Place]:
        """Places within ``reach`` in both directions; degrees of longitude shrink towards the poles."""
        wide = reach / max(0.1, math.cos(math.radians(la)))
        a, o = math.floor(la / FAR), math.floor(lo / FAR)
        steps = math.ceil(wide / FAR)
        return [p for i in (-1, 0, 1) for j in range(-steps, steps + 1) for p in self.cells.get((a + i, o + j), ()) if abs(p.la - la) <= reach and abs(p.lo - lo) <= wide]


def _places(points: Counter) -> dict[tuple[float, float], _Place]:
    """The place of each map point; lonely mirrored or swapped points belong to the place they mirror."""
    at, found = _Map(), {}
    places: list[_Place] = []
    for (la, lo), n in sorted(points.items(), key=lambda x: (-x[1], x[0])):
        x, y = (lo, la) if abs(la) > 90 >= abs(lo) else (la, lo)
        if abs(x) > 90 or abs(y) > 180:
            continue
        hits = at.near(x, y)
        if hits:
            p = max(hits, key=lambda q: q.n)
            p.n += n
        else:
            p = _Place(x, y, n)
            at.add(p)
            places.append(p)
        found[la, lo] = p
    for p in sorted(places, key=lambda q: (q.n, q.key)):
        turned = [q for x, y in ((p.la, -p.lo), (-p.la, p.lo), (-p.la, -p.lo), (p.lo, p.la)) if abs(x) <= 90 for q in at.near(x, y) if q is not p and q.into is None and (q.n, q.key) > (p.n, p.key)]
        if turned:
            p.into = max(turned, key=lambda q: (q.n, q.key))
            p.into.n += p.n
    for k, p in found.items():
        while p.into is not None:
            p = p.into
        found[k] = p
    return found


def _common(counts: Counter) -> str | None:
    known = {k: v for k, v in counts.items() if k is not None}
    return min(known, key=lambda k: (-known[k], k)) if known else None


class _Mention:
    __slots__ = ("table", "key", "place", "says", "n")

    def __init__(self, table: str, key: str, place: _Place | None):
        self.table, self.key, self.place, self.n = table, key, place, 0
        self.says = {c: Counter() for c in ("country", "state", "fuel", "base")}

    def hear(self, row: dict) -> None:
        self.n += row["n"]
        for c, counts in self.says.items():
            counts[row[c]] += row["n"]

    def common(self, c: str) -> str | None:
        return _common(self.says[c])


KIND = ("country", "state", "fuel")


def _clash(a: str | None, b: str | None) -> bool:
    return a is not None and b is not None and a != b


def _same(a: str | None, b: str | None) -> bool:
    return a is not None and a == b


def judge_block(block: str, rows: list[dict]) -> tuple[list[tuple[int, str]], list[tuple[str, str, str, str, float]]]:
    """([(combo, mention)], [(mention, mention, table, table, odds)]) of a block's combinations."""
    points: Counter = Counter()
    for r in rows:
        if r["la"] is not None:
            points[r["la"], r["lo"]] += r["n"]
    place_of = _places(points)
    mentions: dict[tuple[str, str], _Mention] = {}
    members: list[tuple[int, str]] = []
    loose: dict[str, list[dict]] = defaultdict(list)
    for r in rows:
        p = place_of.get((r["la"], r["lo"])) if r["la"] is not None else None
        if p is None:
            loose[r["table_name"]].append(r)
            continue
        m = mentions.setdefault((r["table_name"], f"{p.la:g}/{p.lo:g}"), _Mention(r["table_name"], f"{p.la:g}/{p.lo:g}", p))
        m.hear(r)
        members.append((r["combo"], m.key))
    # rows without a place are taken by kind: country, state and fuel. They join their table's fitting place, else one another
    best_of: dict[str, dict[tuple, _Mention]] = defaultdict(dict)
    for m in mentions.values():
        kind = tuple(m.common(c) for c in KIND)
        if (old := best_of[m.table].get(kind)) is None or (m.n, m.key) > (old.n, old.key):
            best_of[m.table][kind] = m
    for table, rs in loose.items():
        kinds: dict[tuple, list[dict]] = defaultdict(list)
        for r in rs:
            kinds[tuple(r[c] for c in KIND)].append(r)
        left = []
        for kind, same in kinds.items():
            fits = [(2 * _same(kind[1], k[1]) + _same(kind[2], k[2]), m.n, m.key) for k, m in best_of[table].items() if not any(map(_clash, kind, k))]
            if fits:
                members += [(r["combo"], max(fits)[2]) for r in same]
            else:
                left.append((kind, same))
        # the fullest kinds first, each to the first mention that nothing it says contradicts
        apart: list[_Mention] = []
        for kind, same in sorted(left, key=lambda x: (-sum(c is not None for c in x[0]), -sum(r["n"] for r in x[1]), min(r["combo"] for r in x[1]))):
            m = next((m for m in apart if not any(_clash(k, m.common(c)) for c, k in zip(KIND, kind))), None)
            if m is None:
                m = mentions[table, f"?{len(apart)}"] = _Mention(table, f"?{len(apart)}", None)
                apart.append(m)
            for r in same:
                m.hear(r)
                members.append((r["combo"], m.key))
    # candidate pairs
    ms = list(mentions.values())
    says = {id(m): {c: m.common(c) for c in m.says} for m in ms}
    at, of_place, of_country = _Map(), defaultdict(list), defaultdict(list)
    for m in ms:
        if m.place is not None:
            if id(m.place) not in of_place:
                at.add(m.place)
            of_place[id(m.place)].append(m)
        of_country[says[id(m)]["country"]].append(m)
    pairs = []
    for m in ms:
        # beyond FAR, or in another country and without a place, no evidence could make a pair more likely than not
        country = says[id(m)]["country"]
        if m.place is not None:
            others = [x for p in at.near(m.place.la, m.place.lo, FAR) for x in of_place[id(p)]]
        else:
            others = ms if country is None else of_country[country] + of_country[None]
        for x in others:
            if x.table == m.table or (x.table < m.table and (m.place is None) == (x.place is None)) or (m.place is not None and x.place is None):
                continue
            a, b = (m, x) if m.table < x.table else (x, m)
            pairs.append((f"{block}@{a.key}", f"{block}@{b.key}", a.table, b.table, _odds(a, b, says[id(a)], says[id(b)])))
    return members, pairs


def _odds(a: _Mention, b: _Mention, x: dict, y: dict) -> float:
    total = PRIOR
    for c in ("country", "state", "fuel", "base"):
        if x[c] is not None and y[c] is not None:
            total += ODDS[c] if x[c] == y[c] else ODDS[f"other_{c}"]
    if a.place is not None and b.place is not None:
        away = max(abs(a.place.la - b.place.la), abs(a.place.lo - b.place.lo) * math.cos(math.radians(a.place.la)))
        total += ODDS["near"] if away <= NEAR else ODDS["far"] if away > FAR else 0.0
    return math.exp(total)


_S, _L = T.StringType(), T.LongType()
_JUDGED = T.StructType(
    [
        T.StructField("members", T.ArrayType(T.StructType([T.StructField("combo", _L), T.StructField("mention", _S)]))),
        T.StructField("pairs", T.ArrayType(T.StructType([T.StructField(n, _S) for n in ("a", "b", "table_a", "table_b")] + [T.StructField("odds", T.DoubleType())]))),
    ]
)


@F.pandas_udf(_JUDGED)
def _judge(blocks: pd.Series, combos: pd.Series) -> pd.DataFrame:
    clean = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    out = [judge_block(b, [{k: clean(v) for k, v in r.items()} for r in rows]) for b, rows in zip(blocks, combos)]
    names = ("a", "b", "table_a", "table_b", "odds")
    return pd.DataFrame({"members": [[{"combo": c, "mention": f"{b}@{m}"} for c, m in ms] for b, (ms, _) in zip(blocks, out)], "pairs": [[dict(zip(names, p)) for p in ps] for _, ps in out]})


# -- belief propagation --------------------------------------------------------


def propagate(pairs: DataFrame, cut: Callable[[DataFrame], DataFrame], rounds: int = ROUNDS, still: float = STILL) -> DataFrame:
    """Marginals of ``pairs`` under the factor that a mention has at most one partner in each other table.

    A message says how free a mention is for a pair, given all its other
    pairs: 1 / (1 + sum of odds * message of the others). Sums are aggregated
    per mention and other table and joined back; both directions in turn, with
    damping, until no message moves by more than ``still``. Pairs without a
    competitor have messages of 1 at once and take no part.
    """

    def sums(s: DataFrame, node: str, incoming: str) -> DataFrame:
        own, other = (["a", "table_a"], "table_b") if node == "a" else (["b", "table_b"], "table_a")
        return s.groupBy(*own, other).agg(F.sum(F.col("odds") * F.col(incoming)).alias("total"), F.count("*").alias("k"))

    first = pairs.withColumn("from_a", F.lit(1.0)).withColumn("from_b", F.lit(1.0))
    keys = ["table_a", "table_b"]
    ka = sums(first, "a", "from_b").select("a", *keys, F.col("k").alias("ka"))
    kb = sums(first, "b", "from_a").select("b", *keys, F.col("k").alias("kb"))
    state = cut(first.join(ka, ["a", *keys]).join(kb, ["b", *keys]).withColumn("alone", (F.col("ka") == 1) & (F.col("kb") == 1)).drop("ka", "kb"))
    alone = state.where("alone").select("a", "b", *keys, (F.col("odds") / (1 + F.col("odds"))).alias("marginal"))
    state = state.where("not alone").drop("alone")

    def free(s: DataFrame, node: str, incoming: str, out: str, damping: float) -> DataFrame:
        rest = F.greatest(F.col("total") - F.col("odds") * F.col(incoming), F.lit(0.0))
        return s.join(sums(s, node, incoming).drop("k"), [node, *keys]).withColumn(out, damping * F.col(out) + (1 - damping) / (1 + rest)).drop("total")

    state = state.withColumn("moved", F.lit(1.0))
    written = None
    for k in range(rounds):
        damping = DAMPING[k * len(DAMPING) // rounds]
        s = free(state.withColumn("old_a", F.col("from_a")).withColumn("old_b", F.col("from_b")), "a", "from_b", "from_a", damping)
        s = free(s, "b", "from_a", "from_b", damping)
        state = cut(s.withColumn("moved", F.greatest(F.abs(F.col("from_a") - F.col("old_a")), F.abs(F.col("from_b") - F.col("old_b")))).drop("old_a", "old_b"))
        if written is not None:
            release(written)
        written = state
        most = state.agg(F.max("moved")).first()[0] or 0.0
        if most <= 2 * still * (1 - damping):
            break
    else:
        warnings.warn(f"messages still move by {most:.2g} after {rounds} rounds; see the column settled", stacklevel=2)
    belief = F.col("odds") * F.col("from_a") * F.col("from_b")
    rest = state.select("a", "b", *keys, (belief / (1 + belief)).alias("marginal"), (F.col("moved") <= 2 * still).alias("settled"))
    return alone.withColumn("settled", F.lit(True)).unionByName(rest)


def resolve(rows: DataFrame, cut: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): (table_name, row_id, mention) of all rows, and the candidate pairs of mentions; see :func:`parse_rows`."""
    parsed = cut(parse_rows(rows))
    combos = parsed.groupBy("combo", *COMPARED).agg(F.count("*").alias("n"))
    blocked = cut(block_spellings(cut(combos), cut))
    lists = rejoin_lonely(blocked).groupBy("block").agg(F.collect_list(F.struct("combo", "table_name", "base", "country", "state", "fuel", "la", "lo", "n")).alias("combos"))
    judged = cut(lists.select(_judge("block", "combos").alias("j")).select("j.*"))
    of_combo = judged.select(F.explode("members").alias("m")).select("m.*")
    members = parsed.select("table_name", "row_id", "combo").join(of_combo, "combo").drop("combo")
    return members, judged.select(F.explode("pairs").alias("p")).select("p.*")


def slices(n: Column) -> Column:
    """How many slices a mention of ``n`` rows is expanded in."""
    return F.ceil(n / SLICE).cast("int")


def match(rows: DataFrame, cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(id_a, id_b, confidence, settled): row pairs of different tables that mean the same plant.

    The rows of both sides are in slices, and each slice of one side meets
    each of the other, so a mention that holds most rows is no single task.
    """
    members, pairs = resolve(rows, cut)
    accepted = propagate(pairs, cut).where(F.col("marginal") >= ACCEPT)
    sizes = members.groupBy("table_name", "mention").agg(slices(F.count("*")).alias("parts"))
    sliced = members.join(sizes, ["table_name", "mention"]).withColumn("slice", F.pmod(F.xxhash64("row_id"), "parts").cast("int")).drop("parts")
    out = accepted
    for s in ("a", "b"):
        named = sizes.select(F.col("table_name").alias(f"table_{s}"), F.col("mention").alias(s), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias(f"slice_{s}"))
        out = out.join(named, [f"table_{s}", s])
    for s in ("a", "b"):
        held = sliced.select(F.col("table_name").alias(f"table_{s}"), F.col("mention").alias(s), F.col("slice").alias(f"slice_{s}"), F.col("row_id").alias(f"row_{s}"))
        out = out.join(held, [f"table_{s}", s, f"slice_{s}"])
    return out.select(F.least("row_a", "row_b").alias("id_a"), F.greatest("row_a", "row_b").alias("id_b"), F.col("marginal").alias("confidence"), "settled")
