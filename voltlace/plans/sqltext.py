"""Pieces of DuckDB SQL for the checks in :mod:`voltlace.plans.registry`."""

from __future__ import annotations

import re

from voltlace.functions import text as X
from voltlace.functions.domain import TECHNOLOGIES
from voltlace.schema import feed_countries

WS = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_COMPAT = {chr(o): chr(o - 0xFEE0) for o in range(0xFF01, 0xFF5F)} | {c: " " for c in "              　¨´¸¯˜"}
_COMPAT |= {"͏": "|"}  # counts as no combining mark
_COMPAT |= {"ª": "a", "º": "o", "²": "2", "³": "3", "¹": "1", "ⁿ": "n", "µ": "μ"}
_LONGER = {"ﬁ": "fi", "ﬂ": "fl", "ﬆ": "st", "ĳ": "ij", "Ĳ": "IJ", "Ⅱ": "II", "Ⅲ": "III", "Ⅰ": "I", "¼": "1⁄4", "½": "1⁄2", "¾": "3⁄4", "…": "...", "™": "TM", "ŀ": "l·", "ŉ": "ʼn"}


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def trim(e: str) -> str:
    return f"regexp_replace({e}, '^{WS}+|{WS}+$', '', 'g')"


def spaces(e: str) -> str:
    return f"regexp_replace({e}, '{WS}+', ' ', 'g')"


def strip(e: str, suffixes: list[str]) -> str:
    alts = "|".join(re.escape(s).replace("\\ ", " ") for s in sorted(suffixes, key=len, reverse=True))
    return f"regexp_replace(regexp_replace({e}, {lit(f'(?:{WS}*(?:{alts}))+{WS}*$')}, ''), '{WS}+$', '')"


def fix(e: str) -> str:
    raw = f"unhex(array_to_string(list_transform(string_split({e}, ''), lambda c: printf('%02X', unicode(c))), ''))"
    return rf"CASE WHEN regexp_full_match({e}, '[\x{{00}}-\x{{FF}}]*') THEN coalesce(try(decode({raw})), {e}) ELSE {e} END"


def fold(e: str) -> str:
    x = f"translate({fix(e)}, {lit(''.join(_COMPAT))}, {lit(''.join(_COMPAT.values()))})"
    for a, b in _LONGER.items():
        x = f"replace({x}, {lit(a)}, {lit(b)})"
    return f"strip_accents({x})"


def scrub(e: str) -> str:
    return rf"trim(regexp_replace(regexp_replace({e}, '[^A-Z0-9\s]', ' ', 'g'), '\s+', ' ', 'g'))"


def key1(folded: str) -> str:
    up = trim(rf"regexp_replace({trim(f'upper({folded})')}, '\([^)]*\)', '', 'g')")
    return scrub(strip(strip(up, X.FEED_SUFFIXES), [s.upper() for s in X.CATALOGUE_SUFFIXES]))


def key2(folded: str) -> str:
    return scrub(f"regexp_replace({strip(f'upper({folded})', X.FEED_SUFFIXES)}, {lit(X.SECOND_ENDING)}, '')")


def validates(base: str, matched: str) -> str:
    phrase = f"trim({spaces(f'regexp_replace(lower({base}), {lit('[-_]')}, {lit(' ')}, {lit('g')})')})"
    stop = "[" + ", ".join(lit(w) for w in X.STOP_WORDS) + "]"
    words = f"list_filter(string_split({phrase}, ' '), lambda w: length(w) >= 4 AND NOT list_contains({stop}, w))"
    text = f"regexp_replace(lower({matched}), {lit('[-_]')}, ' ', 'g')"
    stands = lambda w: rf"regexp_matches({text}, '(?:^|[^\p{{L}}\p{{N}}_])' || regexp_escape({w}) || '(?:$|[^\p{{L}}\p{{N}}_])')"
    return f"coalesce(CASE WHEN len({words}) > 0 THEN len(list_filter({words}, lambda w: {stands('w')})) > 0 WHEN {phrase} <> '' THEN {stands(phrase)} ELSE false END, false)"


def not_coal(e: str) -> str:
    return f"coalesce(regexp_matches({e}, {lit(X.NON_COAL)}), false)"


def number(e: str) -> str:
    t = f"trim({e})"
    return rf"CASE WHEN regexp_full_match({t}, '[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?') THEN try_cast({t} AS DOUBLE) END"


def is_coal(e: str) -> str:
    return f"coalesce(starts_with(lower(trim({e})), 'coal'), false)"


def coal_type(e: str) -> str:
    first = f"lower(trim(string_split({e}, ',')[1]))"
    kind = f"trim(regexp_extract({first}, '^coal[^:]*:(.*)$', 1))"
    return f"CASE WHEN starts_with({first}, 'coal') AND {kind} NOT IN ('', 'unknown') THEN CASE WHEN {kind} = 'waste coal' THEN 'waste' ELSE {kind} END END"


def tech(e: str) -> str:
    key = f"replace(replace(lower(trim({e})), '-', ''), ' ', '')"
    return f"CASE {key} " + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in TECHNOLOGIES.items()) + " END"


def sorted_tokens(e: str) -> str:
    return f"array_to_string(list_sort(list_filter(string_split({spaces(f'trim({e})')}, ' '), lambda w: w <> '')), ' ')"


def lcs(a: str, b: str) -> str:
    """Length of the longest common subsequence: one row of the table per letter of ``a``."""
    letters = f"list_transform(string_split({a}, ''), lambda c: [unicode(c)])"
    codes = f"list_transform(string_split({b}, ''), lambda c: unicode(c))"
    step = f"list_transform({codes}, lambda x, i: CASE WHEN x = c[1] THEN (CASE WHEN i = 1 THEN 0 ELSE r[i - 1] END) + 1 ELSE r[i] END)"
    row = f"list_transform({step}, lambda x, i: list_max(({step})[1:i]))"
    return f"list_last(list_reduce({letters}, lambda r, c: {row}, list_transform({codes}, lambda x: 0)))"


def lcs_score(a: str, b: str) -> str:
    return f"CASE WHEN length({a}) + length({b}) = 0 THEN 100.0 WHEN {a} = {b} THEN 100.0 WHEN length({a}) = 0 OR length({b}) = 0 THEN 0.0 ELSE (200.0::DOUBLE * {lcs(a, b)}) / (length({a}) + length({b})) END"


def top_input() -> str:
    """Names of all feeds (q) and the first catalogue of each (c), by their keys."""
    names = f"SELECT DISTINCT source_system AS grp, {key1('f')} AS key FROM (SELECT source_system, {fold('plant_name')} AS f FROM unified_plant_crosswalk WHERE trim(plant_name) <> '' AND source_system IS NOT NULL)"
    return f"{_catalogues()}, q AS (SELECT grp, key, {sorted_tokens('key')} AS s FROM ({names}) WHERE key <> ''), c AS (SELECT grp, name, ord, s FROM gem_x)"


def scored(q: str, c: str, bound: bool = True, out: str = "scored") -> str:
    near = f"AND 3 * least(length({q}.s), length({c}.s)) >= 2 * greatest(length({q}.s), length({c}.s))" if bound else ""
    return f"{out} AS (SELECT {q}.grp, {q}.key, {c}.name, {c}.ord, {lcs_score(q + '.s', c + '.s')} AS score FROM {q} JOIN {c} ON {q}.grp = {c}.grp {near})"


def fold_units(source: str, out: str = "folded", group: str = "name") -> str:
    """CTEs from unit rows (name, ord, fuel, capacity, technology, latitude, longitude) to one row per ``group``."""
    cap = number("replace(lower(trim(capacity)), 'mw', '')")
    return f"""{out}_u AS (SELECT *, {is_coal('fuel')} AS coal FROM ({source}) WHERE name IS NOT NULL),
{out}_l AS (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY NOT coal, ord) AS rn FROM {out}_u),
{out} AS (SELECT a.*, l.latitude, l.longitude, CASE WHEN l.coal THEN {coal_type('l.fuel')} END AS coal_type, CASE WHEN l.coal THEN {tech('l.technology')} END AS combustion_tech FROM
(SELECT {group}, min(ord) AS ord, sum(CASE WHEN coal THEN {cap} END) AS capacity_mw FROM {out}_u GROUP BY {group}) a JOIN {out}_l l ON ({', '.join('a.' + g for g in group.split(', '))}) = ({', '.join('l.' + g for g in group.split(', '))}) AND l.rn = 1)"""


def _countries() -> str:
    return "countries AS (SELECT * FROM (VALUES " + ", ".join(f"({lit(a)}, {lit(b)}, {lit(c)})" for a, b, c in feed_countries()) + ") t(source_system, catalogue, country))"


def _valid(lat: str, lon: str) -> str:
    return f"{lat} BETWEEN -90 AND 90 AND {lon} BETWEEN -180 AND 180 AND NOT ({lat} = 0 AND {lon} = 0)"


def _catalogues() -> str:
    return f"""{_countries()},
gem_c AS (SELECT c.source_system AS grp, g.project_name AS name, g.gem_row_id AS ord, g.fuel, g.capacity, g.technology, g.latitude, g.longitude FROM gem_database g JOIN countries c ON c.catalogue = 'GEM' AND c.country = g.country WHERE g.project_name IS NOT NULL),
gem_k AS (SELECT grp, name, ord, {key1('f')} AS key FROM (SELECT grp, name, ord, {fold('name')} AS f FROM gem_c)),
gem_x AS (SELECT grp, name, ord, {sorted_tokens('key')} AS s FROM (SELECT grp, key, arg_min(name, ord) AS name, min(ord) AS ord FROM gem_k WHERE key <> '' GROUP BY ALL)),
{fold_units('SELECT * FROM gem_c', 'gem_i', 'grp, name')},
gppd_c AS (SELECT c.source_system AS grp, g.name, g.gppd_row_id AS ord, g.latitude, g.longitude FROM gppd g JOIN countries c ON c.catalogue = 'GPPD' AND c.country = g.country WHERE g.name IS NOT NULL),
gppd_k AS (SELECT grp, name, ord, {key2('f')} AS key FROM (SELECT grp, name, ord, {fold('name')} AS f FROM gppd_c)),
gppd_x AS (SELECT grp, name, ord, {sorted_tokens('key')} AS s FROM (SELECT grp, key, arg_min(name, ord) AS name, min(ord) AS ord FROM gppd_k WHERE key <> '' GROUP BY ALL)),
gppd_i AS (SELECT grp, name, arg_min(latitude, ord) FILTER (rn = 1) AS latitude, arg_min(longitude, ord) FILTER (rn = 1) AS longitude, NULL AS coal_type, NULL AS combustion_tech, NULL::DOUBLE AS capacity_mw FROM
 (SELECT *, row_number() OVER (PARTITION BY grp, name ORDER BY ord) AS rn FROM gppd_c) GROUP BY ALL)"""


def _stage(which: str, todo: str, out: str) -> str:
    x = which.lower()
    key = "k1" if which == "GEM" else "k2"
    off = "(p.source_system = 'NPP' AND " + not_coal("p.plant_name") + ")"
    return f"""{out}_t AS (SELECT * FROM {todo} WHERE {key} <> '' AND k1 <> ''),
{out}_q AS (SELECT DISTINCT source_system AS grp, {key} AS key, {sorted_tokens(key)} AS s FROM {out}_t),
{scored(out + '_q', x + '_x', True, out + '_s')},
{out}_b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY grp, key ORDER BY score DESC, ord) AS rn FROM {out}_s WHERE score >= 80) WHERE rn = 1),
{out}_h AS (SELECT p.*, b.name AS ref_matched_name, b.score, {fold(trim(strip('p.plant_name', X.FEED_SUFFIXES)))} AS bf, {fold('b.name')} AS nf FROM {out}_t p JOIN {out}_b b ON b.grp = p.source_system AND b.key = p.{key}),
{out} AS (SELECT p.plant_name, p.plant_code, p.source_system, i.latitude, i.longitude, '{which}' AS ref_source, 'rapidfuzz' AS matching_method, p.ref_matched_name,
 CASE WHEN NOT {off} THEN i.coal_type END AS coal_type, CASE WHEN NOT {off} THEN i.combustion_tech END AS combustion_tech, CASE WHEN NOT {off} THEN i.capacity_mw END AS capacity_mw
 FROM {out}_h p JOIN {x}_i i ON i.grp = p.source_system AND i.name = p.ref_matched_name WHERE (p.score >= 90 OR {validates('p.bf', 'p.nf')}) AND {_valid('i.latitude', 'i.longitude')})"""


def _keyed(source: str, out: str) -> str:
    return f"{out} AS (SELECT *, {key1('f')} AS k1, {key2('f')} AS k2 FROM (SELECT *, {fold('plant_name')} AS f FROM ({source}) WHERE trim(plant_name) <> ''))"


_FIRST = "SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY plant_name, source_system ORDER BY latitude NULLS LAST, longitude NULLS LAST, plant_code NULLS LAST) AS rn FROM {}) WHERE rn = 1"
_ANTI = "SELECT * FROM {0} p WHERE NOT EXISTS (SELECT 1 FROM {1} m WHERE m.plant_name = p.plant_name AND m.source_system IS NOT DISTINCT FROM p.source_system)"


def cascade() -> str:
    feeds = "(SELECT DISTINCT plant_name, plant_code, source_system, latitude, longitude FROM unified_plant_crosswalk WHERE plant_name IS NOT NULL)"
    return ",\n".join([
        _catalogues(), f"plants AS ({_FIRST.format(feeds)})", _keyed("SELECT * FROM plants", "todo1"), _stage("GEM", "todo1", "m1"),
        f"todo2 AS ({_ANTI.format('todo1', 'm1')})", _stage("GPPD", "todo2", "m2"), "cascade AS (SELECT * FROM m1 UNION ALL SELECT * FROM m2)",
    ])


def unified() -> str:
    eia = "SELECT coalesce(l.plant_name, x.plant_code) AS plant_name, x.plant_code, 'EIA' AS source_system, x.latitude, x.longitude FROM (SELECT DISTINCT plant_code, latitude, longitude FROM unified_plant_crosswalk WHERE source_system = 'EIA' AND plant_code IS NOT NULL) x LEFT JOIN eia_plant_lookup l ON l.plant_code = x.plant_code"
    rest = "SELECT DISTINCT plant_name, NULL::VARCHAR AS plant_code, source_system, latitude, longitude FROM unified_plant_crosswalk WHERE source_system <> 'EIA' AND plant_name IS NOT NULL"
    none = "NULL AS latitude, NULL AS longitude, NULL AS ref_source, NULL AS matching_method, NULL AS ref_matched_name, NULL AS coal_type, NULL AS combustion_tech, NULL AS capacity_mw"
    return ",\n".join([
        _catalogues(), f"named AS ({rest} UNION ALL {eia})", f"plants AS ({_FIRST.format('named')})",
        f"m0 AS (SELECT plant_name, plant_code, source_system, latitude, longitude, 'OE-direct' AS ref_source, 'direct' AS matching_method, plant_name AS ref_matched_name, NULL AS coal_type, NULL AS combustion_tech, NULL::DOUBLE AS capacity_mw FROM plants WHERE source_system = 'OE' AND {_valid('latitude', 'longitude')})",
        f"left0 AS ({_ANTI.format('plants', 'm0')})", _keyed("SELECT * FROM left0", "todo1"), _stage("GEM", "todo1", "m1"),
        f"todo2 AS ({_ANTI.format('todo1', 'm1')})", _stage("GPPD", "todo2", "m2"),
        "matched AS (SELECT * FROM m0 UNION ALL SELECT * FROM m1 UNION ALL SELECT * FROM m2)",
        f"rows_ AS (SELECT * FROM matched UNION ALL SELECT plant_name, plant_code, source_system, {none} FROM ({_ANTI.format('plants', 'matched')}))",
        "codes AS (SELECT DISTINCT plant_name, plant_code FROM named WHERE source_system = 'EIA')",
        "unified AS (SELECT * FROM rows_ WHERE source_system <> 'EIA' UNION ALL SELECT r.plant_name, c.plant_code, r.* EXCLUDE (plant_name, plant_code) FROM rows_ r LEFT JOIN codes c ON c.plant_name = r.plant_name WHERE r.source_system = 'EIA')",
    ])
