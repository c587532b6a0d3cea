"""Functions of the domain: capacities, fuels, technologies, coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Canonical combustion technologies by their spelling without hyphens and spaces.
TECHNOLOGIES = {
    "subcritical": "subcritical", "supercritical": "supercritical", "ultrasupercritical": "ultra-supercritical", "usc": "ultra-supercritical", "cfb": "CFB", "igcc": "IGCC",
}
_NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"


def to_number(c: Column) -> Column:
    """Double of a plain number text, else null."""
    t = F.trim(c.cast("string"))
    return F.when(t.rlike(_NUMBER), t.try_cast("double"))


def catalogue_capacity(c: Column) -> Column:
    """Megawatts of '660.0 MW' or a number; other text gives null."""
    return to_number(F.replace(F.lower(F.trim(c.cast("string"))), F.lit("mw"), F.lit("")))


def leading_capacity(c: Column) -> Column:
    """Number at the beginning of the text ('1,200 MW' gives 1)."""
    return to_number(F.nullif(F.regexp_extract(c.cast("string"), r"^([0-9.]+)", 1), F.lit("")))


def is_coal(fuel: Column) -> Column:
    return F.coalesce(F.lower(F.trim(fuel)).startswith("coal"), F.lit(False))


def coal_type(fuel: Column) -> Column:
    """Kind of coal of the first listed fuel; null if that is not coal or its kind unknown."""
    first = F.lower(F.trim(F.split(fuel, ",")[0]))
    kind = F.trim(F.regexp_extract(first, r"^coal[^:]*:(.*)$", 1))
    return F.when(first.startswith("coal") & ~kind.isin("", "unknown"), F.when(kind == "waste coal", "waste").otherwise(kind))


def coal_type_word(fuel: Column) -> Column:
    """Word after 'coal:' anywhere in the text, else 'unknown'."""
    return F.coalesce(F.nullif(F.regexp_extract(fuel, r"coal:\s*([\w-]+)", 1), F.lit("")), F.lit("unknown"))


def combustion_tech(tech: Column) -> Column:
    key = F.replace(F.replace(F.lower(F.trim(tech)), F.lit("-"), F.lit("")), F.lit(" "), F.lit(""))
    out = F.lit(None).cast("string")
    for k, v in TECHNOLOGIES.items():
        out = F.when(key == k, v).otherwise(out)
    return out


def tidy_technology(tech: Column) -> Column:
    return F.trim(F.lower(F.coalesce(tech, F.lit("unknown"))))


def valid_coordinates(lat: Column, lon: Column) -> Column:
    """Known, in range and not exactly (0, 0)."""
    ok = lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon) & ~((lat == 0) & (lon == 0)) & lat.between(-90, 90) & lon.between(-180, 180)
    return F.coalesce(ok, F.lit(False))


def cost_estimate(rows: Column, each: float = 0.001) -> Column:
    return rows * F.lit(each)


def percent(part: Column, whole: Column) -> Column:
    return 100.0 * F.try_divide(part.cast("double"), whole.cast("double"))
