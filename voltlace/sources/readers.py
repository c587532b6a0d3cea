"""Sources: relational feeds, CSV, parquet, file discovery, web page links, ZIP members."""

from __future__ import annotations

import os
import re
import warnings
from collections.abc import Mapping
from pathlib import Path
from urllib.parse import quote_plus

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlace.operators.joins import select_existing

STATEMENT_TIMEOUT_S = 120
CONNECT_TIMEOUT_S = 30

# Feed -> (table, name column, further columns). Fixed values.
FEEDS: dict[str, tuple[str, str, tuple[str, ...]]] = {
    "NPP": ("npp_generation", "plant", ()),
    "ENTSOE": ("mv_entsoe_plant_monthly", "plant_name", ()),
    "EIA": ("eia_generation_data", "plant_code", ()),
    "ONS": ("ons_generation_data", "plant", ()),
    "OE": ("oe_facility_generation_data", "facility_name", ("latitude", "longitude")),
    "OCCTO": ("occto_generation_data", "plant", ()),
    "CHILE": ("chile_generation_data", "plant", ()),
}


# -- places ------------------------------------------------------------------


def package_root() -> Path:
    return Path(__file__).resolve().parents[2]


def data_dir(root: str | None = None) -> Path:
    return Path(root or os.environ.get("VOLTLACE_DATA", "data"))


def crosswalk_dir(root: str | None = None) -> Path:
    return data_dir(root) / "crosswalks"


# -- relational --------------------------------------------------------------


def connection(env: Mapping[str, str] = os.environ) -> dict[str, str]:
    """JDBC options: DATABASE_URL, else its parts; time limits for connecting and for each statement."""
    url = env.get("DATABASE_URL")
    if url:
        m = re.fullmatch(r"(?:postgres|postgresql)(?:\+\w+)?://(?:([^:@/]+)(?::([^@/]*))?@)?([^/?]+)/([^?]+)(?:\?(.*))?", url)
        if not m:
            raise ValueError("DATABASE_URL is no postgres URL")
        user, password, host, db, options = m.groups()
    else:
        missing = [k for k in ("DB_HOST", "DB_NAME", "DB_USER", "DB_PASSWORD") if not env.get(k)]
        if missing:
            raise ValueError(f"not set: {', '.join(missing)}")
        user, password, db = env["DB_USER"], env["DB_PASSWORD"], env["DB_NAME"]
        host, options = f"{env['DB_HOST']}:{env.get('DB_PORT', '5432')}", f"sslmode={quote_plus(env.get('DB_SSLMODE', 'require'))}"
    args = "&".join(x for x in (options, f"connectTimeout={CONNECT_TIMEOUT_S}") if x)
    return {
        "url": f"jdbc:postgresql://{host}/{db}?{args}", "user": user or "", "password": password or "", "driver": "org.postgresql.Driver",
        "queryTimeout": str(STATEMENT_TIMEOUT_S), "sessionInitStatement": f"SET statement_timeout = '{STATEMENT_TIMEOUT_S}s'",
    }


def feed_query(source: str) -> str:
    """The feed's distinct names, so that the database makes them distinct."""
    table, name, more = FEEDS[source]
    return f"SELECT DISTINCT {', '.join([f'{name} AS plant_name', *more])} FROM {table} WHERE {name} IS NOT NULL"


def distinct_names(df: DataFrame, source: str, name: str, more: tuple[str, ...] = ()) -> DataFrame:
    """The same of a table at hand, in the columns all feeds share."""
    opt = {c: (F.col(c) if c in more else F.lit(None)).cast("double").alias(c) for c in ("latitude", "longitude")}
    code = F.col(name).cast("string") if source == "EIA" else F.lit(None).cast("string")
    return df.where(F.col(name).isNotNull()).select(F.col(name).cast("string").alias("plant_name"), code.alias("plant_code"), F.lit(source).alias("source_system"), *opt.values()).distinct()


def pull_feeds(spark: SparkSession, sources: list[str] | None = None, env: Mapping[str, str] = os.environ) -> DataFrame:
    """Distinct names of the wanted feeds only."""
    options, out = connection(env), None
    for source in [s for s in FEEDS if sources is None or s in sources]:
        df = spark.read.format("jdbc").options(**options).option("query", feed_query(source)).load()
        part = distinct_names(df, source, "plant_name", FEEDS[source][2])
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no known feed is wanted")
    return out


# -- files -------------------------------------------------------------------


def read_csv(spark: SparkSession, path: str, schema: T.StructType, columns: list[str] | None = None) -> DataFrame:
    """CSV with header, quoted line breaks and a stated schema; a missing file gives an empty table."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema).select(columns or schema.names)
    df = spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"', enforceSchema=False)
    return df.select(columns) if columns else df


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet; a missing file gives an empty table."""
    return spark.read.parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def with_order(df: DataFrame, name: str = "ord") -> DataFrame:
    """Adds the rows' order of reading, which later steps call 'first'."""
    return df.withColumn(name, F.monotonically_increasing_id())


# Headers of the curated list of the Indian feed -> names. Fixed values.
CURATED_COLUMNS = {"Type": "type", "DGR plant name": "plant", "GEM unit/phase ID": "unit_id", "State": "state", "Sector": "sector"}


def curated_list(spark: SparkSession, path: str) -> DataFrame:
    """The curated list as :func:`voltlace.plans.stages.curated_match` reads it; rows of a CSV file keep their order."""
    if not path.lower().endswith(".csv"):
        return spark.read.parquet(path)
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"')
    return with_order(raw.select(*[F.col(f"`{k}`").alias(v) for k, v in CURATED_COLUMNS.items()]))


# Headers of the two catalogues' CSV files -> names and types. Fixed values.
UNIT_COLUMNS = {"Unit ID": "unit_id", "Project Name": "name", "Country/Area": "country", "Fuel": "fuel", "Capacity": "capacity", "Technology": "technology", "Latitude": "latitude", "Longitude": "longitude"}
PLANT_COLUMNS = {"name": "name", "country": "country", "latitude": "latitude", "longitude": "longitude"}


def catalogue_file(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """A catalogue as the build reads it: its CSV file as published, or parquet of that shape; a missing file gives an empty one, and says so."""
    schema = T.StructType([T.StructField(n, T.DoubleType() if n in ("latitude", "longitude") else T.StringType()) for n in columns.values()] + [T.StructField("ord", T.LongType())])
    if not exists(spark, path):
        warnings.warn(f"{path} is missing; going on without it", stacklevel=2)
        return spark.createDataFrame([], schema)
    if not path.lower().endswith(".csv"):
        return spark.read.parquet(path)
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"')
    picked = [(F.col(f"`{k}`") if k in raw.columns else F.lit(None)).cast("string").alias(v) for k, v in columns.items()]
    df = with_order(raw.select(*picked))
    return df.withColumns({c: F.col(c).try_cast("double") for c in ("latitude", "longitude")})


# -- tracker files -----------------------------------------------------------

# Tracker headers -> names. Fixed values.
TRACKER_COLUMNS = {
    "Project Name": "project_name", "Unit Name": "unit_name", "Country/Area": "country", "Subnational": "subnational", "Latitude": "latitude", "Longitude": "longitude",
    "Status": "status", "Capacity (MW)": "capacity_mw", "EIA plant + unit ID": "eia_plant_unit_id",
}
# File patterns in the order they are tried.
TRACKER_PATTERNS = ("gcpt_global_*.csv", "gcpt_global_*.xlsx", "*GCPT_Database*.csv", "GCPT*.xlsx", "*EIA*GCPT*crosswalk*.xlsx")


def find_tracker_file(folder: Path) -> Path | None:
    """Newest file of the first pattern that any file fits."""
    for pattern in TRACKER_PATTERNS:
        if files := list(folder.glob(pattern)):
            return max(files, key=lambda p: p.stat().st_mtime)
    return None


def tidy_tracker(df: DataFrame) -> DataFrame:
    """Known headers renamed (a bare Capacity too, if there is no other) and coordinates made numbers."""
    df = df.withColumnsRenamed({k: v for k, v in TRACKER_COLUMNS.items() if k in df.columns})
    if "Capacity" in df.columns and "capacity_mw" not in df.columns:
        df = df.withColumnRenamed("Capacity", "capacity_mw")
    for c in ("latitude", "longitude"):
        if c in df.columns:
            df = df.withColumn(c, F.col(c).cast("string").try_cast("double"))
    return df


class Tracker:
    """Loads the newest tracker file once; filters by country, status and id."""

    def __init__(self, spark: SparkSession, folder: Path):
        self.spark, self.folder, self._data = spark, folder, None

    def load(self, force: bool = False) -> DataFrame:
        """The tidy table, kept for later calls; empty if there is no readable file."""
        if self._data is None or force:
            try:
                path = find_tracker_file(self.folder)
                if path is None:
                    raise FileNotFoundError(self.folder)
                if path.suffix == ".csv":
                    raw = self.spark.read.csv(str(path), header=True, multiLine=True, escape='"')
                else:
                    from voltlace.sources.excel import read_excel

                    raw = read_excel(self.spark, str(path))
                if self._data is not None:
                    self._data.unpersist()
                self._data = with_order(tidy_tracker(raw)).cache()
            except Exception as e:  # noqa: BLE001 - an unreadable file counts as none
                warnings.warn(f"no tracker in {self.folder}: {type(e).__name__}", stacklevel=2)
                return self.spark.createDataFrame([], ", ".join(f"{c} {'double' if c in ('latitude', 'longitude') else 'string'}" for c in TRACKER_COLUMNS.values()) + ", ord long")
        return self._data

    def _where(self, column: str, values: list[str]) -> DataFrame:
        df = self.load()
        return df.where(F.col(column).isin(values)) if column in df.columns else df.limit(0)

    def by_country(self, countries: list[str]) -> DataFrame:
        return self._where("country", countries)

    def by_status(self, statuses: list[str]) -> DataFrame:
        return self._where("status", statuses)

    def coordinates_of(self, ids: list[str]) -> DataFrame:
        return select_existing(self._where("eia_plant_unit_id", ids), ["eia_plant_unit_id", "project_name", "latitude", "longitude"])

    def us_plants(self) -> DataFrame:
        return self.by_country(["United States"])

    def indian_plants(self) -> DataFrame:
        return self.by_country(["India"])

    def european_plants(self) -> DataFrame:
        from voltlace.schema import TRACKER_EUROPE

        return self.by_country(TRACKER_EUROPE)


# -- web pages and archives --------------------------------------------------


def zip_links(pages: DataFrame, html: str, base: Column, first_year: int = 2009) -> DataFrame:
    """(year, url): ZIP links of pages, the first on the page for each year."""
    pattern = r"""(?is)<a\\s[^>]*href\\s*=\\s*["\\']([^"\\']*\\.zip[^"\\']*)["\\'][^>]*>(.*?)</a>"""
    link = F.expr(f"regexp_extract_all({html}, '{pattern.replace(chr(39), chr(92) + chr(39))}', 0)")
    found = pages.select(base.alias("base"), F.posexplode(link).alias("pos", "a"))
    href = F.regexp_extract("a", r"""(?i)href\s*=\s*["']([^"']*)""", 1)
    text = F.regexp_replace(F.regexp_extract("a", r"(?is)>(.*)</a>", 1), "<[^>]*>", "")
    year = F.regexp_extract(F.concat(text, F.lit(" "), href), r"(20\d{2})", 1).try_cast("int")
    root = F.regexp_extract("base", r"^(\w+://[^/]+)", 1)
    folder = F.regexp_extract("base", r"^(.*/)", 1)
    url = F.when(href.rlike(r"^\w+://"), href).when(href.startswith("/"), F.concat(root, href)).otherwise(F.concat(folder, href))
    years = found.select(year.alias("year"), url.alias("url"), "pos").where(F.col("year") >= first_year)
    w = Window.partitionBy("year").orderBy("pos", "url")
    return years.withColumn("rn", F.row_number().over(w)).where("rn = 1").select("year", "url")


def zip_members(spark: SparkSession, path: str, primary: str, fallback: str) -> DataFrame:
    """(path, member, content) of the first member of each archive whose name fits ``primary``, else ``fallback``."""
    import io
    import zipfile

    import pandas as pd

    def members(batches):
        for pdf in batches:
            rows = []
            for p, data in zip(pdf["path"], pdf["content"]):
                with zipfile.ZipFile(io.BytesIO(data)) as z:
                    names = z.namelist()
                    hit = next((n for pat in (primary, fallback) for n in names if re.search(pat, n, re.I)), None)
                    if hit:
                        rows.append((p, hit, z.read(hit)))
            yield pd.DataFrame(rows, columns=["path", "member", "content"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(members, "path string, member string, content binary")


def code_names(frames: DataFrame) -> DataFrame:
    """(plant_code, plant_name): the latest year's name per code, codes as whole numbers; ``frames`` has plant_code, plant_name, year."""
    code = F.col("plant_code").try_cast("double").cast("long")
    return frames.where(code.isNotNull()).groupBy(code.cast("string").alias("plant_code")).agg(F.max_by("plant_name", "year").alias("plant_name")).orderBy(F.col("plant_code").cast("long"))
