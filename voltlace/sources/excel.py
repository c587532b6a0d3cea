"""Excel source: a Python data source over the workbook's own XML, without further packages."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships"}


def _column(ref: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", ref).group():
        n = n * 26 + ord(c) - 64
    return n - 1


def sheet_rows(data: bytes, sheet: str | None = None) -> Iterator[list[str | None]]:
    """Rows of a sheet (the first by default) as texts."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", _NS)]
        book = ET.fromstring(z.read("xl/workbook.xml"))
        rels = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        sheets = {s.get("name"): rels[s.get(f"{{{_NS['r']}}}id")] for s in book.find("m:sheets", _NS)}
        if sheet is not None and sheet not in sheets:
            raise KeyError(f"no sheet {sheet!r}")
        target = sheets[sheet] if sheet is not None else next(iter(sheets.values()))
        target = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
        at = 0
        for row in ET.fromstring(z.read(target)).iter(f"{{{_NS['m']}}}row"):
            number = int(row.get("r", at + 1))
            while at < number - 1:
                yield []
                at += 1
            cells: list[str | None] = []
            for k, c in enumerate(row.findall("m:c", _NS)):
                i = _column(c.get("r")) if c.get("r") else k
                cells += [None] * (i + 1 - len(cells))
                v = c.find("m:v", _NS)
                if c.get("t") == "s" and v is not None:
                    cells[i] = shared[int(v.text)]
                elif c.get("t") == "inlineStr":
                    cells[i] = "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t"))
                elif v is not None:
                    cells[i] = v.text
            at = number
            yield cells


def table_of(data: bytes, sheet: str | None = None, header_row: int = 0) -> tuple[list[str], list[list[str | None]]]:
    """Header and rows below ``header_row`` (counted from 0); rows without any value are left out."""
    rows = list(sheet_rows(data, sheet))
    header = [(h or f"_c{i}").strip() for i, h in enumerate(rows[header_row])]
    body = [[*r, *[None] * (len(header) - len(r))][: len(header)] for r in rows[header_row + 1 :]]
    return header, [r for r in body if any(x is not None for x in r)]


def plant_frame(data: bytes, sheet: str = "Page 6 Plant Frame", header_rows: tuple[int, ...] = (3, 4, 5)) -> list[tuple[str, str | None]] | None:
    """(plant id, plant name) of the first header row that has both, under any of their headers; ids once, in order."""
    for h in header_rows:
        try:
            header, rows = table_of(data, sheet, h)
        except (KeyError, IndexError):
            continue
        keys = [x.lower().replace(" ", "") for x in header]
        ids = [i for i, k in enumerate(keys) if k in ("plantid", "plantcode")]
        names = [i for i, k in enumerate(keys) if k == "plantname"]
        if ids and names:
            first: dict[str, str | None] = {}
            for r in rows:
                if r[ids[-1]] is not None:
                    first.setdefault(r[ids[-1]], r[names[-1]])
            return list(first.items())
    return None


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.schema, self.options = schema, options

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.options["path"].split(",")]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        with open(partition.value.removeprefix("file:"), "rb") as f:
            header, rows = table_of(f.read(), self.options.get("sheet"), int(self.options.get("headerrow", "0")))
        at = [header.index(n) if n in header else None for n in self.schema.names]
        for r in rows:
            yield tuple(None if i is None else r[i] for i in at)


class ExcelSource(DataSource):
    """Format ``workbook``: options path (several by comma), sheet, headerRow; all columns are texts."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> StructType:
        with open(self.options["path"].split(",")[0].removeprefix("file:"), "rb") as f:
            header, _ = table_of(f.read(), self.options.get("sheet"), int(self.options.get("headerrow", "0")))
        return StructType([StructField(h, StringType()) for h in header])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(schema, {k.lower(): v for k, v in self.options.items()})


def read_excel(spark: SparkSession, path: str, sheet: str | None = None, skip_rows: int = 0, columns: list[str] | None = None) -> DataFrame:
    spark.dataSource.register(ExcelSource)
    reader = spark.read.format("workbook").option("headerRow", str(skip_rows))
    if sheet is not None:
        reader = reader.option("sheet", sheet)
    df = reader.option("path", path).load()
    return df.select(columns) if columns else df
