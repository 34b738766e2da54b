"""A data source of scraped records: JSON lines in a landing folder by day, read with their faults.

Registered as ``landing``: ``spark.read.format("landing").load(folder)`` gives every line with its day and store, and says of a
broken one why it is; ``records`` and ``quarantine`` tell the good from the broken. Each file is a task of its own, and a
filter on the day is taken over by the source, so that files of other days are not opened.
"""

from __future__ import annotations

import json
import posixpath
import re
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

SCHEMA = "day date, store string, item string, name string, price double, currency string, file string, line long, raw string, fault string"
DAY = re.compile(r"day=(\d{4}-\d{2}-\d{2})(?:/|$)")
BATCH = 4096
_FORM = pa.schema([("day", pa.date32()), ("store", pa.string()), ("item", pa.string()), ("name", pa.string()), ("price", pa.float64()), ("currency", pa.string()), ("file", pa.string()), ("line", pa.int64()), ("raw", pa.string()), ("fault", pa.string())])
_KEEPS = {EqualTo: lambda d, v: d == v, GreaterThan: lambda d, v: d > v, GreaterThanOrEqual: lambda d, v: d >= v, LessThan: lambda d, v: d < v, LessThanOrEqual: lambda d, v: d <= v, In: lambda d, v: d in v}


def read_line(text: str) -> tuple[dict, str | None]:
    """A line's record and its fault: no JSON object, no item, or a price that is no positive number."""
    try:
        found = json.loads(text)
    except ValueError:
        return {}, "no JSON"
    if not isinstance(found, dict):
        return {}, "no record"
    if found.get("item") in (None, ""):
        return found, "no item"
    price = found.get("price")
    if isinstance(price, bool) or not isinstance(price, int | float) or not 0 < price < float("inf"):
        return found, "no price"
    return found, None


@dataclass
class LandedFile(InputPartition):
    path: str
    day: str


class LandingReader(DataSourceReader):
    """Lists files by day; tasks read one each."""

    def __init__(self, folder: str):
        self.folder, self.wanted = folder, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes filters on the day over; Spark does the others."""
        for f in filters:
            if type(f) in _KEEPS and f.attribute == ("day",) and f.value is not None:
                self.wanted.append((type(f), f.value))
            else:
                yield f

    def partitions(self) -> list[LandedFile]:
        import datetime

        system, folder = FileSystem.from_uri(quote(self.folder, safe=":/"))
        out = []
        for found in system.get_file_info(FileSelector(folder, recursive=True)):
            day = DAY.search(unquote(found.path))
            if not found.is_file or not day or posixpath.basename(found.path).startswith(("_", ".")):
                continue
            at = datetime.date.fromisoformat(day[1])
            if all(_KEEPS[kind](at, value) for kind, value in self.wanted):
                out.append(LandedFile(found.path, day[1]))
        return sorted(out, key=lambda f: f.path) or [LandedFile("", "")]

    def read(self, partition: LandedFile) -> Iterator[pa.RecordBatch]:
        import datetime

        if not partition.path:
            return
        system, _ = FileSystem.from_uri(quote(self.folder, safe=":/"))
        day, rows = datetime.date.fromisoformat(partition.day), []
        with system.open_input_stream(partition.path) as stream:
            for number, text in enumerate(_lines(stream), 1):
                if not text.strip():
                    continue
                found, fault = read_line(text)
                said = {c: found[c] if isinstance(found.get(c), str) else None if found.get(c) is None else str(found[c]) for c in ("store", "item", "name", "currency")}
                price = found.get("price")
                rows.append({**said, "day": day, "price": float(price) if fault is None else None, "file": posixpath.basename(partition.path), "line": number, "raw": text if fault else None, "fault": fault})
                if len(rows) == BATCH:
                    yield pa.RecordBatch.from_pylist(rows, _FORM)
                    rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _FORM)


def _lines(stream) -> Iterator[str]:
    """Lines of a file that may be of any size."""
    rest = b""
    while piece := stream.read(1 << 20):
        *whole, rest = (rest + piece).split(b"\n")
        for line in whole:
            yield line.decode("utf-8", "replace")
    if rest:
        yield rest.decode("utf-8", "replace")


class LandingSource(DataSource):
    """``landing``: JSON lines below ``day=YYYY-MM-DD`` folders."""

    @classmethod
    def name(cls) -> str:
        return "landing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LandingReader:
        return LandingReader(self.options["path"])


def landed(spark: SparkSession, folder: str) -> DataFrame:
    """All lines of a landing folder, good and broken."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(LandingSource)
    return spark.read.format("landing").load(folder)


def records(lines: DataFrame) -> DataFrame:
    return lines.where("fault IS NULL").drop("raw", "fault")


def quarantine(lines: DataFrame) -> DataFrame:
    return lines.where("fault IS NOT NULL").select("day", "file", "line", "fault", "raw")
