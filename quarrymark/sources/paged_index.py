"""A crawl index in pages, each of which ends with the key of the next: as a batch source and as a stream that goes on at a key.

Page K is the folder page=K: JSON lines, the last of which may be {"resumeKey": "..."}; the last page has none, or names one that isn't there yet.
The driver follows keys by the ends of files; lines are read where partitions, one for each page, run.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from urllib.parse import unquote

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition, IsNotNull, StringContains, StringEndsWith, StringStartsWith

from .archives import opened

FIELDS = {"url": "string", "status": "int", "languages": "string", "filename": "string", "offset": "bigint", "length": "bigint"}
#: Names that index answers use for a field besides its own (fixed values).
ALSO = {"filename": "warc_filename", "offset": "warc_record_offset", "length": "warc_record_length"}
TAIL = 16 << 10


class _Page(InputPartition):
    def __init__(self, key: str) -> None:
        self.key = key


class _Pages:
    """The page files of a folder."""

    def __init__(self, path: str) -> None:
        self.path = path

    def files(self, key: str) -> list[pafs.FileInfo]:
        """A page's files in the order of their names; none if it isn't there."""
        fs, root = opened(self.path)
        found = fs.get_file_info(pafs.FileSelector(f"{root}/page={key}", allow_not_found=True))
        return sorted((x for x in found if x.is_file and not x.base_name.startswith(("_", "."))), key=lambda x: x.path)

    def next_key(self, key: str) -> str | None:
        """The key that a page ends with, from the last bytes of its last file."""
        fs, _ = opened(self.path)
        for info in reversed(self.files(key)):
            if info.size:
                with fs.open_input_file(info.path) as f:
                    lines = f.read_at(min(TAIL, info.size), max(0, info.size - TAIL)).strip().split(b"\n")
                return resume_key(lines[-1].decode("utf-8", "replace"))
        return None

    def chain(self, key: str | None, stop: str | None = None) -> Iterator[tuple[str, str | None]]:
        """(key, next key) of pages that are there, from one key on and before another. A page that names an earlier one is an error."""
        seen = set()
        while key is not None and key != stop and self.files(key):
            if key in seen:
                raise ValueError(f"page {key} follows itself")
            seen.add(key)
            after = self.next_key(key)
            yield key, after
            key = after

    def lines(self, key: str) -> Iterator[str]:
        fs, _ = opened(self.path)
        for info in self.files(key):
            with fs.open_input_stream(info.path, compression="detect") as f:
                rest = b""
                while piece := f.read(1 << 20):
                    *whole, rest = (rest + piece).split(b"\n")
                    yield from (x.decode("utf-8", "replace") for x in whole)
                if rest:
                    yield rest.decode("utf-8", "replace")


def resume_key(line: str) -> str | None:
    try:
        found = json.loads(line)
    except ValueError:
        return None
    return str(found["resumeKey"]) if isinstance(found, dict) and "resumeKey" in found else None


def parsed(line: str) -> dict | None:
    """A line's fields; None for keys, broken lines and those without a url."""
    try:
        x = json.loads(line)
    except ValueError:
        return None
    if not isinstance(x, dict) or "resumeKey" in x or not isinstance(x.get("url"), str):
        return None
    out = {}
    for name, kind in FIELDS.items():
        v = x.get(name)
        if v is None:
            v = x.get(ALSO.get(name, name))
        if v is not None and kind != "string":
            v = int(v) if isinstance(v, int) or isinstance(v, str) and v.strip().lstrip("-").isdigit() else None
        elif v is not None and not isinstance(v, str):
            v = json.dumps(v)
        out[name] = v
    return out


def _test(f: Filter):
    """A filter as a test of a parsed line, or None where it is left to Spark."""
    name = f.attribute[0] if isinstance(f, EqualTo | In | IsNotNull | StringStartsWith | StringEndsWith | StringContains) and len(f.attribute) == 1 else None
    if name not in FIELDS:
        return None
    if isinstance(f, EqualTo):
        return lambda x: x[name] == f.value
    if isinstance(f, In):
        return lambda x: x[name] in f.value
    if isinstance(f, IsNotNull):
        return lambda x: x[name] is not None
    how = {StringStartsWith: str.startswith, StringEndsWith: str.endswith, StringContains: str.__contains__}[type(f)]
    return lambda x: x[name] is not None and how(x[name], f.value)


class _Lines:
    """Reads a page's rows: those that pass the filters, with the asked fields, at most `limit`."""

    def __init__(self, options: dict, fields: list[str]) -> None:
        self.pages, self.first = _Pages(options["path"]), options.get("start", "0")
        self.fields, self.limit = fields, int(options["limit"]) if "limit" in options else None
        self.filters: list[Filter] = []

    def rows(self, key: str) -> Iterator[tuple]:
        tests = [_test(f) for f in self.filters]
        given = 0
        for line in self.pages.lines(key):
            if self.limit is not None and given >= self.limit:
                return
            x = parsed(line)
            if x is not None and all(t(x) for t in tests):
                given += 1
                yield tuple(x[f] for f in self.fields)


class IndexPages(DataSource):
    """spark.read.format("index_pages"), or readStream, with path and, where wanted, start (the first key), fields (names with commas) and limit (of
    each page; the caller's own limit is over all)."""

    @classmethod
    def name(cls) -> str:
        return "index_pages"

    def _fields(self) -> list[str]:
        names = [x.strip() for x in self.options.get("fields", ",".join(FIELDS)).split(",")]
        if unknown := [x for x in names if x not in FIELDS]:
            raise ValueError(f"an index has no {', '.join(unknown)}")
        return names

    def schema(self) -> str:
        return ", ".join(f"{x} {FIELDS[x]}" for x in self._fields())

    def reader(self, schema) -> DataSourceReader:
        return _BatchReader(_Lines(self.options, self._fields()))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(_Lines(self.options, self._fields()))


class _BatchReader(DataSourceReader):
    def __init__(self, lines: _Lines) -> None:
        self.lines = lines

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if _test(f) is None:
                yield f
            else:
                self.lines.filters.append(f)

    def partitions(self) -> list[InputPartition]:
        return [_Page(key) for key, _ in self.lines.pages.chain(self.lines.first)] or [_Page("")]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        return self.lines.rows(partition.key) if partition.key else iter(())


class _StreamReader(DataSourceStreamReader):
    """Its offset is the key of the next page to read, with the number of pages read before it; "" after the last."""

    def __init__(self, lines: _Lines) -> None:
        self.lines = lines
        self.at = self.initialOffset()

    def initialOffset(self) -> dict:
        return {"key": self.lines.first, "page": 0}

    def latestOffset(self) -> dict:
        at = dict(self.at)
        for _, after in self.lines.pages.chain(at["key"] or None):
            at = {"key": after or "", "page": at["page"] + 1}
        self.at = at
        return at

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if end["page"] > self.at["page"]:
            self.at = dict(end)
        return [_Page(key) for key, _ in self.lines.pages.chain(start["key"] or None, end["key"] or None)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        return self.lines.rows(partition.key)

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


def _source(reader, path: str, fields: tuple[str, ...], start: str, limit: int | None):
    reader = reader.format("index_pages").option("path", path).option("start", start)
    reader = reader.option("fields", ",".join(fields)) if fields else reader
    return (reader if limit is None else reader.option("limit", limit)).load()


def read_index_pages(spark: SparkSession, path: str, *fields: str, start: str = "0", limit: int | None = None) -> DataFrame:
    """The index's lines from page `start` on, with some of its fields; filters on them are tested where lines are parsed.

    limit: of rows in all; each page gives no more than that either.
    """
    spark.dataSource.register(IndexPages)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    rows = _source(spark.read, path, fields, start, limit)
    return rows if limit is None else rows.limit(limit)


def stream_index_pages(spark: SparkSession, path: str, *fields: str, start: str = "0") -> DataFrame:
    """The same as a stream: each run reads the pages that are there, and the next goes on at the key where it ended."""
    spark.dataSource.register(IndexPages)
    return _source(spark.readStream, path, fields, start, None)


def write_index_pages(lines: DataFrame, path: str, page: str, order: str, value: str = "value", more: bool = False, append: bool = False) -> None:
    """lines as pages: a folder for each number in `page`, its lines in order and then the next number's key; the largest has one only if more are to come."""
    last = lines.agg(F.max(page)).first()[0]
    keys = lines.select(page).distinct().filter((F.col(page) < F.lit(last)) | F.lit(more)).select(page, F.lit(1).alias("_last"), F.lit(0).cast("long").alias("_at"), F.to_json(F.struct((F.col(page) + 1).cast("string").alias("resumeKey"))).alias("value"))
    rows = lines.select(page, F.lit(0).alias("_last"), F.col(order).cast("long").alias("_at"), F.col(value).alias("value")).unionByName(keys)
    rows.repartition(F.col(page)).sortWithinPartitions(page, "_last", "_at").select(F.col(page).alias("page"), "value").write.mode("append" if append else "overwrite").partitionBy("page").text(path)
