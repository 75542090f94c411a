"""Archives whose records are one gzip member each, read by file, offset and length, and nothing between.

plan_ranges() merges ranges that lie close together into spans, as a table; the source `record_ranges` has one partition for each file of that
table, so the driver lists plan files and never sees a range. Files are opened through Arrow's file systems, by URI.
"""

from __future__ import annotations

import time
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..session import own_folder

RANGE = ["file", "offset", "length"]
RECORD = "file string, offset bigint, length bigint, body string, error string"
#: Bytes between two ranges that are read along rather than skipped, bytes of a span, and of a task.
GAP, SPAN, TASK = 64 << 10, 8 << 20, 128 << 20
#: Bytes of bodies given to Spark together.
BATCH = 4 << 20
RETRIES = 3


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system of a path or URI, and the path in it."""
    return pafs.FileSystem.from_uri(path) if "://" in path else pafs.FileSystem.from_uri("file://" + path.removeprefix("file:"))


def write_archives(pages: DataFrame, path: str, url: str = "url", html: str = "html") -> DataFrame:
    """A file of archive records for each partition of pages, and their index (url, file, offset, length), which is stored beside them.

    A task that runs again writes a file of its own, and the index has the rows of the attempt that counted. Null url or html is empty.
    """
    kind = "url string, file string, offset bigint, length bigint"
    archives = f"{path}/archives"
    files, root = opened(archives)
    files.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = opened(archives)
        name = f"{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
        at = 0
        with files.open_output_stream(f"{root}/{name}", compression=None) as out:
            for batch in batches:
                rows = []
                for u, h in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                    body = (h or "").encode()
                    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + body
                    head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: {u or ''}\r\nContent-Length: {len(http)}\r\n\r\n"
                    z = zlib.compressobj(wbits=31)
                    member = z.compress(head.encode() + http + b"\r\n\r\n") + z.flush()
                    out.write(member)
                    rows.append((u, f"{archives}/{name}", at, len(member)))
                    at += len(member)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)], ["url", "file", "offset", "length"])

    spark = pages.sparkSession
    pages.select(url, html).mapInArrow(write, kind).write.mode("overwrite").parquet(f"{path}/index")
    return spark.read.schema(kind).parquet(f"{path}/index")


def plan_ranges(records: DataFrame, gap: int = GAP, span: int = SPAN) -> DataFrame:
    """Spans of files that cover the records' ranges (file, offset, length): file, start, size, ranges (offset, length), sorted.

    Ranges less than `gap` bytes apart share a span if they begin in the same stretch of `span` bytes, so that the records of one large file are many
    spans. Repeated ranges are read once; rows with a null or negative number, or no bytes, are none.
    """
    rows = records.select("file", F.col("offset").cast("long").alias("offset"), F.col("length").cast("long").alias("length")).filter("file IS NOT NULL AND offset >= 0 AND length > 0").distinct()
    rows = rows.withColumn("stretch", F.floor(F.col("offset") / span))
    w = Window.partitionBy("file", "stretch").orderBy("offset", "length")
    reach = F.max(F.col("offset") + F.col("length")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = (reach.isNull() | (F.col("offset") > reach + gap)).cast("int")
    rows = rows.withColumn("opens", opens).withColumn("part", F.sum("opens").over(w))
    own = rows.groupBy("file", "stretch", "part").agg(F.min("offset").alias("start"), F.max(F.col("offset") + F.col("length")).alias("upto"), F.array_sort(F.collect_list(F.struct("offset", "length"))).alias("ranges"))
    return own.select("file", "start", (F.col("upto") - F.col("start")).alias("size"), "ranges")


class _PlanFile(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class RecordRanges(DataSource):
    """spark.read.format("record_ranges").load(plan), plan being a Parquet table of plan_ranges()."""

    @classmethod
    def name(cls) -> str:
        return "record_ranges"

    def schema(self) -> str:
        return RECORD

    def reader(self, schema) -> DataSourceReader:
        return _RangeReader(self.options["path"])


class _RangeReader(DataSourceReader):
    def __init__(self, plan: str) -> None:
        self.plan = plan

    def partitions(self) -> list[InputPartition]:
        files, root = opened(self.plan)
        return [_PlanFile(x.path) for x in files.get_file_info(pafs.FileSelector(root)) if x.path.endswith(".parquet")] or [_PlanFile("")]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        plan_files, _ = opened(self.plan)
        done: list[tuple] = []
        held = 0
        with plan_files.open_input_file(partition.path) as source:
            for batch in pq.ParquetFile(source).iter_batches(256):
                for span in batch.to_pylist():
                    for row in read_span(span["file"], span["start"], span["size"], [(r["offset"], r["length"]) for r in span["ranges"]]):
                        done.append(row)
                        held += len(row[3] or "")
                        if held > BATCH:
                            yield _rows(done)
                            done, held = [], 0
        if done:
            yield _rows(done)


def _rows(done: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], [*RANGE, "body", "error"])


def read_span(file: str, start: int, size: int, ranges: list[tuple[int, int]]) -> Iterator[tuple]:
    """(file, offset, length, body, error) of each range in a span, which is one read; a file that can't be read after some attempts is each range's error."""
    for attempt in range(RETRIES):
        try:
            files, path = opened(file)
            with files.open_input_file(path) as source:
                blob = source.read_at(size, start)
            break
        except OSError as x:
            if attempt + 1 == RETRIES:
                for offset, length in ranges:
                    yield file, offset, length, None, f"unread: {type(x).__name__}"
                return
            time.sleep(0.1 * 4**attempt)
    for offset, length in ranges:
        own = blob[offset - start : offset - start + length]
        body, error = record_text(own) if len(own) == length else (None, "short")
        yield file, offset, length, body, error


def record_text(member: bytes) -> tuple[str | None, str | None]:
    """The body of an archive record in UTF-8, bytes that aren't replaced, and why there is none. A member without gzip's first bytes is taken as it is."""
    if member[:2] == b"\x1f\x8b":
        try:
            member = zlib.decompress(member, wbits=31)
        except zlib.error:
            return None, "not inflated"
    head = member.find(b"\r\n\r\n")
    http = member.find(b"\r\n\r\n", head + 4) if head >= 0 else -1
    if http < 0:
        return None, "no body"
    size = next((int(v) for k, _, v in (x.partition(b":") for x in member[:head].split(b"\r\n")) if k.strip().lower() == b"content-length" and v.strip().isdigit()), None)
    return member[http + 4 : None if size is None else head + 4 + size].decode("utf-8", "replace"), None


def fetch_records(records: DataFrame, gap: int = GAP, span: int = SPAN, task: int = TASK) -> DataFrame:
    """records (file, offset, length) with body and error of the ranges they name; rows that name none get null in both.

    Only the spans are read, each once. A failed range has a null body and says why in error: it stops nothing.
    """
    spark = records.sparkSession
    spark.dataSource.register(RecordRanges)
    plan = f"{own_folder(spark, 'ranges')}/plan"
    spans = plan_ranges(records, gap, span).persist()
    size = spans.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    spans.repartitionByRange(max(1, -(-size // task)), "file", "start").sortWithinPartitions("file", "start").write.parquet(plan)
    spans.unpersist()
    found = spark.read.format("record_ranges").load(plan)
    return records.join(found, RANGE, "left")


def record_name() -> Column:
    """A name of its own for each record (file, offset)."""
    return F.concat_ws(":", "file", F.col("offset").cast("string"))


def fetched_pages(spark: SparkSession, records: DataFrame, store: str, name: Column | None = None) -> DataFrame:
    """url, html and file of records (url, file, offset, length), from the store where their file name is there already, and else read by range
    and added to it.

    The store is Parquet with a folder for each run, so that what is there isn't written again. Of several records of one file name the first by (file,
    offset) counts, as does the first stored. name: the file name, else that of the url; record_name() keeps every record of a url.
    """
    from ..functions.urls import file_name

    kind = "file_name string, url string, html string, file string"
    files, root = opened(store)
    there = files.get_file_info(root).type == pafs.FileType.Directory
    cached = spark.read.schema(kind).parquet(f"{store}/run=*") if there else spark.createDataFrame([], kind)
    named = records.withColumn("file_name", file_name(F.col("url"), "plain") if name is None else name)
    wanted = named.select("file_name").distinct()
    new = named.join(cached.select("file_name").distinct(), "file_name", "left_anti")
    one = new.groupBy("file_name").agg(F.min_by(F.struct("url", *RANGE), F.struct("file", "offset", "length")).alias("r")).select("file_name", "r.*")
    got = fetch_records(one).filter("body IS NOT NULL").select("file_name", "url", F.col("body").alias("html"), "file")
    got.write.parquet(f"{store}/run={uuid.uuid4().hex}")
    all_stored = spark.read.schema(kind).parquet(f"{store}/run=*")
    return all_stored.join(wanted, "file_name", "left_semi").drop("file_name")
