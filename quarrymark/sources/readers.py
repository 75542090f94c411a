"""Sources: crawl indexes, N-Quads, JSON lines, results, archives' bodies and sinks. Columns are declared, never inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

INDEX = "url string, status string, languages string, filename string, warc_filename string, offset string, warc_record_offset string, length string, warc_record_length string"
CANDIDATE = "url string, schema_type string, probable_type string, source string, property_count int"
MANIFEST = "url string, html_path string, wdc_jsonld string, schema_type string, property_count int, source string, screenshot_path string"
GENERATED = "url string, schema_type_hint string, generated_jsonld string, valid boolean, quality_score double, schema_types array<string>, property_count int, errors array<string>"


def index_lines(lines: DataFrame) -> DataFrame:
    """Index answers, one JSON object or plain http URL a line: url, status, languages, filename, offset, length. Others go."""
    x = F.from_json("value", INDEX)
    rows = lines.select(F.coalesce(x["url"], F.when(F.startswith("value", F.lit("http")), F.trim("value"))).alias("url"), x["status"].try_cast("int").alias("status"), x["languages"].alias("languages"), F.coalesce(x["filename"], x["warc_filename"]).alias("filename"), F.coalesce(x["offset"], x["warc_record_offset"]).try_cast("bigint").alias("offset"), F.coalesce(x["length"], x["warc_record_length"]).try_cast("bigint").alias("length"))
    return rows.filter("url IS NOT NULL")


def read_index(spark: SparkSession, path: str, crawl: str | None = None, subset: str | None = "warc") -> DataFrame:
    """A hive-partitioned Parquet index; crawl and subset prune folders. Asking for one that the index isn't partitioned by is an error."""
    rows = spark.read.parquet(path)
    for name, value in (("crawl", crawl), ("subset", subset)):
        if value is not None:
            if name not in rows.columns:
                raise ValueError(f"the index at {path} has no {name}")
            rows = rows.filter(F.col(name) == value)
    return rows


def catalog_query(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """SQL over catalog tables, and over frames that it names in braces; the session's views stay as they are."""
    return spark.sql(sql, **tables)


def page_urls(lines: DataFrame, quota: int, english: bool = True) -> DataFrame:
    """Of N-Quads lines (file, line_no, line) the URLs of subjects, in each file's first 2 * quota lines that have one; repeats stay."""
    from ..functions.urls import english_tld
    from ..operators.sampling import capped

    url = F.regexp_extract("line", "^<([^>]+)>", 1)
    rows = lines.select("file", "line_no", url.alias("url")).filter(F.startswith("url", F.lit("http")))
    return capped(rows.filter(english_tld(F.col("url"))) if english else rows, "file", 2 * quota, "line_no")


def link_iris(lines: DataFrame) -> DataFrame:
    """Every <http...> token of N-Quads lines but for the vocabulary's own."""
    found = lines.select(*lines.columns, F.explode(F.regexp_extract_all("line", F.lit("<(https?://[^>]+)>"), F.lit(1))).alias("url"))
    return found.filter(~F.startswith("url", F.lit("http://schema.org")) & ~F.startswith("url", F.lit("https://schema.org"))).drop("line")


def to_fetch(records: DataFrame, cached: DataFrame, *order: str, most: int | None = None) -> DataFrame:
    """Records (url) whose file name isn't cached (file_name) yet; of the first `most` records, where given."""
    from ..functions.urls import file_name

    some = records.orderBy(*order).limit(most) if most is not None else records
    return some.withColumn("file_name", file_name(F.col("url"), "plain")).join(cached.select("file_name").distinct(), "file_name", "left_anti")


def read_nquads(spark: SparkSession, *paths: str) -> DataFrame:
    """file, block, line_no, line. Plain files are read in splits, gzip files by one task each; (block, line_no) orders a file's lines,
    block being where the line's split begins."""
    lines = spark.read.text(list(paths)).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))
    return lines.select("file", "block", F.monotonically_increasing_id().alias("line_no"), "line")


def read_parts(spark: SparkSession, path: str, parts: DataFrame, part: str = "part") -> DataFrame:
    """file, block, line_no, line and part of the quads in the folders part=N of path that parts (part) names; no other file is opened.

    The folders are pruned when the join's small side is known, which is broadcast: a row for each part.
    """
    wanted = F.broadcast(parts.select(part).distinct())
    rows = spark.read.schema(f"value string, {part} bigint").text(path)
    kept = rows.select("value", part, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")).join(wanted, part)
    return kept.select("file", "block", F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("line"), part)


def gzip_files(spark: SparkSession, path: str) -> DataFrame:
    """Files and whether they begin as gzip does."""
    return spark.read.format("binaryFile").load(path).select("path", F.startswith("content", F.unhex(F.lit("1F8B"))).alias("is_gzip"))


def read_json_lines(spark: SparkSession, kind: str, *paths: str, strict: bool = False) -> DataFrame:
    return spark.read.schema(kind).json(list(paths), mode="FAILFAST" if strict else "DROPMALFORMED")


def read_results(spark: SparkSession, path: str, kind: str = GENERATED) -> DataFrame:
    """A folder of one JSON file per page, with its file's path."""
    return spark.read.schema(kind).json(path, multiLine=True).select("*", F.col("_metadata.file_path").alias("file"))


def record_body(record: Column) -> Column:
    """An archive record's body: what follows its second empty line, or null with fewer."""
    pieces = F.split(record, "\r\n\r\n", 3)
    return F.when(F.size(pieces) == 3, pieces[2])


def write_json_lines(rows: DataFrame, path: str, append: bool = False) -> None:
    rows.write.mode("append" if append else "overwrite").json(path)


def append_new(rows: DataFrame, path: str, key: str, kind: str) -> None:
    """Append rows whose key isn't in the pool at path yet."""
    from ..operators.sampling import without

    write_json_lines(without(rows, read_json_lines(rows.sparkSession, kind, path), key), path, append=True)


def write_keyed(rows: DataFrame, path: str, key: str = "url", buckets: int = 256) -> None:
    """Results by the md5 of their key, a folder for each bucket of it, rather than a file for each row."""
    h = F.md5(F.col(key))
    rows.select("*", h.alias("key_hash"), (F.conv(F.substring(h, 1, 4), 16, 10).cast("int") % buckets).alias("bucket")).repartition("bucket").write.mode("overwrite").partitionBy("bucket").json(path)
