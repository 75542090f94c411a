"""Queries over archives read by range and over an index in pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import urls as U
from ..session import own_folder
from ..sources import archives as A
from ..sources import paged_index as P
from .base import HOST, query, t

_SIZE = 100


@query(f"SELECT url, md5(html) AS digest FROM pages WHERE ends_with({HOST}, '.org')")
def range_fetch(spark, sf):
    """Pages archived as one gzip member each; those of a TLD are read by their ranges, as the index names them."""
    index = A.write_archives(t(spark, sf, "pages").select("url", "html"), own_folder(spark, "warc"))
    found = A.fetch_records(index.filter(F.endswith(U.authority(F.col("url")), F.lit(".org"))))
    return found.select("url", F.md5("body").alias("digest"))


@query(f"SELECT url, md5(html) AS digest FROM pages WHERE ends_with({HOST}, '.org') OR ends_with({HOST}, '.com')")
def cached_range_fetch(spark, sf):
    """A first run stores one TLD's pages; a second one of two TLDs reads only what the store doesn't have. Pages with one URL are records of their own."""
    folder = own_folder(spark, "warc")
    index = A.write_archives(t(spark, sf, "pages").select("url", "html"), folder)
    of = lambda *tlds: index.filter(F.rlike(U.authority(F.col("url")), F.lit(r"\.(" + "|".join(tlds) + r")\z")))
    A.fetched_pages(spark, of("org"), f"{folder}/store", A.record_name())
    return A.fetched_pages(spark, of("org", "com"), f"{folder}/store", A.record_name()).select("url", F.md5("html").alias("digest"))


def index_of_pages(spark, sf):
    """Index lines of pages (page_id, page, value): some have another status, some are broken."""
    k = F.col("page_id")
    good = F.to_json(F.struct("url", F.when(k % 7 == 0, "404").otherwise("200").alias("status"), F.when(k % 2 == 0, "eng,fra").alias("languages"), (k * 10).cast("string").alias("warc_record_offset")))
    return t(spark, sf, "pages").select("page_id", F.floor(k / _SIZE).alias("page"), F.when(k % 11 == 0, F.concat(F.lit("{broken "), k.cast("string"))).otherwise(good).alias("value"))


@query("SELECT url, 200 AS status, page_id * 10 AS \"offset\" FROM pages WHERE page_id % 7 <> 0 AND page_id % 11 <> 0")
def paged_index(spark, sf):
    """Pages of an index, each found by the key at the end of the one before; status is tested and fields are chosen in the source."""
    folder = own_folder(spark, "index")
    P.write_index_pages(index_of_pages(spark, sf), folder, "page", "page_id")
    return P.read_index_pages(spark, folder, "url", "status", "offset").filter("status = 200")


@query("SELECT url, CASE WHEN page_id % 7 = 0 THEN 404 ELSE 200 END AS status FROM pages WHERE page_id % 11 <> 0")
def resumed_index(spark, sf):
    """A stream over the index's pages that ends in the middle and is run again when the rest is there: each line comes once."""
    folder = own_folder(spark, "index")
    lines = index_of_pages(spark, sf)
    half = lines.agg(F.floor(F.max("page") / 2)).first()[0]
    kind = "url string, status int"
    for part, more in ((lines.filter(F.col("page") <= half), True), (lines.filter(F.col("page") > half), False)):
        if not part.isEmpty():
            P.write_index_pages(part, f"{folder}/pages", "page", "page_id", more=more, append=True)
        rows = P.stream_index_pages(spark, f"{folder}/pages", "url", "status")
        rows.writeStream.format("parquet").option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(kind).parquet(f"{folder}/rows")
