import gzip
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, StringStartsWith

from quarrymark.sources import archives as A
from quarrymark.sources import paged_index as P


def member(body: bytes, size: int | None = None) -> bytes:
    http = b"HTTP/1.1 200 OK\r\n\r\n" + body
    return gzip.compress(b"WARC/1.0\r\nContent-Length: %d\r\n\r\n" % (len(http) if size is None else size) + http + b"\r\n\r\n")


@pytest.fixture
def archive(tmp_path):
    """A sparse file of 3 GB with records far apart, and one that is damaged."""
    path, at = f"{tmp_path}/a.warc.gz", {}
    with open(path, "wb") as f:
        for name, where, blob in (("first", 0, member("é body".encode())), ("near", 500, member(b"near")), ("far", 2_900_000_000, member(b"\xff far")), ("bad", 1_000_000, b"\x1f\x8b" + b"x" * 50), ("plain", 2_000_000, gzip.decompress(member(b"plain"))), ("empty", 3_000_000, member(b"")), ("headless", 4_000_000, gzip.compress(b"WARC/1.0\r\n\r\nno more"))):
            f.seek(where)
            f.write(blob)
            at[name] = (where, len(blob))
    return path, at


def test_records_are_read_by_range(spark, archive, tmp_path):
    path, at = archive
    rows = [(n, path, *at[n]) for n in at] + [("again", path, *at["near"]), ("beyond", path, os.path.getsize(path) - 5, 100), ("gone", f"{tmp_path}/none.gz", 0, 10), ("null", None, 0, 10), ("no length", path, 5, None), ("negative", path, -5, 10)]
    df = spark.createDataFrame(rows, "name string, file string, offset long, length long")
    got = {r["name"]: (r["body"], r["error"]) for r in A.fetch_records(df).collect()}
    assert got == {
        "first": ("é body", None), "near": ("near", None), "again": ("near", None), "far": ("� far", None), "bad": (None, "not inflated"), "plain": ("plain", None), "empty": ("", None), "headless": (None, "no body"),
        "beyond": (None, "short"), "gone": (None, "unread: FileNotFoundError"), "null": (None, None), "no length": (None, None), "negative": (None, None),
    }
    read = A.plan_ranges(df).filter(F.col("file") == path).agg(F.sum("size")).first()[0]
    assert read < 2000  # of 2.9 GB


def test_spans(spark):
    rows = [("f", 0, 10), ("f", 15, 10), ("f", 15, 10), ("f", 200, 10), ("f", 205, 3), ("f", 999, 50), ("f", 1001, 5), ("g", 0, 10)]
    got = A.plan_ranges(spark.createDataFrame(rows, "file string, offset long, length long"), gap=20, span=1000)
    assert sorted((r.file, r.start, r.size, [tuple(x) for x in r.ranges]) for r in got.collect()) == [("f", 0, 25, [(0, 10), (15, 10)]), ("f", 200, 10, [(200, 10), (205, 3)]), ("f", 999, 50, [(999, 50)]), ("f", 1001, 5, [(1001, 5)]), ("g", 0, 10, [(0, 10)])]


def test_no_records(spark, tmp_path):
    none = spark.createDataFrame([], "url string, file string, offset long, length long")
    assert A.fetch_records(none).count() == 0
    assert A.fetched_pages(spark, none, f"{tmp_path}/store").count() == 0
    index = A.write_archives(spark.createDataFrame([], "url string, html string"), f"{tmp_path}/w")
    assert index.count() == 0


def test_round_trip_and_store(spark, tmp_path):
    pages = spark.createDataFrame([(f"http://a/{i}", "é" * i) for i in range(40)] + [(None, None), ("http://big", "x" * 9_000_000)], "url string, html string").repartition(3)
    index = A.write_archives(pages, f"{tmp_path}/w")
    assert sorted(A.fetch_records(index).select("url", "body").collect(), key=str) == sorted(pages.select("url", F.coalesce("html", F.lit("")).alias("body")).collect(), key=str)
    store = f"{tmp_path}/store"
    some = index.filter("url like '%1'")
    assert A.fetched_pages(spark, some, store).count() == 4
    runs = set(os.listdir(store))
    for name in os.listdir(f"{tmp_path}/w/archives"):  # what is stored isn't read again
        os.truncate(f"{tmp_path}/w/archives/{name}", 0)
    assert A.fetched_pages(spark, some, store).count() == 4 and len(set(os.listdir(store)) - runs) == 1
    assert A.fetched_pages(spark, index.filter("url like '%a/2'"), store).count() == 0


def written_pages(path, pages):
    for key, lines in pages.items():
        os.makedirs(f"{path}/page={key}", exist_ok=True)
        with open(f"{path}/page={key}/part-0.txt", "w") as f:
            f.write("\n".join(lines) + "\n")


def answer(i, **more):
    return json.dumps({"url": f"http://h/{i}", "status": "200" if i % 2 else 404, "warc_filename": "f", "warc_record_offset": str(i), "length": i, **more})


PAGES = {"0": [answer(0), "{broken", answer(1), '"text"', '{"resumeKey": "k 1"}'], "k 1": [answer(2, languages=["eng"]), '{"resumeKey": "k2"}'], "k2": [answer(3), answer(4), '{"status": "200"}', '{"resumeKey": "later"}']}


def test_paged_index(spark, tmp_path):
    written_pages(tmp_path, PAGES)
    rows = P.read_index_pages(spark, str(tmp_path))
    assert sorted(map(tuple, rows.collect())) == [(f"http://h/{i}", 200 if i % 2 else 404, '["eng"]' if i == 2 else None, "f", i, i) for i in range(5)]
    assert rows.rdd.getNumPartitions() == 3
    assert [r.url for r in P.read_index_pages(spark, str(tmp_path), "url", start="k2").collect()] == ["http://h/3", "http://h/4"]
    assert P.read_index_pages(spark, str(tmp_path), limit=2).count() == 2
    assert P.read_index_pages(spark, f"{tmp_path}/none").count() == 0
    with pytest.raises(Exception, match="no such"):
        P.read_index_pages(spark, str(tmp_path), "no such")


def test_filters_and_fields_reach_the_source(spark, tmp_path):
    written_pages(tmp_path, PAGES)
    rows = P.read_index_pages(spark, str(tmp_path), "url", "status", "length").filter("status = 200 AND url LIKE 'http://h/%' AND length > 1")
    plan = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(rows._jdf.queryExecution(), "formatted")
    assert "PushedFilters" in plan and "EqualTo(status,200)" in plan and "StringStartsWith(url,http://h/)" in plan and "languages" not in plan
    assert [r.url for r in rows.collect()] == ["http://h/3"]
    reader = P._BatchReader(P._Lines({"path": str(tmp_path)}, ["url"]))
    left = list(reader.pushFilters([EqualTo(("status",), 404), GreaterThan(("length",), 1), In(("length",), (0, 2)), IsNotNull(("url",)), StringStartsWith(("url",), "http://h/2"), EqualTo(("props", "k"), 1)]))
    assert [type(f) for f in left] == [GreaterThan, EqualTo]
    assert [x for p in reader.partitions() for x in reader.read(p)] == [("http://h/2",)]


def test_a_run_goes_on_at_the_key(spark, tmp_path):
    pages, out = f"{tmp_path}/pages", f"{tmp_path}/out"

    def run():
        rows = P.stream_index_pages(spark, pages, "url")
        rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
        return sorted(r.url for r in spark.read.schema("url string").parquet(out).collect())

    written_pages(pages, {k: PAGES[k] for k in ("0", "k 1")})
    assert run() == [f"http://h/{i}" for i in range(3)]
    assert run() == [f"http://h/{i}" for i in range(3)]
    written_pages(pages, {"k2": PAGES["k2"]})
    assert run() == [f"http://h/{i}" for i in range(5)]
    written_pages(pages, {"later": [answer(9)]})
    assert run() == [f"http://h/{i}" for i in (0, 1, 2, 3, 4, 9)]
    assert run() == [f"http://h/{i}" for i in (0, 1, 2, 3, 4, 9)]


def test_pages_in_a_circle(tmp_path):
    written_pages(tmp_path, {"0": ['{"resumeKey": "1"}'], "1": ['{"resumeKey": "0"}']})
    with pytest.raises(ValueError, match="follows itself"):
        list(P._Pages(str(tmp_path)).chain("0"))


def test_long_last_lines_and_many_files(tmp_path):
    os.makedirs(f"{tmp_path}/page=0")
    for name, text in (("part-0", answer(1) + "\n"), ("part-1", answer(2, more="x" * 100_000) + '\n{"resumeKey": "b"}'), ("part-2", ""), ("_SUCCESS", "")):
        with open(f"{tmp_path}/page=0/{name}", "w") as f:
            f.write(text)
    pages = P._Pages(str(tmp_path))
    assert pages.next_key("0") == "b" and [x["length"] for x in map(P.parsed, pages.lines("0")) if x] == [1, 2]
