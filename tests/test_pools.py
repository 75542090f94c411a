import glob
import json
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quarrymark.functions import nquads as N
from quarrymark.functions.urls import iri, local_name
from quarrymark.operators import assemble as A
from quarrymark.operators import report as G
from quarrymark.sources import udtf
from quarrymark.sources.keyed_pool import KeyedPool
from quarrymark.streaming import pacing

KIND = "k string, v int"


def pool_rows(pool):
    return sorted(map(tuple, pool.rows().collect()), key=str)


def test_appends_keep_keys_unique(spark, tmp_path):
    pool = KeyedPool(spark, str(tmp_path), "k", KIND, bucket_keys=10)
    frame = lambda rows: spark.createDataFrame(rows, KIND)
    assert pool.append(frame([])) == 0 and pool.rows().count() == 0
    assert pool.append(frame([("a", 2), ("a", 1), ("b", None), (None, 5), ("", 0)]), "v") == 3
    assert pool_rows(pool) == [("", 0), ("a", 1), ("b", None)]
    assert pool.append(frame([("a", 7), ("c", 1), ("c", 1)])) == 1 and pool.append(frame([("c", 2)])) == 0
    r, want = random.Random(1), {"a": 1, "b": None, "": 0, "c": 1}
    for _ in range(4):
        some = [(f"k{r.randint(0, 150)}", r.randint(0, 9)) for _ in range(60)]
        for k, v in sorted(some):
            want.setdefault(k, v)
        pool.append(frame(some), "v")
    assert pool_rows(pool) == sorted(want.items(), key=str)
    assert pool.commits()[-1]["bits"] >= 4  # split as it grew
    assert sorted(x.k for x in pool.held(frame([("a", 0), ("zz", 0), (None, 1)])).collect()) == ["a"]


def test_an_append_reads_only_its_buckets(spark, tmp_path):
    pool = KeyedPool(spark, str(tmp_path), "k", KIND, bucket_keys=50)
    pool.append(spark.range(3000).selectExpr("concat('k', id) AS k", "1 AS v"))
    bits = pool.commits()[-1]["bits"]
    new = spark.createDataFrame([("k5", 2), ("new", 2)], KIND)
    touched = {r.b for r in new.select(pool._bucket(bits).alias("b")).collect()}
    folders = glob.glob(f"{tmp_path}/keys/append={pool.commits()[-1]['keys'][0]}/bucket=*")
    assert len(folders) >= 32
    for f in folders:
        if int(f.rsplit("=", 1)[1]) not in touched:
            for x in glob.glob(f"{f}/*.parquet"):
                os.truncate(x, 0)  # reading it would fail
    assert pool.append(new) == 1


def test_a_failed_append_counts_for_nothing(spark, tmp_path):
    pool = KeyedPool(spark, str(tmp_path), "k", KIND)
    pool.append(spark.createDataFrame([("a", 1)], KIND))
    commit, pool._commit = pool._commit, lambda *a: (_ for _ in ()).throw(OSError("lost"))
    with pytest.raises(OSError):
        pool.append(spark.createDataFrame([("b", 1)], KIND))
    pool._commit = commit
    assert pool_rows(pool) == [("a", 1)] and pool.append(spark.createDataFrame([("b", 2)], KIND)) == 1 and pool_rows(pool) == [("a", 1), ("b", 2)]


def slow_pace(rows, delay):
    out, free = {}, {}
    for key, at, i in sorted(rows, key=lambda r: (r[1] is None, r[1] or datetime.min, r[2])):
        if at is None:
            out[i] = None
            continue
        out[i] = max(at, free.get(key, at))
        free[key] = out[i] + timedelta(seconds=delay)
    return out


def requests(seed, n=400):
    r = random.Random(seed)
    start = datetime(2024, 1, 1)
    return [(r.choice(["a", "b", "c", None]), start + timedelta(milliseconds=r.randint(0, 60_000)), i) for i in range(n)]


def test_paced(spark):
    rows = [*requests(1), ("a", None, 1000), ("b", None, 1001)]
    df = spark.createDataFrame(rows, "domain string, at timestamp, i int").withColumn("_place", F.lit("kept"))
    got = pacing.paced(df, "domain", "at", "i", delay=0.7)
    assert got.columns == ["domain", "at", "i", "_place", "send_at"]
    assert {r.i: r.send_at for r in got.collect()} == slow_pace(rows, 0.7)
    assert pacing.paced(df.limit(0), "domain", "at").count() == 0


def test_a_paced_stream_goes_on(spark, tmp_path):
    rows = sorted((r for r in requests(2) if r[0]), key=lambda r: r[1])
    df = spark.createDataFrame(rows, "domain string, at timestamp, i int")
    for k, part in enumerate((rows[:150], rows[150:300], rows[300:])):
        df.filter(F.col("i").isin([r[2] for r in part])).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        sent = pacing.paced_stream(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"), "domain", "at", "i", delay=0.7)
        query = sent.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
        query.awaitTermination()
    got = {r.i: r.send_at for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == slow_pace(rows, 0.7)


RESULTS = "page_id int, url string, jsonld string, rescore struct<overall_score:double>, rescore_pass boolean"


def test_both_sinks_as_results_come(spark, tmp_path):
    rows = [(i, f"u{i}", "{}", (4.0,), [True, False, None][i % 3]) for i in range(10)]
    df = spark.createDataFrame(rows, RESULTS)
    assert A.write_rescored(df, f"{tmp_path}/all", f"{tmp_path}/final") == {"total": 10, "passed": 4, "failed": 3, "errors": 3}
    for part in (rows[:6], rows[6:]):
        spark.createDataFrame(part, RESULTS).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        A.stream_rescored(spark.readStream.schema(RESULTS).json(f"{tmp_path}/in"), f"{tmp_path}/s", f"{tmp_path}/f", f"{tmp_path}/state").awaitTermination()
    assert spark.read.json(f"{tmp_path}/s/rows").count() == 10 and sorted(x.page_id for x in spark.read.json(f"{tmp_path}/f").collect()) == [0, 3, 6, 9]
    assert spark.read.json(f"{tmp_path}/s/counts").groupBy().sum("total", "passed", "errors").first()[:] == (10, 4, 3)


def test_chat_export(spark):
    kind = "page_id int, url string, jsonld string, judged struct<valid:boolean,factual_score:double>"
    rows = [(1, "u", '{"@type":["A","B"],"x":"é\\n"}', (True, 0.5)), (2, None, "{}", (True, 0.9)), (3, "u", "{}", (True, 0.49)), (4, "u", "{}", (False, 1.0)), (5, "u", "{}", (None, None))]
    got = [json.loads(x.value) for x in A.chat_export(spark.createDataFrame(rows, kind), "prompt").collect()]
    assert [x["metadata"]["page_id"] for x in got] == ["1", "2"] and got[0]["metadata"]["types"] == ["A", "B"] and got[0]["messages"][2]["content"] == rows[0][2]
    assert [m["role"] for m in got[0]["messages"]] == ["system", "user", "assistant"] and got[0]["messages"][0]["content"] == "prompt"


def test_requests_without_hints(spark):
    rows = spark.createDataFrame([(1, "u", "<p>x</p>")], "page_id int, url string, html string")
    got = json.loads(A.batch_requests(rows, "m", "p").first().value)
    assert got == {"custom_id": "1", "request": {"model": "m", "body": {"system_instruction": {"parts": [{"text": "p"}]}, "contents": [{"role": "user", "parts": [{"text": "URL: u\n\nHTML source:\n<p>x</p>"}]}]}}}


def test_sketches(spark):
    r = random.Random(4)
    rows = [(r.choice("abc"), r.lognormvariate(3, 2), r.randint(0, 3000)) for _ in range(20_000)] + [("d", None, None), (None, 1.0, 1)]
    df = spark.createDataFrame(rows, "batch string, x double, k int")
    first, second = G.sketches(df.filter("batch IN ('a', 'b')"), "batch", "x", "k"), G.sketches(df.filter("NOT coalesce(batch IN ('a', 'b'), false)"), "batch", "x", "k")
    got = G.merged_sketches(first.unionByName(second), (1, 50, 99)).first()
    xs = sorted(x for _, x, _ in rows if x is not None)
    assert got["n"] == len(rows) and abs(got["n_keys"] / len({k for _, _, k in rows if k is not None}) - 1) < 0.05
    for p, x in got["values"]:
        assert abs(sum(v <= x for v in xs) / len(xs) - p / 100) < G.RANK_ERROR
    none = G.merged_sketches(G.sketches(df.limit(0), "batch", "x", "k"), (50,)).first()
    assert (none["n"], none["n_keys"], none["values"]) == (0, 0, None)


LINES = [r'<a> <b> "x\u00e9 \ud83d\ude00y \uDE00 \ud83dz" <d> .', r'<http://a/b#c> <http://s/x#name> "q \"w\" é 😀 \n \\ é \ud83d"@en-US <http://p> .', "_:b <http://s/y/z> <http://o> <http://p> .", "<a> <b> _:c <d> .", '<a> <b> "t"^^<http://int> <d> .', " # no", "# <a> <b> <c> <d>", "<a> <b> <c> .", "", "   ", None, '<<a>> <b> "" <d> <e> .']


def test_the_table_function_agrees_with_columns(spark):
    udtf.register(spark)
    lines = spark.createDataFrame([(i % 2, i, x) for i, x in enumerate(LINES * 3)], "file int, line_no long, line string")
    got = spark.sql("SELECT * FROM quads_of(TABLE({lines}))", lines=lines)
    t = N.tokens(F.col("line"))
    want = lines.filter("line IS NOT NULL AND trim(line) <> '' AND NOT startswith(trim(line), '#')").withColumn("t", t).filter("t IS NOT NULL").select("file", "line_no", iri(F.col("t")[0]), local_name(F.col("t")[1]), N.value(F.col("t")[2]), iri(F.col("t")[3]))
    assert sorted(tuple(x)[:6] for x in got.collect()) == sorted(map(tuple, want.collect()))
    one = spark.createDataFrame([("x", i, f"<{s}> <b> <c> <d> .") for i, s in enumerate("aaba")], "part string, at int, line string")
    runs = spark.sql("SELECT * FROM quads_of(TABLE({one}), 'part', 'at') ORDER BY at", one=one).collect()
    assert [(x.part, x.run, x.opens) for x in runs] == [("x", 0, True), ("x", 0, False), ("x", 1, True), ("x", 2, True)]
    with pytest.raises(Exception, match="misses file, line_no"):
        spark.sql("SELECT * FROM quads_of(TABLE({one}))", one=one)
