"""Hand-made cases with known answers."""

import json
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from quarrymark import reference_data as R
from quarrymark.functions import html as H
from quarrymark.functions import jsontext as J
from quarrymark.functions import nquads as N
from quarrymark.functions import urls as U
from quarrymark.operators import assemble, labeller, pages, validate
from quarrymark.operators import nquads as Q
from quarrymark.operators import report as G
from quarrymark.operators import sampling as S
from quarrymark.session import own_folder
from quarrymark.sources import readers as SRC
from quarrymark.streaming import pools

CTX = '"@context":"https://schema.org"'


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("url,compat,plain", [("https://www.web.ie/a", "eb.ie", "web.ie"), ("https://web.ie", "eb.ie", "web.ie"), ("junk", "", ""), (None, "", "")])
def test_domains(spark, url, compat, plain):
    u = F.lit(url).cast("string")
    assert one(spark, U.domain(u, compat=True)) == compat and one(spark, U.domain(u)) == plain


def test_tlds(spark):
    assert one(spark, U.tld(F.lit("shop.foo.co.uk"))) == "co.uk" and one(spark, U.tld(F.lit("foo.com"))) == "com"
    assert one(spark, U.anywhere_filter(F.lit("https://x.com/a.ie/b"), "ie")) and not one(spark, U.tld_filter(F.lit("https://x.com/a.ie/b"), "ie"))


def test_strip(spark):
    html = '<div class="a" data-x="1" style="c">T</div>\n\n\n<svg >x</svg><link rel=a>'
    assert one(spark, H.strip_noise(F.lit(html))) == "<div>T</div>"


def test_parser_text(spark):
    html = "<p>a</p><meta charset=x><p>b</p><script>s</script><p>c &amp; d</p>"
    assert one(spark, H.parsed_text(F.lit(html))) == "a c & d"


def test_tokens(spark):
    line = r'<http://a> <http://schema.org/name> "A \"q\""@en-US <http://p> .'
    assert one(spark, F.size(N.tokens(F.lit(line)))) == 4
    assert one(spark, N.value(F.lit(r'"A \"q\" é\n"@en'))) == 'A "q" é\n'
    assert one(spark, N.value(F.lit('"café"'), compat=True)) == "cafÃ©" and one(spark, N.value(F.lit("_:b"))) is None


def test_runs(spark):
    lines = [(0, i, f'<http://{s}> <http://schema.org/name> "{s}" <http://p> .') for i, s in enumerate("aaba")] + [(0, 9, "<http://c> <http://schema.org/x> _:b <http://p> .")]
    quads = Q.parse(spark.createDataFrame(lines, "file int, line_no int, line string"))
    assert Q.entities(quads).count() == 3 and Q.entities(quads, "global").count() == 2


@pytest.mark.parametrize("segment", [1, 2, 3, 7, 1000])
def test_runs_go_on_over_segments(spark, segment):
    r = random.Random(segment)
    lines = [(f, i, f"<http://{r.choice('ab')}> <http://s/n> {r.choice(['_:b', chr(34) + str(i) + chr(34)])} <http://{r.choice('pp' if f else 'pq')}> .") for f in range(3) for i in r.sample(range(60), 30)]
    lines += [(9, i, f'<http://a> <http://s/n> "{i}" <http://p> .') for i in range(50)] + [(8, i, None) for i in range(3)]
    quads = Q.parse(spark.createDataFrame(lines, "file int, line_no int, line string").repartition(5))
    want, last = {}, None
    for q in sorted(quads.collect(), key=lambda q: (q.file, q.line_no)):
        if last is None or (q.file, q.subject, q.source_url) != last:
            last, n = (q.file, q.subject, q.source_url), len(want)
            want[n] = (q.subject, q.source_url, [])
        if q.value is not None:
            want[n][2].append(q.value)
    got = sorted((e.subject, e.source_url, e.properties["n"]) for e in Q.entities(quads, segment=segment).collect())
    assert got == sorted(x for x in want.values() if x[2])


def test_one_plain_file_is_many_tasks(spark, tmp_path):
    lines = [f'<http://s{i // 7}> <http://s/n> "{i}" <http://p> .' for i in range(20_000)]
    (tmp_path / "a.nq").write_text("\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", 64 << 10)
        rows = SRC.read_nquads(spark, str(tmp_path / "a.nq"))
        assert rows.rdd.getNumPartitions() > 10
        e = Q.entities(Q.parse(rows))
        assert sorted((x.subject, x.properties["n"]) for x in e.collect()) == sorted((f"http://s{k}", [str(i) for i in range(7 * k, min(7 * k + 7, 20_000))]) for k in range(-(-20_000 // 7)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_only_named_parts_are_opened(spark, tmp_path):
    rows = spark.range(70).select((F.col("id") % 7).alias("part"), F.concat(F.lit("<http://s> <http://s/n> \""), F.col("id").cast("string"), F.lit("\" <http://p> .")).alias("line"))
    rows.repartition("part").write.partitionBy("part").text(str(tmp_path / "q"))
    lookup = spark.createDataFrame([("a.ie", "ie", "part_1.gz"), ("b.ie", "ie", "part_4.gz"), ("c.com", "com", "part_2.gz")], "pld string, tld string, part_name string")
    found = SRC.read_parts(spark, str(tmp_path / "q"), Q.parts_for_tld(lookup, "ie"))
    rows = found.collect()
    assert {x.part for x in rows} == {1, 4} and len(rows) == 20
    plan = found._jdf.queryExecution().executedPlan()
    assert "dynamicpruning" in plan.toString().lower()
    (scan,) = [x for x in leaves(plan) if x.getClass().getSimpleName() == "FileSourceScanExec"]
    assert scan.metrics().apply("numFiles").value() == 2


def leaves(plan):
    """The nodes without children of a plan that ran."""
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec" or name.endswith("QueryStageExec"):
        return leaves(plan.executedPlan() if name.startswith("Adaptive") else plan.plan())
    kids = plan.children()
    return [x for i in range(kids.size()) for x in leaves(kids.apply(i))] if kids.size() else [plan]


CASES = [
    ("{%s,\"@type\":\"Product\",\"name\":\"A\",\"brand\":\"B\"}" % CTX, True, 0, 0, 2, 0.2),
    ("{%s,\"@type\":\"Restaurant\",\"name\":\"A\",\"address\":\"x\",\"telephone\":\"1\"}" % CTX, True, 0, 0, 3, 0.18),
    ('{"@type":"Product","name":"A"}', False, 1, 1, 1, 0.0), ("{%s,\"@type\":\"Foo\",\"name\":\"A\"}" % CTX, True, 0, 1, 1, 0.0),
    ("{%s,\"name\":\"A\"}" % CTX, False, 1, 0, 0, 0.0), ("{%s,\"@graph\":[{\"@type\":\"WebSite\",\"name\":\"x\",\"url\":\"u\"}]}" % CTX, True, 0, 0, 2, 0.387),
    ("[]", False, 1, 0, 0, 0.0), ('{"@graph":[]}', False, 1, 0, 0, 0.0), ("5", False, 1, 0, 0, 0.0), ('{"a":', False, 1, 0, 0, 0.0), (None, False, 1, 0, 0, 0.0),
]


def test_config_scores(spark):
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, jsonld string")
    got = {x.i: x.result for x in validate.scored(rows).collect()}
    for i, (_, valid, errors, warnings, count, score) in enumerate(CASES):
        r = got[i]
        assert (r.valid, len(r.errors), len(r.warnings), r.property_count, r.quality_score) == (valid, errors, warnings, count, score), CASES[i]


def test_page_gate(spark):
    long = "word " * 100
    rows = [("a", "<p>short</p>"), ("b", f"<p>coming soon {long}</p>"), ("c", f"<p>x the y {long}</p>"), ("d", f"<p>x the and y {long}</p>"), ("https://www.bbc.co.uk/x", f"<p>{long}</p>")]
    got = {x.url: x.status for x in pages.with_gate(spark.createDataFrame(rows, "url string, html string")).collect()}
    assert list(got.values()) == ["short", "parked", "not_english", "ok", "ok"] or got == {"a": "short", "b": "parked", "c": "not_english", "d": "ok", "https://www.bbc.co.uk/x": "ok"}


def test_targets_and_splits(spark):
    assert dict(S.type_targets(20_000))["LocalBusiness"] == 4000 and dict(S.type_targets(100))["Course"] == 50
    rows = spark.range(11).withColumn("key", F.col("id").cast("string"))
    assert S.split(rows, "key").filter("split = 'train'").count() == 9
    one_row = rows.filter("id = 0").withColumn("k", F.lit("a"))
    assert S.stratified_split(one_row, "k", "key").first().split == "train"
    few = {tuple(x) for x in S.split(rows.repartition(1), "key").collect()}
    assert few == {tuple(x) for x in S.split(rows.repartition(8), "key").collect()}


def test_sampled_to_targets(spark):
    rows = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, "Product").when(F.col("id") % 3 == 1, "Course").otherwise("Other").alias("kind"), F.col("id").cast("string").alias("key"))
    got = {x.kind: x["count"] for x in S.sampled_to_targets(rows, "kind", 1000, "key", unknown=7).groupBy("kind").count().collect()}
    assert got == {"Product": 150, "Course": 50, "Other": 7}


@pytest.mark.parametrize("text,fixed", [('{"a":[1,2', '{"a":[1,2]}'), ('{"a":1', '{"a":1}'), ('{"a":1,', '{"a":1}'), ("}{", None), ('{"a":1}', '{"a":1}'), (None, None)])
def test_repair(text, fixed):
    assert J.repaired(text) == fixed


def test_json_strictness(spark):
    texts = ['{"a":1,"a":2}', "NaN", "{'a':1}", '{"a":1} x', "[1]"]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    assert [r.ok for r in rows.select("i", J.is_json("x").alias("ok")).orderBy("i").collect()] == [True, True, False, False, True]


def test_labeller_goes_on_and_gives_up(spark):
    rows = spark.createDataFrame([(1, "u", "<title>a</title>"), (2, "v", None)], "page_id long, url string, html string")
    assert labeller.label(rows, done=rows.filter("page_id = 1")).count() == 1

    def broken(url, html):
        raise RuntimeError("no")

    got = labeller.label(rows, broken).collect()
    assert all(not r.valid and r.attempt == 3 and "no" in r.error for r in got)


def test_readers_and_sinks(spark, tmp_path):
    lines = spark.createDataFrame([('{"url":"http://a","status":"200","offset":"5"}',), ("http://b",), ("resume-key",), ("",)], "value string")
    assert sorted((r.url, r.offset or 0) for r in SRC.index_lines(lines).collect()) == [("http://a", 5), ("http://b", 0)]
    rows = spark.createDataFrame([("http://a", "é"), ("http://b", "x")], "url string, v string")
    SRC.write_json_lines(rows, str(tmp_path / "pool"))
    SRC.append_new(spark.createDataFrame([("http://b", "y"), ("http://c", "z")], "url string, v string"), str(tmp_path / "pool"), "url", "url string, v string")
    assert sorted(tuple(r) for r in SRC.read_json_lines(spark, "url string, v string", str(tmp_path / "pool")).collect()) == [("http://a", "é"), ("http://b", "x"), ("http://c", "z")]
    SRC.write_keyed(rows, str(tmp_path / "keyed"))
    assert spark.read.json(str(tmp_path / "keyed")).count() == 2
    assert one(spark, SRC.record_body(F.lit("a\r\n\r\nb\r\n\r\nc\r\n\r\nd"))) == "c\r\n\r\nd"


def test_nquads_files(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "a.nq.gz", "wt") as f:
        f.write('<http://a> <http://schema.org/name> "x" <http://p> .\n\n# c\n')
    (tmp_path / "b.nq.gz").write_bytes(b"<html>")
    assert {r.path.rsplit("/", 1)[1]: r.is_gzip for r in SRC.gzip_files(spark, str(tmp_path)).collect()} == {"a.nq.gz": True, "b.nq.gz": False}
    assert Q.parse(SRC.read_nquads(spark, str(tmp_path / "a.nq.gz"))).first().value == "x"


def test_streams(spark, tmp_path):
    src = tmp_path / "in"
    spark.createDataFrame([("a", "2024-01-01 00:00:01"), ("a", "2024-01-01 00:00:02"), ("b", "2024-01-01 00:05:00")], "url string, ts string").write.json(str(src))
    stream = pools.stream_json(spark, str(src), "url string, ts timestamp")
    pools.append_to(pools.distinct_within(stream, "url", "ts"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    assert pools.run_to_table(spark, pools.counts(stream, "ts", "60 seconds"), "complete").count() == 2
    assert pools.run_to_table(spark, pools.sessions(stream, "url", "ts"), "append").count() >= 0


@pytest.mark.parametrize("text,ok", [("{} x", False), ("{}{}", False), ("[1]]", False), ('1,"a":2', False), ("1]", False), ("1}", False), ("1],[2", False), ('{"a":1,"a":2}', True), ("NaN", True), ("null", True), (" {} ", True), ('{"a":01}', False), ("", False), (None, False)])
def test_json_tests_agree_with_python(spark, text, ok):
    row = spark.createDataFrame([(text,)], "t string").select(J.is_json("t"), J.normal_json("t"), J.repair("t")).first()
    assert row[0] is ok and (row[1] is not None) == (ok and text not in ("null", "NaN"))
    assert not ok or row[2] == text


@pytest.mark.parametrize("html,text", [
    ("<p>a <b>b</b>&amp;c</p>", "a b &c"), ("<head><title>t</title></head>x", "x"), ("<head><script>a</script><title>t</title></head>x", "t x"), ("<script>var a='</style>';</script>y", "y"),
    ("<noscript>n</noscript>z", "z"), ("a<!-- b -->c", "a c"), ("<meta name=x>hidden</head>shown", "shown"), ("<link/>shown", "shown"), ("<style>p{}", ""), ("", ""), ("&nbsp;a&nbsp;", "a"), ("1 < 2", "1 < 2"), (None, None),
])
def test_visible_pieces(html, text):
    assert H.visible_pieces(html) == text


def test_joins_and_judges(spark, tmp_path):
    records = spark.createDataFrame([("u", 1), ("u", 2), ("v", 3)], "url string, n int")
    pages = spark.createDataFrame([("u", "h"), ("u", "h2")], "url string, html string")
    assert [tuple(x) for x in assemble.records_with_html(records, pages, "n").collect()] == [("u", 1, "h")]
    assert [tuple(x) for x in assemble.records_with_html(records, pages, "n", last=True).collect()] == [("u", 2, "h")]
    results = spark.createDataFrame([(1, "u", "h", "ab"), (2, None, None, None)], "page_id long, url string, html string, jsonld string")

    def failing(url, html, jsonld):
        if url is None:
            raise ValueError("no page")
        return {"overall_score": 4, "pass": True}

    found = {x.page_id: x for x in labeller.judge(results, failing, attempts=2).collect()}
    assert found[1].passed and found[1].overall_score == 4.0 and found[2].error == "gave up after 2: no page" and found[2].passed is None
    rows = results.selectExpr("page_id", "url", "jsonld", "named_struct('s', 1) AS rescore", "page_id = 1 AS rescore_pass")
    assemble.write_rescored(rows, str(tmp_path / "all"), str(tmp_path / "final"))
    assert spark.read.json(str(tmp_path / "all")).count() == 2 and [x.page_id for x in spark.read.json(str(tmp_path / "final")).collect()] == [1]
    clash = spark.createDataFrame([(1, 5), (1, 6)], "k int, _rank int")
    assert [tuple(x) for x in S.capped(clash, "k", 1, "_rank").collect()] == [(1, 5)]


def test_helper_columns_leave_others_alone(spark):
    own = ["_rank", "_all", "_b", "_n", "_r", "_before", "_h", "_pool", "_target", "_e", "_keys", "_types", "_context", "_errors", "_warnings", "_count", "_row", "_text", "_r_"]
    rows = spark.range(30).select("id", F.col("id").cast("string").alias("key"), (F.col("id") % 2).cast("string").alias("kind"), *((F.col("id") + i).alias(c) for i, c in enumerate(own)))
    want = {tuple(r[c] for c in ("id", *own)) for r in rows.collect()}
    same = lambda df: {tuple(r[c] for c in ("id", *own)) for r in df.collect()} == want
    assert same(S.split(rows, "key")) and same(S.stratified_split(rows, "kind", "key")) and S.numbered(rows.withColumn("at", F.col("id")), "at").agg(F.sum("_rank"), F.sum("_all"), F.sum("_b")).first()[:] == (435, 465, 495) and same(S.chunked(rows, "id", 10, 4))
    assert same(S.merged_pools(rows.filter("id < 20"), rows.filter("id > 10"), key="id", order="id")) and same(S.capped(rows, "kind", 100, "id"))
    assert same(S.sampled_to_targets(rows.withColumn("kind", F.lit("Product")), "kind", 1000, "key")) and same(S.placed(rows.withColumn("h", F.md5("key")), "h"))
    assert same(validate.scored(rows.withColumn("jsonld", F.lit("{}")).withColumn("result", F.lit(1))))
    assert S.split(rows, "key").filter("split = 'train'").count() == 27
    assert S.numbered(rows.drop("id").withColumn("at", F.col("_rank")), "at").orderBy("at").first().id == "train_000000"
    numbers = [r.place for r in S.placed(rows.withColumn("h", F.md5("key")), "h").orderBy("h").collect()]
    assert numbers == list(range(1, 31)) and S.placed(rows.limit(0), "key").count() == 0


def test_learning_curve(spark):
    rows = spark.createDataFrame([("a", 10), ("b", 500), (None, 10)], "source string, n long")
    got = [tuple(r) for r in G.learning_curve(rows, "source").orderBy("n").collect()]
    assert [x[:2] for x in got] == [("b", 500), ("a", 510), (None, 520)] and got[0][2] == round(52 + 35 * (1 - 2.718281828459045 ** -0.175), 6)
    assert G.learning_curve(rows.limit(0), "source").count() == 0


def test_index_scans_prune_folders(spark, tmp_path):
    rows = spark.createDataFrame([("u1", "c1", "warc"), ("u2", "c2", "warc"), ("u3", "c1", "robots")], "url string, crawl string, subset string")
    rows.write.partitionBy("crawl", "subset").parquet(str(tmp_path / "i"))
    found = SRC.read_index(spark, str(tmp_path / "i"), "c1")
    assert [x.url for x in found.collect()] == ["u1"] and "PartitionFilters: [isnotnull(crawl" in found._jdf.queryExecution().executedPlan().toString()
    assert SRC.read_index(spark, str(tmp_path / "i"), subset=None).count() == 3
    with pytest.raises(ValueError, match="no crawl"):
        SRC.read_index(spark, str(tmp_path / "i" / "crawl=c1"), "c1")


def test_catalog_queries_leave_views_alone(spark):
    spark.range(3).createOrReplaceTempView("mine")
    found = SRC.catalog_query(spark, "SELECT count(*) AS n FROM {mine} a JOIN mine USING (id)", mine=spark.range(2))
    assert found.first().n == 2 and spark.table("mine").count() == 3


def test_fixed_bins_close_at_both_ends(spark):
    rows = spark.createDataFrame([(0.0,), (0.05,), (1.0,), (1.1,), (-0.1,), (None,)], "v double")
    assert {r["bin"]: r["n"] for r in G.fixed_bins(rows, "v", 20).collect()} == {0: 1, 1: 1, 19: 1}
    assert G.fixed_bins(rows.limit(0), "v", 20).count() == 0


def test_adoption_report(spark):
    kind = "existing boolean, generated boolean, quality double, properties long, types array<string>"
    rows = [(True, True, 0.5, 4, ["A", "B"]), (False, False, 0.9, 9, ["B", "B"]), (False, True, 0.7, 5, []), (None, None, None, None, None)]
    got = G.adoption_report(spark.createDataFrame(rows, kind), most=1).first()
    assert tuple(got) == (4, 1, 2, 0.25, 2, 0.6, 4.5, "B:3")
    none = G.adoption_report(spark.createDataFrame([], kind)).first()
    assert (none.total, none.rate, none.mean_quality, none.top_types) == (0, None, 0.0, "")
    assert [r.share for r in G.coverage(spark.createDataFrame([], "x long"), "x", [5]).collect()] == [None]


def test_normal_text(spark):
    texts = [" A  b\x1c\r\n C ", "", None, "　", "x​y"]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i long, x string")
    got = {r.i: r.y for r in rows.select("i", H.normal_text(F.col("x")).alias("y")).collect()}
    assert got == {i: None if x is None else re.sub(r"\s+", " ", x.lower().strip()) for i, x in enumerate(texts)}


def test_own_folder_is_shared_and_deleted(spark):
    path = own_folder(spark, "x")
    assert path.startswith(spark.sparkContext.getConf().get("spark.checkpoint.dir")) and os.path.isdir(path)
    assert own_folder(spark, "x") != path
