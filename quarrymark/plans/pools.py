"""Queries over pools that grow, paced requests, sinks written in one pass, sketches and the table function."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import assemble as A
from ..operators import labeller as L
from ..operators import report as G
from ..operators import validate as V
from ..session import own_folder
from ..sources import udtf
from ..sources.keyed_pool import KeyedPool
from ..streaming import pacing
from .base import query, t
from .judging import _BASE, _FACTS, _TEXT, _VOCAB, judged_pages
from .markup import _PARSED, quads

_DELAY = 900
_PACED = f"SELECT event_id, event_type, max(epoch_us(ts) - i * {_DELAY}000000) OVER (PARTITION BY event_type ORDER BY i) + i * {_DELAY}000000 AS send_at FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS i FROM events)"


@query(_PACED)
def paced_requests(spark, sf):
    """Events as requests to a domain for each type, a quarter of an hour apart."""
    rows = pacing.paced(t(spark, sf, "events"), "event_type", "ts", "event_id", delay=_DELAY)
    return rows.select("event_id", "event_type", F.unix_micros("send_at").alias("send_at"))


@query(_PACED)
def paced_stream(spark, sf):
    """The same as a stream in two runs, the second of which goes on with the state of the first."""
    folder = own_folder(spark, "paced")
    rows = t(spark, sf, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    middle = rows.agg(F.percentile_approx(F.unix_micros("ts"), 0.5)).first()[0]
    for part in (F.unix_micros("ts") <= F.lit(middle), F.unix_micros("ts") > F.lit(middle)):
        rows.filter(part).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
        sent = pacing.paced_stream(stream, "event_type", "ts", "event_id", delay=_DELAY)
        sent.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.schema("event_id long, event_type string, send_at timestamp").parquet(f"{folder}/out")
    return out.select("event_id", "event_type", F.unix_micros("send_at").alias("send_at"))


@query("SELECT c_name, arg_min(tag, c_custkey) AS tag FROM (SELECT substr(c_name, 1, 17) AS c_name, c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'first' ELSE 'second' END AS tag FROM customer) GROUP BY c_name, tag QUALIFY row_number() OVER (PARTITION BY c_name ORDER BY tag) = 1")
def keyed_pool(spark, sf):
    """Two appends to a pool of names, which hold some in common and repeat their own; the second reads the keys of its buckets only."""
    rows = t(spark, sf, "customer").select(F.substring("c_name", 1, 17).alias("c_name"), "c_custkey", "c_mktsegment")
    pool = KeyedPool(spark, f"{own_folder(spark, 'pool')}/names", "c_name", "c_name string, c_custkey bigint, tag string", bucket_keys=100)
    early = F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    for part, tag in ((early, "first"), (~early, "second")):
        pool.append(rows.filter(part).select("c_name", "c_custkey", F.lit(tag).alias("tag")), "c_custkey")
    return pool.rows().select("c_name", "tag")


_JUDGED = "(SELECT l.doc_id AS page_id, 1.0 + length(j) % 5 >= 3.5 AND length(j) % 2 = 0 AS passed, j FROM (SELECT *, repeat('x', (doc_id % 23)::INT) AS j FROM labels) l)"


@query(f"SELECT count(*) AS total, count(*) FILTER (WHERE passed) AS passed, count(*) FILTER (WHERE NOT passed) AS failed, 0 AS errors, count(*) AS stored, count(*) FILTER (WHERE passed) AS final, sum(length(j)) FILTER (WHERE passed)::BIGINT AS final_chars FROM {_JUDGED}")
def rescored_sinks(spark, sf):
    """Judged results written to both sinks as they are counted, and what the sinks hold."""
    folder = own_folder(spark, "rescored")
    results = t(spark, sf, "labels").select(F.col("doc_id").alias("page_id"), F.repeat(F.lit("x"), (F.col("doc_id") % 23).cast("int")).alias("jsonld"))
    rows = A.rescored_results(results, t(spark, sf, "pages").select("page_id", "url", "html"))
    found = rows.select("page_id", "url", "jsonld").join(L.judge(rows), "page_id")
    passed = V.rescored(F.col("overall_score"), F.col("passed"), F.col("error"))
    counts = A.write_rescored(found.select("page_id", "url", "jsonld", F.struct("overall_score").alias("rescore"), passed.alias("rescore_pass")), f"{folder}/all", f"{folder}/final")
    stored = spark.read.schema("page_id long").json(f"{folder}/all").agg(F.count("*").alias("stored"))
    final = spark.read.schema("jsonld string").json(f"{folder}/final").agg(F.count("*").alias("final"), F.sum(F.length("jsonld")).alias("final_chars"))
    return stored.crossJoin(final).select(*(F.lit(counts[c]).cast("long").alias(c) for c in ("total", "passed", "failed")), F.lit(counts["errors"]).cast("int").alias("errors"), "stored", "final", "final_chars")  # one row each


@query(
    _BASE + _VOCAB + _FACTS + ", e AS (SELECT page_id, count(*) FILTER (WHERE severity = 'error') AS errors FROM issues GROUP BY page_id) SELECT page_id, md5(t) AS answer, o->>'@type' AS types, coalesce(factual_score, 1.0)::DOUBLE AS factual_score, "
    "md5('URL: ' || url || chr(10) || chr(10) || '[Screenshot attached]' || chr(10) || chr(10) || '[HTML source attached]') AS asked FROM good JOIN pages USING (page_id) LEFT JOIN e USING (page_id) LEFT JOIN score USING (page_id) WHERE coalesce(errors, 0) <= 2 AND coalesce(factual_score, 1.0) >= 0.5"
)
def chat_export(spark, sf):
    """Results that the second validator holds valid and factual, written as chat examples and read again."""
    path = f"{own_folder(spark, 'export')}/rows"
    urls = t(spark, sf, "pages").select("page_id", "url")
    A.chat_export(judged_pages(spark, sf).select("page_id", "jsonld", "judged").join(urls, "page_id")).write.text(path)
    rows = spark.read.schema("messages array<struct<role:string,content:string>>, metadata struct<page_id:string,url:string,types:array<string>,factual_score:double>").json(path)
    said = lambda i: F.md5(F.col("messages")[i]["content"])
    return rows.select(F.col("metadata.page_id").cast("bigint").alias("page_id"), said(2).alias("answer"), F.array_join("metadata.types", ",").alias("types"), "metadata.factual_score", said(1).alias("asked"))


@query("SELECT p::INT AS percent, (SELECT count(*) FROM documents) AS n, true AS near, true AS keys_near FROM (VALUES (10), (50), (90), (99)) AS q(p)")
def sketched_lengths(spark, sf):
    """Lengths and languages of documents from one state for each source: each value's true rank is within the bound."""
    docs = t(spark, sf, "documents").select("doc_id", "source", F.char_length("text").alias("chars"))
    path = f"{own_folder(spark, 'sketches')}/states"
    G.sketches(docs, "source", "chars", "doc_id").write.parquet(path)
    found = G.merged_sketches(spark.read.parquet(path), (10, 50, 90, 99)).first()
    x = F.col("chars")
    ranks = docs.agg(*(f for i, v in enumerate(found["values"] or []) for f in (F.count_if(x < v["x"]).alias(f"below{i}"), F.count_if(x <= v["x"]).alias(f"upto{i}"))), F.lit(found["n"]).cast("long").alias("n"))
    near = lambda i, p: (F.col(f"below{i}") / F.col("n") <= p / 100 + G.RANK_ERROR) & (F.col(f"upto{i}") / F.col("n") >= p / 100 - G.RANK_ERROR)
    each = F.array(*(F.struct(F.lit(v["percent"]).alias("percent"), near(i, v["percent"]).alias("near")) for i, v in enumerate(found["values"] or [])))
    return ranks.select("n", F.explode(each).alias("v")).select("v.percent", "n", "v.near", F.lit(abs(found["n_keys"] / max(1, found["n"]) - 1) < 0.05).alias("keys_near"))


@query(_PARSED + " SELECT file, line_no, subject, property, value, source_url, run FROM (SELECT *, sum(ch) OVER (PARTITION BY file ORDER BY line_no)::BIGINT - 1 AS run FROM (SELECT *, CASE WHEN lag(subject) OVER w = subject AND lag(source_url) OVER w = source_url THEN 0 ELSE 1 END AS ch FROM q WINDOW w AS (PARTITION BY file ORDER BY line_no)))")
def quads_function(spark, sf):
    """Parsing in SQL: a table function that is given files' lines in order, and knows where runs begin."""
    udtf.register(spark)
    return spark.sql("SELECT file, line_no, subject, property, value, source_url, run FROM quads_of(TABLE({lines}))", lines=quads(spark, sf))
