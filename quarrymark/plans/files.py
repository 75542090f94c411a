"""Queries over sinks and what is read back from them, and reports with other bins, samples and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import reference_data as R
from ..functions import html as H
from ..operators import nquads as Q
from ..operators import report as G
from ..operators import sampling as S
from ..session import own_folder
from ..sources import readers as SRC
from ..streaming import pools
from .base import KIND, count_n, n, query, t, with_kind
from .data import _RANK, _STATS
from .markup import _RUNS, quads, shown_properties


@query("SELECT doc_id, lang, md5(text) AS digest FROM documents")
def json_lines_pool(spark, sf):
    """Documents as JSON lines, a broken line beside each, and read again: broken ones go."""
    folder = own_folder(spark, "pool")
    docs = t(spark, sf, "documents").select("doc_id", "lang", "text")
    SRC.write_json_lines(docs, f"{folder}/good")
    docs.select(F.concat(F.lit('{"doc_id": '), F.col("doc_id").cast("string"), F.lit(', "lang": "')).alias("value")).write.text(f"{folder}/broken")
    rows = SRC.read_json_lines(spark, "doc_id long, lang string, text string", f"{folder}/good", f"{folder}/broken")
    return rows.select("doc_id", "lang", F.md5("text").alias("digest"))


@query("SELECT page_id, md5(url) AS key_hash, ('0x' || substr(md5(url), 1, 4))::INT % 256 AS bucket FROM pages")
def keyed_results(spark, sf):
    """Results by the md5 of their URL, in folders of a bucket each."""
    folder = own_folder(spark, "keyed")
    SRC.write_keyed(t(spark, sf, "pages").select("page_id", "url"), f"{folder}/rows")
    return spark.read.schema("page_id long, url string, key_hash string, bucket int").json(f"{folder}/rows").select("page_id", "key_hash", "bucket")


@query("SELECT n_name AS url, n_regionkey % 2 = 0 AS valid, n_regionkey::BIGINT AS property_count, 'nation=' || n_nationkey AS folder FROM nation")
def result_files(spark, sf):
    """A file for each nation, its JSON over several lines, in the order of their paths."""
    folder = own_folder(spark, "results")
    body = F.to_json(F.struct(F.col("n_name").alias("url"), (F.col("n_regionkey") % 2 == 0).alias("valid"), F.col("n_regionkey").alias("property_count")), {"pretty": "true"})
    t(spark, sf, "nation").select(F.col("n_nationkey").alias("nation"), body.alias("value")).write.partitionBy("nation").text(f"{folder}/rows")
    rows = SRC.read_results(spark, f"{folder}/rows").orderBy("file")
    return rows.select("url", "valid", n("property_count").alias("property_count"), F.regexp_extract("file", "/(nation=[0-9]+)/", 1).alias("folder"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'old' ELSE 'new' END AS tag FROM supplier")
def appended_pool(spark, sf):
    """A pool of JSON lines, to which only keys that it doesn't hold are appended."""
    path, kind = f"{own_folder(spark, 'appended')}/rows", "s_suppkey long, tag string"
    rows = t(spark, sf, "supplier").select("s_suppkey")
    SRC.write_json_lines(rows.filter("s_suppkey % 3 = 0").withColumn("tag", F.lit("old")), path)
    SRC.append_new(rows.withColumn("tag", F.lit("new")), path, "s_suppkey", kind)
    return SRC.read_json_lines(spark, kind, path)


@query("SELECT event_id, user_id, event_type FROM events")
def streamed_results(spark, sf):
    """Results appended batch by batch as they come, a folder for each batch."""
    folder, kind = own_folder(spark, "log"), "event_id long, user_id long, event_type string"
    SRC.write_json_lines(t(spark, sf, "events").select("event_id", "user_id", "event_type"), f"{folder}/in")
    pools.append_to(pools.stream_json(spark, f"{folder}/in", kind), f"{folder}/out", f"{folder}/state").awaitTermination()
    return spark.read.schema(kind).parquet(f"{folder}/out").select("event_id", "user_id", "event_type")


@query(_STATS)
def summary_file(spark, sf):
    """A run's statistics as one JSON row, written and read again."""
    path = f"{own_folder(spark, 'summary')}/rows"
    SRC.write_json_lines(G.quality_stats(t(spark, sf, "labels").select((((F.col("doc_id") * 7) % 11) / 10.0).alias("q")), "q"), path)
    return SRC.read_json_lines(spark, "total long, with_score long, mean double, least double, most double, upper_median double", path, strict=True)


@query(_RUNS + " SELECT subject, source_url, count(*) AS n_properties, min(property) AS first_property FROM p GROUP BY file, run, subject, source_url")
def nquads_file_entities(spark, sf):
    """Entities from gzip parts on disk, which are read together; each part's lines keep their order."""
    folder = own_folder(spark, "quads")
    parts = quads(spark, sf).repartition("file").sortWithinPartitions("file", "line_no").select("file", "line")
    parts.write.partitionBy("file").option("compression", "gzip").text(f"{folder}/rows")
    e = Q.entities(Q.parse(SRC.read_nquads(spark, f"{folder}/rows")))
    keys = F.map_keys("properties")
    return e.select("subject", "source_url", n(F.size(keys)).alias("n_properties"), F.array_min(keys).alias("first_property"))


@query(_RUNS + " SELECT subject, source_url, string_agg(property||'='||v, ';' ORDER BY property) AS properties FROM p GROUP BY file, run, subject, source_url")
def nquads_split_runs(spark, sf):
    """Plain files, which are read in splits: runs are found in segments of few lines and go on over their borders."""
    folder = own_folder(spark, "quads")
    quads(spark, sf).repartition("file").sortWithinPartitions("file", "line_no").select("file", "line").write.partitionBy("file").text(f"{folder}/rows")
    e = Q.entities(Q.parse(SRC.read_nquads(spark, f"{folder}/rows")), segment=16)
    return e.select("subject", "source_url", shown_properties().alias("properties"))


@query(_RUNS.replace("s_suppkey % 4 AS file", "s_suppkey % 7 AS file") + " SELECT file AS part, subject, source_url, string_agg(property||'='||v, ';' ORDER BY property) AS properties FROM p WHERE file IN (1, 4) GROUP BY file, run, subject, source_url")
def tld_part_entities(spark, sf):
    """Quads in seven parts, of which a lookup names those with hosts of a TLD: only these are opened."""
    folder, k = own_folder(spark, "parts"), F.col("s_suppkey")
    lines = quads(spark, sf).withColumn("part", F.floor(F.col("line_no") / 10) % 7)
    lines.repartition("part").sortWithinPartitions("part", "line_no").select("part", "line").write.partitionBy("part").option("compression", "gzip").text(f"{folder}/rows")
    tld = F.when((k % 7).isin(1, 4), "ie").otherwise("com")
    lookup = t(spark, sf, "supplier").select(F.concat(F.lit("s"), k.cast("string"), F.lit("."), tld).alias("pld"), tld.alias("tld"), F.concat(F.lit("part_"), (k % 7).cast("string"), F.lit(".gz")).alias("part_name"))
    lines = SRC.read_parts(spark, f"{folder}/rows", Q.parts_for_tld(lookup, "ie"))
    e = Q.entities(Q.parse(lines.withColumn("file", F.col("part"))))
    return e.select(F.col("file").alias("part"), "subject", "source_url", shown_properties().alias("properties"))


@query("SELECT DISTINCT url FROM pages WHERE url IS NOT NULL")
def index_url_set(spark, sf):
    """Index answers as a set: JSON lines and plain URLs of the same pages, a resume key at the end of each answer."""
    key = F.concat(F.lit("com,example)/ "), F.col("page_id").cast("string"))
    lines = t(spark, sf, "pages").select(F.explode(F.array(F.to_json(F.struct("url", F.lit("200").alias("status"))), F.col("url"), key)).alias("value"))
    return SRC.index_lines(lines).select("url").distinct()


_SPACE = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]+"


@query(f"SELECT doc_id, md5(regexp_replace(lower(regexp_replace(text, '^{_SPACE}|{_SPACE}$', '', 'g')), '{_SPACE}', ' ', 'g')) AS digest FROM documents")
def text_normalised(spark, sf):
    return t(spark, sf, "documents").select("doc_id", F.md5(H.normal_text(F.col("text"))).alias("digest"))


_BINS = "SELECT '{0}' AS part, bin::BIGINT AS bin, count(*) AS n FROM (SELECT least(floor({1}), {2}) AS bin FROM ({3}) WHERE v >= 0 AND v <= {4}) GROUP BY 2"
_SCORES = "SELECT ((doc_id * 7) % 101) / 100.0::DOUBLE AS v FROM labels"
_CHARS = "SELECT length(html) AS v FROM pages"


@query(" UNION ALL ".join((_BINS.format("score_30", "v * 30 / 1.0::DOUBLE", 29, _SCORES, 1), _BINS.format("chars_40", "v * 40 / 10000.0::DOUBLE", 39, _CHARS, 10_000), _BINS.format("score_60", "v * 60 / 1.0::DOUBLE", 59, _SCORES, 1))))
def fixed_histograms(spark, sf):
    """Scores in 30 and 60 bins, and lengths up to 10 000 in 40."""
    scores = t(spark, sf, "labels").select((((F.col("doc_id") * 7) % 101) / 100.0).alias("v"))
    chars = t(spark, sf, "pages").select(F.length("html").alias("v"))
    parts = (("score_30", scores, 30, 1.0), ("chars_40", chars, 40, 10_000.0), ("score_60", scores, 60, 1.0))
    found = [G.fixed_bins(rows, "v", bins, most).select(F.lit(name).alias("part"), "bin", "n") for name, rows, bins, most in parts]
    return found[0].unionByName(found[1]).unionByName(found[2])


def _targets(total: int, floor: int) -> str:
    return "(VALUES " + ",".join(f"('{k}',{m})" for k, m in S.type_targets(total, floor)) + ") AS q(schema_type, target)"


_PAGES = f"(SELECT page_id, {KIND} AS schema_type FROM pages)"


@query(
    f"WITH wide AS (SELECT schema_type, page_id FROM {_PAGES} JOIN {_targets(30_000, 100)} USING (schema_type) QUALIFY row_number() OVER (PARTITION BY schema_type ORDER BY {_RANK}, page_id) <= target), "
    f"rest AS (SELECT schema_type, page_id FROM {_PAGES} WHERE page_id % 4 <> 0 AND (page_id IN (SELECT page_id FROM wide) OR schema_type NOT IN (SELECT schema_type FROM {_targets(1, 1)}))) "
    f"SELECT schema_type, page_id FROM rest LEFT JOIN {_targets(10_000, 50)} USING (schema_type) QUALIFY row_number() OVER (PARTITION BY schema_type ORDER BY {_RANK}, page_id) <= coalesce(target, 200)"
)
def early_sample(spark, sf):
    """Three times the target of each type first; of those with a screenshot the target, and 200 rows of each other type."""
    rows = with_kind(t(spark, sf, "pages").select("page_id")).withColumn("key", F.col("page_id").cast("string"))
    wide = S.sampled_to_targets(rows, "schema_type", 30_000, "key", floor=100)
    other = rows.filter(~F.col("schema_type").isin(*R.TYPE_WEIGHTS))
    shots = wide.unionByName(other).filter("page_id % 4 <> 0")
    return S.sampled_to_targets(shots, "schema_type", 10_000, "key", unknown=200).select("schema_type", "page_id")


@query(
    f"WITH r AS (SELECT page_id % 3 <> 0 AS existing, page_id % 4 <> 0 AS generated, (page_id % 11) / 10.0::DOUBLE AS quality, page_id % 7 AS properties, {KIND} AS kind FROM pages), "
    "c AS (SELECT kind, count(*) AS n FROM r GROUP BY 1 ORDER BY n DESC, kind LIMIT 10) "
    "SELECT count(*) AS total, count(*) FILTER (WHERE existing) AS with_markup, count(*) FILTER (WHERE NOT existing) AS without_markup, round(count(*) FILTER (WHERE existing) / count(*)::DOUBLE, 3) AS rate, "
    "count(*) FILTER (WHERE generated) AS valid, round(avg(quality) FILTER (WHERE generated), 3)::DOUBLE AS mean_quality, round(avg(properties) FILTER (WHERE generated), 1)::DOUBLE AS mean_properties, "
    "(SELECT string_agg(kind || ':' || n, ',' ORDER BY n DESC, kind) FROM c) AS top_types FROM r"
)
def adoption_report(spark, sf):
    k = F.col("page_id")
    rows = with_kind(t(spark, sf, "pages").select("page_id")).select((k % 3 != 0).alias("existing"), (k % 4 != 0).alias("generated"), ((k % 11) / 10.0).alias("quality"), (k % 7).alias("properties"), F.array("schema_type").alias("types"))
    return G.adoption_report(rows)


@query(f"SELECT matched, count(*) AS n FROM (SELECT list_has_any(CASE page_id % 3 WHEN 0 THEN [{KIND}, 'Thing'] WHEN 1 THEN [{KIND}] ELSE []::VARCHAR[] END, CASE page_id % 4 WHEN 0 THEN ['Product'] WHEN 1 THEN [{KIND}] ELSE ['Event', 'Thing'] END) AS matched FROM pages) GROUP BY 1")
def type_overlap(spark, sf):
    """Is any predicted type among the gold ones?"""
    k, kind = F.col("page_id"), F.col("schema_type")
    gold = F.when(k % 3 == 0, F.array(kind, F.lit("Thing"))).when(k % 3 == 1, F.array(kind)).otherwise(F.array().cast("array<string>"))
    pred = F.when(k % 4 == 0, F.array(F.lit("Product"))).when(k % 4 == 1, F.array(kind)).otherwise(F.array(F.lit("Event"), F.lit("Thing")))
    return with_kind(t(spark, sf, "pages").select("page_id")).groupBy(F.arrays_overlap(gold, pred).alias("matched")).agg(count_n())
