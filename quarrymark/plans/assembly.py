"""Queries over record assembly, older gates, link predicates, index scans and judged results."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import reference_data as R
from ..functions import html as H
from ..functions import urls as U
from ..operators import assemble as A
from ..operators import labeller as L
from ..operators import pages as P
from ..operators import report as G
from ..operators import sampling as S
from ..operators import validate as V
from ..session import own_folder
from ..sources import readers as SRC
from .base import HOST, KIND, PART_JSON, STRIP, TEXT, count_n, n, parts_jsonld, query, t, with_kind
from .markup import _QUADS, _SCORE, quads

_DOMAIN = "concat('s', CAST(p_partkey % 50 AS VARCHAR(20)), '.ie')"


def _records(spark, sf):
    return parts_jsonld(spark, sf).selectExpr("p_partkey", "CASE WHEN p_partkey % 17 = 0 THEN '{}' ELSE jsonld END AS jsonld", f"concat('https://www.', {_DOMAIN}, '/p') AS source_url", "concat('<p>', CAST(p_partkey AS VARCHAR(20)), '</p>') AS html")


def _shots(spark, sf):
    return t(spark, sf, "supplier").selectExpr("concat('s', CAST(s_suppkey AS VARCHAR(20)), '.ie') AS domain").filter("substr(domain, 2, 1) < '6'").withColumn("path", F.concat(F.lit("shots/"), "domain", F.lit(".png")))


_USABLE = "(SELECT p_partkey, quality_score FROM (" + _SCORE + ") WHERE valid AND quality_score >= 0.3 AND p_partkey % 17 <> 0)"
_SHOTS = "(SELECT DISTINCT concat('s', CAST(s_suppkey AS VARCHAR(20)), '.ie') AS domain FROM supplier WHERE substr(CAST(s_suppkey AS VARCHAR(20)), 1, 1) < '6')"


@query(f"SELECT p_partkey, {_DOMAIN} AS domain, CASE WHEN s.domain IS NOT NULL THEN concat('shots/', s.domain, '.png') END AS screenshot, quality_score, row_number() OVER (ORDER BY md5(concat_ws('|', '42', CAST(p_partkey AS VARCHAR(20))))) AS place, md5(concat('{{\"messages\":[{{\"role\":\"system\",\"content\":\"{R.SYSTEM_PROMPT}\"}},{{\"role\":\"user\",\"content\":[', CASE WHEN s.domain IS NOT NULL THEN concat('{{\"type\":\"image\",\"image\":\"shots/', s.domain, '.png\"}},') ELSE '' END, '{{\"type\":\"text\",\"text\":\"<p>', p_partkey, '</p>\"}}]}},{{\"role\":\"assistant\",\"content\":', to_json(jsonld)::VARCHAR, '}}],\"metadata\":{{\"source\":\"wdc\",\"schema_types\":[\"Product\"],\"domain\":\"', {_DOMAIN}, '\",\"quality_score\":', quality_score, '}}}}')) AS digest FROM {_USABLE} u JOIN (SELECT p_partkey, {PART_JSON} AS jsonld FROM part) USING (p_partkey) LEFT JOIN {_SHOTS} s ON s.domain = {_DOMAIN}")
def assembled_examples(spark, sf):
    """The line is compared by its digest, the shuffled order by places in it."""
    rows = A.assembled(_records(spark, sf), _shots(spark, sf), "p_partkey").select("p_partkey", "domain", "screenshot", F.col("result.quality_score").alias("quality_score"), F.md5("value").alias("digest"), "rank")
    return S.placed(rows, "rank").select("p_partkey", "domain", "screenshot", "quality_score", n("place").alias("place"), "digest")


@query(f"SELECT p_partkey FROM {_USABLE} ORDER BY p_partkey LIMIT 25")
def assembled_capped(spark, sf):
    return A.assembled(_records(spark, sf), _shots(spark, sf), "p_partkey", most=25).select("p_partkey")


_RESULT = "CASE WHEN page_id % 5 = 0 THEN '[]' ELSE '[\"Product\"]' END"
_META = f"concat('\"metadata\":{{\"url\":', to_json(url)::VARCHAR, ',\"schema_types\":', {_RESULT}, ',\"quality_score\":0.5,\"property_count\":', page_id % 7"


def _labelled(spark, sf):
    k = F.col("page_id")
    result = F.struct(F.when(k % 5 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("Product"))).alias("types"), F.lit(0.5).alias("quality_score"), (k % 7).cast("int").alias("property_count"))
    shot = F.when(k % 4 != 0, F.concat(k.cast("string"), F.lit(".png")))
    return t(spark, sf, "pages").select("page_id", F.concat(F.lit("https://h.ie/"), k.cast("string")).alias("url"), F.concat(F.lit("<style>p{}</style>page "), k.cast("string"), F.when(k % 3 == 0, F.repeat(F.lit("ab "), 6000)).otherwise("")).alias("html"), F.concat(F.lit('{"a": '), k.cast("string"), F.lit("}")).alias("jsonld"), shot.alias("shot"), result.alias("result"))


_LINE = "concat('{\"messages\":[{\"role\":\"system\",\"content\":\"" + R.SYSTEM_PROMPT + "\"},{\"role\":\"user\",\"content\":[', CASE WHEN page_id % 4 <> 0 THEN concat('{\"type\":\"image\",\"image\":\"', page_id, '.png\"},') ELSE '' END, '{\"type\":\"text\",\"text\":', to_json(body)::VARCHAR, '}]},{\"role\":\"assistant\",\"content\":', to_json(answer)::VARCHAR, '}],', "
_LAB = "(SELECT page_id, 'https://h.ie/' || page_id AS url, 'page ' || page_id || CASE WHEN page_id % 3 = 0 THEN repeat('ab ', 6000) ELSE '' END AS shown FROM pages)"


@query(f"SELECT page_id, md5({_LINE} {_META}, ',\"has_screenshot\":', (page_id % 4 <> 0)::VARCHAR, '}}}}'))) AS digest FROM (SELECT *, 'Generate schema.org JSON-LD for this web page.' || chr(10) || chr(10) || 'HTML:' || chr(10) || trim(shown) AS body, '{{\"a\": ' || page_id || '}}' AS answer FROM {_LAB})")
def page_examples(spark, sf):
    c = F.col
    return _labelled(spark, sf).select("page_id", F.md5(A.page_example(c("html"), c("jsonld"), c("shot"), c("url"), c("result"))).alias("digest"))


@query(f"SELECT page_id, CASE WHEN page_id % 4 <> 0 THEN md5({_LINE} {_META}, '}}}}'))) END AS digest FROM (SELECT *, CASE WHEN length(raw) > 12000 THEN substr(raw, 1, 12000) || chr(10) || '<!-- [HTML truncated] -->' ELSE raw END AS body, '{{' || chr(10) || '  \"a\": ' || page_id || chr(10) || '}}' AS answer FROM (SELECT *, '<style>p{{}}</style>' || shown AS raw FROM {_LAB}))")
def screened_examples(spark, sf):
    c = F.col
    return _labelled(spark, sf).select("page_id", F.md5(A.screened_example(c("html"), c("jsonld"), c("shot"), c("url"), c("result"))).alias("digest"))


@query("SELECT doc_id, 'wdc' AS source, NULL::INT AS made FROM labels WHERE quality = 1 UNION ALL SELECT doc_id, 'synthetic', 1 FROM labels WHERE toxic = 1")
def synthetic_union(spark, sf):
    rows = t(spark, sf, "labels")
    return A.with_synthetic(rows.filter("quality = 1").select("doc_id"), rows.filter("toxic = 1").select("doc_id", F.lit(1).alias("made"))).select("doc_id", "source", "made")


@query("SELECT k AS url, first_n, last_n, html FROM (SELECT page_id % 300 AS k, min(page_id) AS first_n, max(page_id) AS last_n FROM pages GROUP BY 1) JOIN (SELECT doc_id % 400 AS k, max(lang) AS html FROM documents WHERE doc_id % 2 = 0 GROUP BY 1) USING (k)")
def records_joined(spark, sf):
    records = t(spark, sf, "pages").select((F.col("page_id") % 300).alias("url"), F.col("page_id").alias("n"))
    fetched = t(spark, sf, "documents").filter("doc_id % 2 = 0").groupBy((F.col("doc_id") % 400).alias("url")).agg(F.max("lang").alias("html"))
    first = A.records_with_html(records, fetched, "n").select("url", F.col("n").alias("first_n"))
    return first.join(A.records_with_html(records, fetched, "n", last=True).select("url", F.col("n").alias("last_n"), "html"), "url")


@query("SELECT l.doc_id AS page_id, p.url, 1.0::DOUBLE + length(j) % 5 AS overall_score, (1.0 + length(j) % 5 >= 3.5 AND length(j) % 2 = 0) AS rescore_pass FROM (SELECT *, repeat('x', (doc_id % 23)::INT) AS j FROM labels) l LEFT JOIN (SELECT page_id, max(url) AS url FROM pages GROUP BY 1) p ON p.page_id = l.doc_id")
def rescored_results(spark, sf):
    """Results joined with their pages, judged by the stub behind the judge's seam, and decided."""
    results = t(spark, sf, "labels").select(F.col("doc_id").alias("page_id"), F.repeat(F.lit("x"), (F.col("doc_id") % 23).cast("int")).alias("jsonld"))
    rows = A.rescored_results(results, t(spark, sf, "pages").select("page_id", "url", "html"))
    found = L.judge(rows)
    both = rows.select("page_id", "url").join(found, "page_id")
    return both.select("page_id", "url", "overall_score", V.rescored(F.col("overall_score"), F.col("passed"), F.col("error")).alias("rescore_pass"))


@query(f"SELECT page_id, coalesce(length(text) >= 300 AND NOT regexp_matches(substr(text, 1, 2000), '{R.PARKED_OLD}', 'i') AND page_id % 3 <> 1, false) AS ok FROM (SELECT page_id, {TEXT} AS text FROM pages)")
def early_gate(spark, sf):
    lang = F.when(F.col("page_id") % 3 == 0, "en").when(F.col("page_id") % 3 == 1, "de")
    return t(spark, sf, "pages").select("page_id", P.early_gate(F.col("html"), lang).alias("ok"))


@query("SELECT CASE WHEN k = 0 THEN 'no_html' WHEN length(html) < 200 THEN 'html_too_short' WHEN k = 1 THEN 'no_jsonld' WHEN k = 2 THEN 'invalid_jsonld' WHEN q < 0.3 THEN 'low_quality' ELSE 'accepted' END AS status, count(*) AS n FROM (SELECT html, page_id % 6 AS k, (page_id % 8) / 10.0 AS q FROM pages) GROUP BY 1")
def early_cascade(spark, sf):
    rows = t(spark, sf, "pages").select((F.col("page_id") % 6).alias("k"), ((F.col("page_id") % 8) / 10.0).alias("q"), "html")
    status = P.early_acceptance(F.when(F.col("k") != 0, F.col("html")), F.when(F.col("k") != 1, "{}"), F.col("k") != 2, F.col("q"))
    return rows.groupBy(status.alias("status")).agg(count_n())


_LINKS = "concat('https://', CASE s_suppkey % 9 WHEN 0 THEN 'www.yelp.ie' WHEN 1 THEN 'yell.com' WHEN 2 THEN 'goldenpages.ie' WHEN 3 THEN 'shop.etsy.com' WHEN 4 THEN 'wikihow.com' WHEN 5 THEN 'checkatrade.com' WHEN 6 THEN 'meetup.com' WHEN 7 THEN 'notonthehighstreet.com' ELSE 'eventbrite.ie' END, '/', CASE s_suppkey % 11 WHEN 0 THEN 'biz/' WHEN 1 THEN 'listing/a/b/' WHEN 2 THEN 'dp/' WHEN 3 THEN 'itm/' WHEN 4 THEN 'product/' WHEN 5 THEN 'e/' WHEN 6 THEN 'events/' WHEN 7 THEN 'Category:x/' WHEN 8 THEN 'trades/' WHEN 9 THEN 'Careers/' ELSE 'learn/' END, CAST(s_suppkey AS VARCHAR(20)))"
_BASE = "CASE WHEN s_suppkey % 2 = 0 THEN 'https://yelp.ie/search' ELSE 'https://meetup.com/x' END"
_HOSTS = "regexp_extract({},'^[^:/?#]+://([^/?#]*)',1)"
_U, _B = _HOSTS.format("u"), _HOSTS.format("b")


@query(
    f"SELECT s_suppkey, contains(u,'/biz/') AND contains({_U},{_B}) AS yelp, contains(u,'yell.com/biz/') AS yell, contains(u,'goldenpages.ie/') AND length(u)-length(replace(u,'/',''))>4 AS goldenpages, contains(u,'etsy.com/listing/') AS etsy, contains(u,'/dp/') OR contains(u,'/gp/product/') AS amazon, contains(u,'/itm/') AS ebay, "
    f"contains(u,'notonthehighstreet.com/') AND contains(u,'/product/') AS notonthehighstreet, contains(u,'/e/') AND contains(u,'eventbrite') AS eventbrite, contains(u,'meetup.com/') AND contains(u,'/events/') AS meetup, contains(u,'wikihow.com/') AND NOT contains(u,'/Category:') AND NOT regexp_matches(u,'wikihow.com/?$') AS wikihow, contains(u,'checkatrade.com/') AND contains(u,'/trades/') AND u<>b AS checkatrade, "
    f"contains(u,{_B}) AND regexp_matches(lower(u),'job|career|vacanc|position') AS job, contains(u,{_B}) AND regexp_matches(lower(u),'course|learn|class|program') AS course FROM (SELECT s_suppkey, {_LINKS} AS u, {_BASE} AS b FROM supplier)"
)
def link_tests(spark, sf):
    rows = t(spark, sf, "supplier").selectExpr("s_suppkey", f"{_LINKS} AS u", f"{_BASE} AS b")
    return rows.select("s_suppkey", *(f(F.col("u"), F.col("b")).alias(k) for k, f in U.LINK_TESTS.items()))


_HREFS = f"WITH l AS (SELECT page_id, {HOST} AS h, regexp_extract(url,'^([^:/?#]+):',1) AS s, unnest(regexp_extract_all(html,'href=\"([^\"]+)\"',1)) AS x, generate_subscripts(regexp_extract_all(html,'href=\"([^\"]+)\"',1),1) AS i FROM pages), r AS (SELECT page_id, h, i, CASE WHEN starts_with(x,'//') THEN s||':'||x WHEN starts_with(x,'/') THEN s||'://'||h||x ELSE x END AS link FROM l), f AS (SELECT page_id, link, min(i) AS i FROM r WHERE starts_with(link,'http') AND contains(link, h) GROUP BY ALL) "


@query(_HREFS + "SELECT page_id, link FROM f QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY i) <= CASE page_id % 3 WHEN 0 THEN 40 WHEN 1 THEN 50 ELSE 30 END")
def page_links_capped(spark, sf):
    """Links on the page's own site, without repeats: up to 40, 50 or 30 a page."""
    rows = t(spark, sf, "pages").select("page_id", "url", U.resolved_links(F.col("html"), F.col("url")).alias("links"))
    keep = F.transform("links", lambda x: U.on_site(x, F.col("url")))
    own = lambda k: U.capped_links(F.col("links"), keep, k)
    k = F.col("page_id") % 3
    return rows.select("page_id", F.explode(F.when(k == 0, own(40)).when(k == 1, own(50)).otherwise(own(30))).alias("link"))


@query(f"SELECT length(html) > 2000 AS large, string_split({HOST},'.')[-1] AS tld, count(*) AS n, min(url) AS sample FROM pages WHERE contains(html, '</body>') GROUP BY ALL")
def index_table_scan(spark, sf):
    """A hive-partitioned index of two crawls: each is read by its folders, and pages that were cut off are in another subset's."""
    path = f"{own_folder(spark, 'index')}/rows"
    crawl = F.when(F.length("html") > 2000, "large").otherwise("small")
    subset = F.when(F.contains("html", F.lit("</body>")), "warc").otherwise("crawldiagnostics")
    t(spark, sf, "pages").select("url", crawl.alias("crawl"), subset.alias("subset")).write.partitionBy("crawl", "subset").parquet(path)
    each = [SRC.read_index(spark, path, k).groupBy(F.lit(k == "large").alias("large"), F.substring_index(U.authority(F.col("url")), ".", -1).alias("tld")).agg(count_n(), F.min("url").alias("sample")) for k in ("large", "small")]
    return each[0].unionByName(each[1])


@query(f"SELECT {HOST} AS domain, count(*) AS page_count, min(url) AS sample_url FROM pages WHERE ends_with({HOST}, '.org') GROUP BY 1 ORDER BY page_count DESC, domain LIMIT 200000")
def catalog_index_query(spark, sf):
    rows = t(spark, sf, "pages").select("url", U.authority(F.col("url")).alias("host"))
    return SRC.catalog_query(spark, "SELECT host AS domain, count(*) AS page_count, min(url) AS sample_url FROM {crawl_index} WHERE endswith(host, '.org') GROUP BY host ORDER BY page_count DESC, domain LIMIT 200000", crawl_index=rows)


@query(_QUADS + ", m AS (SELECT file, line_no, regexp_extract(line, '^<([^>]+)>', 1) AS url FROM l) SELECT file, line_no, url FROM m WHERE starts_with(url, 'http') AND regexp_matches(regexp_extract(url,'^[^:/?#]+://([^/?#]*)',1), '\\.ie$') QUALIFY row_number() OVER (PARTITION BY file ORDER BY line_no) <= 60")
def nquads_page_urls(spark, sf):
    return SRC.page_urls(quads(spark, sf), 30)


@query(_QUADS + ", m AS (SELECT file, line_no, unnest(regexp_extract_all(line, '<(https?://[^>]+)>', 1)) AS url FROM l) SELECT file, line_no, url FROM m WHERE NOT starts_with(url, 'http://schema.org') AND NOT starts_with(url, 'https://schema.org')")
def nquads_iris(spark, sf):
    return SRC.link_iris(quads(spark, sf))


@query("SELECT page_id, file_name FROM (SELECT page_id, substr(replace(replace(url,'://','_'),'/','_'),1,100) AS file_name FROM pages) WHERE file_name NOT IN (SELECT substr(replace(replace(url,'://','_'),'/','_'),1,100) FROM pages WHERE page_id % 3 = 0)")
def cached_fetch(spark, sf):
    p = t(spark, sf, "pages").select("page_id", "url")
    cached = p.filter("page_id % 3 = 0").select(U.file_name(F.col("url"), "plain").alias("file_name"))
    return SRC.to_fetch(p, cached).select("page_id", "file_name")


@query(f"WITH k AS (SELECT {KIND} AS gold, CASE WHEN page_id % 4 = 0 THEN 'Product' ELSE {KIND} END AS pred FROM pages), g AS (SELECT gold AS kind, count(*) AS gold FROM k GROUP BY 1 ORDER BY gold DESC, kind LIMIT 8) SELECT kind, gold, coalesce(p.n, 0)::BIGINT AS predicted FROM g LEFT JOIN (SELECT pred, count(*) AS n FROM k GROUP BY 1) p ON p.pred = kind")
def gold_and_predicted(spark, sf):
    rows = with_kind(t(spark, sf, "pages").select("page_id"))
    return G.gold_and_predicted(rows.withColumn("pred", F.when(F.col("page_id") % 4 == 0, "Product").otherwise(F.col("schema_type"))), "schema_type", "pred")


_WEIGHTS = "(VALUES " + ",".join(f"('{k}',{w})" for k, w in R.TYPE_WEIGHTS.items() if k != "Person") + ") AS q(schema_type, want)"


@query(f"SELECT schema_type, round(100.0 * n / (SELECT count(*) FROM pages), 6)::DOUBLE AS share, round(100.0 * want / (SELECT sum(want) FROM {_WEIGHTS}), 6)::DOUBLE AS target FROM (SELECT {KIND} AS schema_type, count(*) AS n FROM pages GROUP BY 1) JOIN {_WEIGHTS} USING (schema_type)")
def share_and_target(spark, sf):
    want = spark.createDataFrame([(k, w) for k, w in R.TYPE_WEIGHTS.items() if k != "Person"], "schema_type string, want long")
    return G.share_and_target(G.frequencies(with_kind(t(spark, sf, "pages").select("page_id")), "schema_type"), want, "schema_type")


_TYPED = "concat('<script type=\"application/ld+json\">', CASE page_id % 5 WHEN 0 THEN '{\"@type\":[\"Product\",\"Offer\"]}' WHEN 1 THEN '[{\"@type\":\"Event\"},{\"@type\":\"Place\"}]' WHEN 2 THEN '{\"@type\":\"Event\"}' WHEN 3 THEN '{\"name\":1}' ELSE '{oops' END, '</script>', CASE WHEN page_id % 2 = 0 THEN '<script type=\"application/ld+json\">{\"@type\":\"Event\"}</script>' ELSE '' END)"
_LISTS = "(SELECT page_id, list_sort(list_distinct(CASE page_id % 5 WHEN 0 THEN ['Product','Offer'] WHEN 1 THEN ['Event','Place'] WHEN 2 THEN ['Event'] ELSE [] END || CASE WHEN page_id % 2 = 0 THEN ['Event'] ELSE [] END)) AS types FROM pages)"


@query(f"SELECT page_id, array_to_string(types, ',') AS types FROM {_LISTS}")
def declared_types(spark, sf):
    return t(spark, sf, "pages").selectExpr("page_id", f"{_TYPED} AS html").select("page_id", F.array_join(H.declared_types(F.col("html")), ",").alias("types"))


@query(f"SELECT value, count(*) AS n FROM (SELECT unnest(types) AS value FROM {_LISTS}) GROUP BY 1")
def declared_type_counts(spark, sf):
    rows = t(spark, sf, "pages").selectExpr("page_id", f"{_TYPED} AS html")
    return G.listed_counts(rows.select(H.declared_types(F.col("html")).alias("types")), "types")


@query("SELECT op, count(*) AS n FROM (SELECT 'union' AS op, k FROM (SELECT c_custkey % 70 AS k FROM customer UNION SELECT s_suppkey % 90 FROM supplier) UNION ALL SELECT 'intersect', k FROM (SELECT c_custkey % 70 AS k FROM customer INTERSECT SELECT s_suppkey % 90 FROM supplier) UNION ALL SELECT 'except', k FROM (SELECT s_suppkey % 90 AS k FROM supplier EXCEPT SELECT c_custkey % 70 FROM customer)) GROUP BY 1")
def set_algebra(spark, sf):
    a, b = t(spark, sf, "customer").select((F.col("c_custkey") % 70).alias("k")), t(spark, sf, "supplier").select((F.col("s_suppkey") % 90).alias("k"))
    parts = [("union", a.union(b).distinct()), ("intersect", a.intersect(b)), ("except", b.subtract(a))]
    rows = [df.select(F.lit(op).alias("op"), "k") for op, df in parts]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).groupBy("op").agg(count_n())


@query("WITH p AS (SELECT page_id % 100 AS domain, page_id AS v FROM pages) SELECT d.domain, max(m.v) AS markup, max(s.v) AS shot FROM (SELECT DISTINCT domain FROM p) d JOIN (SELECT DISTINCT domain FROM p WHERE v % 3 <> 0) f USING (domain) LEFT JOIN (SELECT * FROM p WHERE v % 2 = 0) m ON m.domain = d.domain LEFT JOIN (SELECT * FROM p WHERE v % 5 = 0) s ON s.domain = d.domain WHERE d.domain % 7 <> 0 GROUP BY d.domain")
def inference_queue_last(spark, sf):
    """Several rows of markup and screenshots for a domain: the last ones count, and no domain is repeated."""
    p = t(spark, sf, "pages").select((F.col("page_id") % 100).alias("domain"), F.col("page_id").alias("v"))
    return A.inference_queue(p.select("domain").distinct(), p.filter("domain % 7 = 0"), p.filter("v % 3 <> 0"), p.filter("v % 2 = 0").withColumnRenamed("v", "markup"), p.filter("v % 5 = 0").withColumnRenamed("v", "shot"))


@query(f"SELECT page_id, md5({STRIP}) AS digest, {KIND} AS schema_type FROM pages WHERE page_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0) AND page_id % 4 <> 0 AND page_id IN (SELECT doc_id FROM labels)")
def labels_pages_shots(spark, sf):
    """Labels that have a page and a screenshot."""
    labels = t(spark, sf, "labels").filter("quality = 1").select(F.col("doc_id").alias("page_id"))
    shots = t(spark, sf, "pages").filter("page_id % 4 <> 0").select("page_id")
    rows = with_kind(t(spark, sf, "pages")).join(labels.distinct(), "page_id", "left_semi")
    return rows.join(shots, "page_id", "left_semi").select("page_id", F.md5(H.strip_noise(F.col("html"))).alias("digest"), "schema_type")
