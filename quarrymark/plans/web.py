"""Queries over pages: URLs, markup, gates and links."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import reference_data as R
from ..functions import html as H
from ..functions import urls as U
from ..operators import pages as P
from ..operators import sampling as S
from .base import count_n, HOST, KIND, STRIP, TEXT, n, query, t, with_kind

TLD2 = f"(CASE WHEN len(string_split({HOST},'.'))>=3 AND string_split({HOST},'.')[-2] IN ('co','com','org','net') THEN array_to_string(string_split({HOST},'.')[-2:],'.') ELSE string_split({HOST},'.')[-1] END)"
SCORE = "(" + "+".join(f"(contains(lower(substr(text,1,500)),' {w} '))::INT" for w in R.STOPWORDS) + ")"
KNOWN = "(" + " OR ".join(f"h='{d}' OR ends_with(h,'.{d}')" for d in R.KNOWN_ENGLISH) + ")"
STATUS = f"CASE WHEN length(text)<400 THEN 'short' WHEN regexp_matches(substr(text,1,2000),'{R.PARKED}','i') THEN 'parked' WHEN {KNOWN} OR {SCORE}>=2 THEN 'ok' ELSE 'not_english' END"
GATED = f"(SELECT *, {STATUS} AS status FROM (SELECT *, {TEXT} AS text, lower({HOST}) AS h FROM pages))"


@query(f"SELECT status, string_split(h,'.')[-1] AS tld, count(*) AS n, sum(length(text))::BIGINT AS chars, max(length(text)) AS longest FROM {GATED} GROUP BY ALL")
def page_quality_by_tld(spark, sf):
    gated = P.with_gate(t(spark, sf, "pages")).select("status", F.substring_index(F.lower(U.authority(F.col("url"))), ".", -1).alias("tld"), n(F.length("text")).alias("chars"))
    return gated.groupBy("status", "tld").agg(count_n(), F.sum("chars").alias("chars"), F.max("chars").alias("longest"))


@query(f"SELECT page_id, {HOST} AS authority, regexp_replace({HOST},'^www\\.','') AS domain, ltrim({HOST},'w.') AS compat, string_split(url,'/')[3] AS piece FROM pages")
def url_domain_variants(spark, sf):
    u = F.col("url")
    return t(spark, sf, "pages").select("page_id", U.authority(u).alias("authority"), U.domain(u).alias("domain"), U.domain(u, compat=True).alias("compat"), U.third_piece(u).alias("piece"))


@query(f"SELECT {TLD2} AS tld, CASE WHEN ends_with({HOST},'.co.uk') THEN 'co.uk' ELSE string_split({HOST},'.')[-1] END AS bucket, count(*) AS n FROM pages GROUP BY ALL")
def tld_two_level(spark, sf):
    host = U.authority(F.col("url"))
    return t(spark, sf, "pages").groupBy(U.tld(host).alias("tld"), U.tld_bucket(host).alias("bucket")).agg(count_n())


_ENGLISH = " OR ".join(f"ends_with(lower({HOST}),'{s}')" for s in R.ENGLISH_SUFFIXES)
_STRICT = " OR ".join(f"ends_with(lower({HOST}),'{s}')" for s in R.STRICT_SUFFIXES)


@query(f"SELECT page_id, ({_ENGLISH}) AS english, ({_STRICT}) AS strict, (lower({HOST})='org' OR ends_with(lower({HOST}),'.org')) AS org, (ends_with(url,'.net') OR contains(url,'.net/')) AS net_anywhere FROM pages")
def english_tld_filter(spark, sf):
    u = F.col("url")
    return t(spark, sf, "pages").select("page_id", U.english_tld(u).alias("english"), U.english_tld(u, strict=True).alias("strict"), U.tld_filter(u, "org").alias("org"), U.anywhere_filter(u, "net").alias("net_anywhere"))


_SITES = "concat('https://', CASE s_suppkey % 4 WHEN 0 THEN 'www.yelp.ie' WHEN 1 THEN 'notyelp.ie' WHEN 2 THEN 'bbc.co.uk' ELSE 'shop.etsy.com' END, '/', CASE s_suppkey % 3 WHEN 0 THEN 'biz/' WHEN 1 THEN 'menu/' ELSE 'listing/a/b/' END, CAST(s_suppkey AS VARCHAR(20)))"


@query(f"SELECT s_suppkey, url, {KNOWN} AS known, contains(url,'.co.uk') OR ends_with(url,'.uk') AS uk FROM (SELECT *, lower({HOST}) AS h FROM (SELECT s_suppkey, {_SITES} AS url FROM supplier))")
def known_english_filter(spark, sf):
    rows = t(spark, sf, "supplier").selectExpr("s_suppkey", f"{_SITES} AS url")
    return rows.select("s_suppkey", "url", U.known_english(F.col("url")).alias("known"), U.uk_filter(F.col("url")).alias("uk"))


@query(f"SELECT s_suppkey, contains(url,'/biz/') AS biz, length(url)-length(replace(url,'/',''))>4 AS deep, contains(url,'/listing/') AS listing FROM (SELECT s_suppkey, {_SITES} AS url FROM supplier)")
def site_link_filters(spark, sf):
    rows = t(spark, sf, "supplier").selectExpr("s_suppkey", f"{_SITES} AS url")
    return rows.select("s_suppkey", *(U.SITE_LINKS[k](F.col("url")).alias(k) for k in ("biz", "deep", "listing")))


@query("SELECT page_id, md5(url) AS url_hash, substr(regexp_replace(url,'[^0-9A-Za-z_]','_','g'),1,120) AS word_name, substr(replace(replace(url,'://','_'),'/','_'),1,100) AS plain_name, substr(translate(replace(replace(url,'://','_'),'/','_'),'?&','__'),1,120) AS query_name FROM pages")
def url_hash_filename(spark, sf):
    u = F.col("url")
    return t(spark, sf, "pages").select("page_id", F.md5(u).alias("url_hash"), U.file_name(u).alias("word_name"), U.file_name(u, "plain").alias("plain_name"), U.file_name(u, "query").alias("query_name"))


_PATHS = "concat('https://b', CAST(c_custkey AS VARCHAR(20)), '.', CASE c_custkey % 3 WHEN 0 THEN 'co.uk' WHEN 1 THEN 'ie' ELSE 'ca' END, CASE c_custkey % 7 WHEN 0 THEN '/menu' WHEN 1 THEN '/recipes/1' WHEN 2 THEN '/events/2' WHEN 3 THEN '/about' WHEN 4 THEN '/blog/faq' WHEN 5 THEN '/' ELSE '/products/3' END)"
_LADDER = "CASE " + " ".join("WHEN " + " OR ".join(f"contains(url,'{p}')" for p in pieces) + f" THEN '{k}'" for pieces, k, _ in R.PATH_TYPES) + " ELSE 'LocalBusiness' END"


@query(f"SELECT c_custkey, {_LADDER} AS probable_type FROM (SELECT c_custkey, {_PATHS} AS url FROM customer)")
def probable_type_case(spark, sf):
    return t(spark, sf, "customer").selectExpr("c_custkey", f"{_PATHS} AS url").select("c_custkey", U.probable_type(F.col("url")).alias("probable_type"))


_ALL = " UNION ALL ".join("SELECT c_custkey, url, '" + k + "' AS schema_type FROM u WHERE " + " OR ".join(f"contains(url,'{p}')" for p in pieces) for pieces, k, _ in R.PATH_TYPES)


#: The limits of the types, and that of home pages (fixed value).
_LIMITS = {**{k: m for _, k, m in R.PATH_TYPES}, "LocalBusiness": 20_000}
_MOST = " ".join(f"WHEN '{k}' THEN {m}" for k, m in _LIMITS.items())


@query(f"WITH u AS (SELECT c_custkey, {_PATHS} AS url FROM customer), m AS ({_ALL} UNION ALL SELECT c_custkey, url, 'LocalBusiness' FROM u WHERE regexp_extract(url,'^[^:/?#]+://[^/?#]*([^?#]*)',1)='/' OR contains(url,'/about') OR contains(url,'/services')) SELECT c_custkey, schema_type FROM m QUALIFY row_number() OVER (PARTITION BY schema_type ORDER BY c_custkey) <= CASE schema_type " + _MOST + " END")
def type_pattern_branches(spark, sf):
    rows = t(spark, sf, "customer").selectExpr("c_custkey", f"{_PATHS} AS url").select("c_custkey", F.explode(U.matching_types(F.col("url"))).alias("schema_type"))
    most = F.create_map(*(F.lit(x) for kv in _LIMITS.items() for x in kv))
    return S.capped(rows, "schema_type", most[F.col("schema_type")], "c_custkey", ceiling=max(_LIMITS.values()))


_RLIKE = [(U.wildcard(p), k, m, i) for i, (p, k, m) in enumerate(R.CRAWL_PATTERNS)]
_CRAWL = "WITH u AS (SELECT c_custkey, " + _PATHS + " AS url FROM customer), m AS (" + " UNION ALL ".join(f"SELECT c_custkey, url, '{k}' AS schema_type, {i} AS pattern FROM u WHERE regexp_matches(url, '{p}')" for p, k, _, i in _RLIKE) + ") "


@query(_CRAWL + ", d AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY url ORDER BY pattern) = 1) SELECT c_custkey, schema_type, pattern FROM d QUALIFY row_number() OVER (PARTITION BY pattern ORDER BY c_custkey) <= CASE pattern " + " ".join(f"WHEN {i} THEN {m}" for _, _, m, i in _RLIKE) + " END")
def crawl_patterns(spark, sf):
    return _crawled(spark, sf, _RLIKE)


def _crawled(spark, sf, patterns):
    """The patterns are an array constant, so no join: each URL explodes to those that fit."""
    rows = t(spark, sf, "customer").selectExpr("c_custkey", f"{_PATHS} AS url")
    fits = F.array_compact(F.array(*(F.when(F.col("url").rlike(p), F.struct(F.lit(k).alias("schema_type"), F.lit(i).alias("pattern"))) for p, k, _, i in patterns)))
    first = S.first_per(rows.select("c_custkey", "url", F.explode(fits).alias("m")).select("c_custkey", "url", "m.schema_type", "m.pattern"), "url", "pattern")
    most = F.create_map(*(F.lit(x) for _, _, m, i in patterns for x in (i, m)))
    return S.capped(first, "pattern", most[F.col("pattern")], "c_custkey", ceiling=max(m for _, _, m, _ in patterns)).select("c_custkey", "schema_type", "pattern")


_BLIKE = [(U.wildcard(p), k, m, i) for i, (p, k, m) in enumerate(R.BUSINESS_PATTERNS)]
_BUSINESS = _CRAWL.split("m AS (")[0] + "m AS (" + " UNION ALL ".join(f"SELECT c_custkey, url, '{k}' AS schema_type, {i} AS pattern FROM u WHERE regexp_matches(url, '{p}')" for p, k, _, i in _BLIKE) + ") "


@query(_BUSINESS + ", d AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY url ORDER BY pattern) = 1) SELECT c_custkey, schema_type, pattern FROM d QUALIFY row_number() OVER (PARTITION BY pattern ORDER BY c_custkey) <= CASE pattern " + " ".join(f"WHEN {i} THEN {m}" for _, _, m, i in _BLIKE) + " END")
def business_patterns(spark, sf):
    return _crawled(spark, sf, _BLIKE)


@query("WITH d AS (SELECT DISTINCT concat('s', s_suppkey % 40, '.ie') AS domain FROM supplier ORDER BY domain LIMIT 500), u AS (SELECT 'https://' || domain || p AS url FROM d, (VALUES ('/services'),('/our-services'),('/what-we-do')) AS v(p)) SELECT url FROM u WHERE url NOT IN (SELECT concat('https://s', s_suppkey % 7, '.ie/services') FROM supplier)")
def derived_urls(spark, sf):
    s = t(spark, sf, "supplier")
    known = s.selectExpr("concat('https://s', s_suppkey % 7, '.ie/services') AS url")
    return S.derived_urls(s.selectExpr("concat('s', s_suppkey % 40, '.ie') AS domain"), ["/services", "/our-services", "/what-we-do"], known, 500)


@query(f"SELECT page_id, md5(s) AS digest, length(s) AS chars, length(CASE WHEN length(s)>2000 THEN substr(s,1,2000)||chr(10)||'<!-- [HTML truncated] -->' ELSE s END) AS cut FROM (SELECT page_id, {STRIP} AS s FROM pages)")
def strip_html_noise(spark, sf):
    s = t(spark, sf, "pages").select("page_id", H.strip_noise(F.col("html")).alias("s"))
    return s.select("page_id", F.md5("s").alias("digest"), n(F.length("s")).alias("chars"), n(F.length(H.truncated(F.col("s"), 2000))).alias("cut"))


_TRIM = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,'<script\b[^>]*>.*?</script>','','gis'),'<style\b[^>]*>.*?</style>','','gis'),'<svg\b[^>]*>.*?</svg>','','gis'),'<!--.*?-->','','gs'),'\s+data-[a-z-]+="[^"]*"','','g'),'\s+class="[^"]{100,}"','','g'),'\s{2,}',' ','g'),'>\s+<','>'||chr(10)||'<','g')"""


@query(
    f"WITH a AS (SELECT page_id, {_TRIM} AS x FROM pages), b AS (SELECT *, regexp_extract(x,'<head\\b[^>]*>.*?</head>',0,'is') AS head, CASE WHEN regexp_matches(x,'<body\\b[^>]*>','i') THEN regexp_extract(x,'<body\\b[^>]*>(.*)',1,'is') ELSE x END AS body FROM a) "
    "SELECT page_id, md5(regexp_replace(CASE WHEN length(x)>2000 THEN head||chr(10)||'<body>'||chr(10)||substr(body,1,greatest(1900-length(head),0))||chr(10)||'<!-- truncated -->'||chr(10)||'</body>' ELSE x END,'^\\s+|\\s+$','','g')) AS digest FROM b"
)
def trim_html_budget(spark, sf):
    return t(spark, sf, "pages").select("page_id", F.md5(H.trimmed(F.col("html"), 500)).alias("digest"))


@query(f"SELECT status, count(*) AS n, sum(length(text))::BIGINT AS chars, sum(length(trim(regexp_replace(regexp_replace(html,'<[^>]+>',' ','g'),'\\s+',' ','g'))))::BIGINT AS tagless, sum(length(CASE WHEN length(text)>400 THEN substr(text,1,400)||'...' ELSE text END))::BIGINT AS snippets FROM {GATED} GROUP BY status")
def html_text_length_stats(spark, sf):
    g = P.with_gate(t(spark, sf, "pages")).select("status", n(F.length("text")).alias("a"), n(H.tagless_length(F.col("html"))).alias("b"), n(F.length(H.snippet(F.col("text")))).alias("c"))
    return g.groupBy("status").agg(count_n(), F.sum("a").alias("chars"), F.sum("b").alias("tagless"), F.sum("c").alias("snippets"))


@query(f"WITH l AS (SELECT page_id, {HOST} AS h, regexp_extract(url,'^([^:/?#]+):',1) AS s, unnest(regexp_extract_all(html,'href=\"([^\"]+)\"',1)) AS x, generate_subscripts(regexp_extract_all(html,'href=\"([^\"]+)\"',1),1) AS i FROM pages), r AS (SELECT page_id, i, CASE WHEN starts_with(x,'//') THEN s||':'||x WHEN starts_with(x,'/') THEN s||'://'||h||x ELSE x END AS link FROM l) SELECT page_id, link FROM r WHERE starts_with(link,'http')")
def link_extract(spark, sf):
    return t(spark, sf, "pages").select("page_id", F.explode(U.resolved_links(F.col("html"), F.col("url"))).alias("link"))


@query("SELECT page_id, substr(regexp_replace(regexp_extract(html,'<title[^>]*>([^<]+)</title>',1,'i'),'^\\s+|\\s+$','','g'),1,100) AS title, replace(replace(replace(substr(regexp_replace(regexp_extract(html,'<title[^>]*>([^<]+)</title>',1,'i'),'^\\s+|\\s+$','','g'),1,100),'&','&amp;'),'<','&lt;'),'>','&gt;') AS escaped FROM pages")
def title_extract(spark, sf):
    return t(spark, sf, "pages").select("page_id", H.title(F.col("html")).alias("title")).select("*", H.escaped(F.col("title")).alias("escaped"))


_PARK = "concat('<p>', CASE page_id % 4 WHEN 0 THEN 'This Domain is parked' WHEN 1 THEN 'access denied' ELSE 'fine' END, '</p>', html)"


@query(f"SELECT regexp_matches(substr(text,1,2000),'{R.PARKED}','i') AS parked, regexp_matches(substr(text,1,2000),'{R.PARKED_OLD}','i') AS parked_old, count(*) AS n FROM (SELECT {TEXT} AS text FROM (SELECT page_id, {_PARK} AS html FROM pages)) GROUP BY ALL")
def parked_pages(spark, sf):
    text = t(spark, sf, "pages").selectExpr("page_id", f"{_PARK} AS html").select(H.visible_text(F.col("html")).alias("text"))
    return text.groupBy(H.parked(F.col("text")).alias("parked"), H.parked(F.col("text"), R.PARKED_OLD).alias("parked_old")).agg(count_n())


_BLOCKS = "concat(html, '<script type=\"application/ld+json\"> {\"@type\":\"A\",\"n\":', CAST(page_id AS VARCHAR(20)), '} </script>', CASE WHEN page_id % 2 = 0 THEN '<SCRIPT id=x type=''application/ld+json''>[]</SCRIPT>' ELSE '' END)"
_PATTERN = "<script[^>]+type=[\"'']application/ld\\+json[\"''][^>]*>(.*?)</script>"


@query(f"SELECT page_id, unnest(list_transform(regexp_extract_all(html,'{_PATTERN}',1,'is'), lambda x: regexp_replace(x,'^\\s+|\\s+$','','g'))) AS block FROM (SELECT page_id, {_BLOCKS.replace(chr(39) * 2, chr(39) * 2)} AS html FROM pages)")
def jsonld_block_extract(spark, sf):
    extra = F.when(F.col("page_id") % 2 == 0, F.lit("<SCRIPT id=x type='application/ld+json'>[]</SCRIPT>")).otherwise(F.lit(""))
    html = F.concat("html", F.lit('<script type="application/ld+json"> {"@type":"A","n":'), F.col("page_id").cast("string"), F.lit("} </script>"), extra)
    return t(spark, sf, "pages").select("page_id", F.explode(H.jsonld_blocks(html)).alias("block"))


@query(f"SELECT {HOST} AS domain, count(*) AS n, min(url) AS min_url, arg_min(page_id, url) AS first_page FROM (SELECT *, CASE WHEN page_id % 9 = 0 THEN 404 ELSE 200 END AS status FROM pages) WHERE status = 200 AND ends_with({HOST},'.com') GROUP BY 1 ORDER BY n DESC, domain LIMIT 200000")
def cc_domain_index(spark, sf):
    rows = t(spark, sf, "pages").withColumn("status", F.when(F.col("page_id") % 9 == 0, 404).otherwise(200)).filter("status = 200").select("page_id", "url", U.authority(F.col("url")).alias("domain")).filter(F.endswith("domain", F.lit(".com")))
    return rows.groupBy("domain").agg(count_n(), F.min("url").alias("min_url"), F.min_by("page_id", "url").alias("first_page")).orderBy(F.desc("n"), "domain").limit(200_000)


@query(f"WITH g AS (SELECT page_id, length(html) AS raw, {STRIP} AS s, page_id % 6 AS k, 0.1 * (page_id % 8) AS q FROM pages) SELECT CASE WHEN raw<200 THEN 'html_too_short' WHEN raw>300000 THEN 'html_too_long' WHEN length(s)>64000 THEN 'html_too_long' WHEN k=1 THEN 'no_jsonld' WHEN k=2 THEN 'invalid_jsonld' WHEN q<0.3 THEN 'low_quality' WHEN k=4 THEN 'encoding_corrupted' WHEN k=5 THEN 'no_screenshot' ELSE 'accepted' END AS status, count(*) AS n FROM g GROUP BY 1")
def acceptance_cascade_v1(spark, sf):
    k = F.col("page_id") % 6
    rows = t(spark, sf, "pages").select("html", H.strip_noise(F.col("html")).alias("s"), k.alias("k"), (F.lit(0.1) * (F.col("page_id") % 8)).alias("q"))
    jsonld = F.when(F.col("k") == 1, "").when(F.col("k") == 4, "{\"a\":\"Ã\"}").otherwise("{}")
    shot = F.when(F.col("k") != 5, "x.png")
    return rows.groupBy(P.acceptance(F.col("html"), F.col("s"), jsonld, F.col("k") != 2, F.col("q"), shot).alias("status")).agg(count_n())


@query("WITH l AS (SELECT doc_id, quality, toxic, p.html FROM labels LEFT JOIN pages p ON p.page_id = doc_id) SELECT CASE WHEN doc_id % 10 = 0 THEN 'parse_error' WHEN toxic = 1 THEN 'invalid' WHEN quality = 0 THEN 'low_quality' WHEN html IS NULL THEN 'no_page' WHEN length(html) < 200 THEN 'short_html' ELSE 'accepted' END AS status, count(*) AS n FROM l GROUP BY 1")
def acceptance_cascade_v2(spark, sf):
    rows = t(spark, sf, "labels").join(t(spark, sf, "pages").select(F.col("page_id").alias("doc_id"), "html"), "doc_id", "left")
    return rows.groupBy(P.label_acceptance(F.col("doc_id") % 10 != 0, F.col("toxic") == 0, F.col("quality").cast("double"), F.col("html")).alias("status")).agg(count_n())


@query(f"SELECT schema_type, count(*) AS n FROM (SELECT page_id, {KIND} AS schema_type, length(html) AS chars FROM pages) WHERE chars > 200 AND page_id IN (SELECT page_id FROM pages WHERE page_id % 3 <> 0) GROUP BY 1")
def ready_pages(spark, sf):
    pages = with_kind(t(spark, sf, "pages"))
    return P.ready(pages, pages.filter("page_id % 3 <> 0"), "page_id").groupBy("schema_type").agg(count_n())


@query()
def parsed_page_text(spark, sf):
    """Stateful parser text; no SQL form."""
    return t(spark, sf, "pages").select("page_id", n(F.length(H.parsed_text("html"))).alias("chars"))
