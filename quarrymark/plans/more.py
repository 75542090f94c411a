"""Queries over seams, prompts, exports and remaining markup functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import reference_data as R
from ..functions import html as H
from ..functions import jsontext as J
from ..functions import urls as U
from ..operators import assemble as A
from ..operators import judge as D
from ..operators import pages as P
from ..operators import sampling as S
from ..operators import validate as V
from .base import KIND, PART_JSON, count_n, n, parts_jsonld, query, t, with_kind
from .web import _SITES

_KEY = "CAST(page_id AS VARCHAR(20))"
#: A block of markup for some pages: rich, poor, broken or none.
_MARKED = (
    "concat('<html>', CASE page_id % 4 WHEN 0 THEN concat('<script type=\"application/ld+json\">{\"@context\":\"https://schema.org\",\"@type\":\"Product\",\"name\":\"n\",\"image\":\"i\",\"description\":\"d\",\"brand\":\"b\",\"sku\":\"', "
    + _KEY + ", '\"}</script>') WHEN 1 THEN '<script type=\"application/ld+json\">{\"@type\":\"Product\"}</script>' WHEN 2 THEN '<script type=\"application/ld+json\">{oops</script>' ELSE '' END, '</html>')"
)


def marked(spark, sf):
    return t(spark, sf, "pages").selectExpr("page_id", f"{_MARKED} AS html")


@query("SELECT page_id FROM pages WHERE page_id % 4 = 0")
def quality_markup_pages(spark, sf):
    return V.pages_with_quality_markup(marked(spark, sf), "page_id")


@query("SELECT page_id FROM pages WHERE page_id % 4 <> 0")
def generation_targets(spark, sf):
    rows = marked(spark, sf)
    return S.without(rows, V.pages_with_quality_markup(rows, "page_id"), "page_id").select("page_id")


@query("SELECT count(*) AS n, count(*) FILTER (WHERE page_id % 4 < 3) AS still, round(100.0 * count(*) FILTER (WHERE page_id % 4 < 3) / count(*), 6)::DOUBLE AS share FROM pages")
def manifest_consistency(spark, sf):
    has = F.size(H.jsonld_blocks(F.col("html"))) > 0
    return marked(spark, sf).agg(count_n(), F.count_if(has).alias("still"), F.round(F.try_divide(100.0 * F.count_if(has), F.count("*")), 6).cast("double").alias("share"))


@query("SELECT doc_id, length(text) > 1500 AND quality = 1 AS exported FROM labels JOIN documents USING (doc_id)")
def export_filter(spark, sf):
    """Valid and factual enough: here from labels and text lengths."""
    rows = t(spark, sf, "labels").join(t(spark, sf, "documents").select("doc_id", F.length("text").alias("chars")), "doc_id")
    score = F.when(F.col("chars") > 1500, 0.6).otherwise(0.4)
    return rows.select("doc_id", ((F.col("quality") == 1) & (score >= 0.5)).alias("exported"))


_PROMPTS = " ".join(f"WHEN '{k}' THEN '{v.replace(chr(39), chr(39) * 2)}'" for k, v in R.TYPE_HINTS.items())


@query(f"SELECT page_id, '{R.SYSTEM_PROMPT}' || coalesce(chr(10) || chr(10) || CASE k {_PROMPTS} END, '') AS prompt FROM (SELECT page_id, CASE page_id % 16 WHEN 15 THEN 'Hotel' WHEN 14 THEN 'Restaurant' ELSE {KIND} END AS k FROM pages)")
def type_prompts(spark, sf):
    rows = with_kind(t(spark, sf, "pages").select("page_id"))
    kind = F.when(F.col("page_id") % 16 == 15, "Hotel").when(F.col("page_id") % 16 == 14, "Restaurant").otherwise(F.col("schema_type"))
    return rows.select("page_id", A.system_prompt(kind, R.TYPE_HINTS).alias("prompt"))


_ASKED = f"CASE WHEN page_id % 5 = 0 THEN 'Category hint: shop' || chr(10) || chr(10) ELSE '' END || 'URL: ' || url || chr(10) || chr(10) || 'HTML source:' || chr(10) || "


@query(
    f"SELECT page_id, page_id::VARCHAR AS custom_id, 'm' AS model, md5('{R.SYSTEM_PROMPT}' || coalesce(chr(10) || chr(10) || CASE k {_PROMPTS} END, '')) AS system, md5({_ASKED} title) AS asked, CASE WHEN page_id % 3 = 0 THEN 'image/jpeg' END AS mime_type, CASE WHEN page_id % 3 = 0 THEN 'shot ' || page_id END AS image, 0.2::DOUBLE AS temperature "
    f"FROM (SELECT page_id, url, {KIND} AS k, regexp_extract(html, '<title>[^<]*</title>') AS title FROM pages)"
)
def batch_requests(spark, sf):
    """Requests with a category's and a type's hint and an image each where there is one, read back whole; the page is its title here."""
    k = F.col("page_id")
    image = F.when(k % 3 == 0, F.concat(F.lit("shot "), k.cast("string")).cast("binary"))
    pages = with_kind(t(spark, sf, "pages")).select("page_id", "url", F.regexp_extract("html", "<title>[^<]*</title>", 0).alias("html"), "schema_type", F.when(k % 5 == 0, "shop").alias("category_hint"), image.alias("image"), F.lit("shot.JPG").alias("image_name"))
    part = "struct<text:string,inline_data:struct<mime_type:string,data:string>>"
    x = F.from_json("value", f"custom_id string, request struct<model:string,body:struct<system_instruction:struct<parts:array<{part}>>,contents:array<struct<role:string,parts:array<{part}>>>,generationConfig:struct<temperature:double>>>")
    body = x["request"]["body"]
    parts = body["contents"][0]["parts"]
    data = F.try_element_at(F.filter(parts, lambda p: p["inline_data"].isNotNull()), F.lit(1))["inline_data"]
    asked = F.element_at(parts, -1)["text"]
    return A.batch_requests(pages, "m", settings={"temperature": 0.2}).select(
        x["custom_id"].cast("bigint").alias("page_id"), x["custom_id"].alias("custom_id"), x["request"]["model"].alias("model"), F.md5(body["system_instruction"]["parts"][0]["text"]).alias("system"), F.md5(asked).alias("asked"),
        data["mime_type"].alias("mime_type"), F.unbase64(data["data"]).cast("string").alias("image"), body["generationConfig"]["temperature"].alias("temperature"),
    )


@query("SELECT page_id, CASE WHEN page_id % 3 = 1 THEN false ELSE true END AS ok FROM pages")
def language_gate(spark, sf):
    lang = F.when(F.col("page_id") % 3 == 0, "eng,deu").when(F.col("page_id") % 3 == 1, "fra")
    return t(spark, sf, "pages").select("page_id", P.language_ok(lang).alias("ok"))


@query("SELECT CASE WHEN valid AND q >= 0.4 THEN 'valid' WHEN valid THEN 'weak' ELSE 'invalid' END AS state, count(*) AS n, sum(tokens)::BIGINT AS tokens FROM (SELECT toxic = 0 AS valid, (doc_id % 10) / 10.0 AS q, doc_id % 100 AS tokens FROM labels) GROUP BY 1")
def run_statistics(spark, sf):
    rows = t(spark, sf, "labels").select((F.col("toxic") == 0).alias("valid"), ((F.col("doc_id") % 10) / 10.0).alias("q"), (F.col("doc_id") % 100).alias("tokens"))
    state = V.cascade((F.col("valid") & (F.col("q") >= 0.4), "valid"), (F.col("valid"), "weak"), otherwise="invalid")
    return rows.groupBy(state.alias("state")).agg(count_n(), F.sum("tokens").alias("tokens"))
