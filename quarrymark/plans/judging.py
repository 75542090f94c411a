"""Queries of the second validator: every target type, with defects, judged against a page. The SQL reads the JSON itself."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import reference_data as R
from ..functions import html as H
from ..functions import jsontext as J
from ..operators import judge as D
from ..operators.validate import Vocabulary
from .base import KINDS, count_n, query, t

_K = "CAST(page_id AS VARCHAR(20))"
_TYPE = "CASE WHEN page_id % 17 = 4 THEN 'Bogus' WHEN page_id % 17 = 9 THEN 'Offer' WHEN page_id % 17 = 10 THEN 'PostalAddress' WHEN page_id % 17 = 11 THEN 'Restaurant' ELSE " + "CASE page_id % 15 " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(KINDS)) + " END END"
_EXTRA = (
    "CASE page_id % 9 WHEN 0 THEN ',\"zzz\":1' WHEN 1 THEN ',\"availability\":\"InStock\"' WHEN 2 THEN ',\"startDate\":\"March 3\",\"endDate\":\"2024-05-06\"' WHEN 3 THEN ',\"price\":9' "
    "WHEN 4 THEN ',\"availability\":\"https://schema.org/InStock\",\"eventStatus\":\"Odd\",\"itemCondition\":\"Old\"' "
    "WHEN 5 THEN ',\"review\":{\"@type\":\"Review\",\"reviewBody\":\"fine words and more\",\"datePublished\":\"2020\",\"zzz\":\"deep\"}' "
    "WHEN 6 THEN ',\"offers\":[{\"@type\":\"Offer\",\"price\":\"5\",\"priceCurrency\":\"EUR\"},{\"price\":\"6\",\"zzz\":1},{\"@type\":\"Nope\"}]' ELSE '' END"
)
#: The same text in both dialects.
_TEXT = (
    f"CASE WHEN page_id % 13 = 8 THEN '{{\"name\":' ELSE concat('{{', CASE WHEN page_id % 13 = 6 THEN '' WHEN page_id % 13 = 5 THEN '\"@context\":\"https://example.org\",' ELSE '\"@context\":\"https://schema.org\",' END, "
    f"CASE WHEN page_id % 13 = 7 THEN '' ELSE concat('\"@type\":\"', {_TYPE}, '\",') END, '\"name\":\"Grand Hotel Item ', {_K}, '\"', {_EXTRA}, '}}') END"
)
_SEEN = f"CASE page_id % 3 WHEN 0 THEN concat('Grand Hotel  Item ', {_K}, ' March 3') WHEN 1 THEN 'a grand lobby hotel item' ELSE 'nothing' END"
_ATTR = f"CASE WHEN page_id % 10 = 0 THEN concat('grand hotel item ', {_K}) WHEN page_id % 5 = 0 THEN 'item grand deep hotel' ELSE '' END"


def page_issues(spark, sf):
    """Issues of structure and of the whole vocabulary by page_id."""
    return D.text_issues(t(spark, sf, "pages").selectExpr("page_id AS k", f"{_TEXT} AS text"), Vocabulary.built_in()).withColumnRenamed("k", "page_id")


def judged_pages(spark, sf):
    rows = t(spark, sf, "pages").selectExpr("page_id", f"{_TEXT} AS jsonld", f"concat('<html><head><title>x</title></head><p title=\"', {_ATTR}, '\">', {_SEEN}, '</p></html>') AS html")
    return D.judged(rows, "jsonld", H.parsed_text("html"), F.col("html"), Vocabulary(OWN, ABOVE))


#: A small vocabulary for the queries of judged pages; jsonld_vocab_issues has the one built in, and a release's is read by Vocabulary.of_release().
OWN = {
    "Thing": ("name", "description", "url", "image"),
    "Organization": ("address", "telephone", "email"),
    "Place": ("address", "geo"),
    "LocalBusiness": ("openingHours", "priceRange"),
    "Restaurant": ("servesCuisine", "menu"),
    "Product": ("brand", "offers", "review", "itemCondition"),
    "Offer": ("availability", "price", "priceCurrency", "itemCondition"),
    "Event": ("startDate", "endDate", "eventStatus", "offers", "review"),
    "CreativeWork": ("author", "datePublished", "offers", "review"),
    "Article": ("articleBody",),
    "FAQPage": ("mainEntity",),
    "HowTo": ("step",),
    "Recipe": ("recipeIngredient",),
    "Service": ("provider", "offers", "review"),
    "JobPosting": ("datePosted", "validThrough"),
    "ItemList": ("itemListElement",),
    "Review": ("reviewBody", "reviewRating"),
}
ABOVE = {
    "Organization": ("Thing",), "Place": ("Thing",), "LocalBusiness": ("Organization", "Place"), "Restaurant": ("LocalBusiness",), "Product": ("Thing",), "Offer": ("Thing",), "Event": ("Thing",),
    "CreativeWork": ("Thing",), "Article": ("CreativeWork",), "WebPage": ("CreativeWork",), "FAQPage": ("WebPage",), "WebSite": ("CreativeWork",), "HowTo": ("CreativeWork",), "Recipe": ("HowTo",),
    "Course": ("CreativeWork",), "SoftwareApplication": ("CreativeWork",), "Service": ("Thing",), "Person": ("Thing",), "JobPosting": ("Thing",), "ItemList": ("Thing",), "BreadcrumbList": ("ItemList",),
    "Review": ("CreativeWork",), "PostalAddress": (),
}


def _pairs(table: dict[str, tuple[str, ...] | str]) -> str:
    return "(VALUES " + ",".join(f"('{k}','{x}')" for k, v in table.items() for x in (v.split() if isinstance(v, str) else v)) + ")"


_BASE = (
    f"WITH RECURSIVE src AS (SELECT page_id, {_TEXT} AS t, {_SEEN} AS seen, {_ATTR} AS attr FROM pages), "
    "j AS (SELECT *, json_valid(t) AS ok, CASE WHEN json_valid(t) THEN t::JSON END AS o FROM src), "
    "st AS (SELECT *, ok AND NOT list_contains(json_keys(o), '@type') AS untyped, ok AND NOT list_contains(json_keys(o), '@context') AS bare, ok AND list_contains(json_keys(o), '@context') AND NOT contains((o->'@context')::VARCHAR, 'schema.org') AS alien FROM j), "
    "good AS (SELECT * FROM st WHERE ok AND NOT untyped AND NOT alien)"
)
#: What is valid where, and then the issues.
_SMALL = (
    f", own AS (SELECT * FROM {_pairs(OWN)} AS x(type, prop)), above AS (SELECT * FROM {_pairs(ABOVE)} AS x(type, top)), "
    "up AS (SELECT type, type AS top FROM (SELECT type FROM own UNION SELECT type FROM above UNION SELECT top FROM above UNION SELECT 'PostalAddress') UNION SELECT up.type, above.top FROM up JOIN above ON above.type = up.top), "
)
_WHOLE = (
    f", own AS (SELECT * FROM {_pairs(R.VOCABULARY)} AS x(type, prop)), below AS (SELECT * FROM {_pairs(R.BELOW)} AS x(top, type)), "
    "up AS (SELECT type, type AS top FROM (SELECT type FROM own UNION SELECT type FROM below UNION SELECT top FROM below WHERE top <> '') UNION SELECT up.type, below.top FROM up JOIN below ON below.type = up.top WHERE below.top <> ''), "
)
_ISSUES = (
    "known AS (SELECT DISTINCT type FROM up), valid AS (SELECT DISTINCT up.type, own.prop FROM up JOIN own ON own.type = up.top), "
    "kids AS (SELECT page_id, '$' AS path, o FROM good UNION ALL SELECT page_id, path, o FROM (SELECT page_id, k.path || '.' || m || CASE WHEN i IS NULL THEN '' ELSE '[' || i || ']' END AS path, x AS o FROM (SELECT page_id, path, m, unnest([NULL] || range(coalesce(json_array_length(v), 0)::BIGINT)) AS i, v, CASE WHEN i IS NULL THEN v ELSE json_extract(v, '$[' || i || ']') END AS x FROM (SELECT page_id, path, m, json_extract(o, '$.\"' || m || '\"') AS v FROM (SELECT page_id, path, o, unnest(json_keys(o)) AS m FROM kids WHERE list_contains(json_keys(o), '@type')))) k WHERE json_type(x) = 'OBJECT')), "
    "typed AS (SELECT *, o->>'@type' AS type FROM kids WHERE list_contains(json_keys(o), '@type')), "
    "keys AS (SELECT page_id, path, type, o, m, json_extract(o, '$.\"' || m || '\"') AS v, json_extract_string(o, '$.\"' || m || '\"') AS s FROM (SELECT *, unnest(json_keys(o)) AS m FROM typed) WHERE NOT starts_with(m, '@')), "
    "issues AS (SELECT page_id, 'error' AS severity, 'type' AS category, path FROM typed WHERE type NOT IN (FROM known) "
    "UNION ALL SELECT page_id, 'warning', 'property', path || '.' || m FROM keys WHERE type IN (SELECT type FROM valid) AND NOT EXISTS (FROM valid WHERE valid.type = keys.type AND prop = m) "
    + "".join(f"UNION ALL SELECT page_id, 'error', 'value', path || '.' || m FROM keys WHERE m = '{k}' AND json_type(v) = 'VARCHAR' AND s NOT IN (" + ",".join(f"'https://schema.org/{x}'" for x in v) + ") " for k, v in R.ENUMERATIONS.items() if k != "dayOfWeek")
    + "UNION ALL SELECT page_id, 'warning', 'value', path || '.' || m FROM keys WHERE json_type(v) = 'VARCHAR' AND m IN (" + ",".join(f"'{k}'" for k in R.DATE_KEYS) + r") AND NOT regexp_matches(s, '^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}(:\d{2})?(Z|[+-]\d{2}:\d{2})?)?$') "
    "UNION ALL SELECT page_id, 'warning', 'value', path || '.' || m FROM keys WHERE m = 'price' AND NOT list_contains(json_keys(o), 'priceCurrency'))"
)
_VOCAB = _SMALL + _ISSUES
_FACTS = (
    ", vals AS (SELECT page_id, seen, attr, trim(regexp_replace(lower(atom->>'$'), '\\s+', ' ', 'g')) AS s, atom->>'$' AS raw FROM (SELECT page_id, seen, attr, e.atom, e.type, e.key FROM good, json_tree(t) AS e) WHERE type = 'VARCHAR' AND NOT starts_with(key, '@') AND length(atom->>'$') > 2 AND NOT starts_with(atom->>'$', 'http') AND NOT regexp_matches(atom->>'$', '^(\\d{4}-\\d{2}-\\d{2}|PT?\\d)')), "
    "facts AS (SELECT page_id, contains(v, s) OR contains(lower(attr), s) OR (len(string_split(s, ' ')) >= 3 AND len(list_filter(string_split(s, ' '), lambda w: length(w) > 2 AND contains(v, w))) / len(string_split(s, ' ')) >= 0.6) AS held FROM (SELECT *, regexp_replace(lower(seen), '\\s+', ' ', 'g') AS v FROM vals)), "
    "score AS (SELECT page_id, round(count(*) FILTER (WHERE held) / count(*), 3)::DOUBLE AS factual_score FROM facts GROUP BY page_id)"
)


@query(_BASE + " SELECT category, severity, count(*) AS n FROM (SELECT 'json' AS category, 'error' AS severity FROM st WHERE NOT ok UNION ALL SELECT 'structure','error' FROM st WHERE untyped UNION ALL SELECT 'structure','error' FROM st WHERE alien UNION ALL SELECT 'structure','warning' FROM st WHERE bare) GROUP BY ALL")
def jsonld_structure_issues(spark, sf):
    texts = t(spark, sf, "pages").selectExpr("page_id AS k", f"{_TEXT} AS text")
    return D.structure_issues(D.entities(texts)).groupBy("category", "severity").agg(count_n())


@query(_BASE + _WHOLE + _ISSUES + " SELECT page_id, category, severity, path, count(*) AS n FROM issues GROUP BY ALL")
def jsonld_vocab_issues(spark, sf):
    i = page_issues(spark, sf).filter(F.col("category").isin("type", "property", "value"))
    return i.groupBy("page_id", "category", "severity", "path").agg(count_n())


@query(_BASE + _FACTS + " SELECT src.page_id, CASE WHEN good.page_id IS NULL THEN 0.0 ELSE coalesce(factual_score, 1.0) END::DOUBLE AS factual_score FROM src LEFT JOIN good USING (page_id) LEFT JOIN score USING (page_id)")
def jsonld_factual_score(spark, sf):
    return judged_pages(spark, sf).select("page_id", "judged.factual_score")


@query(_BASE + _VOCAB + _FACTS + ", e AS (SELECT page_id, count(*) FILTER (WHERE severity = 'error') AS errors FROM issues GROUP BY page_id) SELECT src.page_id, good.page_id IS NOT NULL AS json_valid, good.page_id IS NOT NULL AND coalesce(errors, 0) <= 2 AND coalesce(factual_score, 1.0) >= 0.5 AS valid FROM src LEFT JOIN good USING (page_id) LEFT JOIN e USING (page_id) LEFT JOIN score USING (page_id)")
def validation_decision(spark, sf):
    return judged_pages(spark, sf).select("page_id", "judged.json_valid", "judged.valid")


@query(f"SELECT page_id, CASE WHEN NOT json_valid(t) THEN 'parse_error' ELSE coalesce(t::JSON->>'@type', 'unknown') END AS kind, json_valid(t) AND coalesce(t::JSON->>'@type', '') IN ('Product', 'Offer') AS is_offer FROM (SELECT page_id, {_TEXT} AS t FROM pages)".replace("t::JSON->>", "(CASE WHEN json_valid(t) THEN t END)::JSON->>"))
def first_types(spark, sf):
    gold = F.lit('{"@type":["Product","Offer"]}')
    rows = t(spark, sf, "pages").selectExpr("page_id", f"{_TEXT} AS jsonld")
    return rows.select("page_id", J.first_type("jsonld").alias("kind"), J.same_type("jsonld", gold).alias("is_offer"))


@query(f"SELECT page_id, CASE WHEN json_valid(t) THEN json(t)::VARCHAR END AS compact, CASE WHEN json_valid(t) THEN md5(replace(replace(json(t)::VARCHAR, '\":', '\": '), ': //', '://')) END AS pretty FROM (SELECT page_id, {_TEXT} AS t FROM pages)")
def json_reformat(spark, sf):
    """Indentation is taken out again for the comparison."""
    rows = t(spark, sf, "pages").selectExpr("page_id", f"{_TEXT} AS jsonld")
    flat = F.regexp_replace(J.reformatted("jsonld"), r"\n *", "")
    return rows.select("page_id", J.reformatted("jsonld", None).alias("compact"), F.md5(flat).alias("pretty"))


@query(f"SELECT page_id, CASE page_id % 4 WHEN 1 THEN t || chr(10) || '``` x' ELSE t END AS jsonld FROM (SELECT page_id, {_TEXT} AS t FROM pages)")
def fence_lines(spark, sf):
    k = F.col("page_id") % 4
    fenced = F.when(k == 0, F.col("t")).when(k == 1, F.concat(F.lit("```json\n"), "t", F.lit("\n``` x"))).when(k == 2, F.concat(F.lit("```\n"), "t", F.lit("\n ``` "))).otherwise(F.concat(F.lit("```json\n"), "t"))
    return t(spark, sf, "pages").selectExpr("page_id", f"{_TEXT} AS t").select("page_id", J.without_fence_lines(fenced).alias("jsonld"))
