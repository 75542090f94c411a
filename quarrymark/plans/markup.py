"""Queries over structured markup: N-Quads, JSON-LD, validation, evaluation and audits."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import reference_data as R
from ..functions import jsontext as J
from ..functions import nquads as N
from ..functions.urls import iri, local_name
from ..operators import labeller as L
from ..operators import nquads as Q
from ..operators import validate as V
from .base import count_n, PART_JSON, n, parts_jsonld, query, t

#: Quads of suppliers: eight lines each, in both dialects; one subject comes back later.
_S = "CAST(s_suppkey AS VARCHAR(20))"
_SUBJ = f"concat('<http://s', {_S}, '.ie/#b>')"
_GRAPH = f"concat(' <http://s', {_S}, '.ie/p> .')"
_LINES = [
    f"concat({_SUBJ}, ' <http://schema.org/name> \"', s_name, '\"@en-US', {_GRAPH})",
    f"concat({_SUBJ}, ' <http://schema.org/url> <http://s', {_S}, '.ie/>', {_GRAPH})",
    f"concat({_SUBJ}, ' <http://schema.org/telephone> \"+353 ', {_S}, '\"', {_GRAPH})",
    f"concat({_SUBJ}, ' <http://schema.org/telephone> \"+44 ', {_S}, '\"^^<http://www.w3.org/2001/XMLSchema#string>', {_GRAPH})",
    f"concat({_SUBJ}, ' <http://schema.org/address> _:n', {_S}, {_GRAPH})",
    f"concat('_:n', {_S}, ' <http://www.w3.org/1999/02/22-rdf-syntax-ns#type> <http://schema.org/PostalAddress>', {_GRAPH})",
    "concat('# comment ', s_name)",
    f"concat({_SUBJ}, ' <http://schema.org/email> \"a\\\"b@x.ie\"', {_GRAPH})",
]
_SPARK_LINES = [x.replace('\\"', '\\\\"') for x in _LINES]
_QUADS = "WITH l AS (SELECT s_suppkey % 4 AS file, s_suppkey * 10 + i AS line_no, line FROM supplier, (SELECT unnest(range(8)) AS i) r, LATERAL (SELECT ([" + ", ".join(_LINES) + "])[i + 1] AS line))"
_TOKEN = r"""(<[^>]+>|"(?:[^"\\]|\\.)*"(?:\^\^<[^>]+>|@\w+)?|_:\w+)"""
_PARSED = (
    _QUADS + f", k AS (SELECT file, line_no, regexp_extract_all(line,'{_TOKEN}',1) AS t FROM l WHERE NOT starts_with(line,'#')), q AS (SELECT file, line_no, trim(t[1],'<>') AS subject, string_split(string_split(trim(t[2],'<>'),'/')[-1],'#')[-1] AS property, "
    "CASE WHEN starts_with(t[3],'<') THEN t[3][2:-2] WHEN starts_with(t[3],'\"') THEN replace(regexp_extract(t[3],'^\"((?:[^\"\\\\]|\\\\.)*)\"',1),'\\\"','\"') END AS value, trim(t[4],'<>') AS source_url FROM k WHERE len(t)>=4)"
)
_PARSED = _PARSED.replace("t[3][2:-2]", "substr(t[3],2,length(t[3])-2)")


def quads(spark, sf):
    lines = F.array(*(F.expr(x) for x in _SPARK_LINES))
    rows = t(spark, sf, "supplier").select("s_suppkey", F.posexplode(lines).alias("i", "line"))
    return rows.select((F.col("s_suppkey") % 4).alias("file"), (F.col("s_suppkey") * 10 + F.col("i")).alias("line_no"), "line")


@query(_PARSED + " SELECT file, line_no, subject, property, value, source_url FROM q")
def nquads_tokenise(spark, sf):
    return Q.parse(quads(spark, sf))


def shown_properties():
    """Properties of an entity as one text: names in order, and their values."""
    return F.array_join(F.array_sort(F.transform(F.map_entries("properties"), lambda x: F.concat(x["key"], F.lit("="), F.array_join(x["value"], "|")))), ";")


_RUNS = _PARSED + ", c AS (SELECT *, CASE WHEN lag(subject) OVER w = subject AND lag(source_url) OVER w = source_url THEN 0 ELSE 1 END AS ch FROM q WINDOW w AS (PARTITION BY file ORDER BY line_no)), r AS (SELECT *, sum(ch) OVER (PARTITION BY file ORDER BY line_no) AS run FROM c), p AS (SELECT file, run, subject, source_url, property, string_agg(value,'|' ORDER BY line_no) AS v, count(*) AS nv FROM r WHERE value IS NOT NULL GROUP BY ALL)"


@query(_RUNS + " SELECT subject, source_url, string_agg(property||'='||v, ';' ORDER BY property) AS properties, count(*) AS n_properties FROM p GROUP BY file, run, subject, source_url")
def nquads_entity_runs(spark, sf):
    e = Q.entities(Q.parse(quads(spark, sf)))
    return e.select("subject", "source_url", shown_properties().alias("properties"), n(F.size(F.map_keys("properties"))).alias("n_properties"))


@query(_PARSED + ", f AS (SELECT subject, source_url, property, list(value ORDER BY line_no) AS v, min(line_no) AS o FROM q WHERE value IS NOT NULL GROUP BY ALL), j AS (SELECT subject, count(*) AS c, '{\"@context\":\"https://schema.org\",\"@type\":\"LocalBusiness\",'||string_agg('\"'||property||'\":'||CASE WHEN len(v)=1 THEN to_json(v[1])::VARCHAR ELSE to_json(v)::VARCHAR END, ',' ORDER BY o)||'}' AS jsonld FROM f WHERE property NOT IN ('type','context') GROUP BY subject, source_url) SELECT subject, jsonld, c AS property_count FROM j WHERE c >= 4")
def nquads_to_jsonld(spark, sf):
    e = Q.rich(Q.entities(Q.parse(quads(spark, sf)), grouping="global"), 4)
    return Q.to_jsonld(e, "LocalBusiness").select("subject", "jsonld", n("property_count").alias("property_count"))


@query("SELECT DISTINCT (s_suppkey % 7)::BIGINT AS part FROM supplier WHERE s_suppkey % 3 = 0")
def tld_part_lookup(spark, sf):
    rows = t(spark, sf, "supplier").selectExpr("concat('s', s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN '.ie' ELSE '.com' END) AS pld", "CASE WHEN s_suppkey % 3 = 0 THEN 'ie' ELSE 'com' END AS tld", "concat('part_', s_suppkey % 7, '.gz') AS part_name")
    return Q.parts_for_tld(rows, "ie")


@query(_QUADS + r", m AS (SELECT l.line_no, regexp_extract_all(line,'\"([^\"]{10,})\"',1) AS lits FROM l) SELECT line_no, len(regexp_extract_all(array_to_string(lits[1:3],' '),'\b(" + R.MARKERS + r")\b',1,'i'))::BIGINT AS score FROM m")
def english_markers(spark, sf):
    from ..functions.html import marker_score

    lits = F.regexp_extract_all("line", F.lit(r'"([^"]{10,})"'), F.lit(1))
    return quads(spark, sf).select("line_no", n(marker_score(lits)).alias("score"))


_J = f"(SELECT p_partkey, {PART_JSON} AS jsonld FROM part)"


@query(f"SELECT json_valid(jsonld) AS ok, count(*) AS n FROM {_J} GROUP BY 1")
def json_validity(spark, sf):
    return parts_jsonld(spark, sf).groupBy(J.is_json("jsonld").alias("ok")).agg(count_n())


_SCORE = (
    "WITH j AS " + _J.replace("(SELECT", "(SELECT", 1) + ", k AS (SELECT p_partkey, jsonld, json_valid(jsonld) AS ok, CASE WHEN json_valid(jsonld) THEN json_keys(jsonld) ELSE [] END AS ks FROM j), "
    "e AS (SELECT *, list_contains(ks,'@type') AS ty, list_contains(ks,'@context') AS cx FROM k), "
    "s AS (SELECT *, CASE WHEN NOT ok OR NOT ty THEN 1 ELSE (NOT cx)::INT END AS errors, CASE WHEN ok THEN (NOT cx)::INT ELSE 0 END AS warnings, CASE WHEN ok AND ty THEN len(list_filter(ks, lambda x: x NOT IN ('@context','@type','@id','@graph'))) ELSE 0 END AS pc, "
    "len(list_intersect(ks,['image','description','offers','brand','sku'])) AS rec FROM e) "
    "SELECT p_partkey, errors::BIGINT AS errors, warnings::BIGINT AS warnings, pc::BIGINT AS property_count, errors = 0 AS valid, CASE WHEN ok AND ty THEN greatest(0.0, round(0.6*least(pc/10.0,1.0)+0.4*rec/5.0-0.3*errors-0.1*warnings,3))::DOUBLE ELSE 0.0::DOUBLE END AS quality_score FROM s"
)


@query(_SCORE)
def jsonld_config_score(spark, sf):
    r = V.scored(parts_jsonld(spark, sf))
    return r.select("p_partkey", n(F.size("result.errors")).alias("errors"), n(F.size("result.warnings")).alias("warnings"), n("result.property_count").alias("property_count"), "result.valid", "result.quality_score")


@query("SELECT decision, count(*) AS n FROM (SELECT CASE WHEN doc_id % 13 = 0 THEN 'error' WHEN quality + 3.0 >= 3.5 AND toxic = 0 THEN 'pass' ELSE 'fail' END AS decision FROM labels) GROUP BY 1")
def rescore_decision(spark, sf):
    error = F.when(F.col("doc_id") % 13 == 0, "timeout")
    passed = V.rescored(F.col("quality") + F.lit(3.0), F.col("toxic") == 0, error)
    return t(spark, sf, "labels").groupBy(F.when(passed.isNull(), "error").when(passed, "pass").otherwise("fail").alias("decision")).agg(count_n())


@query("SELECT lang, count(*) AS n FROM (SELECT lang, CASE WHEN doc_id % 10 = 0 THEN 'Ã' || text ELSE text END AS x FROM documents) WHERE contains(x,'Ã') OR contains(x,'â¬') OR contains(x,chr(65533)) GROUP BY lang")
def encoding_corruption(spark, sf):
    x = F.when(F.col("doc_id") % 10 == 0, F.concat(F.lit("Ã"), "text")).otherwise(F.col("text"))
    return t(spark, sf, "documents").filter(J.corrupted(x)).groupBy("lang").agg(count_n())


_CUTS = "[" + ", ".join(f"length(j) - {c}" for c in (0, 50, 100, 200, 500)) + "]"
_LESS = "(length({0}) - length(replace({0}, '{1}', '')) - length({0}) + length(replace({0}, '{2}', '')))"
_OPEN = _LESS.format("own", "[", "]"), _LESS.format("own", "{{", "}}").replace("{{", "{").replace("}}", "}")


@query(
    f"WITH t AS (SELECT p_partkey, jsonld AS j FROM {_J}), c AS (SELECT p_partkey, j, generate_subscripts({_CUTS}, 1) AS i, unnest({_CUTS}) AS upto FROM t WHERE NOT json_valid(j)), "
    "o AS (SELECT p_partkey, i, regexp_replace(rtrim(substr(j, 1, CASE WHEN upto < 0 THEN greatest(length(j) + upto, 0) ELSE upto END)), ',$', '') AS own FROM c), "
    f"f AS (SELECT p_partkey, arg_min(closed, i) AS closed FROM (SELECT p_partkey, i, own || repeat(']', {_OPEN[0]}) || repeat('}}', {_OPEN[1]}) AS closed FROM o WHERE own <> '' AND {_OPEN[0]} >= 0 AND {_OPEN[1]} >= 0) WHERE json_valid(closed) GROUP BY 1) "
    "SELECT p_partkey, CASE WHEN json_valid(j) THEN j ELSE closed END AS jsonld FROM t LEFT JOIN f USING (p_partkey)"
)
def json_repair(spark, sf):
    """Thoughts and every other text's fence removed, and cut text repaired."""
    fenced = F.col("p_partkey") % 2 == 0
    text = F.concat(F.lit("<think>x</think>\n"), F.when(fenced, "```json\n").otherwise(""), "jsonld", F.when(fenced, "\n```").otherwise(""))
    return parts_jsonld(spark, sf).select("p_partkey", J.repair(J.without_fence(J.without_thoughts(text))).alias("jsonld"))


@query(f"SELECT key, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM {_J} WHERE json_valid(jsonld)), 6)::DOUBLE AS share FROM (SELECT unnest(json_keys(jsonld)) AS key FROM {_J} WHERE json_valid(jsonld)) WHERE key NOT IN ('@context','@type','@id','@graph') GROUP BY key")
def property_coverage(spark, sf):
    rows = parts_jsonld(spark, sf).select(J.normal_json("jsonld").alias("j")).filter("j IS NOT NULL")
    both = rows.select(F.explode(F.array_append(J.property_keys(F.col("j")), F.lit("@all"))).alias("key")).groupBy("key").agg(count_n())
    total = F.max(F.when(F.col("key") == "@all", F.col("n"))).over(Window.partitionBy())  # a row per property
    return both.withColumn("total", total).filter("key <> '@all'").select("key", "n", F.round(100.0 * F.col("n") / F.col("total"), 6).cast("double").alias("share"))


#: Gold and predicted keys of parts.
_EVAL = "SELECT p_partkey AS id, CASE WHEN p_partkey % 5 = 0 THEN ['@type'] WHEN p_partkey % 2 = 0 THEN ['name','url','@type'] ELSE ['name','brand','sku'] END AS gold, CASE WHEN p_partkey % 3 = 0 THEN ['name','brand'] WHEN p_partkey % 7 = 0 THEN [] ELSE ['name','url','sku'] END AS pred, CASE WHEN p_partkey % 4 = 0 THEN 'Product' ELSE 'Event' END AS gold_type, CASE WHEN p_partkey % 6 = 0 THEN 'Product' ELSE 'Event' END AS pred_type FROM part"


def evaluated(spark, sf):
    k = F.col("p_partkey")
    a = lambda *x: F.array(*(F.lit(v) for v in x)) if x else F.array().cast("array<string>")
    rows = t(spark, sf, "part").select(k.alias("id"), F.when(k % 5 == 0, a("@type")).when(k % 2 == 0, a("name", "url", "@type")).otherwise(a("name", "brand", "sku")).alias("gold"), F.when(k % 3 == 0, a("name", "brand")).when(k % 7 == 0, a()).otherwise(a("name", "url", "sku")).alias("pred"), F.when(k % 4 == 0, "Product").otherwise("Event").alias("gold_type"), F.when(k % 6 == 0, "Product").otherwise("Event").alias("pred_type"))
    meta = a(*R.META_KEYS)
    return rows.select("id", "gold_type", "pred_type", property_f1(F.array_except("gold", meta), F.array_except("pred", meta)).alias("f1"))


def property_f1(gold, pred):
    """F1 of two key sets; 0 without gold keys or shared ones."""
    both = F.size(F.array_intersect(gold, pred))
    p, r = both / F.greatest(F.size(pred), F.lit(1)), both / F.greatest(F.size(gold), F.lit(1))
    return F.when((F.size(gold) == 0) | (both == 0), 0.0).otherwise(F.round(2 * p * r / (p + r), 9))


_F1 = f"(SELECT id, gold_type, pred_type, CASE WHEN len(g)=0 OR b=0 THEN 0.0 ELSE round(2.0*b/(len(g)+len(pred)),9) END::DOUBLE AS f1 FROM (SELECT *, len(list_intersect(g,pred)) AS b FROM (SELECT *, list_filter(gold, lambda x: x<>'@type') AS g FROM ({_EVAL}))))"


@query(f"SELECT id, f1 FROM {_F1}")
def eval_property_f1(spark, sf):
    return evaluated(spark, sf).select("id", "f1")


@query(f"SELECT count(*) AS n, round(avg((gold_type=pred_type)::INT),6)::DOUBLE AS accuracy, round(avg(f1),6)::DOUBLE AS mean_f1, round(quantile_cont(f1,0.5),6)::DOUBLE AS median_f1 FROM {_F1}")
def eval_type_accuracy(spark, sf):
    e = evaluated(spark, sf)
    return e.agg(count_n(), F.round(F.avg((F.col("gold_type") == F.col("pred_type")).cast("int")), 6).alias("accuracy"), F.round(F.avg("f1"), 6).alias("mean_f1"), F.round(F.expr("percentile(f1, 0.5)"), 6).alias("median_f1"))


@query(f"SELECT gold_type, count(*) AS n, round(avg((gold_type=pred_type)::INT),6)::DOUBLE AS accuracy, count(*) FILTER (WHERE pred_type='Product') AS predicted_product FROM {_F1} GROUP BY 1 HAVING count(*)>=2 ORDER BY accuracy DESC, gold_type LIMIT 10")
def eval_per_type(spark, sf):
    g = evaluated(spark, sf).groupBy("gold_type").agg(count_n(), F.round(F.avg((F.col("gold_type") == F.col("pred_type")).cast("int")), 6).alias("accuracy"), F.count_if(F.col("pred_type") == "Product").alias("predicted_product"))
    return g.filter("n >= 2").orderBy(F.desc("accuracy"), "gold_type").limit(10)


#: Existing and generated properties of parts.
_AUDIT = "SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN [] ELSE ['name','url'] END AS old, CASE WHEN p_partkey % 4 = 0 THEN ['name'] ELSE ['name','brand','sku','offers'] END AS new, (p_partkey % 9) / 10.0 AS q_old, (p_partkey % 11) / 10.0 AS q_new FROM part"


def audited(spark, sf):
    k = F.col("p_partkey")
    a = lambda *x: F.array(*(F.lit(v) for v in x)) if x else F.array().cast("array<string>")
    rows = t(spark, sf, "part").select(k.alias("id"), F.when(k % 3 == 0, a()).otherwise(a("name", "url")).alias("old"), F.when(k % 4 == 0, a("name")).otherwise(a("name", "brand", "sku", "offers")).alias("new"), ((k % 9) / 10.0).alias("q_old"), ((k % 11) / 10.0).alias("q_new"))
    return rows.select("id", n(F.size("old")).alias("existing"), n(F.size("new")).alias("generated"), F.array_except("new", "old").alias("added"), F.round(F.col("q_new") - F.col("q_old"), 3).cast("double").alias("delta"))


_DELTA = f"(SELECT id, len(old)::BIGINT AS existing, len(new)::BIGINT AS generated, list_filter(new, lambda x: NOT list_contains(old,x)) AS added, round(q_new-q_old,3)::DOUBLE AS delta FROM ({_AUDIT}))"


@query(f"SELECT id, existing, generated, array_to_string(list_sort(added),',') AS added, delta FROM {_DELTA}")
def improvement_delta(spark, sf):
    return audited(spark, sf).withColumn("added", F.array_join(F.sort_array("added"), ","))


@query(f"SELECT count(*) AS total, count(*) FILTER (WHERE existing>0) AS with_markup, round(count(*) FILTER (WHERE existing>0)/count(*)::DOUBLE,6) AS rate, round(avg(delta),6)::DOUBLE AS mean_delta, round(avg(len(added)),6)::DOUBLE AS mean_added, count(*) FILTER (WHERE delta>0.05) AS improved FROM {_DELTA}")
def adoption_summary(spark, sf):
    a = audited(spark, sf)
    some = F.count_if(F.col("existing") > 0)
    return a.agg(F.count("*").alias("total"), some.alias("with_markup"), F.round(F.try_divide(some, F.count("*")), 6).alias("rate"), F.round(F.avg("delta"), 6).alias("mean_delta"), F.round(F.avg(F.size("added")), 6).alias("mean_added"), F.count_if(F.col("delta") > 0.05).alias("improved"))


@query(f"SELECT id, delta FROM {_DELTA} WHERE delta>0 ORDER BY delta DESC, id LIMIT 10")
def top_improved(spark, sf):
    return audited(spark, sf).filter("delta > 0").select("id", "delta").orderBy(F.desc("delta"), "id").limit(10)


_ERR = "CASE p_partkey % 4 WHEN 0 THEN 'Unterminated string at 5' WHEN 1 THEN 'Missing required property: name' WHEN 2 THEN 'Invalid JSON: x' ELSE concat('odd ', p_brand) END"


@query(f"SELECT CASE WHEN contains(e,'Unterminated') THEN 'truncated JSON' WHEN contains(e,'Missing required') THEN e WHEN contains(e,'Invalid JSON') THEN 'other JSON error' ELSE substr(e,1,60) END AS bucket, count(*) AS n FROM (SELECT {_ERR} AS e FROM part) GROUP BY 1")
def error_buckets(spark, sf):
    return t(spark, sf, "part").selectExpr(f"{_ERR} AS e").groupBy(J.error_bucket(F.col("e")).alias("bucket")).agg(count_n())


@query(r"""SELECT page_id, true AS valid, 1::BIGINT AS attempt, md5('{"@context": "https://schema.org", "@type": "WebPage", "url": ' || coalesce(to_json(url)::VARCHAR, 'null') || ', "name": ' || to_json(regexp_replace(regexp_extract(coalesce(html, ''), '(?i)<title[^>]*>([^<]+)</title>', 1), '^\s+|\s+$', '', 'g'))::VARCHAR || '}') AS digest FROM pages WHERE page_id % 5 <> 0""")
def labeller_stub_run(spark, sf):
    """The labelling seam with its stub, which reads pages' titles."""
    pages = t(spark, sf, "pages")
    return L.label(pages, done=pages.filter("page_id % 5 = 0")).select("page_id", "valid", n("attempt").alias("attempt"), F.md5("raw_output").alias("digest"))


@query("WITH q AS (SELECT s_suppkey, concat('<http://s', s_suppkey, '.ie/#b>') AS tok FROM supplier) SELECT s_suppkey, trim(tok,'<>') AS iri, string_split(string_split(trim(tok,'<>'),'/')[-1],'#')[-1] AS name FROM q")
def iri_local_names(spark, sf):
    tok = F.concat(F.lit("<http://s"), F.col("s_suppkey").cast("string"), F.lit(".ie/#b>"))
    return t(spark, sf, "supplier").select("s_suppkey", iri(tok).alias("iri"), local_name(tok).alias("name"))


@query("SELECT s_suppkey, 'http://x/'||s_suppkey AS plain, s_name||chr(10)||'é' AS escaped FROM supplier")
def literal_values(spark, sf):
    key = F.col("s_suppkey").cast("string")
    return t(spark, sf, "supplier").select("s_suppkey", N.value(F.concat(F.lit("<http://x/"), key, F.lit(">"))).alias("plain"), N.value(F.concat(F.lit('"'), "s_name", F.lit('\\n\\u00e9"@en'))).alias("escaped"))
