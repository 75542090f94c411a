"""The second validator: structure, vocabulary and facts of JSON-LD, as Column expressions over VARIANT values.

JSON is walked level by level by a recursive query; what is valid where is a table that is joined. Each distinct text is walked once. Only the
facts look at pages: there the text's strings, found once, meet the page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import reference_data as R
from ..functions.html import normal_text
from ..functions.jsontext import without_fence
from .validate import Vocabulary

ISSUE = ["severity", "category", "message", "path"]
#: Errors of the vocabulary and of all that a valid entity may have, and the share of its facts that the page holds.
VOCABULARY_ERRORS, ERRORS, FACTS = 3, 2, 0.5

_KIND = "schema_of_variant({0})"
_OBJECT = "startswith(" + _KIND + ", 'OBJECT')"
_ARRAY = "startswith(" + _KIND + ", 'ARRAY')"
_HAS = "array_contains(json_object_keys(to_json({0})), '{1}')"
_TYPE = "try_variant_get({0}, '$[\"@type\"]', 'variant')"
#: Has it a type, or a list with one?
_TYPED = f"({_KIND.format(_TYPE)} = 'STRING' OR coalesce(exists(try_variant_get({_TYPE}, '$', 'array<variant>'), t -> {_KIND.format('t')} = 'STRING'), false))"
#: The value itself in a list, or the list.
_LISTED = f"CASE WHEN {_ARRAY} THEN {{0}} ELSE parse_json(concat('[', to_json({{0}}), ']')) END"
_PLACE = f"CASE WHEN {_ARRAY.format('e.value')} THEN '[' || c.pos || ']' ELSE '' END"

#: Objects that have a type, and those in them or in their lists; below an object without one nothing is judged.
_WALK = f"""
WITH RECURSIVE walk(k, path, o) AS (
  SELECT k, path, o FROM {{roots}} WHERE {_OBJECT.format('o')}
  UNION ALL
  SELECT w.k, w.path || '.' || e.key || {_PLACE}, c.value
  FROM (SELECT * FROM walk WHERE {_TYPED.format('o')}) w, LATERAL variant_explode(w.o) e, LATERAL variant_explode({_LISTED.format('e.value')}) c
  WHERE NOT startswith(e.key, '@') AND {_OBJECT.format('c.value')}
) SELECT k, path, o FROM walk"""

#: Strings that are no links, of more than two characters, wherever no key on the way begins with @.
_LEAVES = f"""
WITH RECURSIVE walk(k, path, v) AS (
  SELECT k, path, o FROM {{roots}}
  UNION ALL
  SELECT w.k, w.path || CASE WHEN e.key IS NULL THEN '[' || e.pos || ']' ELSE '.' || e.key END, e.value
  FROM walk w, LATERAL variant_explode(w.v) e WHERE e.key IS NULL OR NOT startswith(e.key, '@')
) SELECT k, path, s FROM (SELECT k, path, try_variant_get(v, '$', 'string') AS s FROM walk WHERE {_KIND.format('v')} = 'STRING') WHERE length(s) > 2 AND NOT startswith(s, 'http')"""


def _session(spark: SparkSession) -> None:
    """Equal keys are no error in JSON (the last counts), and walks are as long as the data."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    spark.conf.set("spark.sql.cteRecursionLevelLimit", "1100")  # deeper than the parser goes


def parsed_json(text: Column) -> Column:
    """A text's value as VARIANT, or null where it isn't JSON. NaN and Infinity are read as 0, as other parsers take them."""
    whole = lambda t: F.when(F.try_parse_json(F.concat(F.lit('{"a":'), t, F.lit("}"))).isNotNull(), F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), t, F.lit("]"))), "$[0]", "variant"))
    numbers = F.regexp_replace(text, r"(^|[:\[,])(\s*)-?(?:NaN|Infinity)(?=\s*(?:[,\]}]|$))", "$1$20")
    return F.coalesce(whole(text), F.when(F.contains(text, F.lit("NaN")) | F.contains(text, F.lit("Infinity")), whole(numbers)))


def entities(texts: DataFrame, key: str = "k", text: str = "text") -> DataFrame:
    """k, n, at, path, place, o of each entity of texts (k, text): the value, or each of a list. n: how many the text has; a text that isn't JSON has one
    row without o and n, an empty list one with n 0. place numbers an entity in any list, path only where there are several."""
    _session(texts.sparkSession)
    values = texts.select(F.col(key).alias("k"), parsed_json(F.col(text)).alias("v"))
    rows = texts.sparkSession.sql(f"SELECT k, v, c.pos AS at, c.value AS o FROM {{values}}, LATERAL variant_explode_outer({_LISTED.format('v')}) c", values=values)
    listed = F.expr(_ARRAY.format("v"))
    n = F.when(F.col("v").isNotNull(), F.when(F.col("at").isNull(), 0).when(listed, F.size(F.try_variant_get("v", "$", "array<variant>"))).otherwise(1))
    index = F.concat(F.lit("$["), F.col("at").cast("string"), F.lit("]"))
    return rows.select("k", n.alias("n"), "at", F.when(n > 1, index).otherwise("$").alias("path"), F.when(listed & F.col("at").isNotNull(), index).otherwise("$").alias("place"), "o")


def structure_issues(rows: DataFrame) -> DataFrame:
    """k and the issues of entities(): texts that aren't JSON, entities that aren't objects, or have no type or another context."""
    o = F.col("o")
    keys = F.json_object_keys(F.to_json(o))
    context = F.to_json(F.try_variant_get(o, "$['@context']", "variant"))
    issue = lambda severity, category, message: F.array(F.struct(F.lit(severity).alias("severity"), F.lit(category).alias("category"), F.lit(message).alias("message")))
    none = F.array().cast("array<struct<severity:string,category:string,message:string>>")
    typed = F.when(F.array_contains(keys, "@type"), none).otherwise(issue("error", "structure", "missing @type"))
    within = F.when(~F.array_contains(keys, "@context"), issue("warning", "structure", "missing @context")).when(F.coalesce(F.contains(context, F.lit("schema.org")), F.lit(False)), none).otherwise(issue("error", "structure", "@context is not schema.org"))
    found = F.when(F.col("n").isNull(), issue("error", "json", "Invalid JSON")).when(F.col("n") == 0, none).when(~F.expr(_OBJECT.format("o")), issue("error", "structure", "no object")).otherwise(F.concat(typed, within))
    return rows.select("k", "place", F.explode(found).alias("i")).select("k", "i.*", F.col("place").alias("path"))


def vocabulary_issues(roots: DataFrame, words: Vocabulary) -> DataFrame:
    """k and the issues of entities (k, path, o) and the typed objects in them: types and properties that the vocabulary doesn't have there, and values
    that no enumeration, date or duration has."""
    spark = roots.sparkSession
    _session(spark)
    types, valid = words.tables(spark)
    kind = F.try_variant_get("o", "$['@type']", "variant")
    strings = F.transform(F.filter(F.try_variant_get(kind, "$", "array<variant>"), lambda x: F.schema_of_variant(x) == "STRING"), lambda x: F.try_variant_get(x, "$", "string"))
    kinds = F.when(F.schema_of_variant(kind) == "STRING", F.array(F.try_variant_get(kind, "$", "string"))).otherwise(strings)
    nodes = spark.sql(_WALK, roots=roots).select("k", "path", "o", kinds.alias("kinds")).filter("size(kinds) > 0")
    # What is to be judged of an object, its types and its properties, in one pass, so that the walk is made once.
    none = F.lit(None)
    own = F.transform(F.filter(F.map_entries(F.try_variant_get("o", "$", "map<string,variant>")), lambda e: ~F.startswith(e["key"], F.lit("@"))), lambda e: F.struct(F.col("kinds")[0].alias("type"), e["key"].alias("property"), e["value"].alias("v")))
    each = F.transform("kinds", lambda t: F.struct(t.alias("type"), none.cast("string").alias("property"), none.cast("variant").alias("v")))
    rows = nodes.select("k", "path", F.expr(_HAS.format("o", "priceCurrency")).alias("priced"), F.explode(F.concat(each, own)).alias("x")).select("k", "path", "priced", "x.*")
    typed = types.join(valid.groupBy("type").agg(F.lit(True).alias("has")), "type", "left").withColumn("known", F.lit(True))  # of the vocabulary's size, as valid
    rows = rows.join(typed, "type", "left").join(valid.withColumn("fits", F.lit(True)), ["type", "property"], "left")
    issue = lambda severity, category, message: F.array(F.struct(F.lit(severity).alias("severity"), F.lit(category).alias("category"), message.alias("message")))
    empty = F.array().cast("array<struct<severity:string,category:string,message:string>>")
    unknown = F.when(F.col("known").isNull(), issue("error", "type", F.concat(F.lit("unknown type "), "type"))).otherwise(empty)
    alien = F.when(F.col("has") & F.col("fits").isNull(), issue("warning", "property", F.concat("property", F.lit(" is no property of "), "type"))).otherwise(empty)
    values = F.transform(_value_issues(F.col("property"), F.col("v"), F.col("priced")), lambda i: F.struct(i["severity"].alias("severity"), F.lit("value").alias("category"), i["message"].alias("message")))
    found = F.when(F.col("property").isNull(), unknown).otherwise(F.concat(alien, values))
    at = F.when(F.col("property").isNull(), F.col("path")).otherwise(F.concat("path", F.lit("."), "property"))
    return rows.select("k", at.alias("path"), F.explode(found).alias("i")).select("k", "i.*", "path")


def text_issues(texts: DataFrame, words: Vocabulary, key: str = "k", text: str = "text") -> DataFrame:
    """k and the issues of texts (k, text; a key each) but for facts: structure, and where that has no errors the vocabulary."""
    found = entities(texts, key, text)
    broken = structure_issues(found)
    return broken.unionByName(vocabulary_issues(_sound(found, broken), words))


def _sound(found: DataFrame, broken: DataFrame) -> DataFrame:
    """Entities of texts without errors of structure."""
    return found.filter("n > 0").join(broken.filter("severity = 'error'").select("k").distinct(), "k", "left_anti").select("k", "path", "o")


def _value_issues(name: Column, v: Column, priced: Column) -> Column:
    """severity and message of what is wrong with a property's value."""
    issue = lambda severity, message: F.struct(F.lit(severity).alias("severity"), message.alias("message"))
    none = F.array().cast("array<struct<severity:string,message:string>>")
    kind = F.schema_of_variant(v)
    text = F.when(kind == "STRING", F.try_variant_get(v, "$", "string"))
    listed = F.transform(F.filter(F.try_variant_get(v, "$", "array<variant>"), lambda x: F.schema_of_variant(x) == "STRING"), lambda x: F.try_variant_get(x, "$", "string"))
    given = F.when(text.isNotNull(), F.array(text)).when(name == "dayOfWeek", listed)
    allowed_of = F.create_map(*(x for key, names in R.ENUMERATIONS.items() for x in (F.lit(key), F.array(*(F.lit(a) for a in [R.SCHEMA_ORG + n for n in names] + (list(R.BARE_DAYS) if key == "dayOfWeek" else []))))))
    allowed = F.try_element_at(allowed_of, name)
    odd = F.when(allowed.isNotNull(), F.transform(F.filter(F.coalesce(given, F.array().cast("array<string>")), lambda x: ~F.array_contains(allowed, x)), lambda x: issue("error", F.concat(name, F.lit(" has no value "), x)))).otherwise(none)
    dated = F.when(name.isin(*R.DATE_KEYS) & (text != "") & ~F.rlike(text, F.lit(R.ISO_DATE)), F.array(issue("warning", F.concat(name, F.lit(" is no ISO 8601 date: "), text)))).otherwise(none)
    lasting = F.when(name.isin(*R.DURATION_KEYS) & (text != "") & ~F.rlike(text, F.lit(R.ISO_DURATION)), F.array(issue("warning", F.concat(name, F.lit(" is no ISO 8601 duration: "), text)))).otherwise(none)
    plain = ~F.startswith(kind, F.lit("OBJECT")) & ~F.startswith(kind, F.lit("ARRAY")) & (kind != "VOID")
    price = F.when((name == "price") & plain & ~priced, F.array(issue("warning", F.lit("price without priceCurrency")))).otherwise(none)
    return F.concat(odd, dated, lasting, price)


def leaf_strings(roots: DataFrame) -> DataFrame:
    """k, path, s of the strings of entities (k, path, o)."""
    _session(roots.sparkSession)
    return roots.sparkSession.sql(_LEAVES, roots=roots)


def facts(leaves: Column, visible: Column, markup: Column) -> tuple[Column, Column]:
    """Of strings (path, s): the share that a page holds, and a warning for each other one; dates and durations don't count.

    A string is held whole by the visible text or the markup, both normal_text(), or, from three words on, by 60 % of its words in the visible text.
    """

    def held(own: Column) -> Column:
        words = F.split(own, " ")
        some = F.size(F.filter(words, lambda w: (F.char_length(w) > 2) & F.contains(visible, w)))
        return (F.char_length(own) < 3) | F.contains(visible, own) | F.contains(markup, own) | ((F.size(words) >= 3) & (some / F.size(words) >= 0.6))

    checked = F.filter(leaves, lambda x: ~F.rlike(x["s"], F.lit(r"^\d{4}-\d{2}-\d{2}|^PT?\d")))
    told = F.transform(checked, lambda x: F.struct(x["path"].alias("path"), x["s"].alias("s"), held(normal_text(x["s"])).alias("held")))
    share = F.coalesce(F.try_divide(F.size(F.filter(told, lambda x: x["held"])), F.size(told)), F.lit(1.0))
    issue = lambda x: F.struct(F.lit("warning").alias("severity"), F.lit("factual").alias("category"), F.concat(F.lit("not on the page: "), F.substring(x["s"], 1, 80)).alias("message"), x["path"].alias("path"))
    return share, F.transform(F.filter(told, lambda x: ~x["held"]), issue)


def judged(rows: DataFrame, text: str, page_text: Column, html: Column, words: Vocabulary) -> DataFrame:
    """rows with `judged`: json_valid, schema_valid, valid, factual_score, entity_count, error_count, warning_count and issues of their JSON-LD.

    Structure errors end the check. The vocabulary holds with at most 3 errors; all is valid with at most 2 errors and half
    of the facts on the page. page_text: the page's visible text; null counts as empty, as does null html. A null text isn't JSON. Issues are
    ordered by path. `judged` replaces a column of that name; texts may repeat, and each is walked once.
    """
    key = "_text_key"
    while key in rows.columns:
        key += "_"
    keyed = rows.withColumn(key, F.sha2(F.coalesce(without_fence(F.col(text)), F.lit("")), 256))
    texts = keyed.groupBy(F.col(key).alias("k")).agg(F.first(without_fence(F.col(text)), ignorenulls=True).alias("text"))
    all_entities = entities(texts)
    broken = structure_issues(all_entities)
    roots = _sound(all_entities, broken)
    issues = broken.unionByName(vocabulary_issues(roots, words)).groupBy("k").agg(F.collect_list(F.struct(*ISSUE)).alias("issues"))
    leaves = leaf_strings(roots).groupBy("k").agg(F.array_sort(F.collect_list(F.struct("path", "s"))).alias("leaves"))
    counts = all_entities.groupBy("k").agg(F.coalesce(F.max("n"), F.lit(0)).cast("int").alias("n"))
    told = counts.join(issues, "k", "left").join(leaves, "k", "left").withColumnRenamed("k", key)  # of one text each
    none = F.array().cast("array<struct<severity:string,category:string,message:string,path:string>>")
    own = F.coalesce("issues", none)
    errors = lambda xs, of: F.size(F.filter(xs, lambda i: (i["severity"] == "error") & i["category"].isin(*of)))
    facts_of = F.coalesce("leaves", F.array().cast("array<struct<path:string,s:string>>"))
    both = keyed.join(told, key).withColumns({f"{key}v": normal_text(F.coalesce(page_text, F.lit(""))), f"{key}m": normal_text(F.coalesce(html, F.lit("")))})
    share, missing = facts(facts_of, F.col(f"{key}v"), F.col(f"{key}m"))
    ok = errors(own, ("json", "structure")) == 0
    all_issues = F.array_sort(F.when(ok, F.concat(own, missing)).otherwise(own), lambda a, b: F.when(a["path"] < b["path"], -1).when(a["path"] > b["path"], 1).otherwise(0))
    score = F.when(ok, share).otherwise(0.0)
    every = ("json", "structure", "type", "property", "value")
    result = F.struct(
        ok.alias("json_valid"), (ok & (errors(own, ("type", "property", "value")) <= VOCABULARY_ERRORS)).alias("schema_valid"),
        (ok & (errors(own, ("type", "property", "value")) <= VOCABULARY_ERRORS) & (errors(own, every) <= ERRORS) & (score >= FACTS)).alias("valid"),
        F.bround(score, 3).alias("factual_score"), F.col("n").alias("entity_count"), errors(own, every).alias("error_count"), (F.size(all_issues) - errors(own, every)).alias("warning_count"), all_issues.alias("issues"),
    )
    return both.select(*(c for c in rows.columns if c != "judged"), result.alias("judged"))
