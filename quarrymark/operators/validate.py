"""The first validator of JSON-LD, the vocabulary of the second (judge.py), and the decisions built on both."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import reference_data as R
from ..functions.html import jsonld_blocks
from ..functions.jsontext import normal_json


def _rule_map(which: int) -> Column:
    return F.create_map(*(x for k, v in R.RULES.items() for x in (F.lit(k), F.array(*(F.lit(p) for p in v[which])))))


def scored(rows: DataFrame, text: str = "jsonld") -> DataFrame:
    """rows with `result`: valid, errors, warnings, types, property_count and quality_score of the text's entity.

    The entity is the object, the first of an array, or the first of @graph. Only the first type's rules count; types
    without rules need @type and @context and recommend nothing. Parsing is strict; all else is Column expressions. A column
    `result` of rows is replaced; all others stay, whatever their names.
    """
    none = F.array().cast("array<string>")
    packed = rows.select(F.struct(*(c for c in rows.columns if c != "result")).alias("_row"), F.col(text).alias("_text"))
    root = packed.withColumn("_n", normal_json(F.regexp_replace("_text", r"^\s+|\s+$", "")))
    first = F.when(F.startswith("_n", F.lit("[")), F.get_json_object("_n", "$[0]")).otherwise(F.col("_n"))
    root = root.withColumn("_r", first)
    graph = F.get_json_object("_r", "$['@graph']")
    entity = F.when(graph.isNotNull(), F.when(F.startswith(graph, F.lit("[")), F.get_json_object(graph, "$[0]"))).otherwise(F.col("_r"))
    root = root.withColumn("_e", F.when(F.startswith(entity, F.lit("{")), entity)).withColumn("_keys", F.json_object_keys("_e"))
    root_keys = F.when(~F.startswith("_n", F.lit("[")), F.json_object_keys("_r"))
    all_keys = F.array_union("_keys", F.coalesce(root_keys, none))
    kind = F.get_json_object("_e", "$['@type']")
    types = F.when(F.startswith(kind, F.lit("[")), F.from_json(kind, "array<string>")).when(kind.isNotNull(), F.array(kind)).otherwise(none)
    context = F.coalesce(F.get_json_object("_e", "$['@context']"), F.get_json_object("_r", "$['@context']"))
    root = root.select("*", all_keys.alias("_all"), types.alias("_types"), context.alias("_context"))
    known = F.array(*(F.lit(t) for t in (*R.RULES, *R.SUBTYPES)))
    required = F.coalesce(F.try_element_at(_rule_map(0), F.col("_types")[0]), F.array(F.lit("@type"), F.lit("@context")))
    missing = F.filter(required, lambda p: ~F.array_contains(F.col("_all"), p) & ~F.array_contains(F.col("_all"), F.concat(F.lit("@"), p)))
    missing = F.transform(missing, lambda p: F.concat(F.lit("Missing required property: "), p))
    errors = F.when(F.col("_n").isNull(), F.array(F.lit("Invalid JSON"))).when(F.col("_e").isNull(), F.array(F.lit("No object at the root"))).when(F.size("_types") == 0, F.array(F.lit("Missing @type"))).otherwise(missing)
    no_context = F.when(F.col("_context").isNull(), F.array(F.lit("Missing @context"))).when(~F.contains("_context", F.lit("schema.org")), F.array(F.lit("@context is not schema.org"))).otherwise(none)
    odd = F.transform(F.filter("_types", lambda t: ~F.array_contains(known, t)), lambda t: F.concat(F.lit("Unknown type: "), t))
    warnings = F.when(F.col("_e").isNull(), none).when(F.size("_types") == 0, no_context).otherwise(F.concat(no_context, odd))
    count = F.when(F.col("_e").isNull() | (F.size("_types") == 0), 0).otherwise(F.size(F.array_except("_keys", F.array(*(F.lit(k) for k in R.META_KEYS)))))
    out = root.select("*", errors.alias("_errors"), warnings.alias("_warnings"), count.alias("_count"))
    wanted = F.coalesce(F.try_element_at(_rule_map(1), F.try_element_at("_types", F.lit(1))), none)
    share = F.size(F.array_intersect(wanted, "_keys")) / F.greatest(F.size(wanted), F.lit(1))
    raw = F.lit(0.6) * F.least(F.col("_count") / F.lit(10.0), F.lit(1.0)) + F.lit(0.4) * share - F.lit(0.3) * F.size("_errors") - F.lit(0.1) * F.size("_warnings")
    score = F.when(F.col("_e").isNull() | (F.size("_types") == 0), 0.0).otherwise(F.greatest(F.lit(0.0), F.round(raw, 3)))
    result = F.struct((F.size("_errors") == 0).alias("valid"), F.col("_errors").alias("errors"), F.col("_warnings").alias("warnings"), F.col("_types").alias("types"), F.col("_count").alias("property_count"), score.alias("quality_score"))
    # A generator, so that no filter on the result is pushed below it: each of its uses would repeat the whole expression.
    return out.select("_row.*", F.explode(F.array(result)).alias("result"))


def pages_with_quality_markup(pages: DataFrame, key: str, least: float = 0.4) -> DataFrame:
    """Keys of pages (key, html) of which a block is valid and scores enough."""
    blocks = pages.select(key, F.explode(jsonld_blocks(F.col("html"))).alias("jsonld"))
    return scored(blocks).filter(F.col("result.valid") & (F.col("result.quality_score") >= least)).select(key).distinct()


class Vocabulary:
    """Types with their own properties, and the types right above them, whose properties they have too."""

    def __init__(self, own: dict[str, Sequence[str]], above: dict[str, Sequence[str]]) -> None:
        self.types = {*own, *above, *(t for tops in above.values() for t in tops)}
        self.valid: dict[str, set[str]] = {}
        for t in self.types:
            seen, todo = {t}, [t]
            while todo:
                new = set(above.get(todo.pop(), ())) - seen
                seen |= new
                todo += new
            self.valid[t] = {p for k in seen for p in own.get(k, ())}

    @classmethod
    def built_in(cls) -> Vocabulary:
        above: dict[str, list[str]] = {}
        for top, kinds in R.BELOW.items():
            for k in kinds.split():
                above.setdefault(k, []).extend([top] if top else [])
        return cls({t: own.split() for t, own in R.VOCABULARY.items()}, above)

    @classmethod
    def of_release(cls, text: str) -> Vocabulary:
        """From the vocabulary's published JSON-LD: classes with rdfs:subClassOf, properties with domainIncludes."""
        ids = lambda x: [v["@id"].split(":")[-1].rsplit("/", 1)[-1] for v in (x if isinstance(x, list) else [x])] if x else []
        own: dict[str, list[str]] = {}
        above: dict[str, list[str]] = {}
        for node in json.loads(text)["@graph"]:
            kinds, name = node.get("@type", []), node["@id"].split(":")[-1].rsplit("/", 1)[-1]
            if "rdfs:Class" in kinds:
                above.setdefault(name, []).extend(ids(node.get("rdfs:subClassOf")))
            elif "rdf:Property" in kinds:
                for t in ids(node.get("schema:domainIncludes")):
                    own.setdefault(t, []).append(name)
        return cls(own, above)

    def tables(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        """Types (type), and what is valid on them (type, property)."""
        types = spark.createDataFrame([(t,) for t in sorted(self.types)], "type string")
        return types, spark.createDataFrame([(t, p) for t in sorted(self.valid) for p in sorted(self.valid[t])], "type string, property string")


def rescored(score: Column, passed: Column, error: Column, least: float = 3.5) -> Column:
    """True, false, or null after an error."""
    return F.when(error.isNull(), (score >= least) & passed)


def cascade(*steps: tuple[Column, str], otherwise: str = "accepted") -> Column:
    """The name of the first step that holds."""
    out = F.when(F.lit(False), "")
    for condition, name in steps:
        out = out.when(condition, name)
    return out.otherwise(otherwise)
