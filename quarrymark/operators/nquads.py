"""From N-Quads lines to entities and JSON-LD."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import nquads as N
from ..functions.urls import iri, local_name


#: Lines of a file that are looked at together.
SEGMENT = 1 << 16


def parse(lines: DataFrame, compat: bool = False) -> DataFrame:
    """lines (file, line_no, line, and block where there is one) -> subject, property, value, source_url beside them; blank lines, comments and short lines go."""
    own = lines.filter("line IS NOT NULL AND trim(line) <> '' AND NOT startswith(trim(line), '#')").withColumn("t", N.tokens(F.col("line"))).filter("t IS NOT NULL")
    place = ["file", *(c for c in ("block",) if c in lines.columns), "line_no"]
    return own.select(*place, iri(F.col("t")[0]).alias("subject"), local_name(F.col("t")[1]).alias("property"), N.value(F.col("t")[2], compat).alias("value"), iri(F.col("t")[3]).alias("source_url"))


def runs(quads: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """quads with run, the number of their run of one subject and source among those of their file.

    A file is cut into segments, by its splits and by line numbers. Changes are counted within segments; the first and last quad of each, and how many
    changes it has, say whether a run goes on over a border and where its numbers begin. So a file of any size is many tasks, and
    what meets in one is a row for each of its segments.
    """
    block = F.col("block") if "block" in quads.columns else F.lit(0).cast("long")
    keys = F.struct("subject", "source_url")
    dealt = quads.withColumn("_s", F.struct(block.alias("b"), F.floor(F.col("line_no") / segment).alias("n")))
    w = Window.partitionBy("file", "_s").orderBy("line_no")
    change = F.when(F.lag(F.lit(1)).over(w).isNull() | F.lag(keys).over(w).eqNullSafe(keys), 0).otherwise(1)  # none at a segment's first quad
    local = dealt.withColumn("_c", change).withColumn("_local", F.sum("_c").over(w))
    ends = local.groupBy("file", "_s").agg(F.min_by(keys, "line_no").alias("opens"), F.max_by(keys, "line_no").alias("closes"), F.max("_local").alias("changes"))
    across = Window.partitionBy("file").orderBy("_s")
    fresh = F.when(F.lag(F.lit(1)).over(across).isNull() | ~F.lag("closes").over(across).eqNullSafe(F.col("opens")), 1).otherwise(0)
    starts = ends.withColumn("fresh", fresh).select("file", "_s", (F.sum(F.col("fresh") + F.col("changes")).over(across) - F.col("changes")).alias("_base"))
    return local.join(starts, ["file", "_s"]).withColumn("run", F.col("_base") + F.col("_local")).drop("_s", "_c", "_local", "_base")


def entities(quads: DataFrame, grouping: str = "runs", segment: int = SEGMENT) -> DataFrame:
    """subject, source_url, properties (map of arrays) of each run of quads with one subject and source in a file.

    A subject that comes back later is another entity; with grouping "global" it isn't. Quads without a value add nothing, and
    entities without values go.
    """
    keys = ["subject", "source_url"]
    if grouping == "runs":
        quads = runs(quads, segment)
        keys = ["file", "run", *keys]
    place = F.struct(*(c for c in ("file", "block") if c in quads.columns and c not in keys), "line_no")
    values = quads.filter("value IS NOT NULL").groupBy(*keys, "property").agg(F.array_sort(F.collect_list(F.struct(place.alias("at"), "value"))).alias("v"))
    each = values.withColumn("first", F.col("v")[0]["at"]).withColumn("v", F.transform("v", lambda x: x["value"]))
    out = each.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("first", "property", "v"))).alias("p"))
    return out.withColumn("properties", F.map_from_entries(F.transform("p", lambda x: F.struct(x["property"], x["v"])))).drop("p")


def quote(text: Column) -> Column:
    """A JSON string."""
    return F.regexp_replace(F.to_json(F.struct(text.alias("x"))), r'^\{"x":(.*)\}$', "$1")


def to_jsonld(entity_rows: DataFrame, schema_type: str | Column) -> DataFrame:
    """entities with jsonld, schema_type and property_count; properties called type or context go, single values stand bare."""
    kind = F.lit(schema_type) if isinstance(schema_type, str) else schema_type
    own = F.filter(F.map_entries("properties"), lambda e: ~e["key"].isin("type", "context"))
    several = lambda v: F.concat(F.lit("["), F.array_join(F.transform(v, quote), ","), F.lit("]"))
    fields = F.transform(own, lambda e: F.concat(quote(e["key"]), F.lit(":"), F.when(F.size(e["value"]) == 1, quote(e["value"][0])).otherwise(several(e["value"]))))
    head = F.concat(F.lit('{"@context":"https://schema.org","@type":'), quote(kind))
    body = F.concat(head, F.when(F.size(fields) > 0, F.concat(F.lit(","), F.array_join(fields, ","))).otherwise(""), F.lit("}"))
    return entity_rows.select("*", body.alias("jsonld"), kind.alias("schema_type"), F.size(own).alias("property_count"))


def rich(entity_rows: DataFrame, least: int = 5) -> DataFrame:
    return entity_rows.filter(F.size("properties") >= least)


def parts_for_tld(lookup: DataFrame, name: str) -> DataFrame:
    """Numbers of the parts (pld, tld, part_name) that hold hosts of a TLD: what to read, and nothing else."""
    own = F.endswith("pld", F.lit("." + name)) | (F.col("tld") == name)
    return lookup.filter(own & (F.col("pld") != "pld")).select(F.regexp_extract("part_name", r"^part_(\d+)\.gz$", 1).alias("part")).filter("part <> ''").select(F.col("part").cast("bigint").alias("part")).distinct()
