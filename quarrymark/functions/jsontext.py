"""JSON text: strict tests, repair, keys and types."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType

from .. import reference_data as R


def _parsed(text: str | None):
    """(value, True), or (None, False): as strict as the standard library, which takes NaN and the last of equal keys."""
    try:
        return json.loads(text), True
    except (TypeError, ValueError, RecursionError):
        return None, False


def _sound(text: Column) -> Column:
    """JSON to the JVM's parser, which is stricter. It reads no further than one value, so the text is tried inside brackets of both
    kinds: only one whole value fits in both. False decides nothing: equal keys and NaN are for Python."""
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).isNotNull() & F.try_parse_json(F.concat(F.lit('{"a":'), text, F.lit("}"))).isNotNull()


@F.pandas_udf(BooleanType())
def _is_json(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield batch.map(lambda t: _parsed(t)[1])


@F.pandas_udf(StringType())
def _normal(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield batch.map(lambda t: json.dumps(v, ensure_ascii=False, allow_nan=False) if (v := _parsed(t)[0]) is not None and "NaN" not in t and "Infinity" not in t else None)


@F.pandas_udf(StringType())
def _repaired(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield batch.map(repaired)


def _undecided(text: Column) -> Column:
    return F.when(~F.coalesce(_sound(text), F.lit(False)), text)


def is_json(text: Column | str) -> Column:
    """Is it JSON, as strictly as the standard library? Null is not. Python sees only what the JVM's parser turned down."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(_sound(text), F.lit(False)) | F.coalesce(_is_json(_undecided(text)), F.lit(False))


def normal_json(text: Column | str) -> Column:
    """The same value without spaces around and with equal keys merged, or null (for null, too): safe for VARIANT and from_json."""
    text = F.col(text) if isinstance(text, str) else text
    bare = F.regexp_replace(text, r"^\s+|\s+$", "")
    return F.when(F.coalesce(_sound(text), F.lit(False)), F.nullif(bare, F.lit("null"))).otherwise(_normal(_undecided(text)))


def repair(text: Column | str) -> Column:
    """repaired() of each text; Python sees only what the JVM's parser turned down."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(F.coalesce(_sound(text), F.lit(False)), text).otherwise(_repaired(_undecided(text)))


def without_fence_lines(text: Column) -> Column:
    """Without a fence's first line, and its last one where that is only a fence."""
    lines = F.split(text, "\n")
    last = F.trim(F.element_at(lines, -1)) == "```"
    return F.when(F.startswith(text, F.lit("```")), F.array_join(F.slice(lines, F.lit(2), F.size(lines) - 1 - last.cast("int")), "\n")).otherwise(text)


def reformatted(text: Column | str, indent: int | None = 2) -> Column:
    """The same JSON indented, or without spaces (indent None), keys in their order; null where it isn't JSON."""
    marks = (",", ":") if indent is None else None

    @F.pandas_udf(StringType())
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield batch.map(lambda t: json.dumps(v[0], ensure_ascii=False, indent=indent, separators=marks) if (v := _parsed(t))[1] else None)

    return run(text)


def first_type(text: Column | str) -> Column:
    """The first @type of an object; 'unknown' where there is none, 'parse_error' where the text is no JSON object."""
    own = normal_json(text)
    kind = F.get_json_object(own, "$['@type']")
    one = F.when(F.startswith(kind, F.lit("[")), F.get_json_object(kind, "$[0]")).otherwise(F.nullif(kind, F.lit("")))
    return F.when(F.startswith(own, F.lit("{")), F.coalesce(one, F.lit("unknown"))).otherwise("parse_error")


def types_of(text: Column | str) -> Column:
    """All values of @type as an array, empty without one or where the text is no JSON object."""
    own = normal_json(text)
    kind = F.when(F.startswith(own, F.lit("{")), F.get_json_object(own, "$['@type']"))
    listed = F.when(F.startswith(kind, F.lit("[")), F.from_json(kind, "array<string>")).when(kind.isNotNull(), F.array(kind))
    return F.coalesce(listed, F.array().cast("array<string>"))


def same_type(pred: Column | str, gold: Column | str) -> Column:
    """Do both texts declare a type in common?"""
    return F.coalesce(F.arrays_overlap(types_of(pred), types_of(gold)), F.lit(False))


def without_fence(text: Column) -> Column:
    """Without a Markdown fence around."""
    bare = F.regexp_replace(F.regexp_replace(text, r"^```(?:json)?\s*", ""), r"\s*```\s*$", "")
    return F.when(F.startswith(text, F.lit("```")), bare).otherwise(text)


def without_thoughts(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)<think>.*?</think>\s*", "")


def repaired(text: str | None, cuts: tuple[int, ...] = (0, 50, 100, 200, 500)) -> str | None:
    """The text, or the first cut of its end that parses once open brackets are closed; null where none does."""
    if text is None or _parsed(text)[1]:
        return text
    for cut in cuts:
        own = text[: len(text) - cut].rstrip()
        own = own.removesuffix(",")
        square, curly = own.count("[") - own.count("]"), own.count("{") - own.count("}")
        if own and min(square, curly) >= 0 and _parsed(closed := own + "]" * square + "}" * curly)[1]:
            return closed
    return None


def property_keys(text: Column) -> Column:
    """Top-level keys but for the meta keys; null where the text isn't an object."""
    return F.array_except(F.json_object_keys(text), F.array(*(F.lit(k) for k in R.META_KEYS)))


def error_bucket(message: Column) -> Column:
    return (
        F.when(F.contains(message, F.lit("Unterminated")), "truncated JSON").when(F.contains(message, F.lit("Missing required")), message)
        .when(F.contains(message, F.lit("Invalid JSON")), "other JSON error").otherwise(F.substring(message, 1, 60))
    )


def corrupted(text: Column) -> Column:
    """Signs of UTF-8 read as Latin-1, or of undecodable bytes."""
    return F.contains(text, F.lit("â¬")) | F.contains(text, F.lit("Ã")) | F.contains(text, F.lit("�"))
