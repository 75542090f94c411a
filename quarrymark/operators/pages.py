"""Gates on pages: quality, language, size and acceptance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import reference_data as R
from ..functions import html as H
from ..functions import jsontext as J
from ..functions.urls import known_english
from .validate import cascade

LEAST_TEXT = 400
MOST_RAW, MOST_STRIPPED, LEAST_HTML = 300_000, 64_000, 200


def with_gate(pages: DataFrame) -> DataFrame:
    """pages (url, html) with text and status: short, parked, not_english or ok; known sites skip the language test."""
    own = pages.withColumn("text", H.visible_text(F.col("html")))
    status = cascade((F.length("text") < LEAST_TEXT, "short"), (H.parked(F.col("text")), "parked"), (known_english(F.col("url")) | (H.stopword_score(F.col("text")) >= 2), "ok"), otherwise="not_english")
    return own.withColumn("status", status)


def language_ok(language: Column) -> Column:
    return (F.coalesce(language, F.lit("")) == "") | F.startswith(language, F.lit("eng"))


def ready(pages: DataFrame, screenshots: DataFrame, key: str = "url") -> DataFrame:
    """Pages with markup and a screenshot."""
    return pages.filter(F.length("html") > LEAST_HTML).join(screenshots.select(key).distinct(), key, "left_semi")


def acceptance(html: Column, stripped: Column, jsonld: Column, valid: Column, score: Column, screenshot: Column) -> Column:
    """Why a manifest entry is turned away, first reason first, or accepted."""
    return cascade(
        (F.coalesce(html, F.lit("")) == "", "no_html"), (F.length(html) < LEAST_HTML, "html_too_short"), (F.length(html) > MOST_RAW, "html_too_long"),
        (F.length(stripped) > MOST_STRIPPED, "html_too_long"), (F.coalesce(jsonld, F.lit("")) == "", "no_jsonld"), (~valid, "invalid_jsonld"), (score < 0.3, "low_quality"),
        (J.corrupted(jsonld), "encoding_corrupted"), (screenshot.isNull(), "no_screenshot"),
    )


def label_acceptance(parsed: Column, valid: Column, score: Column, html: Column) -> Column:
    return cascade((~parsed, "parse_error"), (~valid, "invalid"), (score < 0.3, "low_quality"), (html.isNull(), "no_page"), (F.length(html) < LEAST_HTML, "short_html"))


def early_gate(html: Column, language: Column | None = None, least: int = 300) -> Column:
    """An older gate: enough text, not parked, and English where the language is known."""
    text = H.visible_text(html)
    own = (F.length(text) >= least) & ~H.parked(text, R.PARKED_OLD)
    return F.coalesce(own if language is None else own & (language.isNull() | (language == "en")), F.lit(False))


def early_acceptance(html: Column, jsonld: Column, valid: Column, score: Column) -> Column:
    """The cascade of the first notebook: no upper sizes, encodings or screenshots."""
    return cascade(
        (html.isNull(), "no_html"), (F.length(html) < LEAST_HTML, "html_too_short"), (F.coalesce(jsonld, F.lit("")) == "", "no_jsonld"), (~valid, "invalid_jsonld"), (score < 0.3, "low_quality"),
    )
