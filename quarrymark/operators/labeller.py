"""The seam to a labelling model: rows to rows, in partitions, going on where a run ended."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from .sampling import without

RESULT = "page_id long, raw_output string, valid boolean, attempt int, error string"
#: Gets url and html, and gives JSON-LD text; raises on failure.
Labeller = Callable[[str, str], str]


def stub(url: str, html: str) -> str:
    """A deterministic labeller for tests and dry runs."""
    import re

    found = re.search(r"(?i)<title[^>]*>([^<]+)</title>", html or "")
    return json.dumps({"@context": "https://schema.org", "@type": "WebPage", "url": url, "name": found[1].strip() if found else ""}, ensure_ascii=False)


def label(pages: DataFrame, labeller: Labeller = stub, done: DataFrame | None = None, attempts: int = 3, accept: Callable[[str], bool] | None = None) -> DataFrame:
    """RESULT for each page (page_id, url, html) that isn't done; each is tried until accepted, `attempts` times at most."""
    todo = pages.select("page_id", "url", "html")
    if done is not None:
        todo = without(todo, done, "page_id")

    def one(page_id: int, url: str, html: str) -> tuple:
        error = output = None
        for k in range(1, attempts + 1):
            try:
                output = labeller(url, html)
                if accept is None or accept(output):
                    return page_id, output, True, k, None
                error = "not accepted"
            except Exception as x:  # the model's failure is the row's result
                error = str(x)[:200]
        return page_id, output, False, attempts, f"gave up after {attempts}: {error}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([one(*r) for r in b.itertuples(index=False)], columns=[x.split()[0] for x in RESULT.split(", ")])

    return todo.mapInPandas(run, RESULT)


#: Gets url, html and JSON-LD, and gives a dict with overall_score and pass; raises on failure.
Judge = Callable[[str, str, str], dict]
VERDICT = "page_id long, overall_score double, passed boolean, attempt int, error string"


def stub_judge(url: str, html: str, jsonld: str) -> dict:
    """A deterministic judge for tests and dry runs: longer markup scores higher."""
    return {"overall_score": 1.0 + len(jsonld or "") % 5, "pass": len(jsonld or "") % 2 == 0}


def judge(results: DataFrame, judging: Judge = stub_judge, attempts: int = 3) -> DataFrame:
    """VERDICT on each result (page_id, url, html, jsonld); after `attempts` failures its error instead."""

    def one(page_id: int, url: str, html: str, jsonld: str) -> tuple:
        error = None
        for k in range(1, attempts + 1):
            try:
                found = judging(url, html, jsonld)
                return page_id, float(found.get("overall_score", 0)), bool(found.get("pass", False)), k, None
            except Exception as x:  # the judge's failure is the row's result
                error = str(x)[:200]
        return page_id, None, None, attempts, f"gave up after {attempts}: {error}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([one(*r) for r in b.itertuples(index=False)], columns=[x.split()[0] for x in VERDICT.split(", ")]).astype({"passed": "boolean"})

    return results.select("page_id", "url", "html", "jsonld").mapInPandas(run, VERDICT)
