import json
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from quarrymark import reference_data as R
from quarrymark.operators import judge as D
from quarrymark.operators.validate import Vocabulary
from quarrymark.plans import QUERIES
from quarrymark.plans.judging import ABOVE, OWN

WORDS = Vocabulary(OWN, ABOVE)
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def structure(text):
    try:
        value = json.loads(text)
    except (TypeError, ValueError):
        return [], [("error", "json", "$")]
    found, out = value if isinstance(value, list) else [value], []
    for k, e in enumerate(found):
        at = f"$[{k}]" if isinstance(value, list) else "$"
        if not isinstance(e, dict):
            out.append(("error", "structure", at))
            continue
        if "@type" not in e:
            out.append(("error", "structure", at))
        if "@context" not in e:
            out.append(("warning", "structure", at))
        elif "schema.org" not in json.dumps(e["@context"]):
            out.append(("error", "structure", at))
    return found, out


def vocabulary(entity, path):
    todo = [(entity, path)]
    while todo:
        own, at = todo.pop()
        kinds = own.get("@type")
        kinds = [k for k in (kinds if isinstance(kinds, list) else [kinds]) if isinstance(k, str)]
        if not kinds:
            continue
        for k in kinds:
            if k not in WORDS.types:
                yield "error", "type", at
        valid = WORDS.valid.get(kinds[0], set())
        for key, v in own.items():
            if key.startswith("@"):
                continue
            here = f"{at}.{key}"
            if valid and key not in valid:
                yield "warning", "property", here
            if key in R.ENUMERATIONS:
                allowed = {R.SCHEMA_ORG + x for x in R.ENUMERATIONS[key]} | (set(R.BARE_DAYS) if key == "dayOfWeek" else set())
                for x in v if key == "dayOfWeek" and isinstance(v, list) else [v]:
                    if isinstance(x, str) and x not in allowed:
                        yield "error", "value", here
            if isinstance(v, str) and v and key in R.DATE_KEYS and not re.match(R.ISO_DATE, v):
                yield "warning", "value", here
            if isinstance(v, str) and v and key in R.DURATION_KEYS and not re.match(R.ISO_DURATION, v):
                yield "warning", "value", here
            if key == "price" and isinstance(v, int | float | str) and "priceCurrency" not in own:
                yield "warning", "value", here
            todo += [(x, here + i) for x, i in ([(v, "")] if isinstance(v, dict) else [(x, f"[{i}]") for i, x in enumerate(v)] if isinstance(v, list) else []) if isinstance(x, dict)]


def leaves(value, path):
    if isinstance(value, dict):
        return [x for k, v in value.items() if not k.startswith("@") for x in leaves(v, f"{path}.{k}")]
    if isinstance(value, list):
        return [x for i, v in enumerate(value) for x in leaves(v, f"{path}[{i}]")]
    return [(value, path)] if isinstance(value, str) and len(value) > 2 and not value.startswith("http") else []


def squeezed(text):
    return re.sub(r"\s+", " ", text.lower().strip())


def plain(text, page, html):
    """(json_valid, schema_valid, valid, factual_score, entities, errors, sorted issues) by a plain walk."""
    found, issues = structure(text)
    ok, score = not any(i[0] == "error" for i in issues), 0.0
    schema = ok
    if ok:
        several = len(found) > 1
        vocab = [i for k, e in enumerate(found) for i in vocabulary(e, f"$[{k}]" if several else "$")]
        schema = sum(i[0] == "error" for i in vocab) <= 3
        checked = held = 0
        visible, markup = squeezed(page or ""), squeezed(html or "")
        for k, e in enumerate(found):
            for v, at in leaves(e, f"$[{k}]" if several else "$"):
                if re.match(r"^\d{4}-\d{2}-\d{2}|^PT?\d", v):
                    continue
                checked += 1
                own = squeezed(v)
                words = own.split()
                if len(own) < 3 or own in visible or own in markup or (len(words) >= 3 and sum(len(w) > 2 and w in visible for w in words) / len(words) >= 0.6):
                    held += 1
                else:
                    issues.append(("warning", "factual", at))
        score = held / checked if checked else 1.0
        issues = issues + vocab
    errors = sum(i[0] == "error" for i in issues)
    return ok, schema, ok and schema and errors <= 2 and score >= 0.5, round(score, 3), len(found), errors, sorted(issues)


def some(r, depth=0):
    keys = ["name", "description", "price", "priceCurrency", "availability", "startDate", "prepTime", "dayOfWeek", "offers", "review", "zzz", "@id", "address"]
    word = lambda: r.choice(["Grand hotel", "ab", "http://x/y", "2024-01-02", "PT5M", "March 3", "three longer words", "", R.SCHEMA_ORG + "InStock", "InStock", "Monday", "Été à la plage"])
    inner = lambda: some(r, depth + 1) if depth < 3 else word()
    out = {k: r.choice([word(), word(), 5, True, None, 1.5, [word(), 3, {"@type": "Offer", "price": "1"}], inner(), [inner(), [inner()]]]) for k in r.sample(keys, r.randint(0, 4))}
    if r.random() < 0.85:
        out["@type"] = r.choice(["Product", "Offer", "Bogus", "PostalAddress", "Restaurant", ["Event", "Nope"], [], [3, "Recipe"], None])
    return out


def entity(r):
    return {**some(r), **r.choice([{"@context": "https://schema.org"}] * 6 + [{"@context": "https://example.org"}, {}, {"@context": {"@vocab": "http://schema.org/"}}])}


def test_against_a_plain_walk(spark):
    r = random.Random(5)
    texts = [json.dumps(entity(r), ensure_ascii=r.random() < 0.5) for _ in range(150)] + [json.dumps([entity(r) for _ in range(r.randint(0, 3))]) for _ in range(60)]
    texts += [None, "", "{", "[]", "[1]", "3", '"text"', "{} x", "[1]]", "1],[2", '1,"a":2', '{"@type":"Offer","@type":"Event","@context":"https://schema.org"}', '{"@type":"Offer","@context":"https://schema.org","price":NaN}', "[[]]"] + texts[:20]
    deep = {"@type": "Product", "@context": "https://schema.org", "name": "Deep down"}
    for _ in range(60):
        deep = {"@type": "Product", "@context": "https://schema.org", "offers": [deep], "zzz": 1}
    texts.append(json.dumps(deep))
    rows = [(i, t, r.choice([None, "the grand  HOTEL here", "three words longer", "été à la plage deep"]), r.choice([None, '<p title="Grand hotel">']), 7) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, jsonld string, page string, html string, judged int")
    made = D.judged(df, "jsonld", F.col("page"), F.col("html"), WORDS)
    assert made.columns == df.columns
    got = {x.i: x.judged for x in made.collect()}
    assert len(got) == len(rows)
    for i, t, page, html, _ in rows:
        x = got[i]
        want = plain(t, page, html)
        assert (x.json_valid, x.schema_valid, x.valid, x.factual_score, x.entity_count, x.error_count, sorted((j.severity, j.category, j.path) for j in x.issues)) == want, t
        assert x.warning_count == len(want[6]) - want[5]


@pytest.mark.parametrize("body,severities", [('"@type":"Offer","price":"9"', ["warning"]), ('"@type":"Offer","availability":"InStock"', ["error"]), ('"@type":"Event","startDate":"March 3"', ["warning"]), ('"@type":"Bogus"', ["error"]), ('"@type":"Product","zzz":1', ["warning"]), ('"@type":"PostalAddress","zzz":1', [])])
def test_vocabulary(spark, body, severities):
    texts = spark.createDataFrame([(1, '{"@context":"https://schema.org",' + body + "}")], "k int, text string")
    found = D.text_issues(texts, WORDS)
    assert [x.severity for x in found.collect()] == severities
    assert not any(x in found._jdf.queryExecution().executedPlan().toString() for x in ("Python", "Arrow", "Pandas"))


def test_no_texts(spark):
    none = spark.createDataFrame([], "jsonld string, page string")
    assert D.judged(none, "jsonld", F.col("page"), F.col("page"), WORDS).count() == 0
    assert D.text_issues(spark.createDataFrame([], "k int, text string"), WORDS).count() == 0


def test_vocabulary_of_a_release():
    graph = [
        {"@id": "schema:Thing", "@type": "rdfs:Class"}, {"@id": "schema:Pub", "@type": "rdfs:Class", "rdfs:subClassOf": {"@id": "schema:Thing"}},
        {"@id": "schema:name", "@type": "rdf:Property", "schema:domainIncludes": {"@id": "schema:Thing"}}, {"@id": "schema:beer", "@type": "rdf:Property", "schema:domainIncludes": [{"@id": "schema:Pub"}]},
    ]
    own = Vocabulary.of_release(json.dumps({"@graph": graph}))
    assert own.types == {"Thing", "Pub"} and own.valid == {"Thing": {"name"}, "Pub": {"name", "beer"}}
    assert {"address", "name", "priceRange"} <= WORDS.valid["Restaurant"] and WORDS.valid["PostalAddress"] == set()


def test_the_whole_vocabulary_is_judged(spark):
    words = Vocabulary.built_in()
    assert {"servesCuisine", "openingHours", "geo", "taxID", "name"} <= words.valid["Bakery"] and "streetAddress" in words.valid["PostalAddress"] and "name" not in words.valid["PostalAddress"]
    assert "Optician" in words.types and not words.valid["Optician"] and "" not in words.types
    found = QUERIES["jsonld_vocab_issues"](spark, SF).filter("page_id = 10")  # of the type PostalAddress
    assert {tuple(r) for r in found.select("category", "severity", "path", "n").collect()} == {("property", "warning", "$.name", 1), ("property", "warning", "$.availability", 1), ("value", "error", "$.availability", 1)}
