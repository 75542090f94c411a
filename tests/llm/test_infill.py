import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from quarrymark.llm import infill as I
from quarrymark.llm.queries import op13_fill_in_middle

ALPHABET = "ab1 .\n!?Z\té 😀𝔘\r"


@pytest.mark.parametrize("name", sorted(I.UNITS))
def test_boundaries_cut_where_the_grammar_does(spark, name):
    r = random.Random(name)
    texts = ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 40))) for _ in range(300)] + ["", "\n", "\n\n", "😀", "a" * 5000 + "\n" * 50]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", I.units(F.col("t"), I.UNITS[name]).alias("u")).collect()
    for x in got:
        # Java's \s is ASCII only
        assert x.u == re.findall(I.UNITS[name].replace(r"\s]", r" \t\n\x0b\f\r]") if name == "words" else I.UNITS[name], x.t)
    assert spark.createDataFrame([(None,)], "t string").select(I.units(F.col("t"))).first()[0] is None


def test_other_grammars(spark):
    grammar = r"a+b?c*|[^a]"
    t = "aabcca" + "dbabcb" + "acaab"
    assert spark.createDataFrame([(t,)], "t string").select(I.units(F.col("t"), grammar)).first()[0] == re.findall(grammar, t)
    for bad in ("(a)", "a||b", "a{2}", ".*", ""):
        with pytest.raises(ValueError):
            I.boundary(bad)


def plain(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    u = re.findall(r"[^\n]*\n|[^\n]+", text)
    g = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(g[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    if not text or any(t in text for t in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(u), "plain", None, None, text
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if h[3] % 100 < spm:
        return len(u), "spm", p, m, f"<S>{s}<P>{p}<M>{m}"
    return len(u), "psm", p, m, f"<P>{p}<S>{s}<M>{m}"


def rows():
    r = random.Random(3)
    out = [(i, "".join(r.choice("ab<PSM>\n\n😀é ") for _ in range(r.randint(0, 60)))) for i in range(400)]
    return out + [(None, "x\ny"), (1, None), (2, ""), (2, ""), (3, "<\n<P\n<S\n>"), (4, "a<M>b"), (5, "<\n<\n<"), (6, "line\n" * 200_000), (7, "one line " * 100_000), (8, "same\n"), (8, "same\n")]


@pytest.mark.parametrize(("rate", "spm"), [(100, 50), (60, 0), (0, 50), (90, 100)])
def test_against_plain_python(spark, rate, spm):
    docs = spark.createDataFrame(rows(), "doc_id long, text string").selectExpr("*", "1 AS form", "'x' AS _cut", "2 AS prefix", "3 AS other")
    made = I.fill_in_middle(docs, rate=rate, spm=spm)
    assert set(made.columns) == {"doc_id", "text", "form", "_cut", "prefix", "other", "n_units", "middle", "output"}
    got = made.select("doc_id", "text", "n_units", "form", "prefix", "middle", "output", I.restore(F.col("output"), F.col("form")).alias("back"), "_cut", "other").collect()
    assert sorted(((x.doc_id, x.text) for x in got), key=str) == sorted(rows(), key=str)
    for x in got:
        assert (x.n_units, x.form, x.prefix, x.middle, x.output) == plain(x.doc_id, x.text, rate=rate, spm=spm)
        assert x.back == (x.text or "") and x._cut == "x" and x.other == 3


def test_other_tokens_and_units(spark):
    docs = spark.createDataFrame([(i, "some words here, and others 😀") for i in range(40)], "doc_id long, text string")
    t = ("[[pre", "[suf", "[mid")
    with pytest.raises(ValueError):
        I.fill_in_middle(docs, tokens=t)
    t = ("{pre}", "{suf}", "{mid}")
    for name in I.UNITS:
        got = I.fill_in_middle(docs, I.UNITS[name], tokens=t).select("text", "form", I.restore(F.col("output"), F.col("form"), t).alias("back")).collect()
        assert all(x.back == x.text and x.form != "plain" for x in got)


def test_empty_table_and_plan(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert I.fill_in_middle(docs).count() == 0
    spark.createDataFrame(rows(), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    made = op13_fill_in_middle(spark, str(tmp_path))
    want = [(d, *plain(d, t)) for d, t in rows()]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    size = lambda s: None if s is None else len(s)
    assert sorted(map(tuple, made.collect()), key=str) == sorted(((d, n, f, size(p), size(m), sha(o), sha(t or "")) for (d, n, f, p, m, o), (_, t) in zip(want, rows(), strict=True)), key=str)
    assert not any(x in made._jdf.queryExecution().executedPlan().toString() for x in ("Exchange", "Python", "Arrow"))
