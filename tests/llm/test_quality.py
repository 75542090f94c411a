import random
import re

import numpy as np
import pyarrow as pa
import pytest

from quarrymark.llm import arrays as A
from quarrymark.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    wins = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    hit = set()
    for i, x in enumerate(wins):
        if wins.count(x) > 1:
            hit |= {i, i + 1, i + 2}
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(hit), len(lines), len(re.findall("[A-Z]", text)), len(re.findall("[0-9]", text)), len(set(w))


def texts(seed):
    r = random.Random(seed)
    out = ["", None, "\n", "\n\n", "a", "a\na", "a\n a\na\n", "a b c a b c", "a\x1cb", "é é é é", "x\r\nx\r\n", "a b c", "b c a b c"]
    for _ in range(150):
        out.append("".join(r.choice(["a", "B", "é", "1", "#", " ", "\n", "\t", "\x0b", " ", "𝄞"]) for _ in range(r.randint(0, 80))))
        out.append(r.choice([" ", "\n"]).join(r.choices(["a", "b", "c d", "e"], k=r.randint(0, 40))))
    r.shuffle(out)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_counts(seed):
    t = texts(seed)
    data, off = A.text_arrays(pa.array(t, pa.string()))
    assert [tuple(x) for x in Q.doc_counts(data, off).tolist()] == [brute(x) for x in t]


def test_constraint_holds_and_model_learns():
    r = np.random.default_rng(1)
    x = r.random((4000, 9))
    y = (x[:, 0] + 0.5 * np.sin(6 * x[:, 2]) - x[:, 3] + 0.1 * r.normal(size=4000) > 0.3).astype(float)
    signs = list(Q.FEATURES.values())
    trees = Q.train(x[:3000], y[:3000], signs)
    assert ((trees.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.85
    for j, s in enumerate(signs):
        if s:
            grid = np.repeat(x[3000:3050], 20, 0)
            grid[:, j] = np.tile(np.linspace(0, 1, 20), 50)
            assert (s * np.diff(trees.score(grid).reshape(50, 20), axis=1) >= -1e-12).all()


def test_query_shape_and_verdicts(spark):
    r = random.Random(5)
    rows, labels = [], []
    for i in range(300):
        good = i % 3 > 0
        w = ["".join(r.choices("abcdefgh", k=r.randint(1, 8))) for _ in range(r.randint(55, 90))]
        rows.append((i, " ".join(w if good else [x + "###" for x in w])))
        if i % 2:
            labels.append((i, int(good)))
    rows += [(300, None), (301, ""), (302, "few words"), (303, "a b c " * 40), (None, rows[1][1]), (1, rows[1][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_words", "2 AS quality")
    lab = spark.createDataFrame(labels + [(None, 1), (1, None), (1, 1)], "doc_id long, quality int")
    got = Q.judge_quality(docs, lab).collect()
    assert len(got) == len(rows)
    for x in got:
        if x.doc_id is not None and x.doc_id < 300:
            assert not x.base_failed and x.kept == (x.doc_id % 3 > 0)
        elif x.doc_id in (300, 301, 302, 303):
            assert x.base_failed and not x.kept
    none = Q.judge_quality(docs, lab.filter("false")).collect()
    assert all(x.kept != x.base_failed and x.score is None for x in none)
    assert Q.judge_quality(docs.filter("false"), lab).count() == 0
