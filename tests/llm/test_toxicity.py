import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarrymark.llm import arrays as A
from quarrymark.llm import toxicity as T


def corpus(seed, n=900):
    r = random.Random(seed)
    vocab = ["".join(r.choices("abcdefghijklé", k=r.randint(2, 7))) for _ in range(300)]
    bad = ["idyot", "skum", "troshX", "Éwful"]
    docs, labels = [], []
    for i in range(n):
        w = r.choices(vocab, k=r.randint(20, 120))
        toxic = i % 5 == 0
        if toxic:
            for _ in range(r.randint(1, 8)):
                w[r.randrange(len(w))] = r.choice([r.choice(bad), "zqxv" + "".join(r.choices("abcdef", k=3))])
        docs.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_held_out(spark):
    docs, labels = corpus(1)
    d = spark.createDataFrame(docs + [(2000, None), (2001, ""), (None, docs[1][1])], "doc_id long, text string").selectExpr("*", "'x' AS toxic", "1 AS grade")
    lab = spark.createDataFrame([x for x in labels if x[0] < 600] + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = {x.doc_id: x for x in T.judge_toxicity(d, lab).collect()}
    assert len(got) == len(docs) + 3
    wrong = sum(got[i].toxic != bool(y) for i, y in labels if i >= 600)
    assert wrong <= 3
    assert not got[2000].toxic and not got[2001].toxic and not got[None].toxic
    assert all(0 <= x.expected_severity <= 2 for x in got.values())
    kept = T.drop_toxic(d, lab)
    assert kept.columns == d.columns and kept.count() == sum(not x.toxic for x in got.values())


def test_degenerate(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    lab = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert [(x.toxic, x.p_toxic) for x in T.judge_toxicity(d, lab).collect()] == [(False, None)]
    assert T.judge_toxicity(d.filter("false"), lab).count() == 0
    assert T.drop_toxic(d, lab.filter("false")).count() == 1


def test_thresholds_are_ordered_and_shared():
    r = np.random.default_rng(2)
    x = r.random((3000, 3))
    s = 6 * x[:, 0] - 4 * x[:, 1]
    grade = np.searchsorted([0.0, 1.5, 3.0], s + r.logistic(size=3000) * 0.5)
    row, col = np.repeat(np.arange(3000), 3), np.tile(np.arange(3), 3000)
    w, th = T.fit_ordinal(row, col, x.ravel(), grade, 3, steps=1500)
    assert (np.diff(th) > 0).all() and w[0] > 4 and w[1] < -2 and abs(w[2]) < 1
    expected = T.Ordinal(None, w, th).above(x @ w).sum(1)
    assert np.corrcoef(expected, grade)[0, 1] > 0.85


@pytest.mark.parametrize("top", [1, 2, 4])
def test_gradient_matches_differences(top):
    r = np.random.default_rng(3)
    n, k, m = 40, 6, 150
    row, col, value = r.integers(0, n, m), r.integers(0, k, m), r.random(m) + 0.1
    grade = np.append(r.integers(0, top + 1, n - top - 1), np.arange(top + 1))
    p = np.concatenate((r.normal(size=k), [-0.5], r.normal(size=top - 1) * 0.3))
    _, g = T.loss_and_gradient(p, row, col, value, grade, k, 0.3)
    for i in range(len(p)):
        e = np.zeros(len(p))
        e[i] = 1e-5
        up, down = (T.loss_and_gradient(x, row, col, value, grade, k, 0.3)[0] for x in (p + e, p - e))
        assert abs((up - down) / 2e-5 - g[i]) < 1e-6
    assert (np.diff(T.thresholds_of(p, k)) > 0).all()


def plain_severity(text, weights, thresholds):
    """P(grade > k) by dictionaries: folded words and first characters of longer ones, log(1 + count)."""
    counts = {}
    for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
        for f in [("word", w), *((n, w[:n]) for n in (4, 5) if len(w) > n)]:
            counts[f] = counts.get(f, 0) + 1
    score = sum(weights.get(f, 0.0) * math.log1p(n) for f, n in counts.items())
    return [1 / (1 + math.exp(t - score)) for t in thresholds]


def test_scores_against_plain_python(spark):
    docs, labels = corpus(2, 400)
    docs += [(1000, None), (1001, ""), (1002, "Éwful ÉWFUL skum " * 60_000), (1003, docs[5][1].upper())]  # 1002: more than 1 MB
    d, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = T.fit(d, lab, F.col("toxic"), 2)
    weights = {}
    for w in {w for _, t in docs for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))}:
        data, offsets = A.text_arrays(pa.array([w]))
        _, feats, _ = T.text_features(data, offsets)
        for f, h in zip([("word", w), *((n, w[:n]) for n in (4, 5) if len(w) > n)], feats, strict=True):
            k = np.searchsorted(model.features, h)
            if k < len(model.features) and model.features[k] == h:
                weights[f] = model.weights[k]
    texts = dict(docs)
    for x in T.judge_toxicity(d, lab).collect():
        p = plain_severity(texts[x.doc_id], weights, model.thresholds)
        assert abs(x.p_toxic - p[0]) < 1e-9 and abs(x.expected_severity - sum(p)) < 1e-9 and x.toxic == (x.p_toxic >= T.THRESHOLD)
        steps = [1 - p[0], p[0] - p[1], p[1]]
        assert steps[x.grade] >= max(steps) - 1e-9
