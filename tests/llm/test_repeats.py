import hashlib
import random
import re

import numpy as np
import pytest

from quarrymark.llm import suffix_dedup as S
from quarrymark.llm import substring_dedup as W
from quarrymark.llm.substring_dedup import dedup_words

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"


def brute(rows, length, words):
    """doc_id, symbols, removed, spans, digest for each row."""
    split = [(i, WORD.findall(t.encode()) if words else [bytes([b]) for b in t.encode()]) for i, t in ((i, t or "") for i, t in rows)]
    least = {}
    for i, s in split:
        for k in range(len(s) - length + 1):
            if i is not None:
                w = tuple(s[k : k + length])
                least[w] = min(least.get(w, i), i)
    out = []
    for i, s in split:
        gone = [False] * len(s)
        for k in range(len(s) - length + 1):
            if i is not None and least[tuple(s[k : k + length])] < i:
                gone[k : k + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = (b" " if words else b"").join(x for x, g in zip(s, gone) if not g)
        out.append((i, len(s), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, n=60):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdéñ") for _ in range(r.randint(1, 6))) for _ in range(40)]
    passages = [" ".join(r.choices(vocab, k=r.randint(10, 40))) for _ in range(4)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(r.randint(0, 4)):
            parts.append(r.choice(passages) if r.random() < 0.4 else r.choice([" ", "\n", "  "]).join(r.choices(vocab, k=r.randint(1, 50))))
        rows.append((i, "\n".join(parts)))
    rows += [(n, rows[3][1]), (n + 1, rows[3][1]), (n + 1, rows[5][1]), (n + 2, None), (n + 3, ""), (None, rows[3][1]), (n + 4, "a" * 300), (n + 5, "a" * 170), (n + 6, "a b " * 90), (n + 7, "a b " * 40 + "c"), (n + 8, " ".join(vocab * 3)), (7, rows[8][1])]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,hot,block", [(1, 2000, 1 << 22), (2, 1, 2000)])
def test_bytes_against_brute_force(spark, seed, hot, block):
    rows = corpus(seed)
    got = S.dedup_bytes(spark.createDataFrame(rows, SCHEMA), hot=hot, block_bytes=block)
    assert sorted((tuple(x) for x in got.collect()), key=str) == brute(rows, 50, False)


@pytest.mark.parametrize("seed,hot,block", [(3, 2000, 1 << 22), (4, 1, 2000)])
def test_words_against_brute_force(spark, seed, hot, block):
    rows = corpus(seed)
    got = dedup_words(spark.createDataFrame(rows, SCHEMA), hot=hot, block_bytes=block)
    assert sorted((tuple(x) for x in got.collect()), key=str) == sorted(((i, n, g, d) for i, n, g, _, d in brute(rows, 13, True)), key=str)


def test_empty_table_and_extra_columns(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert S.dedup_bytes(docs).count() == 0 and dedup_words(docs).count() == 0
    extra = spark.createDataFrame([(1, "x" * 60, 5, 7), (2, "x" * 60, 5, 7)], "doc_id long, text string, block int, bucket int")
    assert sorted(x.n_removed for x in S.dedup_bytes(extra).collect()) == [0, 60]


def test_kept_texts(spark):
    docs = spark.createDataFrame([(1, "x" * 60), (2, "é" + "x" * 60 + "y")], SCHEMA)
    assert {x.doc_id: x.text for x in S.dedup_bytes(docs, texts=True).collect()} == {1: "x" * 60, 2: "éy"}
    docs = spark.createDataFrame([(1, "a b c d"), (2, "z  a b c\nw")], SCHEMA)
    assert {x.doc_id: x.text for x in dedup_words(docs, length=3, gram=2, texts=True).collect()} == {1: "a b c d", 2: "z w"}


@pytest.mark.parametrize("text", [b"", b"a", b"banana", b"a" * 500, b"abcabcabd" * 60, bytes(random.Random(5).choices(b"ab", k=800)), b"mississippi\x00\x00m"])
def test_suffix_array(text):
    assert S.suffix_array(text).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


@pytest.mark.parametrize("limit,together", [(13, 1 << 17), (13, 50), (3, 50), (None, 200)])
def test_refined_buckets(limit, together):
    data = np.frombuffer(bytes(random.Random(6).choices(b"ab", k=3000)), np.uint8)
    text = data.tobytes()
    order, pointer, deep = S.refine(np.append(data, np.uint8(0)), len(data) - np.arange(len(data) + 1), limit, together)
    suffixes = [text[i:] for i in range(len(text))]
    assert sorted(order.tolist()) == list(range(len(text)))
    depth = limit or len(text)
    assert [s[:depth] for s in (suffixes[i] for i in order)] == sorted(s[:depth] for s in suffixes)
    buckets = {}
    for i, p in enumerate(pointer[:-1].tolist()):
        buckets.setdefault(p, []).append(i)
    for own in buckets.values():
        assert len(own) == 1 or (limit and len({suffixes[i][: deep[i]] for i in own}) == 1 and all(deep[i] >= limit for i in own))


@pytest.mark.parametrize("most", [2, 20, 5000])
def test_maximal_repeats_against_brute_force(most):
    r = random.Random(8)
    texts = [" ".join(r.choices("abc", k=r.randint(0, 25))) for _ in range(12)] + [None, "", "a b c a b c a b c", "a b c a b c a b c"]
    split = [(t or "").split() for t in texts]
    places = {}
    for i, s in enumerate(split):
        for a in range(len(s)):
            for b in range(a + 3, len(s) + 1):
                places.setdefault(tuple(s[a:b]), []).append((i, a))
    want = set()
    for w, at in places.items():
        left = {split[i][a - 1] if a else (i, "start") for i, a in at}
        right = {split[i][a + len(w)] if a + len(w) < len(split[i]) else "end" for i, a in at}
        if len(at) > 1 and len(left) > 1 and (len(right) > 1 or right == {"end"}):
            want.add((w, tuple(at)))
    got = [(tuple(w), tuple(at)) for w, at in W.maximal_repeats(texts, 3, most)]
    assert len(got) == len(set(got)) and set(got) == want


def test_long_texts_and_hot_anchors(spark):
    r = random.Random(9)
    vocab = ["".join(r.choice("abcdefé") for _ in range(r.randint(1, 8))) for _ in range(3000)]
    long = " ".join(r.choices(vocab, k=220_000))  # more than 1 MB
    rows = [(1, long), (2, "x " + long[600_000:600_500] + " y"), (3, long[::-1][:1000]), (4, long + " end"), (0, long[100:400])]
    got = S.dedup_bytes(spark.createDataFrame(rows, SCHEMA), hot=1)
    assert sorted((tuple(x) for x in got.collect()), key=str) == brute(rows, 50, False)
    got = W.dedup_words(spark.createDataFrame(rows, SCHEMA), hot=1)
    assert sorted((tuple(x) for x in got.collect()), key=str) == sorted(((i, n, g, d) for i, n, g, _, d in brute(rows, 13, True)), key=str)


def test_ids_of_other_types(spark):
    docs = spark.createDataFrame([("a", "x")], "doc_id string, text string")
    for f in (S.dedup_bytes, W.dedup_words):
        with pytest.raises(TypeError):
            f(docs)


def test_many_rows_without_id(spark):
    rows = [(None, f"{i} " + "word " * 20) for i in range(50)] + [(7, "word " * 20), (9, "word " * 20)]
    got = W.dedup_words(spark.createDataFrame(rows, SCHEMA), block_bytes=500)
    assert sorted((tuple(x) for x in got.collect()), key=str) == sorted(((i, n, g, d) for i, n, g, _, d in brute(rows, 13, True)), key=str)


def test_two_long_texts_of_one_word(spark):
    n = 500_000
    docs = spark.createDataFrame([(1, "a " * n), (2, "a " * n), (3, "b " + "a " * 12)], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed) for r in W.dedup_words(docs).collect()}
    assert got == {1: (n, 0), 2: (n, n), 3: (13, 0)}
