import hashlib
import random
import re

import pyarrow as pa
import pytest

from quarrymark.llm import decontaminate as D
from quarrymark.llm.decontaminate import find_leaks, longest_matches

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window):
    out = []
    for i, t in docs:
        w = words(t)
        hit, ids = set(), set()
        for item, text in items:
            v = words(text)
            n = min(len(v), window)
            wins = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} if n else set()
            for k in range(len(w) - n + 1):
                if n and tuple(w[k : k + n]) in wins:
                    hit |= set(range(k, k + n))
                    ids.add("" if item is None else str(item))
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def case(seed):
    r = random.Random(seed)
    vocab = ["a", "b", "É", "ñx", "Zed", "9", "it", "c3", "ß"]
    text = lambda n: r.choice([" ", ", ", "\n"]).join(r.choices(vocab, k=n))
    items = [(k, text(r.choice([1, 2, 3, 7, 10, 11, 30]))) for k in range(12)] + [(3, text(12)), (None, text(15)), (90, ""), (91, None), (100, "...")]
    docs = [(k, text(r.randint(0, 60)) + " " + (r.choice(items)[1] or "").upper() + "-" + text(3)) for k in range(60)] + [(60, None), (61, ""), (None, items[6][1]), (5, items[7][1]), (62, "Zed"), (62, "Zed")]
    return docs, items


@pytest.mark.parametrize("seed,window,block", [(1, 10, 1 << 20), (2, 10, 60), (3, 3, 1 << 20), (4, 4, 200)])
def test_against_brute_force(spark, seed, window, block):
    docs, items = case(seed)
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items, window)
    assert sorted((tuple(x) for x in find_leaks(d, b, window, block).collect()), key=str) == want
    extra = d.selectExpr("doc_id", "text", "1 AS n_hit", "2 AS item_id")
    kept = find_leaks(extra, b, window, block, keep_rows=True)
    assert kept.columns == extra.columns
    assert sorted((str(x.doc_id) for x in kept.collect())) == sorted(str(x[0]) for x in want if not x[5])


@pytest.mark.parametrize("block", [1 << 20, 100])
def test_texts_that_repeat_themselves(spark, block):
    items = [(1, "a " * 60), (2, "a " * 12), (3, "a b " * 20), (4, "b"), (5, "a " * 60), (6, "a a a b")]
    docs = [(1, "a " * 500), (2, "a b " * 200), (3, "a " * 9), (4, "b " * 30), (5, ("a " * 11 + "c ") * 20), (6, "a a a b a b a b")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert sorted((tuple(x) for x in find_leaks(d, b, 10, block).collect()), key=str) == brute(docs, items, 10)


def test_occurrences_are_no_more_than_words():
    tests = D.test_suffixes([1, 2], ["a " * 2000, "a " * 1990], 10)
    ((_, w),) = D.shards(pa.array(["a " * 500_000]))
    h = D.search(w, tests, 10)
    assert len(h.test) == 1 and len(h.suffixes) == 1991 + 1981 and len(h.place) == 500_000 - 9
    found = D.leaks(w, tests, 10)
    assert found.cover.all() and found.row.tolist() == [0, 0] and found.item.tolist() == [0, 1]


def test_unequal_windows_of_equal_hashes():
    tests = D.test_suffixes([1, 2, 3], ["a b c", "a x c", "a b c"], 3)
    ((_, w),) = D.shards(pa.array(["a b c", "a x c", "z"]))
    for side in (tests.words, w):  # as if b and x had one hash
        for own in (side.hashes, side.pairs):
            own[:3], own[3:6] = own[:3].copy(), own[:3].copy()
    tests.words.pairs[6:9] = tests.words.pairs[:3]
    found = D.leaks(w, tests, 3)
    assert found.cover.tolist() == [True] * 6 + [False] and list(zip(found.row.tolist(), found.item.tolist())) == [(0, 0), (0, 2), (1, 1)]


def test_empty_tables(spark):
    d, b = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    full = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert find_leaks(d, b).count() == 0
    assert [(x.n_words, x.contaminated) for x in find_leaks(full, b).collect()] == [(2, False)]


@pytest.mark.parametrize("block", [1 << 20, 20])
def test_longest_matches(spark, block):
    d = spark.createDataFrame([(1, "x y one two three four five z"), (2, "two three"), (3, "one two three x three four five six")], "doc_id long, text string")
    b = spark.createDataFrame([(7, "one two three four five six"), (8, "z x"), (9, "y one two nine")], "item_id long, text string")
    got = sorted(tuple(x) for x in longest_matches(d, b, window=3, block_bytes=block).collect())
    assert got == [("7", 0, 1, 2, 5), ("7", 0, 3, 0, 3), ("7", 2, 3, 4, 4), ("9", 0, 1, 1, 3)]


@pytest.mark.parametrize("seed,window", [(5, 3), (6, 4)])
def test_longest_matches_against_brute_force(spark, seed, window):
    docs, items = case(seed)
    docs = [(k, t) for k, (_, t) in enumerate(docs)]
    items = [(str(k), t) for k, (_, t) in enumerate(items)]
    want = set()
    for i, t in docs:
        w = words(t)
        for item, text in items:
            v = words(text)
            n = min(len(v), window)
            for a in range(len(v) if n else 0):
                for b in range(len(w)):
                    if v[a] == w[b] and not (a and b and v[a - 1] == w[b - 1]):
                        size = 0
                        while a + size < len(v) and b + size < len(w) and v[a + size] == w[b + size]:
                            size += 1
                        if size >= n and (len(v) >= window or a == 0):
                            want.add((item, a, i, b, size))
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string")
    got = [tuple(x) for x in longest_matches(d, b, window).collect()]
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("block", [1 << 20, 300])
def test_string_ids_long_texts_and_clashing_names(spark, block):
    long = " ".join(f"w{i}" for i in range(200_000))  # more than 1 MB
    rows = [("a|", "b " + long), ("a", "|b x"), (None, long[600_000:600_200]), ("c", "clean")]
    items = [(1, long[600_000:600_120]), (2, long[:100]), (3, "|b x")]
    d = spark.createDataFrame(rows, "doc_id string, text string").selectExpr("*", "1 AS row", "2 AS _row", "3 AS item")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert sorted((tuple(x) for x in find_leaks(d, b, 10, block).collect()), key=str) == brute(rows, items, 10)
    kept = find_leaks(d, b, 10, block, keep_rows=True)
    assert kept.columns == d.columns and [x.doc_id for x in kept.collect()] == ["c"]
