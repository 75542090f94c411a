import random
import re
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from quarrymark.llm import arrays as A
from quarrymark.llm import jaccard as J

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"


def sets(text, n=5):
    w = WORD.findall(text or "")
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute(rows):
    top = 2**63
    s = [sets(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            inter = len(s[i] & s[j])
            if inter and 9 * inter >= 4 * (len(s[i]) + len(s[j])):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        r = find(k)
        least[r] = min(least.get(r, top), top if i is None else i)
    return sorted(((i, None if least[find(k)] == top else least[find(k)], links[k]) for k, (i, _) in enumerate(rows)), key=str)


def find_class(rows, k):
    """The least place linked to row k."""
    s = [sets(t) for _, t in rows]
    seen, todo = {k}, [k]
    while todo:
        i = todo.pop()
        for j in range(len(rows)):
            inter = len(s[i] & s[j])
            if j not in seen and inter and 9 * inter >= 4 * (len(s[i]) + len(s[j])):
                seen.add(j)
                todo.append(j)
    return min(seen)


def corpus(seed):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for base in range(25):
        words = r.choices(vocab, k=r.choice([3, 8, 40, 120, 300]))
        for _ in range(r.choice([1, 1, 2, 5, 12])):
            w = list(words)
            for _ in range(r.randint(0, max(1, len(w) // 30))):
                w[r.randrange(len(w))] = r.choice(vocab)
            rows.append(r.choice([" ", "\n"]).join(w))
    rows += [rows[0], rows[1], rows[1] + " ", "", None, "", "one", "one", "two words", "a b c d", "a b c d e"]
    r.shuffle(rows)
    out = list(enumerate(rows))
    return out + [(None, rows[4]), (3, rows[7]), (3, rows[3]), (None, None)]


@pytest.mark.parametrize("seed,limit", [(1, J.SET_LIMIT), (2, 500)])
def test_against_brute_force(spark, seed, limit, monkeypatch):
    monkeypatch.setattr(J, "SMALL_SETS", limit)
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS node", "2 AS id", "3 AS class")
    got = sorted((tuple(x) for x in J.similar_documents(docs, set_limit=limit).collect()), key=str)
    assert got == brute(rows)


def test_keep_one(spark):
    rows = corpus(3)
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS _x")
    kept = J.keep_one(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    want = brute(rows)
    classes = {find_class(rows, k) for k, (_, t) in enumerate(rows) if sets(t)}
    assert len(want) == len(rows) and len(got) == len(classes) + sum(not sets(t) for _, t in rows)
    assert len([x for x in got if sets(x.text)]) == len({frozenset(sets(x.text)) for x in got if sets(x.text)})


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert J.similar_documents(docs).count() == 0 and J.keep_one(docs).count() == 0


def test_components(spark):
    r = random.Random(4)
    edges = [(i, i + 1) for i in range(60)] + [(100 + r.randrange(40), 100 + r.randrange(40)) for _ in range(30)] + [(200, k) for k in range(201, 260)]
    got = {x.node: x.comp for x in J.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    label = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert got == {k: v for k, v in label.items() if any(k in e and e[0] != e[1] for e in edges)}


def test_depth():
    assert J.matched_depth(0.8, J.TREES, J.DEPTH, J.RECALL) == 7 and J.matched_depth(0.8, 1, 6, 0.99) == 1
    assert 1 - (1 - 0.8**7) ** J.TREES >= J.RECALL


def test_depths_by_size():
    ratio = Fraction(4, 5)
    asks, near = J.depths(ratio, J.TREES, J.DEPTH, J.RECALL)
    assert asks[:8].tolist() == [0, 0, 0, 0, 7, 7, 8, 10] and set(asks[40:]) == {7}
    for n in range(1, 30):  # against all pairs of sizes
        all_ = {Fraction(i, n + m - i) for m in range(1, 60) for i in range(1, min(n, m) + 1) if ratio <= Fraction(i, n + m - i) < 1}
        assert J.least_similarity(n, ratio) == min(all_, default=None)
        if all_ and n < J.SIZES:
            assert 1 - (1 - float(min(all_)) ** asks[n]) ** J.TREES >= J.RECALL
    assert all(asks[n] in near[n] for n in range(len(asks)) if asks[n])


def test_trie_nodes_are_prefixes():
    r = random.Random(5)
    texts = [" ".join(r.choices("abcdefghij", k=r.choice([3, 6, 9, 10, 11, 40]))) for _ in range(60)] + [""]
    values, bounds = J.shingle_sets(*A.text_arrays(pa.array(texts)))
    asks, near = J.depths(Fraction(4, 5), J.TREES, J.DEPTH, J.RECALL)
    asked, others = J.trie_nodes(values, bounds, J.TREES, asks, near)
    some = [t for t in texts if t]
    for k, t in enumerate(some):
        n = len(sets(t))
        assert len(asked[k]) == (J.TREES if asks[n] else 0)
        assert len(others[k]) == J.TREES * len(near[n] - {asks[n]})
    alone = J.trie_nodes(*J.shingle_sets(*A.text_arrays(pa.array([some[7]]))), J.TREES, asks, near)
    assert alone[0][0].tolist() == asked[7].tolist() and alone[1][0].tolist() == others[7].tolist()


def test_short_near_copies_are_found(spark):
    r = random.Random(6)
    rows = []
    for base in range(150):
        w = [f"v{base}x{k}" for k in range(r.randint(8, 13))]
        rows += [" ".join(w), " ".join(w[:-1]), " ".join([*w, "end"]), " ".join(w[1:])]
    rows = list(enumerate(rows))
    assert sorted((tuple(x) for x in J.similar_documents(spark.createDataFrame(rows, SCHEMA)).collect()), key=str) == brute(rows)


def test_only_candidates_are_compared():
    sets_ = [np.arange(10, dtype=np.uint64), np.arange(10, dtype=np.uint64) + np.uint64(1), np.arange(100, 110, dtype=np.uint64)]
    same, other = np.array([5], np.int64), np.array([6], np.int64)
    ones = np.ones(3, np.int64)
    assert [x.tolist() for x in J.compare(sets_, [same, same, same], 3, True, ones, Fraction(4, 5))] == [[1, 1, 0], [0, 0, 2]]
    assert [x.tolist() for x in J.compare(sets_, [same, other, same], 3, True, ones, Fraction(4, 5))] == [[0, 0, 0], [0, 1, 2]]


def test_rows_without_id_and_names_that_clash(spark):
    same = " ".join(f"w{i}" for i in range(30))
    rows = [(None, same, k) for k in range(20)] + [(None, same + " x", 1), (None, "lone text here", 1), (None, None, 2), (None, None, 2), (4, "a b c d e f", 1), (4, "a b c d e f", 1), (5, "a b  c d e f", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _n long").selectExpr("*", "77 AS at", "78 AS whole", "_n AS _id", "1 AS _node", "2 AS _first")
    got = sorted((tuple(x) for x in J.similar_documents(docs).collect()), key=str)
    assert got == brute([r[:2] for r in rows])
    kept = J.keep_one(docs)
    assert kept.columns == docs.columns
    out = kept.collect()
    assert sorted(str(x.text) for x in out) == sorted(["None", "None", same, same + " x", "lone text here", "a b c d e f"])
    assert all(x.at == 77 and x.whole == 78 and x._id == x._n for x in out) and [x.doc_id for x in out if x.text == "a b c d e f"] == [4]


def test_long_text_and_ids_of_other_types(spark):
    long = " ".join(f"w{i * 7919 % 100003}" for i in range(200_000))  # more than 1 MB
    rows = [(1, long), (2, long + " more"), (3, "w1 w2")]
    assert sorted(tuple(x) for x in J.similar_documents(spark.createDataFrame(rows, SCHEMA)).collect()) == [(1, 1, 1), (2, 1, 1), (3, 3, 0)]
    with pytest.raises(TypeError):
        J.similar_documents(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_shingle_sets():
    texts = ["", "a b c d e f a b c d e", "x", "a\tb\nc d e"]
    data, off = A.text_arrays(pa.array(texts))
    values, bounds = J.shingle_sets(data, off)
    assert np.diff(bounds).tolist() == [len(sets(t)) for t in texts]
    assert values[bounds[3]] in values[bounds[1] : bounds[2]]
