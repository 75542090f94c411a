import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrymark.llm import mixing as M


def slow(weights, seats, caps):
    out = [0] * len(weights)
    for _ in range(seats):
        q = [w / (2 * s + 1) if s < c else -1 for w, s, c in zip(weights, out, caps, strict=True)]
        if max(q) <= 0:
            break
        out[q.index(max(q))] += 1
    return out


@pytest.mark.parametrize("seed", range(8))
def test_apportion_is_highest_quotients(seed):
    r = random.Random(seed)
    w = [r.choice([0, 1, 2, 3, 5, 10, 99.5]) for _ in range(r.randint(1, 9))]
    caps = [r.choice([0, 1, 5, 1000]) for _ in w]
    seats = r.randint(0, 300)
    assert M.apportion(np.array(w), seats, np.array(caps)).tolist() == slow(w, seats, caps)


def test_targets():
    assert M.targets([100, 10, 10], [1, 2, 3]).tolist() == [60, 30, 30]
    assert M.targets([40, 40, 40], [1, 2, 3]).tolist() == [20, 40, 60]


def rows(seed, n=400):
    r = random.Random(seed)
    out = [(i, r.choice(["a", "a", "a", "b", "c", None, ""]), " ".join("w" * r.randint(0, 60))) for i in range(n)]
    return out + [(n, "a", None), (n + 1, "b", ""), (None, "c", "x y z"), (5, "a", "x y"), (5, "a", "x y"), (n + 2, "zz", "tiny")]


@pytest.mark.parametrize("blocks", [1 << 20, 300])
def test_mix(spark, blocks):
    docs = spark.createDataFrame(rows(1), "doc_id long, source string, text string").selectExpr("*", "7 AS size", "1 AS shard")
    got = [tuple(x) for x in M.mix_sources(docs, blocks=blocks).collect()]
    again = [tuple(x) for x in M.mix_sources(docs.repartition(7), blocks=blocks).collect()]
    assert sorted(got, key=str) == sorted(again, key=str) and len(got) == docs.count()
    want = sorted(((i, len((t or "").split())) for i, _, t in rows(1)), key=str)
    assert sorted(((x[0], x[1]) for x in got), key=str) == want
    total = sum(x[1] for x in got)
    block = max(1, total // blocks)
    by_target = {}
    for _, size, source_size, target, taken in got:
        assert 0 <= taken <= 3 * size
        s = by_target.setdefault((source_size, target), [0, 0])
        s[0] += size
        s[1] += taken
    for (source_size, target), (size, taken) in by_target.items():
        assert size == source_size and target <= 3 * size + 1e-6 and abs(taken - target) <= 20 * block


def test_sources_smaller_than_a_block(spark):
    rows = [(i, "big", 600_000_000 + i) for i in range(8)] + [(100 + i, "small", 300 + i) for i in range(5)] + [(200, "tiny", 7)]
    got = M.mix_sources(spark.createDataFrame(rows, "doc_id long, source string, n long"), size=F.col("n")).collect()
    total = sum(n for _, _, n in rows)
    assert total // M.BLOCKS > 3 * 1510  # a block is more than three times the small source
    size, taken = {d: n for d, _, n in rows}, {x.doc_id: x.taken for x in got}
    assert all(taken[d] == 3 * size[d] for d in size if d >= 100)
    assert sum(taken.values()) == total


@pytest.mark.parametrize("blocks", [1 << 20, 300, 1])
def test_taken_is_the_target_at_any_block(spark, blocks):
    docs = spark.createDataFrame(rows(2), "doc_id long, source string, text string")
    sums = {}
    for x in M.mix_sources(docs, blocks=blocks).collect():
        s = sums.setdefault((x.source_size, x.target), [0])
        s[0] += x.taken
    assert all(abs(taken - target) <= 1 for (_, target), (taken,) in sums.items())


def test_empty_table(spark):
    assert M.mix_sources(spark.createDataFrame([], "doc_id long, source string, text string")).count() == 0


def test_take_is_whole():
    sizes = np.array([3, 0, 5, 1, 9])
    for words in range(0, 55):
        t = M._take(sizes, words, 4, (1, 2, 3))
        assert t.sum() == words and (t <= -(-words // 18) * sizes).all()


@pytest.mark.parametrize("n", [2, 8, 200])
def test_partitions_don_t_change_the_mix(spark, n):
    docs = spark.createDataFrame(rows(3), "doc_id long, source string, text string")
    want = sorted((tuple(x) for x in M.mix_sources(docs, shard_rows=50).collect()), key=str)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        assert sorted((tuple(x) for x in M.mix_sources(docs.repartition(5), shard_rows=50).collect()), key=str) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("weights", [None, {"a": 5, "b": 1, None: 2, "": 3}])
def test_many_sources_get_the_same_quotas(spark, weights):
    docs = spark.createDataFrame(rows(4) + [(1000 + i, f"s{i % 23}", "w " * (i % 40)) for i in range(300)], "doc_id long, source string, text string")
    want = sorted((tuple(x) for x in M.mix_sources(docs, weights=weights).collect()), key=str)
    assert sorted((tuple(x) for x in M.mix_sources(docs, weights=weights, most=3).collect()), key=str) == want
    assert M.mix_sources(docs.filter("false"), most=-1).count() == 0


def test_huge_and_tiny_sources(spark):
    rows_ = [(0, "a", 10**10), (1, "b", 1000), (2, "c", 500)]
    got = {x.doc_id: (x.target, x.taken) for x in M.mix_sources(spark.createDataFrame(rows_, "doc_id long, source string, n long"), size=F.col("n")).collect()}
    assert got[1] == (3000.0, 3000) and got[2] == (1500.0, 1500) and abs(got[0][1] - got[0][0]) <= 1
