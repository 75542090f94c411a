import hashlib
import random
import zlib

import pytest

from quarrymark.llm import prefix_trie as P

KIND = "conv_id long, turn long, role string, text string"


def rebuilt(turns):
    by = {}
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    for c, turn, role, text in turns:
        if c is not None:
            by.setdefault(c, []).append((turn is not None, turn or 0, md5(role or ""), md5(text or ""), role or "", text or ""))
    own = {c: [x[4:] for x in sorted(v)] for c, v in by.items()}
    out = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + v[h:]
    return out


def brute(turns):
    convs = rebuilt(turns)
    members = {}
    for c, v in convs.items():
        for d in range(len(v) + 1):
            members.setdefault(tuple(v[:d]), []).append(c)
    out = []
    for p, m in members.items():
        below = [q for q in members if q[: len(p)] == p]
        leaves = [q for q in below if not any(len(x) == len(q) + 1 and x[: len(q)] == q for x in members)]
        ends = sorted(c for c in m if len(convs[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), sum(len(q) == len(p) + 1 for q in below), len(leaves), sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def made(df):
    nodes = P.prefix_trie(*P.shared_starts(P.ordered_turns(df)))
    return sorted((tuple(x) for x in nodes.drop("k1", "k2").collect()), key=str)


def turns(seed, n=60, ids=None, long=3):
    r = random.Random(seed)
    out = []
    for c in ids or [r.choice([r.randint(0, 12), r.randint(90, 112), r.randint(-205, -195), r.randint(300, 310)]) for _ in range(n)]:
        out += [(c, r.choice([0, 1, 2, 3, None]), r.choice(["u", "a", None, ""]), r.choice(["x", "yy", "zzé😀", None, ""])) for _ in range(r.randint(1, long))]
    return out + out[:5] + [(None, 0, "u", "no id")]


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    rows = turns(seed)
    assert made(spark.createDataFrame(rows, KIND)) == brute(rows)


def test_pieces_of_long_conversations_and_lists(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK", 3)
    monkeypatch.setattr(P, "RANGE", 2)
    rows = turns(9, long=11) + [(c, t, "u", "the same") for c in range(400, 440) for t in range(8)]
    assert made(spark.createDataFrame(rows, KIND).repartition(7)) == brute(rows)


def test_copies_of_one_conversation_and_a_hot_one(spark):
    rows = [(c, t, "u", f"turn {t}") for c in range(1000, 1300) for t in range(2, 9)] + [(55, 0, "u", "again")] * 2000 + [(55, 1, "a", None)]
    got = made(spark.createDataFrame(rows, KIND))
    short = [x for x in got if x[1] < 12]
    assert len(got) >= 2000 and {x[3] for x in short} >= {301, 1}
    small = rows[:2100] + [(55, 0, "u", "again")] * 40
    assert made(spark.createDataFrame(small[::-1], KIND)) == brute(small)


def test_empty_null_and_turnless(spark):
    assert made(spark.createDataFrame([], KIND)) == []
    assert made(spark.createDataFrame([(None, 1, "u", "x")], KIND)) == []
    rows = [(c, None, None, None) for c in (1, 2, 3, 4)]
    assert made(spark.createDataFrame(rows, KIND)) == brute(rows)
    void = spark.createDataFrame(rows, KIND).selectExpr("conv_id", "NULL AS turn", "NULL AS role", "NULL AS text", "1 AS pos", "2 AS part", "3 AS k1", "4 AS size")
    assert made(void) == brute(rows)


def test_a_very_long_text(spark):
    rows = [(c, 0, "u", "é" * 3_000_000) for c in (100, 101, 102)] + [(101, 1, "a", "end")]
    assert made(spark.createDataFrame(rows, KIND)) == brute(rows)


def test_ids_have_to_be_numbers(spark):
    with pytest.raises(TypeError):
        P.ordered_turns(spark.createDataFrame([("a", 0, "u", "x")], "conv_id string, turn long, role string, text string"))
