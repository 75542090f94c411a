"""Mixing sources to target weights by Sainte-Laguë apportionment.

Highest quotients (target / 1, 3, 5, ...) give each source an integer quota of words, and again each of its shards a quota
by the shard's words. Quotas are words, not blocks, as a source or shard may be smaller than a block. Only then are blocks of
equally many words selected: a shard's documents stand in a seeded order, whole copies of the shard come first, and a seeded
choice of its blocks, the last one in part, gives the rest. A shard is a hashed share of one source of about SHARD_ROWS documents,
so that a hot source is many shards, and how many follows from the data alone. Shards' quotas are dealt where a source's shards meet; the
driver sees sources, up to a fixed number, and sums.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import numbered, partitions, salted_join, written

#: Blocks in all words, at least one word each; more blocks spread a choice wider, and quotas don't depend on them.
BLOCKS = 1 << 20
REPEAT = 3
#: Sources that the driver ranks itself, and documents expected in a shard.
MOST_LOCAL, SHARD_ROWS = 10_000, 1_000
WORD = r"[^\x20\x09-\x0D]+"


def apportion(weights: np.ndarray, seats: int, caps: np.ndarray) -> np.ndarray:
    """Seats by highest quotients weight / (2 s + 1), never above the caps; ties go to the first.

    Bisection finds how low quotients go in whole, so that only the last seats are dealt one by one.
    """
    weights, caps = np.asarray(weights, float), np.asarray(caps, np.int64)
    seats = int(min(seats, caps[weights > 0].sum()))
    if seats <= 0:
        return np.zeros(len(weights), np.int64)

    def above(q: float) -> np.ndarray:  # seats whose quotients exceed q
        return np.minimum(np.maximum(np.ceil((weights / q - 1) / 2), 0), caps).astype(np.int64)

    lo, hi = 0.0, float(weights.max()) * 2
    for _ in range(200):
        mid = (lo + hi) / 2
        if mid in (lo, hi):
            break
        if above(mid).sum() > seats:
            lo = mid
        else:
            hi = mid
    out = above(hi)
    while (missing := seats - int(out.sum())) > 0:
        q = np.where(out < caps, weights / (2 * out + 1), -1.0)
        best = np.argsort(-q, kind="stable")[:missing]
        best = best[q[best] == q[best[0]]]  # equal quotients together
        out[best] += 1
    return out


def targets(sizes: np.ndarray, weights: np.ndarray, most: float = REPEAT) -> np.ndarray:
    """Each source's share of all words by weight; what exceeds `most` times a source's size is shared again."""
    sizes, weights = np.asarray(sizes, float), np.asarray(weights, float)
    out, full = np.zeros(len(sizes)), np.zeros(len(sizes), bool)
    while not full.all():
        if not weights[~full].any():
            break
        rest = sizes.sum() - most * sizes[full].sum()
        out[~full] = rest * weights[~full] / weights[~full].sum()
        over = ~full & (out > most * sizes)
        if not over.any():
            break
        full |= over
        out[full] = most * sizes[full]
    return out


def mix_sources(docs: DataFrame, seed: int = 7, blocks: int = BLOCKS, weights: dict | None = None, size: Column | None = None, text: str = "text", most: int = MOST_LOCAL, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """How many words of each document the mix takes.

    docs: doc_id, source, text. Sources weigh 1, 2, 3, repeating, in code-point order with null last, or as in weights.
    A row out for each row in: doc_id, size (words), source_size, target (its source's), taken (at most REPEAT times
    its size). Null and empty texts have size 0 and give nothing. Equal rows stand side by side in the order, so which of
    them is which doesn't matter; they share a shard. The same rows and seed give the same mix under any partitioning and
    any spark.sql.shuffle.partitions. With more than `most` sources the same quotas are worked out in Spark.
    """
    words = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long") if size is None else size
    own = [F.col(c) for c in ("doc_id", text) if c in docs.columns]
    key = F.concat(F.when(F.col("source").isNull(), "1").otherwise("0"), F.coalesce("source", F.lit("")))  # code-point order, null last
    sized = written(docs.select("doc_id", key.alias("key"), words.alias("size"), F.xxhash64(*own, F.lit(seed)).alias("place")), "sizes")
    by_source = written(sized.groupBy("key").agg(F.sum("size").alias("size"), F.count("*").alias("n")), "sources")
    count, total = by_source.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    block = max(1, total // blocks)
    if count <= most:
        known = F.broadcast(_local_shares(by_source, weights))
        dealt = sized.join(known, "key")
    else:
        known = written(_spark_shares(by_source, weights, int(total)), "shares")
        dealt = salted_join(sized, known, "key", F.col("place"), 2 * partitions(docs.sparkSession))
    shards = F.ceil(F.col("n") / F.lit(shard_rows))
    dealt = dealt.select("doc_id", "size", "source_size", "target", "quota", "src", F.pmod("place", shards).alias("shard"), F.xxhash64("place").alias("place"))
    sums = dealt.groupBy("src", "shard").agg(F.sum("size").alias("size"), F.first("quota").alias("quota"))

    def share(table: pa.Table) -> pa.Table:
        table = table.sort_by("shard")
        sizes = table["size"].to_numpy()
        return table.select(["src", "shard"]).append_column("words", pa.array(apportion(sizes, int(table["quota"][0].as_py()), REPEAT * sizes)))

    def select(table: pa.Table, quota: pa.Table) -> pa.Table:
        table = table.sort_by([("place", "ascending"), ("doc_id", "ascending"), ("size", "ascending")])
        taken = _take(table["size"].to_numpy(), quota["words"][0].as_py(), block, (seed, table["src"][0].as_py(), table["shard"][0].as_py())) if len(table) else []
        return table.select(["doc_id", "size", "source_size", "target"]).append_column("taken", pa.array(taken, pa.int64()))

    quotas = sums.groupBy("src").applyInArrow(share, "src long, shard long, words long")
    return dealt.groupBy("src", "shard").cogroup(quotas.groupBy("src", "shard")).applyInArrow(select, f"doc_id {dict(docs.dtypes)['doc_id']}, size long, source_size long, target double, taken long")


SHARES = "key string, src long, source_size long, n long, target double, quota long"


def _local_shares(by_source: DataFrame, weights: dict | None) -> DataFrame:
    """Each source's rank, target and quota of words."""
    rows = sorted(by_source.collect(), key=lambda r: r["key"])
    sizes = np.array([r["size"] for r in rows], np.int64)
    weigh = np.array([weights.get(r["key"][1:] if r["key"][0] == "0" else None, 0) if weights else i % 3 + 1 for i, r in enumerate(rows)], float)
    aims = targets(sizes, weigh)
    quotas = apportion(aims, int(sizes.sum()), REPEAT * sizes)
    return by_source.sparkSession.createDataFrame([(r["key"], i, r["size"], r["n"], float(aims[i]), int(quotas[i])) for i, r in enumerate(rows)], SHARES)


def _spark_shares(by_source: DataFrame, weights: dict | None, total: int) -> DataFrame:
    """The same for any number of sources: targets by one aggregate a round, quotas by one for each step of the bisection."""
    ranked = numbered(by_source, "key")
    weight = F.pmod("src", F.lit(3)) + 1
    if weights is not None:
        table = by_source.sparkSession.createDataFrame([("1" if k is None else "0" + k, float(w)) for k, w in weights.items()], "key string, weight double")
        ranked, weight = ranked.join(F.broadcast(table), "key", "left"), F.coalesce("weight", F.lit(0.0))
    rows = written(ranked.select("key", "src", F.col("size").alias("source_size"), "n", weight.cast("double").alias("weight")), "ranked")
    full, rest, free = F.lit(False), float(total), 0.0
    n_full = -1
    while True:
        at, left, free = rows.agg(F.count_if(full), F.sum(F.when(full, F.col("source_size") * REPEAT).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if at == n_full or not free:
            break
        n_full, rest = at, float(total) - float(left)
        full = F.lit(rest) * F.col("weight") / F.lit(float(free)) > F.col("source_size") * REPEAT
    aim = F.when(full, F.col("source_size") * float(REPEAT)).otherwise(F.lit(rest) * F.col("weight") / F.lit(float(free)) if free else F.lit(0.0))
    rows = written(rows.select("key", "src", "source_size", "n", aim.alias("target")), "targets")
    cap = F.col("source_size") * REPEAT
    most, room = rows.agg(F.max("target"), F.sum(F.when(F.col("target") > 0, cap).otherwise(0))).first()
    seats = min(total, int(room or 0))
    above = lambda q: F.least(F.greatest(F.ceil((F.col("target") / F.lit(q) - 1) / 2), F.lit(0)), cap).cast("long") if q > 0 else cap
    lo, hi = 0.0, float(most or 0.0) * 2
    for _ in range(200 if seats > 0 else 0):
        mid = (lo + hi) / 2
        if mid in (lo, hi):
            break
        if rows.agg(F.sum(above(mid))).first()[0] > seats:
            lo = mid
        else:
            hi = mid
    rows = written(rows.withColumn("quota", above(hi) if seats > 0 else F.lit(0).cast("long")), "quotas")
    missing = seats - int(rows.agg(F.sum("quota")).first()[0] or 0)
    if missing <= 0:
        return rows
    # What is left are equal quotients, one seat each, dealt by rank.
    quotient = F.col("target") / (2 * F.col("quota") + 1)
    some = rows.filter(F.col("quota") < cap).orderBy(F.desc(quotient), "src").limit(missing).select("key", F.lit(1).alias("one"))
    return rows.join(some, "key", "left").withColumn("quota", F.col("quota") + F.coalesce("one", F.lit(0))).drop("one")


def _take(sizes: np.ndarray, words: int, block: int, seed: tuple[int, ...]) -> np.ndarray:
    """Words of each document among so many words of the shard."""
    total = int(sizes.sum())
    if not total:
        return np.zeros(len(sizes), np.int64)
    copies, rest = divmod(words, total)
    chosen = np.random.default_rng(seed).permutation(-(-total // block))
    lens = np.minimum((chosen + 1) * block, total) - chosen * block
    use = np.minimum(lens, np.maximum(rest - (np.cumsum(lens) - lens), 0))  # the last block only as far as needed
    per = np.zeros(len(chosen) + 1, np.int64)
    per[1:][chosen] = use
    before, taken = np.cumsum(per), per[1:]
    at = np.concatenate(([0], np.cumsum(sizes)))
    b = np.minimum(at // block, len(chosen) - 1)
    upto = before[b] + np.minimum(at - b * block, taken[b])
    return copies * sizes + np.diff(upto)
