"""Shards by a consistent-hash ring with bounded loads, with DataFrame functions only.

Every shard has virtual nodes on a ring; a key belongs to the first node clockwise of its own place. A shard takes keys up to its
capacity, the largest first (equal ones by hash), and keys that overflow continue clockwise to the next node of a shard that isn't
full. That goes in rounds: in each, every shard whose keys exceed its room becomes full, so there are no more rounds than shards,
and only the overflow, a few hundredths of the keys, goes into the next one.

How far a full shard goes is found from a histogram: sizes are summed by shard and bucket of the order, running sums over at most
2^17 buckets find the bucket in which the capacity is reached, and only its keys are ordered one by one. The ring is a table of
cells, whose size follows from the number of shards and not from the data.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import written

SHARDS = 8
#: Virtual nodes of a shard, and cells of the ring for each of them.
NODES, CELLS = 256, 64
#: Share of a shard's fair load by which its capacity is above it.
SLACK = 0.0
#: Size classes of a power of two, and hash buckets of a class.
FINE, DRAWS = 16, 128
#: Rows of a bucket that slots are counted in.
SLOT_ROWS = 1 << 13


def ring(shards: int, nodes: int = NODES) -> list[int]:
    """The shard of each cell of the ring: that of the first node at or after it.

    Each node takes its place from its own name, so another shard adds nodes and moves none. Of two nodes in a cell the lower shard's counts.
    The number of cells, a power of two, follows from that of the nodes.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    bits = (CELLS * nodes * shards).bit_length()
    place: dict[int, int] = {}
    for s in range(shards):
        for v in range(nodes):
            at = int.from_bytes(hashlib.sha256(f"{s}:{v}".encode()).digest()[:8], "big") >> (64 - bits)
            place[at] = min(s, place.get(at, s))
    out, now = [0] * (1 << bits), place[min(place)]
    for c in range(len(out) - 1, -1, -1):
        now = place.get(c, now)
        out[c] = now
    return out


def passing(cells: list[int], full: frozenset[int]) -> list[int]:
    """The ring with full shards passed over: each cell's next shard clockwise that isn't full."""
    now = next(s for s in cells if s not in full)
    out = list(cells)
    for c in range(len(cells) - 1, -1, -1):
        now = cells[c] if cells[c] not in full else now
        out[c] = now
    return out


def _literal(spark: SparkSession, rows: list[tuple], kind: str) -> DataFrame:
    """A small table, carried by the plan as JSON text."""
    names = [c.split()[0] for c in kind.split(", ")]
    text = json.dumps([dict(zip(names, r, strict=True)) for r in rows])
    fields = ", ".join(c.replace(" ", ": ") for c in kind.split(", "))
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{fields}>>")))


def _ring_table(spark: SparkSession, cells: list[int]) -> DataFrame:
    """(_cell, _shard), a row for each cell; the plan carries runs of cells of one shard."""
    runs, first = [], 0
    for c in range(1, len(cells) + 1):
        if c == len(cells) or cells[c] != cells[first]:
            runs.append((first, c - 1, cells[first]))
            first = c
    return _literal(spark, runs, "a int, b int, s int").select(F.explode(F.sequence("a", "b")).alias("_cell"), F.col("s").alias("_shard"))


def _order(size: Column) -> Column:
    """Classes of sizes, larger ones first: FINE of them for each power of two."""
    power = F.floor(F.log2(F.greatest(size, F.lit(1)).cast("double"))).cast("int")
    fine = F.least(F.floor((size / F.pow(F.lit(2.0), power) - 1) * FINE), F.lit(FINE - 1)).cast("int")
    return F.lit(64 * FINE) - (power * FINE + F.greatest(fine, F.lit(0)))


def copies(rows: DataFrame, *keys: str) -> DataFrame:
    """rows with _copy, their number among rows of equal keys, from 0; rows has _row, a number that has its partition above bit 33.

    Copies are counted within partitions, and partitions' counts added up, so no task gets all copies of a key.
    """
    part = F.shiftright("_row", 33)
    own = [F.coalesce(F.col(k).cast("string"), F.lit("\x00")).alias(f"_k{i}") for i, k in enumerate(keys)]
    names = [f"_k{i}" for i in range(len(keys))]
    many = rows.groupBy(*own).agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    told = rows.select("_row", part.alias("_part"), *own).join(many, names)
    local = told.withColumn("_local", F.row_number().over(Window.partitionBy("_part", *names).orderBy("_row")))
    before = local.groupBy("_part", *names).agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy(*names).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    numbered = local.join(before, ["_part", *names]).select("_row", (F.col("_before") + F.col("_local") - 1).alias("_copy"))
    return rows.join(numbered, "_row", "left").withColumn("_copy", F.coalesce("_copy", F.lit(0).cast("long")))


def ring_keys(docs: DataFrame, cells: list[int], size: Column | None = None, seed: int = 7, text: str = "text") -> DataFrame:
    """Each row's key: its cell of the ring, and its bucket and draw, which order the keys of a shard."""
    blob = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    base = written(docs.select("doc_id", (F.octet_length(blob).cast("long") + 1 if size is None else size.cast("long")).alias("_size"), F.crc32(blob).alias("_crc"), F.monotonically_increasing_id().alias("_row")), "keys")
    own = [F.col("doc_id"), F.col("_size"), F.col("_crc"), F.col("_copy")]
    place = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(0), *own), 64 - (len(cells) - 1).bit_length()).cast("int") if len(cells) > 1 else F.lit(0)
    draw = F.xxhash64(F.lit(seed), F.lit(1), *own)
    bucket = _order(F.col("_size")) * DRAWS + F.shiftrightunsigned(draw, 65 - DRAWS.bit_length()).cast("int")  # the first bits of draws, so draws go on where buckets end
    return copies(base, "doc_id", "_size", "_crc").select("doc_id", "_size", "_crc", "_row", place.alias("_cell"), bucket.alias("_bucket"), F.shiftrightunsigned(draw, 1).alias("_draw"))


def _thresholds(rows: DataFrame, room: dict[int, int]) -> dict[int, tuple[int, int]]:
    """For each shard with more keys than room: the last (bucket, draw) that it takes. A row for each shard reaches the driver."""
    spark = rows.sparkSession
    rooms = F.broadcast(_literal(spark, sorted(room.items()), "_shard int, _room bigint"))  # a row for each shard
    by_bucket = rows.groupBy("_shard", "_bucket").agg(F.sum("_size").alias("_sum"))
    w = Window.partitionBy("_shard")
    run = F.sum("_sum").over(w.orderBy("_bucket"))
    edges = by_bucket.withColumn("_run", run).withColumn("_all", F.sum("_sum").over(w)).join(rooms, "_shard")
    edges = edges.filter("_all > _room AND _run >= _room AND _run - _sum < _room").select("_shard", "_bucket", (F.col("_room") - F.col("_run") + F.col("_sum")).alias("_left"))
    at = rows.join(F.broadcast(edges), ["_shard", "_bucket"])  # one bucket of each shard
    order = Window.partitionBy("_shard").orderBy("_draw", "_row").rowsBetween(Window.unboundedPreceding, -1)
    taken = at.withColumn("_ahead", F.coalesce(F.sum("_size").over(order), F.lit(0))).filter("_ahead < _left")
    return {r["_shard"]: (r["_bucket"], r["_draw"]) for r in taken.groupBy("_shard").agg(F.first("_bucket").alias("_bucket"), F.max("_draw").alias("_draw")).collect()}


def shard_keys(docs: DataFrame, shards: int = SHARDS, size: Column | None = None, slack: float = SLACK, nodes: int = NODES, seed: int = 7, text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard and slot for each row of docs (doc_id, text).

    size: what shards are balanced by, a positive long; UTF-8 bytes of the text plus 1 where none is given, F.lit(1) for counts. No shard takes
    a key once it has (1 + slack) / shards of all sizes, so none is above that by more than the last key it took, one of its smallest; a key
    above the capacity is a shard's first. Slots number each shard's rows from 0. Rows of one id and text are numbered, and each is a key
    of its own, so copies spread over the ring as other keys do. Null texts count as empty, and null ids as one more id. Other columns of docs
    aren't read. The same rows give the same shards and slots under any partitioning; which of two equal rows gets which can't
    be told. An empty table gives an empty one. Another shard takes its part of the ring from the others, and beyond that only keys that
    overflow otherwise than before move.
    """
    spark, cells = docs.sparkSession, ring(shards, nodes)
    rest = written(ring_keys(docs, cells, size, seed, text), "ring")
    total, count = rest.agg(F.coalesce(F.sum("_size"), F.lit(0)), F.count("*")).first()
    capacity = -(-total // shards) + int(total * slack / shards)
    loads, full, placed = dict.fromkeys(range(shards), 0), frozenset(), None
    while placed is None or sum(loads.values()) < total:
        here = rest.join(F.broadcast(_ring_table(spark, passing(cells, full))), "_cell")  # bounded by the ring's cells
        over = _thresholds(here, {s: capacity - n for s, n in loads.items() if s not in full})
        limits = F.broadcast(_literal(spark, [(s, b, d) for s, (b, d) in sorted(over.items())], "_shard int, _last int, _last_draw bigint"))  # a row for each shard
        stays = F.col("_last").isNull() | (F.col("_bucket") < F.col("_last")) | ((F.col("_bucket") == F.col("_last")) & (F.col("_draw") <= F.col("_last_draw")))
        told = here.join(limits, "_shard", "left").withColumn("_stays", stays).drop("_last", "_last_draw")
        taken = told.filter("_stays").drop("_stays")
        placed = taken if placed is None else placed.unionByName(taken)
        if not over:
            break
        for r in taken.groupBy("_shard").agg(F.sum("_size").alias("n")).collect():  # a row for each shard
            loads[r["_shard"]] += r["n"]
        full |= frozenset(over)
        rest = written(told.filter("NOT _stays").drop("_stays", "_shard"), "overflow")
    return _slots(placed, count, shards)


def _slots(placed: DataFrame, count: int, shards: int) -> DataFrame:
    """Numbers each shard's rows from 0, in hash order: buckets of about SLOT_ROWS rows, and within them."""
    buckets = 1 << max(0, (count // (shards * SLOT_ROWS)).bit_length())
    rows = placed.withColumn("_part", F.pmod("_draw", F.lit(buckets)))
    sums = rows.groupBy("_shard", "_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("_shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sums.select("_shard", "_part", before.alias("_before"))
    inside = rows.withColumn("_at", F.row_number().over(Window.partitionBy("_shard", "_part").orderBy("_draw", "_row")))
    return inside.join(starts, ["_shard", "_part"]).select("doc_id", F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), F.col("_shard").alias("shard"), (F.col("_before") + F.col("_at") - 1).cast("long").alias("slot"))
