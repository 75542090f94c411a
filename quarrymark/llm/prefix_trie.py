"""The prefix trie of conversations, by smallest-member ownership.

A node is a distinct sequence of first turns; its members are the conversations that start with it, and the smallest of them owns
it. A conversation's owned nodes are the end of its path: what a smaller conversation shares with it is a prefix. So the trie is
never built: a row for each conversation and depth has the key of its prefix, one group-by finds owners, each conversation learns the
depth from which it owns, and one further group-by over prefixes sums, for each member, what its turns from there on hold less what
it owns of them, and whether it owns a leaf.

Keys are 128 bits: the exclusive or of hashes of (depth, turn), so they are running values that can be made piece by piece.
Turns of a conversation are numbered and scanned in pieces whose partial results are put together, so a very long conversation isn't one
task; group-bys combine before their shuffle, so neither is a node with very many members. Its list of conversations that end there is hashed
as it streams by, in pieces: a SHA-256 can't be put together from parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import whole_ids, written

#: Turns of a conversation that are scanned together, and width of the id ranges whose lists are strings.
BLOCK, RANGE = 1024, 1 << 14
KEY = ["k1", "k2"]


def ordered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), turn_key (16 bytes), size (code points of the text) of turns (conv_id, turn, role, text), by turn with null first.

    Null role or text is empty. Turns of equal numbers are ordered by the md5 of role, then of text, so that equal ones
    are interchangeable and repeated rows stay. Rows without a conv_id belong to no conversation. Other columns aren't read.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = turns.select(whole_ids(turns, "conv_id").alias("conv_id"), "turn", F.md5(role).alias("r"), F.md5(text).alias("x"), F.char_length(text).cast("long").alias("size"), F.monotonically_increasing_id().alias("row")).filter("conv_id IS NOT NULL")
    # Sorted as one table, so that a long conversation is dealt over tasks; places are counted in each and put together.
    sort = ["conv_id", "turn", "r", "x", "row"]
    placed = written(rows.repartitionByRange(*sort).sortWithinPartitions(*sort).select("conv_id", F.unhex(F.md5(F.concat("r", "x"))).alias("turn_key"), "size", F.monotonically_increasing_id().alias("at")), "turns")
    placed = placed.withColumn("part", F.shiftright("at", 33))
    runs = placed.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select("conv_id", "part", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return placed.join(starts, ["conv_id", "part"]).select("conv_id", (F.col("before") + F.col("at") - F.col("first")).alias("pos"), "turn_key", "size")


def shared_starts(rows: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, pos, turn_key, size) rebuilt so that conversations share beginnings, and all conv_ids.

    Conversation c gets the first h turns of c - c % every, all if there are fewer and none if that one is absent, and then its own turns after its
    first h; h is crc32 of c's decimal digits, modulo `most`. A conversation may be left without turns.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    ids = written(rows.groupBy("conv_id").agg(F.count("*").alias("n")), "conversations")
    base = rows.filter(F.col("pos") < most - 1).join(ids.filter(F.col("conv_id") % every == 0).select("conv_id"), "conv_id", "left_semi").withColumnRenamed("conv_id", "base")
    wanted = ids.select("conv_id", (F.col("conv_id") - F.col("conv_id") % every).alias("base"), h.alias("h"))
    given = wanted.join(base, "base").filter("pos < h").select("conv_id", "pos", "turn_key", "size")  # a base has no more than 2 * every heirs
    own = rows.filter(F.col("pos") >= h)
    lengths = ids.select(F.col("conv_id").alias("base"), F.col("n"))
    short = wanted.join(lengths, "base", "left").select("conv_id", (F.col("h") - F.least(F.coalesce("n", F.lit(0)), "h")).alias("gap")).filter("gap > 0")
    own = own.join(short, "conv_id", "left").select("conv_id", (F.col("pos") - F.coalesce("gap", F.lit(0))).alias("pos"), "turn_key", "size")
    return given.unionByName(own), ids.select("conv_id")


def paths(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """A row for each conversation and depth from 0: the prefix's key (k1, k2), its parent's (p1, p2), the sizes of its turns together (run) and
    of its last (size), and of the conversation its length (n_turns) and total size (total)."""
    hashed = [F.xxhash64(F.lit(i), "pos", "turn_key") for i in (0, 1)]
    block = rows.select("conv_id", (F.col("pos") + 1).alias("depth"), "size", hashed[0].alias("e1"), hashed[1].alias("e2"), F.floor(F.col("pos") / BLOCK).alias("block"))
    within = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    local = block.select("*", F.bit_xor("e1").over(within).alias("x1"), F.bit_xor("e2").over(within).alias("x2"), F.sum("size").over(within).alias("s"))
    sums = block.groupBy("conv_id", "block").agg(F.bit_xor("e1").alias("b1"), F.bit_xor("e2").alias("b2"), F.sum("size").alias("b"), F.max("depth").alias("last"))
    w = Window.partitionBy("conv_id")
    earlier = w.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    before = sums.select("conv_id", "block", F.coalesce(F.bit_xor("b1").over(earlier), zero).alias("b1"), F.coalesce(F.bit_xor("b2").over(earlier), zero).alias("b2"), F.coalesce(F.sum("b").over(earlier), zero).alias("b"), F.max("last").over(w).alias("n_turns"), F.sum("b").over(w).alias("total"))
    x1, x2 = F.col("x1").bitwiseXOR(F.col("b1")), F.col("x2").bitwiseXOR(F.col("b2"))
    turns = local.join(before, ["conv_id", "block"]).select("conv_id", "depth", x1.alias("k1"), x2.alias("k2"), x1.bitwiseXOR(F.col("e1")).alias("p1"), x2.bitwiseXOR(F.col("e2")).alias("p2"), "size", (F.col("s") + F.col("b")).alias("run"), "n_turns", "total")
    totals = sums.groupBy("conv_id").agg(F.max("last").alias("n_turns"), F.sum("b").alias("total"))
    none = F.lit(None).cast("long")
    roots = ids.join(totals, "conv_id", "left").select("conv_id", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), none.alias("p1"), none.alias("p2"), zero.alias("size"), zero.alias("run"), F.coalesce("n_turns", zero).alias("n_turns"), F.coalesce("total", zero).alias("total"))
    return turns.unionByName(roots)


def _hash_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's pieces, which come in order; only one digest is open at a time."""
    kind = pa.schema([("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())])
    now, digest = None, hashlib.sha256()
    for batch in batches:
        done = []
        for depth, k1, k2, ids in zip(*(batch[c].to_pylist() for c in ("depth", "k1", "k2", "ids")), strict=True):
            if now != (depth, k1, k2):
                if now is not None:
                    done.append((*now, digest.hexdigest()))
                now, digest = (depth, k1, k2), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), kind, strict=True)], schema=kind)
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*now, digest.hexdigest()), kind, strict=True)], schema=kind)


def end_lists(rows: DataFrame) -> DataFrame:
    """Of each prefix at which conversations end, the SHA-256 of their ids, ascending and with commas between (depth, k1, k2, ends_sha256)."""
    ends = rows.filter("depth = n_turns").select("depth", *KEY, "conv_id", F.floor(F.col("conv_id") / RANGE).alias("piece"))
    pieces = ends.groupBy("depth", *KEY, "piece").agg(F.array_join(F.array_sort(F.collect_list("conv_id")), ",").alias("ids"))  # at most RANGE ids
    return pieces.repartition("depth", *KEY).sortWithinPartitions("depth", *KEY, "piece").mapInArrow(_hash_lists, "depth long, k1 long, k2 long, ends_sha256 string")


def prefix_trie(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """A row for each node of the trie of turns (conv_id, pos, turn_key, size), pos from 0 without gaps; ids (conv_id) names each conversation once,
    those without turns too.

    conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs (members), n_children, n_leaves (childless nodes in the
    subtree, its top included), saved_tokens (over the subtree, each node's members but one times its last turn's size), ends_sha256 (of the
    members that end there; of no text if none do), and the keys k1, k2. Without conversations there are no nodes.
    """
    path = written(paths(rows, ids), "paths")
    nodes = written(path.groupBy("depth", *KEY).agg(F.min("conv_id").alias("owner"), F.max("n_turns").alias("longest"), F.first("run").alias("run"), F.first("size").alias("size")), "nodes")
    owners = nodes.groupBy(F.col("owner").alias("conv_id")).agg(F.min("depth").alias("owns_from"), F.min(F.col("run") - F.col("size")).alias("ahead"), F.max((F.col("longest") == F.col("depth")).cast("long")).alias("leaf"))
    own = path.join(owners, "conv_id", "left")  # a long conversation's rows are one key; AQE may split it, as nothing after needs it whole
    # turns from depth on, less the owned ones among them: those before the first owned one
    saved = F.greatest(F.coalesce("ahead", "total") - (F.col("run") - F.col("size")), F.lit(0).cast("long"))
    child = ((F.col("depth") < F.col("n_turns")) & (F.col("owns_from") <= F.col("depth") + 1)).cast("long")
    parts = own.select("depth", *KEY, "p1", "p2", "conv_id", F.lit(1).cast("long").alias("n"), F.coalesce(child, F.lit(0).cast("long")).alias("child"), F.coalesce("leaf", F.lit(0).cast("long")).alias("leaf"), saved.alias("saved"), F.lit(None).cast("string").alias("ends_sha256"))
    none = F.lit(None).cast("long")
    ends = end_lists(path).select("depth", *KEY, *(none.alias(c) for c in ("p1", "p2", "conv_id", "n", "child", "leaf", "saved")), "ends_sha256")
    summed = parts.unionByName(ends).groupBy("depth", *KEY).agg(F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs"), F.sum("child").alias("n_children"), F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"), F.max("ends_sha256").alias("ends_sha256"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("owner").alias("parent_conv_id"))
    return summed.join(parents, ["depth", "p1", "p2"], "left").select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"), *KEY)
