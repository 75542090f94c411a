"""N-gram Jaccard join: a MinHash LSH forest, with exact verification.

Texts with equal sets of word shingles are one node from the start. A node's MinHash values are dealt to trees, where they are
its label, and a tree's labels make a prefix trie: nodes that share the first d values stand below one trie node, which the hash of the
path names. Every node asks each trie from its full depth upwards: its matched prefix is shortened until the recall expected of
the least similar set that its own size still allows reaches the target. A set of three shingles has none but equal ones and
asks nothing; others stop at different depths, and from some size on the threshold itself decides. A trie node is kept where a node
asks for it, as the table of those below it; what stands below is linked to the least asking one, never as pairs.

Linked nodes form components, whose shingle sets meet in one task (or, beyond SET_LIMIT shingles, in one task for each pair of blocks).
There, candidates are those pairs that share a trie node, and only they are compared, shingle by shingle, and counted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import arrays as A
from .shared import partitions, salted_join, unused, whole_ids, written

SHINGLE, THRESHOLD = 5, 0.8
TREES, DEPTH, RECALL = 49, 12, 0.99999
#: Sets up to this size have depths of their own.
SIZES = 64
#: Shingles of a component that are compared in one task.
SET_LIMIT = 4_000_000
#: Components of so many shingles are never split.
SMALL_SETS = 20_000
#: Edges that a task of components() handles; small graphs need few tasks.
EDGES_PER_TASK = 100_000
_TOP = 2**63 - 1
_SEED = np.random.default_rng(77).integers(1, 2**63, (2, 1024), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def least_similarity(n: int, ratio: Fraction) -> Fraction | None:
    """The least similarity of `ratio` or more that a set of n elements can have with another one; None: only equal sets have it."""
    found = [Fraction(i, u) for i in range(1, n + 1) if (u := i * ratio.denominator // ratio.numerator) >= n and u > i]
    return min(found, default=None)


def matched_depth(similarity: float, trees: int, depth: int, target: float) -> int:
    """Shorten the prefix, from full depth, until the expected recall at a similarity reaches the target."""
    while depth > 1 and 1 - (1 - similarity**depth) ** trees < target:
        depth -= 1
    return depth


def depths(ratio: Fraction, trees: int, depth: int, target: float) -> tuple[np.ndarray, list[set[int]]]:
    """By size, up to twice SIZES: the depth at which a set asks (0: never), and all depths at which sets of like sizes do."""
    base = matched_depth(float(ratio), trees, depth, target)
    asks = np.full(2 * SIZES + 1, base)
    for n in range(SIZES + 1):
        least = least_similarity(n, ratio)
        asks[n] = 0 if least is None else matched_depth(float(least), trees, depth, target)
    near = [{int(asks[m]) for m in range(len(asks)) if m and n and min(m, n) >= ratio * max(m, n) and asks[m]} for n in range(len(asks))]
    return asks, near


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles, ascending, and their bounds; a text of fewer than n words, but not none, is one shingle."""
    starts, ends, bounds = A.word_bounds(data, offsets)
    words = A.word_hashes(data, starts, ends)
    count = np.diff(bounds)
    grams = A.gram_hash(words, n)
    long = count >= n
    at = A.ranges(bounds[:-1][long], count[long] - n + 1)
    doc = np.repeat(np.flatnonzero(long), count[long] - n + 1)
    values = grams[at]
    few = np.flatnonzero((count > 0) & ~long)
    if len(few):
        own = [A.gram_hash(words[bounds[i] : bounds[i + 1]], int(count[i]))[0] ^ np.uint64(count[i]) for i in few]
        values, doc = np.concatenate((values, np.array(own, np.uint64))), np.concatenate((doc, few))
    o = np.lexsort((values, doc))
    values, doc = values[o], doc[o]
    keep = np.ones(len(doc), bool)
    keep[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
    return values[keep], np.searchsorted(doc[keep], np.arange(len(count) + 1))


def set_ids(values: np.ndarray, bounds: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit id of each set; 0 is the empty one."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(A.mix(values ^ np.uint64(0x51ED27 + salt)))))
    out = A.mix((sums[bounds[1:]] - sums[bounds[:-1]]) ^ np.diff(bounds).astype(np.uint64))
    return np.where(np.diff(bounds) > 0, np.maximum(out, np.uint64(1)), np.uint64(0)).view(np.int64)


def signatures(values: np.ndarray, bounds: np.ndarray, size: int, start: int = 0) -> np.ndarray:
    """So many MinHashes, a row for each set that isn't empty."""
    first = bounds[:-1][np.diff(bounds) > 0]
    out = np.zeros((len(first), size), np.uint32)
    for k in range(size if len(first) else 0):
        out[:, k] = np.minimum.reduceat((values * _SEED[0, start + k] + _SEED[1, start + k]) >> np.uint64(32), first)
    return out


def trie_nodes(values: np.ndarray, bounds: np.ndarray, trees: int, asks: np.ndarray, near: list[set[int]]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each set that isn't empty, the trie nodes it asks, and those above it that only others ask."""
    sizes = np.minimum(np.diff(bounds)[np.diff(bounds) > 0], len(asks) - 1)
    asked: list[np.ndarray] = [np.zeros(0, np.int64)] * len(sizes)
    others: list[np.ndarray] = [np.zeros(0, np.int64)] * len(sizes)
    own = np.flatnonzero([bool(near[n]) for n in range(len(near))])
    at = np.flatnonzero(np.isin(sizes, own))
    path = np.tile(A.mix(np.arange(1, trees + 1, dtype=np.uint64)), (len(at), 1))
    nonempty = np.flatnonzero(np.diff(bounds) > 0)
    whole, depth = len(at) == len(sizes), 0
    while len(at):
        if whole:
            v, b = values, bounds
        else:
            start, n = bounds[nonempty[at]], np.diff(bounds)[nonempty[at]]
            v, b = values[A.ranges(start, n)], np.concatenate(([0], np.cumsum(n)))
        path = A.mix(path + signatures(v, b, trees, depth * trees) + np.uint64(1))
        depth += 1
        keys = path.view(np.int64)
        for k in np.flatnonzero(asks[sizes[at]] == depth):
            asked[at[k]] = keys[k]
        for n in own:
            if depth in near[n] and asks[n] != depth:
                for k in np.flatnonzero(sizes[at] == n):
                    others[at[k]] = np.concatenate((others[at[k]], keys[k]))
        on = np.array([max(s, default=0) > depth for s in near])[sizes[at]]
        whole = whole and on.all()
        at, path = at[on], path[on]
    return asked, others


def _lists(arrays: list[np.ndarray], empty: np.ndarray) -> pa.Array:
    """A list for each row; rows that are empty have none."""
    lens = np.zeros(len(empty) + 1, np.int64)
    lens[1:][~empty] = [len(x) for x in arrays]
    return pa.ListArray.from_arrays(pa.array(np.cumsum(lens).astype(np.int32)), pa.array(np.concatenate([np.zeros(0, np.int64), *arrays])))


def _sketches(batches: Iterator[pa.RecordBatch], n: int, trees: int, asks: np.ndarray, near: list[set[int]]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = A.text_arrays(batch["text"])
        for a, b in A.slices(offsets):
            values, bounds = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], n)
            ids, sizes = set_ids(values, bounds), np.diff(bounds)
            asked, others = trie_nodes(values, bounds, trees, asks, near)
            own = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays([own["id"], own["at"], own["whole"], pa.array(ids), pa.array(sizes.astype(np.int64)), _lists(asked, sizes == 0), _lists(others, sizes == 0)], ["id", "at", "whole", "node", "n", "asked", "others"])


def components(edges: DataFrame) -> DataFrame:
    """node and comp (its component's least node), for all nodes of edges (u, v): alternating large and small stars.

    Each half round is a grouped minimum and a join, written in the shared folder by as many tasks as the edges need; a
    hub's neighbours are dealt by Spark's skew join. Rounds go on until the edges no longer change, which takes about the logarithm of the diameter.
    """
    edges = written(edges.filter("u <> v").select(F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u")).distinct(), "edges")
    tasks, mark = edges.count() // EDGES_PER_TASK + 1, None
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least", tasks)
        edges = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        edges = written(edges, "large", tasks)
        least = written(edges.groupBy("u").agg(F.min("v").alias("m")), "least", tasks)
        joined = edges.join(least, "u")
        edges = written(joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "small", tasks)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == mark:
            break
        mark = now
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("comp")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def postings(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Values numbered: each list's numbers and where lists begin in them (n + 1), lists by number, and its first and count for each."""
    sizes = np.array([len(x) for x in lists], np.int64)
    owner = np.repeat(np.arange(len(lists)), sizes)
    _, number, per = np.unique(np.concatenate([np.zeros(0, np.uint64), *lists]), return_inverse=True, return_counts=True)
    return number, np.concatenate(([0], np.cumsum(sizes))), owner[np.argsort(number, kind="stable")], np.cumsum(per) - per, per


def compare(sets: list[np.ndarray], keys: list[np.ndarray], left: int, whole: bool, copies: np.ndarray, ratio: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """Exact links of each set (weighed by copies) and a group label, the least linked place.

    The first `left` sets are compared with the others; with whole, all with all: but only those that share a trie node, each
    pair once. No pair is kept.
    """
    m = len(sets)
    shingle, cut, _, _, per = postings(sets)
    sizes = np.diff(cut)
    trie, trie_cut, below, first, count = postings([k.view(np.uint64) for k in keys])
    mark, parent, links = np.zeros(len(per), bool), np.arange(m), np.zeros(m, np.int64)

    def roots(x: np.ndarray) -> np.ndarray:
        up = parent[x]
        while (up != parent[up]).any():
            up = parent[up]
        return up

    for i in range(m if whole else left):
        k = trie[trie_cut[i] : trie_cut[i + 1]]
        k = k[count[k] > 1]
        near = np.unique(below[A.ranges(first[k], count[k])])
        near = near[near > i] if whole else near[near >= left]
        near = near[np.minimum(sizes[near], sizes[i]) * ratio.denominator >= ratio.numerator * np.maximum(sizes[near], sizes[i])]
        if not len(near):
            continue
        own = shingle[cut[i] : cut[i + 1]]
        mark[own] = True
        shared = np.add.reduceat(mark[shingle[A.ranges(cut[near], sizes[near])]], np.cumsum(sizes[near]) - sizes[near], dtype=np.int64)
        mark[own] = False
        near = near[shared * (ratio.denominator + ratio.numerator) >= ratio.numerator * (sizes[i] + sizes[near])]
        links[i] += copies[near].sum()
        links[near] += copies[i]
        both = roots(np.append(near, i))
        parent[both] = both.min()
    return links, roots(np.arange(m))


def similar_documents(docs: DataFrame, n: int = SHINGLE, threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, target: float = RECALL, set_limit: int = SET_LIMIT) -> DataFrame:
    """Classes of docs (doc_id, text) linked by a Jaccard similarity of their shingle sets of `threshold` or more.

    A row out for each row in: doc_id, class_id (the least doc_id that it is linked to over any number of links) and n_links
    (rows similar to it, copies counted). Ids are whole numbers, and anything else is an error. Words are [^\\x20\\x09-\\x0D]+,
    unchanged. Texts with equal sets are similar; null texts and those without words are similar to nothing, and their own class.
    Rows without an id come after all others and give no class their id. Repeated rows are copies. Shingles and equal sets are
    told by 64-bit hashes: among 10^10 different sets a few may be taken for equal ones. Each pair of the threshold or more is a
    candidate with the probability `target` at least, and what is counted is exact.
    """
    found = _classes(docs, n, threshold, trees, depth, target, set_limit)
    plain = lambda c: F.nullif(c, F.lit(_TOP))
    kind = dict(docs.dtypes)["doc_id"]
    return found.select(plain(F.col("id")).cast(kind).alias("doc_id"), plain(F.coalesce("class", F.col("id"))).cast(kind).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def _row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def _whole(docs: DataFrame) -> Column:
    return F.xxhash64(*(F.col(f"`{f.name}`") for f in docs.schema if not re.search("map<|variant", f.dataType.simpleString())))


def _rows(docs: DataFrame) -> DataFrame:
    """id, text, at (a hash of both, which also tells rows without an id apart) and whole (a hash of all columns that can be hashed)."""
    return docs.select(F.coalesce(whole_ids(docs), F.lit(_TOP)).alias("id"), F.coalesce("text", F.lit("")).alias("text"), _row_key().alias("at"), _whole(docs).alias("whole"))


def _classes(docs: DataFrame, n: int, threshold: float, trees: int, depth: int, target: float, set_limit: int) -> DataFrame:
    """id, at, whole, node (null without words), class, n_links of each row."""
    spark = docs.sparkSession
    ratio = Fraction(threshold).limit_denominator(10_000)
    asks, near = depths(ratio, trees, min(depth, _SEED.shape[1] // trees), target)
    rows = _rows(docs)
    sketched = written(rows.mapInArrow(A.tidy(lambda it: _sketches(it, n, trees, asks, near)), "id long, at long, whole long, node long, n long, asked array<long>, others array<long>"), "sketches")
    some = sketched.filter("n > 0")
    nodes = some.groupBy("node").agg(F.min(F.struct("id", "at")).alias("first"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("asked").alias("asked"), F.first("others").alias("others"))
    nodes = written(nodes.select("node", F.col("first.id").alias("rep"), F.col("first.at").alias("at"), "copies", "n", "asked", "others"), "nodes")
    below = nodes.select("node", F.explode("asked").alias("key"), F.lit(True).alias("asks")).unionByName(nodes.select("node", F.explode("others").alias("key"), F.lit(False).alias("asks")))
    tries = written(below.groupBy("key").agg(F.min(F.when(F.col("asks"), F.col("node"))).alias("least"), F.count("*").alias("n")).filter("n > 1 AND least IS NOT NULL").drop("n"), "tries")
    comps = written(components(below.join(tries, "key").select(F.col("node").alias("u"), F.col("least").alias("v"))), "components")
    members = nodes.join(comps, "node").withColumn("keys", F.concat("asked", "others")).drop("asked", "others")
    sizes = members.groupBy("comp").agg(F.sum("n").alias("total"))
    # A component that is more than one partition's share is split, too: b blocks make b (b + 1) / 2 tasks.
    parts = partitions(spark)
    whole = int(members.agg(F.sum("n")).first()[0] or 0)
    blocks = F.greatest(F.ceil(F.col("total") / F.lit(set_limit / 2)), F.ceil(F.sqrt(F.col("total") * F.lit(2.0 * parts / max(1, whole))))).cast("int")
    alone = F.col("total") <= F.lit(min(set_limit, max(SMALL_SETS, whole // parts)))
    dealt = written(salted_join(members, sizes.select("comp", F.when(alone, 1).otherwise(blocks).alias("blocks")), "comp", F.col("node"), 2 * parts), "members")
    # The text of each node's least document, dealt by the hash of the row; repeated rows stand side by side, and one is taken.
    # Texts are always dealt so, also where Spark could broadcast: the plan, and its shuffle, is the same at any size.
    texts = rows.select("at", "text").join(dealt.hint("merge"), "at")
    names = ["node", "rep", "copies", "comp", "blocks", "keys"]

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = None
        for batch in batches:
            at = batch["node"].to_numpy()
            fresh = np.ones(len(at), bool)
            fresh[1:] = at[1:] != at[:-1]
            if len(at):
                fresh[0], seen = at[0] != seen, at[-1]
            batch = batch.filter(pa.array(fresh))
            data, offsets = A.text_arrays(batch["text"])
            for a, b in A.slices(offsets):
                values, bounds = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], n)
                own = batch.slice(a, b - a)
                keep = pa.array(set_ids(values, bounds) == own["node"].to_numpy())
                blobs = pa.array([values[i:j].tobytes() for i, j in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([*(own[c] for c in names), blobs], [*names, "shingles"]).filter(keep)

    loaded = texts.mapInArrow(A.tidy(sets), "node long, rep long, copies long, comp long, blocks int, keys array<long>, shingles binary")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.struct(F.least(own, b).alias("x"), F.greatest(own, b).alias("y")))
    tasks = loaded.withColumn("block", own).withColumn("pair", F.explode(pairs)).select("*", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("comp"), F.lit(16 * partitions(spark)))).otherwise(F.xxhash64("comp", "pair.x", "pair.y")).alias("task"), F.col("pair.x").alias("x"), F.col("pair.y").alias("y"))

    def verify(table: pa.Table) -> pa.Table:
        out: list[tuple] = []
        col = {c: table[c].to_numpy() for c in ("node", "rep", "copies", "comp", "blocks", "block", "x", "y")}
        order = np.lexsort((col["node"], col["block"], col["y"], col["x"], col["comp"]))
        group = np.stack([col[c][order] for c in ("comp", "x", "y")], 1)
        cuts = np.append(np.flatnonzero(np.concatenate(([True], (group[1:] != group[:-1]).any(1)))), len(order))
        keys = pa.concat_arrays(table["keys"].chunks)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            at = order[a:b]
            fresh = np.ones(len(at), bool)
            fresh[1:] = col["node"][at][1:] != col["node"][at][:-1]  # a repeated row
            at = at[fresh]
            x, y = col["x"][at[0]], col["y"][at[0]]
            values = [np.frombuffer(table["shingles"][int(i)].as_py(), np.uint64) for i in at]
            links, label = compare(values, [keys[int(i)].values.to_numpy() for i in at], int((col["block"][at] == x).sum()), x == y, col["copies"][at], ratio)
            own_copies = col["copies"][at] - 1 if x == y else np.zeros(len(at), np.int64)
            least = np.full(len(at), _TOP)
            np.minimum.at(least, label, col["rep"][at])
            for i, k in enumerate(at):
                out.append((int(col["node"][k]), int(links[i] + own_copies[i]), int(least[label[i]]), int(col["node"][at[label[i]]]), bool(col["blocks"][k] > 1)))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
        return pa.table({c: pa.array([r[i] for r in out], k) for i, (c, k) in enumerate(zip(("node", "links", "class", "root", "split"), kinds, strict=True))})

    verified = written(tasks.groupBy("task").applyInArrow(A.tidy(verify), "node long, links long, class long, root long, split boolean"), "verified")
    classes = verified.filter("NOT split").select("node", "links", "class")
    split = verified.filter("split")
    if not split.isEmpty():  # classes that several tasks saw parts of
        linked = components(split.select(F.col("node").alias("u"), F.col("root").alias("v")))
        counted = split.groupBy("node").agg(F.sum("links").alias("links"))
        placed = counted.join(linked, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        lows = written(placed.join(nodes.select("node", "rep"), "node").groupBy("comp").agg(F.min("rep").alias("class")), "lows")
        classes = classes.unionByName(salted_join(placed, lows, "comp", F.col("node"), 2 * partitions(spark)).select("node", "links", "class"))
    judged = nodes.select("node", "rep", "copies").join(classes, "node", "left").select("node", F.coalesce("class", "rep").alias("class"), F.coalesce("links", F.col("copies") - 1).alias("n_links"))
    return salted_join(sketched.select("id", "at", "whole", F.when(F.col("n") > 0, F.col("node")).alias("node")), judged, "node", F.col("at"), 2 * partitions(spark))


def keep_one(docs: DataFrame, n: int = SHINGLE, threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, target: float = RECALL, set_limit: int = SET_LIMIT) -> DataFrame:
    """The rows of docs, with all their columns, that come first in their class: one of each class of similar_documents().

    Of rows with one id and equal sets the one with the least hashes stays, repeated rows included. Texts without words all stay. A
    class whose rows all have no id keeps one row of each of its sets; so do different sets with one id that is their class's.
    """
    found = _classes(docs, n, threshold, trees, depth, target, set_limit)
    at, whole = unused(docs, "at"), unused(docs, "whole")
    firsts = found.filter("node IS NOT NULL AND id = class").groupBy("id", "node").agg(F.min(F.struct("at", "whole")).alias("w"), F.count("*").alias("n"))
    firsts = written(firsts.select("w.at", F.when(F.col("n") > 1, F.col("w.whole")).alias("whole"), (F.col("n") > 1).alias("repeated")), "firsts")
    empty = found.filter("node IS NULL").select("at", F.lit(None).cast("long").alias("whole"), F.lit(False).alias("repeated")).distinct()
    keyed = docs.select("*", _row_key().alias(at), _whole(docs).alias(whole))
    pick = firsts.unionByName(empty)
    once = keyed.join(pick.filter("NOT repeated").select(F.col("at").alias(at)).hint("merge"), at, "left_semi").select(*docs.columns)
    if firsts.filter("repeated").isEmpty():
        return once
    again = keyed.join(firsts.filter("repeated").select(F.col("at").alias(at), F.col("whole").alias(whole)).hint("merge"), [at, whole], "left_semi")
    return once.unionByName(again.dropDuplicates([at]).select(*docs.columns))
