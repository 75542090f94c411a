"""Benchmark decontamination by training suffix arrays.

A shard is a slice of about 1 MB of documents. Its words' suffixes are sorted into a suffix array, two words a level,
to the depth of a window; only suffixes that still share a prefix are sorted again. Every test suffix is then found by
binary search, level by level, which gives all locations of each window of a test item and, as chains of them,
the longest verbatim match there: windows that follow each other in both texts are one match. Equal windows are searched as one, and what
their intervals of the suffix array cover is removed or counted. Shards are never larger, need no shuffle, and are thrown away after their search.

Test items reach the executors in blocks of at most BLOCK_BYTES of text, however many there are; each block is one
more pass over the documents, whose matches are written before the next one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as A
from .shared import delete_at_exit, new_path, unused

WINDOW = 10
BLOCK_BYTES = 8 << 20
_HALF = np.uint64(0xFFFFFFFF)
_UP = np.uint64(32)


@dataclass
class Words:
    """Folded words of some texts, one space behind each, with 64-bit hashes, and each text's first word (n + 1)."""

    buf: np.ndarray
    at: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray
    pairs: np.ndarray
    ends: np.ndarray


def folded(data: np.ndarray, offsets: np.ndarray) -> Words:
    data = A.LOWER[data]
    starts, ends, bounds = A.word_bounds(data, offsets, A.FOLDED_WORD)
    at = np.concatenate(([0], np.cumsum(ends - starts + 1)))
    buf = np.full(int(at[-1]), 32, np.uint8)
    keep = np.ones(len(buf), bool)
    keep[at[1:] - 1] = False
    buf[keep] = data[A.FOLDED_WORD[data]]
    h = A.word_hashes(buf, at[:-1], at[1:])
    high = (h >> _UP) | np.uint64(1)  # never 0, which stands for the end of a text
    after = np.append(high[1:], np.uint64(0)) if len(high) else high
    last = bounds[1:][bounds[1:] > bounds[:-1]] - 1
    after[last] = 0
    return Words(buf, at, bounds, h, (high << _UP) | after, np.repeat(bounds[1:], np.diff(bounds)))


def suffix_array(w: Words, depth: int) -> np.ndarray:
    """All suffixes, sorted by their first `depth` words (by hash); a text's end is less than any word."""
    n = len(w.pairs)
    order = np.argsort(w.pairs, kind="stable")
    first = np.ones(n + 1, bool)
    first[1:n] = w.pairs[order][1:] != w.pairs[order][:-1]
    for shift in range(2, depth, 2):
        open_ = np.flatnonzero(~(first[:-1] & first[1:]))
        if not len(open_):
            break
        group = np.cumsum(first[:-1])[open_]
        key = level(w, order[open_], shift)
        o = np.lexsort((key, group))
        order[open_] = order[open_][o]
        key = key[o]
        first[open_[1:]] |= (key[1:] != key[:-1]) | (group[1:] != group[:-1])
    return order


def level(w: Words, at: np.ndarray, shift: int) -> np.ndarray:
    """The two words that stand `shift` words behind each place; 0 past the text's end."""
    to = at + shift
    ok = to < w.ends[at]
    return np.where(ok, w.pairs[np.where(ok, to, 0)], np.uint64(0))


@dataclass
class Tests:
    """Test suffixes: where each starts among the items' words, how many words must match, and its item."""

    words: Words
    at: np.ndarray
    depth: np.ndarray
    item: np.ndarray
    ids: list[str]


def test_suffixes(ids: list, texts: list, window: int) -> Tests:
    """Every window of `window` words, or a shorter item's whole text."""
    data, offsets = A.text_arrays(pa.array(texts, pa.string()))
    w = folded(data, offsets)
    n = np.diff(w.bounds)
    count = np.where(n >= window, n - window + 1, np.minimum(n, 1))
    return Tests(w, A.ranges(w.bounds[:-1], count), np.repeat(np.minimum(n, window), count), np.repeat(np.arange(len(n)), count), ["" if i is None else str(i) for i in ids])


def _bound(w: Words, order: np.ndarray, lo: np.ndarray, hi: np.ndarray, shift: int, key: np.ndarray, right: bool) -> np.ndarray:
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            return lo
        mid = (lo[open_] + hi[open_]) >> 1
        v = level(w, order[mid], shift)
        less = v <= key[open_] if right else v < key[open_]
        lo[open_[less]] = mid[less] + 1
        hi[open_[~less]] = mid[~less]


@dataclass
class Hits:
    """Occurrences in a shard: first word and number of the window of each; and of the windows, distinct ones, a test suffix each, and all their
    test suffixes, those of window k from starts[k] to starts[k + 1]."""

    place: np.ndarray
    window: np.ndarray
    test: np.ndarray
    suffixes: np.ndarray
    starts: np.ndarray


def _same(left: Words, a: np.ndarray, right: Words, b: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Whether so many words from each place on are equal, on the bytes; a slice at a time."""
    x, y = left.at[a], right.at[b]
    lx, ly = left.at[a + depth] - x, right.at[b + depth] - y
    alike = np.flatnonzero(lx == ly)
    good = np.zeros(len(a), bool)
    for i, j in A.slices(np.concatenate(([0], np.cumsum(lx[alike])))):
        k = alike[i:j]
        equal = left.buf[A.ranges(x[k], lx[k])] == right.buf[A.ranges(y[k], lx[k])]
        good[k] = np.logical_and.reduceat(equal, np.concatenate(([0], np.cumsum(lx[k])[:-1])))
    return good


def search(w: Words, tests: Tests, window: int) -> Hits:
    """Every occurrence of a test window in the shard, checked byte by byte.

    The search gives each test suffix an interval of the suffix array. Equal windows have one interval, which is read once, and intervals of
    unequal windows of one length don't meet: there are no more occurrences than words in the shard for each length, however often
    both sides repeat themselves.
    """
    order = suffix_array(w, window)
    q = np.arange(len(tests.at))
    lo, hi = np.zeros(len(q), np.int64), np.full(len(q), len(order))
    for shift in range(0, window, 2):
        key = level(tests.words, tests.at[q], shift)
        use = tests.depth[q] > shift
        whole = tests.depth[q] > shift + 1
        least = np.where(whole, key, key & ~_HALF)
        most = np.where(whole, key, key | _HALF)
        new_lo, new_hi = lo.copy(), hi.copy()
        new_lo[use] = _bound(w, order, lo[use], hi[use], shift, least[use], False)
        new_hi[use] = _bound(w, order, new_lo[use], hi[use], shift, most[use], True)
        found = new_lo < new_hi
        q, lo, hi = q[found], new_lo[found], new_hi[found]
        if not len(q):
            break
    o = np.lexsort((q, tests.depth[q], hi, lo))
    q, lo, hi = q[o], lo[o], hi[o]
    first = np.ones(len(q), bool)
    first[1:] = (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]) | (tests.depth[q[1:]] != tests.depth[q[:-1]])
    head = q[np.flatnonzero(first)[np.cumsum(first) - 1]] if len(q) else q
    odd = ~_same(tests.words, tests.at[q], tests.words, tests.at[head], tests.depth[q])  # equal hashes of unequal words: windows of their own
    if odd.any():
        o = np.argsort(odd, kind="stable")
        q, lo, hi, first = q[o], lo[o], hi[o], (first | odd)[o]
    starts = np.append(np.flatnonzero(first), len(q))
    k = starts[:-1]
    test, n = q[k], hi[k] - lo[k]
    place, own = order[A.ranges(lo[k], n)], np.repeat(np.arange(len(k)), n)
    depth = tests.depth[test[own]] if len(own) else np.zeros(0, np.int64)
    fits = place + depth <= w.ends[place] if len(place) else np.zeros(0, bool)
    place, own, depth = place[fits], own[fits], depth[fits]
    good = _same(w, place, tests.words, tests.at[test[own]], depth)
    return Hits(place[good], own[good], test, q, starts)


@dataclass
class Leaks:
    """What a shard's texts hold: covered words, and row and item of each item that occurs, both ascending."""

    cover: np.ndarray
    row: np.ndarray
    item: np.ndarray


def leaks(w: Words, tests: Tests, window: int) -> Leaks:
    """Words of any occurrence, and the items of the windows that occur in each text. Neither is larger than the shard's words, or for a text the test
    suffixes."""
    h = search(w, tests, window)
    cover = A.covered(len(w.pairs), h.place, h.place + tests.depth[h.test[h.window]])
    row = np.searchsorted(w.bounds, h.place, "right") - 1
    n = len(h.test)
    pairs = np.unique(row * n + h.window) if n else np.zeros(0, np.int64)
    rows, items = [], []
    for own in np.split(pairs, np.flatnonzero(np.diff(pairs // max(1, n))) + 1) if len(pairs) else []:
        k = own % n
        found = np.unique(tests.item[h.suffixes[A.ranges(h.starts[k], h.starts[k + 1] - h.starts[k])]])
        rows.append(np.full(len(found), own[0] // n))
        items.append(found)
    none = np.zeros(0, np.int64)
    return Leaks(cover, np.concatenate(rows) if rows else none, np.concatenate(items) if items else none)


def shards(texts: pa.Array) -> Iterator[tuple[int, Words]]:
    data, offsets = A.text_arrays(texts)
    for a, b in A.slices(offsets):
        yield a, folded(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])


def blocks(bench: DataFrame, most: int, id_col: str, text_col: str) -> Iterator[tuple[list, list]]:
    """The items in blocks of at most so many bytes; the driver holds one block at a time."""
    ids, texts, size = [], [], 0
    for row in bench.select(F.col(id_col).alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).toLocalIterator():
        if ids and size + len(row.t.encode()) > most:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(row.i)
        texts.append(row.t)
        size += len(row.t.encode())
    yield ids, texts


@dataclass
class Matches:
    """Longest verbatim matches in a shard: row, item, first word of both, and words."""

    row: np.ndarray
    item: np.ndarray
    place: np.ndarray
    test: np.ndarray
    length: np.ndarray


def longest(w: Words, tests: Tests, window: int) -> Matches:
    """Each match of the search, extended to the left and right as far as it is verbatim, in order of rows.

    All windows of an item are searched and checked on the bytes, so a longer match is a chain of windows that follow each other in
    both texts: on one diagonal, each a word on. Texts that repeat themselves match an item that does so on very many of them: this list
    has them all, and so its size isn't bounded by that of the texts; leaks() is.
    """
    h = search(w, tests, window)
    n = h.starts[h.window + 1] - h.starts[h.window]
    query, place = h.suffixes[A.ranges(h.starts[h.window], n)], np.repeat(h.place, n)
    at = tests.at[query]
    o = np.lexsort((place, place - at))
    query, place, at = query[o], place[o], at[o]
    first = np.ones(len(o), bool)
    own = np.searchsorted(w.bounds, place, "right")
    first[1:] = (place[1:] != place[:-1] + 1) | (at[1:] != at[:-1] + 1) | (own[1:] != own[:-1]) | (tests.item[query[1:]] != tests.item[query[:-1]])
    k = np.flatnonzero(first)
    last = np.append(k[1:], len(o)) - 1
    found = Matches(own[k] - 1, tests.item[query[k]], place[k], at[k], place[last] + tests.depth[query[last]] - place[k]) if len(k) else Matches(*[np.zeros(0, np.int64)] * 5)
    o = np.argsort(found.row, kind="stable")
    return Matches(*(x[o] for x in (found.row, found.item, found.place, found.test, found.length)))


def find_leaks(docs: DataFrame, bench: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, keep_rows: bool = False) -> DataFrame:
    """Which words of each document stand in a window of a benchmark item.

    docs: doc_id, text; bench: item_id, text. An item with fewer words than a window, but not none, is one window. A row
    out for each row in: doc_id, n_words, n_hit, n_items (distinct ids of items with occurring windows), items_sha256,
    contaminated. Null and empty texts have no words; an item without an id has the empty id. Repeated rows and ids are
    judged one by one. With keep_rows=True, instead, the rows of docs that aren't contaminated, with all their columns.
    """
    parts = blocks(bench, block_bytes, "item_id", "text")
    ids, texts = next(parts)
    if next(parts, None) is None:
        tests = test_suffixes(ids, texts, window)
        if keep_rows:
            return docs.mapInArrow(A.tidy(_keeper(tests, window)), docs.schema)
        return docs.select("doc_id", "text").mapInArrow(A.tidy(_judge(tests, window)), "doc_id " + dict(docs.dtypes)["doc_id"] + ", n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")
    return _in_blocks(docs, bench, window, block_bytes, keep_rows)


def _keeper(tests: Tests, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = np.ones(len(batch), bool)
            for a, w in shards(batch["text"]):
                clean[a + leaks(w, tests, window).row] = False
            yield batch.filter(pa.array(clean))

    return run


def _digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def _judge(tests: Tests, window: int):
    none = _digest([])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_hit, n_items, digests = [], np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64), [none] * len(batch)
            for a, w in shards(batch["text"]):
                n_words.append(np.diff(w.bounds))
                m = leaks(w, tests, window)
                cover = np.concatenate(([0], np.cumsum(m.cover)))
                n_hit[a : a + len(w.bounds) - 1] = np.diff(cover[w.bounds])
                cuts = np.append(np.flatnonzero(np.concatenate(([True], m.row[1:] != m.row[:-1]))), len(m.row)) if len(m.row) else np.zeros(1, np.int64)
                for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                    r, own = m.row[x], {tests.ids[i] for i in m.item[x:y]}
                    n_items[a + r], digests[a + r] = len(own), _digest(list(own))
            words = np.concatenate(n_words) if n_words else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(words, pa.int64()), pa.array(n_hit), pa.array(n_items), pa.array(digests, pa.string()), pa.array(n_hit > 0)], ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return run


def longest_matches(docs: DataFrame, bench: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row for each longest verbatim match of a window's words at least (a shorter item's: all of it).

    item_id (string), item_word, doc_id, doc_word, n_words (of the match); word numbers from 0. Repeated rows and ids give repeated
    matches.
    """
    kind = dict(docs.dtypes)["doc_id"]
    return _in_passes(docs.select("doc_id", "text"), bench, window, block_bytes, "doc_id", kind)


MATCH = "item_id string, item_word long, {} {}, doc_word long, n_words long"


def _matcher(tests: Tests, window: int, key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, w in shards(batch["text"]):
                m = longest(w, tests, window)
                names = pa.array([tests.ids[i] for i in m.item], pa.string())
                yield pa.RecordBatch.from_arrays([names, pa.array(m.test - tests.words.bounds[m.item]), batch[key].take(pa.array(a + m.row)), pa.array(m.place - w.bounds[m.row]), pa.array(m.length)], ["item_id", "item_word", key, "doc_word", "n_words"])

    return run


def _marker(tests: Tests, window: int, key: str):
    """As _matcher(), but for each text its covered stretches, which have no item, and its items, which have no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, w in shards(batch["text"]):
                m = leaks(w, tests, window)
                edge = m.cover.copy()
                edge[1:] &= ~m.cover[:-1] | np.isin(np.arange(1, len(edge)), w.bounds)
                first = np.flatnonzero(edge)
                upto = np.append(first[1:], len(edge))
                sums = np.concatenate(([0], np.cumsum(m.cover)))
                size = sums[upto] - sums[first]
                row = np.searchsorted(w.bounds, first, "right") - 1
                names = pa.array([None] * len(first) + [tests.ids[i] for i in m.item], pa.string())
                zeros = np.zeros(len(m.item), np.int64)
                at = np.concatenate((first - w.bounds[row], zeros))
                yield pa.RecordBatch.from_arrays([names, pa.array(np.zeros(len(names), np.int64)), batch[key].take(pa.array(a + np.concatenate((row, m.row)))), pa.array(at), pa.array(np.concatenate((size, zeros)))], ["item_id", "item_word", key, "doc_word", "n_words"])

    return run


def _in_passes(rows: DataFrame, bench: DataFrame, window: int, block_bytes: int, key: str, kind: str, by=_matcher) -> DataFrame:
    """What `by` finds of all items. With more than one block, each block's pass over rows (key, text) is written before the next
    one begins: the driver holds one block, and neither it nor the plan grows with the items."""
    columns = MATCH.format(key, kind)
    parts = blocks(bench, block_bytes, "item_id", "text")
    found = (rows.mapInArrow(A.tidy(by(test_suffixes(ids, texts, window), window, key)), columns) for ids, texts in parts)
    one = next(found)
    two = next(found, None)
    if two is None:
        return one
    path = new_path(rows.sparkSession, "matches")
    for part in (one, two):
        part.write.mode("append").parquet(path)
    for part in found:
        part.write.mode("append").parquet(path)
    delete_at_exit(rows.sparkSession, path)
    return rows.sparkSession.read.schema(columns).parquet(path)


def _in_blocks(docs: DataFrame, bench: DataFrame, window: int, block_bytes: int, keep_rows: bool) -> DataFrame:
    """More than one block: matches of all passes meet by the row's own key; only rows with matches are sent."""
    name = unused(docs, "row")
    known = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    key = F.sha2(F.concat(F.when(F.col("doc_id").isNull(), "-").otherwise(F.length(known).cast("string")), F.lit(":"), known, F.coalesce("text", F.lit(""))), 256)
    rows = docs.withColumn(name, key)
    found = _in_passes(rows.select(F.col(name).alias("row"), "text"), bench, window, block_bytes, "row", "string", _marker).select("row", "item_id", "doc_word", "n_words").distinct()

    def merge(table: pa.Table) -> pa.Table:
        a = table["doc_word"].to_numpy()
        b = a + table["n_words"].to_numpy()
        own = set(table["item_id"].to_pylist()) - {None}
        return pa.table({"row": table["row"].slice(0, 1), "n_hit": pa.array([int(A.covered(int(b.max()), a, b).sum())]), "n_items": pa.array([len(own)]), "items_sha256": pa.array([_digest(list(own))])})

    merged = found.groupBy("row").applyInArrow(merge, "row string, n_hit long, n_items long, items_sha256 string")
    if keep_rows:
        return rows.join(merged.select(F.col("row").alias(name)), name, "left_anti").select(*docs.columns)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [np.diff(w.bounds) for _, w in shards(batch["text"])]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["row"], pa.array(np.concatenate(n) if n else np.zeros(0, np.int64), pa.int64())], ["doc_id", "row", "n_words"])

    counted = rows.select("doc_id", F.col(name).alias("row"), "text").mapInArrow(A.tidy(count), f"doc_id {dict(docs.dtypes)['doc_id']}, row string, n_words long")
    zero = F.lit(0).cast("long")
    return counted.join(merged, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"),
        F.coalesce("items_sha256", F.lit(_digest([]))).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"),
    )
