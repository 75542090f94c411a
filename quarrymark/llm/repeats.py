"""Strings of L symbols that also start in a document with a smaller id: the routing both substring operators share.

Rows are dealt into "blocks" by a hash of their id and text. Every window of L symbols has an anchor: the least hash among
its grams of G symbols, the same wherever the window stands. Then:

1. each block sends the 6-byte codes of its distinct anchors to buckets, which answer with one bit each: is the
   anchor in another document too? (A second bit marks anchors in very many blocks.)
2. Neighbouring windows with the same shared anchor form one segment of text. Each block sends its distinct segments,
   with the least and the greatest document id, to the anchor's bucket. Equal windows thus meet in one bucket; windows
   of very frequent anchors are dealt on by their greatest gram hash, so that no bucket grows with a common phrase. Where
   the segments stand in the block is noted in the same pass and carried along to step 4.
3. The bucket groups equal windows exactly, by the caller's method on the text itself, and sends back, for each
   segment, runs of windows with a smaller id than the block's greatest.
4. Each block marks the covered symbols of its documents, from the notes of step 2; it hashes nothing again.

Codes only choose what is compared: a collision costs time, never a wrong row. No group is larger than a block, or
one entry for each block, and nothing but the total of bytes reaches the driver. A block is always read in the same order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as A
from .shared import partitions, text_bytes, whole_ids

BLOCK_BYTES = 4 << 20
#: An anchor in more blocks than this is dealt on by a second key.
HOT_BLOCKS = 2000
#: Bytes of segments that are grouped at a time in a bucket.
GROUP_BYTES = 1 << 20
_TOP = np.iinfo(np.int64).max
_CODEC = "zstd"
_ROW_BITS = 17


@dataclass(frozen=True)
class Unit:
    """length: symbols in a window, gram: in an anchor; words: the symbols are words, else bytes."""

    length: int
    gram: int
    words: bool
    buckets: int
    hot: int


@dataclass
class Text:
    """A block's text: symbol i is buf[at(i):at(i + 1)] (with the space behind a word); bounds: each row's first symbol (n + 1)."""

    buf: np.ndarray
    sym: np.ndarray | None
    bounds: np.ndarray

    def at(self, symbol: np.ndarray) -> np.ndarray:
        return symbol if self.sym is None else self.sym[symbol]


@dataclass
class Runs:
    """Neighbouring windows with one anchor: first symbol, windows, row, anchor, and hash of the run's text."""

    at: np.ndarray
    n: np.ndarray
    row: np.ndarray
    anchor: np.ndarray
    text: np.ndarray


def normal_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words with one space behind each, where they start in that (n + 1), and each text's first word (n + 1)."""
    starts, ends, bounds = A.word_bounds(data, offsets)
    lens = ends - starts + 1
    sym = np.concatenate(([0], np.cumsum(lens)))
    buf = np.full(int(sym[-1]), 32, np.uint8)
    keep = np.ones(len(buf), bool)
    keep[sym[1:] - 1] = False
    buf[keep] = data[A.PLAIN_WORD[data]]
    return buf, sym, bounds


def ordered(table: pa.Table) -> pa.Table:
    """The rows of a block in an order that only depends on them."""
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def block_text(table: pa.Table, unit: Unit) -> Text:
    data, offsets = A.text_arrays(table["text"])
    return Text(*normal_words(data, offsets)) if unit.words else Text(data, None, offsets)


def _grams(text: Text, a: int, b: int, unit: Unit) -> tuple[np.ndarray, np.ndarray]:
    """Of rows a to b: running hashes of the bytes, and a hash for every gram."""
    first, last = text.bounds[a], text.bounds[b]
    own = text.buf[text.at(first) : text.at(last)]
    sums = A.prefix_hash(own)
    if unit.words:
        sym = text.sym[first : last + 1] - text.sym[first]
        return sums, A.gram_hash(A.range_hash(sums, sym[:-1], sym[1:]), unit.gram)
    return sums, A.even_hash(sums, unit.gram)


def runs_of(text: Text, a: int, b: int, unit: Unit, fine: bool = False) -> Runs:
    """The runs of rows a to b; if fine, a run for each window's pair of anchor and greatest hash instead."""
    sums, grams = _grams(text, a, b, unit)
    span = unit.length - unit.gram + 1
    low = A.window_min(grams, span)
    base = text.bounds[a]
    bounds = text.bounds[a : b + 1] - base
    own = np.flatnonzero(np.diff(bounds) >= unit.length)
    start, n = bounds[own], np.diff(bounds)[own] - unit.length + 1
    fresh = np.ones(len(low) + 1, bool)
    fresh[1:-1] = low[1:] != low[:-1]
    if fine:
        high = A.window_min(~grams, span)
        fresh[1:-1] |= high[1:] != high[:-1]
    fresh[start] = True
    fresh[start + n] = True
    ends = np.flatnonzero(fresh)
    at = ends[:-1]
    of = np.searchsorted(start, at, "right") - 1
    inside = (of >= 0) & (at < (start + n)[of]) if len(own) else np.zeros(len(at), bool)
    at, row, n = at[inside], own[of[inside]], np.diff(ends)[inside]
    anchor = low[at]
    if fine:
        anchor = np.stack((anchor, ~high[at]))
    zero = text.at(base)
    x, y = text.at(at + base) - zero, text.at(at + n + unit.length - 1 + base) - unit.words - zero
    return Runs(at + base, n, row + a, anchor, A.range_hash(sums, x, y))


def code_of(anchors: np.ndarray) -> np.ndarray:
    """47 bits that tell anchors apart nearly always, evenly spread."""
    return A.mix(anchors ^ np.uint64(0xA5A5)) >> np.uint64(17)


def bucket_of(codes: np.ndarray, unit: Unit) -> np.ndarray:
    """Buckets ascend with codes."""
    return (((codes >> np.uint64(15)) * np.uint64(unit.buckets)) >> np.uint64(32)).astype(np.int32)


def scanned(table: pa.Table, unit: Unit) -> tuple[Text, list[Runs], np.ndarray, np.ndarray]:
    """A block's text and runs, its distinct codes (ascending), and which of them two rows have."""
    text = block_text(table, unit)
    found, codes = [], [np.zeros(0, np.uint64)]
    one, bits = np.uint64(1), np.uint64(_ROW_BITS)
    for a, b in A.slices(text.at(text.bounds)):
        r = runs_of(text, a, b, unit)
        found.append(r)
        c, row = code_of(r.anchor), r.row - a
        if b - a <= 1 << _ROW_BITS:
            pair = np.sort((c << bits) | row.astype(np.uint64))
            pair = pair[np.concatenate(([True], pair[1:] != pair[:-1]))] if len(pair) else pair
            c = pair >> bits
        else:  # very many short rows
            o = np.lexsort((row, c))
            c, row = c[o], row[o]
            c = c[np.concatenate(([True], (c[1:] != c[:-1]) | (row[1:] != row[:-1])))] if len(c) else c
        first = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1]))) if len(c) else np.zeros(0, np.int64)
        codes.append((c[first] << one) | (np.diff(np.append(first, len(c))) > 1).astype(np.uint64))
    every = np.sort(np.concatenate(codes))
    c = every >> one
    first = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1]))) if len(c) else np.zeros(0, np.int64)
    last = np.append(first[1:], len(c)) - 1
    return text, found, c[first], (last > first) | ((every[last] & one) > 0)


def cuts_of(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin, and their end."""
    return np.append(np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))), len(keys)) if len(keys) else np.zeros(1, np.int64)


def send_anchors(table: pa.Table, unit: Unit) -> pa.Table:
    key = table["block"][0].as_py()
    _, _, code, twice = scanned(ordered(table), unit)
    bucket = bucket_of(code, unit)
    raw = ((code << np.uint64(1)) | twice.astype(np.uint64)).view(np.uint8).reshape(-1, 8)[:, :6]
    cuts = cuts_of(bucket)
    own = [raw[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return pa.table({"bucket": pa.array(bucket[cuts[:-1]], pa.int32()), "block": pa.array(np.full(len(own), key, np.int64)), "codes": pa.array(own, pa.binary())})


ANSWER = "block long, bucket int, kind tinyint, bits binary, segs binary, froms binary, tos binary, ids binary"
SHARED, COVERED, PLACES = 0, 1, 2


def answers(kind: int, block: pa.Array, bucket: pa.Array, **blobs: list) -> pa.Table:
    n = len(block)
    cols = {c: pa.array(blobs[c], pa.binary()) if c in blobs else pa.nulls(n, pa.binary()) for c in ("bits", "segs", "froms", "tos", "ids")}
    return pa.table({"block": block, "bucket": bucket, "kind": pa.array(np.full(n, kind, np.int8)), **cols})


def answer_anchors(table: pa.Table, unit: Unit) -> pa.Table:
    raw, offsets = A.text_arrays(table["codes"])
    wide = np.zeros((len(raw) // 6, 8), np.uint8)
    wide[:, :6] = raw.reshape(-1, 6)
    code = wide.view(np.uint64)[:, 0]
    o = np.argsort(code >> np.uint64(1), kind="stable")
    c = code[o]
    at = cuts_of(c >> np.uint64(1))
    n, at = np.diff(at), at[:-1]
    flag = np.maximum.reduceat(c & np.uint64(1), at) if len(at) else c
    shared, hot = np.zeros(len(c), bool), np.zeros(len(c), bool)
    shared[o] = np.repeat((n > 1) | (flag > 0), n)
    hot[o] = np.repeat(n > unit.hot, n)
    ends = offsets // 6
    bits = [np.packbits(shared[a:b]).tobytes() + np.packbits(hot[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return answers(SHARED, table["block"], table["bucket"], bits=bits)


#: Ranges of 8 to so many bytes are compared eight bytes at a time.
SHORT = 1024


def equal_groups(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A number for each range, the same for equal bytes only, and a range that has each number. Without hashes, ranges ascend."""
    n, h = len(starts), hashes
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lens = ends - starts
    short = (lens >= 8) & (lens <= SHORT)
    if 0 < (m := int(short.sum())) < n:
        some, others = np.flatnonzero(short), np.flatnonzero(~short)
        (x, p), (y, q) = (equal_groups(buf, starts[k], ends[k], None if h is None else h[k]) for k in (some, others))
        group = np.empty(n, np.int64)
        group[some], group[others] = x, y + len(p)
        return group, np.concatenate((some[p], others[q]))
    short = m == n
    eight = A.eight_bytes(buf) if short else buf
    if h is None and short:
        h = lens.astype(np.uint64)
        for k, at in _eights(starts, lens):
            h[k] = (h[k] ^ eight[at]) * np.uint64(0x9E3779B97F4A7C15)
            h[k] ^= h[k] >> np.uint64(29)
    elif h is None:
        h = np.zeros(n, np.uint64)
        for a, b in A.slices(np.append(starts, ends[-1])):
            base, top = starts[a], ends[a:b].max()
            h[a:b] = A.range_hash(A.prefix_hash(buf[base:top]), starts[a:b] - base, ends[a:b] - base)
    o = np.argsort(h)
    first = np.ones(n, bool)
    first[1:] = h[o][1:] != h[o][:-1]
    group = np.zeros(n, np.int64)
    group[o] = np.cumsum(first) - 1
    rep = o[first]
    other = rep[group]
    same = lens == lens[other]
    check = np.flatnonzero(same & (other != np.arange(n)) & (lens > 0))
    if short:
        for k, at in _eights(starts[check], lens[check]):
            same[check[k]] &= eight[at] == eight[at - starts[check[k]] + starts[other[check[k]]]]
    else:
        for a, b in A.slices(np.concatenate(([0], np.cumsum(lens[check])))):
            c = check[a:b]
            equal = buf[A.ranges(starts[c], lens[c])] == buf[A.ranges(starts[other[c]], lens[c])]
            same[c] = np.logical_and.reduceat(equal, np.concatenate(([0], np.cumsum(lens[c])[:-1])))
    if not same.all():  # a collision of hashes: the bytes themselves decide
        numbers: dict[bytes, int] = {}
        group = np.array([numbers.setdefault(buf[a:b].tobytes(), len(numbers)) for a, b in zip(starts, ends, strict=True)], np.int64)
        _, rep = np.unique(group, return_index=True)
    return group, rep


def _eights(starts: np.ndarray, lens: np.ndarray) -> Iterator[tuple[np.ndarray | slice, np.ndarray]]:
    """Places that cover the ranges eight bytes at a time: which ranges, and where; the last one may lap over."""
    least = int(lens.min()) if len(lens) else 0
    yield slice(None), starts + lens - 8
    for k in range(0, int(lens.max()) - 8 if len(lens) else 0, 8):
        if k + 8 < least:
            yield slice(None), starts + k
        else:
            own = np.flatnonzero(lens > k + 8)
            yield own, starts[own] + k


def packed(x: np.ndarray, dtype: type) -> bytes:
    return pa.compress(np.ascontiguousarray(x, dtype).tobytes(), codec=_CODEC, asbytes=True) if len(x) else b""


def unpacked(blobs: list[bytes], counts: np.ndarray, dtype: type) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    own = [np.frombuffer(pa.decompress(x, int(n) * size, codec=_CODEC, asbytes=True), dtype) for x, n in zip(blobs, counts, strict=True) if n]
    return np.concatenate(own) if own else np.zeros(0, dtype)


def shared_runs(text: Text, found: list[Runs], codes: np.ndarray, shared: np.ndarray, hot: np.ndarray, unit: Unit) -> tuple[Runs, np.ndarray]:
    """The block's runs with a shared anchor, in order, and the key each is dealt by; those with a hot anchor are split."""
    hot_codes, known = codes[hot], codes[shared]
    out, keys = [Runs(*[np.zeros(0, np.int64)] * 3, np.zeros(0, np.uint64), np.zeros(0, np.uint64))], [np.zeros(0, np.uint64)]
    at = 0
    for a, b in A.slices(text.at(text.bounds)):
        r = found[at]
        at += 1
        c = code_of(r.anchor)
        if not len(known) or not len(c):
            continue
        keep = known[np.minimum(np.searchsorted(known, c), len(known) - 1)] == c
        split = np.zeros(len(c), bool)
        if len(hot_codes):
            split = hot_codes[np.minimum(np.searchsorted(hot_codes, c), len(hot_codes) - 1)] == c
        k = np.flatnonzero(keep & ~split)
        parts, key = [Runs(r.at[k], r.n[k], r.row[k], r.anchor[k], r.text[k])], [A.mix(r.anchor[k])]
        if split.any():
            fine = runs_of(text, a, b, unit, fine=True)
            c = code_of(fine.anchor[0])
            k = np.flatnonzero(hot_codes[np.minimum(np.searchsorted(hot_codes, c), len(hot_codes) - 1)] == c)
            parts.append(Runs(fine.at[k], fine.n[k], fine.row[k], fine.anchor[0][k], fine.text[k]))
            key.append(A.mix(fine.anchor[0][k] ^ A.mix(fine.anchor[1][k])))
        o = np.argsort(np.concatenate([p.at for p in parts]), kind="stable")
        out.append(Runs(*(np.concatenate([getattr(p, f) for p in parts])[o] for f in ("at", "n", "row", "anchor", "text"))))
        keys.append(np.concatenate(key)[o])
    return Runs(*(np.concatenate([getattr(r, f) for r in out]) for f in ("at", "n", "row", "anchor", "text"))), np.concatenate(keys)


SEGMENTS = "bucket int, block long, first int, n int, parts binary, lens binary, least binary, most binary, content binary"


def send_segments(table: pa.Table, replies: pa.Table, unit: Unit) -> pa.Table:
    """A row of distinct segments for each bucket, and one with the block's places, which has the bucket -1 - block."""
    names = [x.split()[0] for x in SEGMENTS.split(", ")]
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 5)
    rows = []
    if len(table):
        key = table["block"][0].as_py()
        table = ordered(table)
        text, found, codes, _ = scanned(table, unit)
        cuts = cuts_of(bucket_of(codes, unit))
        bits = dict(zip(replies["bucket"].to_pylist(), replies["bits"].to_pylist(), strict=True))
        shared, hot = np.zeros(len(codes), bool), np.zeros(len(codes), bool)
        for b, x, y in zip(bucket_of(codes[cuts[:-1]], unit).tolist(), cuts[:-1], cuts[1:], strict=True):
            shared[x:y], hot[x:y] = (np.unpackbits(z, count=y - x).astype(bool) for z in np.frombuffer(bits[b], np.uint8).reshape(2, -1))
        runs, keys = shared_runs(text, found, codes, shared, hot, unit)
        ids = table["doc_id"].to_numpy()
        a, b = text.at(runs.at), text.at(runs.at + runs.n + unit.length - 1) - unit.words
        group, rep = equal_groups(text.buf, a, b, runs.text)
        doc = ids[runs.row]
        least, most = np.full(len(rep), _TOP), np.full(len(rep), np.iinfo(np.int64).min)
        np.minimum.at(least, group, doc)
        np.maximum.at(most, group, doc)
        to = bucket_of(code_of(keys[rep]), unit)
        order = np.lexsort((rep, to))
        number = np.zeros(len(rep), np.int64)
        number[order] = np.arange(len(rep))
        rep, to, least, most = rep[order], to[order], least[order], most[order]
        parts, lens = (keys[rep] >> np.uint64(3)).astype(np.uint8), b[rep] - a[rep]
        cuts = cuts_of(to)
        for x, y in zip(cuts[:-1], cuts[1:], strict=True):
            content = text.buf[A.ranges(a[rep[x:y]], lens[x:y])]
            rows.append((int(to[x]), key, int(x), int(y - x), parts[x:y].tobytes(), packed(lens[x:y], np.int32), packed(least[x:y], np.int64), packed(most[x:y], np.int64), packed(content, np.uint8)))
        if len(runs.at):
            rows.append((-1 - key, key, 0, len(runs.at), b"", packed(np.diff(runs.at, prepend=0), np.int64), packed(number[group], np.int32), b"", b""))
    return pa.table({c: pa.array([r[i] for r in rows], k) for i, (c, k) in enumerate(zip(names, kinds, strict=True))})


#: buf, starts, ends of distinct segments, each one's least id, the unit -> the least id for every window of every segment.
Method = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, Unit], tuple[np.ndarray, np.ndarray]]


def answer_segments(table: pa.Table, unit: Unit, method: Method) -> pa.Table:
    counts = table["n"].to_numpy()
    if table["bucket"][0].as_py() < 0:  # a block's places, on their way back to it
        return answers(PLACES, table["block"], table["n"], froms=table["lens"].to_pylist(), segs=table["least"].to_pylist())
    lens, parts = unpacked(table["lens"].to_pylist(), counts, np.int32).astype(np.int64), np.frombuffer(b"".join(table["parts"].to_pylist()), np.uint8)
    least, most = unpacked(table["least"].to_pylist(), counts, np.int64), unpacked(table["most"].to_pylist(), counts, np.int64)
    of = np.repeat(np.arange(len(table)), counts)
    number = np.arange(len(lens)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(table["first"].to_numpy(), counts)
    buf = unpacked(table["content"].to_pylist(), np.add.reduceat(lens, np.cumsum(counts) - counts), np.uint8)
    at = np.cumsum(lens) - lens
    shares = max(1, min(256, -(-len(buf) // GROUP_BYTES)))
    got: list[tuple[np.ndarray, ...]] = []
    for share in range(shares):  # equal windows have equal parts
        own = np.flatnonzero(parts % shares == share)
        if not len(own):
            continue
        group, rep = equal_groups(buf, at[own], at[own] + lens[own])
        low = np.full(len(rep), _TOP)
        np.minimum.at(low, group, least[own])
        rep = own[rep]
        piece, n = buf[A.ranges(at[rep], lens[rep])], lens[rep]
        ends = np.cumsum(n)
        win, bounds = method(piece, ends - n, ends, low, unit)  # bounds: each segment's windows in win
        fresh = np.ones(len(win), bool)
        fresh[1:] = win[1:] != win[:-1]
        fresh[bounds[:-1][bounds[:-1] < len(win)]] = True
        f = np.flatnonzero(fresh)
        f_end = np.append(f[1:], len(win))
        f_at = np.searchsorted(f, bounds)  # each segment's runs
        per = np.diff(f_at)[group]
        runs = A.ranges(f_at[:-1][group], per)
        seg = np.repeat(own, per)
        base = np.repeat(bounds[:-1][group], per)
        keep = win[f[runs]] < most[seg]
        runs, seg, base = runs[keep], seg[keep], base[keep]
        got.append((of[seg], number[seg], f[runs] - base, f_end[runs] - base, win[f[runs]]))
    if not got:
        return answers(COVERED, pa.array([], pa.int64()), pa.array([], pa.int32()))
    row, *rest = (np.concatenate(x) for x in zip(*got, strict=True))
    o = np.argsort(row, kind="stable")
    row, rest = row[o], [x[o] for x in rest]
    cuts = cuts_of(row)
    blobs = [[packed(x[a:b], np.int64 if i == 3 else np.int32) for a, b in zip(cuts[:-1], cuts[1:], strict=True)] for i, x in enumerate(rest)]
    return answers(COVERED, table["block"].take(pa.array(row[cuts[:-1]])), pa.array(np.diff(cuts), pa.int32()), segs=blobs[0], froms=blobs[1], tos=blobs[2], ids=blobs[3])


def block_cover(table: pa.Table, text: Text, replies: pa.Table, unit: Unit) -> np.ndarray:
    """Which symbols of a block in order are covered."""
    kinds = replies["kind"].to_numpy()
    notes, runs = (replies.filter(pa.array(kinds == k)) for k in (PLACES, COVERED))
    get = lambda t, c, dtype: unpacked(t[c].to_pylist(), t["bucket"].to_numpy(), dtype)
    at, number = np.cumsum(get(notes, "froms", np.int64)), get(notes, "segs", np.int32)
    seg, low, a, b = get(runs, "segs", np.int32), get(runs, "ids", np.int64), get(runs, "froms", np.int32), get(runs, "tos", np.int32)
    o = np.argsort(seg, kind="stable")
    seg, low, a, b = seg[o], low[o], a[o], b[o]
    lo, hi = np.searchsorted(seg, number, "left"), np.searchsorted(seg, number, "right")
    k = A.ranges(lo, hi - lo)
    at = np.repeat(at, hi - lo)
    row = np.searchsorted(text.bounds, at, "right") - 1
    ok = (low[k] < table["doc_id"].to_numpy()[row]) & ~table["unknown"].to_numpy()[row]
    return A.covered(int(text.bounds[-1]), (at + a[k])[ok], (at + b[k] - 1 + unit.length)[ok])


def covered_symbols(docs: DataFrame, unit_of: Callable[[int], Unit], method: Method, finish: Callable[[pa.Table, Text, np.ndarray], pa.Table], schema: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs has doc_id and text. finish() gets a block's rows, their text and its covered symbols.

    Rows without a doc_id are after all others: they cover nothing, and stay whole.
    """
    spark = docs.sparkSession
    total, n = text_bytes(docs), partitions(spark)
    blocks = max(2 * n, -(-total // block_bytes))
    unit = unit_of(max(n, -(-total // block_bytes)))
    rows = docs.select(
        F.coalesce(whole_ids(docs), F.lit(_TOP)).alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.col("doc_id").isNull().alias("unknown"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).alias("block"),
    )
    by_block = rows.groupBy("block")
    sent = by_block.applyInArrow(A.tidy(lambda t: send_anchors(t, unit)), "bucket int, block long, codes binary")
    bits = sent.groupBy("bucket").applyInArrow(A.tidy(lambda t: answer_anchors(t, unit)), ANSWER)
    segs = by_block.cogroup(bits.groupBy("block")).applyInArrow(A.tidy(lambda t, a: send_segments(t, a, unit)), SEGMENTS)
    found = segs.groupBy("bucket").applyInArrow(A.tidy(lambda t: answer_segments(t, unit, method)), ANSWER)

    def mark(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not len(table):
            return EMPTY(schema)
        table = ordered(table)
        text = block_text(table, unit)
        return finish(table, text, block_cover(table, text, replies, unit))

    return by_block.cogroup(found.groupBy("block")).applyInArrow(A.tidy(mark), schema)


def EMPTY(schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    return pa.table({x.split()[0]: pa.array([], kinds[x.split()[1]]) for x in schema.split(", ")})


def windows_of(starts: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of segments of symbols: their windows' first symbols, the segment of each, and each segment's first window (n + 1)."""
    n = ends - starts - length + 1
    return A.ranges(starts, n), np.repeat(np.arange(len(n)), n), np.concatenate(([0], np.cumsum(n)))


def least_of_runs(fresh: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The least id in each item's run of the items; fresh: a run begins here."""
    at = np.flatnonzero(fresh)
    return np.repeat(np.minimum.reduceat(ids, at), np.diff(np.append(at, len(ids)))) if len(ids) else ids
