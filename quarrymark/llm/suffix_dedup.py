"""Suffix-array dedup by bucket-pointer refinement.

refine() sorts suffixes into buckets by their first Q bytes; each suffix has a pointer to its bucket's end and knows how many
bytes its bucket shares. A bucket is then refined by sorting its suffixes on the pointers of the buckets that their later
offsets stand in, as far on as the bucket is known to share. New pointers are written at once, and a bucket's parts are
refined, recursively, before later buckets are turned to, which find them in place: what one bucket learned makes the
next one's offsets longer. Small neighbouring buckets are worked on together, as arrays. With a limit, buckets that share
that many bytes are left; without, this ends with the suffix array.

Windows of `length` bytes are equal where neighbours in the sorted order share so many bytes, which is compared on the bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import arrays as A
from . import repeats as R
from .shared import given_ids

Q = 5
LENGTH, GRAM = 50, 20
#: Suffixes of small buckets that are refined together.
TOGETHER = 1 << 17
_INDEX = 21


def _first_order(data: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes by their first Q bytes, shorter ones first, and where buckets begin in that order."""
    n = len(data)
    key = A.eight_bytes(data, ">u8")[:n] >> np.uint64(64 - 8 * Q)
    short = np.flatnonzero(left < Q)
    missing = (8 * (Q - left[short])).astype(np.uint64)
    key[short] = key[short] >> missing << missing
    key = (key << np.uint64(3)) | np.minimum(left, Q).astype(np.uint64)
    own = np.flatnonzero(left)
    if n <= 1 << _INDEX:  # key and place in one word
        both = np.sort(((key << np.uint64(_INDEX)) | np.arange(n, dtype=np.uint64))[own])
        order, key = (both & np.uint64((1 << _INDEX) - 1)).astype(np.int64), both >> np.uint64(_INDEX)
    else:
        order = own[np.argsort(key[own])]
        key = key[order]
    return order, R.cuts_of(key)[:-1]


def _sorted_within(bucket: np.ndarray, later: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of items by bucket number, then by the later pointer, and both so ordered."""
    m = len(bucket)
    low, high = int(m).bit_length(), int(n + 1).bit_length()
    if int(bucket[-1]).bit_length() + high + low < 63:
        both = np.sort((((bucket << high) | later) << low) | np.arange(m))
        pair = both >> low
        return both & ((1 << low) - 1), pair >> high, pair & ((1 << high) - 1)
    o = np.lexsort((later, bucket))
    return o, bucket[o], later[o]


def refine(data: np.ndarray, left: np.ndarray, limit: int | None = None, together: int = TOGETHER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffixes in order, and for each its pointer and how many bytes its bucket shares.

    left: bytes from each place to its text's end; behind each text stands one byte that isn't part of it, with 0 left. Shorter
    suffixes come before those that they begin. Suffixes that are equal to the end share a bucket. Buckets that share
    `limit` bytes or more aren't refined.
    """
    order, starts = _first_order(data, left)
    n = len(order)
    counts = np.diff(np.append(starts, n))
    half = (1 << 32) - 1
    shared = np.minimum(left, Q)[order].astype(np.int64)
    state = np.zeros(len(data), np.int64)  # deep << 32 | pointer + 1, and 0 at the ends
    state[order] = np.repeat(starts + counts, counts) | (shared << 32)
    open_ = np.repeat(counts > 1, counts) & (shared == Q)
    if limit is not None and limit <= Q:
        open_[:] = False
    bounds = np.append(np.unique(starts[np.searchsorted(starts, np.arange(0, n, together), "right") - 1]), n) if n else np.zeros(1, np.int64)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        slots = a + np.flatnonzero(open_[a:b])
        while len(slots):
            at = order[slots]
            own = state[at]
            deep = own >> 32
            own &= half
            next_ = state[at + deep]
            deep += next_ >> 32
            fresh = np.concatenate(([False], own[1:] != own[:-1]))
            o, bucket, later = _sorted_within(np.cumsum(fresh), next_ & half, n)
            at, deep = at[o], deep[o]
            order[slots] = at
            fresh[1:] = (bucket[1:] != bucket[:-1]) | (later[1:] != later[:-1])
            fresh[0] = True
            first = np.flatnonzero(fresh)
            size = np.diff(np.append(first, len(at)))
            state[at] = np.repeat(slots[first + size - 1] + 1, size) | (deep << 32)
            more = np.repeat(size > 1, size) & (later > 0)
            if limit is not None:
                more &= deep < limit
            slots = slots[more]
    return order, (state & half) - 1, state >> 32


def suffix_array(data: bytes) -> np.ndarray:
    """The suffix array of one text."""
    raw = np.frombuffer(data + b"\0", np.uint8)
    return refine(raw, len(data) - np.arange(len(raw)))[0]


def by_suffixes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, low: np.ndarray, unit: R.Unit) -> tuple[np.ndarray, np.ndarray]:
    """The method of repeats.py: equal windows are neighbours in the suffix array and share their bytes."""
    length, count = unit.length, len(starts)
    _, seg, bounds = R.windows_of(starts, ends, length)
    last = ends + np.arange(count)
    data, inside = np.zeros(len(buf) + count, np.uint8), np.ones(len(buf) + count, bool)
    inside[last] = False
    data[inside] = buf
    left = np.repeat(last, ends - starts + 1) - np.arange(len(data))
    order, pointer, deep = refine(data, left, length)
    w = order[left[order] >= length]
    fresh = np.ones(len(w), bool)
    fresh[1:] = (pointer[w][1:] != pointer[w][:-1]) | (deep[w][1:] < length)
    check = np.flatnonzero(fresh[1:])  # another bucket, or one that was single: the bytes decide
    eight, step = (A.eight_bytes(data), 8) if length >= 8 else (data, 1)
    for k in [*range(0, length - step, step), length - step]:
        check = check[eight[w[check] + k] == eight[w[check + 1] + k]]
    fresh[check + 1] = False
    place = np.cumsum(left >= length) - 1  # windows in the order of the text
    out = np.empty(len(w), np.int64)
    out[place[w]] = R.least_of_runs(fresh, low[seg[place[w]]])
    return out, bounds


def _finish(rows: pa.Table, text: R.Text, cover: np.ndarray) -> pa.Table:
    bounds = text.bounds
    removed = np.diff(np.concatenate(([0], np.cumsum(cover)))[bounds])
    opens = cover.copy()
    opens[1:] &= ~cover[:-1]
    opens[bounds[:-1][bounds[:-1] < len(cover)]] |= cover[bounds[:-1][bounds[:-1] < len(cover)]]
    spans = np.diff(np.concatenate(([0], np.cumsum(opens)))[bounds])
    digests = [hashlib.sha256(text.buf[a:b][~cover[a:b]] if r else text.buf[a:b]).hexdigest() for a, b, r in zip(bounds[:-1], bounds[1:], removed, strict=True)]
    return pa.table({"doc_id": given_ids(rows), "n_bytes": np.diff(bounds), "n_removed": removed, "n_spans": spans, "kept_sha256": pa.array(digests, pa.string())})


def _texts(rows: pa.Table, text: R.Text, cover: np.ndarray) -> pa.Table:
    """The kept text; a cut may fall inside a character, and such stray bytes become U+FFFD."""
    kept = [text.buf[a:b][~cover[a:b]].tobytes().decode("utf-8", "replace") for a, b in zip(text.bounds[:-1], text.bounds[1:], strict=True)]
    return pa.table({"doc_id": given_ids(rows), "text": pa.array(kept, pa.string())})


def dedup_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, texts: bool = False, **sizes: int) -> DataFrame:
    """Remove each byte of docs (doc_id, text, other columns unused) covered by a string of `length` bytes that also starts in a document with a smaller id.

    A row out for each row in: doc_id, n_bytes, n_removed, n_spans, kept_sha256, or with texts=True doc_id and the
    kept text. Ids are whole numbers, and anything else is an error. Null and empty texts have no bytes. Rows with the same
    id don't cover each other. Rows without an id stay whole and cover nothing. An empty table gives an empty one.
    """
    hot = sizes.pop("hot", R.HOT_BLOCKS)
    schema = "doc_id long, text string" if texts else "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return R.covered_symbols(docs, lambda b: R.Unit(length, min(gram, length), False, b, hot), by_suffixes, _texts if texts else _finish, schema, **sizes)
