"""Substring dedup by prefix-partitioned suffix trees.

The suffixes of a bucket's segments are split by prefixes of variable length: those with the same first word are a group, a
group with more suffixes than fit is split by one word more, and neighbouring small ones are packed together, until every group
is memory-sized. Each group's subtree is built from the top, level by level, as deep as is asked; it is kept as the
sorted suffixes and, between neighbours, the depth of the node that parts them. Internal nodes of `length` words or more
are repeats: the topmost of them tell which windows are equal, and maximal_repeats() lists all of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import arrays as A
from . import repeats as R
from .shared import given_ids

LENGTH, GRAM = 13, 6
#: Suffixes in a group.
GROUP = 20_000


def prefix_groups(words: np.ndarray, ends: np.ndarray, at: np.ndarray, length: int, most: int = GROUP) -> Iterator[tuple[np.ndarray, int]]:
    """The suffixes at, in groups of at most so many, with the number of words that all of a group share.

    ends: each word's end of text. Prefixes grow to `length` words at most, so that what stands below a deep node stays in
    one group; a group that shares so many may be larger.
    """
    todo = [(at, 0)]
    while todo:
        own, depth = todo.pop()
        if len(own) <= most or depth == length:
            yield own, depth
            continue
        w = next_words(words, ends, own, depth)
        o = np.argsort(w, kind="stable")
        own, w = own[o], w[o]
        starts = R.cuts_of(w)
        a = 0
        while a < len(starts) - 1:  # neighbouring prefixes as far as they fit
            b = max(a + 1, int(np.searchsorted(starts, starts[a] + most, "right")) - 1)
            part = own[starts[a] : starts[b]]
            if b > a + 1:
                yield part, depth
            else:
                todo.append((part, depth + 1))
            a = b


def next_words(words: np.ndarray, ends: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Number of the word that stands so many words on, from 1; 0 where the text has ended."""
    to = at + depth
    ok = to < ends[at]
    return np.where(ok, words[np.where(ok, to, 0)] + 1, 0)


@dataclass
class Subtree:
    """suffixes: sorted leaves; parted: depth of the deepest node above both a leaf and the one before it (0 for the first)."""

    suffixes: np.ndarray
    parted: np.ndarray


def build(words: np.ndarray, ends: np.ndarray, own: np.ndarray, depth: int, stop: int | None = None) -> Subtree:
    """The subtree of suffixes that share `depth` words. Each level parts the leaves of every open node by their next word.

    stop: a depth below which nodes aren't parted: leaves that share so many words stand below one node of that depth.
    """
    order, parted = own.copy(), np.zeros(len(own), np.int64)
    slots, node = np.arange(len(own)), np.zeros(len(own), np.int64)
    while len(slots):
        if depth == stop:
            parted[slots[1:][node[1:] == node[:-1]]] = depth
            break
        key = next_words(words, ends, order[slots], depth)
        bits = int(key.max()).bit_length()
        o = np.argsort((node << bits) | key, kind="stable")
        order[slots], key = order[slots][o], key[o]
        inside = np.concatenate(([False], node[1:] == node[:-1]))
        fresh = np.concatenate(([True], key[1:] != key[:-1])) & inside
        parted[slots[fresh]] = depth
        ended = key == 0
        parted[slots[inside & ended & ~fresh]] = depth  # equal leaves
        child = np.cumsum(fresh | ~inside) - 1
        more = ~ended & (np.bincount(child)[child] > 1)
        slots, node = slots[more], child[more]
        depth += 1
    return Subtree(order, parted)


def deep_nodes(tree: Subtree, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Depth, first and last leaf (exclusive) of the internal nodes of `length` words or more, a depth at a time."""
    parted = tree.parted
    for depth in np.unique(parted[parted >= length]).tolist():
        below = parted >= depth
        edge = np.diff(np.concatenate(([0], below[1:].astype(np.int8), [0])))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1
        exact = np.concatenate(([0], np.cumsum(parted == depth)))
        here = exact[last] > exact[first + 1]  # some leaves part at this depth
        yield depth, first[here], last[here]


def maximal_repeats(texts: list[str], length: int = LENGTH, most: int = GROUP) -> list[tuple[list[str], list[tuple[int, int]]]]:
    """Sequences of `length` words or more that stand twice or more in texts and can be extended neither way without losing an
    occurrence, each with its places (text, word). Null texts have no words."""
    data, offsets = A.text_arrays(pa.array(texts, pa.string()))
    buf, sym, bounds = R.normal_words(data, offsets)
    words, _ = R.equal_groups(buf, sym[:-1], sym[1:])
    ends = np.repeat(bounds[1:], np.diff(bounds))
    starts = np.zeros(len(words), bool)
    starts[bounds[:-1][np.diff(bounds) > 0]] = True
    before = np.where(starts, -1 - np.arange(len(words)), np.concatenate(([0], words[:-1])) if len(words) else words)  # a text's start is unlike any word
    out = []
    for own, depth in prefix_groups(words, ends, np.flatnonzero(ends - np.arange(len(words)) >= length), length, most):
        tree = build(words, ends, own, depth)
        for d, first, last in deep_nodes(tree, length):
            for a, b in zip(first, last, strict=True):
                leaves = np.sort(tree.suffixes[a:b])
                if len(np.unique(before[leaves])) > 1:
                    row = np.searchsorted(bounds, leaves, "right") - 1
                    first_word = leaves[0]
                    out.append((buf[sym[first_word] : sym[first_word + d] - 1].tobytes().decode().split(" "), list(zip(row.tolist(), (leaves - bounds[row]).tolist(), strict=True))))
    return out


def by_subtrees(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, low: np.ndarray, unit: R.Unit) -> tuple[np.ndarray, np.ndarray]:
    """The method of repeats.py: equal windows stand below one topmost deep node."""
    a, b, bounds = A.word_bounds(buf, np.append(starts, ends[-1:]) if len(ends) else np.zeros(1, np.int64))
    words, _ = R.equal_groups(buf, a, b)
    at, seg, first = R.windows_of(bounds[:-1], bounds[1:], unit.length)
    word_ends = np.repeat(bounds[1:], np.diff(bounds))
    place = np.zeros(len(words) + 1, np.int64)
    place[at] = np.arange(len(at))
    out = low[seg]
    for own, depth in prefix_groups(words, word_ends, at, unit.length):
        tree = build(words, word_ends, own, depth, unit.length)  # what parts deeper decides nothing, and repetitive text parts very deep
        k = place[tree.suffixes]
        out[k] = R.least_of_runs(np.concatenate(([True], tree.parted[1:] < unit.length)), low[seg[k]])
    return out, first


def _kept(text: R.Text, cover: np.ndarray) -> list[bytes]:
    keep = ~np.repeat(cover, np.diff(text.sym))
    at = text.sym[text.bounds]
    return [text.buf[a:b][keep[a:b]][:-1].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]


def _finish(rows: pa.Table, text: R.Text, cover: np.ndarray) -> pa.Table:
    sums = np.concatenate(([0], np.cumsum(cover)))
    digests = [hashlib.sha256(x).hexdigest() for x in _kept(text, cover)]
    return pa.table({"doc_id": given_ids(rows), "n_words": np.diff(text.bounds), "n_removed": np.diff(sums[text.bounds]), "kept_sha256": pa.array(digests, pa.string())})


def _texts(rows: pa.Table, text: R.Text, cover: np.ndarray) -> pa.Table:
    return pa.table({"doc_id": given_ids(rows), "text": pa.array([x.decode() for x in _kept(text, cover)], pa.string())})


def dedup_words(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, texts: bool = False, **sizes: int) -> DataFrame:
    """Remove each word of docs (doc_id, text, other columns unused) covered by a window of `length` words that also starts in a document with a smaller id.

    A row out for each row in: doc_id, n_words, n_removed, kept_sha256 (of the kept words, joined by one space), or
    with texts=True doc_id and those words. Ids are whole numbers, and anything else is an error. Null and empty texts have
    no words. Rows with the same id don't cover each other. Rows without an id stay whole and cover nothing. An empty table
    gives an empty one.
    """
    hot = sizes.pop("hot", R.HOT_BLOCKS)
    schema = "doc_id long, text string" if texts else "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return R.covered_symbols(docs, lambda b: R.Unit(length, min(gram, length), True, b, hot), by_subtrees, _texts if texts else _finish, schema, **sizes)
