"""Quality rules: gradient-boosted trees over document statistics.

Statistics are counted for whole slices of texts at once. The trees are trained on the driver from a bounded sample of
labelled rows (of their few numbers, not their texts), with histograms and logistic loss; a feature with a monotonic
constraint may only push the score one way. A trained model is three flat arrays, in which all trees are scored level by
level for a whole batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as A
from .repeats import equal_groups
from .shared import hash_sample, written

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_distinct")
#: Features and their constraints: 1 may only raise, -1 only lower the score.
FEATURES = {"log_words": 0, "mean_word": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "line_words": 0, "upper_share": -1, "digit_share": 0, "distinct_share": 1}
SYMBOLS = A._table(*((ord(c), ord(c)) for c in "#*$%&|<>"))
SAMPLE = 20_000
MIN_WORDS, MOST_REPEATED = 50, 50
THRESHOLD = 0.5


def doc_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """COUNTS of each text of a slice, a column each."""
    starts, ends, bounds = A.word_bounds(data, offsets)
    out = np.zeros((len(offsets) - 1, len(COUNTS)), np.int64)
    per_doc = lambda mask: np.diff(np.concatenate(([0], np.cumsum(mask)))[offsets])
    out[:, 0] = np.diff(bounds)
    out[:, 1] = per_doc(A.PLAIN_WORD[data] & ((data & 0xC0) != 0x80))
    out[:, 2] = per_doc(SYMBOLS[data])
    out[:, 6] = per_doc((data >= 0x41) & (data <= 0x5A))
    out[:, 7] = per_doc((data >= 0x30) & (data <= 0x39))
    # Lines: the texts' pieces between line feeds.
    cut = np.flatnonzero(data == 10)
    line_a = np.sort(np.concatenate((offsets[:-1], cut + 1)), kind="stable")
    line_doc = np.searchsorted(offsets[1:], line_a, "right")
    at_end = np.isin(line_a, offsets[1:]) & ~np.isin(line_a, offsets[:-1])
    line_a, line_doc = line_a[~at_end & (line_doc < len(out))], line_doc[~at_end & (line_doc < len(out))]
    line_b = np.minimum(np.append(line_a[1:], len(data)), offsets[1:][line_doc]) if len(line_a) else line_a
    line_b = line_b - ((line_b > line_a) & (data[np.maximum(line_b - 1, 0)] == 10)) if len(data) else line_b
    first = np.searchsorted(starts, line_a)
    worded = (first < np.searchsorted(starts, line_b)) if len(starts) else np.zeros(len(line_a), bool)
    line_a, line_b, line_doc = line_a[worded], line_b[worded], line_doc[worded]
    group, _ = equal_groups(data, line_a, line_b)
    out[:, 5] = np.bincount(line_doc, minlength=len(out))
    out[:, 3] = np.bincount(line_doc[_again(group, line_doc)[0]], minlength=len(out))
    # Words and windows of three.
    word, _ = equal_groups(data, starts, ends)
    doc = A.row_of(bounds)
    out[:, 8] = out[:, 0] - np.bincount(doc[_again(word, doc)[0]], minlength=len(out))
    if len(word) > 2:
        inside = doc[2:] == doc[:-2]
        at = np.flatnonzero(inside)
        n = np.int64(word.max() + 1)
        if n < 2_000_000:
            key = (word[at] * n + word[at + 1]) * n + word[at + 2]
        else:  # a single text of very many different words
            _, key = np.unique(np.stack((word[at], word[at + 1], word[at + 2]), 1), axis=0, return_inverse=True)
        later, both = _again(key, doc[at])
        hit = A.covered(len(word), at[both], at[both] + 3)
        out[:, 4] = np.diff(np.concatenate(([0], np.cumsum(hit)))[bounds])
    return out


def _again(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Items whose key came before in the same text, and all items whose key comes twice there. Texts ascend."""
    o = np.argsort(key, kind="stable")
    same = np.zeros(len(o) + 1, bool)
    same[1:-1] = (key[o][1:] == key[o][:-1]) & (doc[o][1:] == doc[o][:-1])
    return o[same[:-1]], o[same[:-1] | same[1:]]


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and COUNTS of whole texts, a row out for each row in; null and empty texts count nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = A.text_arrays(batch["text"])
            parts = [doc_counts(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in A.slices(offsets)]
            c = np.concatenate(parts) if parts else np.zeros((0, len(COUNTS)), np.int64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(c[:, k]) for k in range(c.shape[1]))], ["doc_id", *COUNTS])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.col(text).alias("text")).mapInArrow(A.tidy(run), f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS))


def features(c: dict[str, np.ndarray]) -> np.ndarray:
    """FEATURES from COUNTS; shares of nothing are 0."""
    c = {k: np.asarray(v, float) for k, v in c.items()}
    share = lambda a, b: a / np.maximum(b, 1)
    return np.stack((np.log1p(c["n_words"]), share(c["word_chars"], c["n_words"]), share(c["n_symbols"], c["word_chars"]), share(c["n_dup_lines"], c["n_lines"]), share(c["n_repeat_words"], c["n_words"]), share(c["n_words"], c["n_lines"]), share(c["n_upper"], c["word_chars"]), share(c["n_digits"], c["word_chars"]), share(c["n_distinct"], c["n_words"])), 1)


@dataclass
class Trees:
    """Complete trees in flat arrays: node i has children 2 i + 1 and 2 i + 2; left if the feature is at most the threshold."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += v[at - (2**self.depth - 1)]
        return 1 / (1 + np.exp(-out))


def train(x: np.ndarray, y: np.ndarray, signs: list[int], n_trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 64, ridge: float = 1.0, least: int = 5) -> Trees:
    """Boosted trees for P(y = 1). A split on a constrained feature must order its children; their bounds go down the tree."""
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.zeros(0) for j in range(m)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], "left") for j in range(m)], 1) if n else np.zeros((0, m), int)
    p = min(max((y.sum() + 1) / (n + 2), 1e-3), 1 - 1e-3)
    base = float(np.log(p / (1 - p)))
    score = np.full(n, base)
    inner, leaves = 2**depth - 1, 2**depth
    feats, cuts, values = [], [], []
    for _ in range(n_trees if n else 0):
        prob = 1 / (1 + np.exp(-score))
        g, h = y - prob, prob * (1 - prob)
        feat, cut, value = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(leaves)
        low, high = np.full(inner + leaves, -np.inf), np.full(inner + leaves, np.inf)
        at = np.zeros(n, np.int64)
        for node in range(inner):
            own = np.flatnonzero(at == node)
            best = (1e-9, None)
            for j in range(m):
                k = len(edges[j])
                if not k or len(own) < 2 * least:
                    continue
                b = binned[own, j]
                gl, hl, nl = (np.cumsum(np.bincount(b, w, k + 1))[:-1] for w in (g[own], h[own], np.ones(len(own))))
                gs, hs = g[own].sum(), h[own].sum()
                gr, hr = gs - gl, hs - hl
                vl = np.clip(gl / (hl + ridge), low[node], high[node])
                vr = np.clip(gr / (hr + ridge), low[node], high[node])
                gain = 2 * (vl * gl + vr * gr) - vl * vl * (hl + ridge) - vr * vr * (hr + ridge)
                v0 = np.clip(gs / (hs + ridge), low[node], high[node])
                gain -= 2 * v0 * gs - v0 * v0 * (hs + ridge)
                gain[(nl < least) | (len(own) - nl < least) | (signs[j] * (vr - vl) < 0)] = -1
                i = int(np.argmax(gain))
                if gain[i] > best[0]:
                    best = (gain[i], (j, i, vl[i], vr[i]))
            left, right = 2 * node + 1, 2 * node + 2
            low[[left, right]], high[[left, right]] = low[node], high[node]
            if best[1]:
                j, i, vl, vr = best[1]
                feat[node], cut[node] = j, edges[j][i]
                mid = (vl + vr) / 2
                if signs[j]:
                    (high if signs[j] > 0 else low)[left] = mid
                    (low if signs[j] > 0 else high)[right] = mid
                at[own] = left + (binned[own, j] > i)
            else:
                at[own] = left
        for leaf in range(leaves):
            own = at == inner + leaf
            value[leaf] = rate * np.clip(g[own].sum() / (h[own].sum() + ridge), low[inner + leaf], high[inner + leaf])
        feats.append(feat)
        cuts.append(cut)
        values.append(value)
        score += value[at - inner]
    shape = (len(feats), -1) if feats else (0, inner)
    return Trees(np.reshape(feats, shape).astype(np.int64), np.reshape(cuts, shape).astype(float), np.reshape(values, (len(feats), leaves)), depth, base)


def fit(counts: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees | None:
    """Trees from about `sample` labelled rows at most, chosen by a hash of their id; None where nothing is labelled."""
    labelled = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    rows = counts.join(hash_sample(labelled, "doc_id", sample), "doc_id").toPandas().sort_values(["doc_id", *COUNTS])
    if not len(rows):
        return None
    return train(features({c: rows[c].to_numpy() for c in COUNTS}), (rows["quality"].to_numpy() > 0).astype(float), list(FEATURES.values()))


def judge_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """Statistics and verdicts of docs (doc_id, text), from labels (doc_id, quality).

    A row out for each row in: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    score. kept is false where base_failed (fewer than 50 words, or over half of them in repeated windows), else the trees'
    verdict; without labels all that don't fail are kept and score is null. Of a doc_id's labels the greatest counts.
    """
    counts = written(counted(docs), "counts")
    trees = fit(counts, labels, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {k: batch[k].to_numpy() for k in COUNTS}
            failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MOST_REPEATED * c["n_words"])
            score = trees.score(features(c)) if trees else None
            kept = ~failed if score is None else ~failed & (score >= threshold)
            scores = pa.array(score) if score is not None else pa.nulls(len(batch), pa.float64())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(batch[k] for k in COUNTS[:5]), pa.array(failed), pa.array(kept), scores], ["doc_id", *COUNTS[:5], "base_failed", "kept", "score"])

    kind = dict(docs.dtypes)["doc_id"]
    return counts.mapInArrow(A.tidy(run), f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS[:5]) + ", base_failed boolean, kept boolean, score double")
