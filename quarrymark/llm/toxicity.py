"""Toxicity: cumulative-link ordinal regression over sparse text features.

P(grade <= k) = sigmoid(threshold_k - w . x): one weight vector serves all thresholds, which are ordered, and expected
severity is the sum of P(grade > k). Features are folded words and their first four and five characters, told by 64-bit
hashes, with log(1 + count); words that never stood in the sample thus still count by how they begin. Executors count
features over a bounded sample of labelled rows and pick those that tell grades apart; the driver only fits their weights.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import arrays as A
from .decontaminate import folded
from .shared import hash_sample, whole_ids

#: Labelled rows to fit from, features to keep, and in how many sample rows a feature must stand.
SAMPLE, FEATURES, LEAST = 10_000, 1 << 15, 4
#: Pooled z-score from which a feature counts as associated with a grade above 0.
SIGNAL = 4.0
THRESHOLD = 0.4
_KINDS = (np.uint64(0x1F3D5B79), np.uint64(0x2E4C6A88), np.uint64(0x3C5A7896))


def text_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and feature of each word's features in a slice, and each row's words."""
    w = folded(data, offsets)
    row = A.row_of(w.bounds)
    chars = np.flatnonzero((w.buf & 0xC0) != 0x80)
    first = np.searchsorted(chars, w.at[:-1])
    last = w.at[1:] - 1
    sums = A.prefix_hash(w.buf)
    rows, feats = [row], [A.mix(w.hashes ^ _KINDS[0])]
    for n, kind in ((4, _KINDS[1]), (5, _KINDS[2])):
        to = first + n
        ok = np.flatnonzero(to < len(chars))
        ok = ok[chars[to[ok]] < last[ok]]  # longer words only
        rows.append(row[ok])
        feats.append(A.mix(A.range_hash(sums, w.at[:-1][ok], chars[to[ok]]) ^ kind))
    return np.concatenate(rows), np.concatenate(feats), np.diff(w.bounds)


def _counts(row: np.ndarray, feat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, feature) with their counts."""
    o = np.lexsort((feat, row))
    row, feat = row[o], feat[o]
    first = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (feat[1:] != feat[:-1])))) if len(row) else np.zeros(0, np.int64)
    return row[first], feat[first], np.diff(np.append(first, len(row)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Ordinal:
    """features: sorted hashes; weights: theirs; thresholds: ascending."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k), a column for each threshold."""
        return _sigmoid(score[:, None] - self.thresholds[None, :])


def thresholds_of(p: np.ndarray, n_features: int) -> np.ndarray:
    """A first threshold and positive steps (as logarithms) from it, so that they stay ordered."""
    return p[n_features] + np.concatenate(([0.0], np.cumsum(np.exp(p[n_features + 1 :]))))


def loss_and_gradient(p: np.ndarray, row: np.ndarray, col: np.ndarray, value: np.ndarray, grade: np.ndarray, n_features: int, ridge: float) -> tuple[float, np.ndarray]:
    """Mean negative log-likelihood of the grades, with the ridge on weights, and its gradient by weights, threshold and steps."""
    n, w, th = len(grade), p[:n_features], thresholds_of(p, n_features)
    s = np.bincount(row, w[col] * value, n)
    c = np.concatenate((np.zeros((n, 1)), _sigmoid(th[None, :] - s[:, None]), np.ones((n, 1))), 1)
    d = c * (1 - c)
    i = np.arange(n)
    prob = np.maximum(c[i, grade + 1] - c[i, grade], 1e-9)
    gs = (d[i, grade + 1] - d[i, grade]) / prob / n
    gt = np.zeros((n, len(th) + 2))
    gt[i, grade + 1] -= d[i, grade + 1] / prob / n
    gt[i, grade] += d[i, grade] / prob / n
    gt = gt[:, 1:-1].sum(0)
    steps = np.exp(p[n_features + 1 :]) * np.cumsum(gt[::-1])[::-1][1:]
    return float(-np.log(prob).mean() + ridge / 2 / n * (w @ w)), np.concatenate((np.bincount(col, gs[row] * value, n_features) + ridge * w / n, [gt.sum()], steps))


def fit_ordinal(row: np.ndarray, col: np.ndarray, value: np.ndarray, grade: np.ndarray, n_features: int, steps: int = 600, rate: float = 0.05, ridge: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by full gradient steps with momentum (Adam)."""
    share = np.array([np.clip((grade > k).mean(), 1e-3, 1 - 1e-3) for k in range(int(grade.max()))])
    start = -np.log(share / (1 - share))
    p = np.concatenate((np.zeros(n_features), start[:1], np.log(np.maximum(np.diff(start), 1e-2))))
    m, v = np.zeros(len(p)), np.zeros(len(p))
    for t in range(1, steps + 1):
        _, g = loss_and_gradient(p, row, col, value, grade, n_features, ridge)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return p[:n_features], thresholds_of(p, n_features)


def fit(docs: DataFrame, labels: DataFrame, grade: Column, split: int = 1, sample: int = SAMPLE) -> Ordinal | None:
    """An ordinal model from about `sample` labelled rows at most, chosen by a hash of their id.

    grade: a column of labels, whole numbers from 0. With split > 1 and grades 0 and 1 only, rows of grade 1 are dealt into
    grades 1 to split by quantiles of their count of associated features. None where fewer than two grades are labelled.
    """
    spark = docs.sparkSession
    graded = labels.select("doc_id", grade.cast("int").alias("grade")).filter("doc_id IS NOT NULL AND grade >= 0").groupBy("doc_id").agg(F.max("grade").alias("grade"))
    picked = sorted(hash_sample(graded, "doc_id", sample).collect(), key=lambda r: r["doc_id"])
    if len({r["grade"] for r in picked}) < 2:
        return None
    chosen = spark.createDataFrame([(r["doc_id"], r["grade"]) for r in picked], "doc_id long, grade int")  # about `sample` rows at most
    texts = docs.select(whole_ids(docs).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = A.text_arrays(batch["text"])
            toxic = batch["grade"].to_numpy() > 0
            for a, b in A.slices(offsets):
                row, feat, _ = text_features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                row, feat, _ = _counts(row, feat)
                f, inv, n = np.unique(feat, return_inverse=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(f.view(np.int64)), pa.array(n), pa.array(np.bincount(inv, toxic[a + row], len(f)).astype(np.int64))], ["feature", "n", "n_toxic"])

    n_toxic = sum(r["grade"] > 0 for r in picked)
    base = n_toxic / len(picked)
    z = (F.col("n_toxic") - F.col("n") * base) / F.sqrt(F.col("n") * (base * (1 - base)))
    table = texts.mapInArrow(A.tidy(gather), "feature long, n long, n_toxic long").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic"))
    best = table.filter(F.col("n") >= LEAST).select("feature", z.alias("z")).filter(F.abs("z") >= SIGNAL).orderBy(F.abs("z").desc(), "feature").limit(FEATURES).collect()
    if not best:
        return None
    hashes = np.array([r["feature"] for r in best], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    hashes, zs = hashes[order], np.array([r["z"] for r in best])[order]
    rows = texts.mapInArrow(A.tidy(_project(hashes)), "doc_id long, grade int, n_words long, cols binary, counts binary").orderBy("doc_id", "n_words", "cols", "counts").collect()
    cols = [np.frombuffer(r["cols"], np.int32) for r in rows]
    counts = [np.frombuffer(r["counts"], np.int32) for r in rows]
    y = np.array([r["grade"] for r in rows])
    if split > 1 and y.max() == 1:
        hits = np.array([n[zs[c] >= SIGNAL].sum() for c, n in zip(cols, counts, strict=True)])
        steps = np.quantile(hits[y == 1], np.linspace(0, 1, split + 1)[1:-1])
        y = np.where(y == 1, 1 + np.searchsorted(steps, hits, "left"), 0)
    row = np.repeat(np.arange(len(rows)), [len(c) for c in cols])
    w, th = fit_ordinal(row, np.concatenate(cols), np.log1p(np.concatenate(counts)), y, len(hashes))
    return Ordinal(hashes, w, th)


def _known(hashes: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """Index of each feature in the sorted hashes, or -1. A bitmap turns nearly all others away first."""
    bits = 22
    seen = np.zeros(1 << bits, bool)
    seen[(hashes >> np.uint64(64 - bits)).astype(np.int64)] = True

    def find(feat: np.ndarray) -> np.ndarray:
        out = np.full(len(feat), -1, np.int32)
        maybe = np.flatnonzero(seen[(feat >> np.uint64(64 - bits)).astype(np.int64)])
        k = np.minimum(np.searchsorted(hashes, feat[maybe]), len(hashes) - 1)
        ok = hashes[k] == feat[maybe]
        out[maybe[ok]] = k[ok]
        return out

    return find


def _sparse(texts: pa.Array, find) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    data, offsets = A.text_arrays(texts)
    for a, b in A.slices(offsets):
        row, feat, n_words = text_features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        col = find(feat)
        row, col, n = _counts(row[col >= 0], col[col >= 0])
        yield a, b, row, col, n, n_words


def _project(hashes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _known(hashes)
        for batch in batches:
            for a, b, row, col, n, n_words in _sparse(batch["text"], find):
                cut = np.searchsorted(row, np.arange(b - a + 1))
                cols = [col[i:j].astype(np.int32).tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)]
                ns = [n[i:j].astype(np.int32).tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(a, b - a), batch["grade"].slice(a, b - a), pa.array(n_words), pa.array(cols, pa.binary()), pa.array(ns, pa.binary())], ["doc_id", "grade", "n_words", "cols", "counts"])

    return run


def _scores(model: Ordinal, batch: pa.RecordBatch, find) -> np.ndarray:
    out = np.zeros(len(batch))
    for a, b, row, col, n, _ in _sparse(batch["text"], find):
        out[a:b] = np.bincount(row, model.weights[col] * np.log1p(n), b - a)
    return model.above(out)


def judge_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """Severity of docs (doc_id, text), from labels (doc_id, toxic 0 or 1).

    Labels only say 0 or 1; toxic ones are dealt into grades 1 and 2 at the median count of associated features (with a z-score of
    SIGNAL or more), so grade 2 means "more of the same", not a judgement of its own. Bounds of the model, whatever the input: fitted
    from about `sample` labelled rows, with FEATURES features at most, each in LEAST sample rows or more. Ids are whole numbers,
    and anything else is an error. A row out for each row in: doc_id,
    expected_severity (0 to 2), p_toxic (of a grade above 0), grade (the likeliest), toxic (p_toxic >= threshold). Null and
    empty texts have no features. Without labels of both kinds the numbers are null and nothing is toxic. Of a doc_id's
    labels the greatest counts; labels without an id or a grade don't.
    """
    model = fit(docs, labels, F.col("toxic"), 2, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _known(model.features) if model else None
        for batch in batches:
            n = len(batch)
            if model is None:
                yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.nulls(n, pa.float64()), pa.nulls(n, pa.float64()), pa.nulls(n, pa.int32()), pa.array(np.zeros(n, bool))], ["doc_id", "expected_severity", "p_toxic", "grade", "toxic"])
                continue
            p = _scores(model, batch, find)
            c = np.concatenate((np.ones((n, 1)), p, np.zeros((n, 1))), 1)
            grade = np.argmax(c[:, :-1] - c[:, 1:], 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(p.sum(1)), pa.array(p[:, 0]), pa.array(grade), pa.array(p[:, 0] >= threshold)], ["doc_id", "expected_severity", "p_toxic", "grade", "toxic"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(A.tidy(run), f"doc_id {kind}, expected_severity double, p_toxic double, grade int, toxic boolean")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """The rows of docs, with all their columns, that judge_toxicity() doesn't call toxic."""
    model = fit(docs, labels, F.col("toxic"), 2, sample)
    if model is None:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _known(model.features)
        for batch in batches:
            yield batch.filter(pa.array(_scores(model, batch, find)[:, 0] < threshold))

    return docs.mapInArrow(A.tidy(run), docs.schema)
