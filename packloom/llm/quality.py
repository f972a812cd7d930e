"""Quality classifier: a factorisation machine over hashed words, structure statistics and size metadata.

score = sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]), linear in the features.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty
from .labels import fit_rows, held_out
from .wordhash import mixed, parts, slices, word_hashes

WORD_BITS, RANK = 14, 8
#: The fit reads at most so many labelled rows.
MAX_FIT_ROWS = 6000
FOLD = (5, 0)
THRESHOLD = 0.3
#: Statistics: byte classes per byte, then figures of words; each falls in one of BINS bins.
_CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:'\"?-()", b"!", b"#$%&*|~^<>{}[]=+_\\/@`", b"\n", b" ")
BINS = 24
_TABLES = [np.isin(np.arange(256), list(c)).astype(np.int32) for c in _CLASSES] + [(np.arange(256) >= 128).astype(np.int32)]
N_STATS = len(_TABLES) + 4
WIDTH = (1 << WORD_BITS) + N_STATS * BINS


@dataclass
class Model:
    bias: float
    weights: np.ndarray
    factors: np.ndarray


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value) of each feature of each text, in order of row."""
    n = len(texts)
    counts, hashes = word_hashes(texts)
    row_of = np.repeat(np.arange(n), counts)
    # A word's share is taken over whole words, so equal hashes are counted before they are folded into buckets.
    order = np.lexsort((hashes, row_of))
    sorted_rows, sorted_hashes = row_of[order], hashes[order]
    new = np.ones(len(order), bool)
    new[1:] = (sorted_rows[1:] != sorted_rows[:-1]) | (sorted_hashes[1:] != sorted_hashes[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(order)))
    rows = sorted_rows[at]
    buckets = (mixed(sorted_hashes[at]) >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    norm = np.sqrt(np.bincount(rows, times.astype(float) ** 2, n))
    values = times / np.maximum(norm[rows], 1e-9)

    size = np.array([len(t) for t in texts], np.int64)
    raw = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.cumsum(np.append(0, size))
    shares = []
    for table in _TABLES:
        sums = np.concatenate(([0], np.cumsum(table[raw])))
        shares.append(np.diff(sums[bounds]) / np.maximum(size, 1))
    distinct, top = np.bincount(rows, minlength=n), np.zeros(n)
    np.maximum.at(top, rows, times)
    words = np.maximum(counts, 1)
    log_bin = lambda x, step: np.minimum(np.log2(1 + x) * step, BINS - 1)
    share_bin = lambda x: np.where(x <= 0, 0, np.clip(BINS - 1 + 2 * np.log2(np.maximum(x, 1e-9)), 1, BINS - 1))
    bins = [share_bin(x) for x in shares] + [log_bin(counts, 1.5), log_bin(size / words, 4), distinct / words * (BINS - 1), share_bin(top / words)]
    stats = np.stack([(1 << WORD_BITS) + k * BINS + b.astype(np.int64) for k, b in enumerate(bins)], 1)
    rows = np.concatenate([rows, np.repeat(np.arange(n), N_STATS)])
    order = np.argsort(rows, kind="stable")
    return rows[order], np.concatenate([buckets, stats.ravel()])[order], np.concatenate([values, np.full(n * N_STATS, N_STATS**-0.5)])[order]


def raw_scores(model: Model, rows: np.ndarray, feats: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Scores before the sigmoid; every row has features (the statistics), so reduceat is safe."""
    if not n:
        return np.zeros(0)
    at = np.searchsorted(rows, np.arange(n))
    vx = model.factors[feats] * values[:, None]
    linear = np.add.reduceat(model.weights[feats] * values, at)
    return model.bias + linear + 0.5 * ((np.add.reduceat(vx, at) ** 2).sum(1) - np.add.reduceat((vx**2).sum(1), at))


def fit(samples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 10, rate: float = 0.15, decay: float = 1e-4, seed: int = 7) -> Model:
    """Adagrad on the log loss; samples are (features, values, label). Without both labels: the prior alone."""
    rng = np.random.default_rng(seed)
    y = np.array([s[2] for s in samples], float)
    share = (y.sum() + 1) / (len(y) + 2)
    model = Model(float(np.log(share / (1 - share))), np.zeros(WIDTH), rng.normal(0, 0.05, (WIDTH, RANK)))
    if len(set(y)) < 2:
        model.factors[:] = 0
        return model
    gw, gv, gb = np.full(WIDTH, 1e-2), np.full((WIDTH, RANK), 1e-2), 1e-2
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(samples)), max(1, len(samples) // 32)):
            feats = np.concatenate([samples[i][0] for i in part])
            values = np.concatenate([samples[i][1] for i in part]).astype(float)
            rows = np.repeat(np.arange(len(part)), [len(samples[i][0]) for i in part])
            error = 1 / (1 + np.exp(-raw_scores(model, rows, feats, values, len(part)))) - y[part]
            at = np.searchsorted(rows, np.arange(len(part)))
            vx = model.factors[feats] * values[:, None]
            sums = np.add.reduceat(vx, at)
            scale = (error / len(part))[rows] * values
            used, place = np.unique(feats, return_inverse=True)
            dw = np.bincount(place, scale) + decay * model.weights[used]
            dv = np.stack([np.bincount(place, scale * (sums[rows, f] - vx[:, f])) for f in range(RANK)], 1) + decay * model.factors[used]
            db = error.mean()
            gw[used] += dw**2
            gv[used] += dv**2
            gb += db**2
            model.weights[used] -= rate * dw / np.sqrt(gw[used])
            model.factors[used] -= 0.3 * rate * dv / np.sqrt(gv[used])
            model.bias -= rate * db / np.sqrt(gb)
    return model


def _featurised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in parts(batches):
        texts, ys = batch.column(0).to_pylist(), batch.column(1)
        for a, b in slices(texts):
            rows, feats, values = features([t.encode() for t in texts[a:b]])
            at = np.searchsorted(rows, np.arange(b - a + 1))
            cells = lambda x, kind: pa.array([x[i:j].astype(kind).tobytes() for i, j in zip(at[:-1], at[1:], strict=True)], pa.binary())  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([cells(feats, "<u4"), cells(values, "<f4"), ys[a:b]], ["feats", "vals", "y"])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", fold: tuple[int, int] = FOLD, most: int = MAX_FIT_ROWS) -> Model:
    """A model of at most `most` labelled rows outside the fold; their features alone come to the driver."""
    rows = fit_rows(docs, labels, label, *fold, most).select("text", "y")
    found = rows.mapInArrow(_featurised, "feats binary, vals binary, y int").collect()
    samples = sorted((bytes(r[0]), bytes(r[1]), r[2]) for r in found)
    return fit([(np.frombuffer(a, "<u4").astype(np.int64), np.frombuffer(b, "<f4"), y) for a, b, y in samples])


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in parts(batches):
            texts, scores = batch.column(1).to_pylist(), [np.zeros(0)]
            for a, b in slices(texts):
                rows, feats, values = features([t.encode() for t in texts[a:b]])
                scores.append(raw_scores(model, rows, feats, values, b - a))
            score = 1 / (1 + np.exp(-np.clip(np.concatenate(scores), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], ["doc_id", "score"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of every whole text; null and empty texts are scored by their statistics."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(_scored(docs.sparkSession.sparkContext.broadcast(model)), "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, fold: tuple[int, int] = FOLD, threshold: float = THRESHOLD, most: int = MAX_FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs.

    Null text: empty. A null doc_id is scored, not learned from. Repeated rows are scored each. Without labels of
    both kinds every score is the smoothed share of good labels (a half without any). No rows: none.
    """
    out = score(docs, train(docs, labels, "quality", fold, most))
    return out.select("doc_id", held_out(*fold).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
