"""Toxicity scores by non-negative positive-unlabelled learning.

Training rows are confirmed toxic texts (P) and texts whose label is not looked
at (U).  With class prior pi, logistic losses l+ and l-, and a linear score,
the corrected risk is

    pi * E_P[l+]  +  max(0, E_U[l-] - pi * E_P[l-])

and, as usual for the estimator, a step is taken against the second term where
it falls below zero.  The classifier is plain numpy over a sparse matrix.

A text's features are the distinct lower-cased words, and word beginnings of 4
to 8 bytes, that it holds, found over the whole text; a feature is in the model
if it turns up in enough P texts and clearly more often there than in U.

Null and empty texts have no features and get the bias alone, as do texts of
unknown words.  Rows are scored one by one without exchange, so repeated rows,
hot keys and further columns need no care.  Without a positive training row the
score is 0 everywhere.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BYTE, COEF, LOWER, chunks, column, give_back, mix, powers, task, text_buffers, word_spans, R, R_INV

STARTS = (4, 5, 6, 7, 8)


def _word_features(data: np.ndarray, offs: np.ndarray):
    """(hashes [words, 6], index of first word per document)."""
    data = LOWER[data]
    # ASCII punctuation at either end of a word is no part of it
    solid = (data >= 0x80) | ((data >= 48) & (data < 58)) | ((data >= 97) & (data < 123))
    start, end, first = word_spans(np.where(solid | (data == 39), data, np.uint8(32)), offs)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE[data] * powers(R, len(data)), out=sums[1:])
    inv = powers(R_INV, len(sums))[start]
    out = np.empty((len(start), len(STARTS) + 1), np.uint64)
    base = sums[start]
    out[:, 0] = mix((sums[end] - base) * inv + COEF[1])
    for k, n in enumerate(STARTS, 1):
        stop = np.minimum(start + n, end)
        h = mix((sums[stop] - base) * inv + COEF[1 + n])
        h[end - start < n] = 0  # too short to have this beginning
        out[:, k] = h
    return out, first


@dataclass
class Model:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float

    def table(self) -> np.ndarray:
        """Whether some feature has these top 20 bits."""
        t = np.zeros(1 << 20, bool)
        t[(self.features >> np.uint64(44)).astype(np.int64)] = True
        return t

    def score(self, data: np.ndarray, offs: np.ndarray, table: np.ndarray) -> np.ndarray:
        n = len(offs) - 1
        z = np.full(n, self.bias)
        if len(self.features) and len(data):
            h, first = _word_features(data, offs)
            row, col = np.nonzero(table[(h >> np.uint64(44)).astype(np.int64)])
            got = h[row, col]
            at = np.minimum(np.searchsorted(self.features, got), len(self.features) - 1)
            hit = self.features[at] == got
            doc = np.searchsorted(first, row[hit], side="right") - 1
            once = np.unique(doc.astype(np.int64) * len(self.features) + at[hit])
            z += np.bincount(once // len(self.features), weights=self.weights[once % len(self.features)], minlength=n)
        return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit_nnpu(indptr, index, n_features, positive, prior, steps=300, rate=0.05, l2=1e-4, seed=1):
    """Full-batch Adam on the corrected risk.  ``positive`` marks P rows, the
    others are U.  Returns weights and bias."""
    n = len(indptr) - 1
    size = np.diff(indptr)
    row = np.repeat(np.arange(n), size)
    w = np.zeros(n_features + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    p_n, u_n = max(1, positive.sum()), max(1, (~positive).sum())
    for t in range(1, steps + 1):
        z = np.bincount(row, weights=w[index], minlength=n) + w[-1]
        s = 1 / (1 + np.exp(-np.clip(z, -40, 40)))  # also the derivative of l-
        loss_neg = np.logaddexp(0, z)
        rest = loss_neg[~positive].sum() / u_n - prior * loss_neg[positive].sum() / p_n
        d = np.zeros(n)
        neg = np.where(positive, -prior * s / p_n, s / u_n)
        if rest >= 0:
            d[positive] += prior * (s[positive] - 1) / p_n
            d += neg
        else:
            d -= neg
        g = np.empty_like(w)
        g[:-1] = np.bincount(index, weights=d[row], minlength=n_features) + l2 * w[:-1]
        g[-1] = d.sum()
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def train(
    docs: DataFrame,
    positives: DataFrame,
    unlabelled: DataFrame,
    prior: float,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_positive: int = 1000,
    max_unlabelled: int = 3000,
    least: int = 3,
) -> Model:
    """Fit on at most ``max_positive`` + ``max_unlabelled`` whole texts, taken
    in the order of a hash of their id (the documented bound of the sample)."""
    ids = (
        positives.select(F.col(id_col).alias("id"), F.lit(True).alias("p"))
        .distinct().orderBy(F.xxhash64("id"), "id").limit(max_positive)
        .unionByName(
            unlabelled.select(F.col(id_col).alias("id"), F.lit(False).alias("p"))
            .distinct().orderBy(F.xxhash64(F.lit("u"), F.col("id")), "id").limit(max_unlabelled)
        )
    )
    # the sample's ids are bounded, so this side may be broadcast
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "id")

    def features(batches):
        for b in chunks(batches, "text", 1 << 20):
            h, first = _word_features(*text_buffers(column(b, "text")))
            blobs = [np.unique(h[i:j]).astype("<u8").tobytes() for i, j in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays([column(b, "p"), pa.array(blobs, pa.binary())], ["p", "f"])

    # stays on the executors: features of one text each; screened there first
    got = rows.mapInArrow(task(features), "p boolean, f binary").toArrow()
    p = np.array(got.column("p").to_pylist(), bool)
    blobs = got.column("f").to_pylist()
    del got
    if not p.any() or not (~p).any():
        return Model(np.zeros(0, np.uint64), np.zeros(0), -40.0)
    by = [np.frombuffer(b, np.uint64) for b in blobs]
    pos = np.concatenate([x for x, y in zip(by, p) if y])
    feat, n_pos = np.unique(pos, return_counts=True)
    keep = (n_pos >= least) & (feat != 0)
    feat, n_pos = feat[keep], n_pos[keep]
    if not len(feat):
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(prior / (1 - prior))))
    n_un = np.zeros(len(feat), np.int64)
    where = []
    for x in by:
        at = np.minimum(np.searchsorted(feat, x), len(feat) - 1)
        at = at[feat[at] == x]
        where.append(at)
    for at, y in zip(where, p):
        if not y:
            n_un[at] += 1
    # share among P against the share among U, by a two-sample z value
    a, b = n_pos / p.sum(), n_un / (~p).sum()
    z = (a - b) / np.sqrt(a * (1 - a) / p.sum() + (b + 1 / (~p).sum()) / (~p).sum())
    good = (z >= 2.0) & (a >= 2 * b)
    new = np.cumsum(good) - 1
    where = [new[at[good[at]]] for at in where]
    indptr = np.concatenate([[0], np.cumsum([len(x) for x in where])])
    index = np.concatenate(where).astype(np.int64)
    del by, pos, blobs, where
    give_back()
    w, bias = fit_nnpu(indptr, index, int(good.sum()), p, prior)
    used = np.abs(w) > 1e-3
    del indptr, index
    give_back()
    return Model(feat[good][used], w[used], bias)


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """The input with a score between 0 and 1."""
    if score_col in docs.columns:
        docs = docs.drop(score_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())])

    def run(batches):
        table = model.table()
        for b in chunks(batches, text_col, 2 << 20):
            s = model.score(*text_buffers(column(b, text_col)), table)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s)], [*b.schema.names, score_col])

    return docs.mapInArrow(task(run), schema)


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0


def from_labels(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", **bounds) -> Model:
    """Train on the labelled rows outside the held-out fold: those marked toxic
    are P, all of them (labels unread) are U, and their share of toxic rows is
    the class prior."""
    seen = labels.where(F.col(id_col).isNotNull() & ~held_out(id_col)).select(id_col, label_col)
    r = seen.agg(F.avg((F.col(label_col) == 1).cast("int")).alias("r")).first()["r"]
    prior = min(0.5, max(0.01, r or 0.01))
    return train(docs, seen.where(F.col(label_col) == 1), seen, prior, id_col=id_col, **bounds)


__all__ = ["Model", "fit_nnpu", "from_labels", "held_out", "score", "train"]
