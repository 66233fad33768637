"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled good; all documents, whatever their label, are
the unlabelled sample.  A linear score z of a document's features minimises the
non-negative risk (logistic loss l, class prior p)

    p E_P[l(z)] + max(0, E_U[l(-z)] - p E_P[l(-z)])

so no negative label is read.  Each of the two sides of the maximum is convex; a Newton
step on the unbiased risk is halved until the non-negative risk falls, so a step that
would drive the estimate of the negatives' risk below zero is not taken.

The prior is estimated from the same two samples.  A first fit with the prior ``FIRST``
ranks documents by the ratio of positive to unlabelled density.  A set that holds no
negatives has p times as large a share of U as of P, any other a larger one, so the prior
is the least ratio of the two shares over the sets ``z >= t`` that hold at least ``LEAST_SHARE`` of P.

Features tell no language or topic: shares of byte-class pairs (lower, upper, digit,
space, line end, sentence mark, other mark, beyond ASCII), and of repeated and distinct
words and word triples.  They are stored once, some 300 bytes a document; each step of the
fit is one pass over them in which a task returns one set of sums, added up in ``SEGMENTS``
tasks, so what the driver gets has one size.  All documents and all positives count.

Null texts count as empty; an empty text has zero shares and a score like any other.
Labels of an id that is null or held out, or that has a label other than 1 too, are no
positives.  Rows are independent, so repeated rows and ties need no rule; without positives
or documents the score is ``FIRST`` for all.  Texts of any length are read whole.  Further
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import words as W
from .util import few, slices, utf8

FIRST = 0.5
THRESHOLD = 0.7
PENALTY = 1e-3
STEPS = 25
LEAST_GAIN = 1e-7
BINS = 2000                 # of scores, where the prior is read
LEAST_SHARE = 0.95          # of the positives, in a set that tells the prior
SEGMENTS = 16
SLICE = 1 << 20             # bytes of text at once
LABELS = 1 << 20            # labelled ids, 8 bytes each, that are broadcast; more are joined by a shuffle

CLASSES = 8
_CLASS = np.full(256, 6, np.uint8)                      # other marks
for _i, _chars in enumerate(["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\v\f\r", "\n", ".,;:?!"]):
    _CLASS[list(_chars.encode())] = _i
_CLASS[128:] = 7
WORD_FEATURES = 6
WIDTH = CLASSES * CLASSES + WORD_FEATURES + 1           # and a constant


def in_fold(doc_id: Column) -> Column:
    """False for rows whose labels are held out."""
    return F.crc32(doc_id.cast("string")) % 4 != 2


def _pairs(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of byte-class pairs in each row, a chunk of bytes at a time."""
    rows, out = len(offsets) - 1, np.zeros((len(offsets) - 1) * CLASSES * CLASSES)
    for lo in range(int(offsets[0]), int(offsets[-1]) - 1, SLICE):
        hi = min(lo + SLICE, int(offsets[-1]) - 1)       # pairs that begin in [lo, hi)
        kind = _CLASS[data[lo:hi + 1]].astype(np.int64)
        row = np.searchsorted(offsets, np.arange(lo, hi + 1), "right") - 1
        same = row[1:] == row[:-1]
        out += np.bincount((row[:-1] * CLASSES * CLASSES + kind[:-1] * CLASSES + kind[1:])[same], minlength=len(out))
    return out.reshape(rows, -1)


def _runs(row: np.ndarray, h: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row: distinct hashes, the largest count of one, and items whose hash comes twice."""
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (h[1:] != h[:-1])])) if len(h) else np.zeros(0, np.int64)
    count, of = np.diff(np.concatenate([first, [len(h)]])), row[first]
    most = np.zeros(rows)
    np.maximum.at(most, of, count)
    return np.bincount(of, minlength=rows), most, np.bincount(of, count * (count > 1), rows)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A vector of ``WIDTH`` numbers for each text ``data[offsets[i]:offsets[i + 1]]``."""
    rows = len(offsets) - 1
    pairs = _pairs(data, offsets)
    w = W.split(data, offsets)
    n = np.bincount(w.row, minlength=rows)
    again = (w.hash[1:] == w.hash[:-1]) & (w.row[1:] == w.row[:-1])
    distinct, most, _ = _runs(w.row, w.hash, rows)
    at, triple = W.ngrams(w, 3)
    _, _, repeated = _runs(w.row[at], triple, rows)
    per = np.maximum(n, 1)
    by_word = [np.log1p(n), np.bincount(w.row, w.chars, rows) / per, np.bincount(w.row[1:], again, rows) / per,
               np.log1p(distinct) / np.log1p(per), np.sqrt(most / per), np.sqrt(repeated / np.maximum(n - 2, 1))]
    shares = np.sqrt(pairs / np.maximum(pairs.sum(axis=1, keepdims=True), 1))
    return np.column_stack([shares, *by_word, np.ones(rows)]).astype(np.float32)


def feature_table(docs: DataFrame, positives: DataFrame) -> DataFrame:
    """(id, x, positive) of ``docs`` (id, text), stored; ``positives`` has distinct ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = utf8(batch.column(1))
            for lo, hi in slices(offsets, SLICE):
                x = features(data, offsets[lo:hi + 1])
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.array([v.tobytes() for v in x], pa.binary())], ["id", "x"])

    kind = docs.schema["id"].dataType.simpleString()
    made = docs.select("id", "text").mapInArrow(run, f"id {kind}, x binary")
    marked = few(materialize(positives.select("id", F.lit(True).alias("positive"))), LABELS)
    return materialize(made.join(marked, "id", "left").withColumn("positive", F.col("positive").isNotNull()))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(len(column), -1).astype(np.float64)


def _sums(table: DataFrame, sums) -> np.ndarray:
    """``sums(x, positive)``, one array for each batch, added up over all rows of the table."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = sums(_matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False).astype(bool))
                total = part if total is None else total + part
        if total is not None:
            yield emit(dict(enumerate(np.array_split(total, SEGMENTS))))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, x in zip(*(c.to_pylist() for c in batch.columns)):
                part = np.frombuffer(x, np.float64)
                total[i] = total[i] + part if i in total else part
        if total:
            yield emit(total)

    def emit(parts: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int32()), pa.array([x.tobytes() for x in parts.values()], pa.binary())], ["i", "x"])

    parts = table.select("x", "positive").mapInArrow(add, "i int, x binary").repartition(SEGMENTS, "i").mapInArrow(merge, "i int, x binary").collect()
    return np.concatenate([np.frombuffer(r["x"], np.float64) for r in sorted(parts, key=lambda r: r["i"])]) if parts else np.zeros(0)


def _loss(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, -z)


class Model:
    """Weights of standardised features."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray):
        self.mean, self.scale, self.weight, self.prior = mean, scale, np.zeros(len(mean)), FIRST

    def standard(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.standard(x) @ self.weight, -500, 500)))


def risk(sums: dict, prior: float) -> tuple[float, float]:
    """The non-negative risk, and the estimated risk of the negatives."""
    negative = sums["u"] - prior * sums["p_as_negative"]
    return prior * sums["p"] + max(0.0, negative), negative


def _at(table: DataFrame, model: Model, weight: np.ndarray, n: tuple[float, float]) -> dict:
    """Mean losses, gradient and curvature at ``weight``; ``n`` counts all rows and positives."""
    d = len(weight)

    def sums(x: np.ndarray, positive: np.ndarray) -> np.ndarray:
        x = model.standard(x)
        z = x @ weight
        s = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        own = z[positive]
        return np.concatenate([[_loss(-z).sum(), _loss(own).sum(), _loss(-own).sum()], s @ x, x[positive].sum(axis=0),
                               ((x * (s * (1 - s))[:, None]).T @ x).ravel()])

    out = _sums(table, sums)
    return {"u": out[0] / n[0], "p": out[1] / n[1], "p_as_negative": out[2] / n[1], "u_slope": out[3:3 + d] / n[0],
            "p_mean": out[3 + d:3 + 2 * d] / n[1], "curve": out[3 + 2 * d:].reshape(d, d) / n[0]}


def descend(table: DataFrame, model: Model, prior: float, n: tuple[float, float]) -> None:
    """Fit ``model.weight``: Newton steps on the unbiased risk that lower the non-negative one."""
    ridge = np.full(len(model.weight), PENALTY)
    ridge[-1] = 1e-9  # the constant
    full = lambda sums, w: risk(sums, prior)[0] + 0.5 * float(ridge @ (w * w))
    now = _at(table, model, model.weight, n)
    value = full(now, model.weight)
    for _ in range(STEPS):
        slope = now["u_slope"] - prior * now["p_mean"] + ridge * model.weight
        step = np.linalg.solve(now["curve"] + np.diag(ridge + 1e-9), slope)
        step *= min(1.0, 20.0 / max(np.linalg.norm(step), 1e-12))
        for half in range(8):
            weight = model.weight - step / 2 ** half
            there = _at(table, model, weight, n)
            if full(there, weight) < value:
                break
        else:
            return
        gain, value = value - full(there, weight), full(there, weight)
        model.weight, now = weight, there
        if gain < LEAST_GAIN:
            return


def estimate_prior(table: DataFrame, model: Model, n: tuple[float, float]) -> float:
    """The least ratio of U's to P's share among the sets of highest scores that hold ``LEAST_SHARE`` of P."""
    def sums(x: np.ndarray, positive: np.ndarray) -> np.ndarray:
        at = np.minimum((model.score(x) * BINS).astype(np.int64), BINS - 1)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at[positive], minlength=BINS)]).astype(np.float64)

    both = _sums(table, sums).reshape(2, BINS)[:, ::-1].cumsum(axis=1)
    u, p = both[0] / n[0], both[1] / n[1]
    enough = p >= LEAST_SHARE
    return float(np.clip((u[enough] / p[enough]).min(), 0.01, 0.99))


def learn(table: DataFrame) -> Model:
    """Fit on a stored feature table: standardise, rank, estimate the prior, minimise the risk."""
    moments = _sums(table, lambda x, positive: np.concatenate([[len(x), positive.sum()], x.sum(axis=0), (x * x).sum(axis=0)]))
    if not len(moments) or not moments[1]:
        return Model(np.zeros(WIDTH), np.ones(WIDTH))
    n = (moments[0], moments[1])
    mean, square = moments[2:].reshape(2, -1) / n[0]
    scale = np.sqrt(np.maximum(square - mean * mean, 0))
    scale[scale < 1e-6] = 1.0
    mean[-1], scale[-1] = 0.0, 1.0
    model = Model(mean, scale)
    descend(table, model, FIRST, n)
    model.prior = estimate_prior(table, model, n)
    model.weight = np.zeros(len(mean))
    descend(table, model, model.prior, n)
    return model


def quality_scores(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(id, held_out, score, predicted) of each row; ``labels`` has the id and ``label_col``."""
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).where("id is not null and y is not null").where(in_fold(F.col("id")))
    positives = known.groupBy("id").agg(F.min("y").alias("low"), F.max("y").alias("high")).where("low = 1 and high = 1")
    table = feature_table(docs, positives)
    model = learn(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(_matrix(batch.column(1))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], ["id", "score"])

    scored = table.select("id", "x").mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, score double")
    return scored.select(F.col("id").alias(id_col), F.coalesce(~in_fold(F.col("id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
