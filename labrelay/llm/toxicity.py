"""Toxicity: a linear classifier over character n-grams whose features are scaled
by naive Bayes log-count ratios.

The model is fitted on a bounded sample of labelled documents (``MAX_TRAINING``)
and sent to every task; scoring is one pass over whole texts in Arrow batches.
A feature is present or not, however long the text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASE, crc_fold, fresh, labelled_sample, map_arrow, mix

#: Most labelled documents that the classifier is fitted on: half for each label, and what the other leaves of its half.
MAX_TRAINING = 4_000
NGRAMS = (5, 6)
HASH_BITS = 18
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
#: Parts of the training rows whose scores calibrate the sigmoid.
PARTS = 3
#: Log-count ratios below this are taken as 0.
MIN_RATIO = 1.5
#: Characters hashed at a time.
CHUNK = 1 << 16


class Grams:
    """Distinct hashed character n-grams of a text (lower-cased, white space as one kind)."""

    def __init__(self):
        self.seen = np.zeros(1 << HASH_BITS, bool)

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted bucket numbers; empty for null or empty texts. A text shorter
        than an n-gram has none of that length."""
        text = (text or "").lower()
        longest = max(NGRAMS)
        for at in range(0, len(text), CHUNK):
            part = text[at:at + CHUNK + longest - 1]
            codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
            codes[codes <= 32] = 32
            h = np.zeros(len(codes), np.uint64)
            for n in range(1, longest + 1):
                if n > len(codes):
                    break
                h = h[:len(codes) - n + 1] * np.uint64(BASE) + codes[n - 1:]
                if n in NGRAMS:
                    self.seen[(mix(h + np.uint64(n)) >> np.uint64(64 - HASH_BITS)).astype(np.int64)] = True
        found = np.flatnonzero(self.seen)
        self.seen[found] = False
        return found


class Model:
    """Weight of each bucket and the bias: score = sigmoid(bias + sum of the weights present)."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.astype(np.float32), float(bias)

    def score(self, found: np.ndarray) -> float:
        z = self.bias + float(self.weights[found].sum(dtype=np.float64))
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -40, 40))))


def fit(buckets: np.ndarray, lengths: np.ndarray, y: np.ndarray) -> Model:
    """The calibrated model: a sigmoid of slope and offset is fitted to the scores
    that models of all but one of ``PARTS`` parts give to the rows of that part, so
    ``THRESHOLD`` means the same however few rows there are. ``buckets`` holds the
    features of all rows one after the other, ``lengths`` how many each has."""
    model = fit_linear(buckets, lengths, y)
    y = np.asarray(y, np.float64)
    part = np.arange(len(y)) % PARTS
    filled = lengths > 0
    starts = (np.cumsum(lengths) - lengths)[filled]
    if any(len(np.unique(y[part != k])) < 2 for k in range(PARTS)) or len(np.unique(y)) < 2:
        return model
    z = np.zeros(len(y))
    for k in range(PARTS):
        rest = part != k
        other = fit_linear(buckets[np.repeat(rest, lengths)], lengths[rest], y[rest])
        z[~rest] += other.bias
        if len(starts):
            z[filled & ~rest] += np.add.reduceat(other.weights[buckets], starts)[~rest[filled]]
    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    slope, offset = 1.0, 0.0
    for _ in range(50):  # Newton steps of a logistic regression on one feature
        p = 1.0 / (1.0 + np.exp(-np.clip(slope * z + offset, -40, 40)))
        g, h = (p - y) * weight, p * (1 - p) * weight + 1e-9
        a, b, c = (h * z * z).sum() + 1e-3, (h * z).sum(), h.sum() + 1e-6
        ga, gb = (g * z).sum() + 1e-3 * (slope - 1.0), g.sum()
        det = a * c - b * b
        slope, offset = max(0.1, slope - (c * ga - b * gb) / det), offset - (a * gb - b * ga) / det
    return Model(model.weights * slope, model.bias * slope + offset)


def fit_linear(buckets: np.ndarray, lengths: np.ndarray, y: np.ndarray, rounds: int = 150, l2: float = 0.5,
               rate: float = 0.1) -> Model:
    """NB-scaled logistic regression, both classes weighing the same, by full-batch
    Adam. With no rows, or one class only, a constant model: the smoothed share of
    label 1."""
    size = 1 << HASH_BITS
    y = np.asarray(y, np.float64)
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(size), np.log(share / (1 - share)))
    is_one = np.repeat(y > 0, lengths)
    one = np.bincount(buckets[is_one], minlength=size)
    zero = np.bincount(buckets, minlength=size) - one
    ratio = np.log((one + 1.0) / (one.sum() + size)) - np.log((zero + 1.0) / (zero.sum() + size))
    # Features of one document say nothing that another could confirm; those
    # about as frequent in both classes are scaled to almost nothing.
    ratio[(one + zero < 2) | (np.abs(ratio) < MIN_RATIO)] = 0.0
    keep = ratio[buckets] != 0
    row = np.repeat(np.arange(len(y), dtype=np.int32), lengths)[keep]
    used, idx = np.unique(buckets[keep], return_inverse=True)
    r = ratio[used]
    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    w, bias = np.zeros(len(used)), 0.0
    scale = 1.0 / np.sqrt(max(1.0, len(row) / len(y)))
    m, v, mb, vb = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
    for t in range(1, rounds + 1):
        z = bias + np.bincount(row, weights=(w * r)[idx], minlength=len(y)) * scale
        err = (1.0 / (1.0 + np.exp(-np.clip(z, -40, 40))) - y) * weight
        g = np.bincount(idx, weights=err[row], minlength=len(used)) * r * scale + l2 * w / len(y)
        gb = err.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        c1, c2 = 1 - 0.9 ** t, 1 - 0.999 ** t
        w -= rate * (m / c1) / (np.sqrt(v / c2) + 1e-8)
        bias -= rate * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
    weights = np.zeros(size)
    weights[used] = w * r * scale
    return Model(weights, bias)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = FOLDS, held_out: int = HELD_OUT,
          max_rows: int = MAX_TRAINING) -> Model:
    """Fits on ``max_rows`` labelled documents at most outside the held-out fold: texts
    become sparse features on the executors, which the driver collects and sorts by the
    sample's hash, so that no order of tasks shows in the scores."""
    rows, y, order = labelled_sample(docs.select("doc_id", "text"), labels, label, folds, held_out, max_rows, by_label=True)

    def run(batches):
        grams = Grams()
        for batch in batches:
            found = [grams(t.as_py()).astype(np.int32) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(found, pa.list_(pa.int32()))], names=["y", "at", "f"])

    sample = rows.select("text", F.col(y).alias("y"), F.col(order).alias("at"))
    got = map_arrow(sample, run, "y int, at long, f array<int>").toArrow().sort_by([("at", "ascending"), ("y", "ascending")])
    found = got.column("f").combine_chunks()
    return fit(found.flatten().to_numpy(), pc.list_value_length(found).to_numpy(), got.column("y").to_numpy())


def scored(docs: DataFrame, model: Model, keep: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` of every row, score double (0 to 1) and predicted int (1 from
    ``threshold`` on); a name that ``keep`` holds gets a ``_`` behind it. Null and empty texts get the score of a text without features."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    text, score, predicted = (fresh(keep, c) for c in ("document_text", "score", "predicted"))
    rows = docs.select(*keep, F.col("text").cast("string").alias(text))
    schema = rows.select(*keep, F.lit(0.0).alias(score), F.lit(0).alias(predicted)).schema

    def run(batches):
        grams, fitted = Grams(), sent.value
        for batch in batches:
            scores = np.array([fitted.score(grams(t.as_py())) for t in batch.column(batch.num_columns - 1)], np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(batch.num_columns - 1)]
                + [pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], names=[*keep, score, predicted])

    return map_arrow(rows, run, schema)


def toxicity_report(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING) -> DataFrame:
    """doc_id, held_out, score, predicted of every document (held_out is null for a null id)."""
    model = train(docs, labels, max_rows=max_rows)
    out = scored(docs, model, ["doc_id"])
    return out.select("doc_id", (crc_fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score", "predicted")
