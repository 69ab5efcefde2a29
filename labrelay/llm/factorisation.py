"""Quality classifier: a factorisation machine over hashed words, structure
statistics and metadata.

score = sigmoid(b + sum w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]):
every pair of features interacts, at a cost linear in the features present. The
machine is fitted on a bounded sample of labelled documents (``MAX_TRAINING``)
and sent to every task; scoring is one pass over whole texts in Arrow batches.
"""

from __future__ import annotations

from collections import Counter
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_fold, fresh, labelled_sample, map_arrow, mix, word_chunks

#: Most labelled documents that the machine is fitted on.
MAX_TRAINING = 2_500
HASH_BITS = 14
FACTORS = 6
#: Documents of the sample in which a word must occur to get a weight.
MIN_DOCUMENTS = 4
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
STATISTICS = ("words", "word_length", "upper", "symbols", "digits", "wide", "distinct", "repeats", "top_word",
              "lines", "line_length", "distinct_lines", "bare_symbols", "n_chars")
_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LETTER = _UPPER | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_SYMBOL = (_BYTES > 32) & (_BYTES < 127) & ~_LETTER & ~_DIGIT
_ALL_SYMBOLS = bytes(b for b in range(256) if _SYMBOL[b])


def features(data: bytes | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of the distinct lower-cased words, structure statistics and
    metadata) of a text in UTF-8. A null text counts as empty, a null n_chars as
    the text's length."""
    data = data or b""
    counts: Counter[bytes] = Counter()
    repeats, last = 0, []
    for words in word_chunks(data.lower()):
        counts.update(words)
        repeats += sum(map(eq, last + words, words if last else words[1:]))
        last = words[-1:] or last
    n = sum(counts.values())
    b = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    letters, size = max(1, int(b[_LETTER].sum())), max(1, len(data))
    lines = data.split(b"\n")
    bare = sum(c for w, c in counts.items() if not w.strip(_ALL_SYMBOLS))
    h = np.fromiter(map(crc32, counts), np.uint64, len(counts))
    buckets = np.unique(mix(h) >> np.uint64(64 - HASH_BITS)).astype(np.int32)
    some = max(1, n)
    if n_chars is None:
        n_chars = len(data) - int(b[128:192].sum())
    stats = np.array([
        np.log1p(n), len(data) / some, b[_UPPER].sum() / letters, b[_SYMBOL].sum() / size, b[_DIGIT].sum() / size,
        b[128:].sum() / size, len(counts) / some ** 0.8, repeats / some, max(counts.values(), default=0) / some,
        np.log1p(len(lines)), np.log1p(size / len(lines)), len(set(lines)) / len(lines), bare / some,
        np.log1p(max(0, n_chars)),
    ], np.float32)
    return buckets, stats


class Machine:
    """Weights of hashed words, then of statistics; statistics are standardised and clipped."""

    def __init__(self, bias, w, v, mean, sd):
        self.bias, self.mean, self.sd = float(bias), mean.astype(np.float32), sd.astype(np.float32)
        self.w, self.v = w.astype(np.float32), v.astype(np.float32)

    def inputs(self, stats: np.ndarray) -> np.ndarray:
        return np.clip((stats - self.mean) / self.sd, -4, 4)

    def score(self, buckets: np.ndarray, stats: np.ndarray) -> float:
        x = np.concatenate([np.full(len(buckets), 1.0 / np.sqrt(max(1, len(buckets))), np.float32), self.inputs(stats)])
        idx = np.concatenate([buckets, np.arange(1 << HASH_BITS, (1 << HASH_BITS) + len(stats))])
        xv = self.v[idx] * x[:, None]
        s = xv.sum(0)
        z = self.bias + float(self.w[idx] @ x) + 0.5 * float(s @ s - (xv * xv).sum())
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -40, 40))))


def fit(buckets: np.ndarray, lengths: np.ndarray, stats: np.ndarray, y: np.ndarray, rounds: int = 80,
        l2: float = 1e-4, rate: float = 0.05, seed: int = 3) -> Machine:
    """Both classes weigh the same; full-batch Adam on the logistic loss. With no
    rows, or one class only, a constant machine: the smoothed share of label 1."""
    n, size = len(y), (1 << HASH_BITS) + len(STATISTICS)
    y = np.asarray(y, np.float32)
    share = (y.sum() + 1.0) / (n + 2.0)
    mean = stats.mean(0) if n else np.zeros(len(STATISTICS), np.float32)
    sd = stats.std(0) + 1e-3 if n else np.ones(len(STATISTICS), np.float32)
    zero = Machine(np.log(share / (1 - share)), np.zeros(size), np.zeros((size, FACTORS)), mean, sd)
    if not n or y.min() == y.max():
        return zero
    # Words of very few documents are left at weight 0.
    often = np.bincount(buckets, minlength=1 << HASH_BITS) >= MIN_DOCUMENTS
    row = np.repeat(np.arange(n, dtype=np.int32), lengths)
    keep = often[buckets]
    idx = np.concatenate([buckets[keep], np.tile(np.arange(1 << HASH_BITS, size, dtype=np.int32), n)])
    x = np.concatenate([(1.0 / np.sqrt(np.maximum(1, lengths)))[row[keep]], zero.inputs(stats).ravel()]).astype(np.float32)
    row = np.concatenate([row[keep], np.repeat(np.arange(n, dtype=np.int32), len(STATISTICS))])
    order = np.argsort(row, kind="stable")
    idx, x, row = idx[order], x[order], row[order]
    starts = np.searchsorted(row, np.arange(n))
    by_feature = np.argsort(idx, kind="stable")
    used, first = np.unique(idx[by_feature], return_index=True)
    rng = np.random.default_rng(seed)
    theta = np.zeros((len(used), 1 + FACTORS), np.float32)  # weight, then factors
    theta[:, 1:] = rng.normal(0, 0.05, (len(used), FACTORS))
    at = np.searchsorted(used, idx)
    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (n - y.sum())).astype(np.float32)
    bias, m, v, mb, vb = 0.0, np.zeros_like(theta), np.zeros_like(theta), 0.0, 0.0
    xs = x[:, None]
    for t in range(1, rounds + 1):
        e = theta[at] * xs
        sums = np.add.reduceat(e, starts, axis=0)
        squares = np.add.reduceat((e[:, 1:] ** 2).sum(1), starts)
        z = bias + sums[:, 0] + 0.5 * ((sums[:, 1:] ** 2).sum(1) - squares)
        err = (1.0 / (1.0 + np.exp(-np.clip(z, -40, 40))) - y) * weight
        e[:, 0] = 1.0
        e[:, 1:] = sums[row, 1:] - e[:, 1:]
        e *= (err[row] * x)[:, None]
        g = np.add.reduceat(e[by_feature], first, axis=0) + l2 * theta
        gb = err.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        c1, c2 = 1 - 0.9 ** t, 1 - 0.999 ** t
        theta -= (rate * (m / c1) / (np.sqrt(v / c2) + 1e-8)).astype(np.float32)
        bias -= rate * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
    w, factors = np.zeros(size), np.zeros((size, FACTORS))
    w[used], factors[used] = theta[:, 0], theta[:, 1:]
    return Machine(bias, w, factors, mean, sd)


def _inputs(docs: DataFrame) -> list:
    n_chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return [F.col("text").cast("string").cast("binary").alias("data"), n_chars.alias("chars")]


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS, held_out: int = HELD_OUT,
          max_rows: int = MAX_TRAINING) -> Machine:
    """Fits on ``max_rows`` labelled documents at most outside the held-out fold: texts
    become features on the executors, which the driver collects and sorts by the sample's
    hash, so that no order of tasks shows in the scores."""
    rows, y, order = labelled_sample(docs.select("doc_id", "text", *(c for c in docs.columns if c == "n_chars")), labels,
                                     label, folds, held_out, max_rows)

    def run(batches):
        for batch in batches:
            found = [features(t.as_py(), c.as_py()) for t, c in zip(batch.column(0), batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), batch.column(3), pa.array([f[0] for f in found], pa.list_(pa.int32())),
                 pa.array([f[1] for f in found], pa.list_(pa.float32()))], names=["y", "at", "f", "s"])

    sample = rows.select(*_inputs(rows), F.col(y).alias("y"), F.col(order).alias("at"))
    got = map_arrow(sample, run, "y int, at long, f array<int>, s array<float>").toArrow().sort_by([("at", "ascending"), ("y", "ascending")])
    found, stats = got.column("f").combine_chunks(), got.column("s").combine_chunks()
    return fit(found.flatten().to_numpy(), pc.list_value_length(found).to_numpy(),
               stats.flatten().to_numpy().reshape(-1, len(STATISTICS)), got.column("y").to_numpy())


def scored(docs: DataFrame, machine: Machine, keep: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` of every row, score double (0 to 1) and predicted int (1 from
    ``threshold`` on); null and empty texts are scored as texts without words."""
    sent = docs.sparkSession.sparkContext.broadcast(machine)
    score, predicted = fresh(keep, "score"), fresh(keep, "predicted")
    text, chars = _inputs(docs)
    rows = docs.select(*keep, text.alias(fresh(keep, "data")), chars.alias(fresh(keep, "chars")))
    schema = rows.select(*keep, F.lit(0.0).alias(score), F.lit(0).alias(predicted)).schema

    def run(batches):
        fitted = sent.value
        for batch in batches:
            data, n = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
            scores = np.array([fitted.score(*features(t.as_py(), c.as_py())) for t, c in zip(data, n)], np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(batch.num_columns - 2)]
                + [pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], names=[*keep, score, predicted])

    return map_arrow(rows, run, schema)


def accepted(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all columns) that score ``threshold`` or more."""
    out = scored(docs, train(docs, labels, max_rows=max_rows), docs.columns, threshold)
    return out.where(F.col(out.columns[-1]) == 1).select(*docs.columns)


def quality_report(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING) -> DataFrame:
    """doc_id, held_out, score, predicted of every document (held_out is null for a null id)."""
    out = scored(docs, train(docs, labels, max_rows=max_rows), ["doc_id"])
    return out.select("doc_id", (crc_fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score", "predicted")
