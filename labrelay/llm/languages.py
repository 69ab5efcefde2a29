"""Language identification by hierarchical discrimination.

A text's family is predicted first: one linear support vector machine for each
family against the others. Within the family one-versus-one machines separate the
languages; each pair votes, and the sum of the margins breaks ties. All
machines see the same features, hashed character 1- to 3-grams of words, damped by
the square root and of length one. They are fitted by dual coordinate descent on a
bounded sample and sent to every task; prediction is one pass over whole
texts in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASE, bounded_sample, crc_fold, fresh, map_arrow, mix

#: Most documents that the machines are fitted on, shared evenly by the languages.
MAX_TRAINING = 4_000
#: Most languages learned, the most frequent ones.
MAX_LANGUAGES = 200
HASH_BITS = 13
FOLDS, HELD_OUT = 5, 0
#: The sample's parts whose margins, given by machines of the others, calibrate the scores.
PARTS = 3
#: Characters hashed at a time, and texts whose counts are held at a time.
CHUNK, TEXTS = 1 << 18, 64
UNKNOWN = "und"

#: Families of languages by their ISO 639 codes. A language that is not here is a family of its own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sh sk sl sr uk",
    "baltic": "lt lv",
    "uralic": "et fi hu",
    "celtic": "br cy ga gd",
    "turkic": "az kk ky tk tr tt ug uz",
    "indo-aryan": "bn gu hi mr ne pa si ur",
    "iranian": "fa ku ps tg",
    "dravidian": "kn ml ta te",
    "semitic": "am ar he mt",
    "sinitic": "wuu yue zh",
    "austronesian": "id jv mg ms su tl",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
_IS_LETTER: list[np.ndarray] = []


def family(lang: str) -> str:
    """The family of a language by its code, region and script left out."""
    code = lang.lower().replace("_", "-").split("-")[0]
    return _FAMILY.get(code, f"={lang}")


def letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text, 0 for what is no letter."""
    if not _IS_LETTER:
        _IS_LETTER.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    codes = np.where(codes == 0x3C2, 0x3C3, codes)  # a sigma's form depends on what follows it
    return np.where(_IS_LETTER[0][codes], codes, 0).astype(np.uint64)


def pieces(text: str | None) -> Iterator[np.ndarray]:
    """The letters of a text in pieces that begin and end with 0 and cut no word."""
    text = text or ""
    rest = np.zeros(1, np.uint64)
    for at in range(0, len(text), CHUNK):
        codes = np.concatenate([rest, letters(text[at:at + CHUNK])])
        end = len(codes) - int(np.argmax(codes[::-1] == 0))
        yield codes[:end]
        rest = codes[end - 1:]
    yield np.append(rest, np.uint64(0))


def gram_counts(codes: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Hashed n-grams of words with the 0 on either side, counted for each row."""
    counts = np.zeros(rows << HASH_BITS)
    letter = codes > 0
    h = codes
    for n, whole in ((1, letter), (2, letter[:-1] | letter[1:]), (3, letter[1:-1])):  # no 0 but at the ends, and a letter
        if n > 1:
            h = h[:-1] * np.uint64(BASE) + codes[n - 1:]
        slot = (mix(h[whole] + np.uint64(n)) >> np.uint64(64 - HASH_BITS)).astype(np.int64)
        counts += np.bincount((row[n - 1:][whole] << HASH_BITS) + slot, minlength=len(counts))
    return counts.reshape(rows, -1)


def vectors(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Features of all texts, one row each, a block of rows at a time: the square roots of
    the counts, of length one; all 0 for null texts and texts without a letter."""
    block, size, rows = [], 0, 0
    counts: np.ndarray | None = None

    def add():
        nonlocal counts, block, size
        if block:
            row = np.repeat([r for r, _ in block], [len(p) for _, p in block])
            got = gram_counts(np.concatenate([p for _, p in block]), row, TEXTS)
            counts = got if counts is None else counts + got
        block, size = [], 0

    for k, text in enumerate(texts):
        for piece in pieces(text):
            block.append((rows, piece))
            size += len(piece)
            if size >= CHUNK:
                add()
        rows += 1
        if rows == TEXTS or k + 1 == len(texts):
            add()
            x = np.sqrt(counts[:rows])
            yield x / np.maximum(np.sqrt(counts[:rows].sum(1)), 1)[:, None]
            counts, rows = None, 0


class Sparse:
    """Rows of features as (buckets, values) one after the other."""

    def __init__(self, buckets: np.ndarray, values: np.ndarray, lengths: np.ndarray):
        self.buckets, self.values, self.start = buckets, values, np.concatenate([[0], np.cumsum(lengths)])

    def margins(self, rows: np.ndarray, w: np.ndarray) -> np.ndarray:
        return np.array([w[b] @ v for b, v in map(self.row, rows)]) + w[-1]

    def row(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(self.start[i], self.start[i + 1])
        return self.buckets[at], self.values[at]


def fit_svm(x: Sparse, rows: np.ndarray, sign: np.ndarray, cost: float = 10.0, rounds: int = 30, seed: int = 11) -> np.ndarray:
    """Weights, the bias last, of a linear support vector machine with squared hinge
    loss for labels +1 and -1, both weighing the same: dual coordinate descent until
    no step moves, ``rounds`` at most."""
    w = np.zeros((1 << HASH_BITS) + 1)
    n = {s: max(1, int((sign == s).sum())) for s in (1, -1)}
    diagonal = np.array([n[int(s)] / (cost * len(rows)) for s in sign])  # 1 / (2 C), C by the label's share
    alpha = np.zeros(len(rows))
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        most = 0.0
        for i in rng.permutation(len(rows)):
            b, v = x.row(rows[i])
            s = sign[i]
            g = s * (w[b] @ v + w[-1]) - 1 + diagonal[i] * alpha[i]
            if alpha[i] == 0 and g >= 0:
                continue
            most = max(most, abs(g))
            step = max(alpha[i] - g / (2.0 + diagonal[i]), 0.0) - alpha[i]  # a row and its bias have length 1 each
            alpha[i] += step
            w[b] += step * s * v
            w[-1] += step * s
        if most < 0.05:
            break
    return w


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def calibrated(x: Sparse, rows: np.ndarray, sign: np.ndarray) -> tuple[np.ndarray, float, float]:
    """A machine fitted on all rows, and the slope and offset of the sigmoid that turns
    its margins into the chance of +1, fitted on margins of rows not seen."""
    w = fit_svm(x, rows, sign)
    part = np.empty(len(rows), np.int64)
    for s in (1, -1):  # both labels in every part
        part[sign == s] = np.arange((sign == s).sum()) % PARTS
    z = np.empty(len(rows))
    for k in range(PARTS):
        rest = part != k
        other = fit_svm(x, rows[rest], sign[rest]) if len(np.unique(sign[rest])) == 2 else w
        z[~rest] = x.margins(rows[~rest], other)
    n = {s: (sign == s).sum() for s in (1, -1)}
    y = np.where(sign > 0, (n[1] + 1) / (n[1] + 2), 1 / (n[-1] + 2))  # smoothed, so that separable rows give no 0 or 1
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(slope * z + offset)
        g, h = p - y, p * (1 - p) + 1e-6
        a, b, c = (h * z * z).sum() + 1e-3, (h * z).sum(), h.sum()
        ga, gb = (g * z).sum() + 1e-3 * (slope - 1), g.sum()
        det = a * c - b * b + 1e-12
        slope, offset = max(0.1, slope - (c * ga - b * gb) / det), offset - (a * gb - b * ga) / det
    return w, slope, offset


class Model:
    """Machines of the families, and of the pairs of languages within each."""

    def __init__(self, x: Sparse, langs: list[str]):
        self.langs = sorted(set(langs))
        self.families = sorted({family(v) for v in self.langs})
        lang, names = np.array(langs, object), np.array([family(v) for v in langs], object)
        every = np.arange(len(langs))
        machines = []
        if len(self.families) > 1:
            machines = [calibrated(x, every, np.where(names == f, 1, -1)) for f in self.families]
        self.pairs = [(i, j) for j in range(len(self.langs)) for i in range(j) if family(self.langs[i]) == family(self.langs[j])]
        for i, j in self.pairs:
            rows = every[(lang == self.langs[i]) | (lang == self.langs[j])]
            machines.append(calibrated(x, rows, np.where(lang[rows] == self.langs[i], 1, -1)))
        self.w = np.array([m[0] for m in machines]).reshape(len(machines), (1 << HASH_BITS) + 1)
        self.slope, self.offset = (np.array([m[k] for m in machines]) for k in (1, 2))

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """(language, score) of each row of features; (``UNKNOWN``, 0) of a row of zeros, or with nothing learned."""
        out, score = [UNKNOWN] * len(x), np.zeros(len(x))
        if not self.langs:
            return out, score
        z = x @ self.w[:, :-1].T + self.w[:, -1]
        p = sigmoid(z * self.slope + self.offset)
        first = len(self.families) if len(self.families) > 1 else 0
        for k in np.flatnonzero(x.any(1)):
            chosen = int(np.argmax(z[k, :first])) if first else 0
            sure = p[k, chosen] if first else 1.0
            member = [i for i, v in enumerate(self.langs) if family(v) == self.families[chosen]]
            votes, sums, chance = {i: 0 for i in member}, {i: 0.0 for i in member}, {i: [] for i in member}
            for at, (i, j) in enumerate(self.pairs, first):
                if i in votes:
                    votes[i if z[k, at] >= 0 else j] += 1
                    sums[i] += z[k, at]
                    sums[j] -= z[k, at]
                    chance[i].append(p[k, at])
                    chance[j].append(1 - p[k, at])
            best = max(member, key=lambda i: (votes[i], sums[i], -i))
            out[k], score[k] = self.langs[best], sure * (np.mean(chance[best]) if chance[best] else 1.0)
        return out, score


def train(docs: DataFrame, max_rows: int = MAX_TRAINING) -> Model:
    """Fits on ``max_rows`` documents at most outside the held-out fold, each of the
    ``MAX_LANGUAGES`` most frequent languages having the same share at most; rows without
    id, text or language are left out. Texts become features on the executors."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & (crc_fold(F.col("doc_id"), FOLDS) != HELD_OUT) & F.col("text").isNotNull())
    counted = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    each = max(1, max_rows // max(1, len(counted)))
    picked, order = bounded_sample(rows, "lang", {r["lang"]: (r["count"], each) for r in counted})

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for at, x in zip(range(0, batch.num_rows, TEXTS), vectors(batch.column(0).to_pylist())):
                found = [np.flatnonzero(r).astype(np.int32) for r in x]
                rest = [batch.column(c).slice(at, len(x)) for c in (1, 2)]
                yield pa.RecordBatch.from_arrays(
                    [*rest, pa.array(found, pa.list_(pa.int32())), pa.array([r[f].astype(np.float32) for r, f in zip(x, found)], pa.list_(pa.float32()))],
                    names=["lang", "at", "f", "v"])

    sent = picked.select("text", "lang", F.col(order).alias("at"))
    got = map_arrow(sent, run, "lang string, at long, f array<int>, v array<float>").toArrow().sort_by([("at", "ascending"), ("lang", "ascending")])
    got = got.filter(pc.greater(pc.list_value_length(got.column("f")), 0))
    f, v = (got.column(c).combine_chunks() for c in "fv")
    x = Sparse(f.flatten().to_numpy(), v.flatten().to_numpy().astype(np.float64), pc.list_value_length(f).to_numpy())
    return Model(x, got.column("lang").to_pylist())


def identified(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` of every row, lang_pred string and score double (0 to 1); a name that
    ``keep`` holds gets a ``_`` behind it. Null texts, texts without a letter, and all
    texts if nothing was learned are ``und`` with score 0."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    pred, score = fresh(keep, "lang_pred"), fresh(keep, "score")
    rows = docs.select(*keep, F.col("text").cast("string").alias(fresh(keep, "document_text")))
    schema = rows.select(*keep, F.lit("").alias(pred), F.lit(0.0).alias(score)).schema

    def run(batches: Iterator[pa.RecordBatch]):
        fitted = sent.value
        for batch in batches:
            langs, scores = [], []
            for x in vectors(batch.column(batch.num_columns - 1).to_pylist()):
                got = fitted.predict(x)
                langs.extend(got[0])
                scores.append(got[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(batch.num_columns - 1)]
                + [pa.array(langs, pa.string()), pa.array(np.concatenate(scores) if scores else np.empty(0))], names=[*keep, pred, score])

    return map_arrow(rows, run, schema)


def language_report(docs: DataFrame, max_rows: int = MAX_TRAINING) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document (held_out is null for a null id)."""
    out = identified(docs, train(docs, max_rows), ["doc_id"])
    return out.select("doc_id", (crc_fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
