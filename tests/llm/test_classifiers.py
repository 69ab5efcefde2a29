import zlib

import numpy as np
import pytest

from labrelay.llm import factorisation, toxicity


def auc(scores, y):
    order = np.argsort(scores)
    rank = np.empty(len(scores))
    rank[order] = np.arange(len(scores))
    ones = y.sum()
    return (rank[y == 1].sum() - ones * (ones - 1) / 2) / (ones * (len(y) - ones))


@pytest.mark.parametrize("report,label,least", [(toxicity.toxicity_report, "toxic", 0.97), (factorisation.quality_report, "quality", 0.97)])
def test_held_out_accuracy(spark, sf, report, label, least):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = report(docs, labels).join(labels, "doc_id", "left").collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r[label] is not None]
    y, scores = np.array([r[label] for r in held]), np.array([r.score for r in held])
    assert auc(scores, y) > least, auc(scores, y)
    assert (np.array([r.predicted for r in held]) == y).mean() > 0.96


@pytest.mark.parametrize("report,label,folds,out,cut", [(toxicity.toxicity_report, "toxic", 3, 1, 0.7), (factorisation.quality_report, "quality", 5, 0, 0.3)])
def test_odd_rows_and_small_label_tables(spark, documents, report, label, folds, out, cut):
    import zlib

    rows = [(1, None, "s"), (2, "", "s"), (3, "some words", "s"), (None, "some words", None), (3, "some words", "s"), (4, "word " * 200000, "s")]
    docs = documents(rows)
    for labels in ([], [(3, 1), (None, 1), (1, None), (4, 1)]):
        got = report(docs, spark.createDataFrame(labels, f"doc_id long, {label} int")).collect()
        assert len(got) == len(rows)
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= cut) for r in got)
        assert all(r.held_out == (None if r.doc_id is None else zlib.crc32(str(r.doc_id).encode()) % folds == out) for r in got)
    assert report(docs.limit(0), spark.createDataFrame([], f"doc_id long, {label} int")).count() == 0


def test_machine_equals_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    size = (1 << factorisation.HASH_BITS) + len(factorisation.STATISTICS)
    m = factorisation.Machine(0.3, rng.normal(0, 0.1, size), rng.normal(0, 0.1, (size, factorisation.FACTORS)),
                              np.zeros(len(factorisation.STATISTICS)), np.ones(len(factorisation.STATISTICS)))
    buckets, stats = factorisation.features(b"Some words, some MORE words | 1 2", None)
    x = np.concatenate([np.full(len(buckets), len(buckets) ** -0.5), m.inputs(stats)])
    idx = np.concatenate([buckets, np.arange(1 << factorisation.HASH_BITS, size)])
    z = m.bias + m.w[idx] @ x + sum(m.v[idx[i]] @ m.v[idx[j]] * x[i] * x[j] for i in range(len(idx)) for j in range(i))
    assert m.score(buckets, stats) == pytest.approx(1 / (1 + np.exp(-z)), rel=1e-5)


def test_grams_are_distinct_and_whole_texts_count(monkeypatch):
    grams = toxicity.Grams()
    text = "".join(chr(97 + i % 23) + chr(97 + i % 7) for i in range(3000)) + "END of the text"
    whole = grams(text).tolist()
    monkeypatch.setattr(toxicity, "CHUNK", 50)  # chunks overlap, so no n-gram is lost or made up
    assert grams(text).tolist() == whole and len(set(whole)) == len(whole)
    assert grams(None).tolist() == grams("").tolist() == []
    assert set(grams("the end of").tolist()) < set(grams("x the end of the text").tolist())


@pytest.mark.parametrize("rare", [0, 1])
def test_a_rare_label_is_not_thinned_out(spark, documents, monkeypatch, rare):
    got = []
    monkeypatch.setattr(toxicity, "fit", lambda buckets, lengths, y: got.append(y))
    ids = [i for i in range(3000) if zlib.crc32(str(i).encode()) % toxicity.FOLDS != toxicity.HELD_OUT]
    labels = spark.createDataFrame([(i, rare if k < 8 else 1 - rare) for k, i in enumerate(ids)], "doc_id long, toxic int")
    docs = documents([(i, "some words", "s") for i in ids])
    toxicity.train(docs, labels, max_rows=200)
    assert (got[0] == rare).sum() == 8 and 140 < len(got[0]) < 250
    both = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)], "doc_id long, toxic int")
    toxicity.train(docs, both, max_rows=200)
    assert all(60 < (got[1] == y).sum() < 150 for y in (0, 1))


@pytest.mark.parametrize("module,label,report", [(toxicity, "toxic", toxicity.toxicity_report), (factorisation, "quality", factorisation.quality_report)])
def test_the_fit_is_bounded_by_rows_and_blind_to_their_order(spark, documents, monkeypatch, module, label, report):
    """One id that 20,000 rows share, and two partitionings of the same rows."""
    ids = [i for i in range(2, 900) if zlib.crc32(str(i).encode()) % module.FOLDS != module.HELD_OUT]
    shared = ids[0]
    words = "alpha beta gamma delta eps zeta eta theta".split()
    rows = [(i, " ".join(words[(i * k + k) % 8] + str(i % 5) for k in range(12)), "s") for i in ids]
    rows += [(shared, f"{words[k % 8]} {k}", "s") for k in range(20_000)] + [(ids[1], "the same text", "s")] * 5000
    docs = documents(rows)
    labels = spark.createDataFrame([(i, i % 2) for i in ids], f"doc_id long, {label} int")
    sizes, fit = [], module.fit
    monkeypatch.setattr(module, "fit", lambda *a: sizes.append(len(a[-1])) or fit(*a))
    scores = [sorted((str(r.doc_id), r.score) for r in report(d, labels, max_rows=400).collect())
              for d in (docs.repartition(3), docs.repartition(7, "text").sortWithinPartitions("n_chars"))]
    assert sizes[0] == sizes[1] <= 400 and sizes[0] > 200
    assert scores[0] == scores[1]


def test_toxicity_weights_and_scores_restated():
    """Log-count ratios, a fit of a few rows by plain loops, and scores of present features."""
    rng = np.random.default_rng(2)
    rows = [np.unique(rng.integers(0, 40, 8)) for _ in range(60)]
    y = np.array([int((r < 8).sum() >= 2) for r in rows])
    buckets, lengths = np.concatenate(rows), np.array([len(r) for r in rows])
    model = toxicity.fit_linear(buckets, lengths, y, rounds=12)
    size = 1 << toxicity.HASH_BITS
    one, zero = [0] * 40, [0] * 40
    for r, label in zip(rows, y):
        for f in r:
            (one if label else zero)[f] += 1
    ratio = [0.0] * 40
    for f in range(40):
        x = np.log((one[f] + 1) / (sum(one) + size)) - np.log((zero[f] + 1) / (sum(zero) + size))
        ratio[f] = x if one[f] + zero[f] >= 2 and abs(x) >= toxicity.MIN_RATIO else 0.0
    used = [f for f in range(40) if ratio[f]]
    scale = 1 / np.sqrt(max(1.0, sum(f in used for r in rows for f in r) / len(rows)))
    weight = [0.5 / y.sum() if label else 0.5 / (len(y) - y.sum()) for label in y]
    w, m, v, bias, mb, vb = {f: 0.0 for f in used}, {f: 0.0 for f in used}, {f: 0.0 for f in used}, 0.0, 0.0, 0.0
    for t in range(1, 13):
        err = []
        for r, label, share in zip(rows, y, weight):
            z = bias + scale * sum(w[f] * ratio[f] for f in r if f in w)
            err.append((1 / (1 + np.exp(-z)) - label) * share)
        for f in used:
            g = scale * ratio[f] * sum(e for e, r in zip(err, rows) if f in r) + 0.5 * w[f] / len(rows)
            m[f], v[f] = 0.9 * m[f] + 0.1 * g, 0.999 * v[f] + 0.001 * g * g
        gb = sum(err)
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        for f in used:
            w[f] -= 0.1 * (m[f] / (1 - 0.9 ** t)) / (np.sqrt(v[f] / (1 - 0.999 ** t)) + 1e-8)
        bias -= 0.1 * (mb / (1 - 0.9 ** t)) / (np.sqrt(vb / (1 - 0.999 ** t)) + 1e-8)
    assert used and model.bias == pytest.approx(bias)
    for r in rows:
        z = bias + sum(w[f] * ratio[f] * scale for f in r if f in w)
        assert model.score(r) == pytest.approx(1 / (1 + np.exp(-z)), rel=1e-4)
