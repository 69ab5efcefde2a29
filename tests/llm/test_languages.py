import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from labrelay.llm import languages
from labrelay.llm.common import table

WORDS = {"en": "the with thing which house they", "de": "und nicht schön straße über die", "fr": "où très être nous voilà une",
         "es": "niño mañana señor qué una los", "fi": "yötä hyvää minä että kyllä päivää", "": "qxz zxq qqx"}


def made(lang, seed, n=12):
    rng = random.Random(f"{lang}{seed}")
    return " ".join(rng.choice(WORDS[lang].split()) for _ in range(n))


def test_held_out_accuracy(spark, sf):
    docs = table(spark, sf, "documents")
    rows = languages.language_report(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.lang and r.lang_pred != "und"]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97 and len(held) > 1500


def test_languages_without_a_family_and_odd_rows(spark):
    rows = [(k, made(v, k), v) for k in range(300) for v in WORDS]
    rows = [(i, t, v) for i, (_, t, v) in enumerate(rows)]
    odd = [(None, made("de", 1), "fr"), (1, None, "en"), (1, "", None), (7, "12 ### \n", "de"), (8, "a" * 600000, None), (9, "ΣΣ Ǆ İ", "xx"),
           (9, "ΣΣ Ǆ İ", "xx")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").selectExpr("*", "'x' as lang_pred", "2 as score", "3 as document_text")
    got = languages.language_report(docs).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (None if r.doc_id is None else zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    langs = {r.doc_id: r.lang_pred for r in got if r.doc_id and r.doc_id >= 10}
    assert np.mean([langs[i] == v for i, _, v in rows if i >= 10]) > 0.99
    assert set(langs.values()) == set(WORDS)
    seen = [(r.doc_id, r.lang_pred) for r in got]
    assert seen.count((1, "und")) == 2 and (7, "und") in seen
    model = languages.train(docs)
    wide = languages.identified(docs, model, docs.columns)
    assert wide.columns == [*docs.columns, "lang_pred_", "score_"] and wide.where("lang_pred = 'x'").count() == len(got)


def test_nothing_to_learn(spark, documents):
    docs = documents([(1, "words", "s"), (2, None, "s")]).withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in languages.language_report(docs).collect()} == {("und", 0.0)}
    assert languages.language_report(docs.limit(0)).count() == 0
    one = documents([(k, "words of one language", "s") for k in range(20)])
    assert {r.lang_pred for r in languages.language_report(one).collect()} == {"en"}


def test_the_sample_is_bounded_and_the_order_of_rows_does_not_matter(spark, monkeypatch):
    rows = [(1, made("en", k), "en") for k in range(3000)] + [(k, made("de", k), "de") for k in range(2, 400)] + [(6, "und so", "de")] * 3000
    rows += [(k, made("fr", k), "fr") for k in range(3, 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    real = languages.Model
    monkeypatch.setattr(languages, "Model", lambda x, langs: seen.append((x, langs)) or real(x, langs))
    models = [languages.train(d, 150) for d in (df.repartition(3), df.repartition(7, "text").sortWithinPartitions("text"))]
    assert all(seen[0][1].count(v) <= 50 for v in ("en", "de", "fr")) and 100 < len(seen[0][1]) <= 150
    assert seen[0][1] == seen[1][1] and np.array_equal(models[0].w, models[1].w)


def test_features_of_pieces_are_those_of_the_whole(monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abΣé  .\n1Ж") for _ in range(rng.randint(0, 400))) for _ in range(150)] + [None, "", "x" * 999]
    whole = np.concatenate(list(languages.vectors(texts)))
    monkeypatch.setattr(languages, "CHUNK", 37)
    monkeypatch.setattr(languages, "TEXTS", 10)
    assert np.allclose(np.concatenate(list(languages.vectors(texts))), whole)
    length = np.sqrt((whole ** 2).sum(1))
    assert np.allclose(length[length > 0], 1)
    words = [w for w in "".join(c if c.isalpha() else " " for c in texts[0].lower()).split()]
    grams = {g for w in words for n in (1, 2, 3) for i in range(len(f" {w} ") - n + 1) if (g := f" {w} "[i:i + n]).strip()}
    assert 0 < (whole[0] > 0).sum() <= len(grams)


def test_the_machine_minimises_its_loss():
    rng = np.random.default_rng(5)
    n, size = 60, 1 << languages.HASH_BITS
    dense = np.zeros((n, size))
    dense[:, :8] = rng.random((n, 8))
    dense /= np.sqrt((dense ** 2).sum(1))[:, None]
    sign = np.where(dense[:, 0] + rng.normal(0, 0.1, n) > dense[:, 1], 1, -1)
    x = languages.Sparse(np.tile(np.arange(8), n), dense[:, :8].ravel(), np.full(n, 8))
    w = languages.fit_svm(x, np.arange(n), sign, rounds=500)

    def loss(w):
        share = np.where(sign > 0, (sign > 0).sum(), (sign < 0).sum()) / n
        return 0.5 * w @ w + 0.5 * (10.0 / share * np.maximum(0, 1 - sign * (dense @ w[:-1] + w[-1])) ** 2).sum()

    for _ in range(200):
        step = np.zeros(size + 1)
        step[[*range(8), size]] = rng.normal(0, 0.05, 9)
        assert loss(w) <= loss(w + step) + 0.1  # it stops when no step moves by 0.05
    assert np.mean(np.sign(dense @ w[:-1] + w[-1]) == sign) > 0.9
