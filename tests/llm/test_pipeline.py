import corpus_pipeline
from labrelay.llm import factorisation, mixing, simhash, tiling
from labrelay.llm.common import staged
from .test_simhash import slow_components, slow_fingerprint
from .test_tiling import slow_tiles


def test_stages_equal_brute_force(spark):
    """Each stage on what the one before kept, against its rule applied row by row."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(staged(stage(spark, steps[-1], sf), name.replace(" ", "_")))
        if name != "mixing":
            assert steps[-1].columns == docs.columns
    raw, good, single, clean, safe, mix = [[tuple(r) for r in s.collect()] for s in steps]
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    machine = factorisation.train(docs, labels)
    assert sorted(good) == sorted(r for r in raw if machine.score(*factorisation.features(r[1].encode(), r[4])) >= 0.3)
    label = slow_components([slow_fingerprint(r[1]) for r in good])
    least = {}
    for r, c in zip(good, label):
        least[c] = min(least.get(c, r), r)
    assert sorted(single) == sorted(least.values())
    items = [r.text.lower().split() for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]

    def leaks(text):
        words = text.lower().split()
        for item in items:
            near = [w if any(item[k:k + 5] == words[max(0, j - 4) + k2:max(0, j - 4) + k2 + 5] for k in range(len(item) - 4) for k2 in range(5))
                    else 0 for j, w in enumerate(words)] if len(item) >= 5 and set(item) & set(words) else []
            if any(near) and sum(t[2] for t in slow_tiles(item, near, 5)) >= 0.8 * len(item):
                return True
        return False

    kept = {r[0] for r in clean}
    assert kept <= {r[0] for r in single}
    gone = [r for r in single if r[0] not in kept]
    assert gone and all(leaks(r[1]) for r in gone)
    found = tiling.Items([(i, " ".join(w).encode()) for i, w in enumerate(items)])
    assert not any(list(found.found(r[1].encode(), 0.8)) for r in clean)
    assert sorted(r[0] for r in safe) == sorted(kept)
    assert not any(x in r[1] for r in safe for x in ("AKIA", "token = \"")) or all("[SECRET]" in r[1] for r in safe if 'token = "' in r[1])
    copies = {r.doc_id: r.copies for r in mixing.with_copies(steps[4]).collect()}
    counts = {}
    for r in mix:
        counts[r[0]] = counts.get(r[0], 0) + 1
    assert counts == {i: n for i, n in copies.items() if n}
    assert simhash.BITS == 64 and len(corpus_pipeline.STAGES) == 5


def test_empty_documents_run_through(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, sf), name.replace(" ", "_"))
        assert docs.count() == 0
