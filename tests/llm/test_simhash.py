import random
import re

import numpy as np
import xxhash

from labrelay.llm import simhash
from labrelay.llm.components import components


def slow_fingerprint(text, width=3):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or [b" ".join(words)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(fps, budget=2):
    """Class (least index) of every fingerprint, over all pairs."""
    label = list(range(len(fps)))
    for _ in fps:
        new = [min(label[j] for j in range(len(fps)) if (fps[i] ^ fps[j]).bit_count() <= budget) for i in range(len(fps))]
        if new == label:
            break
        label = new
    return label


def test_fingerprint_equals_its_definition(monkeypatch):
    rng = random.Random(1)
    texts = [None, "", " \t\n", "One", "one TWO", "a b c", "a a a a a a", "Äb c\x0bd\x1ce f", "x " * 5000]
    texts += [" ".join(rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(rng.randint(1, 80))) for _ in range(60)]
    want = [slow_fingerprint(t) for t in texts]
    for chunk in (simhash.CHUNK, 7):  # chunks do not change the shingles
        monkeypatch.setattr(simhash, "CHUNK", chunk)
        assert [simhash.fingerprint(None if t is None else t.encode()) for t in texts] == want


def test_trie_links_connect_what_all_pairs_connect(monkeypatch):
    monkeypatch.setattr(simhash, "PAIRS", 50)
    rng = random.Random(2)
    keys = set()
    while len(keys) < 500:
        k = rng.getrandbits(64)
        keys.add(k)
        for _ in range(rng.choice([0, 0, 3, 20])):  # chains of neighbours
            k ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            keys.add(k)
    keys = np.array(sorted(keys), np.uint64)
    depth = 3
    label = {int(k): int(k) for k in keys}

    def find(k):
        while label[k] != k:
            k = label[k]
        return k

    for home in range(1 << depth):
        group = keys[np.bitwise_count((keys >> np.uint64(61)) ^ np.uint64(home)) <= 2]
        for a, b in zip(*simhash.trie_links(group, home, depth, 2)):
            a, b = find(int(a)), find(int(b))
            label[max(a, b)] = min(a, b)
    slow = slow_components([int(k) for k in keys])
    assert [find(int(k)) for k in keys] == [int(keys[i]) for i in slow]


def test_crowded_groups_are_dealt_out_by_deeper_nodes(spark):
    rng = random.Random(9)
    keys = {rng.getrandbits(64) for _ in range(40)}
    home = 0xABCD << 48  # most fingerprints lie below one node of 16 bits
    while len(keys) < 400:
        k = home | rng.getrandbits(6) << 40 | rng.getrandbits(4) << 8
        keys |= {k, k ^ 1 << rng.randrange(64), k ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64)}
    signed = sorted(int(k) - (1 << 64) if k >> 63 else int(k) for k in keys)
    fps = spark.createDataFrame([(k,) for k in signed], "fp long")
    unsigned = [k & (1 << 64) - 1 for k in signed]
    slow = slow_components(unsigned)
    want = {k: signed[c] for k, c in zip(signed, slow) if slow.count(c) > 1}
    for group_rows in (200, 1 << 20):
        links = simhash.fingerprint_links(fps, group_rows=group_rows)
        assert ("Union" in links._jdf.queryExecution().logical().toString()) == (group_rows == 200)
        assert {r.node: r.component for r in components(links).collect()} == want


def test_components_of_a_path_a_star_and_a_cycle(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (201, 200), (202, 201), (200, 202)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {**{i: 1 for i in range(1, 41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200, 202: 200}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def rows():
    rng = random.Random(3)
    base = [" ".join("w%d" % rng.randrange(500) for _ in range(400)) for _ in range(12)]
    out = [(i, t, "s") for i, t in enumerate(base)]
    for i, t in enumerate(base):  # near copies: one word in 400, and chains of them
        words = t.split()
        for n in range(4):
            words[n * 90] = "edit"
            out.append((100 + 10 * i + n, " ".join(words), "s"))
    out += [(900, None, "s"), (901, "", "s"), (902, "  ", "s"), (903, "one two", None), (904, "ONE two", "s"), (None, base[0], "s"),
            (None, "nobody else has this", "s"), (905, base[1], "s"), (905, base[1], "s")]
    return out


def test_report_and_dedup_equal_brute_force(spark, documents):
    data = rows()
    fps = [slow_fingerprint(t) for _, t, _ in data]
    label = slow_components(fps)
    members = {}
    for i, c in enumerate(label):
        members.setdefault(c, []).append(data[i][0])
    least = {c: min((x for x in ids if x is not None), default=None) for c, ids in members.items()}
    want = sorted((str(d[0]), "%016x" % f, str(least[c])) for d, f, c in zip(data, fps, label))
    docs = documents(data)
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.simhash_report(docs).collect())
    assert got == want
    kept = simhash.simhash_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(least[c]) for c in members)
    assert simhash.simhash_dedup(docs.limit(0)).count() == 0
    assert simhash.simhash_report(docs.limit(0)).count() == 0
