import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from labrelay.llm import tokens
from labrelay.llm.common import table

FILES = [f"{tokens.TOKENIZERS}/{f}" for f in (tokens.BYTE_BPE, tokens.PIECE_BPE)]
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def pair():
    try:
        return tokens.Pair(*(open(f, "rb").read() for f in FILES))
    except FileNotFoundError:
        pytest.skip("tokenizer files not present")


def ends(pair, a, b):
    """(end, id) of each token, added up one by one."""
    out = []
    for ids, of in ((a, pair.a_bytes), (b, pair.b_bytes)):
        at, side = 0, []
        for i in ids:
            at += len(of[i])
            side.append((at, i))
        out.append(side)
    return out


def brute(pair, texts):
    """The contract, text by text."""
    rows, counts = [], Counter()
    for t in texts:
        a = b = []
        if t:
            a = pair.a.encode(" " + t, add_special_tokens=False).ids
            b = pair.b.encode(t)
            if not b"".join(pair.a_bytes[i] for i in a) == b"".join(pair.b_bytes[i] for i in b) == (" " + t).encode():
                a = b = []
        ea, eb = ends(pair, a, b)
        cuts = sorted({e for e, _ in ea} & {e for e, _ in eb})
        groups, last = [], 0
        for c in cuts:
            groups.append("|".join(",".join(str(i) for e, i in side if last < e <= c) for side in (ea, eb)))
            last = c
        by_end = {e: i for e, i in eb}
        links = [(i, by_end[e]) for e, i in ea if e in by_end]
        counts.update(links)
        rows.append((len(a), len(b), ";".join(groups), len(cuts), links))
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    return [(na, nb, k, len(links), sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links),
             hashlib.sha256(g.encode()).hexdigest() if na else "") for na, nb, g, k, links in rows]


ODD = ["a b", "", None, "Hello  world\n\n x", "<s>hi</s> <|endoftext|>", "▁x", "naïve ﬁ ½ 東京 🙂 é", "\x00\t", " lead", "trail ",
       "<0x41>", "a b", "x" * 3000, "ab " * 3000, "ñandú über", "​﻿"]


@pytest.mark.parametrize("hot", [0, 3, 40, 1 << 18])
def test_equals_brute_force_whatever_goes_to_every_task(spark, pair, documents, hot):
    texts = [r.text for r in table(spark, "/root/testdata/sf0.001", "documents").limit(60).collect()] + ODD
    docs = documents([(None if k % 9 == 0 else k // 2, t, "s") for k, t in enumerate(texts)]).withColumnRenamed("score", "n_best")
    got = tokens.aligned(docs, ["doc_id", "n_best", "size"], hot_pairs=hot)
    assert got.columns == ["doc_id", "n_best", "size", *(c + "_" if c == "n_best" else c for c in COLUMNS)]
    found = Counter((r[0], *r[3:]) for r in got.collect())
    assert found == Counter((None if k % 9 == 0 else k // 2, *x) for k, x in enumerate(brute(pair, texts)))


def test_empty_tables(spark, pair, documents):
    assert tokens.aligned(documents([(1, "a", "s")]).limit(0), ["doc_id"]).count() == 0
    rows = tokens.aligned(documents([(1, None, "s"), (1, "", None)]), ["doc_id"]).collect()
    assert [tuple(r) for r in rows] == [(1, 0, 0, 0, 0, 0, 0, "")] * 2


def test_pointers_end_at_the_terminal_of_the_overlap_component():
    rng = random.Random(4)
    for _ in range(200):
        size = rng.randint(1, 40)
        a, b = (np.array(sorted({*rng.sample(range(1, size), rng.randint(0, size - 1)), size})) for _ in range(2))
        spans = [(s, e) for x in (a, b) for s, e in zip([0, *x[:-1]], x)]
        group = list(range(len(spans)))
        for _ in spans:  # spreads the largest number over overlapping tokens
            for i, (s, e) in enumerate(spans):
                for j, (t, f) in enumerate(spans):
                    if (i < len(a)) != (j < len(a)) and s < f and t < e:
                        group[i] = group[j] = max(group[i], group[j])
        assert tokens.terminals(tokens.successors(a, b)).tolist() == group


def test_tasks_hand_their_counts_on(spark, pair, documents, monkeypatch):
    monkeypatch.setattr(tokens, "LINKS", 5)
    monkeypatch.setattr(tokens, "CHUNK", 50)
    texts = ["one two three four five six seven eight nine ten " * 2, "one two", "", "three four"] * 4
    got = tokens.aligned(documents([(k, t, "s") for k, t in enumerate(texts)]), ["doc_id"]).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == brute(pair, texts)


def test_merging_by_rank_gives_the_ids_of_the_general_encoder(pair):
    assert pair.bytes
    rng = random.Random(6)
    points = [c for c in range(0x3100) if not 0xD800 <= c < 0xE000] + [rng.randrange(0xE000, 0x110000) for _ in range(3000)]
    texts = [f" a{c}b {c}{c} 1{c}2 !{c}? {c} \n{c}'s <|endoftext|>" for c in map(chr, points)] + [" " * 5000, "a" * 5000, " x" + "\n" * 5000 + "'ll"]
    assert pair.encode_a(texts) == [e.ids for e in pair.a.encode_batch(texts, add_special_tokens=False)]
    spec = tokens.json.loads(pair.a.to_str())
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": None}, {"model": spec["model"] | {"dropout": 0.1}},
                   {"model": spec["model"] | {"merges": spec["model"]["merges"][::-1]}}):
        assert tokens.byte_encoder(spec | change) is None


@pytest.mark.parametrize("blank", [" ", "\n", "　", "\n \t"])
def test_blanks_in_a_row_beyond_what_the_fast_pattern_stands(pair, blank):
    short, long = (blank * n for n in (tokens.CHUNK // len(blank) - 2, 1_200_000))
    assert pair.encode_a([" " + short]) == [pair.a.encode(" " + short, add_special_tokens=False).ids]
    (a, b), = pair.encode([long + "x"])
    assert b"".join(pair.a_bytes[i] for i in a) == (" " + long + "x").encode() == b"".join(pair.b_bytes[i] for i in b)
