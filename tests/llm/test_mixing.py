import random

import duckdb
import pytest

from labrelay.llm import mixing


def slow_targets(sizes, weights=(5, 2, 1), most=3):
    """{source: target}: fill by weight, cap, hand the excess on, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while True:
        level = left / max(1, sum(weight[s] for s in open_))
        over = {s for s in open_ if level * weight[s] >= most * sizes[s]}
        if not over:
            return {**target, **{s: level * weight[s] for s in open_}}
        for s in over:
            target[s] = float(most * sizes[s])
            left -= target[s]
        open_ -= over


def corpus(rng, n_sources, n):
    return [(i, rng.choice([None, "", "x", "two words", "w " * rng.randint(1, 60)]), rng.choice([None, *"abcdefgh"[:n_sources]]))
            for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_report_equals_sql_and_water_filling(spark, documents, seed):
    rng = random.Random(seed)
    rows = corpus(rng, 6, 400) + [(1000 + i, "only a little", "z%d" % i) for i in range(4)] + [(None, "no id", "a"), (5, "again", "a"), (5, "again", "a")]
    docs = documents(rows)
    got = mixing.mixing_report(docs).collect()
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, con.sql(mixing.MIXING_SQL).fetchall()))
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = slow_targets(sizes)
    by_source = {r.source: r.target for r in mixing.source_targets(docs.selectExpr("source", "size(filter(split(coalesce(text, ''), ' '), x -> x <> '')) as size")).collect()}
    assert by_source == pytest.approx(want)
    assert all(r.taken <= 3 * r["size"] for r in got)


def test_mix_emits_each_copy(spark, documents):
    rows = [(i, "some words here", "big") for i in range(600)] + [(i, "some words here", "small") for i in range(600, 700)]
    docs = documents(rows)
    report = {r.doc_id: r.taken // 3 for r in mixing.mixing_report(docs).collect()}
    out = mixing.mixed(docs)
    assert out.columns == [*docs.columns, "copy"]
    copies = {}
    for r in out.collect():
        copies.setdefault(r.doc_id, []).append(r.copy)
    assert {i: len(c) for i, c in copies.items()} == {i: n for i, n in report.items() if n}
    assert all(sorted(c) == list(range(1, len(c) + 1)) for c in copies.values())
    taken = sum(3 * n for i, n in report.items() if i < 600)
    assert abs(taken - 2100 * 5 / 7) < 150
    assert mixing.mixed(docs.limit(0)).count() == 0 and mixing.mixing_report(docs.limit(0)).count() == 0
    assert mixing.mixed(documents([(1, None, None), (2, "", "a")])).count() == 0


def test_a_large_table_of_sources_is_joined_not_broadcast(spark, documents, monkeypatch):
    docs = documents(corpus(random.Random(3), 5, 100))
    want = sorted(map(repr, mixing.mixing_report(docs).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(map(repr, mixing.mixing_report(docs).collect())) == want


def test_rows_without_ids_draw_apart(spark, documents):
    rows = [(None if i % 2 else i, f"text number {i}", "ab"[i % 7 > 4]) for i in range(4000)]
    taken, target = {}, {}
    docs = documents(rows).selectExpr("doc_id", "text", "source")
    for r in mixing.with_copies(docs).collect():
        taken[r.source] = taken.get(r.source, 0) + r["size"] * r.copies
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) < 0.06 * target[s] for s in target)
