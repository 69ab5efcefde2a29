import numpy as np
from pyspark.sql import functions as F

from labrelay.llm import kmeans_tree as K


def brute(ids, x, queries, k=10):
    out = {}
    for q in queries:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        at = np.flatnonzero(ids != q)
        at = at[np.lexsort((ids[at], d[at]))[:k]]
        out[q] = [(int(ids[i]), float(d[i])) for i in at]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_best_bin_first_visits_every_leaf_once_and_the_own_leaf_early():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 8))
    tree = K.Tree(x, 50)
    leaves = tree.descend(x)
    first = 0
    for i in range(50):
        order = list(tree.best_bin_first(x[i]))
        assert sorted(order) == list(range(tree.leaves))
        first += order[0] == leaves[i]
    assert first > 35
    assert K.Tree(np.ones((100, 3)), 5).leaves == 1  # coinciding points can't be split


def test_recall_and_scores_on_a_table(spark, sf, monkeypatch):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    monkeypatch.setattr(K, "BLOCK_ROWS", 40)  # leaves fall into several blocks
    got = found(K.nearest_neighbours(table, F.col("id") % 20 == 0))
    rows = table.toArrow()
    ids, x = rows["vec_id"].to_numpy(), np.array(rows["embedding"].to_pylist(), float)
    want = brute(ids, x, [int(i) for i in ids if i % 20 == 0])
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    for q in got:
        exact = {int(i): float(np.sqrt(((x[ids == q][0] - v) ** 2).sum())) for i, v in zip(ids, x)}
        assert all(abs(exact[i] - s) < 1e-12 for i, s in got[q])


def test_rows_that_take_no_part_ties_and_small_tables(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.0, 1.0]), (1, [1.0, 1.0]), (2, [-1.0, 1.0]), (3, [0.0, 2.0]), (4, [0.0, 0.0]), (5, None), (6, [nan, 1.0]),
            (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0, 2.0, 3.0]), (None, [0.0, 1.0]), (100, [0.0, 1.0]), (100, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    got = found(K.nearest_neighbours(df, F.col("id") % 100 == 0, k=10))
    assert got == {0: [(100, 0.0), (100, 0.0), (1, 1.0), (2, 1.0), (3, 1.0)], 100: [(0, 0.0), (1, 1.0), (2, 1.0), (3, 1.0)]}
    assert K.nearest_neighbours(df.limit(0), F.col("id") % 100 == 0).count() == 0
    assert K.nearest_neighbours(df, F.col("id") == 77).count() == 0


def test_queries_in_tiny_leaves_find_k_rows(spark, monkeypatch):
    monkeypatch.setattr(K, "leaf_rows", lambda n, sample: 600)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(12, 8))[rng.integers(12, size=6000)] * 20 + rng.normal(size=(6000, 8)) * 0.05
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    far = [(20 * 6000 + 20 * i, (np.eye(8)[i] * 3000).tolist()) for i in range(5)]
    often = [(10**6, (-np.eye(8)[0] * 3000 + 1e-3 * i).tolist()) for i in range(30)]  # rows of one id are no candidates of it
    df = spark.createDataFrame(rows + far + often, "vec_id long, embedding array<double>")
    got = found(K.nearest_neighbours(df, F.col("id") % 10 == 0))
    assert len(got) == 600 + 5 + 1 and {len(n) for n in got.values()} == {10}
    assert all(i != q for q, near in got.items() for i, _ in near)


def test_a_search_of_clustered_rows_reads_few_of_them(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(60, 16))[rng.integers(60, size=9000)] * 3 + rng.normal(size=(9000, 16)) * 0.4
    ids = np.arange(9000)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    figures = {}
    got = found(K.nearest_neighbours(df, F.col("id") % 30 == 0, figures=figures))
    want = brute(ids, x, range(0, 9000, 30))
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    assert figures["leaves"] > 50 and figures["queries"] == 300 and figures["read"] < 0.2


def test_samples_are_bounded_whatever_ids_repeat(spark):
    df = spark.range(30_000).selectExpr("if(id % 3 = 0, id, 5L) as id", "array(double(id % 20000 div 2), 1D) as v")
    got = K._sampled(df, 1000, 30_000, 1)
    again = K._sampled(df.repartition(5), 1000, 30_000, 1)
    assert 600 < got.num_rows <= 1000 and got.column("v").to_pylist() == again.column("v").to_pylist()
