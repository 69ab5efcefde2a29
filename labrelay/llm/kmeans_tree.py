"""Approximate nearest neighbours with a hierarchical k-means tree.

* The tree is fitted on a bounded sample (``FIT_ROWS``); every row is indexed:
  it descends to the leaf of its nearest centroids.
* A query visits leaves best bin first: a priority queue holds the tree nodes by
  the distance of their centroid, and the nearest open node is expanded next.
* How many leaves to visit is calibrated: for a bounded set of calibration
  queries the true neighbours are found by brute force over all rows, and the
  visits are widened until ``target_recall`` of them lie in the visited leaves.
  A query whose leaves hold too few rows goes on until they hold ``k`` others.
* Leaf and query visits meet in a cogroup on (leaf, block of rows, block of
  queries). Blocks have a bounded size, so a leaf that holds a third of all rows
  or is visited by every query is many groups.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, staged

#: Bounds: rows the tree is fitted on, calibration queries, leaves of a tree.
FIT_ROWS = 20_000
CALIBRATION_QUERIES = 100
MAX_LEAVES = 4096
#: A table of n rows gets about the root of n leaves, so that a query meets as many centroids
#: as rows in a leaf; each has at least so many rows of the sample.
LEAF_SAMPLE = 12
#: Children of a node, rows and queries of a block.
BRANCHING = 8
BLOCK_ROWS = 4096
BLOCK_QUERIES = 4096


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres * centres).sum(1) - 2.0 * (x @ centres.T), axis=1)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """k-means++ seeds, then Lloyd rounds; fewer centres if points coincide."""
    centres = [x[rng.integers(len(x))]]
    d = ((x - centres[0]) ** 2).sum(1)
    while len(centres) < k and d.max() > 1e-24:
        centres.append(x[rng.choice(len(x), p=d / d.sum())])
        d = np.minimum(d, ((x - centres[-1]) ** 2).sum(1))
    c = np.array(centres)
    for _ in range(rounds):
        at = _nearest(x, c)
        n = np.bincount(at, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, at, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


class Tree:
    """Centroids of all nodes; children of node i; leaf number or -1."""

    def __init__(self, x: np.ndarray, leaf_rows: float, seed: int = 1):
        rng = np.random.default_rng(seed)
        dim = x.shape[1]
        self.centres, self.children, self.leaf, self.leaves = [np.zeros(dim)], [[]], [-1], 0
        todo = [(0, x)]
        while todo:
            node, rows = todo.pop()
            open_leaves = self.leaves + len(todo) + BRANCHING
            at = None
            if len(rows) > max(2.0, leaf_rows) and open_leaves <= MAX_LEAVES:
                k = int(min(BRANCHING, np.ceil(len(rows) / leaf_rows)))
                c = _kmeans(rows, max(2, k), rng)
                at = _nearest(rows, c)
            if at is None or len(np.unique(at)) < 2:
                self.leaf[node] = self.leaves
                self.leaves += 1
                continue
            for j in np.unique(at):
                self.centres.append(c[j])
                self.children.append([])
                self.leaf.append(-1)
                self.children[node].append(len(self.centres) - 1)
                todo.append((len(self.centres) - 1, rows[at == j]))
        self.centres = np.array(self.centres)

    def descend(self, x: np.ndarray) -> np.ndarray:
        """Leaf number of every row of x."""
        out = np.zeros(len(x), np.int32)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            kids = self.children[node]
            if not kids:
                out[rows] = self.leaf[node]
                continue
            at = _nearest(x[rows], self.centres[kids])
            todo += [(kid, rows[at == j]) for j, kid in enumerate(kids) if (at == j).any()]
        return out

    def best_bin_first(self, q: np.ndarray) -> Iterator[int]:
        """Leaf numbers in the order in which a query should visit them."""
        d = ((self.centres - q) ** 2).sum(1)
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                yield self.leaf[node]
            for kid in self.children[node]:
                heapq.heappush(queue, (float(d[kid]), kid))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of one length as a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    diff = x - q
    return np.sqrt(np.einsum("ij,ij->i", diff, diff))


def _top(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k least (score, id), nearest first."""
    at = np.arange(len(scores))
    if len(scores) > k:
        at = np.flatnonzero(scores <= np.partition(scores, k - 1)[k - 1])
    return at[np.lexsort((ids[at], scores[at]))[:k]]


def _best(ids: np.ndarray, x: np.ndarray, qid: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and distances of the k nearest rows of x with another id than the query's."""
    d = _distances(x, q)
    others = ids != qid
    if others.all():
        at = _top(ids, d, k)
    else:
        others = np.flatnonzero(others)
        at = others[_top(ids[others], d[others], k)]
    return at, d[at]


def usable_vectors(df: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(id, v) of the rows that take part, and the dimension.

    Out stay rows whose id or vector is null, vectors with a null or non-finite
    component, zero vectors, and vectors whose length is not the table's most
    frequent one (the smaller of several).
    """
    v = F.col("v")
    good = (
        df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
        .where(F.col("id").isNotNull() & v.isNotNull())
        .where(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
        .where(F.exists(v, lambda x: x != 0))
    )
    size = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    dim = size["n"] if size else 0
    return good.where(F.size("v") == dim), dim


def _sampled(df: DataFrame, rows: int, n: int, seed: int) -> pa.Table:
    """About ``rows`` of the ``n`` rows by a hash of id and vector, at most ``rows``, in order
    of that hash; rows that agree in both count once."""
    df = df.withColumn("h", F.xxhash64("id", "v", F.lit(seed)))
    if n > rows:
        df = df.where(F.pmod("h", F.lit(1 << 30)) < int((1 << 30) * (1.05 * rows + 20) / n))
    return df.dropDuplicates(["h"]).orderBy("h").limit(rows).toArrow().sort_by("h")


def leaf_rows(n: int, sample: int) -> float:
    """Rows of the sample that a leaf should hold, for about the root of ``n`` leaves."""
    leaves = max(1.0, min(np.sqrt(n), MAX_LEAVES, sample / LEAF_SAMPLE))
    return sample / leaves


def nearest_neighbours(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                       k: int = 10, target_recall: float = 0.97, figures: dict | None = None) -> DataFrame:
    """(query_id long, rank int from 1, vec_id long, score double) of the k nearest
    found for every query row, by Euclidean distance in double precision; ties
    go to the smaller id.

    ``is_query`` is a condition on ``id``. Candidates of a query are all rows with
    another id; a table with fewer gives them all. Rows repeated under one id are
    candidates each for themselves; as a query the id counts once, with its least
    vector. ``figures``, if given, gets the number of rows, queries and leaves, the calibrated
    visits and the share of all (query, row) pairs whose distance is taken, at the cost of a job.
    ``usable_vectors`` says which rows take no part. An empty table, or
    one without queries, gives no rows.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    rows, dim = usable_vectors(vectors, id_col, vector_col)
    n = rows.count() if dim else 0
    if not n:
        return spark.createDataFrame([], schema)

    sample = _matrix(_sampled(rows, FIT_ROWS, n, 1).column("v").combine_chunks())
    tree = Tree(sample, leaf_rows(n, len(sample)))

    def index(batches):
        for batch in batches:
            leaf = tree.descend(_matrix(batch.column(1))) if batch.num_rows else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(leaf)], names=["id", "v", "leaf"])

    indexed = staged(map_arrow(rows, index, rows.withColumn("leaf", F.lit(0)).schema), "indexed_vectors")
    queries = indexed.where(is_query).groupBy("id").agg(F.min("v").alias("v"), F.count("*").alias("own"))
    n_queries = queries.count()
    if not n_queries:
        return spark.createDataFrame([], schema)
    visits = calibrated_visits(indexed, _sampled(queries, CALIBRATION_QUERIES, n_queries, 2), tree, k, target_recall)
    counts = indexed.groupBy("leaf").count()  # one row for each leaf: at most MAX_LEAVES
    sizes = [0] * tree.leaves
    for leaf, size in counts.collect():
        sizes[leaf] = size

    def leaves_to_visit(q: np.ndarray, least: int) -> list[int]:
        """The calibrated number of leaves, and more until they hold ``least`` rows."""
        order, held = [], 0
        for leaf in tree.best_bin_first(q):
            if len(order) >= visits and held >= least:
                break
            order.append(leaf)
            held += sizes[leaf]
        return order

    def visit(batches):
        for batch in batches:
            q = _matrix(batch.column(1))
            # Rows under the query's own id are no candidates.
            order = [leaves_to_visit(x, k + own) for x, own in zip(q, batch.column(2).to_pylist())]
            at = np.repeat(np.arange(len(q)), [len(x) for x in order])
            leaves = np.array([leaf for x in order for leaf in x], np.int32)
            for s in range(0, len(at), 8192):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at[s:s + 8192])), batch.column(1).take(pa.array(at[s:s + 8192])),
                     pa.array(leaves[s:s + 8192])], names=["id", "v", "leaf"])

    visited = staged(map_arrow(queries, visit, indexed.schema), "leaf_visits")
    if figures is not None:
        read = visited.groupBy("leaf").agg(F.count("*").alias("q")).join(counts, "leaf").agg(F.sum(F.col("q") * F.col("count"))).first()[0]
        figures |= {"rows": n, "queries": n_queries, "leaves": tree.leaves, "visits": visits, "read": read / (n * n_queries)}
    # As few rows as leaves, so these counts may be broadcast.
    blocks = F.broadcast(
        counts
        .join(visited.groupBy("leaf").agg(F.count("*").alias("queries")), "leaf")
        .select("leaf", F.ceil(F.col("count") / BLOCK_ROWS).cast("int").alias("row_blocks"),
                F.ceil(F.col("queries") / BLOCK_QUERIES).cast("int").alias("query_blocks"))
    )
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("id", "v"), F.col(n)).cast("int")
    left = (indexed.join(blocks, "leaf").withColumn("rb", own("row_blocks"))
            .select("id", "v", "leaf", "rb", every("query_blocks").alias("qb")))
    right = (visited.join(blocks, "leaf").withColumn("qb", own("query_blocks"))
             .select("id", "v", "leaf", every("row_blocks").alias("rb"), "qb"))

    def search(block: pa.Table, asked: pa.Table) -> pa.Table:
        out = ([], [], [])
        if block.num_rows and asked.num_rows:
            ids = block.column("id").to_numpy()
            x = _matrix(block.column("v").combine_chunks())
            for qid, q in zip(asked.column("id").to_pylist(), _matrix(asked.column("v").combine_chunks())):
                at, d = _best(ids, x, qid, q, k)
                for column, values in zip(out, (np.full(len(at), qid), ids[at], d)):
                    column.append(values)
        cat = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        return pa.table({"query_id": cat(out[0], np.int64), "vec_id": cat(out[1], np.int64), "score": cat(out[2], np.float64)})

    keys = ["leaf", "rb", "qb"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def brute_force(indexed: DataFrame, asked: pa.Table, k: int) -> list[tuple[int, int, float, int]]:
    """(query, vec_id, score, leaf) of the k nearest rows of a bounded table of queries."""
    ids, q = asked.column("id").to_numpy(), _matrix(asked.column("v").combine_chunks())

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, own, leaf = _matrix(batch.column(1)), batch.column(0).to_numpy(), batch.column(2).to_numpy()
            for i, (qid, vector) in enumerate(zip(ids, q)):
                at, d = _best(own, x, qid, vector, k)
                yield pa.RecordBatch.from_pydict({"q": np.full(len(at), i), "id": own[at], "score": d, "leaf": leaf[at]})

    near = map_arrow(indexed.select("id", "v", "leaf"), run, "q long, id long, score double, leaf int")
    rank = F.row_number().over(Window.partitionBy("q").orderBy("score", "id"))
    return [tuple(r) for r in near.withColumn("r", rank).where(F.col("r") <= k).select("q", "id", "score", "leaf").collect()]


def calibrated_visits(indexed: DataFrame, asked: pa.Table, tree: Tree, k: int, target: float) -> int:
    """Leaves to visit: widened one by one until the visited leaves hold
    ``target`` of the true neighbours of the calibration queries."""
    truth = brute_force(indexed, asked, k)
    order = [{leaf: i for i, leaf in enumerate(tree.best_bin_first(q))} for q in _matrix(asked.column("v").combine_chunks())]
    at = np.bincount([order[q][leaf] for q, _, _, leaf in truth], minlength=tree.leaves) if truth else np.zeros(1, int)
    found, visits = 0, 0
    while visits < tree.leaves and (visits == 0 or found < target * len(truth)):
        found += int(at[visits])
        visits += 1
    return visits
