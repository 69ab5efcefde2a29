"""Helpers shared by the corpus operators: shared scratch tables, temporary
column names, bounded samples of labelled rows and hashing in numpy."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Odd multiplier of every polynomial hash here.
BASE = 0x9E3779B97F4A7C15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only a single-JVM local session may go without it: it gets a temporary one.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="corpus-scratch-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; nothing is ever overwritten there."""
    return f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table in the shared folder and read back: cuts
    the lineage, survives lost executors, and is computed only once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: The folder that this package is imported from.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def map_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``df.mapInArrow(run, schema)`` whose Python workers find this package where
    the driver did, also if it is not installed (as in local runs from a checkout)."""
    env = df.sparkSession.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    return df.mapInArrow(run, schema)


def fresh(columns: list[str], base: str) -> str:
    """``base`` or ``base_``... that clashes with none of ``columns`` (any case)."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base


def crc_fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null for a null id)."""
    return F.crc32(id_col.cast("string").cast("binary")) % F.lit(folds)


def bounded_sample(rows: DataFrame, label: str, bounds: dict, seed: int = 7) -> tuple[DataFrame, str]:
    """All columns of ``rows`` (doc_id, text, the label and others), and the name of a new
    long column, of a sample that holds no more rows of each label than its bound.

    ``bounds``: label -> (its number of rows, its bound); rows of other labels are left
    out. A hash of id and text picks the rows and is the new column, so neither the order
    of the rows nor their partitions matter. Rows that agree in id, text and label count
    once.
    """
    order, place = fresh(rows.columns, "order"), fresh([*rows.columns, "order"], "place")
    parts = 1_000_000
    hashed = rows.withColumn(order, F.xxhash64("doc_id", "text", F.lit(seed)))
    share = F.lit(0)
    for value, (n, bound) in bounds.items():
        share = F.when(F.col(label) == F.lit(value), F.lit(-(-parts * bound // max(1, n)))).otherwise(share)
    thinned = hashed.where(F.pmod(F.xxhash64(order), F.lit(parts)) < share).dropDuplicates([label, order])
    # About as many rows as the bounds say are left: few enough for a window of each label.
    ranked = thinned.withColumn(place, F.row_number().over(Window.partitionBy(label).orderBy(order)))
    bound = F.lit(0)
    for value, (_, most) in bounds.items():
        bound = F.when(F.col(label) == F.lit(value), F.lit(most)).otherwise(bound)
    return ranked.where(F.col(place) <= bound).drop(place), order


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int,
                    max_rows: int, seed: int = 7, by_label: bool = False) -> tuple[DataFrame, str, str]:
    """All columns of ``docs`` and the label, the label's column name and that of the sample's order (see
    ``bounded_sample``), of at most ``max_rows`` labelled documents outside the held-out fold.

    ``by_label`` gives each of the labels 0 and 1 half of ``max_rows``, and what the
    other leaves of its half, so that a rare label is not thinned out with the rest.
    Rows with a null id, label or text are left out; of several labels of one
    document the largest counts, labels above 0 count as 1. Ids are thinned first, by a
    hash, to about ``max_rows`` and broadcast, so the documents are filtered while they are
    scanned; then rows are counted and thinned, as many may share an id.
    """
    y = fresh(docs.columns, "y")
    picked = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .where(crc_fold(F.col("doc_id"), folds) != held_out)
        .groupBy("doc_id").agg(F.when(F.max(label) > 0, 1).otherwise(0).alias(y))
    )

    def bounds(counts: dict[int, int]) -> dict[int, int]:
        """How many of each label stay."""
        n = sum(counts.values())
        if n <= max_rows:
            return counts
        if not by_label:
            return {v: max_rows * k // n for v, k in counts.items()}
        ones, zeros = counts.get(1, 0), counts.get(0, 0)
        most = min(ones, max(max_rows // 2, max_rows - zeros))
        return {1: most, 0: min(zeros, max_rows - most)}

    counted = lambda rows: {r[0]: r[1] for r in rows.groupBy(y).count().collect()}
    ids = counted(picked)
    parts, share = 1_000_000, F.lit(0)
    for value, most in bounds(ids).items():
        share = F.when(F.col(y) == value, F.lit(-(-parts * most // max(1, ids.get(value, 0))))).otherwise(share)
    picked = F.broadcast(picked.where(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(parts)) < share))
    counts = counted(docs.join(picked, "doc_id"))
    rows = docs.where(F.col("text").isNotNull()).join(picked, "doc_id")
    sample, order = bounded_sample(rows, y, {v: (counts[v], most) for v, most in bounds(counts).items()}, seed)
    return sample, y, order


_SPACE = re.compile(rb"[ \t-\r]")


def word_chunks(data: bytes | None, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words ``[^\x20\x09-\x0D]+`` of a text, in lists from about ``size`` bytes each."""
    data = data or b""
    at = 0
    while at < len(data):
        cut = _SPACE.search(data, at + size) if at + size < len(data) else None
        end = cut.start() if cut else len(data)
        yield data[at:end].split()
        at = end + 1


def powers(n: int, base: int = BASE) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer: spreads the entropy of a uint64 over its high bits."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))
