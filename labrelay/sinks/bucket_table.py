"""Current-state table whose batches don't rewrite it.

The key's hash puts a row into one of ``buckets``. A bucket is a list of pieces, parquet
folders ``write=<commit>-<id>/bucket=<n>``, oldest first; a later piece's row of a key
wins. A batch is deduplicated, and written as one new piece for each bucket that its keys
fall in; no file of another bucket is read or written. A batch takes a bucket's last
pieces into its own while they hold no more than twice its rows, so pieces grow
about geometrically: a bucket of n rows has some log n pieces, and a row is
rewritten some log n times, whatever the size of the state.

The commit (``commit_log``) says which pieces there are. What a lost or slower writer has
written is named by no commit and read by nobody. Any number of writers may share
the table: one that loses the race for a commit builds its batch on the winner's. A
replayed batch changes nothing.

Reading merges the pieces by key: one aggregation, without one where each bucket has
a single piece (``compact`` makes it so). The number of buckets is fixed by the first
commit.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.upsert import latest_per_key
from ..plans.batch import current_rows
from ..plans.kinds import MessageKind, get_kind
from .commit_log import Commit, CommitLog, file_system

_BUCKET, _COMMIT = "bucket", "_commit"
#: A piece is taken into a new one if it has no more than so many times its rows.
GROWTH = 2


@dataclass
class BucketTable:
    path: str
    kind: str | MessageKind
    buckets: int = 64
    keep_commits: int = 3  # newest commits whose data stay, for readers that have begun
    order: Sequence[str] | None = None  # columns that decide which row is later; default: arrival
    tries: int = 20  # for writers that lose races

    @property
    def log(self) -> CommitLog:
        return CommitLog(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        """The current rows."""
        commit = self.log.newest(spark)
        if commit.number < 0:
            raise FileNotFoundError(f"no commit under {self.path}")
        return self._rows(spark, commit, [p for pieces in commit.state["pieces"].values() for p in pieces],
                          all(len(pieces) == 1 for pieces in commit.state["pieces"].values())).drop(_COMMIT)

    def upsert(self, records: DataFrame, batch_id: int, run_id: str = "batch") -> None:
        """Parsed records of a batch (arrival columns included): the latest of each key replaces the table's."""
        spark, k = records.sparkSession, get_kind(self.kind)
        if self.log.newest(spark).holds(run_id, batch_id):
            return
        rows = current_rows(records, k, self.order).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for _ in range(self.tries):
                commit = self.log.newest(spark)
                if commit.holds(run_id, batch_id):
                    return
                if self.log.append(spark, self._written(rows, commit, run_id, batch_id)):
                    self._prune(spark)
                    return
        finally:
            rows.unpersist()
        raise RuntimeError(f"lost {self.tries} races for a commit under {self.path}")

    def compact(self, spark: SparkSession) -> bool:
        """Every bucket becomes one piece. False if a writer was faster."""
        commit = self.log.newest(spark)
        many = {b: p for b, p in commit.state.get("pieces", {}).items() if len(p) > 1}
        if not many:
            return True
        folder = self._folder(commit.number + 1)
        merged = self._rows(spark, commit, [p for pieces in many.values() for p in pieces], False)
        self._write(merged, folder, commit.state["buckets"])
        pieces = commit.state["pieces"] | {b: [[f"{folder}/{_BUCKET}={b}", sum(n for _, n in p)]] for b, p in many.items()}
        done = self.log.append(spark, Commit(commit.number + 1, commit.runs, commit.state | {"pieces": pieces}))
        if done:
            self._prune(spark)
        return done

    def _written(self, rows: DataFrame, commit: Commit, run_id: str, batch_id: int) -> Commit:
        """The batch's pieces written on top of ``commit``, and the commit that names them."""
        spark, k = rows.sparkSession, get_kind(self.kind)
        state = commit.state or {"buckets": self.buckets, "schema": rows.select(*k.table_columns).schema.json(), "pieces": {}}
        bucket = self._bucket(state["buckets"])
        touched = {str(r[0]): r[1] for r in rows.groupBy(bucket).count().collect()}  # a row for each bucket at most
        pieces, taken, folder = dict(state["pieces"]), [], self._folder(commit.number + 1)
        for b, n in touched.items():
            old = list(pieces.get(b, []))
            while old and old[-1][1] <= GROWTH * n:
                n += old[-1][1]
                taken.append(old.pop())
            pieces[b] = [*old, [f"{folder}/{_BUCKET}={b}", n]]
        rows = rows.select(*k.table_columns, F.lit(commit.number + 1).cast("long").alias(_COMMIT))
        if taken:
            older = self._read(spark, state["schema"], [p for p, _ in taken])
            rows = latest_per_key(rows.unionByName(older), k.key, order=[_COMMIT], keep_order=True)
        if touched:
            self._write(rows, folder, state["buckets"])
        return commit.next(run_id, batch_id, state | {"pieces": pieces})

    def _rows(self, spark: SparkSession, commit: Commit, pieces: list, single: bool) -> DataFrame:
        schema = commit.state["schema"]
        if not pieces:
            return spark.createDataFrame([], StructType.fromJson(json.loads(schema))).withColumn(_COMMIT, F.lit(0).cast("long"))
        rows = self._read(spark, schema, [p for p, _ in pieces])
        columns = rows.columns
        return rows if single else latest_per_key(rows, get_kind(self.kind).key, order=[_COMMIT], keep_order=True).select(*columns)

    def _read(self, spark: SparkSession, schema: str, folders: list[str]) -> DataFrame:
        full = StructType.fromJson(json.loads(schema)).add(_COMMIT, "long")
        return spark.read.schema(full).parquet(*(f"{self.path}/{f}" for f in folders))

    def _bucket(self, buckets: int):
        return F.pmod(F.xxhash64(get_kind(self.kind).key), F.lit(buckets)).cast("int")

    def _write(self, rows: DataFrame, folder: str, buckets: int) -> None:
        # a bucket's rows go to one task, so that a piece is one file; a bucket is a small share of the state
        dealt = rows.withColumn(_BUCKET, self._bucket(buckets)).repartition(_BUCKET)
        dealt.write.partitionBy(_BUCKET).parquet(f"{self.path}/{folder}")

    def _folder(self, number: int) -> str:
        return f"write={number:012d}-{uuid.uuid4().hex[:12]}"

    def _prune(self, spark: SparkSession) -> None:
        """Deletes data that none of the newest commits names. A folder of a later number
        may belong to a writer at work; one of an earlier number can't be committed any more."""
        kept = [self.log.read(spark, n) for n in self.log.numbers(spark)[-max(1, self.keep_commits):]]
        named = {f for c in kept for pieces in c.state["pieces"].values() for f, _ in pieces}
        fs, root = file_system(spark, self.path)
        for s in fs.listStatus(root):
            folder = s.getPath().getName()
            if not folder.startswith("write=") or int(folder[6:18]) > kept[0].number:
                continue
            inner = [x.getPath() for x in fs.listStatus(s.getPath())]
            old = [p for p in inner if f"{folder}/{p.getName()}" not in named]
            if not any(p.getName().startswith(f"{_BUCKET}=") for p in inner if p not in old):
                fs.delete(s.getPath(), True)
                continue
            for p in old:
                if p.getName().startswith(f"{_BUCKET}="):
                    fs.delete(p, True)
