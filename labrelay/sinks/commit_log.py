"""Commit records of a table that batches are written to.

``<path>/_commits/<number>.json`` are the table's commits, apart from its data. Each
is written once: to a name of its own beside them, then renamed, which fails if the number
is there. So of two writers that build on the same commit one wins; the other finds
out, and builds on the winner's commit instead. The newest commit says all there is to
know: where the data are (``state``), and the last batch of every run (the life of
one checkpoint). A run counts its batches upwards, so a batch that is not above its
run's last one is a replay, however long ago its data were rewritten.

A commit's file is small, bounded by the table's buckets and runs, and read and
written by the driver. The newest ``KEPT`` stay; a writer would have to sleep through
as many commits between two calls of the file system to take a number twice.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

#: Commit files that stay, for writers that are behind.
KEPT = 100


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path) of a path in any store that Spark reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def read_file(spark: SparkSession, path: str) -> str:
    """A small file, read by the driver without a Spark job."""
    fs, p = file_system(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file whole or not at all; False if the name is taken. A driver
    lost on the way leaves only a file of another name."""
    jvm = spark.sparkContext._jvm
    fs, p = file_system(spark, path)
    side = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}")
    out = fs.create(side, False)
    out.write(bytearray(text.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        context.rename(side, p, none)  # fails if the name is taken; atomic where the store's rename is
        return True
    except Exception:
        if not fs.exists(p):
            raise
        fs.delete(side, False)
        return False


@dataclass
class Commit:
    number: int
    runs: dict[str, int] = field(default_factory=dict)  # the last batch of each run
    state: dict = field(default_factory=dict)  # where the data are

    def holds(self, run_id: str, batch_id: int) -> bool:
        return batch_id <= self.runs.get(run_id, -1)

    def next(self, run_id: str, batch_id: int, state: dict) -> Commit:
        return Commit(self.number + 1, {**self.runs, run_id: batch_id}, state)


@dataclass
class CommitLog:
    path: str  # of the table

    def numbers(self, spark: SparkSession) -> list[int]:
        fs, p = file_system(spark, f"{self.path}/_commits")
        if not fs.exists(p):
            return []
        names = (s.getPath().getName() for s in fs.listStatus(p))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self, spark: SparkSession, number: int) -> Commit:
        return Commit(**json.loads(read_file(spark, self._file(number))))

    def newest(self, spark: SparkSession) -> Commit:
        """The newest commit; number -1 and nothing in it if there is none."""
        numbers = self.numbers(spark)
        return self.read(spark, numbers[-1]) if numbers else Commit(-1)

    def append(self, spark: SparkSession, commit: Commit) -> bool:
        """False if another writer has been faster."""
        if self.numbers(spark)[-1:] != [commit.number - 1] and commit.number:
            return False
        text = json.dumps({"number": commit.number, "runs": commit.runs, "state": commit.state})
        if not write_once(spark, self._file(commit.number), text):
            return False
        fs, _ = file_system(spark, self.path)
        for number in self.numbers(spark)[:-KEPT]:
            fs.delete(file_system(spark, self._file(number))[1], False)
        return True

    def _file(self, number: int) -> str:
        return f"{self.path}/_commits/{number:012d}.json"
