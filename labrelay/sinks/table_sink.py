"""Current-state table sinks: keyed last-write-wins upserts.

Both sinks take the parsed records of one micro-batch (arrival columns
included), dedupe them per key (``plans.batch.current_rows``: latest arrival,
then JSON for nested columns), and apply them so that the later message wins,
NULLs included.

* ``BucketTable`` (``bucket_table``) - hash buckets of the key, each a list of parquet
  pieces; a batch writes only pieces of the buckets its keys fall in.
* ``SnapshotTable`` - versioned parquet snapshots ``<path>/version=<n>-<run>-<batch>``;
  each batch rewrites the whole state (for small tables). Commit records
  (``commit_log``) apart from the versions say which one holds and which batches of
  which run (the life of one checkpoint) are in it: a replayed batch changes
  nothing, however many versions ago it was, a run on a new checkpoint, whose
  batches count from 0 again, builds on what is there, and of two writers the slower
  one builds on the other's version. Versions beyond the newest ``keep_versions`` are deleted.
* ``JdbcUpsertTable`` - the deduplicated batch goes to the run's staging table
  with Spark's JDBC writer (parallel, batched inserts). Then one transaction moves the
  run's row in the batch table (run, target, last batch) to this batch and applies one
  set-based ``INSERT ... SELECT ... ON CONFLICT (key) DO UPDATE``: both or neither are
  committed, and a batch that the batch table already holds is left out, so a replay
  never puts older rows back. Staging and transaction are retried together (default 5
  tries, 5 s apart, a new connection each time), then the batch fails. A restarted
  driver stages into the same table as the one that was lost, so none is left over. Deduping first matters: one
  ``ON CONFLICT`` statement may not touch a key twice. ``connections`` bounds the
  parallel connections of the writer: it merges tasks and drops nothing. Needs
  the database's JDBC driver on the classpath (none here).
"""

from __future__ import annotations

import re
import time
import uuid
from contextlib import contextmanager, suppress
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ..operators.upsert import merge_current
from ..plans.batch import current_rows
from ..plans.kinds import SCHEMA, MessageKind, get_kind
from .commit_log import CommitLog, file_system

VERSION_NAME = re.compile(r"version=(\d+)(?:-(.+)-(\d+))?")


def complete_versions(spark: SparkSession, path: str) -> list[tuple[int, str | None, int | None, str]]:
    """(number, run, batch, folder name) of the versions under ``path`` whose write
    finished (``_SUCCESS`` present), oldest first."""
    fs, root = file_system(spark, path)
    if not fs.exists(root):
        return []
    out = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        m = VERSION_NAME.fullmatch(name)
        if m and st.isDirectory() and fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            out.append((int(m[1]), m[2], int(m[3]) if m[3] else None, name))
    return sorted(out, key=lambda v: v[0])


@dataclass
class SnapshotTable:
    path: str
    kind: str | MessageKind
    keep_versions: int = 3
    order: Sequence[str] | None = None  # columns that decide which row is later; default: arrival

    tries: int = 20  # for writers that lose races

    def current(self, spark: SparkSession) -> DataFrame | None:
        version = CommitLog(self.path).newest(spark).state.get("version")
        return spark.read.parquet(f"{self.path}/{version}") if version else None

    def read(self, spark: SparkSession) -> DataFrame:
        df = self.current(spark)
        if df is None:
            raise FileNotFoundError(f"no complete snapshot under {self.path}")
        return df

    def upsert(self, records: DataFrame, batch_id: int, run_id: str = "batch") -> None:
        k = get_kind(self.kind)
        spark, log = records.sparkSession, CommitLog(self.path)
        for _ in range(self.tries):
            commit = log.newest(spark)
            if commit.holds(run_id, batch_id):
                return  # a replay of a batch that is in the table
            batch = current_rows(records, k, self.order)
            base = self.current(spark)
            merged = batch if base is None else merge_current(base, batch, k.key)
            version = f"version={commit.number + 1}-{run_id}-{batch_id}"
            merged.write.mode("overwrite").parquet(f"{self.path}/{version}")
            if log.append(spark, commit.next(run_id, batch_id, {"version": version})):
                self._prune(spark, commit.number + 1)
                return
        raise RuntimeError(f"lost {self.tries} races for a version under {self.path}")

    def _prune(self, spark: SparkSession, newest: int) -> None:
        for number, _, _, name in complete_versions(spark, self.path):
            if number <= newest - max(1, self.keep_versions):
                fs, p = file_system(spark, f"{self.path}/{name}")
                fs.delete(p, True)


def upsert_sql(kind: str | MessageKind, target: str, staging: str, json_type: str = "jsonb") -> str:
    """``INSERT ... SELECT ... ON CONFLICT (key) DO UPDATE`` from a staging table.

    Every non-key column is overwritten by the incoming row, NULLs included
    (no COALESCE), as in the reference. Nested columns arrive as JSON text
    and are cast to ``json_type``.
    """
    k = get_kind(kind)
    cols = list(k.table_columns)
    select = ", ".join(f"{c}::{json_type}" if c in k.json_columns else c for c in cols)
    updates = ", ".join(f"{c} = EXCLUDED.{c}" for c in cols if c != k.key)
    return (
        f"INSERT INTO {target} ({', '.join(cols)}) "
        f"SELECT {select} FROM {staging} "
        f"ON CONFLICT ({k.key}) DO UPDATE SET {updates}"
    )


def batches_sql(table: str) -> str:
    """The batch table: the last batch of each run and target."""
    return (f"CREATE TABLE IF NOT EXISTS {table} (run_id VARCHAR(64), target VARCHAR(200), batch_id BIGINT NOT NULL, "
            "PRIMARY KEY (run_id, target))")


def mark_sql(table: str) -> str:
    """Moves a run's row to a batch; touches no row if the batch is not above it."""
    return (f"INSERT INTO {table} (run_id, target, batch_id) VALUES (?, ?, ?) ON CONFLICT (run_id, target) "
            f"DO UPDATE SET batch_id = EXCLUDED.batch_id WHERE {table}.batch_id < EXCLUDED.batch_id")


@dataclass
class JdbcUpsertTable:
    url: str
    kind: str | MessageKind
    table: str | None = None  # default: the kind's table in ``schema``
    schema: str = SCHEMA
    properties: dict[str, str] = field(default_factory=dict)
    retries: int = 5
    delay_s: float = 5.0
    connections: int = 8
    order: Sequence[str] | None = None
    batches: str | None = None  # default: ``labrelay_batches`` in ``schema``
    own_run: str = field(default_factory=lambda: uuid.uuid4().hex)  # for batches given without a run

    @property
    def target(self) -> str:
        return self.table or f"{self.schema}.{get_kind(self.kind).table}"

    @property
    def batch_table(self) -> str:
        return self.batches or f"{self.schema}.labrelay_batches"

    def staging(self, run_id: str) -> str:
        """The staging table of a run: its next driver writes over what a lost one left."""
        return f"{self.target}_staging_{re.sub('[^A-Za-z0-9]', '', run_id)[:12]}"

    def upsert(self, records: DataFrame, batch_id: int, run_id: str | None = None) -> None:
        k, run = get_kind(self.kind), run_id or self.own_run
        batch = current_rows(records, k, self.order).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for attempt in range(1, self.retries + 1):
                try:
                    self._apply(batch, run, batch_id)
                    return
                except Exception as e:  # py4j wraps SQLExceptions
                    if attempt == self.retries:
                        raise RuntimeError(f"upsert failed after {self.retries} attempts") from e
                    time.sleep(self.delay_s)
        finally:
            batch.unpersist()

    def _apply(self, batch: DataFrame, run: str, batch_id: int) -> None:
        """One try: staging, then batch table and target in one transaction. A batch of a run
        that the batch table holds already is staged in vain and changes nothing."""
        spark, staging = batch.sparkSession, self.staging(run)
        self._stage(batch, staging)
        with self._connected(spark) as conn:
            self._update(conn, batches_sql(self.batch_table))
            conn.setAutoCommit(False)
            try:
                if self._update(conn, mark_sql(self.batch_table), run, self.target, batch_id):
                    self._update(conn, upsert_sql(self.kind, self.target, staging))
                conn.commit()
            except Exception:
                with suppress(Exception):
                    conn.rollback()
                raise
            conn.setAutoCommit(True)
            with suppress(Exception):  # the batch is in; the run's next batch overwrites what stays
                self._update(conn, f"DROP TABLE {staging}")

    def _stage(self, batch: DataFrame, staging: str) -> None:
        properties = {**self.properties, "numPartitions": str(self.connections)}
        batch.write.mode("overwrite").jdbc(self.url, staging, properties=properties)

    def _connect(self, spark: SparkSession):
        jvm = spark.sparkContext._jvm
        props = jvm.java.util.Properties()
        for key, v in self.properties.items():
            props.setProperty(key, v)
        return jvm.java.sql.DriverManager.getConnection(self.url, props)

    @contextmanager
    def _connected(self, spark: SparkSession):
        conn = self._connect(spark)
        try:
            yield conn
        finally:
            conn.close()

    def _update(self, conn, sql: str, *values) -> int:
        """Runs a statement; the number of rows it touched."""
        stmt = conn.prepareStatement(sql)
        try:
            for i, v in enumerate(values, 1):
                stmt.setLong(i, v) if isinstance(v, int) else stmt.setString(i, v)
            return stmt.executeUpdate()
        finally:
            stmt.close()
