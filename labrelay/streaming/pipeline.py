"""Structured Streaming pipelines.

One query per message kind, of the reference's shape::

    source -> foreachBatch { decode/drop blank -> shred -> key filter ->
        JSON extract sink ; dedupe -> upsert into the current-state table }

A micro-batch is parsed as a batch, so that rows of text files get their position
(``sources.messages.with_position``); offsets and replays stay Spark's.

* stateless: no watermark, no event time, append semantics (G1);
* fan-out: the parsed micro-batch is persisted once and written to both sinks,
  then unpersisted (G2);
* three pipelines in one application, ``await_any`` waits on all (G3);
* checkpoints: one fixed location and query name per pipeline, so offsets
  survive restarts and a restarted query resumes where it stopped; sources
  start from the earliest offset only on a fresh checkpoint (G4, G5, G7);
* the default trigger fires every 10 s like the reference's checkpoint
  interval; tests use ``availableNow`` (G4, G8);
* replays: a run (the life of one checkpoint) has an id that is kept beside its
  offsets, and sinks get it with the batch number: a batch that is replayed
  changes nothing, a new run never overwrites an earlier one's output (G6);
* malformed messages: FAILFAST stops the query, and says where the message stands.
  PERMISSIVE sends rows with an ``_error``, keyed or not, to ``error_sink`` (JSON
  report), ``quarantine_sink`` (raw messages, to be replayed) or both, and only clean
  rows to the others; without either it refuses to start (H2);
* counts: ``on_batch`` gets every micro-batch's counts (``operators.counts``), taken on
  the way by Spark's observed metrics, without a job of their own (G2, H1);
* a micro-batch is bounded: ``max_per_trigger`` offsets (Kafka) or files, so the
  first batch of a long topic is not the whole topic. Nothing is dropped: what
  is left comes with the next batch. Raise it with the cluster's size.

The checkpoint root comes from the session (``spark.sql.streaming.
checkpointLocation``, else ``spark.checkpoint.dir``) unless given; a folder
that ``labrelay.session`` made up for local runs is refused.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.counts import BatchCounts
from ..operators.errors import clean_rows
from ..operators.quarantine import quarantine_rows
from ..plans.batch import error_values, json_values, parse_messages
from ..plans.kinds import MessageKind, get_kind
from ..session import MADE_UP
from ..sinks.commit_log import file_system, read_file, write_once
from ..sources.messages import read_messages, with_position

# Fixed value: the reference checkpoints every 10 seconds.
DEFAULT_TRIGGER = {"processingTime": "10 seconds"}


@dataclass
class PipelineSpec:
    kind: str | MessageKind
    source_fmt: str = "kafka"
    source_path: str | None = None
    source_options: dict | None = None
    json_sink: object | None = None  # has .write(df, batch_id, run_id)
    table_sink: object | None = None  # has .upsert(records, batch_id, run_id)
    mode: str = "FAILFAST"
    error_sink: object | None = None  # has .write(df, batch_id, run_id); PERMISSIVE only
    quarantine_sink: object | None = None  # the same, of quarantined messages
    on_batch: Callable[[dict], None] | None = None  # gets run, batch_id and counts once a batch's sinks are written
    max_per_trigger: int | None = None  # offsets or files of one batch; None: the default of the source


# Offsets (Kafka) and files of one micro-batch.
MAX_OFFSETS, MAX_FILES = 1_000_000, 1_000


def checkpoint_root(spark: SparkSession, given: str | None = None) -> str:
    root = (
        given
        or spark.conf.get("spark.sql.streaming.checkpointLocation", None)
        or spark.conf.get("spark.checkpoint.dir", None)
    )
    if not root or (not given and root == spark.conf.get(MADE_UP, None)):
        raise ValueError("set spark.checkpoint.dir to a shared folder (or pass checkpoint_location) to run a pipeline")
    return root.rstrip("/")


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the run that lives in ``checkpoint``: made on its first start, kept beside its offsets."""
    path = f"{checkpoint}/labrelay-run-id"
    fs, p = file_system(spark, path)
    if fs.exists(p):
        if found := read_file(spark, path).strip():
            return found
        fs.delete(p, False)  # of a driver lost while it wrote; nothing can have run under it
    write_once(spark, path, uuid.uuid4().hex)
    return read_file(spark, path).strip()


def micro_batch_writer(spec: PipelineSpec, run: str):
    """The ``foreachBatch`` function: persist once, write the sinks, release."""
    kind = get_kind(spec.kind)

    def write(raw: DataFrame, batch_id: int) -> None:
        counts = BatchCounts() if spec.on_batch else None
        batch = parse_messages(with_position(raw), kind, spec.mode, counts=counts).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            clean = clean_rows(batch, kind.key)
            if spec.mode.upper() == "PERMISSIVE":
                if spec.error_sink is not None:
                    spec.error_sink.write(error_values(batch, kind), batch_id, run)
                if spec.quarantine_sink is not None:
                    spec.quarantine_sink.write(quarantine_rows(batch, kind), batch_id, run)
            if spec.json_sink is not None:
                spec.json_sink.write(json_values(clean, kind), batch_id, run)
            if spec.table_sink is not None:
                spec.table_sink.upsert(clean, batch_id, run)
            if spec.on_batch:
                spec.on_batch({"run": run, "batch_id": batch_id, **counts.get()})
        finally:
            batch.unpersist()

    return write


def start_pipeline(
    spark: SparkSession,
    spec: PipelineSpec,
    checkpoint_location: str | None = None,
    trigger: dict | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    kind = get_kind(spec.kind)
    if spec.mode.upper() == "PERMISSIVE" and spec.error_sink is None and spec.quarantine_sink is None:
        raise ValueError("a PERMISSIVE pipeline needs an error_sink or a quarantine_sink for its malformed messages")
    if spec.on_batch and not any((spec.json_sink, spec.table_sink, spec.error_sink, spec.quarantine_sink)):
        raise ValueError("a batch is counted while a sink writes it: on_batch needs a sink")
    name = query_name or f"lab-{kind.name}-pipeline"
    checkpoint = f"{checkpoint_root(spark, checkpoint_location)}/{name}"
    options = dict(spec.source_options or {})
    if spec.source_fmt == "kafka":
        options.setdefault("maxOffsetsPerTrigger", str(spec.max_per_trigger or MAX_OFFSETS))
    else:
        options.setdefault("maxFilesPerTrigger", str(spec.max_per_trigger or MAX_FILES))
    raw = read_messages(spark, kind, fmt=spec.source_fmt, path=spec.source_path, streaming=True, options=options)
    writer = (
        raw.writeStream.queryName(name)
        .foreachBatch(micro_batch_writer(spec, run_id(spark, checkpoint)))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or DEFAULT_TRIGGER))
    )
    return writer.start()


def start_all(
    spark: SparkSession,
    specs: list[PipelineSpec],
    checkpoint_location: str | None = None,
    trigger: dict | None = None,
) -> list[StreamingQuery]:
    """Start one pipeline per spec (normally orders, acks, results)."""
    return [start_pipeline(spark, s, checkpoint_location, trigger) for s in specs]


def await_any(spark: SparkSession, timeout_s: float | None = None) -> bool | None:
    """Block until any pipeline stops (a failure surfaces here)."""
    if timeout_s is None:
        return spark.streams.awaitAnyTermination()
    return spark.streams.awaitAnyTermination(int(timeout_s * 1000))
