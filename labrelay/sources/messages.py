"""Raw message sources.

Every source yields the Kafka record shape: ``value`` (binary or string) plus
arrival columns ``topic, partition, offset`` (plus ``timestamp`` for Kafka, which
orders nothing by default, and ``file_time`` for files without offsets).

``fmt``:

* ``kafka``   - ``spark.read[Stream].format("kafka")``: one topic per kind,
  ``startingOffsets=earliest`` on first start; a restarted stream resumes from
  its checkpoint (the option only applies to a fresh checkpoint).
  ``minPartitions`` defaults to the cluster's parallelism so that a topic
  partition holding most of the messages is read by several tasks. Needs the
  Kafka connector on the classpath (not installed here).
* ``parquet`` - files with at least ``value``; ``partition``/``offset`` if
  present, else arrival is derived from the file and row position.
* ``text``    - one message per record, in the order of the file, split at ``lineSep`` (default LF
  only - Spark's own default also splits at CR - so CR-separated segments
  stay inside one message; for framed files use e.g. ``lineSep='\\x1c'``).
* ``fixture`` - messages rendered from the driver's tables (tests, bench);
  ``path`` is the table directory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from ..functions.plan import spread
from ..operators.messages import ARRIVAL_COLUMNS
from ..plans.kinds import MessageKind, get_kind
from . import fixtures

RAW_SCHEMA = StructType(
    [
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("value", BinaryType()),
    ]
)

FORMATS = ("kafka", "parquet", "text", "fixture")


def read_messages(
    spark: SparkSession,
    kind: str | MessageKind,
    fmt: str = "parquet",
    path: str | None = None,
    streaming: bool = False,
    topic: str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Raw messages of one kind as a (streaming) DataFrame in the Kafka shape."""
    k = get_kind(kind)
    opts = dict(options or {})
    topic = topic or k.default_topic
    if fmt == "kafka":
        reader = spark.readStream if streaming else spark.read
        opts.setdefault("subscribe", topic)
        opts.setdefault("startingOffsets", "earliest")
        # a hot topic partition is split into several tasks by offset range;
        # order is carried by the (partition, offset) columns
        opts.setdefault("minPartitions", str(spark.sparkContext.defaultParallelism))
        df = reader.format("kafka").options(**opts).load()
        return df.select("topic", "partition", "offset", "timestamp", "value")
    if fmt == "parquet":
        if path is None:
            raise ValueError("parquet source needs a path")
        if streaming:
            schema = opts.pop("schema", None) or RAW_SCHEMA
            df = spark.readStream.schema(schema).options(**opts).parquet(path)
        else:
            df = spark.read.options(**opts).parquet(path)
        return _with_arrival(df, topic, fmt, streaming)
    if fmt == "text":
        if path is None:
            raise ValueError("text source needs a path")
        reader = spark.readStream if streaming else spark.read
        # Spark's own default splits at CR too, which would cut every message
        opts.setdefault("lineSep", "\n")
        df = reader.options(**opts).text(path)
        return _with_arrival(df, topic, fmt, streaming)
    if fmt == "fixture":
        if streaming:
            raise ValueError("the fixture source is batch only; write it to parquet to stream it")
        return fixture_messages(spark, path, k.name)
    raise ValueError(f"fmt must be one of {FORMATS}, got {fmt!r}")


def _with_arrival(df: DataFrame, topic: str, fmt: str, streaming: bool) -> DataFrame:
    """Add ``topic/partition/offset`` when a file source lacks them.

    Without an ``offset``, arrival order is (file modification time, file, position
    in file): ``file_time``, ``partition`` (the table's own, else a hash of the file
    name) and ``offset``, the row's position in the file. Parquet knows it
    (``_metadata.row_index``). Text does not: ``file_block`` says where the row's piece of
    the file begins, and ``offset`` counts up within a piece (``with_position``).
    Streams can't count, so a streaming text frame has no ``offset`` until
    ``with_position`` gives each micro-batch one, as pipelines do.
    """
    cols = df.columns
    out = df
    if "topic" not in cols:
        out = out.withColumn("topic", F.lit(topic))
    if "offset" not in cols:
        meta = F.col("_metadata")
        added = [meta["file_modification_time"].alias("file_time")]
        added.append(meta["row_index"].alias("offset") if fmt == "parquet" else meta["file_block_start"].alias("file_block"))
        if "partition" not in cols:
            added.append(F.hash(meta["file_name"]).alias("partition"))
        out = out.drop("file_time").select("*", *added)
        if not streaming:
            out = with_position(out)
    elif "partition" not in cols:
        out = out.withColumn("partition", F.lit(0))
    keep = [c for c in ("topic", *ARRIVAL_COLUMNS, "timestamp", "value") if c in out.columns]
    return out.select(*keep)


def with_position(df: DataFrame) -> DataFrame:
    """A batch, or micro-batch, of text messages with ``offset``: a task reads a piece
    of a file in order, so its row numbers grow along the piece. Frames that have
    an offset stay as they are."""
    return df if "offset" in df.columns else df.withColumn("offset", F.monotonically_increasing_id())


# The columns a source table of the renderers is spread by. Orders are
# spread behind their join (``fixtures.render_orders``).
FIXTURE_KEYS = {"events": ("event_id", "user_id"), "lineitem": ("l_orderkey",)}


def fixture_table(spark: SparkSession, table_dir: str, name: str) -> DataFrame:
    """A source table of the renderers, spread evenly (like the partitions of a topic)
    before any message is rendered. The splits of a scan say nothing about its rows: a
    file of one row group is read by one task however many splits it has. Lineitem is
    spread by the renderer's group key."""
    df = spark.read.parquet(f"{table_dir}/{name}.parquet")
    return spread(df, *FIXTURE_KEYS[name]) if name in FIXTURE_KEYS else df


def fixture_messages(spark: SparkSession, table_dir: str, kind: str) -> DataFrame:
    """Messages of ``kind`` rendered from the tables in ``table_dir``."""

    def t(name: str) -> DataFrame:
        return fixture_table(spark, table_dir, name)

    k = get_kind(kind).name
    if k == "order":
        return fixtures.render_orders(t("orders"), t("customer"))
    if k == "ack":
        return fixtures.render_acks(t("events"))
    return fixtures.render_results(t("lineitem"))
