"""Structured Streaming pipelines."""

import json

import pytest
from conftest import raw_frame

import samples as S
from labrelay import current_rows, json_values, parse_messages
from labrelay.operators.errors import clean_rows
from labrelay.operators.quarantine import quarantine_rows, quarantined_messages
from labrelay.sinks.bucket_table import BucketTable
from labrelay.sinks.json_sink import JsonFileSink
from labrelay.sinks.quarantine_sink import QuarantineSink
from labrelay.sinks.table_sink import SnapshotTable
from labrelay.session import MADE_UP
from labrelay.sources.messages import RAW_SCHEMA, read_messages
from labrelay.streaming.pipeline import PipelineSpec, run_id, start_pipeline

ONCE = {"availableNow": True}


def write_messages(spark, path, messages, start):
    df = raw_frame(spark, messages, start)
    df.selectExpr("'lab-orders-ack' AS topic", "partition", "offset", "value").write.mode("append").parquet(path)


def run_once(spark, spec, ckpt):
    q = start_pipeline(spark, spec, checkpoint_location=ckpt, trigger=ONCE, query_name="acks")
    q.awaitTermination(120)
    assert q.exception() is None
    return q


def test_ack_pipeline_stream_equals_batch_and_restarts(spark, scratch_dir):
    src, ckpt = f"{scratch_dir}/in", f"{scratch_dir}/ckpt"
    json_sink = JsonFileSink(f"{scratch_dir}/json")
    table = SnapshotTable(f"{scratch_dir}/table", "ack")
    spec = PipelineSpec("ack", source_fmt="parquet", source_path=src,
                        source_options={"schema": RAW_SCHEMA}, json_sink=json_sink, table_sink=table)
    first = [S.ACK, S.ACK.replace("ack-0001", "ack-0002"), "  ", S.ACK_LINES[0]]
    write_messages(spark, src, first, 0)
    run_once(spark, spec, ckpt)

    got = sorted(r.value for r in spark.read.text(json_sink.path).collect())
    want = sorted(r.value for r in json_values(parse_messages(raw_frame(spark, first), "ack"), "ack").collect())
    assert got == want and len(got) == 2
    assert [r.message_id for r in table.read(spark).collect()] == ["ack-0002"]

    # restart with nothing new: no new output
    run_once(spark, spec, ckpt)
    assert spark.read.text(json_sink.path).count() == 2

    # a later batch with a NULL text overwrites the row
    later = S.ACK.replace("|Accepted", "|").replace("ack-0001", "ack-0003")
    write_messages(spark, src, [later], 10)
    run_once(spark, spec, ckpt)
    rows = table.read(spark).collect()
    assert [(r.message_id, r.acknowledgment_description) for r in rows] == [("ack-0003", None)]
    assert spark.read.text(json_sink.path).count() == 3
    assert json.loads(sorted(r.value for r in spark.read.text(json_sink.path).collect())[-1])


def test_new_checkpoint_keeps_what_an_earlier_run_wrote(spark, scratch_dir):
    src = f"{scratch_dir}/in"
    json_sink, table = JsonFileSink(f"{scratch_dir}/json"), SnapshotTable(f"{scratch_dir}/table", "ack")
    spec = PipelineSpec("ack", source_fmt="parquet", source_path=src, source_options={"schema": RAW_SCHEMA},
                        json_sink=json_sink, table_sink=table)
    write_messages(spark, src, [S.ACK], 0)
    run_once(spark, spec, f"{scratch_dir}/ckpt1")
    spec.source_path = f"{scratch_dir}/in2"
    write_messages(spark, spec.source_path, [S.FULL_ACK], 0)
    run_once(spark, spec, f"{scratch_dir}/ckpt2")
    assert sorted(r.value for r in spark.read.text(json_sink.path).collect()) == sorted([S.ACK_JSON, S.FULL_ACK_JSON])
    assert {r.message_id for r in table.read(spark).collect()} == {"ack-0001", "r-77"}


def test_permissive_pipeline_separates_bad_messages(spark, scratch_dir):
    src = f"{scratch_dir}/in"
    write_messages(spark, src, [S.ACK, S.ORDER, "hello world"], 0)
    spec = PipelineSpec("ack", source_fmt="parquet", source_path=src, source_options={"schema": RAW_SCHEMA}, mode="PERMISSIVE",
                        json_sink=JsonFileSink(f"{scratch_dir}/json"), table_sink=SnapshotTable(f"{scratch_dir}/table", "ack"))
    with pytest.raises(ValueError, match="error_sink"):
        start_pipeline(spark, spec, checkpoint_location=f"{scratch_dir}/ckpt", trigger=ONCE)
    spec.error_sink = JsonFileSink(f"{scratch_dir}/errors")
    run_once(spark, spec, f"{scratch_dir}/ckpt")
    assert [r.value for r in spark.read.text(spec.json_sink.path).collect()] == [S.ACK_JSON]
    assert spec.table_sink.read(spark).count() == 1
    errors = [json.loads(r.value) for r in spark.read.text(spec.error_sink.path).collect()]
    assert sorted(e["offset"] for e in errors) == [1, 2] and all(e["_error"] for e in errors)


def test_custom_kind_streams(spark, scratch_dir):
    from test_kinds import HEADERS

    src = f"{scratch_dir}/in"
    write_messages(spark, src, [S.RESULT], 0)
    spec = PipelineSpec(HEADERS, source_fmt="parquet", source_path=src, source_options={"schema": RAW_SCHEMA},
                        json_sink=JsonFileSink(f"{scratch_dir}/json"), table_sink=SnapshotTable(f"{scratch_dir}/table", HEADERS))
    run_once(spark, spec, f"{scratch_dir}/ckpt")
    assert [r.message_id for r in spec.table_sink.read(spark).collect()] == ["res-0001"]


def test_made_up_checkpoint_folder_is_refused(spark, scratch_dir):
    spec = PipelineSpec("ack", source_fmt="parquet", source_path=scratch_dir, source_options={"schema": RAW_SCHEMA})
    spark.conf.set(MADE_UP, spark.conf.get("spark.checkpoint.dir"))
    try:
        with pytest.raises(ValueError, match="shared folder"):
            start_pipeline(spark, spec)
    finally:
        spark.conf.unset(MADE_UP)


def test_bad_message_fails_the_stream(spark, scratch_dir):
    src = f"{scratch_dir}/in"
    write_messages(spark, src, [S.ORDER], 0)
    spec = PipelineSpec("ack", source_fmt="parquet", source_path=src, source_options={"schema": RAW_SCHEMA},
                        json_sink=JsonFileSink(f"{scratch_dir}/json"))
    q = start_pipeline(spark, spec, checkpoint_location=f"{scratch_dir}/ckpt", trigger=ONCE, query_name="bad")
    try:
        q.awaitTermination(120)
    except Exception as e:
        assert "Message is not an ACK message" in str(e)
    else:
        assert q.exception() is not None


def test_three_pipelines_in_one_application(spark, scratch_dir):
    from labrelay.streaming.pipeline import start_all

    specs = []
    for kind, msg, topic in (("order", S.ORDER, "lab-orders"), ("ack", S.ACK, "lab-orders-ack"),
                             ("result", S.RESULT, "lab-results")):
        src = f"{scratch_dir}/{kind}-in"
        raw_frame(spark, [msg]).selectExpr(f"'{topic}' AS topic", "partition", "offset", "value") \
            .write.parquet(src)
        specs.append(PipelineSpec(kind, source_fmt="parquet", source_path=src,
                                  source_options={"schema": RAW_SCHEMA},
                                  json_sink=JsonFileSink(f"{scratch_dir}/{kind}-json"),
                                  table_sink=SnapshotTable(f"{scratch_dir}/{kind}-table", kind)))
    queries = start_all(spark, specs, checkpoint_location=f"{scratch_dir}/ckpt", trigger=ONCE)
    for q in queries:
        q.awaitTermination(120)
        assert q.exception() is None
    expected = {"order": S.ORDER_JSON, "ack": S.ACK_JSON, "result": S.RESULT_JSON}
    for spec in specs:
        want = expected[spec.kind]
        assert [r.value for r in spark.read.text(f"{scratch_dir}/{spec.kind}-json").collect()] == [want]
        assert spec.table_sink.read(spark).count() == 1


def test_text_file_stream(spark, scratch_dir):
    import os

    src = f"{scratch_dir}/in"
    os.makedirs(src)
    with open(f"{src}/a.txt", "w", newline="") as f:
        f.write(S.ACK + "\n" + S.FULL_ACK + "\n")
    table = SnapshotTable(f"{scratch_dir}/table", "ack")
    spec = PipelineSpec("ack", source_fmt="text", source_path=src, json_sink=JsonFileSink(f"{scratch_dir}/json"),
                        table_sink=table)
    q = start_pipeline(spark, spec, checkpoint_location=f"{scratch_dir}/ckpt", trigger=ONCE, query_name="text")
    q.awaitTermination(120)
    assert q.exception() is None
    assert sorted(r.value for r in spark.read.text(f"{scratch_dir}/json").collect()) == sorted(
        [S.ACK_JSON, S.FULL_ACK_JSON])
    assert table.read(spark).count() == 2


def ack_of(key, i):
    return S.ACK.replace("ord-0001", key).replace("ack-0001", f"m{i}")


@pytest.mark.parametrize("size", [1 << 27, 700])
def test_streamed_text_keeps_the_order_of_its_file(spark, scratch_dir, size):
    """Messages of one key in one file and micro-batch: the last wins, also where the
    file is read in many pieces; a rerun agrees."""
    import os

    src = f"{scratch_dir}/in"
    os.makedirs(src)
    for name, first in (("a.txt", 0), ("b.txt", 100)):
        with open(f"{src}/{name}", "w", newline="") as f:
            f.writelines(ack_of(f"{name}{i % 7}", first + i) + "\n" for i in range(60))
    want = {f"{name}{i % 7}": f"m{first + i}" for name, first in (("a.txt", 0), ("b.txt", 100)) for i in range(60)}
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        for run in range(2):
            table = BucketTable(f"{scratch_dir}/table{run}", "ack", buckets=4)
            run_once(spark, PipelineSpec("ack", source_fmt="text", source_path=src, table_sink=table), f"{scratch_dir}/ckpt{run}")
            assert {r.ack_message_id: r.message_id for r in table.read(spark).collect()} == want
        batch = current_rows(parse_messages(read_messages(spark, "ack", fmt="text", path=src), "ack"), "ack")
        assert {r.ack_message_id: r.message_id for r in batch.collect()} == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_counts_come_with_the_sinks_jobs(spark, scratch_dir):
    def jobs(on_batch, k):
        src = f"{scratch_dir}/in{k}"
        write_messages(spark, src, [S.ACK, S.FULL_ACK, S.ORDER, "  ", "", None, S.ACK_LINES[0], "hello"], 0)
        spec = PipelineSpec("ack", source_fmt="parquet", source_path=src, source_options={"schema": RAW_SCHEMA}, mode="PERMISSIVE",
                            json_sink=JsonFileSink(f"{scratch_dir}/json{k}"), table_sink=BucketTable(f"{scratch_dir}/table{k}", "ack"),
                            error_sink=JsonFileSink(f"{scratch_dir}/errors{k}"), on_batch=on_batch)
        tracker = spark.sparkContext.statusTracker()
        q = run_once(spark, spec, f"{scratch_dir}/ckpt{k}")
        return len(tracker.getJobIdsForGroup(str(q.runId)))

    got = []
    counted, plain = jobs(got.append, 0), jobs(None, 1)
    assert counted == plain and len(got) == 1
    run = got[0].pop("run")
    assert len(run) == 32 and got[0] == {"batch_id": 0, "read": 8, "empty": 2, "blank": 1, "malformed": 2, "keyless": 1, "records": 2}


def test_quarantined_messages_come_back(spark, scratch_dir):
    from pyspark.sql import functions as F

    src = f"{scratch_dir}/in"
    bad = ack_of("late", 7).replace("|P|2.5", "|P|2.3").encode() + b"\xff"
    write_messages(spark, src, [S.ACK, bad, "hello world"], 0)
    quarantine, table = QuarantineSink(f"{scratch_dir}/quarantine"), BucketTable(f"{scratch_dir}/table", "ack")
    spec = PipelineSpec("ack", source_fmt="parquet", source_path=src, source_options={"schema": RAW_SCHEMA}, mode="PERMISSIVE",
                        table_sink=table, quarantine_sink=quarantine)
    run_once(spark, spec, f"{scratch_dir}/ckpt")
    rows = quarantine.read(spark)
    assert {(r.kind, r.topic, r.offset, bytes(r.value)) for r in rows.collect()} == {
        ("ack", "lab-orders-ack", 1, bad), ("ack", "lab-orders-ack", 2, b"hello world")}
    repaired = quarantined_messages(rows, "ack", F.replace(F.decode("value", "ISO-8859-1"), F.lit("|2.3"), F.lit("|2.5")))
    again = parse_messages(repaired, "ack", mode="PERMISSIVE")
    table.upsert(clean_rows(again, "ack_message_id"), 0, "replay-1")
    assert {r.ack_message_id: r.message_id for r in table.read(spark).collect()} == {"ord-0001": "ack-0001", "late": "m7"}
    assert [bytes(r.value) for r in quarantine_rows(again, "ack").collect()] == [b"hello world"]


def test_a_run_id_that_was_not_finished_is_made_again(spark, scratch_dir):
    import os

    os.makedirs(f"{scratch_dir}/ckpt")
    open(f"{scratch_dir}/ckpt/labrelay-run-id", "w").close()
    first = run_id(spark, f"{scratch_dir}/ckpt")
    assert len(first) == 32 and run_id(spark, f"{scratch_dir}/ckpt") == first != run_id(spark, f"{scratch_dir}/other")
