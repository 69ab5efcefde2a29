"""Message sources and generic accessors."""

import os

from conftest import raw_frame

import samples as S
from labrelay import json_values, parse_messages
from labrelay.plans.batch import delimiters, extract_fields
from labrelay.sources.messages import read_messages


def test_text_source_keeps_cr_segments_together(spark, scratch_dir):
    path = os.path.join(scratch_dir, "acks")
    os.makedirs(path)
    with open(os.path.join(path, "part-0.txt"), "w", newline="") as f:
        f.write(S.ACK + "\n" + S.FULL_ACK + "\n")
    raw = read_messages(spark, "ack", fmt="text", path=path)
    assert set(raw.columns) >= {"topic", "partition", "offset", "value"}
    got = sorted(r.value for r in json_values(parse_messages(raw, "ack"), "ack").collect())
    assert got == sorted([S.ACK_JSON, S.FULL_ACK_JSON])


def test_parquet_source_without_offsets(spark, scratch_dir):
    path = os.path.join(scratch_dir, "orders")
    raw_frame(spark, [S.ORDER, S.FULL_ORDER]).select("value").write.parquet(path)
    raw = read_messages(spark, "order", fmt="parquet", path=path)
    assert raw.select("partition", "offset").distinct().count() == 2  # arrival = (file, row)
    assert parse_messages(raw, "order").count() == 2


def test_file_sources_with_a_timestamp_but_no_offset(spark, scratch_dir):
    from pyspark.sql import functions as F

    for columns in (["value", "timestamp"], ["value", "timestamp", "partition"]):
        path = os.path.join(scratch_dir, "-".join(columns))
        raw_frame(spark, [S.ACK, S.FULL_ACK]).withColumn("timestamp", F.current_timestamp()).select(*columns).write.parquet(path)
        raw = read_messages(spark, "ack", fmt="parquet", path=path)
        assert set(raw.columns) == {"topic", "file_time", "partition", "offset", "timestamp", "value"}
        got = sorted(r.value for r in json_values(parse_messages(raw, "ack"), "ack").collect())
        assert got == sorted([S.ACK_JSON, S.FULL_ACK_JSON])


def test_where_reaches_the_scan(spark, scratch_dir):
    path = os.path.join(scratch_dir, "acks")
    raw_frame(spark, [S.ACK, S.FULL_ACK]).write.parquet(path)
    raw = read_messages(spark, "ack", fmt="parquet", path=path)
    df = parse_messages(raw, "ack", where="partition = 0 AND offset > 0")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(partition,0)" in plan and "GreaterThan(offset,0)" in plan
    assert [r.message_id for r in df.collect()] == ["r-77"]


def test_extract_fields_and_delimiters(spark):
    raw = raw_frame(spark, [S.ORDER, S.ACK.replace("|", "#").replace("^", "$")])
    out = extract_fields(raw, {"sender": "MSH-4.2", "pid": "PID-3", "ctl": "MSH-10", "msa": "MSA-3"}).collect()
    assert (out[0].sender, out[0].pid, out[0].ctl, out[0].msa) == ("10010001", "NP-000-1", "ord-0001", None)
    assert (out[1].sender, out[1].pid, out[1].ctl, out[1].msa) == ("L7", None, "ack-0001", "Accepted")
    d = delimiters(raw).collect()
    assert [(r.field_separator, r.component_separator) for r in d] == [("|", "^"), ("#", "$")]


def test_unknown_field_reference(spark):
    import pytest

    with pytest.raises(ValueError):
        extract_fields(raw_frame(spark, [S.ORDER]), {"x": "PID3"})
