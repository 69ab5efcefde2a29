"""Keyed last-write-wins upserts."""

import json

import pytest
from conftest import raw_frame

import samples as S
from labrelay import current_rows, json_values, parse_messages, table_rows
from labrelay.operators.messages import BROKER_TIME_ORDER
from labrelay.operators.upsert import latest_per_key, merge_current
from labrelay.sinks.table_sink import JdbcUpsertTable, SnapshotTable, batches_sql, complete_versions, mark_sql, upsert_sql


def ack_rows(spark, messages, start=0):
    return table_rows(parse_messages(raw_frame(spark, messages, start), "ack"), "ack")


def test_later_message_wins_including_nulls(spark):
    later = S.ACK.replace("|Accepted", "|").replace("ack-0001", "ack-0002")
    rows = ack_rows(spark, [S.ACK, later])
    out = latest_per_key(rows, "ack_message_id").collect()
    assert len(out) == 1
    assert out[0].message_id == "ack-0002"
    assert out[0].acknowledgment_description is None  # NULL overwrites


def test_arrival_not_event_time_decides(spark):
    older_event = S.ACK.replace("20240305101600", "20200101000000").replace("ack-0001", "ack-0009")
    out = latest_per_key(ack_rows(spark, [S.ACK, older_event]), "ack_message_id").collect()
    assert out[0].message_id == "ack-0009"


def test_merge_current_batch_wins(spark):
    first = latest_per_key(ack_rows(spark, [S.ACK]), "ack_message_id")
    second = ack_rows(spark, [S.ACK.replace("ack-0001", "ack-0002")], start=0)
    merged = merge_current(first, second, "ack_message_id").collect()
    assert [r.message_id for r in merged] == ["ack-0002"]


def test_latest_per_key_plan_has_partial_aggregation(spark):
    rows = ack_rows(spark, [S.ACK])
    plan = latest_per_key(rows, "ack_message_id")._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan


def test_snapshot_table_versions_and_replay(spark, scratch_dir):
    t = SnapshotTable(f"{scratch_dir}/acks", "ack")

    def recs(msgs):
        return parse_messages(raw_frame(spark, msgs), "ack")

    t.upsert(recs([S.ACK]), 0)
    t.upsert(recs([S.ACK.replace("ack-0001", "ack-0002")]), 1)
    t.upsert(recs([S.ACK.replace("ack-0001", "ack-0002")]), 1)  # replay
    rows = t.read(spark).collect()
    assert [r.message_id for r in rows] == ["ack-0002"]


def test_snapshot_table_outlives_a_checkpoint(spark, scratch_dir):
    """A run on a new checkpoint counts batches from 0 again and builds on what is there."""
    from labrelay.sinks.json_sink import JsonFileSink

    t, sink = SnapshotTable(f"{scratch_dir}/acks", "ack", keep_versions=1), JsonFileSink(f"{scratch_dir}/json")

    def recs(key):
        return parse_messages(raw_frame(spark, [S.ACK.replace("ord-0001", key)]), "ack")

    def batch(key, n, run):
        t.upsert(recs(key), n, run)
        sink.write(json_values(recs(key), "ack"), n, run)

    for n in range(3):
        batch(f"a{n}", n, "first")
    batch("b0", 0, "second")
    batch("b0", 0, "second")  # replay
    batch("b1", 1, "second")
    assert {r.ack_message_id for r in t.read(spark).collect()} == {"a0", "a1", "a2", "b0", "b1"}
    assert [v[:3] for v in complete_versions(spark, t.path)] == [(4, "second", 1)]
    keys = [json.loads(r.value)["ack_message_id"] for r in spark.read.text(sink.path).collect()]
    assert sorted(keys) == ["a0", "a1", "a2", "b0", "b1"]


def test_offset_decides_against_the_producers_clock(spark):
    from pyspark.sql import functions as F

    raw = raw_frame(spark, [S.ACK, S.ACK.replace("ack-0001", "ack-0002")])
    raw = raw.withColumn("timestamp", F.timestamp_seconds(F.lit(100) - F.col("offset")))
    recs = parse_messages(raw, "ack")
    assert [r.message_id for r in current_rows(recs, "ack").collect()] == ["ack-0002"]
    assert [r.message_id for r in current_rows(recs, "ack", order=BROKER_TIME_ORDER).collect()] == ["ack-0001"]


class FakeJdbc(JdbcUpsertTable):
    """Records staging, statements and transactions; the first ``failures`` calls fail. Its
    batch table is a dict that keeps what is committed."""

    def prepare(self, failures=0, fail_at=None):
        self.calls, self.failures, self.fail_at, self.dropped = [], failures, fail_at, 0
        self.marks = getattr(self, "marks", {})
        self.open = {}

    def call(self, what):
        self.calls.append(what)
        if self.failures or (self.fail_at and self.fail_at in what):
            self.failures, self.fail_at = max(0, self.failures - 1), None
            raise ConnectionError(what)

    def _stage(self, batch, staging):
        self.call(f"stage {staging} {batch.count()}")

    def _connect(self, spark):
        self.calls.append("connect")
        self.open = {}
        return self

    def setAutoCommit(self, on):
        self.calls.append(f"autocommit {on}")

    def commit(self):
        self.call("commit")
        self.marks.update(self.open)

    def rollback(self):
        self.calls.append("rollback")
        self.open = {}

    def close(self):
        self.calls.append("close")

    def _update(self, conn, sql, *values):
        words = sql.split(" ")
        self.call(" ".join(["CREATE", words[5]] if words[0] == "CREATE" else [words[0], words[2]]))
        if values:
            run, target, batch = values
            if self.marks.get((run, target), -1) >= batch:
                return 0
            self.open[run, target] = batch
        return 1


def test_jdbc_batch_and_its_record_are_one_transaction(spark):
    recs = parse_messages(raw_frame(spark, [S.ACK]), "ack")
    sink = FakeJdbc("jdbc:none", "ack", delay_s=0)
    staging, target, batches = sink.staging("run-1"), "crt.lab_orders_ack", "crt.labrelay_batches"
    assert staging == "crt.lab_orders_ack_staging_run1" == FakeJdbc("jdbc:none", "ack").staging("run-1")
    stage, begin = f"stage {staging} 1", ["connect", f"CREATE {batches}", "autocommit False"]
    mark, done = f"INSERT {batches}", ["commit", "autocommit True", f"DROP {staging}", "close"]
    one = [stage, *begin, mark, f"INSERT {target}", *done]

    sink.prepare(1)  # staging fails once: the whole try again
    sink.upsert(recs, 0, "run-1")
    assert sink.calls == [stage, *one]
    for where in (f"INSERT {target}", "commit"):  # nothing stays of a try that fails before its commit
        sink.prepare(fail_at=where)
        sink.marks.clear()
        sink.upsert(recs, 1, "run-1")
        failed = one[:one.index(where) + 1] + ["rollback", "close"]
        assert sink.calls == [*failed, *one] and sink.marks == {("run-1", target): 1}
    for old in (0, 1):  # replays touch the target no more
        sink.prepare()
        sink.upsert(recs, old, "run-1")
        assert sink.calls == [stage, *begin, mark, *done]
    sink.prepare()
    sink.upsert(recs, 0, "run-2")  # a run of its own
    assert f"INSERT {target}" in sink.calls
    sink.prepare(fail_at=f"DROP {staging}")  # the batch is in: no second try
    sink.upsert(recs, 2, "run-1")
    assert sink.calls == one
    sink.prepare(99)
    with pytest.raises(RuntimeError, match="after 5 attempts"):
        sink.upsert(recs, 3, "run-1")
    assert sink.calls == [stage] * 5


def test_batch_table_statements():
    assert mark_sql("b") == ("INSERT INTO b (run_id, target, batch_id) VALUES (?, ?, ?) ON CONFLICT (run_id, target) DO UPDATE SET "
                             "batch_id = EXCLUDED.batch_id WHERE b.batch_id < EXCLUDED.batch_id")
    assert batches_sql("b").startswith("CREATE TABLE IF NOT EXISTS b (run_id")


def test_current_rows_dedupes_before_json(spark):
    from labrelay.plans.batch import current_rows

    later = S.ORDER.replace("Test One", "Test Two")
    rows = current_rows(parse_messages(raw_frame(spark, [S.ORDER, later]), "order"), "order").collect()
    assert len(rows) == 1
    assert rows[0].lab_tests_ordered == '[{"code":"1111-1","name":"Test Two","type":"Regular"}]'


def test_upsert_sql_text():
    sql = upsert_sql("order", "lab_orders", "lab_orders_staging")
    assert sql == (
        "INSERT INTO lab_orders (lab_order_id, sending_facility_id, receiving_lab_code, sending_date_time, "
        "lab_tests_ordered) SELECT lab_order_id, sending_facility_id, receiving_lab_code, sending_date_time, "
        "lab_tests_ordered::jsonb FROM lab_orders_staging ON CONFLICT (lab_order_id) DO UPDATE SET "
        "sending_facility_id = EXCLUDED.sending_facility_id, receiving_lab_code = EXCLUDED.receiving_lab_code, "
        "sending_date_time = EXCLUDED.sending_date_time, lab_tests_ordered = EXCLUDED.lab_tests_ordered"
    )
    ack = upsert_sql("ack", "lab_orders_ack", "s")
    assert "ON CONFLICT (ack_message_id)" in ack and "message_id = EXCLUDED.message_id" in ack


def test_hot_key_with_a_third_of_the_rows(spark):
    from pyspark.sql import functions as F

    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 1000).cast("string")))
        .alias("key"),
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
        F.col("id").cast("string").alias("payload"),
    ).repartition(8)
    out = {r.key: r.payload for r in latest_per_key(df, "key").collect()}
    assert out["hot"] == str(max(i for i in range(n) if i % 3 == 0))
    assert len(out) == 1 + len({i % 1000 for i in range(n) if i % 3 != 0})
    assert out["k1"] == str(max(i for i in range(n) if i % 3 != 0 and i % 1000 == 1))
