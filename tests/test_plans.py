"""Plan shape guards: the parse runs once per row, in one stage, without shuffles."""

import re

import pytest
from conftest import raw_frame

import samples as S
from labrelay import json_values, parse_messages, shred
from labrelay.plans.batch import current_rows, table_rows
from labrelay.functions.segments import delimiter_columns
from labrelay.operators.quarantine import quarantine_rows, quarantined_messages
from labrelay.sources import fixtures
from pyspark.sql import functions as F


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_key_filter_is_not_inlined_into_the_parse(spark):
    df = parse_messages(raw_frame(spark, [S.RESULT]), "result")
    filters = [ln for ln in optimized(df).splitlines() if "Filter" in ln]
    # without the fence the key filter would carry the whole parse (hundreds of KB)
    assert filters and max(len(f) for f in filters) < 2000


def test_explode_filter_stays_above_the_parse(spark):
    df = shred(raw_frame(spark, [S.RESULT]), "result").select(F.explode("lab_test_results"))
    filters = [ln for ln in optimized(df).splitlines() if "Filter" in ln]
    assert max(len(f) for f in filters) < 2000


def test_stored_messages_parse_in_one_stage(spark, scratch_dir):
    path = f"{scratch_dir}/m"
    raw_frame(spark, [S.ORDER, S.FULL_ORDER]).write.parquet(path)
    df = json_values(parse_messages(spark.read.parquet(path), "order"), "order")
    plan = executed(df)
    assert "Exchange" not in plan
    assert "ReadSchema: struct<partition:int,offset:bigint,value:binary>" in df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def largest_method(df):
    """Bytes of the largest generated method of a plan's fused stages (0: none is fused)."""
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
    return max([0, *map(int, re.findall(r"maxMethodCodeSize:(\d+)", text))])


@pytest.mark.parametrize("kind,message", [("order", S.ORDER), ("ack", S.ACK), ("result", S.RESULT)])
def test_generated_methods_are_small_enough_to_be_compiled(spark, scratch_dir, kind, message):
    """The JVM compiles no method above 8,000 bytes; a hot loop that large would be interpreted."""
    path = f"{scratch_dir}/m"
    raw_frame(spark, [message]).write.parquet(path)
    assert largest_method(json_values(parse_messages(spark.read.parquet(path), kind), kind)) < 8000


def test_two_batches_need_one_aggregate_exchange(spark):
    from labrelay.plans.catalog import QUERIES

    plan = executed(QUERIES["upsert_two_batches"](spark, "/root/testdata/sf0.001"))
    assert plan.count("Exchange hashpartitioning(ack_message_id") == 1
    assert plan.count("FileScan") == 1


def test_upsert_has_one_exchange_with_partial_aggregation(spark, scratch_dir):
    path = f"{scratch_dir}/m"
    raw_frame(spark, [S.ORDER, S.FULL_ORDER]).write.parquet(path)
    plan = executed(current_rows(parse_messages(spark.read.parquet(path), "order"), "order"))
    assert plan.count("Exchange") == 1
    assert "partial_max_by" in plan


@pytest.fixture()
def plain_plans(spark):
    """Plans with generated code also behind exchanges."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_rendered_messages_are_not_fused_with_their_parse(spark, plain_plans):
    """Rendering and parsing in one generated method: too large to be compiled."""
    customer = spark.createDataFrame([(1, 2)], "c_custkey long, c_nationkey long")
    orders = spark.createDataFrame([(7, 1)], "o_orderkey long, o_custkey long").selectExpr(
        "*", "TIMESTAMP_NTZ'2024-03-05 10:15:30' AS o_orderdate", "'O' AS o_orderstatus", "'1-URGENT' AS o_orderpriority")
    events = spark.createDataFrame([(2, 5, "click")], "event_id long, user_id long, event_type string").selectExpr(
        "*", "TIMESTAMP_NTZ'2024-03-05 10:15:30' AS ts")
    for kind, raw in (("order", fixtures.render_orders(orders, customer)), ("ack", fixtures.render_acks(events))):
        parsed = json_values(parse_messages(raw, kind), kind)
        assert parsed.count() == 1
        assert 0 < largest_method(parsed) < 8000


def test_result_arrays_are_read_by_methods_small_enough_to_be_compiled(spark, scratch_dir, plain_plans):
    path = f"{scratch_dir}/m"
    raw_frame(spark, [S.RESULT]).write.parquet(path)
    parsed = parse_messages(spark.read.parquet(path), "result")
    assert 0 < largest_method(table_rows(parsed, "result").select("offset", "lab_test_results")) < 8000


def test_a_repair_runs_once_per_message(spark):
    """The filter on empty values reads the repaired value instead of repairing once more."""
    bad = quarantine_rows(parse_messages(raw_frame(spark, [S.ACK.replace("|2.5", "|2.3")]), "ack", mode="PERMISSIVE"), "ack")
    repaired = F.regexp_replace(F.col("value").cast("string"), r"\|2\.3(?=[|\r])", "|2.5")
    again = parse_messages(quarantined_messages(bad, "ack", repaired), "ack", mode="PERMISSIVE")
    assert optimized(again).count("2\\.3(?=") == 1


@pytest.mark.parametrize("kind,message", [("order", S.ORDER), ("ack", S.ACK), ("result", S.RESULT)])
def test_patterns_made_of_a_messages_delimiters_are_kept_between_rows(spark, kind, message):
    """``regexp_like`` compiles a pattern that is no literal anew for every row, ``regexp_instr`` keeps the last."""
    plan = optimized(parse_messages(raw_frame(spark, [message]), kind))
    assert not re.search(r"RLIKE\([^,()]*, concat\(", plan, re.I)


def test_pieces_of_a_text_short_of_its_header_are_as_before(spark):
    rows = ["", "M", "MSH", "MSH|", "MSH|^", "MSH||A", "MSH|^~\\&|A|B\rPIDX1", "MSH|^~\\&|A\rPID|1", "MSH#$%!@#A#B"]
    got = spark.createDataFrame([(r,) for r in rows], "text string").select(
        *delimiter_columns(F.col("text")), F.split_part(F.substr("text", F.lit(5)), F.substr("text", F.lit(4), F.lit(1)), F.lit(1)).alias("enc"))
    for r in got.collect():
        assert [r["_cs"], r["_rs"], r["_es"], r["_ss"], r["_body"]] == [*(r["enc"][i:i + 1] for i in range(4)), len(r["enc"]) + 5]
