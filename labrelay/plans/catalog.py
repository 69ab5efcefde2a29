"""Registered queries: one per inventory item of SURVEY §2 (keys = its "Key" column).

Each query takes ``(spark, sf_dir)``, renders the kind's messages from the
driver's tables (``sources.fixtures``: input only), runs the library operator
under test over *all* of them, and returns flat columns (timestamps as ISO
text, nested values as JSON text) so results compare by value with the DuckDB
oracles in ``plans.oracle``, which are computed from the relational columns.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from ..functions.jsonfmt import to_json_text
from ..functions.segments import segments
from ..functions.text import decode_utf8
from ..operators.errors import ERROR
from ..operators.messages import decode, drop_blank, drop_empty, prepare
from ..operators.quarantine import quarantine_rows, quarantined_messages
from ..operators.results import with_observation_group
from ..operators.route import route
from ..operators.shred import TEXT
from ..operators.upsert import merge_current
from ..session import ensure_checkpoint_dir
from ..sinks.bucket_table import BucketTable
from ..sources import fixtures
from ..sources.messages import fixture_table, read_messages
from .batch import current_rows, delimiters, extract_fields, json_values, parse_messages, shred, table_rows
from .describe import described_kind
from .kinds import ACK, ORDER, RESULT

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return fixture_table(spark, sf, name)


def orders_raw(spark: SparkSession, sf: str) -> DataFrame:
    return read_messages(spark, "order", fmt="fixture", path=sf)


def acks_raw(spark: SparkSession, sf: str) -> DataFrame:
    return read_messages(spark, "ack", fmt="fixture", path=sf)


def results_raw(spark: SparkSession, sf: str) -> DataFrame:
    return read_messages(spark, "result", fmt="fixture", path=sf)


def mixed_raw(spark: SparkSession, sf: str) -> DataFrame:
    t = lambda n: _table(spark, sf, n)
    return fixtures.mixed_messages(t("orders"), t("customer"), t("lineitem"), t("events"))


def iso(c: str | Column) -> Column:
    """TIMESTAMP_NTZ -> ISO text, zone-free (``cast`` to string, no session-zone
    round trip); parsed values carry whole seconds."""
    col = F.col(c) if isinstance(c, str) else c
    return F.replace(col.cast("string"), F.lit(" "), F.lit("T"))


# ---------------------------------------------------------------- sources (A)


def _scanned(raw: DataFrame) -> DataFrame:
    """Arrival columns, and what needs the whole message: its length and digest."""
    return raw.select("topic", "partition", "offset", F.octet_length("value").alias("n_bytes"), F.md5("value").alias("digest"))


@query("scan_order_messages")
def scan_order_messages(spark, sf):
    return _scanned(orders_raw(spark, sf))


@query("scan_ack_messages")
def scan_ack_messages(spark, sf):
    return _scanned(acks_raw(spark, sf))


@query("scan_result_messages")
def scan_result_messages(spark, sf):
    return _scanned(results_raw(spark, sf))


@query("decode_messages")
def decode_messages(spark, sf):
    text = F.col(TEXT)
    bad = F.length(text) - F.length(F.replace(text, F.lit("\ufffd"), F.lit("")))
    return decode(orders_raw(spark, sf)).select("offset", bad.alias("replacement_chars"))


@query("drop_empty_messages")
def drop_empty_messages(spark, sf):
    return drop_empty(acks_raw(spark, sf)).select("offset")


@query("drop_blank_messages")
def drop_blank_messages(spark, sf):
    return drop_blank(decode(drop_empty(acks_raw(spark, sf)))).select("offset")


# ---------------------------------------------------------- shredding (B)


@query("segment_counts")
def segment_counts(spark, sf):
    raw = orders_raw(spark, sf).unionByName(results_raw(spark, sf))
    text = decode(drop_empty(raw))
    return text.select("topic", "offset", F.size(segments(F.col(TEXT))).alias("n_segments"))


@query("custom_delimiters")
def custom_delimiters(spark, sf):
    return delimiters(acks_raw(spark, sf)).drop("topic", "partition")


@query("field_access")
def field_access(spark, sf):
    spec = {
        "msh_4_1": "MSH-4.1",
        "msh_4_2": "MSH-4.2",
        "msh_6_1": "MSH-6.1",
        "pid_3_1": "PID-3.1",
        "pid_3_5": "PID-3.5",
        "orc_1": "ORC-1",
    }
    return extract_fields(orders_raw(spark, sf), spec).drop("topic", "partition")


@query("unescape_text")
def unescape_text(spark, sf):
    """MSA-3 of the acks, and of acks whose text holds every escape, NULs and noncharacters."""
    ev, e = _table(spark, sf, "events"), F.col("event_id")
    odd = F.concat(F.lit("a\\F\\b\u0000F\u0000\\S\\\ufdd0\\T\\\\R\\\\E\\F\\\\X\\"), (e % 100).cast("string"))
    texts = fixtures.render_acks(ev, text=odd).withColumn("topic", F.lit("odd"))
    raw = acks_raw(spark, sf).unionByName(texts)
    return extract_fields(raw, {"msa_3": "MSA-3"}).select("topic", "offset", "msa_3")


@query("route_orders")
def route_orders(spark, sf):
    return route(mixed_raw(spark, sf), ORDER.structure).select("topic", "offset")


@query("route_acks")
def route_acks(spark, sf):
    return route(mixed_raw(spark, sf), ACK.structure).select("topic", "offset")


@query("route_results")
def route_results(spark, sf):
    return route(mixed_raw(spark, sf), RESULT.structure).select("topic", "offset")


@query("first_order_group")
def first_order_group(spark, sf):
    df = shred(orders_raw(spark, sf), ORDER)
    test = F.col("lab_tests_ordered")[0]
    return df.select("offset", F.col("lab_order_id").alias("orc_2"), test["code"].alias("obr_4_1"),
                     test["name"].alias("obr_4_2"))


@query("first_observation_group")
def first_observation_group(spark, sf):
    env = prepare(results_raw(spark, sf))
    return with_observation_group(env).select("offset", F.size("_s_obx").alias("n_obx"))


# -------------------------------------------------- projections (C)


def _orders(spark, sf):
    return shred(orders_raw(spark, sf), ORDER)


def _acks(spark, sf):
    return shred(acks_raw(spark, sf), ACK)


def _results(spark, sf):
    return shred(results_raw(spark, sf), RESULT)


@query("message_ids")
def message_ids(spark, sf):
    cols = ["topic", "offset", "message_id"]
    return _orders(spark, sf).select(*cols).unionByName(_acks(spark, sf).select(*cols)).unionByName(
        _results(spark, sf).select(*cols)
    )


@query("facility_fallback")
def facility_fallback(spark, sf):
    cols = ["topic", "offset", "sending_facility_id"]
    return _orders(spark, sf).select(*cols).unionByName(_results(spark, sf).select(*cols))


@query("ack_facility")
def ack_facility(spark, sf):
    return _acks(spark, sf).select("offset", "sending_facility_id")


@query("receiving_lab")
def receiving_lab(spark, sf):
    cols = ["topic", "offset", "receiving_lab_code"]
    return _orders(spark, sf).select(*cols).unionByName(_results(spark, sf).select(*cols))


@query("ack_target")
def ack_target(spark, sf):
    return _acks(spark, sf).select("offset", "targeted_disa_code")


@query("patient_struct")
def patient_struct(spark, sf):
    return _orders(spark, sf).select("offset", to_json_text(F.col("patient")).alias("patient"))


@query("patient_nupn")
def patient_nupn(spark, sf):
    return _results(spark, sf).select("offset", "patient_nupn")


@query("order_ids")
def order_ids(spark, sf):
    cols = ["topic", "offset", "lab_order_id"]
    return _orders(spark, sf).select(*cols).unionByName(_results(spark, sf).select(*cols))


@query("tests_ordered")
def tests_ordered(spark, sf):
    t = F.col("lab_tests_ordered")
    return _orders(spark, sf).select(
        "offset",
        F.size(t).alias("n_tests"),
        t[0]["code"].alias("code"),
        t[0]["name"].alias("name"),
        t[0]["type"].alias("type"),
    )


def _observations(spark, sf) -> DataFrame:
    df = _results(spark, sf)
    return df.select("offset", F.posexplode("lab_test_results").alias("pos", "r"))


@query("test_results")
def test_results(spark, sf):
    r = F.col("r")
    return _observations(spark, sf).select(
        "offset",
        "pos",
        r["code"].alias("code"),
        r["name"].alias("name"),
        r["value"].alias("value"),
        r["unit"].alias("unit"),
        r["referenceRange"].alias("reference_range"),
        iso(r["observationDateTime"]).alias("observation_time"),
    )


@query("observation_values")
def observation_values(spark, sf):
    return _observations(spark, sf).select("offset", "pos", F.col("r")["value"].alias("value"))


@query("observation_units")
def observation_units(spark, sf):
    r = F.col("r")
    return _observations(spark, sf).select(
        "offset", "pos", r["unit"].alias("unit"), r["referenceRange"].alias("reference_range")
    )


@query("observation_times")
def observation_times(spark, sf):
    r = F.col("r")
    return _observations(spark, sf).select("offset", "pos", iso(r["observationDateTime"]).alias("observation_time"))


@query("ack_fields")
def ack_fields(spark, sf):
    return _acks(spark, sf).select(
        "offset", "acknowledgment_status", "ack_message_id", "acknowledgment_description"
    )


@query("strict_timestamps")
def strict_timestamps(spark, sf):
    o = _orders(spark, sf).select("topic", "offset", iso("sending_date_time").alias("sending_date_time"))
    a = _acks(spark, sf).select("topic", "offset", iso("sending_date_time").alias("sending_date_time"))
    return o.unionByName(a)


@query("lenient_timestamps")
def lenient_timestamps(spark, sf):
    return _results(spark, sf).select("offset", iso("sending_date_time").alias("sending_date_time"))


def _order_records(spark, sf, kind) -> DataFrame:
    df = parse_messages(orders_raw(spark, sf), kind)
    t = F.col("lab_tests_ordered")
    return df.select(
        "offset",
        "lab_order_id",
        "sending_facility_id",
        "receiving_lab_code",
        iso("sending_date_time").alias("sending_date_time"),
        F.size(t).alias("n_tests"),
        t[0]["code"].alias("test_code"),
        t[0]["name"].alias("test_name"),
        t[0]["type"].alias("test_type"),
        "message_id",
        F.col("patient.nupn").alias("patient_nupn"),
        F.col("patient.sex").alias("patient_sex"),
    )


@query("order_records")
def order_records(spark, sf):
    return _order_records(spark, sf, ORDER)


def _ack_records(spark, sf, kind) -> DataFrame:
    df = parse_messages(acks_raw(spark, sf), kind)
    return df.select(
        "offset",
        "sending_facility_id",
        "targeted_disa_code",
        iso("sending_date_time").alias("sending_date_time"),
        "message_id",
        "ack_message_id",
        "acknowledgment_status",
        "acknowledgment_description",
    )


@query("ack_records")
def ack_records(spark, sf):
    return _ack_records(spark, sf, ACK)


@query("result_records")
def result_records(spark, sf):
    df = parse_messages(results_raw(spark, sf), RESULT)
    return df.select(
        "offset",
        "lab_order_id",
        "sending_facility_id",
        "receiving_lab_code",
        iso("sending_date_time").alias("sending_date_time"),
        F.size("lab_test_results").alias("n_results"),
        "message_id",
        "patient_nupn",
    )


def _flat_table(df: DataFrame, ts: str = "sending_date_time") -> DataFrame:
    return df.withColumn(ts, iso(ts))


@query("order_table_rows")
def order_table_rows(spark, sf):
    rows = table_rows(parse_messages(orders_raw(spark, sf), ORDER), ORDER)
    return _flat_table(rows).drop("partition")


# -------------------------------------------------------------- filters (D)


@query("filter_orders")
def filter_orders(spark, sf):
    return parse_messages(orders_raw(spark, sf), ORDER).select("offset")


@query("filter_acks")
def filter_acks(spark, sf):
    return parse_messages(acks_raw(spark, sf), ACK).select("offset")


@query("filter_results")
def filter_results(spark, sf):
    return parse_messages(results_raw(spark, sf), RESULT).select("offset")


# ----------------------------------------------------------------- JSON (E)


@query("order_json")
def order_json(spark, sf):
    return json_values(parse_messages(orders_raw(spark, sf), ORDER), ORDER).select("offset", "value")


@query("ack_json")
def ack_json(spark, sf):
    return json_values(parse_messages(acks_raw(spark, sf), ACK), ACK).select("offset", "value")


@query("result_json")
def result_json(spark, sf):
    return json_values(parse_messages(results_raw(spark, sf), RESULT), RESULT).select("offset", "value")


@query("tests_json")
def tests_json(spark, sf):
    rows = table_rows(parse_messages(orders_raw(spark, sf), ORDER), ORDER)
    return rows.select("offset", "lab_tests_ordered")


@query("results_json")
def results_json(spark, sf):
    rows = table_rows(parse_messages(results_raw(spark, sf), RESULT), RESULT)
    return rows.select("offset", "lab_test_results")


# ------------------------------------------------------------- upserts (F)


def _upserted(raw: DataFrame, kind) -> DataFrame:
    return _flat_table(current_rows(parse_messages(raw, kind), kind))


@query("upsert_orders")
def upsert_orders(spark, sf):
    return _upserted(orders_raw(spark, sf), ORDER)


@query("upsert_acks")
def upsert_acks(spark, sf):
    return _upserted(acks_raw(spark, sf), ACK)


@query("upsert_results")
def upsert_results(spark, sf):
    return _upserted(results_raw(spark, sf), RESULT)


@query("upsert_two_batches")
def upsert_two_batches(spark, sf):
    """Acks arriving in two batches (even offsets, then odd): the later batch wins a
    key. One scan and one aggregate: the batch is the first order column."""
    rows = parse_messages(acks_raw(spark, sf), ACK).withColumn("batch", F.col("offset") % 2)
    return _flat_table(current_rows(rows, ACK, order=["batch", "partition", "offset"]).select(*ACK.table_columns))


@query("upsert_merged_state")
def upsert_merged_state(spark, sf):
    """A state table built from the even offsets, merged with the odd ones as the next batch."""
    state = current_rows(parse_messages(acks_raw(spark, sf), ACK, where="offset % 2 = 0"), ACK)
    batch = table_rows(parse_messages(acks_raw(spark, sf), ACK, where="offset % 2 = 1"), ACK)
    return _flat_table(merge_current(state, batch, ACK.key))


@query("upsert_broker_time")
def upsert_broker_time(spark, sf):
    """Acks whose producer clock runs against the offsets: the offset decides."""
    backwards = F.timestamp_seconds(F.lit(1_700_000_000) - F.col("offset"))
    return _upserted(acks_raw(spark, sf).withColumn("timestamp", backwards), ACK)


# --------------------------------------------------------------- errors (H)


def _malformed_ack_stream(spark, sf) -> DataFrame:
    """An ack stream that also carries every order message, acks in version 2.3
    (e%10=9) and acks with a 12-char send time (e%13=0)."""
    ev, e = _table(spark, sf, "events"), F.col("event_id")
    acks = fixtures.render_acks(
        ev,
        version=F.when(e % 10 == 9, F.lit("2.3")).otherwise(F.lit("2.5")),
        sent_length=F.when(e % 13 == 0, F.lit(12)).otherwise(F.lit(14)),
    )
    return acks.unionByName(orders_raw(spark, sf))


@query("dropmalformed_acks")
def dropmalformed_acks(spark, sf):
    """DROPMALFORMED parse of the malformed ack stream: good acks with a key remain."""
    df = parse_messages(_malformed_ack_stream(spark, sf), ACK, mode="DROPMALFORMED")
    return df.select("topic", "offset", "ack_message_id")


@query("permissive_acks")
def permissive_acks(spark, sf):
    """PERMISSIVE parse of the malformed ack stream: clean rows with a key, and every
    malformed row, with or without one."""
    df = parse_messages(_malformed_ack_stream(spark, sf), ACK, mode="PERMISSIVE")
    return df.select("topic", "offset", "ack_message_id", F.col(ERROR).alias("error"))


# Lengths of header times that malformed_results goes through.
SENT_LENGTHS = (2, 4, 6, 8, 9, 10, 11, 12, 13, 14, 15, 19)


@query("malformed_results")
def malformed_results(spark, sf):
    """PERMISSIVE parse of results whose header times have every length of the
    length table and some of whose observation times have 13 characters."""
    length = F.element_at(F.array(*map(F.lit, SENT_LENGTHS)), (F.col("k") % len(SENT_LENGTHS) + 1).cast("int"))
    raw = fixtures.render_results(
        _table(spark, sf, "lineitem"),
        sent_text=lambda t: F.substr(F.concat(t, F.lit(".1234")), F.lit(1), length),
        obs_text=lambda t: F.when(F.col("l_partkey") % 6 == 0, F.substr(t, F.lit(1), F.lit(13))).otherwise(t),
    )
    df = shred(raw, RESULT, mode="PERMISSIVE").filter(F.col(ERROR).isNotNull())
    return df.select("offset", "message_id", F.col(ERROR).alias("error"))


@query("clamped_timestamps")
def clamped_timestamps(spark, sf):
    """Header times past a month's end (clamped to its last day) and at 24:00 (the next midnight)."""
    k, year = F.col("k"), lambda t: F.substr(t, F.lit(1), F.lit(4))
    raw = fixtures.render_results(
        _table(spark, sf, "lineitem"),
        sent_text=lambda t: F.when(k % 5 == 0, F.concat(year(t), F.lit("0230101530")))
        .when(k % 5 == 1, F.concat(year(t), F.lit("0231")))
        .when(k % 5 == 2, F.concat(year(t), F.lit("04312359")))
        .when(k % 5 == 3, F.concat(F.substr(t, F.lit(1), F.lit(8)), F.lit("240000")))
        .otherwise(F.concat(year(t), F.lit("1231240000"))),
    )
    return shred(raw, RESULT).select("offset", iso("sending_date_time").alias("sending_date_time"))


@query("malformed_report")
def malformed_report(spark, sf):
    """PERMISSIVE parse of the malformed ack stream: one row per bad message and its reason."""
    df = shred(_malformed_ack_stream(spark, sf), ACK, mode="PERMISSIVE")
    return df.filter(F.col(ERROR).isNotNull()).select("topic", "offset", "message_id", F.col(ERROR).alias("error"))


@query("quarantine_replay")
def quarantine_replay(spark, sf):
    """Malformed messages of the ack stream out with their bytes, repaired (version 2.5, the
    missing seconds added), and parsed again; those that are no acks stay out."""
    bad = quarantine_rows(parse_messages(_malformed_ack_stream(spark, sf), ACK, mode="PERMISSIVE"), ACK)
    version = F.replace(decode_utf8(F.col("value"), BinaryType()), F.lit("|P|2.3"), F.lit("|P|2.5"))
    repaired = F.regexp_replace(version, r"^(MSH(?:[|#][^|#]*){5}[|#])([0-9]{12})(?=[|#])", "$1$200")
    again = parse_messages(quarantined_messages(bad, ACK, repaired), ACK, mode="PERMISSIVE")
    sound = F.col(ERROR).isNull()
    return again.select("topic", "offset", "ack_message_id", F.when(sound, iso("sending_date_time")).alias("sending_date_time"), F.col(ERROR).alias("error"))


@query("upsert_bucketed_state")
def upsert_bucketed_state(spark, sf):
    """Acks written to a bucketed state table in the shared folder in three batches, the second
    replayed after the third, and read back."""
    state = BucketTable(f"{ensure_checkpoint_dir(spark)}/upsert-bucketed-state-{uuid.uuid4().hex}", ACK, buckets=16, keep_commits=1)
    for batch in (0, 1, 2, 1):
        state.upsert(parse_messages(acks_raw(spark, sf), ACK, where=f"offset % 3 = {batch}"), batch)
    return _flat_table(state.read(spark))


# ------------------------------------------------------- described kinds (2.9)

DESCRIBED_ACK = described_kind(
    "ack", "ACK", key="ack_message_id", table="lab_orders_ack",
    columns={
        "sending_facility_id": "MSH-4.1",
        "targeted_disa_code": "MSH-5.1",
        "sending_date_time": "MSH-7 as strict time",
        "message_id": "MSH-10",
        "ack_message_id": "MSA-2",
        "acknowledgment_status": "MSA-1",
        "acknowledgment_description": "MSA-3",
    })

DESCRIBED_ORDER = described_kind(
    "order", "OML_O21", key="lab_order_id", table="lab_orders",
    table_columns=ORDER.table_columns,
    groups={"PID": "patient ahead of it", "ORC": "first order group", "OBR": "first order group"},
    columns={
        "lab_order_id": "ORC-2",
        "sending_facility_id": "MSH-4.2 or MSH-4.1",
        "receiving_lab_code": "MSH-6",
        "sending_date_time": "MSH-7 as strict time",
        "lab_tests_ordered": [{"code": "OBR-4.1", "name": "OBR-4.2", "type": "'Regular'"}],
        "message_id": "MSH-10",
        "patient": {"nupn": "PID-3.1", "sex": "PID-8"},
    })


@query("described_acks")
def described_acks(spark, sf):
    """``ack_records`` from a described kind."""
    return _ack_records(spark, sf, DESCRIBED_ACK)


@query("described_orders")
def described_orders(spark, sf):
    """``order_records`` from a described kind: group rules, a fallback, a struct and an array."""
    return _order_records(spark, sf, DESCRIBED_ORDER)
