"""Malformed messages: FAILFAST / DROPMALFORMED / PERMISSIVE."""

import json

import pytest
from conftest import raw_frame

import samples as S
from labrelay import current_rows, json_values, parse_messages, shred
from labrelay.plans.batch import error_values
from labrelay.operators.route import route


def test_wrong_kind_fails_the_job(spark):
    with pytest.raises(Exception, match="Message is not an ACK message"):
        parse_messages(raw_frame(spark, [S.ORDER]), "ack").collect()


def test_wrong_version_fails(spark):
    msg = S.ORDER.replace("|P|2.5", "|P|2.3")
    with pytest.raises(Exception, match="Message is not an OML_O21 message"):
        parse_messages(raw_frame(spark, [msg]), "order").count()


def test_bad_time_fails_even_without_key(spark):
    # the reference parses before it filters on the key
    msg = S.ORDER.replace("20240305101530", "202403051015").replace("ORC|NW|ORD0001", "ORC|NW|")
    with pytest.raises(Exception, match="could not be parsed"):
        parse_messages(raw_frame(spark, [msg]), "order").collect()


def test_bad_observation_time_fails(spark):
    msg = S.RESULT.replace("|||202403051015", "|||2024030510153")
    with pytest.raises(Exception, match="could not be parsed"):
        parse_messages(raw_frame(spark, [msg]), "result").collect()


def test_not_pipe_encoded_fails(spark):
    with pytest.raises(Exception, match="not pipe-delimited"):
        parse_messages(raw_frame(spark, ["hello world"]), "ack").collect()


def test_structure_rules(spark):
    two = S.ACK.replace("ACK^O21^ACK", "ACK^O21")
    one = S.ACK.replace("ACK^O21^ACK", "ACK")
    oru = S.RESULT.replace("ORU^R01^ORU_R01", "ORU^R01")
    assert parse_messages(raw_frame(spark, [two, one]), "ack").count() == 2
    assert parse_messages(raw_frame(spark, [oru]), "result").count() == 1


def test_dropmalformed_and_permissive(spark):
    raw = raw_frame(spark, [S.ORDER, S.ACK, S.ACK.replace("20240305101600", "2024")])
    assert [r.offset for r in parse_messages(raw, "ack", mode="DROPMALFORMED").collect()] == [1]
    rep = shred(raw, "ack", mode="PERMISSIVE").orderBy("offset").collect()
    assert rep[0]._error == "Message is not an ACK message"
    assert rep[1]._error is None
    assert "'2024'" in rep[2]._error


def test_permissive_keeps_bad_rows_apart(spark):
    bad_time = S.ACK.replace("20240305101600", "2024").replace("ack-0001", "ack-bad")
    raw = raw_frame(spark, [S.ACK, bad_time, "hello world", S.ACK_LINES[0]])
    rows = parse_messages(raw, "ack", mode="PERMISSIVE").orderBy("offset")
    # the malformed text without a key stays, the sound message without a key does not
    assert [(r.offset, r._error is None) for r in rows.collect()] == [(0, True), (1, False), (2, False)]
    assert [r.value for r in json_values(rows, "ack").collect()] == [S.ACK_JSON]
    assert [r.message_id for r in current_rows(rows, "ack").collect()] == ["ack-0001"]
    assert [json.loads(r.value)["offset"] for r in error_values(rows, "ack").collect()] == [1, 2]


def test_route_splits_a_mixed_table(spark):
    raw = raw_frame(spark, [S.ORDER, S.ACK, S.RESULT, S.ACK.replace("|P|2.5", "|P|2.3"), None, " "])
    assert [r.offset for r in route(raw, "ACK").collect()] == [1]
    assert [r.offset for r in route(raw, "OML_O21").collect()] == [0]
    assert [r.offset for r in route(raw, "ORU_R01").collect()] == [2]


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        parse_messages(raw_frame(spark, [S.ACK]), "ack", mode="LENIENT")


def test_the_raised_text_says_where_the_message_stands(spark):
    raw = raw_frame(spark, [S.ACK, S.ORDER]).selectExpr("'acks' AS topic", "*")
    with pytest.raises(Exception, match=r"Message is not an ACK message \(topic acks, partition 0, offset 1\)"):
        parse_messages(raw, "ack").collect()


def test_permissive_keeps_the_bytes_of_malformed_messages_only(spark):
    rows = parse_messages(raw_frame(spark, [S.ACK, b"\xff\xfe", S.ORDER]), "ack", mode="PERMISSIVE").orderBy("offset").collect()
    assert [r._raw and bytes(r._raw) for r in rows] == [None, b"\xff\xfe", S.ORDER.encode()]
    assert "_raw" not in parse_messages(raw_frame(spark, [S.ACK]), "ack").columns
    text = raw_frame(spark, [S.ORDER]).selectExpr("partition", "offset", "cast(value as string) as value")
    assert bytes(parse_messages(text, "ack", mode="PERMISSIVE").collect()[0]._raw) == S.ORDER.encode()
