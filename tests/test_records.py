"""Whole messages -> records / JSON."""

import json

import pytest
from conftest import raw_frame, seg

import samples as S
from labrelay import json_values, parse_messages, records, table_rows


def one_json(spark, kind, msg):
    out = json_values(parse_messages(raw_frame(spark, [msg]), kind), kind).collect()
    assert len(out) == 1
    return out[0].value


@pytest.mark.parametrize(
    "kind,msg,expected",
    [
        ("order", S.FULL_ORDER, S.FULL_ORDER_JSON),
        ("ack", S.FULL_ACK, S.FULL_ACK_JSON),
        ("result", S.FULL_RESULT, S.FULL_RESULT_JSON),
        ("order", S.ORDER, S.ORDER_JSON),
        ("ack", S.ACK, S.ACK_JSON),
        ("result", S.RESULT, S.RESULT_JSON),
    ],
)
def test_message_to_json(spark, kind, msg, expected):
    assert one_json(spark, kind, msg) == expected


def test_second_obr_is_ignored(spark):
    rec = records(parse_messages(raw_frame(spark, [S.ORDER]), "order"), "order").collect()[0]
    assert [t.code for t in rec.lab_tests_ordered] == ["1111-1"]


def test_crlf_and_indented_segments(spark):
    crlf = seg(*S.ORDER_LINES, sep="\r\n")
    indented = seg(*S.ORDER_LINES, sep="\r  \t")
    assert one_json(spark, "order", crlf) == S.ORDER_JSON
    assert one_json(spark, "order", indented) == S.ORDER_JSON


def test_custom_delimiters(spark):
    msg = S.ORDER.replace("|", "#").replace("^", "$")
    assert one_json(spark, "order", msg) == S.ORDER_JSON


def test_missing_pid_gives_null_patient_fields(spark):
    lines = [x for x in S.ORDER_LINES if not x.startswith("PID")]
    rec = json.loads(one_json(spark, "order", seg(*lines)))
    assert rec["patient"] == {"nupn": None, "sex": None}


def test_missing_obr_gives_null_test(spark):
    lines = [x for x in S.ORDER_LINES if not x.startswith("OBR|1")]
    rec = json.loads(one_json(spark, "order", seg(*lines)))
    # the second OBR follows an OBX: it opens the next order group
    assert rec["lab_tests_ordered"] == [{"code": None, "name": None, "type": "Regular"}]


def test_order_without_key_is_dropped(spark):
    no_orc = seg(*[x for x in S.ORDER_LINES if not x.startswith("ORC")])
    empty_id = S.ORDER.replace("ORC|NW|ORD0001", "ORC|NW|")
    out = parse_messages(raw_frame(spark, [no_orc, empty_id, S.ORDER]), "order").collect()
    assert [r.offset for r in out] == [2]


def test_result_with_orc_after_obr_is_dropped(spark):
    lines = list(S.RESULT_LINES)
    lines[2], lines[3] = lines[3], lines[2]
    assert parse_messages(raw_frame(spark, [seg(*lines)]), "result").count() == 0


def test_result_without_obx_has_empty_array(spark):
    lines = [x for x in S.RESULT_LINES if not x.startswith("OBX")]
    rec = json.loads(one_json(spark, "result", seg(*lines)))
    assert rec["lab_test_results"] == []
    rows = table_rows(parse_messages(raw_frame(spark, [seg(*lines)]), "result"), "result").collect()
    assert rows[0].lab_test_results == "[]"


def test_ack_without_msa_is_dropped(spark):
    assert parse_messages(raw_frame(spark, [S.ACK_LINES[0]]), "ack").count() == 0


def test_facility_fallback_by_kind(spark):
    order = S.ORDER.replace("North Clinic^10010001^URI", "North Clinic")
    assert json.loads(one_json(spark, "order", order))["sending_facility_id"] == "North Clinic"
    ack = S.ACK.replace("LAB7^L7^URI", "^L7")
    assert json.loads(one_json(spark, "ack", ack))["sending_facility_id"] is None


def test_first_repetition_of_patient_id(spark):
    msg = S.ORDER.replace("NP-000-1^^^^MR", "A^^^x~B^^^y")
    assert json.loads(one_json(spark, "order", msg))["patient"]["nupn"] == "A"


def test_escapes_in_text(spark):
    msg = S.ACK.replace("|Accepted", "|A\\F\\B \\S\\ \\T\\ \\R\\ \\E\\ \\E\\F\\")
    assert json.loads(one_json(spark, "ack", msg))["acknowledgment_description"] == "A|B ^ & ~ \\ \\F\\"


def test_escapes_beside_nul_and_noncharacters(spark):
    text = "a\x00F\x00b\ufdd0\ufdd4\\F\\c\x00S\x00"
    msg = S.ACK.replace("|Accepted", "|" + text)
    assert json.loads(one_json(spark, "ack", msg))["acknowledgment_description"] == text.replace("\\F\\", "|")
    plain = S.ACK.replace("|Accepted", "|x\ufdd0y\x00F\x00z")  # no escape at all
    assert json.loads(one_json(spark, "ack", plain))["acknowledgment_description"] == "x\ufdd0y\x00F\x00z"


def test_observation_value_reencoded(spark):
    msg = S.RESULT.replace("||free text||", "||a^b^^||").replace("||42|", "||x\\F\\y|")
    vals = [r["value"] for r in json.loads(one_json(spark, "result", msg))["lab_test_results"]]
    assert vals == ["a^b", "x\\F\\y"]


def test_bad_utf8_becomes_replacement_char(spark):
    msg = S.ACK.encode().replace(b"|Accepted", b"|A\xffB")
    assert json.loads(one_json(spark, "ack", msg))["acknowledgment_description"] == "A�B"


def test_empty_and_blank_values_are_skipped(spark):
    raw = raw_frame(spark, [None, b"", "  \r\n\t ", S.ACK])
    assert [r.offset for r in parse_messages(raw, "ack").collect()] == [3]


def test_order_table_drops_message_id_and_patient(spark):
    rows = table_rows(parse_messages(raw_frame(spark, [S.ORDER]), "order"), "order")
    assert rows.columns[:5] == ["lab_order_id", "sending_facility_id", "receiving_lab_code",
                                "sending_date_time", "lab_tests_ordered"]
    assert rows.collect()[0].lab_tests_ordered == '[{"code":"1111-1","name":"Test One","type":"Regular"}]'


def test_regex_special_field_separator(spark):
    msg = S.ORDER.replace("|", "$")
    assert one_json(spark, "order", msg) == S.ORDER_JSON


def test_header_time_by_kind(spark):
    import pytest

    short = "202403060800"
    res = json.loads(one_json(spark, "result", S.RESULT.replace("20240306080000", short)))
    assert res["sending_date_time"] == "2024-03-06T08:00:00"
    with pytest.raises(Exception, match="could not be parsed"):
        one_json(spark, "ack", S.ACK.replace("20240305101600", short))
    empty = {"order": S.ORDER.replace("20240305101530", ""), "ack": S.ACK.replace("20240305101600", ""),
             "result": S.RESULT.replace("20240306080000", "")}
    for kind, msg in empty.items():
        assert json.loads(one_json(spark, kind, msg))["sending_date_time"] is None
