"""The extension point: a new kind is one MessageKind."""

from conftest import raw_frame

import samples as S
from labrelay import MessageKind, current_rows, json_values, parse_messages
from labrelay.functions.header import first_error, header_fields, hv, kind_error
from labrelay.operators.shred import passthrough
from pyspark.sql import functions as F


def project_headers(df):
    """A minimal kind: any ORU_R01 message, keyed by its control id."""
    keep = passthrough(df)
    staged = df.select("*", header_fields().alias("_s_msh"))
    msh = F.col("_s_msh")
    return staged.select(
        *keep,
        hv(msh, 10).alias("message_id"),
        hv(msh, 3).alias("sending_application"),
        first_error(kind_error(msh, "ORU_R01")).alias("_error"),
    )


HEADERS = MessageKind(
    name="result_header",
    structure="ORU_R01",
    project=project_headers,
    key="message_id",
    record_columns=("message_id", "sending_application"),
    table="result_headers",
    table_columns=("message_id", "sending_application"),
)


def test_custom_kind_runs_through_the_same_plan(spark):
    raw = raw_frame(spark, [S.RESULT, S.RESULT.replace("LabApp", "OtherApp")])
    recs = parse_messages(raw, HEADERS)
    assert [r.value for r in json_values(recs, HEADERS).collect()] == [
        '{"message_id":"res-0001","sending_application":"LabApp"}',
        '{"message_id":"res-0001","sending_application":"OtherApp"}',
    ]
    assert [r.sending_application for r in current_rows(recs, HEADERS).collect()] == ["OtherApp"]


def test_described_kinds_equal_the_built_in_ones(spark):
    from labrelay.plans.catalog import DESCRIBED_ACK, DESCRIBED_ORDER

    bad = [S.RESULT, "hello", S.ACK.replace("20240305101600", "2024"), S.ACK.replace("|P|2.5", "|P|2.3"), None, " "]
    esc = S.ACK.replace("Accepted", "a\\S\\b^c")
    swapped = S.ORDER.replace("ORC|", "XXX|").replace("OBR|", "ORC|").replace("XXX|", "OBR|")
    for described, name, messages in ((DESCRIBED_ACK, "ack", [S.ACK, S.FULL_ACK, esc, *bad]),
                                      (DESCRIBED_ORDER, "order", [S.ORDER, S.FULL_ORDER, S.ORDER + "\r" + S.ORDER, swapped, *bad])):
        raw = raw_frame(spark, messages)
        rows = [parse_messages(raw, k, mode="PERMISSIVE") for k in (described, name)]
        assert sorted(map(str, rows[0].drop("_raw").collect())) == sorted(map(str, rows[1].drop("_raw").collect()))
        assert rows[0].schema.simpleString() == rows[1].schema.simpleString()
        assert sorted(map(str, current_rows(rows[0], described).collect())) == sorted(map(str, current_rows(rows[1], name).collect()))


def test_descriptions_that_cannot_be_read():
    import pytest

    from labrelay.plans.describe import described_kind

    for columns, key, groups in (({"a": "PID3"}, "a", {}), ({"a": "PID-3 as time"}, "a", {}), ({"a": "PID-3"}, "b", {}),
                                 ({"a": ["PID-3"]}, "a", {}), ({"a": "PID-3"}, "a", {"PID": "last"}), ({"a": "PID-3 or"}, "a", {})):
        with pytest.raises(ValueError):
            described_kind("k", "ACK", columns, key, "t", groups)
