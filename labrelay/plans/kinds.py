"""Message kinds: the one extension point.

A kind bundles what the reference spreads over a parser class, a filter
lambda, a JSON schema and a database sink: which header structure it accepts,
the projection, the business key, and the current-state table layout.
Adding a kind means adding one ``MessageKind``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators.acks import project_acks
from ..operators.orders import project_orders
from ..operators.results import project_results


# Names of the topics, tables, their schema and columns; users'
# consumers and databases rely on them.
SCHEMA = "crt"


@dataclass(frozen=True)
class MessageKind:
    name: str
    structure: str
    project: Callable[[DataFrame], DataFrame]
    key: str
    record_columns: tuple[str, ...]
    table: str  # without its schema, see ``SCHEMA``
    table_columns: tuple[str, ...]
    json_columns: tuple[str, ...] = ()  # nested columns stored as JSON text in the table
    default_topic: str = ""
    default_json_topic: str = ""


ORDER = MessageKind(
    name="order",
    structure="OML_O21",
    project=project_orders,
    key="lab_order_id",
    record_columns=(
        "lab_order_id",
        "sending_facility_id",
        "receiving_lab_code",
        "sending_date_time",
        "lab_tests_ordered",
        "message_id",
        "patient",
    ),
    table="lab_orders",
    # the table keeps neither the message id nor the patient
    table_columns=(
        "lab_order_id",
        "sending_facility_id",
        "receiving_lab_code",
        "sending_date_time",
        "lab_tests_ordered",
    ),
    json_columns=("lab_tests_ordered",),
    default_topic="lab-orders",
    default_json_topic="lab-orders-json-extract",
)

ACK = MessageKind(
    name="ack",
    structure="ACK",
    project=project_acks,
    key="ack_message_id",
    record_columns=(
        "sending_facility_id",
        "targeted_disa_code",
        "sending_date_time",
        "message_id",
        "ack_message_id",
        "acknowledgment_status",
        "acknowledgment_description",
    ),
    table="lab_orders_ack",
    table_columns=(
        "sending_facility_id",
        "targeted_disa_code",
        "sending_date_time",
        "message_id",
        "ack_message_id",
        "acknowledgment_status",
        "acknowledgment_description",
    ),
    default_topic="lab-orders-ack",
    default_json_topic="lab-orders-ack-json-extract",
)

RESULT = MessageKind(
    name="result",
    structure="ORU_R01",
    project=project_results,
    key="lab_order_id",
    record_columns=(
        "lab_order_id",
        "sending_facility_id",
        "receiving_lab_code",
        "sending_date_time",
        "lab_test_results",
        "message_id",
        "patient_nupn",
    ),
    table="lab_results",
    table_columns=(
        "lab_order_id",
        "sending_facility_id",
        "receiving_lab_code",
        "sending_date_time",
        "lab_test_results",
        "message_id",
        "patient_nupn",
    ),
    json_columns=("lab_test_results",),
    default_topic="lab-results",
    default_json_topic="lab-results-json-extract",
)

KINDS = {k.name: k for k in (ORDER, ACK, RESULT)}


def get_kind(kind: str | MessageKind) -> MessageKind:
    if isinstance(kind, MessageKind):
        return kind
    try:
        return KINDS[kind]
    except KeyError:
        raise ValueError(f"unknown message kind {kind!r}; known: {sorted(KINDS)}") from None
