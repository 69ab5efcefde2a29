"""labrelay: clinical lab messages (orders, acks, results) as Spark DataFrames.

Raw pipe-delimited messages from Kafka or files are shredded with built-in
column expressions into typed records, filtered on their business key, and
written as JSON and as keyed last-write-wins upserts into current-state tables.
The same functions serve batch DataFrames and Structured Streaming.
"""

from .plans.batch import current_rows, json_values, parse_messages, records, shred, table_rows
from .plans.describe import described_kind
from .plans.kinds import ACK, KINDS, ORDER, RESULT, MessageKind, get_kind

__all__ = [
    "ACK",
    "KINDS",
    "ORDER",
    "RESULT",
    "MessageKind",
    "current_rows",
    "described_kind",
    "get_kind",
    "json_values",
    "parse_messages",
    "records",
    "shred",
    "table_rows",
]
