"""Malformed messages kept so that they can be parsed again.

A PERMISSIVE parse carries the bytes of a malformed message beside its ``_error``.
``quarantine_rows`` takes both out with the message's place; ``quarantined_messages``
gives quarantined rows, repaired or not, the shape that ``parse_messages`` reads. A
message that comes back arrives anew: written to a state table, it wins over what
the table holds, as a message that is sent again would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.plan import fence
from ..plans.kinds import MessageKind, get_kind
from .errors import ERROR, RAW, malformed_rows
from .messages import arrival_columns

#: Columns of a quarantine table besides arrival columns.
QUARANTINE = ("kind", "topic", "error", "value")


def quarantine_rows(parsed: DataFrame, kind: str | MessageKind) -> DataFrame:
    """The malformed rows of a PERMISSIVE parse: kind, topic, arrival columns, error, value (binary)."""
    bad = malformed_rows(parsed)
    topic = F.col("topic") if "topic" in bad.columns else F.lit(None).cast("string")
    return bad.select(F.lit(get_kind(kind).name).alias("kind"), topic.alias("topic"), *arrival_columns(bad),
                      F.col(ERROR).alias("error"), F.col(RAW).alias("value"))


def quarantined_messages(rows: DataFrame, kind: str | MessageKind, repair: Column | None = None) -> DataFrame:
    """Quarantined rows of ``kind`` as raw messages; ``repair`` replaces their value (binary
    or string, over the columns of ``rows``). It is fenced: the parse's filters on the value
    would otherwise repair each message again."""
    value = F.col("value") if repair is None else fence(repair)
    mine = rows.where(F.col("kind") == get_kind(kind).name)
    return mine.select("topic", *arrival_columns(mine), value.alias("value"))
