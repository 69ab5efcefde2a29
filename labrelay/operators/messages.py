"""Raw message table -> decoded, non-blank message text.

The raw table has the columns of a Kafka record (``value`` binary or string,
plus any of ``topic, partition, offset, timestamp, key``); file sources give
the same shape (see ``sources.messages``). Arrival columns are carried through
every later step so upserts can order rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.plan import fence
from ..functions.segments import with_envelope
from ..functions.text import decode_utf8, is_blank, is_empty
from .counts import BatchCounts, all_rows, observed
from .errors import RAW
from .shred import TEXT

# Fixed value: arrival-order columns, most significant first. A Kafka record is
# ordered by (partition, offset); its timestamp is the producer's clock and
# orders nothing unless the caller asks for it (``BROKER_TIME_ORDER``).
# ``file_time`` exists only for file sources without offsets: later files win;
# ``file_block``, where the row's piece of its file begins, only for text files.
ARRIVAL_COLUMNS = ("file_time", "partition", "file_block", "offset")
#: Optional order for topics whose broker stamps records on arrival.
BROKER_TIME_ORDER = ("timestamp", "partition", "offset")


def arrival_columns(df: DataFrame) -> list[str]:
    return [c for c in ARRIVAL_COLUMNS if c in df.columns]


def drop_empty(df: DataFrame, value: str = "value") -> DataFrame:
    """Drop NULL and zero-length values (skipped by the reference, not an error)."""
    return df.filter(~is_empty(F.col(value)))


def decode(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``text``: the value decoded as UTF-8 with replacement of bad bytes."""
    v = df.schema[value].dataType
    return df.withColumn(TEXT, fence(decode_utf8(F.col(value), v)))


def drop_blank(df: DataFrame) -> DataFrame:
    """Drop messages whose text is only chars <= U+0020."""
    return df.filter(~is_blank(F.col(TEXT)))


def prepare(df: DataFrame, value: str = "value", keep_raw: bool = False, counts: BatchCounts | None = None) -> DataFrame:
    """drop empty -> decode -> drop blank -> envelope; raw payload columns dropped
    (``keep_raw``: the value's bytes stay as ``_raw``)."""
    payload = [c for c in (value, "key") if c in df.columns]
    df = observed(df, counts, read=all_rows(), empty=F.count_if(is_empty(F.col(value))))
    text = decode(drop_empty(df, value), value)
    text = drop_blank(observed(text, counts, blank=F.count_if(is_blank(F.col(TEXT)))))
    if keep_raw:
        text = text.withColumn(RAW, F.col(value).cast("binary"))
    return with_envelope(text.drop(*payload), TEXT)
