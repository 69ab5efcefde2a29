"""Byte and text level column functions.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen and run wherever the message partition lives.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType

# Fixed value: Java's String.trim() removes every char <= U+0020, so a message
# made only of such chars is "blank" and is skipped, not parsed.
_NOT_BLANK = r"[^\x00-\x20]"


def decode_utf8(value: Column, value_type: DataType | None = None) -> Column:
    """Bytes -> text as UTF-8. Malformed byte sequences become U+FFFD, never an error.

    A string column passes through untouched (already text).
    """
    if value_type is not None and not isinstance(value_type, BinaryType):
        return value.cast("string")
    return F.make_valid_utf8(value.cast("string"))


def is_empty(value: Column) -> Column:
    """Null or zero-length value (binary or string)."""
    return value.isNull() | (F.octet_length(value) == 0)


def is_blank(text: Column) -> Column:
    """True when the text holds only chars <= U+0020 (Java ``trim()`` semantics).

    Spark's ``trim`` only strips spaces, so it cannot be used here. Fast path:
    a text whose first char is above U+0020 (every real message starts with
    ``MSH``) is not blank - a one-byte compare instead of a regex scan.
    """
    first_visible = F.substr(text, F.lit(1), F.lit(1)) > F.lit(" ")
    return ~(first_visible | text.rlike(_NOT_BLANK))
