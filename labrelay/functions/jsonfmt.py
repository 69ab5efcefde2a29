"""JSON rendering of records.

Fixed format facts of the reference's JSON: nulls are written, not dropped;
zone-less date-times print as ISO text with seconds and no fraction; field
order is declaration order (= struct order here).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# to_json options that reproduce the reference's JSON text.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss",
}


def to_json_text(col: Column) -> Column:
    """Struct or array -> compact JSON text (an empty array gives ``[]``)."""
    return F.to_json(col, JSON_OPTIONS)


def record_json(*cols: str) -> Column:
    """Whole record -> JSON; a NULL record would give empty text (never reached after the key filter)."""
    return F.coalesce(to_json_text(F.struct(*cols)), F.lit(""))
