"""Message date-time parsing.

Both parsers return ``(value, error)`` columns: ``value`` is TIMESTAMP_NTZ or
NULL, ``error`` is NULL or the reason text. The caller decides whether an error
fails the job, drops the row or is reported (see ``operators.errors``).

The reference parses with a ``yyyyMMddHHmmss`` pattern in its default (smart)
resolver mode, which a Spark format cannot mimic exactly: a day 29-31 past the
month end is clamped to the last day, and ``24:00:00`` means midnight of the
next day. The value is therefore assembled from its digits with
``make_timestamp_ntz`` behind a range check, all native expressions.

The work is split in two steps, ``time_parts`` (digits -> ints, once) and
``time_value`` / ``time_error`` (read only those parts). In a projection the
optimizer fuses them; inside the observation lambdas (interpreted, no reuse
of common subexpressions) the caller runs them as two passes so each part is
computed once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The only lengths the lenient (result) parser can turn into a
# date-time. 12 = yyyyMMddHHmm; 8 and 10 are padded with "00" pairs; 14 is the
# full form. Length 19 goes to a pattern 18 chars wide and always fails;
# everything else fails in padding or parsing.
LENIENT_LENGTHS = (8, 10, 12, 14)

_PARTS = (("y", 1, 4), ("mo", 5, 2), ("d", 7, 2), ("h", 9, 2), ("mi", 11, 2), ("sec", 13, 2))


def time_parts(s: Column, lenient: bool) -> Column:
    """struct(present, usable, digits, y, mo, d, h, mi, sec) of a date-time text."""
    n = F.length(s)
    usable = n.isin(*LENIENT_LENGTHS) if lenient else (n == 14)
    candidate = F.rpad(s, 14, "0") if lenient else s
    return F.struct(
        (s.isNotNull() & (s != "")).alias("present"),
        usable.alias("usable"),
        candidate.rlike(r"^[0-9]{14}$").alias("digits"),
        # NULL on non-digits (try_cast); checked through ``digits`` below
        *(F.substr(candidate, F.lit(p), F.lit(w)).try_cast("int").alias(name) for name, p, w in _PARTS),
    )


def _ok(p: Column) -> Column:
    y, mo, d, h, mi, sec = (p[name] for name, _, _ in _PARTS)
    in_range = (
        (y >= 1)
        & mo.between(1, 12)
        & d.between(1, 31)
        & mi.between(0, 59)
        & sec.between(0, 59)
        & (h.between(0, 23) | ((h == 24) & (mi == 0) & (sec == 0)))
    )
    return F.coalesce(p["usable"] & p["digits"] & in_range, F.lit(False))


def time_value(p: Column) -> Column:
    """TIMESTAMP_NTZ from ``time_parts``; NULL when absent or invalid."""
    y, mo, d, h, mi, sec = (p[name] for name, _, _ in _PARTS)
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    month_end = F.when(mo == 2, F.when(leap, 29).otherwise(28)).when(mo.isin(4, 6, 9, 11), 30).otherwise(31)
    base = F.make_timestamp_ntz(y, mo, F.least(d, month_end), h % 24, mi, sec)
    value = F.when(h == 24, base + F.expr("INTERVAL 1 DAY")).otherwise(base)
    return F.when(p["present"] & _ok(p), value)


def time_error(p: Column, s: Column) -> Column:
    """NULL, or the reason a present date-time text cannot be parsed."""
    return F.when(
        p["present"] & ~_ok(p),
        F.concat(F.lit("Text '"), s, F.lit("' could not be parsed as a date-time")),
    )


def parsed_time(s: Column, lenient: bool) -> Column:
    """struct(value, error) of a date-time text, as one column to be read twice.

    The parts are a lambda's variable: they are computed once, and the projection
    is generated as small methods instead of one that the JVM would not compile.
    """
    one = F.transform(
        F.array(time_parts(s, lenient)), lambda p: F.struct(time_value(p).alias("value"), time_error(p, s).alias("error"))
    )
    return F.get(one, 0)


def parse_strict(s: Column) -> tuple[Column, Column]:
    """Orders and acks: NULL/empty -> NULL; otherwise exactly ``yyyyMMddHHmmss``."""
    p = parsed_time(s, lenient=False)
    return p["value"], p["error"]


def parse_lenient(s: Column) -> tuple[Column, Column]:
    """Results: by length (8, 10, 12, 14 parse; anything else is an error)."""
    p = parsed_time(s, lenient=True)
    return p["value"], p["error"]
