"""Shared steps of the per-kind projections.

A kind projection runs as four narrow projections over the message table:

1. envelope  - delimiters + canonical text (``functions.segments``)
2. positions - where the first PID / ORC / OBR (and the ORC after it) start
3. segments  - the segment strings the kind reads
4. fields    - the record columns plus ``_error``

Splitting them keeps every costly value computed once per row: Catalyst only
merges adjacent projections when that does not duplicate non-trivial work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.header import header_fields
from ..functions.segments import ENV, ENV_COLS, quote_re, segment_at, segment_pos, well_formed

TEXT = "text"

NOT_PIPE_ENCODED = "Message is not pipe-delimited (no MSH header or a segment without the field separator)"


def passthrough(df: DataFrame) -> list[str]:
    """Columns carried unchanged (arrival order, topic, ...)."""
    internal = set(ENV_COLS) | {TEXT}
    return [c for c in df.columns if c not in internal and not c.startswith(("_p_", "_s_", "_v_"))]


# Segments that may stand between an order group's ORC and its
# OBR (timing/quantity) plus site-defined Z segments; anything else there
# (an OBX, NTE, SPM, another ORC, ...) closes the slot, and the next OBR then
# opens the following group.
BETWEEN_ORC_AND_OBR = r"(?:TQ1|TQ2|Z[A-Z0-9]{2})"


def with_positions(df: DataFrame) -> DataFrame:
    """Positions of the first PID, ORC and OBR, and of the first segment after
    that ORC which may not precede the group's OBR."""
    found = df.select(
        "*",
        segment_pos("PID").alias("_p_pid"),
        segment_pos("ORC").alias("_p_orc"),
        segment_pos("OBR").alias("_p_obr"),
    )
    p_orc = F.col("_p_orc")
    pattern = F.concat(F.lit("\r(?!" + BETWEEN_ORC_AND_OBR), quote_re(ENV.fs), F.lit(")"))
    nxt = F.nullif(F.regexp_instr(F.substr(ENV.c, p_orc + 1), pattern), F.lit(0))
    return found.select("*", F.when(p_orc > 0, F.coalesce(p_orc + nxt, F.lit(0))).otherwise(F.lit(0)).alias("_p_after_orc"))


def group_flags() -> tuple[Column, Column, Column]:
    """(orc_ok, obr_ok, pid_ok) for the first order group.

    * the first ORC belongs to group 1 only if no OBR precedes it;
    * with that ORC, the first OBR belongs to group 1 only if it is the next
      segment after it (timing and Z segments aside); without it, the first
      OBR opens group 1 itself;
    * the patient segment counts only ahead of the first order group.
    """
    p_pid, p_orc, p_obr, p_next = (F.col(c) for c in ("_p_pid", "_p_orc", "_p_obr", "_p_after_orc"))
    orc_ok = (p_orc > 0) & ((p_obr == 0) | (p_orc < p_obr))
    obr_ok = (p_obr > 0) & (~orc_ok | (p_next == p_obr))
    pid_ok = (p_pid > 0) & ((p_orc == 0) | (p_pid < p_orc)) & ((p_obr == 0) | (p_pid < p_obr))
    return orc_ok, obr_ok, pid_ok


def with_segments(df: DataFrame, extra: dict[str, Column] | None = None) -> DataFrame:
    """Header fields (array), patient, first ORC and OBR of group 1 as strings (NULL when absent)."""
    orc_ok, obr_ok, pid_ok = group_flags()
    cols = [
        header_fields().alias("_s_msh"),
        F.when(pid_ok, segment_at(F.col("_p_pid"))).alias("_s_pid"),
        F.when(orc_ok, segment_at(F.col("_p_orc"))).alias("_s_orc"),
        F.when(obr_ok, segment_at(F.col("_p_obr"))).alias("_s_obr"),
        F.when(well_formed(F.col(TEXT)), F.lit(None).cast("string"))
        .otherwise(F.lit(NOT_PIPE_ENCODED))
        .alias("_s_bad"),
    ]
    for name, col in (extra or {}).items():
        cols.append(col.alias(name))
    return df.select("*", *cols)


def seg(name: str) -> Column:
    return F.col(f"_s_{name}")


__all__ = [
    "ENV",
    "TEXT",
    "NOT_PIPE_ENCODED",
    "passthrough",
    "with_positions",
    "group_flags",
    "with_segments",
    "seg",
]
