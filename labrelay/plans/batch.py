"""Message table -> records -> {JSON rows, table rows}: the per-kind plan.

Every function works on batch and streaming DataFrames alike. Parsing and
JSON never shuffle: scan -> filter -> project, one stage. The only shuffle of
a pipeline is the keyed dedupe behind ``current_rows`` (``operators.upsert``).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fields import value
from ..functions.jsonfmt import record_json, to_json_text
from ..functions.plan import fenced_select
from ..functions.segments import first_segment
from ..operators.counts import BatchCounts, observed
from ..operators.errors import ERROR, PLACE, apply_mode, clean_rows, keep_keyed, malformed_rows
from ..operators.messages import arrival_columns, prepare
from ..operators.shred import passthrough
from ..operators.upsert import latest_per_key
from .kinds import MessageKind, get_kind


def shred(raw: DataFrame, kind: str | MessageKind, mode: str = "PERMISSIVE", counts: BatchCounts | None = None) -> DataFrame:
    """Raw messages -> one record per non-blank message, before the key filter.

    In ``PERMISSIVE`` (the default here) the ``_error`` column is kept, and the bytes
    of malformed messages in ``_raw``. ``counts`` counts the rows on their way.
    """
    k = get_kind(kind)
    projected = k.project(prepare(raw, keep_raw=mode.upper() == "PERMISSIVE", counts=counts))
    # fenced: no filter (key filter, error filter, inferred explode filters)
    # is rewritten below the parse projection, so the parse runs once per row
    parsed = fenced_select(projected, *projected.columns)
    sound, keyed = F.col(ERROR).isNull(), F.col(k.key).isNotNull()
    parsed = observed(parsed, counts, malformed=F.count_if(~sound), keyless=F.count_if(sound & ~keyed), records=F.count_if(sound & keyed))
    return apply_mode(parsed, k.key, mode)


def parse_messages(
    raw: DataFrame, kind: str | MessageKind, mode: str = "FAILFAST", where: Column | str | None = None,
    counts: BatchCounts | None = None,
) -> DataFrame:
    """Raw messages -> keyed records (+ arrival columns, + ``_error`` and ``_raw`` if
    PERMISSIVE, which also keeps malformed rows without a key).

    ``where`` filters the raw table (topic, partition, offset, a date folder, ...)
    ahead of the parse, so it reaches the scan; filters on the parsed columns do
    not, since the parse is fenced.
    """
    k = get_kind(kind)
    return keep_keyed(shred(raw if where is None else raw.filter(where), k, mode, counts), k.key)


def records(df: DataFrame, kind: str | MessageKind) -> DataFrame:
    """Only the record columns, in declaration order."""
    return df.select(*get_kind(kind).record_columns)


def json_values(df: DataFrame, kind: str | MessageKind) -> DataFrame:
    """Records -> ``value`` JSON text (+ arrival columns), as written to the JSON topic.
    Malformed rows of a PERMISSIVE parse are left out (see ``error_values``)."""
    k = get_kind(kind)
    df = clean_rows(df, k.key)
    return df.select(*arrival_columns(df), record_json(*k.record_columns).alias("value"))


def error_values(df: DataFrame, kind: str | MessageKind) -> DataFrame:
    """Malformed rows of a PERMISSIVE parse -> ``value`` JSON text: what could be read, and ``_error``."""
    k = get_kind(kind)
    bad = malformed_rows(df)
    place = [c for c in PLACE if c in bad.columns]
    return bad.select(*arrival_columns(bad), record_json(*place, *k.record_columns, ERROR).alias("value"))


def current_rows(df: DataFrame, kind: str | MessageKind, order: Sequence[str] | None = None) -> DataFrame:
    """Records (with arrival columns) -> one table row per key, latest arrival wins
    (``order``: other columns of ``df`` to decide it, e.g. ``BROKER_TIME_ORDER``).

    Dedupes the records first and serializes nested columns after, so rows
    that lose to a later message are never turned into JSON. Malformed rows of
    a PERMISSIVE parse are left out.
    """
    k = get_kind(kind)
    df = clean_rows(df, k.key)
    by = list(order) if order is not None else arrival_columns(df)
    latest = latest_per_key(df.select(*k.table_columns, *by), k.key, order=by)
    return table_rows(latest, k)


def table_rows(df: DataFrame, kind: str | MessageKind) -> DataFrame:
    """Records -> current-state table columns; nested columns become JSON text."""
    k = get_kind(kind)
    cols = [to_json_text(F.col(c)).alias(c) if c in k.json_columns else F.col(c) for c in k.table_columns]
    extra = [c for c in arrival_columns(df)] + ([ERROR] if ERROR in df.columns else [])
    return df.select(*cols, *extra)


_SPEC = re.compile(r"^([A-Z0-9]{3})-(\d+)(?:\.(\d+))?$")


def extract_fields(raw: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Ad-hoc field access over raw messages.

    ``spec`` maps output names to ``"SEG-n"`` or ``"SEG-n.c"`` (e.g.
    ``{"nupn": "PID-3.1", "sent": "MSH-7"}``); each reads the *first* segment
    of that name with typed-getter semantics (first repetition, component
    ``c``, first subcomponent, unescaped, empty -> NULL). No group rules,
    no kind check: the generic accessor behind the kind projections.
    """
    parsed = {}
    for out, ref in spec.items():
        m = _SPEC.match(ref)
        if not m:
            raise ValueError(f"field reference must look like 'PID-3' or 'PID-3.1', got {ref!r}")
        parsed[out] = (m.group(1), int(m.group(2)), int(m.group(3) or 1))
    env = prepare(raw)
    keep = passthrough(env)
    names = sorted({seg for seg, _, _ in parsed.values()})
    staged = env.select("*", *(first_segment(n).alias(f"_s_{n}") for n in names))
    return staged.select(
        *keep,
        *(
            value(F.col(f"_s_{seg}"), n, c, header=(seg == "MSH")).alias(out)
            for out, (seg, n, c) in parsed.items()
        ),
    )


def delimiters(raw: DataFrame) -> DataFrame:
    """Per message: the five delimiters its header declares."""
    env = prepare(raw)
    return env.select(
        *passthrough(env),
        F.col("_fs").alias("field_separator"),
        F.col("_cs").alias("component_separator"),
        F.col("_rs").alias("repetition_separator"),
        F.col("_es").alias("escape_character"),
        F.col("_ss").alias("subcomponent_separator"),
    )
