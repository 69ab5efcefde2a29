"""Message kinds from a description.

``described_kind`` compiles a table of columns to the projection of a ``MessageKind``,
so a new kind needs no code::

    described_kind(
        "admission", "ADT_A01", key="visit_id", table="admissions",
        columns={
            "visit_id": "PV1-19.1",
            "facility": "MSH-4.2 or MSH-4.1",            # the first that is there
            "sent": "MSH-7 as strict time",              # or: as lenient time
            "patient": {"id": "PID-3.1", "sex": "PID-8"},  # a struct
            "events": [{"code": "EVN-1", "type": "'ADT'"}],  # an array of one, a literal
        })

A reference ``SEG-n`` or ``SEG-n.c`` reads as the built-in kinds do: first repetition,
component, first subcomponent, unescaped, empty is NULL. ``groups`` says which
segment of a name is meant: ``first`` of the message (the default), or, by the rules of
``operators.shred.group_flags``, that of the ``first order group`` (ORC, OBR) or the
``patient ahead of it`` (PID). A malformed time, a wrong kind or version and text
that is not pipe-delimited become ``_error``, as everywhere.

The projection runs in the same steps as a hand-written one: segments, each found
once, then raw values, each read once, then typed columns.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fields import value
from ..functions.header import first_error, header_fields, hv, kind_error
from ..functions.segments import first_segment, segment_at, well_formed
from ..functions.times import parsed_time
from ..operators.errors import ERROR
from ..operators.shred import NOT_PIPE_ENCODED, TEXT, group_flags, passthrough, with_positions
from .kinds import MessageKind

FIRST, ORDER_GROUP, PATIENT = "first", "first order group", "patient ahead of it"
#: Segments that a group rule can be given for, and its place in ``group_flags``.
_RULES = {(ORDER_GROUP, "ORC"): 0, (ORDER_GROUP, "OBR"): 1, (PATIENT, "PID"): 2}
_REFERENCE = re.compile(r"([A-Z][A-Z0-9]{2})-([1-9]\d*)(?:\.([1-9]\d*))?")
_SCALAR = re.compile(r"(?P<refs>[^']+?)(?: as (?P<time>strict|lenient) time)?")

Spec = str | Mapping | list


class _Scalar:
    """A column read from fields: its references in order of preference, and the parser of a time."""

    def __init__(self, text: str):
        m = _SCALAR.fullmatch(text)
        refs = [_REFERENCE.fullmatch(r.strip()) for r in m["refs"].split(" or ")] if m else [None]
        if not all(refs):
            raise ValueError(f"a column must look like 'PID-3.1', 'MSH-4.2 or MSH-4.1', 'MSH-7 as strict time' or \"'text'\", got {text!r}")
        self.refs = [(r[1], int(r[2]), int(r[3] or 1)) for r in refs]
        self.time = m["time"]

    def raw(self) -> Column:
        return F.coalesce(*(hv(F.col("_s_msh"), n, c) if seg == "MSH" else value(F.col(f"_s_{seg.lower()}"), n, c) for seg, n, c in self.refs))


def _scalars(spec: Spec) -> list[str]:
    """The texts of all columns read from fields, as they come."""
    if isinstance(spec, str):
        return [] if spec.startswith("'") else [spec]
    parts = spec.values() if isinstance(spec, Mapping) else spec
    return [s for part in parts for s in _scalars(part)]


def _column(spec: Spec, names: dict[str, Column]) -> Column:
    if isinstance(spec, str):
        return F.lit(spec[1:-1]) if spec.startswith("'") else names[spec]
    if isinstance(spec, Mapping):
        return F.struct(*(_column(s, names).alias(name) for name, s in spec.items()))
    return F.array(*(_column(s, names) for s in spec))


def described_projection(structure: str, columns: Mapping[str, Spec], groups: Mapping[str, str] | None = None):
    """The ``MessageKind.project`` of a description."""
    groups = dict(groups or {})
    texts = list(dict.fromkeys(s for spec in columns.values() for s in _scalars(spec)))
    scalars = {text: _Scalar(text) for text in texts}
    segments = sorted({seg for s in scalars.values() for seg, _, _ in s.refs} - {"MSH"})
    for seg, rule in groups.items():
        if rule != FIRST and (rule, seg) not in _RULES:
            raise ValueError(f"no rule {rule!r} for segment {seg!r}; known: {FIRST!r}, {sorted(_RULES)}")
    ruled = [s for s in segments if groups.get(s, FIRST) != FIRST]

    def segment(seg: str) -> Column:
        if seg not in ruled:
            return first_segment(seg)
        return F.when(group_flags()[_RULES[groups[seg], seg]], segment_at(F.col(f"_p_{seg.lower()}")))

    def project(df: DataFrame) -> DataFrame:
        keep = passthrough(df)
        bad = F.when(~well_formed(F.col(TEXT)), F.lit(NOT_PIPE_ENCODED))
        staged = (with_positions(df) if ruled else df).select(
            "*", header_fields().alias("_s_msh"), bad.alias("_s_bad"), *(segment(s).alias(f"_s_{s.lower()}") for s in segments))
        raw = {text: f"_v_{i}" for i, text in enumerate(texts)}
        vals = staged.select(*keep, "_s_bad", kind_error(F.col("_s_msh"), structure).alias("_v_kind"),
                             *(s.raw().alias(raw[text]) for text, s in scalars.items()))
        times = [text for text, s in scalars.items() if s.time]
        typed = vals.select("*", *(parsed_time(F.col(raw[t]), lenient=scalars[t].time == "lenient").alias(f"{raw[t]}_t") for t in times))
        names = {t: F.col(f"{raw[t]}_t.value") if t in times else F.col(raw[t]) for t in texts}
        errors = [F.col(f"{raw[t]}_t.error") for t in times]
        return typed.select(*keep, *(_column(spec, names).alias(name) for name, spec in columns.items()),
                            first_error(F.col("_s_bad"), F.col("_v_kind"), *errors).alias(ERROR))

    return project


def described_kind(
    name: str,
    structure: str,
    columns: Mapping[str, Spec],
    key: str,
    table: str,
    groups: Mapping[str, str] | None = None,
    table_columns: tuple[str, ...] | None = None,
    default_topic: str = "",
    default_json_topic: str = "",
) -> MessageKind:
    """A message kind without code; nested columns of its table are stored as JSON text."""
    if not isinstance(columns.get(key), str):
        raise ValueError(f"the key {key!r} must be one of the columns, and no struct or array")
    stored = tuple(table_columns or columns)
    if missing := [c for c in stored if c not in columns]:
        raise ValueError(f"table columns that are not described: {missing}")
    return MessageKind(
        name=name, structure=structure, project=described_projection(structure, columns, groups), key=key,
        record_columns=tuple(columns), table=table, table_columns=stored,
        json_columns=tuple(c for c in stored if not isinstance(columns[c], str)),
        default_topic=default_topic, default_json_topic=default_json_topic)
