"""Kind check and routing.

The reference hands every message of a topic to one parser, which rejects
any other kind ("Message is not an OML_O21 message", ...). ``route`` applies
the same header check to a message table and keeps the messages one kind
accepts - e.g. to split a mixed topic into per-kind streams without failing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.header import header_fields, kind_error
from ..functions.segments import well_formed
from .messages import prepare
from .shred import TEXT, passthrough


def accepted(structure: str) -> Column:
    """True when an envelope'd message is pipe-encoded and names ``structure`` in the accepted version."""
    return well_formed(F.col(TEXT)) & kind_error(header_fields(), structure).isNull()


def route(raw: DataFrame, structure: str) -> DataFrame:
    """Raw messages -> the non-blank messages of one structure (arrival columns + ``text``)."""
    env = prepare(raw)
    keep = passthrough(env)
    return env.filter(accepted(structure)).select(*keep, TEXT)
