"""Header (MSH) reads shared by every message kind."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fields import field_value, split_fields
from .segments import CR, ENV, Env, first_part

# Fixed value: only the typed classes of this version are accepted.
ACCEPTED_VERSION = "2.5"


def header_segment(env: Env = ENV) -> Column:
    """The first segment of the canonical text (``MSH|..|``)."""
    return F.substring_index(F.substr(env.c, F.lit(2)), CR, 1)


def header_fields(env: Env = ENV) -> Column:
    """The header split into its raw fields once: element n-1 is MSH-n."""
    return split_fields(header_segment(env), env)


def hv(msh: Column, n: int, comp: int = 1, env: Env = ENV) -> Column:
    """Typed-getter value of MSH-n.comp, from the ``header_fields`` array."""
    return field_value(F.get(msh, n - 1), comp, env)


def message_structure(msh: Column, env: Env = ENV) -> Column:
    """Message structure named by MSH-9 (``msh`` = ``header_fields``).

    MSH-9.3 when present; a type of ``ACK`` alone is the ACK structure; else
    ``type_event`` (e.g. ``ORU^R01`` -> ``ORU_R01``); NULL when undeterminable.
    """
    msh9 = first_part(F.coalesce(F.get(msh, 8), F.lit("")), env.rs)

    def comp(i: int) -> Column:
        return F.split_part(msh9, env.cs, F.lit(i))

    c1, c2, c3 = comp(1), comp(2), comp(3)
    return (
        F.when(c3 != "", c3)
        .when(c1 == "ACK", F.lit("ACK"))
        .when((c1 != "") & (c2 != ""), F.concat(c1, F.lit("_"), c2))
    )


def version_id(msh: Column, env: Env = ENV) -> Column:
    return hv(msh, 12, 1, env)


def kind_error(msh: Column, structure: str, env: Env = ENV) -> Column:
    """NULL when the header names ``structure`` in the accepted version, else the reason."""
    ok = (message_structure(msh, env) == structure) & (version_id(msh, env) == ACCEPTED_VERSION)
    return F.when(
        ~F.coalesce(ok, F.lit(False)),
        F.lit(f"Message is not an {structure} message"),
    )


def first_error(*errors: Column) -> Column:
    """The first non-NULL reason, in evaluation order of the reference parser."""
    return F.coalesce(*errors)
