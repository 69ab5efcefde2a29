"""Field access inside one segment string.

``value(seg, n, c)`` reads "segment-n.c" the way the reference's typed getters
do: first repetition -> component ``c`` -> first subcomponent -> unescape ->
empty string becomes NULL. Everything is ``split_part`` (literal delimiter
taken per row, no regex); only a value that holds the escape character goes
through the left-to-right unescape.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .segments import ENV, ESCAPE_CODES, STANDARD_DELIMITERS, Env, first_part, quote_re


def field(seg: Column, n: int, env: Env = ENV, *, header: bool = False) -> Column:
    """Raw field ``n`` of a segment ('' when absent, NULL when the segment is NULL).

    In the header the separator itself is field 1, so MSH-n is split piece n;
    in every other segment piece 1 is the name and field n is piece n+1.
    """
    return F.split_part(seg, env.fs, F.lit(n if header else n + 1))


def unescape(s: Column, env: Env = ENV) -> Column:
    """Escape sequences ``<es>X<es>`` -> the delimiters they stand for.

    One regex finds the sequences exactly as a left-to-right reader does
    (``\\E\\F\\`` is one ``\\E\\``, then the text ``F\\``); the text between them
    and what each stands for are joined again. Any text is safe: nothing is
    marked inside it. Messages without an escape character skip all of this.

    The lambda also keeps the projections that read fields out of one fused
    whole-stage method, which the JVM would be too large to compile: Spark
    then generates them as many small methods.
    """
    pattern = F.concat(quote_re(env.es), F.lit("[" + "".join(ESCAPE_CODES) + "]"), quote_re(env.es))
    targets = dict(zip(ESCAPE_CODES, zip((env.fs, env.cs, env.ss, env.rs, env.es), STANDARD_DELIMITERS)))

    def meaning(found: Column) -> Column:
        code = F.substr(found, F.length(env.es) + 1, F.lit(1))
        out = F.when(found.isNull(), F.lit(""))
        for x, (delimiter, standard) in targets.items():
            out = out.when(code == x, F.coalesce(F.nullif(delimiter, F.lit("")), F.lit(standard)))
        return out

    joined = F.array_join(
        F.zip_with(F.split(s, pattern), F.regexp_extract_all(s, pattern, F.lit(0)), lambda text, found: F.concat(text, meaning(found))),
        "",
    )
    return F.when(env.esc & F.contains(s, env.es), joined).otherwise(s)


def split_fields(seg: Column, env: Env = ENV) -> Column:
    """Segment -> array of its raw fields, split once (element n = field n, or
    MSH-(n+1) for the header; element 0 = the name). Java's split takes a fast
    path for a backslash-quoted non-alphanumeric separator."""
    return F.split(seg, env.fsre)


def field_value(raw_field: Column, comp: int = 1, env: Env = ENV) -> Column:
    """Typed-getter value of an already extracted raw field: first repetition,
    component ``comp``, first subcomponent, unescaped; NULL if empty or absent."""
    rep1 = first_part(raw_field, env.rs)
    component = first_part(rep1, env.cs) if comp == 1 else F.split_part(rep1, env.cs, F.lit(comp))
    return F.nullif(unescape(first_part(component, env.ss), env), F.lit(""))


def value(seg: Column, n: int, comp: int = 1, env: Env = ENV, *, header: bool = False) -> Column:
    """Typed-getter value of field ``n`` component ``comp``; NULL if empty or absent."""
    return field_value(field(seg, n, env, header=header), comp, env)


def encoded_value(raw_field: Column, env: Env = ENV) -> Column:
    """First repetition of a raw field re-encoded: components and escapes kept,
    trailing empty components/subcomponents dropped (``a^b^^`` -> ``a^b``)."""
    rep1 = first_part(raw_field, env.rs)
    trailing = F.concat(F.lit("[\\Q"), env.cs, env.ss, F.lit("\\E]+$"))
    ends_empty = (env.cs != "") & (rep1.endswith(env.cs) | ((env.ss != "") & rep1.endswith(env.ss)))
    trimmed = F.when(ends_empty, F.regexp_replace(rep1, trailing, F.lit(""))).otherwise(rep1)
    return trimmed


def encoded_first_repetition(seg: Column, n: int, env: Env = ENV) -> Column:
    """``encoded_value`` of field ``n`` of a segment."""
    return encoded_value(field(seg, n, env), env)


def has_repetition(seg: Column, n: int, env: Env = ENV) -> Column:
    """True when field ``n`` holds at least one repetition (any non-empty raw text)."""
    return F.length(field(seg, n, env)) > 0
