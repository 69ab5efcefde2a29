"""Message envelope: delimiters and segment positions.

A pipe-delimited message is one string: segments separated by CR, fields by
the separator declared at char 4 of the header, components / repetitions /
escape / subcomponents by chars 5-8. Instead of splitting every message into an
array and walking it with lambdas (interpreted, outside codegen), the message
is rewritten once into a *canonical* string::

    "\\rMSH|...|\\rPID|...|\\rORC|...|"

* CRLF, blank lines and leading whitespace of a segment disappear (a CR plus
  any following whitespace collapses to one CR);
* every segment starts with CR and ends with the field separator, so
  ``locate('\\r' || name || fs)`` finds a segment by exact name, and segments
  that carry only a name still match.

Segments and groups are then picked by integer positions with ``locate``,
``substring_index`` and ``regexp_instr``; all of them are codegen'd
expressions evaluated inside the scan stage, no shuffle, no Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CR = "\r"

# Column names the envelope adds; dropped again by the kind projections.
ENV_COLS = ("_fs", "_cs", "_rs", "_es", "_ss", "_c", "_body", "_esc", "_fsre")

# The five standard escape codes. \F\ field sep, \S\ component
# sep, \T\ subcomponent sep, \R\ repetition sep, \E\ escape char.
ESCAPE_CODES = ("F", "S", "T", "R", "E")


def call(name: str, *cols: Column) -> Column:
    """Call a built-in SQL function whose PySpark wrapper wants literals."""
    return F.call_function(name, *cols)


def quote_re(ch: Column) -> Column:
    """Regex-quote a per-row delimiter (``\\Q..\\E`` works for any one char)."""
    return F.concat(F.lit("\\Q"), ch, F.lit("\\E"))


def first_part(s: Column, delimiter: Column) -> Column:
    """``s`` up to the first delimiter (all of it if there is none, or the header
    declares none); unlike ``split_part`` it doesn't cut the rest."""
    return F.when(delimiter == "", s).otherwise(call("substring_index", s, delimiter, F.lit(1)))


@dataclass(frozen=True)
class Env:
    """Per-row delimiters and canonical text, by column name (resolved lazily)."""

    names: tuple[str, ...] = ENV_COLS

    @property
    def fs(self) -> Column:  # field separator
        return F.col(self.names[0])

    @property
    def cs(self) -> Column:  # component separator
        return F.col(self.names[1])

    @property
    def rs(self) -> Column:  # repetition separator
        return F.col(self.names[2])

    @property
    def es(self) -> Column:  # escape char
        return F.col(self.names[3])

    @property
    def ss(self) -> Column:  # subcomponent separator
        return F.col(self.names[4])

    @property
    def c(self) -> Column:  # canonical text
        return F.col(self.names[5])

    @property
    def esc(self) -> Column:  # the message may hold escape sequences
        return F.col(self.names[7])

    @property
    def fsre(self) -> Column:  # regex that splits at the field separator
        return F.col(self.names[8])


ENV = Env()


def delimiter_columns(text: Column) -> list[Column]:
    """Field separator = char 4; the encoding field (MSH-2) holds the other four.

    Also ``_body``: the position where the text after MSH-2 starts (escape
    sequences can only occur from there on).
    """
    fs = F.substr(text, F.lit(4), F.lit(1))
    enc = first_part(F.substr(text, F.lit(5)), fs)
    return [
        fs.alias("_fs"),
        F.substr(enc, F.lit(1), F.lit(1)).alias("_cs"),
        F.substr(enc, F.lit(2), F.lit(1)).alias("_rs"),
        F.substr(enc, F.lit(3), F.lit(1)).alias("_es"),
        F.substr(enc, F.lit(4), F.lit(1)).alias("_ss"),
        (F.length(enc) + 5).alias("_body"),
    ]


def may_escape(text: Column, es: Column, body: Column) -> Column:
    """The escape char occurs after the encoding field (cheap byte search)."""
    return (es != "") & (call("locate", es, text, body) > 0)


def _quote_replacement(s: Column) -> Column:
    """Make a per-row string literal inside a regex replacement ($ and \\ escaped)."""
    return F.replace(F.replace(s, F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))


def canonical(text: Column, fs: Column) -> Column:
    """CR-framed text, one CR before and one field separator after every segment.
    One regex pass frames the segments: every CR and the whitespace after it
    become ``fs + CR``. Nothing else is changed: escape sequences hold no
    delimiter, so they stay as they are until a field value is read."""
    framed = F.regexp_replace(text, F.lit(r"\r\p{javaWhitespace}*"), F.concat(_quote_replacement(fs), F.lit(CR)))
    return F.concat(F.lit(CR), framed, fs)


# The standard delimiters, for an escape code whose delimiter the
# header leaves out (order of the codes: field, component, subcomponent,
# repetition, escape).
STANDARD_DELIMITERS = "|^&~\\"


def with_envelope(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the delimiters ``_fs.._ss``, ``_body`` (start of the text after MSH-2),
    the canonical text ``_c`` and ``_esc`` (any escape character in the body)."""
    t = F.col(text)
    staged = df.select("*", *delimiter_columns(t))
    fs, es = F.col("_fs"), F.col("_es")
    # backslash-quoting a non-alphanumeric separator lets Java's split skip the regex engine
    # (a text too short for one gets a pattern that never matches)
    fsre = (
        F.when(fs == "", F.lit("(?!)"))
        .when(fs.rlike("^[A-Za-z0-9]$"), F.concat(F.lit("\\Q"), fs, F.lit("\\E")))
        .otherwise(F.concat(F.lit("\\"), fs))
    )
    return staged.select(
        "*",
        canonical(t, fs).alias("_c"),
        may_escape(t, es, F.col("_body")).alias("_esc"),
        fsre.alias("_fsre"),
    )


def segment_pos(name: str, env: Env = ENV, start: Column | int = 1) -> Column:
    """1-based position of the CR before the first segment ``name`` at/after ``start``; 0 if none."""
    needle = F.concat(F.lit(CR + name), env.fs)
    start_col = start if isinstance(start, Column) else F.lit(start)
    return call("locate", needle, env.c, start_col)


def segment_at(pos: Column, env: Env = ENV) -> Column:
    """Segment text (``NAME|f1|..|``) starting after the CR at ``pos``; NULL when ``pos`` is 0."""
    return F.when(pos > 0, F.substring_index(F.substr(env.c, pos + 1), CR, 1))


def first_segment(name: str, env: Env = ENV) -> Column:
    return segment_at(segment_pos(name, env), env)


def segments(text: Column) -> Column:
    """Array of segments as the reference's parser sees them (B1).

    Split at CR, strip leading whitespace, ignore fragments shorter than 3 chars.
    Used for reporting only; field access goes through the canonical string.
    """
    norm = F.regexp_replace(text, r"\r\p{javaWhitespace}*", CR)
    return F.filter(F.split(norm, CR), lambda s: F.length(s) >= 3)


def slice_from(pos: Column, env: Env = ENV) -> Column:
    """Canonical text from the segment at ``pos`` (without its leading CR) to the end."""
    return F.substr(env.c, pos + 1)


def cut_at_boundary(rest: Column, names: tuple[str, ...], env: Env = ENV) -> Column:
    """Prefix of ``rest`` up to the first later segment whose name is in ``names``."""
    pattern = F.concat(F.lit(CR + "(?:" + "|".join(names) + ")"), quote_re(env.fs))
    end = F.regexp_instr(rest, pattern)
    return F.when(end > 0, F.substr(rest, F.lit(1), end - 1)).otherwise(rest)


def all_segments(text_slice: Column, name: str, env: Env = ENV) -> Column:
    """Every segment called ``name`` inside a slice of canonical text, in order."""
    pattern = F.concat(F.lit(CR + "(" + name), quote_re(env.fs), F.lit("[^" + CR + "]*)"))
    # a slice produced by slice_from() has no CR before its first segment
    return F.regexp_extract_all(F.concat(F.lit(CR), text_slice), pattern, F.lit(1))


def well_formed(text: Column, env: Env = ENV) -> Column:
    """Pipe encoding check: starts with MSH, and every segment of 4+ chars has the
    field separator as its 4th char (else the message is not pipe-encoded)."""
    bad_segment = F.concat(F.lit(CR + "[^" + CR + "]{3}(?!"), quote_re(env.fs), F.lit(")[^" + CR + "]"))
    return (
        text.startswith("MSH")
        & (F.length(text) >= 4)
        # regexp_like would compile the pattern, which differs by row, for every row
        & ~F.coalesce(F.regexp_instr(env.c, bad_segment) > 0, F.lit(False))
    )
