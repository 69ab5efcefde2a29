"""What happens to a malformed message.

* ``FAILFAST`` (the reference's behaviour, default): the query fails. The
  check is wired into the *key* column, so it fires whenever the key is
  evaluated - by the key filter every pipeline applies, by ``select(key)``,
  by ``count()`` after the filter. An error on a row without a key still
  fails the job, as it does in the reference (it parses before filtering).
* ``DROPMALFORMED``: malformed rows are removed.
* ``PERMISSIVE``: rows are kept, with or without a key, the reason is in
  ``_error`` and the message's bytes in ``_raw`` (null for sound messages). Sinks take
  ``clean_rows`` only; ``malformed_rows`` go elsewhere (``operators.quarantine``).

The text a FAILFAST parse raises ends with the message's place (topic, partition,
offset, as far as they are known): a stopped stream can be mended there.

Plan shape. Filters on the key or on ``_error`` must stay *above* the parse
projection: Catalyst would otherwise push them below it by substituting the
column definitions, i.e. inline the whole parse (canonical text, positions,
time parsing) into the filter and run it twice per row - and the fused code
would outgrow the JVM's 64 KB method limit. ``plans.batch.shred`` therefore
fences the projection's outputs (``functions.plan.fenced_select``) before
the mode is applied; the guard below then only reads fenced columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


ERROR, RAW = "_error", "_raw"
#: Where a message stands in its source.
PLACE = ("topic", "partition", "offset")
MODES = ("FAILFAST", "DROPMALFORMED", "PERMISSIVE")


def apply_mode(df: DataFrame, key: str, mode: str = "FAILFAST") -> DataFrame:
    mode = mode.upper()
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    err = F.col(ERROR)
    if mode == "FAILFAST":
        place = [F.concat(F.lit(f"{c} "), F.col(c).cast("string")) for c in PLACE if c in df.columns]
        reason = F.concat(err, F.lit(" ("), F.concat_ws(", ", *place), F.lit(")")) if place else err
        guarded = F.when(err.isNotNull(), F.raise_error(reason)).otherwise(F.col(key))
        return df.withColumn(key, guarded).drop(ERROR, RAW)
    if mode == "DROPMALFORMED":
        return df.filter(err.isNull()).drop(ERROR, RAW)
    return df.withColumn(RAW, F.when(err.isNotNull(), F.col(RAW))) if RAW in df.columns else df


def keep_keyed(df: DataFrame, key: str) -> DataFrame:
    """Drop records without a business key; malformed rows of a
    PERMISSIVE parse stay, whether or not a key could be read."""
    keyed = F.col(key).isNotNull()
    return df.filter(keyed | F.col(ERROR).isNotNull() if ERROR in df.columns else keyed)


def clean_rows(df: DataFrame, key: str) -> DataFrame:
    """The rows a sink may take: without ``_error``, with a key."""
    if ERROR not in df.columns:
        return df
    return df.filter(F.col(ERROR).isNull() & F.col(key).isNotNull()).drop(ERROR, RAW)


def malformed_rows(df: DataFrame) -> DataFrame:
    """The rows with an ``_error``."""
    return df.filter(F.col(ERROR).isNotNull())
