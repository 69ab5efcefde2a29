"""Keyed last-write-wins upserts.

The reference writes one ``INSERT ... ON CONFLICT (key) DO UPDATE`` per
record in arrival order, so the current-state table holds, per key, the
*whole* row of the latest message - NULLs included (no COALESCE). Here that is
one set operation per batch:

* ``latest_per_key``: ``groupBy(key).agg(max_by(struct(row), struct(arrival)))``.
  ``max_by`` is a declarative aggregate, so Spark runs it partial (map side)
  then final: a key that holds a third of all rows is reduced to one row per
  map task before the shuffle, and the shuffle carries at most
  ``#map tasks x #keys`` rows. No row-number window (that would shuffle every
  row of a hot key to one task), no per-column ``last()`` (that would mix
  columns from different messages).
* ``merge_current``: the existing state and a new batch, the batch winning;
  the same aggregation with the batch flag as the most significant order.

Arrival order is ``(partition, offset)`` (see ``operators.messages.
ARRIVAL_COLUMNS``): offset alone is a total order on a single-partition topic,
and a key lives in one partition if the producer keys its records. Callers
whose broker stamps records on arrival may pass ``BROKER_TIME_ORDER``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .messages import arrival_columns

_ROW = "_row"
_ORDER = "_order"
_BATCH = "_batch"


def latest_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    order: Sequence[str] | None = None,
    keep_order: bool = False,
) -> DataFrame:
    """One row per key: the row with the greatest ``order`` (arrival) value.

    ``order`` defaults to the arrival columns present in ``df``. Rows with a
    NULL key are dropped (they can never be written under a key).
    """
    keys = [key] if isinstance(key, str) else list(key)
    order_cols = list(order) if order is not None else arrival_columns(df)
    if not order_cols:
        raise ValueError("latest_per_key needs arrival-order columns (e.g. partition, offset)")
    payload = [c for c in df.columns if c not in keys and (keep_order or c not in order_cols)]
    keyed = df
    for k in keys:
        keyed = keyed.filter(F.col(k).isNotNull())
    out = keyed.groupBy(*keys).agg(
        F.max_by(F.struct(*payload), F.struct(*order_cols)).alias(_ROW)
    )
    return out.select(*keys, *(F.col(f"{_ROW}.{c}").alias(c) for c in payload))


def merge_current(
    current: DataFrame, batch: DataFrame, key: str | Sequence[str], order: Sequence[str] | None = None
) -> DataFrame:
    """New current state = ``current`` upserted with ``batch`` (batch rows win).

    ``batch`` may hold several rows per key; its arrival columns order them.
    ``current`` has the table columns only. The result has the table columns.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = current.columns
    order_cols = list(order) if order is not None else arrival_columns(batch)
    order_fields = [F.col(c) for c in order_cols] if order_cols else []
    batch_side = batch.select(
        *cols, F.struct(F.lit(1).alias(_BATCH), *(c.alias(n) for c, n in zip(order_fields, order_cols))).alias(_ORDER)
    )
    nulls = [F.lit(None).cast(batch.schema[n].dataType).alias(n) for n in order_cols]
    current_side = current.select(*cols, F.struct(F.lit(0).alias(_BATCH), *nulls).alias(_ORDER))
    both = current_side.unionByName(batch_side)
    return latest_per_key(both, keys, order=[_ORDER]).select(*cols)
