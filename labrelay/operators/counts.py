"""Counts of a batch taken while it is parsed: Spark's observed
metrics, so no pass or job of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class BatchCounts:
    """Counts of one parse, for ``plans.batch.shred``; ``get`` waits for the first action
    on the parsed frame, which must read all of it (a filter above it may, a limit not).

    ``read``: messages of the source; ``empty`` and ``blank`` of them are skipped;
    ``malformed``: have an error; ``keyless``: sound, without a key; ``records``: what is left.
    """

    def __init__(self):
        self._seen: list[Observation] = []

    def observe(self, df: DataFrame, **metrics: Column) -> DataFrame:
        observation = Observation()
        self._seen.append(observation)
        return df.observe(observation, *(c.alias(name) for name, c in metrics.items()))

    def get(self) -> dict[str, int]:
        return {name: n for o in self._seen for name, n in o.get.items()}


def observed(df: DataFrame, counts: BatchCounts | None, **metrics: Column) -> DataFrame:
    """``df``, its rows counted where ``counts`` is given."""
    return df if counts is None else counts.observe(df, **metrics)


def all_rows() -> Column:
    return F.count(F.lit(1))
