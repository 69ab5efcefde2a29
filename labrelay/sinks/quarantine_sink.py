"""Quarantine of malformed messages as parquet: ``<path>/run=<run>/batch_id=<n>/``,
written with overwrite, so that a replayed micro-batch replaces its own rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class QuarantineSink:
    path: str

    def write(self, rows: DataFrame, batch_id: int, run_id: str = "batch") -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/run={run_id}/batch_id={batch_id}")

    def read(self, spark: SparkSession) -> DataFrame:
        """All quarantined rows, with run and batch_id; for ``quarantined_messages``."""
        return spark.read.parquet(self.path)
