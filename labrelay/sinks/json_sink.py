"""JSON extract sinks.

The reference writes one JSON value per record to a topic, value only, at
least once. Two sinks with the same ``write(df, batch_id)`` interface:

* ``KafkaJsonSink`` - ``value`` column to a topic (needs the Kafka connector).
  At-least-once, as in the reference: a replayed micro-batch is sent again.
* ``JsonFileSink`` - text files under ``<path>/run=<run>/batch_id=<n>/``, written
  with overwrite, so a replayed micro-batch replaces its own output: effectively
  once. A run is the life of one checkpoint; a new one counts batches from 0
  again, in a folder of its own. Reading ``<path>`` gives all values plus the
  columns ``run`` and ``batch_id``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass
class JsonFileSink:
    path: str

    def write(self, values: DataFrame, batch_id: int, run_id: str = "batch") -> None:
        values.select("value").write.mode("overwrite").text(f"{self.path}/run={run_id}/batch_id={batch_id}")


@dataclass
class KafkaJsonSink:
    topic: str
    options: dict[str, str] = field(default_factory=dict)

    def write(self, values: DataFrame, batch_id: int, run_id: str = "batch") -> None:
        (
            values.select("value")
            .write.format("kafka")
            .options(**self.options)
            .option("topic", self.topic)
            .save()
        )
