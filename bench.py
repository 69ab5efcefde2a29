"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Two groups, each query run once to warm up and then timed, results written to
Spark's ``noop`` sink (full evaluation, nothing collected on the driver):

* ``q_<name>``  - registered queries (render messages from the tables, parse,
  JSON / upsert) exactly as the correctness gate runs them;
* ``stream_<kind>`` - the streaming pipeline end to end on that message
  table: file stream (``availableNow``) -> parse -> foreachBatch {JSON file
  sink, dedupe + snapshot table}, checkpointed (one run, cold checkpoint);
* ``parse_<kind>_json`` / ``parse_<kind>_upsert`` - the production shape:
  messages already stored as a parquet message table (rendered once, before
  timing, into a fresh folder under the session's shared ``spark.checkpoint.dir``),
  then decode -> shred -> key filter -> JSON extract, or -> dedupe per key for
  the current-state table.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from labrelay import json_values, parse_messages  # noqa: E402
from labrelay.plans.batch import current_rows  # noqa: E402
from labrelay.plans.catalog import QUERIES  # noqa: E402
from labrelay.plans.kinds import get_kind  # noqa: E402
from labrelay.session import ensure_checkpoint_dir, local_session  # noqa: E402
from labrelay.sinks.json_sink import JsonFileSink  # noqa: E402
from labrelay.sinks.table_sink import SnapshotTable  # noqa: E402
from labrelay.sources.messages import RAW_SCHEMA, fixture_messages, read_messages  # noqa: E402
from labrelay.streaming.pipeline import PipelineSpec, start_pipeline  # noqa: E402

HEADLINE = [
    "order_json",
    "ack_json",
    "result_json",
    "order_records",
    "result_records",
    "test_results",
    "upsert_orders",
    "upsert_acks",
    "upsert_results",
    "upsert_two_batches",
    "malformed_report",
]


def timed(df) -> float:
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8)
    scratch = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bench-{uuid.uuid4().hex}"

    times: dict[str, float] = {}
    for name in HEADLINE:
        q = QUERIES[name]
        timed(q(spark, sf_dir))
        times[f"q_{name}"] = round(timed(q(spark, sf_dir)), 3)

    for kind in ("order", "ack", "result"):
        path = f"{scratch}/{kind}_messages"
        fixture_messages(spark, sf_dir, kind).write.mode("overwrite").parquet(path)
        k = get_kind(kind)

        def json_q():
            raw = read_messages(spark, kind, fmt="parquet", path=path)
            return json_values(parse_messages(raw, k), k)

        def upsert_q():
            raw = read_messages(spark, kind, fmt="parquet", path=path)
            return current_rows(parse_messages(raw, k), k)

        for label, build in (("json", json_q), ("upsert", upsert_q)):
            timed(build())
            times[f"parse_{kind}_{label}"] = round(timed(build()), 3)

        spec = PipelineSpec(kind, source_fmt="parquet", source_path=path, source_options={"schema": RAW_SCHEMA},
                            json_sink=JsonFileSink(f"{scratch}/{kind}_json"),
                            table_sink=SnapshotTable(f"{scratch}/{kind}_table", kind))
        t0 = time.perf_counter()
        q = start_pipeline(spark, spec, checkpoint_location=f"{scratch}/ckpt", trigger={"availableNow": True},
                           query_name=f"bench-{kind}")
        q.awaitTermination()
        times[f"stream_{kind}"] = round(time.perf_counter() - t0, 3)

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))


if __name__ == "__main__":
    main()
