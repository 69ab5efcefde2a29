"""Messages rendered from large tables are spread over the cluster's tasks, whatever the files look like."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from labrelay.sources.messages import read_messages

ROWS = 4000


@pytest.fixture()
def tables(spark, scratch_dir):
    """Tables of one row group each, whose scan has more splits than the session has cores."""
    ids, sent = spark.range(ROWS, numPartitions=1), F.lit(datetime(2024, 3, 5))
    ids.select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 2).alias("o_custkey"), sent.cast("timestamp_ntz").alias("o_orderdate"),
        F.lit("O").alias("o_orderstatus"), F.sha2(F.col("id").cast("string"), 256).alias("o_orderpriority"),
    ).write.parquet(f"{scratch_dir}/orders.parquet")
    ids.limit(2).select(F.col("id").alias("c_custkey"), F.col("id").alias("c_nationkey")).write.parquet(f"{scratch_dir}/customer.parquet")
    ids.select(
        F.col("id").alias("event_id"), F.col("id").alias("user_id"), sent.cast("timestamp_ntz").alias("ts"),
        F.sha2(F.col("id").cast("string"), 256).alias("event_type"),
    ).write.parquet(f"{scratch_dir}/events.parquet")
    changed = {"spark.sql.files.maxPartitionBytes": "16k", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield scratch_dir
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
@pytest.mark.parametrize("kind", ["order", "ack"])
def test_rendered_messages_are_spread(spark, tables, kind, broadcast):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        raw = read_messages(spark, kind, fmt="fixture", path=tables)
        sizes = [r["count"] for r in raw.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum(sizes) == ROWS
    assert max(sizes) < 2 * ROWS / spark.sparkContext.defaultParallelism
