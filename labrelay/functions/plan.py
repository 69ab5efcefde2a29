"""Plan-shape helpers.

``fence(col)`` returns ``col`` unchanged but makes it non-deterministic for
the optimizer (it reads ``spark_partition_id()``, which is always >= 0).
Catalyst never pushes a filter through a projection that holds a
non-deterministic column, so a filter on a fenced column is evaluated on the
projection's *output* instead of being rewritten into a copy of the
projection's whole expression tree below it.

Used where that rewrite would duplicate heavy per-row work: the decoded
message text (filters on it would otherwise re-decode, or re-render a test
message), and the record key (filters on it would otherwise re-run the whole
parse and outgrow the JVM's 64 KB method limit in generated code).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fence(col: Column) -> Column:
    return F.when(F.spark_partition_id() >= 0, col)


def unfused(col: Column) -> Column:
    """``col`` fenced, in a projection of its own small generated methods. A fused stage is
    one method, and the JVM never compiles one above 8,000 bytes of bytecode: it would be
    interpreted for every row. The lambda, over one number, is what Spark doesn't fuse."""
    return F.when(F.exists(F.array(F.spark_partition_id()), lambda p: p >= 0), col)


def fenced_select(df: DataFrame, *cols: str) -> DataFrame:
    """``df.select(cols)`` with every column fenced.

    Filters the optimizer infers later (``size(array) > 0`` under an
    ``explode``, ``isnotnull`` under joins) and filters users add on any
    output column stay above this projection; column pruning still drops
    outputs nobody reads.
    """
    return df.select(*(fence(F.col(c)).alias(c) for c in cols))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` hash-spread by ``keys`` over ``spark.sql.shuffle.partitions``, or the cluster's
    cores if those are more. The number is explicit, so adaptive execution doesn't merge
    small partitions whose rows are costly to process."""
    spark = df.sparkSession
    setting, cores = str(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
    return df.repartition(max(int(setting), cores) if setting.isdigit() else cores, *keys)
