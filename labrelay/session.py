"""Session helper for tests, the bench and local runs.

On a cluster the session comes from the platform; nothing here overrides a
setting that is already present (checkpoint dir, shuffle partitions, ...).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

#: Names a checkpoint folder that this module chose itself.
MADE_UP = "labrelay.checkpoint.made_up"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, scratch: str | None = None) -> SparkSession:
    """Local session with the UI off, AQE on and a scratch checkpoint dir.

    ``scratch`` is used only when ``spark.checkpoint.dir`` is unset (tests).
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("labrelay")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("LABRELAY_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, scratch)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, scratch: str | None = None) -> str:
    """Return ``spark.checkpoint.dir``; set a scratch one only when it is unset."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    path = scratch or tempfile.mkdtemp(prefix="labrelay-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.conf.set(MADE_UP, path)  # pipelines refuse it unless it is passed to them
    spark.sparkContext.setCheckpointDir(path)
    return path
