"""A local session for tests and the bench (a cluster brings its own)."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "chronodim") -> SparkSession:
    """Local mode only: on a cluster the session, and ``spark.checkpoint.dir``
    (a shared folder), come from the cluster's configuration."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # broadcast only what is checked: explicit hints after a count, or AQE's
        # runtime conversion from measured shuffle sizes -- not plan estimates
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "10MB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    if not spark.sparkContext.getCheckpointDir():     # set only where unset
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="chronodim-ckpt-"))
    return spark
