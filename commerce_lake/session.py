"""Spark session helpers.

The library never creates a session behind the caller's back: every
function takes the DataFrames (or the session) it works on.  These
helpers only build a session for tests, benches and scripts, and pin
the settings the data model depends on.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the semantics depend on.  Timestamps are read and rendered in
# UTC (the sink of the change pipeline declares UTC), so date boundaries
# do not move with the host time zone.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Settings for scale: adaptive execution re-plans joins from real map
# output sizes (broadcast only when the measured side is small), merges
# tiny shuffle partitions and splits skewed ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}


def get_session(master: str = "local[*]", shuffle_partitions: int = 8,
                app_name: str = "commerce_lake", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the pinned settings."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
    )
    for k, v in {**REQUIRED_CONF, **SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    pin_session(spark)
    return spark


def pin_session(spark: SparkSession) -> SparkSession:
    """Apply the settings the semantics depend on to an existing session."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    On a cluster ``spark.checkpoint.dir`` names a folder every executor
    can reach; it is used as is.  Only when it is unset and the master
    is local (tests, local runs) a fresh local folder is created and
    registered; on a cluster a local folder would not be shared, so an
    unset one is an error there.
    """
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf:
        spark.sparkContext.setCheckpointDir(conf)
        return conf
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="commerce_lake_ckpt_")
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir() or path
