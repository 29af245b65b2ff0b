"""Materialisation into the shared checkpoint folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder, for tables that ``remove`` deletes later."""
    return os.path.join(checkpoint_dir(spark), "commerce_lake", f"{name}-{uuid.uuid4().hex}")


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder in whatever store it is."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str, root: str | None = None) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor recomputes from the files, not
    from the raw JSON), lets several consumers share one computation,
    and gives the planner the exact size of the result for its
    broadcast decision.  The folder is ``spark.checkpoint.dir`` of the
    session (shared storage on a cluster); a local folder is created
    only when that setting is unset.
    """
    path = os.path.join(root, name) if root else new_folder(df.sparkSession, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)
