"""Named table sources.

A source is a parquet folder or a catalog table; callers get a lazy
DataFrame, so column pruning and filters reach the scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..session import pin_session

# The given relational test tables.
GIVEN_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                "events", "documents", "embeddings", "pages", "benchmark", "labels",
                "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables, e.g. ``read_table(spark, dir, 'orders')``."""
    pin_session(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def load(spark: SparkSession, name: str, root: str | None = None,
         merge_schema: bool = False) -> DataFrame:
    """A named source: ``root/name`` as parquet when a root is given, else a catalog table.

    ``merge_schema=True`` reads files written with evolving column sets
    (B8) as one schema.
    """
    pin_session(spark)
    if root is None:
        return spark.table(name)
    reader = spark.read
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.parquet(os.path.join(root, name))


def register_views(spark: SparkSession, frames: dict[str, DataFrame]) -> None:
    """Expose DataFrames to SQL by name (B11 views)."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
