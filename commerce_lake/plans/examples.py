"""The two starter models (M9, U1, A12, D-9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def numbers(spark: SparkSession) -> DataFrame:
    """``select 1 as id union all select null as id`` (literal rows, U1, A12)."""
    one = spark.range(1).select(F.lit(1).alias("id"))
    null = spark.range(1).select(F.lit(None).cast("int").alias("id"))
    return one.unionAll(null)


def ones(first: DataFrame) -> DataFrame:
    """Rows of the first model with ``id = 1`` (D-9)."""
    return first.where(F.col("id") == 1)
