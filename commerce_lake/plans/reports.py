"""Analyst reports over silver and gold (R1-R8, S1-S6, D-10).

Sorted outputs use explicit NULL placement (the reference engine puts
NULLs last in both directions).  Top-k reports carry unique
tie-breakers so the same k rows come back on every run; Spark plans
``orderBy().limit(k)`` as a per-task top-k plus a final merge, so no
task holds more than k rows per partition.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..streaming.ingest import table_stats  # noqa: F401  (R8 lives with the loader)


def sample_raw(bronze: DataFrame, n: int = 1) -> DataFrame:
    """A few raw events (R1); the limit is the feature."""
    return bronze.select("raw_data").limit(n)


def sample_orders(stg_orders: DataFrame, n: int = 10) -> DataFrame:
    """A few cleaned orders (R2)."""
    return stg_orders.select("order_id", "customer_id", "ordered_at", "order_status").limit(n)


def segments(dim_customers: DataFrame) -> DataFrame:
    """Customers and average age per segment, largest first."""
    return (dim_customers.groupBy("customer_segment")
            .agg(F.count(F.lit(1)).alias("customer_count"),
                 F.avg("days_since_registration").alias("avg_days_registered"))
            .orderBy(F.col("customer_count").desc_nulls_last()))


def price_inventory(dim_products: DataFrame) -> DataFrame:
    """Products and average price per price category x inventory status."""
    return (dim_products.groupBy("price_category", "inventory_status")
            .agg(F.count(F.lit(1)).alias("product_count"), F.avg("price").alias("avg_price"))
            .orderBy(F.col("price_category").asc_nulls_last(), F.col("inventory_status").asc_nulls_last()))


def _as_date(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, _dt.date) and not isinstance(as_of, _dt.datetime):
        return F.lit(as_of)
    return F.to_date(X.as_timestamp(as_of))


def first_day(as_of=None, days: int = 7) -> Column:
    """The earliest day that is not more than ``days`` days before ``as_of``."""
    return F.date_sub(_as_date(as_of), days)


def since_days(df: DataFrame, col: str, as_of=None, days: int = 7) -> DataFrame:
    """Rows dated within the last ``days`` days of ``as_of`` (D-10)."""
    return df.where(F.col(col) >= first_day(as_of, days))


TOP_ORDER_COLUMNS = ["order_date", "customer_name", "customer_segment", "product_name", "price_category",
                     "quantity", "unit_price", "line_total", "order_total_value", "customer_lifetime_value"]


def top_orders(fact: DataFrame, as_of=None, days: int = 7, k: int = 20) -> DataFrame:
    """The k most valuable recent order lines."""
    recent = since_days(fact, "order_date", as_of, days)
    return (recent.orderBy(F.col("order_total_value").desc_nulls_last(), F.col("order_id").asc_nulls_last(),
                           F.col("product_id").asc_nulls_last(), F.col("quantity").desc_nulls_last(),
                           F.col("unit_price").desc_nulls_last())
            .limit(k).select(*TOP_ORDER_COLUMNS))


def recent_days(daily: DataFrame, k: int = 7) -> DataFrame:
    """The latest k days of sales."""
    return (daily.orderBy(F.col("order_date").desc_nulls_last()).limit(k)
            .select("order_date", "total_revenue", "total_orders_placed", "total_unique_customers",
                    "avg_order_value"))


def freshness(stg: DataFrame) -> DataFrame:
    """Event count and newest event time of a silver model."""
    return stg.agg(F.count(F.lit(1)).alias("event_count"),
                   F.max("_event_timestamp_ms").alias("max_event_timestamp_ms"))


def sort_desc(df: DataFrame, col: str) -> DataFrame:
    """Order by one key descending, NULLs last."""
    return df.orderBy(F.col(col).desc_nulls_last())


def sort_asc(df: DataFrame, col: str) -> DataFrame:
    """Order by one key ascending, NULLs last."""
    return df.orderBy(F.col(col).asc_nulls_last())


def top_k(df: DataFrame, order: list[Column], k: int, where: Column | None = None) -> DataFrame:
    """Filter, order, keep k."""
    if where is not None:
        df = df.where(where)
    return df.orderBy(*order).limit(k)
