"""End-to-end build: bronze -> silver views -> gold tables.

Materialisation barriers follow the model layer: silver stays lazy
(views); the shared line-item relation is written once and re-read by
both facts, so its JSON parsing runs once instead of once per
consumer; gold tables are written as parquet.  Intermediate tables go
under the cluster's shared checkpoint folder (``spark.checkpoint.dir``),
never a machine-local one, so they survive the loss of an executor.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import register_views
from . import catalog, gold, silver
from .materialize import materialize, new_folder, remove


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register a lazily evaluated model under a name."""
    df.createOrReplaceTempView(name)
    return df


def as_table(df: DataFrame, path: str, sort: list[str] | None = None,
             partition_by: list[str] | None = None, cluster_by: list[str] | None = None) -> DataFrame:
    """Write a model as a parquet table.

    ``sort`` orders rows within each output file (no exchange) instead of
    a global sort.  ``cluster_by`` first range-partitions on the listed
    keys (one exchange; the bounds come from a sample of all keys, so a
    heavy leading value is split on the following keys) and sorts each
    file on them: every file then covers a narrow key range and filters
    on the leading key skip files by their min/max statistics.
    """
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    elif sort:
        df = df.sortWithinPartitions(*sort)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def build(spark: SparkSession, bronze: dict[str, DataFrame], out_root: str, as_of=None,
          unmatched: str = "defaults", deletes: str = "ignore", latest_only: bool = False,
          cluster_fact: bool = False, hot_lines: int = gold.HOT_LINES, database: str | None = None) -> dict[str, DataFrame]:
    """Run every model; returns the gold tables as read back from ``out_root``.

    ``deletes='apply'`` drops deleted customers, products and orders
    (delete events must have reached bronze: the loader drops unwrapped
    ones as soft deletes, so it needs an envelope shape);
    ``latest_only`` takes the newest version of each order.  The
    intermediate tables are removed when the gold tables are written.

    The fact's files are sorted by (order_date, order_id), so a date
    filter skips row groups by their statistics.  ``cluster_fact``
    additionally range-partitions the fact on those keys so it skips
    whole files.  That costs an exchange plus the sampling pass that
    range bounds need, which evaluates the fact's join pipeline once
    more: worth it only for tables read far more often than written.
    Orders with more than ``hot_lines`` lines get their metrics by a join
    (see ``gold.with_order_metrics``).  With ``database`` the gold tables
    are also saved in the catalog (``catalog.publish``) and returned as
    read by name, those with an order date with their month.
    """
    stg = {
        "stg_customers": silver.customers(bronze["customers"], as_of, include_deletes=deletes == "apply"),
        "stg_products": silver.products(bronze["products"], as_of, include_deletes=deletes == "apply"),
        "stg_orders": silver.orders(bronze["orders"], as_of, include_deletes=deletes == "apply"),
    }
    register_views(spark, stg)
    scratch = new_folder(spark, "build")
    lines = materialize(gold.line_items(stg["stg_orders"], latest_only, deletes, numbered=True), "line_items", scratch)
    dim_c = as_table(gold.dim_customers(stg["stg_customers"], as_of, deletes),
                     os.path.join(out_root, "dim_customers"), sort=["customer_id"])
    dim_p = as_table(gold.dim_products(stg["stg_products"], as_of, deletes),
                     os.path.join(out_root, "dim_products"), sort=["product_id"])
    cust, prod = gold.fact_sides(lines, dim_c, dim_p)
    sides = materialize(cust, "customer_side", scratch), materialize(prod, "product_side", scratch)
    hot = materialize(gold.hot_orders(lines, hot_lines), "hot_orders", scratch)
    fact = as_table(gold.fact_orders(lines, dim_c, dim_p, as_of, unmatched, sides=sides, hot=None if hot.isEmpty() else hot),
                    os.path.join(out_root, "fact_orders"), sort=["order_date", "order_id"],
                    cluster_by=["order_date", "order_id"] if cluster_fact else None)
    daily = as_table(gold.daily_sales(lines, as_of), os.path.join(out_root, "fct_daily_sales"),
                     sort=["order_date"])
    remove(spark, scratch)
    out = {"dim_customers": dim_c, "dim_products": dim_p, "fact_orders": fact, "fct_daily_sales": daily}
    if database:
        out = catalog.publish(spark, out, database)
    register_views(spark, out)
    return out
