"""Gold tables in the catalog: named, partitioned by month, with comments.

``publish`` saves the gold tables under their names in a database, so
any session of the cluster reads them by name.  The order-line fact and
the daily totals are partitioned by the month of the order date; reports
that filter on days also filter on the month (``recent``), so only the
partitions of the last days are listed and read.  Rows are sorted within
their files, and each month's rows are first brought together
(``rebalance``: adaptive execution splits a large month over tasks and
merges small ones), so a month is a few files of good size.  A table
that holds its month column comes from a plan that has brought its rows
together (``fact_by``): it is written as it comes, without that exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import reports

#: Partition column of tables with an order date: the first day of its month.
MONTH = "order_month"

#: What the tables and their columns hold.
TABLE_COMMENTS = {
    "dim_customers": "Newest version of each customer",
    "dim_products": "Newest version of each product",
    "fact_orders": "Order lines with customer, product and their totals",
    "fct_daily_sales": "Sales of each order day",
}
COLUMN_COMMENTS = {
    "customer_id": "Key of the customer",
    "product_id": "Key of the product",
    "order_id": "Key of the order",
    "full_name": "First and last name",
    "email": "Mail address of the customer",
    "registered_at": "When the customer registered, UTC",
    "customer_segment": "Bucket of the time since registration",
    "days_since_registration": "Whole days from registration to the run",
    "product_name": "Name of the product",
    "price": "Price of the newest version",
    "price_rounded": "Price to two places",
    "price_category": "Bucket of the price",
    "stock_quantity": "Pieces in stock",
    "inventory_status": "Bucket of the stock",
    "is_out_of_stock": "Whether nothing is in stock",
    "ordered_at": "When the order was placed, UTC",
    "order_date": "Day of the order, UTC",
    "order_status": "pending, shipped or delivered",
    "quantity": "Pieces on the line, above 0",
    "unit_price": "Price of a piece on the line, above 0",
    "line_total": "Quantity by unit price",
    "customer_name": "Full name of the customer",
    "current_product_price": "Price of the product's newest version",
    "price_difference": "Unit price less current price",
    "has_price_variance": "Whether the two prices differ",
    "order_total_value": "Sum over the lines of the order",
    "items_in_order": "Lines of the order",
    "avg_item_price_in_order": "Mean unit price of the order's lines",
    "customer_lifetime_orders": "Distinct orders of the customer",
    "customer_lifetime_value": "Sum over all lines of the customer",
    "product_total_quantity_sold": "Pieces of the product over all lines",
    "product_total_revenue": "Sum over all lines of the product",
    "total_revenue": "Sum over the day's orders",
    "total_orders_placed": "Distinct orders of the day",
    "total_unique_customers": "Distinct customers of the day",
    "avg_order_value": "Mean total of the day's orders",
    "total_line_items": "Lines of the day's orders",
    "_operation": "Kind of the change event: r, c, u or d",
    "_event_timestamp_ms": "Time of the change event in milliseconds",
    "_extracted_at": "When the event was parsed",
    "_processed_at": "When the row was built",
    "_calculated_at": "When the totals were built",
    "raw_data": "The change event as it arrived",
    "_kafka_timestamp": "Second in which the loader took the event",
    "_kafka_offset": "Offset of the event in its topic partition",
    "_kafka_partition": "Topic partition of the event",
    "ingest_date": "Day on which the loader took the event, UTC",
    MONTH: "First day of the order date's month",
}


def save_table(df: DataFrame, name: str, partition_by: dict[str, Column] | None = None, sort: list[str] | None = None,
               comment: str | None = None, comments: dict[str, str] | None = None, together: bool = False) -> DataFrame:
    """Save a model as a catalog table and read it by name.

    ``partition_by`` adds columns (name -> expression) by which the table
    is partitioned; ``comments`` describe columns.  A table of that name
    is replaced; frames that were read from it before must be read anew.
    ``together``: the rows of a partition lie together already.
    """
    spark = df.sparkSession
    parts = dict(partition_by or {})
    known = COLUMN_COMMENTS if comments is None else comments
    columns = [F.col(f"`{c}`") for c in df.columns if c not in parts]
    out = df.select(*columns, *(e.alias(c) for c, e in parts.items()))
    if parts and not together:
        out = out.hint("rebalance", *(F.col(c) for c in parts))
    if parts or sort:
        out = out.sortWithinPartitions(*parts, *(sort or []))
    out = out.select(*(F.col(f"`{c}`").alias(c, metadata={"comment": known[c]} if c in known else {}) for c in out.columns))
    w = out.write.format("parquet").mode("overwrite").option("compression", "zstd")
    if parts:
        w = w.partitionBy(*parts)
    w.saveAsTable(name)
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS '{comment.replace(chr(39), chr(92) + chr(39))}'")
    return spark.table(name)


def month_of(day: str | Column) -> Column:
    return F.trunc(F.col(day) if isinstance(day, str) else day, "month")


def fact_by() -> dict[str, Column]:
    """Keys by which ``gold.fact_orders`` brings the rows of the fact together and sorts them for its table."""
    return {MONTH: month_of("order_date"), "order_date": F.col("order_date"), "order_id": F.col("order_id")}


def _database(spark: SparkSession, name: str, location: str | None) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}" + (f" LOCATION '{location}'" if location else ""))


def publish(spark: SparkSession, gold: dict[str, DataFrame], database: str, location: str | None = None) -> dict[str, DataFrame]:
    """Save the gold tables in a database of the catalog (B12); a new one is made at ``location``, else in the warehouse."""
    _database(spark, database, location)
    month = {MONTH: month_of("order_date")}
    layout = {
        "dim_customers": (None, ["customer_id"]),
        "dim_products": (None, ["product_id"]),
        "fact_orders": (month, ["order_date", "order_id"]),
        "fct_daily_sales": (month, ["order_date"]),
    }

    def save(name: str, df: DataFrame) -> DataFrame:
        parts, sort = layout.get(name, (None, None))
        together = bool(parts) and MONTH in df.columns
        return save_table(df, f"{database}.{name}", {MONTH: F.col(MONTH)} if together else parts, sort, comment=TABLE_COMMENTS.get(name), together=together)

    return {name: save(name, df) for name, df in gold.items()}


def publish_bronze(spark: SparkSession, bronze: dict[str, DataFrame], database: str, location: str | None = None) -> dict[str, DataFrame]:
    """Save bronze tables, partitioned by the day the loader took each event."""
    _database(spark, database, location)
    day = {"ingest_date": F.to_date("_kafka_timestamp")}
    return {name: save_table(df, f"{database}.{name}", day, ["_kafka_partition", "_kafka_offset"]) for name, df in bronze.items()}


def recent(table: DataFrame, as_of=None, days: int = 7, day: str = "order_date") -> DataFrame:
    """The last days of a table partitioned by month (D-10); only their months are read."""
    rows = reports.since_days(table, day, as_of, days)
    if MONTH not in table.columns:
        return rows
    return rows.where(F.col(MONTH) >= month_of(reports.first_day(as_of, days))).drop(MONTH)
