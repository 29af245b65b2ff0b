"""Silver: bronze JSON -> typed change events, one row per event (M1-M3).

Each model normalises the event shape, parses the after-image once
with an all-text schema, converts the fields leniently and drops events
without a usable id or critical field.  Silver is not de-duplicated;
the gold dimensions pick the latest version.  Everything is row-local
(no shuffle, no sort), so the same functions run on streaming frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import scalars as X
from ..operators import changes as C


def _parsed(bronze: DataFrame, doc_schema, include_deletes: bool) -> DataFrame:
    n = C.normalize_change(bronze, doc_schema=doc_schema).withColumnRenamed("_doc", "_d")
    live_id = X.text_or_empty(F.col("_d")["_id"]["$oid"])
    keep = F.col("_d").isNotNull() & (live_id != "")
    if include_deletes:
        # envelope deletes carry no after-image: the id comes from the key
        n = n.withColumn("_id_text", F.when(F.col("_op") == "d", F.coalesce(F.col("_key_id"), live_id))
                         .otherwise(live_id))
        keep = keep | ((F.col("_op") == "d") & (X.text_or_empty(F.col("_id_text")) != ""))
    else:
        n = n.withColumn("_id_text", live_id)
    return n.where(keep)


def _meta(as_of) -> list[Column]:
    return [F.col("_op").alias("_operation"), F.col("_ts_ms").alias("_event_timestamp_ms"),
            X.as_timestamp(as_of).alias("_extracted_at")]


def _tiebreak(df: DataFrame) -> list[Column]:
    return [(F.col(c) if c in df.columns else F.lit(None).cast("bigint")).cast("bigint").alias(c)
            for c in S.TIEBREAK]


def _require(df: DataFrame, *cols: str, unless: Column | None = None) -> DataFrame:
    """Missing-critical-field filter: IS NOT NULL AND != '' (D-4)."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull() & (F.col(c) != "")
    if unless is not None:
        cond = cond | unless
    return df.where(cond)


def customers(bronze: DataFrame, as_of=None, include_deletes: bool = False,
              strict: bool = False, tiebreak: bool = True) -> DataFrame:
    """stg_customers (M1)."""
    p = _parsed(bronze, S.CUSTOMER_DOC, include_deletes)
    d = F.col("_d")
    out = p.select(
        F.col("_id_text").alias("customer_id"),
        X.text_or_empty(d["first_name"]).alias("first_name"),
        X.text_or_empty(d["last_name"]).alias("last_name"),
        X.text_or_empty(d["email"]).alias("email"),
        X.parse_ts(d["registration_date"], strict).alias("registered_at"),
        *_meta(as_of), *(_tiebreak(p) if tiebreak else []))
    return _require(out, "customer_id", "email",
                    unless=(F.col("_operation") == "d") if include_deletes else None)


def products(bronze: DataFrame, as_of=None, include_deletes: bool = False,
             tiebreak: bool = True) -> DataFrame:
    """stg_products (M2)."""
    p = _parsed(bronze, S.PRODUCT_DOC, include_deletes)
    d = F.col("_d")
    out = p.select(
        F.col("_id_text").alias("product_id"),
        X.text_or_empty(d["name"]).alias("product_name"),
        X.double_or_zero(d["price"]).alias("price"),
        X.int_or_zero(d["stock_quantity"]).alias("stock_quantity"),
        *_meta(as_of), *(_tiebreak(p) if tiebreak else []))
    return _require(out, "product_id", "product_name",
                    unless=(F.col("_operation") == "d") if include_deletes else None)


def orders(bronze: DataFrame, as_of=None, keep_raw: bool = False, include_deletes: bool = False,
           strict: bool = False, tiebreak: bool = True) -> DataFrame:
    """stg_orders (M3); ``line_items`` stays JSON text ('' when absent)."""
    p = _parsed(bronze, S.ORDER_DOC, include_deletes)
    d = F.col("_d")
    cols = [
        F.col("_id_text").alias("order_id"),
        X.text_or_empty(d["customer_id"]["$oid"]).alias("customer_id"),
        X.parse_ts(d["order_date"], strict).alias("ordered_at"),
        X.text_or_empty(d["status"]).alias("order_status"),
        X.text_or_empty(d["line_items"]).alias("line_items"),
        *_meta(as_of),
    ]
    if keep_raw:
        cols.append(F.col("raw_data").alias("_raw_data"))
    out = p.select(*cols, *(_tiebreak(p) if tiebreak else []))
    return _require(out, "order_id", "customer_id",
                    unless=(F.col("_operation") == "d") if include_deletes else None)


def date_rejects(bronze: DataFrame, entity: str) -> DataFrame:
    """Events whose date text cannot be parsed (D12): raw row plus reason.

    The models keep such events with a NULL date; this is the matching
    reject table, so nothing is lost silently.
    """
    field = {"customers": "registration_date", "orders": "order_date"}[entity]
    schema = S.CUSTOMER_DOC if entity == "customers" else S.ORDER_DOC
    p = _parsed(bronze, schema, False)
    return p.where(X.ts_unparseable(F.col("_d")[field])).select(
        "raw_data", F.col("_d")[field].alias("value"), F.lit(f"unparseable {field}").alias("reason"))


def all_models(bronze: dict[str, DataFrame], as_of=None) -> dict[str, DataFrame]:
    return {"stg_customers": customers(bronze["customers"], as_of),
            "stg_products": products(bronze["products"], as_of),
            "stg_orders": orders(bronze["orders"], as_of)}
