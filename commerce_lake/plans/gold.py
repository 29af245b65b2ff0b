"""Gold: dimensions, the enriched order-line fact and daily sales (M4-M8).

Shuffle budget, by design:

* dimensions: one keyed exchange each (latest version per key, with a
  map-side top-1 so hot keys shrink before the exchange);
* line items: row-local explode + parse, no exchange;
* fact: per-customer and per-product metrics are partial aggregates
  joined back on their key instead of whole-partition windows, so a hot
  customer or product is pre-reduced map-side.  What an order's lines
  have in common (``order_versions``) is kept once for each version of
  the order: it gets its order metrics (windows over the few versions;
  orders with very many lines are joined with theirs, ``hot_orders``)
  and its customer there.  The lines go through two exchanges, by
  product with their own few columns and then by order, where they meet
  their version; a sorted or partitioned fact takes the second one by
  range of its sort key, so that none is added for the sort.
  Each dimension is joined to its metric table first (both one row per key).  The caller may write these two keyed
  side tables once (``fact_sides``, as ``pipeline.build`` does): every
  join-back then reads a shuffle on both sides, which adaptive execution
  splits when one key holds a large share of the lines (it cannot split
  a join fed directly by an aggregate), and the broadcast decision sees
  the written size;
* daily sales: two aggregations with partial (map-side) combine.

Joins carry no hints: Spark broadcasts a side only when its measured
size is under ``spark.sql.autoBroadcastJoinThreshold`` (adaptive
execution re-checks with real sizes) and falls back to a sort-merge
join otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import scalars as X
from ..operators import changes as C


def _latest(stg: DataFrame, key: str, deletes: str) -> DataFrame:
    if deletes not in ("ignore", "apply"):
        raise ValueError("deletes must be 'ignore' or 'apply'")
    ops = S.LIVE_OPS + (("d",) if deletes == "apply" else ())
    latest = C.latest_per_key(C.keep_ops(stg, ops), [key])
    if deletes == "apply":
        latest = latest.where(F.col("_operation") != "d")
    return latest


def dim_customers(stg_customers: DataFrame, as_of=None, deletes: str = "ignore",
                  ordered: bool = False) -> DataFrame:
    """Latest live version per customer with segment and age (M4).

    ``deletes='apply'`` drops customers whose newest event is a delete
    (silver must then keep delete events: ``include_deletes=True``).
    """
    now = X.as_timestamp(as_of)
    d = _latest(stg_customers, "customer_id", deletes)
    out = d.select(
        "customer_id", "first_name", "last_name",
        X.full_name("first_name", "last_name").alias("full_name"),
        "email", "registered_at",
        X.customer_segment("registered_at", now).alias("customer_segment"),
        X.days_between("registered_at", now).alias("days_since_registration"),
        "_event_timestamp_ms", "_extracted_at", now.alias("_processed_at"))
    # the id splits days with many registrations, and rows without one, over range partitions
    return out.orderBy(F.col("registered_at").desc_nulls_last(), F.col("customer_id").asc_nulls_last()) if ordered else out


def dim_products(stg_products: DataFrame, as_of=None, deletes: str = "ignore",
                 ordered: bool = False) -> DataFrame:
    """Latest live version per product with price and stock buckets (M5)."""
    now = X.as_timestamp(as_of)
    d = _latest(stg_products, "product_id", deletes)
    out = d.select(
        "product_id", "product_name", "price",
        X.round_money("price").alias("price_rounded"),
        X.price_category("price").alias("price_category"),
        "stock_quantity",
        X.inventory_status("stock_quantity").alias("inventory_status"),
        X.is_out_of_stock("stock_quantity").alias("is_out_of_stock"),
        "_event_timestamp_ms", "_extracted_at", now.alias("_processed_at"))
    return out.orderBy(F.col("product_name").asc_nulls_last(), F.col("product_id").asc_nulls_last()) if ordered else out


def has_lines(col: str = "line_items") -> Column:
    """Non-empty JSON array (D-6): NULL, '', 'null', '[]', objects and junk all fail."""
    return F.coalesce(X.json_length(F.col(col)) > 0, F.lit(False))


_LINE_ARRAY = T.ArrayType(S.LINE_ITEM_DOC)


def parse_lines(col: str = "line_items") -> Column:
    """Line-item JSON array -> array of (product_id, quantity, price) structs, leaves as text.

    One typed parse per order; only arrays holding a non-object element
    (which make the typed parse fail) fall back to parsing element by
    element, so valid elements next to junk are kept.  Text that is not
    an array gives NULL, and exploding NULL or [] yields no row, which
    is exactly the non-empty-array guard (D-6).
    """
    text = F.col(col)
    per_element = F.transform(X.json_array(text), lambda e: F.from_json(e, S.LINE_ITEM_DOC))
    return F.when(F.ltrim(text).startswith("["),
                  F.coalesce(F.from_json(text, _LINE_ARRAY), per_element))


def line_items(stg_orders: DataFrame, latest_only: bool = False, deletes: str = "ignore", numbered: bool = False) -> DataFrame:
    """One row per valid order line (M6, F4, F8, F11, D-7).

    Orders with a known status are exploded (empty or non-array line
    lists give no row); lines need a quantity and a price that convert
    to positive numbers (missing text converts to 0).  By default every
    order version contributes its lines, as in the reference (D5);
    ``latest_only=True`` keeps the newest version per order first.
    ``deletes='apply'`` leaves out every line of an order whose newest
    event is a delete (silver must then keep delete events).
    ``numbered`` adds ``_version``, a number that the lines of one order
    version have for themselves, for lines that are written once: it
    comes out otherwise when they are computed again.
    """
    o = stg_orders
    if deletes not in ("ignore", "apply"):
        raise ValueError("deletes must be 'ignore' or 'apply'")
    if latest_only:
        o = _latest(o, "order_id", deletes)
    elif deletes == "apply":
        # one exchange of the events by order; a self-join would parse all of them twice
        newest = F.first("_operation").over(Window.partitionBy("order_id").orderBy(*C.newest_first(o)))
        o = o.withColumn("_newest", F.when(F.col("order_id").isNotNull(), newest))
        o = C.keep_ops(o.where(F.coalesce(F.col("_newest") != "d", F.lit(True))).drop("_newest"))
    o = C.keep_values(o, "order_status", S.ORDER_STATUSES)
    number = ["_version"] if numbered else []
    if numbered:
        o = o.withColumn("_version", F.monotonically_increasing_id())
    # explode the parse expression itself (not a column) so no inferred
    # size filter re-parses the text below the generator
    ex = o.select(
        "order_id", "customer_id", "ordered_at", X.to_day("ordered_at").alias("order_date"),
        "order_status", "_operation", "_event_timestamp_ms", "_extracted_at", *number,
        F.explode(parse_lines()).alias("_li"))
    li = F.col("_li")
    q = X.double_or_zero(li["quantity"])
    u = X.double_or_zero(li["price"])
    out = ex.select(
        "order_id", "customer_id",
        X.text_or_empty(li["product_id"]["$oid"]).alias("product_id"),
        "ordered_at", "order_date", "order_status",
        q.alias("quantity"), u.alias("unit_price"), (q * u).alias("line_total"),
        "_operation", "_event_timestamp_ms", "_extracted_at", *number)
    return out.where((F.col("quantity") > 0) & (F.col("unit_price") > 0))


# --- fact metrics (W2-W8) ---------------------------------------------------------

def order_metrics(lines: DataFrame) -> DataFrame:
    """Per order: total, line count, average unit price."""
    return lines.groupBy("order_id").agg(
        F.sum("line_total").alias("order_total_value"),
        F.count(F.lit(1)).alias("items_in_order"),
        F.avg("unit_price").alias("avg_item_price_in_order"))


def customer_metrics(lines: DataFrame) -> DataFrame:
    """Per customer: distinct orders and lifetime value.

    Spark has no DISTINCT window aggregate; a grouped distinct count is
    the same number, computed with partial aggregation on
    (customer, order) so one very large customer is spread over tasks.
    """
    return lines.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("customer_lifetime_orders"),
        F.sum("line_total").alias("customer_lifetime_value"))


def product_metrics(lines: DataFrame) -> DataFrame:
    """Per product: quantity sold and revenue."""
    return lines.groupBy("product_id").agg(
        F.sum("quantity").alias("product_total_quantity_sold"),
        F.sum("line_total").alias("product_total_revenue"))


#: Lines of one order beyond which its window would hold up a task.
HOT_LINES = 1_000_000


def hot_orders(lines: DataFrame, most: int = HOT_LINES) -> DataFrame:
    """Metrics of the orders with more than ``most`` lines; one light aggregation over the lines.

    The caller writes the result, which is at most one row in ``most``
    lines, and passes it to ``with_order_metrics``.
    """
    return order_metrics(lines).where(F.col("items_in_order") > most)


def with_order_metrics(lines: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Lines, or versions of orders with the sums of their lines, with the metrics of their order.

    As windows over the order's rows: one exchange, no side table.  A
    window brings an order's rows into one task, so the orders of
    ``hot`` (see ``hot_orders``) take another way: their rows meet their
    metrics in a join, which adaptive execution broadcasts or splits by
    size, and never a window.
    """
    w = Window.partitionBy("order_id")
    metrics = ["order_total_value", "items_in_order", "avg_item_price_in_order"]

    def windowed(rows: DataFrame) -> DataFrame:
        if set(VERSION_SUMS) <= set(rows.columns):
            values = [F.sum("_total").over(w), F.sum("_lines").over(w), F.try_divide(F.sum("_prices").over(w), F.sum("_priced").over(w))]
        else:
            values = [F.sum("line_total").over(w), F.count(F.lit(1)).over(w), F.avg("unit_price").over(w)]
        return rows.select("*", *(v.alias(m) for m, v in zip(metrics, values)))

    if hot is None:
        return windowed(lines)
    side = hot.select(F.col("order_id").alias("_key"), *metrics)
    same = lines["order_id"].eqNullSafe(side["_key"])
    return windowed(lines.join(side, same, "left_anti")).unionByName(lines.join(side, same).drop("_key"))


#: What the lines of one version of an order have in common, besides its id.
VERSION_COLUMNS = ["customer_id", "ordered_at", "order_date", "order_status", "_operation", "_event_timestamp_ms", "_extracted_at"]
#: Sums over the lines of a version: total, lines, unit prices and their number.
VERSION_SUMS = ["_total", "_lines", "_prices", "_priced"]


def version_key() -> Column:
    """Tells the versions of one order apart: 64 hashed bits of all that their lines have in common, NULLs marked."""
    return F.xxhash64(*(x for c in VERSION_COLUMNS for x in (F.col(c).isNull(), F.col(c))))


def order_versions(lines: DataFrame) -> DataFrame:
    """One row per version of each order: what its lines have in common, ``VERSION_SUMS`` (combined map-side), ``_version``."""
    number = F.col("_version") if "_version" in lines.columns else version_key()
    return lines.groupBy("order_id", *VERSION_COLUMNS, number.alias("_version")).agg(
        F.sum("line_total").alias("_total"), F.count(F.lit(1)).alias("_lines"),
        F.sum("unit_price").alias("_prices"), F.count("unit_price").alias("_priced"))


def fact_sides(lines: DataFrame, dim_c: DataFrame, dim_p: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(customer side, product side): metrics of each key of the lines with its dimension, one row per key."""
    cust = customer_metrics(lines).join(dim_c.select(
        "customer_id",
        F.col("full_name").alias("customer_name"),
        F.col("first_name").alias("customer_first_name"),
        F.col("last_name").alias("customer_last_name"),
        F.col("email").alias("customer_email"),
        "customer_segment", "days_since_registration"), "customer_id", "left")
    prod = product_metrics(lines).join(dim_p.select(
        "product_id", "product_name",
        F.col("price").alias("current_product_price"),
        "price_category", "inventory_status", "is_out_of_stock"), "product_id", "left")
    return cust, prod


def _join_back(lines: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """Every line with the side row of its key; a NULL key meets the side row of the NULL keys."""
    s = side.withColumnRenamed(key, "_key")
    return lines.join(s, lines[key].eqNullSafe(s["_key"]), "left").drop("_key")


def _meet(lines: DataFrame, versions: DataFrame) -> DataFrame:
    """Every line with its order's version; a join, so the lines of a hot order can be split."""
    v = versions.withColumnsRenamed({"order_id": "_key", "_version": "_same"})
    same = lines["_version"] == v["_same"]
    if "order_id" not in lines.columns:
        return lines.join(v, same).withColumnRenamed("_key", "order_id").drop("_same")
    return lines.join(v, lines["order_id"].eqNullSafe(v["_key"]) & same).drop("_key", "_same")


def _meet_in_order(lines: DataFrame, versions: DataFrame, by: list[str], then: list[str]) -> DataFrame:
    """Every line with its order's version, sorted by the columns ``by`` of both and ``then`` of the lines.

    ``by`` holds the order's id.  Lines and versions go through one
    exchange, by range of ``by``; a window over the rows of equal keys,
    in the order of ``then``, gives each line the versions there, of
    which it takes its own.
    """
    own = [c for c in lines.columns if c not in {*by, *then}]
    shared = [c for c in versions.columns if c not in {*by, "_version"}]
    both = lines.select(*by, *then, F.struct(*own).alias("_line")).unionByName(
        versions.select(*by, F.struct("_version", *shared).alias("_of")), allowMissingColumns=True).repartitionByRange(*by)
    w = Window.partitionBy(*by).orderBy(*(then or by)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    mine = F.filter("_there", lambda v: v["_version"] == F.col("_line")["_version"])
    met = both.withColumn("_there", F.collect_list("_of").over(w)).where(F.col("_line").isNotNull()).withColumn("_of", F.get(mine, F.lit(0)))
    return met.select(*by, *then, *(F.col("_line")[c].alias(c) for c in own), *(F.col("_of")[c].alias(c) for c in shared))


def _dflt(c: str, value, unmatched: str) -> Column:
    return F.coalesce(F.col(c), F.lit(value)).alias(c) if unmatched == "defaults" else F.col(c)


def fact_orders(lines: DataFrame, dim_c: DataFrame, dim_p: DataFrame, as_of=None,
                unmatched: str = "defaults", ordered: bool = False,
                sides: tuple[DataFrame, DataFrame] | None = None, hot: DataFrame | None = None,
                by: dict[str, Column] | None = None) -> DataFrame:
    """Order lines enriched with customer and product data and metrics.

    ``unmatched='defaults'`` fills columns of a missing customer or
    product with type defaults ('' / 0 / false; the age stays NULL) as
    the reference's engine does; ``'nulls'`` keeps SQL NULLs.
    Every line is kept, those with a NULL order, customer or product
    too.  Lines that are written with their ``_version`` (``line_items``)
    meet their order by it, others by id and hash.  ``sides`` are the two tables of ``fact_sides`` as written by
    the caller, so that hot keys can be split at the join-back; without
    them the plan stays fully lazy.  ``hot`` are the metrics of orders
    with very many lines (``hot_orders``), written by the caller.
    ``by`` (name -> expression over ``order_date`` and ``order_id``, the
    id itself among them) brings the rows together and sorts them by
    these keys, and adds those that are no columns of the fact.
    """
    if unmatched not in ("defaults", "nulls"):
        raise ValueError("unmatched must be 'defaults' or 'nulls'")
    if ordered and by:
        raise ValueError("either ordered or by")
    now = X.as_timestamp(as_of)
    cust, prod = sides or fact_sides(lines, dim_c, dim_p)
    versions = with_order_metrics(order_versions(lines), hot).drop(*VERSION_SUMS)
    versions = _join_back(versions, cust, "customer_id")
    keys = by or {}
    if ordered:
        # ascending keys, as a window sorts them: newest first, NULLs last
        keys = {"_undated": F.col("ordered_at").isNull(), "_age": -F.unix_micros("ordered_at"),
                "_unnamed": F.col("order_id").isNull(), "order_id": F.col("order_id")}
    numbered = "_version" in lines.columns
    carried = ["ordered_at"] if ordered else ["order_date"] if by else []
    own = lines.select("product_id", "quantity", "unit_price", "line_total", (F.col("_version") if numbered else version_key()).alias("_version"),
                       *carried, *(["order_id"] if keys or not numbered else []))
    own = _join_back(own, prod, "product_id")
    if ordered:
        last = ["_no_product", "product_id"]
        own = own.withColumns(keys).drop(*carried).withColumn(last[0], F.col("product_id").isNull())
        f = _meet_in_order(own, versions.withColumns(keys), [*keys], last)
        f = f.orderBy(*keys, *last)  # the planner sees that they have this order and sorts nothing
    elif by:
        f = _meet_in_order(own.withColumns(keys).drop(*(c for c in carried if c not in keys)), versions.withColumns(keys), [*keys], [])
    else:
        f = _meet(own, versions)
    price = (F.coalesce(F.col("current_product_price"), F.lit(0.0)) if unmatched == "defaults"
             else F.col("current_product_price"))
    filled = {
        "customer_name": _dflt("customer_name", "", unmatched),
        "customer_first_name": _dflt("customer_first_name", "", unmatched),
        "customer_last_name": _dflt("customer_last_name", "", unmatched),
        "customer_email": _dflt("customer_email", "", unmatched),
        "customer_segment": _dflt("customer_segment", "", unmatched),
        "product_name": _dflt("product_name", "", unmatched),
        "current_product_price": price.alias("current_product_price"),
        "price_category": _dflt("price_category", "", unmatched),
        "inventory_status": _dflt("inventory_status", "", unmatched),
        "is_out_of_stock": _dflt("is_out_of_stock", False, unmatched),
        "price_difference": X.price_gap("unit_price", price).alias("price_difference"),
        "has_price_variance": X.has_variance("unit_price", price).alias("has_price_variance"),
        "_processed_at": now.alias("_processed_at"),
    }
    return f.select(*[filled.get(c, F.col(c)) for c in S.FACT_ORDERS], *(c for c in by or {} if c not in S.FACT_ORDERS))


# --- daily sales (G1-G5) ------------------------------------------------------------

def order_totals(lines: DataFrame, min_total: float = 0.0) -> DataFrame:
    """Per (order, customer, day): total and line count, totals above ``min_total``."""
    return (lines.groupBy("order_id", "customer_id", "order_date")
            .agg(F.sum("line_total").alias("order_total_value"),
                 F.count(F.lit(1)).alias("line_items_count"))
            .where(F.col("order_total_value") > min_total))


def unique_count(col: str, approx: bool = False, rsd: float = 0.01) -> Column:
    """Exact distinct count, or a HyperLogLog++ estimate."""
    return F.approx_count_distinct(col, rsd) if approx else F.count_distinct(col)


def daily_sales(lines: DataFrame, as_of=None, approx: bool = False, ordered: bool = False) -> DataFrame:
    """Per order day: revenue, orders, customers, average order, lines."""
    t = order_totals(lines)
    out = t.groupBy("order_date").agg(
        F.sum("order_total_value").alias("total_revenue"),
        F.count_distinct("order_id").alias("total_orders_placed"),
        unique_count("customer_id", approx).alias("total_unique_customers"),
        F.avg("order_total_value").alias("avg_order_value"),
        F.sum("line_items_count").alias("total_line_items"),
    ).select(*S.DAILY_SALES[:-1], X.as_timestamp(as_of).alias("_calculated_at"))
    return out.orderBy(F.col("order_date").desc_nulls_last()) if ordered else out

