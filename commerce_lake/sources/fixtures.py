"""Change events derived from the given relational tables.

The relational tables stand in for the captured collections: each row
becomes a source document, each document one or more change events
(snapshot read, updates, deletes), and the events a change-log frame
with the Kafka-source columns.  Everything is a narrow projection or
one window per order, so it scales with the tables.

The mapping (FIXTURES.md section 5) is chosen so every money value is a
multiple of 0.25 and float sums are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas as S
from .tables import read_table

# Fixed values of the test mapping.
AS_OF_CUSTOMERS = "2024-01-01 00:00:00"   # registration dates count back from here
AS_OF_ORDERS = "2001-08-01 00:00:00"      # latest order date of the test data
REGISTRATION_SPAN_DAYS = 800
PRICE_PER_SIZE = 6.5
VARIANCE_SURCHARGE = 1.25
DISCOUNT_CUTOFF = 0.05
STOCK_MODULUS = 60
STATUS_OF = {"O": "shipped", "F": "delivered", "P": "pending"}
N_PARTITIONS = 4
TS_SNAPSHOT, TS_UPDATE, TS_DELETE = 1000, 2000, 3000
SHAPES = ("envelope", "string_after", "root", "flat")


def _oid(c: Column) -> Column:
    return F.struct(c.alias("$oid"))


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def _status(code: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, v in STATUS_OF.items():
        out = F.when(code == k, F.lit(v)).otherwise(out)
    return out


# --- source documents -------------------------------------------------------

def customer_docs(customer: DataFrame) -> DataFrame:
    """(num, id, doc) per customer; ``doc`` is the stored document."""
    k = F.col("c_custkey")
    registered = (F.lit(AS_OF_CUSTOMERS).cast("timestamp")
                  - F.make_dt_interval(days=(k % REGISTRATION_SPAN_DAYS).cast("int")))
    return customer.select(
        k.alias("num"),
        k.cast("string").alias("id"),
        F.struct(
            _oid(k.cast("string")).alias("_id"),
            F.lit("Customer").alias("first_name"),
            F.substring("c_name", 10, 1 << 20).alias("last_name"),
            F.concat(F.lit("c"), k.cast("string"), F.lit("@example.com")).alias("email"),
            _iso(registered).alias("registration_date"),
        ).alias("doc"),
    )


def product_docs(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    return part.select(
        k.alias("num"),
        k.cast("string").alias("id"),
        F.struct(
            _oid(k.cast("string")).alias("_id"),
            F.col("p_name").alias("name"),
            (F.col("p_size") * F.lit(PRICE_PER_SIZE)).alias("price"),
            (k % STOCK_MODULUS).cast("int").alias("stock_quantity"),
        ).alias("doc"),
    )


def line_items(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """(l_orderkey, line_items array) per order: one window over its lines.

    Lines join the part table for their price (Spark picks broadcast or
    shuffle join by measured size); the window leaves the data
    hash-partitioned and sorted on the key the orders join uses next.
    (A grouped collect has nothing to combine before the exchange, yet
    sorts the lines on both sides of it and sends them as arrays.)
    Both functions have the same window order, so one sort of the bare
    lines serves them; under two orders Spark sorts again, every line
    then holding the array of its whole order.  The lines are dealt out by
    order before they become structs of text, which are several times as wide.
    """
    priced = lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_discount").join(
        part.select(F.col("p_partkey").alias("l_partkey"), "p_size"), "l_partkey")
    bare = priced.select("l_orderkey", "l_partkey", F.col("l_quantity").cast("int").alias("_quantity"),
                         (F.col("p_size") * F.lit(PRICE_PER_SIZE)
                          + F.when(F.col("l_discount") > DISCOUNT_CUTOFF, F.lit(VARIANCE_SURCHARGE))
                          .otherwise(F.lit(0.0))).alias("_price")).repartition("l_orderkey")
    item = F.struct(
        _oid(F.col("l_partkey").cast("string")).alias("product_id"),
        F.col("_quantity").alias("quantity"),
        F.col("_price").alias("price"),
    )
    order = Window.partitionBy("l_orderkey").orderBy("l_orderkey")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return bare.select("l_orderkey", F.collect_list(item).over(whole).alias("line_items"),
                         F.row_number().over(order).alias("_nth")).where(F.col("_nth") == 1).drop("_nth")


def order_docs(orders: DataFrame, lineitem: DataFrame, part: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    lines = line_items(lineitem, part).withColumnRenamed("l_orderkey", "o_orderkey")
    return orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus").join(
        lines, "o_orderkey", "left").select(
        k.alias("num"),
        k.cast("string").alias("id"),
        F.struct(
            _oid(k.cast("string")).alias("_id"),
            _oid(F.col("o_custkey").cast("string")).alias("customer_id"),
            _iso(F.col("o_orderdate")).alias("order_date"),
            _status(F.col("o_orderstatus")).alias("status"),
            F.col("line_items"),
        ).alias("doc"),
    )


# --- change events ------------------------------------------------------------

def _versions(docs: DataFrame, versions: list[tuple[Column, str, int, Column | None]]) -> DataFrame:
    """Explode each document into its change events: (num, id, op, ts_ms, after, seq).

    ``versions`` holds (condition, op, ts_ms, after-image expression);
    ``None`` as after-image is a delete.  One scan, no shuffle.
    """
    after_type = docs.schema["doc"].dataType
    cand = []
    for seq, (cond, op, ts, after) in enumerate(versions):
        img = F.lit(None).cast(after_type) if after is None else after
        cand.append(F.when(cond, F.struct(F.lit(op).alias("op"), F.lit(ts).cast("bigint").alias("ts_ms"),
                                          img.alias("after"), F.lit(seq).alias("seq"))))
    ev = docs.select("num", "id", F.explode(F.filter(F.array(*cand), lambda x: x.isNotNull())).alias("e"))
    return ev.select("num", "id", "e.op", "e.ts_ms", "e.after", "e.seq")


def customer_events(customer: DataFrame, with_updates: bool = True, with_deletes: bool = True) -> DataFrame:
    docs = customer_docs(customer)
    num, doc = F.col("num"), F.col("doc")
    v = [(F.lit(True), "r", TS_SNAPSHOT, doc)]
    if with_updates:
        v.append((num % 3 == 0, "u", TS_UPDATE,
                  doc.withField("last_name", F.concat(doc["last_name"], F.lit("-x")))))
    if with_deletes:
        v.append((num % 10 == 0, "d", TS_DELETE, None))
    return _versions(docs, v)


def product_events(part: DataFrame, with_updates: bool = True, with_deletes: bool = False) -> DataFrame:
    docs = product_docs(part)
    num, doc = F.col("num"), F.col("doc")
    v = [(F.lit(True), "r", TS_SNAPSHOT, doc)]
    if with_updates:
        v.append((num % 4 == 1, "u", TS_UPDATE,
                  doc.withField("stock_quantity", doc["stock_quantity"] + 1)))
    if with_deletes:
        v.append((num % 12 == 5, "d", TS_DELETE, None))
    return _versions(docs, v)


def order_events(orders: DataFrame, lineitem: DataFrame, part: DataFrame,
                 with_updates: bool = False, with_deletes: bool = False) -> DataFrame:
    docs = order_docs(orders, lineitem, part)
    num, doc = F.col("num"), F.col("doc")
    v = [(F.lit(True), "r", TS_SNAPSHOT, doc)]
    if with_updates:
        v.append((num % 7 == 0, "u", TS_UPDATE, doc.withField("status", F.lit("delivered"))))
    if with_deletes:
        v.append((num % 11 == 3, "d", TS_DELETE, None))
    return _versions(docs, v)


def encode(events: DataFrame, entity: str, shape: str = "envelope") -> DataFrame:
    """Change events -> change-log frame (Kafka-source columns).

    Shapes: ``envelope`` (payload.after object), ``string_after``
    (payload.after JSON-encoded text), ``root`` (envelope without the
    payload wrapper) and ``flat`` (unwrapped document plus
    ``__deleted``, operation in the ``__op`` header).
    """
    if shape not in SHAPES:
        raise ValueError(f"unknown shape {shape!r}")
    after = F.col("after")
    op, ts = F.col("op"), F.col("ts_ms")
    if shape == "envelope":
        value = F.to_json(F.struct(F.struct(op.alias("op"), ts.alias("ts_ms"), after.alias("after")).alias("payload")))
    elif shape == "string_after":
        value = F.to_json(F.struct(F.struct(op.alias("op"), ts.alias("ts_ms"),
                                            F.to_json(after).alias("after")).alias("payload")))
    elif shape == "root":
        value = F.to_json(F.struct(op.alias("op"), ts.alias("ts_ms"), after.alias("after")))
    else:
        live = F.to_json(after.withField("__deleted", F.lit(False)))
        gone = F.to_json(F.struct(_oid(F.col("id")).alias("_id"), F.lit(True).alias("__deleted")))
        value = F.when(after.isNull(), gone).otherwise(live)
    key = F.to_json(F.struct(F.to_json(_oid(F.col("id"))).alias("id")))
    headers = (F.array(F.struct(F.lit("__op").alias("key"), F.encode(op, "UTF-8").alias("value")))
               if shape == "flat" else F.lit(None).cast(S.CHANGELOG["headers"].dataType))
    return events.select(
        key.alias("key"),
        value.alias("value"),
        F.lit(S.topic_of(entity)).alias("topic"),
        (F.col("num") % N_PARTITIONS).cast("int").alias("partition"),
        (F.col("num") * 8 + F.col("seq")).cast("bigint").alias("offset"),
        F.timestamp_millis(ts).alias("timestamp"),
        headers.alias("headers"),
    )


def changelog_from_tables(spark: SparkSession, sf_dir: str, entity: str, shape: str = "envelope",
                          order_updates: bool = False, deletes: bool = False) -> DataFrame:
    """Change-log frame of one entity built from the given tables.

    Customers always have delete events; ``deletes`` adds them to
    products and orders.
    """
    if entity == "customers":
        ev = customer_events(read_table(spark, sf_dir, "customer"))
    elif entity == "products":
        ev = product_events(read_table(spark, sf_dir, "part"), with_deletes=deletes)
    elif entity == "orders":
        ev = order_events(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "lineitem"),
                          read_table(spark, sf_dir, "part"), with_updates=order_updates, with_deletes=deletes)
    else:
        raise ValueError(f"unknown entity {entity!r}")
    return encode(ev, entity, shape)


def changelog_from_events(events: DataFrame) -> DataFrame:
    """Change-log frame from the given ``events`` table (FIXTURES.md section 2).

    offset = event_id, partition = user_id % 4, timestamp = ts, topic by
    user_id % 3; ``error`` events are tombstones (NULL value) and
    ``click`` events are soft deletes (``"__deleted": true``).
    """
    topics = F.array(*[F.lit(S.topic_of(e)) for e in S.ENTITIES])
    doc = F.struct(
        _oid(F.col("event_id").cast("string")).alias("_id"),
        F.col("event_type"), F.col("value"), F.col("props"),
        (F.col("event_type") == "click").alias("__deleted"),
    )
    return events.select(
        F.to_json(F.struct(F.to_json(_oid(F.col("event_id").cast("string"))).alias("id"))).alias("key"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("string")).otherwise(F.to_json(doc)).alias("value"),
        F.element_at(topics, (F.col("user_id") % 3 + 1).cast("int")).alias("topic"),
        (F.col("user_id") % N_PARTITIONS).cast("int").alias("partition"),
        F.col("event_id").cast("bigint").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.array(F.struct(F.lit("__op").alias("key"), F.encode(F.lit("r"), "UTF-8").alias("value"))).alias("headers"),
    )


def bronze_from_tables(spark: SparkSession, sf_dir: str, entity: str, shape: str = "envelope",
                       order_updates: bool = False, ingested_at=None, deletes: bool = False) -> DataFrame:
    """Bronze rows of one entity as the loader would have written them."""
    from ..streaming.ingest import accept, to_bronze

    log = changelog_from_tables(spark, sf_dir, entity, shape, order_updates, deletes)
    if shape == "flat":
        # unwrapped deletes carry "__deleted": true and are dropped by the
        # loader; the other shapes are non-empty objects by construction,
        # so the loader's filters would keep every row
        log = accept(log)
    return to_bronze(log, ingested_at=ingested_at, keep_key=True)


def changelog_with_junk(events: DataFrame) -> DataFrame:
    """The change log of ``events`` with values that test the loader's rules, by event_id % 10.

    1 blank (tab, newline, other white space), 2 cut off, 3 a repeated
    key whose last value counts, 4 text after the object, 5 NaN, 6 a
    scalar; all others as they are.
    """
    k = F.col("offset") % 10
    value = (F.when(k == 1, F.lit("\t \n\x0b"))
             .when(k == 2, F.lit('{"event_type": "cut'))
             .when(k == 3, F.lit('{"__deleted": true, "__deleted": false}'))
             .when(k == 4, F.lit('{"event_type": "a"} x'))
             .when(k == 5, F.lit('{"value": NaN}'))
             .when(k == 6, F.lit('"text"'))
             .otherwise(F.col("value")))
    return changelog_from_events(events).withColumn("value", value)


def bronze_all(spark: SparkSession, sf_dir: str, shape: str = "envelope", order_updates: bool = False,
               ingested_at=None, deletes: bool = False) -> dict[str, DataFrame]:
    return {e: bronze_from_tables(spark, sf_dir, e, shape, order_updates, ingested_at, deletes) for e in S.ENTITIES}
