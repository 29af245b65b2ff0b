"""Table contracts of the change pipeline (bronze, silver, gold)."""

from __future__ import annotations

from pyspark.sql import types as T

# The three captured collections, their change-log topics
# and the bronze table each one is loaded into.
TOPIC_TABLES = {
    "mongo.ecom.ecom.customers": "mongo_ecom_customers",
    "mongo.ecom.ecom.products": "mongo_ecom_products",
    "mongo.ecom.ecom.orders": "mongo_ecom_orders",
}
TOPIC_PATTERN = r"mongo\.ecom\..*"
ENTITIES = ("customers", "products", "orders")
LIVE_OPS = ("r", "c", "u")
ORDER_STATUSES = ("shipped", "delivered", "pending")


def topic_of(entity: str) -> str:
    return f"mongo.ecom.ecom.{entity}"


def table_of(entity: str) -> str:
    return TOPIC_TABLES[topic_of(entity)]


# The change-log frame: the columns of Spark's Kafka source.  The file
# source used in tests and the Kafka source share this contract.
CHANGELOG = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("headers", T.ArrayType(T.StructType([
        T.StructField("key", T.StringType()),
        T.StructField("value", T.BinaryType()),
    ]))),
])

# Bronze: the raw record plus ingest metadata.  ``_kafka_key`` and
# ``_kafka_op`` are optional extras (delete keys and the operation
# header and message time of unwrapped events); readers treat them as absent when missing.
BRONZE = T.StructType([
    T.StructField("raw_data", T.StringType()),
    T.StructField("_kafka_timestamp", T.TimestampType()),
    T.StructField("_kafka_offset", T.LongType()),
    T.StructField("_kafka_partition", T.IntegerType()),
])
BRONZE_OPTIONAL = T.StructType([
    T.StructField("_kafka_key", T.StringType()),
    T.StructField("_kafka_op", T.StringType()),
    T.StructField("_message_timestamp", T.TimestampType()),
])

# Envelope of one change event, every leaf as text: an ``after`` that is
# an object and one that is a JSON-encoded string both arrive as the
# same document text.
ENVELOPE = T.StructType([
    T.StructField("payload", T.StructType([
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.StringType()),
        T.StructField("after", T.StringType()),
    ])),
    T.StructField("op", T.StringType()),
    T.StructField("ts_ms", T.StringType()),
    T.StructField("after", T.StringType()),
    T.StructField("__deleted", T.StringType()),
    T.StructField("_id", T.StringType()),
])

_OID = T.StructType([T.StructField("$oid", T.StringType())])

# After-images, leaves as text so numbers keep their text (3 -> "3").
CUSTOMER_DOC = T.StructType([
    T.StructField("_id", _OID),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("registration_date", T.StringType()),
])
PRODUCT_DOC = T.StructType([
    T.StructField("_id", _OID),
    T.StructField("name", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("stock_quantity", T.StringType()),
])
ORDER_DOC = T.StructType([
    T.StructField("_id", _OID),
    T.StructField("customer_id", _OID),
    T.StructField("order_date", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("line_items", T.StringType()),
])
LINE_ITEM_DOC = T.StructType([
    T.StructField("product_id", _OID),
    T.StructField("quantity", T.StringType()),
    T.StructField("price", T.StringType()),
])

# Column order of the silver and gold relations.
STG_CUSTOMERS = ["customer_id", "first_name", "last_name", "email", "registered_at",
                 "_operation", "_event_timestamp_ms", "_extracted_at"]
STG_PRODUCTS = ["product_id", "product_name", "price", "stock_quantity",
                "_operation", "_event_timestamp_ms", "_extracted_at"]
STG_ORDERS = ["order_id", "customer_id", "ordered_at", "order_status", "line_items",
              "_operation", "_event_timestamp_ms", "_extracted_at"]
# Hidden tie-breakers carried through silver (latest-version ties).
TIEBREAK = ["_kafka_partition", "_kafka_offset"]

DIM_CUSTOMERS = ["customer_id", "first_name", "last_name", "full_name", "email",
                 "registered_at", "customer_segment", "days_since_registration",
                 "_event_timestamp_ms", "_extracted_at", "_processed_at"]
DIM_PRODUCTS = ["product_id", "product_name", "price", "price_rounded", "price_category",
                "stock_quantity", "inventory_status", "is_out_of_stock",
                "_event_timestamp_ms", "_extracted_at", "_processed_at"]
FACT_ORDERS = [
    "order_id", "customer_id", "product_id", "ordered_at", "order_date", "order_status",
    "quantity", "unit_price", "line_total",
    "customer_name", "customer_first_name", "customer_last_name", "customer_email",
    "customer_segment", "days_since_registration",
    "product_name", "current_product_price", "price_category", "inventory_status",
    "is_out_of_stock",
    "price_difference", "has_price_variance",
    "order_total_value", "items_in_order", "avg_item_price_in_order",
    "customer_lifetime_orders", "customer_lifetime_value",
    "product_total_quantity_sold", "product_total_revenue",
    "_operation", "_event_timestamp_ms", "_extracted_at", "_processed_at",
]
DAILY_SALES = ["order_date", "total_revenue", "total_orders_placed", "total_unique_customers",
               "avg_order_value", "total_line_items", "_calculated_at"]
