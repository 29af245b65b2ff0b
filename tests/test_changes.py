import datetime as dt

from pyspark.sql import functions as F

from commerce_lake import schemas as S
from commerce_lake.operators import changes as C
from commerce_lake.plans import silver
from commerce_lake.streaming import ingest as I

SHAPES = [
    '{"payload":{"op":"c","ts_ms":1000,"after":{"_id":{"$oid":"1"},"status":"shipped"}}}',
    '{"payload":{"op":"c","ts_ms":1000,"after":"{\\"_id\\":{\\"$oid\\":\\"1\\"},\\"status\\":\\"shipped\\"}"}}',
    '{"op":"c","ts_ms":1000,"after":{"_id":{"$oid":"1"},"status":"shipped"}}',
    '{"_id":{"$oid":"1"},"status":"shipped","__deleted":false}',
]


def bronze(spark, values, ts=dt.datetime(2024, 1, 1), key=None, op=None):
    rows = [(v, ts, i, 0, key, op) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "raw_data string, _kafka_timestamp timestamp, _kafka_offset long, "
                                       "_kafka_partition int, _kafka_key string, _kafka_op string")


def test_normalize_all_shapes(spark):
    n = C.normalize_change(bronze(spark, SHAPES)).select(
        F.get_json_object("_doc", "$._id['$oid']").alias("id"), F.get_json_object("_doc", "$.status").alias("s"),
        "_op", "_ts_ms", "_deleted").collect()
    assert [(r["id"], r["s"]) for r in n] == [("1", "shipped")] * 4
    assert [r["_op"] for r in n] == ["c", "c", "c", "r"]
    assert [r["_ts_ms"] for r in n][:3] == [1000, 1000, 1000]
    assert n[3]["_ts_ms"] == 1704067200000   # unwrapped: Kafka timestamp
    assert not any(r["_deleted"] for r in n)


def test_normalize_typed_all_shapes(spark):
    n = C.normalize_change(bronze(spark, SHAPES), doc_schema=S.ORDER_DOC).select(
        F.col("_doc._id.$oid").alias("id"), F.col("_doc.status").alias("s")).collect()
    assert [(r["id"], r["s"]) for r in n] == [("1", "shipped")] * 4


def test_deletes_and_null_after(spark):
    vals = ['{"payload":{"op":"d","ts_ms":3000,"after":null}}', '{"payload":{"op":"d","ts_ms":3000}}',
            '{"_id":{"$oid":"9"},"__deleted":true}']
    b = bronze(spark, vals, key='{"id":"{\\"$oid\\": \\"9\\"}"}')
    n = C.normalize_change(b).select("_doc", "_op", "_deleted", "_key_id").collect()
    assert n[0]["_doc"] is None and n[0]["_deleted"] and n[0]["_key_id"] == "9"
    assert n[1]["_doc"] is None and n[1]["_op"] == "d"
    assert n[2]["_op"] == "d" and n[2]["_deleted"]
    # silver drops events without an after-image (D4) unless deletes are kept
    assert silver.orders(b).count() == 0
    assert silver.customers(b, include_deletes=True).where("_operation = 'd'").count() == 3
    r = C.rewrite_deletes(b).where("_op = 'd'").select("_doc").first()["_doc"]
    assert '"__deleted":true' in r and '"9"' in r


def test_loader_filters(spark):
    # blank, tombstone, malformed, soft delete
    rows = [(None,), ("",), ("  ",), ("{bad",), ("[1]",), ("5",), ('{"__deleted": true}',),
            ('{"__deleted": "true"}',), ('{"a": 1}',)]
    df = spark.createDataFrame([(v, "mongo.ecom.ecom.orders", 0, i) for i, (v,) in enumerate(rows)],
                               "value string, topic string, partition int, offset long")
    assert C.drop_empty(df).count() == 6
    assert C.drop_malformed(C.drop_empty(df)).count() == 3
    kept = [r["value"] for r in I.accept(df).collect()]
    assert kept == ['{"__deleted": "true"}', '{"a": 1}']
    assert [r["value"] for r in I.accept(df, lenient=True).collect()] == ['{"a": 1}']
    good, bad = I.split_rejects(df)
    assert good.count() == 2
    assert sorted(r["reason"] for r in bad.collect()) == ["malformed"] * 3


def test_latest_per_key_ties(spark):
    # Same event time, higher offset wins
    rows = [("k", 1000, 0, 1, "old"), ("k", 1000, 0, 2, "new"), ("j", 5, 0, 9, "only")]
    df = spark.createDataFrame(rows, "customer_id string, _event_timestamp_ms long, _kafka_partition long, "
                                     "_kafka_offset long, v string")
    got = {r["customer_id"]: r["v"] for r in C.latest_per_key(df, ["customer_id"]).collect()}
    assert got == {"k": "new", "j": "only"}


def test_latest_per_key_plans_group_limit(spark):
    df = spark.range(100).selectExpr("cast(id % 3 as string) as customer_id", "id as _event_timestamp_ms")
    plan = C.latest_per_key(df, ["customer_id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_op_from_header_and_topics(spark):
    schema = S.CHANGELOG
    rows = [("k", "{}", "mongo.ecom.ecom.orders", 0, 1, None, [("__op", bytearray(b"u"))]),
            ("k", "{}", "other.topic", 0, 2, None, [])]
    df = spark.createDataFrame(rows, schema)
    assert [r[0] for r in df.select(C.op_from_header(df)).collect()] == ["u", None]
    assert C.select_topics(df).count() == 1
    assert C.select_collections(df, ["orders"]).count() == 1


def test_snapshot_changes(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, name string")
    ev = C.snapshot_changes(df, "k", "products", ts_ms=7)
    n = C.normalize_change(ev.withColumnRenamed("value", "raw_data").withColumnRenamed("key", "_kafka_key"))
    got = sorted((r["_op"], r["_ts_ms"], r["_key_id"]) for r in n.collect())
    assert got == [("r", 7, "1"), ("r", 7, "2")]
    assert ev.select("topic").distinct().first()[0] == "mongo.ecom.ecom.products"
