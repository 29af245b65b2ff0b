import os

import pytest
from pyspark.sql import functions as F

from commerce_lake import schemas as S
from commerce_lake.sources import fixtures as FX
from commerce_lake.sources.tables import read_table
from commerce_lake.streaming import ingest as I
from tests.conftest import SMALL


def expected(spark):
    ev = read_table(spark, SMALL, "events").where(~F.col("event_type").isin("error", "click"))
    names = [S.table_of(e) for e in S.ENTITIES]
    return {names[k]: n for k, n in ev.groupBy((F.col("user_id") % 3).alias("k")).count().collect()
            for k in [k] if True for n in [n]}


def counts(spark, root):
    return {t: I.read_bronze(spark, root, t).count() for t in S.TOPIC_TABLES.values()}


def run(spark, src, root, ckpt, **kw):
    changes = I.read_changes(spark, path=src, fmt="parquet", max_per_trigger=1)
    q = I.ingest(changes, root, ckpt, mode="batch", **kw)
    I.run_stream(q, timeout_s=300)
    return q


def test_stream_ingest_restart_reset(spark, scratch):
    src, root, ckpt = (os.path.join(scratch, d) for d in ("src", "bronze", "ckpt"))
    log = FX.changelog_from_events(read_table(spark, SMALL, "events"))
    log.repartition(3).write.parquet(src)
    want = expected(spark)

    run(spark, src, root, ckpt)
    assert counts(spark, root) == want
    progress = I.progress_table(spark, root)
    assert progress.count() >= 3                          # one file per micro-batch
    assert progress.agg(F.sum("num_input_rows"), F.sum("num_accepted_rows")).first() == (log.count(), sum(want.values()))

    run(spark, src, root, ckpt)                          # resume: nothing new
    assert counts(spark, root) == want

    # new data plus junk arrives: only the new file is read; junk goes to rejects
    extra = spark.createDataFrame(
        [("k", '{"_id": {"$oid": "x1"}, "v": 1}', "mongo.ecom.ecom.orders", 0, 10**9, None, []),
         ("k", "{bad", "mongo.ecom.ecom.orders", 0, 10**9 + 1, None, []),
         ("k", '{"a": 1}', "some.other.topic", 0, 10**9 + 2, None, [])], S.CHANGELOG)
    extra.write.mode("append").parquet(src)
    run(spark, src, root, ckpt)
    c = counts(spark, root)
    assert c["mongo_ecom_orders"] == want["mongo_ecom_orders"] + 1
    rej = spark.read.parquet(os.path.join(root, I.REJECTS_TABLE))
    assert sorted(r["reason"] for r in rej.collect()) == ["malformed", "unknown_topic"]

    run(spark, src, root, ckpt, reset=True)              # reset: reload everything once, rejects too
    c = counts(spark, root)
    assert c["mongo_ecom_orders"] == want["mongo_ecom_orders"] + 1
    assert c["mongo_ecom_customers"] == want["mongo_ecom_customers"]
    assert spark.read.parquet(os.path.join(root, I.REJECTS_TABLE)).count() == 2

    run(spark, src, root, ckpt)                          # goes on with the checkpoint of the reset
    assert counts(spark, root) == c

    # a second loader with a checkpoint of its own adds to the same root
    other = os.path.join(scratch, "other")
    extra.where("value like '%x1%'").withColumn("offset", F.lit(10**9 + 9).cast("long")).write.parquet(other)
    run(spark, other, root, ckpt + "-other")
    assert counts(spark, root) == c | {"mongo_ecom_orders": c["mongo_ecom_orders"] + 1}


def test_topic_named_tables_are_emptied_by_a_reset(spark, scratch):
    src, root, ckpt = (os.path.join(scratch, d) for d in ("src", "bronze", "ckpt"))
    rows = [("k", '{"a": 1}', "other.db.things", 0, i, None, []) for i in range(2)]
    spark.createDataFrame(rows, S.CHANGELOG).write.parquet(src)
    run(spark, src, root, ckpt, mapping=I.BY_TOPIC)
    run(spark, src, root, ckpt, mapping=I.BY_TOPIC, reset=True)
    assert I.read_bronze(spark, root, "other.db.things").count() == 2


def test_batch_replay_is_idempotent(spark, scratch):
    root = os.path.join(scratch, "bronze")
    log = FX.changelog_from_events(read_table(spark, SMALL, "events"))
    I.ensure_bronze(spark, root)
    write = I.batch_writer(root)
    write(log, 7)
    write(log, 7)                                        # the same micro-batch again after a failure
    assert counts(spark, root) == expected(spark)


def test_table_stats_and_drain(spark):
    log = FX.changelog_from_events(read_table(spark, SMALL, "events"))
    b = I.to_bronze(I.accept(log), with_table=True)
    stats = {r["table_name"]: r["row_count"] for r in I.table_stats(I.route(b)).collect()}
    assert stats == expected(spark)
    assert {r["table_name"]: r["row_count"] for r in I.routed_stats(b).collect()} == stats
    stray = spark.createDataFrame([("k", '{"a": 1}', "other.db.x", 0, -1, None, [])], S.CHANGELOG)
    assert I.drain(stray, 1).count() == 0                # an unknown topic is not counted
    first = I.drain(log, 50)
    assert first.count() == 50
    second = I.drain(log, 50, I.commit(first))
    assert second.count() == 50 and second.join(first, ["topic", "partition", "offset"]).count() == 0


def test_realtime_mode_and_timeout(spark, scratch):
    src, root, ckpt = (os.path.join(scratch, d) for d in ("src", "bronze", "ckpt"))
    FX.changelog_from_events(read_table(spark, SMALL, "events")).repartition(2).write.parquet(src)
    changes = I.read_changes(spark, path=src, fmt="parquet", topics=["customers", "products", "orders"])
    q = I.ingest(changes, root, ckpt, mode="realtime", interval="1 second")
    q.processAllAvailable()
    with pytest.raises(I.Unfinished):     # still running after the timeout: stopped, and said so
        I.run_stream(q, timeout_s=1)
    assert not q.isActive
    assert counts(spark, root) == expected(spark)


def test_pipeline_build(spark, scratch):
    from commerce_lake.plans import pipeline
    bronze = FX.bronze_all(spark, SMALL, ingested_at="2024-01-01")
    g = pipeline.build(spark, bronze, os.path.join(scratch, "gold"), as_of="2024-01-01")
    assert set(g) == {"dim_customers", "dim_products", "fact_orders", "fct_daily_sales"}
    assert spark.table("fact_orders").count() == g["fact_orders"].count() > 0
    assert spark.table("stg_orders").count() > 0                      # silver registered as a view
    assert g["fct_daily_sales"].where("total_revenue <= 0").count() == 0
    from commerce_lake.sources.tables import load
    assert load(spark, "dim_customers", os.path.join(scratch, "gold")).count() == g["dim_customers"].count()


def test_topic_named_tables_and_kafka_options(spark, scratch):
    root = os.path.join(scratch, "bronze")
    log = FX.changelog_from_events(read_table(spark, SMALL, "events"))
    I.batch_writer(root, mapping=I.BY_TOPIC)(log, 0)
    got = {t: I.read_bronze(spark, root, t).count() for t in S.TOPIC_TABLES}
    want = expected(spark)
    assert got == {t: want[S.TOPIC_TABLES[t]] for t in S.TOPIC_TABLES}
    opts = I.kafka_options(["customers"], max_per_trigger=100)
    assert opts == {"startingOffsets": "earliest", "includeHeaders": "true", "subscribe": "mongo.ecom.ecom.customers",
                    "maxOffsetsPerTrigger": "100"}
    assert I.kafka_options(pattern=S.TOPIC_PATTERN)["subscribePattern"] == S.TOPIC_PATTERN


def test_silver_and_line_items_run_on_a_stream(spark, scratch):
    from commerce_lake.plans import gold, silver
    bronze_dir, out, ckpt = (os.path.join(scratch, d) for d in ("bronze", "lines", "ckpt"))
    FX.bronze_from_tables(spark, SMALL, "orders", ingested_at="2024-01-01").repartition(3).write.parquet(bronze_dir)
    batch = gold.line_items(silver.orders(spark.read.parquet(bronze_dir), "2024-01-01"))
    schema = spark.read.parquet(bronze_dir).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(bronze_dir)
    lines = gold.line_items(silver.orders(stream, "2024-01-01"))
    q = (lines.writeStream.format("parquet").option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start(out))
    I.run_stream(q, timeout_s=300)
    got = spark.read.parquet(out)
    assert got.count() == batch.count() > 0
    assert got.exceptAll(batch.select(*got.columns)).count() == 0
