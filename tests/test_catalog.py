import os

from pyspark.sql import functions as F

from commerce_lake.plans import catalog, pipeline
from commerce_lake.plans.materialize import materialize, new_folder
from commerce_lake.registry import AS_OF, AS_OF_ORDERS, Lake
from commerce_lake.session import pin_session
from commerce_lake.sources import fixtures as FX
from commerce_lake.streaming import ingest as I
from tests.conftest import SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_gold_tables_by_name(spark, scratch):
    bronze = FX.bronze_all(spark, SMALL, ingested_at="2024-01-01")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS gold_test LOCATION '{scratch}/gold_test'")
    gold = pipeline.build(spark, bronze, os.path.join(scratch, "gold"), as_of=AS_OF, database="gold_test")
    other = pin_session(spark.newSession())
    fact = other.table("gold_test.fact_orders")
    assert fact.columns[-1] == catalog.MONTH and fact.drop(catalog.MONTH).exceptAll(other.read.parquet(os.path.join(scratch, "gold", "fact_orders"))).isEmpty()
    recent = catalog.recent(fact, AS_OF_ORDERS, 7)
    plan = plan_of(recent)
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert f"{catalog.MONTH}" in filters.split("PartitionFilters")[1].split("]")[0], plan
    assert catalog.MONTH not in recent.columns
    assert recent.count() == gold["fact_orders"].where(F.col("order_date") >= F.lit("2001-07-25")).count() > 0
    months = fact.select(catalog.MONTH).distinct().count()
    assert months > 10 and fact.where(F.col(catalog.MONTH) != F.trunc("order_date", "month")).count() == 0
    comments = {r["col_name"]: r["comment"] for r in spark.sql("DESCRIBE gold_test.fact_orders").collect()}
    assert comments["line_total"] == "Quantity by unit price" and comments[catalog.MONTH]
    assert "Order lines" in str(spark.sql("DESCRIBE EXTENDED gold_test.fact_orders").collect())
    # a table without a month is only filtered
    assert catalog.recent(other.read.parquet(os.path.join(scratch, "gold", "fact_orders")), AS_OF_ORDERS, 7).count() == recent.count()
    before = fact.count()
    again = pipeline.build(spark, bronze, os.path.join(scratch, "gold2"), as_of=AS_OF, database="gold_test")   # replaced
    assert again["fact_orders"].count() == before
    spark.sql("DROP DATABASE gold_test CASCADE")


def test_bronze_by_ingest_date(spark, scratch):
    log = FX.changelog_from_tables(spark, SMALL, "customers")
    b = I.to_bronze(I.accept(log), ingested_at="2024-03-05 10:00:00", keep_key=True)
    t = catalog.publish_bronze(spark, {"mongo_ecom_customers": b}, "bronze_test", f"{scratch}/bronze_test")["mongo_ecom_customers"]
    assert t.count() == b.count() and [str(r[0]) for r in t.select("ingest_date").distinct().collect()] == ["2024-03-05"]
    assert "PartitionFilters: [isnotnull(ingest_date" in plan_of(t.where("ingest_date >= DATE'2024-03-05'"))
    spark.sql("DROP DATABASE bronze_test CASCADE")


def test_quotes_in_comments_and_empty_tables(spark, scratch):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS odd_test LOCATION '{scratch}/odd_test'")
    df = spark.createDataFrame([], "`a b` int, day date")
    t = catalog.save_table(df, "odd_test.t", {"m": catalog.month_of("day")}, comment="it's empty", comments={"a b": "it's a column"})
    assert t.count() == 0 and t.columns == ["a b", "day", "m"]
    spark.sql("DROP DATABASE odd_test CASCADE")


def test_hot_order_takes_no_window(spark):
    from commerce_lake.plans import gold
    lines = materialize(Lake(spark, SMALL).lines().withColumn(
        "order_id", F.when(F.abs(F.xxhash64("product_id", "quantity")) % 3 == 0, F.lit("hot")).when(
            F.abs(F.xxhash64("quantity")) % 50 == 1, F.lit(None)).otherwise(F.col("order_id"))), "hot", new_folder(spark, "test"))
    limit = 50
    hot = materialize(gold.hot_orders(lines, limit), "hot_orders", new_folder(spark, "test"))
    assert {r["order_id"] for r in hot.collect()} >= {"hot"}
    split = gold.with_order_metrics(lines, hot)
    key = lambda r: tuple(map(str, r))
    rows = sorted(map(key, split.collect()))
    assert rows == sorted(map(key, gold.with_order_metrics(lines).collect()))
    windowed = lines.join(hot.select("order_id"), lines["order_id"].eqNullSafe(hot["order_id"]), "left_anti")
    assert windowed.groupBy("order_id").count().agg(F.max("count")).first()[0] <= limit
    fact = gold.fact_orders(lines, Lake(spark, SMALL).dim_customers(), Lake(spark, SMALL).dim_products(), AS_OF, hot=hot)
    assert fact.count() == lines.count()
