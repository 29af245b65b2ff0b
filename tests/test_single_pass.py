"""Order events are built and parsed once a model, not once for each of its consumers."""

from pyspark.sql import functions as F

from commerce_lake import registry
from commerce_lake.operators import quality as Q
from commerce_lake.plans import gold
from commerce_lake.registry import Lake
from commerce_lake.sources import fixtures as FX
from tests.conftest import SMALL


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_deletes_parse_the_orders_once(spark):
    lines = Lake(spark, SMALL, deletes="apply").lines()
    assert _plan(lines).count("Generate inline") == 1


def test_deleted_orders_by_newest_event(spark):
    line = '[{"product_id": {"$oid": "p"}, "quantity": 1, "price": 2}]'
    rows = [("1", "r", 1, 0), ("1", "d", 2, 0),                # gone
            ("2", "d", 1, 0), ("2", "u", 2, 0),                # back again
            ("3", "r", 1, 5), ("3", "d", 1, 6),                # same time: the later offset counts
            ("4", "d", 1, 5), ("4", "r", 1, 6),
            ("5", "r", 1, 0), ("5", "u", 2, 0),                # two versions
            (None, "r", 1, 0), (None, "d", 2, 0)]              # no key: never one order
    stg = spark.createDataFrame(rows, "order_id string, _operation string, _event_timestamp_ms long, _kafka_offset long").select(
        "*", F.lit("c").alias("customer_id"), F.lit("2024-01-01").cast("timestamp").alias("ordered_at"), F.lit("shipped").alias("order_status"),
        F.lit(line).alias("line_items"), F.lit("2024-01-01").cast("timestamp").alias("_extracted_at"), F.lit(0).cast("long").alias("_kafka_partition"))
    got = sorted(((r["order_id"] or "", r["_operation"]) for r in gold.line_items(stg, deletes="apply").collect()))
    assert got == [("", "r"), ("2", "u"), ("4", "r"), ("5", "r"), ("5", "u")]


def test_daily_sales_read_the_written_lines(spark):
    lake = Lake(spark, SMALL)
    alone = lake.daily().collect()
    lake.share_orders()
    lake.fact()
    daily = lake.daily()
    assert "from_json" not in _plan(daily)
    assert sorted(daily.collect()) == sorted(alone)


def test_lines_of_an_order_are_collected_after_one_exchange(spark):
    lineitem = spark.createDataFrame([(1, 7, 2.0, 0.0), (1, 7, 2.0, 0.0), (1, 8, 1.0, 0.1), (2, 9, 1.0, 0.0), (None, 7, 3.0, 0.0)],
                                     "l_orderkey long, l_partkey long, l_quantity double, l_discount double")
    part = spark.createDataFrame([(7, 2), (8, 4)], "p_partkey long, p_size int")
    out = FX.line_items(lineitem, part)
    assert "collect_list" in _plan(out) and "Aggregate" not in _plan(out)
    got = {r["l_orderkey"]: sorted((i["product_id"]["$oid"], i["quantity"], i["price"]) for i in r["line_items"]) for r in out.collect()}
    assert got == {1: [("7", 2, 13.0), ("7", 2, 13.0), ("8", 1, 27.25)], None: [("7", 3, 13.0)]} and out.count() == 2


def test_lines_are_sorted_once_and_without_the_arrays(spark):
    lineitem = spark.createDataFrame([(k, (k or 0) % 3, 1.0, 0.0) for k in [1, 1, 2, 3, 3, 3, None]],
                                     "l_orderkey long, l_partkey long, l_quantity double, l_discount double")
    part = spark.createDataFrame([(0, 2), (1, 4), (2, 6)], "p_partkey long, p_size int")
    out = FX.line_items(lineitem, part)
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Window ") == 1                # a second one sorts lines that hold their order's array
    got = {r["l_orderkey"]: sorted(i["product_id"]["$oid"] for i in r["line_items"]) for r in out.collect()}
    assert got == {1: ["1", "1"], 2: ["2"], 3: ["0", "0", "0"], None: ["0"]}


def test_seeded_models_are_built_once_for_their_checks(spark):
    models = registry._seeded(spark, SMALL)
    assert sorted(models) == ["dim_customers", "dim_products", "stg_orders"]
    for df in models.values():
        assert "from_json" not in _plan(df) and "Window" not in _plan(df)
    assert models["stg_orders"].columns == ["order_id", "customer_id", "order_status"]
    orders = Lake(spark, SMALL).stg_orders()
    assert models["stg_orders"].count() == orders.count()
    failing = Q.failing_rows(models, {"stg_orders": "order_id"})
    assert "Window" not in _plan(failing) and failing.where("model = 'stg_orders'").count() > 0
