"""The fact's lines go through two exchanges, by product and by order, sorted and by month too."""

import collections
import os

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from commerce_lake.plans import catalog, gold
from commerce_lake.plans.materialize import materialize, new_folder
from commerce_lake.registry import AS_OF, Lake
from commerce_lake.sources import fixtures as FX
from tests.conftest import SMALL

LINES = ("order_id string, customer_id string, product_id string, ordered_at timestamp, order_date date, order_status string, quantity double, "
         "unit_price double, line_total double, _operation string, _event_timestamp_ms long, _extracted_at timestamp")


def nodes(plan):
    yield plan
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        yield from nodes(plan.executedPlan())
    elif kind.endswith("QueryStageExec"):
        yield from nodes(plan.plan())
    for i in range(plan.children().size()):
        yield from nodes(plan.children().apply(i))


def exchanges(df):
    """Rows sent by each exchange of a frame that has run."""
    return [n.metrics().apply("shuffleRecordsWritten").value() for n in nodes(df._jdf.queryExecution().executedPlan())
            if n.getClass().getSimpleName() == "ShuffleExchangeExec"]


def variants(lines, dim_c, dim_p):
    return {"plain": gold.fact_orders(lines, dim_c, dim_p, AS_OF), "sorted": gold.fact_orders(lines, dim_c, dim_p, AS_OF, ordered=True),
            "by month": gold.fact_orders(lines, dim_c, dim_p, AS_OF, by=catalog.fact_by())}


@pytest.fixture
def no_broadcasts(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in names}
    for k in names:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_two_exchanges_of_the_lines(spark, no_broadcasts):
    lake = Lake(spark, SMALL)
    lines = lake.shared_lines()
    n = lines.count()
    found = variants(lines, lake.dim_customers(), lake.dim_products())
    # as the catalog writes it
    found["by month"] = found["by month"].sortWithinPartitions(catalog.MONTH, "order_date", "order_id")
    for name, df in found.items():
        assert len(df.collect()) == n
        assert sum(rows >= n for rows in exchanges(df)) == 2, name
        sorts = [p.toString() for p in nodes(df._jdf.queryExecution().executedPlan()) if p.getClass().getSimpleName() == "SortExec"]
        assert not any("global=true" in s or ", true, 0" in s.splitlines()[0] for s in sorts), name


def odd_lines(spark):
    import datetime as dt
    rows, at = [], dt.datetime(2024, 1, 1)
    for i, (order, cust, product, day, status, op) in enumerate([
            ("1", "c1", "p1", 0, "shipped", "r"), ("1", "c1", "p2", 0, "shipped", "r"), ("1", "c1", "p1", 0, "shipped", "r"),
            ("1", "c1", "p1", 0, "delivered", "u"), ("1", "c2", None, 40, "delivered", "u"), ("1", None, "p3", None, "shipped", "u"),
            (None, "c1", "p1", 3, "shipped", "r"), (None, None, None, None, "pending", "r"), (None, None, None, None, "pending", "r"),
            ("", "c3", "p1", 3, "shipped", "r"), ("2", "c3", "p9", 40, "pending", "r"), ("3", "nobody", "p2", 40, "pending", "r"), ("3", "nobody", "p1", 40, "pending", "r")]):
        when = None if day is None else at + dt.timedelta(days=day)
        price = 1.25 * (i + 1)
        rows.append((order, cust, product, when, when and when.date(), status, 2.0, price, 2 * price, op, 1000, at))
    return spark.createDataFrame(rows, LINES)


def test_versions_ties_and_nulls(spark):
    lines = odd_lines(spark)
    dim_c = spark.createDataFrame([(f"c{i}", "F", f"L{i}", f"F L{i}", f"c{i}@x", "New", i) for i in (1, 2)],
                                  "customer_id string, first_name string, last_name string, full_name string, email string, customer_segment string, days_since_registration int")
    dim_p = spark.createDataFrame([(f"p{i}", f"name {i}", 1.5 * i, "Low", "In Stock", False) for i in (1, 2, 3)],
                                  "product_id string, product_name string, price double, price_category string, inventory_status string, is_out_of_stock boolean")
    given = [r.asDict() for r in lines.collect()]

    def total(key, value):
        return sum(r["line_total"] for r in given if r[key] == value)

    want = collections.Counter()
    for r in given:
        c, p = (r["customer_id"] or "?")[1:], (r["product_id"] or "?")[1:]
        mine = [x for x in given if x["order_id"] == r["order_id"]]
        want[(*(r[k] for k in ("order_id", "customer_id", "product_id", "ordered_at", "order_status", "unit_price", "_operation")),
              f"F L{c}" if c in ("1", "2") else "", f"name {p}" if p in ("1", "2", "3") else "", total("order_id", r["order_id"]), len(mine),
              sum(x["unit_price"] for x in mine) / len(mine), len({x["order_id"] for x in given if x["customer_id"] == r["customer_id"]} - {None}),
              total("customer_id", r["customer_id"]), total("product_id", r["product_id"]))] += 1
    columns = ["order_id", "customer_id", "product_id", "ordered_at", "order_status", "unit_price", "_operation", "customer_name", "product_name",
               "order_total_value", "items_in_order", "avg_item_price_in_order", "customer_lifetime_orders", "customer_lifetime_value", "product_total_revenue"]
    # numbered as order versions are when they are written, and with one version a line
    numbers = spark.createDataFrame([Row(**r, _version=i * 7) for i, r in enumerate(given)], LINES + ", _version long")
    for name, df in [*variants(lines, dim_c, dim_p).items(), *variants(numbers, dim_c, dim_p).items()]:
        rows = df.collect()
        assert collections.Counter(tuple(r[c] for c in columns) for r in rows) == want, name
        if name == "sorted":
            def late(v):
                return (v is None, v or "")
            keys = [(r["ordered_at"] is None, -r["ordered_at"].timestamp() if r["ordered_at"] else 0, late(r["order_id"]), late(r["product_id"])) for r in rows]
            assert keys == sorted(keys)
        if name == "by month":
            assert all((r[catalog.MONTH] and r[catalog.MONTH].isoformat()) == (r["order_date"] and r["order_date"].isoformat()[:8] + "01") for r in rows)
    none = gold.fact_orders(lines.where(F.lit(False)), dim_c, dim_p, AS_OF, ordered=True)
    assert none.count() == 0 and none.columns == variants(lines, dim_c, dim_p)["plain"].columns


def test_published_fact_comes_together_by_month(spark, scratch):
    lake = Lake(spark, SMALL)
    database = "together_test"
    tables = catalog.publish(spark, {"fact_orders": lake.fact(by=catalog.fact_by())}, database, os.path.join(scratch, database))
    fact = tables["fact_orders"]
    assert fact.columns[-1] == catalog.MONTH and fact.drop(catalog.MONTH).exceptAll(lake.fact()).isEmpty()
    assert fact.count() == lake.fact().count() and fact.where(F.col(catalog.MONTH) != F.trunc("order_date", "month")).isEmpty()
    months = fact.select(catalog.MONTH).distinct().count()
    assert len(fact.inputFiles()) <= months + int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_lines_of_the_source_are_dealt_bare(spark):
    lineitem = spark.createDataFrame([(1, 7, 2.0, 0.0), (1, 8, 1.0, 0.1)], "l_orderkey long, l_partkey long, l_quantity double, l_discount double")
    part = spark.createDataFrame([(7, 2), (8, 4)], "p_partkey long, p_size int")
    out = FX.line_items(lineitem, part)
    assert out.count() == 1
    sent = [n.output().toString() for n in nodes(out._jdf.queryExecution().executedPlan()) if n.getClass().getSimpleName() == "ShuffleExchangeExec" and "l_orderkey" in n.output().toString()]
    assert sent and not any("_w0" in s or "line_items" in s for s in sent), sent


def test_intermediate_tables_are_packed(spark, scratch):
    t = materialize(spark.range(1000), "packed", new_folder(spark, "test"))
    assert t.count() == 1000 and all(".zstd." in f for f in t.inputFiles())


def test_written_lines_hold_the_number_of_their_version(spark):
    lake = Lake(spark, SMALL, order_updates=True)
    lines = lake.shared_lines()
    of = lines.groupBy("_version").agg(F.count_distinct("order_id", "order_status", "_operation").alias("n")).agg(F.max("n"), F.count("n")).first()
    assert of[0] == 1 and of[1] == lines.select("order_id", "_operation").distinct().count()
    assert "_version" not in lake.lines().columns and "_version" not in lake.fact().columns
