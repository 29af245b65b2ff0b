"""A hot customer and product (a third of all lines) are split at the fact's join-back."""

from pyspark.sql import functions as F

from commerce_lake.plans import gold
from commerce_lake.plans.materialize import materialize
from commerce_lake.registry import AS_OF, Lake
from tests.conftest import MEDIUM

CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "32",
}


def test_hot_keys_are_split_at_join_back(spark):
    old = {k: spark.conf.get(k, None) for k in CONF}
    try:
        for k, v in CONF.items():
            spark.conf.set(k, v)
        lake = Lake(spark, MEDIUM)
        hot = F.abs(F.xxhash64("order_id", "product_id", "quantity")) % 3 == 0
        lines = materialize(lake.lines()
                            .withColumn("customer_id", F.when(hot, F.lit("0")).otherwise(F.col("customer_id")))
                            .withColumn("product_id", F.when(hot, F.lit("0")).otherwise(F.col("product_id"))),
                            "skewed_lines")
        dim_c, dim_p = lake.dim_customers(), lake.dim_products()
        sides = tuple(materialize(side, "side") for side in gold.fact_sides(lines, dim_c, dim_p))
        fact = gold.fact_orders(lines, dim_c, dim_p, AS_OF, sides=sides)
        rows = fact.collect()
        plan = fact._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin(skew=true)") >= 2, plan
        lazy = gold.fact_orders(lines, dim_c, dim_p, AS_OF).collect()
        key = lambda r: (r["order_id"], r["product_id"], r["quantity"], r["unit_price"])
        assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, lazy), key=str)
        assert max(r["customer_lifetime_orders"] for r in rows if r["customer_id"] == "0") > 1000
        assert len(rows) == lines.count() and key(rows[0])
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
