import datetime as dt

from pyspark.sql import functions as F

from commerce_lake.plans import reports


def test_nulls_last_both_directions(spark):
    df = spark.createDataFrame([(2,), (None,), (1,)], "v int")
    assert [r[0] for r in reports.sort_desc(df, "v").collect()] == [2, 1, None]
    assert [r[0] for r in reports.sort_asc(df, "v").collect()] == [1, 2, None]


def test_since_days_and_top_orders(spark):
    rows = [(dt.date(2001, 8, 1), "o1", "p1", 2.0, 5.0, 10.0, 30.0),
            (dt.date(2001, 7, 25), "o2", "p1", 1.0, 5.0, 5.0, 30.0),
            (dt.date(2001, 7, 24), "o3", "p2", 9.0, 9.0, 81.0, 90.0),
            (dt.date(2001, 8, 1), "o0", "p3", 1.0, 2.0, 2.0, 30.0)]
    fact = spark.createDataFrame(rows, "order_date date, order_id string, product_id string, quantity double, "
                                       "unit_price double, line_total double, order_total_value double")
    for c in ["customer_name", "customer_segment", "product_name", "price_category"]:
        fact = fact.withColumn(c, F.lit("x"))
    fact = fact.withColumn("customer_lifetime_value", F.lit(1.0))
    recent = reports.since_days(fact, "order_date", dt.date(2001, 8, 1), 7)
    assert sorted(r["order_id"] for r in recent.collect()) == ["o0", "o1", "o2"]   # 7 days back, inclusive
    top = reports.top_orders(fact, "2001-08-01", 7, 2).collect()
    # equal order totals fall back to the order id
    assert [(r["order_total_value"], r["line_total"]) for r in top] == [(30.0, 2.0), (30.0, 10.0)]


def test_recent_days_and_freshness(spark):
    daily = spark.createDataFrame([(dt.date(2001, 7, d), float(d), 1, 1, 1.0) for d in range(1, 20)],
                                  "order_date date, total_revenue double, total_orders_placed long, "
                                  "total_unique_customers long, avg_order_value double")
    got = [r["order_date"].day for r in reports.recent_days(daily, 7).collect()]
    assert got == list(range(19, 12, -1))
    stg = spark.createDataFrame([(1000,), (3000,), (2000,)], "_event_timestamp_ms long")
    r = reports.freshness(stg).first()
    assert (r["event_count"], r["max_event_timestamp_ms"]) == (3, 3000)
