import datetime as dt

from commerce_lake.plans import gold, silver

AS_OF = "2024-01-01 00:00:00"


def bronze(spark, docs, op="r", ts=1000):
    import json
    rows = []
    for i, d in enumerate(docs):
        payload = {"op": op, "ts_ms": ts}
        if d is not None:
            payload["after"] = d
        rows.append((json.dumps({"payload": payload}), dt.datetime(2024, 1, 1), i, 0))
    return spark.createDataFrame(rows, "raw_data string, _kafka_timestamp timestamp, _kafka_offset long, "
                                       "_kafka_partition int")


def test_silver_drops_missing_id_and_email(spark):
    docs = [{"_id": {"$oid": "1"}, "email": "a@x", "first_name": "A", "last_name": "B",
             "registration_date": "2023-12-31T23:59:00Z"},
            {"email": "b@x"},                                  # no id
            {"_id": {"$oid": "3"}, "email": ""},               # empty email
            {"_id": {"$oid": "4"}, "email": "d@x", "registration_date": "junk"}]
    stg = silver.customers(bronze(spark, docs), AS_OF)
    rows = {r["customer_id"]: r for r in stg.collect()}
    assert set(rows) == {"1", "4"}                             # D10
    assert rows["1"]["registered_at"] == dt.datetime(2023, 12, 31, 23, 59)
    assert rows["4"]["registered_at"] is None and rows["4"]["first_name"] == ""   # D12 -> NULL, D10 -> ''
    rejects = silver.date_rejects(bronze(spark, docs), "customers").collect()
    assert [r["value"] for r in rejects] == ["junk"]
    dim = {r["customer_id"]: r for r in gold.dim_customers(stg, "2024-01-01 00:01:00").collect()}
    assert dim["1"]["days_since_registration"] == 1            # F17 midnight
    assert dim["4"]["customer_segment"] == "Established"       # D20
    assert dim["4"]["days_since_registration"] is None


def test_products_lenient_numbers(spark):
    docs = [{"_id": {"$oid": "1"}, "name": "p", "price": "12.5", "stock_quantity": "3"},
            {"_id": {"$oid": "2"}, "name": "q", "price": 7, "stock_quantity": "3.5"},
            {"_id": {"$oid": "3"}, "name": "r", "price": "abc", "stock_quantity": 3},
            {"_id": {"$oid": "4"}, "name": "", "price": 1}]
    got = {r["product_id"]: (r["price"], r["stock_quantity"])
           for r in silver.products(bronze(spark, docs), AS_OF).collect()}
    assert got == {"1": (12.5, 3), "2": (7.0, 0), "3": (0.0, 3)}
    dim = {r["product_id"]: r for r in gold.dim_products(silver.products(bronze(spark, docs), AS_OF)).collect()}
    assert dim["3"]["inventory_status"] == "Low Stock" and dim["2"]["is_out_of_stock"] is True


def order(oid, lines, status="shipped", cust="c1"):
    d = {"_id": {"$oid": oid}, "customer_id": {"$oid": cust}, "order_date": "2024-01-01T10:00:00Z", "status": status}
    if lines is not None:
        d["line_items"] = lines
    return d


def test_line_item_arrays(spark):
    # D-6: NULL, [], {}, null and [null] give no lines; number as text (D14); D19 empty product id kept
    good = {"product_id": {"$oid": "p1"}, "quantity": "3", "price": 2.5}
    docs = [order("1", None), order("2", []), order("3", {}), order("4", [None]),
            order("5", [good, 5, {"product_id": {"$oid": "p2"}, "quantity": "abc", "price": 1}]),
            order("6", [{"quantity": 2, "price": "1.5"}]),
            order("7", [good], status="cancelled")]
    stg = silver.orders(bronze(spark, docs), AS_OF)
    lines = gold.line_items(stg).collect()
    got = sorted((r["order_id"], r["product_id"], r["quantity"], r["unit_price"], r["line_total"]) for r in lines)
    assert got == [("5", "p1", 3.0, 2.5, 7.5), ("6", "", 2.0, 1.5, 3.0)]


def test_fact_unmatched_modes(spark):
    # Unknown customer and product -> defaults or NULLs
    docs = [order("1", [{"product_id": {"$oid": "px"}, "quantity": 2, "price": 5}], cust="nobody")]
    lines = gold.line_items(silver.orders(bronze(spark, docs), AS_OF))
    empty_c = spark.createDataFrame([], "customer_id string, first_name string, last_name string, full_name string, "
                                        "email string, customer_segment string, days_since_registration int")
    empty_p = spark.createDataFrame([], "product_id string, product_name string, price double, price_category string, "
                                        "inventory_status string, is_out_of_stock boolean")
    d = gold.fact_orders(lines, empty_c, empty_p, AS_OF, "defaults").first()
    assert d["customer_name"] == "" and d["current_product_price"] == 0.0 and d["is_out_of_stock"] is False
    assert d["price_difference"] == 5.0 and d["has_price_variance"] is True
    assert d["days_since_registration"] is None
    n = gold.fact_orders(lines, empty_c, empty_p, AS_OF, "nulls").first()
    assert n["customer_name"] is None and n["price_difference"] is None and n["has_price_variance"] is False
    assert d["order_total_value"] == 10.0 and d["customer_lifetime_orders"] == 1 and d["items_in_order"] == 1


def test_daily_sales_counts_versions(spark):
    # Every surviving version of an order adds its lines
    li = [{"product_id": {"$oid": "p"}, "quantity": 1, "price": 4}]
    b = bronze(spark, [order("1", li), order("2", li, cust="c2")]).unionByName(
        bronze(spark, [order("1", li, status="delivered")], op="u", ts=2000))
    stg = silver.orders(b, AS_OF)
    r = gold.daily_sales(gold.line_items(stg), AS_OF).first()
    assert (r["total_revenue"], r["total_orders_placed"], r["total_unique_customers"], r["total_line_items"]) == \
        (12.0, 2, 2, 3)
    r2 = gold.daily_sales(gold.line_items(stg, latest_only=True), AS_OF).first()
    assert r2["total_revenue"] == 8.0


def test_keep_raw_column(spark):
    b = bronze(spark, [order("1", [])])
    assert "_raw_data" not in silver.orders(b).columns
    r = silver.orders(b, keep_raw=True).first()
    assert r["_raw_data"].startswith('{"payload"') and r["line_items"] == "[]"
