import datetime as dt

from pyspark.sql import functions as F

from commerce_lake.functions import scalars as X


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(expr(F.col("v")).alias("r")).first()["r"]


def test_lenient_numbers(spark):
    # Number as text, junk, fractions for an int, padded and suffixed text
    assert one(spark, X.int_or_zero, "3") == 3
    assert one(spark, X.int_or_zero, "abc") == 0
    assert one(spark, X.int_or_zero, "3.5") == 0
    assert one(spark, X.int_or_zero, " 7 ") == 0
    assert one(spark, X.int_or_zero, None) == 0
    assert one(spark, X.double_or_zero, "3.5") == 3.5
    assert one(spark, X.double_or_zero, "1.0d") == 0.0
    assert one(spark, X.double_or_zero, "1e3") == 1000.0
    assert one(spark, X.double_or_zero, "") == 0.0
    assert one(spark, X.uint_or_zero, "-5") == 0
    assert one(spark, X.uint_or_zero, "1700000000000") == 1700000000000


def test_parse_ts_formats(spark):
    # ISO with Z, space form, date only, 10 and 13 digits, {"$date": ...}, junk
    cases = {
        "2024-01-02T03:04:05Z": dt.datetime(2024, 1, 2, 3, 4, 5),
        "2024-01-02T03:04:05.500Z": dt.datetime(2024, 1, 2, 3, 4, 5, 500000),
        "2024-01-02 03:04:05": dt.datetime(2024, 1, 2, 3, 4, 5),
        "2024-01-02": dt.datetime(2024, 1, 2),
        "1704067200": dt.datetime(2024, 1, 1),
        "1704067200000": dt.datetime(2024, 1, 1),
        '{"$date": 1704067200000}': dt.datetime(2024, 1, 1),
        '{"$date": "2024-01-02T00:00:00Z"}': dt.datetime(2024, 1, 2),
        '{"$date": {"$numberLong": "1704067200000"}}': dt.datetime(2024, 1, 1),
        "20240102": dt.datetime(2024, 1, 2),
        "20240102030405": dt.datetime(2024, 1, 2, 3, 4, 5),
        "02/01/2024": dt.datetime(2024, 1, 2),
        "02.01.2024 03:04:05": dt.datetime(2024, 1, 2, 3, 4, 5),
        "2 Jan 2024": dt.datetime(2024, 1, 2),
        "2024-01-02T03:04:05+01:00": dt.datetime(2024, 1, 2, 2, 4, 5),
        "junk": None,
        "31/02/2024": None,
        "": None,
    }
    rows = [(k,) for k in cases]
    df = spark.createDataFrame(rows, "v string").select("v", X.parse_ts("v").alias("t"),
                                                        X.ts_unparseable("v").alias("bad"))
    got = {r["v"]: (r["t"], r["bad"]) for r in df.collect()}
    for k, want in cases.items():
        assert got[k][0] == want, k
    assert got["junk"][1] is True and got[""][1] is False


def test_parse_ts_strict_fails(spark):
    import pytest
    df = spark.createDataFrame([("junk",)], "v string")
    with pytest.raises(Exception):
        df.select(X.parse_ts("v", strict=True)).collect()


def test_json_helpers(spark):
    doc = '{"payload":{"after":{"_id":{"$oid":"7"},"n":3,"li":[{"a":1}]}}}'
    df = spark.createDataFrame([(doc,)], "d string")
    r = df.select(
        X.json_text("d", "payload", "after", "_id", "$oid").alias("id"),
        X.json_text("d", "payload", "after", "n").alias("n"),
        X.json_text("d", "payload", "missing").alias("missing"),
        X.json_raw("d", "payload", "after", "li").alias("raw"),
        X.json_has("d", "payload", "after").alias("has"),
        X.json_long("d", "payload", "after", "n").alias("long"),
        X.json_length(X.json_raw("d", "payload", "after", "li")).alias("len"),
    ).first()
    assert r["id"] == "7" and r["n"] == "3" and r["missing"] == ""
    assert r["raw"] == '[{"a":1}]' and r["has"] and r["long"] == 3 and r["len"] == 1


def test_json_flag_and_object(spark):
    rows = [('{"__deleted": true}',), ('{"__deleted": "true"}',), ('{"__deleted": 1}',),
            ('{"__deleted": false}',), ('[1]',), ('5',), ('{bad',), ('{"__deleted": 2}',), ('{"__deleted": 1.0}',),
            ('{"__deleted": "TRUE"}',), ('{"__deleted": null}',), ('{"other": true}',)]
    df = spark.createDataFrame(rows, "v string").select(
        "v", X.json_flag("v", "__deleted").alias("f"), X.json_flag("v", "__deleted", lenient=True).alias("lf"),
        X.json_is_object("v").alias("obj"))
    got = {r["v"]: (r["f"], r["lf"], r["obj"]) for r in df.collect()}
    assert got['{"__deleted": true}'] == (True, True, True)
    assert got['{"__deleted": "true"}'] == (False, True, True)   # D17
    assert got['{"__deleted": 1}'][0] is True
    assert got['{"__deleted": false}'][0] is False
    assert got["[1]"][2] is False and got["5"][2] is False and got["{bad"][2] is False  # D18
    assert got['{"__deleted": 2}'][:2] == (False, False)          # 2 == True is false
    assert got['{"__deleted": 1.0}'][0] is True
    assert got['{"__deleted": "TRUE"}'][:2] == (False, True)
    assert got['{"__deleted": null}'][:2] == (False, False) and got['{"other": true}'][:2] == (False, False)


def test_bucket_edges(spark):
    # D-8 edges: price 50 and 200, stock 0/10/50, age exactly 30 and 365 days
    assert one(spark, X.price_category, 49.99, "double") == "Low"
    assert one(spark, X.price_category, 50.0, "double") == "Medium"
    assert one(spark, X.price_category, 200.0, "double") == "High"
    assert one(spark, X.inventory_status, 0, "int") == "Out of Stock"
    assert one(spark, X.inventory_status, 9, "int") == "Low Stock"
    assert one(spark, X.inventory_status, 10, "int") == "Medium Stock"
    assert one(spark, X.inventory_status, 50, "int") == "High Stock"
    as_of = "2024-01-31 00:00:00"
    seg = lambda c: X.customer_segment(c, as_of)
    assert one(spark, seg, dt.datetime(2024, 1, 1), "timestamp") == "New"
    assert one(spark, seg, dt.datetime(2023, 1, 31), "timestamp") == "Recent"
    assert one(spark, seg, dt.datetime(2023, 1, 30), "timestamp") == "Established"
    assert one(spark, seg, None, "timestamp") == "Established"   # D20


def test_days_between_midnight(spark):
    # 23:59 the day before to 00:01 crosses one day boundary
    df = spark.createDataFrame([(dt.datetime(2023, 12, 31, 23, 59), dt.datetime(2024, 1, 1, 0, 1))], "a timestamp, b timestamp")
    assert df.select(X.days_between("a", "b")).first()[0] == 1


def test_full_name_and_rounding(spark):
    df = spark.createDataFrame([("a", "b", 2.675, 0.125), ("a", None, 1.005, 0.375)], "f string, l string, p double, q double")
    r = df.select(X.full_name("f", "l").alias("n"), X.round_money("q").alias("q")).collect()
    assert r[0]["n"] == "a b" and r[1]["n"] is None
    assert r[0]["q"] == 0.12 and r[1]["q"] == 0.38   # half to even


def test_variance(spark):
    df = spark.createDataFrame([(10.0, 10.005), (10.0, 10.02), (10.0, None)], "a double, b double")
    got = [r[0] for r in df.select(X.has_variance("a", "b")).collect()]
    assert got == [False, True, False]


def test_json_valid_and_stamp(spark):
    df = spark.createDataFrame([('{"a": 1}',), ("[1]",), ("{bad",), (None,)], "v string")
    assert [r[0] for r in df.select(X.json_valid("v")).collect()] == [True, True, False, False]
    r = X.stamp(df, "_processed_at", "2024-01-01").select("_processed_at").first()[0]
    assert r == dt.datetime(2024, 1, 1)
