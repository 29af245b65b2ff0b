import pytest

from commerce_lake.operators import quality as Q
from commerce_lake.plans import examples


def test_declared_check_counts():
    kinds = [c[2] for c in Q.CHECKS]
    assert len(Q.CHECKS) == 58
    assert (kinds.count("unique"), kinds.count("not_null"), kinds.count("accepted_values"),
            kinds.count("expression_is_true")) == (10, 31, 4, 13)


def test_seeded_failures(spark):
    df = spark.createDataFrame(
        [("1", "a@x", "New", 5, "a"), ("1", "b@x", "Old", -1, "b"), ("2", None, "Gone", None, "c"),
         ("3", "c@x", None, 0, None)],
        "customer_id string, email string, customer_segment string, days_since_registration int, full_name string")
    out = {(r["column_name"], r["check_name"]): r["failures"]
           for r in Q.run_checks({"dim_customers": df}).collect()}
    assert out[("customer_id", "unique")] == 1            # one duplicated value
    assert out[("email", "unique")] == 0
    assert out[("email", "not_null")] == 1
    assert out[("customer_segment", "accepted_values")] == 2   # distinct bad values; NULL not reported
    assert out[("days_since_registration", "expression_is_true")] == 1   # NULL passes
    assert out[("full_name", "not_null")] == 1
    with pytest.raises(ValueError):
        Q.run_checks({"dim_customers": df.drop("full_name")})
    assert len(Q.run_checks({"dim_customers": df.drop("full_name")}, missing="skip").collect()) == 6


def test_starter_models(spark):
    first = examples.numbers(spark)
    second = examples.ones(first)
    assert sorted(r["id"] for r in first.collect() if r["id"] is not None) == [1]
    assert first.count() == 2 and second.count() == 1
    res = {(r["model"], r["check_name"]): r["passed"]
           for r in Q.run_checks({"my_first_dbt_model": first, "my_second_dbt_model": second}).collect()}
    # the starter model's NULL row fails its own not_null check
    assert res == {("my_first_dbt_model", "unique"): True, ("my_first_dbt_model", "not_null"): False,
                   ("my_second_dbt_model", "unique"): True, ("my_second_dbt_model", "not_null"): True}


def test_failing_rows_name_each_row(spark):
    df = spark.createDataFrame(
        [("1", "a@x", "New", 5, "a"), ("1", "b@x", "Old", -1, "b"), ("2", None, "Gone", None, "c"), ("3", "c@x", None, 0, None)],
        "customer_id string, email string, customer_segment string, days_since_registration int, full_name string")
    rows = {(r["row_key"], r["column_name"], r["check_name"], r["value"], r["occurrences"])
            for r in Q.failing_rows({"dim_customers": df}, {"dim_customers": "customer_id"}).collect()}
    assert rows == {(None, "customer_id", "unique", "1", 2), ("2", "email", "not_null", None, 1), ("3", "full_name", "not_null", None, 1),
                    ("1", "customer_segment", "accepted_values", "Old", 1), ("2", "customer_segment", "accepted_values", "Gone", 1),
                    ("1", "days_since_registration", "expression_is_true", "-1", 1)}
    assert Q.failing_rows({"dim_customers": df.limit(0)}, {}).count() == 0
    with pytest.raises(ValueError):
        Q.failing_rows({"unknown": df}, {})


def test_accepted_values_plan_has_no_expand(spark):
    df = spark.createDataFrame([("a", "b")], "customer_segment string, x string")
    plan = Q.run_checks({"dim_customers": df}, kinds=["accepted_values"])._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
