"""Declarative data-quality checks (Q1-Q4).

Every check counts failing records the way the declarative test would
return them: ``not_null`` and ``expression_is_true`` count rows,
``accepted_values`` counts distinct offending values (NULL is not
reported), ``unique`` counts values that occur more than once.

All checks of one model that count rows fold into a single aggregate
pass (one ``count_if`` column per check, partial aggregation on every
task); all its ``unique`` and ``accepted_values`` checks share one
grouped count over (check, value) pairs with map-side combine.  Each
model is therefore read at most twice, whatever the number of checks.
``failing_rows`` gives the failures themselves.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The declared checks (model, column, check, argument).
CHECKS: list[tuple[str, str, str, object]] = [
    ("stg_customers", "customer_id", "unique", None),
    ("stg_customers", "customer_id", "not_null", None),
    ("stg_customers", "email", "unique", None),
    ("stg_customers", "email", "not_null", None),
    ("stg_customers", "first_name", "not_null", None),
    ("stg_customers", "last_name", "not_null", None),
    ("stg_products", "product_id", "unique", None),
    ("stg_products", "product_id", "not_null", None),
    ("stg_products", "product_name", "not_null", None),
    ("stg_products", "price", "not_null", None),
    ("stg_products", "price", "expression_is_true", ">= 0"),
    ("stg_orders", "order_id", "unique", None),
    ("stg_orders", "order_id", "not_null", None),
    ("stg_orders", "customer_id", "not_null", None),
    ("stg_orders", "order_status", "accepted_values", ("pending", "shipped", "delivered")),
    ("dim_customers", "customer_id", "unique", None),
    ("dim_customers", "customer_id", "not_null", None),
    ("dim_customers", "email", "unique", None),
    ("dim_customers", "email", "not_null", None),
    ("dim_customers", "full_name", "not_null", None),
    ("dim_customers", "customer_segment", "accepted_values", ("New", "Recent", "Established")),
    ("dim_customers", "days_since_registration", "expression_is_true", ">= 0"),
    ("dim_products", "product_id", "unique", None),
    ("dim_products", "product_id", "not_null", None),
    ("dim_products", "product_name", "not_null", None),
    ("dim_products", "price", "not_null", None),
    ("dim_products", "price", "expression_is_true", "> 0"),
    ("dim_products", "price_category", "accepted_values", ("Low", "Medium", "High")),
    ("dim_products", "inventory_status", "accepted_values",
     ("Out of Stock", "Low Stock", "Medium Stock", "High Stock")),
    ("dim_products", "stock_quantity", "not_null", None),
    ("dim_products", "stock_quantity", "expression_is_true", ">= 0"),
    ("fact_orders", "order_id", "not_null", None),
    ("fact_orders", "customer_id", "not_null", None),
    ("fact_orders", "product_id", "not_null", None),
    ("fact_orders", "quantity", "not_null", None),
    ("fact_orders", "quantity", "expression_is_true", "> 0"),
    ("fact_orders", "unit_price", "not_null", None),
    ("fact_orders", "unit_price", "expression_is_true", "> 0"),
    ("fact_orders", "line_total", "not_null", None),
    ("fact_orders", "line_total", "expression_is_true", "> 0"),
    ("fact_orders", "order_total_value", "not_null", None),
    ("fact_orders", "order_total_value", "expression_is_true", "> 0"),
    ("fact_orders", "customer_lifetime_value", "not_null", None),
    ("fact_orders", "customer_lifetime_value", "expression_is_true", "> 0"),
    ("fct_daily_sales", "order_date", "unique", None),
    ("fct_daily_sales", "order_date", "not_null", None),
    ("fct_daily_sales", "total_revenue", "not_null", None),
    ("fct_daily_sales", "total_revenue", "expression_is_true", ">= 0"),
    ("fct_daily_sales", "total_orders_placed", "not_null", None),
    ("fct_daily_sales", "total_orders_placed", "expression_is_true", "> 0"),
    ("fct_daily_sales", "total_unique_customers", "not_null", None),
    ("fct_daily_sales", "total_unique_customers", "expression_is_true", "> 0"),
    ("fct_daily_sales", "avg_order_value", "not_null", None),
    ("fct_daily_sales", "avg_order_value", "expression_is_true", "> 0"),
    ("my_first_dbt_model", "id", "unique", None),
    ("my_first_dbt_model", "id", "not_null", None),
    ("my_second_dbt_model", "id", "unique", None),
    ("my_second_dbt_model", "id", "not_null", None),
]
CHECK_KINDS = ("unique", "not_null", "accepted_values", "expression_is_true")


def arg_text(arg) -> str:
    if arg is None:
        return ""
    if isinstance(arg, (tuple, list)):
        return ",".join(str(a) for a in arg)
    return str(arg)


def _fails(col: str, kind: str, arg=None) -> Column:
    """Whether a row fails a row-level check; never NULL."""
    c = F.col(f"`{col}`")
    if kind == "not_null":
        return c.isNull()
    if kind == "accepted_values":
        return F.coalesce(~c.isin(list(arg)), F.lit(False))
    if kind == "expression_is_true":
        return F.coalesce(~F.expr(f"`{col}` {arg}"), F.lit(False))
    raise ValueError(f"not a row-level check: {kind}")


def _repeated(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, value, occurrences) of every non-NULL value that occurs more than once in its column.

    One exchange for all columns: rows become (column, value) pairs,
    counted per pair with partial aggregation, so a very frequent value
    is pre-counted on every task before the shuffle.
    """
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols
    ])).alias("_p")).select("_p.*").where(F.col("value").isNotNull())
    return (pairs.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("occurrences"))
            .where(F.col("occurrences") > 1))


def value_failures(df: DataFrame, unique: list[str], accepted: dict[str, tuple]) -> DataFrame:
    """(column_name, check_name, argument, failures) of the checks that look at distinct values, also 0.

    ``unique`` counts non-NULL values occurring more than once,
    ``accepted_values`` distinct values outside the accepted ones.  One
    exchange for all of them: rows become (check, value) pairs, of the
    accepted ones only where they offend, counted per pair with partial
    aggregation, so a very frequent value is pre-counted on every task
    before the shuffle.
    """
    checks = [(c, "unique", None) for c in unique] + [(c, "accepted_values", arg) for c, arg in accepted.items()]
    pairs = df.select(F.explode(F.filter(F.array(*[
        F.when(F.lit(True) if kind == "unique" else _fails(c, kind, arg),
               F.struct(F.lit(i).alias("check"), F.col(f"`{c}`").cast("string").alias("value"))) for i, (c, kind, arg) in enumerate(checks)
    ]), lambda p: p["value"].isNotNull())).alias("_p")).select("_p.*")
    counted = pairs.groupBy("check", "value").agg(F.count(F.lit(1)).alias("n")).agg(*[
        F.count_if((F.col("check") == i) & ((F.col("n") > 1) if kind == "unique" else F.lit(True))).alias(f"_u{i}")
        for i, (_, kind, _) in enumerate(checks)])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(kind).alias("check_name"), F.lit(arg_text(arg)).alias("argument"),
                 F.col(f"_u{i}").cast("bigint").alias("failures")) for i, (c, kind, arg) in enumerate(checks)])))


def failing_rows(models: dict[str, DataFrame], keys: dict[str, str], checks: Iterable[tuple] = CHECKS,
                 kinds: Iterable[str] = CHECK_KINDS) -> DataFrame:
    """Every failure of the checks: model, row_key, column_name, check_name, argument, value, occurrences.

    ``keys`` names the column of each model that tells its rows apart (as
    text; NULL without one).  A row that fails several checks comes once
    for each; the row-level checks of a model are one pass that emits
    nothing for rows without a failure.  A value that repeats in a unique
    column comes once, with its ``occurrences`` and without a key.
    """
    kinds, parts = set(kinds), []
    for model, df in models.items():
        mine = [c for c in checks if c[0] == model and c[2] in kinds and c[1] in df.columns]
        row_level = [c for c in mine if c[2] != "unique"]
        uniq = [c[1] for c in mine if c[2] == "unique"]
        if row_level:
            key = F.col(f"`{keys[model]}`").cast("string") if model in keys else F.lit(None).cast("string")
            failed = F.filter(F.array(*[
                F.when(_fails(col, kind, arg), F.struct(F.lit(col).alias("column_name"), F.lit(kind).alias("check_name"),
                                                        F.lit(arg_text(arg)).alias("argument"), F.col(f"`{col}`").cast("string").alias("value")))
                for _, col, kind, arg in row_level]), lambda f: f.isNotNull())
            parts.append(df.select(F.lit(model).alias("model"), key.alias("row_key"), F.explode(failed).alias("_f"))
                         .select("model", "row_key", "_f.*", F.lit(1).cast("bigint").alias("occurrences")))
        if uniq:
            parts.append(_repeated(df, uniq).select(
                F.lit(model).alias("model"), F.lit(None).cast("string").alias("row_key"), "column_name", F.lit("unique").alias("check_name"),
                F.lit("").alias("argument"), "value", "occurrences"))
    if not parts:
        raise ValueError("no checks apply to the given models")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_checks(models: dict[str, DataFrame], checks: Iterable[tuple] = CHECKS,
               kinds: Iterable[str] = CHECK_KINDS, missing: str = "error") -> DataFrame:
    """One row per check of the given models: model, column_name, check_name, argument, failures, passed.

    A check on a column the model lacks raises (``missing='error'``) or
    is left out (``missing='skip'``).
    """
    kinds = set(kinds)
    parts: list[DataFrame] = []
    for model, df in models.items():
        mine = [c for c in checks if c[0] == model and c[2] in kinds]
        absent = sorted({c[1] for c in mine if c[1] not in df.columns})
        if absent and missing == "error":
            raise ValueError(f"model {model} lacks checked columns {absent}")
        mine = [c for c in mine if c[1] in df.columns]
        row_level = [(i, c) for i, c in enumerate(mine) if c[2] in ("not_null", "expression_is_true")]
        uniq = [c[1] for c in mine if c[2] == "unique"]
        accepted = {c[1]: c[3] for c in mine if c[2] == "accepted_values"}
        if uniq or accepted:
            parts.append(value_failures(df, uniq, accepted).select(F.lit(model).alias("model"), "column_name", "check_name", "argument", "failures"))
        if row_level:
            agg = df.agg(*[F.count_if(_fails(col, kind, arg)).alias(f"_c{i}") for i, (_, col, kind, arg) in row_level])
            stacked = F.array(*[F.struct(F.lit(model).alias("model"), F.lit(col).alias("column_name"),
                                         F.lit(kind).alias("check_name"), F.lit(arg_text(arg)).alias("argument"),
                                         F.col(f"_c{i}").cast("bigint").alias("failures"))
                                for i, (_, col, kind, arg) in row_level])
            parts.append(agg.select(F.inline(stacked)))
    if not parts:
        raise ValueError("no checks apply to the given models")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("failures") == 0)
