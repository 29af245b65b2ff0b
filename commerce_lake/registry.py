"""Registered queries: one per checked operator, each with its DuckDB oracle.

Every query builds its inputs from the given tables at ``sf_dir``
(relational rows -> change events -> bronze -> silver -> gold), so its
work grows with the tables.  Clock columns are pinned (``AS_OF``).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle as O
from . import registry_loader as L
from . import schemas as S
from .functions import scalars as X
from .operators import changes as C
from .operators import quality as Q
from .plans import catalog, gold, pipeline, reports, silver
from .plans.materialize import materialize, new_folder
from .session import checkpoint_dir, pin_session
from .sources import fixtures as FX
from .sources.tables import load, read_table
from .streaming import ingest as I

AS_OF = "2024-01-01 00:00:00"
AS_OF_ORDERS = O.AS_OF_ORDERS


class Lake:
    """Lazily built layers of one fixture variant (nothing runs until an action)."""

    def __init__(self, spark: SparkSession, sf_dir: str, shape: str = "envelope",
                 order_updates: bool = False, deletes: str = "ignore"):
        pin_session(spark)
        self.spark, self.sf_dir, self.shape, self.order_updates = spark, sf_dir, shape, order_updates
        self.deletes = deletes
        self._lines = self._orders = None

    def log(self, entity: str) -> DataFrame:
        return FX.changelog_from_tables(self.spark, self.sf_dir, entity, self.shape, self.order_updates)

    def bronze(self, entity: str) -> DataFrame:
        return FX.bronze_from_tables(self.spark, self.sf_dir, entity, self.shape, self.order_updates,
                                     ingested_at=AS_OF, deletes=self.deletes == "apply")

    def stg_customers(self, include_deletes: bool = False) -> DataFrame:
        return silver.customers(self.bronze("customers"), AS_OF, include_deletes=include_deletes)

    def stg_products(self) -> DataFrame:
        return silver.products(self.bronze("products"), AS_OF, include_deletes=self.deletes == "apply")

    def stg_orders(self) -> DataFrame:
        if self._orders is not None:
            return self._orders
        return silver.orders(self.bronze("orders"), AS_OF, include_deletes=self.deletes == "apply")

    def share_orders(self) -> None:
        """Parsed orders written once and re-read by every later model of one query."""
        if self._orders is None:
            self._orders = materialize(self.stg_orders(), "stg_orders")

    def dim_customers(self, deletes: str = "ignore") -> DataFrame:
        return gold.dim_customers(self.stg_customers(include_deletes=deletes == "apply"), AS_OF, deletes)

    def dim_products(self) -> DataFrame:
        return gold.dim_products(self.stg_products(), AS_OF, self.deletes)

    def lines(self, latest_only: bool = False, numbered: bool = False) -> DataFrame:
        return gold.line_items(self.stg_orders(), latest_only, self.deletes, numbered)

    def shared_lines(self) -> DataFrame:
        """Line items written once and re-read by every consumer of one query."""
        if self._lines is None:
            self._lines = materialize(self.lines(numbered=True), "line_items")
        return self._lines

    def fact(self, deletes: str = "ignore", unmatched: str = "defaults", ordered: bool = False, by=None) -> DataFrame:
        deletes = "apply" if self.deletes == "apply" else deletes
        return gold.fact_orders(self.shared_lines(), self.dim_customers(deletes), self.dim_products(), AS_OF,
                                unmatched, ordered, by=by)

    def daily(self) -> DataFrame:
        """Daily sales, from the written line items if a model of the query has them."""
        return gold.daily_sales(self.lines() if self._lines is None else self._lines, AS_OF)


def _events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_session(spark)
    return FX.changelog_from_events(read_table(spark, sf_dir, "events"))


_STG_C_COLS = "customer_id, first_name, last_name, email, registered_at, _operation, _event_timestamp_ms"
_STG_P_COLS = "product_id, product_name, price, stock_quantity, _operation, _event_timestamp_ms"
_DIM_C_COLS = ", ".join(S.DIM_CUSTOMERS)
_DIM_P_COLS = ", ".join(S.DIM_PRODUCTS)
_LINE_COLS = ["order_id", "customer_id", "product_id", "ordered_at", "order_date", "order_status",
              "quantity", "unit_price", "line_total", "_operation", "_event_timestamp_ms", "_extracted_at"]
_FACT_COLS = ", ".join(S.FACT_ORDERS)
_DAILY_COLS = ", ".join(S.DAILY_SALES)


def _q(fn, sql=None, **kw):
    return fn, (O.with_models(sql, **kw) if sql is not None else None)


def _sel(df: DataFrame, cols) -> DataFrame:
    return df.select(*([c.strip() for c in cols.split(",")] if isinstance(cols, str) else cols))


def _shape_dim(shape: str):
    return lambda s, d: Lake(s, d, shape=shape).dim_customers()


def _q_checks(kind: str):
    def run(s, d):
        lake = Lake(s, d)
        build = {"stg_customers": lake.stg_customers, "stg_products": lake.stg_products,
                 "stg_orders": lake.stg_orders, "dim_customers": lake.dim_customers,
                 "dim_products": lake.dim_products, "fact_orders": lake.fact, "fct_daily_sales": lake.daily}
        wanted = [m for m in build if any(c[0] == m and c[2] == kind for c in Q.CHECKS)]
        if len({"stg_orders", "fact_orders", "fct_daily_sales"} & set(wanted)) > 1:
            lake.share_orders()
        return Q.run_checks({m: build[m]() for m in wanted}, kinds=[kind]).drop("passed")
    return run


def _checks_sql(kind: str) -> str:
    parts = []
    for model, col, k, arg in Q.CHECKS:
        if k != kind or model.startswith("my_"):
            continue
        if k == "unique":
            n = (f"(SELECT count(*) FROM (SELECT {col} FROM {model} WHERE {col} IS NOT NULL "
                 f"GROUP BY {col} HAVING count(*) > 1))")
        elif k == "not_null":
            n = f"(SELECT count(*) FROM {model} WHERE {col} IS NULL)"
        elif k == "accepted_values":
            vals = ", ".join(f"'{v}'" for v in arg)
            n = f"(SELECT count(DISTINCT {col}) FROM {model} WHERE {col} NOT IN ({vals}))"
        else:
            n = f"(SELECT count(*) FROM {model} WHERE NOT ({col} {arg}))"
        parts.append(f"SELECT '{model}' AS model, '{col}' AS column_name, '{k}' AS check_name, "
                     f"'{Q.arg_text(arg)}' AS argument, CAST({n} AS BIGINT) AS failures")
    return "\nUNION ALL\n".join(parts)


def _snapshot(s, d):
    cust = read_table(s, d, "customer")
    log = C.snapshot_changes(cust, "c_custkey", "customers", ts_ms=500,
                             doc_cols=["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    n = C.normalize_change(log.withColumnRenamed("value", "raw_data").withColumnRenamed("key", "_kafka_key"))
    doc = F.from_json("_doc", "_id struct<`$oid`:string>, c_name string, c_nationkey string, c_mktsegment string")
    return n.select(F.col("_op").alias("op"), F.col("_ts_ms").alias("ts_ms"), doc.alias("d"), "_key_id").select(
        "op", "ts_ms", F.col("d._id.$oid").alias("customer_id"), F.col("_key_id").alias("key_id"),
        F.col("d.c_name").alias("c_name"), X.int_or_zero("d.c_nationkey").alias("c_nationkey"),
        F.col("d.c_mktsegment").alias("c_mktsegment"))


def _junk_log(s, d):
    pin_session(s)
    return FX.changelog_with_junk(read_table(s, d, "events"))


# Reason of every event of the junk log; orders stand for an unknown topic where ``mapped`` is false.
def _junk_reason(mapped: bool = True) -> str:
    topic = "" if mapped else "WHEN user_id % 3 = 2 THEN 'unknown_topic' "
    return (f"CASE {topic}WHEN event_id % 10 = 1 THEN 'empty' WHEN event_id % 10 IN (2, 4, 6) THEN 'malformed' "
            "WHEN event_id % 10 IN (3, 5) THEN 'accepted' WHEN event_type = 'error' THEN 'empty' "
            "WHEN event_type = 'click' THEN 'deleted' ELSE 'accepted' END")


def _rejects(s, d):
    mapping = {k: v for k, v in S.TOPIC_TABLES.items() if not k.endswith("orders")}
    good, bad = I.split_rejects(_junk_log(s, d), mapping)
    rows = good.withColumn("reason", F.lit("accepted")).unionByName(bad)
    return rows.select("topic", "partition", F.col("offset").alias("event_id"), "reason")


def _loader_rules(s, d):
    c = I.classify(_junk_log(s, d), name="reason")
    return c.select(F.col("offset").alias("event_id"), "partition", F.coalesce("reason", F.lit("accepted")).alias("reason"))


def _merge_schema(s, d):
    """Two column sets written to one folder, read with merged schemas."""
    lake = Lake(s, d)
    base = os.path.join(checkpoint_dir(s), "commerce_lake", f"b8-{uuid.uuid4().hex}")
    lake.bronze("customers").write.parquet(os.path.join(base, "source=customers"))
    lake.bronze("products").select(*S.BRONZE.fieldNames()).write.parquet(os.path.join(base, "source=products"))
    u = load(s, os.path.basename(base), os.path.dirname(base), merge_schema=True)
    return u.groupBy("source").agg(F.count(F.lit(1)).alias("row_count"),
                                   F.count("_kafka_key").alias("with_key"))


def _c2(s, d):
    n = C.rewrite_deletes(Lake(s, d).bronze("customers"))
    return n.groupBy(F.col("_op").alias("op"), F.col("_deleted").alias("deleted")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.get_json_object("_doc", "$._id['$oid']").isNotNull()).alias("with_id"))


def _c3(s, d):
    log = Lake(s, d, shape="flat").log("customers")
    return log.groupBy(C.op_from_header(log).alias("op")).agg(F.count(F.lit(1)).alias("row_count"))


def _c4(s, d):
    return C.drop_empty(_junk_log(s, d)).select("topic", F.col("offset").alias("event_id"))


def _c5(s, d):
    log = C.drop_deleted(C.drop_malformed(C.drop_empty(_junk_log(s, d))))
    return log.select("partition", F.col("offset").alias("event_id"))


def _c7(s, d):
    stg = Lake(s, d).stg_customers(include_deletes=True)
    return C.keep_ops(stg, ("r", "u")).groupBy("_operation").agg(F.count(F.lit(1)).alias("row_count"))


def _c8(s, d):
    n = C.normalize_change(Lake(s, d).bronze("customers"))
    n = n.withColumn("_id_text", F.get_json_object("_doc", "$._id['$oid']"))
    return C.has_after(n).groupBy(F.col("_op").alias("op")).agg(F.count(F.lit(1)).alias("row_count"))


def _b2(s, d):
    b = I.to_bronze(I.accept(_events_log(s, d)), ingested_at=AS_OF, keep_key=True, with_table=True)
    return b.select("table_name", "_kafka_offset", "_kafka_partition", "_kafka_op",
                    F.get_json_object("raw_data", "$.event_type").alias("event_type"),
                    F.get_json_object("raw_data", "$.value").cast("double").alias("value"),
                    C.key_id(F.col("_kafka_key")).alias("key_id"))


def _b3(s, d):
    b = I.to_bronze(I.accept(_events_log(s, d)), ingested_at=AS_OF, with_table=True)
    return I.routed_stats(b)


def _b6(s, d):
    lake = Lake(s, d)
    return I.table_stats({S.table_of(e): lake.bronze(e) for e in S.ENTITIES})


def _a5(s, d):
    return I.drain(_events_log(s, d), I.BATCH_DRAIN[0]).select(
        F.col("offset").alias("event_id"), "partition", "topic")


def _d6(s, d):
    stg = Lake(s, d).stg_orders()
    return stg.where(gold.has_lines()).groupBy("order_status").agg(F.count(F.lit(1)).alias("row_count"))


def _d10(s, d):
    f = reports.since_days(Lake(s, d).fact(), "order_date", AS_OF_ORDERS, 7)
    return f.groupBy("order_date").agg(F.count(F.lit(1)).alias("row_count"), F.sum("line_total").alias("revenue"))


def _m3(s, d):
    stg = Lake(s, d).stg_orders()
    return stg.select("order_id", "customer_id", "ordered_at", "order_status",
                      X.json_length("line_items").alias("n_line_items"), "_operation",
                      "_event_timestamp_ms", "_extracted_at")


def _f13(s, d):
    """Registration times rendered in six text forms (by key), parsed back."""
    c = read_table(s, d, "customer")
    k = F.col("c_custkey")
    reg = F.lit(AS_OF).cast("timestamp") - F.make_dt_interval(days=(k % 800).cast("int"))
    millis = F.unix_millis(reg).cast("string")
    forms = [F.date_format(reg, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), F.date_format(reg, "yyyy-MM-dd HH:mm:ss"),
             F.date_format(reg, "yyyy-MM-dd"), F.unix_seconds(reg).cast("string"), millis,
             F.concat(F.lit('{"$date": '), millis, F.lit("}"))]
    text = F.element_at(F.array(*forms), (k % 6 + 1).cast("int"))
    return c.select(k.cast("string").alias("customer_id"), (k % 6).alias("variant"),
                    X.parse_ts(text).alias("registered_at"))


def _f11_f12(s, d):
    """Part sizes rendered as plain, fractional, exponent, junk and padded text, read leniently."""
    p = read_table(s, d, "part")
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    forms = [size, F.concat(size, F.lit(".0")), F.concat(size, F.lit("e0")), F.concat(F.lit("abc"), size),
             F.concat(F.lit(" "), size, F.lit(" "))]
    text = F.element_at(F.array(*forms), (k % 5 + 1).cast("int"))
    return p.select(k.cast("string").alias("product_id"), (k % 5).alias("variant"),
                    X.double_or_zero(text).alias("as_double"), X.int_or_zero(text).alias("as_int"))


def _f1_f6(s, d):
    """Path-based JSON access on the raw order events."""
    raw = Lake(s, d).bronze("orders").select("raw_data")
    li = X.json_raw("raw_data", "payload", "after", "line_items")
    return raw.select(
        X.json_text("raw_data", "payload", "after", "_id", "$oid").alias("order_id"),
        X.json_text("raw_data", "payload", "after", "customer_id", "$oid").alias("customer_id"),
        X.json_text("raw_data", "payload", "after", "status").alias("order_status"),
        X.json_text("raw_data", "payload", "after", "missing").alias("missing"),
        X.json_has("raw_data", "payload", "after", "line_items").alias("has_line_items"),
        X.json_long("raw_data", "payload", "ts_ms").alias("ts_ms"),
        X.json_length(li).alias("n_line_items"),
        F.when(li.isNotNull(), F.size(X.json_array(li))).alias("n_elements"))


def _approx_unique(s, d):
    """Estimated distinct customers of a day against the exact number: within five standard errors."""
    lines = Lake(s, d).shared_lines()
    rsd = 0.01
    estimate = gold.daily_sales(lines, AS_OF, approx=True).select("order_date", F.col("total_unique_customers").alias("estimate"))
    exact = gold.daily_sales(lines, AS_OF).join(estimate, "order_date")
    off = F.abs(F.col("estimate") - F.col("total_unique_customers"))
    return exact.select("order_date", "total_orders_placed",
                        (off <= F.greatest(F.lit(1.0), 5 * rsd * F.col("total_unique_customers"))).alias("within_error"))


def _hot_order_metrics(s, d):
    """Lines with the metrics of their order; the lines of a third of the products are one order's."""
    lines = Lake(s, d).lines().withColumn("order_id", F.when(F.col("product_id").cast("long") % 3 == 0, F.lit("0")).otherwise(F.col("order_id")))
    lines = materialize(lines, "hot_lines")
    hot = materialize(gold.hot_orders(lines, lines.count() // 10), "hot_orders")
    return gold.with_order_metrics(lines, hot).select("order_id", "product_id", "quantity", "unit_price", "order_total_value",
                                                      "items_in_order", "avg_item_price_in_order")


def _keep_raw(s, d):
    stg = silver.orders(Lake(s, d).bronze("orders"), AS_OF, keep_raw=True)
    raw = F.col("_raw_data")
    return stg.select("order_id", "order_status", X.json_text(raw, "payload", "after", "_id", "$oid").alias("raw_order_id"),
                      X.json_text(raw, "payload", "after", "status").alias("raw_status"), X.json_long(raw, "payload", "ts_ms").alias("raw_ts_ms"))


def _view(s, d):
    pipeline.as_view(Lake(s, d).dim_customers(), "b11_dim_customers")
    return s.sql("SELECT customer_segment, count(*) AS row_count, min(days_since_registration) AS least_days FROM b11_dim_customers GROUP BY 1")


def _catalog(s, d):
    """Gold tables saved by name; another session reads the last days of the fact, of which only their months are scanned."""
    lake = Lake(s, d)
    database = f"gold_{uuid.uuid4().hex[:12]}"
    catalog.publish(s, {"fact_orders": lake.fact(by=catalog.fact_by()), "dim_customers": lake.dim_customers()}, database, new_folder(s, "catalog"))
    other = pin_session(s.newSession())
    return catalog.recent(other.table(f"{database}.fact_orders"), AS_OF_ORDERS, 7).join(
        other.table(f"{database}.dim_customers").select("customer_id", "registered_at"), "customer_id").select(
        "order_id", "order_date", "customer_id", "product_id", "quantity", "line_total", "customer_segment", "registered_at")


# Violations put into the models: (column, modulus, remainder, value) of rows whose key has that remainder.
_SEEDS: dict[str, tuple[str, list[tuple]]] = {
    "dim_customers": ("customer_id", [("email", 7, 0, None), ("email", 11, 1, "twice@example.com"), ("full_name", 19, 1, None),
                                      ("customer_segment", 13, 2, "Unknown"), ("customer_segment", 13, 3, "Gone"), ("days_since_registration", 17, 3, -1)]),
    "dim_products": ("product_id", [("price", 9, 4, -2.5), ("price_category", 8, 3, "Free"), ("stock_quantity", 10, 1, None),
                                    ("stock_quantity", 10, 2, -5), ("product_name", 12, 6, None)]),
    "stg_orders": ("order_id", [("order_status", 10, 3, "lost"), ("customer_id", 14, 5, None)]),
}


def _seeded(s, d) -> dict[str, DataFrame]:
    """The models with their violations; key and checked columns written once, as the checks read each model twice.

    Read from files, the counts of distinct values share their stage with
    no exchange of order lines, beside which Spark would put them, small
    in bytes, into very few tasks.
    """
    lake, out = Lake(s, d), {}
    for model, df in {"dim_customers": lake.dim_customers(), "dim_products": lake.dim_products(), "stg_orders": lake.stg_orders()}.items():
        key, seeds = _SEEDS[model]
        k, columns = F.col(key).cast("long"), {}
        for col, modulus, rest, value in reversed(seeds):
            columns[col] = F.when(k % modulus == rest, F.lit(value)).otherwise(columns.get(col, F.col(col)))
        checked = {key, *(c[1] for c in Q.CHECKS if c[0] == model)}
        out[model] = materialize(df.withColumns(columns).select(*[c for c in df.columns if c in checked]), f"seeded_{model}")
    return out


def _seeded_sql(model: str) -> str:
    key, seeds = _SEEDS[model]
    columns: dict[str, str] = {}
    for col, modulus, rest, value in reversed(seeds):
        literal = "NULL" if value is None else f"'{value}'" if isinstance(value, str) else str(value)
        columns[col] = f"CASE WHEN CAST({key} AS BIGINT) % {modulus} = {rest} THEN {literal} ELSE {columns.get(col, col)} END"
    return f"(SELECT * REPLACE ({', '.join(f'{e} AS {c}' for c, e in columns.items())}) FROM {model})"


def _seeded_counts(s, d):
    return Q.run_checks(_seeded(s, d)).drop("passed")


def _seeded_counts_sql() -> str:
    parts = []
    for model, col, kind, arg in Q.CHECKS:
        if model in _SEEDS:
            t = _seeded_sql(model)
            n = {"unique": f"(SELECT count(*) FROM (SELECT {col} FROM {t} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1))",
                 "not_null": f"(SELECT count(*) FROM {t} WHERE {col} IS NULL)",
                 "accepted_values": f"(SELECT count(DISTINCT {col}) FROM {t} WHERE {col} NOT IN ({_values(arg)}))",
                 "expression_is_true": f"(SELECT count(*) FROM {t} WHERE NOT ({col} {arg}))"}[kind]
            parts.append(f"SELECT '{model}' AS model, '{col}' AS column_name, '{kind}' AS check_name, '{Q.arg_text(arg)}' AS argument, "
                         f"CAST({n} AS BIGINT) AS failures")
    return "\nUNION ALL\n".join(parts)


def _values(arg) -> str:
    return ", ".join(f"'{v}'" for v in arg or ()) if isinstance(arg, tuple) else ""


def _failing(s, d):
    return Q.failing_rows(_seeded(s, d), {m: key for m, (key, _) in _SEEDS.items()})


def _failing_sql() -> str:
    parts = []
    for model, col, kind, arg in Q.CHECKS:
        if model in _SEEDS:
            key, t = _SEEDS[model][0], _seeded_sql(model)
            head = f"SELECT '{model}' AS model, {{key}} AS row_key, '{col}' AS column_name, '{kind}' AS check_name, '{Q.arg_text(arg)}' AS argument, " \
                   f"CAST({col} AS VARCHAR) AS value, {{n}} AS occurrences FROM {t}"
            if kind == "unique":
                parts.append(head.format(key="NULL", n="count(*)") + f" WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1")
            else:
                where = {"not_null": f"{col} IS NULL", "accepted_values": f"{col} NOT IN ({_values(arg)})",
                         "expression_is_true": f"NOT ({col} {arg})"}[kind]
                parts.append(head.format(key=key, n="CAST(1 AS BIGINT)") + f" WHERE {where}")
    return "\nUNION ALL\n".join(parts)


def _sampled(table, sample):
    def run(s, d):
        t = materialize(table(Lake(s, d)), "sampled")
        rows = materialize(sample(t), "sample")
        same = [rows[c].eqNullSafe(t[c]) for c in rows.columns]
        return rows.join(t, same, "left_semi").agg(F.count(F.lit(1)).alias("found")).join(
            rows.agg(F.count(F.lit(1)).alias("row_count"))).select(  # one row each
            "row_count", (F.col("found") == F.col("row_count")).alias("all_in_table"))
    return run


_QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    # --- models -----------------------------------------------------------------
    "m1_stg_customers": _q(lambda s, d: _sel(Lake(s, d).stg_customers(), _STG_C_COLS + ", _extracted_at"),
                           f"SELECT {_STG_C_COLS}, {O.AS_OF} AS _extracted_at FROM stg_customers"),
    "m2_stg_products": _q(lambda s, d: _sel(Lake(s, d).stg_products(), _STG_P_COLS + ", _extracted_at"),
                          f"SELECT {_STG_P_COLS}, {O.AS_OF} AS _extracted_at FROM stg_products"),
    "m3_stg_orders": _q(_m3, f"""
        SELECT s.order_id, s.customer_id, s.ordered_at, s.order_status, n.n_line_items, s._operation,
               s._event_timestamp_ms, {O.AS_OF} AS _extracted_at
        FROM stg_orders s LEFT JOIN (SELECT l_orderkey, CAST(count(*) AS INTEGER) AS n_line_items
                                     FROM lineitem GROUP BY l_orderkey) n ON n.l_orderkey = s.o_orderkey"""),
    "m4_dim_customers": _q(lambda s, d: Lake(s, d).dim_customers(), f"SELECT {_DIM_C_COLS} FROM dim_customers"),
    "m4_dim_customers_deletes_applied": _q(lambda s, d: Lake(s, d).dim_customers("apply"),
                                           f"SELECT {_DIM_C_COLS} FROM dim_customers", customers_deletes="apply"),
    "m5_dim_products_deletes_applied": _q(lambda s, d: Lake(s, d, deletes="apply").dim_products(),
                                          f"SELECT {_DIM_P_COLS} FROM dim_products", deletes="apply"),
    "m7_fact_orders_deletes_applied": _q(lambda s, d: Lake(s, d, deletes="apply").fact(),
                                         f"SELECT {_FACT_COLS} FROM fact_orders", deletes="apply"),
    "m8_daily_sales_deletes_applied": _q(lambda s, d: Lake(s, d, deletes="apply").daily(),
                                         f"SELECT {_DAILY_COLS} FROM fct_daily_sales", deletes="apply"),
    "j3_unmatched_products_nulls": _q(lambda s, d: Lake(s, d, deletes="apply").fact(unmatched="nulls"),
                                      f"SELECT {_FACT_COLS} FROM fact_orders", deletes="apply", unmatched="nulls"),
    "m5_dim_products": _q(lambda s, d: Lake(s, d).dim_products(), f"SELECT {_DIM_P_COLS} FROM dim_products"),
    "m6_line_items": _q(lambda s, d: Lake(s, d).lines(), f"SELECT {', '.join(_LINE_COLS)} FROM lines"),
    "m6_line_items_latest_only": _q(
        lambda s, d: Lake(s, d, order_updates=True).lines(latest_only=True),
        f"""SELECT {', '.join(_LINE_COLS)} FROM (
              SELECT *, max(_event_timestamp_ms) OVER (PARTITION BY order_id) AS _newest FROM lines)
            WHERE _event_timestamp_ms = _newest""", order_updates=True),
    "m7_fact_orders": _q(lambda s, d: Lake(s, d).fact(), f"SELECT {_FACT_COLS} FROM fact_orders"),
    "m7_fact_orders_all_versions": _q(lambda s, d: Lake(s, d, order_updates=True).fact(),
                                      f"SELECT {_FACT_COLS} FROM fact_orders", order_updates=True),
    "m8_daily_sales": _q(lambda s, d: Lake(s, d).daily(), f"SELECT {_DAILY_COLS} FROM fct_daily_sales"),
    "m8_daily_sales_all_versions": _q(lambda s, d: Lake(s, d, order_updates=True).daily(),
                                      f"SELECT {_DAILY_COLS} FROM fct_daily_sales", order_updates=True),
    # --- sources and ingestion --------------------------------------------------------
    "a10_named_source": _q(
        lambda s, d: load(s, "customer.parquet", d).agg(F.count(F.lit(1)).alias("row_count"),
                                                        F.max("c_custkey").alias("max_key"),
                                                        F.count_distinct("c_mktsegment").alias("segments")),
        "SELECT count(*) AS row_count, max(c_custkey) AS max_key, count(DISTINCT c_mktsegment) AS segments "
        "FROM customer"),
    "a2_topic_pattern": _q(
        lambda s, d: C.select_topics(_events_log(s, d), r"mongo\.ecom\.ecom\.(customers|orders)")
        .groupBy("topic").agg(F.count(F.lit(1)).alias("row_count")),
        f"SELECT {O.EVENTS_TOPIC} AS topic, count(*) AS row_count FROM events WHERE user_id % 3 IN (0, 2) GROUP BY 1"),
    "a3_select_collections": _q(
        lambda s, d: C.select_collections(_events_log(s, d), ["products"])
        .groupBy("partition").agg(F.count(F.lit(1)).alias("row_count")),
        "SELECT CAST(user_id % 4 AS INTEGER) AS partition, count(*) AS row_count FROM events "
        "WHERE user_id % 3 = 1 GROUP BY 1"),
    "a4_snapshot_changes": _q(_snapshot, """
        SELECT 'r' AS op, CAST(500 AS BIGINT) AS ts_ms, CAST(c_custkey AS VARCHAR) AS customer_id,
               CAST(c_custkey AS VARCHAR) AS key_id, c_name, c_nationkey, c_mktsegment FROM customer"""),
    "a5_drain": _q(_a5, f"""
        SELECT event_id, CAST(user_id % 4 AS INTEGER) AS partition, {O.EVENTS_TOPIC} AS topic FROM events
        WHERE event_type NOT IN ('error', 'click')
        ORDER BY event_id LIMIT {I.BATCH_DRAIN[0]}"""),
    **L.QUERIES,
    "b2_to_bronze": _q(_b2, f"""
        SELECT {O.EVENTS_TABLE} AS table_name, event_id AS _kafka_offset,
               CAST(user_id % 4 AS INTEGER) AS _kafka_partition, 'r' AS _kafka_op, event_type, value,
               CAST(event_id AS VARCHAR) AS key_id
        FROM events WHERE event_type NOT IN ('error', 'click')"""),
    "b3_route": _q(_b3, f"SELECT {O.EVENTS_TABLE} AS table_name, count(*) AS row_count FROM events "
                        "WHERE event_type NOT IN ('error', 'click') GROUP BY 1"),
    "b6_table_stats": _q(_b6, """
        SELECT 'mongo_ecom_customers' AS table_name,
               (SELECT count(*) + count(*) FILTER (WHERE c_custkey % 3 = 0)
                       + count(*) FILTER (WHERE c_custkey % 10 = 0) FROM customer) AS row_count
        UNION ALL SELECT 'mongo_ecom_products',
               (SELECT count(*) + count(*) FILTER (WHERE p_partkey % 4 = 1) FROM part)
        UNION ALL SELECT 'mongo_ecom_orders', (SELECT count(*) FROM orders)"""),
    "b8_merge_schema": _q(_merge_schema, """
        SELECT 'customers' AS source,
               (SELECT count(*) + count(*) FILTER (WHERE c_custkey % 3 = 0)
                       + count(*) FILTER (WHERE c_custkey % 10 = 0) FROM customer) AS row_count,
               (SELECT count(*) + count(*) FILTER (WHERE c_custkey % 3 = 0)
                       + count(*) FILTER (WHERE c_custkey % 10 = 0) FROM customer) AS with_key
        UNION ALL SELECT 'products', (SELECT count(*) + count(*) FILTER (WHERE p_partkey % 4 = 1) FROM part),
               CAST(0 AS BIGINT)"""),
    "b10_split_rejects": _q(_rejects, f"""
        SELECT {O.EVENTS_TOPIC} AS topic, CAST(user_id % 4 AS INTEGER) AS partition, event_id,
               {_junk_reason(False)} AS reason FROM events
        WHERE {_junk_reason(False)} NOT IN ('empty', 'deleted')"""),
    "b10_c4_c5_loader_rules": _q(_loader_rules, f"""
        SELECT event_id, CAST(user_id % 4 AS INTEGER) AS partition, {_junk_reason()} AS reason FROM events"""),
    # --- change-data operators ------------------------------------------------------------
    "c1_normalize_string_after": _q(_shape_dim("string_after"), f"SELECT {_DIM_C_COLS} FROM dim_customers"),
    "c1_normalize_root_envelope": _q(_shape_dim("root"), f"SELECT {_DIM_C_COLS} FROM dim_customers"),
    "c1_normalize_flat": _q(
        lambda s, d: Lake(s, d, shape="flat").dim_customers(), f"SELECT {_DIM_C_COLS} FROM dim_customers"),
    "c2_rewrite_deletes": _q(_c2, """
        SELECT 'r' AS op, false AS deleted, count(*) AS row_count, count(*) AS with_id FROM customer
        UNION ALL SELECT 'u', false, count(*), count(*) FROM customer WHERE c_custkey % 3 = 0
        UNION ALL SELECT 'd', true, count(*), count(*) FROM customer WHERE c_custkey % 10 = 0"""),
    "c3_op_from_header": _q(_c3, """
        SELECT 'r' AS op, count(*) AS row_count FROM customer
        UNION ALL SELECT 'u', count(*) FROM customer WHERE c_custkey % 3 = 0
        UNION ALL SELECT 'd', count(*) FROM customer WHERE c_custkey % 10 = 0"""),
    "c4_drop_empty": _q(_c4, f"SELECT {O.EVENTS_TOPIC} AS topic, event_id FROM events "
                             f"WHERE {_junk_reason()} <> 'empty'"),
    "c5_drop_malformed_deleted": _q(_c5, "SELECT CAST(user_id % 4 AS INTEGER) AS partition, event_id "
                                         f"FROM events WHERE {_junk_reason()} = 'accepted'"),
    "c6_latest_per_key": _q(
        lambda s, d: C.latest_per_key(Lake(s, d).stg_customers(), ["customer_id"])
        .select("customer_id", "last_name", "_operation", "_event_timestamp_ms"),
        "SELECT customer_id, last_name, _operation, _event_timestamp_ms FROM ("
        "SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY _event_timestamp_ms DESC) AS rn "
        "FROM stg_customers) WHERE rn = 1"),
    "c7_keep_ops": _q(_c7, "SELECT _operation, count(*) AS row_count FROM stg_customers GROUP BY 1"),
    "c8_has_after": _q(_c8, "SELECT _operation AS op, count(*) AS row_count FROM stg_customers GROUP BY 1"),
    # --- filters ------------------------------------------------------------------------------
    "d6_has_lines": _q(_d6, "SELECT order_status, count(*) AS row_count FROM stg_orders "
                            "WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY 1"),
    "d10_since_days": _q(_d10, f"""
        SELECT order_date, count(*) AS row_count, sum(line_total) AS revenue FROM fact_orders
        WHERE order_date >= DATE '{O.ORDERS_RECENT_FROM}' GROUP BY 1"""),
    # --- scalar functions over whole tables -------------------------------------------------
    "f13_parse_ts_formats": _q(_f13, f"""
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_custkey % 6 AS variant,
               {O.AS_OF} - to_days(CAST(c_custkey % 800 AS INTEGER)) AS registered_at FROM customer"""),
    "f11_f12_lenient_numbers": _q(_f11_f12, """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_partkey % 5 AS variant,
               CASE WHEN p_partkey % 5 IN (0, 1, 2) THEN CAST(p_size AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS as_double,
               CASE WHEN p_partkey % 5 = 0 THEN p_size ELSE 0 END AS as_int FROM part"""),
    "f1_f6_json_paths": _q(_f1_f6, f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
               {O._STATUS} AS order_status, '' AS missing,
               n.n IS NOT NULL AS has_line_items, CAST(1000 AS BIGINT) AS ts_ms,
               CAST(n.n AS INTEGER) AS n_line_items, CAST(n.n AS INTEGER) AS n_elements
        FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) n
             ON n.l_orderkey = o_orderkey"""),
    # --- joins ------------------------------------------------------------------------------------
    "j1_j2_enrich": _q(
        lambda s, d: Lake(s, d).fact().select("order_id", "product_id", "quantity", "unit_price",
                                              "customer_name", "customer_segment", "product_name",
                                              "price_category", "price_difference", "has_price_variance"),
        "SELECT order_id, product_id, quantity, unit_price, customer_name, customer_segment, product_name, "
        "price_category, price_difference, has_price_variance FROM fact_orders"),
    "j3_unmatched_defaults": _q(lambda s, d: Lake(s, d).fact(deletes="apply", unmatched="defaults"),
                                f"SELECT {_FACT_COLS} FROM fact_orders", customers_deletes="apply"),
    "j3_unmatched_nulls": _q(lambda s, d: Lake(s, d).fact(deletes="apply", unmatched="nulls"),
                             f"SELECT {_FACT_COLS} FROM fact_orders", customers_deletes="apply",
                             unmatched="nulls"),
    # --- aggregations ---------------------------------------------------------------------------
    "g1_order_totals": _q(lambda s, d: gold.order_totals(Lake(s, d).lines()),
                          "SELECT order_id, customer_id, order_date, order_total_value, line_items_count "
                          "FROM order_totals"),
    "g2_having_min_total": _q(lambda s, d: gold.order_totals(Lake(s, d).lines(), min_total=20000.0),
                              "SELECT order_id, customer_id, order_date, order_total_value, line_items_count "
                              "FROM order_totals WHERE order_total_value > 20000"),
    "g5_approx_unique_customers": _q(
        _approx_unique, "SELECT order_date, total_orders_placed, true AS within_error FROM fct_daily_sales"),
    "g6_segments": _q(lambda s, d: reports.segments(Lake(s, d).dim_customers()), """
        SELECT customer_segment, count(*) AS customer_count, avg(days_since_registration) AS avg_days_registered
        FROM dim_customers GROUP BY 1 ORDER BY customer_count DESC"""),
    "g7_price_inventory": _q(lambda s, d: reports.price_inventory(Lake(s, d).dim_products()), """
        SELECT price_category, inventory_status, count(*) AS product_count, avg(price) AS avg_price
        FROM dim_products GROUP BY 1, 2 ORDER BY 1, 2"""),
    "g8_freshness": _q(lambda s, d: reports.freshness(Lake(s, d, order_updates=True).stg_orders()),
                       "SELECT count(*) AS event_count, max(_event_timestamp_ms) AS max_event_timestamp_ms "
                       "FROM stg_orders", order_updates=True),
    # --- window metrics (as aggregate-and-join) --------------------------------------------------
    "w2_w4_order_metrics": _q(lambda s, d: gold.order_metrics(Lake(s, d).lines()), """
        SELECT order_id, sum(line_total) AS order_total_value, count(*) AS items_in_order,
               avg(unit_price) AS avg_item_price_in_order FROM lines GROUP BY 1"""),
    "w5_w6_customer_metrics": _q(lambda s, d: gold.customer_metrics(Lake(s, d).lines()), """
        SELECT customer_id, count(DISTINCT order_id) AS customer_lifetime_orders,
               sum(line_total) AS customer_lifetime_value FROM lines GROUP BY 1"""),
    "w7_w8_product_metrics": _q(lambda s, d: gold.product_metrics(Lake(s, d).lines()), """
        SELECT product_id, sum(quantity) AS product_total_quantity_sold, sum(line_total) AS product_total_revenue
        FROM lines GROUP BY 1"""),
    "w2_w4_hot_order_window": _q(_hot_order_metrics, """
        SELECT order_id, product_id, quantity, unit_price, sum(line_total) OVER w AS order_total_value, count(*) OVER w AS items_in_order,
               avg(unit_price) OVER w AS avg_item_price_in_order
        FROM (SELECT * REPLACE (CASE WHEN CAST(product_id AS BIGINT) % 3 = 0 THEN '0' ELSE order_id END AS order_id) FROM lines)
        WINDOW w AS (PARTITION BY order_id)"""),
    # --- sorts and top-k -------------------------------------------------------------------------
    "s1_dim_customers_sorted": _q(
        lambda s, d: gold.dim_customers(Lake(s, d).stg_customers(), AS_OF, ordered=True),
        f"SELECT {_DIM_C_COLS} FROM dim_customers ORDER BY registered_at DESC NULLS LAST"),
    "s2_dim_products_sorted": _q(
        lambda s, d: gold.dim_products(Lake(s, d).stg_products(), AS_OF, ordered=True),
        f"SELECT {_DIM_P_COLS} FROM dim_products ORDER BY product_name"),
    "s3_fact_sorted": _q(
        lambda s, d: Lake(s, d).fact(ordered=True),
        f"SELECT {_FACT_COLS} FROM fact_orders ORDER BY ordered_at DESC, order_id, product_id"),
    "s4_top_orders": _q(lambda s, d: reports.top_orders(Lake(s, d).fact(), AS_OF_ORDERS, 7, 20), f"""
        SELECT {', '.join(reports.TOP_ORDER_COLUMNS)} FROM fact_orders
        WHERE order_date >= DATE '{O.ORDERS_RECENT_FROM}'
        ORDER BY order_total_value DESC, order_id, product_id, quantity DESC, unit_price DESC LIMIT 20"""),
    "s6_recent_days": _q(lambda s, d: reports.recent_days(Lake(s, d).daily(), 7), """
        SELECT order_date, total_revenue, total_orders_placed, total_unique_customers, avg_order_value
        FROM fct_daily_sales ORDER BY order_date DESC LIMIT 7"""),
    # --- samples (the limit is the feature): how many rows, and whether all are rows of the table ----
    "r1_sample_raw": _q(_sampled(lambda lake: lake.bronze("orders"), lambda t: reports.sample_raw(t, 1)),
                        "SELECT CAST(1 AS BIGINT) AS row_count, true AS all_in_table"),
    "r2_sample_orders": _q(_sampled(lambda lake: lake.stg_orders(), lambda t: reports.sample_orders(t, 10)),
                           "SELECT CAST(10 AS BIGINT) AS row_count, true AS all_in_table"),
    # --- models by name, raw column -----------------------------------------------------------------
    "d3_keep_raw": _q(_keep_raw, """
        SELECT order_id, order_status, order_id AS raw_order_id, order_status AS raw_status, _event_timestamp_ms AS raw_ts_ms FROM stg_orders"""),
    "b11_view": _q(_view, """
        SELECT customer_segment, count(*) AS row_count, min(days_since_registration) AS least_days FROM dim_customers GROUP BY 1"""),
    "b12_catalog_tables": _q(_catalog, f"""
        SELECT f.order_id, f.order_date, f.customer_id, f.product_id, f.quantity, f.line_total, f.customer_segment, c.registered_at
        FROM fact_orders f JOIN dim_customers c USING (customer_id) WHERE f.order_date >= DATE '{O.ORDERS_RECENT_FROM}'"""),
    # --- data-quality checks ------------------------------------------------------------------------
    "q1_unique": _q(_q_checks("unique"), _checks_sql("unique")),
    "q2_not_null": _q(_q_checks("not_null"), _checks_sql("not_null")),
    "q3_accepted_values": _q(_q_checks("accepted_values"), _checks_sql("accepted_values")),
    "q1_q4_seeded_failures": _q(_seeded_counts, _seeded_counts_sql()),
    "q1_q4_failing_rows": _q(_failing, _failing_sql()),
    "q4_expression_is_true": _q(_q_checks("expression_is_true"), _checks_sql("expression_is_true")),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v[0] for k, v in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in _QUERIES.items() if v[1] is not None}
