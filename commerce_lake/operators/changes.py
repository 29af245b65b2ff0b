"""Change-data operators.

All of them are row-local projections and filters except
``latest_per_key``, which is one keyed shuffle with a map-side top-1.
They work on batch and streaming frames alike (no sort, no window)
unless stated.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import scalars as X


def _maybe(df: DataFrame, name: str, dtype: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def key_id(key: Column) -> Column:
    """Document id from a message key: ``{"id": "{\\"$oid\\": \\"..\\"}"}``, ``{"_id": {"$oid": ..}}`` or plain text."""
    inner = F.get_json_object(key, "$.id")
    return F.coalesce(
        F.get_json_object(inner, "$['$oid']"),
        inner,
        F.get_json_object(key, "$._id['$oid']"),
        F.get_json_object(key, "$._id"),
        key,
    )


def evaluate_once(df: DataFrame, keep: list[str], exprs: dict[str, Column]) -> DataFrame:
    """Evaluate expensive expressions (JSON parses) exactly once per row.

    The optimizer pushes a filter below the projection that feeds it by
    inlining the projected expressions, so a parse in a projection with
    a filter on its result would run in both places.  Emitting the
    results through a one-row generator makes them generator output,
    which filters cannot be pushed below; one parse per row remains.
    """
    row = F.struct(*[c.alias(n) for n, c in exprs.items()])
    return df.select(*keep, F.inline(F.array(row)))


def envelope_schema(doc_schema: T.StructType | None = None) -> T.StructType:
    """Envelope of every event shape; ``after`` typed with ``doc_schema`` when given.

    With a document schema the unwrapped shape's fields are read from the
    root in the same parse.
    """
    if doc_schema is None:
        return S.ENVELOPE
    fields = [
        T.StructField("payload", T.StructType([
            T.StructField("op", T.StringType()), T.StructField("ts_ms", T.StringType()),
            T.StructField("after", doc_schema)])),
        T.StructField("op", T.StringType()), T.StructField("ts_ms", T.StringType()),
        T.StructField("after", doc_schema), T.StructField("__deleted", T.StringType()),
    ]
    names = {f.name for f in fields}
    return T.StructType(fields + [f for f in doc_schema.fields if f.name not in names])


def normalize_change(df: DataFrame, raw: str = "raw_data", doc_schema: T.StructType | None = None) -> DataFrame:
    """Unwrap every event shape to ``_doc, _op, _ts_ms, _deleted, _key_id``.

    Shapes: ``{"payload": {op, ts_ms, after}}`` with ``after`` an object
    or JSON text, the same without ``payload``, and the unwrapped
    document (``__deleted`` flag, operation from the ``__op`` header or
    the ``_kafka_op`` column, event time from the message time, or from
    the ingest time where bronze does not hold it).

    Without ``doc_schema``, ``_doc`` is the after-image as JSON text.
    With it, ``_doc`` is the typed after-image (leaves as declared),
    read in the same single parse of the raw text; only an ``after``
    sent as encoded text is parsed a second time.
    """
    parsed = evaluate_once(df, df.columns, {"_env": F.from_json(F.col(raw), envelope_schema(doc_schema))})
    e = F.col("_env")
    # an unwrapped document has its ``_id`` at the root, an envelope has not: fields of its own
    # that are named payload, op or after do not make a document an envelope
    bare = e["_id"].isNotNull() if doc_schema is None or "_id" in doc_schema.names else F.lit(False)
    enveloped = ~bare & e["payload"].isNotNull()
    rooted = ~bare & ~enveloped & (e["op"].isNotNull() | e["after"].isNotNull())
    flat = ~enveloped & ~rooted
    flat_deleted = F.lower(F.coalesce(e["__deleted"], F.lit(""))).isin("true", "1")
    kafka_ms = F.unix_millis(F.coalesce(_maybe(df, "_message_timestamp", "timestamp"),
                                        _maybe(df, "_kafka_timestamp", "timestamp")))
    op = F.coalesce(
        F.when(enveloped, e["payload"]["op"]),
        F.when(rooted, e["op"]),
        F.when(flat, F.coalesce(_maybe(df, "_kafka_op", "string"),
                                F.when(flat_deleted, F.lit("d")), F.lit("r"))),
    )
    if doc_schema is None:
        doc = F.when(enveloped, e["payload"]["after"]).when(rooted, e["after"]).otherwise(F.col(raw))
    else:
        # an after-image sent as JSON text does not fit the typed parse:
        # that text is read again, lazily, only where the typed one is NULL.
        # (A second one-row generator would keep the projections
        # code-generated, but copies every row once more; measured slower.)
        def reparse(path: str) -> Column:
            return F.from_json(F.get_json_object(F.col(raw), path), doc_schema)
        root_doc = F.struct(*[e[f.name].alias(f.name) for f in doc_schema.fields])
        doc = (F.when(enveloped, F.coalesce(e["payload"]["after"], reparse("$.payload.after")))
               .when(rooted, F.coalesce(e["after"], reparse("$.after")))
               .otherwise(root_doc))
    return parsed.select(
        *[F.col(c) for c in df.columns],
        doc.alias("_doc"),
        op.alias("_op"),
        F.when(enveloped, X.uint_or_zero(e["payload"]["ts_ms"]))
        .when(rooted, X.uint_or_zero(e["ts_ms"]))
        .otherwise(F.coalesce(kafka_ms, F.lit(0).cast("bigint"))).alias("_ts_ms"),
        ((op == "d") | (flat & flat_deleted)).alias("_deleted"),
        key_id(_maybe(df, "_kafka_key", "string")).alias("_key_id"),
    )


def op_from_header(df: DataFrame, headers: str = "headers", name: str = "__op") -> Column:
    """Operation carried in a message header."""
    h = F.filter(F.col(headers), lambda x: x["key"] == name)
    return F.try_element_at(h, F.lit(1))["value"].cast("string")


def rewrite_deletes(df: DataFrame) -> DataFrame:
    """Delete events become records flagged ``__deleted`` (C2): the id
    comes from the message key, the document carries ``__deleted: true``."""
    n = normalize_change(df)
    doc = F.when(F.col("_op") == "d",
                 F.to_json(F.struct(F.struct(F.col("_key_id").alias("$oid")).alias("_id"),
                                    F.lit(True).alias("__deleted"))))
    return n.withColumn("_doc", F.coalesce(doc, F.col("_doc"))).withColumn(
        "_deleted", F.col("_op") == "d")


def drop_empty(df: DataFrame, value: str = "value") -> DataFrame:
    """Drop tombstones and blank values (C4)."""
    return df.where(~X.is_blank(F.col(value).cast("string")))


def drop_malformed(df: DataFrame, value: str = "value") -> DataFrame:
    """Keep values that parse as a JSON object."""
    return df.where(X.json_is_object(F.col(value).cast("string")))


def drop_deleted(df: DataFrame, value: str = "value", lenient: bool = False) -> DataFrame:
    """Drop soft-deleted records (``"__deleted": true``)."""
    return df.where(~X.json_flag(F.col(value).cast("string"), "__deleted", lenient))


def keep_ops(df: DataFrame, ops: Iterable[str] = S.LIVE_OPS, col: str = "_operation") -> DataFrame:
    """Keep read/create/update events."""
    return df.where(F.col(col).isin(list(ops)))


def keep_values(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    """Set-membership filter (D-5)."""
    return df.where(F.col(col).isin(list(values)))


def has_after(df: DataFrame, id_col: str = "_id_text") -> DataFrame:
    """Events with an after-image and a non-empty id."""
    return df.where(F.col("_doc").isNotNull() & (F.coalesce(F.col(id_col), F.lit("")) != ""))


def select_collections(df: DataFrame, names: Iterable[str], topic: str = "topic") -> DataFrame:
    """Keep events of the listed collections, e.g. ``['customers']`` or full topic names (A3)."""
    topics = [n if "." in n else S.topic_of(n) for n in names]
    return df.where(F.col(topic).isin(topics))


def select_topics(df: DataFrame, pattern: str = S.TOPIC_PATTERN, topic: str = "topic") -> DataFrame:
    """Keep events whose topic matches a regular expression (A2)."""
    return df.where(F.col(topic).rlike("^(?:" + pattern + ")$"))


def newest_first(df: DataFrame) -> list[Column]:
    """The order of versions: newest first; ties on event time fall to the later partition/offset."""
    return [F.col("_event_timestamp_ms").desc(), *(F.col(c).desc_nulls_last() for c in S.TIEBREAK if c in df.columns)]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """Newest event per key.

    ``row_number() = 1`` over the key, newest first; ties on event time
    fall to the later partition/offset (D8).  Spark plans this as a
    partial ``WindowGroupLimit`` before the shuffle, so a key with many
    versions reaches the exchange as one row per map task.
    """
    if order is None:
        order = newest_first(df)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def snapshot_changes(df: DataFrame, key: str, collection: str, ts_ms: int = 0,
                     doc_cols: Sequence[str] | None = None) -> DataFrame:
    """Existing rows become ``r`` change events in the envelope shape (A4).

    Output has the change-log columns ``key, value, topic``; ``key`` is
    the row key, the document holds ``_id: {"$oid": key}`` plus the
    chosen columns.
    """
    cols = [c for c in (doc_cols or df.columns) if c != key]
    oid = F.struct(F.col(key).cast("string").alias("$oid"))
    after = F.struct(oid.alias("_id"), *[F.col(c) for c in cols])
    value = F.to_json(F.struct(F.struct(F.lit("r").alias("op"), F.lit(ts_ms).cast("bigint").alias("ts_ms"),
                                        after.alias("after")).alias("payload")))
    return df.select(
        F.to_json(F.struct(F.to_json(oid).alias("id"))).alias("key"),
        value.alias("value"),
        F.lit(S.topic_of(collection) if "." not in collection else collection).alias("topic"),
    )
