"""Bronze ingestion: change log -> raw bronze tables.

One streaming query subscribes to every topic.  Each micro-batch is
classified and written in one pass, partitioned by bronze table and
segment; its counts are observed on the way.  Rejects, if there are any,
go to a dead-letter table.  A commit file then makes the segment count
(see ``commits``), so readers see a micro-batch whole or not at all, and
a batch replayed after a failure replaces its partial output or, when it
was committed, is passed over.

A reset starts the root's next generation in one step and loads it from
the earliest offset; what is older no longer counts and is deleted
afterwards.  A reset that dies anywhere is finished by the next run.
All loaders of a root follow its generation: one that still runs stops
with ``Superseded``, and its next run loads the new generation from the
earliest offset.

``compact`` rewrites the segments of many micro-batches as few files and
swaps them in one step.
"""

from __future__ import annotations

import hashlib
import json
import logging
import os
import re
import time
import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas as S
from ..functions import scalars as X
from ..operators import changes as C
from ..plans.materialize import materialize, new_folder, remove
from . import commits as K

log = logging.getLogger(__name__)

REJECTS_TABLE = "_rejects"
PROGRESS_TABLE = "_progress"
# mapping value that names every bronze table after its topic
BY_TOPIC = "by_topic"
TABLE_COL = "table_name"
BATCH_COL = "_batch_id"
# Drain caps of the batch and reset modes (messages, seconds).
BATCH_DRAIN = (3500, 60)
RESET_DRAIN = (5000, 120)
#: Buckets of offsets counted in one pass when a message bound cuts a topic partition.
BUCKETS = 1024

REJECTS = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("raw_data", T.StringType()),
    T.StructField("_kafka_offset", T.LongType()),
    T.StructField("_kafka_partition", T.IntegerType()),
    T.StructField("reason", T.StringType()),
    T.StructField(BATCH_COL, T.StringType()),
])


# --- sources -----------------------------------------------------------------

def read_changes(spark: SparkSession, topics=None, pattern: str | None = None, streaming: bool = True,
                 options: dict | None = None, path: str | None = None, fmt: str = "kafka",
                 max_per_trigger: int | None = None, evolve: bool = False) -> DataFrame:
    """Change-log frame from Kafka (``fmt='kafka'``) or from files with the same columns.

    Kafka: subscribe to ``topics`` (or ``pattern``) from the earliest
    offset; key and value arrive as text.  Files (``fmt='parquet'`` or
    ``'json'``): the folder holds change-log rows; topic selection is a
    filter.  ``max_per_trigger`` caps one micro-batch: offsets on Kafka
    (``maxOffsetsPerTrigger``), files on a file source
    (``maxFilesPerTrigger``).  ``evolve`` also takes columns that the
    files have beyond the change log's own, as they are when the run
    starts; the loader carries them to bronze (B8).
    """
    opts = dict(options or {})
    if max_per_trigger and streaming and fmt != "kafka":
        opts["maxFilesPerTrigger"] = str(max_per_trigger)
    if fmt == "kafka":
        reader = spark.readStream if streaming else spark.read
        reader = reader.format("kafka")
        for k, v in kafka_options(topics, pattern, max_per_trigger if streaming else None, opts).items():
            reader = reader.option(k, v)
        df = reader.load().select(
            F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
            "topic", "partition", "offset", "timestamp", "headers")
        return df
    reader = spark.readStream if streaming else spark.read
    reader = reader.schema(changelog_schema(spark, path, fmt) if evolve else S.CHANGELOG).format(fmt)
    for k, v in opts.items():
        reader = reader.option(k, v)
    df = reader.load(path)
    if pattern:
        df = C.select_topics(df, pattern)
    elif topics:
        df = C.select_collections(df, topics)
    return df


def changelog_schema(spark: SparkSession, path: str, fmt: str) -> T.StructType:
    """The change log's columns and whatever further ones the files hold now."""
    found = spark.read.format(fmt).option("mergeSchema", "true").load(path).schema
    known = {n.lower() for n in S.CHANGELOG.fieldNames()}
    return T.StructType([*S.CHANGELOG.fields, *(f for f in found.fields if f.name.lower() not in known)])


def kafka_options(topics=None, pattern: str | None = None, max_per_trigger: int | None = None,
                  extra: dict | None = None) -> dict:
    """Kafka source options: the subscription, earliest start, headers (they carry ``__op``), optional micro-batch cap."""
    out = {"startingOffsets": "earliest", "includeHeaders": "true"}
    if pattern:
        out["subscribePattern"] = pattern
    else:
        names = [t if "." in t else S.topic_of(t) for t in (topics or S.TOPIC_TABLES)]
        out["subscribe"] = ",".join(names)
    if max_per_trigger:
        out["maxOffsetsPerTrigger"] = str(max_per_trigger)
    out.update(extra or {})
    return out


# --- classification ---------------------------------------------------------

def reject_reason(is_object: Column, deleted: Column, mapping: dict[str, str] | str | None = None) -> Column:
    """Why a change-log row does not reach bronze; NULL when accepted.

    ``is_object`` and ``deleted`` tell of the message whether it is a
    JSON object and flagged as deleted.  ``empty`` (tombstone or blank) and ``deleted`` (soft delete) are
    silently dropped like the loader does; ``malformed`` (not a JSON
    object) and ``unknown_topic`` (a NULL one too) go to the dead-letter table (B10).
    """
    mapping = mapping or S.TOPIC_TABLES
    v = F.col("value").cast("string")
    known = F.col("topic").isNotNull() if mapping == BY_TOPIC else F.col("topic").isin(list(mapping))
    return (F.when(~F.coalesce(known, F.lit(False)), F.lit("unknown_topic"))
            .when(X.is_blank(v), F.lit("empty"))
            .when(~is_object, F.lit("malformed"))
            .when(deleted, F.lit("deleted")))


def classify(df: DataFrame, mapping: dict[str, str] | str | None = None, lenient: bool = False,
             name: str = "_reason") -> DataFrame:
    """Add the reject reason of every message, parsing each message once."""
    v = F.col("value").cast("string")
    read = C.evaluate_once(df, df.columns, {"_object": X.json_is_object(v), "_gone": X.json_flag(v, "__deleted", lenient)})
    return read.select(*df.columns, reject_reason(F.col("_object"), F.col("_gone"), mapping).alias(name))


def accept(df: DataFrame, lenient: bool = False, mapping: dict[str, str] | str | None = None) -> DataFrame:
    """Rows the loader keeps: non-empty JSON objects not flagged deleted, on a known topic."""
    c = classify(df, mapping, lenient)
    return c.where(F.col("_reason").isNull()).drop("_reason")


def split_rejects(df: DataFrame, mapping: dict[str, str] | str | None = None,
                  lenient: bool = False) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with ``reason``) from one classification."""
    c = classify(df, mapping, lenient, name="reason")
    good = c.where(F.col("reason").isNull()).drop("reason")
    bad = c.where(F.col("reason").isin("malformed", "unknown_topic"))
    return good, bad


def to_bronze(df: DataFrame, ingested_at=None, keep_key: bool = False, with_table: bool = False,
              mapping: dict[str, str] | None = None, extra: T.StructType | None = None) -> DataFrame:
    """Change-log rows -> bronze rows: raw text, ingest second, offset, partition.

    ``keep_key`` adds the message key, the ``__op`` header and the
    message time (needed to apply deletes and to read unwrapped events); ``with_table`` adds the
    target table of each row's topic (B3), or the topic itself with
    ``mapping=BY_TOPIC`` (B7).  ``extra`` names further columns of the
    change log that go along, with their types (B8).
    """
    ts = (F.date_trunc("second", F.current_timestamp()) if ingested_at is None
          else X.as_timestamp(ingested_at))
    cols = [F.col("value").cast("string").alias("raw_data"), ts.alias("_kafka_timestamp"),
            F.col("offset").cast("bigint").alias("_kafka_offset"),
            F.col("partition").cast("int").alias("_kafka_partition")]
    if keep_key:
        op = C.op_from_header(df) if "headers" in df.columns else F.lit(None).cast("string")
        sent = F.col("timestamp") if "timestamp" in df.columns else F.lit(None)
        cols += [F.col("key").cast("string").alias("_kafka_key"), op.alias("_kafka_op"),
                 sent.cast("timestamp").alias("_message_timestamp")]
    cols += [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in (extra.fields if extra else ())]
    if with_table:
        m = mapping or S.TOPIC_TABLES
        if m == BY_TOPIC:
            table = F.col("topic")
        else:
            table = F.lit(None).cast("string")
            for topic, name in m.items():
                table = F.when(F.col("topic") == topic, F.lit(name)).otherwise(table)
        cols.append(table.alias(TABLE_COL))
    return df.select(*cols)


def route(bronze: DataFrame, mapping: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Split bronze rows (with ``table_name``) into one frame per table."""
    m = mapping or S.TOPIC_TABLES
    if m == BY_TOPIC:
        raise ValueError("route needs an explicit topic -> table mapping")
    return {t: bronze.where(F.col(TABLE_COL) == t).drop(TABLE_COL) for t in m.values()}


def drain(df: DataFrame, max_messages: int, committed: DataFrame | None = None,
          mapping: dict[str, str] | str | None = None) -> DataFrame:
    """The next ``max_messages`` accepted rows by offset (A5, batch form).

    ``committed`` (topic, partition, offset; see ``commit``) says how far
    earlier runs came; runs that each pass on their commits return every
    accepted row once.  Rows are taken by (offset, topic, partition), so
    of each topic partition a run returns the next rows without a gap.
    ``BATCH_DRAIN`` and ``RESET_DRAIN`` hold the caps of the batch and
    reset modes.

    The cap is the feature here (the bounded drain of the batch mode);
    Spark keeps a top-n per task and merges, so no task sees more than
    n rows.
    """
    rows = accept(df, mapping=mapping)
    if committed is not None:
        done = committed.select("topic", "partition", F.col("offset").alias("_done"))
        rows = rows.join(done, ["topic", "partition"], "left").where(
            F.col("_done").isNull() | (F.col("offset") > F.col("_done"))).select(*df.columns)
    return rows.orderBy("offset", "topic", "partition").limit(max_messages)


def commit(drained: DataFrame, committed: DataFrame | None = None) -> DataFrame:
    """(topic, partition, offset): the last offset of each topic partition after a drain."""
    rows = drained.select("topic", "partition", "offset")
    if committed is not None:
        rows = rows.unionByName(committed.select("topic", "partition", "offset"))
    return rows.groupBy("topic", "partition").agg(F.max("offset").alias("offset"))


# --- message bound ---------------------------------------------------------------

_POSITION = {"topic": "", "partition": -1, "offset": -1}  # what stands for a NULL


def _positions(df: DataFrame) -> list[Column]:
    kinds = {"topic": "string", "partition": "int", "offset": "bigint"}
    return [F.coalesce(F.col(c).cast(kinds[c]), F.lit(v)).alias(f"_{c}") for c, v in _POSITION.items()]


def _bounded(df: DataFrame, upto: list[tuple[str, int, int]], inside: bool) -> DataFrame:
    """Rows up to the offsets ``upto`` (topic, partition, offset) or, with ``inside`` false, all others."""
    bounds = df.sparkSession.createDataFrame(upto, "_t string, _p int, _upto bigint")  # one row a topic partition
    rows = df.select("*", *_positions(df))
    at = (F.col("_topic") == F.col("_t")) & (F.col("_partition") == F.col("_p")) & (F.col("_offset") <= F.col("_upto"))
    return rows.join(F.broadcast(bounds), at, "left_semi" if inside else "left_anti").select(*df.columns)


def offset_of_rank(rows: DataFrame, rank: int, low: int, high: int) -> int:
    """The smallest ``_offset`` up to which there are ``rank`` rows, between ``low`` and ``high``.

    Offsets are counted by ranges, then again within the range that
    holds the rank, so each pass brings at most ``BUCKETS`` counts to
    the driver and no task holds or sorts the rows.
    """
    while low < high:
        width = -(-(high - low + 1) // BUCKETS)
        counts = {r["b"]: r["n"] for r in rows.where(F.col("_offset").between(low, high)).groupBy(
            F.expr(f"(_offset - {low}L) div {width}L").alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()}
        before = 0
        for b in sorted(counts):
            if before + counts[b] >= rank:
                rank -= before
                low, high = low + b * width, min(high, low + (b + 1) * width - 1)
                break
            before += counts[b]
        else:
            return high
    return low


def next_offsets(classified: DataFrame, left: int) -> list[tuple[str, int, int]] | None:
    """How far to read each topic partition for ``left`` accepted rows; None if there are no more than that.

    Topic partitions are taken one after another, each by offset, the
    last one up to the offset at which the bound is met.  Rows of one
    topic partition with the same offset stay together, so the rows may
    be more than ``left`` by such rows, and never fewer.
    """
    spark = classified.sparkSession
    folder = new_folder(spark, "offsets")
    rows = materialize(classified.select(*_positions(classified), F.col("_reason").isNull().alias("_good")), "rows", folder)
    try:
        parts = rows.groupBy("_topic", "_partition").agg(F.count_if("_good").alias("n"), F.min("_offset").alias("low"),
                                                         F.max("_offset").alias("high")).collect()  # one row a topic partition
        if sum(p["n"] for p in parts) <= left:
            return None
        out = []
        for p in sorted(parts, key=lambda p: (p["_topic"], p["_partition"])):
            if p["n"] <= left:
                out.append((p["_topic"], p["_partition"], p["high"]))
                left -= p["n"]
                continue
            if left:
                mine = rows.where(F.col("_good") & (F.col("_topic") == p["_topic"]) & (F.col("_partition") == p["_partition"]))
                out.append((p["_topic"], p["_partition"], offset_of_rank(mine, left, p["low"], p["high"])))
            break
        return out
    finally:
        remove(spark, folder)


# --- tables ------------------------------------------------------------------

def bronze_path(root: str, table: str) -> str:
    return os.path.join(root, f"{TABLE_COL}={table}")


def _tables(mapping) -> list[str]:
    m = mapping or S.TOPIC_TABLES
    return list(S.TOPIC_TABLES) if m == BY_TOPIC else list(m.values())


def ensure_bronze(spark: SparkSession, root: str, mapping: dict[str, str] | None = None) -> None:
    """Create empty bronze tables that do not exist yet (B1)."""
    for t in _tables(mapping):
        fs, path = K.fs_of(spark, bronze_path(root, t))
        fs.mkdirs(path)


def read_bronze(spark: SparkSession, root: str, table: str) -> DataFrame:
    """One bronze table: the rows of all segments that count when this is called, with the newest columns."""
    schema = T.StructType([*bronze_schema(spark, root).fields, T.StructField(BATCH_COL, T.StringType())])
    path = bronze_path(root, table)
    rows = spark.read.schema(schema).option("basePath", path).parquet(path)
    return K.only_live(rows, K.live(spark, root), BATCH_COL)


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """The dead-letter table: the rejects of all segments that count."""
    path = os.path.join(root, REJECTS_TABLE)
    if not K.exists(spark, path):
        return spark.createDataFrame([], REJECTS)
    return K.only_live(spark.read.schema(REJECTS).option("basePath", path).parquet(path), K.live(spark, root), BATCH_COL)


def bronze_schema(spark: SparkSession, root: str) -> T.StructType:
    """The bronze columns under this root: those of every table, and what sources have added."""
    return K.schema(spark, root, _first_schema())


def _first_schema() -> T.StructType:
    # StructType.add mutates; build a fresh schema every time
    return T.StructType(list(S.BRONZE.fields) + list(S.BRONZE_OPTIONAL.fields))


def truncate(spark: SparkSession, root: str, mapping: dict[str, str] | None = None) -> int:
    """Empty every bronze table, rejects and progress in one step, then delete the old files (B5); the new generation."""
    g = K.next_generation(spark, root)
    sweep(spark, root)
    ensure_bronze(spark, root, mapping)
    return g


_GENERATION_OF = re.compile(r"-g(\d+)-")


def _segment_folders(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """(segment, folder) of every segment of every table under the root, committed or not."""
    tables = [n for n in K.names(spark, root) if n.startswith(f"{TABLE_COL}=") or n in (REJECTS_TABLE, PROGRESS_TABLE)]
    return [(n.split("=", 1)[1], os.path.join(root, t, n)) for t in tables for n in K.names(spark, os.path.join(root, t)) if n.startswith(f"{BATCH_COL}=")]


def sweep(spark: SparkSession, root: str) -> int:
    """Delete what earlier generations have left; returns the number of folders deleted."""
    g = K.generation(spark, root)
    void = [f for s, f in _segment_folders(spark, root) if (m := _GENERATION_OF.search(s)) and int(m[1]) < g]
    for folder in void:
        K.delete(spark, folder)
    for kind in (K.COMMITS, K.FOLDS):  # last, so that a sweep that dies is done again
        for n in K.names(spark, os.path.join(root, kind)):
            if int(n) < g:
                K.delete(spark, os.path.join(root, kind, n))
    return len(void)


def _unswept(spark: SparkSession, root: str, g: int) -> bool:
    return any(int(n) < g for kind in (K.COMMITS, K.FOLDS) for n in K.names(spark, os.path.join(root, kind)))


# --- compaction --------------------------------------------------------------------

def compact(spark: SparkSession, root: str, everything: bool = False) -> int:
    """Rewrite the segments of the micro-batches since the last compaction as one; returns how many were replaced.

    ``everything`` takes the segments of earlier compactions along.  The
    new files (of about ``spark.sql.adaptive.advisoryPartitionSizeInBytes``)
    are written beside the old ones and swapped in one step, so a reader
    that starts meanwhile has all rows once.  The old files stay, for
    readers that have started, until ``vacuum``.  Micro-batches that a
    message bound has cut are left until they are complete.  Loaders may
    go on writing; of two compactions at the same time one raises
    ``FileExistsError``.
    """
    g = K.generation(spark, root)
    done = K.fold(spark, root, g)
    new = K.open_commits(spark, root, g, done)
    through = dict(done.through)
    for c in new:
        if c["complete"]:
            through[c["loader"]] = max(c["batch_id"], through.get(c["loader"], -1))
    taken = [c for c in new if c["batch_id"] <= through.get(c["loader"], -1)]
    old = [c["segment"] for c in taken] + (list(done.segments) if everything else [])
    if not taken and len(old) < 2:
        return 0
    version = done.version + 1
    segment = f"fold-g{g}-{version:06d}-{uuid.uuid4().hex[:8]}"
    base = bronze_schema(spark, root)
    tables = [os.path.join(root, n) for n in K.names(spark, root) if n.startswith(f"{TABLE_COL}=")]
    rows = (spark.read.schema(T.StructType([*base.fields, T.StructField(TABLE_COL, T.StringType()), T.StructField(BATCH_COL, T.StringType())]))
            .option("basePath", root).parquet(*tables))
    _write(K.only_live(rows, old, BATCH_COL).withColumn(BATCH_COL, F.lit(segment)).hint("rebalance", F.col(TABLE_COL)), root, TABLE_COL, BATCH_COL)
    rejects = os.path.join(root, REJECTS_TABLE)
    if K.exists(spark, rejects):
        bad = spark.read.schema(REJECTS).option("basePath", rejects).parquet(rejects)
        _write(K.only_live(bad, old, BATCH_COL).withColumn(BATCH_COL, F.lit(segment)).hint("rebalance"), rejects, BATCH_COL)
    history = _progress_rows(spark.createDataFrame([tuple(c) for c in taken], K.COMMIT))
    if everything:
        history = history.unionByName(_folded_progress(spark, root, list(done.segments)))
    _write(history.select("*", F.lit(segment).alias(BATCH_COL)).coalesce(1), os.path.join(root, PROGRESS_TABLE), BATCH_COL)
    kept = () if everything else done.segments
    K.write_fold(spark, root, g, K.Fold(version, (*kept, segment), through))
    return len(old)


def vacuum(spark: SparkSession, root: str) -> int:
    """Delete segments that a compaction or a reset has made void; returns how many folders.

    Segments that are not committed yet are left alone, so loaders may
    run; readers that have started before the compaction may not.
    """
    swept = sweep(spark, root)
    g = K.generation(spark, root)
    done = K.fold(spark, root, g)
    void = [r["segment"] for r in K.commits(spark, root, g).collect() if r["batch_id"] <= done.through.get(r["loader"], -1)]
    lost = re.compile(rf"fold-g{g}-(\d+)-")  # of earlier versions, or of compactions that died
    folders = [f for s, f in _segment_folders(spark, root)
               if s in set(void) or (m := lost.match(s)) and int(m[1]) <= done.version and s not in done.segments]
    for folder in folders:
        K.delete(spark, folder)
    for s in void:
        K.delete(spark, K.commit_path(root, g, s))
    return swept + len(folders)


def adopt(spark: SparkSession, root: str) -> int:
    """Make all segments under a root without commits count (one written before there were any); their number."""
    g = K.generation(spark, root)
    if K.fold(spark, root, g).version or K.names(spark, os.path.join(root, K.COMMITS, str(g))):
        raise ValueError("the root has commits")
    found = sorted({s for s, _ in _segment_folders(spark, root)})
    K.write_fold(spark, root, g, K.Fold(1, tuple(found), {}))
    return len(found)


def _write(df: DataFrame, path: str, *partitions: str) -> None:
    """Write partitions; those that are there already are replaced."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path))


def table_stats(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, one global count each, unioned."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def routed_stats(bronze: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Row count per table of bronze rows (with ``table_name``) in one pass (B3, B6); tables without rows count 0."""
    names = bronze.sparkSession.createDataFrame([(t,) for t in _tables(mapping)], f"{TABLE_COL} string")
    counts = bronze.groupBy(TABLE_COL).agg(F.count(F.lit(1)).alias("row_count"))
    return names.join(counts, TABLE_COL, "left").select(TABLE_COL, F.coalesce("row_count", F.lit(0)).alias("row_count"))


# --- streaming ---------------------------------------------------------------

class Superseded(RuntimeError):
    """The root was reset by another loader; the next run loads the new generation from the earliest offset."""


class Reached(Exception):
    """The message bound is met; ends the streaming query without committing the rest of its micro-batch."""


class BatchWriter:
    """foreachBatch function: write bronze, rejects and a commit for each micro-batch, each once.

    ``loader`` names the checkpoint; with generation and batch number it
    names the segment that a replay of the batch replaces.  With
    ``max_messages`` a run ends after so many accepted rows: of the
    micro-batch that passes the bound only the offsets up to it are
    written and committed, and the query ends without the batch counting
    as done, so the next run gets the same batch again and goes on where
    this one stopped.
    """

    def __init__(self, root: str, mapping=None, lenient: bool = False, ingested_at=None, loader: str = "loader",
                 max_messages: int | None = None, generation: int | None = None):
        if max_messages is not None and max_messages < 1:
            raise ValueError("a run takes at least one message")
        self.root, self.mapping, self.lenient, self.ingested_at = root, mapping, lenient, ingested_at
        self.loader, self.max_messages, self.generation = loader, max_messages, generation
        self.accepted, self.reached = 0, False

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        g = K.generation(spark, self.root)
        if self.generation is None:
            self.generation = g
        if g != self.generation:
            raise Superseded(f"the root is at generation {g}, this run began with {self.generation}")
        if K.fold(spark, self.root, g).through.get(self.loader, -1) >= batch_id:
            return
        prefix = f"{self.loader}-g{g}-{batch_id:010d}-"
        parts = K.parts(spark, self.root, g, prefix)
        if any(p["complete"] for p in parts):
            return
        upto: dict[tuple[str, int], int] = {}
        for p in parts:
            for u in p["upto"]:
                key = u["topic"], u["partition"]
                upto[key] = max(u["offset"], upto.get(key, u["offset"]))
        started = time.time()
        if upto:
            batch = _bounded(batch, [(*k, v) for k, v in upto.items()], inside=False)
        classified = classify(batch, self.mapping, self.lenient)
        cut = None
        if self.max_messages is not None:
            if self.accepted >= self.max_messages:
                self.reached = True
                raise Reached(f"{self.accepted} messages")
            cut = next_offsets(classified, self.max_messages - self.accepted)
            if cut is not None:
                classified = _bounded(classified, cut, inside=True)
        segment = f"{prefix}{len(parts)}"
        counts = self._write(classified, segment)
        self.accepted += counts["num_accepted_rows"]
        commit = {"segment": segment, "loader": self.loader, "batch_id": batch_id, "part": len(parts), "complete": cut is None,
                  "upto": [dict(zip(("topic", "partition", "offset"), c)) for c in cut or ()], **counts,
                  "started_at_ms": int(started * 1000), "finished_at_ms": int(time.time() * 1000)}
        K.write_text(spark, K.commit_path(self.root, g, segment), json.dumps(commit))
        if cut is not None:
            self.reached = True
            raise Reached(f"{self.accepted} messages")

    def _write(self, classified: DataFrame, segment: str) -> dict[str, int]:
        """Write the rows; the counts are observed in the same pass."""
        spark = classified.sparkSession
        known = {n.lower() for n in [*S.CHANGELOG.fieldNames(), "_reason"]}
        extra = T.StructType([f for f in classified.schema.fields if f.name.lower() not in known])
        if extra.fields:
            # nothing may take the place of a bronze column
            clash = {n.lower() for n in [*_first_schema().fieldNames(), TABLE_COL, BATCH_COL]} & {f.name.lower() for f in extra.fields}
            if clash:
                raise K.SchemaConflict(f"source columns {sorted(clash)} have the name of a bronze column")
            names = {f.name.lower() for f in extra.fields}
            extra = T.StructType([f for f in K.evolve(spark, self.root, extra, _first_schema()).fields if f.name.lower() in names])
        bad = F.col("_reason").isin("malformed", "unknown_topic")
        seen = Observation()
        observed = classified.observe(seen, F.count(F.lit(1)).alias("num_input_rows"), F.count_if(F.col("_reason").isNull()).alias("num_accepted_rows"),
                                      F.count_if(bad).alias("num_rejected_rows"))
        part = F.lit(segment).alias(BATCH_COL)
        good = to_bronze(observed.where(F.col("_reason").isNull()), self.ingested_at, keep_key=True, with_table=True, mapping=self.mapping, extra=extra)
        _write(good.select("*", part), self.root, TABLE_COL, BATCH_COL)
        counts = {k: int(v or 0) for k, v in seen.get.items()}
        if counts["num_rejected_rows"]:
            rows = classified.where(bad).select(F.col("topic"), F.col("value").cast("string").alias("raw_data"), F.col("offset").alias("_kafka_offset"),
                                                F.col("partition").alias("_kafka_partition"), F.col("_reason").alias("reason"), part)
            _write(rows, os.path.join(self.root, REJECTS_TABLE), BATCH_COL)
        return counts


def batch_writer(root: str, mapping: dict[str, str] | None = None, lenient: bool = False,
                 ingested_at=None, loader: str = "loader", max_messages: int | None = None) -> BatchWriter:
    """The loader's foreachBatch function, for a streaming query of the caller's own."""
    return BatchWriter(root, mapping, lenient, ingested_at, loader, max_messages)


def ingest(changes: DataFrame, root: str, checkpoint: str, mode: str = "batch",
           reset: bool = False, interval: str = "5 seconds",
           mapping: dict[str, str] | None = None, lenient: bool = False, max_messages: int | None = None) -> StreamingQuery:
    """Start the bronze loader on a streaming change log.

    ``mode='batch'`` drains what is available and stops
    (``availableNow``); ``'realtime'`` runs continuously with a
    processing-time trigger.  ``checkpoint`` tracks offsets, so a
    re-run resumes where the last one stopped.  ``max_messages`` ends
    the run after so many accepted messages (more only by rows that share
    the last offset); the next run goes on with the message after them.

    ``reset=True`` empties the root and loads it from the earliest
    offset.  The switch is one step; a reset that dies before or after it
    loses nothing: the next run (with or without ``reset``) deletes what
    is void and loads or goes on.  Several loaders may write to one root
    with checkpoints of their own; a reset by one of them makes each
    other one load from the earliest offset too, at its next run.
    Micro-batch size is a source setting (``read_changes(max_per_trigger=)``).
    """
    spark = changes.sparkSession
    if reset:
        K.next_generation(spark, root)
    now = K.generation(spark, root)
    if reset or _unswept(spark, root, now):
        sweep(spark, root)
    ensure_bronze(spark, root, mapping)
    loader = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]
    writer = BatchWriter(root, mapping, lenient, None, loader, max_messages, now)
    w = changes.writeStream.foreachBatch(writer).option(
        "checkpointLocation", os.path.join(checkpoint, f"generation-{now}") if now else checkpoint)
    if mode == "batch":
        w = w.trigger(availableNow=True)
    elif mode == "realtime":
        w = w.trigger(processingTime=interval)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    query = w.start()
    query.loader = writer
    return query


class Unfinished(TimeoutError):
    """A bounded run was stopped before the source was drained."""


def run_stream(query: StreamingQuery, timeout_s: float | None = None, allow_partial: bool = False) -> StreamingQuery:
    """Wait for a query, stopping it after ``timeout_s`` seconds.

    A query that is stopped by the time bound raises ``Unfinished``
    unless ``allow_partial``; what it had not read stays for the next
    run with its checkpoint.  One that has met its message bound has
    ended as asked.  A query that failed raises its error.
    """
    try:
        if timeout_s is None:
            query.awaitTermination()
        elif not query.awaitTermination(timeout_s):
            query.stop()
            if not allow_partial:
                raise Unfinished(f"stopped after {timeout_s} s; the rest is left to the next run")
    except StreamingQueryException:
        if not _bound_met(query):
            raise
    if query.exception() is not None and not _bound_met(query):
        raise RuntimeError(f"the stream failed: {query.exception()}")
    return query


def run_bounded(changes: DataFrame, root: str, checkpoint: str, reset: bool = False, **options) -> StreamingQuery:
    """One run of the batch mode, or with ``reset`` of the reset mode: until its messages, its time or the source end."""
    messages, seconds = RESET_DRAIN if reset else BATCH_DRAIN
    query = ingest(changes, root, checkpoint, reset=reset, max_messages=messages, **options)
    return run_stream(query, timeout_s=seconds, allow_partial=True)


def _bound_met(query: StreamingQuery) -> bool:
    writer = getattr(query, "loader", None)
    return writer is not None and writer.reached


_HISTORY = "loader string, segment string, batch_id long, num_input_rows long, num_accepted_rows long, num_rejected_rows long, " \
           "started_at timestamp, finished_at timestamp, rows_per_second double"


def _progress_rows(committed: DataFrame) -> DataFrame:
    took = F.greatest(F.col("finished_at_ms") - F.col("started_at_ms"), F.lit(1))
    return committed.select("loader", "segment", "batch_id", "num_input_rows", "num_accepted_rows", "num_rejected_rows",
                            F.timestamp_millis("started_at_ms").alias("started_at"), F.timestamp_millis("finished_at_ms").alias("finished_at"),
                            (F.col("num_input_rows") * 1000 / took).alias("rows_per_second"))


def _folded_progress(spark: SparkSession, root: str, segments: list[str]) -> DataFrame:
    path = os.path.join(root, PROGRESS_TABLE)
    if not segments or not K.exists(spark, path):
        return spark.createDataFrame([], _HISTORY)
    rows = spark.read.schema(f"{_HISTORY}, {BATCH_COL} string").option("basePath", path).parquet(path)
    return K.only_live(rows, segments, BATCH_COL).drop(BATCH_COL)


def progress_table(spark: SparkSession, root: str) -> DataFrame:
    """Per micro-batch (or part of one) of all runs of this generation: rows read, accepted and rejected, when, and rows per second."""
    g = K.generation(spark, root)
    done = K.fold(spark, root, g)
    rows = K.open_commits(spark, root, g, done)
    recent = spark.createDataFrame([tuple(r) for r in rows], K.COMMIT)
    return _progress_rows(recent).unionByName(_folded_progress(spark, root, list(done.segments)))


def rates(progress: DataFrame) -> DataFrame:
    """Per loader: micro-batches, rows and rows per second over the time it spent on them."""
    seconds = F.unix_millis("finished_at") - F.unix_millis("started_at")
    return progress.groupBy("loader").agg(
        F.count(F.lit(1)).alias("num_batches"), F.sum("num_input_rows").alias("num_input_rows"), F.sum("num_accepted_rows").alias("num_accepted_rows"),
        (F.sum("num_input_rows") * 1000 / F.greatest(F.sum(seconds), F.lit(1))).alias("rows_per_second"))
