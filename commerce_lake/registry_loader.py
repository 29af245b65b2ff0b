"""Registered queries of the bronze loader: every one streams the change log of ``events`` from files.

The change log is written once a query under the shared checkpoint
folder (``Feed``); what the query returns is read from the bronze root
that the loader left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle as O
from . import schemas as S
from .plans.materialize import new_folder
from .session import pin_session
from .sources import fixtures as FX
from .sources.tables import read_table
from .streaming import commits as K
from .streaming import ingest as I

_KEPT = "event_type NOT IN ('error', 'click')"
_ROWS = f"""SELECT {O.EVENTS_TABLE} AS table_name, event_id, CAST(user_id % 4 AS INTEGER) AS partition FROM events WHERE {_KEPT}"""


#: Files of one set, and the bytes of a row group in them: a file is a micro-batch of its own, so
#: their number may not grow with the rows; row groups let all tasks read a part of one file.
FILES, ROW_GROUP = 16, 4 << 20


class Feed:
    """A folder of change-log files, a bronze root and a checkpoint, all new."""

    def __init__(self, spark: SparkSession, sf_dir: str, name: str):
        pin_session(spark)
        self.spark = spark
        base = new_folder(spark, name)
        self.source, self.root, self.checkpoint = f"{base}/changelog", f"{base}/bronze", f"{base}/_checkpoint"
        self.log = FX.changelog_from_events(read_table(spark, sf_dir, "events"))

    def add(self, rows: DataFrame) -> None:
        """Another set of files, as many as there are shuffle partitions but not more than ``FILES``."""
        n = min(FILES, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        rows.repartition(n, "offset").write.mode("append").option("parquet.block.size", ROW_GROUP).parquet(self.source)

    def start(self, files: int | None = None, evolve: bool = False, checkpoint: str | None = None, **options):
        changes = I.read_changes(self.spark, path=self.source, fmt="parquet", max_per_trigger=files, evolve=evolve)
        return I.ingest(changes, self.root, checkpoint or self.checkpoint, **options)

    def load(self, files: int | None = None, **options):
        return I.run_stream(self.start(files, **options))

    def table(self, name: str) -> DataFrame:
        return I.read_bronze(self.spark, self.root, name)

    def rows(self, *columns: str, tables: dict[str, str] | None = None) -> DataFrame:
        """(table_name, event_id, partition) and further columns of all bronze tables."""
        out = None
        for name, t in (tables or {t: t for t in S.TOPIC_TABLES.values()}).items():
            rows = self.table(name).select(F.lit(t).alias("table_name"), F.col("_kafka_offset").alias("event_id"),
                                           F.col("_kafka_partition").alias("partition"), *columns)
            out = rows if out is None else out.unionByName(rows)
        return out


def stream_ingest(s, d):
    """One file a micro-batch until all is loaded; the row count of each table."""
    feed = Feed(s, d, "t1")
    feed.log.write.parquet(feed.source)
    feed.load(1)
    return I.table_stats({t: feed.table(t) for t in S.TOPIC_TABLES.values()})


def drain_resumed(s, d):
    """Runs with a message bound, each going on where the last one stopped, until one ends below it."""
    feed = Feed(s, d, "a5")
    feed.add(feed.log)
    cap = feed.log.count() // 5 + 1
    for _ in range(20):
        if not feed.load(2, max_messages=cap).loader.reached:
            return feed.rows().select("event_id", "partition", F.element_at(F.create_map(
                *(F.lit(x) for topic, t in S.TOPIC_TABLES.items() for x in (t, topic))), F.col("table_name")).alias("topic"))
    raise RuntimeError("the bounded runs do not end")


def reset_resume(s, d):
    """Load a part, reset with another micro-batch size, add the rest, resume: every accepted offset once."""
    feed = Feed(s, d, "a8")
    feed.add(feed.log.where("offset % 3 = 0"))
    feed.load(2)
    feed.load(1, reset=True)
    feed.add(feed.log.where("offset % 3 <> 0"))
    feed.load(2)
    return feed.rows()


def reset_killed(s, d):
    """Resets that die at each of their steps; the runs after them leave every accepted offset once.

    The first dies right after the switch, the second while old files
    are deleted, the third while the new generation is loaded.
    """
    feed = Feed(s, d, "a9")
    feed.add(feed.log.where("offset % 2 = 0"))
    feed.load()
    K.next_generation(s, feed.root)                                  # switched, nothing deleted, nothing loaded
    feed.load()
    K.next_generation(s, feed.root)
    _, folder = I._segment_folders(s, feed.root)[0]
    K.delete(s, folder)                                              # one folder deleted, then dead
    feed.add(feed.log.where("offset % 2 = 1"))
    feed.load(1, reset=True, max_messages=max(1, feed.log.count() // 4))  # a part loaded, then dead
    feed.load()
    return feed.rows()


def superseded_loader(s, d):
    """Two loaders on one root, one of them resets it: the other loads its part anew, all offsets once."""
    feed, other = Feed(s, d, "b13"), Feed(s, d, "b13-other")
    other.root = feed.root
    feed.add(feed.log.where("offset % 2 = 0"))
    other.add(other.log.where("offset % 2 = 1"))
    feed.load()
    other.load()
    feed.load(reset=True)
    other.load()
    return feed.rows()


def compacted(s, d):
    """Many micro-batches, compacted twice; a batch is replayed, the second part comes later: every row once, few files."""
    feed = Feed(s, d, "b4")
    feed.add(feed.log.where("offset % 4 <> 0"))
    writer = feed.load(1).loader
    I.compact(s, feed.root)
    I.vacuum(s, feed.root)
    writer(feed.log.where("offset % 4 <> 0"), 0)                     # a replayed batch is held by the compaction
    feed.add(feed.log.where("offset % 4 = 0"))
    feed.load(1)
    batches = I.progress_table(s, feed.root).count()
    I.compact(s, feed.root, everything=True)
    I.vacuum(s, feed.root)
    segments = len(K.live(s, feed.root))
    return feed.rows().select("*", F.lit(segments).alias("segments"), F.lit(batches > 3).alias("many_batches"))


def evolved(s, d):
    """Three file sets with more columns each, one of which gets wider: all rows land, the earlier ones without them."""
    feed = Feed(s, d, "b8")
    plain, region = F.col("offset") % 3 == 0, F.concat(F.lit("region-"), (F.col("offset") % 5).cast("string"))
    feed.add(feed.log.where(plain))
    feed.load(evolve=True)
    feed.add(feed.log.where("offset % 3 = 1").withColumn("region", region).withColumn("attempt", (F.col("offset") % 7).cast("int")))
    feed.load(evolve=True)
    # a folder of its own, as its files have another type
    feed.source += "-wide"
    feed.add(feed.log.where("offset % 3 = 2").withColumn("attempt", (F.col("offset") % 7 + 10_000_000_000).cast("long")))
    feed.load(evolve=True, checkpoint=f"{feed.checkpoint}-wide")
    return feed.rows("region", "attempt")


def progress_rate(s, d):
    """Rows and micro-batches of a run of several, and whether each batch has a rate."""
    feed = Feed(s, d, "t3")
    feed.add(feed.log)
    feed.load(1)
    p = I.progress_table(s, feed.root)
    return p.agg(F.sum("num_input_rows").alias("num_input_rows"), F.sum("num_accepted_rows").alias("num_accepted_rows"),
                 (F.count(F.lit(1)) > 1).alias("many_batches"),
                 F.bool_and((F.col("rows_per_second") >= 0) & (F.col("finished_at") >= F.col("started_at"))).alias("has_rate"))


def stop_and_resume(s, d):
    """A continuous run over several triggers while files arrive, stopped by a time bound, and resumed."""
    feed = Feed(s, d, "a7")
    feed.add(feed.log.where("offset % 3 = 0"))
    q = feed.start(1, mode="realtime", interval="100 milliseconds")
    q.processAllAvailable()
    feed.add(feed.log.where("offset % 3 = 1"))                        # arrives while the query runs
    q.processAllAvailable()
    I.run_stream(q, timeout_s=0.2, allow_partial=True)
    feed.add(feed.log.where("offset % 3 = 2"))                        # arrives while none runs
    q = feed.start(1, mode="realtime", interval="100 milliseconds")
    I.run_stream(q, timeout_s=0.5, allow_partial=True)               # may stop before all is read
    feed.load()
    return feed.rows()


def topic_tables(s, d):
    """Bronze tables named after their topics."""
    feed = Feed(s, d, "b7")
    feed.add(feed.log)
    feed.load(mapping=I.BY_TOPIC)
    return feed.rows(tables={topic: topic for topic in S.TOPIC_TABLES})


QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {
    "t1_stream_ingest": (stream_ingest, f"SELECT {O.EVENTS_TABLE} AS table_name, count(*) AS row_count FROM events WHERE {_KEPT} GROUP BY 1"),
    "a5_drain_resumed": (drain_resumed, f"""
        SELECT event_id, CAST(user_id % 4 AS INTEGER) AS partition, {O.EVENTS_TOPIC} AS topic FROM events WHERE {_KEPT}"""),
    "a6_a7_stop_and_resume": (stop_and_resume, _ROWS),
    "a8_a9_reset_resume": (reset_resume, _ROWS),
    "a9_reset_killed": (reset_killed, _ROWS),
    "b13_superseded_loader": (superseded_loader, _ROWS),
    "b4_compaction": (compacted, f"SELECT *, CAST(1 AS INTEGER) AS segments, true AS many_batches FROM ({_ROWS})"),
    "b7_topic_tables": (topic_tables, f"""
        SELECT {O.EVENTS_TOPIC} AS table_name, event_id, CAST(user_id % 4 AS INTEGER) AS partition FROM events WHERE {_KEPT}"""),
    "b8_sink_evolution": (evolved, f"""
        SELECT *, CASE WHEN event_id % 3 = 1 THEN 'region-' || (event_id % 5) END AS region,
               CASE event_id % 3 WHEN 1 THEN CAST(event_id % 7 AS BIGINT) WHEN 2 THEN CAST(event_id % 7 + 10000000000 AS BIGINT) END AS attempt
        FROM ({_ROWS})"""),
    "t3_progress_rate": (progress_rate, f"""
        SELECT count(*) AS num_input_rows, count(*) FILTER (WHERE {_KEPT}) AS num_accepted_rows, true AS many_batches, true AS has_rate FROM events"""),
}
