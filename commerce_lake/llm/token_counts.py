"""Token counts through a digest cache.

The cache is a Parquet table of (tokenizer digest, content digest,
token count).  Documents are joined to it by the digest of their
normalised content and the digest of the tokenizer version; one text of
each content that is not there yet is encoded, and its count is
appended.  A later run over the same or overlapping texts encodes only
what is new, and another tokenizer version never meets old counts.

Normalisation only turns NULL into the empty text: any other change
could change the count.

Edge cases: NULL and empty texts have 0 bytes and 0 tokens; repeated
rows and equal texts are encoded once and each keep their row; other
columns of the input are left behind; an empty input gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, rows_of, small_batches, text_of
from .tokens import encoder, version_digest

CACHE_SCHEMA = "content_digest binary, n_tokens long, tokenizer string"


def read_cache(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """Stored counts of one tokenizer version (empty before the first append)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return (spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("tokenizer") == tokenizer)
            # two runs at the same time may both have appended a digest
            .groupBy("content_digest").agg(F.min("n_tokens").alias("n_tokens")))


def encode_misses(texts: DataFrame, known: DataFrame, path: str) -> DataFrame:
    """(content_digest, n_tokens) of the distinct contents that ``known`` lacks."""
    def count(batches):
        import pyarrow as pa

        enc = encoder(path)
        for digests, batch in rows_of(batches, "content_digest", "text"):
            yield pa.RecordBatch.from_pydict({
                "content_digest": pa.array(digests, pa.binary()),
                "n_tokens": pa.array([len(enc.encode(t)) // 4 for t in batch], pa.int64())})

    # first() is pre-aggregated on every map task: copies of a text leave a task once
    distinct = texts.groupBy("content_digest").agg(F.first("text").alias("text"))
    return distinct.join(known, "content_digest", "left_anti").mapInArrow(count, "content_digest binary, n_tokens long")


def token_counts(docs: DataFrame, path: str, cache: str, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row of ``docs``: the keys, content_digest, n_bytes (UTF-8) and n_tokens.

    ``path`` is the tokenizer file on every node, ``cache`` the folder
    of the cache in a store that all nodes share.
    """
    spark = docs.sparkSession
    small_batches(spark)
    version = version_digest(path)
    texts = text_of(docs, *keys).withColumn("content_digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    misses = encode_misses(texts.select("content_digest", "text"), read_cache(spark, cache, version), path)
    misses.withColumn("tokenizer", F.lit(version)).write.mode("append").partitionBy("tokenizer").parquet(cache)
    rows = texts.select(*keys, "content_digest", F.octet_length("text").cast("long").alias("n_bytes"))
    # one count per digest; checkpointed, so the join reads a plain exchange and a hot digest can be split at run time
    stored = checkpointed(read_cache(spark, cache, version))
    return rows.join(stored, "content_digest").select(*keys, "content_digest", "n_bytes", "n_tokens")
