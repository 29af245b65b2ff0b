"""The registered corpus queries: one per operator, over its whole table, with production parameters."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from . import ann, fim, langid, lm, mixing, packing, periodic, pii, simhash, spotsigs, token_counts, warc, winnow

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the store that driver and executors share."""
    return os.path.join(checkpoint_dir(spark), "corpus", f"{name}-{uuid.uuid4().hex}")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER, capacity=1024, end_id=2)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"), TOKENIZER, shared_folder(spark, "token_cache"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    counts = (F.expr(f"cast(size(filter(pii_spans, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in pii.base_kinds())
    return found.select("doc_id", *counts, F.sha2(pii.listed("pii_spans", pii.base_kinds()), 256).alias("base_sha256"),
                        pii.listed("pii_spans").alias("spans"), F.size("pii_spans").cast("long").alias("n_spans"), (F.size("pii_spans") > 0).alias("has_pii"))


def op6_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.compare_with_next(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return groups.select("doc_id", simhash.fingerprint_hex("fp").alias("fingerprint"), "component_id")


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "source", F.coalesce(F.length("text"), F.lit(0)).alias("size"))
    return mixing.mix(sized, mixing.tempered_weights(docs), size="size").drop("size")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_languages(table(spark, sf_dir, "documents"), PIECES)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(manifest, folder, payloads=False).drop("url", "payload")


def with_loops(docs: DataFrame) -> DataFrame:
    """(doc_id, text): where the crc32 of the id ends in 0, the words from some place on repeat with a period fixed by it."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.filter(F.split("text", periodic.SPACE), lambda x: x != ""))
    split = docs.select("doc_id", "text", words.alias("w"), F.floor(h / 10).alias("g"))
    placed = split.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    a, p = F.col("a"), F.lit(1) + F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.col("g") % 8))
    loop = F.transform("w", lambda x, i: F.when(i < a, x).otherwise(F.get("w", (a + (i - a) % p).cast("int"))))
    return placed.select("doc_id", F.when(a.isNotNull(), F.array_join(loop, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find(with_loops(table(spark, sf_dir, "documents")), min_length=6, min_periods=4)
    best = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), periodic.longest("runs").alias("best"),
                        F.sha2(periodic.listed("runs"), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return best.select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                       F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnow.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), span=10)
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.restore(fim.transform(table(spark, sf_dir, "documents"), seed=7, rate=100, spm_rate=50))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_best_fit_packing, op2_token_counts, op3_nearest_neighbours, op4_lm_scoring, op5_pii, op6_spotsigs,
                            op7_simhash, op8_source_mixing, op9_language_id, op10_warc, op11_periodic_runs, op12_decontamination, op13_fill_in_middle)
}

#: DuckDB statements of the operators that SQL can express.
ORACLES: dict[str, str] = {"op8_source_mixing": mixing.ORACLE, "op10_warc": warc.ORACLE, "op11_periodic_runs": periodic.ORACLE, "op12_decontamination": winnow.ORACLE,
                           "op13_fill_in_middle": fim.ORACLE}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
