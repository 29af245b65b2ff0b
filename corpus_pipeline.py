"""A corpus preparation pipeline out of the operators of ``commerce_lake.llm``.

Each stage takes what its predecessor wrote.  Languages: documents
without a recognisable language go.  Near-duplicates: of each group of
documents whose SimHash fingerprints over 3-word shingles link at 3 or
fewer differing bits, the one with the smallest id stays.  Personal data: spans are replaced
in the text.  Mixing: the documents are written in the order of the mix,
by the square root of each source's characters.  Packing: the pieces of
the documents in sequences of 1024 tokens, numbered in the order of the mix,
each piece with its document's place in the mix (start, block, release,
deadline and slot).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from commerce_lake.llm import langid, mixing, packing, pii, simhash
from commerce_lake.session import checkpoint_dir

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Target weights of the sources, for the mix and for the order of the packed sequences.
WEIGHTS: Callable[[DataFrame], DataFrame] = mixing.tempered_weights


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.drop_undetermined(docs, PIECES)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_per_group(docs, shingle=3, max_bits=3)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.in_mixed_order(docs, WEIGHTS(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # rows of a table have no order: the place of each document in the mix is worked out again
    placed = mixing.mix(docs, WEIGHTS(docs))
    return packing.pack_in_order(placed, TOKENIZER, capacity=1024, end_id=2, keep=mixing.PLACES)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("pii", personal_data),
    ("source_mixing", source_mix),
    ("best_fit_packing", pack),
]

#: Language identification, near-duplicate groups and token ids are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, each reading what its predecessor wrote to the shared folder."""
    root = os.path.join(checkpoint_dir(spark), "corpus", f"pipeline-{uuid.uuid4().hex}")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return docs
