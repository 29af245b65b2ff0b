import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tests.conftest import SMALL


def test_registered():
    names = entry.queries()
    assert "pipeline" in names and all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11))


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_near_dedup", "pii", "source_mixing", "best_fit_packing"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    extra = docs.withColumn("score", F.lit(1)).withColumn("fp", F.lit("x")).cache()
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    before = extra
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SMALL).cache()
        assert after.columns == extra.columns and 0 < after.count() <= before.count(), name
        assert stage(spark, extra.where(F.lit(False)), SMALL).count() == 0
        before = after
    pieces = corpus_pipeline.pack(spark, before, SMALL)
    per_doc = {r.doc_id: r.n for r in pieces.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert per_doc == {r.doc_id: len(tok.encode(r.text, add_special_tokens=False).ids) + 1 for r in before.collect()}
    # the direct run gives the same pieces
    want = sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in pieces.collect())
    assert sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, SMALL).collect()) == want
