import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from commerce_lake.llm import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_counts_and_cache(spark, scratch):
    rows = [(1, None), (2, ""), (3, "Hello <|endoftext|> world"), (4, "Hello <|endoftext|> world"), (4, "x" * 5000), (None, "é ö")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n_tokens int")
    cache = f"{scratch}/cache"
    tok = Tokenizer.from_file(PATH)
    want = sorted((str(i), len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)

    def got(frame):
        return sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in token_counts.token_counts(frame, PATH, cache).collect())

    assert got(docs) == want
    assert spark.read.parquet(cache).count() == 4  # distinct contents
    assert got(docs) == want
    assert spark.read.parquet(cache).count() == 4  # nothing new, nothing encoded
    more = docs.union(spark.createDataFrame([(9, "new", 0)], docs.schema))
    assert len(got(more)) == 7 and spark.read.parquet(cache).count() == 5
    assert got(docs.where(F.lit(False))) == []


def test_stored_count_is_used(spark, scratch):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    cache = f"{scratch}/cache"
    token_counts.token_counts(docs, PATH, cache).count()
    changed = spark.read.parquet(cache).withColumn("n_tokens", F.lit(99).cast("long"))
    changed.write.partitionBy("tokenizer").parquet(f"{scratch}/other")
    assert token_counts.token_counts(docs, PATH, f"{scratch}/other").first().n_tokens == 99
