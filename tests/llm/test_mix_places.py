"""What the mix decides of a document comes out with its packed pieces."""

from pyspark.sql import functions as F

import corpus_pipeline
from commerce_lake.llm import mixing
from tests.conftest import SMALL


def test_pieces_hold_the_place_of_their_document(spark):
    rows = [(i, s, "word " * (200 + 37 * i)) for i, s in enumerate(["a", "b", None] * 20)] + [(100, "a", None), (None, "b", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").cache()
    mixed = corpus_pipeline.source_mix(spark, docs, SMALL).cache()
    assert sorted(map(str, mixed.collect())) == sorted(map(str, docs.collect()))  # every document is mixed, none left out
    want = {r.doc_id: tuple(r[c] for c in mixing.PLACES) for r in mixing.mix(docs, mixing.tempered_weights(docs)).collect()}
    pieces = corpus_pipeline.pack(spark, mixed, SMALL)
    got = {r.doc_id: tuple(r[c] for c in mixing.PLACES) for r in pieces.collect()}
    assert got == want and len(got) == len(rows) and len({v[-1] for v in want.values()}) > 1
    # rows come in the order of the mix
    assert [r.doc_id for r in mixed.collect()] == sorted(want, key=lambda d: (want[d][4], want[d][0]))
    assert corpus_pipeline.pack(spark, docs.where(F.lit(False)), SMALL).columns == pieces.columns
