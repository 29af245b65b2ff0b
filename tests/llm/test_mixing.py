import duckdb
import pytest
from pyspark.sql import functions as F

from commerce_lake.llm import mixing, queries
from tests.conftest import SMALL
from tools.compare import compare_one, register_tables


def docs_of(spark, sizes):
    rows = [(i, s, "x" * n, 0) for i, (s, n) in enumerate(sizes)]
    return spark.createDataFrame(rows, "doc_id long, source string, text string, weight int")


def test_less_than_one_block_from_the_weights(spark):
    docs = docs_of(spark, [("a", 10)] * 600 + [("b", 10)] * 200 + [("c", 10)] * 200 + [(None, 10)] * 60)
    weights = spark.createDataFrame([("a", 5.0), ("b", 3.0), ("c", 1.5), (None, 0.5)], "source string, weight double")
    rows = mixing.mix(docs, weights, block_chars=10).collect()
    assert sorted(r.doc_id for r in rows) == list(range(1060))
    slots = {r.mix_slot: r.source for r in rows}
    assert len(slots) == len(rows)  # one block a slot
    assert all(r.mix_release <= r.mix_slot < r.mix_deadline for r in rows)
    share, had = {"a": 0.5, "b": 0.3, "c": 0.15, None: 0.05}, dict.fromkeys(["a", "b", "c", None], 0)
    last = min(max(s for s, x in slots.items() if x == name) for name in had)  # until the first runs out
    for t in range(last + 1):
        had[slots[t]] += 1
        assert all(abs(had[s] - share[s] * (t + 1)) < 1 for s in share), t


def test_edge_cases(spark):
    docs = docs_of(spark, [("a", 0), ("a", 5000), ("b", 3), ("b", 3)]).union(spark.createDataFrame([(None, None, None, 1), (2, "b", "xxx", 0)], "a long, b string, c string, d int"))
    out = mixing.in_mixed_order(docs, mixing.tempered_weights(docs), block_chars=100)
    assert out.columns == docs.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, docs.collect()))
    none = docs.where(F.lit(False))
    assert mixing.in_mixed_order(none, mixing.tempered_weights(none)).count() == 0
    assert mixing.mix(docs, mixing.tempered_weights(docs).where("source = 'a'"), block_chars=100).count() == 6


@pytest.mark.parametrize("name", ["op8_source_mixing", "op10_warc"])
def test_oracle(spark, name):
    con = duckdb.connect()
    register_tables(con, SMALL)
    status, detail = compare_one(spark, con, name, SMALL)
    assert status == "ok", detail
    assert set(queries.oracle_sql()) <= set(queries.queries())


def deviation(slots, share, until):
    """Largest difference between what a source has had and its share, at any slot before ``until``."""
    worst = 0.0
    for source, w in share.items():
        mine = sorted(t for t, s in slots if s == source and t < until)
        worst = max([worst, *(abs(k - w * t) for k, t in enumerate(mine)), *(abs(k + 1 - w * (t + 1)) for k, t in enumerate(mine))])
    return worst


@pytest.mark.parametrize("share", [{"a": 1 / 3, "b": 2 / 3}, {"a": 0.0001, "b": 0.9999}, {"a": 0.0001, "b": 1 / 3, "c": 2 / 3 - 0.0001}])
def test_deviation_over_many_blocks(spark, share):
    n = 100_000
    sizes = spark.createDataFrame([("=" + s, max(1, int(n * w))) for s, w in share.items()], "_key string, _chars long")
    weights = spark.createDataFrame(list(share.items()), "source string, weight double")
    rows = mixing.schedule(sizes, weights, 1).collect()
    assert len(rows) == sum(max(1, int(n * w)) for w in share.values()) and len({r.mix_slot for r in rows}) == len(rows)
    assert all(r.mix_release <= r.mix_slot < r.mix_deadline for r in rows)
    assert deviation([(r.mix_slot, r._key[1:]) for r in rows], share, n - 2) < 1
    assert sum(r._key == "=a" and r.mix_slot < 30_000 for r in rows) in {int(30_000 * share["a"]) + i for i in (0, 1)}


def test_five_thousand_sources(spark):
    share = {f"s{i}": (1 + i % 7) for i in range(5000)} | {"big": 10_000}
    total = sum(share.values())
    sizes = spark.createDataFrame([("=" + s, 1 + w * 4000 // total) for s, w in share.items()], "_key string, _chars long")
    rows = mixing.schedule(sizes, spark.createDataFrame([(s, float(w)) for s, w in share.items()], "source string, weight double"), 1).collect()
    assert all(r.mix_release <= r.mix_slot < r.mix_deadline for r in rows) and len(rows) > 5000
    assert deviation([(r.mix_slot, r._key[1:]) for r in rows], {s: w / total for s, w in share.items()}, 1200) < 1


def test_columns_with_helper_names(spark):
    docs = docs_of(spark, [("a", 500), ("b", 30)] * 40)
    odd = docs.selectExpr("doc_id", "source", "text", "weight", "7 as size", "'x' as _key", "'y' as _row", "1 as mix_slot", "2 as _size")
    plain = {r.doc_id: r.mix_slot for r in mixing.mix(docs, mixing.tempered_weights(docs), block_chars=100).collect()}
    rows = mixing.mix(odd, mixing.tempered_weights(odd), block_chars=100).collect()
    assert {r.doc_id: r.mix_slot for r in rows} == plain and {(r["size"], r._key, r._row, r._size) for r in rows} == {(7, "x", "y", 2)}
