import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commerce_lake import schemas as S
from commerce_lake.streaming import commits as K
from commerce_lake.streaming import ingest as I

TOPIC, TABLE = "mongo.ecom.ecom.orders", "mongo_ecom_orders"


def log(spark, offsets, topic=TOPIC, partition=0, value='{"a": 1}'):
    return spark.createDataFrame([("k", value, topic, partition, o, None, []) for o in offsets], S.CHANGELOG)


def offsets(spark, root, table=TABLE):
    return sorted(r[0] for r in I.read_bronze(spark, root, table).select("_kafka_offset").collect())


def load(spark, src, root, ckpt, files=None, **kw):
    return I.run_stream(I.ingest(I.read_changes(spark, path=src, fmt="parquet", max_per_trigger=files), root, ckpt, **kw), timeout_s=300)


@pytest.fixture
def places(scratch):
    return tuple(os.path.join(scratch, n) for n in ("src", "bronze", "ckpt"))


def test_offset_of_rank_equals_sorting(spark):
    rnd = random.Random(1)
    values = [rnd.choice([rnd.randrange(20), rnd.randrange(10 ** 12), 5]) for _ in range(300)]
    rows = spark.createDataFrame([(v,) for v in values], "_offset long").cache()
    for rank in (1, 2, 50, 299, 300):
        assert I.offset_of_rank(rows, rank, min(values), max(values)) == sorted(values)[rank - 1]


def test_bounded_runs_take_each_message_once(spark, places):
    src, root, ckpt = places
    rows = log(spark, range(40)).unionByName(log(spark, range(30), partition=1)).unionByName(
        log(spark, range(100, 110), value="{bad")).unionByName(log(spark, range(5), topic="other.topic")).unionByName(log(spark, [None, 7], topic=None))
    rows.repartition(3).write.parquet(src)
    seen = 0
    for _ in range(20):
        writer = load(spark, src, root, ckpt, max_messages=11).loader
        now = I.read_bronze(spark, root, TABLE)
        assert now.count() == seen + writer.accepted and (writer.accepted == 11 or not writer.reached)
        seen += writer.accepted
        assert now.select("_kafka_partition", "_kafka_offset").distinct().count() == seen
        if not writer.reached:
            break
    assert seen == 70 and I.read_rejects(spark, root).count() == 17
    assert I.progress_table(spark, root).agg(F.sum("num_input_rows")).first()[0] == rows.count()


def test_rows_of_one_offset_stay_together(spark, places):
    src, root, ckpt = places
    log(spark, [1, 1, 1, 2, 2, 3]).coalesce(1).write.parquet(src)
    sizes = []
    for _ in range(4):
        sizes.append(load(spark, src, root, ckpt, max_messages=1).loader.accepted)
    assert sizes == [3, 2, 1, 0] and offsets(spark, root) == [1, 1, 1, 2, 2, 3]
    with pytest.raises(ValueError):
        I.batch_writer(root, max_messages=0)


def test_bound_across_micro_batches(spark, places):
    src, root, ckpt = places
    for i in range(4):
        log(spark, range(10 * i, 10 * i + 10)).coalesce(1).write.mode("append").parquet(src)
    assert load(spark, src, root, ckpt, 1, max_messages=25).loader.accepted == 25
    assert load(spark, src, root, ckpt, 1, max_messages=15).loader.accepted == 15
    assert offsets(spark, root) == list(range(40))


def test_reset_that_dies_after_the_switch(spark, places):
    src, root, ckpt = places
    log(spark, [1, 2, 3]).write.parquet(src)
    load(spark, src, root, ckpt)
    K.next_generation(spark, root)
    assert offsets(spark, root) == [] and I.progress_table(spark, root).count() == 0
    log(spark, [4, 5]).write.mode("append").parquet(src)
    load(spark, src, root, ckpt)
    assert offsets(spark, root) == [1, 2, 3, 4, 5]
    assert all("-g1-" in s for s, _ in I._segment_folders(spark, root))      # the resumed run has swept


def test_running_loader_is_superseded(spark, places):
    _, root, _ = places
    writer = I.batch_writer(root)
    writer(log(spark, [1]), 0)
    I.truncate(spark, root)
    with pytest.raises(I.Superseded):
        writer(log(spark, [2]), 1)
    assert offsets(spark, root) == []


def test_partial_output_does_not_count(spark, places):
    _, root, _ = places
    writer = I.batch_writer(root)
    writer(log(spark, [1]), 0)
    writer._write(I.classify(log(spark, [2])), "loader-g0-0000000001-0")       # dies before its commit
    assert offsets(spark, root) == [1]
    I.vacuum(spark, root)                                                        # may be under way: left alone
    assert len(I._segment_folders(spark, root)) == 2
    writer(log(spark, [2]), 1)
    assert offsets(spark, root) == [1, 2]


def test_compaction(spark, places):
    _, root, _ = places
    writer = I.batch_writer(root)
    for i in range(5):
        writer(log(spark, [i]).unionByName(log(spark, [100 + i], value="{bad")), i)
    before = I.read_bronze(spark, root, TABLE)
    assert I.compact(spark, root) == 5 and I.compact(spark, root) == 0
    assert before.count() == 5                                                   # a reader that has started keeps its files
    assert offsets(spark, root) == list(range(5)) and I.read_rejects(spark, root).count() == 5
    assert I.vacuum(spark, root) == 10 and I.vacuum(spark, root) == 0
    writer(log(spark, [3]), 3)                                                   # replayed: passed over
    writer(log(spark, [5]), 5)
    assert offsets(spark, root) == list(range(6)) and len(K.live(spark, root)) == 2
    assert I.compact(spark, root, everything=True) == 2 and len(K.live(spark, root)) == 1
    I.vacuum(spark, root)
    assert offsets(spark, root) == list(range(6)) and I.read_rejects(spark, root).count() == 5
    p = I.progress_table(spark, root)
    assert p.count() == 6 and p.agg(F.sum("num_input_rows")).first()[0] == 11 and p.where("rows_per_second is null").count() == 0
    assert I.rates(p).first()["num_batches"] == 6


def test_compaction_leaves_cut_batches_and_meets_another(spark, places):
    src, root, ckpt = places
    log(spark, range(10)).coalesce(1).write.parquet(src)
    load(spark, src, root, ckpt, max_messages=4)
    assert I.compact(spark, root) == 0
    load(spark, src, root, ckpt)
    done = K.fold(spark, root, 0)
    assert I.compact(spark, root) == 2 and offsets(spark, root) == list(range(10))
    with pytest.raises(FileExistsError):                                         # one that began before, and ends after
        K.write_fold(spark, root, 0, K.Fold(done.version + 1, (), {}))
    load(spark, src, root, ckpt)
    assert offsets(spark, root) == list(range(10))


def test_compaction_that_died_is_cleaned_up(spark, places, monkeypatch):
    _, root, _ = places
    writer = I.batch_writer(root)
    for i in range(2):
        writer(log(spark, [i]), i)

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(K, "write_fold", dies)
        with pytest.raises(KeyboardInterrupt):
            I.compact(spark, root)
    assert offsets(spark, root) == [0, 1]
    I.compact(spark, root)
    I.vacuum(spark, root)
    assert offsets(spark, root) == [0, 1]
    assert {s for s, _ in I._segment_folders(spark, root)} == set(K.live(spark, root))


def test_schema_evolution(spark, places):
    _, root, _ = places
    writer = I.batch_writer(root)
    writer(log(spark, [0]), 0)
    writer(log(spark, [1]).withColumn("Region", F.lit("x")).withColumn("n", F.lit(1)), 1)
    writer(log(spark, [2]).withColumn("n", F.lit(2).cast("long")), 2)
    writer(log(spark, [3]).withColumn("n", F.lit(3)).withColumn("region", F.lit("y")), 3)   # narrower and in other case
    got = {r["_kafka_offset"]: (r["Region"], r["n"]) for r in I.read_bronze(spark, root, TABLE).collect()}
    assert got == {0: (None, None), 1: ("x", 1), 2: (None, 2), 3: ("y", 3)}
    assert dict(I.read_bronze(spark, root, TABLE).dtypes)["n"] == "bigint"
    with pytest.raises(K.SchemaConflict):
        writer(log(spark, [4]).withColumn("n", F.lit("text")), 4)
    with pytest.raises(K.SchemaConflict):
        writer(log(spark, [4]).withColumn("raw_data", F.lit("text")), 4)
    I.compact(spark, root)
    I.vacuum(spark, root)
    assert {r["_kafka_offset"]: (r["Region"], r["n"]) for r in I.read_bronze(spark, root, TABLE).collect()} == got
    assert K.merged(T.StructType([T.StructField("a", T.FloatType())]), T.StructType([T.StructField("A", T.DoubleType())])).simpleString() == "struct<a:double>"


def test_adopt_a_root_without_commits(spark, places):
    _, root, _ = places
    b = I.to_bronze(log(spark, [1, 2]), keep_key=True, with_table=True).withColumn(I.BATCH_COL, F.lit("old-0000000000"))
    b.write.partitionBy(I.TABLE_COL, I.BATCH_COL).parquet(root)
    assert offsets(spark, root) == []
    assert I.adopt(spark, root) == 1 and offsets(spark, root) == [1, 2]
    with pytest.raises(ValueError):
        I.adopt(spark, root)


def test_bounded_modes(spark, places, monkeypatch):
    src, root, ckpt = places
    log(spark, range(12)).coalesce(1).write.parquet(src)
    monkeypatch.setattr(I, "BATCH_DRAIN", (5, 100))
    monkeypatch.setattr(I, "RESET_DRAIN", (7, 100))

    def run(**kw):
        return I.run_bounded(I.read_changes(spark, path=src, fmt="parquet"), root, ckpt, **kw).loader.accepted

    assert [run(), run(), run()] == [5, 5, 2] and offsets(spark, root) == list(range(12))
    assert run(reset=True) == 7 and offsets(spark, root) == list(range(7))
    assert run() == 5 and offsets(spark, root) == list(range(12))
