"""Near-duplicates by SimHash fingerprints, linked through an anchor-point covering.

A fingerprint has 64 bits; documents are linked when at most
``max_bits`` = 3 bits differ.  Of two such fingerprints, one 32-bit half
differs in at most one bit.  In each half the anchors are the words of
a covering code: a Hamming [31,26] code word in the low 31 bits and any
top bit.  Its covering radius is 1: each half-word has one *home* anchor
at distance 0 or 1.  A fingerprint is replicated to every anchor within
covering radius plus threshold (1 + 1) of each half, at most 17 of
2**27 anchors, so of two linked fingerprints one meets the other at its
home anchor.  Fingerprints are compared per anchor, homes against all.

Equal fingerprints are merged first (pre-aggregated on the map side), so
a group of copies of any size is one fingerprint.  An anchor's rows are
read as a sorted stream.  A short run of rows of one anchor gives its
pairs; from a longer one only a spanning forest of the links is kept,
so no large group is written out as all pairs.  An anchor with more than
``ANCHOR_ROWS`` fingerprints (a family of near copies can share one) is
split: its fingerprints are dealt into blocks, and every block of homes
meets every block of rows under a key of its own, so a task holds two
blocks at most and many tasks share the work.  Components follow from
the links by star rounds.

Edge cases: NULL and empty texts (and any without a word) have
fingerprint 0 and are linked like any other; repeated rows share their
fingerprint and keep their rows; rows with a NULL id get the smallest
id of the component of their fingerprint, or NULL where no row of that
very fingerprint has one; an empty input gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batches_of, checkpointed, rows_of, small_batches, text_of
from .components import components

SEED = 42
#: Shingles whose bits are counted at a time.
BLOCK = 1 << 15
#: Rows of one run up to which each row is compared with each; longer runs go by blocks.
SHORT_RUN = 32
#: Rows of one anchor, about, over which it is split into blocks of that size.
ANCHOR_ROWS = 1 << 14
#: One fingerprint in so many is counted to find the anchors to split; which are split changes no link.
COUNTED = 16
#: Split anchors that are broadcast; more of them are joined by a shuffle.
MOST_BROADCAST = 100_000
#: Bits of a run's key below the anchor's: the pair of blocks.
PART_BITS = 30
_SYNDROME = [np.uint64(sum(1 << (i - 1) for i in range(1, 32) if i >> k & 1)) for k in range(5)]


def fingerprint(text: str, shingle: int = 3) -> int:
    """SimHash of the text's word shingles, repeats included (signed 64 bits)."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()  # bytes: lower() and split() know ASCII only
    if not words:
        return 0
    if len(words) < shingle:
        hashes = np.array([xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
        hashes = np.fromiter((xxh64_intdigest(g, SEED) for g in grams), np.uint64, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        bits = np.unpackbits(hashes[at:at + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, key: str = "doc_id") -> DataFrame:
    """(key, fp) of every document."""
    small_batches(docs.sparkSession)
    kind = docs.schema[key].dataType

    def hashed(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        for keys, texts in rows_of(batches, key, "text"):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, to_arrow_type(kind)), pa.array([fingerprint(t, shingle) for t in texts], pa.int64())], [key, "fp"])

    return text_of(docs, key).mapInArrow(hashed, f"`{key}` {kind.simpleString()}, fp long")


def home_anchor(half: np.ndarray) -> np.ndarray:
    """The code word (with its top bit) next to each 32-bit word."""
    s = _syndrome(half)
    return half ^ np.where(s > 0, np.uint64(1) << (np.maximum(s, 1) - 1).astype(np.uint64), np.uint64(0))


def _syndrome(half: np.ndarray) -> np.ndarray:
    return sum(((np.bitwise_count(half & m) & 1).astype(np.int64) << k) for k, m in enumerate(_SYNDROME))


def near_anchors(half: np.ndarray) -> np.ndarray:
    """All anchors within 2 bits of each word, home first; column j of row i, unused places hold the home again."""
    home = home_anchor(half)
    s = _syndrome(half)
    out = [home, home ^ np.uint64(1 << 31)]
    out[1] = np.where(np.bitwise_count(out[1] ^ half) <= 2, out[1], home)
    for i in range(1, 32):  # two flips whose columns add up to the syndrome
        j = i ^ s
        two = (s > 0) & (j > i)
        flips = (np.uint64(1) << np.uint64(i - 1)) | (np.uint64(1) << np.where(two, j - 1, 0).astype(np.uint64))
        out.append(np.where(two, half ^ flips, home))
    return np.stack(out, axis=1)


def replicas(distinct: DataFrame) -> DataFrame:
    """(anchor, home, fp, rep): every distinct fingerprint at every anchor near either half."""
    def spread(batches):
        import pyarrow as pa

        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            rep = batch.column(1).to_numpy(zero_copy_only=False)
            for side in range(2):
                half = (fp >> np.uint64(32 * side)) & np.uint64(0xFFFFFFFF)
                near = near_anchors(half)
                keep = np.concatenate([np.ones((len(fp), 1), bool), near[:, 1:] != near[:, :1]], axis=1)
                row, column = np.nonzero(keep)
                anchor = near[row, column].astype(np.int64) | (side << 32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(column == 0), pa.array(fp.view(np.int64)[row]), pa.array(rep[row])],
                    ["anchor", "home", "fp", "rep"])

    return distinct.mapInArrow(spread, "anchor long, home boolean, fp long, rep long")


def _forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """A spanning forest of the links among n rows."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for us, vs in pairs:
        for u, v in zip(us.tolist(), vs.tolist()):
            a, b = find(u), find(v)
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((u, v))
    return out


def links_of_runs(run: np.ndarray, home: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of linked rows, in rows sorted by run."""
    n = len(run)
    starts = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    lengths = np.diff(np.append(starts, n))
    us, vs = [], []
    short = np.repeat(lengths <= SHORT_RUN, lengths)
    for step in range(1, min(SHORT_RUN, int(lengths.max(initial=1)))):
        u = np.flatnonzero((run[:-step] == run[step:]) & short[:-step] & (home[:-step] | home[step:])) if n > step else np.empty(0, np.int64)
        u = u[np.bitwise_count(fp[u] ^ fp[u + step]) <= max_bits]
        us.append(u)
        vs.append(u + step)
    for start, length in zip(starts[lengths > SHORT_RUN], lengths[lengths > SHORT_RUN]):
        mine = fp[start:start + length]
        homes = np.flatnonzero(home[start:start + length])

        def near(homes=homes, mine=mine, length=length):
            for at in range(0, len(homes), max(1, (1 << 20) // length)):
                some = homes[at:at + max(1, (1 << 20) // length)]
                h, x = np.nonzero(np.bitwise_count(mine[some][:, None] ^ mine[None, :]) <= max_bits)
                yield some[h], x

        forest = np.array(_forest(int(length), near()), np.int64).reshape(-1, 2) + start
        us.append(forest[:, 0])
        vs.append(forest[:, 1])
    none = np.empty(0, np.int64)
    return np.concatenate([none, *us]), np.concatenate([none, *vs])


def split_runs(spread: DataFrame, hot: DataFrame) -> DataFrame:
    """(run, home, fp, rep): the rows of each anchor; those of an anchor in ``hot`` (anchor, blocks) by pairs of blocks.

    Of an anchor with k blocks, run (i, j) gets the homes of block i and
    all rows of block j: a home goes to k runs, and so does a row.
    """
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    others = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    part = lambda at, home: F.struct(at.alias("part"), F.lit(home).alias("home"))
    as_row = F.transform(others, lambda i: part(i * F.col("blocks") + mine, False))
    as_home = F.transform(others, lambda j: part(mine * F.col("blocks") + j, True))
    parts = (F.when(F.col("blocks").isNull(), F.array(F.struct(F.lit(0).cast("long").alias("part"), F.col("home"))))
             .when(F.col("home"), F.concat(as_row, as_home)).otherwise(as_row))
    return (spread.join(hot, "anchor", "left").select("anchor", "fp", "rep", F.explode(parts).alias("p"))
            .select(_run(F.col("p.part")), F.col("p.home").alias("home"), "fp", "rep"))


def _run(part: Column) -> Column:
    # parts beyond PART_BITS would share a run, which costs comparisons and loses none
    return F.shiftleft("anchor", PART_BITS).bitwiseOR(F.pmod(part, F.lit(1 << PART_BITS))).alias("run")


def links(distinct: DataFrame, max_bits: int = 3, anchor_rows: int = ANCHOR_ROWS) -> DataFrame:
    """Edges (u, v) between representatives; their components are those of all links of at most 3 bits."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the covering is built for at most 3 differing bits")
    def compare(batches):
        import pyarrow as pa

        def linked(cols):
            run, home, fp, rep = cols
            u, v = links_of_runs(run, home, fp.view(np.uint64), max_bits)
            a, b = rep[u], rep[v]
            pair = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], axis=1)[a != b], axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], ["u", "v"])

        held = None
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            if not len(cols[0]):
                continue
            last = int(np.searchsorted(cols[0], cols[0][-1]))  # the last run may go on in the next batch
            if last:
                yield linked([c[:last] for c in cols])
            held = [c[last:] for c in cols]
        if held is not None and len(held[0]):
            yield linked(held)

    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = distinct.select("fp", "rep").repartition(parts, "fp")
    counted = replicas(dealt.where(F.pmod(F.xxhash64(F.lit(SEED), "fp"), F.lit(COUNTED)) == 0))
    hot = checkpointed(counted.groupBy("anchor").agg(F.ceil(F.count("*") * F.lit(COUNTED) / F.lit(anchor_rows)).alias("blocks")).where("blocks > 1"))
    split = hot.count()
    spread = replicas(dealt)
    if split:
        runs = split_runs(spread, F.broadcast(hot) if split <= MOST_BROADCAST else hot)
    else:
        runs = spread.select(_run(F.lit(0)), "home", "fp", "rep")
    return runs.repartition(parts, "run").sortWithinPartitions("run").mapInArrow(compare, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, key: str = "doc_id") -> DataFrame:
    """(key, fp, component_id): component_id is the smallest key linked, directly or through others."""
    prints = checkpointed(fingerprints(docs, shingle, key))
    reps = checkpointed(prints.groupBy("fp").agg(F.min(key).alias("rep")).where(F.col("rep").isNotNull()))
    with batches_of(docs.sparkSession, 20_000):  # fingerprints, no texts
        linked = components(links(reps, max_bits))
    # a table of its own, so that a hot fingerprint meets it in a join that can be split
    labels = checkpointed(reps.join(linked, F.col("rep") == F.col("node"), "left")
                          .select("fp", F.coalesce("component", "rep").alias("component_id")))
    return prints.join(labels, "fp", "left").select(key, "fp", "component_id")


def fingerprint_hex(fp):
    """16 lowercase hex digits of the fingerprint column."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_per_group(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the one with the smallest doc_id.

    Rows with a NULL id whose fingerprint no other row has stay once for
    each such fingerprint; repeated rows of the smallest id stay once.
    """
    groups = near_duplicates(docs.select("doc_id", "text"), shingle, max_bits)
    kept = (groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .select(F.col("doc_id").alias("id"), F.when(F.col("doc_id").isNull(), F.col("fp")).alias("print")).distinct())
    # whole rows in one column, so that no helper meets a column's name
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").alias("id"))

    def first(some: DataFrame, key) -> DataFrame:
        return some.withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy("row.text"))).where("n = 1").drop("n")

    known = first(rows.where("id is not null").join(kept.where("id is not null").select("id"), "id", "left_semi"), F.col("id"))
    # rows without an id: one for each fingerprint that is kept
    digest = F.xxhash64("row.text")
    unknown = first(rows.where("id is null"), digest)
    prints = fingerprints(unknown.select(F.col("row.text").alias("text"), digest.alias("doc_id")), shingle)
    keep = (prints.join(kept.where("id is null").select(F.col("print").alias("fp")), "fp", "left_semi")
            .groupBy("fp").agg(F.min("doc_id").alias("digest")))
    unknown = unknown.join(keep.select(F.col("digest").alias("_digest")), digest == F.col("_digest"), "left_semi")
    return known.select("row.*").unionByName(unknown.select("row.*"))
