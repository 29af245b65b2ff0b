"""Approximate nearest neighbours by an adaptive dimension scan over inverted lists.

Vectors are dealt to lists by the nearest of a few hundred centroids.  A
query probes its nearest lists.  In each, vectors are turned by one
random rotation and scanned in blocks of columns: after each block a
hypothesis test compares the partial distance, scaled to all dimensions,
with the distance to beat, and candidates that fail are given up
without their remaining columns.  What survives is measured exactly, in
double precision, on the original vectors.

Equal vectors are merged first and keep their ``k + 1`` smallest ids
(more can never be among the k nearest of any query), so a vector held
by a third of all rows is one candidate, and queries that share a vector
are searched once.  Large lists are split into chunks, and the queries
of a list too, so no task holds more than ``CHUNK`` of either.

The centroids are fitted on a bounded sample of about ``sample`` vectors; all
vectors are indexed and every query is answered.

Edge cases: vectors that are NULL, zero, or hold NULL or non-finite
components take no part, as query or candidate; vectors of different
lengths are searched apart; NULL ids take no part; a repeated id
counts once; ties go to the smaller id; with fewer than k candidates all
are returned; an empty input gives an empty result; other columns are
left behind.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batches_of, checkpointed

CHUNK = 4096
RESULT = "query_id long, rank int, vec_id long, score double"
#: Columns of one block, and the strictness of the test: candidates within the distance are lost with a chance of about exp(-EPSILON ** 2).
COLUMNS, EPSILON = 16, 2.1


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): v an array of doubles; only rows that take part."""
    big = F.lit(float("inf"))
    v = F.col("v")
    return vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull()
        & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big)), F.lit(False))
        & F.exists(v, lambda x: x != 0))


def k_means(sample: np.ndarray, lists: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(11)
    centres = sample[rng.permutation(len(sample))[:lists]].copy()
    for _ in range(rounds):
        near = nearest(sample, centres, 1)[:, 0]
        for c in range(len(centres)):
            mine = sample[near == c]
            centres[c] = mine.mean(axis=0) if len(mine) else sample[rng.integers(len(sample))]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """The n nearest centres of each row, nearest first."""
    d = (centres * centres).sum(axis=1)[None, :] - 2 * (x @ centres.T)
    if n >= len(centres):
        return np.argsort(d, axis=1, kind="stable")
    some = np.argpartition(d, n - 1, axis=1)[:, :n]
    return np.take_along_axis(some, np.argsort(np.take_along_axis(d, some, axis=1), axis=1, kind="stable"), axis=1)


def rotation(dims: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(13).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def scan(queries: np.ndarray, turned: np.ndarray, ids: np.ndarray, vectors: np.ndarray, blocks: list[np.ndarray], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the k nearest of one chunk: (ids, distances), nearest first, ties to the smaller id.

    ``blocks`` are the rotated vectors in column blocks, each contiguous;
    ``turned`` the rotated queries.  The first rows are measured whole
    and set each query's distance to beat; pairs of a query and one of
    the other rows live on from block to block while they pass the test.
    """
    dims = vectors.shape[1]
    first = min(len(ids), max(4 * k, 64))
    head = np.sqrt(((queries[:, None, :] - vectors[None, :first, :]) ** 2).sum(axis=2))
    rows, cols, found = [np.repeat(np.arange(len(queries)), first)], [np.tile(np.arange(first), len(queries))], [head.ravel()]
    if first < len(ids):
        limit = np.partition(head, min(k, first) - 1, axis=1)[:, min(k, first) - 1] ** 2
        block, part = blocks[0][first:], turned[:, :blocks[0].shape[1]]
        partial = (part ** 2).sum(axis=1)[:, None] - 2 * part @ block.T + (block ** 2).sum(axis=1)[None, :]
        seen = block.shape[1]
        row, col = np.nonzero(partial <= _beaten(limit, seen, dims)[:, None])
        partial = partial[row, col]
        for block in blocks[1:]:
            width = block.shape[1]
            diff = block[first + col] - turned[row, seen:seen + width]
            partial = partial + np.einsum("ij,ij->i", diff, diff)
            seen += width
            keep = partial <= _beaten(limit, seen, dims)[row]
            row, col, partial = row[keep], col[keep], partial[keep]
        diff = vectors[first + col] - queries[row]
        rows.append(row)
        cols.append(first + col)
        found.append(np.sqrt(np.einsum("ij,ij->i", diff, diff)))
    row, col, d = (np.concatenate(x) for x in (rows, cols, found))
    order = np.lexsort((ids[col], d, row))
    row, col, d = row[order], col[order], d[order]
    starts = np.searchsorted(row, np.arange(len(queries) + 1))
    return [(ids[col[a:b][:k]], d[a:b][:k]) for a, b in zip(starts[:-1], starts[1:])]


def _beaten(limit: np.ndarray, seen: int, dims: int) -> np.ndarray:
    """Largest squared partial distance over ``seen`` of ``dims`` rotated columns that may still beat the limit."""
    if seen >= dims:
        return limit * (1 + 1e-9) + 1e-12
    return limit * (seen / dims) * (1 + EPSILON / np.sqrt(seen)) ** 2 + 1e-12


def enough_probes(sample: np.ndarray, centres: np.ndarray, k: int, recall: float, queries: int = 4096, least: int = 32) -> np.ndarray:
    """For each list, the probes with which its queries would find that share of their k nearest within the sample.

    Queries are drawn from the whole sample at random.  A list takes the
    share over the queries that it is home to and, until there are
    ``least``, over those of the lists next to it: in dense places few
    probes are enough, in sparse ones many.
    """
    k = min(k, len(sample) - 1)
    if k < 1:
        return np.ones(len(centres), int)
    drawn = np.random.default_rng(17).permutation(len(sample))[:queries]
    lists, squares = nearest(sample, centres, 1)[:, 0], (sample ** 2).sum(axis=1)
    needed = np.empty((len(drawn), k), int)
    for low in range(0, len(drawn), 256):
        some = drawn[low:low + 256]
        d = squares[None, :] - 2 * sample[some] @ sample.T
        d[np.arange(len(some)), some] = np.inf
        near = lists[np.argpartition(d, k - 1, axis=1)[:, :k]]
        place = np.argsort(nearest(sample[some], centres, len(centres)), axis=1)  # place of each list in a query's order
        needed[low:low + 256] = np.take_along_axis(place, near, axis=1) + 1
    by_home = np.argsort(lists[drawn], kind="stable")
    cuts = np.searchsorted(lists[drawn][by_home], np.arange(len(centres) + 1))
    counts = np.diff(cuts)
    order = nearest(centres, centres, len(centres))
    out = np.empty(len(centres), int)
    for c in range(len(centres)):
        around = order[c][order[c] != c]
        far = int(np.searchsorted(counts[c] + np.cumsum(counts[around]), least)) + 1 if counts[c] < least else 0
        mine = np.concatenate([by_home[cuts[x]:cuts[x + 1]] for x in (c, *around[:far])])
        out[c] = np.quantile(needed[mine], recall, method="higher")
    return out


def search(vectors: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding",
           lists: int | None = None, probes: int | None = None, sample: int = 16384, recall: float = 0.96) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest other rows of each query found.

    ``is_query`` is a condition on the column ``id``.  ``lists``: about
    the square root of the number of vectors, at most 1024; ``probes``:
    for each query's own list as many as reach ``recall`` within the
    sample.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector).withColumn("q", is_query)
    lengths = [r["d"] for r in rows.groupBy(F.size("v").alias("d")).agg(F.count_if("q").alias("asked")).where("asked > 0").orderBy("d").collect()]
    if not lengths:
        return spark.createDataFrame([], RESULT)
    out = None
    for d in lengths:  # nearly always one; vectors of different lengths have no distance
        with batches_of(spark, CHUNK):
            found = _search(rows.where(F.size("v") == d).dropDuplicates(["id"]), k, lists, probes, sample, recall)
        out = found if out is None else out.unionByName(found)
    return out


def _search(rows: DataFrame, k: int, lists: int | None, probes: int | None, sample: int, recall: float) -> DataFrame:
    """``search`` among vectors of one length: (id, v, q)."""
    spark = rows.sparkSession
    # merge equal vectors; the window keeps k + 1 ids of each on the map side already
    ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("id")))
    members = checkpointed(ranked.where(F.col("r") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(
        F.element_at("ids", 1).alias("vid"), "v", "ids"))
    # each query's merged vector; a hot vector meets one row of a table, in a join that can be split
    queries = checkpointed(rows.where("q").select("id", "v").join(members.select("v", "vid"), "v").select(F.col("id").alias("query_id"), "vid"))
    n = members.count()
    # a sample of about that many vectors by a hash of the id; at least one
    few = members.where(F.pmod(F.xxhash64("vid"), F.lit(1_000_000)) < int(1e6 * min(1.0, sample / n)) + 1).select("vid", "v").collect()
    fitted = np.array([r["v"] for r in sorted(few, key=lambda r: r["vid"])] or [members.select("v").first()["v"]], float)
    lists = lists or int(min(1024, max(1, round(np.sqrt(n)))))
    centres = k_means(fitted, min(lists, len(fitted)))
    needed = np.full(len(centres), min(probes, len(centres))) if probes else enough_probes(fitted, centres, k, recall)
    sent = spark.sparkContext.broadcast((centres, rotation(fitted.shape[1])))

    def assign(batches, count):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
                near = nearest(x, sent.value[0], int(count.max()))
                row, place = np.nonzero(np.arange(near.shape[1]) < count[near[:, 0]][:, None])
                raw = [v.tobytes() for v in x]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(row)), pa.array(near[row, place].astype(np.int32)),
                    pa.array([raw[i] for i in row.tolist()], pa.binary())], ["vid", "list", "x"])

    schema = "vid long, list int, x binary"
    index = checkpointed(members.select("vid", "v").mapInArrow(lambda b: assign(b, np.ones_like(needed)), schema))
    asked = members.join(queries.select("vid").distinct(), "vid", "left_semi").select("vid", "v")
    probed = checkpointed(asked.mapInArrow(lambda b: assign(b, needed), schema))
    # how often lists are split: one row a list
    sizes = index.groupBy("list").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    loads = probed.groupBy("list").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("shares"))
    cuts = F.broadcast(sizes.join(loads, "list"))
    index = index.join(cuts, "list").select("vid", "list", "x", F.pmod(F.xxhash64("vid"), "chunks").cast("int").alias("chunk"),
                                            F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"))
    probed = probed.join(cuts, "list").select("vid", "list", "x", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
                                              F.pmod(F.xxhash64("vid"), "shares").cast("int").alias("share"))

    def match(left, right):
        import pyarrow as pa

        qid, vid, score = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
        if left.num_rows and right.num_rows:
            turn = sent.value[1]
            ids, x = left.column("vid").to_numpy(), _matrix(left)
            turned = x @ turn
            blocks = [np.ascontiguousarray(turned[:, c:c + COLUMNS]) for c in range(0, turned.shape[1], COLUMNS)]
            asking, q = right.column("vid").to_numpy(), _matrix(right)
            for at in range(0, len(q), 256):
                some = q[at:at + 256]
                for who, (near, d) in zip(asking[at:], scan(some, some @ turn, ids, x, blocks, k + 1)):
                    qid.append(np.full(len(near), who))
                    vid.append(near)
                    score.append(d)
        return pa.table({"qid": pa.array(np.concatenate(qid)), "vid": pa.array(np.concatenate(vid)), "score": pa.array(np.concatenate(score))})

    by = ("list", "chunk", "share")
    found = index.groupBy(*by).cogroup(probed.groupBy(*by)).applyInArrow(match, "qid long, vid long, score double")
    order = Window.partitionBy("qid").orderBy("score", "vid")
    top = found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
    near = top.join(members.select("vid", "ids"), "vid").select("qid", "score", "ids")
    each = (queries.join(near, F.col("vid") == F.col("qid")).select("query_id", "score", F.explode("ids").alias("vec_id"))
            .where("query_id <> vec_id"))
    last = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return each.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _matrix(table) -> np.ndarray:
    flat = np.frombuffer(b"".join(table.column("x").to_pylist()))
    return flat.reshape(table.num_rows, -1)
