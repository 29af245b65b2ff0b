"""Mixing sources to target weights by Pfair scheduling, in DataFrame and SQL functions only.

Each source's documents, in an order drawn by a hash of their id, are
cut into blocks of characters (a document belongs to the block it starts
in).  A source with share w of the weights gives its block k the release
time floor(k / w) and the deadline ceil((k + 1) / w); in every slot the
released block with the earliest deadline goes next, ties to the first
source by name.  So at any time before a source runs out, what it has
had differs from its share by less than one block, over the whole run
and for any weights.  Slots in which no block is released stay empty.

The schedule is made of blocks, not rows: a block has as many characters
as leave about ``SLOTS`` of them, and ``BLOCK_CHARS`` at least, so the
schedule has at most ``SLOTS`` blocks and one more for each source,
whatever the size of the data.  It is one pass over the blocks, whose
state is the next block of each source; its work grows with blocks times
sources (some thousands of sources at most).  Documents meet it by their
block.  The place of a document in its source is a running sum within
(source, first hex digits of the hash), shifted by the sums of the
digits before, so a source that holds a third of all rows is spread over
4096 groups.

Edge cases: NULL text is empty; every document counts one character at
least; a NULL source is a source of its own; repeated rows each keep
their place; a source without a weight, or with one that is NULL or not
above 0, gets the smallest weight given; an empty input gives an empty
result; no column of the input but doc_id, source and text (or the size
column that is named) is looked at, and those called mix_start,
mix_block, mix_release, mix_deadline or mix_slot are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed

#: Most blocks of a schedule (besides one for each source), and fewest characters of a block.
SLOTS, BLOCK_CHARS = 1 << 16, 1 << 16
#: Schedules of up to so many rows are broadcast; their number is counted first.
MOST_BROADCAST = 1 << 18
PLACES = ("mix_start", "mix_block", "mix_release", "mix_deadline", "mix_slot")

# quotients that rounding has moved off a whole number count as whole
_RELEASE = "cast(floor({k} / x.w + 1e-9 * (1 + {k} / x.w)) as bigint)"
_DEADLINE = "cast(ceil(({k} + 1) / x.w - 1e-9 * (1 + ({k} + 1) / x.w)) as bigint)"


def _next(k: str) -> str:
    return (f"named_struct('d', {_DEADLINE.format(k=k)}, 'i', x.i, 'k', {k}, 'r', {_RELEASE.format(k=k)}, 'w', x.w, 'n', x.n)")


#: One slot: the released block with the earliest deadline; time moves on to the next release where there is none.
_SLOT = f"""
(s, j) -> transform(array(greatest(s.t, array_min(transform(s.left, x -> x.r)))),
  t -> transform(array(array_min(filter(s.left, x -> x.r <= t))),
    b -> named_struct('t', t + 1L, 'left', filter(transform(s.left, x -> if(x.i = b.i, {_next("(x.k + 1L)")}, x)), x -> x.k < x.n),
                      'out', concat(s.out, array(named_struct('i', b.i, 'k', b.k, 'd', b.d, 'r', b.r, 'at', t)))))[0])[0]
"""
_NONE = "array_repeat(named_struct('i', 0, 'k', 0L, 'd', 0L, 'r', 0L, 'at', 0L), 0)"
#: All slots, in runs of 256, so that no long array is built step by step.
SCHEDULE = f"""
flatten(aggregate(
  sequence(0L, (total - 1L) div 256L),
  named_struct('t', 0L, 'left', transform(sources, x -> {_next("0L")}), 'out', array_repeat({_NONE}, 0)),
  (f, run) -> transform(array(aggregate(sequence(1L, least(256L, total - run * 256L)), named_struct('t', f.t, 'left', f.left, 'out', {_NONE}), {_SLOT})),
    s -> named_struct('t', s.t, 'left', s.left, 'out', concat(f.out, array(s.out))))[0]).out)
"""


def source_key(column: str = "source"):
    """The source as a key that keeps NULL apart from every name."""
    return F.when(F.col(column).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(column)))


def tempered_weights(docs: DataFrame, power: float = 0.5) -> DataFrame:
    """(source, weight): each source's characters to a power, which lifts small sources."""
    return docs.groupBy("source").agg(F.pow(F.sum(F.greatest(F.coalesce(F.length("text"), F.lit(0)), F.lit(1))).cast("double"), F.lit(power)).alias("weight"))


def schedule(sizes: DataFrame, weights: DataFrame, block_chars: int) -> DataFrame:
    """(_key, mix_block, mix_release, mix_deadline, mix_slot) of every block; ``sizes``: (_key, _chars) of the sources."""
    given = weights.where("weight > 0").groupBy(source_key().alias("_key")).agg(F.max("weight").cast("double").alias("weight"))
    known = sizes.join(given, "_key", "left")
    listed = known.agg(F.sort_array(F.collect_list(F.struct("_key", "weight", F.expr(f"(_chars - 1L) div {block_chars}L + 1L").alias("n")))).alias("s"),
                       F.coalesce(F.min("weight"), F.lit(1.0)).alias("least")).where(F.size("s") > 0)
    summed = listed.select("s", "least", F.expr("aggregate(s, 0.0D, (a, x) -> a + coalesce(x.weight, least))").alias("sum"),
                           F.expr("aggregate(s, 0L, (a, x) -> a + x.n)").alias("total"))
    ready = summed.select("s", "total", F.expr("transform(s, (x, i) -> named_struct('i', i, 'w', coalesce(x.weight, least) / sum, 'n', x.n))").alias("sources"))
    blocks = ready.select("s", F.explode(F.expr(SCHEDULE)).alias("b"))
    return blocks.select(F.expr("s[b.i]._key").alias("_key"), F.col("b.k").alias("mix_block"), F.col("b.r").alias("mix_release"),
                         F.col("b.d").alias("mix_deadline"), F.col("b.at").alias("mix_slot"))


def mix(docs: DataFrame, weights: DataFrame, block_chars: int | None = None, seed: int = 0, size: str | None = None) -> DataFrame:
    """Adds to every row of ``docs`` (doc_id, source, text, ...) its place in the mix.

    ``mix_start`` (characters before it in its source), ``mix_block``,
    ``mix_release`` and ``mix_deadline`` (slots) and ``mix_slot``: the
    order of the mix is (mix_slot, mix_start).  ``size`` names a column
    that holds the characters of each text, if the caller has one.
    """
    kept = [c for c in docs.columns if c not in PLACES]
    row = F.struct(*(F.col(f"`{c}`") for c in kept)).alias("_row")  # no column of the input can meet a helper's name
    chars = F.length("text") if size is None else F.col(f"`{size}`")
    hashed = docs.select(row, source_key().alias("_key"), F.col("doc_id").alias("_id"), F.greatest(F.coalesce(chars, F.lit(0)), F.lit(1)).cast("long").alias("_size"),
                         F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("_hash"))
    hashed = hashed.withColumn("_part", F.substring("_hash", 1, 3))
    sums = checkpointed(hashed.groupBy("_key", "_part").agg(F.sum("_size").alias("_sum")))
    earlier = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("_key", "_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    if block_chars is None:
        total = sums.agg(F.sum("_sum")).first()[0] or 0
        block_chars = max(BLOCK_CHARS, -(-total // SLOTS))
    slots = checkpointed(schedule(sums.groupBy("_key").agg(F.sum("_sum").alias("_chars")), weights, block_chars))
    if slots.count() <= MOST_BROADCAST:
        slots = F.broadcast(slots)
    inside = Window.partitionBy("_key", "_part").orderBy("_hash", "_id", "_size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (hashed.withColumn("_inside", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
              .join(before, ["_key", "_part"])
              .withColumn("mix_start", F.col("_before") + F.col("_inside"))
              .withColumn("mix_block", F.expr(f"mix_start div {block_chars}L")))
    return placed.join(slots, ["_key", "mix_block"]).select("_row.*", *PLACES)


def in_mixed_order(docs: DataFrame, weights: DataFrame, **options) -> DataFrame:
    """All rows of ``docs`` with their columns, range-partitioned and sorted in the order of the mix."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = mix(docs, weights, **options)
    return placed.repartitionByRange(parts, "mix_slot", "mix_start").sortWithinPartitions("mix_slot", "mix_start").select(
        *(F.col(f"`{c}`") for c in docs.columns))


#: The same in DuckDB over ``documents``, weights by the square root of characters.
ORACLE = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS key,
         greatest(coalesce(length(text), 0), 1)::BIGINT AS size, md5('0:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
chars AS (SELECT greatest(65536, ceil(sum(size) / 65536.0)::BIGINT) AS block FROM d),
w AS (SELECT key, sqrt(sum(size)::DOUBLE) AS weight, ((sum(size)::BIGINT - 1) // (SELECT block FROM chars) + 1)::BIGINT AS n FROM d GROUP BY key),
src AS (SELECT key, row_number() OVER (ORDER BY key) AS i, weight / (SELECT sum(weight) FROM w) AS w, n FROM w),
all_src AS (SELECT list(struct_pack(i := i, w := w, n := n) ORDER BY i) AS l, sum(n)::BIGINT AS total FROM src),
s(step, t, done, i, k, r, d) AS (
  SELECT 0::BIGINT, 0::BIGINT, list_transform(l, lambda x: 0::BIGINT), 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT FROM all_src
  UNION ALL
  SELECT step + 1, now + 1, list_transform(done, lambda x, j: CASE WHEN j = pick.i THEN x + 1 ELSE x END), pick.i, pick.k, pick.r, pick.d
  FROM (SELECT step, done, now, list_min(list_filter(ready, lambda b: b.r <= now)) AS pick
        FROM (SELECT step, done, ready, greatest(t, list_min(list_transform(ready, lambda b: b.r))) AS now
              FROM (SELECT step, t, done, list_filter(list_transform(l, lambda x: struct_pack(
                      d := ceil((done[x.i] + 1) / x.w - 1e-9::DOUBLE * (1 + (done[x.i] + 1) / x.w))::BIGINT, i := x.i, k := done[x.i],
                      r := floor(done[x.i] / x.w + 1e-9::DOUBLE * (1 + done[x.i] / x.w))::BIGINT, n := x.n)), lambda b: b.k < b.n) AS ready
                    FROM s, all_src WHERE step < total)))),
b AS (SELECT doc_id, source, key, coalesce(sum(size) OVER (PARTITION BY key ORDER BY h, doc_id, size
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS mix_start FROM d),
c AS (SELECT *, mix_start // (SELECT block FROM chars) AS mix_block FROM b)
SELECT doc_id, source, mix_start, mix_block, s.r AS mix_release, s.d AS mix_deadline, s.t - 1 AS mix_slot
FROM c JOIN src USING (key) JOIN s ON s.i = src.i AND s.k = mix_block AND s.step > 0
"""
