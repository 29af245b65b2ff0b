"""Best-fit packing of tokenised documents into fixed-size sequences.

Bulk-synchronous best-fit decreasing.  Piece lengths and gaps are
integers of at most ``capacity``, so documents sorted by length and
gaps sorted by size are kept as *runs*: (length, number of pieces) and
(gap, range of sequences).  One round takes the longest length still
unplaced, sweeps the gap runs upwards from the successor of that length
(the smallest gap that holds it), and matches the whole run of pieces
to the run of gaps; which piece of the run gets which gap is settled by
rank.  The matched gaps shrink, go back into the sorted runs, and the
next round follows.  A length with no successor opens new sequences.

The rounds see only runs: at most ``capacity`` lengths and, since a
match splits at most one run, a few runs for each length, whatever the
number of documents.  The plan they leave, (length, rank range ->
sequence range, offset), is bounded the same way and is the one thing
that is broadcast.  Rows meet it by their rank among pieces of equal
length.  Ranks are counted within (length, salt) and shifted by the
salts' totals, so a length that holds a third of all pieces is no hot
key.  The result equals one-at-a-time best-fit decreasing in its number
of sequences.

Edge cases: NULL text is empty and still has its end token; equal
texts and repeated rows are packed each for itself; a text with more
tokens than ``capacity`` is cut, all its pieces but the first being
full; an empty input gives an empty result; other columns of the input
are left behind.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, joined, small_batches, text_of
from .tokens import CUT_BYTES, encoder

PIECES = "piece int, start long, length long, ids_crc32 long"
#: Groups of neighbouring places, in which pieces and sequences are numbered.
PLACES = 1024
PLAN = "length long, rank_from long, rank_to long, sequence_from long, per_sequence long, offset_from long"


def tokenised_pieces(docs: DataFrame, path: str, capacity: int, end_id: int, key: str = "doc_id", forget: bool = False) -> DataFrame:
    """The pieces of every document: key, piece, start, length, ids_crc32.

    With ``forget`` a worker gives the memory of its memo back after each
    task, for runs that go on with other work.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[key].dataType

    def cut(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        enc, end = encoder(path), end_id.to_bytes(4, "little")
        for batch in joined(batches, CUT_BYTES):
            keys, texts = (batch.column(batch.schema.get_field_index(c)) for c in (key, "text"))
            out: list[tuple] = []
            for k, coded in zip(keys.to_pylist(), enc.encode_all(texts)):
                ids = memoryview(coded + end)
                n = len(ids) // 4
                start, size = 0, n % capacity or min(n, capacity)
                piece = 0
                while start < n:
                    out.append((k, piece, start, size, zlib.crc32(ids[4 * start:4 * (start + size)])))
                    piece, start, size = piece + 1, start + size, capacity
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], to_arrow_type(kind)), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:])],
                [key, "piece", "start", "length", "ids_crc32"])
        if forget:
            enc.memo.forget()

    return text_of(docs, key).mapInArrow(cut, f"`{key}` {kind.simpleString()}, {PIECES}")


def best_fit_plan(runs: Iterable[tuple[int, int]], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """The rounds over runs (length, count); returns rows of ``PLAN``.

    A plan row says: the pieces of that length with ranks
    [rank_from, rank_to) go, ``per_sequence`` at a time, to the
    sequences from ``sequence_from`` on, from ``offset_from`` on.
    """
    plan: list[tuple[int, int, int, int, int, int]] = []
    sizes: list[int] = []                      # gap sizes, ascending
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap size -> ranges (first sequence, number)
    opened = 0

    def put(size: int, first: int, count: int) -> None:
        if size and count:
            if size not in gaps:
                bisect.insort(sizes, size)
                gaps[size] = []
            gaps[size].append((first, count))

    def match(length: int, rank: int, left: int, gap: int, first: int, count: int) -> int:
        """Pieces of one run into ``count`` equal gaps from ``first`` on; returns the number placed."""
        each = gap // length
        placed = min(left, each * count)
        plan.append((length, rank, rank + placed, first, each, capacity - gap))
        full, rest = divmod(placed, each)
        put(gap - each * length, first, full)
        put(gap - rest * length, first + full, 1 if rest else 0)
        put(gap, first + full + (1 if rest else 0), count - full - (1 if rest else 0))
        return placed

    for length, count in sorted(runs, reverse=True):
        rank = 0
        while rank < count:
            at = bisect.bisect_left(sizes, length)  # the successor of this length among the gaps
            if at < len(sizes):
                gap = sizes.pop(at)
                ranges = gaps.pop(gap)
                while ranges and rank < count:
                    rank += match(length, rank, count - rank, gap, *ranges.pop())
                for first, number in ranges:
                    put(gap, first, number)
            else:
                number = -(-(count - rank) // (capacity // length))
                rank += match(length, rank, count - rank, capacity, opened, number)
                opened += number
    return plan


def pack(pieces: DataFrame, capacity: int, place: tuple[str, ...] = (), salt: Column | None = None) -> DataFrame:
    """Adds sequence_id and offset to rows with a ``length`` of 1 to ``capacity``.

    ``pieces`` must read the same rows each time (a table or a
    checkpoint), as it is read for the counts and again for the ranks.
    Pieces of equal length are ranked by the columns ``place``, if given;
    ``salt`` is then an integer that never falls along them.
    """
    spark = pieces.sparkSession
    keys = [*place, *(c for c in pieces.columns if c != "length" and c not in place)]
    salts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    salted = pieces.withColumn("_salt", (F.pmod(F.xxhash64(*keys), F.lit(salts)) if salt is None else salt).cast("int"))
    totals = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    offsets = checkpointed(totals.withColumn("_before", F.coalesce(
        F.sum("_n").over(Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    counts = offsets.groupBy("length").agg(F.sum("_n").alias("n")).collect()  # at most `capacity` rows
    plan = spark.createDataFrame(best_fit_plan([(r.length, r.n) for r in counts], capacity), PLAN)
    ranked = (salted.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_salt").orderBy(*keys)) - 1)
              .join(offsets.drop("_n"), ["length", "_salt"])
              .withColumn("_rank", F.col("_rank") + F.col("_before")))
    # the plan has a few rows for each length, at most a few thousand for any input
    at = (F.col("r.length") == F.col("p.length")) & (F.col("_rank") >= F.col("rank_from")) & (F.col("_rank") < F.col("rank_to"))
    index = F.col("_rank") - F.col("rank_from")
    return ranked.alias("r").join(F.broadcast(plan.alias("p")), at).select(
        *(F.col(f"r.`{c}`") for c in pieces.columns),
        (F.col("sequence_from") + F.floor(index / F.col("per_sequence"))).cast("long").alias("sequence_id"),
        (F.col("offset_from") + index % F.col("per_sequence") * F.col("r.length")).cast("long").alias("offset"))


def pack_documents(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document."""
    return pack(checkpointed(tokenised_pieces(docs, path, capacity, end_id)), capacity)


def pack_in_order(placed: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, place: tuple[str, str] = ("mix_slot", "mix_start"),
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """As ``pack_documents``, with the sequences numbered by the place of the piece they were opened with.

    ``placed`` has two long columns that order its documents; the first
    is 0 or more.  Pieces of equal length go by place too, so as many
    sequences are opened as without, and they run in that order.  Every
    piece has its document's columns ``keep``, which may be the place.
    """
    more = [c for c in keep if c not in place]
    where = F.struct("doc_id", *place, *more).alias("at")
    cut = tokenised_pieces(placed.select(where, "text"), path, capacity, end_id, "at", forget=True)
    pieces = checkpointed(cut.select("at.doc_id", *(f"at.{c}" for c in place), *(c for c in cut.columns if c != "at"), *(f"at.{c}" for c in more)))
    last = pieces.agg(F.max(place[0])).first()[0] or 0
    group = F.expr(f"{place[0]} * {PLACES}L div {last + 1}L")  # 0 to PLACES - 1
    packed = checkpointed(pack(pieces, capacity, place, group))
    opened = packed.where("offset = 0").select(F.col("sequence_id").alias("_old"), group.alias("_group"), *place)
    counts = {r["_group"]: r["n"] for r in opened.groupBy("_group").agg(F.count("*").alias("n")).collect()}  # at most PLACES rows
    before = placed.sparkSession.createDataFrame([(g, sum(counts[h] for h in counts if h < g)) for g in counts], "_group long, _before long")
    inside = Window.partitionBy("_group").orderBy(*place, "_old")
    numbers = checkpointed(opened.withColumn("_n", F.row_number().over(inside) - 1).join(F.broadcast(before), "_group")
                           .select(F.col("_old").alias("sequence_id"), (F.col("_before") + F.col("_n")).cast("long").alias("_new")))
    out = packed.join(numbers, "sequence_id")
    own = [c for c in packed.columns if c not in {*place, *more}]
    return out.select(*(F.col("_new").alias(c) if c == "sequence_id" else F.col(c) for c in own), *keep)
