"""SpotSigs: fingerprints out of chains of content words that follow common-word anchors.

An anchor is one of ``ANCHORS``; its signature is the anchor with the
next ``chain`` words that are no anchors.  A text's fingerprint is the
set of its signatures, so it follows the running text and not lists,
markup or menus around it.  Likeness is the Jaccard coefficient of two
sets.

``near_duplicates`` finds all texts with a likeness of at least a
threshold.  Equal sets are merged first.  Two sets can only be that
alike if their lengths differ little, so sets are partitioned by length
into bands, each met by its own and the next band; within a band, sets
meet through the first signatures of their rarest-first order (the
prefix that two such sets must share).  The sets of one signature are
read as a stream by length; a set is compared only with those whose
length allows the threshold and which are not in its component yet, so a
large group of near copies costs one comparison a member and leaves a
spanning forest, not all its pairs.

``with_next`` gives each document its successor by id.  Documents are
dealt by ranges of ids and sorted there; the first document of each
range is also sent, as a guest, to the end of the range before.

Edge cases: NULL text is empty; a text without an anchor that a content
word follows has its whole word sequence (without words: its characters)
as its one signature; an empty text has the empty set, which is alike (1)
only to itself; equal texts have equal fingerprints; repeated rows are
ordered by text and follow each other; NULL ids come first; a single
document is its own successor; an empty input gives an empty result;
other columns are left behind.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import checkpointed, rows_of, small_batches, text_of
from .components import components

# Frequent function words of English, German, French and Spanish.
ANCHORS = frozenset(
    "the of and to a in is that it was for on with as be by at this are from "
    "der die das und ist von den mit auf ein eine nicht zu des sich "
    "le la les et est que un une dans du pour il pas "
    "el los y se por con del las no su".split())
WORD = re.compile(r"\w+")
#: Characters of text in one range of ids, and most ranges (a task streams its ranges, so more text only takes longer).
RANGE_CHARS, MOST_RANGES = 16 << 20, 4096


def signatures(text: str, chain: int = 2) -> np.ndarray:
    """The fingerprint: sorted distinct 32-bit hashes of the text's signatures."""
    from xxhash import xxh32_intdigest

    content: list[str] = []
    spots: list[tuple[str, int]] = []
    for w in WORD.findall(text.lower()):
        if w in ANCHORS:
            spots.append((w, len(content)))
        else:
            content.append(w)
    n = len(content)
    found = {" ".join((a, *content[at:at + chain])) for a, at in spots if at < n}
    if not found and text:
        found = {" ".join(content) + "\n" + " ".join(a for a, _ in spots) if content or spots else text}
    return np.array(sorted({xxh32_intdigest(s.encode("utf-8", "surrogatepass")) for s in found}), np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard coefficient; 1 for two empty sets."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def as_text(sigs: np.ndarray) -> str:
    """The set as hex digits, 8 a signature."""
    return sigs.astype(">u4").tobytes().hex()


def with_next(docs: DataFrame, fn, schema: str, range_chars: int = RANGE_CHARS) -> DataFrame:
    """``fn(doc_id, text, next_text)`` (a tuple for ``schema``) of every document; after the last comes the first."""
    spark = docs.sparkSession
    small_batches(spark)
    result = StructType.fromDDL(schema)
    texts = text_of(docs, F.col("doc_id").cast("long").alias("doc_id"))
    key = F.struct(F.col("doc_id").isNotNull().alias("known"), F.coalesce("doc_id", F.lit(0)).alias("id"))
    sizes = texts.agg(F.sum(F.length("text")).alias("chars"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = int(min(MOST_RANGES, max(parts, -(-(sizes["chars"] or 0) // range_chars))))
    bounds: list[int] = []
    if ranges > 1 and sizes["low"] is not None:
        cuts = texts.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 100 * ranges).alias("cuts")).first()["cuts"]
        bounds = sorted(set(cuts))  # at most MOST_RANGES numbers
    inside = F.lit(0) if not bounds else F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= F.coalesce("doc_id", F.lit(sizes["low"]))))
    ranged = texts.withColumn("range", inside)
    # first document of each range -> the range before it; the very first also follows the very last; one row a range
    firsts = ranged.groupBy("range").agg(F.min(key).alias("first")).orderBy("range").collect()
    guests = [(r["first"]["known"], r["first"]["id"], firsts[i - 1]["range"], i == 0) for i, r in enumerate(firsts)]
    hosts = spark.createDataFrame(guests, "known boolean, id long, host int, around boolean")
    guest = (ranged.withColumn("k", key).join(F.broadcast(hosts), (F.col("k.known") == F.col("known")) & (F.col("k.id") == F.col("id")))
             .select(F.col("host").alias("range"), F.when(F.col("around"), 2).otherwise(1).alias("turn"), "doc_id", "text"))
    dealt = ranged.select("range", F.lit(0).alias("turn"), "doc_id", "text").union(guest)
    # ranges hold about as many rows each, and neighbouring numbers go to different tasks
    dealt = dealt.repartitionById(parts, (F.col("range") % parts).cast("int")).sortWithinPartitions("range", "turn", "doc_id", "text")

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema
        kinds = to_arrow_schema(result)
        held, closed = None, None  # the document that waits for its successor; the range whose guest has come
        for spans, turns, ids, bodies in rows_of(batches, "range", "turn", "doc_id", "text"):
            out = []
            for span, turn, doc_id, text in zip(spans, turns, ids, bodies):
                if held is not None and span == held[0] and closed != span:
                    out.append(fn(held[1], held[2], text))
                    held = None
                if turn:
                    closed = span
                else:
                    held = (span, doc_id, text)
            columns = zip(*out) if out else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.types)], schema=kinds)

    return dealt.mapInArrow(run, result)


def compare_with_next(docs: DataFrame, chain: int = 2) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness; see ``op6`` in the queries."""
    def one(doc_id, text, after):
        n = len(text)
        cut = n // 4
        edited = text[:n - cut] + after[:cut]
        mine, other, following = signatures(text, chain), signatures(edited, chain), signatures(after, chain)
        return (doc_id, n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), as_text(mine), as_text(other),
                float(likeness(mine, other)), float(likeness(mine, following)), len(mine))

    return with_next(docs, one, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                                "near_edited double, near_next double, n_signatures long")


def fingerprints(docs: DataFrame, chain: int = 2) -> DataFrame:
    """doc_id and sigs (sorted array of long) of every document."""
    small_batches(docs.sparkSession)

    def run(batches):
        import pyarrow as pa

        for ids, texts in rows_of(batches, "doc_id", "text"):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([signatures(t, chain).tolist() for t in texts], pa.list_(pa.int64()))],
                                             ["doc_id", "sigs"])

    return text_of(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(run, "doc_id long, sigs array<long>")


def _links(batches, threshold: float):
    """A spanning forest of the links among the sets of each (band, signature), in rows sorted by both, then length."""
    import pyarrow as pa

    run, window, root = None, [], {}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for ats, sigs, reps, ns, sets in rows_of(batches, "at", "sig", "rep", "n", "o"):
        us, vs = [], []
        for at, sig, rep, n, o in zip(ats, sigs, reps, ns, sets):
            if run != (at, sig):
                run, window, root = (at, sig), [], {}
            mine = np.array(sorted(o), np.int64)
            while window and len(window[0][1]) < threshold * n:
                window.pop(0)
            root[rep] = rep
            for other, theirs in window:
                if find(other) != find(rep) and likeness(theirs, mine) >= threshold:
                    root[find(other)] = find(rep)
                    us.append(other)
                    vs.append(rep)
            window.append((rep, mine))
        yield pa.RecordBatch.from_pydict({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())})


def near_duplicates(docs: DataFrame, threshold: float = 0.8, chain: int = 2) -> DataFrame:
    """doc_id, class_id (smallest doc_id of an equal set) and component_id (smallest reachable by links) of every document."""
    prints = checkpointed(fingerprints(docs, chain).withColumn("key", F.xxhash64("sigs")))
    sets = checkpointed(prints.groupBy("sigs").agg(F.min("doc_id").alias("rep")).where("rep is not null"))
    sized = sets.where(F.size("sigs") > 0).withColumn("n", F.size("sigs"))
    # rarest first, so that the prefixes hold few common signatures
    df = sized.select(F.explode("sigs").alias("sig")).groupBy("sig").agg(F.count("*").alias("df"))
    ordered = (sized.select("rep", "n", F.explode("sigs").alias("sig")).join(df, "sig")
               .groupBy("rep", "n").agg(F.sort_array(F.collect_list(F.struct("df", "sig"))).alias("o"))
               .withColumn("o", F.col("o.sig"))
               .withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.lit(-np.log(threshold) if threshold < 1 else 1e-9)).cast("int")))
    prefix = F.slice("o", F.lit(1), F.col("n") - F.ceil(F.col("n") * F.lit(threshold)).cast("int") + 1)
    ordered = checkpointed(ordered.withColumn("prefix", prefix))
    each = ordered.select("rep", "n", "o", "band", F.explode("prefix").alias("sig"))
    spread = each.select("rep", "n", "o", "sig", F.explode(F.array("band", F.col("band") + 1)).alias("at"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    linked = (spread.repartition(parts, "at", "sig").sortWithinPartitions("at", "sig", "n", "rep")
              .mapInArrow(lambda batches: _links(batches, threshold), "u long, v long").distinct())
    found = components(linked)
    labels = checkpointed(sets.join(found, F.col("rep") == F.col("node"), "left").select("sigs", "rep", F.coalesce("component", "rep").alias("component_id")))
    return prints.drop("key").join(labels, "sigs", "left").select("doc_id", F.col("rep").alias("class_id"), "component_id")
