"""A log-bilinear neural language model, trained with noise-contrastive estimation.

Outputs of the model are *classes*: the end of a text, each of the
``n_words`` most frequent training words, and a few shape classes that
all other words fall into by their form alone.  The score of class w
after words w1, w2 is (E1[w1] + E2[w2]) . Q[w] + b[w]; the probability
is its softmax over all classes, from batched matrix products.  A word
of a shape class gets the class's probability times its smoothed share
(c + 1) / (N_class + V_class + 1) in it, where all unseen words of the
class share one place, as in the add-one base score; so the whole is
normalised over the open vocabulary.

Counts come from all training documents (one shuffle of pre-aggregated
counts).  The ``lexicon`` words of highest count travel with the model
(a fixed bound; of the words of equal count at its edge a share by their
hash); words beyond it are joined to their counts in a shuffle, whatever
their number.  Training is data-parallel: documents are dealt to *lanes*
by a hash of id and text, as many as the training tokens ask for.  Every
lane runs one epoch of NCE with AdaGrad in numpy over its documents, in
the order of the hash, from the same start, and the parameters are
averaged, weighted by tokens; first over a sixteenth of the training
documents, then over all.  So the model follows from the rows alone, not
from how Spark has partitioned them.

Edge cases: NULL and empty texts are one end token; a NULL doc_id is
never held out; repeated rows are scored (and counted) each for itself;
an empty training part leaves N = V = 0 and a uniform model; an empty
input gives an empty result; other columns are left behind.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.materialize import materialize
from .common import SPACES, crc32_mod, joined, small_batches, text_of, utf8_of

SHAPES = 32
LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
#: Distinct words counted in a task before they are passed on.
COUNTED = 300_000
#: Training tokens of a lane, and most lanes (beyond that, lanes get longer).
LANE_TOKENS, MOST_LANES = 2_000_000, 16_384


@dataclass
class Model:
    """Words, counts and parameters; everything here is bounded by n_words and lexicon."""

    lexicon: list[bytes]              # by falling count
    counts: np.ndarray                # of the lexicon
    end_count: int
    n: int                            # training tokens
    v: int                            # distinct training tokens
    shape_n: np.ndarray               # tokens and words of the shape classes
    shape_v: np.ndarray
    n_words: int
    dim: int
    params: dict[str, np.ndarray] = field(default_factory=dict)
    made: dict = field(default_factory=dict, repr=False)  # by a worker, whose later tasks get the same copy of a broadcast model

    def indexer(self) -> Indexer:
        if "indexer" not in self.made:
            self.made["indexer"] = Indexer(self)
        return self.made["indexer"]

    def scorer(self) -> Scorer:
        if "scorer" not in self.made:
            self.made["scorer"] = Scorer(self)
        return self.made["scorer"]

    @property
    def classes(self) -> int:
        return 1 + self.n_words + SHAPES


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of some texts, the number of each word among them, and how many words stand before each text (and after all).

    Words are runs of other than ASCII white space, A-Z lower-cased.
    """
    data, starts = utf8_of(texts)
    inside = ~SPACES[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    first = starts[:-1][starts[:-1] < starts[1:]]
    begin[first] = inside[first]
    letters = LOWER[data[inside]]
    offsets = np.append(np.flatnonzero(begin[inside]), len(letters)).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), np.searchsorted(np.flatnonzero(begin), starts)


def shape(word: bytes) -> int:
    """Shape class of a word: how it ends, how long it is, whether it has letters beyond ASCII."""
    return int(shapes(pa.array([word], pa.large_binary()))[0])


def shapes(words: pa.Array) -> np.ndarray:
    """Shape classes of words, none of them empty."""
    if not len(words):
        return np.zeros(0, np.int32)
    whole = words.cast(pa.large_binary())
    _, offsets, data = whole.buffers()
    at = np.frombuffer(offsets, np.int64, len(whole) + 1, 8 * whole.offset)
    data = np.frombuffer(data, np.uint8)[at[0]:at[-1]]
    at = at - at[0]
    last = data[at[1:] - 1]
    end = np.select([(last >= 128) | ((last >= 97) & (last <= 122)), last == 46, last == 44], [0, 1, 2], 3)
    size = np.searchsorted([4, 8, 12], np.diff(at))
    return (end * 8 + size * 2 + np.maximum.reduceat(data, at[:-1]) // 128).astype(np.int32)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, shape, n) over all texts; the end of a text is counted by the caller."""
    def count(batches):
        def out(counted: pa.Table):
            word = counted.column("word").combine_chunks()
            return pa.RecordBatch.from_arrays([word, pa.array(shapes(word)), counted.column("n_sum").combine_chunks()], ["word", "shape", "n"])

        held, rows = [], 0
        for batch in joined(batches):
            words, index, _ = words_of(batch.column("text"))
            held.append(pa.table({"word": words.cast(pa.binary()), "n_sum": np.bincount(index, minlength=len(words))}))
            rows += len(words)
            if rows > 2 * COUNTED:
                held = [summed(held)]
                rows = held[0].num_rows
                if rows > COUNTED:
                    yield out(held[0])
                    held, rows = [], 0
        if rows:
            yield out(summed(held))

    def summed(held):
        tables = pa.concat_tables(held).rename_columns(["word", "n"])
        return tables.group_by("word", use_threads=False).aggregate([("n", "sum")])

    partial = docs.select("text").mapInArrow(count, "word binary, shape int, n long")
    return partial.groupBy("word", "shape").agg(F.sum("n").alias("n"))


def gather(train: DataFrame, n_words: int, lexicon: int, dim: int) -> tuple[Model, DataFrame]:
    """The untrained model, and the table of all counts."""
    counts = materialize(word_counts(train), "lm-counts")
    ends = train.count()
    total = counts.agg(F.sum("n"), F.count("*")).first()
    # the count at which the words become more than `lexicon`; there are far fewer distinct counts than words
    reach, edge, share = 0, 0, 0.0
    for r in counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).limit(lexicon).collect():
        if reach + r["words"] > lexicon:  # of these words as many as there is room for, by their hash
            edge, share = r["n"], (lexicon - reach) / r["words"]
            break
        reach += r["words"]
    chosen = (F.col("n") > edge) | ((F.col("n") == edge) & (F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(share * (1 << 20))))
    top = counts.where(chosen).collect()  # about `lexicon` rows at most
    top.sort(key=lambda r: (-r["n"], bytes(r["word"])))
    n_words = min(n_words, len(top))
    by_shape = {r["shape"]: r for r in counts.groupBy("shape").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    shape_n = np.array([by_shape[s]["n"] if s in by_shape else 0 for s in range(SHAPES)], np.int64)
    shape_v = np.array([by_shape[s]["v"] if s in by_shape else 0 for s in range(SHAPES)], np.int64)
    for r in top[:n_words]:  # the words that are classes of their own
        shape_n[r["shape"]] -= r["n"]
        shape_v[r["shape"]] -= 1
    model = Model([bytes(r["word"]) for r in top], np.array([r["n"] for r in top], np.int64), ends, (total[0] or 0) + ends,
                  total[1] + (ends > 0), shape_n, shape_v, n_words, dim)
    rng = np.random.default_rng(7)
    c = model.classes
    model.params = {k: (rng.standard_normal((c, dim)) * 0.1).astype(np.float32) for k in ("e1", "e2", "q")}
    model.params["b"] = np.log(noise(model)).astype(np.float32)
    return model, counts


def noise(model: Model) -> np.ndarray:
    """Unigram distribution over the classes."""
    n = np.concatenate([[model.end_count], model.counts[:model.n_words], model.shape_n]) + 1.0
    return n / n.sum()


class Indexer:
    """Class of each token of a text."""

    def __init__(self, model: Model):
        self.model = model
        self.index = {w: i for i, w in enumerate(model.lexicon)}
        lex_shape = shapes(pa.array(model.lexicon, pa.large_binary()))
        self.lex_class = np.arange(1, len(model.lexicon) + 1, dtype=np.int32)
        self.lex_class[model.n_words:] = 1 + model.n_words + lex_shape[model.n_words:]

    def positions(self, words: pa.Array) -> np.ndarray:
        """Places in the lexicon, -1 beyond it."""
        get = self.index.get
        return np.fromiter((get(w, -1) for w in words.to_numpy(zero_copy_only=False)), np.int32, len(words))

    def classes(self, words: pa.Array, at: np.ndarray) -> np.ndarray:
        """Classes of the words."""
        out = (1 + self.model.n_words + shapes(words)).astype(np.int32)
        known = at >= 0
        out[known] = self.lex_class[at[known]]
        return out


def with_ends(classes: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes of texts one after another with the end after each, and where each text begins there (with the end of the last)."""
    texts = len(before) - 1
    out = np.zeros(len(classes) + texts, np.int32)
    out[np.arange(len(classes)) + np.repeat(np.arange(texts), np.diff(before))] = classes
    return out, before + np.arange(texts + 1)


def contexts(tokens: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes one and two places before each token; the end class stands before a text, as after the one before it."""
    one, two = np.zeros_like(tokens), np.zeros_like(tokens)
    one[1:], two[2:] = tokens[:-1], tokens[:-2]
    two[starts[:-1]] = 0
    return one, two


def _rows_added(index: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Sum of rows by index."""
    order = np.argsort(index.astype(np.uint16) if size <= 1 << 16 else index, kind="stable")  # small integers are sorted by their digits
    sorted_index = index[order]
    starts = np.flatnonzero(np.concatenate([[True], sorted_index[1:] != sorted_index[:-1]]))
    out = np.zeros((size, rows.shape[1]), np.float32)
    out[sorted_index[starts]] = np.add.reduceat(rows[order], starts, axis=0)
    return out


class Trainer:
    """NCE over minibatches, AdaGrad steps."""

    def __init__(self, model: Model, samples: int, rate: float, seed: int):
        self.p = {k: x.copy() for k, x in model.params.items()}
        self.sums = {k: np.full_like(x, 1e-2) for k, x in self.p.items()}
        self.noise = noise(model)
        self.log_kn = np.log(self.noise * samples).astype(np.float32)
        self.cumulative = np.cumsum(self.noise)
        self.samples, self.rate, self.rng = samples, rate, np.random.default_rng(seed)

    def step(self, one: np.ndarray, two: np.ndarray, target: np.ndarray) -> None:
        p, size = self.p, len(self.noise)
        drawn = np.minimum(np.searchsorted(self.cumulative, self.rng.random(self.samples)), size - 1)
        q = p["e1"][one] + p["e2"][two]
        targets, others = p["q"][target], p["q"][drawn]
        data = np.einsum("ij,ij->i", q, targets) + p["b"][target] - self.log_kn[target]
        g = 1 / (1 + np.exp(np.clip(data, -30, 30)))                      # 1 - P(data)
        h = q @ others.T
        h += p["b"][drawn] - self.log_kn[drawn]
        np.negative(np.clip(h, -30, 30, out=h), out=h)
        np.exp(h, out=h)
        h += 1
        np.divide(1, h, out=h)                                            # P(data) of noise
        dq = g[:, None] * targets - h @ others
        grad = {"e1": _rows_added(one, dq, size), "e2": _rows_added(two, dq, size)}
        dt = _rows_added(target, np.concatenate([g[:, None] * q, g[:, None]], axis=1), size)
        dn = _rows_added(drawn, np.concatenate([h.T @ q, h.sum(axis=0)[:, None]], axis=1), size)
        grad["q"], grad["b"] = dt[:, :-1] - dn[:, :-1], dt[:, -1] - dn[:, -1]
        for k, x in grad.items():
            self.sums[k] += x * x
            p[k] += self.rate * x / np.sqrt(self.sums[k])


def train_round(model: Model, docs: DataFrame, batch: int, samples: int, rate: float) -> dict[str, np.ndarray]:
    """Average of the parameters that the lanes of ``docs`` (doc_id, text) end with, weighted by their tokens."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)
    names = list(model.params)
    lanes = int(min(MOST_LANES, max(1, -(-model.n // LANE_TOKENS))))
    parts = min(lanes, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def fit(batches):
        m = sent.value
        index = m.indexer()
        lane, trainer, held, waiting, tokens = None, None, [], 0, 0

        def flush():
            one, two, target = (np.concatenate(x) for x in zip(*held))
            order = trainer.rng.permutation(len(target))
            for at in range(0, len(order), batch):
                some = order[at:at + batch]
                trainer.step(one[some], two[some], target[some])
            held.clear()

        def end():
            flat = np.concatenate([trainer.p[k].ravel() for k in names]).astype(np.float64) * tokens
            return pa.RecordBatch.from_pydict({"lane": pa.array([lane], pa.int64()), "tokens": pa.array([tokens], pa.int64()),
                                               "total": pa.array([flat.tobytes()], pa.binary())})

        for run in joined(batches):
            words, number, before = words_of(run.column("text"))
            target, starts = with_ends(index.classes(words, index.positions(words))[number], before)
            one, two = contexts(target, starts)
            for mine, a, b in zip(run.column("lane").to_pylist(), starts.tolist(), starts[1:].tolist()):
                if mine != lane:
                    if held:
                        flush()
                    if tokens:
                        yield end()
                    lane, trainer, waiting, tokens = mine, Trainer(m, samples, rate, seed=mine), 0, 0
                held.append((one[a:b], two[a:b], target[a:b]))
                waiting += b - a
                tokens += b - a
                if waiting >= 16 * batch:
                    flush()
                    waiting = 0
        if held:
            flush()
        if tokens:
            yield end()

    def add(rows):
        order = np.argsort(rows.column("lane").to_numpy(), kind="stable").tolist()  # sums do not depend on the rows' order
        tokens, total = 0, 0.0
        for i in order:
            tokens, total = tokens + rows.column("tokens")[i].as_py(), total + np.frombuffer(rows.column("total")[i].as_py())
        return pa.table({"lane": pa.array([min(rows.column("lane").to_pylist())], pa.int64()), "tokens": pa.array([tokens], pa.int64()),
                         "total": pa.array([total.tobytes()], pa.binary())})

    schema = "lane long, tokens long, total binary"
    hashed = docs.select("text", F.xxhash64("doc_id", "text").alias("h")).withColumn("lane", F.pmod("h", F.lit(lanes)).cast("long"))
    sorted_lanes = hashed.repartitionById(parts, (F.col("lane") % parts).cast("int")).sortWithinPartitions("lane", "h", "text")
    trained = sorted_lanes.select("lane", "text").mapInArrow(fit, schema)
    # a tree of two levels, as wide as deep; each row has the fixed size of the model
    wide = max(2, int(math.sqrt(lanes)))
    some = trained.groupBy(F.pmod("lane", F.lit(wide)).alias("at")).applyInArrow(add, schema)
    rows = some.groupBy(F.lit(0).alias("all")).applyInArrow(add, schema).collect()
    sent.unpersist()
    if not rows:
        return model.params
    flat, out, at = np.frombuffer(rows[0]["total"]) / rows[0]["tokens"], {}, 0
    for k in names:
        x = model.params[k]
        out[k] = flat[at:at + x.size].reshape(x.shape).astype(np.float32)
        at += x.size
    return out


class Scorer:
    """Normalised log probabilities; the normaliser of each pair of context classes is worked out once."""

    def __init__(self, model: Model):
        self.p = model.params
        self.size = model.classes
        self.log_z = np.full(self.size * self.size, np.nan, np.float32)

    def __call__(self, one: np.ndarray, two: np.ndarray, target: np.ndarray) -> np.ndarray:
        p = self.p
        pair = one.astype(np.int64) * self.size + two
        new = np.unique(pair[np.isnan(self.log_z[pair])])
        for at in range(0, len(new), 4096):
            some = new[at:at + 4096]
            s = (p["e1"][some // self.size] + p["e2"][some % self.size]) @ p["q"].T + p["b"]
            top = s.max(axis=1, keepdims=True)
            self.log_z[some] = (np.log(np.exp(s - top).sum(axis=1, keepdims=True)) + top)[:, 0]
        out = np.empty(len(target), np.float64)
        for at in range(0, len(target), 1 << 16):
            s = slice(at, at + (1 << 16))
            out[s] = np.einsum("ij,ij->i", p["e1"][one[s]] + p["e2"][two[s]], p["q"][target[s]]) + p["b"][target[s]] - self.log_z[pair[s]]
        return out


def _rated(docs: DataFrame, model: Model) -> DataFrame:
    """Per row what the lexicon and the model give, and the words beyond the lexicon with their numbers."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def rate(batches):
        from pyspark import TaskContext

        m = sent.value
        index, scorer = m.indexer(), m.scorer()
        base = np.log10((m.counts + 1) / (m.n + m.v + 1))
        end_base = np.log10((m.end_count + 1) / (m.n + m.v + 1))
        share = np.zeros(len(m.lexicon))
        of_shape = index.lex_class[m.n_words:] - 1 - m.n_words
        share[m.n_words:] = np.log10((m.counts[m.n_words:] + 1) / (m.shape_n + m.shape_v + 1)[of_shape])
        row = TaskContext.get().partitionId() << 40
        for run in joined(batches):
            words, number, before = words_of(run.column("text"))
            places = index.positions(words)
            known = places >= 0
            tokens, starts = with_ends(index.classes(words, places)[number], before)
            log_p = scorer(*contexts(tokens, starts), tokens)
            of_word = np.zeros((2, len(words)))
            of_word[:, known] = base[places[known]], share[places[known]]
            bases, shares = of_word[:, number]
            in_lexicon = known[number]
            texts = range(run.num_rows)
            words_in = [slice(a, b) for a, b in zip(before.tolist(), before[1:].tolist())]
            tokens_in = [slice(a, b) for a, b in zip(starts.tolist(), starts[1:].tolist())]
            # the words beyond the lexicon: each once a text, with its number there
            beyond = np.flatnonzero(~in_lexicon)
            text = np.searchsorted(before, beyond, "right") - 1
            pairs, n = np.unique(text * max(1, len(words)) + number[beyond], return_counts=True)
            word = pairs % max(1, len(words))
            found = words.take(pa.array(word)).cast(pa.binary())
            rest = pa.StructArray.from_arrays([found, pa.array(shapes(found), pa.int32()), pa.array(n, pa.int64())], ["word", "shape", "n"])
            ends = np.searchsorted(pairs, np.arange(run.num_rows + 1) * max(1, len(words)))
            yield pa.RecordBatch.from_pydict({
                "row": pa.array(np.arange(row, row + run.num_rows), pa.int64()),
                "doc_id": run.column("doc_id"), "held_out": run.column("held_out"),
                "n_tokens": pa.array(np.diff(starts), pa.int64()),
                "n_known": pa.array([int(in_lexicon[words_in[i]].sum()) + (m.end_count > 0) for i in texts], pa.int64()),
                "base_score": pa.array([bases[words_in[i]].sum() + end_base for i in texts], pa.float64()),
                "score": pa.array([log_p[tokens_in[i]].sum() / np.log(10) + shares[words_in[i]].sum() for i in texts], pa.float64()),
                "rest": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rest)})
            row += run.num_rows

    return docs.mapInArrow(rate, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, "
                                 "score double, rest array<struct<word:binary,shape:int,n:long>>")


def score_documents(docs: DataFrame, folds: int = 7, held_fold: int = 2, n_words: int = 1023, lexicon: int = 200_000, dim: int = 24,
                    batch: int = 8192, samples: int = 64, rate: float = 0.1) -> DataFrame:
    """Trains on the documents outside the held-out fold and scores all.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score and score (log10 probability of the text).
    """
    spark = docs.sparkSession
    small_batches(spark)
    all_docs = text_of(docs, F.col("doc_id").cast("long").alias("doc_id")).withColumn("held_out", crc32_mod("doc_id", folds) == held_fold)
    train = all_docs.where(~F.col("held_out"))
    model, counts = gather(train, n_words, lexicon, dim)
    if model.n:
        model.params = train_round(model, train.where(F.pmod(F.xxhash64("doc_id"), F.lit(16)) == 0), batch, samples, rate)
        model.params = train_round(model, train, batch, samples, rate)
    rated = materialize(_rated(all_docs, model), "lm-rated")
    rest = rated.select("row", F.explode("rest").alias("w")).select("row", "w.*")
    shapes = F.array(*(F.lit(int(a + b + 1)) for a, b in zip(model.shape_n, model.shape_v)))
    c = F.coalesce(F.col("c"), F.lit(0))
    found = rest.join(counts.select("word", F.col("n").alias("c")), "word", "left").groupBy("row").agg(
        F.sum(F.col("n") * F.log10((c + 1) / F.lit(model.n + model.v + 1))).alias("rest_base"),
        F.sum(F.col("n") * F.log10((c + 1) / F.element_at(shapes, F.col("shape") + 1))).alias("rest_score"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("rest_known"))
    zero = F.lit(0)
    return rated.drop("rest").join(found, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rest_known", zero)).alias("n_known"),
        F.lit(model.n).cast("long").alias("train_tokens"), (F.col("base_score") + F.coalesce("rest_base", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("rest_score", zero)).alias("score"))
