"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for each piece of a fixed public
sentencepiece vocabulary.  The probability of a word in a language is
the sum over all its segmentations into pieces of the product of their
probabilities, by the forward algorithm; that of a text is the product
over its words.  The piece probabilities are fitted by expectation
maximisation: the expected use of each piece (forward-backward) over the
distinct words of labelled documents, weighted by their counts.

The classifier is fitted on a bounded sample of the labelled rows: per
language about ``max_docs`` documents, drawn by a hash of their id, or
all if there are fewer.  The expectations are summed by a shuffle of
(language, piece) rows; only the fitted table, bounded by vocabulary
times languages, reaches the driver.  Prediction reads every text whole;
a worker keeps the scores of words it has met.

Edge cases: NULL text, and text without a letter, is ``und`` with score
0; so is every text when nothing is labelled; NULL languages are not
learned; repeated rows keep their rows; ties go to the language first in
the alphabet; very long words are scored with rescaled sums; an empty
input gives an empty result; other columns are left behind.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, crc32_mod, rows_of, small_batches

WORD = re.compile(r"[^\W\d_]+")
MARK = "▁"           # before the first letter of a word in sentencepiece vocabularies
UNDETERMINED = "und"
#: Probability of a letter that is no piece, the same in all languages.
UNKNOWN = 1e-7
#: Longest word whose score a worker keeps, and most words it keeps.
MEMO_CHARS, MEMO_WORDS = 32, 600_000
#: Letters of text (and words of one text) that are scored together.
TOGETHER = 1 << 19


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters (the pattern also lets through runs of letter-like numerals alone)."""
    words = WORD.findall(text.lower())
    return words if text.isascii() else [w for w in words if w.isalpha() or any(c.isalpha() for c in w)]


def vocabulary(path: str) -> list[str]:
    """The ordinary pieces of a sentencepiece model, lower-cased ones only."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {sp.id_to_piece(i) for i in range(sp.get_piece_size())
              if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))}
    return sorted(p for p in pieces if p == p.lower() and re.fullmatch(f"{MARK}?[^\\W\\d_]+", p))


@dataclass
class Model:
    languages: list[str]
    priors: np.ndarray                 # log share of the labelled documents
    pieces: dict[str, list[float]]     # piece -> probability in each language
    longest: int = 0                   # characters of the longest piece

    def __post_init__(self):
        self.longest = max(map(len, self.pieces), default=1)


@dataclass
class Trie:
    """The pieces by their letters: (state, letter) -> state as sorted keys, and the piece that a state is, or -1."""

    keys: np.ndarray
    child: np.ndarray
    piece: np.ndarray

    @staticmethod
    def key(state, letter):
        return state << 21 | letter  # a code point has 21 bits

    def step(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The next state, -1 where there is none."""
        wanted = self.key(state, letter)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.child[at], -1)


def _prefixes(pieces: dict[str, list[float]]) -> Trie:
    """The trie of the pieces, in their order."""
    states, piece, edges = {"": 0}, [-1], {}
    for number, text in enumerate(pieces):
        state = 0
        for end in range(1, len(text) + 1):
            then = states.setdefault(text[:end], len(states))
            if then == len(piece):
                piece.append(-1)
                edges[Trie.key(state, ord(text[end - 1]))] = then
            state = then
        piece[state] = number
    keys = np.array(sorted(edges) or [-1], np.int64)
    return Trie(keys, np.array([edges.get(int(k), 0) for k in keys], np.int64), np.array(piece, np.int64))


class Segments:
    """All segmentations of a batch of marked words, as arcs (word, start, end, piece) by end; piece -1: a letter that is none."""

    def __init__(self, words: list[str], prefixes: Trie):
        letters = np.frombuffer((MARK + MARK.join(words)).encode("utf-32-le"), np.uint32).astype(np.int64) if words else np.empty(0, np.int64)
        self.lengths = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
        self.width = int(self.lengths.max(initial=0)) + 1
        owner = np.repeat(np.arange(len(words)), self.lengths)
        first = (np.cumsum(self.lengths) - self.lengths)[owner]
        stop = first + self.lengths[owner]
        # all places at once, one letter further in each step, as long as some piece goes on
        place, state, far, found = np.arange(len(letters)), np.zeros(len(letters), np.int64), 0, []
        while len(place):
            state = prefixes.step(state, letters[place + far])
            far += 1
            known = np.flatnonzero(state >= 0)
            piece = np.full(len(place), -1)
            piece[known] = prefixes.piece[state[known]]
            arc = np.arange(len(place)) if far == 1 else np.flatnonzero(piece >= 0)
            found.append((place[arc], np.full(len(arc), far), piece[arc]))
            known = known[place[known] + far < stop[place[known]]]
            place, state = place[known], state[known]
        begin, length, piece = (np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64) for i in range(3))
        start = begin - first[begin]
        order = np.argsort(start + length, kind="stable")
        self.word, self.start, self.end, self.piece = owner[begin][order], start[order], (start + length)[order], piece[order]
        self.cuts = np.searchsorted(self.end, np.arange(self.width + 1))

    def forward(self, p: np.ndarray) -> np.ndarray:
        """Sums up to each position: (word, position, language); ``p``: probabilities of the arcs, (arc, language)."""
        n, languages = len(self.lengths), p.shape[1]
        alpha = np.zeros((n, self.width, languages))
        alpha[:, 0] = 1.0
        for at in range(1, self.width):
            arcs = slice(self.cuts[at], self.cuts[at + 1])
            word = self.word[arcs]
            part = alpha[word, self.start[arcs]] * p[arcs]
            for language in range(languages):
                alpha[:, at, language] = np.bincount(word, part[:, language], n)
        return alpha

    def backward(self, p: np.ndarray) -> np.ndarray:
        """Sums from each position to the end of the word, for one language: (word, position)."""
        n = len(self.lengths)
        beta = np.zeros((n, self.width))
        beta[np.arange(n), self.lengths] = 1.0
        for at in range(self.width - 1, 0, -1):  # what ends here is complete when its ends are
            arcs = slice(self.cuts[at], self.cuts[at + 1])
            np.add.at(beta, (self.word[arcs], self.start[arcs]), p[arcs] * beta[self.word[arcs], at])
        return beta


def table_of(pieces: dict[str, list[float]]) -> np.ndarray:
    """Probabilities by piece number; the last row is that of a letter that is no piece."""
    rows = [*pieces.values()]
    return np.array([*rows, [UNKNOWN] * len(rows[0])]) if rows else np.zeros((1, 0))


def forward_batch(words: list[str], prefixes: Trie, table: np.ndarray) -> np.ndarray:
    """Log probabilities (word, language) of words of at most MEMO_CHARS letters, over all segmentations."""
    s = Segments(words, prefixes)
    alpha = s.forward(table[s.piece])
    return np.log(alpha[np.arange(len(words)), s.lengths])


def expectations(words: list[str], counts: np.ndarray, prefixes: Trie, table: np.ndarray) -> np.ndarray:
    """Expected uses of each piece (by number) in the segmentations of counted words of one language; words of at most MEMO_CHARS letters."""
    s = Segments(words, prefixes)
    p = table[s.piece]
    alpha, beta = s.forward(p[:, None])[:, :, 0], s.backward(p)
    total = alpha[np.arange(len(words)), s.lengths]
    used = alpha[s.word, s.start] * p * beta[s.word, s.end] * (counts / total)[s.word]
    return np.bincount(s.piece[s.piece >= 0], used[s.piece >= 0], len(table) - 1)


def long_expectations(word: str, count: float, prefixes: Trie, table: np.ndarray) -> np.ndarray:
    """``expectations`` of one word of any length, by logarithms of the sums."""
    s = Segments([word], prefixes)
    n, log_p = int(s.lengths[0]), np.log(table[s.piece])
    alpha, beta = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
    alpha[0] = beta[n] = 0.0
    for at in range(1, n + 1):
        arcs = slice(s.cuts[at], s.cuts[at + 1])
        alpha[at] = np.logaddexp.reduce(alpha[s.start[arcs]] + log_p[arcs])
    for at in range(n, 0, -1):
        arcs = slice(s.cuts[at], s.cuts[at + 1])
        beta[s.start[arcs]] = np.logaddexp(beta[s.start[arcs]], log_p[arcs] + beta[at])
    used = count * np.exp(alpha[s.start] + log_p + beta[s.end] - alpha[n])
    return np.bincount(s.piece[s.piece >= 0], used[s.piece >= 0], len(table) - 1)


def forward(word: str, model: Model) -> list[float]:
    """Log probability of a word of any length in each language: sums are rescaled on the way."""
    text, longest, languages = MARK + word, model.longest, len(model.languages)
    unknown = [UNKNOWN] * languages
    alpha, scale = [[1.0] * languages], [0.0] * languages
    for end in range(1, len(text) + 1):
        total = [0.0] * languages
        for start in range(max(0, end - longest), end):
            p = model.pieces.get(text[start:end]) or (unknown if start == end - 1 else None)
            if p is not None:
                total = [t + a * x for t, a, x in zip(total, alpha[start], p)]
        alpha.append(total)
        for i, t in enumerate(total):
            if t < 1e-200:  # lift the sums that later ends still need
                for row in alpha[max(0, len(alpha) - longest - 1):]:
                    row[i] *= 1e200
                scale[i] -= 200 * math.log(10)
    return [math.log(t) + s for t, s in zip(alpha[-1], scale)]


def fit(labelled: DataFrame, vocabulary_path: str, max_docs: int = 4000, iterations: int = 3) -> Model:
    """``labelled``: doc_id, text, lang of documents to learn from."""
    spark = labelled.sparkSession
    known = labelled.where(F.col("lang").isNotNull())
    per_language = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    languages = sorted(per_language)
    if not languages:
        return Model([], np.zeros(0), {})
    # a share of each language by the hash of the id, so that about max_docs remain
    share = F.create_map(*(x for lang in languages for x in (F.lit(lang), F.lit(min(1.0, max_docs / per_language[lang])))))
    sample = known.where((F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1e6 < share[F.col("lang")]) & F.col("text").isNotNull())

    def count(batches):
        import pyarrow as pa

        counted: Counter = Counter()
        for langs, texts in rows_of(batches, "lang", "text"):
            for lang, text in zip(langs, texts):
                counted.update((lang, w) for w in words_of(text))
        if counted:
            yield pa.RecordBatch.from_pydict({"lang": pa.array([k[0] for k in counted]), "word": pa.array([k[1] for k in counted]),
                                              "n": pa.array(list(counted.values()), pa.int64())})

    # a task's counter is bounded with the sample
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = checkpointed(sample.select("lang", "text").mapInArrow(count, "lang string, word string, n long")
                         .groupBy("lang", "word").agg(F.sum("n").alias("n")).repartition(parts))
    vocab = vocabulary(vocabulary_path)
    pieces = {p: [1.0 / len(vocab)] * len(languages) for p in vocab}
    for _ in range(iterations):
        sent = spark.sparkContext.broadcast((pieces, {lang: i for i, lang in enumerate(languages)}))

        def expect(batches, sent=sent):
            import pyarrow as pa

            table, at = sent.value
            names, prefixes, p = list(table), _prefixes(table), table_of(table)
            used = np.zeros((len(at), len(names)))
            for langs, batch, ns in rows_of(batches, "lang", "word", "n"):
                for lang, i in at.items():
                    mine = [(w, n) for x, w, n in zip(langs, batch, ns) if x == lang]
                    short = [(w, n) for w, n in mine if len(w) <= MEMO_CHARS]
                    if short:
                        used[i] += expectations([w for w, _ in short], np.array([n for _, n in short], float), prefixes, p[:, i])
                    for w, n in mine:
                        if len(w) > MEMO_CHARS:
                            used[i] += long_expectations(w, n, prefixes, p[:, i])
            for lang, i in at.items():
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(names), pa.string()), "piece": pa.array(names), "n": pa.array(used[i])})

        rows = words.mapInArrow(expect, "lang string, piece string, n double").where("n > 0").groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect()
        n = {(r["lang"], r["piece"]): r["n"] for r in rows}  # at most vocabulary x languages
        totals = Counter()
        for (lang, _), x in n.items():
            totals[lang] += x
        pieces = {p: [(n.get((lang, p), 0.0) + 0.05) / (totals[lang] + 0.05 * len(vocab)) for lang in languages] for p in vocab}
        sent.unpersist()
    shares = np.array([per_language[lang] for lang in languages], float)
    return Model(languages, np.log(shares / shares.sum()), pieces)


class Identifier:
    """Scores texts; keeps the scores of words it has met."""

    def __init__(self, model: Model):
        self.model = model
        self.index: dict[str, int] = {}
        self.scores = np.zeros((1024, max(1, len(model.languages))))
        self.prefixes, self.table = _prefixes(model.pieces), table_of(model.pieces)

    def places(self, words: list[str]) -> np.ndarray:
        """Rows of the words' scores; new ones are scored first, -1 stands for a very long word."""
        get = self.index.get
        at = np.fromiter([get(w, -1) for w in words], np.int64, len(words))
        missing = np.flatnonzero(at < 0)
        new = [w for w in dict.fromkeys(words[i] for i in missing) if len(w) <= MEMO_CHARS]
        if new:
            if len(self.index) + len(new) > MEMO_WORDS:
                self.index.clear()
                return self.places(words)
            need = len(self.index) + len(new)
            if need > len(self.scores):
                self.scores = np.concatenate([self.scores, np.zeros((need, self.scores.shape[1]))])
            for start in range(0, len(new), 2000):
                some = new[start:start + 2000]
                first = len(self.index)
                self.scores[first:first + len(some)] = forward_batch(some, self.prefixes, self.table)
                self.index.update(zip(some, range(first, first + len(some))))
            at[missing] = [get(words[i], -1) for i in missing]
        return at

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and posterior of each text; the words of about ``TOGETHER`` letters of text are looked up together."""
        found: list[tuple[str, float]] = []
        low = 0
        while low < len(texts):
            high, letters = low, 0
            while high < len(texts) and (high == low or letters + len(texts[high] or "") <= TOGETHER):
                letters += len(texts[high] or "")
                high += 1
            found += self._some(texts[low:high])
            low = high
        return found

    def _some(self, texts: list[str | None]) -> list[tuple[str, float]]:
        words = [words_of(t) if t and self.model.languages else [] for t in texts]
        counts = np.fromiter(map(len, words), np.int64, len(words))
        flat = [w for ws in words for w in ws]
        owner = np.repeat(np.arange(len(texts)), counts)
        total = np.tile(self.model.priors, (len(texts), 1))
        for start in range(0, len(flat), TOGETHER):  # one text may be longer
            at = self.places(flat[start:start + TOGETHER])
            mine = owner[start:start + TOGETHER]
            short = at >= 0
            first, last = int(mine[0]), int(mine[-1]) + 1
            for language in range(total.shape[1]):
                total[first:last, language] += np.bincount(mine[short] - first, self.scores[at[short], language], last - first)
            for i in np.flatnonzero(~short):
                total[mine[i]] += forward(flat[start + i], self.model)
        out = []
        for n, sums in zip(counts.tolist(), total):
            if not n:
                out.append((UNDETERMINED, 0.0))
                continue
            best = int(np.argmax(sums))
            out.append((self.model.languages[best], float(1 / np.exp(sums - sums[best]).sum())))
        return out


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Adds lang_pred and score to the columns of ``docs`` but the text."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept_columns = [c for c in docs.columns if c != "text"]
    schema = docs.select(*kept_columns, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def name(batches):
        import pyarrow as pa

        identify = Identifier(sent.value)
        for batch in batches:
            found = identify(batch.column(batch.schema.get_field_index("text")).to_pylist())
            kept = [batch.column(batch.schema.get_field_index(c)) for c in kept_columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                                             [*kept_columns, "lang_pred", "score"])

    return docs.mapInArrow(name, schema)


def identify_languages(docs: DataFrame, vocabulary_path: str, folds: int = 4, held_fold: int = 2, **fit_options) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learns outside the held-out fold."""
    held = docs.select("doc_id", "text", "lang", (crc32_mod("doc_id", folds) == held_fold).alias("held_out"))
    model = fit(held.where(~F.col("held_out")).select("doc_id", "text", "lang"), vocabulary_path, **fit_options)
    return predict(held.select("doc_id", "held_out", "text"), model)


def drop_undetermined(docs: DataFrame, vocabulary_path: str, folds: int = 4, held_fold: int = 2, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose language is found with a score of at least ``least``; columns as they were."""
    labelled = docs.where(crc32_mod("doc_id", folds) != held_fold).select("doc_id", "text", "lang")
    model = fit(labelled, vocabulary_path)
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches):
        import pyarrow as pa

        identify = Identifier(sent.value)
        for batch in batches:
            found = identify(batch.column(batch.schema.get_field_index("text")).to_pylist())
            yield batch.filter(pa.array([x[0] != UNDETERMINED and x[1] >= least for x in found], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
