"""Language-model scoring with a log-bilinear model.

The model predicts classes of words: each of the most frequent words is a class
of its own, so is the end of a text, and the other words share classes by their
last two bytes.  A context's representation is the weighted sum of its words'
vectors, and a class's score is the product with its own vector, plus a bias.
Training is by noise-contrastive estimation in numpy: every task trains on its
own texts, and the tasks' parameters are averaged after each round.  For scoring,
the products of all contexts of a batch with all classes are normalised by their
sums, so the probabilities of the classes add up to one; within a class a word
has its share of the class's counts, plus one.

Counts of words are exact and cover all training texts.  Words too rare or too
long for a bounded dictionary are joined with their counts instead.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from quire.llm.common import shipped
from quire.session import materialize

END = 0
TOP = 192  # classes of single words, the end included
SUFFIXES = 64
CLASSES = TOP + SUFFIXES
PAD = CLASSES  # what stands before a text
ORDER = 2  # context words
WIDTH = 16

# Words that make up 1 / DICTIONARY of all tokens or more: there can't be more than DICTIONARY of them.
DICTIONARY = 500_000
# Words of more bytes are joined, however frequent, unless they are classes of their own.
LONG_WORD = 128
# A task hands on its counts when it holds so many words, or words of so many bytes.
HELD_WORDS = 500_000
HELD_BYTES = 32 << 20
# Tokens worked on at once.
TOKENS = 1_000_000
# Bytes of text scored at once, should the tokens be long.
TEXT_BYTES = 16 << 20
# Rows handed on at once.
ROWS = 65_536


def tokens_of(text: bytes | None) -> list[bytes]:
    """Words, A-Z lower-cased: of bytes, ``lower`` and ``split`` know ASCII only."""
    return (text or b"").lower().split()


def is_training(id_col: str) -> Column:
    """Documents whose crc32(id as text) mod 7 is not 2; a NULL id is as ''."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 7 != 2


def suffix_class(word: bytes) -> int:
    return TOP + zlib.crc32(word[-2:]) % SUFFIXES


class _Suffixes(dict):
    """Classes by the last two bytes, worked out once."""

    def __missing__(self, suffix: bytes) -> int:
        self[suffix] = out = suffix_class(suffix)
        return out


# --- counts -----------------------------------------------------------------------


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()
    read = 0  # the held words have no more bytes

    def out() -> Iterator[pa.RecordBatch]:
        words, times = list(counts), list(counts.values())
        for at in range(0, len(words), ROWS):
            yield pa.RecordBatch.from_arrays(
                [pa.array(words[at : at + ROWS], pa.binary()), pa.array(times[at : at + ROWS], pa.int64())], ["word", "n"]
            )
        counts.clear()

    for batch in batches:
        for text in batch.column(0):
            if text.is_valid:
                own = text.as_buffer().to_pybytes()
                counts.update(tokens_of(own))
                read += len(own)
            full = len(counts) > HELD_WORDS
            if read > HELD_BYTES:
                read = sum(map(len, counts))
                full |= read > HELD_BYTES // 2
            if full:
                yield from out()
                read = 0
    yield from out()


def word_counts(training: DataFrame, text_col: str) -> DataFrame:
    """(word binary, n) of all training texts."""
    parts = training.select(text_col).mapInArrow(_count_words, "word binary, n long")
    return materialize(parts.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


class Vocabulary:
    """Bounded tables for tasks: classes and counts of frequent words, sizes of classes, totals."""

    def __init__(self, counts: DataFrame, n_texts: int):
        totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
        self.end_count = n_texts
        self.tokens = totals[0] + n_texts
        self.words = totals[1] + (n_texts > 0)
        least = max(1, -(-self.tokens // DICTIONARY))
        frequent, size = counts.filter(F.col("n") >= least), F.octet_length("word")
        long = frequent.filter(size > LONG_WORD).orderBy(F.desc("n"), "word").limit(TOP - 1)
        frequent = pd.concat([frequent.filter(size <= LONG_WORD).toPandas(), long.toPandas()])
        frequent = frequent.sort_values(["n", "word"], ascending=[False, True], kind="stable")
        frequent = frequent[(np.arange(len(frequent)) < TOP - 1) | (frequent["word"].map(len) <= LONG_WORD)]
        words = [bytes(w) for w in frequent["word"]]
        self.number = {w: i for i, w in enumerate(words)}
        self.of_word = np.array([i + 1 if i < TOP - 1 else suffix_class(w) for i, w in enumerate(words)], np.int16)
        n = frequent["n"].to_numpy(np.int64)
        self.log_count = np.log10(n + 1.0)

        # Counts of the shared classes, rare words included.
        @F.arrow_udf("long")
        def classes(values: pa.Array) -> pa.Array:
            return pa.array([suffix_class(w) for w in values.to_pylist()], pa.int64())

        by_class = counts.groupBy(classes(F.col("word")).alias("c")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"))
        sums = np.zeros((CLASSES, 2), np.int64)
        for row in by_class.collect():  # SUFFIXES rows
            sums[row["c"]] = row["n"], row["v"]
        for i, w in enumerate(words[: TOP - 1]):
            sums[suffix_class(w)] -= n[i], 1
            sums[i + 1] = n[i], 0
        sums[END] = n_texts, 0
        self.class_count = sums[:, 0]
        shared = np.arange(CLASSES) >= TOP
        self.log_class = np.where(shared, np.log10(sums.sum(1) + 1.0), 0.0)

    def classify(self, words: list[bytes], suffixes: _Suffixes) -> tuple[np.ndarray, np.ndarray]:
        """For each word its number among the frequent ones (or -1) and its class."""
        number = np.fromiter((self.number.get(w, -1) for w in words), np.int32, len(words))
        of = self.of_word[number] if len(self.of_word) else np.zeros(len(words), np.int16)
        rare = np.flatnonzero(number < 0)
        of[rare] = [suffixes[words[i][-2:]] for i in rare.tolist()]
        return number, of


def _add_rows(to: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Add each row to that of its number; numbers may repeat."""
    order = np.argsort(at, kind="stable")
    first = np.flatnonzero(np.diff(at[order], prepend=-1))
    if len(first):
        to[at[order[first]]] += np.add.reduceat(rows[order], first)


# --- the model --------------------------------------------------------------------


class Model:
    """context: a vector for each class and PAD; place: a weight for each context place; target, bias: of each class."""

    def __init__(self, class_count: np.ndarray):
        rng = np.random.default_rng(0)
        self.noise = (class_count + 1.0) / (class_count + 1.0).sum()
        self.context = rng.normal(0, 0.3, (CLASSES + 1, WIDTH))
        self.place = np.full((ORDER, WIDTH), 0.7)
        self.target = rng.normal(0, 0.1, (CLASSES, WIDTH))
        self.bias = np.log(self.noise)

    NAMES = ("context", "place", "target", "bias")

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def load(self, values: np.ndarray) -> None:
        at = 0
        for n in self.NAMES:
            old = getattr(self, n)
            setattr(self, n, values[at : at + old.size].reshape(old.shape).copy())
            at += old.size

    def hidden(self, contexts: np.ndarray) -> np.ndarray:
        return sum(self.context[contexts[:, j]] * self.place[j] for j in range(ORDER))

    def log_probabilities(self, contexts: np.ndarray) -> np.ndarray:
        """Natural logs for (contexts, classes), each row normalised."""
        scores = self.hidden(contexts) @ self.target.T + self.bias
        scores -= scores.max(1, keepdims=True)
        return scores - np.log(np.exp(scores).sum(1, keepdims=True))

    def train(self, seen: np.ndarray, weight: np.ndarray, rng: np.random.Generator, rate: float = 0.1, noise: int = 32, size: int = 2048) -> None:
        """One pass of noise-contrastive estimation over weighted (context..., target) rows, with Adagrad steps."""
        if not hasattr(self, "steps"):
            self.steps = {n: np.full(getattr(self, n).shape, 1e-2) for n in self.NAMES}
        offset = np.log(noise * self.noise)
        for at in range(0, len(seen), size):
            rows, w = seen[at : at + size], weight[at : at + size]
            w = w / w.sum()
            hidden = self.hidden(rows)
            target = rows[:, ORDER]
            false = rng.choice(CLASSES, noise, p=self.noise)
            good = (hidden * self.target[target]).sum(1) + self.bias[target] - offset[target]
            fake = hidden @ self.target[false].T + self.bias[false] - offset[false]
            # Slopes of the logistic loss that tells seen words from noise.
            g = -w / (1 + np.exp(good))
            f = w[:, None] / (1 + np.exp(-fake))
            d_hidden = g[:, None] * self.target[target] + f @ self.target[false]
            slope = {n: np.zeros_like(getattr(self, n)) for n in self.NAMES}
            _add_rows(slope["target"], target, g[:, None] * hidden)
            np.add.at(slope["target"], false, f.T @ hidden)
            slope["bias"] = np.bincount(target, g, CLASSES) + np.bincount(false, f.sum(0), CLASSES)
            for j in range(ORDER):
                own = self.context[rows[:, j]]
                slope["place"][j] = (d_hidden * own).sum(0)
                _add_rows(slope["context"], rows[:, j], d_hidden * self.place[j])
            for n, s in slope.items():
                self.steps[n] += s * s
                getattr(self, n).__isub__(rate * s / np.sqrt(self.steps[n]))


def windows(classes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """(context..., target) rows of texts given as classes, one after the other, each ending with END."""
    starts = np.cumsum(lengths) - lengths
    out = np.empty((len(classes), ORDER + 1), np.int16)
    out[:, ORDER] = classes
    for j in range(ORDER):
        back = j + 1
        out[back:, j] = classes[: max(0, len(classes) - back)]
        for place in range(back):
            out[starts[lengths > place] + place, j] = PAD
    return out


def _codes(rows: np.ndarray) -> np.ndarray:
    """A number for each row of classes; (CLASSES + 1) ** (ORDER + 1) are fewer than 2 ** 31."""
    code = rows[:, 0].astype(np.int32)
    for j in range(1, rows.shape[1]):
        code = code * np.int32(CLASSES + 1) + rows[:, j]
    return code


def _of_codes(code: np.ndarray, width: int) -> np.ndarray:
    out = np.empty((len(code), width), np.int16)
    for j in range(width - 1, -1, -1):
        code, out[:, j] = np.divmod(code, CLASSES + 1)
    return out


def distinct_windows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    code, n = np.unique(_codes(rows), return_counts=True)
    return _of_codes(code, ORDER + 1), n


class _Block:
    """Texts of a task, one after the other, as flat arrays: no object stays for a text, nor for a word unless it is rare."""

    def __init__(self):
        self.beside: list[pa.RecordBatch] = []  # the texts' other columns
        self.numbers, self.classes = array("i"), array("h")  # of words; each text ends with -1 and END
        self.lengths = array("q")  # words and end
        self.rare, self.times, self.n_rare = [], array("q"), array("i")
        self.bytes = 0

    def add(self, text: bytes, vocabulary: Vocabulary, suffixes: _Suffixes) -> None:
        words = tokens_of(text)
        number, of = vocabulary.classify(words, suffixes)
        rare = Counter(words[i] for i in np.flatnonzero(number < 0).tolist())
        self.numbers.frombytes(number.tobytes())
        self.numbers.append(-1)
        self.classes.frombytes(of.tobytes())
        self.classes.append(END)
        self.lengths.append(len(words) + 1)
        self.rare.extend(rare)
        self.times.extend(rare.values())
        self.n_rare.append(len(rare))
        self.bytes += len(text)


def _in_blocks(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, suffixes: _Suffixes, column: int) -> Iterator[_Block]:
    """Texts of a task in blocks of TOKENS or TEXT_BYTES, or a little more."""
    block = _Block()
    for batch in batches:
        others, first = batch.select([c for c in range(batch.num_columns) if c != column]), 0
        for end, text in enumerate(batch.column(column), 1):
            block.add(text.as_buffer().to_pybytes() if text.is_valid else b"", vocabulary, suffixes)
            if len(block.numbers) >= TOKENS or block.bytes >= TEXT_BYTES:
                block.beside.append(others.slice(first, end - first))
                yield block
                block, first = _Block(), end
        if first < batch.num_rows:
            block.beside.append(others.slice(first))
    if block.lengths:
        yield block


class _Classes(dict):
    """The class of each word: of the frequent ones by their table, of the others by their last two bytes."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__(zip(vocabulary.number, vocabulary.of_word.tolist()))
        self.suffixes = _Suffixes()

    def __missing__(self, word: bytes) -> int:
        return self.suffixes[word[-2:]]


def _class_blocks(batches: Iterator[pa.RecordBatch], classes: _Classes, column: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Texts of a task in blocks of TOKENS or a little more: their classes, one text after the other, and their lengths."""
    flat, lengths = array("h"), array("q")
    for batch in batches:
        for text in batch.column(column):
            words = tokens_of(text.as_buffer().to_pybytes() if text.is_valid else None)
            flat.extend(map(classes.__getitem__, words))
            flat.append(END)
            lengths.append(len(words) + 1)
            if len(flat) >= TOKENS:
                yield np.frombuffer(flat, np.int16), np.frombuffer(lengths, np.int64)
                flat, lengths = array("h"), array("q")
    if lengths:
        yield np.frombuffer(flat, np.int16), np.frombuffer(lengths, np.int64)


def train(training: DataFrame, text_col: str, vocabulary: Vocabulary, rounds: int = 2) -> Model:
    """Rounds of training on all texts; each ends with the tasks' mean, weighted by tokens."""
    spark = training.sparkSession
    model = Model(vocabulary.class_count)
    words = shipped(spark, vocabulary)
    for step in range(rounds):
        start = model.flat()  # travels with the function

        def run(batches: Iterator[pa.RecordBatch], step=step, start=start) -> Iterator[pa.RecordBatch]:
            v = words()
            own, rng, seen = Model(v.class_count), np.random.default_rng(step), 0
            own.load(start)
            for block in _class_blocks(batches, _Classes(v), 0):
                rows, n = distinct_windows(windows(*block))
                order = rng.permutation(len(rows))
                own.train(rows[order], n[order].astype(np.float64), rng, rate=0.1 / (step + 1))
                seen += int(n.sum())
            if seen:
                values = own.flat()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(values)) // 64), pa.array(np.arange(len(values)) % 64), pa.array(values * seen), pa.array(np.full(len(values), float(seen)))],
                    ["part", "at", "value", "seen"],
                )

        parts = training.select(text_col).mapInArrow(run, "part long, at long, value double, seen double")
        mean = parts.groupBy("part", "at").agg((F.sum("value") / F.sum("seen")).alias("value")).toPandas()  # the parameters
        if len(mean):
            values = model.flat()
            values[mean["part"] * 64 + mean["at"]] = mean["value"]
            model.load(values)
    return model


# --- scoring ----------------------------------------------------------------------


def score_parts(docs: DataFrame, vocabulary: Vocabulary, model: Model) -> DataFrame:
    """What each (row, text, doc_id, held_out) gets without the counts of its rare words, and these words."""
    load = shipped(docs.sparkSession, (vocabulary, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (v, m), suffixes = load(), _Suffixes()
        known_end = np.log10(v.end_count + 1.0)
        for block in _in_blocks(batches, v, suffixes, 1):
            lengths, number = np.frombuffer(block.lengths, np.int64), np.frombuffer(block.numbers, np.int32)
            rows, starts = windows(np.frombuffer(block.classes, np.int16), lengths), np.cumsum(lengths) - lengths
            distinct, at = np.unique(_codes(rows[:, :ORDER]), return_inverse=True)
            chosen = np.empty(len(rows))
            order = np.argsort(at, kind="stable")
            cuts = np.searchsorted(at[order], np.arange(0, len(distinct) + 4096, 4096))
            for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                table = m.log_probabilities(_of_codes(distinct[k * 4096 : (k + 1) * 4096], ORDER))
                own = order[a:b]
                chosen[own] = table[at[own] - k * 4096, rows[own, ORDER]]
            chosen = chosen / np.log(10) - v.log_class[rows[:, ORDER]]
            common = number >= 0
            logs = np.zeros(len(rows))
            logs[common] = v.log_count[number[common]]
            chosen[rows[:, ORDER] >= TOP] += logs[rows[:, ORDER] >= TOP]  # the words' shares of their classes
            ends = np.cumsum([0, *block.n_rare], dtype=np.int32)
            beside = pa.Table.from_batches(block.beside).combine_chunks()
            out = pa.RecordBatch.from_arrays(
                [
                    *(c.chunk(0) for c in beside.columns), pa.array(lengths), pa.array(np.add.reduceat(common.astype(np.int64), starts) + (v.end_count > 0)),
                    pa.array(np.add.reduceat(logs, starts) + known_end), pa.array(np.add.reduceat(chosen, starts)),
                    pa.ListArray.from_arrays(ends, pa.array(block.rare, pa.binary())), pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(block.times, np.int64))),
                ],
                schema.names,
            )
            for first in range(0, out.num_rows, ROWS):
                yield out.slice(first, ROWS)

    given = docs.select("row", "text", "doc_id", "held_out")
    sums = "n_tokens long, n_known long, log_known double, log_model double, words array<binary>, times array<long>"
    schema = given.drop("text").schema
    for field in T.StructType.fromDDL(sums):
        schema = schema.add(field)
    return given.mapInArrow(run, schema)


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``.

    Tokens are a text's words, A-Z lower-cased, and one end; NULL is an empty
    text.  ``held_out`` documents (see ``is_training``) are not learned from.
    base_score is the sum of log10((c + 1) / (N + V + 1)) over the tokens, with
    c a token's count, N all and V distinct training tokens; n_known those with
    c > 0; ``score`` is the model's log10 probability of the text.  Without
    training documents all counts are 0; an empty table gives no rows.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    training = base.filter(is_training("doc_id"))
    counts = word_counts(training, "text")
    vocabulary = Vocabulary(counts, training.count())
    model = train(training, "text", vocabulary, rounds)

    # The row numbers are fixed by writing them.
    numbered = base.withColumns({"row": F.monotonically_increasing_id(), "held_out": ~is_training("doc_id")})
    parts = materialize(score_parts(numbered, vocabulary, model), "lm-parts")
    rare = parts.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select(
        "row", F.col("w.words").alias("word"), F.col("w.times").alias("times")
    )
    found = rare.join(counts, "word").groupBy("row").agg(
        F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more_log")
    )
    n, v = float(vocabulary.tokens), float(vocabulary.words)
    joined = parts.drop("words", "times").join(found, "row", "left")
    more = F.coalesce(F.col("more_log"), F.lit(0.0))
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("log_known") + more - F.col("n_tokens") * float(np.log10(n + v + 1))).alias("base_score"),
        (F.col("log_model") + more).alias("score"),
    )
