"""SentencePiece encoding and decoding with a Viterbi search shared over prefixes.

A text is cut into marked words (U+2581 for each space), and no piece reaches
across such a cut.  Of each batch of texts the distinct words are sorted: in this
order, walking from word to word is a depth-first walk through their trie.  The
forward state of every prefix stays on a stack, and a word pays only for what it
doesn't share with the word before.  A bounded cache keeps words between batches.

Unigram models: the state is the best sum of scores, and where its last piece
begins.  BPE models: their encoding isn't the best sum of anything, but it has the
same shape.  Every prefix has one encoding, which is that of a shorter prefix and
one piece more, and a row of pieces is an encoding if every two neighbours are
one by themselves.  So the state is the last piece, and the step to the next
prefix takes the one piece that goes with the last piece before it.  Both give
the ids that the library gives.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quire.llm.common import free_name, shipped

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
# Stands for a U+2581 of the text itself; no text can hold it.  It is written as the mark's three bytes.
LITERAL_MARK = "\ud800"
# Beyond so many words a task's cache keeps those of the last batch only; beyond so many, pairs of pieces are forgotten.
CACHE, PAIRS = 300_000, 300_000


class Pieces:
    """A model's vocabulary as plain tables: ids and scores by piece, bytes by id."""

    def __init__(self, rows: list[tuple[str, float, str]], by_merges: bool):
        self.by_merges = by_merges
        self.neighbours: dict[tuple[str, str], bool] = {}
        self.halves: dict[str, tuple[str, str] | None] = {}
        self.edges: tuple[dict, dict] = ({}, {})
        self.found: dict[str, tuple[int, float]] = {}
        self.byte_ids = [-1] * 256
        self.unknown = -1
        self.written: list[bytes] = []
        for number, (piece, score, kind) in enumerate(rows):
            if kind == "byte":
                self.byte_ids[int(piece[3:5], 16)] = number
                self.written.append(bytes([int(piece[3:5], 16)]))
            elif kind == "normal":
                self.found[piece] = (number, score)
                self.written.append(piece.replace(MARK, " ").encode())
            else:
                self.unknown = number if kind == "unknown" else self.unknown
                self.written.append(b"")
        self.longest = max(map(len, self.found), default=1)
        self.ends = {p[i:] for p in self.found for i in range(len(p))}
        self.penalty = min((s for _, s in self.found.values()), default=0.0) - 10.0
        characters = set("".join(self.found))
        crossing = any(MARK in p.lstrip(MARK) for p in self.found)
        if crossing:
            raise ValueError("a piece reaches across a word mark")
        # Blanks that no piece contains end a word as well.
        alone = "".join(c for c in "\t\n\x0b\f\r" if c not in characters)
        self.cut = re.compile(f"{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+|[{alone}]" if alone else f"{MARK}+[^{MARK}]*")

    def spelled(self, character: str) -> list[int]:
        """Ids of a character that is no piece: its bytes, or the unknown piece where the model lacks them."""
        ids = [self.byte_ids[b] for b in (MARK if character == LITERAL_MARK else character).encode()]
        return ids if min(ids) >= 0 else [self.unknown]

    def merged(self, text: str) -> list[str]:
        """BPE as defined: of all neighbours that make a piece, the pair with the best score is joined, the leftmost first."""
        parts, last = list(text), None
        while True:
            scores = [self.found[a + b][1] if a + b in self.found else None for a, b in zip(parts, parts[1:])]
            best = max((s for s in scores if s is not None), default=None)
            if best is None:
                break
            at = scores.index(best)
            last = (parts[at], parts[at + 1])
            parts[at : at + 2] = ["".join(last)]
        if len(parts) == 1:
            self.halves[text] = last
        return parts

    def edge(self, piece: str, side: int) -> list[tuple[str, float, float]]:
        """The parts that a piece has at its left (0) or right (1) end while it is built, the whole first.

        Each with its own score, and that of the join that ends it.  Empty if
        the piece isn't its own encoding.
        """
        out = self.edges[side].get(piece)
        if out is None:
            out = []
            if self.merged(piece) == [piece]:
                part, ended = piece, -np.inf
                while True:
                    halves = self.halves[part] if part in self.halves else self.merged(part) and self.halves.get(part)
                    own = self.found[part][1] if halves else np.inf
                    out.append((part, own, ended))
                    if not halves:
                        break
                    part, ended = halves[side], own
            self.edges[side][piece] = out
        return out

    def fits(self, before: str, piece: str) -> bool:
        """Whether the two stay two pieces when encoded together.

        They don't if parts that touch would be joined before either is built
        into more; of equal scores the left join comes first.
        """
        known = self.neighbours.get((before, piece))
        if known is not None:
            return known
        if len(self.neighbours) > PAIRS:
            self.neighbours.clear()
        left = self.edge(before, 1) if before in self.found else [("", np.inf, -np.inf)]
        right = self.edge(piece, 0)
        known = bool(left and right)
        for a, made_a, end_a in left if known else ():
            for b, made_b, end_b in right:
                hit = self.found.get(a + b) if a else None
                if hit is None:
                    continue
                if hit[1] >= min(made_a, made_b):  # scores that don't fall as pieces grow: do it step by step
                    known = self.merged(before + piece) == [before, piece]
                    break
                if hit[1] > end_a and hit[1] >= end_b:
                    known = False
                    break
            else:
                continue
            break
        self.neighbours[before, piece] = known
        return known


def load_pieces(path: str = MODEL) -> Pieces:
    """Read a model on the driver; only its tables travel to tasks."""
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    model = SentencePieceProcessor(model_file=path)
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model.serialized_model_proto())
    kinds = proto.trainer_spec.ModelType
    if proto.trainer_spec.model_type not in (kinds.Value("UNIGRAM"), kinds.Value("BPE")):
        raise ValueError("only unigram and BPE models have pieces to search for")

    def kind(i: int) -> str:
        return "byte" if model.is_byte(i) else "unknown" if model.is_unknown(i) else "control" if model.is_control(i) or model.is_unused(i) else "normal"

    rows = [(model.id_to_piece(i), model.get_score(i), kind(i)) for i in range(model.get_piece_size())]
    return Pieces(rows, proto.trainer_spec.model_type == kinds.Value("BPE"))


def marked_words(text: str, pieces: Pieces) -> list[str]:
    """The text with a space put before it, as words that begin with their marks."""
    if not text:
        return []
    if MARK in text:
        text = text.replace(MARK, LITERAL_MARK)
    return pieces.cut.findall(MARK + text.replace(" ", MARK))


def _by_score(pieces: Pieces, word: str, shared: int, best: list[float], start: list[int]) -> None:
    """Extend the states of a word's first ``shared`` characters to the whole word.

    Of equal sums, the one whose last piece begins first.  A character outside
    the vocabulary costs ``penalty``.
    """
    found, ends, longest, penalty = pieces.found, pieces.ends, pieces.longest, pieces.penalty
    for end in range(shared + 1, len(word) + 1):
        top, at = best[end - 1] + penalty, end - 1
        for begin in range(end - 1, max(-1, end - 1 - longest), -1):
            piece = word[begin:end]
            if piece not in ends:
                break
            hit = found.get(piece)
            if hit is not None and (score := best[begin] + hit[1]) >= top:
                top, at = score, begin
        best.append(top)
        start.append(at)


def _by_merges(pieces: Pieces, word: str, shared: int, last: list[str], start: list[int]) -> None:
    """The same for BPE: ``last`` has the last piece of each prefix's encoding."""
    found, ends, longest, known, fits = pieces.found, pieces.ends, pieces.longest, pieces.neighbours, pieces.fits
    for end in range(shared + 1, len(word) + 1):
        own, at = word[end - 1], end - 1
        for begin in range(end - 1, max(-1, end - 1 - longest), -1):
            piece = word[begin:end]
            if piece not in ends:
                break
            if piece in found:
                pair = (last[begin], piece)
                if known[pair] if pair in known else fits(*pair):
                    own, at = piece, begin
                    break
        last.append(own)
        start.append(at)


def encode_words(words: Iterable[str], pieces: Pieces) -> Iterator[tuple[str, list[int]]]:
    """(word, ids) for distinct words."""
    found, extend = pieces.found, _by_merges if pieces.by_merges else _by_score
    before = ""
    state, start = ["" if pieces.by_merges else 0.0], [0]
    for word in sorted(words):
        shared = 0
        for a, b in zip(before, word):
            if a != b:
                break
            shared += 1
        del state[shared + 1 :], start[shared + 1 :]
        extend(pieces, word, shared, state, start)
        before = word
        ids: list[int] = []
        end = len(word)
        while end:
            piece = word[start[end] : end]
            hit = found.get(piece)
            ids += [hit[0]] if hit else reversed(pieces.spelled(piece))
            end = start[end]
        yield word, ids[::-1]


def encode_batch(texts: list[str | None], pieces: Pieces, cache: dict[str, bytes]) -> pa.ListArray:
    """Ids of each text.  ``cache`` has those of a word as the bytes of an int32 array."""
    cut = [marked_words(t or "", pieces) for t in texts]
    present = set(chain.from_iterable(cut))
    cache.update((w, array("i", ids).tobytes()) for w, ids in encode_words(present.difference(cache), pieces))
    ids = [b"".join(map(cache.__getitem__, words)) for words in cut]
    if len(cache) > CACHE:  # words of this batch stay, frequent ones among them
        own = {w: cache[w] for w in present}
        cache.clear()
        cache.update(own)
    offsets = np.concatenate([[0], np.cumsum([len(i) // 4 for i in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), np.int32)))


def decode_ids(ids: Iterable[int], pieces: Pieces) -> str:
    text = b"".join(map(pieces.written.__getitem__, ids)).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def decode_batch(values: pa.ListArray, pieces: Pieces) -> pa.Array:
    flat = values.values.to_numpy(zero_copy_only=False)
    cuts = values.offsets.to_pylist()
    return pa.array([decode_ids(flat[a:b].tolist(), pieces) for a, b in zip(cuts, cuts[1:])], pa.string())


# Rows and bytes handed on at once: many, since the words of a group share their prefixes, but few of very long texts.
GROUP, GROUP_BYTES = 1_024, 2_000_000


def _groups(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for values in batches:
        size = pc.list_value_length(values) if pa.types.is_list(values.type) else pc.binary_length(values)
        upto = np.cumsum(size.fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        begin, done = 0, 0
        while begin < len(values):
            fits = int(np.searchsorted(upto, done + GROUP_BYTES, side="right"))
            end = min(max(fits, begin + 1), begin + GROUP, len(values))
            yield values.slice(begin, end - begin)
            begin, done = end, int(upto[end - 1])


def encode(text: Column, pieces: Pieces, spark: SparkSession) -> Column:
    """array<int>: ids of each text; NULL and '' have none."""
    load = shipped(spark, pieces)  # the vocabulary: its size is the model's

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cache: dict[str, bytes] = {}
        own = load()
        for texts in _groups(batches):
            yield encode_batch(texts.to_pylist(), own, cache)

    return ids(text)


def decode(ids: Column, pieces: Pieces, spark: SparkSession) -> Column:
    """string: the text that ``encode`` was given ('' for NULL)."""
    load = shipped(spark, pieces)

    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = load()
        for values in _groups(batches):
            yield decode_batch(values, own)

    return texts(ids)


def encode_and_decode(text: Column, pieces: Pieces, spark: SparkSession) -> Column:
    """struct<ids, decoded>: both steps in one task process, so that ids don't travel back to be decoded."""
    load = shipped(spark, pieces)

    @F.arrow_udf("ids array<int>, decoded string")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cache: dict[str, bytes] = {}
        own = load()
        for texts in _groups(batches):
            ids = encode_batch(texts.to_pylist(), own, cache)
            yield pa.StructArray.from_arrays([ids, decode_batch(ids, own)], ["ids", "decoded"])

    return both(text)


def tokenized(docs: DataFrame, pieces: Pieces, text_col: str = "text", ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """``docs`` with two more columns: the ids of each text, and the text made of them again.

    Names that ``docs`` has already get an underscore.  The round trip is exact
    for every text, except that NULL comes back as ''.
    """
    own = list(docs.columns)
    ids_col, both = free_name(docs, ids_col), free_name(docs, "encoded")
    decoded_col = free_name(docs.select(*own, F.lit(0).alias(ids_col)), decoded_col)
    out = docs.withColumn(both, encode_and_decode(F.col(text_col), pieces, docs.sparkSession))
    return out.select(*own, F.col(both)["ids"].alias(ids_col), F.col(both)["decoded"].alias(decoded_col))
