"""How the tokens of two tokenizers overlap: an inverted index of id pairs, as bitmaps of documents.

Both tokenizers spell the same bytes, so each place where a token of either ends cuts
the text, and each piece between two cuts is one link: the pair of the tokens that hold
it.  For each pair the index stores which documents link it, in blocks of documents, as
compressed bitmaps: one for each binary digit (a plane) of the number of its links in a
document.  All planes ORed are the pair's documents; their popcounts give its number of
documents, and weighed by their digits its number of links.  To score documents, the
postings go back to their blocks, each with its pair's count.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quire.llm.common import shipped
from quire.session import materialize, scratch_path

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
# Documents in a block, as a power of two.
BLOCK_BITS = 14
BLOCK = 1 << BLOCK_BITS
# A bitmap of fewer documents than this is a list of two-byte numbers, which is then shorter.
DENSE_FROM = BLOCK // 16
# Bytes of text that a task cuts at once, and (pair, document) entries that it holds before it writes a block's postings.
SLICE_BYTES, MAX_ENTRIES = 1_000_000, 2_000_000
# Longer texts go to the library that reads the vocabulary's own format: slower, but at home with endless words.
LONG_TEXT = 100_000
# Words whose ids a task keeps, and how long they are at most; a space that no word follows.
MAX_KNOWN, MAX_WORD, WORDS_AT_ONCE = 300_000, 200, 400
LOOSE_SPACE = re.compile(r" (?=\s|$)")
# The fixed split of byte-level BPE into words.
BYTE_LEVEL_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_level() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}


class Tokenizers:
    """Both tokenizers, made in a task from the contents of their files."""

    def __init__(self, byte_bpe: str, piece_bpe: bytes):
        import tiktoken
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        own = json.loads(byte_bpe)
        stands_for = _byte_level()
        special = {t["content"] for t in own["added_tokens"]}
        spelled = {bytes(stands_for[c] for c in t): i for t, i in own["model"]["vocab"].items() if t not in special}
        self.exact = Tokenizer.from_str(byte_bpe)
        self.exact.encode_special_tokens = True
        # Ids that rise with the merges make the fast encoder's ranks the file's merges.
        pairs = [m if isinstance(m, list) else m.split(" ") for m in own["model"]["merges"]]
        merged = [own["model"]["vocab"]["".join(m)] for m in pairs]
        level = own["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        in_order = all(x < y for x, y in zip(merged, merged[1:])) and own["normalizer"] is None and level
        self.fast = None
        if in_order:
            self.fast = tiktoken.Encoding("byte-bpe", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=spelled, special_tokens={})
        self.bytes_a = [b""] * (max(spelled.values()) + 1)
        for token, number in spelled.items():
            self.bytes_a[number] = token
        self.pieces = SentencePieceProcessor(model_proto=piece_bpe)
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, self.pieces.id_to_piece(i)) for i in range(self.pieces.get_piece_size()))
        ]
        self.length_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.length_b = np.array([len(t) for t in self.bytes_b], np.int64)
        # Written ids with what may follow them in a list of groups.
        self.n_a, self.n_b = len(self.bytes_a), len(self.bytes_b)
        written = [b"%d," % i for i in range(self.n_a)] + [b"%d|" % i for i in range(self.n_a)]
        written += [b"%d," % i for i in range(self.n_b)] + [b"%d;" % i for i in range(self.n_b)]
        self.written = np.array(written, object)
        self.written_length = np.array([len(w) for w in written], np.int64)

        # No piece reaches across a space, so what follows one is encoded by itself; known words are kept.
        self.by_word = not any("▁" in self.pieces.id_to_piece(i).lstrip("▁") for i in range(self.n_b))
        self.known: dict[str, tuple[bytes, bytes] | None] = {}

    def ids_a(self, text: str) -> list[int]:
        if self.fast is None or len(text) > LONG_TEXT:
            return self.exact.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    def _both(self, spaced: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of either side of a text that begins with a space, None if they don't both spell it."""
        raw = spaced.encode()
        ids_a, ids_b = self.ids_a(spaced), self.pieces.encode(spaced[1:], num_threads=1)
        if b"".join([self.bytes_a[i] for i in ids_a]) != raw or b"".join([self.bytes_b[i] for i in ids_b]) != raw:
            return None
        return np.array(ids_a, np.int32), np.array(ids_b, np.int32)

    def _words(self, text: str) -> list[str] | None:
        """The text's words, if each is found by itself as it is in the text: every space stands before one."""
        if not text or not self.by_word or LOOSE_SPACE.search(text):
            return None
        words = text[1:].split(" ")
        return words if max(map(len, words)) <= MAX_WORD else None

    def _learn(self, words: list[str]) -> None:
        """Encode words one behind the other, then cut the ids where the words end; None for a word that is not spelled."""
        for begin in range(0, len(words), WORDS_AT_ONCE):
            some = words[begin : begin + WORDS_AT_ONCE]
            both = self._both(" " + " ".join(some))
            if both is None:
                for word in some:
                    own = self._both(" " + word)
                    self.known[word] = own and (own[0].tobytes(), own[1].tobytes())
                continue
            ends = np.cumsum([len(w.encode()) + 1 for w in some])
            sides = []
            for ids, lengths in zip(both, (self.length_a, self.length_b)):
                to = 4 * (np.searchsorted(_ends(ids, lengths), ends) + 1)
                data, cuts = ids.tobytes(), [0, *to.tolist()]
                sides.append([data[i:j] for i, j in zip(cuts, cuts[1:])])
            self.known.update(zip(some, zip(*sides)))

    def encode(self, spaced: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of either side for texts that begin with a space; none where they don't spell the text."""
        cut = [self._words(t) for t in spaced]
        if len(self.known) > MAX_KNOWN:
            self.known.clear()
        self._learn(list({w for words in cut if words for w in words}.difference(self.known)))
        out_a, out_b, none = [], [], np.zeros(0, np.int32)
        for text, words in zip(spaced, cut):
            found = list(map(self.known.__getitem__, words)) if words else [None]
            if None in found:
                both = (self._both(text) if text else None) or (none, none)
            else:
                both = [np.frombuffer(b"".join(side), np.int32) for side in zip(*found)]
            out_a.append(both[0].astype(np.int64))
            out_b.append(both[1].astype(np.int64))
        return out_a, out_b


def _ends(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths[ids])


@dataclass
class Cut:
    """What is found in some texts: per text the counts and the groups' hash, and all links as (text, a, b)."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    sha: list[str]
    text: np.ndarray
    a: np.ndarray
    b: np.ndarray


def cut_texts(texts: list[str | None], tok: Tokenizers) -> Cut:
    """Encode, compare the bytes, cut at all tokens' ends.  Texts without tokens have zeros and ''."""
    n = len(texts)
    ids_a, ids_b = tok.encode([" " + t if t else "" for t in texts])
    n_a, n_b = (np.array([len(ids) for ids in side], np.int64) for side in (ids_a, ids_b))
    a, b = np.concatenate([*ids_a, np.zeros(0, np.int64)]), np.concatenate([*ids_b, np.zeros(0, np.int64)])
    zeros = np.zeros(n, np.int64)
    if not len(a):
        return Cut(n_a, n_b, zeros, zeros, [""] * n, a, a, a)

    # Both sides spell the same bytes, so the texts may lie one after another.
    end_a, end_b = _ends(a, tok.length_a), _ends(b, tok.length_b)
    text_a, text_b = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
    cuts = np.sort(np.concatenate([end_a, end_b]), kind="stable")  # two sorted runs
    cuts = cuts[np.append(cuts[1:] != cuts[:-1], True)]
    of_a, of_b = np.searchsorted(end_a, cuts), np.searchsorted(end_b, cuts)
    link_text = text_a[of_a]

    ends_a = end_b[np.searchsorted(end_b, end_a)] == end_a  # a group ends with this token
    ends_b = end_a[np.searchsorted(end_a, end_b)] == end_b
    group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
    row = np.concatenate([a + tok.n_a * ends_a, 2 * tok.n_a + b + tok.n_b * ends_b])
    order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
    row, text = row[order], np.concatenate([text_a, text_b])[order]
    written = b"".join(tok.written[row].tolist())
    size = np.bincount(text, weights=tok.written_length[row], minlength=n).astype(np.int64)
    to = np.cumsum(size)
    sha = [hashlib.sha256(written[e - s : e - 1]).hexdigest() if s else "" for e, s in zip(to.tolist(), size.tolist())]
    return Cut(
        n_a, n_b, np.bincount(text_a[ends_a], minlength=n), np.bincount(link_text, minlength=n), sha, link_text, a[of_a], b[of_b]
    )


def pack(numbers: np.ndarray) -> bytes:
    """A set of sorted document numbers of one block, as a list or as bits, whichever is shorter."""
    if len(numbers) < DENSE_FROM:
        return numbers.astype("<u2").tobytes()
    bits = np.zeros(BLOCK, np.uint8)
    bits[numbers] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def unpack(data: bytes) -> np.ndarray:
    if len(data) < BLOCK // 8:
        return np.frombuffer(data, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little"))


def _postings(block: int, found: list[tuple[np.ndarray, np.ndarray]], n_b: int) -> dict[str, list]:
    """One posting for each pair of a block.  ``found`` holds (pair and document, links) of slices of it, which are ORed."""
    entry, at = np.unique(np.concatenate([e for e, _ in found]), return_inverse=True)
    links = np.bincount(at, weights=np.concatenate([n for _, n in found])).astype(np.int64)
    pair, number = entry >> BLOCK_BITS, entry & (BLOCK - 1)
    pairs, begin = np.unique(pair, return_index=True)
    cut = np.append(begin, len(pair))
    planes: list[list[bytes]] = [[] for _ in pairs]
    for digit in range(int(links.max()).bit_length()):
        own = np.flatnonzero((links >> digit) & 1)
        to = np.searchsorted(own, cut)
        numbers = number[own]
        for i in range(len(pairs)):
            planes[i].append(pack(numbers[to[i] : to[i + 1]]))
    most = np.maximum.reduceat(links, begin)
    planes = [p[: int(m).bit_length()] for p, m in zip(planes, most)]
    return {"block": [block] * len(pairs), "a": (pairs // n_b).tolist(), "b": (pairs % n_b).tolist(), "planes": planes}


def _index_task(load: Callable[[], tuple], schema: pa.Schema):
    """mapInArrow over d, doc_id, text: a row for each document, and the postings of each block."""

    def filled(n: int, columns: dict) -> pa.RecordBatch:
        arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        begin, done = 0, 0
        for i, upto in enumerate(size.tolist()):
            if upto - done >= SLICE_BYTES:
                yield batch.slice(begin, i + 1 - begin)
                begin, done = i + 1, upto
        if begin < batch.num_rows:
            yield batch.slice(begin)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = Tokenizers(*load())
        block, held, found = None, 0, []

        def flush() -> Iterator[pa.RecordBatch]:
            if found:
                columns = _postings(block, found, tok.n_b)
                n = len(columns["a"])
                yield filled(n, columns | {"part": ["postings"] * n})

        for batch in batches:
            for piece in slices(batch):
                d = piece.column(0).to_numpy()
                cut = cut_texts(piece.column(2).to_pylist(), tok)
                yield filled(
                    len(d),
                    {
                        "part": ["documents"] * len(d), "d": d, "doc_id": piece.column(1), "n_a": cut.n_a, "n_b": cut.n_b,
                        "n_groups": cut.n_groups, "n_links": cut.n_links, "groups_sha256": cut.sha,
                    },
                )
                pair, blocks = cut.a * tok.n_b + cut.b, (d >> BLOCK_BITS)[cut.text]
                for own in np.unique(d >> BLOCK_BITS):
                    if own != block or held >= MAX_ENTRIES:
                        yield from flush()
                        block, held, found = int(own), 0, []
                    mine = blocks == own
                    if mine.any():
                        found.append(
                            np.unique(pair[mine] << BLOCK_BITS | (d & (BLOCK - 1))[cut.text[mine]], return_counts=True)
                        )
                        held += len(found[-1][0])
        yield from flush()

    return run


@dataclass(frozen=True)
class PairIndex:
    """``documents``: d, doc_id, n_a, n_b, n_groups, n_links, groups_sha256.  ``postings``: block, a, b, planes."""

    documents: DataFrame
    postings: DataFrame


def pair_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE
) -> PairIndex:
    """Encode all of ``docs`` once and store the index in the shared folder.

    The tokenizers' files are read on the driver and sent to the tasks.  ``d`` numbers
    the rows, so repeated rows and NULL ids stay apart; a block is BLOCK rows of one
    task, and its postings are as many as it has pairs (a block of very many entries
    may have a pair in several postings, of different documents).  NULL and empty
    texts, and those that either tokenizer does not spell, have zeros; other columns
    are not read; an empty table gives an empty index.
    """
    spark = docs.sparkSession
    with open(byte_bpe, encoding="utf-8") as file_a, open(piece_bpe, "rb") as file_b:
        load = shipped(spark, (file_a.read(), file_b.read()))
    counts = [T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")]
    schema = T.StructType(
        [
            T.StructField("part", T.StringType()), T.StructField("d", T.LongType()),
            T.StructField("doc_id", docs.schema[id_col].dataType), *counts, T.StructField("groups_sha256", T.StringType()),
            T.StructField("block", T.LongType()), T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()),
            T.StructField("planes", T.ArrayType(T.BinaryType())),
        ]
    )
    rows = docs.select(F.monotonically_increasing_id().alias("d"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    path = scratch_path(spark, "pair-index")
    rows.mapInArrow(_index_task(load, to_arrow_schema(schema)), schema).write.partitionBy("part").parquet(path)
    stored = spark.read.schema(schema).parquet(path)
    documents = stored.filter("part = 'documents'").select("d", "doc_id", *[c.name for c in counts], "groups_sha256")
    return PairIndex(documents, stored.filter("part = 'postings'").select("block", "a", "b", "planes"))


@F.arrow_udf(T.StructType([T.StructField("docs", T.LongType()), T.StructField("links", T.LongType())]))
def _popcounts(planes: pa.Array) -> pa.Array:
    docs, links = [], []
    for own in planes.to_pylist():
        sets = [unpack(p) for p in own]
        docs.append(len(np.unique(np.concatenate(sets))) if len(sets) > 1 else len(sets[0]))
        links.append(sum(len(s) << digit for digit, s in enumerate(sets)))
    return pa.StructArray.from_arrays([pa.array(docs, pa.int64()), pa.array(links, pa.int64())], ["docs", "links"])


def pair_scores(index: PairIndex) -> DataFrame:
    """``a, b, docs, links, best`` for each pair of ids that is linked anywhere.

    ``docs`` counts the documents that link it, ``links`` all its links; ``best``: no
    other pair of its b has more links.
    """
    counted = index.postings.select("a", "b", _popcounts(F.col("planes")).alias("n"))
    pairs = counted.groupBy("a", "b").agg(F.sum("n.docs").alias("docs"), F.sum("n.links").alias("links"))
    pairs = materialize(pairs, "pair-counts")
    most = pairs.groupBy("b").agg(F.max("links").alias("most"))
    return pairs.join(most, "b").select("a", "b", "docs", "links", (F.col("links") == F.col("most")).alias("best"))


def _sum_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over postings with their pairs' scores, sorted by block: the sums of each document."""
    names = ["d", "n_best", "count_sum"]
    block, best, total = None, np.zeros(BLOCK, np.int64), np.zeros(BLOCK, np.int64)

    def flush() -> Iterator[pa.RecordBatch]:
        own = np.flatnonzero(total)
        if block is not None and len(own):
            yield pa.RecordBatch.from_arrays([pa.array((block << BLOCK_BITS) + own), pa.array(best[own]), pa.array(total[own])], names)

    for batch in batches:
        for at, links, is_best, planes in zip(*(column.to_pylist() for column in batch.columns)):
            if at != block:
                yield from flush()
                block, best, total = at, np.zeros(BLOCK, np.int64), np.zeros(BLOCK, np.int64)
            for digit, data in enumerate(planes):
                numbers = unpack(data)
                total[numbers] += links << digit
                if is_best:
                    best[numbers] += 1 << digit
    yield from flush()


def align_tokenizers(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``count_sum`` sums over a document's links how many links the corpus has of the same
    pair; ``n_best`` counts the links whose pair is the most linked of its b, ties
    included.  See ``pair_index`` for NULLs, empty texts, repeated rows and empty tables.
    """
    index = pair_index(docs, id_col, text_col, byte_bpe, piece_bpe)
    # Not by sending the scores while they are few: what is shuffled then grows with the input.
    scored = index.postings.join(pair_scores(index).hint("merge"), ["a", "b"]).select("block", "links", "best", "planes")
    sums = scored.repartition("block").sortWithinPartitions("block").mapInArrow(_sum_blocks, "d long, n_best long, count_sum long")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return index.documents.join(sums.groupBy("d").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")), "d", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256"
    )
