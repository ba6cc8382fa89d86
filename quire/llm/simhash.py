"""SimHash near-dedup with Golay-code fuzzy hashing.

Fingerprints of 64 bits are linked at 4 or fewer differing bits.  To find the
links without comparing all pairs, a fingerprint gets several keys such that any
two within 4 bits share one, and only rows that share a key are compared.

The keys.  The binary Golay code [23, 12, 7] has a code word within 3 bits of
every 23-bit word.  Let near(x) be the code words within 4 bits of x: one if x
lies within 2 bits of a code word, else six.  Words x and y that differ in 2 bits
or fewer have a word z between them, 1 bit from both at most, and the code word
within 3 bits of z lies within 4 of both: near(x) and near(y) meet.

The fingerprint is cut into three segments of 22, 21 and 21 bits.  If two of them
differ in 4 bits or fewer,

* either some segment is equal in both.  One of the other two differs in 2 bits or
  fewer.  Key: the equal segment, and a code word near the other (6 x 1 to 6 keys).
* or all three differ, by (1, 1, 1 or 2) in some order.  Halve the segments: those
  that differ in one bit have an equal half.  Key: a half of each of these two, and
  a code word near the third (3 x 4 x 1 to 6 keys).

A key has 32 bits and more, so chance meetings stay few: a hundred keys for a
billion fingerprints meet about thirty strangers each.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from quire.llm.common import free_name
from quire.llm.components import components
from quire.session import materialize

RADIUS = 4
# Rows to drop are sent to all tasks up to so many (16 bytes each).
MAX_SENT = 500_000
# Generator polynomial of the Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.  Fixed value.
GOLAY = 0b101011100011
SEGMENTS = ((0, 22), (22, 21), (43, 21))

# Shingles hashed at once, rows with one key compared at once, rows written at once.
SHINGLES = 2**16
CROWD = 2048
ROWS = 2**17


def fingerprint(text: bytes | None, words: int, seed: int = 42) -> int:
    """SimHash of a text's word shingles: a bit is set if it is in over half of their XXH64 hashes."""
    found = (text or b"").lower().split()  # of bytes: A-Z only, and the six blanks only
    if not found:
        return 0
    joined = b" ".join(found)
    n = max(1, len(found) - words + 1)
    hashed = xxhash.xxh64_intdigest
    if n == 1:
        return hashed(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    ones = np.zeros(64, np.int64)
    for at in range(0, n, SHINGLES):
        cuts = zip(starts[at : min(at + SHINGLES, n)].tolist(), ends[at + words - 1 : min(at + SHINGLES, n) + words - 1].tolist())
        hashes = np.fromiter((hashed(joined[a:b], seed) for a, b in cuts), "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<u8")[0])


def _fingerprint_column(words: int):
    @F.arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        values = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else None, words) for t in texts]
        return pa.array(np.array(values, np.uint64).view(np.int64))

    return simhash


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """doc_id and fp, the 64 bits as a signed long; NULL and wordless texts have fingerprint 0."""
    return docs.select(F.col(id_col).alias("doc_id"), _fingerprint_column(words)(F.col(text_col)).alias("fp"))


# --- Golay keys ----------------------------------------------------------------


class Golay:
    """near(x) for all 2^23 words, through their 2^11 syndromes."""

    def __init__(self):
        weight4 = [self._errors(k) for k in range(5)]
        self.count = np.zeros(2048, np.int64)
        self.patterns = np.zeros((2048, 6), np.int64)
        for errors in weight4:
            for error, syndrome in zip(errors, self.syndrome(errors)):
                # Within 2 bits there is one code word; from 3 bits on, those at 4 count as well.
                if self.count[syndrome] == 0 or self.patterns[syndrome, 0].bit_count() == 3:
                    self.patterns[syndrome, self.count[syndrome]] = error
                    self.count[syndrome] += 1

    @staticmethod
    def _errors(weight: int) -> np.ndarray:
        from itertools import combinations

        return np.array([sum(1 << i for i in at) for at in combinations(range(23), weight)], np.int64)

    @staticmethod
    def syndrome(words: np.ndarray) -> np.ndarray:
        """Remainder of division by the generator polynomial."""
        rest = words.copy()
        for bit in range(22, 10, -1):
            rest ^= np.where(rest >> bit & 1, GOLAY << (bit - 11), 0)
        return rest

    def near(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and indices (12 bits) of the code words within 4 bits of ``words``."""
        syndrome = self.syndrome(words)
        row = np.repeat(np.arange(len(words)), self.count[syndrome])
        place = np.arange(len(row)) - np.repeat(np.cumsum(self.count[syndrome]) - self.count[syndrome], self.count[syndrome])
        # The code is systematic in its upper 12 bits: these number its words.
        return row, (words[row] ^ self.patterns[syndrome[row], place]) >> 11


def fuzzy_keys(values: np.ndarray, golay: Golay) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and keys (62 bits) of fingerprints given as uint64."""
    segment = [((values >> np.uint64(at)) & np.uint64(2**size - 1)).astype(np.int64) for at, size in SEGMENTS]
    halves = [(s & 2047, s >> 11) for s in segment]
    near = [golay.near(s) for s in segment]
    rows, keys = [], []
    for third in range(3):
        row, word = near[third]
        one, two = (i for i in range(3) if i != third)
        for exact in (one, two):
            kind = third * 6 + (exact == two)
            rows.append(row)
            keys.append(kind << 57 | word << 22 | segment[exact][row])
        for a in range(2):
            for b in range(2):
                kind = third * 6 + 2 + a * 2 + b
                rows.append(row)
                keys.append(kind << 57 | word << 22 | halves[one][a][row] << 11 | halves[two][b][row])
    return np.concatenate(rows), np.concatenate(keys)


def _emit_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    golay = Golay()
    for batch in batches:
        values = batch.column(0).to_numpy().view(np.uint64)
        for at in range(0, len(values), 4096):
            part = values[at : at + 4096]
            row, key = fuzzy_keys(part, golay)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[row].view(np.int64))], ["key", "fp"])


# --- links among rows that share a key -----------------------------------------


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def spanning_links(values: np.ndarray, others: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all that the links among ``values`` (and ``others``) connect, fewer than there are values.

    Each connected part gets a tree that grows from the fingerprint with the most
    neighbours, so links go to the middle of a crowd: most often the original of its copies.
    """
    nodes = values if others is None else np.concatenate([values, others])
    close = _distance(nodes[:, None], nodes[None, :]) <= RADIUS
    if others is not None:  # each block's own links are found elsewhere
        close[: len(values), : len(values)] = close[len(values) :, len(values) :] = False
    np.fill_diagonal(close, False)
    degree = close.sum(1)
    place = np.empty(len(nodes), np.int64)
    order = np.argsort(-degree, kind="stable")
    place[order] = np.arange(len(nodes))
    new = np.ones(len(nodes), bool)
    a, b = [], []
    for root in order[degree[order] > 0].tolist():
        if not new[root]:
            continue
        new[root] = False
        waiting = [(place[root], root)]
        while waiting:
            _, node = heapq.heappop(waiting)
            reached = np.flatnonzero(close[node] & new)
            if len(reached):
                new[reached] = False
                a.append(np.full(len(reached), nodes[node]))
                b.append(nodes[reached])
                for n in reached.tolist():
                    heapq.heappush(waiting, (place[n], n))
    none = np.empty(0, np.uint64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def _rows(key, a, b) -> pa.RecordBatch:
    n = len(a)
    return pa.RecordBatch.from_arrays(
        [pa.array(key, pa.int64()) if key is not None else pa.nulls(n, pa.int64()), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
        ["key", "a", "b"],
    )


def _link_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within runs of equal keys; the rows come sorted by key.

    Runs of over CROWD rows are not compared here: their rows go out with their
    key, numbered, for ``_link_crowds``.
    """
    held_key, held_fp, crowd, passed = np.empty(0, np.int64), np.empty(0, np.uint64), None, 0

    def linked(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        lengths = np.diff(np.concatenate([starts, [len(key)]]))
        small = np.repeat((lengths > 1) & (lengths <= 16), lengths)
        k, v = key[small], fp[small]
        for d in range(1, 16):
            if d >= len(k):
                break
            hit = np.flatnonzero((k[d:] == k[:-d]) & (_distance(v[d:], v[:-d]) <= RADIUS))
            if not len(hit):
                if not (k[d:] == k[:-d]).any():
                    break
                continue
            yield _rows(None, v[hit], v[hit + d])
        for at, n in zip(starts[lengths > 16].tolist(), lengths[lengths > 16].tolist()):
            a, b = spanning_links(fp[at : at + n])
            if len(a):
                yield _rows(None, a, b)

    for batch in batches:
        key = np.concatenate([held_key, batch.column(0).to_numpy()])
        fp = np.concatenate([held_fp, batch.column(1).to_numpy().view(np.uint64)])
        if crowd is not None:  # goes on from the batch before
            n = int(np.searchsorted(key, crowd, "right"))
            if n:
                yield _rows(np.full(n, crowd), fp[:n], np.arange(passed, passed + n))
            passed, key, fp = passed + n, key[n:], fp[n:]
            crowd = crowd if not len(key) else None
        if len(key):
            last = int(np.searchsorted(key, key[-1], "left"))
            if last:
                starts = np.flatnonzero(np.concatenate([[True], key[1:last] != key[: last - 1]]))
                lengths = np.diff(np.concatenate([starts, [last]]))
                big = lengths > CROWD
                for at, n in zip(starts[big].tolist(), lengths[big].tolist()):
                    yield _rows(np.full(n, key[at]), fp[at : at + n], np.arange(n))
                rest = np.repeat(~big, lengths)
                yield from linked(key[:last][rest], fp[:last][rest]) if rest.any() else ()
            key, fp = key[last:], fp[last:]
            if len(key) > CROWD:
                crowd, passed = int(key[0]), len(key)
                yield _rows(np.full(len(key), crowd), fp, np.arange(len(key)))
                key, fp = key[:0], fp[:0]
        held_key, held_fp = key, fp
    if len(held_key):
        yield from linked(held_key, held_fp)


def _link_crowds(crowded: DataFrame) -> DataFrame:
    """Links in runs of many rows: blocks of CROWD rows, and each pair of blocks of a run for itself."""
    blocks = crowded.select("key", F.col("a").alias("fp"), F.floor(F.col("b") / CROWD).cast("int").alias("block"))
    last = blocks.groupBy("key").agg(F.max("block").alias("last"))
    mates = F.explode(F.sequence(F.lit(0), F.col("last")))
    pairs = blocks.join(last, "key").select("key", "fp", "block", mates.alias("mate"))
    pairs = pairs.select(
        "key", "fp", F.least("block", "mate").alias("x"), F.greatest("block", "mate").alias("y"),
        (F.col("block") <= F.col("mate")).alias("left"),
    )

    def link(group: pd.DataFrame) -> pd.DataFrame:
        values = group["fp"].to_numpy().view(np.uint64)
        left = group["left"].to_numpy()
        if group["x"].iloc[0] == group["y"].iloc[0]:
            a, b = spanning_links(values)
        else:
            a, b = spanning_links(values[left], values[~left])
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return pairs.groupBy("key", "x", "y").applyInPandas(link, "a long, b long")


def near_links(values: DataFrame) -> DataFrame:
    """Links (a, b) among the distinct fingerprints in column ``fp``, within RADIUS bits.

    Not all pairs: for every two fingerprints within RADIUS bits there is a chain
    of links from one to the other.
    """
    keyed = values.select("fp").mapInArrow(_emit_keys, "key long, fp long")
    dealt = keyed.repartition("key").sortWithinPartitions("key")
    found = materialize(dealt.mapInArrow(_link_sorted, "key long, a long, b long"), "near-links")
    links = found.filter("key is null").select("a", "b")
    return links.unionByName(_link_crowds(found.filter("key is not null"))).distinct()


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """doc_id, fingerprint, component_id for every row of ``docs``.

    Texts are lower-cased (A-Z) and cut into shingles of ``words`` words, repeats
    included; a text of fewer words is one shingle, and one without words (NULL
    too) has fingerprint 0, linked like any other.  ``component_id`` is the
    smallest id reachable over links, NULL if none of them has an id.  Rows that
    share an id or a text are rows like others; an empty table gives no rows.
    """
    stored = materialize(fingerprints(docs, id_col, text_col, words), "fingerprints")
    least = materialize(stored.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    groups = materialize(components(near_links(least)), "components")
    of_fp = least.join(groups, least.fp == groups.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    # Stored: a join of two shuffles, unlike one with an aggregate on the same keys, can be split.
    of_root = materialize(of_fp.groupBy("root").agg(F.min("least").alias("component_id")), "component-ids")
    answer = of_fp.join(of_root, "root").select(F.col("fp").alias("of"), "component_id")
    # One row a fingerprint on the right: AQE splits a hot one's documents.
    return stored.join(answer, F.col("fp") == F.col("of")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """``docs`` with one row of each group that ``near_dedup`` links, all columns as they are.

    Of a group the row with the smallest id stays, a NULL id only if there is no other; of
    rows equal in id and text one stays.  Texts without words are linked like any other.
    Rows are known by id and text hash, so that texts are neither stored nor, unless very
    many rows go, shuffled.
    """
    names = free_name(docs, "copy_id"), free_name(docs, "copy_text")
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = [F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("twin")]
    stored = materialize(docs.select(*own, _fingerprint_column(words)(F.col(text_col)).alias("fp")), "fingerprints")
    prints = materialize(stored.select("fp").distinct(), "distinct-fingerprints")
    groups = materialize(components(near_links(prints)), "components")
    rooted = stored.join(groups, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = materialize(rooted.select("doc_id", "twin", "root"), "rooted")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "twin")
    kept = rooted.groupBy("root").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    kept = materialize(kept.select("root", "first"), "near-kept")
    members = rooted.join(kept, "root").withColumn("stays", F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.twin") == F.col("twin")))
    members = members.groupBy("doc_id", "twin", "stays").agg(F.count(F.lit(1)).alias("n"))
    # Rows that go, and those that stay once of several equal ones.
    marked = materialize(members.filter("NOT stays OR n > 1"), "near-marked")
    keys = marked.select(F.col("doc_id").alias(names[0]), F.col("twin").alias(names[1]), "stays")
    if marked.count() <= MAX_SENT:
        keys = F.broadcast(keys)
    same = F.col(id_col).eqNullSafe(F.col(names[0])) & (F.xxhash64(text) == F.col(names[1]))
    rest = docs.join(keys, same, "left_anti")
    repeated = docs.join(keys.filter("stays"), same)
    return rest.unionByName(repeated.dropDuplicates(list(names)).select(*docs.columns))
