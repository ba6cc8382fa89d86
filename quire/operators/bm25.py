"""Okapi BM25 over a corpus of chunks, for a whole table of queries.

The index is a table of postings, sorted by word batch by batch, and in every file when laid out by it.  A search reads the
postings of the queries' words and no texts.  Postings are packed into bundles of chunks,
queries into blocks, and every block meets every bundle in a task, which adds up one query
after the other, or many at once in tiles (``tiles``), and keeps the k best of each.

With ``skip_blocks`` each list is cut into blocks of like impact instead, of which the
largest is known, and a query reads blocks in the order in which they lower, for each
posting, what unread ones can still add most:

1. the chunks that look best after the first blocks give each query a bar: the k-th best of their scores;
2. it reads on until what is unread can add a small share of the bar only, and skips the rest: chunks it has
   not met can't reach the bar;
3. the chunks that can still reach it get what they lack from the skipped blocks.

These steps are joins and sums over all queries at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quire.fixed_values import BM25_B, BM25_EPSILON, BM25_K1
from quire.functions import text as tx
from quire.functions.text import words_in
from quire.operators import tiles
from quire.operators.topk import DECIMALS, among, sent
from quire.session import materialize

POSTING_BUCKET = "term_bucket"

# Postings a query reads before it has a bar.
FIRST_READ = 2_000
# Chunks whose scores are worked out for the bar, for each of the k best.
HOPEFUL = 5
# A query reads until what is unread can add this share of the bar: the less, the fewer chunks need what was skipped.
ROOM = 0.3
# Additions in a task that sums scores: its table of sums stays in memory, and in the caches of a core for the most part.
SUMS_PER_TASK = 2_000_000
# Blocks of all queries (four numbers each, 64 MB in all) that are sent to the tasks; beyond that Spark chooses the join.
MAX_BLOCKS = 2_000_000
# Bounds are compared with this much room, more than sums of doubles differ by.
MARGIN = 1e-6
# Chunks of a bundle at most, as a power of two; postings a task holds before it packs them; words of a block of queries.
BUNDLE_BITS, HELD_POSTINGS, BLOCK_WORDS = 16, 500_000, 400_000
# Words of the chunks of a bundle, by their mean length.
BUNDLE_WORDS = 3_000_000
# Blocks of so many queries are added up in tiles.
TILED_QUERIES = 256
# Bars of queries that a task keeps.
HELD_BARS = 8_000_000
# Blocks of queries up to this size are sent to all tasks; larger tables are read by the tasks that need them.
SENT_BYTES = 64 * 1024 * 1024
# Bytes of chunks whose words a task counts at once.
COUNTED_BYTES = 8_000_000
# Hits (query, row) that a task holds before it hands on what it has.
HELD_HITS = 2_000_000
# Postings that a task holds before it packs them by word.
PACKED_POSTINGS = 1_000_000


def _tokens(text_col: str) -> Column:
    return F.coalesce(tx.tokens(F.col(text_col)), F.array().cast("array<string>"))


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        step = max(1, batch.num_rows * COUNTED_BYTES // max(1, batch.nbytes))
        for begin in range(0, batch.num_rows, step):
            yield batch.slice(begin, step)


def entries_of(chunks: DataFrame, id_col: str = "chunk_id", text_col: str = "text", row: Column | None = None) -> DataFrame:
    """``term, row, tf, length``, one for each distinct word of a chunk, and one without a term that holds its id.

    Counted batch by batch where the chunks lie, without a shuffle, and sorted by word in each batch.  ``row`` numbers
    the chunks, unless given.
    """
    schema = T.StructType(
        [
            T.StructField("term", T.StringType()),
            T.StructField("row", T.LongType()),
            T.StructField("tf", T.IntegerType()),
            T.StructField("length", T.IntegerType()),
            T.StructField(id_col, chunks.schema[id_col].dataType),
        ]
    )
    arrow_schema = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _bounded(batches):
            rows, ids, texts = batch.columns
            words, lengths = words_in(texts)
            lengths = lengths.astype(np.int32)
            none = pa.nulls(len(rows))
            yield pa.RecordBatch.from_arrays(
                [none.cast(pa.string()), rows, none.cast(pa.int32()), pa.array(lengths), ids], schema=arrow_schema
            )
            words = words.dictionary_encode()
            # Sorted by word here, so that no task has to sort all it has.
            order = pc.sort_indices(words.dictionary).to_numpy()
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            n_rows = max(1, len(rows))
            owner = np.repeat(np.arange(len(rows), dtype=np.int64), lengths)
            entry, tf = np.unique(place[words.indices.to_numpy()] * n_rows + owner, return_counts=True)
            owner = entry % n_rows
            columns = [
                words.dictionary.take(pa.array(order)).take(pa.array(entry // n_rows)),
                rows.take(pa.array(owner)),
                pa.array(tf.astype(np.int32)),
                pa.array(lengths[owner]),
                pa.nulls(len(owner), ids.type),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow_schema)

    number = F.monotonically_increasing_id() if row is None else row
    numbered = chunks.select(number.alias("row"), id_col, F.coalesce(F.lower(text_col), F.lit("")).alias("text"))
    return numbered.mapInArrow(run, schema)


PACKED = T.StructType(
    [
        T.StructField("term", T.StringType()), T.StructField("rows", T.ArrayType(T.LongType())),
        T.StructField("tfs", T.ArrayType(T.IntegerType())), T.StructField("lengths", T.ArrayType(T.IntegerType())),
    ]
)


def packed_entries_of(chunks: DataFrame, text_col: str = "text", row_col: str = "row") -> DataFrame:
    """``term, rows, tfs, lengths``: the entries of ``entries_of``, many of a word in a row, and no ids.

    Counted where the chunks lie, without a shuffle or a sort of all a task has; a word has a row for each
    PACKED_POSTINGS of a task at most.  The row without a term holds the chunks themselves.
    """
    arrow_schema = to_arrow_schema(PACKED)

    def packed(held: list[tuple]) -> pa.RecordBatch:
        # Each batch has numbered its words for itself; here they get their places in the order of all.
        words = pa.concat_arrays([h[0] for h in held]).dictionary_encode()
        order = pc.sort_indices(words.dictionary).to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        of_word = place[words.indices.to_numpy()]
        begins = np.cumsum([0, *[len(h[0]) for h in held[:-1]]])
        number = np.concatenate([of_word[begin + h[1]] for begin, h in zip(begins, held)])
        by_word = np.argsort(number, kind="stable")
        cuts = np.searchsorted(number[by_word], np.arange(len(order) + 1)).astype(np.int32)
        lists = [np.concatenate(c)[by_word] for c in list(zip(*held))[2:]]
        return made(words.dictionary.take(pa.array(order)), cuts, *lists)

    def made(terms: pa.Array, cuts: np.ndarray, *lists: np.ndarray) -> pa.RecordBatch:
        arrays = [pa.ListArray.from_arrays(pa.array(cuts), pa.array(c)) for c in lists]
        return pa.RecordBatch.from_arrays([terms, *(a.cast(f.type) for a, f in zip(arrays, list(arrow_schema)[1:]))], schema=arrow_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in _bounded(batches):
            rows, texts = batch.column(0).to_numpy(), batch.column(1)
            words, lengths = words_in(texts)
            lengths = lengths.astype(np.int32)
            if not len(rows):
                continue
            yield made(pa.nulls(1, pa.string()), np.array([0, len(rows)], np.int32), rows, np.zeros(len(rows), np.int32), lengths)
            words = words.dictionary_encode()
            owner = np.repeat(np.arange(len(rows), dtype=np.int64), lengths)
            entry, tf = np.unique(words.indices.to_numpy() * np.int64(len(rows)) + owner, return_counts=True)
            word, owner = np.divmod(entry, len(rows))
            held.append((words.dictionary, word, rows[owner], tf.astype(np.int32), lengths[owner]))
            n += len(entry)
            if n >= PACKED_POSTINGS:
                yield packed(held)
                held, n = [], 0
        if n:
            yield packed(held)

    return chunks.select(F.col(row_col).alias("row"), F.coalesce(F.lower(text_col), F.lit("")).alias("text")).mapInArrow(run, PACKED)


def unpacked(entries: DataFrame) -> DataFrame:
    """``row, tf, length`` of packed entries, beside what other columns they have."""
    others = [c for c in entries.columns if c not in ("rows", "tfs", "lengths")]
    lists = F.arrays_zip(F.col("rows").alias("row"), F.col("tfs").alias("tf"), F.col("lengths").alias("length"))
    return entries.select(*others, F.inline(lists))


def packed_counts(entries: DataFrame) -> DataFrame:
    """``term, df, total_length`` of packed entries, not yet summed over the rows of a word."""
    length = F.aggregate("lengths", F.lit(0).cast("long"), lambda total, n: total + n)
    return entries.select("term", F.size("rows").cast("long").alias("df"), F.when(F.col("term").isNull(), length).alias("total_length"))


def term_counts(entries: DataFrame) -> DataFrame:
    """Chunks per term; the row without a term holds the corpus totals.  Combined map-side, so a frequent term stays cheap."""
    return entries.groupBy("term").agg(
        F.count("*").alias("df"), F.sum(F.when(F.col("term").isNull(), F.col("length"))).alias("total_length")
    )


def _idf(df: Column, n_docs: int) -> Column:
    return F.ln(F.lit(float(n_docs)) - df + 0.5) - F.ln(df + 0.5)


@dataclass(frozen=True)
class TermStatistics:
    """Term counts and the corpus totals."""

    counts: DataFrame
    n_docs: int
    total_length: int
    mean_idf: float

    @property
    def mean_length(self) -> float:
        return self.total_length / self.n_docs if self.n_docs else 0.0

    def dictionary(self) -> DataFrame:
        """``term, df, idf``: a negative weight becomes a share of the mean."""
        raw = _idf(F.col("df"), self.n_docs)
        floor = F.lit(BM25_EPSILON * self.mean_idf)
        return self.counts.filter("term IS NOT NULL").select("term", "df", F.when(raw < 0, floor).otherwise(raw).alias("idf"))


@dataclass(frozen=True)
class Bm25Index(TermStatistics):
    """``entries`` as ``entries_of`` makes them, stored; ``buckets`` of terms if they are laid out by term.

    Packed entries come with ``unpack``, which gives ``row, tf, length`` of the chosen ones, and ``named``: ``row, <id>``.
    """

    entries: DataFrame
    id_col: str = "chunk_id"
    buckets: int | None = None
    unpack: Callable[[DataFrame], DataFrame] | None = None
    named: DataFrame | None = None

    @property
    def documents(self) -> DataFrame:
        if self.named is not None:
            return self.named
        none = F.col("term").isNull()
        rows = self.entries.filter(none if self.buckets is None else none & (F.col(POSTING_BUCKET) == -1))
        return rows.select("row", self.id_col)

    def postings(self, words: DataFrame) -> DataFrame:
        """``term, row, tf, length`` of the words in a stored table; of laid out postings only their buckets are read."""
        return self._unpacked(among(self._read(words), words, "term")).select("term", "row", "tf", "length")

    def numbered_postings(self, numbers: DataFrame) -> DataFrame:
        """``number, row, tf, length`` of the words in a stored table of ``term, number``."""
        return self._unpacked(self._read(numbers).join(sent(numbers), "term")).select("number", "row", "tf", "length")

    def _unpacked(self, entries: DataFrame) -> DataFrame:
        return entries if self.unpack is None else self.unpack(entries)

    def _read(self, words: DataFrame) -> DataFrame:
        rows = self.entries.filter("term IS NOT NULL")
        if self.buckets is not None:
            wanted = [r[0] for r in words.select(term_bucket(self.buckets)).distinct().collect()]
            rows = rows.filter(F.col(POSTING_BUCKET).isin(wanted))
        return rows.select("term", "row", "tf", "length") if self.unpack is None else rows.drop(POSTING_BUCKET)


def statistics(counts: DataFrame) -> tuple[DataFrame, int, int, float]:
    """The totals of stored term counts, as ``TermStatistics`` takes them."""
    totals = counts.filter("term IS NULL").select("df", "total_length").first()
    n_docs, total_length = (totals[0], totals[1]) if totals else (0, 0)
    mean_idf = counts.filter("term IS NOT NULL").agg(F.avg(_idf(F.col("df"), n_docs))).first()[0]
    return counts, n_docs, total_length, mean_idf or 0.0


def count_terms(chunks: DataFrame, text_col: str = "text") -> TermStatistics:
    """The dictionary alone: no postings are made or stored."""
    docs = chunks.select(_tokens(text_col).alias("tokens"))
    terms = F.array_append(F.array_distinct("tokens"), F.lit(None).cast("string"))
    spread = docs.select(F.size("tokens").alias("length"), F.explode(terms).alias("term"))
    return TermStatistics(*statistics(materialize(term_counts(spread), "bm25-terms")))


def build_index(chunks: DataFrame, id_col: str = "chunk_id", text_col: str = "text") -> Bm25Index:
    """Tokenize and count once, store the postings, take three numbers to the driver."""
    entries = materialize(entries_of(chunks, id_col, text_col), "bm25-entries")
    return Bm25Index(*statistics(materialize(term_counts(entries), "bm25-terms")), entries, id_col)


def term_bucket(buckets: int) -> Column:
    return F.coalesce(F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int"), F.lit(-1))


def laid_out(entries: DataFrame, buckets: int) -> DataFrame:
    """Entries with the bucket of their term, those of a bucket together, a crowded bucket in several tasks."""
    known = F.when(F.col("term").isNotNull(), F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int")).otherwise(-1)
    spread = entries.withColumn(POSTING_BUCKET, known)
    return spread.hint("rebalance", F.col(POSTING_BUCKET)).sortWithinPartitions(POSTING_BUCKET, "term", "row")


def store_postings(index: Bm25Index, path: str, buckets: int = 64) -> Bm25Index:
    """Write the postings in buckets of the term, sorted by it, and use them.

    A query then reads the buckets of its words, and within their files the
    row groups that can hold them.  A word found everywhere does not gather in
    one task: its bucket is split while writing.
    """
    ordered = laid_out(index.entries, buckets)
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(POSTING_BUCKET).parquet(path)
    stored = index.entries.sparkSession.read.schema(ordered.schema).parquet(path)
    return Bm25Index(index.counts, index.n_docs, index.total_length, index.mean_idf, stored, index.id_col, buckets)


def corpus_statistics(index: TermStatistics) -> DataFrame:
    """One row: documents, mean length, distinct terms, mean term weight."""
    df = F.col("df")
    return index.counts.agg(
        F.max(F.when(F.col("term").isNull(), df)).alias("n_docs"),
        (F.max("total_length") / F.max(F.when(F.col("term").isNull(), df))).alias("mean_length"),
        F.count("term").alias("n_terms"),
        F.avg(F.when(F.col("term").isNotNull(), _idf(df, index.n_docs))).alias("mean_idf"),
    )


# --- search ------------------------------------------------------------------------


def _lists(index: Bm25Index, numbers: DataFrame) -> DataFrame:
    """Stored ``term, row, impact, block`` of the numbered words: what a posting adds for each unit of weight, and its block.

    ``term`` is the word's number.  A block holds postings of one word and about equal counts and lengths, so they are of
    like impact; its number holds that of its word, so that blocks are joined by one integer.
    """
    tf, length = F.col("tf"), F.col("length")
    norm = BM25_K1 * (1 - BM25_B + BM25_B * length / F.lit(index.mean_length or 1.0))
    block = F.col("number") * 1024 + F.least(F.floor(F.log2(tf)), F.lit(15)) * 64 + F.floor(F.log2(length) * 2)
    postings = index.postings(numbers.select("term")).join(sent(numbers), "term")
    impact = (tf * (BM25_K1 + 1) / (tf + norm)).alias("impact")
    return materialize(postings.select(F.col("number").alias("term"), "row", impact, block.cast("long").alias("block")), "bm25-lists")


def _reading_plan(lists: DataFrame, weights: DataFrame) -> DataFrame:
    """Stored ``q, term, block, weight, top, after, rest, upto, must``: the blocks of each query, in the order it reads them.

    ``top`` is what a posting of the block adds at most, ``after`` that of those behind it in
    its list, ``rest`` what unread blocks can add to one chunk before this one is read,
    ``upto`` the postings read with it.  Lists that lower scores are read in any case.
    """
    blocks = lists.groupBy("term", "block").agg(F.count("*").alias("n"), F.max("impact").alias("most"))
    both = weights.join(blocks, "term").withColumn("top", F.greatest(F.col("weight") * F.col("most"), F.lit(0.0)))
    down = Window.partitionBy("q", "term").orderBy(F.desc("most"), "block")
    listed = both.withColumn("after", F.coalesce(F.lead("top").over(down), F.lit(0.0)))
    # Lists are read in order: a block is worth no more than those before it.
    listed = listed.withColumn("worth", F.min((F.col("top") - F.col("after")) / F.col("n")).over(down))
    listed = listed.withColumn("must", F.col("weight") < 0).withColumn("nth", F.row_number().over(down))
    order = Window.partitionBy("q").orderBy(F.desc("must"), F.desc("worth"), "term", "nth")
    gain = F.col("top") - F.col("after")
    planned = listed.withColumn("upto", F.sum("n").over(order)).withColumn("gained", F.sum(gain).over(order))
    rest = F.sum(gain).over(Window.partitionBy("q")) - F.col("gained") + gain
    return materialize(
        planned.withColumn("rest", rest).select("q", "term", "block", "n", "weight", "top", "after", "rest", "upto", "must"), "bm25-plan"
    )


def _best(known: DataFrame, n: int) -> DataFrame:
    """The n best rows of each query, numbered by ``place``."""
    order = Window.partitionBy("q").orderBy(F.desc("known"), "row")
    return known.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n)


def _completed(lists: DataFrame, chosen: DataFrame, skipped: DataFrame) -> DataFrame:
    """``q, row, known`` with what the chunks have in the skipped blocks (both tables are stored)."""
    lacking = chosen.select("q", "row").join(sent(materialize(skipped.select("q", "term").distinct(), "bm25-lists")), "q")
    some = among(among(lists, skipped, "term"), chosen, "row")
    late = some.join(lacking, ["row", "term"]).join(sent(skipped.drop("term")), ["q", "block"])
    both = chosen.select("q", "row", "known").unionByName(late.select("q", "row", (F.col("weight") * F.col("impact")).alias("known")))
    return both.groupBy("q", "row").agg(F.sum("known").alias("known"))


def _bars(known: DataFrame, k: int, all_others: bool) -> DataFrame:
    """``q, bar``: the k-th best score of each query that has so many chunks."""
    bars = _best(known, k).filter(F.col("place") == k).select("q", F.col("known").alias("bar"))
    return bars.filter("bar > 0") if all_others else bars


def _tasks(blocks: DataFrame) -> int:
    """In how many tasks the queries' blocks are added up: as many as their postings need, not fewer than the session's."""
    sums = blocks.agg(F.sum("n")).first()[0] or 0
    return max(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-sums // SUMS_PER_TASK))


def _scores(lists: DataFrame, plan: DataFrame, k: int, all_others: bool) -> DataFrame:
    """``q, row, score``: exact scores of all chunks that can be among the k best of their query.

    With ``all_others``, all chunks that share a word with a query that has not k above 0.
    """
    blocks = ("q", "term", "block", "weight")
    score = (F.col("weight") * F.col("impact")).alias("score")
    early = (F.col("upto") - F.col("n") < FIRST_READ) | F.col("must")
    first = lists.join(sent(materialize(plan.filter(early).select(*blocks), "bm25-first")), "block")
    partial = first.groupBy("q", "row").agg(F.sum(F.col("weight") * F.col("impact")).alias("known"))
    # The bar is that of whole scores: the chunks that look best so far get theirs.
    hopeful = materialize(_best(partial, k * HOPEFUL).select("q", "row", "known"), "bm25-hopeful")
    later = materialize(plan.filter(~early).select(*blocks), "bm25-later")
    bars = materialize(_bars(_completed(lists, hopeful, later), k, all_others), "bm25-bars")

    reach = plan.join(sent(bars), "q", "left")
    needed = early | F.col("bar").isNull() | (F.col("rest") >= F.col("bar") * ROOM - MARGIN)
    marked = reach.withColumn("read", needed)
    # What a chunk can have in a list it was not met in: the largest behind the blocks read, or of all.
    whole_list = Window.partitionBy("q", "term")
    unread = F.coalesce(F.min(F.when(F.col("read"), F.col("after"))).over(whole_list), F.max("top").over(whole_list))
    marked = materialize(marked.withColumn("unread", unread), "bm25-read")
    rest = marked.groupBy("q", "term", "bar").agg(F.first("unread").alias("unread"))
    rest = materialize(rest.groupBy("q", "bar").agg(F.sum("unread").alias("open")), "bm25-open")

    read = materialize(marked.filter("read").select("q", "block", "weight", "unread"), "bm25-blocks")
    read = sent(read, MAX_BLOCKS)
    # Dealt by chunk before they meet the queries: the sums below need no further shuffle.
    dealt = lists.repartition(_tasks(marked.filter("read")), "row")
    met = dealt.join(read, "block").select("q", "row", score, "unread")
    known = met.groupBy("q", "row").agg(F.sum("score").alias("known"), F.sum("unread").alias("seen"))
    upper = F.col("known") + F.col("open") - F.col("seen")
    chosen = known.join(sent(rest), "q").filter(F.col("bar").isNull() | (upper >= F.col("bar") - MARGIN))
    chosen = materialize(chosen.select("q", "row", "known"), "bm25-chosen")
    skipped = materialize(marked.filter("NOT read").select(*blocks), "bm25-skipped")
    if skipped.isEmpty():
        return chosen.select("q", "row", F.col("known").alias("score"))
    return _completed(lists, chosen, skipped).select("q", "row", F.col("known").alias("score"))


# --- search that reads all postings of the queries' words ------------------------------

_PIECE = "bundle long, number binary, place binary, impact binary"


def _bundle_bits(mean_length: float) -> int:
    """Chunks of a bundle, as a power of two: fewer where they are long."""
    return min(BUNDLE_BITS, max(0, int(BUNDLE_WORDS / max(1.0, mean_length)).bit_length() - 1))


def _cut_postings(postings: DataFrame, mean_length: float) -> DataFrame:
    """Pieces of bundles where they lie: ``bundle``, and of its postings the word, the place in the bundle and the impact."""
    bits = _bundle_bits(mean_length)

    def pieces(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, row, tf, length = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in range(4))
        bundle = row >> bits
        order = np.argsort(bundle, kind="stable")
        impact = tf * (BM25_K1 + 1) / (tf + BM25_K1 * (1 - BM25_B + BM25_B * length / mean_length))
        place = (row & ((1 << bits) - 1)).astype(np.int32)
        cuts = np.append(np.flatnonzero(np.diff(bundle[order], prepend=-1)), len(order))
        for i, j in zip(cuts.tolist(), cuts[1:].tolist()):
            own = order[i:j]
            columns = [pa.array([int(bundle[own[0]])])] + [pa.array([c[own].tobytes()], pa.binary()) for c in (number, place, impact)]
            yield pa.RecordBatch.from_arrays(columns, ["bundle", "number", "place", "impact"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= HELD_POSTINGS:
                yield from pieces(held)
                held, n = [], 0
        if held:
            yield from pieces(held)

    return postings.mapInArrow(run, _PIECE)


def _whole_bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over pieces sorted by bundle: each bundle with its postings sorted by word."""
    bundle, held = None, []

    def whole() -> pa.RecordBatch:
        number, place, impact = (np.frombuffer(b"".join(side), t) for side, t in zip(zip(*held), (np.int64, np.int32, np.float64)))
        order = np.argsort(number, kind="stable")
        columns = [pa.array([bundle])] + [pa.array([c[order].tobytes()], pa.binary()) for c in (number, place, impact)]
        return pa.RecordBatch.from_arrays(columns, ["bundle", "number", "place", "impact"])

    for batch in batches:
        for at, *sides in zip(*(column.to_pylist() for column in batch.columns)):
            if at != bundle and held:
                yield whole()
                held = []
            bundle = at
            held.append(sides)
    if held:
        yield whole()


def _packed_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over ``q, term, weight`` sorted by q: blocks of whole queries, as q and number of words for each, and all words."""
    names, held, n = ["q", "words", "term", "weight"], [], 0

    def packed(q: np.ndarray, term: np.ndarray, weight: np.ndarray) -> pa.RecordBatch:
        own, words = np.unique(q, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in (own, words, term, weight)], names)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append([column.to_numpy() for column in batch.columns])
        n += batch.num_rows
        if n >= BLOCK_WORDS:
            q, term, weight = map(np.concatenate, zip(*held))
            # The last query may go on.
            cut = np.searchsorted(q, q[-1])
            if cut:
                yield packed(q[:cut], term[:cut], weight[:cut])
            held, n = [[q[cut:], term[cut:], weight[cut:]]], len(q) - cut
    if n:
        yield packed(*map(np.concatenate, zip(*held)))


class _Best:
    """The k best rows of each query of a block, and those that equal the last of them."""

    def __init__(self, k: int, n_queries: int):
        self.k, self.floor = k, np.full(n_queries, -np.inf)
        self.held: list[tuple] = []
        self.n, self.limit = 0, max(100_000, 4 * k * n_queries)

    def offer(self, query: int, rows: np.ndarray, scores: np.ndarray, place: np.ndarray) -> None:
        if len(rows) > self.k:
            floor = np.partition(place, -self.k)[-self.k]
            self.floor[query] = max(floor, self.floor[query])
            good = place >= floor
            rows, scores, place = rows[good], scores[good], place[good]
        self.held.append((np.full(len(rows), query), rows, scores, place))
        self.n += len(rows)
        if self.n > self.limit:
            self.prune()
            self.limit = max(self.limit, 2 * self.n)

    def prune(self) -> tuple:
        query, rows, scores, place = map(np.concatenate, zip(*self.held))
        order = np.lexsort((-place, query))
        query, rows, scores, place = (c[order] for c in (query, rows, scores, place))
        first = np.flatnonzero(np.diff(query, prepend=-1))
        length = np.diff(np.append(first, len(query)))
        many = length >= self.k
        self.floor[query[first[many]]] = place[first[many] + self.k - 1]
        good = place >= self.floor[query]
        self.held, self.n = [tuple(c[good] for c in (query, rows, scores, place))], int(good.sum())
        return self.held[0]


def _sum_up(pairs: DataFrame, k: int, below: bool, bits: int) -> DataFrame:
    """``q, row, score``, at least the k best of each query, from pairs of a block of queries and a bundle.

    A large block without weights of 0 or less is added up in tiles, any other query by query.

    ``below``: also all rows that score below 0, of a query that has not k above 0 in the task.
    """

    def out(q: np.ndarray, rows: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(q), pa.array(rows), pa.array(scores)], ["q", "row", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple, tuple[np.ndarray, _Best]] = {}
        bars: dict[tuple, tiles.Bars] = {}
        unpacked_bundle: tuple | None = None

        def flush() -> Iterator[pa.RecordBatch]:
            for numbers, top in best.values():
                if top.held:
                    query, rows, scores, _ = top.prune()
                    for at in range(0, len(query), 65536):
                        yield out(numbers[query[at : at + 65536]], rows[at : at + 65536], scores[at : at + 65536])
            best.clear()

        for batch in batches:
            for i in range(batch.num_rows):
                kinds = (np.int64, np.int64, np.int64, np.float64, None, np.int64, np.int32, np.float64)
                columns = [c[i].as_py() if t is None else np.frombuffer(c[i].as_buffer(), t) for c, t in zip(batch.columns, kinds)]
                q, words, term, weight, bundle, number, place, impact = columns
                key = (int(q[0]), len(q))
                if len(q) >= TILED_QUERIES and weight.min() > 0:
                    # Pairs of a bundle come one after another for the most part.
                    if unpacked_bundle is None or unpacked_bundle[0] != bundle:
                        unpacked_bundle = (bundle, tiles.Bundle(number, place, impact))
                    if key not in bars:
                        if sum(b.values.size for b in bars.values()) > HELD_BARS:
                            bars.clear()
                        bars[key] = tiles.Bars(k, len(q))
                    query, rows, scores = tiles.best_in(unpacked_bundle[1], words, term, weight, bars[key])
                    for at in range(0, len(query), 65536):
                        part = slice(at, at + 65536)
                        yield out(q[query[part]], rows[part] + (bundle << bits), scores[part])
                    continue
                if key not in best:
                    best[key] = (q.copy(), _Best(k, len(q)))
                top = best[key][1]
                floor, first = top.floor, bundle << bits
                size = int(place.max()) + 1
                # Where the list of each word of a query begins and ends in the bundle.
                begin, end = np.searchsorted(number, term), np.searchsorted(number, term, "right")
                ends = np.cumsum(words)
                for n, (a, b) in enumerate(zip((ends - words).tolist(), ends.tolist())):
                    lists = [(x, y, w) for x, y, w in zip(begin[a:b].tolist(), end[a:b].tolist(), weight[a:b].tolist()) if x < y]
                    if not lists:
                        continue
                    rows = np.concatenate([place[x:y] for x, y, _ in lists])
                    sums = np.bincount(rows, np.concatenate([impact[x:y] * w for x, y, w in lists]), size)
                    # A row without the words scores 0.
                    met = np.flatnonzero(sums >= floor[n] - MARGIN) if floor[n] > MARGIN else np.unique(rows).astype(np.int64)
                    scores = sums[met]
                    at = np.round(scores, DECIMALS)
                    if below and floor[n] <= 0:
                        low = at < 0
                        if low.any():
                            yield out(np.full(int(low.sum()), q[n]), met[low] + first, scores[low])
                        met, scores, at = met[~low], scores[~low], at[~low]
                    good = at >= floor[n]
                    if good.any():
                        top.offer(n, met[good] + first, scores[good], at[good])
            if sum(top.n for _, top in best.values()) > HELD_HITS:
                yield from flush()
        yield from flush()

    columns = ("q", "words", "term", "weight", "bundle", "number", "place", "impact")
    return pairs.select(*columns).mapInArrow(run, "q long, row long, score double")


def _all_scores(index: Bm25Index, numbers: DataFrame, weights: DataFrame, k: int, pad: bool) -> DataFrame:
    """``q, row, score``: exact scores of all chunks that can be among the k best of their query.

    Every block of queries meets every bundle of chunks.  With ``pad``, also the chunks below 0.
    """
    n, n_queries = weights.agg(F.count("*"), F.count_distinct("q")).first()
    pieces = max(1, -(-n // (10 * BLOCK_WORDS)))
    dealt = weights.select("q", "term", "weight").repartition(pieces, "q").sortWithinPartitions("q")
    blocks = materialize(dealt.mapInArrow(_packed_queries, "q binary, words binary, term binary, weight binary"), "bm25-blocks")
    cut = _cut_postings(index.numbered_postings(numbers), index.mean_length or 1.0)
    tasks = int(numbers.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bundles = cut.repartition(tasks, "bundle").sortWithinPartitions("bundle").mapInArrow(_whole_bundles, _PIECE)
    # The stated queries, in blocks, against all chunks.
    if 16 * (n + n_queries) <= SENT_BYTES:
        pairs = bundles.crossJoin(F.broadcast(blocks))
    else:
        pairs = materialize(bundles, "bm25-bundles").crossJoin(blocks)
    return _sum_up(pairs, k, pad, _bundle_bits(index.mean_length or 1.0))


def _zero_rows(index: Bm25Index, asked: DataFrame, scored: DataFrame, k: int) -> DataFrame:
    """``q, <id>, score``: the first k chunks by id that score 0, of each query that has fewer than k better ones.

    Taken from the first ids; more of them, as long as a query finds too few because so many have another score.
    """
    other = scored.filter(F.round("score", DECIMALS) != 0)
    better = other.filter("score > 0").groupBy("q").agg(F.count("*").alias("n"))
    short = materialize(asked.select("q").join(better.filter(F.col("n") >= k), "q", "left_anti"), "bm25-short")
    n_short, size = short.count(), 2 * k
    while True:
        first = materialize(index.documents.orderBy(index.id_col).limit(size), "bm25-first-ids")
        # The stated queries against the first ids: a few for each of them.
        pairs = short.crossJoin(sent(first)).join(other.select("q", "row"), ["q", "row"], "left_anti")
        zeros = materialize(pairs.select("q", index.id_col, F.lit(0.0).alias("score")), "bm25-zeros")
        full = zeros.groupBy("q").agg(F.count("*").alias("n")).filter(F.col("n") >= k).count()
        if full == n_short or size >= index.n_docs:
            return zeros
        size *= 4


def bm25_topk(index: Bm25Index, queries: DataFrame, k: int = 10, pad_to_k: bool = False, skip_blocks: bool = False) -> DataFrame:
    """The k best chunks per query: ``query_id, <id>, score, rank``.

    A word the query repeats counts repeatedly, an unknown word adds nothing.
    Chunks sharing no word with the query are left out; ``pad_to_k`` lets them
    in with score 0 (in id order), so that every query gets k rows.  Each row of
    ``queries`` is ranked by itself, also if ids repeat.  Scores are compared at
    9 decimals, so the order of summation cannot decide a rank; equals rank by id.
    All postings of the queries' words are added up; with ``skip_blocks``, blocks that
    can't matter are skipped, by joins, which pays where few rare words decide.
    """
    id_col = index.id_col
    asked = materialize(queries.select(F.monotonically_increasing_id().alias("q"), "query_id", _tokens("text").alias("tokens")), "bm25-queries")
    words = asked.select("q", F.explode("tokens").alias("term")).groupBy("q", "term").agg(F.count("*").alias("times"))
    words = materialize(words, "bm25-words")
    numbers = words.select("term").distinct().withColumn("number", F.monotonically_increasing_id())
    numbers = materialize(numbers, "bm25-numbers")
    known = among(index.dictionary(), numbers, "term").join(sent(numbers), "term").withColumnRenamed("idf", "weight")
    weights = words.join(sent(materialize(known.select("term", "number", "weight"), "bm25-known")), "term")
    weights = weights.select("q", F.col("number").alias("term"), (F.col("times") * F.col("weight")).alias("weight"))
    weights = materialize(weights, "bm25-weights")
    # To pad, chunks below 0 must be known as such.
    if skip_blocks:
        lists = _lists(index, numbers)
        scored = _scores(lists, _reading_plan(lists, weights), k, pad_to_k)
    else:
        scored = _all_scores(index, numbers, weights, k, pad_to_k)

    place = F.round("score", DECIMALS)
    if pad_to_k:
        scored = materialize(scored, "bm25-scores")
    best = Window.partitionBy("q").orderBy(F.desc("place"))
    top = scored.withColumn("place", place).withColumn("nth", F.rank().over(best)).filter(F.col("nth") <= k).select("q", "row", "score")
    top = materialize(top, "bm25-top")
    named = top.join(among(index.documents, top, "row"), "row").select("q", id_col, "score")
    if pad_to_k:
        named = named.filter(F.round("score", DECIMALS) != 0).unionByName(_zero_rows(index, asked, scored, k))
    order = Window.partitionBy("q").orderBy(F.desc(place), F.asc(id_col))
    ranked = named.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(asked.select("q", "query_id"), "q").select("query_id", id_col, "score", "rank")
