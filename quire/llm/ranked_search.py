"""Ranked lexical search without random access (NRA), for a whole table of queries.

Every list of the index is sorted by impact and read from the top on, block by block.
What has been read gives each document an interval: its score is at least the sum of
what was seen of it, and at most that and, for each list in which it was not seen, the
largest impact still unread.  Once all unread documents together stay below the k-th
best lower end, a query is closed: only documents whose interval reaches up to it go
on.  Reading ends when all of these are fully known, so that members, ties and scores
are exact.

Each round is a few joins and sums over all queries; the blocks to read are planned for
all rounds beforehand: those that lower the bound most for each posting come first.

Words are known by 64-bit hashes; a wrong score needs a collision of a query's word with
another word of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quire.llm.common import ascii_lower
from quire.llm.phrase_index import MAX_SENT, among
from quire.session import materialize

# Words are runs of ASCII letters, digits and all beyond ASCII.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Impact is at most 10**9 / 1000; a list's block holds the impacts of a quarter octave.
LEVELS_AN_OCTAVE = 4
# Postings a query reads in the first round, and how much further it has read after each later one.
FIRST_READ, GROWTH = 4096, 4
SLICE_BYTES = 8_000_000


# By byte: is it part of a word?  All bytes of a character beyond ASCII are.
IN_WORD = np.array([b > 0x7F or chr(b).isalnum() for b in range(256)])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow over texts: how many have a word, and all their words, for each batch."""
    for batch in batches:
        texts = batch.column(0).cast(pa.large_binary()).drop_null()
        if not len(texts):
            continue
        _, offsets, data = texts.buffers()
        ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        inside = IN_WORD[np.frombuffer(data, np.uint8, ends[-1] - ends[0], ends[0])] if ends[-1] > ends[0] else np.zeros(0, bool)
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        # A text's first byte follows nothing.
        first = (ends[:-1] - ends[0])[np.diff(ends) > 0]
        begins[first] = inside[first]
        # Words up to each end, and so those of each text.
        upto = np.searchsorted(np.flatnonzero(begins), ends - ends[0])
        yield pa.RecordBatch.from_arrays([pa.array([int((np.diff(upto) > 0).sum())]), pa.array([int(upto[-1])])], ["docs", "words"])


def _impacts(n_docs: int, n_words: int, schema: pa.Schema):
    """mapInArrow over d, doc_id, text: a row for each document, and one for each of its words with its impact."""

    def postings(d: np.ndarray, texts: pa.Array) -> pa.RecordBatch:
        lists = pc.split_pattern_regex(pc.ascii_lower(texts.fill_null("")), BETWEEN + "+")
        row = np.repeat(np.arange(len(d)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        words = lists.flatten()
        filled = pc.greater(pc.binary_length(words), 0)
        row, words = row[filled.to_numpy(zero_copy_only=False)], words.filter(filled).dictionary_encode()
        size = max(1, len(words.dictionary))
        entry, tf = np.unique(row * size + words.indices.to_numpy(), return_counts=True)
        own, n = entry // size, np.bincount(row, minlength=len(d))
        m = 100 - 25 + 25 * n * n_docs // max(1, n_words)
        impact = 1_000_000_000 * tf // (1000 * tf + 12 * m[own])
        columns = {"word": words.dictionary.take(pa.array(entry % size)), "d": pa.array(d[own]), "impact": pa.array(impact)}
        return columns | {"doc_id": pa.nulls(len(own), schema.field("doc_id").type)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(columns: dict) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in schema], schema=schema)

        for batch in batches:
            d, texts = batch.column(0).to_numpy(), batch.column(2)
            none = pa.nulls(len(d))
            yield made({"word": none, "d": batch.column(0), "impact": none, "doc_id": batch.column(1)})
            slice_no = np.cumsum(pc.binary_length(texts.fill_null("")).to_numpy(zero_copy_only=False), dtype=np.int64) // SLICE_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(slice_no)) + 1).tolist(), len(d)]
            for begin, end in zip(cuts, cuts[1:]):
                if end > begin:
                    yield made(postings(d[begin:end], texts.slice(begin, end - begin)))

    return run


@dataclass(frozen=True)
class ImpactIndex:
    """``entries``: term, d, impact, in each file sorted by term and falling impact; a row without a term for each document."""

    entries: DataFrame
    n_docs: int

    @property
    def postings(self) -> DataFrame:
        return self.entries.filter("term IS NOT NULL").select("term", "d", "impact")

    @property
    def documents(self) -> DataFrame:
        return self.entries.filter("term IS NULL").select("d", "doc_id")


def impact_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> ImpactIndex:
    """Index the whole of ``docs`` and store it in the shared folder.

    ``d`` numbers the rows, so repeated rows and NULL ids stay apart.  NULL and empty
    texts have no words and don't count as documents; other columns are not read.
    """
    counted = docs.select(F.col(text_col).cast("string")).mapInArrow(_count_words, "docs long, words long")
    total = counted.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("docs"), F.coalesce(F.sum("words"), F.lit(0)).alias("words")).first()
    schema = T.StructType(
        [
            T.StructField("word", T.StringType()), T.StructField("d", T.LongType()),
            T.StructField("impact", T.LongType()), T.StructField("doc_id", docs.schema[id_col].dataType),
        ]
    )
    rows = docs.select(F.monotonically_increasing_id().alias("d"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    entries = rows.mapInArrow(_impacts(total["docs"], total["words"], to_arrow_schema(schema)), schema)
    hashed = entries.select(F.when(F.col("word").isNotNull(), F.xxhash64("word")).alias("term"), "d", "impact", "doc_id")
    return ImpactIndex(materialize(hashed.sortWithinPartitions("term", F.desc("impact")), "impact-index"), total["docs"])


def _sent(df: DataFrame) -> DataFrame:
    """Tell Spark to send a stored table to all tasks, if it is small."""
    return F.broadcast(df) if df.count() <= MAX_SENT else df


def _read_plan(index: ImpactIndex, words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The queries' lists, with the block of each posting, and which query reads which block in which round.

    Stored: ``term, d, impact, level`` and ``q, term, level, weight, top, after, round``; a posting adds weight * impact to
    a score, the block's largest adds ``top``, the largest behind the block ``after``.
    """
    level = F.floor(F.log2("impact") * LEVELS_AN_OCTAVE).cast("int")
    lists = materialize(among(index.postings, words, "term").withColumn("level", F.when(F.col("impact") > 0, level)), "query-lists")
    blocks = lists.groupBy("term", "level").agg(F.count(F.lit(1)).alias("n"), F.max("impact").alias("top"))
    df = F.sum("n").over(Window.partitionBy("term"))
    idf = F.floor(1000 * F.log((2.0 * index.n_docs + 2) / (2.0 * F.col("df") + 1))).cast("long")
    blocks = materialize(blocks.withColumn("df", df).withColumn("idf", idf).filter("level IS NOT NULL AND idf > 0"), "list-blocks")

    down = Window.partitionBy("q", "term").orderBy(F.desc("level"))
    both = words.join(blocks, "term").select("q", "term", "level", "n", "top", (F.col("times") * F.col("idf")).alias("weight"))
    behind = both.withColumn("after", F.coalesce(F.lead("top").over(down), F.lit(0)) * F.col("weight"))
    behind = behind.withColumn("top", F.col("top") * F.col("weight"))
    # A list is read in order, so a block is worth no more than those before it.
    worth = F.min((F.col("top") - F.col("after")) / F.col("n")).over(down)
    upto = F.sum("n").over(Window.partitionBy("q").orderBy(F.desc("worth"), "term", F.desc("level")))
    after = F.ceil(F.log(F.col("upto") / FIRST_READ) / F.log(F.lit(float(GROWTH))))
    planned = behind.withColumn("worth", worth).withColumn("upto", upto)
    planned = planned.withColumn("round", F.greatest(after, F.lit(0)).cast("int"))
    return lists, materialize(planned.select("q", "term", "level", "weight", "top", "after", "round"), "read-plan")


def _read(lists: DataFrame, blocks: DataFrame, status: DataFrame | None, candidates: DataFrame | None) -> DataFrame:
    """``q, d, term, score`` of the blocks: whole for queries that are open, else those of candidates."""
    score = (F.col("weight") * F.col("impact")).alias("score")
    opened = blocks if status is None else blocks.join(F.broadcast(status.filter("NOT closed").select("q")), "q", "left_semi")
    opened = materialize(opened, "open-blocks")
    whole = lists.join(_sent(opened), ["term", "level"]).select("q", "d", "term", score)
    if status is None:
        return whole
    narrow = blocks.groupBy("q", "term", "weight").agg(F.min("level").alias("low"), F.max("level").alias("high"))
    probes = materialize(candidates.select("q", "d").join(_sent(materialize(narrow, "closed-blocks")), "q"), "probes")
    some = among(among(lists, probes, "term"), probes, "d")
    found = some.join(probes, ["d", "term"]).filter("level BETWEEN low AND high").select("q", "d", "term", score)
    return whole.unionByName(found)


def top_documents(index: ImpactIndex, queries: DataFrame, k: int = 20) -> DataFrame:
    """``q, d, score`` of all documents that may be among the k best of a query, with exact scores.

    ``queries``: q, text; q is unique.  Documents that tie with the k-th are all returned;
    without a word in common there are no rows, and fewer than k where fewer score above 0.
    """
    text = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    words = queries.select("q", F.explode(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).alias("word"))
    words = materialize(words.groupBy("q", F.xxhash64("word").alias("term")).agg(F.count(F.lit(1)).alias("times")), "query-words")
    lists, plan = _read_plan(index, words)
    rounds = plan.agg(F.max("round")).first()[0]
    pieces, results, status, candidates = [], [], None, None
    for number in range(-1 if rounds is None else rounds + 1):
        live = plan if status is None else plan.join(F.broadcast(status.select("q")), "q", "left_semi")
        pieces.append(materialize(_read(lists, live.filter(F.col("round") == number), status, candidates), "read-postings"))

        # What is unread in each list, and in all lists of a query.
        done = F.col("round") <= number
        unread = live.groupBy("q", "term").agg(F.coalesce(F.min(F.when(done, F.col("after"))), F.max("top")).alias("unread"))
        unread = materialize(unread, "unread")
        read = pieces[0]
        for piece in pieces[1:]:
            read = read.unionByName(piece)
        seen = read.join(_sent(unread), ["q", "term"])
        rest = unread.groupBy("q").agg(F.sum("unread").alias("rest"))
        bounds = seen.groupBy("q", "d").agg(F.sum("score").alias("lower"), (F.sum("score") - F.sum("unread")).alias("over"))
        bounds = materialize(bounds, "bounds")

        best = Window.partitionBy("q").orderBy(F.desc("lower"))
        ends = bounds.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k)
        ends = ends.groupBy("q").agg(F.when(F.count(F.lit(1)) == k, F.min("lower")).otherwise(0).alias("bar"))
        state = rest.join(ends, "q", "left").withColumn("bar", F.coalesce("bar", F.lit(0)))
        state = materialize(state.withColumn("closed", (F.col("rest") < F.col("bar")) | (F.col("rest") == 0)), "bars")
        # The upper end is rest + over.  While a query is open, no document is out.
        inside = bounds.join(_sent(state), "q").filter("closed AND rest + over >= bar")
        inside = materialize(inside.select("q", "d", "lower", (F.col("rest") + F.col("over") > F.col("lower")).alias("vague")), "candidates")
        vague = inside.groupBy("q").agg(F.max("vague").alias("vague"))
        # A closed query without candidates has no words in any document.
        state = materialize(state.join(vague, "q", "left").withColumn("known", F.col("closed") & ~F.coalesce("vague", F.lit(False))), "bars")
        known = state.filter("known").select("q")
        results.append(inside.join(_sent(known), "q", "left_semi").select("q", "d", F.col("lower").alias("score")))
        status = state.filter("NOT known").select("q", "closed")
        candidates = inside.join(_sent(known), "q", "left_anti")
        if status.isEmpty():
            break
    if not results:
        return queries.sparkSession.createDataFrame([], "q long, d long, score long")
    found = results[0]
    for piece in results[1:]:
        found = found.unionByName(piece)
    return found.filter("score > 0")


def rank_documents(
    docs: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best rows of ``docs`` for each row of ``queries`` with score above 0.

    Equal scores rank by ascending id, NULL last; of equal rows any comes first.  Each
    repeated row of ``queries`` has its own ranks.  Queries without known words and empty
    tables have no rows.  Texts are read whole, however long.
    """
    asked = queries.select(F.monotonically_increasing_id().alias("q"), F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
    asked = materialize(asked, "queries")
    index = impact_index(docs, id_col, text_col)
    found = materialize(top_documents(index, asked, k), "top-documents")
    named = found.join(among(index.documents, found, "d"), "d")
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "d")
    ranked = named.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(asked.select("q", "item_id"), "q").select("item_id", "rank", "doc_id", "score")
