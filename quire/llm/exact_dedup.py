"""Exact dedup with a Bloom filter in two passes.

The first pass counts, up to two, how often each slot of the filter is hit.  A
text that occurs twice hits all its slots twice, so the second pass knows for
most texts that they are unique; these go straight through.  Only the others
are shuffled, and compared by SHA-256.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from quire.llm.common import free_name
from quire.session import materialize

# 16 slots a row; the filter that tasks are sent has a bit a slot and MAX_SLOTS / 8 = 128 MB at most.
# Beyond 67 million rows its load grows: more rows are shuffled, the result is the same.
SLOTS_A_ROW = 16
MIN_SLOTS, MAX_SLOTS = 2**16, 2**30
BLOCK = 2**15
FLUSH = 2**21


def normalized(text: Column) -> Column:
    """Each run of blanks is one space; NULL is ''."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _slots(hashes: np.ndarray, slots: int) -> np.ndarray:
    """Two slots for each 64-bit hash."""
    bits = hashes.view(np.uint64)
    return np.concatenate([bits & np.uint64(slots - 1), (bits >> np.uint64(32)) & np.uint64(slots - 1)]).astype(np.int64)


def _packed(block: np.ndarray) -> bytes:
    return np.packbits(block, bitorder="little").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")


def _count_slots(slots: int):
    """Per task, its part of the filter: for each block that is hit, the slots hit once or more and twice or more."""

    def blocks(found: list[np.ndarray], part: int) -> Iterator[pa.RecordBatch]:
        slot, times = np.unique(np.concatenate(found), return_counts=True)
        cuts = np.flatnonzero(np.diff(slot // BLOCK)) + 1
        out = []
        for own, n in zip(np.split(slot, cuts), np.split(times, cuts)):
            once, twice = np.zeros(BLOCK, np.uint8), np.zeros(BLOCK, np.uint8)
            once[own % BLOCK] = 1
            twice[own[n > 1] % BLOCK] = 1
            out.append((int(own[0]) // BLOCK, part, _packed(once), _packed(twice)))
            if len(out) == 1024:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["block", "part", "once", "twice"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["block", "part", "once", "twice"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held, part = [], 0, TaskContext.get().partitionId() % 64
        for batch in batches:
            if batch.num_rows:
                found.append(_slots(batch.column(0).to_numpy(), slots))
                held += batch.num_rows
            if held >= FLUSH:
                yield from blocks(found, part)
                found, held = [], 0
        if found:
            yield from blocks(found, part)

    return run


def _merge(blocks: pd.DataFrame) -> pd.DataFrame:
    once, twice = np.zeros(BLOCK, np.uint8), np.zeros(BLOCK, np.uint8)
    for a, b in zip(blocks["once"], blocks["twice"]):
        hit = _unpacked(a)
        twice |= _unpacked(b) | (once & hit)
        once |= hit
    return pd.DataFrame([(blocks["block"].iloc[0], blocks["part"].iloc[0], _packed(once), _packed(twice))], columns=blocks.columns)


def repeat_filter(hashes: DataFrame):
    """A test for 64-bit hashes: False means that the hash occurs once in the only column of ``hashes``.

    Returns a function from a long column to a boolean column.  The filter is
    merged in two steps, so that no group holds more than 1/64 of the tasks'
    parts, and is bounded by MAX_SLOTS.
    """
    spark = hashes.sparkSession
    slots = min(MAX_SLOTS, max(MIN_SLOTS, 1 << (SLOTS_A_ROW * hashes.count()).bit_length()))
    schema = "block long, part long, once binary, twice binary"
    parts = hashes.mapInArrow(_count_slots(slots), schema)
    halfway = parts.groupBy("block", "part").applyInPandas(_merge, schema)
    merged = halfway.groupBy("block").applyInPandas(_merge, schema).select("block", "twice")
    bits = np.zeros(slots // 8, np.uint8)
    for row in merged.toLocalIterator():
        at = row["block"] * BLOCK // 8
        bits[at : at + BLOCK // 8] = np.frombuffer(bytes(row["twice"]), np.uint8)
    sent = spark.sparkContext.broadcast(bits.tobytes())

    @F.arrow_udf("boolean")
    def may_repeat(values: pa.Array) -> pa.Array:
        filled = np.frombuffer(sent.value, np.uint8)
        slot = _slots(values.to_numpy(zero_copy_only=False).astype(np.int64), slots)
        hit = (filled[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1
        return pa.array(hit[: len(values)] & hit[len(values) :] == 1)

    return may_repeat


def _first(id_col: str, row_col: str) -> Column:
    """Orders rows of one text: smallest id, NULL last, then any fixed one."""
    return F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.col(row_col).alias("row"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, may_repeat for every row of ``docs``.

    Texts are equal if they are after each run of blanks is replaced by one
    space; NULL is an empty text.  Of equal texts the row with the smallest id
    stays, a NULL id only if there is no other; of rows equal in id and text one
    stays.  An empty table gives no rows; other columns are not read.
    """
    digests = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.sha2(normalized(F.col(text_col)), 256).alias("text_sha256"),
            F.monotonically_increasing_id().alias("row"),
        ).withColumn("hash", F.xxhash64("text_sha256")),
        "digests",
    )
    may_repeat = repeat_filter(digests.select("hash"))
    marked = materialize(digests.withColumn("may_repeat", may_repeat(F.col("hash"))).drop("hash"), "marked")

    suspects = marked.filter("may_repeat")
    groups = suspects.groupBy("text_sha256").agg(
        F.min(_first("doc_id", "row")).alias("first"), F.count(F.lit(1)).alias("group_size")
    )
    # One row a text on the right, and stored: a join of two shuffles, in which AQE splits a hot text's rows.
    groups = materialize(groups, "repeated-texts")
    checked = suspects.join(groups, "text_sha256").select(
        "doc_id",
        F.col("first.id").alias("keep_id"),
        "group_size",
        (F.col("first.row") == F.col("row")).alias("kept"),
        "text_sha256",
        "may_repeat",
    )
    unique = marked.filter(~F.col("may_repeat")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
        "text_sha256", "may_repeat",
    )
    return unique.unionByName(checked)


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each text, all columns as they are; see ``exact_dedup``.

    Rows that the filter knows to be unique are neither shuffled nor stored.
    """
    digest, row, hint = (free_name(docs, c) for c in ("text_digest", "copy_row", "may_repeat"))
    with_digest = docs.withColumn(digest, F.sha2(normalized(F.col(text_col)), 256))
    hashes = materialize(with_digest.select(F.xxhash64(digest).alias("hash")), "digest-hashes")
    marked = with_digest.withColumn(hint, repeat_filter(hashes)(F.xxhash64(digest)))
    suspects = materialize(
        marked.filter(F.col(hint)).withColumn(row, F.monotonically_increasing_id()).drop(hint), "suspects"
    )
    first = suspects.groupBy(digest).agg(F.min(_first(id_col, row)).alias("first"))
    winners = first.select(F.col("first.row").alias(row))
    unique = marked.filter(~F.col(hint)).select(*docs.columns)
    return unique.unionByName(suspects.join(winners, row, "left_semi").select(*docs.columns))
