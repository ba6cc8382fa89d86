"""A search index that stays: kept in a folder, opened by any session, refreshed file by file.

Everything is written once and never changed.  A refresh is a new generation: the chunks
and postings of the touched files, a bitmap of the chunks they replace, and the term
counts that hold from then on.  Chunks and postings are written where they are made,
without a shuffle: a task adds a file to each bucket it has rows of, and ``compact``
gathers them.  What holds is the sum of all generations up to the last one that is
complete; the row of its totals, written last, makes it so.  A refresh that fails leaves
files that nobody reads and that the next one overwrites.  ``compact`` writes the sum as
one generation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from quire.operators import bm25, dense
from quire.operators.topk import among, sent
from quire.plans.retrieval import SearchIndex
from quire.session import materialize
from quire.sources.tables import path_exists

FILE_BUCKET = "file_bucket"
COLUMNS = ("chunk_id", "text", "file_name", "category", "document_id")
# Bitmaps of rows (4 KB for 32,768 of them) up to this many bytes are sent to all tasks.
SENT_BYTES = 64 * 1024 * 1024
BITMAP_BYTES = 4096
BITMAPS = "block bigint, bits binary"
TOTALS = "first_generation int, next_row bigint, n_docs bigint, total_length bigint, mean_idf double"


def _bitmaps(rows: DataFrame, *by: str) -> DataFrame:
    """``block, bits``: the numbers in the column ``row`` as bitmaps, for each value of ``by``."""
    blocks = rows.groupBy(*by, F.bitmap_bucket_number("row").alias("block"))
    return blocks.agg(F.bitmap_construct_agg(F.bitmap_bit_position("row")).alias("bits"))


def _in_numbers(bitmaps: DataFrame) -> DataFrame:
    """``block, numbers``: each bitmap as numbers of 64 bits, worked out once for a bitmap and not for each row it meets."""
    each = F.sequence(F.lit(0), F.lit(BITMAP_BYTES // 8 - 1))
    digits = lambda i: F.hex(F.substring(F.col("bits"), i * 8 + 1, F.lit(8)))
    return bitmaps.select("block", F.transform(each, lambda i: F.conv(digits(i), 16, -10).cast("bigint")).alias("numbers"))


def _picked(rows: DataFrame, bitmaps: DataFrame, inside: bool) -> DataFrame:
    """The rows whose number is in the bitmaps (of each block one), or is not; they are not shuffled while the bitmaps are small."""
    few = bitmaps.count() * BITMAP_BYTES <= SENT_BYTES
    bitmaps = _in_numbers(bitmaps)
    if few:
        bitmaps = F.broadcast(bitmaps)
    place = F.bitmap_bit_position("row")
    # The first byte of a number is the highest.
    bit = F.getbit(F.get("numbers", F.shiftright(place, 6).cast("int")), place.bitwiseAND(63).bitwiseXOR(56).cast("int"))
    with_bits = rows.withColumn("block", F.bitmap_bucket_number("row")).join(bitmaps, "block", "inner" if inside else "left")
    return with_bits.filter(F.coalesce(bit, F.lit(0)) == int(inside)).drop("block", "numbers")


def _fingerprint() -> Column:
    """128 bits of all columns of a chunk, NULLs told apart."""
    parts = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-")) for c in COLUMNS]
    return F.unhex(F.md5(F.concat(*parts)))


@dataclass(frozen=True)
class SearchStore:
    """The index at ``path``; ``buckets`` of files and of terms are fixed when it is built.

    ``encoder`` embeds chunks (see ``dense.embed``) and must stay the same.
    """

    spark: SparkSession
    path: str
    buckets: int = 64
    encoder: object = None

    # -- reading --

    def totals(self) -> dict | None:
        """The totals of the last complete generation, with its number; None before the first."""
        if not path_exists(self.spark, f"{self.path}/totals"):
            return None
        # A row for each generation.
        rows = self.spark.read.schema(f"{TOTALS}, generation int").parquet(f"{self.path}/totals")
        last = rows.orderBy(F.desc("generation")).limit(1).collect()
        return last[0].asDict() if last else None

    def _read(self, table: str, schema: T.StructType, totals: dict) -> DataFrame:
        fields = [f for f in schema if f.name != "generation"] + [T.StructField("generation", T.IntegerType())]
        stored = self.spark.read.schema(T.StructType(fields)).parquet(f"{self.path}/{table}")
        return stored.filter(F.col("generation").between(totals["first_generation"], totals["generation"])).drop("generation")

    def _schema(self, table: str) -> T.StructType:
        text, number, whole = T.StringType(), T.LongType(), T.IntegerType()
        field = T.StructField
        return T.StructType(
            {
                "chunks": [
                    *[field(c, text) for c in COLUMNS], field("embedding", T.BinaryType()), field("row", number),
                    field(FILE_BUCKET, whole),
                ],
                "postings": [*bm25.PACKED, field(bm25.POSTING_BUCKET, whole)],
                "terms": [field("term", text), field("df", number), field("total_length", number)],
                "removed": [*T.StructType.fromDDL(BITMAPS)],
            }[table]
        )

    def _removed(self, totals: dict) -> DataFrame:
        """Bitmaps of the rows that later generations have replaced, stored."""
        removed = self._read("removed", self._schema("removed"), totals)
        return materialize(removed.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits")), "removed-rows")

    def chunks(self, files: DataFrame | None = None) -> DataFrame:
        """All chunks that hold; with ``files`` (a stored table of ``file_name``) those of these files, read from their buckets."""
        return self._held(files).withColumn("embedding", dense.in_lists("embedding"))

    def _held(self, files: DataFrame | None = None) -> DataFrame:
        """The chunks that hold, vectors as bytes."""
        totals = self._complete()
        rows = self._read("chunks", self._schema("chunks"), totals)
        if files is not None:
            rows = among(self._touched(rows, files), files, "file_name")
        return _picked(rows, self._removed(totals), False).select(*COLUMNS, "embedding", "row")

    def _touched(self, rows: DataFrame, files: DataFrame) -> DataFrame:
        """The rows in the buckets of the files."""
        touched = [r[0] for r in files.select(self._file_bucket()).distinct().collect()]  # at most ``buckets`` numbers
        return rows.filter(F.col(FILE_BUCKET).isin(touched))

    def _counts(self, generation: int) -> DataFrame:
        """``term, df, total_length`` as they are with the generation."""
        return self._read("terms", self._schema("terms"), {"first_generation": generation, "generation": generation})

    def _complete(self) -> dict:
        totals = self.totals()
        if totals is None:
            raise FileNotFoundError(f"no search index at {self.path}")
        return totals

    def open(self) -> SearchIndex:
        """The index as it is now, vectors as bytes; later refreshes don't change what an opened index returns."""
        totals = self._complete()
        entries = self._read("postings", self._schema("postings"), totals)
        removed = self._removed(totals)
        sums = (totals["n_docs"], totals["total_length"], totals["mean_idf"])
        chunks = _picked(self._read("chunks", self._schema("chunks"), totals), removed, False)
        words = bm25.Bm25Index(
            self._counts(totals["generation"]), *sums, entries, "chunk_id", self.buckets,
            unpack=lambda chosen: _picked(bm25.unpacked(chosen), removed, False), named=chunks.select("row", "chunk_id"),
        )
        return SearchIndex(chunks.select(*COLUMNS, "embedding"), words)

    # -- writing --

    def _file_bucket(self) -> Column:
        return F.pmod(F.xxhash64("file_name"), F.lit(self.buckets)).cast("int")

    def _write(self, df: DataFrame, table: str, generation: int, *by: str) -> None:
        """Replace what an earlier try left in the generation's folder; rows go to their folders as they come, unsorted."""
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer = writer.option("compression", "zstd").option("parquet.writer.version", "PARQUET_2_0")
        setting = "spark.sql.maxConcurrentOutputFileWriters"
        before = self.spark.conf.get(setting)
        self.spark.conf.set(setting, str(max(int(before), self.buckets + 1)))
        try:
            (writer.partitionBy(*by) if by else writer).parquet(f"{self.path}/{table}/generation={generation}")
        finally:
            self.spark.conf.set(setting, before)

    def _write_generation(
        self, number: int, first: int, first_row: int, chunks: DataFrame, removed: DataFrame, lost: DataFrame | None, keep_rows: bool = False
    ) -> None:
        """``chunks`` come in, the rows of the bitmaps ``removed`` go, with the term counts ``lost``; with ``keep_rows`` files are gathered."""
        if not keep_rows:
            chunks = chunks.withColumn("row", F.monotonically_increasing_id() + first_row)
        placed = chunks.select(*COLUMNS, "embedding", "row").withColumn(FILE_BUCKET, self._file_bucket())
        self._write(placed.hint("rebalance", F.col(FILE_BUCKET)) if keep_rows else placed, "chunks", number, FILE_BUCKET)
        self._write(removed.select("block", "bits"), "removed", number)
        own = {"first_generation": number, "generation": number}
        stored = self._read("chunks", self._schema("chunks"), own)
        entries = bm25.packed_entries_of(stored).withColumn(bm25.POSTING_BUCKET, bm25.term_bucket(self.buckets))
        self._write(entries.hint("rebalance", F.col(bm25.POSTING_BUCKET)) if keep_rows else entries, "postings", number, bm25.POSTING_BUCKET)
        counts = bm25.packed_counts(self._read("postings", self._schema("postings"), own))
        if lost is not None:
            counts = counts.unionByName(lost.select("term", (-F.col("df")).alias("df"), (-F.col("total_length")).alias("total_length")))
        if first < number:
            counts = counts.unionByName(self._counts(number - 1))
        counts = counts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("total_length").alias("total_length"))
        self._write(counts.filter("df <> 0"), "terms", number)
        counts = self._counts(number)
        _, n_docs, total_length, mean_idf = bm25.statistics(counts)
        last_row = stored.agg(F.max("row")).first()[0]
        next_row = first_row if last_row is None else max(first_row, last_row + 1)
        row = (first, next_row, n_docs, total_length, mean_idf)
        self._write(self.spark.createDataFrame([row], TOTALS).coalesce(1), "totals", number)

    def build(self, chunks: DataFrame) -> None:
        """Index all chunks; what the store held before no longer counts."""
        before = self.totals()
        number, first_row = (before["generation"] + 1, before["next_row"]) if before else (1, 0)
        embedded = dense.embed(chunks.select(*COLUMNS), "text", self.encoder, as_bytes=True)
        self._write_generation(number, number, first_row, embedded, self.spark.createDataFrame([], BITMAPS), None)

    def refresh(self, chunks: DataFrame, files: DataFrame) -> dict:
        """Replace all chunks of ``files`` by ``chunks``; a file without chunks, an emptied document, is left with none.

        ``files`` (``file_name``) must name every file of ``chunks``.  Chunks that are as they were keep their rows:
        they are neither embedded nor written again.  Returns how many were removed, added and kept.
        """
        totals = self._complete()
        files = materialize(files.select("file_name").distinct(), "touched-files")
        new = materialize(chunks.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "new-chunks", compression="zstd")
        strangers = new.select("file_name").distinct().join(sent(files), "file_name", "left_anti")
        if not strangers.isEmpty():
            raise ValueError("chunks of files that are not among the refreshed ones")
        # Compared by fingerprints and row numbers, so that no text is shuffled.
        stored = self._touched(self._read("chunks", self._schema("chunks"), totals), files)
        old = among(stored.select("file_name", "row", _fingerprint().alias("same")), files, "file_name")
        old = _picked(old, self._removed(totals), False).select("same", "row", F.lit(0).alias("side"))
        both = old.unionByName(new.select(_fingerprint().alias("same"), "row", F.lit(1).alias("side")))
        # Of equal chunks as many stay as there are on both sides.
        alike, nth = Window.partitionBy("same"), Window.partitionBy("same", "side").orderBy("row")
        both = both.withColumn("stay", F.least(F.sum(1 - F.col("side")).over(alike), F.sum("side").over(alike)))
        other = both.withColumn("nth", F.row_number().over(nth)).filter("nth > stay")
        bitmaps = materialize(_bitmaps(other, "side"), "changed-chunks")
        gone, come = (bitmaps.filter(F.col("side") == side).select("block", "bits") for side in (0, 1))
        n_gone, n_come = (b.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0))).first()[0] for b in (gone, come))
        if n_gone or n_come:
            lost = bm25.packed_counts(bm25.packed_entries_of(_picked(stored, gone, True)))
            embedded = dense.embed(_picked(new, come, True).select(*COLUMNS), "text", self.encoder, as_bytes=True)
            self._write_generation(
                totals["generation"] + 1, totals["first_generation"], totals["next_row"], embedded, gone, lost
            )
        return {"removed": n_gone, "added": n_come, "kept": new.count() - n_come}

    def compact(self) -> None:
        """Write what holds as one generation, without the replaced chunks; nothing is embedded again."""
        totals = self._complete()
        number = totals["generation"] + 1
        none = self.spark.createDataFrame([], BITMAPS)
        self._write_generation(number, number, totals["next_row"], self._held(), none, None, keep_rows=True)
