"""Line dedup: lines that many documents share stay in one of them.

Built from DataFrame functions only.  The hashes of long lines are dealt by
range and sorted by document and position; a window streams over them and marks
where a key meets a new document.  What comes out is not text but, per document,
the runs of dropped lines, which ``apply_line_bitmaps`` applies to the texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from quire.functions.text import once
from quire.llm.common import BLANKS, ascii_lower
from quire.session import materialize

# A key that occurs in very many documents is sorted in this many slices.
SLICES = 64


def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and the text's hash: rows that share an id are told apart by their texts."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("twin"), text.alias("text"))


def line_bitmaps(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5
) -> DataFrame:
    """(doc_id, twin, runs) for each document that loses lines.

    ``runs`` is its keep bitmap, run-length coded: the first and last line
    number (from 0) of each run of dropped lines; all other lines are kept.

    A line's key is the line without blanks at its ends, A-Z lower-cased, known
    by 128 hash bits.  Keys of ``min_chars`` code points or more in ``min_docs``
    documents or more keep their lines (all of them, if repeated) in the largest
    id only.  NULL ids count as one document, smaller than any other; rows that
    share an id are one document.  NULL text is an empty line; an empty table
    gives no rows; other columns are not read.
    """
    base = _identified(docs, id_col, text_col)
    lines = base.select("doc_id", "twin", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    key = F.btrim(F.col("line"), F.lit(BLANKS))
    long_lines = lines.filter((F.length("line") >= min_chars) & (F.length(key) >= min_chars))
    key = ascii_lower(key)
    hashed = materialize(
        long_lines.select(
            "doc_id", "twin", "pos", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key).alias("h2")
        ),
        "line-hashes",
    )

    # By range of hash, then document and position.  The slice cuts a hot key
    # into pieces that many tasks share.
    slices = hashed.withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.lit(SLICES)))
    dealt = slices.repartitionByRange("h1", "h2", "slice")
    order = [F.col("doc_id").desc_nulls_last(), F.col("twin"), F.col("pos")]
    stream = Window.partitionBy("h1", "h2", "slice").orderBy(*order)
    heads = dealt.select(
        "h1",
        "h2",
        "doc_id",
        ((F.row_number().over(stream) == 1) | ~F.lag("doc_id").over(stream).eqNullSafe(F.col("doc_id"))).alias("head"),
    ).filter("head")
    shared = (
        heads.groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("home"))
        .filter(F.col("n_docs") >= min_docs)
        .select("h1", "h2", "home")
    )
    # One row a key on the right, and stored: a join of two shuffles, in which AQE splits a hot key's lines.
    shared = materialize(shared, "shared-lines")
    dropped = hashed.join(shared, ["h1", "h2"]).filter(~F.col("doc_id").eqNullSafe(F.col("home")))
    positions = dropped.groupBy("doc_id", "twin").agg(F.sort_array(F.collect_set("pos")).alias("at"))
    first = F.filter("at", lambda p, i: (i == 0) | (F.get("at", i - 1) != p - 1))
    last = F.filter("at", lambda p, i: (i == F.size("at") - 1) | (F.get("at", i + 1) != p + 1))
    return positions.select("doc_id", "twin", F.arrays_zip(first.alias("first"), last.alias("last")).alias("runs"))


def apply_line_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_text, runs: the kept lines of each row, joined by \\n.

    Every row of ``docs`` comes out once, repeated rows too; a document that
    loses all lines has an empty text, one without a bitmap stays as it is.
    """
    base = _identified(docs, id_col, text_col)
    right = bitmaps.select(F.col("doc_id").alias("b_id"), F.col("twin").alias("b_twin"), "runs")
    joined = base.join(right, base.doc_id.eqNullSafe(right.b_id) & (base.twin == right.b_twin), "left")
    split = once(joined, lines=F.split("text", "\n"))
    placed = once(split, n_lines=F.size("lines"))
    begin = lambda i: F.coalesce(F.get("runs", i - 1)["last"] + 1, F.lit(0))
    end = lambda i: F.coalesce(F.get("runs", i)["first"], F.col("n_lines"))
    pieces = F.transform(
        F.sequence(F.lit(0), F.size("runs")), lambda i: F.slice("lines", begin(i) + 1, end(i) - begin(i))
    )
    n_dropped = F.aggregate(
        "runs", F.lit(0).cast("long"), lambda acc, run: acc + (run["last"] - run["first"] + 1).cast("long")
    )
    kept = F.when(F.col("runs").isNull(), F.col("text")).otherwise(F.array_join(F.flatten(pieces), "\n"))
    return placed.select(
        "doc_id",
        F.col("n_lines").cast("long").alias("n_lines"),
        F.coalesce(n_dropped, F.lit(0)).cast("long").alias("n_dropped"),
        kept.alias("kept_text"),
        "runs",
    )


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5
) -> DataFrame:
    """Both steps: see ``line_bitmaps`` and ``apply_line_bitmaps``."""
    bitmaps = line_bitmaps(docs, id_col, text_col, min_chars, min_docs)
    return apply_line_bitmaps(docs, bitmaps, id_col, text_col)
