"""Mixing sources to target weights by systematic sampling, from DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quire.llm.common import free_name, ranked, word_count
from quire.session import materialize

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """source, source_size, target: how many words each source should give.

    ``sizes`` has (source, size) rows.  Sources in order of code point, NULL
    last, take the weights in turn.  A target is the source's weight times one
    level, or ``max_copies`` times its size where that is less; the level is
    such that the targets add up to all sizes.  (Sharing again what exceeds a
    limit, until none does, ends at this level.)  Sources are few beside
    documents: this table alone is ordered in one task.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everywhere = Window.partitionBy(F.lit(0))
    rank = F.row_number().over(everywhere.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    limit = F.col("source_size").cast("double") * max_copies
    weighed = totals.select("source", "source_size", weight.alias("weight"), limit.alias("limit"))

    # Sources reach their limits in order of limit / weight.  With those before
    # one at their limits, the rest would share at the level computed here; it
    # rises up to the source where the limits stop to matter, and falls after it.
    fills = everywhere.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fills.rowsBetween(Window.unboundedPreceding, -1)
    onward = fills.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(everywhere).cast("double")
    level = (total - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    levels = weighed.withColumn("level", level)
    target = F.least("limit", F.col("weight") * F.max("level").over(everywhere))
    return levels.select("source", "source_size", target.alias("target"))


def random_offset(source: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the source and the seed alone."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("\u0000")))), 1, 12)
    return F.conv(digits, 16, 10).cast("double") / float(16**12)


def mix_sizes(
    sizes: DataFrame, seed: int = 0, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES
) -> DataFrame:
    """Rows (source, size, doc_id, ...) with source_size, target, copies and taken.

    Every document of a source is expected target / source_size times.  These
    expected copies are summed up along the source, its documents in order of
    size (so that every stretch of sizes is drawn from evenly) and then of id,
    and the source's random offset is added; a document is emitted once for each
    integer that its own share crosses.  The order and the offset are fixed by
    the rows and the seed: reruns agree, equal rows may trade places.
    """
    sizes = materialize(sizes, "mix-sizes")
    targets = source_targets(sizes, weights, max_copies)
    placed = ranked(sizes, ["size", "doc_id"], by=["source"], label="mix-ranked")
    right = targets.select(F.col("source").alias("t_source"), "source_size", "target")
    joined = placed.join(right, placed.source.eqNullSafe(right.t_source))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = random_offset(F.col("source"), seed)
    upto = F.floor((F.col("position") + 1) * rate + offset)
    copies = (upto - F.floor(F.col("position") * rate + offset)).cast("long")
    return joined.select(
        *sizes.columns, "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def mix_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken for every row of ``docs``.

    A document's size is its number of words (NULL text: 0).  Sources without a
    word get the target 0 and no copies; an empty table gives no rows.
    """
    return mix_sizes(
        docs.select(
            F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), F.col(id_col).alias("doc_id")
        ),
        **how,
    )


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mix itself: rows of ``docs`` with all their columns, as often as they are drawn."""
    row = free_name(docs, "mix_row")
    copies = free_name(docs, "mix_copies")
    # The numbers are fixed by writing them with the rows.
    stored = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "mix-input")
    drawn = mix_sizes(
        stored.select(
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
            F.col(id_col).alias("doc_id"),
            F.col(row).alias("row"),
        ),
        **how,
    )
    drawn = drawn.filter("copies > 0").select(F.col("row").alias(row), F.col("copies").cast("int").alias(copies))
    out = stored.join(drawn, row)
    return out.withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns)
