"""What several operators share."""

from __future__ import annotations

import pickle
import string
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from quire.session import materialize

# "Blank" is one of these six characters everywhere in this subpackage.
BLANKS = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else untouched.  ``lower`` does that to ASCII texts, and faster than ``translate``."""
    is_ascii = F.length(text) == F.octet_length(text)
    return F.when(is_ascii, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that ``df`` doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def ranked(df: DataFrame, order: list[str], by: list[str] | None = None, label: str = "ranked") -> DataFrame:
    """``df`` with ``position`` (from 0, in ``order``), within each value of ``by`` if given.

    A window over a whole group would sort it in one task.  Here the rows are
    dealt to pieces by range, so that a hot group spans many pieces; each piece
    is numbered for itself, and the pieces' row counts, summed in order, say
    where each begins.  Only those counts (pieces + groups rows) meet in one
    task per group.  Adds columns ``piece`` and ``position``; rows equal in
    ``by`` and ``order`` are numbered in any order.
    """
    by = by or []
    keys = [F.col(c).asc_nulls_last() for c in by] + [F.col(c).asc_nulls_last() for c in order]
    pieces = materialize(df.repartitionByRange(*keys).withColumn("piece", F.spark_partition_id()), label)
    inside = Window.partitionBy("piece", *by).orderBy(*keys[len(by) :])
    local = pieces.withColumn("local", F.row_number().over(inside))

    counts = pieces.groupBy("piece", *by).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(*by).orderBy("piece") if by else Window.partitionBy(F.lit(0)).orderBy("piece")
    starts = counts.select(
        F.col("piece").alias("start_piece"),
        *[F.col(c).alias(f"start_{c}") for c in by],
        (F.sum("n").over(earlier) - F.col("n")).alias("start"),
    )
    same = F.col("piece") == F.col("start_piece")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"start_{c}"))
    numbered = local.join(starts, same)
    return numbered.select(*df.columns, "piece", (F.col("start") + F.col("local") - 1).alias("position"))


def shipped(spark: SparkSession, value: object) -> Callable[[], object]:
    """Broadcast an object of bounded size; call the result in a task, once.

    Its class travels with it, so that executors don't need this package.
    """
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)
