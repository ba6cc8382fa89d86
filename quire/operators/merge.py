"""Merges and deletes as DataFrame operators.

These describe the result; ``quire.sources.tables`` applies them to stored
tables and rewrites only what changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quire.operators.topk import sent
from quire.session import materialize


def latest_per_key(df: DataFrame, key: str, order_by: list[Column]) -> DataFrame:
    """One row per key: the first in ``order_by``.

    Spark limits each task to one row per key before the shuffle, so a key that
    holds a large share of the rows stays small.
    """
    order = Window.partitionBy(key).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def _newest_first() -> list[Column]:
    return [
        F.desc_nulls_last(F.try_to_timestamp("upload_timestamp")),
        F.desc_nulls_last("upload_timestamp"),
        F.desc_nulls_last("document_id"),
    ]


def latest_revision(df: DataFrame, key: str = "file_name") -> DataFrame:
    """The newest revision per business key; ties fall to the larger id."""
    return latest_per_key(df, key, _newest_first())


def latest_stored_revision(df: DataFrame, key: str = "file_name", keys: DataFrame | None = None) -> DataFrame:
    """``latest_revision`` of a table read from files, without shuffling its texts.

    Sorted are key, time, id and the place of a row, its file and number.  The rows that
    win, or those that lose where these are fewer, are stored and sent to a second scan;
    only where both are many are whole rows shuffled.  With ``keys`` (a stored table of
    distinct keys) only their revisions are returned.
    """
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    placed = df.select("*", *place)
    if keys is not None:
        placed = placed.join(sent(keys.select(key)), key, "left_semi")
    narrow = placed.select(key, "upload_timestamp", "document_id", "_file", "_row")
    order = Window.partitionBy(key).orderBy(*_newest_first(), "_file", "_row")
    # Without a limit on the rank: the losers are needed as well.  A hot key's rows here are a few words each.
    ranked = materialize(narrow.select("_file", "_row", (F.row_number().over(order) == 1).alias("wins")), "revisions")
    wins, loses = ranked.filter("wins").drop("wins"), ranked.filter("NOT wins").drop("wins")
    n_wins, n_loses = ranked.agg(F.count_if("wins"), F.count_if(~F.col("wins"))).first()
    if n_loses < n_wins:
        kept = placed.join(sent(loses), ["_file", "_row"], "left_anti")
    else:
        kept = placed.join(sent(wins), ["_file", "_row"], "left_semi")
    return kept.select(df.columns)


def _stored_keys(df: DataFrame, key: str) -> DataFrame:
    """The distinct keys, written once.

    Repeated keys shrink before any join, and the join sees a plain table: its
    size is known, and AQE can split a hot key of the other side (it does not
    where an aggregate stands between shuffle and join).
    """
    return materialize(df.select(key).distinct(), "keys")


def insert_only(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """The rows of ``source`` whose key the target does not hold yet.

    Of the target's keys only those that the source has are stored.
    """
    wanted = source.select(key).distinct()
    known = _stored_keys(target.select(key).join(wanted, key, "left_semi"), key)
    return source.join(known, key, "left_anti").select(source.columns)


def merge_insert_only(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target plus the new keys of the source; existing rows never change."""
    return target.unionByName(insert_only(target, source, key))


def merge_upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Rows with a key of the source are replaced whole, new keys are added."""
    kept = target.join(_stored_keys(source, key), key, "left_anti").select(target.columns)
    return kept.unionByName(source)


def changed_keys(target: DataFrame, source: DataFrame, key: str, print_col: str) -> DataFrame:
    """``<key>, n_target, n_source, changed`` of the source's keys, from both sides' keys and rows' fingerprints.

    A key is unchanged if both sides hold equally many rows of it with the same sum of
    fingerprints.  Counted map-side, so a repeated key stays small.
    """
    total = F.sum(F.col(print_col).cast("decimal(20,0)"))
    old = target.groupBy(key).agg(F.count("*").alias("n_target"), total.alias("old")).withColumnRenamed(key, "known")
    new = source.groupBy(key).agg(F.count("*").alias("n_source"), total.alias("new"))
    both = new.join(old, F.col(key).eqNullSafe(F.col("known")), "left")
    n_target = F.coalesce("n_target", F.lit(0))
    return both.select(
        key, n_target.alias("n_target"), "n_source",
        ((n_target != F.col("n_source")) | ~F.col("old").eqNullSafe(F.col("new"))).alias("changed"),
    )


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is false or unknown."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def merge_metrics(target: DataFrame, source: DataFrame, key: str, update_existing: bool) -> DataFrame:
    """One row: rows before, incoming, inserted, updated and after.

    Both sides are reduced to counts per key before they meet.
    """
    before = target.groupBy(key).agg(F.count("*").alias("n_target"), F.lit(0).cast("bigint").alias("n_source"))
    incoming = source.groupBy(key).agg(F.lit(0).cast("bigint").alias("n_target"), F.count("*").alias("n_source"))
    per_key = before.unionByName(incoming).groupBy(key).agg(
        F.sum("n_target").alias("n_target"), F.sum("n_source").alias("n_source")
    )
    # A NULL key equals no other, so it is always inserted.
    known = (F.col("n_target") > 0) & F.col(key).isNotNull()
    matched = F.when(known, F.col("n_source")).otherwise(0)
    inserted = F.when(known, 0).otherwise(F.col("n_source"))
    kept = F.when(known & (F.col("n_source") > 0), F.col("n_source")).otherwise(F.col("n_target"))
    after = F.sum(kept + inserted) if update_existing else F.sum(F.col("n_target") + inserted)
    return per_key.agg(
        F.coalesce(F.sum("n_target"), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("n_source"), F.lit(0)).alias("rows_incoming"),
        F.coalesce(F.sum(inserted), F.lit(0)).alias("rows_inserted"),
        F.coalesce(F.sum(matched) if update_existing else F.sum(F.lit(0)), F.lit(0)).alias("rows_updated"),
        F.coalesce(after, F.lit(0)).alias("rows_after"),
    )


def union_events(*batches: DataFrame) -> DataFrame:
    """Event batches by column name; a field one batch lacks becomes NULL."""
    out = batches[0]
    for batch in batches[1:]:
        out = out.unionByName(batch, allowMissingColumns=True)
    return out


def revise(
    table: DataFrame,
    key: str,
    revisions: DataFrame,
    text_col: str = "clean_text",
    order: tuple[str, ...] = ("marker", "document_id"),
) -> DataFrame:
    """Rows to upsert for text addenda, without those already applied: one row per changed row.

    ``revisions`` has ``key``, ``marker``, ``addendum`` and ``document_id``.  All
    addenda of a key are appended one after another, in ``order``; one is skipped
    where the text holds its marker by then.  The row takes the ``document_id``
    of the last one applied.
    """
    one = F.struct(*[F.col(c).alias(f"order_{c}") for c in order], "marker", "addendum", "document_id")
    by_key = revisions.groupBy(key).agg(F.sort_array(F.collect_list(one)).alias("_revisions"))
    current = table.join(by_key, key, "inner")
    start = F.struct(
        F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.lit(None).cast("string").alias("id")
    )

    def apply(done, revision):
        appended = F.struct(
            F.concat(done["text"], revision["addendum"]).alias("text"), revision["document_id"].alias("id")
        )
        return F.when(F.contains(done["text"], revision["marker"]), done).otherwise(appended)

    folded = current.withColumn("_revised", F.aggregate("_revisions", start, apply))
    changed = folded.filter(F.col("_revised.id").isNotNull())
    return changed.withColumns({text_col: F.col("_revised.text"), "document_id": F.col("_revised.id")}).select(table.columns)
