"""The gated pipeline: ingest, bronze, silver, quality, gold.

Plain Spark jobs in order on one session.  A gate that fails raises, so nothing
after it runs; each step leaves lineage events.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from quire import fixed_values as fixed
from quire.functions import text as tx
from quire.operators import expectations as ex
from quire.operators import layers, merge as mg
from quire.operators.lineage import LineageLog
from quire.session import materialize
from quire.sources import landing, topics
from quire.sources.tables import StoredTable, path_exists
from quire.streaming import ingest


class PipelineHalted(Exception):
    """A gate failed: later steps must not run."""


@dataclass(frozen=True)
class Lakehouse:
    """Where everything lives, below one root folder."""

    spark: SparkSession
    root: str
    buckets: int = 16
    fmt: str = "parquet"

    @property
    def topic(self) -> str:
        return f"{self.root}/topic"

    @property
    def ingestion(self) -> str:
        return f"{self.root}/ingestion"

    @property
    def bronze(self) -> StoredTable:
        return StoredTable(self.spark, f"{self.root}/bronze", layers.BRONZE_SCHEMA, fmt=self.fmt)

    @property
    def extraction_errors(self) -> StoredTable:
        return StoredTable(self.spark, f"{self.root}/extraction_errors", fmt=self.fmt)

    @property
    def silver(self) -> StoredTable:
        return StoredTable(
            self.spark, f"{self.root}/silver", layers.SILVER_SCHEMA, key=layers.KEY, buckets=self.buckets, fmt=self.fmt
        )

    @property
    def gold(self) -> StoredTable:
        return StoredTable(self.spark, f"{self.root}/gold", fmt=self.fmt)

    @property
    def lineage(self) -> LineageLog:
        return LineageLog(self.spark, f"{self.root}/lineage")


def produce(house: Lakehouse, folders: list[str], more_events: DataFrame | None = None) -> None:
    """Send one raw event per landed file to the topic."""
    encoded = topics.encode_events(landing.upload_events(landing.list_files(house.spark, folders)))
    if more_events is not None:
        encoded = mg.union_events(encoded, more_events)
    topics.write_topic_files(encoded, house.topic)


def consume(house: Lakehouse, inventory: DataFrame) -> dict:
    """Validate everything new on the topic; the totals of this run."""
    stream = topics.stream_topic_files(house.spark, house.topic)
    batches = ingest.run_ingestion(stream, house.ingestion, inventory=inventory)
    return ingest.run_summary(house.spark, house.ingestion, batches)


def check_ingestion(summary: dict, min_accepted: int = fixed.MIN_ACCEPTED) -> None:
    if summary["accepted"] < min_accepted:
        raise PipelineHalted(
            f"ingestion gate failed: {summary['accepted']} accepted, {summary['rejected']} rejected"
        )


def load_bronze(house: Lakehouse, loaders: dict | None = None, now: Column | None = None) -> dict:
    """Rebuild bronze from the whole manifest, with the text of each file."""
    if not path_exists(house.spark, f"{house.ingestion}/{ingest.ACCEPTED}"):
        raise FileNotFoundError(f"no validated manifest below {house.ingestion}: run the ingestion first")
    events = ingest.accepted_events(house.spark, house.ingestion).drop("batch_id")
    loaded = landing.read_and_extract(events, loaders)
    stamped = loaded.withColumn("bronze_ingested_at", F.current_timestamp() if now is None else now)
    # Counted while writing, so that the texts are not read again for it.
    coverage = Observation("coverage")
    counts = (F.count(F.lit(1)).alias("row_count"), F.count("raw_text").alias("extracted_text_count"))
    house.bronze.rebuild(stamped.observe(coverage, *counts))
    # Why a text is missing is kept beside bronze; only those files are read again.
    without = house.bronze.read().filter("raw_text IS NULL")
    failed = landing.read_and_extract(
        without.select("document_id", "file_path", "file_type", "file_size_bytes"), loaders, error_col="extraction_error"
    )
    house.extraction_errors.rebuild(failed.drop("raw_text", "file_size_bytes"))
    return dict(coverage.get)


def update_silver(house: Lakehouse, update_existing: bool = False, now: Column | None = None) -> dict:
    """Merge bronze into silver, the newest revision per file name.

    A bulk reload only inserts; ``update_existing`` replaces whole rows.  Rows
    that cannot change silver are dropped before any text is cleaned: the new
    keys are found and stored first, so that few of them are sent to the texts
    instead of shuffling these.
    """
    bronze, silver, new_keys = house.bronze.read(), house.silver, None
    if silver.exists() and not update_existing:
        keys = bronze.select(layers.KEY).distinct()
        new_keys = materialize(mg.insert_only(silver.read(), keys, layers.KEY), "new-keys")
    rows = layers.to_silver(mg.latest_stored_revision(bronze, layers.KEY, new_keys), now)
    return silver.merge(rows, update_existing)


def apply_revisions(house: Lakehouse, revisions: DataFrame, now: Column | None = None) -> dict:
    """Append addenda to current texts, all of a file's in order; those already applied are skipped."""
    stamp = F.current_timestamp() if now is None else now
    revised = mg.revise(house.silver.read(), layers.KEY, revisions).withColumns(
        {"upload_timestamp": F.regexp_replace(tx.iso_utc(stamp), "[+]00:00$", "Z"), "silver_updated_at": stamp}
    )
    rows = layers.refresh_text_columns(revised).select(layers.SILVER_SCHEMA.names)
    return house.silver.merge(mg.latest_revision(rows), update_existing=True)


def check_quality(df: DataFrame, suite: list[ex.Expectation] | None = None) -> dict:
    """The suite's outcome; its size is that of the suite."""
    results = [r.asDict() for r in ex.check_expectations(df, suite or ex.SILVER_SUITE).collect()]
    return {
        "success": all(r["success"] for r in results),
        "results": results,
        "row_count": max(r["row_count"] for r in results),
    }


def require_quality(df: DataFrame, suite: list[ex.Expectation] | None = None) -> dict:
    outcome = check_quality(df, suite)
    if not outcome["success"]:
        broken = [f"{r['expectation']}({r['column']})" for r in outcome["results"] if not r["success"]]
        raise PipelineHalted("quality gate failed: " + ", ".join(broken))
    return outcome


def build_gold(house: Lakehouse) -> dict:
    """Recompute the category statistics and store them in few files."""
    silver = house.silver.read()
    house.gold.rebuild(layers.to_gold(silver))
    house.gold.compact()
    return {"silver_row_count": layers.valid_rows(silver).count(), "gold_row_count": house.gold.count()}


def run_pipeline(
    house: Lakehouse,
    folders: list[str],
    more_events: DataFrame | None = None,
    loaders: dict | None = None,
) -> dict:
    """All steps in order; a failed gate or step stops the rest."""
    log, out = house.lineage, {}
    with log.step("produce_documents"):
        produce(house, folders, more_events)
    with log.step("validate_and_consume") as step:
        out["ingestion"] = consume(house, landing.list_files(house.spark, folders))
        step.rows = out["ingestion"]["total"]
    with log.step("check_ingestion_quality"):
        check_ingestion(out["ingestion"])
    with log.step("bronze_load") as step:
        out["bronze"] = load_bronze(house, loaders)
        step.rows = out["bronze"]["row_count"]
    with log.step("silver_transform") as step:
        out["silver"] = update_silver(house)
        step.rows = out["silver"]["rows_after"]
    with log.step("quality_checkpoint"):
        out["quality"] = require_quality(house.silver.read())
    with log.step("gold_aggregate") as step:
        out["gold"] = build_gold(house)
        step.rows = out["gold"]["gold_row_count"]
    return out
